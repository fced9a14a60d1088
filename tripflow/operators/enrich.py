"""Zone names for rides: two left joins to the zone dimension.

A dimension is broadcast only after its rows and bytes were measured. Beyond the bound the join
shuffles, and then the ids that carry most rows (one zone may hold a third of them) and the rows
without an id are salted, so no task receives a hot group whole. The rides are read once for both
sides, apart from the pass that finds the hot ids.

Measuring, and finding the hot ids of a large dimension's rides, are jobs that run when the join
is built.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BROADCAST_ROWS = 100_000
BROADCAST_BYTES = 32 * 1024 * 1024
HOT_KEYS = 20_000
SALTS = 64


def fits_broadcast(
    dimension: DataFrame,
    max_rows: int | None = None,
    max_bytes: int | None = None,
) -> bool:
    """Measures a dimension's rows and the bytes of its values as text (runs a job)."""
    max_rows = BROADCAST_ROWS if max_rows is None else max_rows
    max_bytes = BROADCAST_BYTES if max_bytes is None else max_bytes
    text = F.concat_ws("", *[F.col(name).cast("string") for name in dimension.columns])
    size = dimension.agg(
        F.count(F.lit(1)).alias("rows"), F.sum(F.octet_length(text)).alias("bytes")
    ).first()
    return size.rows <= max_rows and (size.bytes or 0) <= max_bytes


def hot_ids(facts: DataFrame, key: str) -> DataFrame:
    """The ids that each hold more than 1/``HOT_KEYS`` of the rows (runs a job).

    There are fewer than ``HOT_KEYS`` of them by that definition, so they can be collected.
    """
    per_id = facts.groupBy(key).agg(F.count(F.lit(1)).alias("_rows"))
    total = per_id.agg(F.sum("_rows")).scalar()
    hot = per_id.filter(F.col(key).isNotNull() & (F.col("_rows") * HOT_KEYS > total))
    ids = hot.select(key, F.lit(True).alias("_hot"))
    return facts.sparkSession.createDataFrame(ids.collect(), ids.schema)


def _join_spreading_hot_ids(
    facts: DataFrame, names: DataFrame, key: str, hot: DataFrame
) -> DataFrame:
    """Left join to a dimension too large to broadcast.

    Rows with a hot id or none are dealt over ``SALTS`` parts by a hash of the row, and the
    dimension's hot rows are repeated for each part. All in one join over one scan.
    """
    marked = facts.join(F.broadcast(hot), key, "left")
    spread = F.col("_hot").isNotNull() | F.col(key).isNull()
    salt = F.pmod(F.xxhash64(*facts.columns), F.lit(SALTS)).cast("int")
    salted = marked.withColumn("_salt", F.when(spread, salt).otherwise(0)).drop("_hot")
    parts = F.when(F.col("_hot"), F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(
        F.array(F.lit(0))
    )
    copies = (
        names.join(F.broadcast(hot), key, "left")
        .withColumn("_salt", F.explode(parts))
        .drop("_hot")
    )
    return salted.join(copies, [key, "_salt"], "left").drop("_salt")


def _zone_names(zones: DataFrame, side: str) -> DataFrame:
    return zones.select(
        F.col("LocationID").cast("bigint").alias(f"{side}_location_id"),
        F.col("Zone").alias(f"{side}_zone"),
    )


def zones_fit_broadcast(zones: DataFrame) -> bool:
    """Whether the part of the zone dimension that rides need may be broadcast."""
    return fits_broadcast(_zone_names(zones, "pickup"))


def enrich(
    rides: DataFrame,
    zones: DataFrame,
    sides: tuple[str, ...] = ("pickup", "dropoff"),
    *,
    small: bool | None = None,
) -> DataFrame:
    """Adds ``{side}_zone`` by ``{side}_location_id``; null where no zone matches.

    Measures the dimension unless ``small`` says whether it may be broadcast. The hot ids of all
    sides are found before the first join, which their job would otherwise run again.
    """
    if small is None:
        small = zones_fit_broadcast(zones)
    keys = {side: f"{side}_location_id" for side in sides}
    # The hot ids of a stream are not known beforehand; it is joined as it comes.
    plain = small or rides.isStreaming
    hot = {} if plain else {side: hot_ids(rides, key) for side, key in keys.items()}
    for side, key in keys.items():
        names = _zone_names(zones, side)
        if plain:
            rides = rides.join(F.broadcast(names) if small else names, key, "left")
        else:
            rides = _join_spreading_hot_ids(rides, names, key, hot[side])
    return rides

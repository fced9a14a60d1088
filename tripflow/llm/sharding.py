"""Shards of near equal bytes by histogram sort.

Rows are ordered by a hash of their text, then by a hash of their id, then by their place. Equal
texts lie side by side and hot texts can still be cut. Splitters are searched for: every round
counts the exact bytes below some candidate boundaries over all rows, and each splitter keeps the
interval between two candidates that holds its share of the bytes, until a candidate is within
tolerance. Then rows go to their places in one exchange.

The keys are written once, so the rounds read a few columns and never the texts. A shard is
several ranges, each small enough for one task; what slots need of the others is one count each.

Column expressions and aggregations throughout. Defined results: a null text has no bytes, size 8
and the checksum of the empty text. Repeated rows differ only in their place and can be cut
apart. An empty table gives no rows. Extra columns play no part.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripflow.llm.common import bucket_of, saved, text_or_empty

#: Hexadecimal digits of a key: text hash, id hash, place.
KEY_DIGITS = (16, 16, 16)


@dataclass(frozen=True)
class ShardParams:
    """``tolerance`` is a share of a shard's bytes; ``range_rows`` is what one task sorts."""

    shards: int = 24
    tolerance: float = 0.005
    range_rows: int = 250_000
    probes: int = 16


def _hex(number: Column) -> Column:
    return F.lpad(F.hex(number), 16, "0")


def sort_keys(docs: DataFrame) -> DataFrame:
    """``doc_id, size, text_crc32, key`` for every document, without its text."""
    text = text_or_empty()
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.octet_length(text) + F.lit(8)).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.concat(
            F.upper(F.substring(F.md5(text.cast("binary")), 1, 16)),
            _hex(F.xxhash64(F.col("doc_id").cast("long"))),
            _hex(F.monotonically_increasing_id()),
        ).alias("key"),
    )


#: One step in the text hash.
TEXT_STEP = 16 ** sum(KEY_DIGITS[1:])


def _digits(value: int) -> str:
    return f"{value:0{sum(KEY_DIGITS)}X}"


@dataclass(frozen=True)
class Stretch:
    """Rows between two neighbouring candidates: their ends, and exact bytes below and with them."""

    first: int
    last: int
    below: int
    through: int
    rows: int


def _histogram(keys: DataFrame, bounds: list[int]) -> list[Stretch]:
    """Counts all rows between ascending bounds; one row per bound reaches the driver."""
    at = bucket_of(F.col("key"), F.lit([_digits(bound) for bound in bounds]), len(bounds))
    counted = keys.groupBy(at.alias("at")).agg(
        F.sum("size").alias("bytes"),
        F.count(F.lit(1)).alias("rows"),
        F.min("key").alias("first"),
        F.max("key").alias("last"),
    )
    found, total = [], 0
    for row in sorted(counted.collect(), key=lambda row: row["at"]):
        ends = int(row["first"], 16), int(row["last"], 16)
        found.append(Stretch(*ends, total, total + row["bytes"], row["rows"]))
        total += row["bytes"]
    return found


def _probes(stretch: Stretch, count: int) -> list[int]:
    """Candidates inside a stretch: between texts as long as it has two, else between rows."""
    first, last, step = stretch.first, stretch.last, 1
    if first // TEXT_STEP != last // TEXT_STEP:
        step = TEXT_STEP
    low, high = first // step, last // step
    return sorted({(low + 1 + (high - low - 1) * i // count) * step for i in range(count + 1)})


def splitters(keys: DataFrame, parts: int, params: ShardParams) -> list[str]:
    """Ascending boundaries of all shards' ``parts`` ranges; a row at its boundary lies behind it.

    A candidate between two texts is taken if it is within tolerance, so groups of equal texts
    stay whole unless one is larger than that. Between shards the tolerance is of a shard's
    bytes, however many ranges a shard has; between ranges of one shard it is of a range's. A
    range that a neighbouring shard's boundary has passed is empty.
    """
    count = params.shards * parts
    # The first candidates part the text hashes evenly.
    first = 16 * count
    stretches = _histogram(
        keys, [16 ** KEY_DIGITS[0] * i // first * TEXT_STEP for i in range(1, first)]
    )
    if not stretches:
        return []
    total = stretches[-1].through
    numbers = range(1, count)
    goals = {number: total * number // count for number in numbers}
    slack = {
        number: params.tolerance * total / (params.shards if number % parts == 0 else count)
        for number in numbers
    }
    found: dict[int, int] = {}
    while True:
        probes: set[int] = set()
        for number, goal in goals.items():
            if number in found:
                continue
            own = next(s for s in stretches if s.below <= goal < s.through)
            if own.rows == 1 or own.first == own.last or goal - own.below <= slack[number]:
                low = goal - own.below <= own.through - goal
                found[number] = own.first if low else own.last + 1
            elif own.through - goal <= slack[number]:
                found[number] = own.last + 1
            else:
                # With its own ends among the bounds a stretch can only shrink.
                probes.update([own.first, *_probes(own, params.probes), own.last + 1])
        if not probes:
            break
        stretches = _histogram(keys, sorted(probes))
    # A bound behind the very last key has no digits of its own.
    top = 16 ** sum(KEY_DIGITS) - 1
    between = {0: 0, **{n: min(at, top) for n, at in found.items() if n % parts == 0}, count: top}
    bounds = []
    for number in numbers:
        shard = number - number % parts
        inside = between[shard], between[min(shard + parts, count)]
        bounds.append(_digits(between.get(number, min(max(found[number], inside[0]), inside[1]))))
    return bounds


def assign_shards(docs: DataFrame, params: ShardParams | None = None) -> DataFrame:
    """``doc_id, size, text_crc32, law, shard, slot, grown_shard`` for every document."""
    params = params or ShardParams()
    keys = saved(sort_keys(docs), "shard-keys")
    rows = keys.count()
    # Every shard is the same number of ranges, and shards are cut first and exactly.
    parts = max(1, -(-rows // (params.shards * params.range_rows)))
    bounds = splitters(keys, parts, params)
    place = bucket_of(F.col("key"), F.lit(bounds), len(bounds)) if bounds else F.lit(0)
    placed = saved(
        keys.withColumn("place", place.cast("int")).repartitionById(
            params.shards * parts, F.col("place")
        ),
        "shard-placed",
    )
    # One count per range.
    counts = {row["place"]: row["count"] for row in placed.groupBy("place").count().collect()}
    offsets: list[int] = []
    for first in range(0, params.shards * parts, parts):
        inside = (counts.get(place, 0) for place in range(first, first + parts - 1))
        offsets.extend(accumulate(inside, initial=0))
    return placed.selectExpr(
        "*", "row_number() over (partition by place order by key) as number"
    ).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        F.floor(F.col("place") / parts).cast("int").alias("shard"),
        (F.get(F.lit(offsets), F.col("place")) + F.col("number") - 1).cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )

"""Training order: every sequence at its own slot, in shards of fixed stride.

Documents become token ids, either those of a vocabulary file (four bytes each) or their UTF-8
bytes (one byte each), and are cut into sequences of ``length`` ids, the last one filled up with
``pad``. Sequences are numbered through all documents, and a keyed Feistel network permutes
the numbers: an even number of bits is swapped in rounds, and a result beyond the last sequence
goes through the network again until it is inside (cycle-walking). So every number gets a slot of
its own without a sort or a shuffle table, and anybody with the key can compute either way.

Slots are then dealt out by ranges, ``stride`` to a shard; each shard is one folder whose records
are all of the same size, little-endian, in slot order. A reader resumes at any slot by
dividing; a writer resumes by making those shards whose rows are not all there.

Defined results: null and empty texts have no sequence. Repeated rows have sequences of their
own. An empty table gives no rows. A very long text is encoded whole in one task and has as many
sequences as it needs. Extra columns play no part.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripflow.llm.bpe import ID, codec
from tripflow.llm.common import id_or_none, saved, texts_of, with_null_ids
from tripflow.sources.folders import run_folder

BATCH_DOCS = 500
RECORD = "slot long, shard long, doc_id long, number int, n_tokens int, ids binary"


@dataclass(frozen=True)
class OrderParams:
    """``stride`` slots per shard; ``key`` fixes the order."""

    length: int = 4_096
    stride: int = 16_384
    key: int = 20_240_601
    rounds: int = 6
    pad: int = 0


def _round(value: np.ndarray, key: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (value + np.uint64(key)) * np.uint64(0x9E3779B97F4A7C15)
        x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def _network(values: np.ndarray, half: int, keys: list[int]) -> np.ndarray:
    mask = np.uint64((1 << half) - 1)
    left, right = values >> np.uint64(half), values & mask
    for key in keys:
        left, right = right, left ^ (_round(right, key) & mask)
    return (left << np.uint64(half)) | right


def _round_keys(params: OrderParams) -> list[int]:
    random = np.random.default_rng(params.key)
    return [int(k) for k in random.integers(0, 1 << 63, params.rounds, dtype=np.int64)]


def slots(numbers: np.ndarray, total: int, params: OrderParams) -> np.ndarray:
    """The slot of each sequence number below ``total``: a bijection."""
    half = max(1, -(-max(1, (total - 1).bit_length()) // 2))
    out = numbers.astype(np.uint64)
    keys = _round_keys(params)
    waiting = np.arange(len(out))
    while len(waiting):
        out[waiting] = _network(out[waiting], half, keys)
        waiting = waiting[out[waiting] >= total]
    return out.astype(np.int64)


def numbers_of(places: np.ndarray, total: int, params: OrderParams) -> np.ndarray:
    """The sequence number at each slot: ``slots`` backwards."""
    half = max(1, -(-max(1, (total - 1).bit_length()) // 2))
    out = places.astype(np.uint64)
    keys = _round_keys(params)[::-1]
    mask = np.uint64((1 << half) - 1)
    waiting = np.arange(len(out))
    while len(waiting):
        left, right = out[waiting] >> np.uint64(half), out[waiting] & mask
        for key in keys:
            left, right = right ^ (_round(left, key) & mask), left
        out[waiting] = (left << np.uint64(half)) | right
        waiting = waiting[out[waiting] >= total]
    return out.astype(np.int64)


def sequences(docs: DataFrame, path: str | None, params: OrderParams) -> DataFrame:
    """``doc_id, number, n_tokens, ids`` per sequence; ids without the filling.

    Ids have the narrowest type that holds the vocabulary's.
    """
    kind = _stored_type(path)
    width = kind.itemsize

    def cut(batch: pd.DataFrame) -> pd.DataFrame:
        encode = codec(path).encode if path else str.encode
        narrow = path and kind != ID
        rows = []
        size = params.length * width
        for doc_id, text in zip(batch["doc_id"], texts_of(batch["text"]), strict=True):
            ids = encode(text)
            if narrow:
                ids = np.frombuffer(ids, ID).astype(kind).tobytes()
            for number, at in enumerate(range(0, len(ids), size)):
                part = ids[at : at + size]
                rows.append((doc_id, number, len(part) // width, part))
        return pd.DataFrame(rows, columns=["doc_id", "number", "n_tokens", "ids"])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            # A few documents at a time: what waits for Spark stays small.
            for start in range(0, len(batch), BATCH_DOCS):
                yield cut(batch.iloc[start : start + BATCH_DOCS])

    ids = docs.select(id_or_none(), "text")
    return ids.mapInPandas(run, "doc_id long, number int, n_tokens int, ids binary")


def _id_type(path: str | None) -> np.dtype:
    return ID if path else np.dtype("<u1")


def _stored_type(path: str | None) -> np.dtype:
    """The type of ids until they are written."""
    if path and len(codec(path).tokens) <= 1 << 16:
        return np.dtype("<u2")
    return _id_type(path)


def _widened(column: pa.Array, kind: np.dtype) -> pa.Array:
    """A batch's narrow ids as ``kind``, all at once."""
    column = column.cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], np.int64)
    offsets = offsets[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    ids = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data else np.zeros(0, np.uint8)
    wide = ids.view("<u2").astype(kind)
    starts = (offsets - offsets[0]) * (kind.itemsize // 2)
    buffers = [None, pa.py_buffer(starts.tobytes()), pa.py_buffer(wide.tobytes())]
    return pa.Array.from_buffers(pa.large_binary(), len(column), buffers).cast(pa.binary())


def numbered(rows: DataFrame) -> tuple[DataFrame, int]:
    """Written rows with ``sequence``, gapless from 0: one count per part reaches the driver."""
    parts = rows.withColumns(
        {
            "part": F.spark_partition_id(),
            "inside": F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1),
        }
    )
    written = saved(parts, "order-sequences")
    counts = written.groupBy("part").agg(F.count(F.lit(1)).alias("rows")).collect()
    sizes = {row.part: row.rows for row in counts}
    offsets, total = [], 0
    for part in range(max(sizes, default=-1) + 1):
        offsets.append(total)
        total += sizes.get(part, 0)
    first: Column = F.get(F.lit(offsets), F.col("part")) if offsets else F.lit(0)
    return written.withColumn("sequence", (first + F.col("inside")).cast("long")), total


def materialise(
    docs: DataFrame,
    path: str | None = None,
    folder: str | None = None,
    params: OrderParams | None = None,
) -> DataFrame:
    """Writes the shards of all sequences and returns them as ``RECORD`` rows.

    Ids are those of the vocabulary file at ``path``, or bytes without one.

    Into an existing ``folder`` only missing or incomplete shards are written, each of them whole.
    """
    params = params or OrderParams()
    spark = docs.sparkSession
    target = folder or run_folder(spark, "order-shards")
    rows, total = numbered(sequences(docs, path, params))

    # Arrow batches: the ids pass through without becoming Python objects.
    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = slots(batch.column("sequence").to_numpy(), total, params)
            own = [batch.column(name) for name in _names()[2:]]
            yield pa.RecordBatch.from_arrays(
                [pa.array(at), pa.array(at // params.stride), *own], _names()
            )

    placed = rows.drop("part", "inside").mapInArrow(place, RECORD)
    missing = missing_shards(spark, target, total, params) if folder else None
    if missing is not None:
        placed = placed.join(F.broadcast(missing), "shard", "left_semi").select(*_names())
    shards = max(1, -(-total // params.stride))

    kind = _id_type(path)
    stop = F.lit(np.array([params.pad], dtype=kind).tobytes())
    # Filled up where the rows are written, one at a time: a batch of full sequences is large.
    filled = F.rpad("ids", F.lit(params.length * kind.itemsize), stop)
    # Equal strides, so dealing by shard is already even; one range of slots is one shard.
    dealt = placed.repartitionById(shards, F.col("shard").cast("int"))
    if _stored_type(path) != kind:
        # Narrow ids cross the shuffle, and get their width where they are written.
        def widen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                own = [*batch.columns[:-1], _widened(batch.columns[-1], kind)]
                yield pa.RecordBatch.from_arrays(own, _names())

        dealt = dealt.mapInArrow(widen, RECORD)
    # The shards that are written are written whole, over what an earlier run left of them.
    (
        dealt.sortWithinPartitions("shard", "slot")
        .withColumn("ids", filled)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("parquet.enable.dictionary", "false")
        .option("compression", "zstd")
        .partitionBy("shard")
        .parquet(target)
    )
    return read_slots(spark, target)


def _names() -> list[str]:
    return [part.split()[0] for part in RECORD.split(", ")]


def missing_shards(
    spark: SparkSession, folder: str, total: int, params: OrderParams
) -> DataFrame | None:
    """The shards that are not all there; None if nothing is. A row per shard."""
    try:
        have = read_slots(spark, folder).groupBy("shard").agg(F.count(F.lit(1)).alias("rows"))
    except Exception as error:
        if "PATH_NOT_FOUND" not in str(error):
            raise
        return None
    wanted = spark.range(max(1, -(-total // params.stride))).select(
        F.col("id").alias("shard"),
        F.least(F.lit(params.stride), F.lit(total) - F.col("id") * params.stride).alias("all"),
    )
    return wanted.join(have, "shard", "left").filter("rows is null or rows <> all").select("shard")


def read_slots(spark: SparkSession, folder: str, first: int = 0, params: OrderParams | None = None):
    """Records from slot ``first`` on; folders of earlier shards are not opened."""
    params = params or OrderParams()
    rows = with_null_ids(spark.read.schema(RECORD).parquet(folder)).select(*_names())
    if first:
        rows = rows.filter(F.col("shard") >= first // params.stride).filter(
            F.col("slot") >= first
        )
    return rows

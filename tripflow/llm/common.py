"""Helpers shared by the operators of this folder."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripflow.sources.folders import run_folder

ASCII_SPACE = " \t\n\v\f\r"
#: A-Z to a-z and nothing else, on text and on UTF-8 bytes.
LOWER_TEXT = {code: code + 32 for code in range(65, 91)}
LOWER_BYTES = bytes(code + 32 if 65 <= code <= 90 else code for code in range(256))


def words(text: str | None) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a text, as UTF-8; none for null.

    ``bytes.split`` separates at exactly these six characters, and none of them is part of a
    longer UTF-8 sequence.
    """
    return text.encode().split() if text else []


def texts_of(column: pd.Series) -> list[str]:
    """A batch's texts with null as the empty text."""
    return [text if isinstance(text, str) else "" for text in column]


def saved(rows: DataFrame, purpose: str, compression: str = "zstd") -> DataFrame:
    """Rows written to the session's shared folder and read back, which ends their lineage."""
    folder = run_folder(rows.sparkSession, purpose)
    rows.write.option("compression", compression).parquet(folder)
    return rows.sparkSession.read.schema(rows.schema).parquet(folder)


def map_batches(
    rows: DataFrame, work: Callable[[pd.DataFrame], pd.DataFrame], schema: T.StructType | str
) -> DataFrame:
    """``work`` on one Arrow batch after another."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield work(batch)

    return rows.mapInPandas(run, schema)


def keep_rows(
    rows: DataFrame,
    work: Callable[[list[str]], tuple[list[bool], list[str] | None]],
    lengths: str | None = None,
) -> DataFrame:
    """The rows whose text ``work`` keeps, in all their columns, with the texts it gives back.

    Rows stay Arrow batches, in which every column keeps its type: numbers beside nulls do not
    turn into floats. ``lengths`` names a column that follows the text, if it is there.
    """
    names = rows.columns
    at = names.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            given = [text or "" for text in batch.column(at).to_pylist()]
            kept, texts = work(given)
            columns = [column.filter(pa.array(kept, pa.bool_())) for column in batch.columns]
            if texts is not None:
                own = [text for text, keep in zip(texts, kept, strict=True) if keep]
                columns[at] = pa.array(own, columns[at].type)
                if lengths in names:
                    place = names.index(lengths)
                    sizes = [len(text) for text in own]
                    columns[place] = pa.array(sizes, pa.int64()).cast(columns[place].type)
            yield pa.RecordBatch.from_arrays(columns, schema=batch.schema)

    return rows.mapInArrow(run, rows.schema)


def with_field(schema: T.StructType, *fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType(
        [*schema.fields, *(T.StructField(name, kind) for name, kind in fields)]
    )


#: Stands for a null id inside Python, where a column of numbers with nulls turns into floats.
NO_ID = -(1 << 63)


def id_or_none(name: str = "doc_id") -> Column:
    return F.coalesce(F.col(name).cast("long"), F.lit(NO_ID)).alias(name)


def with_null_ids(rows: DataFrame, name: str = "doc_id") -> DataFrame:
    """Turns ``NO_ID`` back into null."""
    return rows.withColumn(name, F.nullif(F.col(name), F.lit(NO_ID)))


def row_identity(rows: DataFrame, names: list[str]) -> Column:
    """A hash of some columns of a row; nulls count, in the column where they are.

    Maps cannot be hashed and go by their JSON text, entries in the order they are stored in.
    """
    kinds = {field.name: field.dataType for field in rows.schema.fields}
    columns = []
    for name in names:
        column = F.col(f"`{name}`")
        own = F.to_json(F.struct(column)) if "map<" in kinds[name].simpleString() else column
        columns += [own, column.isNull()]
    return F.xxhash64(*columns)


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def bucket_of(key: Column, bounds: Column, count: int) -> Column:
    """How many of the ``count`` ascending ``bounds`` are at or below ``key``: a binary search.

    The steps are the powers of two below the count, so an expression has logarithmic length
    whatever the number of bounds.
    """
    if count == 0:
        return F.lit(0)
    steps = [1 << bit for bit in reversed(range(count.bit_length()))]

    def step(at: Column, width: Column) -> Column:
        # get() gives null past the end, and null counts as "above".
        below = F.coalesce(F.get(bounds, at + width - 1) <= key, F.lit(False))
        return F.when(below, at + width).otherwise(at)

    return F.aggregate(F.array(*map(F.lit, steps)), F.lit(0), step)

"""Files of differing types: footers, groups of files that agree, and files that do not fit.

A folder of many months holds files whose columns changed type. A scan has one type per column
and stops at the first file that differs, so files are grouped by what their footers say; each
group is read with its own types, and its values are cast to the declared ones.

Footers are read in a distributed job: tasks read the end of each file where Arrow knows the
file system, and of the rest Spark hands them whole files. What reaches the driver is a name per
file, as in any scan of a folder.
"""

from __future__ import annotations

import io
import json
from collections.abc import Iterator
from functools import reduce

import pandas as pd
import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripflow.sources.folders import run_folder

FOOTER = "path string, types string, error string"
#: Files whose footers one task reads.
FILES_PER_TASK = 200


def _types(source) -> str:
    schema = pq.read_schema(source)
    return json.dumps({field.name: str(field.type) for field in schema}, sort_keys=True)


def _near(path: str) -> tuple[str | None, str | None, bool]:
    """(types, error, whether the file could be reached)."""
    local = path.removeprefix("file:") if path.startswith("file:/") else None
    try:
        if local is not None:
            system, place = fs.LocalFileSystem(), "/" + local.lstrip("/")
        else:
            system, place = fs.FileSystem.from_uri(path)
        with system.open_input_file(place) as file:
            return _types(file), None, True
    except pa.ArrowInvalid as error:
        # Either a scheme that Arrow does not know, or a file that is no Parquet file.
        return None, _short(error), local is not None
    except (OSError, NotImplementedError) as error:
        return None, _short(error), False


def _short(error: Exception) -> str:
    return " ".join(str(error).split())[:200]


def file_names(spark: SparkSession, path: str, glob: str = "*.parquet") -> DataFrame:
    """``path`` of a folder's files. Their contents are not read."""
    found = spark.read.format("binaryFile").option("pathGlobFilter", glob).load(path)
    return found.select("path")


def footers(names: DataFrame) -> DataFrame:
    """``path, types, error`` per Parquet file: its column types as JSON, or why there are none.

    ``names`` has a ``path`` per file.
    """

    def near(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [_near(path) for path in batch["path"]]
            types, errors, reached = zip(*found, strict=True)
            yield pd.DataFrame(
                {"path": batch["path"], "types": types, "error": errors, "reached": reached}
            )

    def whole(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for path, content in batch.itertuples(index=False):
                try:
                    rows.append((path, _types(io.BytesIO(content)), None))
                except (pa.ArrowInvalid, OSError) as error:
                    rows.append((path, None, _short(error)))
            yield pd.DataFrame(rows, columns=["path", "types", "error"])

    spark = names.sparkSession
    tasks = max(1, -(-names.count() // FILES_PER_TASK))
    folder = run_folder(spark, "footers")
    shape = f"{FOOTER}, reached boolean"
    names.repartition(tasks).mapInPandas(near, shape).write.parquet(folder)
    found = spark.read.schema(shape).parquet(folder)
    far = [row.path for row in found.filter("not reached").select("path").collect()]
    known = found.filter("reached").drop("reached")
    if not far:
        return known
    contents = spark.read.format("binaryFile").load(far).select("path", "content")
    return known.unionByName(contents.mapInPandas(whole, FOOTER))


def type_groups(found: DataFrame, declared: dict[str, str]) -> list[tuple[str, list[str]]]:
    """(types of the declared columns as JSON, files) of the files that agree."""
    own = F.from_json("types", "map<string, string>")
    named = F.map_filter(own, lambda name, kind: name.isin(list(declared)))
    entries = F.array_sort(F.map_entries(named))
    groups = (
        found.filter("types is not null")
        .groupBy(F.to_json(F.map_from_entries(entries)).alias("types"))
        .agg(F.array_sort(F.collect_list("path")).alias("paths"))
        .orderBy("types")
    )
    return [(row.types, row.paths) for row in groups.collect()]


def read_group(spark: SparkSession, paths: list[str], declared: dict[str, str]) -> DataFrame:
    """Files that agree, in the declared columns and types; null for absent or unreadable ones."""
    rows = spark.read.parquet(*paths)
    return rows.select(
        *[
            F.expr(f"try_cast(`{name}` as {kind})" if name in rows.columns else "null")
            .cast(kind)
            .alias(name)
            for name, kind in declared.items()
        ]
    )


def read_history(
    spark: SparkSession, path: str, declared: dict[str, str], glob: str = "*.parquet"
) -> DataFrame:
    """All rows of a folder's Parquet files, whatever types each file has for the columns.

    Values that do not fit the declared type are null, and so is a column in files without it;
    one that no file has is left out. A file that cannot be read is an error, and an empty folder.
    """
    found = footers(file_names(spark, path, glob))
    bad = found.filter("types is null").limit(1).collect()
    if bad:
        raise ValueError(f"{bad[0].path} cannot be read: {bad[0].error}")
    groups = type_groups(found, declared)
    if not groups:
        raise FileNotFoundError(f"no {glob} files in {path}")
    there = {name for types, _ in groups for name in json.loads(types)}
    shape = {name: kind for name, kind in declared.items() if name in there}
    return reduce(DataFrame.unionByName, [read_group(spark, p, shape) for _, p in groups])


def misfits(found: DataFrame, declared: dict[str, str], fits: dict[str, set[str]]) -> DataFrame:
    """``path, reason`` of the files that must not be read.

    ``fits`` gives, per declared column, the file types that may stand for it; an absent column
    is a misfit too.
    """
    own = F.from_json("types", "map<string, string>")
    reason = F.when(F.col("types").isNull(), F.concat(F.lit("not readable: "), F.col("error")))
    for name in declared:
        kind = F.try_element_at(own, F.lit(name))
        reason = reason.when(kind.isNull(), F.lit(f"{name} is not there"))
        reason = reason.when(~kind.isin(sorted(fits[name])), F.concat(F.lit(f"{name} is "), kind))
    return found.select("path", reason.alias("reason")).filter("reason is not null")

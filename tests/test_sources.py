from collections import Counter
from types import SimpleNamespace

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from tests.builders import ZONE_ROWS, feed, rides
from tripflow.schemas import FEED, RIDES, ddl
from tripflow.sources import files, footers
from tripflow.sources.folders import run_folder


def test_trips_ignore_other_files(spark, tmp_path):
    folder = str(tmp_path / "trips")
    spark.range(5).write.parquet(folder)
    (tmp_path / "trips" / "README.md").write_text("not data")
    (tmp_path / "trips" / "late.parquet.tmp").write_text("half written")
    assert files.read_trips(spark, folder).count() == 5


def test_trips_folder_without_parquet_is_an_error(spark, tmp_path):
    (tmp_path / "README.md").write_text("not data")
    with pytest.raises(FileNotFoundError):
        files.read_trips(spark, str(tmp_path))


def test_a_single_trip_file_can_be_read(spark, tmp_path):
    folder = tmp_path / "trips"
    spark.range(5).coalesce(1).write.parquet(str(folder))
    (part,) = folder.glob("*.parquet")
    assert files.read_trips(spark, str(part)).count() == 5


def test_zones(spark, tmp_path):
    path = tmp_path / "zones.csv"
    lines = [",".join("" if v is None else f'"{v}"' for v in row) for row in ZONE_ROWS]
    path.write_text('"LocationID","Borough","Zone","service_zone"\n' + "\n".join(lines))
    read = files.read_zones(spark, str(path))
    assert [tuple(row) for row in read.collect()] == ZONE_ROWS
    assert read.filter("Zone = 'NA'").count() == 1


def test_zones_with_other_columns_fail_rather_than_shift(spark, tmp_path):
    path = tmp_path / "zones.csv"
    path.write_text("Zone,Borough,LocationID,service_zone\nAlpha,North,1,Yellow\n")
    with pytest.raises(Exception, match="header"):
        files.read_zones(spark, str(path)).collect()


@pytest.mark.parametrize("fmt", ["parquet", "csv"])
def test_feed_files_hold_at_most_n_rows_and_all_of_them(spark, tmp_path, fmt):
    path = tmp_path / "feed"
    rows = feed(spark, *[{"fare_amount": float(n)} for n in range(25)]).coalesce(1)
    files.write_feed(rows, str(path), rows_per_file=10, fmt=fmt)
    read = spark.read.schema(ddl(FEED)).option("header", True).format(fmt).load(str(path))
    assert Counter(map(tuple, read.collect())) == Counter(map(tuple, rows.collect()))
    sizes = [
        spark.read.schema(ddl(FEED)).option("header", True).format(fmt).load(str(part)).count()
        for part in path.glob(f"*.{fmt}")
    ]
    assert sorted(sizes) == [5, 10, 10]


def test_missing_ride_table_is_empty(spark, tmp_path):
    empty = files.read_rides(spark, str(tmp_path / "none"))
    assert empty.count() == 0
    assert dict(empty.dtypes) == RIDES


def test_unreadable_ride_table_is_an_error(spark, tmp_path):
    (tmp_path / "part.parquet").write_text("not parquet")
    with pytest.raises(Exception, match="(?i)parquet"):
        files.read_rides(spark, str(tmp_path)).collect()


def test_compaction_keeps_the_rows(spark, tmp_path):
    many = rides(spark, *[{"fare_amount": float(n + 1)} for n in range(40)])
    many.repartition(20).write.parquet(str(tmp_path / "many"))
    files.compact_rides(spark, str(tmp_path / "many"), str(tmp_path / "few"))
    few = files.read_rides(spark, str(tmp_path / "few"))
    assert Counter(map(tuple, few.collect())) == Counter(map(tuple, many.collect()))
    assert len(list((tmp_path / "few").glob("*.parquet"))) < 20
    with pytest.raises(AnalysisException):
        files.compact_rides(spark, str(tmp_path / "many"), str(tmp_path / "few"))


def test_run_folders_are_new_and_below_the_shared_folder(spark):
    first, second = (run_folder(spark, "x") for _ in range(2))
    assert first != second
    assert first.startswith(spark.conf.get("spark.checkpoint.dir"))


class Unset:
    """A session on some master, without the shared folder's setting."""

    def __init__(self, master):
        self.conf = {}
        self.sparkContext = SimpleNamespace(master=master)


def test_only_a_local_session_may_lack_the_shared_folder():
    first, second = (run_folder(Unset("local[2]"), "x") for _ in range(2))
    assert first.rsplit("/", 1)[0] == second.rsplit("/", 1)[0]
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        run_folder(Unset("yarn"), "x")


DECLARED = {"id": "bigint", "size": "double", "name": "string"}
SHAPES = [
    "id bigint, size double, name string",
    "id int, size double, name string, more array<int>",
    "id double, size decimal(6, 2), name string, more string",
    "id string, size int, name int",
    "id bigint, name string",
]


def test_history_of_differing_types(spark, tmp_path):
    folder = str(tmp_path / "history")
    for number, shape in enumerate(SHAPES):
        row = spark.range(number * 10, number * 10 + 3).selectExpr(
            "id", "id / 2 as size", "cast(id as string) as name", "null as more"
        )
        kinds = [part.split(" ", 1) for part in shape.replace("(6, 2)", "(6;2)").split(", ")]
        row.select(
            *[F.col(name).cast(kind.replace(";", ", ")).alias(name) for name, kind in kinds]
        ).write.mode("append").parquet(folder)
    odd = spark.createDataFrame([("x", 1.5, "odd"), (None, None, None)], "id string, size double, name string")
    odd.write.mode("append").parquet(folder)
    (tmp_path / "history" / "README.md").write_text("not data")
    found = footers.read_history(spark, folder, DECLARED)
    assert dict(found.dtypes) == DECLARED
    want = Counter({(None, 1.5, "odd"): 1, (None, None, None): 1})
    for number in range(len(SHAPES)):
        for i in range(number * 10, number * 10 + 3):
            size = None if number == 4 else float(i // 2) if number == 3 else i / 2
            want[(i, size, str(i))] += 1
    assert Counter(map(tuple, found.collect())) == want
    # Files with equal types for the declared columns are one scan.
    groups = footers.type_groups(footers.footers(footers.file_names(spark, folder)), DECLARED)
    assert len(groups) == len(SHAPES) + 1


def test_history_stops_at_a_file_it_cannot_read(spark, tmp_path):
    spark.range(3).write.parquet(str(tmp_path / "history"))
    (tmp_path / "history" / "torn.parquet").write_bytes(b"PAR1")
    with pytest.raises(ValueError, match="torn.parquet"):
        footers.read_history(spark, str(tmp_path / "history"), {"id": "bigint"})
    (tmp_path / "empty").mkdir()
    with pytest.raises(FileNotFoundError):
        footers.read_history(spark, str(tmp_path / "empty"), {"id": "bigint"})


def test_footers_of_a_store_that_arrow_does_not_know(spark, tmp_path, monkeypatch):
    """Whole files go to the tasks then; only the result is the same."""
    folder = str(tmp_path / "history")
    spark.range(3).write.parquet(folder)
    names = footers.file_names(spark, folder)
    want = {tuple(row) for row in footers.footers(names).collect()}
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    conf.set("fs.viewfs.mounttable.shop.link./in", f"file://{tmp_path}")
    far = footers.file_names(spark, "viewfs://shop/in/history")
    found = footers.footers(far).collect()
    assert {row.types for row in found} == {types for _, types, _ in want}
    assert all(row.path.startswith("viewfs:") and row.error is None for row in found)
    read = footers.read_history(spark, "viewfs://shop/in/history", {"id": "bigint"})
    assert sorted(row.id for row in read.collect()) == [0, 1, 2]

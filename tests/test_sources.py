import gzip
import zipfile

import pytest
from pyspark.sql import functions as F

from tilecast.sources import demand as src
from tilecast.sources.events import demand_from_events

CSV = "geohash6,day,timestamp,demand\nqp02yc,1,9:0,0.5\nqp02yf,2,10:15,1.25\n"
ROWS = [("qp02yc", 1, "9:0", 0.5), ("qp02yf", 2, "10:15", 1.25)]


def rows(df):
    return sorted(tuple(r) for r in df.select("geohash6", "day", "timestamp", "demand").collect())


@pytest.mark.parametrize("kind", ["csv", "csv.gz", "zip"])
def test_same_rows_from_every_format(spark, tmp_path, kind):
    path = tmp_path / f"demand.{kind}"
    if kind == "zip":
        with zipfile.ZipFile(path, "w") as archive:
            archive.writestr("demand.csv", CSV)
    elif kind == "csv.gz":
        path.write_bytes(gzip.compress(CSV.encode()))
    else:
        path.write_text(CSV)
    df = src.read_demand(spark, str(path))
    assert rows(df) == ROWS
    assert df.schema.simpleString() == (
        "struct<geohash6:string,day:int,timestamp:string,demand:double>"
    )


def test_columns_are_taken_by_name(spark, tmp_path):
    path = tmp_path / "saved.csv"
    path.write_text(",demand,day,geohash6,day_timestamp,timestamp\n0,0.5,1,qp02yc,1:9:0,9:0\n")
    assert rows(src.read_demand(spark, str(path))) == ROWS[:1]


def test_zip_reads_every_member_and_missing_values(spark, tmp_path, monkeypatch):
    path = tmp_path / "two.zip"
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as archive:
        archive.writestr("part/a.csv", CSV)
        archive.writestr("part/b.csv", "day,geohash6,demand,timestamp\n3,qp02yv,,1:45\n")
    got = src.read_demand(spark, str(path)).collect()
    assert len(got) == 3
    assert [r.demand for r in got if r.geohash6 == "qp02yv"] == [None]


def test_saved_table_is_pruned_by_day(spark, tmp_path, demand):
    path = str(tmp_path / "table.parquet")
    src.write_table(demand, path)
    back = src.read_demand(spark, path)
    assert rows(back) == rows(demand)
    plan = back.filter("day between 2 and 3")._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(day" in plan


def test_predictions_are_written_with_a_header(spark, tmp_path, demand):
    for kind in ("csv", "parquet"):
        path = str(tmp_path / kind)
        src.write_predictions(demand, path, kind)
        reader = spark.read.option("header", True) if kind == "csv" else spark.read
        back = reader.format(kind).load(path)
        assert back.columns == demand.columns
        assert back.count() == demand.count()


def test_every_format_reads_odd_numbers_alike(spark, tmp_path):
    """NaN and empty are missing, and a whole number may be written with a point."""
    text = "geohash6,day,timestamp,demand\na,1.0,9:0,NaN\nb,2,9:15,\nc,3,9:30,2.5\n"
    (tmp_path / "d.csv").write_text(text)
    (tmp_path / "d.csv.gz").write_bytes(gzip.compress(text.encode()))
    with zipfile.ZipFile(tmp_path / "d.zip", "w") as archive:
        archive.writestr("d.csv", text)
    want = [("a", 1, "9:0", None), ("b", 2, "9:15", None), ("c", 3, "9:30", 2.5)]
    for name in ("d.csv", "d.csv.gz", "d.zip"):
        assert rows(src.read_demand(spark, str(tmp_path / name))) == want


def test_a_folder_without_extension_needs_its_format(spark, tmp_path):
    path = str(tmp_path / "saved")
    src.write_table(spark.createDataFrame(ROWS, "geohash6 string, day int, timestamp string, demand double"), path)
    assert rows(src.read_demand(spark, path, format="parquet")) == ROWS


def test_no_two_places_share_a_geohash(spark, tmp_path):
    places = spark.range(400_000).union(spark.range(1_048_000, 1_049_000)).union(spark.range(857_734_000, 857_735_168))
    events = places.select(F.lit("2024-01-01 00:00:00").cast("timestamp_ntz").alias("ts"), (F.col("id") * 10).alias("user_id"), F.lit(1.0).alias("value"))
    events.write.parquet(f"{tmp_path}/events.parquet")
    found = demand_from_events(spark, str(tmp_path)).agg(F.count("geohash6"), F.countDistinct("geohash6"), F.max(F.length("geohash6"))).first()
    assert tuple(found) == (402_168, 402_168, 6)


def test_every_member_of_an_archive_is_a_task(spark, tmp_path):
    path = tmp_path / "two.zip"
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as archive:
        archive.writestr("a/", "")
        archive.writestr("a/one.csv", CSV)
        archive.writestr("a/none.csv", "")
        archive.writestr("two.csv", 'demand,timestamp,geohash6,day\n7,"0:0","a\nb",4\n')
    spark.dataSource.register(src.zip_csv_source())
    raw = spark.read.format("zip_csv").schema("geohash6 string, day string, timestamp string, demand string").load(str(path))
    assert raw.rdd.getNumPartitions() == 2
    df = src.read_zip_csv(spark, str(path))
    assert rows(df) == sorted([*ROWS, ("a\nb", 4, "0:0", 7.0)])
    plan = df._jdf.queryExecution().toString()
    assert "binary" not in plan.lower()
    with pytest.raises(Exception, match="FileNotFound|not found"):
        src.read_zip_csv(spark, str(tmp_path / "none.zip")).count()


def test_a_folder_of_archives_comes_back(spark, tmp_path, demand):
    path = str(tmp_path / "zips")
    src.write_zip_csv(demand.repartition(3), path)
    assert sorted(p.name for p in (tmp_path / "zips").iterdir()) == [f"part-0000{k}.zip" for k in range(3)]
    assert rows(src.read_demand(spark, path, format="zip")) == rows(demand)
    assert rows(src.read_demand(spark, f"file://{path}", format="zip")) == rows(demand)

"""Loads into partitioned catalog tables: what changes, what stays, and what a lost job leaves."""

import uuid

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import Observation
from pyspark.sql import functions as F

from marginbook.sources import partitions, schemas, sink

from conftest import rows

TARGET = schemas.text_and_double("name v note busi_month part", doubles="v")


@pytest.fixture
def table(spark, tmp_path):
    name = f"t_{uuid.uuid4().hex}"
    partitions.create_table(spark, name, TARGET, ["busi_month", "part"], f"{tmp_path}/{name}")
    yield name
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def frame(spark, *data):
    return spark.createDataFrame(list(data), "NAME string, V double, BUSI_MONTH string, PART string, SURPLUS int")


def content(spark, table):
    return rows(spark.table(table).select("busi_month", "part", "name", "v"), "busi_month", "part", "name")


FIRST = (("a", 1.0, "202401", "x", 1), ("b", 2.0, "202401", "y", 1), ("c", 3.0, "202402", "x", 1))


def test_append_adds_and_counts(spark, table):
    assert partitions.append_rows(frame(spark, *FIRST), table).first().asDict() == {"target": table, "mode": "append", "partition": None, "rows": 3}
    partitions.append_rows(frame(spark, ("d", 4.0, "202401", "x", 1)), table)
    assert [r[2] for r in content(spark, table)] == ["a", "d", "b", "c"]
    assert partitions.append_rows(frame(spark, ("e", 5.0, None, None, 1)), table, {"busi_month": "202403", "part": "z"}).first()["rows"] == 1
    assert content(spark, table)[-1] == ("202403", "z", "e", 5.0)


def test_replace_leaves_other_partitions(spark, table):
    partitions.append_rows(frame(spark, *FIRST), table)
    loaded = partitions.replace_partitions(frame(spark, ("n", 9.0, "202401", "x", 1), ("o", 8.0, "202405", "it's a/b %c=1", 1)), table)
    assert [(r["partition"], r["rows"]) for r in loaded.collect()] == [("busi_month=202401/part=x", 1), ("busi_month=202405/part=it's a/b %c=1", 1)]
    want = [("202401", "x", "n", 9.0), ("202401", "y", "b", 2.0), ("202402", "x", "c", 3.0), ("202405", "it's a/b %c=1", "o", 8.0)]
    assert content(spark, table) == want
    partitions.append_rows(frame(spark, ("p", 7.0, "202401", "x", 1)), table)  # into the folder pointed at
    assert content(spark, table)[:2] == [("202401", "x", "n", 9.0), ("202401", "x", "p", 7.0)]
    assert partitions.replace_partitions(frame(spark), table).count() == 0 and len(content(spark, table)) == 5


def test_a_lost_job_leaves_the_old_rows(spark, table, monkeypatch):
    partitions.append_rows(frame(spark, *FIRST), table)
    before = content(spark, table)
    lost = frame(spark, *[(str(i), float(i), "202401", "x", i) for i in range(40)]).repartition(4).withColumn(
        "V", F.when(F.col("SURPLUS") == 39, F.raise_error(F.lit("lost")).cast("double")).otherwise(F.col("V")))
    with pytest.raises(PySparkException, match="lost"):
        partitions.replace_partitions(lost, table)
    assert content(spark, table) == before
    with pytest.raises(ValueError, match="rows without"):
        partitions.replace_partitions(frame(spark, ("n", 9.0, "202401", "x", 1), ("m", 1.0, None, "x", 1)), table)
    assert content(spark, table) == before


def test_purge_by_part_of_the_key(spark, table):
    partitions.append_rows(frame(spark, *FIRST), table)
    assert partitions.purge(spark, table, {"busi_month": "202401"}) == 2
    assert [r[2] for r in content(spark, table)] == ["c"]
    assert partitions.purge(spark, table, {"busi_month": "203001"}) == 0
    partitions.append_rows(frame(spark, ("d", 4.0, "202403", "it's a/b %c=1", 1)), table)
    assert partitions.purge(spark, table, {"busi_month": "202403"}) == 1 and len(content(spark, table)) == 1
    partitions.append_rows(frame(spark, ("z", 5.0, "202401", "x", 1)), table)  # nothing purged comes back
    assert [r[2] for r in content(spark, table)] == ["z", "c"]
    partitions.replace_partitions(frame(spark, ("y", 6.0, "202401", "x", 1)), table, keep_old=True)
    assert partitions.purge(spark, table, {"part": "x"}) == 2 and content(spark, table) == []
    partitions.append_rows(frame(spark, ("z", 5.0, "202401", "x", 1)), table)
    assert [r[2] for r in content(spark, table)] == ["z"]
    for bad in ({}, {"name": "c"}):
        with pytest.raises(ValueError):
            partitions.purge(spark, table, bad)


def test_rebuild_touches_the_window_only(spark, tmp_path):
    name, schema = f"t_{uuid.uuid4().hex}", schemas.text_and_double("name v busi_month", doubles="v")
    partitions.create_table(spark, name, schema, ["busi_month"], f"{tmp_path}/{name}")
    months = ["202310", "202311", "202312", "202401", "202402"]
    partitions.append_rows(spark.createDataFrame([(m, 1.0, m) for m in months], "name string, v double, busi_month string"), name)
    asked = []

    def build(window):
        asked.append(window)
        return spark.createDataFrame([("new", 2.0, "202401"), ("new", 2.0, "202402"), ("out", 2.0, "202310")], "name string, v double, busi_month string")

    loaded = partitions.rebuild_months(spark, build, name, "202402", 2)
    assert asked == [["202312", "202401", "202402"]]
    assert sorted((r["mode"], r["partition"], r["rows"]) for r in loaded.collect()) == [
        ("overwrite", "busi_month=202401", 1), ("overwrite", "busi_month=202402", 1), ("purge", "busi_month=202312", 0)]
    assert rows(spark.table(name).select("busi_month", "name"), "busi_month") == [
        ("202310", "202310"), ("202311", "202311"), ("202401", "new"), ("202402", "new")]
    assert partitions.months_back("202401") == ["202310", "202311", "202312", "202401"]


def test_loads_of_nothing_count_nothing(spark, table, tmp_path):
    """Rows that are all filtered out after a shuffle: the plan shrinks while it runs, and the count must outlast that."""
    nothing = frame(spark, *FIRST).groupBy("NAME", "BUSI_MONTH", "PART").agg(F.sum("V").alias("V")).filter("V > 100")
    assert partitions.append_rows(nothing, table).first()["rows"] == 0 and content(spark, table) == []
    seen = Observation()
    sink.load_aligned(nothing, TARGET, f"{tmp_path}/nothing", partition_by=["busi_month"], observe=seen)
    assert seen.get["rows"] == 0


def test_rebuild_of_nothing_empties_the_window(spark):
    """A ledger whose books are all excluded has no results, before the rebuild and after."""
    name = f"t_{uuid.uuid4().hex}"
    schema = schemas.text_and_double("name v busi_month", doubles="v")
    partitions.create_table(spark, name, schema, ["busi_month"], f"{spark.sparkContext.getCheckpointDir().removeprefix('file:')}/{name}")
    none = spark.createDataFrame([("a", 1.0, "202404")], schema).join(spark.createDataFrame([("a",)], "name string"), "name", "left_anti")
    partitions.append_rows(none, name)
    got = partitions.rebuild_months(spark, lambda months: none.filter(F.col("busi_month").isin(months)), name, "202404")
    assert rows(got.select("mode", "partition", "rows"), "partition") == [("purge", f"busi_month=2024{m:02d}", 0) for m in range(1, 5)]
    assert spark.table(name).count() == 0

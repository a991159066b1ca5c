"""Operators for groups and targets of any size: ranks, concatenation, distinct counts, bucketed merges."""

import re
import uuid
from datetime import date

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from marginbook.operators import distinct, ranking as R, strings
from marginbook.sources import buckets

from conftest import rows


@pytest.fixture(autouse=True)
def shared(spark, tmp_path_factory):
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("shared")))


def skewed(spark, n):
    return spark.range(n).selectExpr("CASE WHEN id % 10 < 7 THEN 'hot' WHEN id % 10 = 7 THEN NULL ELSE concat('g', id % 4) END AS g", "id AS k",
                                     "CAST(CASE WHEN id % 31 = 0 THEN NULL WHEN id % 3 = 0 THEN 1 ELSE exp((id * 7919 % 2111) / 100) END AS DOUBLE) AS v")


@pytest.mark.parametrize(("per_range", "most"), [(250_000, 1024), (50, 64), (7, 16), (1, 5)])
def test_rank_within_equals_rank(spark, per_range, most):
    df = skewed(spark, 4000)
    got = R.rank_within(df, ["g"], "v", values_per_range=per_range, ranges_most=most)
    want = df.selectExpr("*", "CASE WHEN v IS NOT NULL THEN rank() OVER (PARTITION BY g ORDER BY v DESC) END AS r")
    both = got.join(want.select("k", "r"), "k")
    assert got.columns == ["g", "k", "v", "rank_no"] and both.count() == 4000 and both.filter("NOT rank_no <=> r").count() == 0


def test_ranges_stay_even_when_a_group_grows(spark):
    def largest(n):
        df = spark.range(n).selectExpr("'hot' AS g", "id AS k", "CAST(id * 7919 % 1000003 AS DOUBLE) AS v")
        plan = R.rank_within(df, ["g"], "v", values_per_range=500, ranges_most=256)
        ranked = plan.select("rank_no").distinct().count()
        assert ranked == n
        values = df.groupBy("g").agg(F.percentile_approx("v", F.array(*[F.lit(i / 256) for i in range(1, 256)]), 2560).alias("c"))
        k = -(-n // 500)
        cuts = sorted({values.first().c[i * 256 // k - 1] for i in range(1, k)})
        placed = df.select(F.size(F.filter(F.array(*[F.lit(c) for c in cuts]), lambda c: c < F.col("v"))).alias("b")).groupBy("b").count()
        return placed.agg(F.max("count")).first()[0]
    small, big = largest(4_000), largest(40_000)
    assert big < 2 * small


def test_concat_of_a_million_values(spark):
    df = spark.range(1_000_000).selectExpr("'one' AS g", "id AS v").unionAll(spark.range(5).selectExpr("'few'", "id"))
    pieces = strings._pieces(df, ["g"], F.col("v"), "/", 50_000).agg(F.max("__values"), F.count("*"), F.sum("__values")).first()
    assert pieces[0] < 150_000 and pieces[1] >= 20 and pieces[2] == 1_000_005
    got = {r.g: r.t for r in strings.ordered_concat(df, ["g"], "v", "t", values_per_range=50_000).collect()}
    assert got["few"] == "0/1/2/3/4" and got["one"] == "/".join(sorted(map(str, range(1_000_000))))


def test_concat_of_odd_rows(spark):
    df = spark.createDataFrame([("a", "y"), ("a", "x"), ("a", "y"), ("a", None), ("a", ""), ("b", None), (None, "é"), (None, "z")], "g string, v string")
    for per_range in (1, 100):
        got = rows(strings.ordered_concat(df, ["g"], "v", "t", "|", per_range), F.col("g").asc_nulls_first())
        assert got == [(None, "z|é"), ("a", "|x|y")]
    assert strings.ordered_concat(df.limit(0), ["g"], "v", "t").count() == 0


def test_nested_distinct_counts(spark):
    df = spark.range(6000).selectExpr("id % 3 AS g", "CASE WHEN id % 17 = 0 THEN NULL ELSE id * 7919 % 70001 - 100 END AS i",
                                      "CASE WHEN id % 13 = 0 THEN NULL ELSE date_add(DATE '2023-11-01', CAST(id % 200 AS INT)) END AS d")
    got = {(r.g, r.grain, r.period): r.n for r in distinct.nested_distinct(df, ["g"], "i", "d", "n").collect()}
    want = {}
    for grain, key in (("month", F.date_format("d", "yyyyMM")), ("quarter", F.concat(F.date_format("d", "yyyy"), F.quarter("d").cast("string"))), ("year", F.date_format("d", "yyyy"))):
        for r in df.filter("i IS NOT NULL AND d IS NOT NULL").groupBy("g", key.alias("p")).agg(F.countDistinct("i").alias("n")).collect():
            want[r.g, grain, r.p] = r.n
    assert got == want
    # Bitmaps kept from earlier months merge with new ones.
    old, new = (distinct.item_bitmaps(df.filter(c), ["g"], "i", "d") for c in ("d < DATE '2024-02-01'", "d >= DATE '2024-02-01'"))
    assert {(r.g, r.grain, r.period): r.n for r in distinct.count_bitmaps(old.unionByName(new), ["g"], "n").collect()} == want
    assert distinct.nested_distinct(df.limit(0), ["g"], "i", "d", "n").count() == 0
    with pytest.raises(ValueError):
        distinct.count_bitmaps(old, ["g"], "n", ["week"])


@pytest.fixture
def target(spark, tmp_path):
    name = f"target_{uuid.uuid4().hex}"
    buckets.create_target(spark.range(1000).selectExpr("id AS k", "id * 1.5D AS v", "CAST(NULL AS STRING) AS s"), name, ["k"], 16, str(tmp_path))
    yield name
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_a_bucketed_target_is_not_shuffled(spark, target, tmp_path):
    source = spark.range(0, 900, 3).selectExpr("id AS k", "-1D AS v", "'hit' AS s")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for _ in range(2):  # the table as created, and as written by a merge
            plan = plan_of(buckets.merged(spark, target, source, ["v", "s"]))
            side = plan[:plan.index("Scan parquet")].rsplit("Join", 1)[1]
            assert "Exchange" not in side and "Bucketed: true" in plan.replace("Batched", "") or "Bucketed" in plan
            assert len(re.findall(r"Exchange hashpartitioning", plan)) <= 1
            buckets.merge_into(spark, target, source, ["v", "s"], str(tmp_path))
            source = spark.createDataFrame([(1, 5.0, None), (3, None, "again"), (5000, 1.0, "x")], "k long, v double, s string")
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    got = {r.k: (r.v, r.s) for r in spark.table(target).collect()}
    assert len(got) == 1000 and got[1] == (5.0, None) and got[3] == (-1.0, "again") and got[6] == (-1.0, "hit") and got[2] == (3.0, None) and got[999] == (1498.5, None)
    assert buckets.buckets_of(spark, target) == (["k"], 16)


def test_a_failed_merge_leaves_the_target(spark, target, tmp_path):
    twice = spark.createDataFrame([(1, 1.0), (1, 2.0)], "k long, v double")
    with pytest.raises(PySparkException, match="duplicate merge key"):
        buckets.merge_into(spark, target, twice, ["v"], str(tmp_path))
    with pytest.raises(ValueError, match="no column"):
        buckets.merge_into(spark, target, twice.withColumnRenamed("v", "w"), ["w"], str(tmp_path))
    assert rows(spark.table(target).filter("k = 1"))[0][1] == 1.5
    spark.sql("CREATE OR REPLACE TEMP VIEW plain AS SELECT 1 AS k")
    with pytest.raises((ValueError, PySparkException)):
        buckets.buckets_of(spark, "plain")

from datetime import date

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from marginbook.operators import balances, joins as J, merge, orgs, ranking as R, scoring, spine
from marginbook.sources import schemas, sink, tables

from conftest import rows


def test_merge_keeps_old_values_for_null_and_unmatched(spark):
    t = spark.createDataFrame([(1, 10.0, "a"), (2, 20.0, "b"), (None, 30.0, "c")], "k int, v double, s string")
    s = spark.createDataFrame([(1, None, "x"), (2, 5.0, "y"), (9, 1.0, "z")], "k int, v double, s string")
    assert rows(merge.merge_update(t, s, ["k"], ["v"]), "s") == [(1, 10.0, "a"), (2, 5.0, "b"), (None, 30.0, "c")]
    assert rows(merge.merge_update(t, s, ["k"], ["v"], overwrite_nulls=True), "s")[0] == (1, None, "a")
    assert rows(merge.merge_update(t, s, ["k"], ["v"], cond="b.s = 'x'"), "s")[1] == (2, 20.0, "b")
    added = merge.merge_update(t.drop("v"), s, ["k"], ["v"])
    assert added.columns == ["k", "s", "v"]


def test_merge_rejects_a_repeated_source_key(spark):
    t = spark.createDataFrame([(1, 1.0)], "k int, v double")
    twice = spark.createDataFrame([(1, 1.0), (1, 2.0)], "k int, v double")
    with pytest.raises(PySparkException, match="duplicate merge key"):
        merge.merge_update(t, twice, ["k"], ["v"]).collect()
    with pytest.raises(PySparkException, match="duplicate merge key"):
        merge.merge_many(t.select("k"), [(twice, ["v"])], ["k"]).collect()


def test_merge_many_and_insert_missing(spark):
    base = spark.createDataFrame([(1,), (2,)], "k int")
    a = spark.createDataFrame([(1, 5.0)], "k int, x double")
    b = spark.createDataFrame([(2, "t"), (7, "u")], "k int, y string")
    assert rows(merge.merge_many(base, [(a, ["x"]), (b, ["y"])], ["k"]), "k") == [(1, 5.0, None), (2, None, "t")]
    grown = merge.insert_missing(b, spark.createDataFrame([(2,), (3,)], "k int"), ["k"])
    assert rows(grown, "k") == [(2, "t"), (3, None), (7, "u")]


def test_top_n_keeps_all_ties_and_ranks_losses_ascending(spark):
    df = spark.createDataFrame([("g", i, v) for i, v in enumerate([5.0, 5.0, 3.0, 3.0, 1.0, None])], "g string, k int, v double")
    top = R.top_n(df, ["g"], {"hi": ("v", "desc"), "lo": ("v", "asc")}, 2, ["k"])
    assert rows(top.filter("index_type = 'hi'").select("k", "rank_no"), "k") == [(0, 1), (1, 1)]
    assert rows(top.filter("index_type = 'lo'").select("k", "rank_no"), "k") == [(2, 2), (3, 2), (4, 1)]
    assert R.top_n(df, ["g"], {"hi": ("v", "desc")}, 3, ["k"], ties="row_number").count() == 3


def test_top_n_when_everything_ties(spark):
    df = spark.range(500).selectExpr("'g' AS g", "id AS k", "0D AS v")
    assert R.top_n(df, ["g"], {"m": ("v", "asc")}, 9, ["k"]).count() == 500


def test_rank_within_equals_rank_for_skewed_groups(spark):
    df = spark.range(3000).selectExpr("CASE WHEN id % 10 < 7 THEN 'hot' ELSE concat('g', id % 4) END AS g", "id AS k",
                                      "CAST(CASE WHEN id % 3 = 0 THEN 1 ELSE id * 7919 % 211 END AS DOUBLE) AS v")
    got = R.rank_within(df, ["g"], "v", values_per_range=13, ranges_most=16)
    want = df.selectExpr("*", "rank() OVER (PARTITION BY g ORDER BY v DESC) AS r")
    both = got.join(want.select("k", "r"), "k")
    assert both.count() == 3000 and both.filter("rank_no <> r").count() == 0


def test_map_side_limit_before_the_shuffle(spark):
    df = spark.range(100).selectExpr("id % 3 AS g", "id AS k", "CAST(id AS DOUBLE) AS v")
    for frame in (R.top_n(df, ["g"], {"m": ("v", "desc")}, 2, ["k"]), R.latest_per_key(df, ["g"], [F.col("v").desc()])):
        assert "WindowGroupLimit" in frame._jdf.queryExecution().executedPlan().toString()


def test_semi_additive_over_a_holiday(spark, calendar):
    facts = spark.createDataFrame([(1, date(2023, 9, d), 100.0 * d, 1.0) for d in (25, 26, 27, 28)] + [(1, date(2023, 10, 9), 50.0, 7.0)],
                                  "k int, busi_date date, rights double, yes double")
    got = {r.period: r for r in balances.semi_additive(facts, ["k"], "rights", calendar, opening="yes").collect()}
    sep, octo = got["202309"], got["202310"]
    assert (sep.opening, sep.closing, sep.highest, sep.trade_days, sep.natural_days) == (1.0, 2800.0, 2800.0, 4, 6)
    assert sep.avg_trade == 10600.0 / 4 and sep.avg_natural == (2500 + 2600 + 2700 + 2800 * 3) / 6
    assert (octo.opening, octo.closing) == (7.0, 0.0) and octo.avg_natural == (2800 * 8 + 50) / 15


def test_spine_matches_null_key_parts(spark):
    a = spark.createDataFrame([(1, None, 2.0), (1, "x", 3.0)], "k int, p string, m double")
    b = spark.createDataFrame([(1, None, 5.0), (2, "y", 1.0)], "k int, p string, m double")
    got = rows(spine.spine_merge({"a": (a, ["m"]), "b": (b, ["m"])}, ["k", "p"]), "k", F.col("p").asc_nulls_first())
    assert got == [(1, None, 2.0, 5.0), (1, "x", 3.0, 0.0), (2, "y", 0.0, 1.0)]
    assert spine.key_spine([a, b], ["k"]).count() == 2


def test_union_by_name_ignores_case_and_by_position_ignores_names(spark):
    people = spark.createDataFrame([("Tom", 28, 2000.0)], "name string, age int, salary double")
    upper = spark.createDataFrame([("Tom", 1, 280.0)], "NAME string, AGE int, height double")
    assert spine.union_all([people, upper]).columns == ["name", "age", "salary", "height"]
    assert rows(spine.union_all([people, upper], by_position=True), "salary")[0] == ("Tom", 1, 280.0)


def test_rate_counts_on_both_boundary_days(spark, calendar):
    rates = spark.createDataFrame([(date(2023, 9, 26), date(2023, 9, 27), 1.5)], "begin_date date, end_date date, interest_rate double")
    facts = spark.createDataFrame([(date(2023, 9, d),) for d in (25, 26, 27, 28)], "busi_date date")
    assert rows(J.effective_rate(facts, rates, calendar), "busi_date") == [(date(2023, 9, 26), 1.5), (date(2023, 9, 27), 1.5)]
    assert [r.interest_rate for r in J.effective_rate(facts, rates, calendar, default=1.0).orderBy("busi_date").collect()] == [1.0, 1.5, 1.5, 1.0]
    endless = spark.createDataFrame([(date(1900, 1, 1), date(9999, 12, 31), 2.0)], "begin_date date, end_date date, interest_rate double")
    assert J.effective_rate(facts, endless, calendar).count() == 4


def test_unmapped_branch_drops_out_at_every_level(spark):
    acc = spark.createDataFrame([(1, 10), (2, 20), (3, 30)], "fund_account_id int, branch_id int")
    bm = spark.createDataFrame([(10, "u1"), (20, None), (30, "u3")], "ctp_branch_id int, oa_branch_id string")
    units = spark.createDataFrame([("u1", "L1", "R1"), ("u3", "L1", None)], "departmentid string, business_line_id string, respons_line_id string")
    facts = spark.createDataFrame([(1, 1.0), (1, 2.0), (2, 4.0), (3, 8.0)], "fund_account_id int, m double")
    def total(level):
        return rows(orgs.org_rollup(facts, ["m"], acc, bm, units, level), "org_id")
    assert total("unit") == [("u1", 3.0), ("u3", 8.0)] and total("line") == [("L1", 11.0)] and total("respons") == [("R1", 3.0)]


def test_scaffold_total_cohorts_allocation(spark):
    u = spark.createDataFrame([("a",), ("b",)], "u string")
    for n in (0, 1, 20_000):
        wide = J.scaffold(u, spark.range(n).selectExpr("id AS k"))
        assert wide.schema["k"].dataType.simpleString() == "bigint" and wide.count() == n * u.count()
    assert J.scaffold(u, [("1", "x"), ("2", "y")], ["c", "n"]).count() == 4
    assert J.scaffold(u, u.withColumnRenamed("u", "v")).count() == 4 and J.scaffold(u, [], ["c"]).count() == 0
    t = spark.createDataFrame([("a", 1.0), ("b", 3.0)], "u string, m double")
    assert rows(J.against_total(t, t.agg(F.sum("m").alias("all"))), "u") == [("a", 1.0, 4.0), ("b", 3.0, 4.0)]
    p, c = spark.createDataFrame([(1,), (2,), (2,)], "k int"), spark.createDataFrame([(2,), (3,)], "k int")
    assert rows(J.cohort_split(p, c, ["k"]), "k") == [(1, "lost"), (2, "kept"), (3, "new")]
    w = spark.createDataFrame([("a", "r1", 0.25), ("a", "r2", 0.75)], "u string, r string, alloca_rate double")
    assert rows(J.allocate(t, w, ["u"], ["m"]), "r") == [("a", "r1", 0.25), ("a", "r2", 0.75)]


def test_surplus_of_several_quarters_makes_up_a_miss(spark):
    df = spark.createDataFrame([("k", "1", 15.0, 10.0), ("k", "2", 12.0, 10.0), ("k", "3", 8.0, 10.0), ("k", "4", 30.0, 10.0)],
                               "k string, quarter_id string, actual_value double, target_value double")
    got = {r.quarter_id: r for r in scoring.carry_over(df, ["k"]).collect()}
    assert (got["3"].adjust_1, got["3"].adjust_2, got["3"].adjust_3, got["3"].completed) == (5.0, 2.0, 0.0, 15.0)
    assert (got["3"].adjust_quarter_1, got["3"].adjust_quarter_3) == ("1季度", "-")
    assert got["4"].completed == 30.0 and got["1"].completed == 15.0
    s = spark.createDataFrame([(1.5,), (0.5,), (0.0,), (-1.0,), (1.2,)], "r double").select(scoring.capped_score("r", F.lit(0.1), F.lit(120)))
    assert [round(r[0], 6) for r in s.collect()] == [12.0, 5.0, 0.0, 0.0, 12.0]


def test_aligned_load_replaces_only_its_partitions(spark, tmp_path):
    schema = schemas.text_and_double("name amount y q", doubles="amount")
    path = str(tmp_path / "t")
    first = spark.createDataFrame([("a", 1.0, "2023", "1"), ("b", 2.0, "2023", "2")], "NAME string, AMOUNT double, Y string, Q string")
    sink.load_aligned(first, schema, path, partition_by=["y", "q"])
    again = spark.createDataFrame([("c", 9, "junk")], "Name string, Amount int, extra string")
    from pyspark.sql import Observation
    seen = Observation()
    sink.load_aligned(again, schema, path, partitions={"y": "2023", "q": "2"}, observe=seen)
    assert seen.get["rows"] == 1
    assert rows(spark.read.schema(schema).parquet(path).select("name", "amount", "q"), "name") == [("a", 1.0, "1"), ("c", 9.0, "2")]
    sink.load_aligned(again, schema, path, "append", partitions={"y": "2023", "q": "1"})
    assert spark.read.parquet(path).count() == 3
    assert rows(sink.align_to_schema(again.drop("Amount"), schema)) == [("c", None, None, None)]


def test_reading_prunes_and_formats_bounds_not_columns(spark, tmp_path):
    path = str(tmp_path / "f")
    spark.createDataFrame([("20230101", 1.0, 2.0), ("20230301", 3.0, 4.0)], "BUSI_DATE string, A double, B double").write.parquet(path)
    df = tables.read_table(spark, path, ["busi_date", "a"]).filter(tables.day_range("busi_date", date(2023, 1, 1), date(2023, 1, 31), "%Y%m%d"))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert df.count() == 1 and "GreaterThanOrEqual" in plan and "b:double" not in plan.lower()
    assert tables.with_dates(df, ["busi_date"]).first()[0] == date(2023, 1, 1)


@pytest.mark.parametrize(("more", "fine"), [(0, False), (0, True), (3, True)])
def test_spine_is_one_shuffle_with_the_same_sums(spark, more, fine):
    """Few columns, or many under fine keys, against the sums in two steps of the same rows with ``more`` components."""
    a = spark.createDataFrame([("x", 1, 1.0, 3), (None, 1, 2.0, 4), ("x", 1, 2.0, 8), ("x", None, None, None)], "k string, p int, m double, b long")
    b = spark.createDataFrame([("x", 1, 4.0), ("y", 2, 8.111)], "k string, p int, n double")
    frames, keys = {"a": (a, ["m"]), "b": (b, ["n"]), **{f"c{i}": (b, ["n"]) for i in range(more)}}, ["k", "p"]
    masks = []
    if more:
        frames["a"], masks = (a, ["m", "b"]), ["a_b"]
    got = spine.spine_merge(frames, keys, masks=masks, fine=fine)
    assert got._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1
    assert got.columns[2:] == [f"{p}_{m}" for p, (_, ms) in frames.items() for m in ms]
    assert not any(f.nullable for f in got.schema.fields[2:])
    short = {(r.k, r.p): (r.a_m, r.b_n) for r in got.collect()}
    assert short == {("x", 1): (3.0, 4.0), (None, 1): (2.0, 0.0), ("x", None): (0.0, 0.0), ("y", 2): (0.0, 8.11)}
    assert not more or {(r.k, r.p): r.a_b for r in got.collect()} == {("x", 1): 11, (None, 1): 4, ("x", None): 0, ("y", 2): 0}

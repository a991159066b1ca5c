from datetime import date

from pyspark.sql import functions as F

from marginbook.functions import codes, measures as M

from conftest import rows


def test_safe_ratio_is_zero_without_a_denominator(spark):
    df = spark.createDataFrame([(1.0, 0.0), (1.0, None), (None, 2.0), (1.0, 4.0)], "n double, d double")
    assert [r[0] for r in df.select(M.safe_ratio("n", "d")).collect()] == [0.0, 0.0, 0.0, 0.25]
    assert [r[0] for r in df.select(M.safe_ratio(F.col("n"), F.col("d"), 100)).collect()] == [0.0, 0.0, 0.0, 25.0]
    assert [r[0] for r in df.select(M.growth("n", "d")).collect()] == [0.0, 0.0, -100.0, -75.0]


def test_money_sum_of_nothing_is_zero(spark):
    df = spark.createDataFrame([(None,), (0.1,), (0.2,)], "v double")
    assert df.agg(M.money_sum("v"), M.cond_sum("v > 5", "v"), M.cond_sum(F.col("v") > 0.15, "v")).first() == (0.3, 0.0, 0.2)
    assert df.filter("v > 9").agg(M.money_sum("v")).first()[0] == 0.0


def test_bucketize_edges_are_inclusive(spark):
    df = spark.createDataFrame([(1,), (2,), (3,), (9,), (None,)], "v int")
    assert [r[0] for r in df.select(M.bucketize("v", [1, 3], ["a", "b", "c"])).collect()] == ["a", "b", "b", "c", None]


def test_birth_from_both_identity_lengths(spark):
    df = spark.createDataFrame([("110101199001021234",), ("110101850607123",), ("unknown",), (None,), ("110101199913991234",)], "id string")
    assert [r[0] for r in df.select(codes.birth_from_id("id")).collect()] == [date(1990, 1, 2), date(1985, 6, 7), None, None, None]


def test_contract_month_rules_in_order(spark):
    df = spark.createDataFrame([
        ("cu2401", "2024", "03", "20240115", "20240215"), ("cu2401", "", "03", "20240115", "20240215"),
        ("cu2401", None, None, "20240115", None), ("cu2401", None, None, None, "20240215"), ("cu2405a9", None, None, None, None)],
        "c string, y string, m string, d string, e string")
    assert [r[0] for r in df.select(codes.delivery_month("c", "y", "m", "d", "e")).collect()] == ["2403", "2402", "2401", "2402", "2405"]


def test_indicator_codes(spark):
    df = spark.createDataFrame([("0", "1", "x"), ("1", "4", "x"), ("0", "6", "新增直接开发有效客户数量（户）"), ("0", "6", "新增有效客户数量"),
                                ("0", "6", "other"), ("1", "7", "x")], "t string, b string, n string")
    assert [r[0] for r in df.select(codes.indicator_code("t", "b", "n")).collect()] == ["001", "007", "010", "011", "", ""]


def test_labels_and_concat(spark):
    df = spark.createDataFrame([("301", "b"), ("zzz", "a"), ("301", "b")], "c string, v string")
    assert df.agg(M.group_concat("v")).first()[0] == "a/b"
    got = df.select(codes.label_map("c", codes.RELATION_LABELS).alias("l")).distinct()
    assert rows(got, "l") == [("-",), ("居间关系",)]

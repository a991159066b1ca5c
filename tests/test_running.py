"""Running totals keep their value through months without facts."""

import pytest
from pyspark.sql import functions as F

from marginbook.operators import running

from conftest import rows

SPINE = [("a", p) for p in ("199911", "199912", "200001", "200002", "200003")] + [("b", "200001"), ("b", "200001")]


@pytest.fixture(scope="module")
def facts(spark):
    return spark.createDataFrame(
        [("a", "199910", 1.0, "x"), ("a", "199912", 2.0, "y"), ("a", "199912", 4.0, None), ("a", "200002", 8.0, "x"), ("a", "200002", 16.0, "z"),
         ("a", "200002", None, "x"), ("a", "200005", 32.0, "w"), ("a", None, 64.0, "v"), ("c", "200001", 128.0, "x")],
        "org string, period string, v double, item string")


@pytest.fixture(scope="module")
def spine(spark):
    return spark.createDataFrame(SPINE, "org string, period string")


def test_a_month_without_facts_keeps_the_total(facts, spine):
    got = running.running_totals({"ever": (facts, "v", "ever", 2), "year": (facts, "v", "year", 2), "big": (facts, F.when(F.col("v") > 2, F.col("v")), "year", 2)},
                                 spine, ["org"])
    assert rows(got, "org", "period") == [
        ("a", "199911", 1.0, 1.0, 0.0), ("a", "199912", 7.0, 7.0, 4.0), ("a", "200001", 7.0, 0.0, 0.0), ("a", "200002", 31.0, 24.0, 24.0),
        ("a", "200003", 31.0, 24.0, 24.0), ("b", "200001", 0.0, 0.0, 0.0)]


def test_items_count_from_their_first_month_on(facts, spine):
    got = rows(running.running_distinct(facts, "item", "n", spine, ["org"]), "org", "period")
    assert [r[2] for r in got] == [1.0, 2.0, 0.0, 2.0, 2.0, 0.0]
    ever = rows(running.running_distinct(facts, "item", "n", spine, ["org"], since="ever"), "org", "period")
    assert [r[2] for r in ever] == [1.0, 2.0, 2.0, 3.0, 3.0, 0.0]


def test_empty_and_unknown(facts, spine):
    assert running.running_totals({"t": (facts, "v", "year", 2)}, spine.limit(0), ["org"]).count() == 0
    assert {r.t for r in running.running_totals({"t": (facts.limit(0), "v", "year", 2)}, spine, ["org"]).collect()} == {0.0}
    with pytest.raises(ValueError):
        running.running_totals({"t": (facts, "v", "month", 2)}, spine, ["org"])


def test_totals_never_fall_inside_their_window(spark):
    """The side business at the smallest tables: a running column falls only where a year begins."""
    import __spark_entry__ as entry
    got = entry.queries()["side_business"](spark, "/root/testdata/sf0.001").orderBy("org_id", "period").collect()
    columns = [c for c in got[0].asDict() if c.startswith(("xt_product", "xt_trade", "xt_off", "xt_own"))]
    assert len(columns) == 11
    for before, after in zip(got, got[1:]):
        if before.org_id == after.org_id and (before.period[:4] == after.period[:4]):
            assert all(after[c] >= before[c] - 1e-9 for c in columns)

"""Filter context (JN10): directions, inactive relationships, two paths."""

import pytest
from pyspark.sql import functions as F

from ledgerlake.plans.filters import RELATIONSHIPS, AmbiguousPath, FilterContext, Relationship


@pytest.fixture(scope="module")
def tables(spark):
    return {
        "day": spark.createDataFrame([(1, "mon"), (2, "tue"), (3, "wed")], "k int, name string"),
        "shop": spark.createDataFrame([("a", 1, 3), ("b", 2, 2), ("c", 3, 1), ("d", None, None)], "shop string, first int, last int"),
        "place": spark.createDataFrame([("a", "x"), ("b", "y"), ("c", "x"), ("z", "z")], "shop string, town string"),
        "sale": spark.createDataFrame([(1, "a", 5), (1, "b", 6), (2, "b", 7), (3, "a", 8), (None, "a", 9), (3, None, 1)],
                                      "k int, shop string, amount int"),
    }


RULES = (Relationship("shop", "first", "day", "k"), Relationship("shop", "last", "day", "k", active=False),
         Relationship("place", "shop", "shop", "shop", both=True), Relationship("sale", "k", "day", "k"))


def got(df, column):
    return sorted((str(r[0]) for r in df.select(column).collect()))


def test_flows_from_the_one_side(tables):
    ctx = FilterContext(tables, RULES).where("day", F.col("name") == "mon")
    assert got(ctx.table("shop"), "shop") == ["a"]
    assert got(ctx.table("sale"), "amount") == ["5", "6"]
    assert got(ctx.table("place"), "shop") == ["a"]     # on through the second relationship
    assert got(ctx.table("day"), "k") == ["1"]


def test_not_from_the_many_side(tables):
    ctx = FilterContext(tables, RULES).where("sale", F.col("amount") > 7)
    assert ctx.table("day").count() == 3 and ctx.table("shop").count() == 4
    assert got(ctx.table("sale"), "amount") == ["8", "9"]


def test_both_directions(tables):
    ctx = FilterContext(tables, RULES)
    assert got(ctx.where("place", F.col("town") == "x").table("shop"), "shop") == ["a", "c"]
    assert got(ctx.where("shop", F.col("first") >= 2).table("place"), "shop") == ["b", "c"]
    both = ctx.where("place", F.col("town") == "x").where("shop", F.col("first") >= 2)
    assert got(both.table("place"), "shop") == got(both.table("shop"), "shop") == ["c"]


def test_inactive_relationship_replaces_the_active_one(tables):
    ctx = FilterContext(tables, RULES).where("day", F.col("name") == "mon")
    other = ctx.using("shop.last", "day.k")
    assert got(other.table("shop"), "shop") == ["c"] and got(other.table("place"), "shop") == ["c"]
    assert got(other.table("sale"), "amount") == ["5", "6"]     # other pairs of tables are untouched
    assert got(ctx.table("shop"), "shop") == ["a"]              # contexts are values
    with pytest.raises(KeyError):
        ctx.using("shop.town", "day.k")


def test_null_keys_and_conditions(tables):
    ctx = FilterContext(tables, RULES)
    assert ctx.table("sale").count() == 6 and ctx.table("shop").count() == 4
    assert ctx.where("day", F.lit(True)).table("sale").count() == 5     # a filter, so the null day goes
    assert ctx.where("day", F.lit(None).cast("boolean")).table("sale").count() == 0
    assert ctx.where("day", F.col("k") > 1).where("day", F.col("k") < 3).table("sale").count() == 1
    assert ctx.where("day", F.col("k") > 1).all("day").table("sale").count() == 6


def test_second_path_is_refused(tables):
    two = (*RULES, Relationship("sale", "shop", "shop", "shop"))
    with pytest.raises(AmbiguousPath, match="day filters sale"):
        FilterContext(tables, two).where("day", F.col("k") == 1).table("sale")
    FilterContext(tables, two).table("shop").count()     # its own ways in are single
    round_trip = (Relationship("shop", "first", "day", "k", both=True), Relationship("sale", "k", "day", "k", both=True),
                  Relationship("sale", "shop", "shop", "shop", both=True))
    with pytest.raises(AmbiguousPath):
        FilterContext(tables, round_trip).table("shop")


def test_summaries(tables):
    ctx = FilterContext(tables, RULES)
    total = F.sum("amount").alias("amount")
    by = {(r[0], r[1]) for r in ctx.summarize("sale", ["day.name"], total).collect()}
    assert by == {("mon", 11), ("tue", 7), ("wed", 9), (None, 9)}
    by = {tuple(r) for r in ctx.where("day", F.col("k") > 1).summarize("sale", ["day.name", "shop"], total).collect()}
    assert by == {("tue", "b", 7), ("wed", "a", 8), ("wed", None, 1)}
    by = {tuple(r) for r in ctx.summarize("shop", ["place.town"], F.count("shop").alias("n")).collect()}
    assert by == {("x", 2), ("y", 1), (None, 1)}
    with pytest.raises(KeyError):
        ctx.summarize("place", ["day.name"], F.count("*"))


def test_the_report_model_has_single_paths():
    class Anything:
        def __getattr__(self, name):
            return None
    ctx = FilterContext(Anything())
    names = {r.table for r in RELATIONSHIPS} | {r.to_table for r in RELATIONSHIPS}
    reached = {t: set(ctx.paths(t)) - {t} for t in names}
    assert reached["dim_merchants"] == {"mart_kpi_merchant_overall", "dim_date", "mart_kpi_daily"}
    assert reached["dim_date"] == {"mart_kpi_daily"} and reached["dim_time"] == set()
    assert reached["mart_kpi_merchant_daily"] == {"dim_date", "mart_kpi_daily"}     # merchants do not filter it

"""Mergeable distinct counts (AG7) against sets."""

import random

import pytest

from ledgerlake.operators.distinct import BUCKET, bitmaps, distinct_counts, distinct_levels, new_numbers, rolled_up
from ledgerlake.plans.models import Models, written

SCHEMA = "day int, place string, who string, what string, bits string, number int"


def some_rows(n=3000):
    rng = random.Random(4)
    rows = [(rng.randint(1, 5), rng.choice(["x", "y", None]), rng.choice(["hot", f"u{rng.randrange(400)}"]),
             f"w{rng.randrange(9)}" if rng.random() < 0.8 else None, "b", 1) for _ in range(n)]
    return rows + rows[:50] + [(9, "x", None, None, "b", 1), (None, "y", "u1", "only here", "b", 1)]


@pytest.fixture(scope="module")
def facts(spark):
    return spark.createDataFrame(some_rows(), SCHEMA).repartition(7)


@pytest.fixture(scope="module")
def stored(facts):
    columns = {n: (c, written(new_numbers(facts, c), f"test-{c}")) for n, c in (("users", "who"), ("things", "what"))}
    return written(bitmaps(facts, ["day", "place"], columns), "test-bitmaps")


@pytest.mark.parametrize("groups", [["day", "place"], ["day"], ["place"], []])
def test_any_level_from_one_table(stored, groups):
    at = [["day", "place"].index(g) for g in groups]
    want = {}
    for r in some_rows():
        for i, column in enumerate((2, 3)):
            if r[column] is not None:
                want.setdefault(tuple(r[k] for k in at), (set(), set()))[i].add(r[column])
    got = {tuple(r[g] for g in groups): (r["users"], r["things"]) for r in distinct_counts(stored, groups, ["users", "things"]).collect()}
    assert got == {k: (len(a), len(b)) for k, (a, b) in want.items()}


def test_rolled_up_bitmaps_merge_again(stored):
    by_day = rolled_up(stored, ["day"])
    assert distinct_counts(by_day, [], ["users", "things"]).collect() == distinct_counts(stored, [], ["users", "things"]).collect()


def test_new_days_keep_old_numbers(spark, facts):
    first = written(new_numbers(facts.where("day <= 3"), "who"), "test-first")
    later = written(new_numbers(facts, "who", first), "test-later")
    known, new = ({r["value"]: r["number"] for r in d.collect()} for d in (first, later))
    assert set(known).isdisjoint(new) and set(known) | set(new) == {r[2] for r in some_rows() if r[2] is not None}
    numbers = [*known.values(), *new.values()]
    assert len(set(numbers)) == len(numbers) and min(new.values(), default=BUCKET) // BUCKET > max(known.values()) // BUCKET
    a = bitmaps(facts.where("day <= 3"), ["day"], {"users": ("who", first)})
    b = bitmaps(facts.where("day > 3"), ["day"], {"users": ("who", first.unionByName(later))})
    total = distinct_counts(a.unionByName(b), [], ["users"]).first()["users"]
    assert total == len({r[2] for r in some_rows() if r[0] is not None and r[2] is not None})


def test_many_buckets(spark):
    df = spark.range(100_000).selectExpr("cast(id % 90000 as string) who", "id % 2 day")
    numbers = written(new_numbers(df, "who"), "test-many")
    counts = {r["day"]: r["users"] for r in distinct_counts(bitmaps(df, ["day"], {"users": ("who", numbers)}), ["day"], ["users"]).collect()}
    assert counts == {0: 45_000, 1: 45_000}


def test_empty(spark, facts):
    none = facts.where("false")
    numbers = written(new_numbers(none, "who"), "test-none")
    assert numbers.count() == 0 and new_numbers(none, "who", numbers).count() == 0
    assert bitmaps(none, ["day"], {"users": ("who", numbers)}).count() == 0


def test_plan_has_no_expand(spark):
    m = Models(spark, "/root/testdata/sf0.001").build(Models.SHARED)
    plan = distinct_levels(m)._jdf.queryExecution().toString()
    assert "Expand" not in plan and "bitmap_or_agg" in plan

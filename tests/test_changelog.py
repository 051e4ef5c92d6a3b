"""The change log (SRC10): positions, deletes, moved keys, late and repeated entries."""

import random
from collections import Counter
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from ledgerlake.sources.changelog import log_versions, open_rows, replay, user_history
from ledgerlake.sources.tables import raw_users_log

SCHEMA = "lsn long, op string, committed_at timestamp, old_key string, id string, name string, n int"
T0 = datetime(2024, 1, 1)


def entry(lsn, op, key, name=None, old=None):
    return (lsn, op, T0 + timedelta(seconds=lsn // 2), old, key, name, lsn)


def random_log(n=600, keys=25, seed=1):
    rng, out = random.Random(seed), []
    for lsn in range(1, n + 1):
        key = "hot" if rng.random() < 0.4 else f"k{rng.randrange(keys)}"
        kind = rng.random()
        if kind < 0.2:
            out.append(entry(lsn, "D", None, old=key))
        elif kind < 0.3:
            out.append(entry(lsn, "U", f"k{rng.randrange(keys)}", f"moved {lsn}", old=key))
        else:
            out.append(entry(lsn, rng.choice("IU"), key, f"v{lsn}", old=key if kind > 0.9 else None))
    return out


def applied(log):
    """A plain table, entry after entry; and the versions it had."""
    table, versions = {}, {}

    def close(key, at, by):
        if key in table:
            versions[table[key][0]] = (*versions[table[key][0]][:4], at, by)
        table.pop(key, None)
    closed = {}
    for lsn, op, at, old, key, name, n in sorted(set(log), key=lambda r: r[0]):
        if op == "D":
            close(old if old is not None else key, at, "delete")
        else:
            if op == "U" and old is not None and old != key:
                close(old, at, "move")
            close(key, at, "update")
            table[key] = (lsn, name, n)
            versions[lsn] = (key, name, lsn, at, None, None)
    return {k: v for k, v in table.items()}, Counter(versions.values()), closed


def shuffled(spark, log, seed=0):
    log = log + log[::7]        # repeated deliveries
    random.Random(seed).shuffle(log)
    return spark.createDataFrame(log, SCHEMA).repartition(4)


def rows_of(state):
    return {r["id"]: (r["lsn"], r["name"], r["n"]) for r in open_rows(state).collect()}


def test_replay_follows_positions(spark):
    log = random_log()
    assert rows_of(replay(shuffled(spark, log), "id")) == applied(log)[0]


@pytest.mark.parametrize("seed", [1, 2])
def test_batches_in_any_order(spark, seed):
    log, rng, state = random_log(seed=seed), random.Random(seed), None
    cut = [log[i::4] for i in range(4)]
    rng.shuffle(cut)
    for part in [*cut, cut[1]]:         # the last batch comes twice
        state = replay(shuffled(spark, part), "id", state).checkpoint()
    assert rows_of(state) == applied(log)[0]


def test_late_entry_below_a_delete(spark):
    state = replay(spark.createDataFrame([entry(9, "D", None, old="a")], SCHEMA), "id")
    state = replay(spark.createDataFrame([entry(4, "I", "a", "late"), entry(5, "I", "b", "kept")], SCHEMA), "id", state)
    assert rows_of(state) == {"b": (5, "kept", 5)}
    state = replay(spark.createDataFrame([entry(12, "I", "a", "again")], SCHEMA), "id", state)
    assert rows_of(state) == {"a": (12, "again", 12), "b": (5, "kept", 5)}


@pytest.mark.parametrize("positions", [1_000_000, 10, 1])
def test_versions(spark, positions):
    log = random_log()
    got = log_versions(shuffled(spark, log), "id", positions)
    assert Counter((r["id"], r["name"], r["lsn"], r["valid_from"], r["valid_to"], r["ended_by"]) for r in got.collect()) == \
        applied(log)[1]


def test_entries_without_meaning(spark):
    log = [entry(1, "I", "a", "x"), (None, "U", T0, None, "a", "no position", 0), entry(2, "T", "a"), entry(3, "U", None, "no key"),
           entry(4, None, "a", "no op"), entry(5, "D", None, old="nobody"), entry(6, "D", "a"), entry(7, "I", "c", None)]
    df = spark.createDataFrame(log, SCHEMA)
    assert rows_of(replay(df, "id")) == {"c": (7, None, 7)}
    assert {(r["id"], r["ended_by"]) for r in log_versions(df, "id").collect()} == {("a", "delete"), ("c", None)}
    empty = df.where("false")
    assert open_rows(replay(empty, "id")).count() == log_versions(empty, "id").count() == 0


def test_deletes_close_user_versions(spark):
    log = raw_users_log(spark, "/root/testdata/sf0.001")
    history = user_history(log)
    ends = {r[0]: r[1] for r in history.groupBy("ended_by").count().collect()}
    assert ends["delete"] > 3 and ends["move"] > 1 and ends["update"] > 20 and ends[None] > 3
    open_users = {r[0] for r in history.where("dbt_valid_to is null").select("user_id").collect()}
    assert open_users == {r[0] for r in open_rows(replay(log, "user_id")).select("user_id").collect()}
    assert history.where(F.col("user_id").isNull()).count() == 0

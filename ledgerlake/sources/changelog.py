"""The users' change log as a log (SRC10): positions, operations, key-only old images.

A logical replication stream gives one entry per changed row: its position in
the log, the operation (I, U, D), the commit time and the new row.  The tables
publish with their primary key as replica identity, so an old image holds the
key alone, and comes with deletes and with updates that change the key.

Entries reach the landing table at least once and in any order.  Everything
here follows the log's positions, never the order of arrival: an entry that
comes late, or twice, gives the same result.

An entry becomes one or two *actions* on keys: a delete closes its key; an
update that moves a row to another key closes the old one and writes the new
one at the same position; inserts and updates write (an update of a row that
was never seen is a write as well, as a stream may start in the middle).

Defined cases: entries without a position, without a key, or with another
operation take no part; a delete of an unknown key changes nothing; a write
after a delete opens the key again; of entries with one position and key one is
taken; an empty log gives empty results; further columns are part of the row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

LOG_COLUMNS = ("lsn", "op", "committed_at", "old_key")
STEP_COLUMNS = ("__pos", "__deleted", "__moved")


def actions(log: DataFrame, key: str) -> DataFrame:
    """(key, row columns, lsn, committed_at, __pos, __deleted, __moved): closes (row columns NULL) and writes."""
    row = [c for c in log.columns if c not in LOG_COLUMNS]
    moved = (F.col("op") == "U") & F.col("old_key").isNotNull() & (F.col("old_key") != F.col(key))
    known = log.where(F.col("lsn").isNotNull() & F.col("op").isin("I", "U", "D"))
    empty = [F.lit(None).cast(log.schema[c].dataType).alias(c) for c in row if c != key]
    closes = known.where((F.col("op") == "D") | moved).select(
        F.coalesce("old_key", F.col(key)).alias(key), *empty, "lsn", "committed_at",
        (F.col("lsn") * 2).alias("__pos"), F.lit(True).alias("__deleted"), moved.alias("__moved"))
    writes = known.where(F.col("op") != "D").select(
        *row, "lsn", "committed_at", (F.col("lsn") * 2 + 1).alias("__pos"), F.lit(False).alias("__deleted"),
        F.lit(False).alias("__moved"))
    return closes.unionByName(writes).where(F.col(key).isNotNull())


def _latest(acts: DataFrame, key: str) -> DataFrame:
    """The last action of each key.  A partial limit per map task comes before the shuffle, so a key with a third of the log
    sends one row per task."""
    last = Window.partitionBy(key).orderBy(F.col("__pos").desc(), F.xxhash64(*acts.columns))
    return acts.withColumn("__rn", F.row_number().over(last)).where("__rn = 1").drop("__rn")


def replay(log: DataFrame, key: str, state: DataFrame | None = None) -> DataFrame:
    """The table's state after the log: the last action of each key.  ``state``, from an earlier replay, keeps closed keys
    too, so that a late entry below a delete stays without effect; replays in any order or twice give the same."""
    acts = _latest(actions(log, key), key)
    return acts if state is None else _latest(state.unionByName(acts), key)


def open_rows(state: DataFrame) -> DataFrame:
    """The rows of the table: keys that are not closed, with the position that wrote them."""
    return state.where(~F.col("__deleted")).drop("committed_at", *STEP_COLUMNS)


def log_versions(log: DataFrame, key: str, positions: int = 1_000_000) -> DataFrame:
    """One version per write: row columns, lsn, valid_from, valid_to and ended_by (``update``, ``delete``, ``move``; NULL while
    open).  A version ends where the key's next action is, in log order.  Windows are split by (key, ``positions`` of the log),
    and a split's last action looks at the key's next split by a summary of one row each."""
    acts = actions(log, key).dropDuplicates([key, "__pos"]).withColumn(
        "__part", F.floor(F.col("__pos") / F.lit(2 * positions)).cast("bigint"))
    ended = F.when(F.col("__moved"), "move").when(F.col("__deleted"), "delete").otherwise("update")
    here = F.struct(F.col("committed_at").alias("at"), ended.alias("by"))
    inside = Window.partitionBy(key, "__part").orderBy("__pos")
    first = acts.groupBy(key, "__part").agg(F.min_by(here, "__pos").alias("__first"))
    later = first.select(F.col(key).alias("__k"), F.col("__part").alias("__p"),
                         F.lead("__first").over(Window.partitionBy(key).orderBy("__part")).alias("__later"))
    j = acts.withColumn("__next", F.lead(here).over(inside))
    j = j.join(later, (j[key] == later["__k"]) & (j["__part"] == later["__p"]))
    end = F.coalesce("__next", "__later")
    row = [c for c in log.columns if c not in LOG_COLUMNS]
    return j.where(~F.col("__deleted")).select(*row, "lsn", F.col("committed_at").alias("valid_from"),
                                               end["at"].alias("valid_to"), end["by"].alias("ended_by"))


def user_history(log: DataFrame) -> DataFrame:
    """MD10 from the log: user versions whose ends include deletes and key changes; the columns of ``dim_users_history``
    and ``ended_by``."""
    from ledgerlake.functions import exprs as X
    from ledgerlake.plans.dims import USER_HISTORY_COLUMNS
    from ledgerlake.plans.staging import stg_users_changes
    v = stg_users_changes(log_versions(log, "user_id"), keep=("valid_from", "valid_to", "ended_by"))
    built: dict[str, Column] = {
        "user_version_id": X.surrogate_key(F.col("user_id"), F.date_format("valid_from", X.VERSION_TS_FORMAT)),
        "full_name": X.full_name("first_name", "last_name"), "dbt_valid_from": F.col("valid_from"),
        "dbt_valid_to": F.col("valid_to")}
    return v.select(*[built[c].alias(c) if c in built else c for c in USER_HISTORY_COLUMNS], "ended_by")

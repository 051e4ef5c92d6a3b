"""Declarative data-quality checks (DQ1-DQ5).

Each check returns failing-row counts the way the warehouse's generic tests
count them:

* not_null: rows where the column is NULL;
* accepted_values: distinct non-NULL values outside the list;
* unique: non-NULL values that occur more than once (one failure per value);
* relationships: non-NULL child rows whose value has no parent row.

All not_null / accepted_values checks of one table run as a single
aggregate over one scan, or, with :class:`ObservedChecks`, inside the job that
writes the table, without any scan of their own.  ``unique`` is a partial-aggregated group-by.
``relationships`` first reduces the child column to (value, rows) with a
partial aggregate, so a value that fills a third of the table costs one row
in the anti join, and only then anti-joins the parent's distinct keys.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

RESULT_SCHEMA = T.StructType([
    T.StructField("model", T.StringType()),
    T.StructField("column_name", T.StringType()),
    T.StructField("test_name", T.StringType()),
    T.StructField("failing_rows", T.LongType()),
])


@dataclass(frozen=True)
class Check:
    model: str
    column: str
    test: str                                   # not_null | unique | accepted_values | relationships
    values: tuple = field(default=())           # accepted_values
    to_model: str | None = None                 # relationships
    to_field: str | None = None


def _row_checks(model: str, df: DataFrame, checks: list[Check]) -> DataFrame | None:
    aggs, names = [], []
    for i, c in enumerate(checks):
        col = F.col(c.column)
        if c.test == "not_null":
            aggs.append(F.count_if(col.isNull()).alias(f"c{i}"))
        else:
            # one failure per distinct value outside the list (values are grouped first)
            aggs.append(F.count_distinct(F.when(~col.isin(*c.values), col)).alias(f"c{i}"))
        names.append(c)
    if not aggs:
        return None
    one = df.agg(*aggs)
    stacked = one.select(F.explode(F.array(*[
        F.struct(F.lit(model).alias("model"), F.lit(c.column).alias("column_name"),
                 F.lit(c.test).alias("test_name"), F.col(f"c{i}").cast("bigint").alias("failing_rows"))
        for i, c in enumerate(names)])).alias("r")).select("r.*")
    return stacked


ROW_TESTS = ("not_null", "accepted_values")


class FailedChecks(ValueError):
    """A written table does not hold what its checks demand; ``counts`` has the failing rows by check."""

    def __init__(self, counts: dict):
        self.counts = counts
        super().__init__("; ".join(f"{c.model}.{c.column} {c.test}: {n} rows" for c, n in counts.items()))


class ObservedChecks:
    """The not_null and accepted_values checks among ``checks``, counted while a table is written.

    ``watch`` adds the counts to the rows on their way to the writer; once the write is done, ``counts`` gives them and
    ``enforce`` raises if any row failed.  Rows are counted (a distinct count cannot be observed), which passes and fails
    alike.  A re-run stage may count its failing rows again, but none where there is none."""

    def __init__(self, checks):
        self.checks = [c for c in checks if c.test in ROW_TESTS]
        self._seen = None

    def watch(self, df: DataFrame) -> DataFrame:
        if not self.checks:
            return df
        self._seen = Observation()
        failing = [F.col(f"`{c.column}`").isNull() if c.test == "not_null" else ~F.col(f"`{c.column}`").isin(*c.values)
                   for c in self.checks]
        return df.observe(self._seen, *[F.count_if(x).alias(f"c{i}") for i, x in enumerate(failing)])

    def counts(self) -> dict:
        seen = self._seen.get if self.checks else {}
        return {c: int(seen.get(f"c{i}") or 0) for i, c in enumerate(self.checks)}

    def enforce(self) -> dict:
        counts = self.counts()
        failed = {c: n for c, n in counts.items() if n}
        if failed:
            raise FailedChecks(failed)
        return counts


def unique_failures(model: str, df: DataFrame, column: str) -> DataFrame:
    dup = (df.where(F.col(column).isNotNull()).groupBy(column).count().where("count > 1"))
    return dup.agg(F.count(F.lit(1)).alias("failing_rows")).select(
        F.lit(model).alias("model"), F.lit(column).alias("column_name"), F.lit("unique").alias("test_name"),
        F.col("failing_rows").cast("bigint"))


def orphan_rows(child: DataFrame, column: str, parent: DataFrame, parent_field: str) -> DataFrame:
    """Distinct orphan values of ``child.column`` with their row counts (JN9)."""
    per_value = child.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("rows"))
    keys = parent.select(F.col(parent_field).alias("__pk")).where(F.col("__pk").isNotNull()).distinct()
    return per_value.join(keys, per_value[column] == keys["__pk"], "left_anti")


def relationship_failures(model: str, child: DataFrame, column: str, parent: DataFrame,
                          parent_field: str) -> DataFrame:
    orphans = orphan_rows(child, column, parent, parent_field)
    return orphans.agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("failing_rows")).select(
        F.lit(model).alias("model"), F.lit(column).alias("column_name"), F.lit("relationships").alias("test_name"),
        F.col("failing_rows").cast("bigint"))


def run_suite(spark: SparkSession, tables: dict[str, DataFrame], checks: list[Check],
              known: dict[Check, int] | None = None) -> DataFrame:
    """DQ5: one row per check: (model, column_name, test_name, failing_rows, passed).  ``known``: results that the writes
    of the tables have given; these checks scan nothing."""
    parts: list[DataFrame] = []
    by_model: dict[str, list[Check]] = {}
    known = known or {}
    done = [(c.model, c.column, c.test, known[c]) for c in checks if c in known]
    if done:
        parts.append(spark.createDataFrame(done, RESULT_SCHEMA))
    for c in checks:
        if c not in known:
            by_model.setdefault(c.model, []).append(c)
    for model, cs in by_model.items():
        df = tables[model]
        rc = _row_checks(model, df, [c for c in cs if c.test in ROW_TESTS])
        if rc is not None:
            parts.append(rc)
        for c in cs:
            if c.test == "unique":
                parts.append(unique_failures(model, df, c.column))
            elif c.test == "relationships":
                parts.append(relationship_failures(model, df, c.column, tables[c.to_model], c.to_field))
    if not parts:
        return spark.createDataFrame([], RESULT_SCHEMA).withColumn("passed", F.lit(True))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.withColumn("passed", F.col("failing_rows") == 0)

"""The report model's relationships and filter context (JN10).

A relationship joins the *many* side's column to the *one* side's column.  A
filter on a table reaches other tables along relationships: from the one side
to the many side, and also back where the relationship filters both ways.  An
inactive relationship carries filters only when a query asks for it, and then
in place of the active one between the same two tables.

A reached table keeps the rows whose key is among the surviving rows of the
table the filter came through: one semi-join for each relationship on the way,
on the key column alone.  Keys of a one side are unique, and those of a many
side need not be made distinct for a semi-join.  Spark picks broadcast or
sort-merge from the sizes at run time; nothing is collected.

Two paths from a filtered table to another one give two different answers, so
a walk that meets a table a second time stops with :class:`AmbiguousPath`.

Defined cases: a null key belongs to no row of the other side, so a filtered
walk drops it and an unfiltered table keeps it; several conditions on one table
must all hold; a condition that is null does not hold; a table that no filter
reaches is whole.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class Relationship(NamedTuple):
    table: str
    column: str
    to_table: str
    to_column: str
    active: bool = True
    both: bool = False      # filters flow from ``table`` to ``to_table`` as well

    def __str__(self) -> str:
        return f"{self.table}.{self.column} -> {self.to_table}.{self.to_column}"


# The relationships of the report's semantic model
RELATIONSHIPS = (
    Relationship("mart_kpi_daily", "date_key", "dim_date", "date_key", both=True),
    Relationship("mart_kpi_user_daily", "date_key", "dim_date", "date_key"),
    Relationship("mart_kpi_user_daily", "user_id", "dim_users_current", "user_id"),
    Relationship("mart_kpi_merchant_daily", "date_key", "dim_date", "date_key"),
    Relationship("mart_kpi_currency_daily", "date_key", "dim_date", "date_key"),
    Relationship("mart_kpi_merchant_overall", "first_date_key", "dim_date", "date_key"),
    Relationship("mart_kpi_merchant_overall", "last_date_key", "dim_date", "date_key", active=False),
    Relationship("mart_kpi_hourly", "date_key", "dim_date", "date_key"),
    Relationship("mart_kpi_hourly", "time_key", "dim_time", "time_key"),
    Relationship("dim_merchants", "merchant_name", "mart_kpi_merchant_overall", "merchant_name", both=True),
)


class AmbiguousPath(ValueError):
    """A filter reaches a table in two ways."""


class FilterContext:
    """Filters on the tables of a model, as they reach its other tables.

    ``tables`` maps a name to its DataFrame (a dict, or an object with the
    tables as attributes).  Contexts are values: every method gives a new one.
    """

    def __init__(self, tables, relationships=RELATIONSHIPS, filters: dict | None = None):
        self._tables, self.relationships, self._filters = tables, tuple(relationships), dict(filters or {})

    def source(self, table: str) -> DataFrame:
        return self._tables[table] if isinstance(self._tables, dict) else getattr(self._tables, table)

    def where(self, table: str, condition: Column) -> "FilterContext":
        """The context with one more condition on ``table``."""
        both = self._filters[table] & condition if table in self._filters else condition
        return FilterContext(self._tables, self.relationships, {**self._filters, table: both})

    def all(self, *tables: str) -> "FilterContext":
        """The context without the filters on ``tables`` (without any, if none is named)."""
        keep = {t: c for t, c in self._filters.items() if tables and t not in tables}
        return FilterContext(self._tables, self.relationships, keep)

    def using(self, column: str, to_column: str) -> "FilterContext":
        """The context in which the relationship of two ``table.column`` names is the active one of its two tables."""
        ends = {tuple(column.split(".")), tuple(to_column.split("."))}
        hit = [r for r in self.relationships if {(r.table, r.column), (r.to_table, r.to_column)} == ends]
        if not hit:
            raise KeyError(f"no relationship between {column} and {to_column}")
        pair = {hit[0].table, hit[0].to_table}
        return FilterContext(self._tables, [r._replace(active=r == hit[0]) if {r.table, r.to_table} == pair else r
                                            for r in self.relationships], self._filters)

    def _incoming(self, table: str) -> list[tuple[str, str, str]]:
        """(other table, its column, this table's column) of the relationships that bring filters to ``table``."""
        into = [(r.to_table, r.to_column, r.column) for r in self.relationships if r.active and r.table == table]
        return into + [(r.table, r.column, r.to_column) for r in self.relationships
                       if r.active and r.both and r.to_table == table]

    def paths(self, table: str) -> dict[str, list[str]]:
        """For each table whose filters reach ``table``: the tables on the way, ``table`` last."""
        found = {table: [table]}

        def walk(at: str, came_from: str | None) -> None:
            for other, _, _ in self._incoming(at):
                if other == came_from:      # a filter does not flow back over the relationship that brought it
                    continue
                if other in found:
                    raise AmbiguousPath(f"{other} filters {table} by {' > '.join([other, *found[at]])} and by "
                                        f"{' > '.join(found[other])}")
                found[other] = [other, *found[at]]
                walk(other, at)
        walk(table, None)
        return found

    def table(self, name: str) -> DataFrame:
        """The rows of ``name`` that all filters leave."""
        self.paths(name)    # refuses two ways from anywhere
        return self._rows(name, None)

    def _filtered(self, table: str, came_from: str | None) -> bool:
        return table in self._filters or any(self._filtered(other, table) for other, _, _ in self._incoming(table)
                                             if other != came_from)

    def _rows(self, table: str, came_from: str | None) -> DataFrame:
        rows = self.source(table)
        if table in self._filters:
            rows = rows.where(self._filters[table])
        for other, other_column, column in self._incoming(table):
            if other != came_from and self._filtered(other, table):
                keys = self._rows(other, table).select(F.col(other_column).alias("__key"))
                rows = rows.join(keys, rows[column] == keys["__key"], "left_semi")
        return rows

    def lookup(self, table: str, dim: str) -> tuple[str, str]:
        """(column of ``table``, key of ``dim``) of the active relationship by which each row of ``table`` has at most one
        row of ``dim``."""
        for r in self.relationships:
            if r.active and r.table == table and r.to_table == dim:
                return r.column, r.to_column
            if r.active and r.both and r.table == dim and r.to_table == table:      # one to one, seen from its one side
                return r.to_column, r.column
        raise KeyError(f"{table} has no active relationship to {dim}")

    def summarize(self, table: str, by: list[str], *measures: Column) -> DataFrame:
        """Measures over the rows of ``table`` in this context, grouped by its own columns or by ``dim.column`` of its
        dimensions; rows without a partner in a dimension are grouped under NULL."""
        rows, groups = self.table(table), []
        dims: dict[str, list[str]] = {}
        for name in by:
            dim, _, column = name.rpartition(".")
            if dim and dim != table:
                dims.setdefault(dim, []).append(column)
            groups.append(F.col(f"__{dim}__{column}" if dim and dim != table else column).alias(column))
        for dim, columns in dims.items():
            own, key = self.lookup(table, dim)
            side = self.source(dim).select(F.col(key).alias(f"__{dim}"), *[F.col(c).alias(f"__{dim}__{c}") for c in columns])
            rows = rows.join(side, rows[own] == side[f"__{dim}"], "left")
        return rows.groupBy(*groups).agg(*measures)


def filter_contexts(models) -> DataFrame:
    """What is left of the model's tables under four filters: a part of a calendar month, a merchant mart, the calendar over
    the inactive ``last_date_key``, and a daily mart (which filters the calendar, and by it the other marts)."""
    ctx = FilterContext(models)
    late = (F.col("month_number") == 1) & (F.col("day_of_month") > 20)
    contexts = {
        "month": ctx.where("dim_date", late),
        "merchant": ctx.where("mart_kpi_merchant_overall", F.col("fraud_txn_count") >= 20),
        "last_date": ctx.using("mart_kpi_merchant_overall.last_date_key", "dim_date.date_key").where("dim_date", late),
        "daily": ctx.where("mart_kpi_daily", F.col("fraud_rate") >= 0.2).where("dim_date", F.col("day_of_week") != 1),
    }
    tables = ["mart_kpi_daily", "mart_kpi_currency_daily", "mart_kpi_merchant_daily", "mart_kpi_merchant_overall",
              "mart_kpi_user_daily", "dim_merchants", "dim_date"]
    out = None
    for name, context in contexts.items():
        for t in tables:
            rows = context.table(t)
            total = F.sum("amount_usd_total") if "amount_usd_total" in rows.columns else F.lit(None).cast("decimal(38,9)")
            one = rows.agg(F.count(F.lit(1)).alias("row_count"), total.cast("decimal(38,9)").alias("amount_usd_total")).select(
                F.lit(name).alias("context"), F.lit(t).alias("table_name"), "row_count", "amount_usd_total")
            out = one if out is None else out.unionByName(one)
    return out


def filtered_visuals(models) -> DataFrame:
    """Daily totals by weekday, and merchant totals by the month of their last day, under the same filter."""
    late = F.col("day_of_month") > 20
    ctx = FilterContext(models).where("dim_date", late)
    total = F.sum("amount_usd_total").cast("decimal(38,9)").alias("amount_usd_total")
    first = ctx.summarize("mart_kpi_currency_daily", ["dim_date.day_name", "currency"], total)
    last = ctx.using("mart_kpi_merchant_overall.last_date_key", "dim_date.date_key").summarize(
        "mart_kpi_merchant_overall", ["dim_date.day_name"], total)
    return first.unionByName(last.withColumn("currency", F.lit("all, by last day")))

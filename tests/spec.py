"""Executable specifications: the plain forms that the linear operators must equal.  They pair every row with every
candidate of its key, so they are for small inputs only."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from ledgerlake.functions.exprs import decimal_avg, seconds_diff, to_usd
from ledgerlake.operators.topk import row_tiebreak
from ledgerlake.plans import features


def nearest_rate(tx, fx):
    """MD6: equi-join on the currency, then rank by distance, later first."""
    r = fx.where("datetime_fetched_UTC is not null and transaction_currency is not null").select(
        F.col("transaction_currency").alias("__rk"), F.col("datetime_fetched_UTC").alias("fx_rate_timestamp_UTC"),
        F.col("rate").alias("fx_rate_to_currency"))
    j = tx.join(r, tx["currency"] == r["__rk"], "left")
    dist = F.abs(seconds_diff(F.col("transaction_datetime_UTC"), F.col("fx_rate_timestamp_UTC")))
    w = Window.partitionBy("transaction_id").orderBy(dist.asc_nulls_first(), F.col("fx_rate_timestamp_UTC").desc(),
                                                     row_tiebreak(j))
    j = j.withColumn("__rn", F.row_number().over(w)).where("__rn = 1")
    return j.select(*tx.columns, "fx_rate_to_currency", "fx_rate_timestamp_UTC",
                    to_usd("currency", "original_amount", "fx_rate_to_currency").alias("amount_usd"))


def fraud_features(fct, dim_date, dim_time, dim_merchants):
    """MD20 with Spark's own frames."""
    e = features.enrich(fct.withColumn("event_ts", F.col("transaction_datetime_UTC").cast("timestamp")),
                        dim_date, dim_time, dim_merchants)
    amount = F.col("original_amount")
    for prefix, keys, widths, full in features.ROLLING_SPECS:
        w = Window.partitionBy(*keys).orderBy("event_ts", "transaction_id")
        e = e.withColumn(f"{prefix}_recency_seconds", seconds_diff(F.col("event_ts"), F.lag("event_ts").over(w)))
        for label, width in widths.items():
            w = Window.partitionBy(*keys).orderBy("unix_time_seconds").rangeBetween(-width, -1)
            e = e.withColumn(f"{prefix}_txn_count_{label}", F.count(F.lit(1)).over(w))
            e = e.withColumn(f"{prefix}_original_amount_avg_{label}",
                             decimal_avg(F.sum(amount).over(w), F.count(amount).over(w)))
            if full:
                e = e.withColumn(f"{prefix}_original_amount_sum_{label}", F.sum(amount).over(w))
                e = e.withColumn(f"{prefix}_original_amount_max_{label}", F.max(amount).over(w))
    return e.select(*features.FEATURE_COLUMNS)

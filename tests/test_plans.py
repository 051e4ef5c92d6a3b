"""Physical-plan guards: the properties the scale design relies on."""

from helpers import SF001
from ledgerlake.plans.models import Models


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_top1_is_limited_before_the_shuffle(spark):
    p = _plan(Models(spark, SF001).stg_transactions)
    assert "WindowGroupLimit" in p and "Partial" in p and "Final" in p


def test_scans_are_pruned(spark):
    p = _plan(Models(spark, SF001).mart_kpi_daily)
    # events is read with only the columns the chain needs (no props column)
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,user_id:bigint,event_type:string,value:double>" in p
    assert "props" not in p.split("events.parquet")[1].split("ReadSchema")[1].split("\n")[0]


def _partitionings(plan):
    import re
    return [re.sub(r"#\d+L?", "", x) for x in re.findall(r"hashpartitioning\(([^\n]*?), \d+\)", plan)]


def test_asof_and_scd2_facts_are_dealt_by_key_and_bucket(spark):
    m = Models(spark, SF001)
    stg, fx, uh, dd = m.stg_transactions, m.stg_fx_rates, m.dim_users_history, m.dim_date
    from ledgerlake.plans import facts
    for df in (facts.int_transactions_fx_enriched(stg, fx), facts.fct_transactions(
            facts.int_transactions_fx_enriched(stg, fx), uh, dd)):
        p = _plan(df)
        parts = _partitionings(p)
        # the union of both sides is dealt by (key, bucket), never by the bare key or currency
        assert any(x.replace(" ", "") == "__k,__b" for x in parts), parts
        assert "currency" not in parts, parts
        assert "CartesianProduct" not in p and "NestedLoop" not in p


def test_feature_windows_are_dealt_by_bucket(spark):
    m = Models(spark, SF001)
    parts = _partitionings(_plan(m.fraud_features))
    for keys in ("user_id", "merchant_name", "user_id, merchant_name"):
        for b in ("__b", "__lb"):
            assert f"{keys}, {b}" in parts, (keys, b, parts)


def test_no_python_in_the_hot_path(spark):
    m = Models(spark, SF001)
    for name in ("stg_transactions", "int_transactions_fx_enriched", "fct_transactions", "mart_kpi_daily",
                 "mart_kpi_user_segments_daily", "fraud_features"):
        p = _plan(getattr(m, name))
        assert "EvalPython" not in p and "PythonUDF" not in p and "MapInPandas" not in p, name

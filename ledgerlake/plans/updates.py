"""MD26: sampled keyed update of the user dimension, emitted as change rows.

The reference picks 1 % of users at random, picks one of city/job/zip for
the run and writes a random new value per user into the operational table,
from where change capture lands a new change-log row.  Here the same change
rows are produced directly: the sample is the reproducible hash top-n (SL1),
field and values come from salted hashes (FR1), and the rows have the raw
change-log schema so they can be appended to the log that feeds MD4.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.operators.topk import sample_hash, sample_top_n

UPDATE_FRACTION = 0.01
UPDATABLE_FIELDS = ["city", "job", "zip"]
# The value pools of the user-update job.
CITIES = [
    "New York", "Los Angeles", "Chicago", "Houston", "Phoenix",
    "Philadelphia", "San Antonio", "San Diego", "Dallas", "San Jose",
    "Austin", "Jacksonville", "San Francisco", "Columbus", "Fort Worth",
    "Charlotte", "Seattle", "Denver", "Boston", "El Paso",
    "Detroit", "Nashville", "Portland", "Oklahoma City", "Las Vegas",
    "Memphis", "Louisville", "Baltimore", "Milwaukee", "Albuquerque",
]
JOBS = [
    "Software Engineer", "Data Scientist", "Product Manager", "Marketing Manager",
    "Sales Representative", "Accountant", "Teacher", "Nurse", "Doctor",
    "Lawyer", "Consultant", "Designer", "Analyst", "Manager", "Director",
    "Engineer", "Developer", "Architect", "Administrator", "Specialist",
    "Coordinator", "Assistant", "Executive", "Supervisor", "Technician",
]
RAW_USER_COLUMNS = ["_airbyte_emitted_at", "_ab_cdc_updated_at", "user_id", "first_name", "last_name", "gender",
                    "street", "city", "zip", "lat", "long", "dob", "job"]


def _h(key: Column, salt: str, n: int) -> Column:
    return F.pmod(sample_hash(key, salt), F.lit(n)).cast("int")


def update_field(salt: str) -> str:
    """The run's field (one per run, like the reference's random choice)."""
    return UPDATABLE_FIELDS[sum(map(ord, salt)) % len(UPDATABLE_FIELDS)]


def user_update_changes(raw_users: DataFrame, run_ts: str, salt: str,
                        fraction: float = UPDATE_FRACTION) -> DataFrame:
    """Change rows for one update run at ``run_ts`` (ISO UTC)."""
    latest_w = raw_users.withColumn("__vt", F.coalesce(F.try_to_timestamp("_ab_cdc_updated_at"),
                                                       F.col("_airbyte_emitted_at")))
    from ledgerlake.operators.topk import latest_per_key
    current = latest_per_key(latest_w, ["user_id"], [F.col("__vt").desc()]).drop("__vt")
    picked = sample_top_n(current, "user_id", fraction, salt)
    field = update_field(salt)
    key = F.col("user_id")
    new_value = {
        "city": F.element_at(F.array(*[F.lit(c) for c in CITIES]), _h(key, salt + "v", len(CITIES)) + 1),
        "job": F.element_at(F.array(*[F.lit(j) for j in JOBS]), _h(key, salt + "v", len(JOBS)) + 1),
        "zip": (_h(key, salt + "v", 90000) + 10000),
    }[field]
    out = picked.withColumn(field, new_value.cast(picked.schema[field].dataType))
    ts = F.lit(run_ts).cast("timestamp")
    return out.select(
        ts.alias("_airbyte_emitted_at"),
        F.concat(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("+00:00")).alias("_ab_cdc_updated_at"),
        *RAW_USER_COLUMNS[2:])

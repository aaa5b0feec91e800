"""Full-row duplicates, counted exactly without shuffling every wide row.

First a 64-bit hash of each row is counted: a row whose hash is unique is unique. Only rows that share a hash are
compared in full, with a pre-aggregated count, so a row copied a billion times is one row per map task. Where the repeated
hashes are too many to broadcast, a sieve of them keeps the other rows out of the shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.operators.keys import repeated_keys
from ledgerline.operators.lookup import lookup
from ledgerline.session import materialise


def duplicate_rows(rows: DataFrame) -> DataFrame:
    """One row: `duplicate_rows`, the number of rows beyond the first of each group of equal rows."""
    columns = rows.columns
    hashed = rows.withColumn("_hash", F.xxhash64(*columns))
    suspects = materialise(repeated_keys(hashed, "_hash").select("_hash"))
    groups = lookup(hashed, suspects, "_hash", sparse=True).groupBy(*columns).agg(F.count(F.lit(1)).alias("_copies"))
    return groups.agg(F.coalesce(F.sum(F.col("_copies") - 1), F.lit(0)).alias("duplicate_rows"))

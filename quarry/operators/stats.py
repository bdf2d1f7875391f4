"""Dataset statistics: per-role counts and bytes, split sizes, packing totals.

All are single aggregations with map-side partial aggregation; the shuffled
partials are one row per group per task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def split_stats(df: DataFrame, split_col: str = "split") -> DataFrame:
    return df.groupBy(split_col).agg(F.count(F.lit(1)).alias("n"))


def role_counts(df: DataFrame, role_col: str = "role") -> DataFrame:
    """Per-role record count plus a grand total row (role = null)."""
    return df.rollup(role_col).agg(F.count(F.lit(1)).alias("records"))


def dataset_stats(lines: DataFrame, role_col: str = "role", line_col: str = "line") -> DataFrame:
    """Per role: records, bytes on disk (UTF-8 line + newline), and a total row
    whose ``datasets`` is the number of roles with records.

    ``lines`` holds one serialised record per row, as written to JSONL.
    """
    roles = lines.groupBy(role_col).agg(
        F.count(F.lit(1)).alias("records"),
        F.sum(F.octet_length(F.col(line_col)) + 1).cast("long").alias("bytes"),
    )
    # Only the rows of the roles are expanded for the total.
    return roles.rollup(role_col).agg(
        F.sum("records").alias("records"), F.sum("bytes").alias("bytes"), F.count(role_col).alias("datasets")
    )

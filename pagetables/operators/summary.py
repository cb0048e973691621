"""Group counts, flag counts, top values, presence counts and run summaries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagetables.functions.text import NO_LINK


def count_by_group(df: DataFrame, group: str, limit: int | None = None) -> DataFrame:
    """Rows per group, largest first; ties by name. ``limit`` cuts a report to its length."""
    counts = df.groupBy(group).agg(F.count("*").alias("n")).orderBy(F.desc("n"), group)
    return counts if limit is None else counts.limit(limit)


def group_remainder(df: DataFrame, group: str, shown: int = 10) -> DataFrame:
    """How many groups a report of ``shown`` groups leaves out: ``n_more``."""
    groups = df.select(group).distinct()
    return groups.agg(F.greatest(F.count("*") - shown, F.lit(0)).cast("bigint").alias("n_more"))


def flag_counts(df: DataFrame, **flags: str) -> DataFrame:
    """``total`` and, per ``name=column``, how many rows say Yes."""
    return df.agg(
        F.count("*").alias("total"),
        *[F.count_if(F.col(c) == "Yes").alias(name) for name, c in flags.items()],
    )


def top_values(df: DataFrame, column: str, n: int = 5) -> DataFrame:
    """The ``n`` most frequent values, blank ones then hidden (so fewer may remain)."""
    top = df.groupBy(column).agg(F.count("*").alias("n")).orderBy(F.desc("n"), column).limit(n)
    return top.filter(F.col(column) != "")


def entries(c: Column) -> Column:
    """Length of a list or map, 0 for NULL."""
    return F.coalesce(F.size(c), F.lit(0)).cast("bigint")


def section_presence(profiles: DataFrame, sections: dict[str, Column]) -> DataFrame:
    """``profiles`` and, per section, how many profiles have it and its total entries."""
    cols = []
    for name, c in sections.items():
        cols.append(F.count_if(entries(c) > 0).alias(f"with_{name}"))
        cols.append(F.coalesce(F.sum(entries(c)), F.lit(0)).cast("bigint").alias(f"{name}_entries"))
    return profiles.agg(F.count("*").alias("profiles"), *cols)


def section_sizes(profiles: DataFrame, keys: Sequence[str], sections: dict[str, Column]) -> DataFrame:
    """Entries per profile and section: ``keys, n_<section>``."""
    return profiles.select(*keys, *[entries(c).alias(f"n_{name}") for name, c in sections.items()])


def harvest_totals(listing: DataFrame, group: str, dim: DataFrame, name: str = "name", url: str = "Manage_URL") -> DataFrame:
    """``records, groups_seen, groups_empty, no_link``.

    Rows are first counted per group, so the distinct count is over groups, not rows.
    """
    per_group = listing.groupBy(F.col(group).alias(name)).agg(
        F.count("*").alias("n"), F.count_if(F.col(url) == NO_LINK).alias("no_link")
    )
    return (
        dim.select(name)
        .distinct()
        .withColumn("_dim", F.lit(True))
        .join(per_group, name, "full")
        .agg(
            F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("records"),
            F.count_if(F.col("n").isNotNull()).alias("groups_seen"),
            F.count_if(F.col("_dim") & F.col("n").isNull()).alias("groups_empty"),
            F.coalesce(F.sum("no_link"), F.lit(0)).cast("bigint").alias("no_link"),
        )
    )


def run_summary(steps: DataFrame, run: str, phase: str, failed: Column, started: str, ended: str) -> DataFrame:
    """Per run: completed and failed steps (count and phases) and the duration in seconds."""
    return steps.groupBy(run).agg(
        F.count_if(~failed).alias("completed"),
        F.count_if(failed).alias("failed"),
        F.array_sort(F.collect_set(F.when(~failed, F.col(phase)))).alias("completed_phases"),
        F.array_sort(F.collect_set(F.when(failed, F.col(phase)))).alias("failed_phases"),
        (F.unix_timestamp(F.max(ended)) - F.unix_timestamp(F.min(started))).alias("seconds"),
    )

"""Progress, status and completeness."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagetables.functions.text import first_truthy, percent


def progress(processed: Column, total: Column, errors: Column) -> list[Column]:
    """Progress columns: ``processed, total, percent, is_complete``."""
    return [
        processed.cast("bigint").alias("processed"),
        total.cast("bigint").alias("total"),
        percent(processed, total).alias("percent"),
        ((errors == 0) & (processed == total)).alias("is_complete"),
    ]


def retirable(log: DataFrame, keys: Sequence[str], need_all: bool = False) -> DataFrame:
    """Whether a run's saved state may go, by its newest progress row: ``keys, batch_id, may_retire``.

    It may once there are no errors, and with ``need_all`` only if everything is processed too.
    """
    fields = ["processed", "total", "errors"]
    last = log.groupBy(*keys).agg(F.max("batch_id").alias("batch_id"), F.max_by(F.struct(*fields), "batch_id").alias("p"))
    clean = F.col("p.errors") == 0
    done = clean & (F.col("p.processed") == F.col("p.total")) if need_all else clean
    return last.select(*keys, "batch_id", F.coalesce(done, F.lit(False)).alias("may_retire"))


def latest_progress(rows: DataFrame, keys: Sequence[str], time: str = "timestamp") -> DataFrame:
    """Newest progress row per key; blank or zero counters fall back to 0, a missing time to 'Unknown'."""
    fields = ["processed", "total", "cursor", time]
    zero = F.lit(0).cast("bigint")
    last = rows.groupBy(*keys).agg(F.max_by(F.struct(*fields), F.coalesce(F.col(time), F.lit(""))).alias("p"))
    total = first_truthy(F.col("p.total"), default=zero)
    return last.select(
        *keys,
        first_truthy(F.col("p.processed"), default=zero).alias("processed"),
        total.alias("total"),
        percent(first_truthy(F.col("p.cursor"), default=zero), total).alias("percent"),
        first_truthy(F.col(f"p.{time}"), default=F.lit("Unknown")).alias(time),
    )


def ready_datasets(registry: DataFrame, counts: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Whether each dataset may run: it depends on nothing, or that output has records.

    ``registry(keys, phase, depends_on, ...)``, ``counts(keys, phase, records)``.
    """
    have = counts.select(*keys, F.col("phase").alias("depends_on"), F.col("records").alias("_n"))
    return registry.join(have, [*keys, "depends_on"], "left").select(
        *registry.columns,
        (F.col("depends_on").isNull() | (F.coalesce("_n", F.lit(0)) > 0)).alias("ready"),
    )


def status_board(registry: DataFrame, counts: DataFrame, progress: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Add ``status`` and ``records`` to the registry.

    An output is Partial while its progress is below 100 %, else Complete; progress without
    output is Paused with what is processed; neither is Pending.
    """
    on = [*keys, "phase"]
    c = counts.select(*on, F.col("records").alias("_n"))
    p = progress.select(*on, F.col("percent").alias("_pct"), F.col("processed").alias("_done"))
    return (
        registry.join(c, on, "left")
        .join(p, on, "left")
        .select(
            *registry.columns,
            F.when(F.col("_n").isNotNull(), F.when(F.col("_pct") < 100, "Partial").otherwise("Complete"))
            .when(F.col("_pct").isNotNull(), "Paused")
            .otherwise("Pending")
            .alias("status"),
            F.coalesce("_n", "_done", F.lit(0)).cast("bigint").alias("records"),
        )
    )


def completeness(dim: DataFrame, listing: DataFrame, claims: DataFrame, key: str) -> DataFrame:
    """Rows seen per group against what the pager claims: ``dim columns, claimed, seen, verdict``.

    Nothing seen is ``empty`` when nothing is claimed, else ``suspicious``; fewer rows than
    claimed are ``short``, otherwise the group is ``complete``. A pager that cannot be read
    leaves ``claimed`` NULL and the verdict ``unparsed``.
    """
    seen = listing.groupBy(key).agg(F.count("*").alias("seen"))
    n = F.coalesce("seen", F.lit(0)).cast("bigint")
    claimed = F.col("claimed")
    return (
        dim.join(claims.select(key, "claimed"), key, "left")
        .join(seen, key, "left")
        .select(
            *dim.columns,
            claimed,
            n.alias("seen"),
            F.when(claimed.isNull(), "unparsed")
            .when((n == 0) & (claimed == 0), "empty")
            .when(n == 0, "suspicious")
            .when(n < claimed, "short")
            .otherwise("complete")
            .alias("verdict"),
        )
    )


def claimed_totals(pagers: DataFrame, key: str) -> DataFrame:
    """Largest total a group's pagers claim, NULL if none can be read: ``key, claimed``."""
    return pagers.groupBy(key).agg(F.max(F.when(F.col("pager.parsed"), F.col("pager.total"))).alias("claimed"))

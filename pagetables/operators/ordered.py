"""Running totals, numbering and stability, without one task per group.

A group may be far larger than a task. Rows therefore come with a ``block``: a coarse,
order-preserving part of the group (a page number, a range of the order). Blocks are small, so
windows run inside them, and only one summary row per block travels across blocks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pagetables.sources.stage import staged

FAN = 4096  # blocks, or sums of blocks, that one window sees


def prefix_sums(totals: DataFrame, group: Sequence[str], block: str, n: str, out: str) -> DataFrame:
    """Add ``out``: the sum of ``n`` over all earlier blocks of the group.

    The blocks, numbered from 0, are the leaves of a tree in which ``FAN`` neighbours have one parent, as high as
    their numbers ask for. A block's sum is what lies before it under its parent, before that under the
    next, and so on; every window has at most ``FAN`` rows. Give ``totals`` that are staged: they are read once a level.
    """
    group = list(group)
    most = totals.agg(F.max(block)).first()[0] or 0
    level = totals.select(*group, F.col(block).cast("bigint").alias("_at"), F.col(n).alias("_n"))
    levels: list[DataFrame] = []
    while True:
        level = level.withColumn("_up", F.expr(f"_at div {FAN}"))
        before = Window.partitionBy(*group, "_up").orderBy("_at").rowsBetween(Window.unboundedPreceding, -1)
        levels.append(level.select(*group, "_at", "_up", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_sum")))
        if most < FAN:
            break
        most //= FAN
        level = level.groupBy(*group, F.col("_up").alias("_at")).agg(F.sum("_n").alias("_n"))
    found = levels.pop()
    while levels:
        above = found.select(*group, F.col("_at").alias("_up"), F.col("_sum").alias("_above"))
        found = levels.pop().join(above, [*group, "_up"]).select(*group, "_at", "_up", (F.col("_sum") + F.col("_above")).alias("_sum"))
    sums = found.select(*group, F.col("_at").alias("_block"), F.col("_sum").cast("bigint").alias(out))
    return totals.withColumn("_block", F.col(block).cast("bigint")).join(sums, [*group, "_block"]).drop("_block")


def running_total(df: DataFrame, block: str = "page_no", group: Sequence[str] = ()) -> DataFrame:
    """New rows per page and the total so far: ``group, block, n_new, running``."""
    counts = staged(df.groupBy(*group, block).agg(F.count("*").alias("n_new")))
    return prefix_sums(counts, group, block, "n_new", "_before").select(
        *group, block, "n_new", (F.col("_before") + F.col("n_new")).alias("running")
    )


def row_numbers(df: DataFrame, group: Sequence[str], block: str, order: Sequence[str]) -> DataFrame:
    """Add ``position``, the row's number in its group from 0. The rows are read once and staged with their number in the block."""
    keys = [*group, block]
    w = Window.partitionBy(*keys).orderBy(*order)
    ranked = staged(df.withColumn("_rank", F.row_number().over(w) - 1))
    counts = staged(ranked.groupBy(*keys).agg(F.count("*").alias("_n")))
    offsets = prefix_sums(counts, group, block, "_n", "_before").select(*keys, "_before")
    return (
        ranked.join(offsets, keys)
        .withColumn("position", (F.col("_rank") + F.col("_before")).cast("bigint"))
        .drop("_rank", "_before")
    )


def batch_ids(df: DataFrame, group: Sequence[str], block: str, order: Sequence[str], size: int = 50) -> DataFrame:
    """Add ``batch``: every ``size`` rows of a group close one."""
    return (
        row_numbers(df, group, block, order)
        .withColumn("batch", F.floor(F.col("position") / size).cast("bigint"))
        .drop("position")
    )


def order_blocks(df: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """Add ``_block``: consecutive ranges of key and order whose bounds are quantiles of a sample.

    A key with many rows spans several blocks and small keys share one, so no block grows with a key. The number of blocks is that
    of the session's shuffle partitions. Staged, since everything after relies on the same bounds.
    """
    ranged = df.repartitionByRange(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), key, *order)
    return staged(ranged.withColumn("_block", F.spark_partition_id()))


def _with_history(polls: DataFrame, key: str, order: Sequence[str], k: int) -> DataFrame:
    """Add ``history``: the ``k`` earlier counts of the same page, oldest first; ``polls`` has ``_block``."""
    at = F.struct(*order, "n")
    tails = (
        polls.withColumn(
            "_back",
            F.row_number().over(Window.partitionBy(key, "_block").orderBy(*[F.col(c).desc() for c in order])),
        )
        .filter(F.col("_back") <= k)
        .groupBy(key, "_block")
        .agg(F.array_sort(F.collect_list(at)).alias("_tail"))
    )
    # every block has at least one read, so the k blocks before hold the k reads before
    blocks = Window.partitionBy(key).orderBy("_block").rowsBetween(-k, -1)
    carried = tails.select(
        key, "_block", F.transform(F.flatten(F.collect_list("_tail").over(blocks)), lambda r: r["n"]).alias("_carried")
    )
    w = Window.partitionBy(key, "_block").orderBy(*order).rowsBetween(-k, -1)
    both = F.concat(F.col("_carried"), F.col("_own"))
    return (
        polls.withColumn("_own", F.collect_list("n").over(w))
        .join(carried, [key, "_block"])
        .withColumn("history", F.slice(both, F.greatest(F.size(both) - k + 1, F.lit(1)), k))
        .drop("_block", "_own", "_carried")
    )


def first_stable(
    polls: DataFrame,
    key: str,
    order: Sequence[str],
    block: Column | None = None,
    k: int = 2,
    last_read: bool = False,
) -> DataFrame:
    """The read at which a page's row count ``n`` is stable.

    Stable means above zero and equal to the ``k`` reads before it, so ``k = 2`` takes three
    equal reads. The result has the columns of ``polls`` and one row per page that becomes
    stable; with ``last_read`` a page that never does gives its last read, as at a timeout,
    and ``stable`` tells which is which. ``block`` may name an order-preserving part of each page's reads; without it
    parts are found by sampling, so a page with a third of all reads is split too.
    """
    equal = F.forall("history", lambda h: h == F.col("n"))
    stable = (F.col("n") > 0) & (F.size("history") == k) & equal
    cols = [c for c in polls.columns if c != key]
    parted = order_blocks(polls, key, order) if block is None else polls.withColumn("_block", block)
    marked = _with_history(parted, key, order, k).withColumn("stable", stable)
    picked = marked.groupBy(key).agg(
        F.min_by(F.struct(*cols), F.when(F.col("stable"), F.struct(*order))).alias("first"),
        F.max_by(F.struct(*cols), F.struct(*order)).alias("last"),
    )
    if not last_read:
        return picked.filter(F.col("first").isNotNull()).select(key, "first.*")
    return picked.select(
        key, F.coalesce("first", "last").alias("r"), F.col("first").isNotNull().alias("stable")
    ).select(key, "r.*", "stable")


def classify_attempts(polls: DataFrame, key: str, order: Sequence[str], retries: int = 3) -> DataFrame:
    """Outcome of the first attempt and up to ``retries`` more: ``key, outcome, retries``.

    Only the attempts that count leave a task, however many a page has.
    """
    w = Window.partitionBy(key).orderBy(*order)
    tries = polls.withColumn("_a", F.row_number().over(w)).filter(F.col("_a") <= retries + 1)
    hit = tries.groupBy(key).agg(F.min(F.when(F.col("n") > 0, F.col("_a"))).alias("_hit"))
    return hit.select(
        key,
        F.when(F.col("_hit").isNull(), "empty").when(F.col("_hit") == 1, "ok").otherwise("ok_after_retry").alias("outcome"),
        F.coalesce(F.col("_hit") - 1, F.lit(retries)).cast("bigint").alias("retries"),
    )

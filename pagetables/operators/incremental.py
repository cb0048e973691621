"""Keeping a master table up to date: first-wins, append, resume, replace, re-visit."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pagetables.functions.text import NO_LINK, parse_int_list


def keep_first(
    df: DataFrame, key: str, order: Sequence[str | Column], collapse_missing: bool = True
) -> DataFrame:
    """First row per key in the given order.

    Every task cuts its rows to one per key before the exchange, so a key with very many
    copies costs no more than any other. All rows without a link share the key
    'Not Found' and collapse to one; ``collapse_missing=False`` keeps them all.
    """
    w = Window.partitionBy(key).orderBy(*order)

    def first(rows: DataFrame) -> DataFrame:
        return rows.withColumn("_rank", F.row_number().over(w)).filter(F.col("_rank") == 1).drop("_rank")

    if collapse_missing:
        return first(df)
    missing = F.coalesce(F.col(key), F.lit(NO_LINK)) == NO_LINK
    return first(df.filter(~missing)).unionByName(df.filter(missing))


def append_new(
    existing: DataFrame, batch: DataFrame, key: str, order: Sequence[str | Column], collapse_missing: bool = True
) -> DataFrame:
    """Rows of the batch whose key is not there yet, first one of each key.

    The existing keys are made distinct before the join, so both sides carry each key once.
    """
    fresh = keep_first(batch, key, order, collapse_missing)
    known = existing.select(key).distinct()
    if not collapse_missing:
        known = known.filter(F.coalesce(F.col(key), F.lit(NO_LINK)) != NO_LINK)
    return fresh.join(known, key, "left_anti")


def pending(master: DataFrame, key: str, *handled: DataFrame) -> DataFrame:
    """Master rows that no run has handled yet, whether with a result or an error."""
    out = master
    for done in handled:
        out = out.join(done.select(key).distinct(), key, "left_anti")
    return out


def replace_groups(master: DataFrame, fresh: DataFrame, group: str, revisited: DataFrame | None = None) -> DataFrame:
    """Drop every row of a re-visited group and add the fresh ones.

    ``revisited`` names the groups (column ``group``); without it they are the groups that
    have fresh rows.
    """
    groups = (fresh if revisited is None else revisited).select(group).distinct()
    return master.join(groups, group, "left_anti").unionByName(fresh)


def removed_counts(master: DataFrame, revisited: DataFrame, group: str) -> DataFrame:
    """How many old rows a replacement drops, per group: ``group, removed``."""
    counts = master.groupBy(group).agg(F.count("*").alias("removed"))
    return counts.join(revisited.select(group).distinct(), group, "left_semi")


def empty_groups(
    dim: DataFrame, listing: DataFrame, group: str, name: str = "name", resolved: DataFrame | None = None
) -> DataFrame:
    """Groups without rows, with the reason.

    A group that could not be chosen (absent from ``resolved``) has ``selection_failed``,
    any other ``no_data``.
    """
    seen = listing.select(F.col(group).alias(name)).distinct()
    empty = dim.join(seen, name, "left_anti")
    if resolved is None:
        return empty.withColumn("reason", F.lit("no_data"))
    chosen = resolved.select(name).distinct().withColumn("_ok", F.lit(True))
    return empty.join(chosen, name, "left").select(
        *dim.columns, F.when(F.col("_ok"), "no_data").otherwise("selection_failed").alias("reason")
    )


def still_empty(empties: DataFrame, fresh: DataFrame, group: str, name: str = "name") -> DataFrame:
    """Empty groups, re-visited or not, that the fresh rows do not fill."""
    return empties.join(fresh.select(F.col(group).alias(name)).distinct(), name, "left_anti")


def pick_empty(empties: DataFrame, requests: DataFrame, choice: str, keys: Sequence[str]) -> DataFrame:
    """Chosen display numbers -> empty groups: ``keys, display_no, name, unknown``.

    A choice is a comma list of numbers (a group's index + 1); a choice with any bad item
    is dropped as a whole, a number that is no empty group is reported as unknown.
    """
    chosen = requests.select(*keys, F.explode(parse_int_list(F.col(choice))).alias("display_no"))
    targets = empties.select((F.col("idx") + 1).alias("display_no"), "name")
    return chosen.join(targets, "display_no", "left").select(
        *keys, "display_no", "name", F.col("name").isNull().alias("unknown")
    )


def grams(c: Column, n: int) -> Column:
    """The distinct runs of ``n`` characters of a text, at most as many as it has characters; none if it is shorter."""
    starts = F.when(F.length(c) >= n, F.sequence(F.lit(1), F.length(c) - (n - 1)))
    return F.array_distinct(F.transform(starts, lambda i: F.substr(c, i, F.lit(n))))


def _held(parts: DataFrame, wholes: DataFrame, keys: list[str], n: int) -> DataFrame:
    """All ``keys, part, whole`` where the text ``whole`` contains ``part``, without comparing all pairs.

    A part of ``n`` characters or more is looked up by its run of characters that is rarest among the wholes and then
    compared; a shorter one is such a run itself.
    """
    index = wholes.select(*keys, "whole", F.explode(grams(F.col("whole"), n)).alias("_gram"))
    counts = index.groupBy(*keys, "_gram").agg(F.count("*").alias("_n"))
    own = parts.filter(F.length("part") >= n).select(*keys, "part", F.explode(grams(F.col("part"), n)).alias("_gram"))
    # a run that no whole has is the rarest of all, and finds none
    rare = own.join(counts, [*keys, "_gram"], "left").groupBy(*keys, "part").agg(
        F.min_by("_gram", F.struct(F.coalesce("_n", F.lit(0)), "_gram")).alias("_gram")
    )
    found = rare.join(index, [*keys, "_gram"]).filter(F.col("whole").contains(F.col("part"))).select(*keys, "part", "whole")
    for short in range(1, n):
        runs = wholes.select(*keys, "whole", F.explode(grams(F.col("whole"), short)).alias("part"))
        found = found.unionByName(parts.filter(F.length("part") == short).join(runs, [*keys, "part"]).select(*keys, "part", "whole"))
    return found


def resolve_option(
    targets: DataFrame, options: DataFrame, keys: Sequence[str] = (), both_ways: bool = True, n: int = 3
) -> DataFrame:
    """First option that contains the target's name, or (``both_ways``) lies within it.

    ``targets(keys, target)`` and ``options(keys, idx, name)`` give ``keys, target, chosen``,
    NULL where nothing matches. A name of any length makes at most as many index rows as it has characters for each
    run length up to ``n``. Names that are equal count once, as the earliest.
    """
    keys = list(keys)
    first = options.filter(F.col("name") != "").groupBy(*keys, "name").agg(F.min("idx").alias("idx"))
    names = targets.select(*keys, "target").distinct()
    wanted = names.filter(F.col("target") != "")
    hits = _held(wanted.withColumnRenamed("target", "part"), first.select(*keys, F.col("name").alias("whole")), keys, n)
    hits = hits.select(*keys, F.col("part").alias("target"), F.col("whole").alias("name"))
    if both_ways:
        within = _held(first.select(*keys, F.col("name").alias("part")), wanted.withColumnRenamed("target", "whole"), keys, n)
        hits = hits.unionByName(within.select(*keys, F.col("whole").alias("target"), F.col("part").alias("name")))
    best = F.min(F.struct("idx", "name")).alias("hit")
    chosen = hits.join(first, [*keys, "name"]).groupBy(*keys, "target").agg(best)
    return names.join(chosen, [*keys, "target"], "left").select(*keys, "target", F.col("hit.name").alias("chosen"))

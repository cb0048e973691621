"""Exact duplicates by a tree of merges over sorted digest runs, in DataFrame operations only.

Every row belongs to a run by a hash of its identifier and text, with as many runs as the input has partitions, so a run is as
large as a partition however much there is. A run holds each digest once, with its smallest
identifier and its number of rows. Round by round, ``fan_in`` neighbouring runs are merged into one, until one
run is left; a level keeps the smallest identifier of what it merges. The result goes back down the same tree,
so a group that holds a third of all rows never meets in one task: on every level a digest has at most one row
per run, and the rows themselves meet only the row of their own run.

Two texts are taken as equal when SHA-256, length and a second 64-bit hash of the normalised text all agree.
Null texts count as empty. Rows without identifier come after all others: they keep only among themselves,
with a null ``keep_id``. Of rows that repeat the smallest identifier, exactly one stays. An empty table gives an
empty result; further columns of the input are ignored unless asked for by ``carry``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pagetables.llm.common import cut

FAN_IN = 8
KEY = ["_digest", "_length", "_check"]


def normalized(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", " ")


def n_runs(docs: DataFrame) -> int:
    """Partitions of the input that hold rows, one at least."""
    return max(1, docs.select(F.spark_partition_id().alias("_at")).distinct().count())


def digests(docs: DataFrame, columns: list[Column], id_col: str, text_col: str, runs: int) -> DataFrame:
    """``columns`` plus id, run and the three parts of the key. The text is normalised once, in a step of its own."""
    row = docs.select(*columns, F.col(id_col).alias("_id"), normalized(F.col(text_col)).alias("_norm"))
    return row.select(
        *[c for c in row.columns if c != "_norm"],
        F.unhex(F.sha2("_norm", 256)).alias("_digest"),
        F.length("_norm").alias("_length"),
        F.xxhash64("_norm").alias("_check"),
    ).withColumn("_run", F.pmod(F.xxhash64("_id", "_check"), F.lit(runs)).cast("int"))


def merge_tree(rows: DataFrame, runs: int, fan_in: int) -> DataFrame:
    """``_run``, key, ``keep_id``, ``group_size``: the whole group's result for every digest of every first run."""
    level = rows.groupBy("_run", *KEY).agg(F.min("_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
    levels, width = [level], runs
    while width > 1:
        width = -(-width // fan_in)
        level = level.groupBy((F.col("_run") / fan_in).cast("int").alias("_run"), *KEY).agg(
            F.min("keep_id").alias("keep_id"), F.sum("group_size").alias("group_size")
        )
        levels.append(level)
    result = levels.pop()
    for below in reversed(levels):
        below = below.select("_run", *KEY, (F.col("_run") / fan_in).cast("int").alias("_up"))
        result = below.join(result.withColumnRenamed("_run", "_up"), ["_up", *KEY]).drop("_up")
    return result


def exact_groups(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", carry: list[str] | None = None,
    runs: int | None = None, fan_in: int = FAN_IN,
) -> DataFrame:
    """One row per row of ``docs``: ``carry`` (the id by default), ``keep_id, group_size, kept, text_sha256``."""
    names = [id_col] if carry is None else carry
    runs = runs or n_runs(docs)
    # Carried columns travel under names of their own, so none can clash with the columns made here.
    own = [F.col(f"`{c}`").alias(f"_c{i}") for i, c in enumerate(names)]
    light = cut(digests(docs, [], id_col, text_col, runs))
    found = merge_tree(light, runs, fan_in)
    rows = light.withColumn("_c0", F.col("_id")) if carry is None else digests(docs, own, id_col, text_col, runs)
    marked = rows.join(found, ["_run", *KEY])
    first = F.row_number().over(Window.partitionBy("_run", *KEY, "_id").orderBy(F.lit(0)))
    # Rows without identifier that are equal are in one run, so the row number alone decides.
    return marked.select(
        *[F.col(f"_c{i}").alias(c) for i, c in enumerate(names)],
        "keep_id",
        "group_size",
        (F.col("_id").eqNullSafe(F.col("keep_id")) & (first == 1)).alias("kept"),
        F.lower(F.hex("_digest")).alias("text_sha256"),
    )


def stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: one document of every group of equal texts stays, the one with the smallest identifier.

    Null texts are empty ones and equal to each other. Of rows that repeat the smallest identifier, or if no row of the
    group has one, exactly one stays. An empty table stays empty; columns of any name come through unchanged.
    """
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), "doc_id", "text")
    return exact_groups(whole, carry=["_row"]).where("kept").select("_row.*")

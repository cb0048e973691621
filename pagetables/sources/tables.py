"""Reading and writing master lists, snapshots, errors, pages and node tables."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pagetables import schema
from pagetables.functions.text import first_truthy, json_text, percent

CORRUPT = "_corrupt_record"


def read_master(spark: SparkSession, path: str, kind: str, multi_line: bool = False) -> DataFrame:
    """Master records from JSON lines, or (``multi_line``) from files that hold one array each.

    Indented arrays, one field to a line, are split among tasks at their records' borders, whatever a file's size; other array
    files are read whole. Unreadable records (or whole array files of the second sort) are left out; ``unreadable`` shows
    them. A missing path is an error.
    """
    df = _json(spark, path, schema.MASTER[kind], multi_line)
    return df.filter(F.col("_bad").isNull()).select(*schema.master_fields(kind))


def unreadable(spark: SparkSession, path: str, kind: str, multi_line: bool = False) -> DataFrame:
    """The texts that ``read_master`` leaves out: ``text``."""
    df = _json(spark, path, schema.MASTER[kind], multi_line)
    return df.filter(F.col("_bad").isNotNull()).select(F.col("_bad").alias("text"))


def _json(spark: SparkSession, path: str, ddl: str, multi_line: bool = False) -> DataFrame:
    """Records with the given fields and ``_bad``, the text where it could not be read.

    The text is parsed in a column, so that any selection of columns may be made of it.
    """
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    border = _border(spark, path) if multi_line else None
    text = _indented(spark, path, border) if border else spark.read.option("wholetext", multi_line).text(path)
    text = text.filter(F.trim("value") != "")
    record = f"struct<{_fields(ddl)}, {CORRUPT}:string>"
    if border or not multi_line:
        parsed = text.select(F.from_json("value", record, options).alias("r"))
        return parsed.select("r.*").withColumnRenamed(CORRUPT, "_bad")
    files = text.select("value", F.from_json("value", f"array<{record}>", options).alias("rs"))
    # an array file is whole or unreadable
    bad = F.col("rs").isNull() | F.exists("rs", lambda r: r.isNull() | r[CORRUPT].isNotNull())
    one = F.array(F.lit(None).cast(record))
    rows = files.select(
        F.when(bad, F.col("value")).alias("_bad"), F.explode(F.when(bad, one).otherwise(F.col("rs"))).alias("r")
    )
    return rows.select("r.*", "_bad").drop(CORRUPT)


def _border(spark: SparkSession, path: str) -> tuple[str, str] | None:
    """End of line and indent of the records of an indented array, None if the first file isn't one.

    A line feed can't stand inside a JSON string, so where a line closes a record at this indent, a record ends.
    """
    head = [r["value"] for r in spark.read.option("lineSep", "\n").text(path).limit(2).collect()]
    found = re.fullmatch(r"([ \t]+)\{(\r?)", head[1]) if len(head) == 2 and head[0].strip() == "[" else None
    return (found[2] + "\n", found[1]) if found else None


def _indented(spark: SparkSession, path: str, border: tuple[str, str]) -> DataFrame:
    """The records of indented arrays, one text each; Spark splits the files at the separator."""
    eol, indent = border
    pieces = spark.read.option("lineSep", f"{eol}{indent}}},{eol}{indent}{{{eol}").text(path)
    inner = F.regexp_replace("value", rf"\A\s*\[{eol}{indent}\{{{eol}", "")
    inner = F.regexp_replace(inner, rf"{eol}{indent}\}}{eol}\]\s*\z", "")
    return pieces.select(F.concat(F.lit("{"), inner, F.lit("}")).alias("value"))


def _fields(ddl: str) -> str:
    return ", ".join(":".join(f.split(" ", 1)) for f in ddl.split(", "))


def _snapshot(spark: SparkSession, path: str, records: str, multi_line: bool) -> DataFrame:
    """Checkpoints with ``_bad``, the text of those that could not be read."""
    counters = [*schema.SNAPSHOT_PROCESSED, *schema.SNAPSHOT_TOTAL, *schema.SNAPSHOT_CURSOR, "errors_count"]
    fields = f"timestamp:string, {', '.join(f'{c}:bigint' for c in counters)}, data:array<struct<{_fields(records)}>>"
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    text = spark.read.option("wholetext", multi_line).text(path).filter(F.trim("value") != "")
    parsed = text.select(F.from_json("value", f"struct<{fields}, {CORRUPT}:string>", options).alias("r"))
    return parsed.select("r.*").withColumnRenamed(CORRUPT, "_bad")


def unreadable_snapshots(spark: SparkSession, path: str, kind: str, multi_line: bool = True) -> DataFrame:
    """The checkpoints that ``read_snapshot`` leaves out: ``text``."""
    files = _snapshot(spark, path, schema.MASTER[kind], multi_line)
    return files.filter(F.col("_bad").isNotNull()).select(F.col("_bad").alias("text"))


def read_snapshot(
    spark: SparkSession, path: str, kind: str, multi_line: bool = True
) -> tuple[DataFrame, DataFrame]:
    """Checkpoints -> (records, progress); one per file, or one per line without ``multi_line``.

    The records are the checkpoints' ``data``; progress has ``processed, total, cursor, errors,
    records, percent, timestamp`` under one name each, whatever the file calls them. Unreadable
    checkpoints are left out; ``unreadable_snapshots`` shows them.
    """
    files = _snapshot(spark, path, schema.MASTER[kind], multi_line).filter(F.col("_bad").isNull())
    zero = F.lit(0).cast("bigint")

    def one_of(names: Sequence[str]) -> Column:
        return first_truthy(*map(F.col, names), default=zero)

    total, cursor = one_of(schema.SNAPSHOT_TOTAL), one_of(schema.SNAPSHOT_CURSOR)
    progress = files.select(
        one_of(schema.SNAPSHOT_PROCESSED).alias("processed"),
        total.alias("total"),
        cursor.alias("cursor"),
        F.coalesce("errors_count", zero).alias("errors"),
        record_count(F.col("data")).alias("records"),
        percent(cursor, total).alias("percent"),
        F.coalesce("timestamp", F.lit("Unknown")).alias("timestamp"),
    )
    return files.select(F.inline("data")), progress


def read_errors(spark: SparkSession, path: str) -> DataFrame:
    """Error rows; none if the path is absent or holds nothing readable."""
    try:
        return _json(spark, path, schema.ERRORS).filter(F.col("_bad").isNull()).drop("_bad")
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in (e.getCondition() or ""):
            raise
        return spark.createDataFrame([], schema.ERRORS)


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """Captured pages ``page_id, url, html``, split by ``spark.sql.files.maxPartitionBytes``."""
    return spark.read.parquet(path)


def record_count(records: Column) -> Column:
    """Length of a stored list, 0 where there is none."""
    return F.coalesce(F.size(records), F.lit(0)).cast("bigint")


def write_records(df: DataFrame, path: str, form: str = "parquet") -> None:
    """Whole result, replacing an earlier one; ``form='json'`` writes UTF-8 JSON lines."""
    df.write.mode("overwrite").format(form).save(path)


def flat(df: DataFrame, order: Sequence[str] | None = None) -> DataFrame:
    """Columns present, in the given order; nested ones as JSON text."""
    names = [c for c in (order or df.columns) if c in df.columns]
    nested = (T.ArrayType, T.MapType, T.StructType)
    return df.select(
        *[json_text(F.col(c)).alias(c) if isinstance(df.schema[c].dataType, nested) else F.col(c) for c in names]
    )


def write_flat(df: DataFrame, path: str, order: Sequence[str] | None = None) -> None:
    """CSV with header. Blank text stays '' and NULL stays NULL."""
    (
        flat(df, order)
        .write.mode("overwrite")
        .options(header=True, escape='"', emptyValue='""', nullValue="")
        .csv(path)
    )


def read_flat(spark: SparkSession, path: str, ddl: str) -> DataFrame:
    return (
        spark.read.schema(ddl)
        .options(header=True, escape='"', emptyValue="", nullValue=None, multiLine=True)
        .csv(path)
    )


def write_batch(df: DataFrame, path: str, batch: int | str) -> None:
    """One batch of records as a partition; writing the same batch again replaces only it."""
    (
        df.withColumn("batch_id", F.lit(batch))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("batch_id")
        .parquet(path)
    )


def write_snapshot(df: DataFrame, progress: DataFrame, path: str, batch: int) -> None:
    """New records of a batch, then its progress row, which commits them. Earlier batches stay as they are."""
    write_batch(df, f"{path}/data", batch)
    write_batch(progress.drop("batch_id"), f"{path}/progress", batch)


def snapshot_log(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """What ``write_snapshot`` committed: (records, progress), both with ``batch_id``.

    The records of a batch that was interrupted before its progress row are left out.
    """
    progress = spark.read.parquet(f"{path}/progress")
    done = progress.select("batch_id").distinct()
    return spark.read.parquet(f"{path}/data").join(done, "batch_id", "left_semi"), progress


def write_errors(df: DataFrame, path: str, run: str) -> None:
    """Error rows of a run as a partition."""
    df.withColumn("run", F.lit(run)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
        "run"
    ).json(path)


def replace_partitions(df: DataFrame, path: str, group: str) -> None:
    """Write the groups that ``df`` holds and leave all others as they are."""
    (
        df.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(group)
        .parquet(path)
    )


def write_nodes(nodes: DataFrame, path: str) -> None:
    """Node table for many extractions: pages are read once, columns and tags pruned at the scan."""
    nodes.sortWithinPartitions("tag").write.mode("overwrite").parquet(path)

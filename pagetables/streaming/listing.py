"""Listing pages that arrive over time -> growing, duplicate-free master tables.

Reading, extraction and the projection to records are one stateless plan. First-wins is a grouped minimum in Spark's
state store: one entry per key, its first record and the times of its batches, so a batch looks up its own
keys and never reads what earlier batches wrote; tasks reduce their rows to one per key before they move. With ``ROCKSDB`` set (``stream_listing`` does so) the entries lie on
disk and only their changes go to the checkpoint.

Expert and facility listings come group by group, and a group may be visited again. A landed page tells its
group and visit, keys count within a visit, and every visit leaves a mark even if its pages have no row.
``current_rows`` shows each group's latest visit, so a group that is visited again replaces itself, also by
nothing, while the others stay.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from pagetables.functions.text import percent, valid_link
from pagetables.operators.grid import table_rows
from pagetables.operators.listing import expert_listing, facility_listing, organization_listing
from pagetables.sources.html import page_trees
from pagetables.sources.tables import write_batch

LISTING_TAGS = ("tr", "td", "a", "span", "input")
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
PLACE = ("page_no", "page_id", "row_pre")


@dataclass(frozen=True)
class Source:
    """How the pages of a kind land, and what groups them."""

    landing: str
    group: tuple[str, ...] = ()


KINDS = {
    "organization": Source("page_id bigint, page_no bigint, html string"),
    "expert": Source("institution string, visit bigint, page_id bigint, page_no bigint, url string, html string", ("institution", "visit")),
    "facility": Source("institution string, visit bigint, page_id bigint, page_no bigint, url string, html string", ("institution", "visit")),
}


def records_of(pages: DataFrame, kind: str) -> DataFrame:
    """Listing pages -> records with their place (and group); nothing is moved."""
    group = KINDS[kind].group
    rows = table_rows(page_trees(pages, (*group, "page_no"), LISTING_TAGS), (*group, "page_id", "page_no"))
    keep = (*group, *PLACE)
    at = F.lit(None).cast("timestamp")
    if kind == "organization":
        return organization_listing(rows, at, keep)
    found = (expert_listing if kind == "expert" else facility_listing)(rows, F.col("institution"), at, keep)
    # the record has an institution of its own, and names don't differ by case alone
    return found.toDF(*["_group" if c == "institution" else c for c in keep], *found.columns[len(keep) :])


def marks_of(pages: DataFrame, like: DataFrame) -> DataFrame:
    """One row without record per landed page, so that a visit shows even without rows."""
    own = {"_group": F.col("institution"), "visit": F.col("visit")}
    return pages.select(*[own.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in like.schema.fields])


def first_of_keys(records: DataFrame, key: tuple[str, ...]) -> DataFrame:
    """The first record of every key that no earlier batch had, by place within a batch (missing places last).

    A key of an earlier batch comes up again with two times of batches; only keys with one are new.
    """
    columns = [f.name for f in records.schema.fields]
    place = [c for c in PLACE if c in columns]
    order = [x for c in place for x in (F.col(c).isNull().alias(f"_no_{c}"), F.col(c))]
    held = F.struct(*order, *[c for c in columns if c not in (*key, *place)])
    timed = records.withColumn("_at", F.current_timestamp())  # in a stream the batch's own, also when it is run again
    found = timed.groupBy(*key).agg(F.min(held).alias("_first"), F.min("_at").alias("_since"), F.max("_at").alias("_until"))
    new = found.where(F.col("_since") == F.col("_until"))
    return new.select(*[F.col(c) if c in key else F.col("_first")[c].alias(c) for c in columns])


def _stored(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """What batches wrote; no row if none did."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in (e.getCondition() or "") or "UNABLE_TO_INFER_SCHEMA" in (e.getCondition() or ""):
            return spark.createDataFrame([], schema)
        raise


def stream_listing(
    spark: SparkSession,
    landing: str,
    out: str,
    checkpoint: str,
    kind: str = "organization",
    max_files: int | None = None,
    total: int = 0,
    key: str = "Manage_URL",
    collapse_missing: bool = True,
) -> StreamingQuery:
    """Take in all landed pages, batch by batch, and stop.

    Each batch adds the first record per key that no other batch holds, so keys of any age are recognised. A batch is
    one partition of ``out/data``; if it is run again after a failure, Spark starts from the state before it, so it
    replaces itself by the same rows. Records without an address are one key, or with
    ``collapse_missing=False`` all kept. ``max_files`` bounds a batch; every batch leaves one row in ``out/progress``.
    """
    source = KINDS[kind]
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    spark.conf.set("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true")
    reader = spark.readStream.schema(source.landing)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    pages = reader.parquet(landing)
    records = records_of(pages, kind)
    group = ("_group", "visit") if source.group else ()
    own = F.col(key)
    if not collapse_missing:
        own = F.when(valid_link(own), own).otherwise(F.concat_ws(" ", F.lit(""), *PLACE))
    records = records.withColumn("_mark", F.lit(False)).withColumn("_key", own)
    if group:
        records = records.unionByName(marks_of(pages, records).withColumn("_mark", F.lit(True)))
    fresh = first_of_keys(records, (*group, "_mark", "_key")).drop("_key")

    def take(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        write_batch(batch if group else batch.drop("_mark"), f"{out}/data", batch_id)
        # the total so far is the last batch's total plus this batch, not a count of everything
        new = _stored(session, f"{out}/data", "batch_id bigint, _mark boolean").filter(F.col("batch_id") == batch_id)
        n = new.filter(~F.col("_mark")).count() if group else new.count()
        before = _stored(session, f"{out}/progress", "batch_id bigint, processed bigint")
        earlier = before.filter(F.col("batch_id") < batch_id).agg(F.max("processed")).first()[0] or 0
        row = session.range(1).select(F.lit(earlier + n).alias("processed"), F.lit(total).cast("bigint").alias("total"))
        counters = row.withColumn("percent", percent(F.col("processed"), F.col("total"))).withColumn("timestamp", F.current_timestamp())
        write_batch(counters, f"{out}/progress", batch_id)

    return (
        fresh.writeStream.foreachBatch(take)
        .outputMode("update")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def current_rows(spark: SparkSession, out: str) -> DataFrame:
    """The records of each group's latest visit, of ``stream_listing`` for a grouped kind."""
    stored = spark.read.parquet(f"{out}/data")
    latest = stored.filter("_mark").groupBy(F.col("_group").alias("_g")).agg(F.max("visit").alias("_v"))
    same = stored["_group"].eqNullSafe(latest["_g"]) & (stored["visit"] == latest["_v"])
    found = stored.filter(~F.col("_mark")).join(latest, same)
    return found.drop("_mark", "_group", "_g", "_v", "batch_id", "visit", *PLACE)

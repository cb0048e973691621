"""Fixed schemas and the registry of datasets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

MASTER = {
    "expert": "Institution string, Name string, Expert_Type string, Position string, Facility string, "
    "Expert_ID string, Manage_URL string, Profile_URL string, Scraped_At timestamp",
    "facility": "Institution string, Branch string, Facility_Name string, Facility_Type string, "
    "Manage_URL string, Scraped_At timestamp",
    "organization": "Organization_Name string, Provinces string, Sectors string, Requests string, "
    "Projects string, Enabled string, Manage_URL string, Scraped_At timestamp",
}
PAGES = "page_id bigint, url string, html string"
ERRORS = "index bigint, name string, institution string, url string, reason string, timestamp timestamp"
PROGRESS = (
    "batch_id bigint, unit string, processed bigint, total bigint, cursor bigint, errors bigint, "
    "percent double, is_complete boolean, timestamp timestamp"
)
# Counters as the source data's checkpoint files name them, differing by dataset.
SNAPSHOT_PROCESSED = (
    "experts_processed", "facilities_processed", "organizations_processed", "organizations_collected",
    "experts_collected", "facilities_collected",
)
SNAPSHOT_TOTAL = ("total_institutions", "total_organizations", "total_items_in_table")
SNAPSHOT_CURSOR = ("current_index", "last_page_scraped")

# phase, name, category, type, depends_on
DATASETS = (
    (1, "Experts Metadata", "Experts", "Metadata", None),
    (2, "Experts Details", "Experts", "Details", 1),
    (3, "Facilities Metadata", "Facilities", "Metadata", None),
    (4, "Facilities Details", "Facilities", "Details", 3),
    (5, "Organizations Metadata", "Organizations", "Metadata", None),
    (6, "Organizations Details", "Organizations", "Details", 5),
)
DATASETS_SCHEMA = "phase int, name string, category string, type string, depends_on int"


def datasets(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(DATASETS), DATASETS_SCHEMA)


def dataset_rows() -> Column:
    """The registry as an array of structs, to give every group its own registry rows."""
    names = [f.split()[0] for f in DATASETS_SCHEMA.split(", ")]
    types = [f.split()[1] for f in DATASETS_SCHEMA.split(", ")]
    return F.array(
        *[F.struct(*[F.lit(v).cast(t).alias(n) for v, n, t in zip(row, names, types)]) for row in DATASETS]
    )


def master_fields(kind: str) -> list[str]:
    return [f.split()[0] for f in MASTER[kind].split(", ")]

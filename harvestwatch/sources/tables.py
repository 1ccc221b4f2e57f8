"""Scans and sinks.

Raw inputs arrive as CSV with every measure as text, so raw schemas are all
strings and numbers are parsed with ``try_cast`` later; stage tables are
Parquet, partitioned by year so period filters prune files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ..functions.parse import normalise_missing


def _strings(*names: str) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType(), True) for n in names])


RAINFALL_RAW = _strings("date", "adm1_name", "adm2_name", "rfh", "rfh_avg", "rfq",
                        "r1h", "r1h_avg", "r1q", "r3h", "r3h_avg", "r3q")
PRICES_RAW = _strings("date", "admin1", "admin2", "market", "category", "commodity",
                      "unit", "pricetype", "currency", "price", "usdprice")
EVENT_FIELDS = ("event_id_cnty", "event_date", "year", "event_type", "sub_event_type",
                "admin1", "admin2", "location", "latitude", "longitude", "fatalities", "notes")
EVENTS_RAW = _strings(*EVENT_FIELDS)
# landed API page: {"data": [ {event fields as strings}, ... ]}
EVENT_PAGE = T.StructType([T.StructField("data", T.ArrayType(EVENTS_RAW), True)])


def read_table(spark: SparkSession, path: str, schema: T.StructType | None = None,
               fmt: str = "csv") -> DataFrame:
    """Typed scan.  CSV uses an explicit schema (no inference pass) and
    normalises missing-value tokens in string columns to NULL."""
    if fmt == "parquet":
        df = spark.read.parquet(path)
        return df if schema is None else df.select(*[F.col(f.name).cast(f.dataType) for f in schema])
    reader = spark.read.option("header", True).option("mode", "PERMISSIVE")
    if schema is not None:
        reader = reader.schema(schema)
    return normalised(reader.csv(path))


def normalised(df: DataFrame) -> DataFrame:
    """Missing-value tokens of all text columns as NULL."""
    return df.select(*[
        normalise_missing(F.col(f.name)).alias(f.name) if isinstance(f.dataType, T.StringType)
        else F.col(f.name) for f in df.schema])


def drop_tag_rows(df: DataFrame, marker: str = "#", cols=None) -> DataFrame:
    """Drop metadata rows (HXL tag rows): those whose date cell, or a cell of
    ``cols``, starts with ``marker``.

    Spark has no "first row"; a date never starts with the marker, so no data
    row is lost, whatever its text columns hold.
    """
    cols = cols or [f.name for f in df.schema if f.name == "date" and isinstance(f.dataType, T.StringType)]
    if not cols:
        return df
    tagged = F.exists(F.array(*[F.col(c) for c in cols]),
                      lambda c: F.coalesce(c.startswith(marker), F.lit(False)))
    return df.filter(~tagged)


def subset_country(df: DataFrame, name: str, column: str | None = None) -> DataFrame:
    """S3: keep rows whose country column contains ``name`` (case-insensitive).

    The column is the first whose name contains ``country`` (else the first
    column); chosen from the schema on the driver, no job.
    """
    if column is None:
        column = next((c for c in df.columns if "country" in c.lower()), df.columns[0])
    return df.filter(F.coalesce(F.lower(F.col(column)).contains(name.lower()), F.lit(False)))


def read_event_pages(spark: SparkSession, path: str, dedupe: bool = False, multiline: bool = True) -> DataFrame:
    """Landed JSON pages (``{"data": [...]}``, one file per page)
    read in parallel with an explicit schema and exploded into event rows; without
    ``multiline`` a file holds a page per line and large files are split.

    Missing-value tokens become NULL, as in a table scan.  Pages are only appended; with ``dedupe`` one row per event id stays, that
    of the page landed last (ties by name, then by value), and all rows without an id.  De-duplication is a hash aggregate with map-side partial
    aggregation, so even if one id had a third of all copies, each task ships
    one row per id."""
    pages = spark.read.schema(EVENT_PAGE).option("multiLine", multiline).json(path)
    if not dedupe:
        return normalised(pages.select(F.explode("data").alias("e")).select("e.*"))
    rows = normalised(pages.select(F.explode("data").alias("e"), F.col("_metadata.file_modification_time").alias("at"),
                                   F.col("_metadata.file_name").alias("page")).select("e.*", "at", "page"))
    known, cells = F.col("event_id_cnty").isNotNull(), list(EVENT_FIELDS)
    last = rows.where(known).groupBy(F.col("event_id_cnty").alias("id")).agg(F.max(F.struct("at", "page", F.struct(*cells).alias("e"))).alias("m"))
    return last.select("m.e.*").unionByName(rows.where(~known).select(*cells))


def save_if_absent(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Land a table only if nothing is there yet."""
    df.write.mode("ignore").format(fmt).save(path)


def write_stage(df: DataFrame, path: str, partition_by=("year",), cluster_by=("district", "region", "month")) -> DataFrame:
    """Write a stage table (Parquet, partitioned) and return a scan of it.

    Rows are clustered by ``cluster_by`` (the columns present) inside each
    task before writing, so Parquet row-group min/max statistics let entity
    filters (one district's deep dive) skip row groups, on top of the year
    partition pruning.  The returned DataFrame's lineage starts at the
    written files, so later stages never recompute this one, and a lost
    executor only costs the tasks of the current stage.
    """
    keys = [c for c in cluster_by if c in df.columns]
    parts = [c for c in (partition_by or ()) if c in df.columns]
    if parts:
        # each task writes few partitions; REBALANCE also splits a large one
        df = df.hint("rebalance", *parts)
    if keys:
        # partition columns first: the writer needs rows ordered by them, and
        # with this prefix it adds no sort of its own that would undo ours
        df = df.sortWithinPartitions(*parts, *keys)
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return df.sparkSession.read.parquet(path)


def write_feed(df: DataFrame, path: str, order_by, header: bool = True) -> None:
    """Ordered CSV feed.  A global sort writes range-ordered part files, so
    reading the parts in name order gives the feed order, with no single-task
    funnel."""
    df.orderBy(*order_by).write.mode("overwrite").option("header", header).csv(path)


def write_lines(df: DataFrame, path: str, order_by=("seq",), value: str = "value") -> None:
    """Text report from a lines table ``(order keys..., value)``."""
    df.orderBy(*order_by).select(F.col(value).cast("string")).write.mode("overwrite").text(path)


LISTED = 1_000


def source_overview(df: DataFrame, date_col: str, distinct_cols=(), list_cols=()) -> DataFrame:
    """One-row overview (rows, date range, distinct counts, value lists).

    Value lists hold the labels (commodities, event types) of a bounded summary:
    all of them where a column has at most ``LISTED`` labels, else its most frequent
    ones; ``operators.label_counts`` has them as rows with exact counts.
    """
    aggs = [F.count(F.lit(1)).alias("rows"),
            F.min(date_col).alias("date_min"), F.max(date_col).alias("date_max")]
    aggs += [F.count_distinct(c).alias(f"n_{c}") for c in distinct_cols]
    aggs += [F.expr(f"array_sort(approx_top_k(`{c}`, {LISTED}, {10 * LISTED}) FILTER (WHERE `{c}` IS NOT NULL).item)").alias(
        f"{c}_values") for c in list_cols]
    return df.agg(*aggs)

"""Incremental monthly refresh of landed raw files (Structured Streaming).

The published pipeline refreshes by dropping new raw files and re-running
the batch.  Here a file-source stream picks up only the new files (the
stream checkpoint remembers which were processed); each micro-batch is
reduced to monthly *partial* aggregates (sums and counts, which add up) and
written to a partials table keyed by batch id, so a retried batch writes its
own part again (exactly-once).  The monthly table is a cheap re-aggregation of the
partials, followed by the usual batch steps (lags, quantile flag, master).

Late data is never dropped: there is no watermark, and a late row simply
adds to its month's partial sums.

``start_refresh`` adds every landed row.  ``start_keyed_refresh`` counts each event id
once, as it was sent last: every micro-batch looks up what its ids added before,
takes that off and adds the new values, so a file that is sent again changes nothing
and a corrected event moves its counts.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession, functions as F

from .. import constants as K
from ..functions import flag_gt, flag_lt, flag_pattern, parse_date, parse_double, std_region
from ..operators import add_lags, quantile_flag
from ..session import path_exists
from ..sources import EVENTS_RAW, RAINFALL_RAW, drop_tag_rows, normalised


def _event_partials(batch: DataFrame) -> DataFrame:
    rows = batch.select(
        parse_date("event_date").alias("date"), std_region("admin1").alias("region"),
        F.col("event_id_cnty"),
        F.coalesce(parse_double("fatalities"), F.lit(0.0)).alias("fatalities"),
        flag_pattern("event_type", K.FLOOD_EVENT_PATTERN).alias("is_flood_event"),
    ).where(F.col("date").isNotNull())
    return (rows.groupBy("region", F.year("date").alias("year"), F.month("date").alias("month"))
            .agg(F.count("*").alias("n_rows"), F.count("event_id_cnty").alias("n_events"),
                 F.sum("fatalities").alias("fatalities_sum"),
                 F.sum("is_flood_event").cast("long").alias("flood_events")))


def _rain_partials(batch: DataFrame, measures=None) -> DataFrame:
    measures = measures or K.RAIN_MEASURES
    rows = batch.select(parse_date("date").alias("date"), std_region("adm1_name").alias("region"),
                        F.trim("adm2_name").alias("district"),
                        *[parse_double(c).alias(c) for c in measures]).where(
        F.col("date").isNotNull() & F.col("district").isNotNull())
    aggs = []
    for c in measures:
        aggs += [F.sum(c).alias(f"{c}__sum"), F.count(c).alias(f"{c}__n")]
    return rows.groupBy("region", "district", F.year("date").alias("year"),
                        F.month("date").alias("month")).agg(*aggs)


def _append_partials(partials_dir: str, reduce):
    def handle(batch: DataFrame, batch_id: int) -> None:
        marker = os.path.join(partials_dir, f"batch_id={batch_id}")
        # a retried batch overwrites its own folder, whatever a failed attempt left there
        reduce(batch).write.mode("overwrite").parquet(marker)
    return handle


def start_refresh(spark: SparkSession, landing_dir: str, partials_dir: str, checkpoint_dir: str,
                  kind: str = "events", available_now: bool = True, max_files: int | None = None):
    """Start the stream over ``landing_dir`` (CSV files with a header).
    ``kind`` is ``events`` or ``rainfall``.  Returns the StreamingQuery."""
    schema = EVENTS_RAW if kind == "events" else RAINFALL_RAW
    reduce = _event_partials if kind == "events" else _rain_partials
    reader = spark.readStream.schema(schema).option("header", True)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    stream = normalised(reader.csv(landing_dir))
    if kind != "events":
        stream = drop_tag_rows(stream)
    w = stream.writeStream.foreachBatch(_append_partials(partials_dir, reduce)).option(
        "checkpointLocation", checkpoint_dir)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()


_CONTRIBUTION = ("region", "year", "month", "fatalities", "is_flood_event")


SMALL_BATCH = 100_000  # rows whose ids are broadcast to the log


def _contributions(batch: DataFrame) -> DataFrame:
    """What each row adds, with the landing it came by; a row without a date adds nothing."""
    date = parse_date("event_date")
    return batch.select("event_id_cnty", "landed_at", "landed_in", F.struct(
        F.when(date.isNotNull(), std_region("admin1")).alias("region"), F.year(date).alias("year"), F.month(date).alias("month"),
        F.coalesce(parse_double("fatalities"), F.lit(0.0)).alias("fatalities"),
        flag_pattern("event_type", K.FLOOD_EVENT_PATTERN).alias("is_flood_event")).alias("now"))


def merge_events(batch: DataFrame, store_dir: str, batch_id: int) -> None:
    """Count a micro-batch of events once per id.

    ``events/batch_id=n`` logs the ids whose values are new or changed (with what they were),
    ``partials/batch_id=n`` the sums that come and go, read from that log.  Only log entries
    of earlier batches are looked up, and both folders are written over, so a batch that is
    tried again does the same.  Ids are unique after an aggregate with partial aggregation, so
    an id that a third of the rows repeat is one row in the joins."""
    spark = batch.sparkSession
    rows = _contributions(batch)
    newest = rows.where(F.col("event_id_cnty").isNotNull()).groupBy("event_id_cnty").agg(
        F.max(F.struct("landed_at", "landed_in", "now")).alias("m")).select("event_id_cnty", "m.now")
    log = f"{store_dir}/events"
    old = None
    if path_exists(spark, log):
        schema = newest.schema.add("batch_id", "long")
        held = spark.read.schema(schema).option("basePath", log).parquet(log).where(F.col("batch_id") < batch_id)
        if batch.limit(SMALL_BATCH + 1).count() <= SMALL_BATCH:  # † a few ids spare the log a shuffle
            ids = F.broadcast(newest.select(F.col("event_id_cnty").alias("id")))
            held = held.join(ids, F.col("event_id_cnty") == F.col("id"), "left_semi")
        old = held.groupBy("event_id_cnty").agg(F.max_by("now", "batch_id").alias("was"))
    both = newest.join(old, "event_id_cnty", "left") if old is not None else newest.withColumn(
        "was", F.lit(None).cast(newest.schema["now"].dataType))
    both = both.where(F.col("was").isNull() | ~F.col("was").eqNullSafe(F.col("now"))).select("event_id_cnty", "now", "was")
    mine = f"{log}/batch_id={batch_id}"
    both.write.mode("overwrite").parquet(mine)
    changed = spark.read.schema(both.schema).parquet(mine)
    signed = (changed.select("event_id_cnty", F.lit(1).alias("sign"), "now.*")
              .unionByName(changed.where(F.col("was").isNotNull()).select("event_id_cnty", F.lit(-1).alias("sign"), "was.*"))
              .unionByName(rows.where(F.col("event_id_cnty").isNull()).select("event_id_cnty", F.lit(1).alias("sign"), "now.*")))
    known = F.col("event_id_cnty").isNotNull().cast("int")
    sums = signed.where(F.col("year").isNotNull()).groupBy("region", "year", "month").agg(
        F.sum("sign").alias("n_rows"), F.sum(F.col("sign") * known).alias("n_events"),
        F.sum(F.col("sign") * F.col("fatalities")).alias("fatalities_sum"),
        F.sum(F.col("sign") * F.col("is_flood_event")).cast("long").alias("flood_events"))
    sums.write.mode("overwrite").parquet(f"{store_dir}/partials/batch_id={batch_id}")


def start_keyed_refresh(spark: SparkSession, landing_dir: str, store_dir: str, checkpoint_dir: str,
                        available_now: bool = True, max_files: int | None = None):
    """Start the stream of events that counts each id as it was sent last (by time and
    name of the landed file, ties by value).  Sums: ``conflict_from_partials`` of
    ``<store_dir>/partials``."""
    reader = spark.readStream.schema(EVENTS_RAW).option("header", True)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    landed = reader.csv(landing_dir).select(
        "*", F.col("_metadata.file_modification_time").alias("landed_at"), F.col("_metadata.file_name").alias("landed_in"))
    w = normalised(landed).writeStream.foreachBatch(lambda batch, n: merge_events(batch, store_dir, n)).option(
        "checkpointLocation", checkpoint_dir)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()


def conflict_from_partials(spark: SparkSession, partials_dir: str,
                           q: float = K.HIGH_CONFLICT_QUANTILE) -> DataFrame:
    """The conflict monthly table from the accumulated partials."""
    p = spark.read.parquet(partials_dir)
    monthly = (p.groupBy("region", "year", "month")
               .agg(F.sum("n_rows").alias("n_rows"), F.sum("n_events").alias("conflict_events"),
                    F.coalesce(F.sum("fatalities_sum"), F.lit(0.0)).alias("fatalities_total"),
                    F.coalesce(F.sum("flood_events"), F.lit(0)).cast("long").alias("flood_displace_events"))
               .where("n_rows > 0").drop("n_rows"))  # a month that corrections have emptied is no row
    monthly = add_lags(monthly, "conflict_events", [1], key="region", fill=0, name="conflict_events_lag1")
    monthly = add_lags(monthly, "flood_displace_events", [1], key="region", fill=0, name="flood_displace_lag1")
    return quantile_flag(monthly, "conflict_events", q, "high_conflict_flag")


def rainfall_from_partials(spark: SparkSession, partials_dir: str, measures=None, digits: int = 3) -> DataFrame:
    """The rainfall monthly table (means from partial sums and counts)."""
    from ..functions._util import np_round
    measures = measures or K.RAIN_MEASURES
    p = spark.read.parquet(partials_dir)
    aggs = [np_round(F.try_divide(F.sum(f"{c}__sum"), F.sum(f"{c}__n").cast("double")), digits).alias(out)
            for c, out in measures.items()]
    monthly = p.groupBy("region", "district", "year", "month").agg(*aggs)
    return monthly.withColumns({"flood_flag": flag_gt("rainfall_anomaly_pct", K.FLOOD_ANOMALY_GT),
                                "drought_flag": flag_lt("rainfall_anomaly_pct", K.DROUGHT_ANOMALY_LT)})


__all__ = ["start_refresh", "start_keyed_refresh", "merge_events", "conflict_from_partials", "rainfall_from_partials"]

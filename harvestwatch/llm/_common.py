"""Helpers shared by the operators: tables, shipping, slicing of Arrow batches."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from harvestwatch.session import cut_lineage, ensure_checkpoint_dir, ship_package
from harvestwatch.sources.driver import table

__all__ = ["cut_lineage", "let", "prepare", "slices", "table", "with_columns_replaced"]

# The white space between words (space, tab to carriage return).
SPACE_CLASS = r"[\x20\x09-\x0D]"
WORD_CLASS = r"[^\x20\x09-\x0D]"


BATCH_BYTES = 8 << 20
_BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"


def prepare(spark: SparkSession) -> None:
    """Point the session at the shared folder, make the package importable on the
    workers, and bound the Arrow batches of texts (a smaller bound of the session
    stays): the operators work on slices of a few MB, so larger batches only hold
    memory outside the heap of the executors."""
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    now = str(spark.conf.get(_BATCH_SETTING)).rstrip("b")
    if not now.lstrip("-").isdigit() or not 0 < int(now) <= BATCH_BYTES:
        spark.conf.set(_BATCH_SETTING, str(BATCH_BYTES))


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once per row."""
    return F.transform(F.array(value), body)[0]


def with_columns_replaced(df: DataFrame, *names: str) -> DataFrame:
    """``df`` without the columns that an operator is about to add (any case)."""
    taken = {n.lower() for n in names}
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c.lower() not in taken])


def slices(batch: pa.RecordBatch, column: int, limit: int = 1 << 21):
    """Cut a record batch into runs of rows holding about ``limit`` bytes of one
    text column, so that a batch of long texts is worked on in bounded pieces."""
    import pyarrow.compute as pc

    lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()
    start = held = 0
    for i, n in enumerate(lengths):
        if held and held + n > limit:
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += n + 16
    if start < len(lengths):
        yield batch.slice(start)

"""S6, incremental: a stage table whose years are replaced one by one.

A folder holds the years that one refresh rewrote (``version=<n>-<id>/year=<y>``, the
id its own, so that no other attempt writes there); a manifest names the folder that
is current for each year.  A refresh writes its version first and publishes it by renaming a finished
manifest to the next number, so a reader sees all years of a refresh or none, a
failed attempt leaves the table as it was, and of two refreshes that started from
one manifest only one can take the next number.  Years that are not touched keep
their files.  Manifests hold one entry per year, so the driver reads a few KB.
"""

from __future__ import annotations

import json
import re
import uuid

from pyspark.sql import DataFrame, SparkSession

from ..session import delete_path

_MANIFEST = re.compile(r"^manifest-(\d{8})\.json$")


class StaleRefresh(RuntimeError):
    """Another refresh has published since this one read the table."""


class YearTable:
    """A table partitioned by ``year`` under ``root`` (shared storage)."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def _fs(self):
        at = self.spark._jvm.org.apache.hadoop.fs.Path(self.root)
        return at.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _path(self, name: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")

    def _names(self) -> list[str]:
        fs, at = self._fs(), self.spark._jvm.org.apache.hadoop.fs.Path(self.root)
        return sorted(s.getPath().getName() for s in fs.listStatus(at)) if fs.exists(at) else []

    def version(self) -> int:
        """Number of the current manifest, 0 if there is none."""
        return max((int(m.group(1)) for n in self._names() if (m := _MANIFEST.match(n))), default=0)

    def years(self, version: int | None = None) -> dict[int, str]:
        """The folder that holds each year (``<n>-<id>``)."""
        version = self.version() if version is None else version
        if not version:
            return {}
        text = self.spark.read.text(f"{self.root}/manifest-{version:08d}.json", wholetext=True).first()[0]
        return {int(y): v for y, v in json.loads(text).items()}

    def read(self, years=None, version: int | None = None) -> DataFrame:
        """The table, or only the files of ``years``."""
        held = self.years(version)
        paths = [f"{self.root}/version={v}/year={y}" for y, v in sorted(held.items()) if years is None or y in years]
        if not paths:  # no such year: an empty table with the columns of any year
            y, v = next(iter(held.items()))
            return self.spark.read.option("basePath", self.root).parquet(f"{self.root}/version={v}/year={y}").drop("version").limit(0)
        return self.spark.read.option("basePath", self.root).parquet(*paths).drop("version")

    def write_years(self, df: DataFrame, years, based_on: int | None = None, cluster_by=("district", "region", "month")) -> int:
        """Replace ``years`` by the rows of ``df`` (which holds no other year; a year
        without rows leaves the table) and return the new version."""
        current = self.version() if based_on is None else based_on
        version, keys = current + 1, [c for c in cluster_by if c in df.columns]
        folder = f"{version}-{uuid.uuid4().hex[:8]}"
        if self._fs().exists(self._path(f"manifest-{version:08d}.json")):
            raise StaleRefresh(f"version {version} of {self.root} is there already")
        rows = df.hint("rebalance", "year").sortWithinPartitions("year", *keys)
        rows.write.mode("overwrite").partitionBy("year").parquet(f"{self.root}/version={folder}")
        written = {int(n.split("=")[1]) for n in (s.getPath().getName() for s in self._fs().listStatus(
            self._path(f"version={folder}"))) if n.startswith("year=")}
        if not written <= {int(y) for y in years}:
            raise ValueError(f"rows outside the years to write: {sorted(written - set(years))}")
        held = {y: v for y, v in self.years(current).items() if y not in set(years)} | dict.fromkeys(written, folder)
        self._publish(version, held)
        return version

    def _publish(self, version: int, held: dict[int, str]) -> None:
        fs, part = self._fs(), self._path(f"_writing-{uuid.uuid4().hex}.json")
        out = fs.create(part, True)
        out.write(bytearray(json.dumps({str(y): v for y, v in sorted(held.items())}).encode()))
        out.close()
        at = self._path(f"manifest-{version:08d}.json")
        if fs.exists(at) or not fs.rename(part, at):
            raise StaleRefresh(f"version {version} of {self.root} was published by another refresh")

    def vacuum(self, keep: int = 1) -> list[int]:
        """Delete folders and manifests that the last ``keep`` versions do not use;
        returns the versions whose folders are deleted."""
        last = self.version()
        used = {v for n in range(max(1, last - keep + 1), last + 1) for v in self.years(n).values()}
        gone = []
        for name in self._names():
            if (m := _MANIFEST.match(name)) and int(m.group(1)) <= last - keep:
                delete_path(self.spark, f"{self.root}/{name}")
            elif name.startswith("version=") and (folder := name.split("=")[1]) not in used and int(folder.split("-")[0]) <= last:
                delete_path(self.spark, f"{self.root}/{name}")  # one of a later number is being written
                gone.append(int(folder.split("-")[0]))
        return gone


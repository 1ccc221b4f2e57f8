"""Session helpers: configuration defaults and lineage cuts.

The cluster owns ``spark.checkpoint.dir`` (a shared folder).  We read it from
the session and only set one ourselves where it is unset (local tests).
"""

from __future__ import annotations

import contextlib
import contextvars
import os
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession

# Settings we want everywhere; none of them fixes a partition count, AQE
# coalesces shuffle partitions to the data at runtime.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_spark(master: str | None = None, app: str = "harvestwatch",
              shuffle_partitions: int | None = None, extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for k, v in DEFAULT_CONF.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, configuring the context with it.

    Uses ``spark.checkpoint.dir`` when the cluster sets it; only when it is
    unset (tests on one machine) a private folder is created.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not conf_dir:
        if not is_single_machine(sc.master):
            raise RuntimeError("spark.checkpoint.dir is not set: on a cluster it must name a folder that "
                               "the driver and all executors share")
        conf_dir = tempfile.mkdtemp(prefix="hw-ckpt-")
        spark.conf.set("spark.checkpoint.dir", conf_dir)
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir() or conf_dir


def is_single_machine(master: str) -> bool:
    """Whether driver and executors are one process (``local``, ``local[8]``)."""
    return master == "local" or master.startswith("local[")


def ship_package(spark: SparkSession) -> None:
    """Send this package to the workers, once per Spark context, so that Python
    functions of it run wherever the driver was started from."""
    sc = spark.sparkContext
    if _shipped.get("id") == sc.applicationId:
        return
    root = os.path.dirname(os.path.abspath(__file__))
    name = os.path.basename(root)
    path = os.path.join(tempfile.mkdtemp(prefix="hw-ship-"), f"{name}.zip")
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, _, files in os.walk(root):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(folder, f)
                    z.write(full, os.path.join(name, os.path.relpath(full, root)))
    sc.addPyFile(path)
    _shipped["id"] = sc.applicationId


_shipped: dict[str, str] = {}


def cut_lineage(df: DataFrame, name: str | None = None) -> DataFrame:
    """Cut lineage by writing the table once (Parquet) under the shared
    checkpoint folder and reading it back.

    The data lives in the cluster's shared checkpoint storage, so a lost
    executor never forces a recomputation of the upstream stages; and unlike
    ``Dataset.checkpoint`` on an unpersisted plan, the plan runs once (write)
    instead of twice (count, then checkpoint write).
    """
    spark = df.sparkSession
    path = stage_path(spark, name or uuid.uuid4().hex)
    scope = _scope.get()
    if scope is not None:
        scope.paths.append(path)
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


class StageScope:
    """Owns the stage tables that ``cut_lineage`` writes while it is entered, and
    deletes them when it is left::

        with StageScope(spark):
            query(spark, sf_dir).write.parquet(out)

    ``collecting`` enters it without deleting; ``release`` deletes later.  Tables that
    no scope owns go when the application ends."""

    def __init__(self, spark: SparkSession):
        self.spark, self.paths = spark, []

    @contextlib.contextmanager
    def collecting(self):
        token = _scope.set(self)
        try:
            yield self
        finally:
            _scope.reset(token)

    def __enter__(self):
        self._token = _scope.set(self)
        return self

    def __exit__(self, *error):
        _scope.reset(self._token)
        self.release()

    def release(self) -> None:
        while self.paths:
            delete_path(self.spark, self.paths.pop())

    def read_by(self, df: DataFrame) -> bool:
        """Whether ``df`` is still to read one of the tables."""
        roots = scanned_roots(df)
        return any(root.rstrip("/").endswith(path.rsplit("/hw-stages/", 1)[-1]) for path in self.paths for root in roots)


_scope: contextvars.ContextVar[StageScope | None] = contextvars.ContextVar("stage_scope", default=None)


def scanned_roots(df: DataFrame) -> set[str]:
    """The paths that the scans of a plan were opened with (a few, not their files)."""
    roots, plans = set(), [df._jdf.queryExecution().analyzed()]
    while plans:
        plan = plans.pop()
        children = plan.children()
        inner = plan.subqueries()
        plans += [children.apply(i) for i in range(children.size())] + [inner.apply(i) for i in range(inner.size())]
        if plan.getClass().getSimpleName() == "LogicalRelation" and plan.relation().getClass().getSimpleName() == "HadoopFsRelation":
            paths = plan.relation().location().rootPaths()
            roots |= {paths.apply(i).toString() for i in range(paths.size())}
    return roots


def path_exists(spark: SparkSession, path: str) -> bool:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at)


def delete_path(spark: SparkSession, path: str) -> None:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def stage_path(spark: SparkSession, name: str) -> str:
    """A path for a stage table inside the shared checkpoint folder."""
    base = ensure_checkpoint_dir(spark).rstrip("/") + "/hw-stages"
    if base not in _ends_with_application:
        at = spark._jvm.org.apache.hadoop.fs.Path(base)
        files = at.getFileSystem(spark._jsc.hadoopConfiguration())
        files.mkdirs(at)
        files.deleteOnExit(at)
        _ends_with_application.add(base)
    return f"{base}/{name}"


_ends_with_application: set[str] = set()


def materialize_all(builders: dict, write=None) -> dict:
    """Materialise several independent tables at once.

    ``builders`` maps a name to a zero-argument callable returning a
    DataFrame; ``write(name, df)`` materialises one and returns the re-read
    table (default: ``cut_lineage``).  The write jobs are submitted from a
    small thread pool, so Spark runs them concurrently and a narrow stage
    (one large file, one straggler) of one table does not idle the executors
    the others could use.
    """
    from concurrent.futures import ThreadPoolExecutor
    write = write or (lambda name, df: cut_lineage(df))
    if len(builders) <= 1:
        return {k: write(k, b()) for k, b in builders.items()}
    with ThreadPoolExecutor(max_workers=len(builders)) as pool:
        run = {k: contextvars.copy_context() for k in builders}  # the scope of the caller holds in the threads
        futures = {k: pool.submit(run[k].run, lambda k=k, b=b: write(k, b())) for k, b in builders.items()}
        return {k: f.result() for k, f in futures.items()}

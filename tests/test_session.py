"""Scopes of stage tables."""

import os

from pyspark.sql import functions as F

from harvestwatch.session import StageScope, cut_lineage, materialize_all, scanned_roots


def local(path):
    return path.removeprefix("file:")


def test_scope_owns_its_tables_only(spark):
    other = cut_lineage(spark.range(5))
    with StageScope(spark) as scope:
        mine = cut_lineage(spark.range(7))
        built = materialize_all({"a": lambda: spark.range(2), "b": lambda: spark.range(3)})
        assert mine.count() == 7 and built["b"].count() == 3
        paths = list(scope.paths)
    assert len(paths) == 3 and not any(os.path.exists(local(p)) for p in paths)
    assert other.count() == 5 and not scope.paths


def test_tables_that_a_plan_reads(spark):
    scope, later = StageScope(spark), StageScope(spark)
    with scope.collecting():
        a = cut_lineage(spark.range(4))
    with later.collecting():
        b = cut_lineage(spark.range(4))
    lazy = a.filter("id > 0").join(spark.range(2), "id", "left")
    assert scope.read_by(lazy) and not later.read_by(lazy)
    asked = spark.range(1).withColumn("n", b.select(F.max("id")).scalar())
    assert later.read_by(asked) and not scope.read_by(asked)
    assert len(scanned_roots(lazy)) == 1
    later.release()
    assert lazy.count() == 3
    scope.release()

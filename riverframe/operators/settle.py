"""Write an intermediate table once instead of computing it once per use.

A whole-table threshold, a z-score and the table itself read the same daily roll-up. Catalyst
prunes each reader to other columns, so their shuffles differ and none is reused: the raw data
would be scanned for each. A written table is read per column, survives lost executors, and
gives every reader the very same floating-point sums.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from weakref import WeakKeyDictionary

from pyspark.sql import DataFrame, SparkSession

from riverframe.session import checkpoint_dir

#: Tables that this process has written, by application, oldest first.
_written: dict[str, list[str]] = {}
#: Where a table that :func:`settle` returned is.
_place: WeakKeyDictionary[DataFrame, str] = WeakKeyDictionary()


def settle(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write ``df`` to the shared checkpoint folder now and return it as read from there."""
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"
    _written.setdefault(spark.sparkContext.applicationId, []).append(path)
    df.write.parquet(path)
    table = spark.read.schema(df.schema).parquet(path)
    _place[table] = path
    return table


def release(spark: SparkSession, since: int = 0) -> int:
    """Remove the tables written after the first ``since`` ones; what reads them must have run by then."""
    paths = _written.get(spark.sparkContext.applicationId, [])
    gone, paths[since:] = paths[since:], []
    _delete(spark, gone)
    return len(gone)


def discard(table: DataFrame) -> None:
    """Remove one table that :func:`settle` returned, once nothing reads it any more (the state before the last of a loop)."""
    spark, path = table.sparkSession, _place.pop(table)
    _written[spark.sparkContext.applicationId].remove(path)
    _delete(spark, [path])


def _delete(spark: SparkSession, paths: list[str]) -> None:
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for path in paths:
        target = jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(conf).delete(target, True)


@contextmanager
def settled(spark: SparkSession) -> Iterator[None]:
    """Tables settled inside the block are removed at its end: put the action inside it as well."""
    since = len(_written.get(spark.sparkContext.applicationId, []))
    try:
        yield
    finally:
        release(spark, since)

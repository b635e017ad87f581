"""Helpers shared by the training-data operators."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablelog.shipping import ship

BATCH_ROWS = 500
_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"
_own_dirs: dict[str, str] = {}
_written: list[tuple[SparkSession, str]] = []


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, or a local one where that is unset (tests)."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if found:
        return found.rstrip("/")
    master = spark.sparkContext.master
    if not (master == "local" or master.startswith("local[")):
        raise RuntimeError(f"spark.checkpoint.dir must name a folder that driver and executors share (master {master})")
    app = spark.sparkContext.applicationId
    if app not in _own_dirs:
        _own_dirs[app] = tempfile.mkdtemp(prefix="tablelog-shared-")
        spark.sparkContext.setCheckpointDir(_own_dirs[app])
    return "file://" + _own_dirs[app]


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write df as Parquet to the shared folder and read it back: cuts the lineage, survives lost executors."""
    spark = df.sparkSession
    ship(spark)
    path = f"{shared_dir(spark)}/llm/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    _written.append((spark, path))
    back = spark.read.schema(df.schema).parquet(path)
    back._written_to = path
    return back


def discard(df: DataFrame) -> None:
    """Delete a table of materialise() that nothing reads any more."""
    path = getattr(df, "_written_to", None)
    if path:
        _delete(df.sparkSession, path)


def _delete(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


@atexit.register
def _clean(pid: int = os.getpid()) -> None:
    if os.getpid() != pid:  # a forked worker
        return
    for spark, path in _written:
        plain = path.removeprefix("file://").removeprefix("file:")
        try:
            shutil.rmtree(plain, ignore_errors=True) if plain.startswith("/") else _delete(spark, path)
        except Exception:  # noqa: BLE001  the JVM may be gone at exit
            return
    for path in _own_dirs.values():
        shutil.rmtree(path, ignore_errors=True)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def integral(df: DataFrame, *names: str) -> None:
    """Raise unless the named columns exist and hold integers."""
    for n in names:
        if n not in df.columns:
            raise ValueError(f"no column {n!r}; there are {df.columns}")
        if not isinstance(df.schema[n].dataType, T.IntegralType):
            raise TypeError(f"column {n!r} must hold integers, not {df.schema[n].dataType.simpleString()}")


def bounded_batches(spark: SparkSession) -> None:
    """Hand Python at most BATCH_ROWS rows at a time: long texts in batches of Spark's 10,000 rows take hundreds of MB of
    Arrow buffers outside the heap. A smaller setting of the session stays. The workers also get this package."""
    ship(spark)
    if int(spark.conf.get(_BATCH, "10000")) > BATCH_ROWS:
        spark.conf.set(_BATCH, str(BATCH_ROWS))


def edit_batches(df: DataFrame, make: Callable[[], Callable[[pa.RecordBatch], pa.RecordBatch]]) -> DataFrame:
    """df with each Arrow batch passed through the function that make() builds once a task; the columns stay as they are."""

    def f(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        edit = make()
        for batch in batches:
            yield edit(batch)

    bounded_batches(df.sparkSession)
    return df.mapInArrow(f, df.schema)


def fold(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo 3; a null id counts as the text ''."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 3

"""Where intermediate tables live, and how they get there."""

from __future__ import annotations

import tempfile
import threading
import uuid
from collections.abc import Iterable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``.

    Only a local session without that setting gets a folder of its own; a cluster has to
    name one that all executors reach.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    context = spark.sparkContext
    if not folder:
        folder = context.getCheckpointDir()
    if not folder:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
        folder = tempfile.mkdtemp(prefix="qualitygate-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return folder


_made = threading.local()


def new_folder(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder; nothing is created, and removed only by ``temporary``."""
    path = f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    if getattr(_made, "paths", None) is not None:
        _made.paths.append(path)
    return path


@contextmanager
def temporary(spark: SparkSession) -> Iterator[None]:
    """Remove the folders that this thread gets from ``new_folder`` meanwhile, once their tables are used up."""
    before, _made.paths = getattr(_made, "paths", None), []
    try:
        yield
    finally:
        for path in _made.paths:
            store, folder = _store(spark, path)
            store.delete(folder, True)
        _made.paths = before


def _store(spark: SparkSession, path: str) -> tuple:
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), folder


def exists(spark: SparkSession, path: str) -> bool:
    """Whether there is a file or folder of that name, in whatever store it names."""
    store, folder = _store(spark, path)
    return store.exists(folder)


def children(spark: SparkSession, path: str) -> list[str]:
    """Names of the files and folders in a folder; none if there is no such folder."""
    store, folder = _store(spark, path)
    return [x.getPath().getName() for x in store.listStatus(folder)] if store.exists(folder) else []


def size_of(spark: SparkSession, path: str) -> tuple[int, int]:
    """Number and bytes of all files below a folder."""
    store, folder = _store(spark, path)
    summary = store.getContentSummary(folder)
    return summary.getFileCount(), summary.getLength()


def pin(df: DataFrame) -> DataFrame:
    """Write a small ``df`` to the shared folder once and go on from the written copy.

    Used where two parts of a plan must see the very same rows (sampled range bounds,
    sketches) and where running a step twice would cost money.
    """
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def spool(df: DataFrame, rows_per_file: int = 0) -> DataFrame:
    """The same for a table that may be large: columnar files, so later reads take only what they need.

    ``rows_per_file`` limits the rows of a file (0: no limit of its own). A task of a later read takes whole files or row groups, by their
    bytes, which in columns that compress well are millions of rows.
    """
    path = new_folder(df.sparkSession, "spool")
    writer = df.write.option("maxRecordsPerFile", rows_per_file) if rows_per_file else df.write
    writer.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def names_table(spark: SparkSession, names: Iterable[str], column: str) -> DataFrame:
    """A one-column table of a few distinct names, built without a Python worker."""
    values = F.array(*[F.lit(n) for n in dict.fromkeys(names)]).cast("array<string>")
    return spark.range(1).select(F.explode(values).alias(column))


def empty_table(spark: SparkSession, schema: T.StructType) -> DataFrame:
    return spark.range(0).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields])

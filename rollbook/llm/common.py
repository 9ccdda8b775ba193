"""Helpers that several operators share."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

WORD = r"[^\x20\x09-\x0D]+"  # fixed: words are runs of anything but ASCII white space


_own_folders: dict[str, str] = {}  # of local sessions without spark.checkpoint.dir
_kept: list[str] = []  # what ``keep`` has written and ``release`` has not deleted


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors reach, from ``spark.checkpoint.dir``.

    Where it is unset a local session gets a folder of its own; on a cluster that is an error.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local") or "cluster" in spark.sparkContext.master:
        raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
    app = spark.sparkContext.applicationId
    if app not in _own_folders:
        _own_folders[app] = tempfile.mkdtemp(prefix="rollbook-llm-")
    return _own_folders[app]


ARROW_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"
CLEAN_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def keep(df: DataFrame, label: str, batch_bytes: int | None = None) -> DataFrame:
    """The same rows, written once to the shared folder and read from there.

    Cuts the lineage: a lost executor costs a re-read, not a recomputation. ``release`` deletes
    what is kept, once results that read it are written. ``batch_bytes`` bounds the Arrow
    batches that tasks get meanwhile: rows of whole texts are wide. Shuffle files of the write
    go with its end, not when the driver happens to collect its garbage.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/rollbook-llm/{label}-{uuid.uuid4().hex}"
    wanted = {CLEAN_SHUFFLES: "true"} | ({ARROW_BYTES: str(batch_bytes)} if batch_bytes else {})
    before = {name: spark.conf.get(name, None) for name in wanted}
    try:
        for name, value in wanted.items():
            spark.conf.set(name, value)
        df.write.parquet(path)
    finally:
        for name, value in before.items():
            if value is not None:
                spark.conf.set(name, value)
    _kept.append(path)
    return spark.read.schema(df.schema).parquet(path)


def release(spark: SparkSession) -> None:
    """Delete all tables that ``keep`` has written in this process. Call it when no result that
    still reads them is open."""
    hadoop = spark.sparkContext._jsc.hadoopConfiguration()
    while _kept:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(_kept.pop())
        path.getFileSystem(hadoop).delete(path, True)


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` evaluated once per row, however often ``use`` names it."""
    return F.element_at(F.transform(F.array(value), use), 1)


def words(text: Column) -> Column:
    """Words of a text; a null text has none."""
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(WORD), F.lit(0))


def docs_table(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/documents.parquet")

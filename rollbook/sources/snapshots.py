"""Tables that are published as versions: readers see the old one or the new one, never parts.

A version of a folder's tables lies in a folder of its own. When all of them are written, a
marker is written last; readers take the highest version that has a marker. A run that breaks
on the way leaves the last version as it was, and the next run writes over what is left. A
refresh may read the tables it replaces. One writer publishes at a time.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rollbook.sources import writers


def _markers(folder: str) -> str:
    return f"{folder}/versions"


def versions(spark: SparkSession, folder: str) -> list[int]:
    """All published versions, ascending. The driver receives a number for each."""
    try:
        markers = spark.read.option("recursiveFileLookup", True).parquet(_markers(folder))
        found = markers.select("version").distinct().collect()
    except AnalysisException:  # nothing published yet, or the first marker is not complete
        return []
    return sorted(r["version"] for r in found)


def current(spark: SparkSession, folder: str) -> int:
    """The latest published version; 0 if there is none."""
    return max(versions(spark, folder), default=0)


def path_of(spark: SparkSession, folder: str, name: str, version: int | None = None) -> str:
    """Path of a table in the latest version, or in the one given."""
    number = current(spark, folder) if version is None else version
    if not number:
        raise FileNotFoundError(f"nothing is published under {folder}")
    return f"{folder}/version-{number}/{name}"


def read(spark: SparkSession, folder: str, name: str, version: int | None = None) -> DataFrame:
    return spark.read.parquet(path_of(spark, folder, name, version))


def publish(
    spark: SparkSession, folder: str, tables: Mapping[str, tuple[DataFrame, Sequence[str]]]
) -> int:
    """Write all tables, each with its partition columns, as one new version; returns its number.

    The tables of a version belong together: they become visible at once.
    """
    version = current(spark, folder) + 1
    for name, (df, parts) in tables.items():
        writers.write_parts(df, f"{folder}/version-{version}/{name}", parts)
    marker = spark.range(1).select(
        F.lit(version).alias("version"),
        F.current_timestamp().alias("published_at"),
        F.array(*[F.lit(name) for name in tables]).cast("array<string>").alias("tables"),
    )
    marker.write.mode("overwrite").parquet(f"{_markers(folder)}/{version}")
    return version


def prune(spark: SparkSession, folder: str, keep: int = 2) -> list[int]:
    """Delete all but the latest ``keep`` versions, markers first; returns the deleted ones.

    Give readers of an old version time to end: the latest is never deleted.
    """
    gone = versions(spark, folder)[: -max(1, keep)]
    hadoop = spark.sparkContext._jsc.hadoopConfiguration()
    for version in gone:
        for path in (f"{_markers(folder)}/{version}", f"{folder}/version-{version}"):
            target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
            target.getFileSystem(hadoop).delete(target, True)
    return gone

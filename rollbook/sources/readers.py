"""Sources: CSV feeds, tables and streams."""

from __future__ import annotations

import csv
from collections.abc import Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rollbook.catalog import COLUMN_ALIASES, SCHEMAS, TableSpec, schema_ddl
from rollbook.functions.columns import to_whole

# Arrival order of a CSV row. Stable once written with the row at ingest;
# recomputing it on another read of the files is not.
FILE_ORDER = ("src_path", "src_block", "src_row")

# Where a row of a file comes from.
LINEAGE = {
    "src_file": "string",
    "src_path": "string",
    "src_modified": "timestamp",
    "src_block": "bigint",
}

# Identity of an arriving file, as the stream of a feed's files has it.
ARRIVAL = ("path", "modificationTime", "length")


def find_source(spark: SparkSession, candidates: Sequence[str]) -> str:
    """First candidate path or glob that exists; an error naming all if none does."""
    for path in candidates:
        try:
            spark.read.text(path)  # resolves the path, starts no job
            return path
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
    raise FileNotFoundError(f"none of these sources exists: {list(candidates)}")


def list_sources(spark: SparkSession, paths: Sequence[str]) -> list[str]:
    """All given paths, every one of which must exist."""
    return [find_source(spark, [path]) for path in paths]


def _csv_schema(name: str) -> str:
    return schema_ddl(name, strings_only=True) + ", _corrupt string"


def with_file(df: DataFrame) -> DataFrame:
    """Adds where each row comes from. Files of one name in different folders differ by path."""
    return df.select(
        "*",
        F.col("_metadata.file_name").alias("src_file"),
        F.col("_metadata.file_path").alias("src_path"),
        F.col("_metadata.file_modification_time").alias("src_modified"),
        F.col("_metadata.file_block_start").alias("src_block"),
    )


def with_row_number(df: DataFrame) -> DataFrame:
    """Adds ``src_row``, ascending within each file split; for batch frames only."""
    return df.withColumn("src_row", F.monotonically_increasing_id())


def feed_header(columns: Sequence[str], name: str) -> dict[str, str]:
    """Declared column of each header column; an error if the two do not match by name."""
    declared = SCHEMAS[name]
    named = {}
    for column in columns:
        clean = column.strip()
        named[column] = COLUMN_ALIASES.get(clean, clean) if clean not in declared else clean
    unknown = [c for c, known in named.items() if known not in declared]
    missing = [c for c in declared if c not in named.values()]
    if unknown or missing or len(set(named.values())) < len(columns):
        raise ValueError(f"header of {name}: unknown {unknown}, missing {missing}, has {columns}")
    return named


def file_headers(spark: SparkSession, paths: str | Sequence[str]) -> dict[str, list[str]]:
    """The files behind ``paths`` by their header line, read in one pass over all of them.

    The header is the first line with any text in it; a file without one has no rows either.
    """
    if not isinstance(paths, str) and not paths:
        return {}
    lines = spark.read.text(paths)
    first = (
        lines.select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"))
        .filter(F.trim("value") != "")
        .select("file", "block", "value", F.monotonically_increasing_id().alias("row"))
        .groupBy("file")
        .agg(F.min_by("value", F.struct("block", "row")).alias("header"))
    )
    found = first.groupBy("header").agg(F.sort_array(F.collect_list("file")).alias("files")).collect()
    return {r.header: r.files for r in sorted(found, key=lambda r: r.files)}


def read_bronze_csv(spark: SparkSession, paths: str | Sequence[str], name: str) -> DataFrame:
    """All shards of a feed as text columns, with malformed lines kept in ``_corrupt``.

    Columns are matched by the name in each file's header, whatever their order; known
    misspellings are mapped, other names are an error. Files with one header are read
    together. Measures stay text until silver types them, so one bad number loses nothing.
    """
    parts = []
    for line, shards in file_headers(spark, paths).items():
        header = next(csv.reader([line.removeprefix("\ufeff")]), [])
        known = feed_header(header, name)
        schema = ", ".join(f"`{c}` string" for c in header) + ", _corrupt string"
        reader = spark.read.schema(schema).options(
            header=True, mode="PERMISSIVE", columnNameOfCorruptRecord="_corrupt"
        )
        named = with_file(reader.csv(shards)).withColumnsRenamed(known)
        parts.append(named.select(*SCHEMAS[name], "_corrupt", *LINEAGE))
    if not parts:
        empty = spark.createDataFrame([], _csv_schema(name))
        parts = [empty.withColumns({c: F.lit(None).cast(t) for c, t in LINEAGE.items()})]
    return with_row_number(reduce(DataFrame.unionByName, parts))


def read_arrivals(arrivals: DataFrame) -> DataFrame:
    """The rows of a micro-batch of arriving files (see ``stream_csv``), by their headers.

    The driver receives the paths of one micro-batch, ``max_files`` at most.
    """
    spark = arrivals.sparkSession
    found = arrivals.select("path", "feed").distinct().collect()
    feeds = {r.feed for r in found}
    if len(feeds) > 1:
        raise ValueError(f"files of several feeds in one batch: {sorted(feeds)}")
    if not found:
        name = arrivals.schema["feed"].metadata["feed"]
        return read_bronze_csv(spark, [], name)
    return read_bronze_csv(spark, sorted(r.path for r in found), feeds.pop())


def read_profile_csv(
    spark: SparkSession, paths: str | Sequence[str], spec: TableSpec
) -> DataFrame:
    """A CSV with its own header, keys as text and measures as numbers or null."""
    raw = spark.read.options(header=True, inferSchema=False).csv(paths)
    raw = raw.withColumnsRenamed(
        {old: new for old, new in COLUMN_ALIASES.items() if old in raw.columns}
    )
    return raw.withColumns({m: to_whole(m) for m in spec.measures})


def scan(spark: SparkSession, table: str) -> DataFrame:
    """A table by name, or Parquet by path."""
    return spark.read.parquet(table) if "/" in table else spark.table(table)


def stream_csv(spark: SparkSession, path: str, name: str, max_files: int = 1000) -> DataFrame:
    """The arriving files of a feed as a stream: path, time, length and feed of each.

    Their rows are read by the sink (see ``read_arrivals``): each file by its own header.
    """
    reader = spark.readStream.format("binaryFile").schema(
        "path string, modificationTime timestamp, length bigint, content binary"
    )
    files = reader.option("maxFilesPerTrigger", max_files).load(path)
    return files.select(*ARRIVAL, F.lit(name).alias("feed", metadata={"feed": name}))


def stream_topic(spark: SparkSession, options: dict[str, str], fmt: str = "kafka") -> DataFrame:
    """A message source (Kafka, or an Event Hub through its Kafka endpoint)."""
    return spark.readStream.format(fmt).options(**options).load()


def parse_messages(messages: DataFrame, name: str) -> DataFrame:
    """Feed columns from JSON message values, with topic, offset and event time kept."""
    body = F.from_json(F.col("value").cast("string"), schema_ddl(name, strings_only=True))
    return messages.select(
        body.alias("body"),
        "topic",
        "partition",
        "offset",
        F.col("timestamp").alias("event_ts"),
    ).select(*[f"body.`{c}`" for c in SCHEMAS[name]], "topic", "partition", "offset", "event_ts")


def split_messages(messages: DataFrame, name: str) -> tuple[DataFrame, DataFrame]:
    """(feed rows, dead letters) of JSON messages; together they are all messages.

    A feed row has the declared columns as text and in ``rest`` (VARIANT) the fields beyond
    them. A dead letter keeps its raw value and the reason: no value, unreadable JSON, not an
    object, or none of the declared fields. Both keep topic, partition, offset and event time.
    """
    place = ["topic", "partition", "offset", F.col("timestamp").alias("event_ts")]
    text = F.col("value").cast("string")
    fields = F.from_json(text, "map<string,string>")
    tagged = messages.withColumns({"text_": text, "json_": F.try_parse_json(text)}).withColumn(
        "fields_", F.when(F.schema_of_variant("json_").startswith("OBJECT"), fields)
    )
    known = F.array(*[F.lit(c) for c in SCHEMAS[name]])
    reason = (
        F.when(F.col("text_").isNull(), "no value")
        .when(F.col("json_").isNull(), "unreadable JSON")
        .when(F.col("fields_").isNull(), "not an object")
        .when(~F.arrays_overlap(F.map_keys("fields_"), known), "no declared field")
    )
    judged = tagged.withColumn("reason", reason)
    beyond = F.map_filter("fields_", lambda k, v: ~F.array_contains(known, k))
    good = judged.filter(F.col("reason").isNull()).select(
        *[F.col("fields_").getItem(c).alias(c) for c in SCHEMAS[name]],
        F.when(F.size(beyond) > 0, F.try_parse_json(F.to_json(beyond))).alias("rest"),
        *place,
    )
    dead = judged.filter(F.col("reason").isNotNull()).select(F.col("text_").alias("raw"), "reason", *place)
    return good, dead


# Arrival order of a message row.
MESSAGE_ORDER = ("event_ts", "topic", "partition", "offset")

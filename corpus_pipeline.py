"""A training corpus from raw documents: five stages, each written and read again.

Each stage takes (spark, docs, sf_dir) and returns all rows it keeps; all but the last
return the columns of ``documents``.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rollbook.llm import jaccard, mixing, packing, pii, quality
from rollbook.llm.common import docs_table, keep, release, shared_dir
from rollbook.llm.queries import tokenizer_file


NEAR_NGRAM, NEAR_PERCENT = 5, 80  # near copies: words of a shingle, and what texts share


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Quality rules with certified cutoffs; documents that they reject go.

    A null or empty text has no words and goes; texts are judged whole, whatever their length.
    Repeated rows and rows without a doc_id are judged one by one. Without labels the base
    rules decide alone; an empty table stays so.
    """
    return quality.good_documents(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """N-gram Jaccard join; of each group of near copies the smallest doc_id stays.

    Near copies share 80 percent of their five-word shingles. Documents that belong to no
    group stay, those without a doc_id, a text or a word too. Rows that repeat a doc_id that
    stays all stay. Texts are compared whole, whatever their length; an empty table stays so.
    """
    found = jaccard.jaccard_components(docs, ngram=NEAR_NGRAM, percent=NEAR_PERCENT)
    gone = found.filter(F.col("doc_id") != F.col("component_id")).select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data and secrets are replaced by the name of their kind.

    No row goes. Null and empty texts stay as they are, whole texts of any length are searched,
    repeated rows one by one. ``n_chars`` follows the text; an empty table stays so.
    """
    return pii.redact(docs, pii.train_field(docs))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources mixed to their targets; a document is there as often as the mix takes it.

    The mix is drawn without the texts, which are shuffled once, to meet its decisions.
    Rows that agree in id, source and size share what the mix takes of them. A text
    without words is taken once an epoch; long texts are taken whole or not at all; an empty
    table stays so.
    """
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    key = F.xxhash64("doc_id", "source", "size").alias("key_")
    sized = keep(mixing.sizes(docs), "sizes")
    mixed = mixing.mix(sized, mixing.quality_weights(labels))
    drawn = (
        mixed.groupBy(key)
        .agg(F.sum("copies").alias("copies_"), F.count(F.lit(1)).alias("rows_"))
        .filter(F.col("copies_") > 0)
    )
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row_")
    keyed = mixing.sizes(docs, F.col("doc_id"), F.col("source"), row).select(key, "row_")
    place = F.row_number().over(Window.partitionBy("key_").orderBy("key_"))
    each = F.floor(F.col("copies_") / F.col("rows_"))
    more = (F.col("place_") <= F.col("copies_") % F.col("rows_")).cast("int")
    times = F.array_repeat(F.lit(True), (each + more).cast("int"))
    met = keyed.withColumn("place_", place).join(drawn, "key_")
    return met.select("row_", F.explode(times).alias("copy_")).select("row_.*")


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document tokenised and packed into sequences of 1024 tokens.

    A null or empty text is its end token alone; long texts are cut into pieces; repeated rows
    are packed one by one. An empty table gives no pieces.
    """
    return packing.pack(packing.tokenise(docs, tokenizer_file()))


STAGES = [
    ("quality rules", keep_good),
    ("n-gram Jaccard join", one_of_each),
    ("personal data", mask_personal_data),
    ("source mixing", mix_sources),
    ("best-fit packing", pack_sequences),
]

# Certified cutoffs, a trained field and a tokenizer are beyond SQL: tests use brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder; each result is written to the shared folder."""
    docs = docs_table(spark, sf_dir)
    base = f"{shared_dir(spark)}/rollbook-pipeline/{uuid.uuid4().hex}"
    for k, (_, stage) in enumerate(STAGES):
        out = stage(spark, docs, sf_dir)
        out.write.parquet(f"{base}/{k}")
        release(spark)  # what the stage has put down on its way
        docs = spark.read.schema(out.schema).parquet(f"{base}/{k}")
    return docs

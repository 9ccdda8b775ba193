"""Proposals for alias tables: rare spellings beside frequent ones."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

DISTANCE = 1
TIMES = 10  # as often as the misspelt label the proposed one occurs at least


def deletions(label: Column, distance: int) -> Column:
    """The label and all texts that up to ``distance`` deletions make of it.

    Two labels within that edit distance share one of these texts.
    """

    def one_less(text: Column) -> Column:
        cut = F.transform(
            F.sequence(F.lit(1), F.length(text)),
            lambda i: F.concat(F.substring(text, F.lit(1), i - 1), F.substring(text, i + 1, F.length(text))),
        )
        return F.when(F.length(text) > 0, cut).otherwise(F.array().cast("array<string>"))

    found = F.array(label)
    for _ in range(distance):
        found = F.array_distinct(F.concat(found, F.flatten(F.transform(found, one_less))))
    return found


def propose_aliases(df: DataFrame, label: str, distance: int = DISTANCE, times: int = TIMES) -> DataFrame:
    """(alias, canonical, n_alias, n_canonical, distance): for each label that is misspelt by all
    signs the most frequent label within the edit distance.

    Labels are compared trimmed and in lower case; null and blank ones are left out. A
    proposal occurs ``times`` as often as the label, so that similar names of their own are not
    taken for misspellings; ties go to the nearer label, then to the smaller. Distinct labels
    meet through an index of deletions, never all with all. Of the labels that share a deletion
    only those meet of which one is ``times`` as frequent as the other.
    """
    counts = (
        df.select(F.lower(F.trim(label)).alias("label"))
        .filter(F.col("label") != "")
        .groupBy("label")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    index = counts.select("label", "n", F.explode(deletions(F.col("label"), distance)).alias("part"))
    rare = index.select("part", F.col("label").alias("alias"), F.col("n").alias("n_alias"))
    common = index.select("part", F.col("label").alias("canonical"), F.col("n").alias("n_canonical"))
    most = index.groupBy("part").agg(F.max("n").alias("most"))
    # a part whose most frequent label is not frequent enough for an alias pairs nothing
    rare = rare.join(most, "part").filter(F.col("most") >= times * F.col("n_alias")).drop("most")
    met = rare.join(common, "part").filter(F.col("n_canonical") >= times * F.col("n_alias"))
    far = F.levenshtein("alias", "canonical").cast("int")
    pairs = met.drop("part").distinct().withColumn("distance", far).filter(F.col("distance") <= distance)
    best = Window.partitionBy("alias").orderBy(F.desc("n_canonical"), "distance", "canonical")
    return (
        pairs.withColumn("rank", F.row_number().over(best))
        .filter(F.col("rank") == 1)
        .select("alias", "canonical", "n_alias", "n_canonical", "distance")
    )

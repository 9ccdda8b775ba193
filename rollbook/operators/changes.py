"""Change logs: the latest state of every key from inserts, updates and deletes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def latest(log: DataFrame, keys: Sequence[str], sequence: str, kind: str = "kind", deleted: str = "delete") -> DataFrame:
    """(keys, sequence, deleted, other columns): of each key the change with the largest number.

    A change holds the whole row. Changes may come in any order and more than once. Where two
    of a key have one number the delete wins, then the larger row. A delete stays as a mark, so
    that an older change that comes late does not bring the row back. One combined aggregate:
    a key with very many changes leaves each map task as one row. Keys match as they are,
    nulls too; changes without a number are older than all others.
    """
    values = [c for c in log.columns if c not in (*keys, sequence, kind, "deleted")]
    gone = F.coalesce(F.col(kind) == deleted, F.lit(False))
    if "deleted" in log.columns:
        gone = gone | F.coalesce(F.col("deleted"), F.lit(False))
    change = F.struct(F.col(sequence), gone.alias("deleted"), *values)
    return log.groupBy(*keys).agg(F.max(change).alias("change")).select(*keys, "change.*")


def merge(*states: DataFrame, keys: Sequence[str], sequence: str) -> DataFrame:
    """States of ``latest`` made one, whatever their order: the same as one over all changes."""
    every = states[0]
    for state in states[1:]:
        every = every.unionByName(state)
    return latest(every.withColumn("kind", F.lit(None).cast("string")), keys, sequence)


def live(state: DataFrame, sequence: str) -> DataFrame:
    """The rows of a state that are not deleted."""
    return state.filter(~F.col("deleted")).drop("deleted", sequence)

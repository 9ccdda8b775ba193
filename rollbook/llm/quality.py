"""Quality rules with risk-controlled cutoffs, in built-in column expressions only.

Every rule rejects a text whose measure exceeds a cutoff. Cutoffs come from a labelled
holdout. A quarter of it, by a hash of the doc_id, chooses in each stratum the cutoffs that
part good from bad best, and their order. The rest certifies them: from the loosest cutoff of
the first rule to the strictest of the last, rejections only grow, and an exact binomial test
shows for each step that all rules together reject at most a share ``alpha`` of good texts.
The last step before the first failure is used. Tests in a fixed order share one level, so it
is divided by the number of labelled strata only. A stratum without a certified step keeps
everything.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollbook.llm.common import keep, let, words

ALPHA = 0.04  # most good texts a stratum may lose, over all rules
DELTA = 0.05  # chance that any certified cutoff breaks its promise
GRID = (0.02, 0.05, 0.1, 0.15, 0.2, 0.3, 0.4, 0.6, 0.8, 1.0)
RULES = ("symbol_ratio", "shout_ratio", "line_ratio", "repeat_ratio")
CHOOSE_ONE_IN = 4  # labelled documents choose the cutoffs, the others certify them
MIN_GAP = 0.05  # a cutoff must catch this much more of the bad than of the good

BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _repeats(w: Column) -> Column:
    """Words that lie in a 3-word window found twice or more, the first included.

    Windows are sorted by a 64-bit hash; neighbours count as equal if their words are.
    """

    def same(a: Column, b: Column) -> Column:
        ends = [F.get(w, a["p"] + k) == F.get(w, b["p"] + k) for k in range(3)]
        return (a["h"] == b["h"]) & ends[0] & ends[1] & ends[2]

    def found(s: Column) -> Column:
        hit = F.filter(
            s,
            lambda x, i: F.coalesce(same(x, F.get(s, i - 1)), F.lit(False))
            | F.coalesce(same(x, F.get(s, i + 1)), F.lit(False)),
        )
        return let(F.array_sort(F.transform(hit, lambda x: x["p"])), covered)

    def covered(p: Column) -> Column:
        gaps = F.transform(p, lambda x, i: F.least(F.lit(3), F.coalesce(F.get(p, i + 1) - x, F.lit(3))))
        return F.aggregate(gaps, F.lit(0).cast("long"), lambda a, g: a + g)

    windows = F.transform(
        F.sequence(F.lit(0), F.size(w) - 3),
        lambda i: F.struct(
            F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)).alias("h"), i.alias("p")
        ),
    )
    return F.when(F.size(w) >= 4, let(F.array_sort(windows), found)).otherwise(
        F.lit(0).cast("long")
    )


def _dup_lines(text: Column) -> Column:
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    return let(lines, lambda x: (F.size(x) - F.size(F.array_distinct(x))).cast("long"))


def _without(text: Column, chars: str) -> Column:
    return F.length(text) - F.length(F.regexp_replace(text, chars, ""))


def measures(text: Column) -> Column:
    """Struct of the base counts and the rules' ratios of a whole text; null is empty."""
    text = F.coalesce(text, F.lit(""))

    def of(w: Column) -> Column:
        return F.struct(
            F.size(w).cast("long").alias("n_words"),
            F.aggregate(w, F.lit(0).cast("long"), lambda a, x: a + F.length(x)).alias("word_chars"),
            _without(text, r"[#*$%&|<>]").cast("long").alias("n_symbols"),
            _dup_lines(text).alias("n_dup_lines"),
            _repeats(w).alias("n_repeat_words"),
            _without(text, "[A-Z]").cast("long").alias("n_capitals"),
            F.size(F.split(text, "\n")).cast("long").alias("n_lines"),
        )

    return let(words(text), of)


def measured(docs: DataFrame, *carry: Column) -> DataFrame:
    """The ``carry`` columns (default doc_id), the stratum, base counts, ``base_failed``, rules.

    The stratum is the language column; a null language is a stratum of its own.
    """
    carry = carry or (F.col("doc_id"),)
    rows = docs.select(
        *carry,
        F.coalesce(F.concat(F.lit("lang "), F.col("lang")), F.lit("none")).alias("stratum"),
        measures(F.col("text")).alias("m_"),
    )
    carried = [f"`{c}`" for c in rows.columns[:-1]]
    m = rows.select(*carried, "m_.*")
    n = F.greatest(F.col("n_words"), F.lit(1))
    return m.select(
        *carried,
        *BASE,
        ((F.col("n_words") < 50) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 50)).alias(
            "base_failed"
        ),
        (F.col("n_symbols") / n).alias("symbol_ratio"),
        (F.col("n_capitals") / F.greatest(F.col("word_chars"), F.lit(1))).alias("shout_ratio"),
        (F.col("n_dup_lines") / F.greatest(F.col("n_lines"), F.lit(1))).alias("line_ratio"),
        (F.col("n_repeat_words") / n).alias("repeat_ratio"),
    )


def _log_factorial(n: Column) -> Column:
    """ln n!, by a table below 20 and Stirling's series above (error below 1e-12)."""
    x = n.cast("double")
    small = F.log(F.factorial(F.least(n, F.lit(20)).cast("int")).cast("double"))
    series = (
        x * F.log(x) - x + 0.5 * F.log(x * (2 * math.pi))
        + 1 / (12 * x) - 1 / (360 * x * x * x) + 1 / (1260 * x * x * x * x * x)
    )
    return F.when(n <= 20, small).otherwise(series)


def binomial_tail(k: Column, n: Column, share: float) -> Column:
    """P(Bin(n, share) <= k), summed down from k; 1 where k is at least the mean.

    Below the mean the terms fall off from k downwards; those more than forty
    deviations away add nothing to a double.
    """
    top = _log_factorial(n) - _log_factorial(k) - _log_factorial(n - k)
    first = top + k * math.log(share) + (n - k) * math.log1p(-share)
    reach = F.least(k, (40 * F.sqrt(n * share)).cast("long") + 40)
    odds = (1 - share) / share
    total = F.aggregate(
        F.sequence(F.lit(0).cast("long"), reach),
        F.struct(F.lit(0.0).alias("sum"), F.lit(1.0).alias("term")),
        lambda a, j: F.struct(
            (a["sum"] + a["term"]).alias("sum"),
            (a["term"] * ((k - j) * odds / (n - k + j + 1))).alias("term"),
        ),
        lambda a: a["sum"],
    )
    return F.when(k >= n * share, F.lit(1.0)).otherwise(F.exp(first + F.log(total)))


def cutoffs(
    texts: DataFrame,
    labels: DataFrame,
    alpha: float = ALPHA,
    delta: float = DELTA,
    grid: tuple[float, ...] = GRID,
) -> DataFrame:
    """(stratum, one cutoff per rule or null): the certified cutoffs, one row per stratum.

    ``texts`` is the result of ``measured``. A document counts as bad if any of its labels
    says quality 0, as good if all say 1; null labels and labels without a document count
    nowhere. Texts that fail the base rules are no part of the promise. A rule without a
    certified cutoff is null and rejects nothing.
    """
    marks = (
        labels.filter(F.col("doc_id").isNotNull() & F.col("quality").isNotNull())
        .groupBy("doc_id")
        .agg((F.min("quality") > 0).alias("good"))
    )
    chooses = F.pmod(F.xxhash64(F.col("doc_id").cast("string")), F.lit(CHOOSE_ONE_IN)) == 0
    marked = keep(
        texts.filter(~F.col("base_failed"))
        .join(marks, "doc_id")
        .select("stratum", "good", chooses.alias("chooses"), *RULES),
        "labelled-measures",
    )
    steps = _steps(marked.filter("chooses"), alpha, grid)
    hit = F.lit(False)
    for r in RULES:
        hit = hit | F.coalesce(F.col(r) > F.col(f"cut_{r}"), F.lit(False))
    cuts = F.struct(*[f"cut_{r}" for r in RULES])
    counts = (
        marked.filter(F.col("good") & ~F.col("chooses"))
        .join(steps, "stratum")
        .groupBy("stratum", "step", cuts.alias("cuts"))
        .agg(F.count(F.lit(1)).alias("n"), F.count_if(hit).alias("k"))
    )
    strata = marked.select("stratum").distinct().agg(F.count(F.lit(1))).scalar()
    level = F.lit(delta) / F.greatest(strata, F.lit(1))
    # each step rejects what the one before does and more, so those that fail are the last ones
    return (
        counts.filter(binomial_tail(F.col("k"), F.col("n"), alpha) <= level)
        .groupBy("stratum")
        .agg(F.max_by("cuts", "step").alias("cuts"))
        .select("stratum", "cuts.*")
    )


def _steps(marked: DataFrame, alpha: float, grid: tuple[float, ...]) -> DataFrame:
    """(stratum, step, one cutoff per rule or null): nested rejections in the order of their tests.

    Rules that lose the fewest good texts come first. A rule goes from the loosest cutoff to
    the one with the widest gap between bad and good that loses no more than ``alpha``.
    """
    tests = F.array(
        *[
            F.struct(F.lit(r).alias("rule"), F.lit(c).alias("cutoff"), (F.col(r) > c).alias("hit"))
            for r in RULES
            for c in grid
        ]
    )
    counts = (
        marked.select("stratum", "good", F.explode(tests).alias("t"))
        .groupBy("stratum", "t.rule", "t.cutoff")
        .agg(
            F.count_if("good").alias("n"),
            F.count_if(F.col("good") & F.col("t.hit")).alias("k"),
            F.count_if(~F.col("good")).alias("bad"),
            F.count_if(~F.col("good") & F.col("t.hit")).alias("caught"),
        )
    )
    lost = F.col("k") / F.greatest("n", F.lit(1))
    gap = F.col("caught") / F.greatest("bad", F.lit(1)) - lost
    chosen = (
        counts.filter((gap >= MIN_GAP) & (lost <= alpha))
        .groupBy("stratum", "rule")
        .agg(F.max_by(F.struct(lost.alias("lost"), (-gap).alias("gap"), "cutoff"), F.struct(gap, "cutoff")).alias("best"))
        .groupBy("stratum")
        .agg(F.array_sort(F.collect_list(F.struct("best.lost", "best.gap", "rule", "best.cutoff"))).alias("order"))
    )
    one = chosen.select("stratum", "order", F.posexplode("order").alias("place", "at"))
    values = F.filter(F.array(*[F.lit(c) for c in grid]), lambda c: c >= F.col("at.cutoff"))
    each = one.select("stratum", "order", "place", "at.rule", F.explode(values).alias("cutoff"))

    def cut(rule: str) -> Column:
        done = F.filter("order", lambda x, i: (x["rule"] == rule) & (i < F.col("place")))
        return F.when(F.col("rule") == rule, F.col("cutoff")).otherwise(F.get(done, F.lit(0))["cutoff"])

    return each.select(
        "stratum",
        F.struct("place", (-F.col("cutoff")).alias("cutoff")).alias("step"),
        *[cut(r).alias(f"cut_{r}") for r in RULES],
    )


def judged(texts: DataFrame, limits: DataFrame) -> DataFrame:
    """``texts`` with ``kept``: passes the base rules and every certified cutoff of its stratum."""
    over = F.lit(False)
    for r in RULES:
        over = over | F.coalesce(F.col(r) > F.col(f"cut_{r}"), F.lit(False))
    return texts.join(limits, "stratum", "left").withColumn("kept", ~(F.col("base_failed") | over))


def quality_verdicts(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """One row per document: base counts, rule measures, ``base_failed`` and ``kept``.

    Needs doc_id, text, lang of the documents and doc_id, quality of the labels; other
    columns are ignored. Null texts count as empty and fail the base rules. Repeated rows
    are judged one by one. Texts are read once: their measures are kept in the shared folder.
    """
    texts = keep(measured(docs), "measures")
    return judged(texts, cutoffs(texts, labels, **options))


def good_documents(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """The rows of ``docs``, all columns, that ``quality_verdicts`` keeps.

    Texts are measured once and kept in the shared folder with their measures; the
    cutoffs read the measures only, and no text is shuffled.
    """
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row_")
    texts = keep(measured(docs, F.col("doc_id"), row), "measures")
    return judged(texts, cutoffs(texts, labels, **options)).filter("kept").select("row_.*")

"""Quality rules with risk-controlled thresholds, by DataFrame functions only."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import SPACES, WORD, materialize, table

SYMBOLS = r"[#*$%&|<>]"
#: Rules: the rate that each judges, and its laxest cutoff. A rule rejects rates at or above its cutoff.
RULES = {"symbol_rate": 3.0, "repeat_rate": 0.5, "dup_line_rate": 1.0, "bang_rate": 2.0, "upper_rate": 0.95}
#: Each next cutoff of a rule is this part of the one before, so many times; fixed before any label is seen.
TIGHTER, LEVELS = 0.85, 32
#: Strata by number of words: up to these, and above.
STRATA = [150, 600]
#: The verdict rejects at most this part of the good documents of a stratum, with probability 1 - DELTA for all strata.
ALPHA, DELTA = 0.03, 0.05


def let(value: Column, body) -> Column:
    """body(value) with value computed once."""
    return F.transform(F.array(value), body)[0]


def repeated_words(words: Column) -> Column:
    """Words that lie in 3-word windows found twice or more in the array; windows are compared by 64-bit hash."""
    n = F.size(words)

    def hashes(w: Column) -> Column:
        at = F.sequence(F.lit(0), F.size(w) - 3)
        return F.transform(at, lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)))

    def covered(h: Column) -> Column:
        # windows sorted by hash; those with an equal neighbour occur twice or more
        return let(F.array_sort(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i")))), marked)

    def marked(s: Column) -> Column:
        last = F.size(s) - 1
        twice = F.filter(
            F.sequence(F.lit(0), last),
            lambda j: ((j > 0) & (F.get(s, j)["h"] == F.get(s, j - 1)["h"]))
            | ((j < last) & (F.get(s, j)["h"] == F.get(s, j + 1)["h"])),
        )
        return let(F.array_sort(F.transform(twice, lambda j: F.get(s, j)["i"])), spans)

    def spans(p: Column) -> Column:
        # each window adds the words before the next one's start, at most its own three
        start = F.struct(F.lit(-3).alias("at"), F.lit(0).cast("long").alias("n"))
        step = lambda acc, i: F.struct(i.alias("at"), (acc["n"] + F.least(F.lit(3), i - acc["at"])).alias("n"))
        return F.aggregate(p, start, step)["n"]

    def checked(h: Column) -> Column:
        plain = F.size(F.array_distinct(h)) == F.size(h)
        return F.when(plain, F.lit(0).cast("long")).otherwise(covered(h))

    return F.when(n < 4, F.lit(0).cast("long")).otherwise(let(hashes(words), checked))


def measures(docs: DataFrame) -> DataFrame:
    """docs (doc_id, text) to the counts that the rules use; a null text has none of anything."""
    text = F.coalesce(F.col("text"), F.lit(""))
    trimmed = F.regexp_replace(text, f"^{SPACES}|{SPACES}$", "")
    words = F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, SPACES))
    base = docs.select(F.col("doc_id"), text.alias("_text"), words.alias("_words"))
    return base.select(
        "doc_id",
        F.size("_words").cast("long").alias("n_words"),
        F.aggregate("_words", F.lit(0).cast("long"), lambda a, x: a + F.length(x)).alias("word_chars"),
        F.regexp_count("_text", F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
        let(F.filter(F.split("_text", "\n"), lambda x: x.rlike(WORD)), lambda x: F.size(x) - F.size(F.array_distinct(x)))
        .cast("long")
        .alias("n_dup_lines"),
        repeated_words(F.col("_words")).alias("n_repeat_words"),
        F.size(F.split("_text", "\n")).cast("long").alias("n_lines"),
        F.regexp_count("_text", F.lit("!")).cast("long").alias("n_bangs"),
        F.regexp_count("_text", F.lit(r"\p{Lu}")).cast("long").alias("n_upper"),
    )


def with_rates(measured: DataFrame) -> DataFrame:
    words = F.greatest(F.col("n_words"), F.lit(1))
    return measured.withColumns(
        {
            "base_failed": (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words")),
            "symbol_rate": F.col("n_symbols") / words,
            "repeat_rate": F.col("n_repeat_words") / words,
            "dup_line_rate": F.col("n_dup_lines") / F.col("n_lines"),
            "bang_rate": F.col("n_bangs") / words,
            "upper_rate": F.col("n_upper") / F.greatest(F.col("word_chars"), F.lit(1)),
            "stratum": sum((F.col("n_words") > x).cast("int") for x in STRATA),
        }
    )


def most_rejections(n: int, alpha: float, delta: float) -> int:
    """The largest k for which k rejections of n good documents show, at level delta, a rate below alpha; -1 if none.

    That is the exact (Clopper-Pearson) upper bound: P(at most k of n) <= delta at rate alpha.
    """
    log_q, log_r = math.log1p(-alpha), math.log(alpha) - math.log1p(-alpha)
    term, total, k = n * log_q, 0.0, -1
    while k < n:
        total += math.exp(term)
        if total > delta:
            return k
        k += 1
        term += math.log((n - k) / (k + 1)) + log_r if k < n else 0.0
    return n


def cutoffs() -> list[tuple[str, float]]:
    """(rule, cutoff) in the order in which they are tightened: every rule by one level, then every rule by the next."""
    return [(rule, lax * TIGHTER**level) for level in range(LEVELS) for rule, lax in RULES.items()]


def first_rejection() -> Column:
    """The step, from 1 on, of `cutoffs` at which a document is rejected first; null if it never is."""

    def level_of(rule: str, lax: float) -> Column:
        # cutoffs fall, so the number of those above the rate is the level at which it is met
        grid = F.array(*[F.lit(lax * TIGHTER**level) for level in range(LEVELS)])
        return F.size(F.filter(grid, lambda cut: cut > F.col(rule)))

    levels = [level_of(rule, lax) for rule, lax in RULES.items()]
    return F.least(*[F.when(level < LEVELS, level * len(RULES) + (i + 1)) for i, level in enumerate(levels)])


def thresholds(labelled: DataFrame, alpha: float = ALPHA, delta: float = DELTA) -> dict[int, int]:
    """For each stratum the last step of `cutoffs` that is shown safe; labelled has stratum, step, base_failed, quality.

    A step stands for all rules with the cutoffs that they have by then: what is tested is the verdict, the union of
    the rules, and not each rule for itself. One aggregate counts the good (quality 1) documents that each step is the
    first to reject, a table whose size depends on the grids alone. Strata are tested at delta / strata (Bonferroni);
    within one, steps are tested in their order and the first that fails ends the test (fixed sequence), which needs no
    further correction. A stratum without enough labels takes no step.
    """
    good = labelled.where((F.col("quality") == 1) & ~F.col("base_failed"))
    seen = good.groupBy("stratum", "step").count().collect()
    chosen: dict[int, int] = {}
    for stratum in {r["stratum"] for r in seen}:
        by = {r["step"]: r["count"] for r in seen if r["stratum"] == stratum}
        most = most_rejections(sum(by.values()), alpha, delta / (len(STRATA) + 1))
        rejected = 0
        for step in range(1, len(RULES) * LEVELS + 1):
            rejected += by.get(step, 0)
            if rejected > most:
                break
            chosen[stratum] = step
    return chosen


def quality_rules(docs: DataFrame, labels: DataFrame, alpha: float = ALPHA, delta: float = DELTA) -> DataFrame:
    """docs (doc_id, text) with counts, base_failed and kept.

    Cutoffs come from `labels` (doc_id, quality) of all labelled documents: with probability 1 - delta the rules
    together reject at most the part alpha of good documents of any stratum (by number of words) beyond the base rules.
    kept is false if base_failed or if any rate is at or above its stratum's cutoff. Documents without labels don't
    change the cutoffs; without enough labels only the base rules hold. Null texts have no words and fail; rows of one
    doc_id are judged each by its own text; a very long text is split into words whole, in one task; other columns are
    ignored; empty in, empty out.
    """
    rates = with_rates(materialize(measures(docs), "rules")).withColumn("step", first_rejection())
    known = labels.where("quality is not null and doc_id is not null").groupBy("doc_id").agg(F.max("quality").alias("quality"))
    chosen = thresholds(rates.join(known, "doc_id"), alpha, delta)
    failed = F.lit(False)
    for stratum, step in sorted(chosen.items()):
        failed = failed | ((F.col("stratum") == stratum) & F.coalesce(F.col("step") <= step, F.lit(False)))
    return rates.withColumn("kept", ~F.col("base_failed") & ~failed)


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and verdicts of all documents: doc_id, n_words, four counts, base_failed, kept."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = quality_rules(docs, table(spark, sf_dir, "labels"))
    return out.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )

"""Quality rules whose cutoffs are chosen with a guarantee from labelled holdouts.

Base rules are fixed. The others compare a score with a cutoff, and the cutoff
is set per stratum (language): labelled good documents are the holdout, and a
cutoff is safe if so few of them fail it that a false rejection rate above the
permitted one would be rejected by the exact binomial test. The level is split
over all strata and scores (Bonferroni); along the cutoffs of one score the test
goes from lenient to strict, and as stricter cutoffs reject no fewer documents
the safe ones are a prefix, so testing them in that order costs no level.
Among the safe cutoffs the one that rejects the most bad documents less good
ones counts, on ties the most lenient; a score that separates nothing rejects
nothing, and a stratum with too few labels rejects by the base rules alone.
Column functions only.

Null and empty texts have no words, so they fail the base rule. Null languages
are one stratum. Repeated rows are judged alike; a document labelled twice
counts with each label; null labels don't count. Without labels or documents no
cutoff is set.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from galewatch.llm.shared import BLANKS, landed, split_words

LEAST_WORDS = 20
MOST_REPEATED = 30  # of 100 words
SHINGLE = 8  # words
# Per thousand; from lenient to strict.
CUTOFFS = (900, 700, 500, 400, 300, 200, 150, 100, 75, 50, 30, 20, 10, 5)
SCORES = ("symbols", "marks", "capitals", "dup_lines", "repeats")


@dataclass(frozen=True)
class Risk:
    """False rejection of good documents that each stratum may see by all scores together, and the chance to be wrong."""

    rejected: float = 0.01
    level: float = 0.05


def thousandths(part: Column, whole: Column) -> Column:
    """Floor of 1000 part / whole, 0 for an empty whole."""
    return F.when(whole > 0, F.floor(1000 * part / whole)).otherwise(F.lit(0)).cast("long")


def left_of(text: Column, dropped: str) -> Column:
    return F.length(F.regexp_replace(text, dropped, ""))


def measured(documents: DataFrame) -> DataFrame:
    """Documents with a struct ``_measures``: counts of the base rules and scores per thousand."""
    text = F.coalesce(F.col("text"), F.lit(""))
    out = documents.withColumn("_words", split_words(F.col("text"), BLANKS))
    # Hashes of 8-word windows; the sort that finds repeats runs only where two are equal.
    window = lambda _, i: F.xxhash64(*[F.get("_words", i + j) for j in range(SHINGLE)])
    full = F.slice("_words", SHINGLE, F.greatest(F.size("_words") - SHINGLE + 1, F.lit(0)))
    out = out.withColumn("_windows", F.when(F.size("_words") >= SHINGLE, F.transform(full, window)))
    repeated = F.size(F.array_distinct("_windows")) < F.size("_windows")
    placed = F.transform("_windows", lambda h, i: F.struct(h.alias("h"), i.alias("i")))
    out = out.withColumn("_sorted", F.when(repeated, F.array_sort(placed)))
    near = lambda i: F.get("_sorted", i)["h"]
    twice = F.filter(
        "_sorted", lambda x, i: F.coalesce(x["h"] == near(i - 1), F.lit(False)) | F.coalesce(x["h"] == near(i + 1), F.lit(False))
    )
    places = F.array_sort(F.transform(twice, lambda x: x["i"]))
    start = F.struct(F.lit(0).alias("upto"), F.lit(0).alias("n"))
    step = lambda a, i: F.struct(
        (i + SHINGLE).alias("upto"), (a["n"] + F.lit(SHINGLE) - F.greatest(a["upto"] - i, F.lit(0))).alias("n")
    )
    out = out.withColumn("_repeated", F.coalesce(F.aggregate(places, start, step, lambda a: a["n"]), F.lit(0)))
    lines = F.filter(F.split(text, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    out = out.withColumn("_lines", lines)
    n_words, n_lines = F.size("_words"), F.size("_lines")
    dup_lines = n_lines - F.size(F.array_distinct("_lines"))
    out = out.withColumn(
        "_counts",
        F.struct(
            n_words.alias("n_words"),
            left_of(text, BLANKS).alias("word_chars"),
            left_of(text, r"[^#*$%&|<>]+").alias("n_symbols"),
            left_of(text, r"[^!?]+").alias("n_marks"),
            left_of(text, r"[^A-Z]+").alias("n_capitals"),
            dup_lines.alias("n_dup_lines"),
            n_lines.alias("n_lines"),
            F.col("_repeated").alias("n_repeat_words"),
        ),
    )
    c = F.col("_counts")
    measures = F.struct(
        *[c[name].cast("long").alias(name) for name in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")],
        thousandths(c["n_symbols"], c["word_chars"]).alias("symbols"),
        thousandths(c["n_marks"], c["word_chars"]).alias("marks"),
        thousandths(c["n_capitals"], c["word_chars"]).alias("capitals"),
        thousandths(c["n_dup_lines"], c["n_lines"]).alias("dup_lines"),
        thousandths(c["n_repeat_words"], c["n_words"]).alias("repeats"),
        ((c["n_words"] < LEAST_WORDS) | (100 * c["n_repeat_words"] > MOST_REPEATED * c["n_words"])).alias("base_failed"),
    )
    # Out of an array, so that a filter on measures isn't pushed below and doesn't repeat what they are made of.
    return out.select(*documents.columns, F.explode(F.array(measures)).alias("_measures"))


def binomial_tail(n: Column, k: Column, rate: Column) -> Column:
    """P(X <= k) for X ~ Bin(n, rate), summed exactly term by term in logarithms."""
    ratio = F.log(rate / (1 - rate))
    begin = F.struct((n * F.log(1 - rate)).alias("term"), F.exp(n * F.log(1 - rate)).alias("sum"))

    def step(a, i):
        term = a["term"] + F.log((n - i + 1) / i) + ratio
        return F.struct(term.alias("term"), (a["sum"] + F.exp(term)).alias("sum"))

    rest = F.when(k > 0, F.sequence(F.lit(1).cast("long"), k)).otherwise(F.array().cast("array<bigint>"))
    return F.aggregate(rest, begin, step, lambda a: a["sum"])


def cutoffs(measures: DataFrame, labels: DataFrame, risk: Risk = Risk()) -> DataFrame:
    """stratum, and for each score its cutoff (null: none is safe or useful). ``measures``: doc_id, lang, _measures."""
    labels = labels.where("quality is not null").select(F.col("doc_id").alias("_label_id"), F.col("quality").alias("_good"))
    held = measures.select("doc_id", F.col("lang").alias("stratum"), "_measures.*").where("not base_failed")
    held = held.join(labels, F.col("doc_id") == F.col("_label_id"))
    fails = [
        F.count(F.when((F.col(score) > cutoff) & (F.col("_good") == good), 1)).alias(f"{score}_{cutoff}_{good}")
        for score in SCORES
        for cutoff in CUTOFFS
        for good in (0, 1)
    ]
    counted = held.groupBy("stratum").agg(F.count(F.when(F.col("_good") == 1, 1)).alias("n"), *fails)
    trials = F.explode(
        F.array(
            *[
                F.struct(
                    F.lit(score).alias("score"),
                    F.lit(cutoff).cast("long").alias("cutoff"),
                    F.col(f"{score}_{cutoff}_1").alias("good"),
                    F.col(f"{score}_{cutoff}_0").alias("bad"),
                )
                for score in SCORES
                for cutoff in CUTOFFS
            ]
        )
    )
    counted = landed(counted.select("stratum", "n", trials.alias("t")).select("stratum", "n", "t.*"), "trials")
    strata = counted.select("stratum").distinct().count()
    chance = binomial_tail(F.col("n"), F.col("good"), F.lit(risk.rejected / len(SCORES)))
    level = risk.level / (max(strata, 1) * len(SCORES))
    # No tail at k >= n * rate can be below the level: the sum stays short.
    hopeful = F.col("good") <= F.col("n") * (risk.rejected / len(SCORES))
    safe = counted.where(hopeful & (F.col("bad") > F.col("good"))).where(chance <= level)
    best = F.max_by("cutoff", F.struct(F.col("bad") - F.col("good"), F.col("cutoff")))
    return safe.groupBy("stratum").pivot("score", list(SCORES)).agg(best)


def judged(measures: DataFrame, chosen: DataFrame) -> DataFrame:
    """Rows of ``measures`` with a boolean ``_kept``."""
    chosen = chosen.withColumnsRenamed({score: f"_cut_{score}" for score in SCORES} | {"stratum": "_stratum"})
    out = measures.join(landed(chosen, "cutoffs"), F.col("lang").eqNullSafe(F.col("_stratum")), "left")
    failed = F.col("_measures.base_failed")
    for score in SCORES:
        failed = failed | F.coalesce(F.col(f"_measures.{score}") > F.col(f"_cut_{score}"), F.lit(False))
    return out.withColumn("_kept", ~failed).drop("_stratum", *[f"_cut_{score}" for score in SCORES])


def rules(documents: DataFrame, labels: DataFrame, risk: Risk = Risk()) -> DataFrame:
    """doc_id, lang, _measures, _kept of each row of documents; texts are read once."""
    narrow = landed(measured(documents.select("doc_id", "lang", "text")).drop("text"), "measures")
    return judged(narrow, cutoffs(narrow, labels, risk))


def without_rejected(documents: DataFrame, labels: DataFrame, risk: Risk = Risk()) -> DataFrame:
    """Documents, with all their columns, that pass base rules and cutoffs.

    They are stored with their measures, so that texts are measured once. The row
    stays in one column, so that no name of its own meets one of those made here.
    """
    packed = documents.select(F.struct("*").alias("row"), "doc_id", "lang", "text")
    whole = landed(measured(packed).drop("text"), "measured")
    chosen = cutoffs(whole.select("doc_id", "lang", "_measures"), labels, risk)
    kept = judged(whole, chosen).where("_kept")
    return kept.select(*[F.col("row").getField(name).alias(name) for name in documents.columns])

"""Lexicon sentiment in the published VADER manner (Hutto & Gilbert, ICWSM 2014), without Python per row.

A text is split once, its tokens meet the lexicon in a join, the rules look at
neighbours taken from the same row's token array, and the valences of a text
are summed. The tokens of a text never leave their task: the sum is combined
map-side and one small row per text goes through the exchange.

Valences are summed as whole multiples of 1e-8, so the result does not depend
on the order of addition.
"""

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from galewatch.functions import text as tx
from galewatch.functions import wordlists
from galewatch.functions.literals import listed, number, quoted
from galewatch.operators.sampling import first_per_class
from galewatch.sources.tables import parameter_table

Lexicon = DataFrame | Iterable[tuple[str, float]]

UNITS = 1e8

# Fixed value: what makes any word a negation.
NOT = "n't"


@dataclass(frozen=True)
class Rules:
    """Words and weights of the scoring rules; the defaults are the published ones."""

    intensifiers: Sequence[str] = tuple(sorted(wordlists.INTENSIFIERS))
    dampeners: Sequence[str] = tuple(sorted(wordlists.DAMPENERS))
    dampening_phrases: Sequence[str] = tuple(sorted(wordlists.DAMPENING_PHRASES))
    negations: Sequence[str] = tuple(sorted(wordlists.NEGATIONS))
    idioms: Mapping[str, float] = field(default_factory=lambda: dict(wordlists.IDIOMS))
    contrast: str = "but"
    boost: float = 0.293
    shout: float = 0.733
    negate: float = -0.74
    damping: Sequence[float] = (1.0, 0.95, 0.9)
    before_contrast: float = 0.5
    after_contrast: float = 1.5
    exclamation: float = 0.292
    most_exclamations: int = 4
    question: float = 0.18
    most_questions: int = 3
    many_questions: float = 0.96
    alpha: float = 15.0
    threshold: float = 0.05


PUBLISHED = Rules()


def text_hash(text: str) -> Column:
    return F.unhex(F.md5(F.col(text)))


def score_texts(
    df: DataFrame, text: str, lexicon: Lexicon, keys: Sequence[str] = (), rules: Rules = PUBLISHED
) -> DataFrame:
    """(keys..., text_hash, copies, score, sentiment): each distinct (keys, text) scored once.

    ``copies`` is how many rows share them, so counts stay whole when ids or
    texts repeat. Null texts are left out; texts without tokens or lexicon
    words score 0. ``lexicon`` is (word, valence), a frame or rows; case doesn't
    count, and of a repeated word the highest valence does. It is joined without
    a hint: broadcast while its size is below Catalyst's threshold, sort-merged
    beyond it. A frame of unknown size (made from a list of rows) counts as large.
    """
    group = [*keys, "text_hash"]
    tokens = tokens_in_context(df, text, keys, rules)
    entries = unique_entries(df.sparkSession, lexicon)
    met = tokens.join(entries, "word", "left")
    starts = F.col("pos").isNull() | (F.col("pos") == 0)
    judged = in_context(with_known(met.where(F.col("valence").isNotNull() | starts), entries), keys, rules)
    sums = judged.groupBy(*group).agg(
        F.count_if(starts).alias("copies"),
        F.sum(F.coalesce(F.round(F.col("valence") * UNITS).cast("long"), F.lit(0))).alias("units"),
        F.max("emphasis").alias("emphasis"),
    )
    total = F.col("units") / F.col("copies") / UNITS
    strong = sums.withColumn("total", total + F.signum(total) * F.col("emphasis"))
    strength = F.col("total")
    score = F.round(strength / F.sqrt(strength * strength + rules.alpha), 4)
    scored = strong.select(*group, "copies", score.alias("score"))
    return scored.withColumn("sentiment", sentiment_class(F.col("score"), rules.threshold))


def unique_entries(spark: SparkSession, lexicon: Lexicon) -> DataFrame:
    """(word, valence), each lower-case word once."""
    if isinstance(lexicon, DataFrame):
        lowered = lexicon.select(F.lower("word").alias("word"), F.col("valence").cast("double").alias("valence"))
        return lowered.groupBy("word").agg(F.max("valence").alias("valence"))
    highest: dict[str, float] = {}
    for word, valence in lexicon:
        highest[word.lower()] = max(float(valence), highest.get(word.lower(), float(valence)))
    return parameter_table(spark, ["word", "valence"], sorted(highest.items()) or [("", None)])


def with_known(hits: DataFrame, entries: DataFrame) -> DataFrame:
    """Adds ``known1`` to ``known3``: whether the word so many places before is itself in the lexicon.

    Only tokens that are in the lexicon get here, so these are small joins.
    """
    for back in (1, 2, 3):
        near = entries.select(F.col("word").alias(f"word{back}"), F.lit(True).alias(f"known{back}"))
        hits = hits.join(near, F.lower(f"prev{back}") == F.col(f"word{back}"), "left").drop(f"word{back}")
    return hits.withColumns({f"known{back}": F.coalesce(f"known{back}", F.lit(False)) for back in (1, 2, 3)})


def sentiment_class(score: Column, threshold: float = PUBLISHED.threshold) -> Column:
    """positive, negative or neutral; a score at a threshold is polar."""
    return F.when(score >= threshold, "positive").when(score <= -threshold, "negative").otherwise("neutral")


def sentiment_counts(scored: DataFrame) -> DataFrame:
    """(sentiment, count) of the scored rows, most frequent first."""
    counts = scored.groupBy("sentiment").agg(F.sum("copies").alias("count"))
    return counts.orderBy(F.col("count").desc(), "sentiment")


def sentiment_samples(
    df: DataFrame, scored: DataFrame, text: str, keys: Sequence[str] = (), n: int = 5
) -> DataFrame:
    """(keys..., text, sentiment, score, rank): the first n rows of each class in key order.

    Texts stay out of the scoring exchange. The few chosen rows (n per class)
    fetch theirs by key; only texts whose keys match are hashed, to tell apart
    rows that share their keys.
    """
    order = [*keys, "text_hash"]
    chosen = first_per_class(scored, "sentiment", n, *order).select(*order, "score", "sentiment")
    rows = df.select(*keys, F.col(text).alias("text"))
    same = [rows[name].eqNullSafe(chosen[name]) for name in keys]
    same.append(text_hash("text") == chosen["text_hash"])
    found = rows.join(chosen, same).select(*[rows[name] for name in keys], "text_hash", "text", "sentiment", "score")
    return first_per_class(found, "sentiment", n, *order).drop("text_hash")


def tokens_in_context(df: DataFrame, text: str, keys: Sequence[str], rules: Rules = PUBLISHED) -> DataFrame:
    """One row per token with its neighbours and what its text as a whole says.

    Capitals are emphasis in a ``mixed`` text, one with any token that is not
    in capitals; ``turn`` is the place of its first contrast word, 0 without.

    The neighbours are picked from the token array before the join with the
    lexicon, so that the array never travels with its tokens.
    """
    raw = F.col(text)
    tokens = F.col("tokens")
    speaks_of_contrast = F.lower(raw).contains(rules.contrast)
    texts = df.where(raw.isNotNull()).select(
        *keys,
        text_hash(text).alias("text_hash"),
        emphasis(raw, rules).alias("emphasis"),
        speaks_of_contrast.alias("contrasting"),
        tx.cased_tokens(raw).alias("tokens"),
    )
    turn = F.array_position(F.transform(tokens, F.lower), rules.contrast)
    texts = texts.select(
        *keys, "text_hash", "emphasis", "tokens",
        F.exists(tokens, lambda token: ~tx.shouted(token)).alias("mixed"),
        F.when(F.col("contrasting"), turn).otherwise(0).alias("turn"),
    )
    carried = [*keys, "text_hash", "emphasis", "mixed", "turn"]
    placed = texts.select(*carried, "tokens", F.posexplode_outer("tokens").alias("pos", "token"))
    return placed.select(
        *carried, "pos", "token",
        F.lower("token").alias("word"),
        *[F.get("tokens", F.col("pos") - back).alias(f"prev{back}") for back in (1, 2, 3)],
        *[F.get("tokens", F.col("pos") + ahead).alias(f"next{ahead}") for ahead in (1, 2)],
    )


def emphasis(text: Column, rules: Rules = PUBLISHED) -> Column:
    """What exclamation and question marks add to the strength of the text."""
    exclamations = F.least(tx.occurrences(text, "!"), F.lit(rules.most_exclamations)) * rules.exclamation
    questions = tx.occurrences(text, "?")
    asked = (
        F.when(questions > rules.most_questions, rules.many_questions)
        .when(questions > 1, questions * rules.question)
        .otherwise(0.0)
    )
    return exclamations + asked


def in_context(met: DataFrame, keys: Sequence[str], rules: Rules = PUBLISHED) -> DataFrame:
    """(keys..., text_hash, emphasis, pos, valence): the lexicon valence as its text's rules change it.

    A word before the token acts on it (as booster, negation, part of an idiom or
    of a dampening phrase) only if it is not in the lexicon itself; for idioms
    and phrases that is asked of the third word before. Each column below builds on those above it. Tokens without lexicon entry,
    booster words and the "kind" of "kind of" have null throughout. What the
    neighbours are is said in columns of their own: repeated inside the steps
    it would make the generated code too long for the JVM to compile. The
    rules are SQL text since a column object per listed word would take longer
    to build than a small query takes to run.
    """
    muted = f"word in {listed(rules.intensifiers, rules.dampeners)} or (word = 'kind' and lower(next1) = 'of')"
    steps = {
        "bare_valence": f"case when not coalesce({muted}, false) then valence end",
        **{f"low{back}": f"lower(prev{back})" for back in (1, 2, 3)},
        **{f"boost{back}": boost(f"low{back}", rules) for back in (1, 2, 3)},
        **{f"factor{back}": reversal(back, rules) for back in (1, 2, 3)},
        "valence0": f"""bare_valence
            + case when {shouted("token")} then {away("bare_valence", rules.shout)} else 0D end""",
        **{f"valence{back}": boosted(back, rules) for back in (1, 2, 3)},
        "phrased": phrased("valence3", rules),
        "in_text": f"phrased * {least_factor(rules)} * {contrast_factor(rules)}",
    }
    steps = [F.expr(sql).alias(name) for name, sql in steps.items()]
    group = [*keys, "text_hash", "emphasis", "pos"]
    return met.select("*", *steps).select(*group, F.col("in_text").alias("valence"))


def shouted(token: str) -> str:
    return f"mixed and upper({token}) = {token} and lower({token}) <> {token}"


def away(valence: str, by: float) -> str:
    """``by`` with the sign that takes a valence further from zero."""
    return f"case when {valence} > 0 then {number(by)} else {number(-by)} end"


def boost(word: str, rules: Rules) -> str:
    """What a booster word adds to a positive valence, 0 for other words."""
    return f"""case when {word} in {listed(rules.intensifiers)} then {number(rules.boost)}
                    when {word} in {listed(rules.dampeners)} then {number(-rules.boost)} else 0D end"""


def boosted(back: int, rules: Rules) -> str:
    """The valence after a booster, in capitals perhaps, and a negation ``back`` places before."""
    before = f"valence{back - 1}"
    signed = f"case when {before} < 0 then -boost{back} else boost{back} end"
    loud = f"case when {shouted(f'prev{back}')} then {away(before, rules.shout)} else 0D end"
    damped = f"({signed} + {loud}) * {number(rules.damping[back - 1])}"
    changed = f"({before} + case when boost{back} <> 0 then {damped} else 0D end) * factor{back}"
    return f"case when known{back} then {before} else {changed} end"


def reversal(back: int, rules: Rules) -> str:
    """Factor for a negation ``back`` places before; "never so" and "never this" strengthen instead."""
    strengthened = {
        1: "",
        2: "when prev2 = 'never' and prev1 in ('so', 'this') then 1.5D",
        3: """when prev3 is not null and ((prev3 = 'never' and prev2 in ('so', 'this')) or prev1 in ('so', 'this'))
                then 1.25D""",
    }[back]
    negated = f"low{back} in {listed(rules.negations)} or contains(low{back}, {quoted(NOT)})"
    return f"case {strengthened} when {negated} then {number(rules.negate)} else 1D end"


def phrased(valence: str, rules: Rules) -> str:
    """Valence of the idiom the token is part of, and the dampening by a two-word phrase before it.

    Looked at only from the fourth token on, as in the published scorer. Later
    idioms win over earlier ones there, so those that run on after the token
    come first here.
    """
    spans = [
        "token, next1, next2",
        "token, next1",
        "prev1, token",
        "prev2, prev1, token",
        "prev2, prev1",
        "prev3, prev2, prev1",
        "prev3, prev2",
    ]
    known = valence
    if rules.idioms:
        entries = ", ".join(f"{quoted(phrase)}, {number(value)}" for phrase, value in rules.idioms.items())
        phrases = ", ".join(f"concat_ws(' ', {span})" for span in spans)
        found = f"transform(array({phrases}), phrase -> try_element_at(map({entries}), phrase))"
        known = f"coalesce(get(filter({found}, value -> value is not null), 0), {valence})"
    dampening = listed(rules.dampening_phrases)
    dampened = f"concat_ws(' ', prev3, prev2) in {dampening} or concat_ws(' ', prev2, prev1) in {dampening}"
    return f"""case when {valence} is null or prev3 is null or known3 then {valence}
                    else {known} + case when {dampened} then {number(-rules.boost)} else 0D end end"""


def least_factor(rules: Rules) -> str:
    """Factor for "least" directly before, unless it is "at least" or "very least"."""
    softened = "coalesce(low2 in ('at', 'very'), false)"
    return f"case when low1 = 'least' and not known1 and not {softened} then {number(rules.negate)} else 1D end"


def contrast_factor(rules: Rules) -> str:
    """Factor for standing before or after the text's first contrast word."""
    return f"""case when turn > 0 and pos + 1 < turn then {number(rules.before_contrast)}
                    when turn > 0 and pos + 1 > turn then {number(rules.after_contrast)} else 1D end"""

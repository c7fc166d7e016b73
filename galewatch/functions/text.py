"""Text to words."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# Punctuation taken off one end of a token when the rest has none.
EDGE = r"(?:\?!\?!|!\?!\?|\?!\?|!\?!|!!!|\?\?\?|!!|\?\?|[.!?,;:'\"-])"
EDGE_MARKS = ".!?,;:'\"-"
BARE = r"[^\s\p{Z}!-/:-@\[-`{-~]{2,}"
SPACE = r"[\s\p{Z}]+"


def lower_words(text: Column) -> Column:
    """Lower-cased runs of ASCII word characters; may hold empty strings at the ends."""
    return F.split(F.lower(text), r"\W+")


def cased_tokens(text: Column) -> Column:
    """Space-separated tokens of two characters or more, casing kept.

    A punctuation mark at one end goes away when the rest of the token has no
    punctuation at all, so ``good!!`` is ``good`` while ``:-)`` stays. Only
    tokens with such a mark at an end meet the pattern.
    """
    marks = F.lit(EDGE_MARKS)

    def bare(token: Column) -> Column:
        marked = F.contains(marks, F.substring(token, 1, 1)) | F.contains(marks, F.substring(token, -1, 1))
        return F.when(marked, F.regexp_replace(token, f"^(?:{EDGE}({BARE})|({BARE}){EDGE})$", "$1$2")).otherwise(token)

    return F.transform(F.filter(F.split(text, SPACE), lambda token: F.char_length(token) > 1), bare)


def shouted(token: Column) -> Column:
    """Whether all letters of a token are capitals, and there are some."""
    return (F.upper(token) == token) & (F.lower(token) != token)


def occurrences(text: Column, mark: str) -> Column:
    """How often a one-character mark occurs in a text."""
    return F.char_length(text) - F.char_length(F.replace(text, F.lit(mark), F.lit("")))

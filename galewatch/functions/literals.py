"""Python values as SQL text.

A long list goes into a plan as one parsed expression; as column objects it
would cost a call into the JVM per word.
"""

from collections.abc import Iterable


def quoted(word: str) -> str:
    return "'" + word.replace("\\", "\\\\").replace("'", "''") + "'"


def listed(*lists: Iterable[str]) -> str:
    """``('a', 'b')`` of all words of the lists."""
    return "(" + ", ".join(quoted(word) for several in lists for word in several) + ")"


def number(value: float) -> str:
    """A double, which SQL would otherwise take for a decimal."""
    return f"{float(value)!r}D"

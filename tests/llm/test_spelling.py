"""Spelling variants against plain counting and single edits tried one by one."""

import re
from collections import Counter
from zlib import crc32

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from galewatch.llm import queries, spelling


def plain(texts):
    counts = Counter()
    for doc_id, text in texts:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]+", lambda m: m[0].lower(), run)
            h = crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 199 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    words = {w: n for w, n in counts.items() if len(w) >= 6 and n >= 5}
    letters = sorted({x for w in words for x in w})
    near = {}
    for w in words:
        some = {w[:i] + w[i + 1 :] for i in range(len(w))} | {w[:i] + x + w[j:] for i in range(len(w) + 1) for j in (i, i + 1) for x in letters}
        near[w] = sorted((-words[o], o) for o in some if o in words and o != w)
    form = {w: near[w][0][1] if near[w] and -near[w][0][0] >= 5 * n else None for w, n in words.items()}
    out = []
    for w, n in words.items():
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, n, len(near[w]), words[form[w]] if form[w] else None))
    return sorted(out, key=repr)


def got(frame):
    return sorted(map(tuple, frame.collect()), key=repr)


def rows(*counts):
    words = [w for w, n in counts for _ in range(n)]
    return [(i, " ".join(words[i::7])) for i in range(7)]


def test_variants(documents, monkeypatch):
    monkeypatch.setattr(spelling, "WORDS_A_RANGE", 3)
    texts = rows(
        ("colour", 200), ("color", 50), ("colours", 30), ("colur", 9), ("cclour", 6), ("colouur", 5), ("colourr", 40), ("xolour", 40),
        ("aaaaaa", 500), ("aaaaaaa", 70), ("aaaaaaaa", 10), ("aaaaab", 12), ("baaaaa", 11), ("abcdef", 5), ("bcdefg", 5), ("Überfall", 8), ("überfall", 6),
        ("straße", 90), ("strasse", 9), ("garçon", 25), ("garcon", 5), ("l'étéité", 6), ("z" * 3_000, 8), ("z" * 2_999 + "y", 5), ("tie" * 2, 30), ("tietia", 6), ("tietib", 30), ("tietic", 30),
    )
    texts += [(None, "colour words abcdef null id"), (8, None), (9, ""), (9, "colour"), (9, "colour"), (10, "été×÷Ünder " * 9)]
    frame = documents(texts, "word", "n", "form", "root", "p", "s")
    want = plain(texts)
    assert got(spelling.variants(frame)) == want
    assert any(r[1] and r[2] != r[1] for r in want) and len(want) > 20
    assert got(spelling.variants(frame.where("false"))) == []


def test_deleted_runs(spark, documents):
    """Enough documents for the rule that takes a code point from a run."""
    texts = [(i, "wonderful weather forecast") for i in range(3_000)]
    want = plain(texts)
    assert len(want) > 3
    assert got(spelling.variants(documents(texts))) == want


def test_stored_documents(spark):
    directory = "/root/testdata/sf0.001"
    texts = [tuple(r) for r in spark.read.parquet(f"{directory}/documents.parquet").select("doc_id", "text").collect()]
    assert got(queries.op11_spelling(spark, directory)) == plain(texts)


@settings(max_examples=200, deadline=None)
@given(st.sets(st.text(alphabet="ab", min_size=1, max_size=7), min_size=1, max_size=30), st.integers(1, 5))
def test_nodes_are_the_same_only_for_equal_prefixes(words, size):
    words = sorted(words)
    parts = [words[i : i + size] for i in range(0, len(words), size)]
    ends = sorted({w for part in parts for w in (part[0], part[-1])})
    known = dict(zip(ends, spelling.paths(ends, 1, ("", [0]), ("", [0])), strict=True))
    of = {}
    for number, part in enumerate(parts, 1):
        for word, nodes in zip(part, spelling.paths(part, number << 40, (part[0], known[part[0]]), (part[-1], known[part[-1]])), strict=True):
            assert len(nodes) == len(word) + 1
            for i, node in enumerate(nodes):
                assert of.setdefault(word[:i], node) == node
    assert len(set(of.values())) == len(of)


@pytest.mark.parametrize(("a", "b"), [("", "x"), ("abc", "abd"), ("abc", "abc"), ("abc", "ab"), ("abcdefgh", "abcdxfgh"), ("x", "y")])
def test_shared_prefix(a, b):
    assert spelling.shared_prefix(a, b) == next((i for i, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), min(len(a), len(b)))

"""Personal data: patterns against their regular expressions, windows and reconciliation, the model on held-out text."""

from hashlib import sha256

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from galewatch.llm import pii, pii_model, pii_rules
from tests.llm import brute

TRICKY = [
    "a@b.c_d@e.f", "x@y@z.org", "@@a.b", "a@b", "a..b%+-@c-.d.e..", "1.2.3.4.5.6.7.8", "256.1.1.1 1.1.1.256", "001.002.003.004",
    "4111 1111 1111 1111", "4111-1111-1111-1111 1", "12 4337166598464399", "+1 (988) 555-2485.", "++1 988 555 24 85-", "+1+22 333 444 5555",
    "1" * 500, "a@" + "b" * 300, "é4111111111111111é x@y.zé", "+" + "1 " * 20, "1.1.1.1" * 9, "a@b.c" * 5, "",
]


@pytest.mark.parametrize("text", TRICKY)
def test_patterns(text):
    assert pii_rules.base_spans(text) == brute.base_spans(text)


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet="a1234@.+- ()_5é", max_size=60))
def test_patterns_on_any_text(text):
    assert pii_rules.base_spans(text) == brute.base_spans(text)


def test_long_runs_take_linear_time():
    for text in ("1" * 300_000, "a@" + "b" * 300_000, "1." * 150_000, "+1" * 100_000):
        pii_rules.base_spans(text)


@settings(max_examples=50, deadline=None)
@given(st.integers(0, 5000))
def test_windows_cover_and_overlap(length):
    windows = pii.windows_of(length)
    assert (not windows) == (length == 0)
    if windows:
        assert windows[0][0] == 0 and windows[-1][1] == length
        assert all(b - a <= pii.WINDOW for a, b in windows)
        assert all(b - c >= pii.OVERLAP for (_, b), (c, _) in zip(windows, windows[1:], strict=False))


@settings(max_examples=100, deadline=None)
@given(st.lists(st.tuples(st.integers(1, 9), st.integers(0, 20), st.integers(1, 8), st.integers(1, 4)), max_size=7))
def test_reconciled_is_the_best_choice(raw):
    spans = [(float(score), a, a + n, tag) for score, a, n, tag in raw]
    chosen = pii.reconciled(spans)
    assert all(b <= c for (_, b, _), (c, _, _) in zip(chosen, chosen[1:], strict=False))
    best = {}
    for score, *span in spans:
        best[tuple(span)] = max(score, best.get(tuple(span), 0))
    keys, most = list(best), 0.0
    for mask in range(1 << len(keys)):
        some = sorted(k for i, k in enumerate(keys) if mask >> i & 1)
        if all(x[1] <= y[0] for x, y in zip(some, some[1:], strict=False)):
            most = max(most, sum(best[k] for k in some))
    assert sum(best[c] for c in chosen) == most


def test_best_paths_against_all_paths():
    random = np.random.default_rng(0)
    scores = random.normal(size=(5, pii_model.TAGS, 3)).astype(np.float32)
    moves = random.normal(size=(pii_model.TAGS, pii_model.TAGS)).astype(np.float32)
    paths = pii_model.best_paths(scores, moves)
    for lane in range(3):
        value = lambda p: sum(scores[t, k, lane] for t, k in enumerate(p)) + sum(moves[a, b] for a, b in zip(p, p[1:], strict=False))  # noqa: B023, E731
        every = np.stack(np.meshgrid(*[range(pii_model.TAGS)] * 5, indexing="ij"), -1).reshape(-1, 5)
        assert value(paths[:, lane]) == pytest.approx(max(value(p) for p in every), abs=1e-4)
    none = pii_model.hopeless(scores, moves)
    assert all(not paths[:, lane].any() for lane in np.flatnonzero(none))


@settings(max_examples=200, deadline=None)
@given(st.integers(0, 10_000))
def test_no_window_with_a_span_is_given_up(seed):
    """Margins near the bound, as where one character takes two good moves."""
    random = np.random.default_rng(seed)
    scores = random.normal(size=(6, pii_model.TAGS, 20)).astype(np.float32) - np.float32(random.uniform(0, 3))
    scores[:, 0] = 0
    moves = random.normal(size=(pii_model.TAGS, pii_model.TAGS)).astype(np.float32)
    paths = pii_model.best_paths(scores, moves)
    assert not paths[:, pii_model.hopeless(scores, moves)].any()


def test_one_character_takes_two_moves():
    moves = np.zeros((pii_model.TAGS, pii_model.TAGS), np.float32)
    moves[0, 1] = moves[1, 0] = 1
    scores = np.full((3, pii_model.TAGS, 1), -9, np.float32)
    scores[:, 0], scores[1, 1] = 0, -1.5
    assert pii_model.best_paths(scores, moves)[:, 0].tolist() == [0, 1, 0]
    assert not pii_model.hopeless(scores, moves).any()


def test_gradients_are_those_of_the_loss():
    random = np.random.default_rng(1)
    scores, moves = random.normal(size=(4, pii_model.TAGS, 2)), random.normal(size=(pii_model.TAGS, pii_model.TAGS))
    tags = random.integers(0, pii_model.TAGS, (4, 2))

    def loss(s, m):
        total = 0.0
        every = np.stack(np.meshgrid(*[range(pii_model.TAGS)] * 4, indexing="ij"), -1).reshape(-1, 4)
        for lane in range(2):
            value = lambda p: s[np.arange(4), p, lane].sum() + m[p[:-1], p[1:]].sum()  # noqa: B023, E731
            total += np.log(sum(np.exp(value(p)) for p in every)) - value(tags[:, lane])
        return total / 2

    of_scores, of_moves = pii_model.crf_gradient(scores, moves, tags)
    for array, found in ((scores, of_scores), (moves, of_moves)):
        for at in [(0,) * array.ndim, tuple(n - 1 for n in array.shape)]:
            array[at] += 1e-5
            high = loss(scores, moves)
            array[at] -= 2e-5
            low = loss(scores, moves)
            array[at] += 1e-5
            assert found[at] == pytest.approx((high - low) / 2e-5, abs=1e-4)


@pytest.fixture(scope="module")
def corpus(spark):
    return spark.read.parquet("/root/testdata/sf0.01/documents.parquet")


@pytest.fixture(scope="module")
def weights(corpus):
    return pii.fitted(corpus)


def test_model_finds_other_spellings_and_leaves_the_rest(corpus, weights):
    """Held out: texts that are no training passages, with newly written data put in."""
    random = np.random.default_rng(123)
    texts = [r.text[700:1300] for r in corpus.where("length(text) > 1400").orderBy("doc_id").collect()]
    texts = [t for t in texts if len(t) == 600 and not any(c.isdigit() for c in t)][:150]
    put, truth = [], []
    for text in texts:
        for kind in pii_rules.KINDS:
            data, at = pii.written(kind, random), text.index(" ", int(random.integers(20, 400)))
            put.append(f"{text[:at]} {data}{text[at:]}")
            truth.append((kind, at + 1, at + 1 + len(data)))
    found = [every for _, every in pii.spans_of(put, weights)]
    hit = sum(span in every for span, every in zip(truth, found, strict=True))
    assert hit >= 0.85 * len(truth)
    assert sum(len(every) for every in found) - hit <= 0.1 * len(truth)
    assert sum(len(every) for _, every in pii.spans_of(texts, weights)) <= 0.02 * len(texts)


def test_rows(documents, weights):
    long = "no data here, " * 400 + "mail bob.42@mail8.example.com now " + "or 55.63.178.142, " * 200
    rows = [(1, None), (2, ""), (3, "a.b@c.de and +1 (988) 555-2485"), (3, "a.b@c.de and +1 (988) 555-2485"), (None, long), (5, "x" * 50_000)]
    got = pii.found(documents(rows, "spans", "n_email"), weights).collect()
    assert len(got) == len(rows)
    for doc_id, text in rows:
        base = brute.base_spans(text)
        row = next(r for r in got if r.doc_id == doc_id)
        assert [row.n_email, row.n_ip, row.n_card, row.n_phone] == [sum(s[0] == k for s in base) for k in pii_rules.KINDS]
        listed = [f"{k}:{a}:{b}" for k, a, b in base]
        assert row.base_sha256 == sha256(",".join(listed).encode()).hexdigest()
        assert set(listed) <= set(row.spans.split(",") if row.spans else [])
    assert pii.found(documents(rows).where("false"), weights).collect() == []


def test_block_and_single_texts_agree(corpus, weights):
    texts = [r.text for r in corpus.orderBy("doc_id").limit(60).collect()]
    together = list(pii.spans_of(texts, weights))
    assert together == [next(pii.spans_of([t], weights)) for t in texts]


def test_a_model_for_tables_without_text(documents):
    assert pii.fitted(documents([(1, None), (2, "short")]), sample=5).keys() == pii_model.fresh(0).keys()

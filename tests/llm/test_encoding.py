"""Byte-level BPE against tiktoken, token files against the tokenizers library, Simple-8b round trips."""

from hashlib import sha256

import numpy as np
import public_tokenizers
import pytest
import regex
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from galewatch.llm import byte_bpe, pieces, queries, simple8b, token_files
from tests.llm import brute

RANKS = byte_bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
PATTERN = public_tokenizers.PATTERN
TIKTOKEN = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=RANKS, special_tokens={})
ODD = [
    None, "", " ", "  ", "\n", "a'b's 'll it's don't ''s", "  x  y\n\n z ", "\n \t  x1a²½Ⅷ㐀", "aaaaaaa" * 50, "\x1c a\x1f b\x85c",
    "🙂🙂 é̀ x", "<|endoftext|>", "x" * 30_000, " " * 5_000, "word " * 20_000, "\x00\x00 \x00",
]


@pytest.fixture(scope="module")
def encoder():
    return byte_bpe.Encoder(RANKS, PATTERN)


def as_lists(cutter, texts):
    words, which, counts = cutter.cut(texts)
    assert len(set(words)) == len(words)
    flat = iter([words[i] for i in which])
    return [[next(flat) for _ in range(count)] for count in counts]


@settings(max_examples=500, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from("ab'strelvmd  \n\t1é中!.²"), max_size=40), max_size=6))
def test_pieces(texts):
    assert as_lists(pieces.Cutter(PATTERN), texts) == [regex.findall(PATTERN, t) for t in texts]


@pytest.mark.parametrize("pattern", [r"[0-9]|[^0-9]+", r"\S+|\s+"])
def test_pieces_of_another_pattern(pattern):
    texts = ["ab 12", "ab' 12", "", "it's 1"]
    assert as_lists(pieces.Cutter(pattern), texts) == [regex.findall(pattern, t) for t in texts]


def test_pieces_with_one_hash_are_told_apart(monkeypatch):
    monkeypatch.setattr(pieces, "rolling", lambda n: (np.zeros(n, np.uint64), np.zeros(n, np.uint64)))
    texts = ["a bb a c bb", "bb a"]
    assert as_lists(pieces.Cutter(PATTERN), texts) == [regex.findall(PATTERN, t) for t in texts]


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=60))
def test_any_text(encoder, text):
    ids = np.frombuffer(next(encoder.encode([text])), "<u4").tolist()
    assert ids == TIKTOKEN.encode_ordinary(text)
    assert encoder.decode(ids) == text.encode()


def test_lower_rank_made_by_a_merge_goes_first():
    """With these ranks a merge makes a pair of a lower rank, beside an equal pair that is still due."""
    ranks = {bytes((b,)): b for b in range(256)} | {b"ab": 400, b"aba": 300, b"ba": 500, b"abab": 600}
    own = tiktoken.Encoding("odd", pat_str=r"\S+", mergeable_ranks=ranks, special_tokens={})
    for word in ("abab", "ababab", "aabab", "babab", "abaab"):
        assert byte_bpe.replay([word.encode()], byte_bpe.Merges(ranks))[0] == own.encode_ordinary(word)


def test_encoded(documents):
    rows = [*enumerate(ODD), (3, ODD[3]), (None, "a b c")]
    frame = documents(rows, "ids", "n_tokens")
    got = {(r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256): r.ids for r in byte_bpe.encoded(frame, public_tokenizers.path("byte_bpe_50k.tiktoken"), PATTERN).collect()}
    want = set()
    for doc_id, text in rows:
        ids = TIKTOKEN.encode_ordinary(text or "")
        raw = np.array(ids, "<u4").tobytes()
        want.add((doc_id, len(ids), sha256(raw).hexdigest(), sha256((text or "").encode()).hexdigest()))
    assert set(got) == want
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    assert byte_bpe.encoded(frame, path, PATTERN).count() == len(rows)
    assert byte_bpe.encoded(frame.where("false"), path, PATTERN).collect() == []


@settings(max_examples=300, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 3), st.integers(0, 60_000), st.integers(0, 2**64 - 1)), max_size=300))
def test_simple8b_round_trip(numbers):
    words, plain = simple8b.encode(np.array(numbers, np.uint64))
    assert simple8b.decode(words, plain, len(numbers)).tolist() == numbers


def test_simple8b_is_dense():
    words, plain = simple8b.encode(np.zeros(600, np.uint64))
    assert len(words) == 10 and not len(plain)
    words, _ = simple8b.encode(np.full(400, 40_000, np.uint64))
    assert len(words) == 134  # three of 20 bits a word


def test_token_files(spark, documents, monkeypatch):
    rows = [*[(i * 7 % 101, t) for i, t in enumerate(ODD)], (50, "b"), (50, "a"), (50, "a"), (None, "none")]
    rows += [(1000 + i, f"text number {i} " * (i % 9)) for i in range(300)]
    path = token_files.new_path(spark)
    vocabulary = public_tokenizers.path("byte_bpe_50k.json")
    token_files.write(documents(rows, "file", "start", "ids"), vocabulary, PATTERN, path)
    got = token_files.read(spark, path).collect()
    library = Tokenizer.from_file(vocabulary)
    library.encode_special_tokens = True
    at = 0
    ordered = sorted(got, key=lambda r: r.start)
    assert [r.doc_id for r in ordered] == sorted((r[0] for r in rows), key=lambda d: (d is not None, d))
    left = [(d, tuple([*library.encode(t or "", add_special_tokens=False).ids, 2])) for d, t in rows]
    for row in ordered:
        assert row.start == at
        at += row.n_tokens
        left.remove((row.doc_id, tuple(row.ids)))
        assert row.n_tokens == len(row.ids) and row.ids_crc32 == brute.crc32_of(row.ids)
    assert not left


def test_token_files_of_no_rows(spark, documents):
    path = token_files.new_path(spark)
    token_files.write(documents([(1, "x")]).where("false"), public_tokenizers.path("byte_bpe_50k.json"), PATTERN, path)
    assert token_files.read(spark, path).collect() == []


def test_op8_recognises_added_tokens(spark, documents, tmp_path):
    mark = "<|endoftext|>"
    texts = [mark, f"a{mark}b", f"{mark}{mark} x", f"it's {mark} don't\n", f"a b {mark}", "<|endoftext", "plain text", "", None]
    documents([*enumerate(texts)]).write.parquet(str(tmp_path / "documents.parquet"))
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want, at = [], 0
    for doc_id, text in enumerate(texts):
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 2]
        want.append((doc_id, at, len(ids), brute.crc32_of(ids)))
        at += len(ids)
    assert library.encode(texts[1], add_special_tokens=False).ids == [64, 50256, 65]
    assert sorted(map(tuple, queries.op8_token_files(spark, str(tmp_path)).collect())) == want

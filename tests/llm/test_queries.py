"""The registered queries against SQL and brute force, and the pipeline stage by stage."""

import os
from hashlib import sha256

import numpy as np
import public_tokenizers
import pytest
import tiktoken

import corpus_pipeline
from checks.compare import difference, open_tables
from galewatch.llm import byte_bpe, decontaminate, line_dedup
from galewatch.llm.queries import QUERIES
from galewatch.llm.sql import ORACLES
from tests.llm import brute

DIRECTORY = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def tables():
    return open_tables(DIRECTORY)


@pytest.fixture(scope="module")
def texts(tables):
    return tables.execute("select doc_id, text from documents").fetchall()


def rows(spark, key):
    return sorted((tuple(r) for r in QUERIES[key](spark, DIRECTORY).collect()), key=repr)


@pytest.mark.parametrize("key", sorted(ORACLES))
def test_same_as_sql(spark, tables, key):
    assert difference(QUERIES[key](spark, DIRECTORY), tables, ORACLES[key]) is None


def test_op2(spark, texts):
    assert rows(spark, "op2_simhash") == sorted(brute.simhash(texts), key=repr)


def test_op7(spark, texts):
    assert rows(spark, "op7_passages") == sorted(brute.passages(texts), key=repr)


def test_op1(spark, texts):
    got = {r[0]: r for r in rows(spark, "op1_pii")}
    for doc_id, text in texts:
        base = brute.base_spans(text)
        listed = [f"{k}:{a}:{b}" for k, a, b in base]
        want = [sum(s[0] == k for s in base) for k in brute.KINDS]
        assert list(got[doc_id][1:6]) == [*want, sha256(",".join(listed).encode()).hexdigest()]
        assert set(listed) <= set(got[doc_id][6].split(",") if got[doc_id][6] else [])


def test_op5_gives_every_document(spark, texts):
    assert sorted(r[0] for r in rows(spark, "op5_quality_classifier")) == sorted(d for d, _ in texts)


def ids_of(text):
    ranks = byte_bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    own = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    return own.encode_ordinary(text or "")


def test_op4_and_op8(spark, texts):
    four = {r[0]: r[1:] for r in rows(spark, "op4_byte_bpe")}
    eight = sorted(rows(spark, "op8_token_files"), key=lambda r: r[1])
    ranks = byte_bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    own = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    at = 0
    for (doc_id, text), row in zip(sorted(texts), eight, strict=True):
        ids = own.encode_ordinary(text or "")
        raw = np.array(ids, "<u4").tobytes()
        assert four[doc_id] == (len(ids), sha256(raw).hexdigest(), sha256((text or "").encode()).hexdigest())
        assert row == (doc_id, at, len(ids) + 1, brute.crc32_of([*ids, 2]))
        at += len(ids) + 1


def test_pipeline(spark, tables):
    """run() against the stages worked out plainly, one after the other."""
    kept = {r[0] for r in tables.execute(f"select doc_id from ({ORACLES['op3_quality_rules']}) where kept").fetchall()}
    docs = [r for r in tables.execute("select doc_id, text, source from documents").fetchall() if r[0] in kept]
    pages, held = {}, {}
    for _, text, site in docs:
        pages[site] = pages.get(site, 0) + 1
        for line in set((text or "").split("\n")):
            held[site, line] = held.get((site, line), 0) + 1
    gone = lambda site, line: bool(line.strip()) and held[site, line] >= line_dedup.LEAST_PAGES and held[site, line] > line_dedup.RATIO * pages[site]
    docs = [(d, t if t is None else "\n".join(x for x in t.split("\n") if not gone(s, x))) for d, t, s in docs]
    least = {c for _, _, c in brute.simhash(docs)}
    docs = [r for r in docs if r[0] in least]
    benchmark = tables.execute("select item_id, text from benchmark").fetchall()
    bad = {r[0] for r in brute.decontaminated(docs, benchmark) if r[4]}
    want = {d: ids_of(t) for d, t in docs if d not in bad}
    got = {r.doc_id: r for r in corpus_pipeline.run(spark, DIRECTORY).collect()}
    assert {d: r.ids for d, r in got.items()} == want
    assert all(r.n_tokens == len(r.ids) for r in got.values())


def test_stages_keep_the_columns(spark):
    docs = spark.read.parquet(f"{DIRECTORY}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, DIRECTORY).columns == docs.columns
        assert stage(spark, docs.where("false"), DIRECTORY).collect() == []
    assert decontaminate.WINDOW == 13

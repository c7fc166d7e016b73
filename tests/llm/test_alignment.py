"""Cross-tokenizer alignment against the two libraries asked for whole texts, and plain counting."""

from bisect import bisect_left
from collections import Counter
from hashlib import sha256

import public_tokenizers
import pytest
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from galewatch.llm import alignment, queries

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
ODD = [
    None, "", " ", "  ", "a ", " a  b ", "\n", "a\n \n  b", "it's l'été don't ''s 'stuff", "x▁y", "▁", "▁a b",
    "<|endoftext|> <s> <0x41>", "A\x00B \x01", "ab　c  d  e", "½Ⅷ² 12345 a1b2", "🙂🙂 é̀ x 你好", "x" * 5_000, " " * 300,
    "word " * 4_000, "!!!???...  --- \t\t", "Donaudampfschifffahrtsgesellschaft überfällig.",
]


def plain(texts):
    """What the contract says, from whole encodings."""
    a_model, b_model = Tokenizer.from_file(A), SentencePieceProcessor(model_file=B)
    a_model.encode_special_tokens = True
    a_bytes, b_bytes = alignment.bytes_of_a(a_model.get_vocab()), alignment.bytes_of_b(b_model)
    rows = []
    for doc_id, text in texts:
        a = a_model.encode(f" {text}", add_special_tokens=False).ids if text else []
        b = b_model.encode(text) if text else []
        if b"".join(a_bytes[i] for i in a) != b"".join(b_bytes[i] for i in b) or b"".join(a_bytes[i] for i in a) != f" {text}".encode():
            a = b = []
        ends = []
        for ids, of in ((a, a_bytes), (b, b_bytes)):
            at, own = 0, []
            for number in ids:
                at += len(of[number])
                own.append((at, number))
            ends.append(own)
        at_a, at_b = map(dict, ends)
        common = sorted(at_a.keys() & at_b.keys())
        owner = [[common[bisect_left(common, e)] for e, _ in own] for own in ends]
        members = [{}, {}]
        for side, own in enumerate(ends):
            for (_, number), stop in zip(own, owner[side]):
                members[side].setdefault(stop, []).append(number)
        groups = ["|".join(",".join(map(str, side[stop])) for side in members) for stop in common]
        links = [(at_a[stop], at_b[stop]) for stop in common]
        rows.append((doc_id, len(a), len(b), len(groups), links, sha256(";".join(groups).encode()).hexdigest() if groups else ""))
    count = Counter(link for row in rows for link in row[4])
    best = Counter()
    for (_, b), n in count.items():
        best[b] = max(best[b], n)
    return sorted(
        ((d, na, nb, g, len(ls), sum(count[x] == best[x[1]] for x in ls), sum(count[x] for x in ls), sha) for d, na, nb, g, ls, sha in rows),
        key=repr,
    )


def got(frame):
    return sorted(map(tuple, frame.collect()), key=repr)


@pytest.mark.parametrize("most_sent", [alignment.MOST_SENT, 3])
def test_odd_texts_both_ways(documents, most_sent):
    rows = [*enumerate(ODD), (3, "a b"), (3, "a b"), (None, "one two"), (None, "déjà vu")]
    frame = documents(rows, "row", "links", "n_best", "groups", "link")
    assert got(alignment.cross_counts(frame, A, B, most_sent)) == plain(rows)
    assert got(alignment.cross_counts(frame.where("false"), A, B, most_sent)) == []
    assert got(alignment.cross_counts(frame.where("text is null"), A, B, most_sent)) == plain([(0, None)])


def test_stored_documents(spark):
    directory = "/root/testdata/sf0.001"
    texts = [tuple(r) for r in spark.read.parquet(f"{directory}/documents.parquet").select("doc_id", "text").collect()]
    short = [(d, t) for d, t in texts if t is None or len(t) < 3_000]
    frame = spark.createDataFrame(short, "doc_id bigint, text string")
    assert got(alignment.cross_counts(frame, A, B)) == plain(short)
    whole = queries.op12_alignment(spark, directory)
    assert sorted(r.doc_id for r in whole.collect()) == sorted(d for d, _ in texts)


def test_groups_are_given(documents):
    row = alignment.aligned(documents([(1, "hello worlds, it's")]), A, B).first()
    assert row.n_groups == len(row.groups.split(";")) == len(row.links)
    a = [int(x) for group in row.groups.split(";") for x in group.split("|")[0].split(",")]
    assert a == Tokenizer.from_file(A).encode(" hello worlds, it's").ids


def test_stored_links_are_small_and_opened_in_portions(documents, monkeypatch):
    frame = documents(list(enumerate(ODD)))
    listed = {r.doc_id: r.links for r in alignment.aligned(frame, A, B).collect()}
    stored = alignment.aligned(frame, A, B, packed=True).toArrow()
    monkeypatch.setattr(alignment, "MOST_LINKS", 10)
    found = {}
    for rows, links, ends in alignment.opened(iter(stored.to_batches())):
        assert len(links) <= 10 or rows.num_rows == 1
        bounds = zip(rows.column("doc_id").to_pylist(), ends[:-1], ends[1:], strict=True)
        found |= {doc_id: links[a:b].tolist() for doc_id, a, b in bounds}
    assert found == listed
    long = max(stored.to_pylist(), key=lambda row: row["n_groups"])
    assert len(long["links"]) < 2 * long["n_groups"]


def test_regular_links_have_the_same_bytes():
    aligner = alignment.Aligner(*alignment.read_files(A, B))
    pairs = [(i, j) for i, j in enumerate(aligner.same) if j >= 0]
    assert len(pairs) > 10_000 and all(aligner.a_bytes[i] == aligner.b_bytes[j] for i, j in pairs)


def test_a_session_without_a_shared_folder_gets_one(spark):
    from galewatch.llm.shared import shared_folder

    assert shared_folder(spark) == shared_folder(spark)

"""Byte-level BPE by replaying merges over the words of a block of the corpus.

Each task takes its documents in blocks, cuts them into pieces and replays the
merges once for all distinct pieces that are new to it: an inverted index leads from a token pair
to the places where it stands, the pair of the lowest rank is applied at all its
places, and only the pairs of the two neighbours are looked up anew and enter the
index. Pieces don't influence each other, so blocks may be cut anywhere, nothing
is shuffled, and a lost task is one task. Pieces met before are kept up to a
fixed number.

Null texts are encoded as empty: no ids, the digests of nothing. Repeated rows
are encoded alike; of equal pairs the leftmost goes first; a piece that is a token
is that token. Files of ranks are read by the driver and sent to the tasks (a fixed
vocabulary).
"""

from __future__ import annotations

import base64
import heapq
from collections import defaultdict
from collections.abc import Iterable, Iterator
from hashlib import sha256
from struct import pack

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame

from galewatch.llm.pieces import Cutter, blocks
from galewatch.llm.shared import no_collector

MOST_KEPT = 600_000  # pieces that a Python worker remembers
COLUMNS = "ids array<int>, n_tokens bigint, ids_sha256 string, decoded_sha256 string"


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


class Merges:
    """Ranks by token pair: every way to split a token into two tokens is a merge of that token's rank."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.tokens = {rank: token for token, rank in ranks.items()}
        self.single = [ranks[bytes((b,))] for b in range(256)]
        self.of_pair = {
            left << 32 | right: rank
            for token, rank in ranks.items()
            for cut in range(1, len(token))
            if (left := ranks.get(token[:cut])) is not None and (right := ranks.get(token[cut:])) is not None
        }


def replay(words: list[bytes], merges: Merges) -> list[list[int]]:
    """Token ids of each word (not empty)."""
    data = b"".join(words)
    n = len(data)
    token = list(map(merges.single.__getitem__, data))
    upto, before = list(range(1, n + 1)), list(range(-1, n - 1))
    opens = bytearray(n + 1)  # places where a word begins
    at = 0
    for word in words:
        opens[at], before[at] = 1, -1
        at += len(word)
    opens[n] = 1
    rank_of = merges.of_pair.get
    # Rank of the pair that begins at a place, and the inverted index: a heap of places for each rank.
    pair = [rank_of(a << 32 | b, -1) for a, b in zip(token, token[1:], strict=False)] + [-1]
    places: dict[int, list[int]] = defaultdict(list)
    for p, rank in enumerate(pair):
        if rank >= 0:
            if opens[p + 1]:
                pair[p] = -1
            else:
                places[rank].append(p)
    due = list(places)
    heapq.heapify(due)
    pop, push = heapq.heappop, heapq.heappush
    while due:
        rank = due[0]
        held = places[rank]
        if not held:
            pop(due)
        # A merge can make a pair of a lower rank, which then goes first.
        while held and due[0] == rank:
            p = pop(held)
            if pair[p] != rank:
                continue  # a neighbour has been merged since
            q = upto[p]
            end = upto[q]
            token[p], upto[p], pair[q] = rank, end, -1
            if opens[end]:
                pair[p] = -1
            else:
                before[end] = p
                pair[p] = fresh = rank_of(rank << 32 | token[end], -1)
                if fresh >= 0:
                    if not (other := places[fresh]):
                        push(due, fresh)
                    push(other, p)
            o = before[p]
            if o >= 0:
                pair[o] = fresh = rank_of(token[o] << 32 | rank, -1)
                if fresh >= 0:
                    if not (other := places[fresh]):
                        push(due, fresh)
                    push(other, o)
    out, at = [], 0
    for word in words:
        ids, stop = [], at + len(word)
        while at < stop:
            ids.append(token[at])
            at = upto[at]
        out.append(ids)
    return out


class Encoder:
    """Encodes and decodes texts; a Python worker keeps one, with pieces met before, for all its tasks."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.merges, self.cutter = Merges(ranks), Cutter(pattern)
        self.known: dict[str, bytes] = {}

    def learn(self, new: list[str]) -> None:
        ranks = self.merges.ranks
        words = [p.encode() for p in new]
        left = []
        for piece, word in zip(new, words, strict=True):
            if word in ranks:
                self.known[piece] = pack("<I", ranks[word])
            else:
                left.append((piece, word))
        for (piece, _), ids in zip(left, replay([w for _, w in left], self.merges), strict=True):
            self.known[piece] = pack(f"<{len(ids)}I", *ids)

    def encode(self, texts: list[str]) -> Iterator[bytes]:
        """Ids of each text, as little-endian 32-bit numbers."""
        return self.cutter.encode(texts, self.known, self.learn, MOST_KEPT)

    def decode(self, ids: Iterable[int]) -> bytes:
        return b"".join(map(self.merges.tokens.__getitem__, ids))


encoders: dict[tuple[int, str], Encoder] = {}


def worker_encoder(ranks: Broadcast, pattern: str) -> Encoder:
    key = (id(ranks.value), pattern)  # the value stays in the worker as long as the encoder that holds it
    if key not in encoders:
        encoders.clear()
        encoders[key] = Encoder(ranks.value, pattern)
    return encoders[key]


def encoded(documents: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """doc_id, ids, n_tokens, ids_sha256 (of 32-bit little-endian ids), decoded_sha256 (of the bytes decoded from them)."""
    ranks = documents.sparkSession.sparkContext.broadcast(read_ranks(ranks_path))

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = worker_encoder(ranks, pattern)
        with no_collector():
            for batch in batches:
                texts = [t or "" for t in batch.column("text").to_pylist()]
                for block in blocks(texts):
                    own = batch.slice(block.start, block.stop - block.start)
                    ids, digests, decoded = [], [], []
                    for raw in encoder.encode(texts[block]):
                        row = np.frombuffer(raw, "<u4")
                        ids.append(row)
                        digests.append(sha256(raw).hexdigest())
                        decoded.append(sha256(encoder.decode(row.tolist())).hexdigest())
                    ends = np.cumsum([0, *map(len, ids)], dtype=np.int32)
                    flat = pa.array(np.concatenate(ids).astype(np.int32))
                    columns = [own.column("doc_id"), pa.ListArray.from_arrays(pa.array(ends), flat)]
                    columns += [pa.array(np.diff(ends).astype(np.int64)), pa.array(digests), pa.array(decoded)]
                    yield pa.RecordBatch.from_arrays(columns, ["doc_id", "ids", "n_tokens", "ids_sha256", "decoded_sha256"])

    kind = documents.schema["doc_id"].dataType.simpleString()
    return documents.select("doc_id", "text").mapInArrow(of, f"doc_id {kind}, {COLUMNS}")

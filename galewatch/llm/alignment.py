"""Aligns the token ids of two tokenizers over a corpus, and counts which ids end together.

Both tokenizers cut a text's bytes; where a token of A and a token of B end at
the same byte, a group ends, and the two tokens are linked. Texts are cut first
where both tokenizers must begin anew (A's pattern, and a run of spaces for B),
and equal parts of a block are aligned once.

Most groups are one token of A and the token of B with the same bytes. An array
from each id of A to that id of B says so, and such links are counted in vectors
as long as A's vocabulary, one a task. Only the links of other groups become id
pairs that are exchanged, a row for each pair and batch of texts. The stored table
holds each document's links as compressed bytes, since batches of eight bytes a
link are too much for a task's JVM and Python together. The counts then
meet the links where these were read: vectors of vocabulary length always, the
other pairs as well while they are at most MOST_SENT; if there are more, these
links are joined with their counts by pair, and only their sums go back to the
documents.

Null and empty texts, and texts whose tokens don't give back their bytes (B
writes U+2581 for a space), have no tokens: zeros, and no groups. Repeated rows
are aligned and counted each. Columns beside doc_id and text are not looked at.
Of equal counts each is a highest. Empty tables give no rows.
"""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import Broadcast, TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from galewatch.llm.pieces import blocks, code_points, cuts, distinct
from galewatch.llm.shared import landed, no_collector

SPACE = "▁"  # how B's pieces write a space
MOST_SENT = 1_000_000  # pairs of irregular groups, 16 bytes each, that are sent to all tasks
MOST_KEPT = 400_000  # parts that a Python worker remembers
MOST_LINKS = 500_000  # links that are counted or summed at once; a batch of long texts has millions
PAIR = 1 << 32  # links from here on are (A id + 1) << 32 | B id; below, an A id with the B id of the same bytes


def letters_of_bytes() -> dict[str, int]:
    """The byte that a byte-level vocabulary's character stands for: itself if it is visible, else counted from 256."""
    seen = [*range(33, 127), *range(161, 173), *range(174, 256)]
    return {chr(b): b for b in seen} | {chr(256 + i): b for i, b in enumerate(x for x in range(256) if x not in seen)}


def bytes_of_a(vocabulary: dict[str, int]) -> list[bytes]:
    of = letters_of_bytes()
    tokens = [b""] * (max(vocabulary.values()) + 1)
    for written, number in vocabulary.items():
        # Special tokens are never made from text; their names need not be byte-level.
        tokens[number] = bytes(of[x] for x in written) if all(x in of for x in written) else written.encode()
    return tokens


def bytes_of_b(model) -> list[bytes]:
    tokens = []
    for number in range(model.get_piece_size()):
        piece = model.id_to_piece(number)
        tokens.append(bytes([int(piece[3:5], 16)]) if model.is_byte(number) else piece.replace(SPACE, " ").encode())
    return tokens


def same_bytes(a: list[bytes], b: list[bytes], skipped: set[int]) -> np.ndarray:
    """For each id of A the id of B with the same bytes, -1 without one; a written piece goes before a byte's piece."""
    of: dict[bytes, int] = {}
    for number in reversed(range(len(b))):
        if number not in skipped:
            of[b[number]] = number
    return np.array([of.get(token, -1) for token in a], np.int64)


class Aligner:
    """Both tokenizers; a Python worker keeps one, with parts met before, for all its tasks."""

    def __init__(self, a_definition: str, b_model: bytes):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_str(a_definition)
        self.a.encode_special_tokens = True
        self.b = SentencePieceProcessor(model_proto=b_model)
        self.a_bytes, self.b_bytes = bytes_of_a(self.a.get_vocab()), bytes_of_b(self.b)
        skipped = {i for i in range(len(self.b_bytes)) if self.b.is_byte(i) or self.b.is_control(i) or self.b.is_unknown(i)}
        self.same = same_bytes(self.a_bytes, self.b_bytes, skipped).tolist()
        # A part is B's own from space to space as long as no piece has a space inside.
        if any(SPACE in self.b.id_to_piece(i).lstrip(SPACE) for i in range(len(self.b_bytes))):
            raise ValueError("a piece of the second tokenizer spans words")
        self.lone_space = [self.b.piece_to_id(SPACE)]
        self.known: dict[str, tuple | None] = {}

    def learn(self, parts: list[str]) -> None:
        a_ids = [x.ids for x in self.a.encode_batch(parts, add_special_tokens=False)]
        b_ids = self.b.encode([part[1:] for part in parts], num_threads=1)  # the model adds a space before
        for part, a, b in zip(parts, a_ids, b_ids, strict=True):
            self.known[part] = self.align(part.encode(), a, b or self.lone_space)

    def align(self, raw: bytes, a_ids: list[int], b_ids: list[int]) -> tuple | None:
        """Tokens of A and B, groups, the groups as text, and the links as 64-bit numbers. None if bytes are not given back."""
        a_bytes, b_bytes, same = self.a_bytes, self.b_bytes, self.same
        if b"".join([a_bytes[i] for i in a_ids]) != raw or b"".join([b_bytes[i] for i in b_ids]) != raw:
            return None
        groups, links = [], []
        i = j = upto_a = upto_b = 0
        while i < len(a_ids):
            first_a, first_b = i, j
            upto_a, upto_b = upto_a + len(a_bytes[a_ids[i]]), upto_b + len(b_bytes[b_ids[j]])
            while upto_a != upto_b:
                if upto_a < upto_b:
                    i += 1
                    upto_a += len(a_bytes[a_ids[i]])
                else:
                    j += 1
                    upto_b += len(b_bytes[b_ids[j]])
            a, b = a_ids[i], b_ids[j]
            i, j = i + 1, j + 1
            groups.append(f"{','.join(map(str, a_ids[first_a:i]))}|{','.join(map(str, b_ids[first_b:j]))}")
            links.append(a if i - first_a == j - first_b == 1 and same[a] == b else (a + 1) << 32 | b)
        return len(a_ids), len(b_ids), len(groups), ";".join(groups), np.array(links, np.int64).tobytes()

    def rows(self, texts: list[str]) -> Iterator[tuple]:
        """n_a, n_b, n_groups, groups, links (as bytes) of each text."""
        nothing = (0, 0, 0, "", b"")
        for block in blocks(texts):
            spaced = ["" if not text or SPACE in text else f" {text}" for text in texts[block]]
            joined = "".join(spaced)
            if not joined:
                yield from [nothing] * len(spaced)
                continue
            codes, ends = code_points(joined), np.cumsum([len(t) for t in spaced])
            begins = cuts(codes, ends)
            space = codes == 32
            space[1:] &= ~space[:-1]
            space[ends[ends < len(codes)]] = True
            at = np.flatnonzero(begins & space)
            counts = np.diff(np.searchsorted(at, np.concatenate(([0], ends)))).tolist()
            chosen, which = distinct(codes, at)
            stops = np.append(at[1:], len(codes))[chosen]
            parts = [joined[a:b] for a, b in zip(at[chosen].tolist(), stops.tolist(), strict=True)]
            if len(self.known) > MOST_KEPT:
                self.known.clear()
            new = [part for part in parts if part not in self.known]
            if new:
                self.learn(new)
            found = [self.known[part] for part in parts]
            numbers = np.array([x[:3] if x else (-1, 0, 0) for x in found], np.int64)[which]
            sums = np.concatenate((np.zeros((1, 3), np.int64), np.cumsum(numbers, axis=0)))
            broken = np.concatenate(([0], np.cumsum(numbers[:, 0] < 0)))
            which, done = which.tolist(), 0
            for count in counts:
                upto = done + count
                if not count or broken[upto] != broken[done]:
                    yield nothing
                else:
                    own = [found[i] for i in which[done:upto]]
                    groups, links = ";".join([x[3] for x in own]), b"".join([x[4] for x in own])
                    yield (*(sums[upto] - sums[done]).tolist(), groups, links)
                done = upto


aligners: dict[int, Aligner] = {}


def worker_aligner(sent: Broadcast) -> Aligner:
    key = id(sent.value)  # the value stays in the worker as long as the aligner that was made from it
    if key not in aligners:
        aligners.clear()
        aligners[key] = Aligner(*sent.value)
        aligners[key].made_from = sent.value
    return aligners[key]


def read_files(a_path: str, b_path: str) -> tuple[str, bytes]:
    with open(a_path, encoding="utf-8") as a, open(b_path, "rb") as b:
        return a.read(), b.read()


def aligned(documents: DataFrame, a_path: str, b_path: str, packed: bool = False) -> DataFrame:
    """doc_id, row, n_a, n_b, n_groups, groups (``a1,a2|b1;a3|b2,b3``), links (see PAIR; one a group): a row for each document.

    ``row`` tells rows apart whose ids are null or repeat. A's file is a
    byte-level BPE of the tokenizers library, B's a sentencepiece model that
    marks words by a space before; both are fixed vocabularies, read by the
    driver and sent to the tasks. ``packed``: links as compressed bytes, as
    opened() takes them.
    """
    sent = documents.sparkSession.sparkContext.broadcast(read_files(a_path, b_path))

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner, row = worker_aligner(sent), TaskContext.get().partitionId() << 40
        press = zstandard.ZstdCompressor(level=1)
        names = ["doc_id", "row", "n_a", "n_b", "n_groups", "groups", "links"]
        with no_collector():
            for batch in batches:
                texts = [t or "" for t in batch.column("text").to_pylist()]
                for block in blocks(texts):
                    own = batch.slice(block.start, block.stop - block.start)
                    n_a, n_b, n_groups, groups, links = zip(*aligner.rows(texts[block]), strict=True)
                    if packed:
                        listed = pa.array([press.compress(x) for x in links], pa.binary())
                    else:
                        ends = pa.array(np.cumsum([0, *[len(x) // 8 for x in links]]), pa.int32())
                        listed = pa.ListArray.from_arrays(ends, pa.array(np.frombuffer(b"".join(links), np.int64)))
                    rows = np.arange(row, row + len(n_a))
                    row += len(n_a)
                    columns = [own.column("doc_id"), pa.array(rows), *[pa.array(x, pa.int64()) for x in (n_a, n_b, n_groups)]]
                    yield pa.RecordBatch.from_arrays([*columns, pa.array(groups), listed], names)

    kind = documents.schema["doc_id"].dataType.simpleString()
    columns = f"row bigint, n_a bigint, n_b bigint, n_groups bigint, groups string, links {'binary' if packed else 'array<bigint>'}"
    return documents.select("doc_id", "text").mapInArrow(of, f"doc_id {kind}, {columns}")


def opened(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Rows with at most MOST_LINKS links together (a row with more comes alone), all their links, and where each row's begin and end."""
    aligners.clear()  # a worker that has aligned needs its parts no more
    expand = zstandard.ZstdDecompressor()
    for batch in batches:
        ends = np.concatenate(([0], np.cumsum(batch.column("n_groups").to_numpy())))
        start = 0
        while start < batch.num_rows:
            stop = max(start + 1, int(np.searchsorted(ends, ends[start] + MOST_LINKS, "right")) - 1)
            rows = batch.slice(start, stop - start)
            links = b"".join([expand.decompress(x) for x in rows.column("links").to_pylist()])
            yield rows, np.frombuffer(links, np.int64), ends[start : stop + 1] - ends[start]
            start = stop


def totals(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Different keys, and the sum of each one's counts."""
    found, which = np.unique(np.concatenate(keys), return_inverse=True)
    n = np.zeros(len(found), np.int64)
    np.add.at(n, which, np.concatenate(counts))
    return found, n


def counted(rows: DataFrame, a_size: int) -> DataFrame:
    """link, n: how often each link occurs in packed rows."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        regular = np.zeros(a_size, np.int64)
        for batch in batches:
            keys, counts = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
            for _, links, _ in opened(iter([batch])):
                regular += np.bincount(links[links < PAIR], minlength=a_size)
                pairs, n = np.unique(links[links >= PAIR], return_counts=True)
                keys.append(pairs)
                counts.append(n)
            yield pa.RecordBatch.from_arrays([*map(pa.array, totals(keys, counts))], ["link", "n"])
        some = np.flatnonzero(regular)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int64()), pa.array(regular[some])], ["link", "n"])

    tallies = rows.select("n_groups", "links").mapInArrow(of, "link bigint, n bigint")
    return tallies.groupBy("link").agg(F.sum("n").alias("n"))


def irregular(rows: DataFrame) -> DataFrame:
    """row, link, times: the different links of other groups that each of the packed rows has."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, links, ends in opened(batches):
            row = np.repeat(part.column("row").to_numpy(), np.diff(ends))[links >= PAIR]
            pairs = links[links >= PAIR]
            order = np.lexsort((pairs, row))
            row, pairs = row[order], pairs[order]
            first = np.flatnonzero((np.diff(row, prepend=-1) != 0) | (np.diff(pairs, prepend=-1) != 0))
            times = np.diff(np.append(first, len(row)))
            yield pa.RecordBatch.from_arrays([*map(pa.array, (row[first], pairs[first], times))], ["row", "link", "times"])

    return rows.select("row", "n_groups", "links").mapInArrow(of, "row bigint, link bigint, times bigint")


def vector(rows, size: int) -> np.ndarray:
    """Numbers by id; ``rows`` is as long as a vocabulary at most."""
    out = np.zeros(size, np.int64)
    for number, n in rows:
        out[number] = n
    return out


def b_id(link) -> F.Column:
    return link.bitwiseAND(F.lit(PAIR - 1))


def judged(aligned_rows: DataFrame, same: np.ndarray, b_size: int, most_sent: int = MOST_SENT) -> DataFrame:
    """``aligned_rows`` (a stored table, packed) with n_best and count_sum: links whose count is the highest of their B id, and the sum of counts."""
    spark = aligned_rows.sparkSession
    counts = landed(counted(aligned_rows, len(same)), "links")
    pairs = counts.where(F.col("link") >= PAIR)
    regular = vector(counts.where(F.col("link") < PAIR).collect(), len(same))
    best = vector(pairs.groupBy(b_id(F.col("link"))).agg(F.max("n")).collect(), b_size)
    known = same >= 0
    np.maximum.at(best, same[known], regular[known])
    if pairs.count() <= most_sent:
        table = pairs.orderBy("link").toArrow()
        sent = table.column("link").to_numpy(), table.column("n").to_numpy()
        return with_sums(aligned_rows, spark, same, regular, best, sent).drop("row")
    none = np.zeros(0, np.int64), np.zeros(0, np.int64)
    near = with_sums(aligned_rows, spark, same, regular, best, none)
    highest = landed(spark.createDataFrame(pa.table({"b": np.arange(b_size), "highest": best})), "highest")
    rated = pairs.withColumn("b", b_id(F.col("link"))).join(highest, "b").select("link", "n", "highest")
    sums = irregular(aligned_rows).join(rated, "link").groupBy("row")
    sums = sums.agg(
        F.sum(F.when(F.col("n") == F.col("highest"), F.col("times")).otherwise(0)).alias("more_best"),
        F.sum(F.col("times") * F.col("n")).alias("more_sum"),
    )
    whole = near.join(sums, "row", "left")
    return whole.withColumns({
        "n_best": F.col("n_best") + F.coalesce("more_best", F.lit(0)),
        "count_sum": F.col("count_sum") + F.coalesce("more_sum", F.lit(0)),
    }).drop("row", "more_best", "more_sum")


def with_sums(rows: DataFrame, spark: SparkSession, same: np.ndarray, regular: np.ndarray, best: np.ndarray, pairs: tuple) -> DataFrame:
    """Adds n_best and count_sum over regular links and those among ``pairs`` (links in ascending order, counts); without links."""
    sent = spark.sparkContext.broadcast((regular, best, regular == best[same], *pairs))
    kept = [name for name in rows.columns if name != "links"]

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        regular, best, is_best, links, n = sent.value
        for part, flat, ends in opened(batches):
            odd = flat >= PAIR
            count, top = np.zeros(len(flat), np.int64), np.zeros(len(flat), bool)
            count[~odd], top[~odd] = regular[flat[~odd]], is_best[flat[~odd]]
            if len(links):
                at = np.searchsorted(links, flat[odd])
                count[odd] = n[at]
                top[odd] = n[at] == best[flat[odd] & (PAIR - 1)]
            sums = [np.diff(np.concatenate(([0], np.cumsum(x)))[ends]) for x in (top.astype(np.int64), count)]
            yield pa.RecordBatch.from_arrays([*(part.column(name) for name in kept), *map(pa.array, sums)], [*kept, "n_best", "count_sum"])

    columns = ", ".join(f"`{name}` {kind}" for name, kind in rows.dtypes if name != "links")
    return rows.mapInArrow(of, f"{columns}, n_best bigint, count_sum bigint")


def cross_counts(documents: DataFrame, a_path: str, b_path: str, most_sent: int = MOST_SENT) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 (empty without tokens): a row for each document."""
    rows = aligned(documents, a_path, b_path, packed=True)
    digest = F.when(F.col("groups") == "", "").otherwise(F.sha2("groups", 256))
    rows = landed(rows.withColumn("groups_sha256", digest).drop("groups"), "aligned")
    aligner = Aligner(*read_files(a_path, b_path))
    out = judged(rows.withColumn("n_links", F.col("n_groups")), np.array(aligner.same), len(aligner.b_bytes), most_sent)
    return out.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")

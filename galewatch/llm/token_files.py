"""Token ids in files, in ascending document order, as Simple-8b blocks.

Documents are range-partitioned by id, so the files' order is the documents'.
A file is a Parquet file of blocks; a block holds whole documents: their ids,
their numbers of tokens, the packed words, the places of escaped words, and how
many ids of the file come before. So any block decodes alone and at once. Where a document starts in the whole
sequence follows from the files' totals, which are few; nothing else is
gathered.

Null texts are empty and have the end id only. Documents with equal ids follow
each other by the hash of their texts; a null id comes first. A document longer
than a block is a block of its own. Empty tables give no rows.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from struct import pack
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from galewatch.llm import simple8b
from galewatch.llm.pieces import Cutter
from galewatch.llm.shared import landed, no_collector, shared_folder

END = 2
BLOCK_IDS = 1 << 16  # ids after which a block is closed
MOST_KEPT = 600_000  # pieces that a Python worker remembers


def alphabet() -> dict[int, str]:
    """The character that byte-level vocabularies write for each byte: itself if it is visible, else the next from 256."""
    seen = [*range(33, 127), *range(161, 173), *range(174, 256)]
    return {b: chr(b) for b in seen} | {b: chr(256 + i) for i, b in enumerate(x for x in range(256) if x not in seen)}


class LibraryEncoder:
    """The tokenizers library's model, asked once for each piece that a text is cut into.

    A text that holds an added token of the definition goes through the library
    as a whole, which alone knows where such a token ends a piece.
    ``encode_special_tokens``: the library's switch of that name; if set, special
    tokens are cut like other text.
    """

    def __init__(self, definition: str, pattern: str, encode_special_tokens: bool):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(definition)
        self.tokenizer.encode_special_tokens = encode_special_tokens
        self.written, self.cutter = str.maketrans(alphabet()), Cutter(pattern)
        self.known: dict[str, bytes] = {}
        added = self.tokenizer.get_added_tokens_decoder().values()
        self.added = [token.content for token in added if not (token.special and encode_special_tokens)]

    def learn(self, new: list[str]) -> None:
        tokenize, written = self.tokenizer.model.tokenize, self.written
        for piece in new:
            ids = [token.id for token in tokenize(piece.encode().decode("latin-1").translate(written))]
            self.known[piece] = pack(f"<{len(ids)}I", *ids)

    def encode(self, texts: list[str]) -> Iterator[bytes]:
        """Ids of each text, as little-endian 32-bit numbers."""
        whole = {i: text for i, text in enumerate(texts) if any(token in text for token in self.added)}
        plain = [text for i, text in enumerate(texts) if i not in whole] if whole else texts
        cut = self.cutter.encode(plain, self.known, self.learn, MOST_KEPT)
        for i in range(len(texts)):
            if i in whole:
                ids = self.tokenizer.encode(whole[i], add_special_tokens=False).ids
                yield pack(f"<{len(ids)}I", *ids)
            else:
                yield next(cut)


encoders: dict[int, LibraryEncoder] = {}


def worker_encoder(definition: str, pattern: str, encode_special_tokens: bool) -> LibraryEncoder:
    """One for all tasks of a Python worker."""
    key = hash((definition, pattern, encode_special_tokens))
    if key not in encoders:
        encoders.clear()
        encoders[key] = LibraryEncoder(definition, pattern, encode_special_tokens)
    return encoders[key]


def block_row(first: int, doc_ids: list, raws: list[bytes]) -> list:
    """``first``: ids in the file's blocks before."""
    counts = [len(raw) // 4 for raw in raws]
    words, plain = simple8b.encode(np.frombuffer(b"".join(raws), "<u4"))
    return [first, doc_ids, counts, sum(counts), words.astype("<u8").tobytes(), plain.tolist()]


def write(
    documents: DataFrame, tokenizer_path: str, pattern: str, path: str, end: int = END, encode_special_tokens: bool = True
) -> None:
    """Write the files of all documents below ``path``, a folder that Spark can write to.

    Special tokens that a text spells out are text, unless ``encode_special_tokens`` is False, as it is in the library.
    """
    spark = documents.sparkSession
    with open(tokenizer_path, encoding="utf-8") as lines:
        definition = spark.sparkContext.broadcast(lines.read())  # a fixed vocabulary
    kind = documents.schema["doc_id"].dataType
    names = ["file", "first", "doc_ids", "counts", "n_ids", "words", "plain"]
    schema = (
        f"file int, first bigint, doc_ids array<{kind.simpleString()}>, counts array<bigint>, n_ids bigint,"
        " words binary, plain array<bigint>"
    )

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = worker_encoder(definition.value, pattern, encode_special_tokens)
        with no_collector():
            file, first, doc_ids, raws, held = TaskContext.get().partitionId(), 0, [], [], 0
            arrow = None
            for batch in batches:
                texts = [t or "" for t in batch.column("text").to_pylist()]
                arrow = batch.schema.field("doc_id").type
                rows = []
                for doc_id, raw in zip(batch.column("doc_id").to_pylist(), encoder.encode(texts), strict=True):
                    doc_ids.append(doc_id)
                    raws.append(raw + pack("<I", end))
                    held += len(raw) // 4 + 1
                    if held >= BLOCK_IDS:
                        rows.append(block_row(first, doc_ids, raws))
                        first, doc_ids, raws, held = first + held, [], [], 0
                if rows:
                    yield as_batch(file, rows, arrow)
            if doc_ids:
                yield as_batch(file, [block_row(first, doc_ids, raws)], arrow)

    def as_batch(file: int, rows: list[list], arrow: pa.DataType) -> pa.RecordBatch:
        first, doc_ids, counts, n_ids, words, plain = zip(*rows, strict=True)
        longs = pa.list_(pa.int64())
        columns = [
            pa.array([file] * len(rows), pa.int32()),
            pa.array(first, pa.int64()),
            pa.array(doc_ids, pa.list_(arrow)),
            pa.array(counts, longs),
            pa.array(n_ids, pa.int64()),
            pa.array(words, pa.binary()),
            pa.array(plain, longs),
        ]
        return pa.RecordBatch.from_arrays(columns, names)

    order = documents.select("doc_id", "text").withColumn("_at", F.xxhash64("text"))
    order = order.repartitionByRange("doc_id", "_at").sortWithinPartitions("doc_id", "_at").select("doc_id", "text")
    order.mapInArrow(of, schema).write.parquet(path)


def starts(files: DataFrame) -> DataFrame:
    """file, base: ids in all files before. One row for each file goes through one task."""
    totals = files.groupBy("file").agg(F.sum("n_ids").alias("n_ids"))
    before = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    return totals.select("file", F.coalesce(F.sum("n_ids").over(before), F.lit(0)).alias("base"))


def located(files: DataFrame) -> DataFrame:
    """Blocks with ``start``: ids in all blocks before."""
    return files.join(landed(starts(files), "bases"), "file").withColumn("start", F.col("base") + F.col("first"))


def read(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32, ids: each document of the files below ``path``."""
    files = located(spark.read.parquet(path))
    kind = files.schema["doc_ids"].dataType.elementType.simpleString()
    names = ["doc_id", "start", "n_tokens", "ids_crc32", "ids"]

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                words, plain = batch.column("words")[i].as_py(), batch.column("plain")[i].as_py()
                counts = np.array(batch.column("counts")[i].as_py(), np.int64)
                ids = simple8b.decode(np.frombuffer(words, "<u8"), np.array(plain, np.int64), int(counts.sum()))
                ids = ids.astype("<u4")
                ends = np.cumsum(counts)
                own = np.split(ids, ends[:-1])
                sums = pa.array([crc32(x.tobytes()) for x in own], pa.int64())
                doc_ids = batch.column("doc_ids")[i].values
                flat = pa.array(ids.view(np.int32))
                lists = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], ends)), pa.int32()), flat)
                at = pa.array(batch.column("start")[i].as_py() + ends - counts)
                yield pa.RecordBatch.from_arrays([doc_ids, at, pa.array(counts), sums, lists], names)

    wanted = files.select("start", "doc_ids", "counts", "words", "plain")
    return wanted.mapInArrow(of, f"doc_id {kind}, start bigint, n_tokens bigint, ids_crc32 bigint, ids array<int>")


def new_path(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/token-files-{uuid.uuid4().hex}"

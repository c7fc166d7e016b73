"""Personal data in whole texts: fixed patterns, and a BiLSTM-CRF for what they don't cover.

The model is trained on labelled spans: those that the patterns find in a
bounded sample of the corpus, and written variants of them (brackets for @ and
dots, other separators, no country code) put into texts of the sample. Every
text is read whole, in overlapping windows that are decoded for themselves; the
spans of all windows of a text are then reconciled at once: of spans that
overlap, the choice with the highest sum of scores stays. What overlaps a
pattern's match, or can't be of its kind, is left out; pattern matches always
stay.

Null and empty texts have no spans. Repeated rows are read alike. Of equal
scores the earlier span stays. Without rows to sample, the variants stand among
random letters, so that there is a model for every table.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from galewatch.llm import pii_model
from galewatch.llm.pieces import blocks
from galewatch.llm.pii_rules import KINDS, base_spans, digits_of, in_order, luhn, small_parts

SAMPLE = 3_000  # documents that the model is trained on, the first by hash
PASSAGE = 600  # characters of a sampled document that the driver gets
DRAWS = 1 << 40
WINDOW, OVERLAP = 1024, 128  # characters; a span up to the overlap's length is whole in some window
LANES = 2048  # windows read together
TRAINED = 96  # characters of a training window
STEPS, BATCH, SEED = 260, 96, 7

Span = tuple[str, int, int]


# ---- labelled spans ------------------------------------------------------------


def written(kind: str, random: np.random.Generator) -> str:
    """Personal data of a kind, in the plain form or another."""
    number = lambda n: "".join(map(str, random.integers(0, 10, n)))
    word = lambda a, b: "".join(chr(97 + i) for i in random.integers(0, 26, random.integers(a, b)))
    pick = lambda *of: of[random.integers(0, len(of))]
    if kind == "email":
        name = word(3, 8) + pick("", "." + number(2), "_" + word(2, 5), number(2))
        host, end = word(3, 8) + pick("", number(1)), pick("com", "org", "net", "example.com", "de", "fr")
        at, dot = pick(("@", "."), (" (at) ", "."), (" [at] ", "."), (" [at] ", " [dot] "), (" (at) ", " (dot) "), ("[@]", "."))
        return name + at + host + dot + end.replace(".", dot)
    if kind == "ip":
        return pick(".", "[.]", " . ", "(.)").join(str(n) for n in random.integers(1, 256, 4))
    if kind == "card":
        body = pick("4", "51", "37") + number(13)
        body = next(body[:15] + str(d) for d in range(10) if luhn(body[:15] + str(d))) if len(body) >= 15 else body + number(2)
        return pick("", " ", "-", ".", "_", "/").join(body[i : i + 4] for i in range(0, len(body), 4))
    area, three, four = str(random.integers(200, 999)), number(3), number(4)
    return pick(f"+1 ({area}) {three}-{four}", f"({area}) {three}-{four}", f"{area}-{three}-{four}", f"001 {area} {three} {four}", f"{area}.{three}.{four}")


def harmless(random: np.random.Generator) -> str:
    """Digits and signs that are no personal data."""
    n = lambda a, b: int(random.integers(a, b))
    forms = (
        f"{n(1900, 2100)}-{n(10, 13)}-{n(10, 29)}",
        f"{n(10, 24)}:{n(10, 60)}",
        f"{n(1, 9)}.{n(0, 20)}.{n(0, 20)}",
        f"${n(1, 999)},{n(100, 999)}.{n(10, 99)}",
        f"password={n(1 << 40, 1 << 50):x}",
        f"AKIA{n(1 << 40, 1 << 50):X}",
        f"no. {n(1, 10**6)}",
        f"@{chr(97 + n(0, 26))}{chr(97 + n(0, 26))}{chr(97 + n(0, 26))}",
        f"{n(1, 99)}% (at) {n(1, 99)}",
    )
    return forms[n(0, len(forms))]


def labelled(texts: list[str], seed: int = SEED) -> tuple[np.ndarray, np.ndarray]:
    """Codes and tags of training windows: around each base span, and with something put in."""
    random = np.random.default_rng(seed)
    texts = [t for t in texts if len(t) >= TRAINED] or [
        "".join(chr(c) for c in random.choice([32, *range(97, 123)], 400)) for _ in range(50)
    ]
    windows: list[tuple[str, list[Span]]] = []
    for text in texts:
        found = base_spans(text)
        for kind, a, b in found[:4]:
            start = max(0, min(a - int(random.integers(0, TRAINED // 2)), len(text) - TRAINED))
            windows.append((text[start : start + TRAINED], [(k, x - start, y - start) for k, x, y in found]))
        start = int(random.integers(0, len(text) - TRAINED + 1))
        piece = text[start : start + TRAINED]
        inside = [(k, x - start, y - start) for k, x, y in found if y > start and x < start + TRAINED]
        if inside:
            windows.append((piece, inside))
            continue
        put, at = harmless(random), int(random.integers(0, TRAINED // 2))
        windows.append(((piece[:at] + " " + put + " " + piece[at:])[:TRAINED], []))
        kind = KINDS[random.integers(0, len(KINDS))]
        put, at = written(kind, random), int(random.integers(0, TRAINED // 2))
        end = (" ", ". ", ", ")[random.integers(0, 3)]
        whole = piece[:at] + " " + put + end + piece[at:]
        windows.append((whole[:TRAINED], [(kind, at + 1, at + 1 + len(put))]))
        windows.append((piece, []))
    codes, tags = np.zeros((len(windows), TRAINED), np.uint8), np.zeros((len(windows), TRAINED), np.uint8)
    for i, (text, spans) in enumerate(windows):
        codes[i, : len(text)] = pii_model.codes_of(text)
        for kind, a, b in spans:
            tags[i, max(a, 0) : max(b, 0)] = 1 + KINDS.index(kind)
    return codes, tags


def fitted(documents: DataFrame, sample: int = SAMPLE) -> dict[str, np.ndarray]:
    """The model of a corpus. Of each sampled document the driver gets a passage of bounded length.

    Documents are taken by the hash of id and text: about twice as many as
    wanted, of which the first by hash remain.
    """
    drawn = documents.where("text is not null").select(F.xxhash64("doc_id", "text", F.lit(SEED)).alias("drawn"), "text")
    share = min(1.0, 2 * sample / max(documents.count(), 1))
    some = drawn.where(F.pmod("drawn", F.lit(DRAWS)) < int(share * DRAWS))

    def passages(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text in batch.column("text").to_pylist():
                found = base_spans(text)
                start = max(0, found[0][1] - 200) if found else 0
                out.append(text[start : start + PASSAGE])
            yield pa.RecordBatch.from_arrays([batch.column("drawn"), pa.array(out, pa.string())], ["drawn", "text"])

    first = some.mapInArrow(passages, "drawn bigint, text string").orderBy("drawn", "text").limit(sample)
    texts = [row.text for row in first.collect()]
    codes, tags = labelled(texts)
    return pii_model.train(codes, tags, STEPS, BATCH, SEED)


# ---- decoding --------------------------------------------------------------------


def windows_of(length: int) -> list[tuple[int, int]]:
    """Overlapping windows that cover a text."""
    if length <= WINDOW:
        return [(0, length)] if length else []
    starts = range(0, length - OVERLAP, WINDOW - OVERLAP)
    return [(a, min(a + WINDOW, length)) for a in starts]


def window_spans(weights: dict[str, np.ndarray], texts: list[str]) -> list[list[tuple[float, int, int, int]]]:
    """For each text the spans that its windows decode to, as (score, start, end, tag)."""
    found: list[list[tuple[float, int, int, int]]] = [[] for _ in texts]
    codes = np.append(pii_model.codes_of("".join(texts)), np.zeros(WINDOW, np.uint8))
    firsts = np.cumsum([0, *map(len, texts)])
    lanes = [(b - a, i, a, b) for i, text in enumerate(texts) for a, b in windows_of(len(text))]
    lanes.sort(key=lambda lane: lane[0])  # windows of about one length together
    for some in range(0, len(lanes), LANES):
        own = lanes[some : some + LANES]
        longest = own[-1][0]
        at = np.array([firsts[i] + a for _, i, a, _ in own])
        sizes = np.array([size for size, *_ in own])
        block = np.ascontiguousarray(sliding_window_view(codes, longest)[at].T)
        if sizes[0] < longest:
            block[np.arange(longest)[:, None] >= sizes] = 0
        scores = pii_model.emissions(weights, block)
        hope = np.flatnonzero(~pii_model.hopeless(scores, weights["moves"]))
        if not len(hope):
            continue
        chosen = scores[:, :, hope]
        paths = pii_model.best_paths(chosen, weights["moves"])
        for lane in np.flatnonzero(paths.any(axis=0)):
            size, i, a, b = own[hope[lane]]
            path = paths[:size, lane].astype(np.int64)
            margins = np.take_along_axis(chosen[:size, :, lane], path[:, None], 1)[:, 0] - chosen[:size, 0, lane]
            edges = np.flatnonzero(np.diff(path, prepend=0, append=0))
            for x, y in zip(edges, edges[1:], strict=False):
                if path[x]:
                    cut = (x == 0 and a > 0) or (y == size and b < len(texts[i]))
                    score = float(margins[x:y].sum()) * (0.1 if cut else 1)
                    found[i].append((round(score, 3), a + int(x), a + int(y), int(path[x])))
    return found


def reconciled(spans: list[tuple[float, int, int, int]]) -> list[tuple[int, int, int]]:
    """Spans of all windows of a text without overlaps, with the highest sum of scores; as (start, end, tag)."""
    best: dict[tuple[int, int, int], float] = {}
    for score, *span in spans:
        best[tuple(span)] = max(score, best.get(tuple(span), 0.0))
    ordered = sorted(best, key=lambda s: (s[1], s[0], s[2]))
    ends = [s[1] for s in ordered]
    total, taken = [0.0], []
    for j, (a, _, _) in enumerate(ordered):
        before = int(np.searchsorted(ends[:j], a, side="right"))
        with_it = total[before] + best[ordered[j]]
        taken.append(before if with_it > total[j] else -1)
        total.append(max(with_it, total[j]))
    out, j = [], len(ordered)
    while j:
        if taken[j - 1] >= 0:
            out.append(ordered[j - 1])
            j = taken[j - 1]
        else:
            j -= 1
    return out[::-1]


AT = re.compile(r"[A-Za-z0-9._%+-]+ ?(?:@|[\[({] ?(?:@|at) ?[\])}]) ?[A-Za-z0-9-]+(?: ?(?:\.|[\[({] ?(?:\.|dot) ?[\])}]) ?[A-Za-z0-9-]+)+", re.I)
PARTS = re.compile(r"[0-9]+")


def possible(kind: str, text: str) -> bool:
    """Whether a text can be personal data of a kind at all."""
    digits = digits_of(text)
    if kind == "email":
        return bool(AT.fullmatch(text))
    if kind == "ip":
        parts = PARTS.findall(text)
        return len(parts) == 4 and small_parts(parts) and text.count(".") == 3
    if kind == "card":
        return 13 <= len(digits) <= 19 and luhn(digits)
    return 10 <= len(digits) <= 15 and not re.search(r"[^0-9+(). -]", text)


def spans_of(texts: list[str], weights: dict[str, np.ndarray]) -> Iterator[tuple[list[Span], list[Span]]]:
    """Base spans and all spans of each text."""
    for text, decoded in zip(texts, window_spans(weights, texts), strict=True):
        base = base_spans(text)
        added = []
        for a, b, tag in reconciled(decoded):
            part = text[a:b]
            a, b = a + len(part) - len(part.lstrip(" ,;:")), b - (len(part) - len(part.rstrip(" .,;:")))
            kind = KINDS[tag - 1]
            if a < b and not any(x < b and a < y for _, x, y in base) and possible(kind, text[a:b]):
                added.append((kind, a, b))
        yield base, in_order(base + added)


def listed(spans: list[Span]) -> str:
    return ",".join(f"{kind}:{a}:{b}" for kind, a, b in spans)


def found(documents: DataFrame, weights: dict[str, np.ndarray] | None = None) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone (base spans), base_sha256, spans (base and added)."""
    model = documents.sparkSession.sparkContext.broadcast(weights or fitted(documents))  # some thousand numbers
    counts = [f"n_{kind}" for kind in KINDS]

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t or "" for t in batch.column("text").to_pylist()]
            for block in blocks(texts):
                rows = list(spans_of(texts[block], model.value))
                own = batch.column("doc_id").slice(block.start, block.stop - block.start)
                numbers = [pa.array([sum(s[0] == kind for s in base) for base, _ in rows], pa.int64()) for kind in KINDS]
                digests = pa.array([sha256(listed(base).encode()).hexdigest() for base, _ in rows])
                columns = [own, *numbers, digests, pa.array([listed(every) for _, every in rows])]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", *counts, "base_sha256", "spans"])

    kind = documents.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, {', '.join(f'{c} bigint' for c in counts)}, base_sha256 string, spans string"
    return documents.select("doc_id", "text").mapInArrow(of, schema)

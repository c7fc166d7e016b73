"""The contracts of the operators, computed the plain way."""

import re
import zlib
from hashlib import sha256

import numpy as np
import xxhash

KINDS = ("email", "ip", "card", "phone")
PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def valid(kind, found):
    digits = [int(c) for c in found if c in "0123456789"]
    if kind == "ip":
        return all(int(p) <= 255 for p in found.split("."))
    if kind == "card":
        doubled = [sum(divmod(2 * d, 10)) if i % 2 else d for i, d in enumerate(reversed(digits))]
        return 14 <= len(digits) <= 19 and sum(doubled) % 10 == 0
    return kind == "email" or 10 <= len(digits) <= 15


def base_spans(text):
    spans = [(k, *m.span()) for k in KINDS for m in re.finditer(PATTERNS[k], text or "") if valid(k, m[0])]
    return sorted(spans, key=lambda s: (s[1], KINDS.index(s[0])))


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", lower(text))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups(fingerprints):
    """Fingerprint -> all fingerprints reachable by steps of 2 bits at most."""
    distinct = sorted(set(fingerprints))
    root = {f: f for f in distinct}

    def find(f):
        while root[f] != f:
            root[f] = root[root[f]]
            f = root[f]
        return f

    for i, a in enumerate(distinct):
        for b in distinct[:i]:
            if (a ^ b).bit_count() <= 2:
                root[find(a)] = find(b)
    return {f: find(f) for f in distinct}


def simhash(rows):
    """doc_id, fingerprint, component_id."""
    prints = [fingerprint(text) for _, text in rows]
    group = groups(prints)
    least = {}
    for (doc_id, _), fp in zip(rows, prints, strict=True):
        least[group[fp]] = min(doc_id, least.get(group[fp], doc_id))
    return [(d, f"{fp:016x}", least[group[fp]]) for (d, _), fp in zip(rows, prints, strict=True)]


def passages(rows, length=50):
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256."""
    data = [(d, (t or "").encode()) for d, t in rows]
    least = {}
    for d, b in data:
        for i in range(len(b) - length + 1):
            w = b[i : i + length]
            least[w] = min(d, least.get(w, d))
    out = []
    for d, b in data:
        gone = np.zeros(len(b), bool)
        for i in range(len(b) - length + 1):
            if least[b[i : i + length]] < d:
                gone[i : i + length] = True
        spans = int((np.diff(gone.astype(int), prepend=0) == 1).sum()) if len(b) else 0
        kept = bytes(np.frombuffer(b, np.uint8)[~gone])
        out.append((d, len(b), int(gone.sum()), spans, sha256(kept).hexdigest()))
    return out


def repeat_words(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    counts = {}
    for w in windows:
        counts[w] = counts.get(w, 0) + 1
    return len({j for i, w in enumerate(windows) if counts[w] > 1 for j in range(i, i + 8)})


def crc32_of(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def words_of(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text))


def decontaminated(documents, benchmark):
    """(doc_id, n_words, n_hit, sorted items, contaminated)."""
    windows = {}
    for item, text in benchmark:
        words = words_of(text)
        n = min(13, len(words))
        for i in range(len(words) - n + 1 if n else 0):
            windows.setdefault(tuple(words[i : i + n]), set()).add(str(item))
    out = []
    for doc_id, text in documents:
        words, hit, items = words_of(text), set(), set()
        for n in {len(w) for w in windows}:
            for i in range(len(words) - n + 1):
                if (found := windows.get(tuple(words[i : i + n]))) is not None:
                    hit.update(range(i, i + n))
                    items |= found
        out.append((doc_id, len(words), len(hit), sorted(items), bool(hit) and 20 * len(hit) >= len(words)))
    return out

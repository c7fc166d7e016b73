"""Near-duplicates, components, line dedup and decontamination against brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from galewatch.llm import decontaminate, line_dedup, simhash
from galewatch.llm.graph import components
from galewatch.llm.shared import landed
from tests.llm import brute


@pytest.mark.parametrize("text", [None, "", " \t", "One", "one TWO", "a b c", "É é A" * 50, "x " * 5000, "the cat sat on the mat"])
def test_fingerprint(text):
    assert simhash.fingerprint(text) == brute.fingerprint(text)


def signed(fp):
    return fp - (1 << 64) if fp >> 63 else fp


def fingerprint_sets():
    random = np.random.default_rng(5)
    wide = [int(x) for x in random.integers(0, 1 << 63, 300)]
    near = [w ^ (1 << int(random.integers(0, 64))) ^ (1 << int(random.integers(0, 64))) for w in wide[:150]]
    ball = [wide[0] ^ (1 << i) ^ (1 << j) for i in range(0, 64, 3) for j in range(0, 64, 5)]
    edge = [0, 1, 3, 7, (1 << 64) - 1, (1 << 64) - 2, 1 << 63, (1 << 63) | 1, 0xF, 0xFF, 0xF0F]
    chain = [wide[9] ^ ((1 << i) - 1) for i in range(40)]
    return {"ball": ball, "all": wide + near + ball + edge + chain}


@pytest.mark.parametrize("name", ["ball", "all"])
def test_links_connect_what_is_close(spark, name):
    fps = sorted(set(fingerprint_sets()[name]))
    frame = spark.createDataFrame([(signed(f),) for f in fps], "fp bigint")
    links = landed(simhash.links(frame), "links")
    edges = [(r.u, r.v) for r in links.collect()]
    assert all(((u ^ v) & ((1 << 64) - 1)).bit_count() <= 2 for u, v in edges)
    root = {r.node: r.root for r in components(links).collect()}
    want = brute.groups(fps)
    mine = {f: root.get(signed(f), signed(f)) for f in fps}
    classes = lambda of: sorted(sorted(f for f in fps if of[f] == c) for c in set(of.values()))
    assert classes(mine) == classes(want)


def test_components_of_chains_stars_and_rings(spark):
    edges = [(i, i + 1) for i in range(0, 70)] + [(100, i) for i in range(101, 140)] + [(200 + i, 200 + (i + 1) % 9) for i in range(9)]
    edges += [(7, 7), (300, 301), (301, 300)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "u bigint, v bigint")).collect()}
    want = {i: 0 for i in range(71)} | {i: 100 for i in range(100, 140)} | {i: 200 for i in range(200, 209)} | {300: 300, 301: 300}
    assert got == want
    assert components(spark.createDataFrame([], "u bigint, v bigint")).collect() == []


def near_rows():
    random = np.random.default_rng(8)
    word = lambda: "".join(random.choice(list("abcdefgh"), 5))
    rows = []
    for i in range(40):
        words = [word() for _ in range(int(random.integers(1, 400)))]
        rows.append((i, " ".join(words)))
        rows.append((100 + i, " ".join(words).upper()))
        words[len(words) // 2] = word()
        rows.append((200 + i, " ".join(words)))
    return [*rows, (300, None), (301, ""), (302, " \n"), (5, rows[15][1]), (5, rows[15][1]), (303, "w " * 9000)]


def test_grouped(documents):
    rows = near_rows()
    got = simhash.grouped(documents(rows, "fp", "component_id"))
    got = got.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")), "component_id").collect()
    assert sorted(map(tuple, got)) == sorted(brute.simhash(rows))
    assert simhash.grouped(documents(rows).where("false")).collect() == []


def test_one_of_each(documents):
    rows = near_rows()
    frame = documents(rows, "fp", "root")
    got = simhash.one_of_each(frame)
    assert got.columns == frame.columns
    assert sorted(r.doc_id for r in got.collect()) == sorted({c for _, _, c in brute.simhash(rows)})


def test_null_ids_are_no_least_id(documents):
    got = {(r.doc_id, r.component_id) for r in simhash.grouped(documents([(None, "a b c"), (4, "a b c"), (None, "q r s t")])).collect()}
    assert got == {(None, 4), (4, 4), (None, None)}
    kept = simhash.one_of_each(documents([(None, "a b c"), (4, "a b c"), (None, "q r s t")])).collect()
    assert [r.doc_id for r in kept if r.text == "a b c"] == [4]


def test_one_of_each_tells_rows_apart_by_text(documents):
    rows = [(None, "a b c"), (4, "a b c"), (None, "q r s t"), (None, None)]  # one group with an id, unrelated texts without
    rows += [(7, "k l m n o"), (8, "k l m n o"), (8, "u v w x y"), (8, "u v w x y")]  # 8 has a copy of 7's and its own text
    rows += [(9, "aa bb cc dd"), (9, "ee ff gg hh")]  # the least of two groups
    rows += [(10, "One two"), (10, "one TWO")]  # one group whose texts share the least id
    frame = documents(rows, "_id", "_key", "least")
    got = sorted(((r.doc_id, r.text) for r in simhash.one_of_each(frame).collect()), key=repr)
    want = [(4, "a b c"), (None, "q r s t"), (None, None), (7, "k l m n o"), (8, "u v w x y"), (9, "aa bb cc dd"), (9, "ee ff gg hh")]
    ten = [r for r in got if r[0] == 10]
    assert len(ten) == 1 and ten[0] in rows
    assert sorted((r for r in got if r[0] != 10), key=repr) == sorted(want, key=repr)


def test_lines(documents):
    rows = [(i, f"Menu\nown line {i}\n\n  \nMenu" if i % 2 else f"Menu\nother {i}", "en", "hot") for i in range(60)]
    rows += [(100 + i, "Menu\nsmall", "en", "small") for i in range(2)] + [(200 + i, f"Rare\nx{i}" if i < 10 else f"y{i}", "en", "r") for i in range(100)]
    rows += [(300 + i, f"Often\nx{i}" if i < 11 else f"y{i}", "en", "o") for i in range(100)] + [(400, None, "en", "hot"), (401, "", "en", "hot")]
    rows += [(500 + i, f"Null site\n{i}", "en", None) for i in range(20)] + [(600, "Menu", "en", "hot"), (600, "Menu", "en", "hot")]
    rows += [(700 + 100 * n + i, "Foot\nx" if i < 3 else f"y{i}", "en", f"site{n}") for n in (3, 20, 29, 31, 99) for i in range(n)]
    frame = documents(rows, "_line", "held", "host", "_lines", "_left", "_site", "_dropped", "row", "site")
    assert set(line_dedup.without_boilerplate(frame).select("_lines", "_left", "_site", "_dropped", "row", "site").distinct().first()) == {"clash"}
    got = {(r.doc_id, r.text, r.n_chars) for r in line_dedup.without_boilerplate(frame).collect()}
    assert line_dedup.without_boilerplate(frame).columns == frame.columns
    assert line_dedup.without_boilerplate(frame).count() == len(rows)

    def cut(doc_id, text, _, site):
        if text is None:
            return None
        gone = {"hot": ["Menu"], "o": ["Often"], None: ["Null site"]} | {f"site{n}": ["Foot", "x"] for n in (3, 20, 29)}
        return "\n".join(line for line in text.split("\n") if line not in gone.get(site, []))

    want = {(r[0], cut(*r), len(cut(*r)) if r[1] is not None else None) for r in rows}
    assert got == want
    assert line_dedup.without_boilerplate(frame.where("false")).collect() == []


ITEM = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen"
ITEMS = [(1, ITEM), (2, "short item"), (3, None), (4, "..."), (5, "Solo"), (10, ITEM.upper()), (6, "é ü ß x y z é ü ß x y z é ü ß")]


def passages_rows():
    words = ITEM.split()
    return [
        (1, ITEM), (2, "filler " * 400 + ITEM), (3, "filler " * 100 + ITEM), (4, " ".join(words[:12])), (5, " ".join(words[1:14]) + " x"),
        (6, "A short, ITEM! and again short-item"), (7, None), (8, ""), (9, "solo solo solo"), (9, "solo solo solo"), (9, "another text"),
        (None, ITEM + " " + ITEM), (11, "é ü ß x y z é ü ß x y z é ü ß x y z é ü ß"), (12, "w " * 30_000), (13, ITEM.replace(" ", "--")),
    ]


@pytest.mark.parametrize("items", [ITEMS, []])
def test_decontaminated(spark, documents, items):
    rows = passages_rows()
    benchmark = spark.createDataFrame(items, "item_id bigint, text string").selectExpr("*", "'clash' as words", "1 as start")
    frame = documents(rows, "words", "key", "n_hit")
    got = [(r.doc_id, r.n_words, r.n_hit, r["items"], r.contaminated) for r in decontaminate.decontaminate(frame, benchmark).collect()]
    want = brute.decontaminated(rows, items)
    assert sorted(got, key=repr) == sorted(want, key=repr)
    kept = decontaminate.without_contaminated(frame, benchmark)
    assert kept.columns == frame.columns
    clean = [(d, t) for (d, t), w in zip(rows, want, strict=True) if not w[4]]
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=repr) == sorted(clean, key=repr)


def test_the_way_without_broadcast(spark, documents, monkeypatch):
    monkeypatch.setattr(decontaminate, "BROADCAST_KEYS", 0)
    rows = passages_rows()
    benchmark = spark.createDataFrame(ITEMS, "item_id bigint, text string")
    got = [(r.doc_id, r.n_words, r.n_hit, r["items"], r.contaminated) for r in decontaminate.decontaminate(documents(rows), benchmark).collect()]
    assert sorted(got, key=repr) == sorted(brute.decontaminated(rows, ITEMS), key=repr)


def test_no_documents(spark, documents):
    benchmark = spark.createDataFrame(ITEMS, "item_id bigint, text string")
    assert decontaminate.decontaminate(documents([(1, "x")]).where("false"), benchmark).collect() == []

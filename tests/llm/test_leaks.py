"""Benchmark decontamination against brute force over words."""

from __future__ import annotations

import random
import re

import numpy as np
import pyarrow as pa
import pytest

from purchaseflow.llm import decontaminate as dc

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans({chr(i): chr(i + 32) for i in range(65, 91)})


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def brute(texts, items, window):
    """Per text: its words, the places of hit words and the items that hit."""
    windows = {}
    for name, text in items:
        w = words(text)
        size = min(window, len(w))
        for k in range(len(w) - size + 1 if w else 0):
            windows.setdefault(tuple(w[k : k + size]), set()).add(name)
    found = []
    for text in texts:
        w, hit, names = words(text), set(), set()
        for size in {len(k) for k in windows}:
            for k in range(len(w) - size + 1):
                own = windows.get(tuple(w[k : k + size]), ())
                names.update(own)
                hit.update(range(k, k + size) if own else ())
        found.append((w, hit, names))
    return found


def made(rng, count=80):
    """Items, some short or shared in part, and texts made of their parts."""
    pool = ["Ab", "b9", "été", "日本", "c", "d_e", "f", "gg", "H"]
    line = lambda n: rng.choice([" ", ". ", "\n"]).join(rng.choices(pool, k=n))
    items = [(str(i), line(rng.choice([0, 1, 2, 4, 9, 12, 30]))) for i in range(12)]
    items += [("12", items[5][1]), ("13", None), ("14", items[7][1] + " tail " + items[8][1])]
    texts = []
    for _ in range(count):
        parts = []
        for _ in range(rng.randrange(6)):
            source = words(rng.choice(items)[1])
            cut = rng.randrange(len(source) + 1) if source else 0
            parts.append(rng.choice([" ".join(source[cut:]), " ".join(source[:cut]), line(3), "zz é"]))
        texts.append(" - ".join(parts))
    return items, [*texts, None, "", "...", "ab " * 60]


def spans_of(found):
    return {k for s in found for k in range(s[0], s[1])}


@pytest.mark.parametrize("window", [1, 3, 10])
def test_automaton_finds_what_brute_force_finds(window):
    items, texts = made(random.Random(window))
    scanner = dc._Items([(n, t or "") for n, t in items], window).scanner()
    column = pa.array([t or "" for t in texts])
    got = [x for raw, cuts in dc._texts(column) for x in scanner.scan(raw, cuts)]
    for text, (count, spans, names), (w, hit, expected) in zip(
        texts, got, brute(texts, items, window), strict=True
    ):
        assert (count, spans_of(spans), names) == (len(w), hit, expected)
        for first, end, start, stop in spans:
            assert words(text[start:stop]) == w[first:end]


def test_matching_lengths_are_the_longest():
    rng = random.Random(2)
    listed = [[rng.choice("abc").encode() for _ in range(rng.randrange(1, 25))] for _ in range(9)]
    automaton = dc.Automaton([(str(i), x) for i, x in enumerate(listed)], 10_000)
    inner = {tuple(x[i:j]) for x in listed for i in range(len(x)) for j in range(i + 1, len(x) + 1)}
    text = [rng.choice("abcd").encode() for _ in range(400)]
    at = matched = 0
    for i, word in enumerate(text):
        number = automaton.ids.get(word, -1)
        while at and number not in automaton.next[at]:
            at = automaton.link[at]
            matched = automaton.length[at]
        if number in automaton.next[at]:
            at, matched = automaton.next[at][number], matched + 1
        longest = max((n for n in range(i + 2) if tuple(text[i + 1 - n : i + 1]) in inner), default=0)
        assert matched == longest


@pytest.mark.parametrize("piece", [7, 64])
def test_a_long_text_in_pieces_is_the_same(monkeypatch, piece):
    monkeypatch.setattr(dc, "PIECE", piece)
    items, texts = made(random.Random(piece))
    scanner = dc._Items([(n, t or "") for n, t in items], 4).scanner()
    whole = "x" * 50 + " " + " ; ".join(t or "" for t in texts) + " " + "é" * 40
    raw = np.frombuffer(whole.encode(), dtype=np.uint8)
    count, spans, names = scanner.scan_long(raw)
    ((w, hit, expected),) = brute([whole], items, 4)
    assert (count, spans_of(spans), names) == (len(w), hit, expected)
    assert all(words(whole[s:e]) == w[a:b] for a, b, s, e in spans)


@pytest.mark.parametrize("block", [20, 100_000])
def test_benchmarks_in_blocks_find_the_same(spark, docs, block):
    items, texts = made(random.Random(6), 30)
    texts += [texts[3]]
    table = spark.createDataFrame(items, "item_id string, text string")
    found = dc.find(docs(texts), table, window=5, block_words=block).collect()
    assert len(list(dc.item_blocks(table, window=5, block_words=block))) == (1 if block > 99 else 5)
    expected = brute(texts, items, 5)
    for r in found:
        w, hit, names = expected[r[dc.ID]]
        assert (r["n_words"], r["items"]) == (len(w), sorted(names))
        assert spans_of(r["spans"]) == hit
    rows = [(r["n_words"], r["n"]) for r in dc.find(docs(texts), table, window=5, block_words=block)
            .select("n_words", dc.hit_words().alias("n")).collect()]
    assert sorted(rows) == sorted((len(w), len(hit)) for w, hit, _ in expected)


def test_odd_rows_odd_items_and_none(spark, odd, none, docs):
    shape = "item_id long, text string, source string"
    table = spark.createDataFrame(
        [(None, "The SAME text stands here", "a"), (1, None, "b"), (2, "...", "c"), (3, "日本語", None)],
        shape,
    )
    rows = dc.find(odd, table).collect()
    assert len(rows) == odd.count()
    hits = {(r[dc.ID], tuple(r["items"])) for r in rows if r["items"]}
    assert hits == {(6, ("null",)), (7, ("null",)), (8, ("3",))}
    assert dc.find(odd, spark.createDataFrame([], shape)).filter("size(spans) > 0").isEmpty()
    assert dc.find(none, table).isEmpty()
    clean = dc.decontaminated(odd, table, coverage=0.6)
    assert clean.columns == odd.columns
    left = {r["doc_id"]: r["text"] for r in clean.collect()}
    # five of seven words are an item's: beyond the limit; the others stay as they are
    assert not {6, 7} & set(left) and clean.count() == odd.count() - 3
    shown = {r["doc_id"]: r["text"] for r in dc.decontaminated(odd, table, coverage=0.8).collect()}
    assert shown[6] == " twice over" and shown[8].startswith(" ▁")


def test_passages_are_cut_out_and_dropped_by_coverage(spark, docs):
    item = " ".join(f"q{i}" for i in range(15))
    own = " ".join(f"w{i}" for i in range(20))
    table = spark.createDataFrame([(1, item)], "item_id long, text string")
    texts = [own, f"{own}\n{item.upper()}! {own}", f"{item} x", " ".join(item.split()[:9])]
    found = {r["doc_id"]: r["text"] for r in dc.decontaminated(docs(texts), table).collect()}
    assert found == {0: own, 1: f"{own}\n! {own}", 3: texts[3]}

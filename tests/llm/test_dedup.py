"""Line dedup, exact dedup and the similarity join against brute force."""

from __future__ import annotations

import hashlib
import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from purchaseflow.llm import components, exact_dedup, line_dedup, ngram_join


def brute_gone(texts: dict[int, str], least: int) -> dict[int, set[int]]:
    """Lines in a run of ``least`` words or more that began at an earlier place.

    All such runs take their lines with words; those in between go with the runs that
    would be too short without their first or their last line.
    """
    lines = {
        d: [
            (n, x.strip(" \t\r"))
            for n, x in enumerate(t.split("\n"))
            if x.strip(" \t\r")
        ]
        for d, t in sorted(texts.items())
    }
    first, gone = {}, defaultdict(set)
    runs = []
    for d, own in lines.items():
        for i in range(len(own)):
            words = 0
            for j in range(i, len(own)):
                words += 1 + own[j][1].count(" ")
                if words >= least:
                    run = own[i : j + 1]
                    edges = [1 + x.count(" ") for _, x in (run[0], run[-1])]
                    tight = words - max(edges) < least
                    runs.append((tuple(x for _, x in run), d, [n for n, _ in run], tight))
    for key, d, places, _ in runs:
        first[key] = min(first.get(key, (d, places[0])), (d, places[0]))
    for key, d, places, tight in runs:
        if (d, places[0]) > first[key]:
            gone[d].update(range(places[0], places[-1] + 1) if tight else places)
    return gone


@pytest.mark.parametrize("least", [1, 4, 9])
def test_line_dedup_is_what_brute_force_finds(docs, least):
    rng = random.Random(least)
    pool = [" ".join(rng.choices("abcdef", k=rng.choice([1, 2, 3, 7]))) for _ in range(9)]
    pool += ["", "  "]
    texts = {i: "\n".join(rng.choices(pool, k=rng.randint(0, 14))) for i in range(60)}
    found = line_dedup.dedup_lines(docs(list(texts.items())), min_words=least).collect()
    expected = brute_gone(texts, least)
    assert len(found) == 60
    for row in found:
        gone = expected[row["__id"]]
        assert set(row["gone"] or []) == gone
        kept = [x for n, x in enumerate(texts[row["__id"]].split("\n")) if n not in gone]
        assert row["left"] == "\n".join(kept)


def test_line_dedup_catches_a_shared_passage_and_spares_the_rest(docs):
    passage = "\n".join(" ".join(f"p{i}{j}" for j in range(11)) for i in range(5))
    own = [" ".join(f"own{d}x{j}" for j in range(30)) for d in range(40)]
    texts = [f"{o}\n{passage}\n{o[::-1]}" for o in own]
    left = {r["__id"]: r["left"] for r in line_dedup.dedup_lines(docs(texts)).collect()}
    assert left[0] == texts[0]
    assert all(left[d] == f"{own[d]}\n{own[d][::-1]}" for d in range(1, 40))


def test_line_dedup_of_odd_rows_and_none(odd, none):
    found = line_dedup.dedup_lines(odd).collect()
    assert len(found) == odd.count()
    assert all(not r["gone"] for r in found)
    assert line_dedup.dedup_lines(none).count() == 0


def test_line_dedup_stage_keeps_columns_and_drops_what_is_empty(spark, docs):
    text = " ".join(f"w{i}" for i in range(40))
    out = line_dedup.stage(spark, docs([text, text, f"{text}\nown line"]), "")
    assert out.columns == docs([]).columns
    rows = {r["doc_id"]: r for r in out.collect()}
    assert set(rows) == {0, 2}
    assert (rows[2]["text"], rows[2]["n_chars"]) == ("own line", 8)


def test_line_dedup_stage_finds_passages_inside_lines(spark, docs):
    rng = random.Random(8)

    def own(n):
        return " ".join(f"o{rng.randrange(10**9)}" for _ in range(n))

    passage = [" ".join(f"p{i}x{j}" for j in range(50)) for i in range(40)]
    pairs = [(f"{own(30)} {p} {own(9)}\n  {own(20)}", f"\t{own(17)}  {p} {own(40)}\r\n\n{own(3)}") for p in passage]
    texts = [a for a, _ in pairs] + [b for _, b in pairs]
    left = {r["doc_id"]: r["text"] for r in line_dedup.stage(spark, docs(texts), "").collect()}
    assert [left[i] for i in range(40)] == texts[:40]
    for i, p in enumerate(passage):
        before, after = texts[40 + i].split(p)
        got = left[40 + i]
        assert got.startswith(before) and got.endswith(after)
        rest = got[len(before) : len(got) - len(after)]
        assert len(rest.split()) <= 2 * line_dedup.REACH - 1 and set(rest.split()) <= set(p.split())


def test_line_dedup_stage_counts_words_of_any_script_and_spacing(spark, docs):
    rng = random.Random(9)
    tabbed = "\t".join(f"t{i}" for i in range(60))
    wide = "\u3000".join(f"w{i}" for i in range(60))
    chinese = "".join(chr(rng.randrange(0x4E00, 0x9000)) for _ in range(60))
    thai = "".join(chr(rng.randrange(0x0E01, 0x0E2E)) for _ in range(60))
    texts = [f"{own}{i}\n{p}" for own in "ab" for i, p in enumerate((tabbed, wide, chinese, thai))]
    texts += [f"{own}\n" + (" " * 30).join("few words in all".split()) for own in "ab"]
    left = {r["doc_id"]: r["text"] for r in line_dedup.stage(spark, docs(texts), "").collect()}
    assert [left[i] for i in range(4)] == texts[:4]
    assert [left[i] for i in range(4, 8)] == ["b0", "b1", "b2", "b3"]
    assert [left[i] for i in (8, 9)] == texts[8:]


def test_pieces_make_up_the_text_and_match_their_hashes(spark, odd):
    rows = odd.select(
        "text",
        line_dedup.without_pieces(F.coalesce("text", F.lit("")), F.array().cast("array<int>")).alias("same"),
        F.size(line_dedup._pieces(F.coalesce("text", F.lit("")))).alias("n"),
        F.size(line_dedup._parts(F.coalesce("text", F.lit("")))).alias("shown"),
    ).collect()
    assert all(r["same"] == (r["text"] or "") and r["n"] == r["shown"] for r in rows)


@pytest.mark.parametrize("bits", [64, 3, 1])
def test_exact_dedup_is_what_grouping_by_text_finds(docs, bits):
    rng = random.Random(bits)
    long = ["".join(rng.choices("ab. \n", k=900)) for _ in range(5)]
    texts = [rng.choice([*long, "", None, "a", long[0] + "a", "a" + long[0]]) for _ in range(80)]
    groups = defaultdict(list)
    for i, t in enumerate(texts):
        groups[t or ""].append(i)
    rows = exact_dedup.find_copies(docs(texts), hash_bits=bits).collect()
    assert len(rows) == 80
    for r in rows:
        group = groups[texts[r["doc_id"]] or ""]
        assert (r["keep_id"], r["group_size"]) == (max(group), len(group))
        assert r["kept"] == (r["doc_id"] == max(group))
        assert r["text_sha256"] == hashlib.sha256((texts[r["doc_id"]] or "").encode()).hexdigest()


def test_exact_dedup_of_odd_rows(odd, none):
    rows = exact_dedup.find_copies(odd).collect()
    assert len(rows) == odd.count()
    empty = [r for r in rows if r["text_sha256"] == hashlib.sha256(b"").hexdigest()]
    assert Counter((r["doc_id"], r["keep_id"], r["kept"]) for r in empty) == Counter(
        [(None, 2, False), (1, 2, False), (2, 2, True)]
    )
    same = [r for r in rows if r["doc_id"] in (6, 7)]
    assert {(r["keep_id"], r["group_size"]) for r in same} == {(7, 3)}
    assert sum(r["kept"] for r in rows) == len({r["text_sha256"] for r in rows})
    assert exact_dedup.find_copies(none).count() == 0


def test_chunks_join_to_the_text(spark, docs):
    from pyspark.sql import functions as F

    rng = random.Random(5)
    texts = ["".join(rng.choices("abc. \n😀", k=n)) for n in (0, 1, 255, 256, 5000, 20_000)]
    texts.append("z" * 9000)
    for r in docs(texts).select("text", exact_dedup.chunks(F.col("text")).alias("c")).collect():
        assert "".join(r["c"]) == r["text"]
        assert all(len(c) <= exact_dedup.MAX_CHUNK + 2 for c in r["c"])


def brute_similar(texts: dict[int, str]):
    runs = {}
    for d, t in texts.items():
        w = (t or "").lower().split()
        runs[d] = frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else None
    parent = {d: d for d in texts}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    near, links = Counter(), defaultdict(set)
    ids = sorted(texts)
    for i, x in enumerate(ids):
        for y in ids[i + 1 :]:
            a, b = runs[x], runs[y]
            if a and b and 5 * len(a & b) >= 4 * len(a | b):
                near.update([x, y])
                if a != b:
                    links[x].add(b)
                    links[y].add(a)
                rx, ry = root(x), root(y)
                parent[max(rx, ry)] = min(rx, ry)
    return {d: (root(d), len(links[d]), near[d]) for d in texts}


def near_copies(rng, groups=6, size=12, words=120):
    texts = []
    for _ in range(groups):
        base = [f"w{rng.randrange(5000)}" for _ in range(words)]
        for _ in range(size):
            copy = list(base)
            for _ in range(rng.randrange(4)):
                copy[rng.randrange(words)] = f"v{rng.randrange(5000)}"
            texts.append(" ".join(copy))
    texts += [" ".join(f"u{rng.randrange(9000)}" for _ in range(words)) for _ in range(30)]
    return texts


@pytest.mark.parametrize(("block", "verify"), [(4096, 256), (5, 4)])
def test_similarity_join_is_what_brute_force_finds(docs, monkeypatch, block, verify):
    monkeypatch.setattr(ngram_join, "BLOCK", block)
    monkeypatch.setattr(ngram_join, "VERIFY", verify)
    texts = near_copies(random.Random(7))
    texts += ["", "one two", "one two", "ONE  two", "one two three"]
    texts = dict(enumerate(texts))
    found = ngram_join.similar(docs(list(texts.items()))).collect()
    expected = brute_similar(texts)
    assert len(found) == len(texts)
    for r in found:
        assert (r["class_id"], r["n_links"], r["n_similar"]) == expected[r["doc_id"]]
        assert r["representative"] == (r["class_id"] == r["doc_id"])


def test_pruning_keeps_what_the_posterior_allows():
    fewest = ngram_join.fewest_matches(0.8, 1e-4)
    assert len(fewest) == ngram_join.SIGNATURE // ngram_join.STEP
    assert all(a < b for a, b in zip(fewest, fewest[1:], strict=False))
    assert 35 <= fewest[-1] <= 42


def test_similarity_join_of_odd_rows(odd, none):
    rows = ngram_join.similar(odd).collect()
    assert len(rows) == odd.count()
    by_id = defaultdict(list)
    for r in rows:
        by_id[r["doc_id"]].append(r)
    assert {(r["class_id"], r["n_similar"]) for r in by_id[6] + by_id[7]} == {(6, 2)}
    assert all(r["n_similar"] == 0 and r["class_id"] == r["doc_id"] for r in by_id[1] + by_id[2])
    assert ngram_join.similar(none).count() == 0


def test_near_duplicate_stage_keeps_one_of_each_group(spark, docs, odd):
    texts = near_copies(random.Random(3), groups=2, size=5)
    out = ngram_join.stage(spark, docs(texts), "")
    assert out.columns == docs([]).columns
    classes = {c for c, _, _ in brute_similar(dict(enumerate(texts))).values()}
    assert sorted(r["doc_id"] for r in out.collect()) == sorted(classes)
    kept = [r["doc_id"] for r in ngram_join.stage(spark, odd, "").collect()]
    assert sorted(kept, key=str) == sorted([None, None, 1, 2, 3, 4, 5, 6, 8, 9], key=str)


def test_components(spark):
    rng = random.Random(1)
    edges = [(i, i + 1) for i in range(60)] + [(100, 101), (101, 100), (102, 102)]
    edges += [(200 + rng.randrange(40), 200 + rng.randrange(40)) for _ in range(30)]
    parent = {x: x for e in edges for x in e}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    alone = {x for x in parent if all(x not in e or e[0] == e[1] for e in edges)}
    found = components.components(spark.createDataFrame(edges, "u long, v long")).collect()
    assert {r["node"]: r["root"] for r in found} == {x: root(x) for x in parent if x not in alone}

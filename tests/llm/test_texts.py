"""Fingerprints, segmentation, licenses and packing."""

from __future__ import annotations

import hashlib
import itertools
import math
import random
import textwrap
import time
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
from purchaseflow.llm import fingerprints, hashing, licenses, packing, pieces

SP_MODEL = public_tokenizers.path("piece_bpe_32k.model")
WORDS = public_tokenizers.path("word_bpe_49k.json")


# --- fingerprints -------------------------------------------------------------------


def edited(texts: dict[int, str]) -> dict[int, str]:
    ids = sorted(texts, reverse=True)
    out = {}
    for here, after in zip(ids, ids[1:] + ids[:1], strict=True):
        text, half = texts[here] or "", len(texts[here] or "") // 2
        out[here] = text[: len(text) - half] + (texts[after] or "")[:half]
    return out


@pytest.mark.parametrize("tasks", [1, 7])
def test_edited_text_is_half_of_the_next_document(spark, docs, tasks):
    rng = random.Random(tasks)
    texts = {
        i * 3: "".join(rng.choices("abé😀. \n", k=rng.randrange(60))) for i in range(50)
    }
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", tasks)
    try:
        rows = fingerprints.with_edited(docs(list(texts.items()))).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    expected = edited(texts)
    assert len(rows) == 50
    for r in rows:
        assert r["n_chars"] == len(texts[r["doc_id"]])
        assert r["edited_sha256"] == hashlib.sha256(expected[r["doc_id"]].encode()).hexdigest()
        assert 0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1
        same = texts[r["doc_id"]] == expected[r["doc_id"]]
        assert not same or (r["fingerprint"] == r["edited_fingerprint"] and r["near_edited"] == 1)


def _prints(spark, texts):
    frame = spark.createDataFrame([(t,) for t in texts], "t string")
    return [r[0] for r in frame.select(fingerprints.as_text(fingerprints.fingerprint("t"))).collect()]


def test_fingerprints_ignore_order_and_tell_multiplicity(spark):
    a, b, c, d = _prints(spark, ["one.\ntwo.\nthree.", "three.\none.\n\ntwo.", "one.\ntwo.", "one.\none.\ntwo."])
    assert a == b
    assert len({a, c, d}) == 3
    assert len(a) == 8 * fingerprints.WIDE + 4 * fingerprints.SIGNS


def test_wide_lanes_are_sums_of_digest_slices(spark):
    lines = ["one line.", "and another", "日本語", "one line."]
    (shown,) = _prints(spark, ["\n".join(lines)])
    digests = [hashlib.sha512(x.encode()).hexdigest() for x in lines]
    for i in range(0, 8 * fingerprints.WIDE, 8):
        assert int(shown[i : i + 8], 16) == sum(int(d[i : i + 8], 16) for d in digests) % 2**32


def test_paragraphs_can_be_added_and_taken_away(spark):
    frame = spark.createDataFrame([("one. two.\nthree.", "four.\nfive.")], "a string, b string")
    whole = fingerprints.fingerprint(F.concat_ws("\n", "a", "b"))
    a, b = fingerprints.fingerprint("a"), fingerprints.fingerprint("b")
    shown = frame.select(
        *[
            fingerprints.as_text(x).alias(str(i))
            for i, x in enumerate(
                [whole, fingerprints.combine(a, b), a, fingerprints.combine(whole, b, -1)]
            )
        ]
    ).first()
    assert shown[0] == shown[1] and shown[2] == shown[3]


def test_likeness_follows_what_texts_share(spark):
    rng = random.Random(0)
    sentences = [f"s{rng.randrange(10**9)} here." for _ in range(80)]
    frame = spark.createDataFrame(
        [(" ".join(sentences[:40]), " ".join(sentences[n : n + 40])) for n in (0, 4, 20, 40)],
        "a string, b string",
    )
    a, b = fingerprints.fingerprint("a"), fingerprints.fingerprint("b")
    same, most, half, none_ = [r[0] for r in frame.select(fingerprints.likeness(a, b)).collect()]
    assert same == 1 and most > half > none_ and abs(most - 0.9) < 0.15 and none_ < 0.4


def test_short_and_unpunctuated_texts_are_like_their_edit(spark, docs):
    rng = random.Random(4)
    words = [" ".join(f"w{rng.randrange(10**9)}" for _ in range(60)) for _ in range(30)]
    chinese = ["".join(chr(rng.randrange(0x4E00, 0x9000)) for _ in range(200)) for _ in range(30)]
    for texts in (words, chinese):
        rows = fingerprints.with_edited(docs(texts)).collect()
        assert all(abs(r["near_edited"] - 0.5) < 0.25 and r["near_next"] < 0.25 for r in rows)
    one = docs([words[0]]).select(
        fingerprints.likeness(
            fingerprints.fingerprint("text"), fingerprints.fingerprint(F.concat(F.lit("x"), "text"))
        )
    )
    assert one.first()[0] > 0.9


def test_fingerprints_of_odd_rows(odd, none, docs):
    rows = fingerprints.with_edited(odd).collect()
    assert len(rows) == odd.count()
    empty = "0" * (8 * fingerprints.WIDE + 4 * fingerprints.SIGNS)
    assert all(r["fingerprint"] == empty for r in rows if r["doc_id"] in (1, 2, 3))
    assert fingerprints.with_edited(none).count() == 0
    (alone,) = fingerprints.with_edited(docs(["only. one."])).collect()
    assert alone["edited_sha256"] == hashlib.sha256(b"only.only.").hexdigest()


# --- segmentation -------------------------------------------------------------------


@pytest.fixture(scope="module")
def vocabulary():
    return pieces.Vocabulary(SP_MODEL)


def spellings(text, vocabulary):
    """Every segmentation of a short text with its probability."""
    code = [" ", *text]
    known = {b.decode("utf-8", "replace"): i for i, b in enumerate(vocabulary.bytes) if np.isfinite(vocabulary.logs[i])}
    found = {}

    def walk(at, ids, log):
        if at == len(code):
            found[tuple(ids)] = log
            return
        for size in range(1, vocabulary.longest + 1):
            part = "".join(code[at : at + size])
            inside = any(a != " " and b == " " for a, b in itertools.pairwise(part))
            if at + size <= len(code) and part in known and not inside:
                walk(at + size, [*ids, known[part]], log + vocabulary.logs[known[part]])
        if code[at] not in known:
            raw = code[at].encode()
            ids_of = [int(vocabulary.byte_ids[b]) for b in raw]
            walk(at + 1, ids + ids_of, log + len(raw) * vocabulary.byte_log)

    walk(0, [], 0.0)
    total = sum(map(math.exp, found.values()))
    return {k: math.exp(v) / total for k, v in found.items()}


def test_samples_follow_the_lattice_without_replacement(vocabulary):
    text, n = "the cat\nß", 3000
    chance = spellings(text, vocabulary)
    first, among, estimate = Counter(), Counter(), 0.0
    for search in pieces.sample([text] * n, list(range(n)), vocabulary, 2):
        over = search.best()[0]
        ids = [tuple(search.ids(i, vocabulary).tolist()) for i in range(2)]
        assert ids[0] != ids[1]
        assert search.paths[0][5] > search.paths[1][5] > over
        first[ids[0]] += 1
        among.update(ids)
        for i in range(2):
            log = search.paths[i][4]
            assert math.isclose(log, math.log(chance[ids[i]]), abs_tol=1e-6)
            estimate += chance[ids[i]] / -math.expm1(-math.exp(log - over)) / n
    for ids, p in chance.items():
        second = sum(q * p / (1 - q) for other, q in chance.items() if other != ids)
        assert abs(first[ids] / n - p) < 0.035
        assert abs(among[ids] / n - p - second) < 0.035
    assert abs(estimate - 1) < 0.06  # the inclusion scores weigh samples without bias


def test_all_segmentations_come_out_once(vocabulary):
    chance = spellings("abc", vocabulary)
    (search,) = pieces.sample(["abc"], [5], vocabulary, len(chance) + 3)
    found = [tuple(search.ids(i, vocabulary).tolist()) for i in range(len(search.paths))]
    assert sorted(found) == sorted(chance)


def test_siblings_of_a_path_take_no_number_a_step(vocabulary, monkeypatch):
    drawn, real = [], np.random.Generator

    class Counted:
        def __init__(self, bits):
            self.own = real(bits)

        def random(self, size=None):
            drawn.append(size or 1)
            return self.own.random(size)

    monkeypatch.setattr(pieces.np.random, "Generator", Counted)
    text = "some words to be split, again and again. " * 50
    (search,) = pieces.sample([text], [3], vocabulary, 2)
    assert search.paths[0][2].size > 500
    # one for each character and round, and a few a round
    assert sum(drawn) <= 2 * (len(text) + 1) + 10


@pytest.mark.parametrize("text", ["abc", "the cat", "some words to be split, again. " * 60])
def test_masses_of_siblings_are_all_but_the_path(vocabulary, text):
    (search,) = pieces.sample([text], [7], vocabulary, 1)
    (group,) = search.open
    for whole in (False, True):
        search._masses(group, whole)
        assert math.isclose(group.mass.sum(), -math.expm1(search.paths[0][4]), rel_tol=1e-9)
    assert group.mass.size == search.paths[0][2].size


def test_steps_left_out_at_first_are_opened_when_they_count(vocabulary, monkeypatch):
    monkeypatch.setattr(pieces, "_FAR", 0.1)
    chance = spellings("qz xj", vocabulary)
    (search,) = pieces.sample(["qz xj"], [5], vocabulary, len(chance) + 3)
    found = [tuple(search.ids(i, vocabulary).tolist()) for i in range(len(search.paths))]
    assert sorted(found) == sorted(chance)


def test_encoding_gives_texts_back(odd, none, vocabulary):
    rows = pieces.encode(odd.filter("doc_id is not null"), SP_MODEL).collect()
    texts = {r["doc_id"]: r["text"] or "" for r in odd.collect() if r["doc_id"] is not None}
    assert {r["doc_id"] for r in rows} == set(texts)
    for r in rows:
        assert r["round_trip"] and vocabulary.decode(r["ids"]) == texts[r["doc_id"]]
        assert 0 < r["inclusion"] <= 1 or r["inclusion"] == pytest.approx(0, abs=1e-9)
        packed = np.array(r["ids"], dtype="<u4").tobytes()
        assert (r["n_pieces"], r["ids_crc32"]) == (len(r["ids"]), zlib.crc32(packed))
    by_id = defaultdict(set)
    for r in rows:
        by_id[r["doc_id"]].add((r["sample"], tuple(r["ids"])))
    assert len(by_id[6]) == 2  # repeated rows give the same samples
    assert len(by_id[1]) == len(by_id[2]) == 1
    assert pieces.encode(none, SP_MODEL).count() == 0


def test_samples_do_not_depend_on_other_rows(docs):
    texts = [f"some text number {i} to be split" for i in range(20)]
    whole = {tuple(r) for r in pieces.encode(docs(texts), SP_MODEL, with_ids=False).collect()}
    part = {tuple(r) for r in pieces.encode(docs(texts).filter("doc_id = 7").repartition(3), SP_MODEL, with_ids=False).collect()}
    assert part == {r for r in whole if r[0] == 7} and len(part) == 2


def test_decode_column(docs):
    out = pieces.decode(pieces.encode(docs(["a text", None]), SP_MODEL), SP_MODEL)
    assert {r["decoded"] for r in out.collect()} == {"a text", ""}


def test_query_hands_out_the_segmentations_themselves(spark, sf_dir, vocabulary):
    found = contract.queries()["op4_sentencepiece"](spark, sf_dir).collect()
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    assert {r["doc_id"] for r in found} == set(texts)
    for r in found:
        assert vocabulary.decode(r["ids"]) == texts[r["doc_id"]] and r["round_trip"]
        packed = np.array(r["ids"], dtype="<u4").tobytes()
        assert (r["n_pieces"], r["ids_crc32"]) == (len(r["ids"]), zlib.crc32(packed))


@pytest.mark.parametrize("slots", [0, 100, 10**6])
def test_lattices_that_are_kept_change_no_sample(vocabulary, monkeypatch, slots):
    monkeypatch.setattr(pieces, "KEPT_SLOTS", slots)
    rng, kept = random.Random(slots), pieces.Kept()
    for n in range(12):
        texts = [" ".join(rng.choices("the then cat ß naïve 日本 a\nb x".split(" "), k=9)) + f" {n}" * n]
        (own,), (alone,) = (pieces.sample(texts, [n], vocabulary, 3, k) for k in (kept, None))
        for i in range(3):
            assert own.ids(i, vocabulary).tolist() == alone.ids(i, vocabulary).tolist()
            assert own.paths[i][4:] == alone.paths[i][4:]


def test_lattices_are_built_and_kept_within_bounds(vocabulary, monkeypatch):
    texts = [" ".join(f"w{n}x{i} again" for i in range(12)) for n in range(30)]
    alone = [pieces.sample([t], [n], vocabulary, 2)[0] for n, t in enumerate(texts)]
    monkeypatch.setattr(pieces, "KEPT_SLOTS", 300)
    monkeypatch.setattr(pieces, "BUILT_SLOTS", 20)
    kept = pieces.Kept()
    for n, text in enumerate(texts):
        (own,) = pieces.sample([text], [n], vocabulary, 2, kept)
        assert kept.grid.left.size <= 300
        assert [own.ids(i, vocabulary).tolist() for i in range(2)] == [
            alone[n].ids(i, vocabulary).tolist() for i in range(2)
        ]


def test_every_prefix_of_a_piece_is_found_and_no_other(vocabulary):
    near = np.concatenate([vocabulary.hashes, vocabulary.hashes + np.uint64(1), vocabulary.hashes - np.uint64(1)])
    known, piece = vocabulary.look_up(near)
    assert known.tolist() == np.isin(near, vocabulary.hashes).tolist()
    assert piece[: vocabulary.hashes.size].tolist() == vocabulary.pieces.tolist()


# --- hashes -------------------------------------------------------------------------


@pytest.mark.parametrize("piece", [1, 3, 16])
def test_hashes_do_not_show_where_a_text_is_cut(monkeypatch, piece):
    rng = random.Random(piece)
    texts = ["".join(rng.choices("ab cé. \n日Z9", k=rng.randrange(60))) for _ in range(150)]
    texts += ["x" * 50 + " y", " ", "", "....", "é" * 40]

    def hashed(text):
        grams = hashing.letter_grams(text, 12).tolist()
        return (
            hashing.words(text).tolist(),
            hashing.words(text, "isalnum", inside=True).tolist(),
            hashing.shingles(text).tolist(),
            grams,
        )

    whole = [hashed(t) for t in texts]
    monkeypatch.setattr(hashing, "PIECE", piece)
    assert [hashed(t) for t in texts] == whole
    for text, (words, _, _, _) in zip(texts, whole, strict=True):
        assert len(words) == len(text.split())


# --- licenses -----------------------------------------------------------------------


def test_known_sentences_and_rules():
    scan = licenses.Scanner()

    def found(text):
        return [m[2] for m in scan.matches(scan.identifiers(text))]

    apache = "Licensed under the Apache License, Version 2.0."
    assert found(f"Some words.\n{apache}\nmore") == ["Apache-2.0"]
    assert found("released under the\n  MIT   license!") == ["MIT"]
    assert found(f"{apache} Released under the MIT License.") == ["Apache-2.0", "MIT"]
    assert found("We talked about the Apache License, Version 2.0 at length.") == []
    assert found("Not Licensed under CC BY-NC 4.0, I say.") == []
    bsd = [licenses.SENTENCES[n] for n in ("bsd-redistribution", "bsd-source", "bsd-binary", "bsd-endorse")]
    assert found(".\n".join(bsd) + ".") == ["BSD-3-Clause"]
    assert found(".\n".join(bsd[:3]) + ".") == ["BSD-2-Clause"]
    assert found(".\n".join(bsd[2::-1]) + ".") == []  # the order counts
    far = f"{bsd[0]}.\n" + "filler.\n" * 9 + f"{bsd[1]}.\n{bsd[2]}."
    assert found(far) == []  # and so does the distance


def test_known_sentences_may_be_wrapped_and_underlined_at_will():
    scan = licenses.Scanner()
    for name in ("mit-grant", "gpl-free", "bsd-binary"):
        for width in (1, 20, 30, 38, 80):
            text = "\n".join(textwrap.wrap(licenses.SENTENCES[name], width, break_long_words=False))
            assert scan.identifiers(f"x\n{text}.\ny") == [(1, name)]
    for text in ("_Released under the MIT License_", "x. __*_Released under the MIT License"):
        assert [name for _, name in scan.identifiers(text)] == ["mit-released"]


def test_sequences_are_what_brute_force_finds():
    scan, rng = licenses.Scanner(), random.Random(6)
    names = list(licenses.SENTENCES)
    by_text = defaultdict(list)
    for n in names:
        by_text[licenses.normalised(licenses.SENTENCES[n])].append(n)
    for _ in range(300):
        chosen = [rng.choice([*names, None, None]) for _ in range(rng.randrange(12))]
        text = "\n".join("lorem ipsum dolor." if n is None else f"{licenses.SENTENCES[n]}." for n in chosen)
        places, expected = 0, []
        for n in chosen:
            if n is not None:
                expected.append((places, by_text[licenses.normalised(licenses.SENTENCES[n])][-1]))
            raw = "lorem ipsum dolor." if n is None else f"{licenses.SENTENCES[n]}."
            places += len(licenses.sentences(raw))
        assert scan.identifiers(text) == expected


def test_licenses_of_odd_rows(odd, none, docs):
    rows = licenses.scan(odd).collect()
    assert len(rows) == odd.count() and all(r["licenses"] == "" for r in rows)
    assert licenses.scan(none).count() == 0
    (row,) = licenses.scan(docs(["All rights reserved.\nx\nAll rights reserved."])).collect()
    assert row["matches"].count("all-rights-reserved") == 2
    assert row["licenses"] == "LicenseRef-all-rights-reserved"


def brute_matches(found, rules):
    """Rules by length, then listed order; earliest start; the nearest free next sentence."""
    left, out = dict(found), []
    for _, (license_, wanted) in sorted(enumerate(rules), key=lambda r: (-len(r[1][1]), r[0])):
        for place in sorted(left):
            if left.get(place) != wanted[0]:
                continue
            chain = [place]
            for name in wanted[1:]:
                near = [p for p in sorted(left) if chain[-1] < p <= chain[-1] + licenses.GAP + 1]
                after = [p for p in near if left[p] == name]
                if not after:
                    break
                chain.append(after[0])
            else:
                for p in chain:
                    del left[p]
                out.append((chain[0], chain[-1], license_))
    return sorted(out)


def test_license_rules_are_what_brute_force_finds():
    rng, scan = random.Random(3), licenses.Scanner()
    parts = [name for _, wanted in licenses.RULES for name in wanted]
    for _ in range(400):
        place, found = 0, []
        for _ in range(rng.randrange(14)):
            place += rng.choice([1, 1, 1, 2, 4, 5])
            _, wanted = rng.choice(licenses.RULES)
            for name in wanted if rng.random() < 0.6 else [rng.choice(parts)]:
                found.append((place, name))
                place += rng.choice([1, 1, 2, 5])
        assert scan.matches(found) == brute_matches(found, licenses.RULES)


def test_rules_name_known_sentences_and_every_sentence_is_found():
    scan = licenses.Scanner()
    assert {n for _, wanted in licenses.RULES for n in wanted} <= set(licenses.SENTENCES)
    assert len({license_ for license_, _ in licenses.RULES}) >= 40
    for text in licenses.SENTENCES.values():
        assert scan.identifiers(f"x y.\n__{text}__.\nz") != []
    text = licenses.SENTENCES
    gpl = f"{text['gpl2-free']}.\n{text['gpl-useful']}.\nsee there.\n{text['classpath-exception']}."
    assert [m[2] for m in scan.matches(scan.identifiers(gpl))] == [
        "GPL-2.0-or-later WITH Classpath-exception-2.0"
    ]


@pytest.mark.parametrize("sign", [".", " ", "_", "_ ", "the ", "this.\t", "\u3000"])
def test_long_runs_of_signs_are_scanned_in_linear_time(sign):
    scan = licenses.Scanner()

    def seconds(n):
        start = time.perf_counter()
        assert scan.identifiers(f"The{sign * n}") == []
        return time.perf_counter() - start

    few, many = max(seconds(100_000), 0.02), seconds(1_000_000)
    assert many < 40 * few


# --- packing ------------------------------------------------------------------------


def test_word_ids_are_the_tokenizers_own():
    from tokenizers import Tokenizer

    own, whole = packing.WordTokenizer(WORDS), Tokenizer.from_file(WORDS)
    rng = random.Random(3)
    texts = ["don't it'll ''s 12a³ É́ İ ß ŉ", "a\x85b\xa0c \x1c d", "日本 ١٢ <|endoftext|>x", ""]
    for letters in ("ab' s!t2", "éÀßſ ñ'm", "a\n\t\r 　漢z", "<|endotx>"):
        texts += ["".join(rng.choices(letters, k=rng.randrange(60))) for _ in range(150)]
    for text in texts:
        ids = whole.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(own.encode(text), "<u4").tolist() == ids


def test_every_latin_character_has_the_tokenizers_ids():
    from tokenizers import Tokenizer

    own, whole = packing.WordTokenizer(WORDS), Tokenizer.from_file(WORDS)
    for sign in map(chr, range(0x21, 0x250)):
        for text in (sign, f"a{sign}b", f"Is {sign}zm {sign}{sign}x", f"1{sign}2'{sign}s"):
            ids = whole.encode(text, add_special_tokens=False).ids
            assert np.frombuffer(own.encode(text), "<u4").tolist() == ids, hex(ord(sign))


def test_long_texts_are_cut_between_words(monkeypatch):
    monkeypatch.setattr(packing, "PIECE", 50)
    own = packing.WordTokenizer(WORDS)
    text = "some words, and\nmore of them " * 30 + "x" * 300
    cut = own.encode(text)
    monkeypatch.undo()
    assert cut == own.encode(text)


@pytest.mark.parametrize("windows", [1, 2, 5, 9])
def test_differencing_gives_near_equal_windows(windows):
    rng = random.Random(windows)
    sizes = [rng.randint(1, 256) for _ in range(12 * windows)]
    found = packing.partition(sizes, windows)
    assert sorted(i for w in found for i in w) == list(range(len(sizes)))
    sums = [sum(sizes[i] for i in w) for w in found]
    assert max(sums) - min(sums) < 40


def test_windows_rise_until_all_fit():
    assert sorted(packing.fit_windows([6, 6, 6], 10)) == [[0], [1], [2]]
    assert packing.fit_windows([], 10) == []
    sizes = [3, 3, 4, 5, 5]
    found = packing.fit_windows(sizes, 10)
    assert sorted(i for w in found for i in w) == [0, 1, 2, 3, 4]
    assert all(sum(sizes[i] for i in w) <= 10 for w in found)


def check_packed(rows, texts, capacity=packing.CAPACITY):
    """Every id in one piece, pieces in one place, sequences gapless and within capacity."""
    own = packing.WordTokenizer(WORDS)
    ids = {d: own.encode(t or "") + b"\1\0\0\0" for d, t in texts.items()}
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r["doc_id"]].append(r)
        by_sequence[r["sequence_id"]].append(r)
    assert set(by_doc) == set(ids)
    for d, parts in by_doc.items():
        at = 0
        for r in sorted(parts, key=lambda r: r["start"]):
            assert (r["start"], r["doc_tokens"]) == (at, len(ids[d]) // 4)
            at += r["length"]
            assert r["ids_crc32"] == zlib.crc32(ids[d][r["start"] * 4 : at * 4])
        assert at == len(ids[d]) // 4
    for parts in by_sequence.values():
        at = 0
        for r in sorted(parts, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= capacity
    return sum(len(v) // 4 for v in ids.values()) / capacity / len(by_sequence)


def test_packing_places_every_id_once(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    fill = check_packed(packing.pack(docs, WORDS).collect(), texts)
    assert fill > 0.97


@pytest.mark.parametrize("tasks", [1, 40, 200])
def test_packing_is_as_full_in_many_tasks(spark, tasks):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").limit(700)
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    fill = check_packed(packing.pack(docs.repartition(tasks), WORDS).collect(), texts)
    print("fill", tasks, fill)
    assert fill > 0.97


def test_packing_of_odd_rows(odd, none):
    rows = packing.pack(odd.filter("doc_id is not null").dropDuplicates(["doc_id"]), WORDS).collect()
    check_packed(rows, {r["doc_id"]: r["text"] for r in odd.collect() if r["doc_id"] is not None})
    assert packing.pack(odd, WORDS).filter("doc_id is null").count() >= 2
    assert packing.pack(odd, WORDS).filter("doc_id = 6 and start = 0").count() == 2
    assert packing.pack(none, WORDS).count() == 0

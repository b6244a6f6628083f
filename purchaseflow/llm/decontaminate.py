"""Benchmark passages in documents, by a generalised suffix automaton of the test items.

Words are the runs of digits, letters and characters beyond ASCII, A-Z in lower case. The
items' words are read into one suffix automaton over all items: a state stands for the
word sequences that end at the same places of the items, and from it follow, for each word
of a document that is streamed through, the longest sequence up to that word that stands
in some item, and the items in which it does. A sequence of ``window`` words of an item, or
a shorter item as a whole, is a window; whatever words of a document an occurrence of one
covers are hit. Spans of hit words can be cut out of the text, and documents dropped whose
share of hit words is above a limit.

Two words in a row that stand so in no item end every match, so between such places the
longest match is one word at most. Only the stretches without them, if they are as long as
the shortest window, go through the automaton; they are found by hashes of all words at
once (numpy over the text's bytes), and the automaton compares the words themselves.

An automaton takes BLOCK_WORDS words of items. Larger benchmarks are dealt to blocks, with
a pass over the documents for each; hits of later passes are joined to the first by row,
and only rows with a hit take part. So memory is bounded whatever the benchmark: it is
never collected or broadcast but in blocks of that size.

Defined results: null and empty texts have no words and are never contaminated; items
without words match nothing; a null item id is shown as "null"; rows with the same item id
are one item; rows equal in id and text are treated alike; a text of any length is read in
pieces of some PIECE bytes that end where no match goes on.
"""

from __future__ import annotations

import functools
import hashlib
import re
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from purchaseflow.llm.keys import HASH, ID, TEXT, text_hash

WINDOW = 10
BLOCK_WORDS = 500_000
PIECE = 1 << 21
_UPPER_TO_LOWER = np.arange(256, dtype=np.uint8)
_UPPER_TO_LOWER[0x41:0x5B] += 0x20
# the bytes of words in lower-cased UTF-8: every byte of a character beyond ASCII too
_IN_WORD = np.ones(256, dtype=bool)
_IN_WORD[0x00:0x30] = _IN_WORD[0x3A:0x61] = _IN_WORD[0x7B:0x80] = False
_WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_SPAN = "array<struct<first:bigint,end:bigint,start:bigint,stop:bigint>>"


def words(text: str | None) -> list[bytes]:
    """The words of a text, in UTF-8."""
    whole = (text or "").encode("utf-8", "surrogatepass")
    return _WORD.findall(bytes(_UPPER_TO_LOWER[np.frombuffer(whole, dtype=np.uint8)]))


class Automaton:
    """A suffix automaton of several word sequences, with the items of every window."""

    def __init__(self, items: Sequence[tuple[str, Sequence[bytes]]], window: int = WINDOW):
        self.window = window
        self.ids: dict[bytes, int] = {}
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        coded = []
        for name, listed in items:
            code = [self.ids.setdefault(w, len(self.ids)) for w in listed]
            if code:
                coded.append((name, code))
        self.pairs = {p for _, code in coded for p in zip(code, code[1:], strict=False)}
        self.shortest = min((min(window, len(code)) for _, code in coded), default=0)
        for _, code in coded:
            last = 0
            for word in code:
                last = self._extend(last, word)
        self._mark(coded)

    def _state(self, length: int, link: int, edges: dict[int, int]) -> int:
        self.length.append(length)
        self.link.append(link)
        self.next.append(edges)
        return len(self.length) - 1

    def _extend(self, last: int, word: int) -> int:
        """The state of the sequence of ``last`` and ``word``, made if there is none."""
        known = self.next[last].get(word)
        if known is not None:
            return self._exact(last, word, known)
        new = self._state(self.length[last] + 1, 0, {})
        at = last
        while at >= 0 and word not in self.next[at]:
            self.next[at][word] = new
            at = self.link[at]
        if at >= 0:
            self.link[new] = self._exact(at, word, self.next[at][word])
        return new

    def _exact(self, at: int, word: int, target: int) -> int:
        """``target``, or a copy of it that ends right after the longest sequence of ``at``."""
        if self.length[target] == self.length[at] + 1:
            return target
        copy = self._state(self.length[at] + 1, self.link[target], dict(self.next[target]))
        self.link[target] = copy
        while at >= 0 and self.next[at].get(word) == target:
            self.next[at][word] = copy
            at = self.link[at]
        return copy

    def _mark(self, coded) -> None:
        """Which states begin the windows (``gate``) and which are short items (``near``)."""
        states = len(self.length)
        self.gate, self.near = [0] * states, [0] * states
        self.items: dict[int, set[str]] = {}
        self.short: dict[int, tuple[int, set[str]]] = {}
        for name, code in coded:
            if len(code) < self.window:
                at = 0
                for word in code:
                    at = self.next[at][word]
                self.short.setdefault(at, {}).setdefault(len(code), set()).add(name)
        for at in sorted(range(1, states), key=self.length.__getitem__):
            up = self.link[at]
            if self.length[at] >= self.window:
                self.gate[at] = self.gate[up] or at
            self.near[at] = at if at in self.short else self.near[up]
        for name, code in coded:
            at = 0
            for n, word in enumerate(code, 1):
                at = self.next[at][word]
                if n >= self.window:
                    self.items.setdefault(self.gate[at], set()).add(name)

    def stream(self, listed: Sequence[bytes], found: set[str]) -> list[tuple[int, int]]:
        """Spans of hit words in a row of words; adds the items whose windows occur."""
        spans: list[list[int]] = []
        seen: set[int] = set()
        at = matched = 0
        for i, text in enumerate(listed):
            word = self.ids.get(text, -1)
            while at and word not in self.next[at]:
                at = self.link[at]
                matched = self.length[at]
            if word in self.next[at]:
                at = self.next[at][word]
                matched += 1
            hit = 0
            if matched >= self.window:
                hit = matched
                if self.gate[at] not in seen:
                    seen.add(self.gate[at])
                    found |= self.items[self.gate[at]]
            short = self.near[at]
            while short:
                for size, names in self.short[short].items():
                    if size <= matched:
                        hit = max(hit, size)
                        found |= names
                short = self.near[self.link[short]]
            if hit:
                first = i + 1 - hit
                while spans and spans[-1][1] >= first:
                    first = min(first, spans.pop()[0])
                spans.append([first, i + 1])
        return [(a, b) for a, b in spans]


class Scanner:
    """Finds the stretches that an automaton has to see in the bytes of many texts."""

    def __init__(self, automaton: Automaton):
        self.automaton = automaton
        vocabulary = list(automaton.ids)
        self.longest = max(map(len, vocabulary), default=0)
        joined = np.frombuffer(b"".join(vocabulary), dtype=np.uint8)
        ends = np.cumsum([len(w) for w in vocabulary], dtype=np.int64)
        size = np.array([len(w) for w in vocabulary], dtype=np.int64)
        hashes = self._hashed(joined, ends - size, size)
        order = np.argsort(hashes)
        self.hashes, self.numbers = hashes[order], order
        self.maybe = np.zeros(1 << 20, dtype=bool)
        self.maybe[self.hashes >> np.uint64(44)] = True
        count = max(1, len(vocabulary))
        self.pairs = np.array(sorted(a * count + b for a, b in automaton.pairs), dtype=np.int64)

    def _hashed(self, data: np.ndarray, starts: np.ndarray, size: np.ndarray) -> np.ndarray:
        """A 64-bit hash of each word that is no longer than the items' longest one."""
        found = size.astype(np.uint64)
        rest = np.flatnonzero(size <= self.longest)
        for j in range(self.longest):
            rest = rest[size[rest] > j]
            if not rest.size:
                break
            code = data[starts[rest] + j].astype(np.uint64) + np.uint64(1)
            value = (found[rest] ^ code) * np.uint64(0x9E3779B97F4A7C15)
            found[rest] = value ^ (value >> np.uint64(29))
        return found * np.uint64(0xBF58476D1CE4E5B9)

    def _numbered(self, data: np.ndarray, starts: np.ndarray, size: np.ndarray) -> np.ndarray:
        """The number that each word has among the items' words, -1 for others."""
        found = np.full(starts.size, -1, dtype=np.int64)
        if not self.hashes.size:
            return found
        hashes = self._hashed(data, starts, size)
        near = np.flatnonzero(self.maybe[hashes >> np.uint64(44)] & (size <= self.longest))
        place = np.searchsorted(self.hashes, hashes[near])
        place = np.minimum(place, self.hashes.size - 1)
        same = self.hashes[place] == hashes[near]
        found[near[same]] = self.numbers[place[same]]
        return found

    def _goes_on(self, number: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Whether a word and the one before it, in the same text, are a pair of some item."""
        on = np.zeros(number.size, dtype=bool)
        if not self.pairs.size:
            return on
        both = (number >= 0) & ~first
        both[1:] &= number[:-1] >= 0
        at = np.flatnonzero(both)
        pair = number[at - 1] * max(1, len(self.automaton.ids)) + number[at]
        place = np.minimum(np.searchsorted(self.pairs, pair), self.pairs.size - 1)
        on[at] = self.pairs[place] == pair
        return on

    def _stretches(self, raw: np.ndarray, cuts: np.ndarray):
        """Bytes in lower case, words (starts, ends) and the stretches of words to stream.

        ``cuts`` are the places where texts begin and end.
        """
        data = _UPPER_TO_LOWER[raw]
        inside = np.zeros(raw.size + 2, dtype=np.int8)
        inside[1:-1] = _IN_WORD[data]
        begin, end = inside[1:-1] > inside[:-2], inside[1:-1] > inside[2:]
        for at in cuts[1:-1]:
            if 0 < at < raw.size and inside[at] and inside[at + 1]:
                begin[at] = end[at - 1] = True
        starts, ends = np.flatnonzero(begin), np.flatnonzero(end) + 1
        number = self._numbered(data, starts, ends - starts)
        first = np.zeros(starts.size + 1, dtype=bool)
        first[np.searchsorted(starts, cuts)] = True
        on = np.append(self._goes_on(number, first[:-1]), False)
        opens = np.flatnonzero((number >= 0) & ~on[:-1])
        closes = np.flatnonzero((number >= 0) & ~on[1:]) + 1
        return data, starts, ends, opens, closes

    def _streamed(self, data, starts, ends, low: int, high: int, found: set[str]):
        listed = [bytes(data[a:b]) for a, b in zip(starts[low:high], ends[low:high], strict=True)]
        return self.automaton.stream(listed, found)

    def scan(self, raw: np.ndarray, cuts: np.ndarray) -> Iterator[tuple[int, list, set[str]]]:
        """Per text: its number of words, the spans of hit words and the items they hit.

        A span is (first word, end word, start, stop), in code points of the text.
        """
        data, starts, ends, opens, closes = self._stretches(raw, cuts)
        count = np.diff(np.searchsorted(starts, cuts))
        below = np.concatenate([[0], np.cumsum(count)])
        out = [(int(n), [], set()) for n in count]
        if self.automaton.shortest:
            long = np.flatnonzero(closes - opens >= self.automaton.shortest)
            text = np.searchsorted(below, opens[long], side="right") - 1
            for low, high, at in zip(opens[long].tolist(), closes[long].tolist(), text.tolist()):
                _, spans, found = out[at]
                for a, b in self._streamed(data, starts, ends, low, high, found):
                    first, last = low + a, low + b
                    start, stop = _points(raw, cuts[at], starts[first], ends[last - 1])
                    spans.append((int(first - below[at]), int(last - below[at]), start, stop))
        yield from out

    def scan_long(self, raw: np.ndarray) -> tuple[int, list, set[str]]:
        """The same of one text of any length, piece by piece."""
        count, spans, found = 0, [], set()
        at, points, want = 0, 0, PIECE
        while at < raw.size:
            stop = min(raw.size, at + want)
            # a piece ends behind a byte that is in no word
            while stop < raw.size and _IN_WORD[_UPPER_TO_LOWER[raw[stop - 1]]]:
                ahead = _IN_WORD[_UPPER_TO_LOWER[raw[stop : stop + PIECE]]]
                stop += int(ahead.argmin()) + 1 if not ahead.all() else ahead.size
            piece = raw[at:stop]
            cuts = np.array([0, piece.size])
            data, starts, ends, opens, closes = self._stretches(piece, cuts)
            upto = starts.size
            if stop < raw.size and closes.size and closes[-1] == starts.size:
                if opens[-1] == 0:  # all of it is one stretch
                    want *= 2
                    continue
                upto = int(opens[-1])  # the last stretch may go on: it waits for the next piece
                stop = at + int(starts[upto])
                opens, closes = opens[:-1], closes[:-1]
            for low, high in zip(opens.tolist(), closes.tolist()):
                if self.automaton.shortest and high - low >= self.automaton.shortest:
                    for a, b in self._streamed(data, starts, ends, low, high, found):
                        s, e = _points(piece, 0, starts[low + a], ends[low + b - 1])
                        spans.append((count + low + a, count + low + b, points + s, points + e))
            count += upto
            points += int(np.count_nonzero((raw[at:stop] & 0xC0) != 0x80))
            at, want = stop, PIECE
        return count, spans, found


def _points(raw: np.ndarray, zero: int, start: int, stop: int) -> tuple[int, int]:
    """Byte places as code points after ``zero``."""
    before = int(np.count_nonzero((raw[zero:start] & 0xC0) != 0x80))
    return before, before + int(np.count_nonzero((raw[start:stop] & 0xC0) != 0x80))


@functools.lru_cache(maxsize=1)
def _scanner(digest: str, holder: _Items) -> Scanner:
    return Scanner(Automaton([(name, words(text)) for name, text in holder.items], holder.window))


class _Items:
    """One block of items; equal blocks share the automaton of a Python worker."""

    def __init__(self, items: list[tuple[str, str]], window: int):
        self.items, self.window = items, window
        self.digest = hashlib.sha256(repr((window, items)).encode("utf-8", "replace")).hexdigest()

    def __eq__(self, other):
        return self.digest == other.digest

    def __hash__(self):
        return hash(self.digest)

    def scanner(self) -> Scanner:
        return _scanner(self.digest, self)


def item_blocks(
    benchmark: DataFrame,
    item_id: str = "item_id",
    text: str = "text",
    window: int = WINDOW,
    block_words: int = BLOCK_WORDS,
) -> Iterator[_Items]:
    """The items in blocks of some ``block_words`` words, one after another.

    A block is what an automaton takes, and all of the benchmark that the driver holds
    at once. Blocks are dealt by hash.
    """
    items = benchmark.select(
        F.coalesce(F.col(item_id).cast("string"), F.lit("null")).alias("name"),
        F.coalesce(F.col(text), F.lit("")).alias("text"),
    )
    # a word takes up two characters at least
    size = (F.floor((F.length("text") + 1) / 2)).alias("size")
    total = items.agg(F.sum(size)).first()[0] or 0
    blocks = max(1, -(-int(total) // block_words))
    dealt = items.withColumn("block", F.pmod(F.xxhash64("name", "text"), F.lit(blocks)))
    for block in range(blocks):
        rows = dealt.filter(F.col("block") == block).select("name", "text").collect()
        yield _Items(sorted((r["name"], r["text"]) for r in rows), window)


def _pass(keyed: DataFrame, items: _Items) -> DataFrame:
    """ID, HASH, n_words, spans and items per row of ``keyed``, as one block sees it."""
    shape = T.StructType(
        [
            keyed.schema[ID],
            keyed.schema[HASH],
            T.StructField("n_words", T.LongType()),
            T.StructField("spans", T._parse_datatype_string(_SPAN)),
            T.StructField("items", T.ArrayType(T.StringType())),
        ]
    )
    names = ["first", "end", "start", "stop"]
    span = pa.list_(pa.struct([(n, pa.int64()) for n in names]))

    def scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = items.scanner()
        for batch in batches:
            found = []
            for raw, cuts in _texts(batch.column(2)):
                if raw.size > 2 * PIECE:
                    found.append(scanner.scan_long(raw))
                else:
                    found += scanner.scan(raw, cuts)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array([n for n, _, _ in found], pa.int64()),
                    pa.array(
                        [[dict(zip(names, s, strict=True)) for s in spans] for _, spans, _ in found],
                        span,
                    ),
                    pa.array([sorted(hit) for _, _, hit in found], pa.list_(pa.string())),
                ],
                names=[ID, HASH, "n_words", "spans", "items"],
            )

    return keyed.mapInArrow(scanned, shape)


def _texts(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The bytes of some texts at a time, up to PIECE of them or one text, and their cuts."""
    wide = pa.types.is_large_string(column.type)
    kind = np.int64 if wide else np.int32
    _, places, data = column.buffers()
    cuts = np.frombuffer(places, dtype=kind)[column.offset : column.offset + len(column) + 1]
    whole = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    at = 0
    while at < len(column):
        upto = max(at + 1, int(np.searchsorted(cuts, int(cuts[at]) + PIECE, side="right")) - 1)
        upto = min(upto, len(column))
        own = cuts[at : upto + 1].astype(np.int64)
        yield whole[own[0] : own[-1]], own - own[0]
        at = upto


def _merged(spans: Column) -> Column:
    """Sorted spans with those that overlap or touch made one."""
    start = F.lit(None).cast(_SPAN)

    def add(done: Column, x: Column) -> Column:
        last = F.element_at(done, -1)
        joined = F.struct(
            last["first"].alias("first"),
            F.greatest(last["end"], x["end"]).alias("end"),
            last["start"].alias("start"),
            F.greatest(last["stop"], x["stop"]).alias("stop"),
        )
        rest = F.slice(done, F.lit(1), F.size(done) - 1)
        return F.when(done.isNull(), F.array(x)).otherwise(
            F.when(x["first"] <= last["end"], F.concat(rest, F.array(joined))).otherwise(
                F.concat(done, F.array(x))
            )
        )

    merged = F.aggregate(F.sort_array(spans), start, add)
    return F.when(F.size(spans) == 0, spans).otherwise(merged)


def find(
    df: DataFrame,
    benchmark: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """Per row of ``df``: ID, HASH, n_words, spans of hit words, and the sorted items hit."""
    rows = df.select(
        F.col(doc_id).alias(ID),
        text_hash(text).alias(HASH),
        F.coalesce(F.col(text), F.lit("")).alias(TEXT),
    )
    blocks = item_blocks(benchmark, item_id, item_text, window, block_words)
    found = _pass(rows, next(blocks))
    more = None
    for block in blocks:
        hits = _pass(rows, block).filter(F.size("spans") > 0).drop("n_words")
        more = hits if more is None else more.unionByName(hits)
    if more is None:
        return found
    more = more.groupBy(F.col(ID).alias("__i"), F.col(HASH).alias("__h")).agg(
        F.flatten(F.collect_set("spans")).alias("__spans"),
        F.flatten(F.collect_set("items")).alias("__items"),
    )
    same = F.col(ID).eqNullSafe(F.col("__i")) & (F.col(HASH) == F.col("__h"))
    both = F.concat("spans", F.coalesce("__spans", F.array().cast(_SPAN)))
    names = F.concat("items", F.coalesce("__items", F.array().cast("array<string>")))
    return found.join(more, same, "left").select(
        ID,
        HASH,
        "n_words",
        F.when(F.col("__spans").isNull(), F.col("spans")).otherwise(_merged(both)).alias("spans"),
        F.sort_array(F.array_distinct(names)).alias("items"),
    )


def hit_words() -> Column:
    """Number of words in ``spans``."""
    return F.aggregate(
        F.transform("spans", lambda s: s["end"] - s["first"]),
        F.lit(0).cast("long"),
        lambda total, n: total + n,
    )


def decontaminated(
    df: DataFrame,
    benchmark: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    window: int = WINDOW,
    coverage: float = 0.5,
) -> DataFrame:
    """``df`` without benchmark passages, in its own columns.

    Spans of ``window`` words or more that stand in an item, and whole shorter items, are
    cut out of the text; documents with more than ``coverage`` of their words in such
    spans go. Rows equal in id and text are treated alike.
    """
    hits = find(df, benchmark, doc_id, text, window=window).filter(F.size("spans") > 0)
    once = hits.groupBy(F.col(ID).alias("__i"), F.col(HASH).alias("__h")).agg(
        F.first("spans").alias("spans"), F.first("n_words").alias("n_words")
    )
    share = once.select("__i", "__h", "spans", (hit_words() / F.col("n_words")).alias("__share"))
    named = share.withColumnRenamed("spans", "__spans")

    @F.arrow_udf("string")
    def cut(texts: pa.Array, spans: pa.Array) -> pa.Array:
        out = []
        for whole, places in zip(texts.to_pylist(), spans.to_pylist(), strict=True):
            if whole and places:
                kept, done = [], 0
                for s in places:
                    kept.append(whole[done : s["start"]])
                    done = s["stop"]
                whole = "".join([*kept, whole[done:]])
            out.append(whole)
        return pa.array(out, pa.string())

    same = F.col(doc_id).eqNullSafe(F.col("__i")) & (text_hash(text) == F.col("__h"))
    kept = df.join(named, same, "left").filter(
        F.col("__share").isNull() | (F.col("__share") <= coverage)
    )
    clean = F.when(F.col("__spans").isNull(), F.col(text)).otherwise(cut(text, "__spans"))
    return kept.withColumn(text, clean).select(*df.columns)

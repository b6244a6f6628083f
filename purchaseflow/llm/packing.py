"""Packs documents into sequences of a fixed number of tokens, by Karmarkar-Karp.

A document is its token ids and an end id. What fills whole sequences is cut off first;
the rest is cut into parts of at most PART ids, which are gathered until they make
WINDOWS sequences. Karmarkar-Karp multiway differencing deals these out: every part
begins as a partial partition with one full window; the two partial partitions with the
largest spread are merged, the fullest windows of one with the emptiest of the other,
until one partition is left, whose windows are nearly equal. If its fullest window exceeds
the capacity, the number of windows rises by one and the parts are dealt out again. What
the windows lack after that is cut off parts that were not dealt.

One pass over the documents, with no shuffle, packs what each task reads, in a buffer of
bounded size, and is written. All its sequences are full. Left over are fewer tokens than a
sequence for each task; a second pass, over nothing else, packs these parts in the same
way in few tasks, and only the last sequence of each of these needs padding. A sequence is named by the task's partition and a counter, so a task that runs
again after a loss gives the same sequences.

Defined results: null text is empty text, whose document is the end id alone; rows with
equal ids are packed one by one; a text of any length is tokenized in pieces between
white space and cut as often as needed.
"""

from __future__ import annotations

import heapq
import re
import unicodedata
import zlib
from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F, types as T

from purchaseflow.sources.scratch import staged

CAPACITY = 2048
PART = 256
WINDOWS = 128
END_ID = 1
PIECE = 1 << 20
CACHED_WORDS = 600_000
TASK_BITS = 40  # a sequence id is the partition number, then so many bits of counter
SECOND = 1 << 22  # marks the partition numbers of the second pass
AGAIN = 2_000  # parts that a task of the second pass takes


def _class_of(test) -> str:
    """The Latin characters for which ``test`` holds, as the inside of a regex class."""
    return "".join(re.escape(chr(i)) for i in range(0x21, 0x250) if test(chr(i)))


class WordTokenizer:
    """Ids of a lower-casing word-level BPE tokenizer, each word encoded once.

    Its pre-tokenizer cuts texts into runs of letters, single digits, runs of other
    signs and English contractions, and encodes each by itself, so words can be cached.
    Texts beyond the Latin letters, or with one of its special tokens, go through the
    tokenizer as a whole.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer, pre_tokenizers

        self._tokenizer = Tokenizer.from_file(path)
        self._model = self._tokenizer.model
        # the model knows bytes by printable stand-ins; for ASCII they are the characters
        stand_in = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self._stand_ins = {
            i: stand_in.pre_tokenize_str(chr(i))[0][0] for i in range(0xA1, 0x250)
        }
        letter = _class_of(str.isalpha)
        number = _class_of(lambda c: unicodedata.category(c)[0] == "N")
        self._plain = re.compile(r"[\t\n\r\x20-\x7e¡-ɏ]*")
        self._words = re.compile(
            rf"[{letter}]+|[{number}]|'(?:s|t|re|ve|m|ll|d)|[^\s{letter}{number}]+"
        )
        outer = self

        class Cache(dict):
            def __missing__(self, word: str) -> bytes:
                found = outer._word(word)
                if len(self) >= CACHED_WORDS:
                    self.clear()
                if len(word) <= 64:
                    self[word] = found
                return found

        self._cache = Cache()

    def _word(self, word: str) -> bytes:
        """The ids of one word of a plain text, past the steps that only cut texts up."""
        known = word if word.isascii() else word.translate(self._stand_ins)
        ids = [token.id for token in self._model.tokenize(known)]
        return np.array(ids, dtype="<u4").tobytes()

    def _encode(self, text: str) -> bytes:
        ids = self._tokenizer.encode(text, add_special_tokens=False).ids
        return np.array(ids, dtype="<u4").tobytes()

    def encode(self, text: str) -> bytes:
        """The ids of ``text``, 4 bytes each, little-endian."""
        return b"".join(self._part(part) for part in _cut(text))

    def _part(self, text: str) -> bytes:
        # lower case can lie beyond the Latin letters even where the text does not
        lower = text.lower()
        simple = (
            self._plain.fullmatch(lower)
            and "<|" not in text
            and (text.isascii() or unicodedata.is_normalized("NFC", text))
        )
        if not simple:
            return self._encode(text)
        words = self._words.findall(lower)
        return b"".join(map(self._cache.__getitem__, words))


def _cut(text: str) -> Iterator[str]:
    """``text`` in pieces of about PIECE characters, cut at blanks and line ends only."""
    start = 0
    while len(text) - start > PIECE:
        found = re.compile(r"[ \n]").search(text, start + PIECE)
        if not found:
            break
        yield text[start : found.start()]
        start = found.start()
    yield text[start:] if start else text


def partition(sizes: list[int], windows: int) -> list[list[int]]:
    """Karmarkar-Karp: the numbers of the items in each of ``windows`` near-equal windows."""
    if not sizes:
        return [[] for _ in range(windows)]
    heap = []
    for i, size in enumerate(sizes):
        sums = np.zeros(windows, dtype=np.int64)
        sums[0] = size
        heap.append((-(size - (0 if windows > 1 else size)), i, sums, [i] + [None] * (windows - 1)))
    heapq.heapify(heap)
    number = len(sizes)
    while len(heap) > 1:
        _, _, a, a_items = heapq.heappop(heap)
        _, _, b, b_items = heapq.heappop(heap)
        sums = a + b[::-1]
        order = np.argsort(-sums, kind="stable").tolist()
        sums = sums[order]
        b_items.reverse()
        items = [_both(a_items[i], b_items[i]) for i in order]
        heapq.heappush(heap, (-int(sums[0] - sums[-1]), number, sums, items))
        number += 1
    return [_flat(tree) for tree in heap[0][3]]


def _both(a, b):
    return b if a is None else a if b is None else (a, b)


def _flat(tree) -> list[int]:
    found, open_ = [], [tree]
    while open_:
        node = open_.pop()
        if isinstance(node, tuple):
            open_.extend(node)
        elif node is not None:
            found.append(node)
    return sorted(found)


def fit_windows(sizes: list[int], capacity: int) -> list[list[int]]:
    """Windows within ``capacity``: as few as the total allows, more if one overflows."""
    windows = max(1, -(-sum(sizes) // capacity))
    while True:
        found = partition(sizes, windows)
        if all(sum(sizes[i] for i in window) <= capacity for window in found):
            return [window for window in found if window]
        windows += 1


def _cut_off(parts: deque[tuple], tokens: int) -> list[tuple]:
    """Takes so many tokens off the front of ``parts``, the last one cut if need be."""
    taken = []
    while tokens:
        doc, start, ids, total = parts.popleft()
        size = min(tokens, len(ids) // 4)
        taken.append((doc, start, ids[: size * 4], total))
        if size * 4 < len(ids):
            parts.appendleft((doc, start + size, ids[size * 4 :], total))
        tokens -= size
    return taken


class Packer:
    """Takes documents one by one and gives back pieces that have their place."""

    def __init__(self, task: int, capacity: int = CAPACITY):
        self._capacity = capacity
        self._next = task << TASK_BITS
        self._parts: list[tuple] = []  # (doc, start, ids, tokens of the document)
        self._held = 0
        self._done: list[tuple] = []

    def _place(self, parts: list[tuple]) -> None:
        offset = 0
        for doc, start, ids, tokens in parts:
            length = len(ids) // 4
            self._done.append((doc, start, length, zlib.crc32(ids), tokens, self._next, offset))
            offset += length
        self._next += 1

    def add_part(self, doc, start: int, ids: bytes, tokens: int) -> None:
        """A part of a document, of fewer tokens than a sequence."""
        self._parts.append((doc, start, ids, tokens))
        self._held += len(ids) // 4
        if self._held >= WINDOWS * self._capacity:
            self.flush()

    def add(self, doc, ids: bytes) -> None:
        tokens, whole = len(ids) // 4, self._capacity * 4
        cut = len(ids) - len(ids) % whole
        for at in range(0, cut, whole):
            self._place([(doc, at // 4, ids[at : at + whole], tokens)])
        for at in range(cut, len(ids), PART * 4):
            self._parts.append((doc, at // 4, ids[at : at + PART * 4], tokens))
        self._held += tokens - cut // 4
        if self._held >= WINDOWS * self._capacity:
            self.flush()

    def flush(self) -> None:
        """Deals the parts that fill whole windows and holds what is over.

        The parts are dealt by differencing. If the number of windows had to rise, the
        emptiest are given up again, and what is left over is cut to fill the others up.
        """
        whole = self._held // self._capacity
        left, kept = whole * self._capacity, []
        rest: deque[tuple] = deque()
        for part in self._parts:
            size = len(part[2]) // 4
            if size <= left:
                kept.append(part)
                left -= size
            else:
                rest.append(part)
        windows = [
            [kept[i] for i in window]
            for window in fit_windows([len(p[2]) // 4 for p in kept], self._capacity)
        ]
        windows.sort(key=lambda parts: -sum(len(p[2]) for p in parts))
        for given_up in windows[whole:]:
            rest.extend(given_up)
        for window in windows[:whole]:
            room = self._capacity - sum(len(p[2]) for p in window) // 4
            self._place([*window, *_cut_off(rest, room)])
        self._parts = list(rest)
        self._held = sum(len(p[2]) for p in rest) // 4

    def finish(self) -> None:
        """Places all that is held, the last sequence as full as it gets."""
        self.flush()
        if self._parts:
            self._place(self._parts)
        self._parts, self._held = [], 0

    def left_over(self) -> list[tuple]:
        """Fewer tokens than a sequence, which are given back unplaced."""
        self.flush()
        parts, self._parts, self._held = self._parts, [], 0
        return parts

    def taken(self) -> list[tuple]:
        done, self._done = self._done, []
        return done


def pack(
    df: DataFrame, tokenizer: str, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """One row per piece of a document.

    doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset; ``tokenizer`` is
    the path of the tokenizer file on the executors.
    """
    slim = df.select(df[doc_id].alias("doc_id"), df[text].alias("text"))
    names = ["start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    schema = T.StructType([slim.schema["doc_id"], *[T.StructField(n, T.LongType()) for n in names]])
    with_ids = T.StructType([*schema, T.StructField("ids", T.BinaryType())])

    def batch_of(rows: list[tuple], kind: pa.DataType, ids: bool) -> pa.RecordBatch:
        kinds = [kind, *[pa.int64()] * 6, *[pa.binary()] * ids]
        columns = list(zip(*rows, strict=True)) or [[]] * len(kinds)
        arrays = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
        return pa.RecordBatch.from_arrays(arrays, names=["doc_id", *names, *["ids"] * ids])

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, kind = WordTokenizer(tokenizer), None
        end = np.array([END_ID], dtype="<u4").tobytes()
        packer = Packer(TaskContext.get().partitionId())

        def out() -> pa.RecordBatch:
            return batch_of([(*row, None) for row in packer.taken()], kind, True)

        for batch in batches:
            kind = batch.schema.field(0).type
            # a few rows at a time, so that no more texts are Python objects than needed
            for start in range(0, batch.num_rows, 256):
                ids, texts = batch.slice(start, 256).columns
                for doc, whole in zip(ids.to_pylist(), texts.to_pylist(), strict=True):
                    packer.add(doc, words.encode(whole or "") + end)
            yield out()
        if kind is not None:
            over = packer.left_over()
            yield out()
            open_ = [(d, at, len(ids) // 4, zlib.crc32(ids), n, None, None, ids) for d, at, ids, n in over]
            yield batch_of(open_, kind, True)

    def packed_again(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer, kind = Packer(SECOND | TaskContext.get().partitionId()), None
        for batch in batches:
            kind = batch.schema.field("doc_id").type
            columns = [batch.column(n).to_pylist() for n in ("doc_id", "start", "ids", "doc_tokens")]
            for part in zip(*columns, strict=True):
                packer.add_part(*part)
            yield batch_of(packer.taken(), kind, False)
        if kind is not None:
            packer.finish()
            yield batch_of(packer.taken(), kind, False)

    first = staged(slim.mapInArrow(packed, with_ids), "packed")
    over = first.filter(F.col("ids").isNotNull())
    tasks = max(1, over.count() // AGAIN)
    second = over.repartition(tasks).mapInArrow(packed_again, schema)
    return first.filter(F.col("ids").isNull()).drop("ids").unionByName(second)


def stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage, the last: the pieces of the packed documents."""
    import public_tokenizers

    return pack(docs, public_tokenizers.path("word_bpe_49k.json"))

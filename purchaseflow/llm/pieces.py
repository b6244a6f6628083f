"""SentencePiece encoding by Gumbel top-k sampling without replacement, and decoding.

A text's lattice has all ways to spell it with pieces of the vocabulary, and with bytes
where a character has no piece. A piece's probability falls with its rank in the BPE
vocabulary (its score is the negative rank) as 1 / (rank + 2); a byte is rarer than every
piece. As no piece goes on after a word's end, the lattice is one of its words in a row.

Sampling is a perturbed A-star search. Each node, a prefix of a segmentation, has the log
probability of all that complete it (from backward sums) and a Gumbel-perturbed version
of it, the highest of its completions. The best open node is expanded until it is whole:
the search follows the sampled best child down, and the siblings passed on the way stay
open together, as one group whose best value is a Gumbel at the log of their summed
probabilities, cut off at the value of the segmentation. The best group is opened next,
for one of its members (a step, and a sibling there, by probability), and keeps the rest.
So segmentations come out in order of their perturbed log probability, all different, as
if every one of them had been perturbed. Beside each stands its inclusion score, the
probability to be among the first ``samples`` given the next value after them.

Randomness comes from a generator keyed by the row, one number for each character and
round, so a row's samples do not depend on the rows around it or on a task's retries.

Defined results: null text is empty text, whose only segmentation is empty; a text with
fewer segmentations than ``samples`` gives all it has, with inclusion score 1; decoding
gives the text back exactly, characters of any kind included; a null key is a key.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from purchaseflow.llm.hashing import PIECE, mixed, points, powers

SAMPLES = 2
BATCH_CHARS = 2_000_000
KEPT_SLOTS = 2_000_000  # of lattices that a task keeps for the batches to come
BUILT_SLOTS = 1 << 18  # of lattices that are built at a time
DECODED = 1 << 20
_SPACE = 0x110000  # stands for a blank, beyond all characters
_NEVER = -np.inf
_FAR = 50.0  # a log probability so far below another counts for nothing beside it
_BITS = np.uint64(44)  # of a hash, behind the first ones that look it up


def _codes(text: str) -> np.ndarray:
    """Code points behind a leading blank, blanks as _SPACE; nothing for an empty text."""
    if not text:
        return np.zeros(0, dtype=np.uint32)
    code = points(" " + text).copy()
    code[code == 32] = _SPACE
    return code


def _running(code: np.ndarray) -> np.ndarray:
    """Prefix sums from which the hash of any part of up to PIECE characters follows."""
    power, _ = powers()
    total = np.zeros(code.size + 1, dtype=np.uint64)
    where = np.arange(code.size) % PIECE
    np.cumsum((code + np.uint64(1)) * power[where], out=total[1:])
    return total


class Vocabulary:
    """Pieces, their log probabilities, and the prefixes of pieces by hash."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        count = model.get_piece_size()
        names = [model.id_to_piece(i) for i in range(count)]
        plain = [
            i
            for i in range(count)
            if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i))
        ]
        rank = np.array([-model.get_score(i) for i in plain])
        share = 1 / (rank + 2)
        bytes_ = {int(names[i][3:5], 16): i for i in range(count) if model.is_byte(i)}
        rare = share.min() / 2
        log_total = math.log(share.sum() + rare * len(bytes_))
        self.byte_log = math.log(rare) - log_total
        self.byte_ids = np.array([bytes_[b] for b in range(256)], dtype=np.int64)
        self.longest = max(len(names[i]) for i in plain)
        # every prefix of a piece: its hash, and the piece it is itself, if any
        known: dict[int, int] = {}
        for i in plain:
            code = points(names[i].replace("▁", " ")).copy()
            code[code == 32] = _SPACE
            total = _running(code)
            keys = _hash(total[1:], np.arange(1, code.size + 1)).tolist()
            for key in keys:
                known.setdefault(key, -1)
            known[keys[-1]] = i
        self.hashes = np.array(sorted(known), dtype=np.uint64)
        self.pieces = np.array([known[h] for h in self.hashes.tolist()], dtype=np.int32)
        # by the hash's first bits: where the known ones with these bits begin, or -1
        bits = (self.hashes >> _BITS).astype(np.int64)
        self.begin = np.full(1 << 20, -1, dtype=np.int32)
        self.begin[bits[::-1]] = np.arange(bits.size)[::-1]
        self.crowd = int(np.bincount(bits).max())
        self.logs = np.full(count, _NEVER)
        self.logs[plain] = np.log(share) - log_total
        self.bytes = [n.replace("▁", " ").encode() for n in names]
        for value, i in bytes_.items():
            self.bytes[i] = bytes([value])
        for i in range(count):
            if model.is_control(i) or model.is_unknown(i):
                self.bytes[i] = b""
        self._joined = np.frombuffer(b"".join(self.bytes), dtype=np.uint8)
        self._sizes = np.array([len(b) for b in self.bytes], dtype=np.int32)
        self._places = np.cumsum(self._sizes, dtype=np.int32) - self._sizes

    def look_up(self, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Whether each hash is that of a piece's prefix, and the piece it is, or -1."""
        place = self.begin[key >> _BITS]
        near = np.flatnonzero(place >= 0)
        place, own = place[near], key[near]
        for _ in range(self.crowd - 1):
            # hashes with the same first bits lie side by side
            other = np.flatnonzero(self.hashes[place] < own)
            if not other.size:
                break
            place[other] = np.minimum(place[other] + 1, self.hashes.size - 1)
        same = self.hashes[place] == own
        near, place = near[same], place[same]
        known, piece = np.zeros(key.size, dtype=bool), np.full(key.size, -1, dtype=np.int32)
        known[near] = True
        piece[near] = self.pieces[place]
        return known, piece

    def spelling(self, ids) -> bytes:
        """The bytes of piece ids, with the blank that encoding puts in front."""
        parts, ids = [], np.asarray(ids, dtype=np.int32)
        for at in range(0, ids.size, DECODED):
            own = ids[at : at + DECODED]
            size = self._sizes[own]
            upto = np.cumsum(size, dtype=np.int32)
            where = np.repeat(self._places[own] - upto + size, size)
            where += np.arange(where.size, dtype=np.int32)
            parts.append(self._joined[where].tobytes())
        return b"".join(parts)

    def decode(self, ids) -> str:
        """The text of piece ids, without the blank that encoding puts in front."""
        whole = self.spelling(ids).decode("utf-8", "replace")
        return whole[1:] if whole.startswith(" ") else whole


def _hash(value: np.ndarray, length: np.ndarray) -> np.ndarray:
    return mixed(value + length.astype(np.uint64))


@dataclass
class Lattices:
    """Lattices of different words one after another, an end slot after each.

    A slot's edges, one for each piece that may begin there, are the numbers from
    ``first[slot]`` to ``first[slot + 1]``: their ``length`` in characters, the piece
    ``ids`` (-1: spelt in several bytes), ``log`` of the chance given the slot, and ``below``, the
    running sum of chances over the slot's edges. ``left`` is the number of characters to
    the word's end. Nothing in it depends on the words around, so lattices can be kept.
    """

    first: np.ndarray
    length: np.ndarray
    ids: np.ndarray
    log: np.ndarray
    below: np.ndarray
    left: np.ndarray


class Kept:
    """The lattices of the words that a task has met, up to some KEPT_SLOTS."""

    def __init__(self):
        self.clear()

    def clear(self) -> None:
        self.room: dict[str, np.ndarray] = {}  # of the grid's arrays, some of it free
        self.names = np.zeros(0, dtype=np.uint64)  # sorted
        self.slots = np.zeros(0, dtype=np.int64)  # where the word of each name begins
        self.grid: Lattices | None = None

    def of(self, names, code, starts, ends, vocabulary) -> tuple[Lattices, np.ndarray]:
        """Lattices with all words ``code[start:end]`` of different ``names``, and the slot
        where each begins."""
        size = ends - starts + 1
        for _ in range(2):
            place = np.minimum(np.searchsorted(self.names, names), max(0, self.names.size - 1))
            known = self.names[place] == names if self.names.size else np.zeros(names.size, bool)
            new = np.flatnonzero(~known)
            if self.grid is None or self.grid.left.size + size[new].sum() <= KEPT_SLOTS:
                break
            self.clear()  # before there are too many
        if new.size:
            size = size[new]
            old = self.grid.left.size if self.grid else 0
            upto = np.cumsum(size)
            slots = old + upto - size
            done = 0
            while done < new.size:
                # some at a time, as building takes several times the room of what is kept
                last = int(np.searchsorted(upto, upto[done] - size[done] + BUILT_SLOTS, side="right"))
                own = new[done : max(done + 1, last)]
                self._add(lattices(code, starts[own], ends[own], vocabulary))
                done += own.size
            merged = np.concatenate([self.names, names[new]])
            order = np.argsort(merged, kind="stable")
            self.names = merged[order]
            self.slots = np.concatenate([self.slots, slots])[order]
        return self.grid, self.slots[np.searchsorted(self.names, names)]


    def _add(self, more: Lattices) -> None:
        """Puts ``more`` behind the lattices kept, whose arrays grow by doubling."""
        arrays = dict(vars(more))
        if self.grid:
            upto = _narrow(more.first.astype(np.int64) + self.grid.first[-1])
            arrays["first"] = upto[1:]
        for name, new in arrays.items():
            room = self.room.get(name)
            used = getattr(self.grid, name).size if self.grid else 0
            if room is None or used + new.size > room.size or room.dtype < new.dtype:
                free = used + max(used, new.size)
                room = np.empty(free, dtype=new.dtype)
                if used:
                    room[:used] = getattr(self.grid, name)
                self.room[name] = room
            room[used : used + new.size] = new
            arrays[name] = room[: used + new.size]
        self.grid = Lattices(**arrays)


def lattices(code: np.ndarray, starts: np.ndarray, ends: np.ndarray, vocabulary: Vocabulary) -> Lattices:
    """The lattices of the words ``code[start:end]``."""
    size = ends - starts
    begin = np.concatenate([[0], np.cumsum(size + 1)])
    slots = int(begin[-1])
    left = np.repeat(begin[1:] - 1, size + 1) - np.arange(slots)
    inside = np.flatnonzero(left > 0)
    chars = np.zeros(slots, dtype=np.uint32)
    shift = np.repeat(starts - np.concatenate([[0], np.cumsum(size)[:-1]]), size)
    chars[inside] = code[shift + np.arange(inside.size)]
    # the hash of a part is built up character by character, as long as pieces go on
    power, _ = powers()
    plus_one = chars + np.uint64(1)
    at, value = inside, np.zeros(inside.size, dtype=np.uint64)
    parts, count = [], np.zeros(slots, dtype=np.int32)
    for length in range(1, vocabulary.longest + 1):
        value = value + plus_one[at + (length - 1)] * power[length - 1]
        known, piece = vocabulary.look_up(mixed(value + np.uint64(length)))
        # every character can be spelt, in bytes if it is no piece
        whole = np.flatnonzero(piece >= 0) if length > 1 else slice(None)
        parts.append((at[whole], piece[whole]))
        count[parts[-1][0]] += 1
        on = np.flatnonzero(known)
        on = on[left[at[on]] > length]
        at, value = at[on], value[on]
        if not at.size:
            break
    first = _narrow(np.concatenate([[0], np.cumsum(count, dtype=np.int64)]))
    ids, length = np.empty((2, int(first[-1])), dtype=np.int32)
    place = first[:-1].copy()
    for size, (slot, piece) in enumerate(parts, 1):
        to = place[slot]
        ids[to], length[to], place[slot] = piece, size, to + 1
    slot = np.repeat(np.arange(slots), count)
    log = vocabulary.logs[ids]
    bare = np.flatnonzero(ids < 0)
    wide = chars[slot[bare]]
    log[bare] = vocabulary.byte_log * (1 + (wide > 0x7F) + (wide > 0x7FF) + (wide > 0xFFFF))
    # log probability of all ways on from a slot, from the words' ends backwards
    log_all, target = np.zeros(slots), slot + length
    left_inside = left[inside]
    if left.max(initial=0) < 1 << 16:
        left_inside = left_inside.astype(np.uint16)  # which numpy sorts by digits
    by_left = np.argsort(left_inside, kind="stable")
    bounds = np.cumsum(np.bincount(left_inside, minlength=1))
    by_left = inside[by_left]
    for d in range(1, bounds.size):
        now = by_left[bounds[d - 1] : bounds[d]]
        if not now.size:
            continue
        own = count[now]
        open_ = np.concatenate([[0], np.cumsum(own)[:-1]])
        edge = np.repeat(first[now] - open_, own) + np.arange(own.sum())
        value = log[edge] + log_all[target[edge]]
        top = np.maximum.reduceat(value, open_)
        total = np.add.reduceat(np.exp(value - np.repeat(top, own)), open_)
        log_all[now] = top + np.log(total)
    plain = wide < 0x80
    ids[bare[plain]] = vocabulary.byte_ids[wide[plain]]
    log = log + log_all[target] - np.repeat(log_all, count)
    below = np.exp(log)
    more = np.flatnonzero(count > 1)
    for nth in range(1, int(count.max(initial=0))):
        more = more[count[more] > nth]
        edge = first[more] + nth
        below[edge] += below[edge - 1]
    return Lattices(first, length, ids, log, below, left.astype(np.int32))


def _narrow(numbers: np.ndarray) -> np.ndarray:
    """Rising ``numbers`` in 32 bits if they fit, as most of the time goes into moving them."""
    return numbers.astype(np.int32) if numbers[-1] < 1 << 31 else numbers


def _steps(grid: Lattices, slot: np.ndarray, char: np.ndarray, uniform: np.ndarray):
    """Samples each slot's word to its end; arrays (char, edge), by character."""
    taken = np.full(uniform.size, -1, dtype=grid.first.dtype)
    while slot.size:
        # chances of a slot sum up to 1; should rounding leave less, the last edge has the rest
        edge, last = grid.first[slot], grid.first[slot + 1] - 1
        wanted = uniform[char]
        behind = np.flatnonzero((grid.below[edge] <= wanted) & (edge < last))
        if behind.size:
            now, wanted, last = edge[behind], wanted[behind], last[behind]
            while True:
                now += 1
                on = np.flatnonzero((grid.below[now] <= wanted) & (now < last))
                edge[behind] = now
                if not on.size:
                    break
                behind, now, wanted, last = behind[on], now[on], wanted[on], last[on]
        taken[char] = edge
        length = grid.length[edge]
        on = np.flatnonzero(grid.left[slot] > length)
        length = length[on]
        slot, char = slot[on] + length, char[on] + length
    char = np.flatnonzero(taken >= 0)
    return char, taken[char]


@dataclass
class Siblings:
    """The open group of a path: the siblings passed from its step ``first`` on.

    ``value`` is the best perturbed one. Probabilities are taken given the node where the
    steps begin, whose log is ``start``: ``mass`` of the siblings by step, once the group
    is opened, as far as they count (``whole``: for all steps), without the edges
    ``gone`` of a step.
    """

    path: int
    first: int
    start: float
    value: float
    mass: np.ndarray | None = None
    whole: bool = False
    gone: dict[int, list[int]] = field(default_factory=dict)


class Search:
    """The open groups of one text's search tree, and the segmentations found."""

    def __init__(self, code: np.ndarray, key: int, grid: Lattices | None):
        self.code, self.grid = code, grid
        self.random = np.random.Generator(np.random.Philox(key=key & 0xFFFFFFFFFFFFFFFF))
        # (char, slot of each of the text's characters, edge, running log, log, value)
        self.paths: list[tuple] = []
        self.open: list[Siblings] = []

    def uniform(self) -> np.ndarray:
        return self.random.random(self.code.size)

    def _cut_gumbel(self, log: float, bound: float) -> float:
        """A Gumbel with the given location, below ``bound``."""
        noise = -math.log(self.random.random() + 1e-300)
        return min(log - math.log(math.exp(min(700.0, log - bound)) + noise), bound)

    def add(self, char, slots, edge, first: int, value: float) -> None:
        """A whole segmentation; its steps from ``first`` on open a group of siblings."""
        upto = np.cumsum(self.grid.log[edge])
        start, log = float(upto[first - 1]) if first else 0.0, float(upto[-1])
        self.paths.append((char, slots, edge, upto, log, value))
        # all that goes on from the node where the steps begin, but this segmentation
        other = -math.expm1(log - start) if first < edge.size else 0.0
        best = _NEVER
        if other >= 1e-12:
            best = self._cut_gumbel(start + math.log(other), value)
        self.open.append(Siblings(len(self.paths) - 1, first, start, best))

    def best(self) -> tuple[float, int]:
        """The highest open value and its group; _NEVER if nothing is open."""
        return max(((group.value, n) for n, group in enumerate(self.open)), default=(_NEVER, 0))

    def _masses(self, group: Siblings, whole: bool) -> None:
        """Sets the masses of a group, of all steps or those that count beside the first."""
        upto = self.paths[group.path][3]
        size = upto.size - group.first
        if not whole:
            size = min(size, 1 + upto.size - int(np.searchsorted(upto[::-1], group.start - _FAR)) - group.first)
        upto = np.concatenate([[0.0], upto[group.first : group.first + size] - group.start])
        other = -np.expm1(upto[1:] - upto[:-1])
        other[other < 1e-12] = 0  # no siblings
        mass = np.exp(upto[:-1]) * other
        if group.mass is not None:
            mass[: group.mass.size] = group.mass
        group.mass, group.whole = mass, whole

    def next(self):
        """Opens the best group: (path, step, edge of the sibling, value), or None."""
        while True:
            value, n = self.best()
            if value == _NEVER:
                return None
            group = self.open[n]
            if group.mass is None:
                self._masses(group, False)
            total = np.cumsum(group.mass)
            if total[-1] > 0:
                break
            group.value = _NEVER
        char, slots, edge, upto, _, _ = self.paths[group.path]
        nth = int(np.searchsorted(total, self.random.random() * total[-1], side="right"))
        nth = min(nth, int(np.flatnonzero(group.mass)[-1]))
        step = group.first + nth
        gone = group.gone.setdefault(step, [int(edge[step])])
        slot = slots[char[step]]
        low, high = self.grid.first[slot], self.grid.first[slot + 1]
        chance = np.exp(self.grid.log[low:high])
        chance[np.array(gone) - low] = 0
        total = np.cumsum(chance)
        taken = int(np.searchsorted(total, self.random.random() * total[-1], side="right"))
        taken = min(taken, int(np.flatnonzero(chance)[-1]))
        gone.append(int(low) + taken)
        chance[taken] = 0
        rest = float(chance.sum())
        before = float(upto[step - 1]) if step else 0.0
        group.mass[nth] = math.exp(before - group.start) * rest if rest > 1e-12 else 0.0
        if not group.whole and group.mass.sum() < 1e-6:
            self._masses(group, True)
        rest = float(group.mass.sum())
        group.value = self._cut_gumbel(group.start + math.log(rest), value) if rest > 0 else _NEVER
        return group.path, step, int(low) + taken, value

    def ids(self, path: int, vocabulary: Vocabulary) -> np.ndarray:
        char, _, edge = self.paths[path][:3]
        found = self.grid.ids[edge]
        spelt = np.flatnonzero(found < 0)
        if not spelt.size:
            return found
        letters = [chr(c).encode("utf-8", "surrogatepass") for c in self.code[char[spelt]].tolist()]
        width = np.ones(found.size, dtype=np.int64)
        width[spelt] = [len(x) for x in letters]
        out = np.repeat(found, width)
        out[out < 0] = vocabulary.byte_ids[np.frombuffer(b"".join(letters), dtype=np.uint8)]
        return out


def sample(
    texts: list[str],
    keys: list[int],
    vocabulary: Vocabulary,
    samples: int,
    kept: Kept | None = None,
) -> list[Search]:
    """The searches of several texts, each run for ``samples`` segmentations."""
    codes = [_codes(text) for text in texts]
    sizes = np.array([c.size for c in codes], dtype=np.int64)
    base = np.concatenate([[0], np.cumsum(sizes)])
    code = np.concatenate(codes) if codes else np.zeros(0, dtype=np.uint32)
    if not code.size:
        return [Search(c, k, None) for c, k in zip(codes, keys, strict=True)]
    blank = code == _SPACE
    begins = blank.copy()
    begins[1:] &= ~blank[:-1]
    begins[base[:-1][sizes > 0]] = True
    starts = np.flatnonzero(begins)
    ends = np.append(starts[1:], code.size)
    names = _names(code, starts, ends)
    inverse, different = pd.factorize(names)
    index = np.empty(different.size, dtype=np.int64)
    index[inverse[::-1]] = np.arange(names.size)[::-1]
    kept = kept or Kept()
    grid, first = kept.of(different, code, starts[index], ends[index], vocabulary)
    word_slot = first[inverse]
    slot_of = _narrow(np.arange(code.size)) + np.repeat(word_slot - starts, ends - starts)
    searches = [Search(c, k, grid) for c, k in zip(codes, keys, strict=True)]
    uniform = np.concatenate([s.uniform() for s in searches])
    char, edge = _steps(grid, word_slot, starts, uniform)
    cuts = np.searchsorted(char, base)
    for d, search in enumerate(searches):
        if sizes[d]:
            a, b = cuts[d], cuts[d + 1]
            value = -math.log(-math.log(search.random.random() + 1e-300))
            search.add(char[a:b] - base[d], slot_of[base[d] : base[d + 1]], edge[a:b], 0, value)
    word_of = np.repeat(np.arange(starts.size), ends - starts)
    for _ in range(samples - 1):
        opened, from_slot, from_char, uniform = [], [], [], np.zeros(code.size)
        for d, search in enumerate(searches):
            node = search.next() if sizes[d] else None
            if node is None:
                continue
            path, step, taken, value = node
            # the character after the sibling
            at = int(search.paths[path][0][step] + grid.length[taken])
            uniform[base[d] : base[d + 1]] = search.uniform()
            opened.append((d, path, step, taken, value, at))
            here = base[d] + at
            if at < sizes[d]:
                # the rest of the word, if any is left, and the words behind it
                word = word_of[here]
                after = starts[word : np.searchsorted(starts, base[d + 1])]
                if after[0] != here:
                    after = np.concatenate([[here], after[1:]])
                from_char.append(after)
                from_slot.append(slot_of[after])
        if not opened:
            break
        char, edge = _steps(
            grid,
            np.concatenate(from_slot) if from_slot else np.zeros(0, dtype=np.int64),
            np.concatenate(from_char) if from_char else np.zeros(0, dtype=np.int64),
            uniform,
        )
        cuts = np.searchsorted(char, base)
        for d, path, step, taken, value, _ in opened:
            old = searches[d].paths[path]
            a, b = cuts[d], cuts[d + 1]
            searches[d].add(
                np.concatenate([old[0][: step + 1], char[a:b] - base[d]]),
                old[1],
                np.concatenate([old[2][:step], [taken], edge[a:b]]),
                step + 1,
                value,
            )
    return searches


def _names(code: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word; words beyond PIECE characters are hashed in parts."""
    power, inverse = powers()
    found = np.zeros(starts.size, dtype=np.uint64)
    done = 0
    while done < starts.size:
        low = starts[done]
        last = max(done + 1, int(np.searchsorted(ends, low + PIECE, side="right")))
        if ends[last - 1] - low > PIECE:
            part = code[low : ends[last - 1]].tobytes()
            found[done] = zlib.crc32(part) | zlib.adler32(part) << 32
        else:
            window = code[low : ends[last - 1]]
            total = np.zeros(window.size + 1, dtype=np.uint64)
            np.cumsum((window + np.uint64(1)) * power[: window.size], out=total[1:])
            a, b = starts[done:last] - low, ends[done:last] - low
            found[done:last] = mixed((total[b] - total[a]) * inverse[a] + (b - a).astype(np.uint64))
        done = last
    return found


def encode(
    df: DataFrame,
    model: str,
    key: str = "doc_id",
    text: str = "text",
    samples: int = SAMPLES,
    with_ids: bool = True,
) -> DataFrame:
    """One row per row of ``df`` and sampled segmentation.

    ``key``, sample (from 1), n_pieces, log_prob, perturbed, inclusion, ids_crc32 (of
    unsigned 32-bit ids), round_trip (decoding gives the text), and ``ids`` if asked for.
    ``model`` is the path of the SentencePiece model on the executors.
    """
    slim = df.select(
        df[key].alias(key),
        F.xxhash64(df[key]).alias("__seed"),
        F.coalesce(df[text], F.lit("")).alias("__text"),
    )
    columns = {
        "sample": (pa.int32(), T.IntegerType()),
        "n_pieces": (pa.int64(), T.LongType()),
        "log_prob": (pa.float64(), T.DoubleType()),
        "perturbed": (pa.float64(), T.DoubleType()),
        "inclusion": (pa.float64(), T.DoubleType()),
        "ids_crc32": (pa.int64(), T.LongType()),
        "round_trip": (pa.bool_(), T.BooleanType()),
    }
    if with_ids:
        columns["ids"] = (pa.list_(pa.int32()), T.ArrayType(T.IntegerType()))
    added = [T.StructField(name, kind) for name, (_, kind) in columns.items()]
    schema = T.StructType([slim.schema[key], *added])

    def rows_of(search: Search, whole: str, vocabulary: Vocabulary) -> Iterator[tuple]:
        if not search.paths:
            yield (1, 0, 0.0, 0.0, 1.0, 0, True, np.zeros(0, dtype=np.int32))
            return
        over, spelt = search.best()[0], b" " + whole.encode("utf-8", "surrogatepass")
        for n in range(min(samples, len(search.paths))):
            log, value = search.paths[n][4:6]
            score = 1.0 if over == _NEVER else -math.expm1(-math.exp(min(700.0, log - over)))
            ids = search.ids(n, vocabulary)
            yield (
                n + 1,
                ids.size,
                log,
                value,
                score,
                zlib.crc32(ids.astype("<u4").tobytes()),
                vocabulary.spelling(ids) == spelt,
                ids if with_ids else None,
            )

    def sampled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary, kept = Vocabulary(model), Kept()
        for batch in batches:
            start = 0
            while start < batch.num_rows:
                texts, seeds, chars = [], [], 0
                while start + len(texts) < batch.num_rows and chars < BATCH_CHARS:
                    at = start + len(texts)
                    texts.append(batch.column(2)[at].as_py())
                    seeds.append(batch.column(1)[at].as_py())
                    chars += len(texts[-1])
                rows, owner = [], []
                for d, search in enumerate(sample(texts, seeds, vocabulary, samples, kept)):
                    own = list(rows_of(search, texts[d], vocabulary))
                    rows += own
                    owner += [start + d] * len(own)
                ids = batch.column(0).take(pa.array(owner, pa.int64()))
                *parts, listed = zip(*rows, strict=True)
                arrays = [pa.array(p, t) for p, (t, _) in zip(parts, columns.values(), strict=False)]
                if with_ids:
                    upto = np.cumsum([0, *map(len, listed)])
                    arrays.append(pa.ListArray.from_arrays(pa.array(upto, pa.int32()), np.concatenate(listed)))
                yield pa.RecordBatch.from_arrays([ids, *arrays], names=[key, *columns])
                start += len(texts)

    return slim.mapInArrow(sampled, schema)


def decode(df: DataFrame, model: str, ids: str = "ids", name: str = "decoded") -> DataFrame:
    """``df`` with the text of its piece ids in column ``name``; null ids give null."""
    @F.pandas_udf("string")
    def decoded(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        vocabulary = Vocabulary(model)
        for batch in batches:
            found = [None if x is None else vocabulary.decode(x) for x in batch]
            yield pd.Series(found, dtype=object)

    return df.withColumn(name, decoded(ids))

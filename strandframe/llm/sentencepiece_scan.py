"""SentencePiece encoding and decoding by a max-plus scan over boundary states.

A segmentation is a path of pieces whose score is the sum of the weights of its steps. For a
unigram model the weight of a step is the piece's score. For a model of merges it is 0 where the
pair of neighbouring pieces is what the merges leave of the two, else minus infinity; such a
segmentation is unique and is the one that the merges give. So both kinds share one scan.

Long documents are split into chunks at fixed places, also inside words. The state at a boundary
is the piece that touches or crosses it and how far it reaches (for a unigram model the reach
alone). Each chunk yields its transfer matrix between the states of its two boundaries, matrices
of a document are multiplied in the max-plus sense, which is associative, and with the states so
fixed every chunk is traced back on its own. Where no piece goes on behind a word's end, paths of
all entries meet there.

Null gives null ids, an empty text none. Repeated rows get equal ids. ``U+2581`` stands for a
blank, so it is decoded as one, as in the library of that name; all other texts come back exactly.
"""

from __future__ import annotations

import re
import struct
from array import array
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import scratch_path
from .text import _BASE, _INVERSE, _power, member, mix, replace_names, slices

BLANK = "▁"
CHUNK = 32_768
GROUP = 64
TRACED = 8
CACHE = 50_000
PAIR_BITS = 20
TOGETHER = 64
UNIGRAM, MERGES = 1, 2
NORMAL, UNKNOWN, BYTE = 1, 2, 6
NO = float("-inf")
LETTER = np.array([chr(c).isalpha() for c in range(0x110000)])


def _fields(raw: bytes) -> Iterator[tuple[int, object]]:
    """Fields of a serialised message: number and integer, bytes or float."""
    at = 0

    def number() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = raw[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(raw):
        key = number()
        kind = key & 7
        if kind == 0:
            yield key >> 3, number()
        elif kind == 2:
            size = number()
            yield key >> 3, raw[at : at + size]
            at += size
        else:
            width = 4 if kind == 5 else 8
            yield key >> 3, struct.unpack("<f" if kind == 5 else "<d", raw[at : at + width])[0]
            at += width


@dataclass
class Pieces:
    """What the scan needs of a model file."""

    strings: list[str]
    scores: list[float]
    kinds: list[int]
    merges: bool
    dummy: bool = True
    numbers: dict[str, int] = field(default_factory=dict)
    width: int = 1
    splits: bool = True
    unknown: int = 0
    begins: set[str] = field(default_factory=set)
    inside: set[str] = field(default_factory=set)
    bytes_from: dict[int, int] = field(default_factory=dict)
    table: Table | None = None
    right: dict[str, list[tuple[str, float]]] = field(default_factory=dict)
    left: dict[str, list[tuple[str, float]]] = field(default_factory=dict)
    ordered: bool = True

    @classmethod
    def read(cls, path: str, kind: int | None = None) -> Pieces:
        """``kind`` overrides the file's own (unigram or merges)."""
        with open(path, "rb") as f:
            raw = f.read()
        strings, scores, kinds, own, dummy = [], [], [], UNIGRAM, True
        for name, value in _fields(raw):
            if name == 1:
                piece = dict(_fields(value))
                strings.append(piece[1].decode())
                scores.append(float(piece.get(2, 0.0)))
                kinds.append(int(piece.get(3, NORMAL)))
            elif name == 2:
                own = int(dict(_fields(value)).get(3, own))
            elif name == 3:
                dummy = bool(dict(_fields(value)).get(3, 1))
        out = cls(strings, scores, kinds, (kind or own) == MERGES, dummy)
        out.numbers = {s: i for i, (s, k) in enumerate(zip(strings, kinds)) if k == NORMAL}
        if out.merges:
            _grow_spines(out)
        out.width = max(map(len, out.numbers), default=1)
        out.begins = {s[:k] for s in out.numbers for k in range(1, len(s) + 1)}
        out.inside = {s[k - 1 : k + 1] for s in out.numbers for k in range(1, len(s))}
        out.table = Table(out.numbers, out.begins)
        out.splits = not any(BLANK in s.lstrip(BLANK) for s in out.numbers)
        out.unknown = kinds.index(UNKNOWN) if UNKNOWN in kinds else 0
        out.bytes_from = {int(s[3:5], 16): i for i, (s, k) in enumerate(zip(strings, kinds)) if k == BYTE}
        return out


PLAIN = float("inf")


def last_pair(text: str, numbers: dict[str, int], scores: list[float]) -> list[str]:
    """The two parts that the merges of ``text`` join last; one or more than two parts if they do not give it."""
    parts = before = list(text)
    while len(parts) > 1:
        options = [(-scores[i], k) for k in range(len(parts) - 1) if (i := numbers.get(parts[k] + parts[k + 1])) is not None]
        if not options:
            return parts
        before, k = parts, min(options)[1]
        parts = [*parts[:k], parts[k] + parts[k + 1], *parts[k + 2 :]]
    return before


def merge(text: str, numbers: dict[str, int], scores: list[float]) -> list[str]:
    """Join the neighbours that form the best piece, the leftmost of equals, until none do."""
    parts = list(text)
    while len(parts) > 1:
        options = [(-scores[i], k) for k in range(len(parts) - 1) if (i := numbers.get(parts[k] + parts[k + 1])) is not None]
        if not options:
            break
        k = min(options)[1]
        parts[k : k + 2] = [parts[k] + parts[k + 1]]
    return parts


def _grow_spines(model: Pieces) -> None:
    """For each piece what stands at its right (and left) end while it is merged, and the rank at
    which that is taken up. A piece that its own merges do not give never occurs and is left out."""
    split = {s: last_pair(s, model.numbers, model.scores) for s in model.numbers}
    model.numbers = {s: i for s, i in model.numbers.items() if len(split[s]) == min(2, len(s))}
    rank = {s: -model.scores[i] for s, i in model.numbers.items()}
    worst = max(rank.values(), default=0.0)
    for s in sorted(model.numbers, key=len):
        for own, end in ((model.right, -1), (model.left, 0)):
            below = own.get(split[s][end], [(split[s][end], PLAIN)]) if len(s) > 1 else []
            own[s] = [*below[:-1], *([(below[-1][0], rank[s])] if below else []), (s, PLAIN)]
        # do the parts always come before the whole?
        model.ordered &= all(rank.get(x, -PLAIN) < rank[s] for x in split[s] if len(x) > 1) or rank[s] == worst


def prefix_hash(codes: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        total = np.zeros(len(codes) + 1, np.uint64)
        np.cumsum(mix(codes.astype(np.uint64) + np.uint64(1)) * _power(_BASE, len(codes)), out=total[1:])
        return total


def span_hash(total: np.ndarray, first: np.ndarray, end: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return mix((total[end] - total[first]) * _power(_INVERSE, len(total))[first] + (end - first).astype(np.uint64))


class Table:
    """Pieces and their beginnings by hash: number (or -1), and whether longer pieces begin so."""

    def __init__(self, numbers: dict[str, int], begins: set[str]) -> None:
        strings = sorted(begins)
        codes = np.frombuffer("".join(strings).encode("utf-32-le", "surrogatepass"), np.uint32)
        ends = np.cumsum([len(s) for s in strings])
        starts = np.concatenate([[0], ends[:-1]]).astype(np.int64) if strings else np.zeros(0, np.int64)
        keys = span_hash(prefix_hash(codes), starts, ends.astype(np.int64)) if strings else np.zeros(0, np.uint64)
        number = np.array([numbers.get(s, -1) for s in strings], np.int32)
        longer = {s[:-1] for s in strings if len(s) > 1}
        on = np.array([s in longer for s in strings], bool)
        # open addressing: each round places the keys that found their slot free
        bits = max(4, int(np.ceil(np.log2(len(strings) + 1))) + 3)
        self.bits, self.key = bits, np.zeros(1 << bits, np.uint64)
        self.number, self.on = np.full(1 << bits, -1, np.int32), np.zeros(1 << bits, bool)
        todo, shift = np.arange(len(strings)), 0
        while len(todo):
            slot = self._slot(keys[todo], shift)
            free = self.key[slot] == 0
            _, one = np.unique(slot[free], return_index=True)
            here = todo[free][one]
            at = self._slot(keys[here], shift)
            self.key[at], self.number[at], self.on[at] = keys[here], number[here], on[here]
            todo = np.setdiff1d(todo, here)
            shift += 1
        self.probes = max(1, shift)

    def _slot(self, keys: np.ndarray, shift: int) -> np.ndarray:
        return ((keys >> np.uint64(64 - self.bits)).astype(np.int64) + shift * 7) & ((1 << self.bits) - 1)

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        number, on = np.full(len(keys), -1, np.int32), np.zeros(len(keys), bool)
        open_ = np.arange(len(keys))
        for shift in range(self.probes):
            slot = self._slot(keys[open_], shift)
            held = self.key[slot]
            same = held == keys[open_]
            at = open_[same]
            number[at], on[at] = self.number[slot[same]], self.on[slot[same]]
            open_ = open_[~same & (held != 0)]
            if not len(open_):
                break
        return number, on


class Scan:
    """Segmentations of one model; the caches are bounded."""

    def __init__(self, model: Pieces) -> None:
        self.model = model
        self.joins: dict[tuple[str, str], bool] = {}
        self.words: dict[str, bytes] = {}
        self.pair_key = np.full(1 << PAIR_BITS, -1, np.int64)
        self.pair_value = np.zeros(1 << PAIR_BITS, bool)
        self.floor = min(model.scores, default=0.0) - 10.0
        self.pairs = np.array(sorted(ord(x[0]) << 21 | ord(x[1]) for x in model.inside), np.int64)

    def fits(self, left: str | None, right: str) -> bool:
        """Do the merges leave these two neighbours apart?"""
        if left is None or not self.model.merges:
            return True
        key = (left, right)
        known = self.joins.get(key)
        if known is None:
            if len(self.joins) > CACHE // 4:
                self.joins.clear()
            known = self.joins[key] = self._apart(left, right)
        return known

    def _apart(self, left: str, right: str) -> bool:
        """Follow what stands at the common border, by rank: would a merge across it come first?"""
        model = self.model
        if model.ordered and left in model.right and right in model.left:
            a, b, i, j = model.right[left], model.left[right], 0, 0
            while True:
                (x, until), (y, other) = a[i], b[j]
                number = model.numbers.get(x + y)
                rank = PLAIN if number is None else -model.scores[number]
                first = min(until, other)
                if rank < first:
                    return False
                if first == PLAIN:
                    return True
                if rank == first or until == other:
                    break  # of equal ranks the place decides
                if until < other:
                    i += 1
                else:
                    j += 1
        return merge(left + right, model.numbers, model.scores) == [left, right]

    def run(self, text: str, first: int, before: str | None, starts_to: int, stop: int, meet: dict | None = None) -> tuple[dict[int, tuple[float, str | None, int]], int]:
        """Best paths from ``first``, where ``before`` ended, over pieces that start before ``starts_to``.

        Returns for each place (score, piece that ends there, where it began), and the place from
        which on the paths are those of ``meet``, or -1. Of equal scores the earlier start wins.
        """
        numbers, scores, merges, width = self.model.numbers, self.model.scores, self.model.merges, self.model.width
        best: dict[int, tuple[float, str | None, int]] = {first: (0.0, before, -1)}
        same = 0
        for p in range(first + 1, stop + 1):
            top = None
            for q in range(max(first, p - width), p):
                if q >= starts_to:
                    break
                came = best.get(q)
                if came is None:
                    continue
                piece = text[q:p]
                number = numbers.get(piece)
                if number is None:
                    if p - q > 1 or piece in numbers:
                        continue
                    weight = 0.0 if merges else self.floor
                elif merges:
                    if not self.fits(came[1], piece):
                        continue
                    weight = 0.0
                else:
                    weight = scores[number]
                if top is None or came[0] + weight > top[0]:
                    top = (came[0] + weight, piece, q)
                    if merges:
                        break
            if top is not None:
                best[p] = top
            if meet is not None:
                other = meet.get(p)
                same = same + 1 if (top is None) == (other is None) and (top is None or top[1:] == other[1:] and top[2] >= first) else 0
                if same > width and top is not None and (merges or self._level(best, meet, p, width)):
                    return best, p
        return best, -1

    @staticmethod
    def _level(best: dict, meet: dict, p: int, width: int) -> bool:
        """Are the scores of the last places apart by one constant?"""
        gaps = {round(best[k][0] - meet[k][0], 6) for k in range(p - width, p + 1) if k in best and k in meet}
        return len(gaps) == 1

    @staticmethod
    def trace(best: dict, at: int) -> list[str]:
        out = []
        while best[at][2] >= 0:
            out.append(best[at][1])
            at = best[at][2]
        return out[::-1]

    def ids(self, pieces: list[str]) -> list[int]:
        out = []
        for piece in pieces:
            number = self.model.numbers.get(piece)
            if number is not None:
                out.append(number)
            elif self.model.bytes_from:
                out += [self.model.bytes_from[b] for b in piece.encode()]
            else:
                out.append(self.model.unknown)
        return out

    def learn(self, units: list[str]) -> None:
        """Add units to the cache, the short ones of a model of merges together."""
        words = self.words
        alone = units
        if self.model.merges:
            short = [x for x in units if len(x) <= TOGETHER]
            alone = [x for x in units if len(x) > TOGETHER] if len(short) < len(units) else []
            for first in range(0, len(short), 50_000):
                self.only_paths(short[first : first + 50_000])
        for unit in alone:
            words[unit] = array("i", self.only_path(unit) if self.model.merges else self.best_path(unit)).tobytes()

    def only_paths(self, units: list[str]) -> None:
        """The max-plus step over many words at once: from each place on, pieces of growing length
        are set where they end if the pair with the piece before has weight 0."""
        units.sort(key=len, reverse=True)
        lengths = np.array([len(u) for u in units])
        codes = np.frombuffer("".join(units).encode("utf-32-le", "surrogatepass"), np.uint32)
        starts = np.cumsum(lengths) - lengths
        total = prefix_hash(codes)
        size = int(lengths[0])
        last = np.full((size + 1, len(units)), -2, np.int32)
        back = np.zeros((size + 1, len(units)), np.int8)
        last[0] = -1
        live = len(lengths) - np.searchsorted(lengths[::-1], np.arange(size + 1), "right")
        for q in range(size):
            active = np.arange(live[q])
            for n in range(1, min(self.model.width, size - q) + 1):
                active = active[: np.searchsorted(active, live[q + n - 1])]
                if not len(active):
                    break
                at = starts[active] + q
                number, goes_on = self.model.table.find(span_hash(total, at, at + n))
                hit = np.flatnonzero(number >= 0)
                if len(hit):
                    rows = active[hit]
                    fits = self.pair_fits(last[q, rows], number[hit])
                    rows, kept = rows[fits], number[hit][fits]
                    last[q + n, rows] = kept
                    back[q + n, rows] = q
                if n == 1:  # a character without a piece
                    rows = active[number < 0]
                    last[1 + q, rows] = -1
                    back[1 + q, rows] = q
                active = active[goes_on]
        rows, place = np.arange(len(units)), lengths.copy()
        steps = []
        while len(rows):
            steps.append((rows, last[place[rows], rows]))
            place[rows] = back[place[rows], rows]
            rows = rows[place[rows] > 0]
        owner, number = np.concatenate([x[0] for x in steps]), np.concatenate([x[1] for x in steps])
        order = np.argsort(owner, kind="stable")  # each word's pieces from its end
        raw = number[order][::-1].tobytes()
        ends = np.cumsum(np.bincount(owner, minlength=len(units))[::-1] * 4).tolist()
        first = 0
        for unit, end in zip(reversed(units), ends):
            self.words[unit] = raw[first:end]
            first = end
        for k in np.unique(owner[number < 0]).tolist():  # with a character that has no piece
            self.words[units[k]] = array("i", self.only_path(units[k])).tobytes()

    @staticmethod
    def _slots(key: np.ndarray) -> np.ndarray:
        return ((key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - PAIR_BITS)).astype(np.int64)

    def pair_fits(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """``fits`` for many pairs, from a table whose places newer pairs take over."""
        key = left.astype(np.int64) << 20 | right
        place = self._slots(key)
        out = self.pair_value[place]
        new = np.flatnonzero((self.pair_key[place] != key) & (left >= 0))
        if len(new):
            strings = self.model.strings
            fresh, back = np.unique(key[new], return_inverse=True)
            values = np.array([self._apart(strings[k >> 20], strings[k & 0xFFFFF]) for k in fresh.tolist()])
            out[new] = values[back]
            place = self._slots(fresh)
            self.pair_key[place], self.pair_value[place] = fresh, values
        out[left < 0] = True
        return out

    def best_path(self, unit: str) -> list[int]:
        best, _ = self.run(unit, 0, None, len(unit), len(unit))
        return self.ids(self.trace(best, len(unit)))

    def only_path(self, unit: str) -> list[int]:
        """With weights of 0 and minus infinity the one finite path is searched from the left, long pieces first."""
        get, begins, strings = self.model.numbers.get, self.model.begins, self.model.strings
        size, place, left = len(unit), 0, -1
        path: list[tuple[int, int, list]] = []  # place, piece before it, options left there
        failed: set[tuple[int, int]] = set()
        options = None
        while place < size:
            if options is None:
                options = []
                end = place + 1
                piece = unit[place:end]
                while piece in begins:
                    number = get(piece)
                    if number is not None:
                        options.append((number, end))
                    end += 1
                    if end > size:
                        break
                    piece = unit[place:end]
                if not options or options[0][1] > place + 1:
                    options.insert(0, (-1, place + 1))  # a character without a piece
            while options:
                number, end = options.pop()
                if left >= 0 and number >= 0 and not self.fits(strings[left], strings[number]):
                    continue
                if failed and (end, number) in failed:
                    continue
                path.append((place, left, options))
                place, left, options = end, number, None
                break
            else:
                failed.add((place, left))
                place, left, options = path.pop()
        edges = [x[0] for x in path] + [size]
        ids = [x[1] for x in path[1:]] + [left]
        if -1 in ids:
            return self.ids([unit[a:b] for a, b in zip(edges, edges[1:])])
        return ids

    def encode_all(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of some texts."""
        return self.encode_units([self.normal(t) for t in texts])

    def encode_units(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of texts that begin and end where words do; units that are not in the cache are learnt together.

        A text falls apart wherever no piece has the two characters side by side; between two letters that is not asked.
        """
        joined = "".join(texts)
        codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
        edges = np.cumsum([0, *map(len, texts)])
        apart = np.zeros(len(codes) + 1, bool)
        apart[edges] = True
        letter = LETTER[codes]
        at = np.flatnonzero(~(letter[:-1] & letter[1:])) + 1
        pair = codes[at - 1].astype(np.int64) << 21 | codes[at]
        apart[at[~member(self.pairs, pair)[1]]] = True
        cuts = np.flatnonzero(apart)
        places = cuts.tolist()
        units = [joined[a:b] for a, b in zip(places, places[1:])]
        distinct = set(units)
        new = distinct - self.words.keys()
        if len(self.words) + len(new) > CACHE:
            self.words.clear()
            new = distinct
        self.learn(list(new))
        get = self.words.__getitem__
        first = np.searchsorted(cuts, edges).tolist()
        out = [np.frombuffer(b"".join(map(get, units[a:b])), np.int32) for a, b in zip(first, first[1:])]
        if len(cuts) > 1 and np.diff(cuts).max() > TOGETHER:
            for unit in new:
                if len(unit) > TOGETHER:  # long ones would fill the cache
                    del self.words[unit]
        return out

    def normal(self, text: str) -> str:
        return (BLANK if self.model.dummy and text else "") + text.replace(" ", BLANK)

    def encode(self, text: str) -> list[int]:
        return self.encode_all([text])[0].tolist()

    def decode(self, ids) -> str:
        """Pieces joined, blanks back, the blank that encoding put in front removed."""
        model = self.model
        raw = b"".join(bytes([int(model.strings[i][3:5], 16)]) if model.kinds[i] == BYTE else model.strings[i].encode() if model.kinds[i] == NORMAL else b"" for i in ids)
        text = raw.decode("utf-8", "replace").replace(BLANK, " ")
        return text[1:] if model.dummy and text[:1] == " " else text

    # states at boundaries: (reach behind the boundary, piece); a unigram model needs no piece

    def entries(self, text: str, at: int) -> list[tuple[int, str | None]]:
        """States that may hold at place ``at`` of ``text``."""
        width, out = self.model.width, set()
        for q in range(max(0, at - width), at):
            for p in range(at, min(len(text), q + width) + 1):
                piece = text[q:p]
                if piece in self.model.numbers or len(piece) == 1:
                    out.add((p - at, piece if self.model.merges else None))
        return sorted(out, key=lambda x: (x[0], x[1] or ""))

    def ends(self, text: str, first: int, last: int) -> list[int]:
        """Places in the chunk where a word ends, so that no piece crosses."""
        if not self.model.splits:
            return []
        return [m.start() for m in re.finditer(f"(?<=[^{BLANK}]){BLANK}", text[:last]) if m.start() > first]

    def matrix(self, text: str, first: int, last: int, begins: bool) -> list[tuple[int, str | None, int, str | None, float]]:
        """Transfer of the chunk ``text[first:last]`` with some text around it: (reach, piece, reach, piece, score)."""
        starts = [(0, None)] if begins else self.entries(text, first)
        places = self.ends(text, first + self.model.width, last)
        stop = min(len(text), last + self.model.width)
        out = []
        if places:
            lead = {s: r[0].get(places[0]) for s in starts if (r := self.run(text, first + s[0], s[1], places[0], places[0]))}
            inner = 0.0
            if not self.model.merges:
                inner = self.run(text, places[0], None, places[-1], places[-1])[0][places[-1]][0] if len(places) > 1 else 0.0
            tail, _ = self.run(text, places[-1], None, last, stop)
            leave = self._exits(tail, last, stop)
            return [(*s, e, x, lead[s][0] + inner + w) for s in starts if lead[s] is not None for e, x, w in leave]
        meet = None
        for s in starts:
            if first + s[0] >= last:  # the piece before reaches over the whole rest
                out.append((*s, first + s[0] - last, s[1], 0.0))
                continue
            best, joined = self.run(text, first + s[0], s[1], last, stop, meet)
            if joined >= 0:
                shift = best[joined][0] - meet[joined][0]
                best = {**best, **{p: (w + shift, x, q) for p, (w, x, q) in meet.items() if p > joined}}
            elif meet is None and any(p >= last for p in best):
                meet = best
            out += [(*s, e, x, w) for e, x, w in self._exits(best, last, stop)]
        return out

    def _exits(self, best: dict, last: int, stop: int) -> list[tuple[int, str | None, float]]:
        return [(p - last, best[p][1] if self.model.merges else None, best[p][0]) for p in range(last, stop + 1) if p in best and best[p][2] >= 0]

    def chunk_parts(self, text: str, first: int, last: int, state: tuple[int, str | None], leave: tuple[int, str | None]) -> tuple[list[int], str, list[int]]:
        """Ids of the words at both edges of a chunk between its fixed states, and the text of those between.

        Where words end no piece crosses, so only the words at the edges have to be walked.
        """
        start, end = first + state[0], last + leave[0]
        if start >= last:
            return [], "", []

        def walk(begin: int, before: str | None, upto: int, stop: int) -> list[int]:
            best, _ = self.run(text, begin, before, upto, stop)
            return self.ids(self.trace(best, stop))

        places = self.ends(text, first + self.model.width, last)
        if not places:
            return walk(start, state[1], last, end), "", []
        return walk(start, state[1], places[0], places[0]), text[places[0] : places[-1]], walk(places[-1], None, last, end)

    def chunks_ids(self, chunks: list[tuple]) -> list[np.ndarray]:
        """Trace chunks back, each alone between its fixed states: the pieces that begin in it."""
        parts = [self.chunk_parts(*x) for x in chunks]
        between = self.encode_units([x[1] for x in parts])
        return [np.concatenate([np.array(a, np.int32), m, np.array(b, np.int32)]) for (a, _, b), m in zip(parts, between)]

    def chunk_ids(self, *chunk) -> np.ndarray:
        return self.chunks_ids([chunk])[0]


State = tuple[int, str | None]


def times(a: dict, b: list) -> dict:
    """Max-plus product of ``a`` (state -> {state: score}) with the rows of one more matrix."""
    rows: dict = {}
    for s, sp, e, ep, w in b:
        rows.setdefault((s, sp), []).append(((e, ep), w))
    out: dict = {}
    for start, to in a.items():
        best: dict = {}
        for middle, w in to.items():
            for leave, x in rows.get(middle, ()):
                if w + x > best.get(leave, NO):
                    best[leave] = w + x
        if best:
            out[start] = best
    return out


def product(matrices: list[list]) -> list:
    """The matrix of several neighbouring chunks."""
    out = {(s, sp): {(s, sp): 0.0} for s, sp, *_ in matrices[0]}
    for m in matrices:
        out = times(out, m)
    return [(*a, *b, w) for a, to in out.items() for b, w in to.items()]


def boundary_states(matrices: list[list], begin: State = (0, None), leave: State | None = None) -> list[State]:
    """The best path's state at each boundary: products from the left, then back from the end.

    ``leave`` is the state at the end where it is known; else the text ends there.
    """
    products = [{begin: {begin: 0.0}}]
    for m in matrices:
        products.append(times(products[-1], m))
    if leave is None:
        leave = max(((w, -s[0], s[1] or "", s) for s, w in products[-1][begin].items() if s[0] == 0))[3]
    states = [leave]
    for m, before in zip(reversed(matrices), reversed(products[:-1])):
        options = [(before[begin][(s, sp)] + w, -s, sp or "", (s, sp)) for s, sp, e, ep, w in m if (e, ep) == states[-1] and (s, sp) in before[begin]]
        states.append(max(options)[3])
    return states[::-1]


_scans: dict[int, Scan] = {}


def _scan(shared) -> Scan:
    """One scan, with its caches, for each worker process and model."""
    if id(shared.value) not in _scans:
        _scans.clear()
        _scans[id(shared.value)] = Scan(shared.value)
    return _scans[id(shared.value)]


def _groups(column: pa.Array) -> Iterator[tuple[int, int]]:
    """Rows in groups of about a megabyte of text; what a group took is given back."""
    for first, end, _ in slices(column, 1 << 20):
        yield first, end
        pa.default_memory_pool().release_unused()


CELL = "struct<s:int,sp:string,e:int,ep:string,w:double>"


def encode(docs: DataFrame, model: Pieces, column: str = "text", chunk: int = CHUNK) -> DataFrame:
    """Adds ``ids``: the piece numbers of each text."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(model)  # as large as the model file
    frame = replace_names(docs, ["ids", "_row"])
    kept = frame.columns
    short = frame.filter(F.col(column).isNull() | (F.length(column) <= chunk))
    schema = short.withColumn("ids", F.lit(None).cast("array<int>")).schema

    def plain(batches):
        scan = _scan(shared)
        for batch in batches:
            at = batch.schema.get_field_index(column)
            for first, end in _groups(batch.column(at)):
                part = batch.slice(first, end - first)
                texts = part.column(at).to_pylist()
                ids = scan.encode_all([t or "" for t in texts])
                offsets = np.cumsum([0, *map(len, ids)])
                made = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(np.concatenate(ids)), mask=pa.array([t is None for t in texts]))
                yield pa.RecordBatch.from_arrays([*part.columns, made], names=schema.names)

    long = frame.filter(F.length(column) > chunk)
    return short.mapInArrow(plain, schema).unionByName(_encode_long(long, shared, model, column, chunk, kept))


def _cells(column: pa.Array) -> list[list]:
    """Per row its matrices, in order of their numbers."""
    return [[[tuple(c.values()) for c in x["cells"]] for x in row] for row in column.to_pylist()]


CELLS = pa.list_(pa.struct([("s", pa.int32()), ("sp", pa.string()), ("e", pa.int32()), ("ep", pa.string()), ("w", pa.float64())]))
EDGES = "s int, sp string, e int, ep string"


def _cell_array(matrices: list[list]) -> pa.Array:
    return pa.array([[dict(zip(("s", "sp", "e", "ep", "w"), c)) for c in m] for m in matrices], CELLS)


def _edge_arrays(path: list[State]) -> list[pa.Array]:
    """Both states of each chunk along a path."""
    return [pa.array([x[i] for x in part], t) for part in (path[:-1], path[1:]) for i, t in enumerate((pa.int32(), pa.string()))]


def _encode_long(long: DataFrame, shared, model: Pieces, column: str, chunk: int, kept: list[str]) -> DataFrame:
    """Texts of several chunks. A text is known by its hash, so copies are encoded once and no text is stored.

    Matrices are multiplied in groups of ``GROUP`` chunks, then the products of a text; the states between the
    groups are handed down to them, and those between their chunks to the chunks.
    """
    width = model.width
    body = F.concat(F.lit(BLANK if model.dummy else ""), F.replace(F.col(column), F.lit(" "), F.lit(BLANK)))
    size = F.length("_body")
    text_key = F.unhex(F.sha2(F.col(column).cast("binary"), 256))
    cut = long.select(text_key.alias("_row"), body.alias("_body")).withColumn("_n", F.ceil(size / chunk).cast("int"))
    cut = cut.select("_row", "_n", "_body", F.explode(F.sequence(F.lit(0), F.col("_n") - 1)).alias("_k"))
    lead = F.least(F.col("_k") * chunk, F.lit(width))
    # a chunk is a second's work and few bytes, so tasks are not merged by their bytes
    tasks = int(long.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    pieces = cut.select(
        "_row", "_k", lead.alias("_first"), F.least(F.lit(chunk), size - F.col("_k") * chunk).alias("_size"),
        F.substring(F.col("_body"), F.col("_k") * chunk - lead + 1, lead + chunk + width).alias("_part"),
    ).repartition(tasks, "_row", "_k").dropDuplicates(["_row", "_k"])

    def matrices(batches):
        scan = _scan(shared)
        for batch in batches:
            for i, (k, first, length, part) in enumerate(zip(*(c.to_pylist() for c in batch.columns[1:]))):
                cells = _cell_array([scan.matrix(part, first, first + length, k == 0)])
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, 1), batch.column(1).slice(i, 1), cells], names=["_row", "_k", "cells"])

    # a few numbers for each chunk, which two steps read
    path = scratch_path(long.sparkSession, "matrices")
    pieces.mapInArrow(matrices, f"_row binary, _k int, cells array<{CELL}>").write.parquet(path)
    each = long.sparkSession.read.parquet(path)
    ordered = F.array_sort(F.collect_list(F.struct("_k", "cells"))).alias("all")
    groups = each.groupBy("_row", F.floor(F.col("_k") / GROUP).cast("int").alias("_g")).agg(ordered)

    def products(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], _cell_array([product(x) for x in _cells(batch.column(2))])], names=["_row", "_k", "cells"])

    whole = groups.mapInArrow(products, f"_row binary, _k int, cells array<{CELL}>").groupBy("_row").agg(ordered)

    def outer(batches):
        for batch in batches:
            for i, chunks in enumerate(_cells(batch.column(1))):
                path = boundary_states(chunks)
                rows = batch.column(0).take(pa.array([i] * len(chunks)))
                yield pa.RecordBatch.from_arrays([rows, pa.array(range(len(chunks)), pa.int32()), *_edge_arrays(path)], names=["_row", "_g", "s", "sp", "e", "ep"])

    between = whole.mapInArrow(outer, f"_row binary, _g int, {EDGES}")

    def inner(batches):
        for batch in batches:
            col = {n: batch.column(i) for i, n in enumerate(batch.schema.names)}
            for i, (g, chunks, s, sp, e, ep) in enumerate(zip(col["_g"].to_pylist(), _cells(col["all"]), *(col[c].to_pylist() for c in ("s", "sp", "e", "ep")))):
                path = boundary_states(chunks, (s, sp), (e, ep))
                n = len(chunks)
                yield pa.RecordBatch.from_arrays(
                    [col["_row"].take(pa.array([i] * n)), pa.array(range(g * GROUP, g * GROUP + n), pa.int32()), *_edge_arrays(path)], names=["_row", "_k", "s", "sp", "e", "ep"])

    fixed = groups.join(between, ["_row", "_g"]).select("_row", "_g", "all", "s", "sp", "e", "ep").mapInArrow(inner, f"_row binary, _k int, {EDGES}")

    def traced(batches):
        scan = _scan(shared)
        for batch in batches:
            # some chunks at a time, so that their new words are learnt together
            for first in range(0, batch.num_rows, TRACED):
                rows = batch.slice(first, TRACED)
                _, at, size, part, s, sp, e, ep = (c.to_pylist() for c in rows.columns[1:])
                ids = scan.chunks_ids([(p, a, a + n, (x, xp), (y, yp)) for p, a, n, x, xp, y, yp in zip(part, at, size, s, sp, e, ep)])
                offsets = pa.array(np.cumsum([0, *map(len, ids)]), pa.int32())
                made = pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(ids), pa.int32()))
                yield pa.RecordBatch.from_arrays([rows.column(0), rows.column(1), made], names=["_row", "_k", "ids"])
                pa.default_memory_pool().release_unused()

    made = pieces.join(fixed, ["_row", "_k"]).select("_row", "_k", "_first", "_size", "_part", "s", "sp", "e", "ep").mapInArrow(traced, "_row binary, _k int, ids array<int>")
    found = made.groupBy("_row").agg(F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("_k", "ids"))), lambda x: x["ids"])).alias("ids"))
    return long.join(found, text_key == F.col("_row")).select(*kept, "ids")


def decode(tokens: DataFrame, model: Pieces, column: str = "ids") -> DataFrame:
    """Adds ``decoded``, the text of the ids."""
    shared = tokens.sparkSession.sparkContext.broadcast(model)
    frame = replace_names(tokens, ["decoded"])
    schema = frame.withColumn("decoded", F.lit(None).cast("string")).schema

    def run(batches):
        held = shared.value
        raw = [bytes([int(s[3:5], 16)]) if k == BYTE else s.replace(BLANK, " ").encode() if k == NORMAL else b"" for s, k in zip(held.strings, held.kinds)]
        size = np.array([len(x) for x in raw], np.int64)
        start, table = np.cumsum(size) - size, np.frombuffer(b"".join(raw), np.uint8)
        for batch in batches:
            at = batch.schema.get_field_index(column)
            for first in range(0, batch.num_rows, 256):
                part = batch.slice(first, 256)
                ids = part.column(at).flatten().to_numpy(zero_copy_only=False)
                known = part.column(at).is_valid().to_numpy(zero_copy_only=False)
                count = pc.fill_null(pc.list_value_length(part.column(at)), 0).to_numpy(zero_copy_only=False)
                # the bytes of all pieces, one after the other
                length = size[ids]
                ends = np.cumsum(length)
                data = table[np.repeat(start[ids] - ends + length, length) + np.arange(int(length.sum()))].tobytes()
                edges = np.concatenate([[0], ends])[np.cumsum([0, *count])].tolist()
                texts = [data[a:b].decode("utf-8", "replace") if k else None for a, b, k in zip(edges, edges[1:], known)]
                if held.dummy:
                    texts = [t[1:] if t and t[0] == " " else t for t in texts]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(texts, pa.string())], names=schema.names)
                pa.default_memory_pool().release_unused()

    return frame.mapInArrow(run, schema)


def default_model() -> str:
    """Place of the installed public model file."""
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")

"""Benchmark decontamination with a generalised suffix automaton of the test items.

Items and texts are normalised to words. All items of a block go into one suffix automaton over
word numbers; the words of a document are streamed through it and the longest match that ends at
each word is tracked. A word is hit if it lies in an occurrence of a window (``window``
consecutive words of an item, or a whole shorter item). Only stretches in which every short
gram occurs in some item reach the automaton, since any other gram resets it below a window.

The benchmark is read in blocks of at most ``BLOCK_WORDS`` words (a longer item is a block of its
own), so what is broadcast is bounded; each further block is one more pass over the documents,
whose hits so far travel along in a written table.

Null or empty texts have no words and no hits. Null or wordless items match nothing. Rows that
repeat an item id count as one item; a null id is reported as ``null``. Repeated documents get
equal results.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import scratch_path
from .text import ALNUM, LOWER, Texts, annotate, member, replace_names, windows

WINDOW = 10
BLOCK_WORDS = 200_000
#: Limits of a clean document: a hit span of more words is cut out; above this share of hit words the document goes.
MAX_SPAN, MAX_COVERAGE = 0, 0.5
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


class SuffixAutomaton:
    """Of several sequences; ``ends[state]`` lists (window length, item) that end in the state."""

    def __init__(self) -> None:
        self.next: list[dict[int, int]] = [{}]
        self.link = [-1]
        self.length = [0]
        self.ends: dict[int, list[tuple[int, int]]] = {}

    def _split(self, p: int, q: int, symbol: int) -> int:
        """A copy of ``q`` for the shorter strings that come through ``p``."""
        self.next.append(dict(self.next[q]))
        self.link.append(self.link[q])
        self.length.append(self.length[p] + 1)
        copy = len(self.next) - 1
        self.link[q] = copy
        while p >= 0 and self.next[p].get(symbol) == q:
            self.next[p][symbol] = copy
            p = self.link[p]
        return copy

    def add(self, sequence) -> None:
        last = 0
        for symbol in sequence:
            known = self.next[last].get(symbol)
            if known is not None:
                last = known if self.length[known] == self.length[last] + 1 else self._split(last, known, symbol)
                continue
            self.next.append({})
            self.link.append(0)
            self.length.append(self.length[last] + 1)
            new, p = len(self.next) - 1, last
            while p >= 0 and symbol not in self.next[p]:
                self.next[p][symbol] = new
                p = self.link[p]
            if p >= 0:
                q = self.next[p][symbol]
                self.link[new] = q if self.length[q] == self.length[p] + 1 else self._split(p, q, symbol)
            last = new

    def stream(self, symbols):
        """(state, longest match) behind each symbol."""
        state, length = 0, 0
        for symbol in symbols:
            while state and symbol not in self.next[state]:
                state = self.link[state]
                length = self.length[state]
            to = self.next[state].get(symbol)
            if to is None:
                state, length = 0, 0
            else:
                state, length = to, length + 1
            yield state, length

    def windows_at(self, state: int, length: int) -> list[tuple[int, int]]:
        """(window length, item) of all windows that end a match of ``length`` in ``state``."""
        out = []
        while state > 0:
            out += [x for x in self.ends.get(state, ()) if x[0] <= length]
            state = self.link[state]
            length = self.length[state]
        return out


class Matcher:
    """The automaton of a block of items, with the words and short grams that its items have."""

    def __init__(self, items: list[tuple[str, str]], window: int) -> None:
        self.items = [i for i, _ in items]
        part = Texts(np.frombuffer(b"".join(t.encode() for _, t in items), np.uint8), np.cumsum([0, *[len(t.encode()) for _, t in items]]))
        hashes, counts = _words(part)[1:]
        self.vocabulary = np.unique(hashes)
        numbers = np.searchsorted(self.vocabulary, hashes)
        ends = np.cumsum(counts)
        self.automaton = SuffixAutomaton()
        sequences = [numbers[e - c : e].tolist() for e, c in zip(ends, counts)]
        for s in sequences:
            self.automaton.add(s)
        shortest = window
        for item, s in enumerate(sequences):
            size = min(window, len(s))
            shortest = min(shortest, size or shortest)
            for k, (state, length) in enumerate(self.automaton.stream(s)):
                if size and k + 1 >= size:
                    below = self.automaton.link[state]
                    while self.automaton.length[below] >= size:
                        state, below = below, self.automaton.link[below]
                    entry = (size, item)
                    here = self.automaton.ends.setdefault(state, [])
                    if entry not in here:
                        here.append(entry)
        self.shortest = shortest
        self.gram = min(4, shortest)
        _, keys = windows(hashes, counts, self.gram)
        self.grams = np.unique(keys)
        self.cache: dict[tuple[int, int], list[tuple[int, int]]] = {}

    def hits(self, hashes: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, dict[int, set[int]]]:
        """Marks per word, and the items per document."""
        mark = np.zeros(len(hashes) + 1, np.int64)
        items: dict[int, set[int]] = {}
        at, keys = windows(hashes, counts, self.gram)
        held = at[member(self.grams, keys)[1]]
        if len(held):
            document = np.repeat(np.arange(len(counts)), counts)
            breaks = np.flatnonzero((np.diff(held) > 1) | (np.diff(document[held]) > 0)) + 1
            for run in np.split(held, breaks):
                first, end = int(run[0]), int(run[-1]) + self.gram
                if end - first < self.shortest:
                    continue
                place, known = member(self.vocabulary, hashes[first:end])
                symbols = np.where(known, place, -1).tolist()
                doc = int(document[first])
                for k, (state, length) in enumerate(self.automaton.stream(symbols)):
                    if length < self.shortest:
                        continue
                    length = min(length, self.automaton.length[state])
                    got = self.cache.get((state, length))
                    if got is None:
                        got = self.cache[(state, length)] = self.automaton.windows_at(state, length)
                    if got:
                        stop = first + k + 1
                        mark[stop - max(size for size, _ in got)] += 1
                        mark[stop] -= 1
                        items.setdefault(doc, set()).update(i for _, i in got)
        return np.cumsum(mark[:-1]) > 0, items


def _words(texts: Texts) -> tuple[tuple[np.ndarray, np.ndarray], np.ndarray, np.ndarray]:
    low = Texts(LOWER[texts.data], texts.offsets)
    starts, ends, counts = low.spans(ALNUM)
    return (starts, ends), low.hashes(starts, ends), counts


def _blocks(benchmark: DataFrame, limit: int):
    """Items in blocks of about ``limit`` words; one block at a time is on the driver."""
    items = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("null")).alias("id"), F.coalesce("text", F.lit("")).alias("text"))
    items = items.withColumn("n", F.size(F.split("text", r"\s+")).cast("long"))
    block, size = [], 0
    for row in items.toLocalIterator():
        if block and size + row["n"] > limit:
            yield block
            block, size = [], 0
        block.append((row["id"], row["text"]))
        size += row["n"]
    yield block


def find_overlap(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, column: str = "text", block_words: int = BLOCK_WORDS) -> DataFrame:
    """Adds ``n_words``, ``hit_spans`` (first word, end word, start and end in code points) and ``hit_items``."""
    spark = docs.sparkSession
    frame = replace_names(docs, ["n_words", "hit_spans", "hit_items"])
    before = None
    for block in _blocks(benchmark, block_words):
        if before is not None:
            path = scratch_path(spark, "overlap")
            before.write.parquet(path)
            frame = spark.read.parquet(path)
        before = _pass(frame, Matcher(block, window), column)
    return before


SPANS = "n_words long, hit_spans array<struct<word:int,word_end:int,start:int,end:int>>, hit_items array<string>"


def _pass(frame: DataFrame, matcher: Matcher, column: str) -> DataFrame:
    shared = frame.sparkSession.sparkContext.broadcast(matcher)
    again = "hit_spans" in frame.columns
    if again:
        frame = frame.withColumnRenamed("hit_spans", "_spans_before").withColumnRenamed("hit_items", "_items_before").drop("n_words")

    def kernel():
        held = shared.value

        def run(texts: Texts) -> list:
            (starts, ends), hashes, counts = _words(texts)
            hit, items = held.hits(hashes, counts)
            spans: list[list] = [[] for _ in range(len(texts))]
            if hit.any():
                last = np.cumsum(counts)
                on = np.diff(np.concatenate([[0], hit.astype(np.int8), [0]]))
                for a, b in zip(np.flatnonzero(on == 1), np.flatnonzero(on == -1)):
                    while a < b:  # hits of neighbouring documents may touch
                        doc = int(np.searchsorted(last, a, "right"))
                        stop = min(int(b), int(last[doc]))
                        first = int(last[doc] - counts[doc])
                        body = texts.data[texts.offsets[doc] : ends[stop - 1]]
                        lead = int(((body[: starts[a] - texts.offsets[doc]] & 0xC0) != 0x80).sum())
                        size = int(((body & 0xC0) != 0x80).sum())
                        spans[doc].append({"word": int(a) - first, "word_end": stop - first, "start": lead, "end": size})
                        a = stop
            return [counts, spans, [sorted({held.items[i] for i in items.get(d, ())}) for d in range(len(texts))]]

        return run

    out = annotate(frame, SPANS, kernel, column)
    if not again:
        return out
    out = out.withColumn("hit_items", F.array_sort(F.array_union("hit_items", "_items_before")))
    out = out.withColumn("hit_spans", _merged(F.array_sort(F.concat("hit_spans", "_spans_before"))))
    return out.drop("_spans_before", "_items_before")


def _merged(spans):
    """Sorted spans with those that overlap or touch joined."""
    def step(done, x):
        last = F.get(done, F.size(done) - 1)
        joins = (F.size(done) > 0) & (x["word"] <= last["word_end"])
        grown = F.struct(last["word"].alias("word"), F.greatest(last["word_end"], x["word_end"]).alias("word_end"),
                         last["start"].alias("start"), F.greatest(last["end"], x["end"]).alias("end"))
        return F.when(joins, F.concat(F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(0))), F.array(grown))).otherwise(F.concat(done, F.array(x)))

    return F.aggregate(spans, F.filter(spans, lambda x: F.lit(False)), step)


def n_hit(spans="hit_spans"):
    return F.aggregate(spans, F.lit(0).cast("long"), lambda n, x: n + (x["word_end"] - x["word"]))


def remove_overlap(docs: DataFrame, benchmark: DataFrame, max_span: int = MAX_SPAN, max_coverage: float = MAX_COVERAGE, window: int = WINDOW) -> DataFrame:
    """Documents without benchmark passages.

    Hit spans of more than ``max_span`` words are cut out of ``text``; a document with more than
    ``max_coverage`` of its words hit goes. Adds the columns of ``find_overlap``.
    """
    found = find_overlap(docs, benchmark, window).filter(n_hit() <= max_coverage * F.col("n_words"))
    cut = F.filter("hit_spans", lambda x: x["word_end"] - x["word"] > max_span)
    starts = F.concat(F.array(F.lit(0)), F.transform(cut, lambda x: x["end"]))
    ends = F.concat(F.transform(cut, lambda x: x["start"]), F.array(F.length("text")))
    pieces = F.transform(F.arrays_zip(starts.alias("a"), ends.alias("b")), lambda x: F.substring("text", x["a"] + 1, x["b"] - x["a"]))
    return found.withColumn("text", F.when(F.size(cut) > 0, F.array_join(pieces, "")).otherwise(F.col("text")))

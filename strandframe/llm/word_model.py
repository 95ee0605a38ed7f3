"""A modified Kneser-Ney model of word trigrams whose tables stay in Spark.

Words are 64-bit hashes; upper and lower case and all scripts differ. Documents lie in two halves
by the hash of their text, and each half is scored with what the other one counts: with its own
counts in the model, a text of words that occur nowhere else would look certain. Every document is
counted, copies too; equal texts lie in one half and get equal scores.

What is moved is blocks, not rows. The words of some million tokens are a block, written once as
numbers with the block's own dictionary. For trigrams, then bigrams, then words, each block asks: it
sends its distinct n-grams as sorted 64-bit fingerprints, cut by ranges, with what it has counted. The
task of a range merges all blocks' arrays and answers each with the totals, in the order it asked, and
tells one block for each n-gram that it owns it: this one counts it in its context and as a
continuation. A range takes an n-gram once from a block, so no frequent word makes one large.

All arrays grow with the corpus and are written. Only the counts of counts, 2 halves x 3 orders x 5
numbers, reach the driver. A task holds one block, or one range of about as many entries.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path
from .text import SPACE, mix, slices

HALVES = (0, 1)
#: A block ends with the slice of texts that fills it; a longer text is a block alone.
BLOCK_WORDS = 1 << 20
BLOCKS = "block long, n_words long, keys binary, counts binary, words binary, tokens binary"
ASKS = "part int, block long, n int, grams binary, counts array<binary>"
ANSWERS = "block long, level int, part int, n int, totals array<binary>, stats array<long>"
SCORES = "key long, mean double, var double"
#: How many numbers go with a trigram, a bigram and a word.
NUMBERS = {3: 2, 2: 10, 1: 10}
#: Shuffle files go when the table is written, not when the driver happens to collect garbage.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def text_key(column: str) -> Column:
    return F.xxhash64(F.coalesce(F.col(column), F.lit("")))


def half(key) -> Column:
    return F.pmod(F.shiftright(key, 7), F.lit(2))


def pack(x: np.ndarray) -> bytes:
    """Numbers of 64 bits, none negative: their bytes by place, as many as the largest needs, compressed."""
    x = np.ascontiguousarray(x)
    width = (int(x.max()).bit_length() + 7) // 8 if len(x) else 0
    planes = np.ascontiguousarray(x.view(np.uint8).reshape(-1, 8)[:, :width].T)
    return bytes([width]) + (pa.compress(planes, codec="zstd", asbytes=True) if width else b"")


def unpack(data: bytes, n: int) -> np.ndarray:
    out = np.zeros((n, 8), np.uint8)
    if width := data[0]:
        planes = pa.decompress(memoryview(data)[1:], decompressed_size=width * n, codec="zstd", asbytes=True)
        out[:, :width] = np.frombuffer(planes, np.uint8).reshape(width, n).T
    return out.view(np.int64).reshape(-1)


def _distinct(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted distinct values, a place of each and the entry of each place."""
    order = np.argsort(codes)
    codes = codes[order]
    new = np.append(True, codes[1:] != codes[:-1])
    entry = np.empty(len(codes), np.int64)
    entry[order] = np.cumsum(new) - 1
    return codes[new], order[new], entry


def _row(schema: list[str], *values) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([v]) for v in values], names=schema)


def _names(fields: str) -> list[str]:
    return [f.split()[0] for f in fields.split(", ")]


def _blocks(size: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts with words as blocks: words by falling frequency, and their numbers in the order of the texts."""
    held: list[list[np.ndarray]] = []

    def block() -> pa.RecordBatch:
        keys, counts, hashes = (np.concatenate(x) for x in zip(*held))
        held.clear()
        words, _, number = _distinct(hashes)
        order = np.argsort(-np.bincount(number), kind="stable")
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        return _row(_names(BLOCKS), uuid.uuid4().int >> 65, len(hashes), keys.tobytes(), pack(counts), words[order].tobytes(), pack(rank[number]))

    for batch in batches:
        keys = batch.column(1).to_numpy()
        for first, end, part in slices(batch.column(0)):
            starts, ends, counts = part.spans(~SPACE)
            if len(starts):
                some = np.flatnonzero(counts)
                held.append([keys[first:end][some], counts[some].astype(np.int64), part.hashes(starts, ends)])
            if sum(len(x[2]) for x in held) >= size:
                yield block()
        pa.default_memory_pool().release_unused()
    if held:
        yield block()


class Block:
    """The n-grams of a block: sorted distinct fingerprints of each order, and the entry of each token in them.

    Two starts, the word 0, precede a text.
    """

    def __init__(self, row: dict):
        words = np.frombuffer(row["words"], np.uint64)
        self.keys = np.frombuffer(row["keys"], np.int64)
        counts = unpack(row["counts"], len(self.keys))
        self.heads = np.cumsum(counts) - counts
        tokens = unpack(row["tokens"], row["n_words"])
        order = np.argsort(words)
        self.one = np.concatenate([np.zeros(1, np.uint64), words[order]])
        at = np.empty(len(words), np.int64)
        at[order] = np.arange(1, len(words) + 1)
        self.word = at[tokens]
        self.counts = counts
        # all pairs of neighbours, and the pair of starts
        pair = self._joined(mix(self.one)[self._before(self.word, 0)], self.one[self.word])
        self.two, _, entry = _distinct(np.concatenate([np.zeros(1, np.uint64), pair]))
        self.pair, self.start = entry[1:], int(entry[0])

    @staticmethod
    def _joined(left: np.ndarray, word: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return mix(left * np.uint64(3) + word)

    def _before(self, entries: np.ndarray, start: int) -> np.ndarray:
        """The entry of each token's predecessor; ``start`` at the head of a text."""
        out = np.empty_like(entries)
        out[1:] = entries[:-1]
        out[self.heads] = start
        return out

    def context(self) -> np.ndarray:
        """The pair before each token."""
        return self._before(self.pair, self.start)

    def triples(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Distinct fingerprints, a token of each and the entry of each token."""
        return _distinct(self._joined(self.two[self.context()], self.one[self.word]))

    def words_of_pairs(self) -> tuple[np.ndarray, np.ndarray]:
        """Both words' entries for each pair; the pair of starts follows no word and counts nowhere."""
        left, right = np.zeros(len(self.two), np.int64), np.zeros(len(self.two), np.int64)
        left[self.pair], right[self.pair] = self._before(self.word, 0), self.word
        return left, right

    def halves(self) -> np.ndarray:
        """The half of each token."""
        return np.repeat((self.keys >> 7) & 1, self.counts)


def _asked(block: int, parts: int, grams: np.ndarray, counts: Iterator[np.ndarray]) -> pa.Table:
    """One row for each range of fingerprints that the block has some of. ``counts``: each number in turn."""
    edges = np.searchsorted(grams, np.array([(i << 64) // parts for i in range(parts)], np.uint64))
    edges = np.append(edges, len(grams))
    part = np.flatnonzero(np.diff(edges))
    spans = [(edges[i], edges[i + 1]) for i in part]
    packed = [[pack(x[a:b]) for a, b in spans] for x in counts]
    columns = [
        pa.array(part, pa.int32()), pa.array(np.full(len(part), block)), pa.array([b - a for a, b in spans], pa.int32()),
        pa.array([grams[a].tobytes() + pack(np.diff(grams[a:b])) for a, b in spans], pa.binary()), pa.array([list(x) for x in zip(*packed)], pa.list_(pa.binary())),
    ]
    return pa.Table.from_arrays(columns, names=_names(ASKS))


def _answer(level: int, asks: pa.Table) -> pa.Table:
    """Adds up what all blocks say of the n-grams of a range. The totals that go back are followed by a row that is
    1 where the block owns the n-gram: the lowest block that has it. One row without a block has, for each half,
    how many n-grams occur once, twice, three times, four times and thrice or more, and the sum; then their number."""
    rows = sorted(asks.to_pylist(), key=lambda r: r["block"])
    sizes = [r["n"] for r in rows]
    spans = list(zip(np.cumsum(sizes) - sizes, np.cumsum(sizes)))
    grams = np.empty(sum(sizes), np.uint64)
    for r, (a, b) in zip(rows, spans):
        grams[a], grams[a + 1 : b] = np.frombuffer(r["grams"][:8], np.uint64)[0], unpack(r["grams"][8:], r["n"] - 1)
        grams[a:b] = np.cumsum(grams[a:b], dtype=np.uint64)
    order = np.argsort(grams, kind="stable")
    new = np.append(True, grams[order[1:]] != grams[order[:-1]])
    first, entry = np.flatnonzero(new), np.cumsum(new) - 1
    back, packed, n = np.empty(len(order), np.int64), [], []
    for k in range(NUMBERS[level]):
        counts = np.concatenate([unpack(r["counts"][k], r["n"]) for r in rows])
        totals = np.add.reduceat(counts[order], first)
        back[order] = totals[entry]
        packed.append([pack(back[a:b]) for a, b in spans])
        n = [*n, totals][-2:]  # the halves' counts come last
    back[order] = new
    packed.append([pack(back[a:b]) for a, b in spans])
    stats = [int(x) for h in HALVES for x in (*((n[h] == k).sum() for k in range(1, 5)), (n[h] >= 3).sum(), n[h].sum())] + [int((n[0] + n[1] > 0).sum())]
    columns = [
        pa.array([*(r["block"] for r in rows), None], pa.int64()), pa.array([level] * (len(rows) + 1), pa.int32()), pa.array([rows[0]["part"]] * (len(rows) + 1), pa.int32()),
        pa.array([*sizes, 0], pa.int32()), pa.array([*(list(x) for x in zip(*packed)), None], pa.list_(pa.binary())), pa.array([None] * len(rows) + [stats], pa.list_(pa.int64())),
    ]
    return pa.Table.from_arrays(columns, names=_names(ANSWERS))


class _Answers:
    """The totals of one order, in the order of the block's fingerprints: each number when it is asked for."""

    def __init__(self, rows: list[dict], level: int):
        self.rows = sorted((r for r in rows if r["level"] == level), key=lambda r: r["part"])

    def __getitem__(self, k: int) -> np.ndarray:
        return np.concatenate([unpack(r["totals"][k], r["n"]) for r in self.rows])

    def own(self) -> np.ndarray:
        return np.flatnonzero(self[-1])


def _sums(n: list[np.ndarray], context: np.ndarray, event: np.ndarray, entries: int) -> Iterator[np.ndarray]:
    """What n-grams with these counts in either half add to their contexts and to the n-grams without their
    first word: for each half how many of the context occur once, twice, and thrice or more, and the sum of these last
    (mostly 0, as the total is not); then how many continue to the shorter n-gram in either half."""
    some = [np.flatnonzero(x) for x in n]
    for h in HALVES:
        count, above = n[h][some[h]], context[some[h]]
        for k in (1, 2, 3):
            yield np.bincount(above[count == k if k < 3 else count >= k], minlength=entries)
        yield np.bincount(above[count >= 3], count[count >= 3], entries).astype(np.int64)
    for h in HALVES:
        yield np.bincount(event[some[h]], minlength=entries)


def _ask_triples(parts: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i in range(batch.num_rows):
            row = batch.slice(i, 1).to_pylist()[0]
            block = Block(row)
            grams, _, entry = block.triples()
            mine = block.halves()
            counts = (np.bincount(entry[mine == h], minlength=len(grams)) for h in HALVES)
            yield from _asked(row["block"], parts, grams, counts).to_batches()
        pa.default_memory_pool().release_unused()


def _ask_pairs(parts: int, blocks: pa.Table, answers: pa.Table) -> pa.Table:
    row = blocks.to_pylist()[0]
    block = Block(row)
    _, at, _ = block.triples()
    totals = _Answers(answers.to_pylist(), 3)
    own = totals.own()
    at = at[own]
    return _asked(row["block"], parts, block.two, _sums([totals[h][own] for h in HALVES], block.context()[at], block.pair[at], len(block.two)))


def _ask_words(parts: int, blocks: pa.Table, answers: pa.Table) -> pa.Table:
    row = blocks.to_pylist()[0]
    block = Block(row)
    totals = _Answers(answers.to_pylist(), 2)
    left, right = block.words_of_pairs()
    own = totals.own()
    return _asked(row["block"], parts, block.one, _sums([totals[8 + h][own] for h in HALVES], left[own], right[own], len(block.one)))


def _discounts(of: list[int]) -> np.ndarray:
    """The discounts of counts 0, 1, 2 and 3 or more, from the counts of counts."""
    y = of[0] / max(1, of[0] + 2 * of[1])
    return np.array([0.0, *(min(k, max(0.0, k - (k + 1) * y * of[k] / of[k - 1])) if of[k - 1] else 0.5 for k in (1, 2, 3))])


def _seen(n: np.ndarray, cut: np.ndarray) -> np.ndarray:
    return n - cut[np.minimum(n, 3)]


def _score(stats: dict[int, list[int]], blocks: pa.Table, answers: pa.Table) -> pa.Table:
    """Mean and variance of each text's negative log probabilities."""
    block = Block(blocks.to_pylist()[0])
    rows = answers.to_pylist()
    three, two, one = (_Answers(rows, level) for level in (3, 2, 1))
    _, at, entry = block.triples()
    context = block.context()[at]
    left, right = block.words_of_pairs()
    x, mine = np.empty(len(block.word)), block.halves()
    for h in HALVES:
        d3, d2, d1 = (_discounts(stats[level][6 * h : 6 * h + 4]) for level in (3, 2, 1))
        starts = [stats[1][6 * h + k] for k in (0, 1, 4)]
        whole = stats[1][6 * h + 5]

        def over(n: np.ndarray, cut: np.ndarray, table: _Answers, above: np.ndarray, lower: np.ndarray) -> np.ndarray:
            """Interpolated probability; without its context that of the shorter n-gram."""
            occur = [table[4 * h + k] for k in range(4)]
            total = occur[0] + 2 * occur[1] + occur[3]
            weight = np.clip((cut[1] * occur[0] + cut[2] * occur[1] + cut[3] * occur[2]) / np.maximum(total, 1), 1e-9, 1.0)
            weight[total == 0] = 1.0
            return np.where(total[above] > 0, _seen(n, cut) / np.maximum(total[above], 1), 0.0) + weight[above] * lower

        weight = min(1.0, max(1e-9, float(d1[1:] @ starts) / whole)) if whole else 1.0
        p = (_seen(one[8 + h], d1) / whole if whole else 0.0) + weight / (stats[1][12] + 1)
        p = over(two[8 + h], d2, one, left, p[right])
        p = over(three[h], d3, two, context, p[block.pair[at]])
        asks = mine != h
        x[asks] = -np.log(p)[entry[asks]]
    mean = np.add.reduceat(x, block.heads) / block.counts
    var = np.maximum(np.add.reduceat(x * x, block.heads) / block.counts - mean * mean, 0.0)
    return pa.Table.from_arrays([pa.array(block.keys), pa.array(mean), pa.array(var)], names=_names(SCORES))


class _Scratch:
    """Tables written between steps, dealt by a column into buckets if one is named, so that what meets them there
    moves and they do not. Shuffle files go with the step, the tables at the end."""

    def __init__(self, spark: SparkSession):
        self.spark, self.paths, self.tables, self.before = spark, [], [], spark.conf.get(CLEANUP, "false")

    def __enter__(self) -> _Scratch:
        self.spark.conf.set(CLEANUP, "true")
        return self

    def written(self, df: DataFrame, name: str, by: str | None = None) -> DataFrame:
        path = scratch_path(self.spark, name)
        self.paths.append(path)
        out = df.write.option("compression", "none")
        if not by:
            out.parquet(path)
            return self.spark.read.parquet(path)
        self.tables.append(path.rpartition("/")[2].replace("-", "_"))
        out = out.option("path", path).option("maxRecordsPerFile", 1)
        out.bucketBy(int(self.spark.conf.get("spark.sql.shuffle.partitions")), by).saveAsTable(self.tables[-1], format="parquet")
        return self.spark.table(self.tables[-1])

    def __exit__(self, *_) -> None:
        self.spark.conf.set(CLEANUP, self.before)
        for table in self.tables:
            self.spark.sql(f"DROP TABLE IF EXISTS {table}")
        for path in map(self.spark._jvm.org.apache.hadoop.fs.Path, self.paths):
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


def _stats(answers: DataFrame) -> list[int]:
    rows = answers.filter("block IS NULL")
    return list(rows.agg(*[F.coalesce(F.sum(F.col("stats")[i]), F.lit(0)).alias(f"s{i}") for i in range(13)]).first())


def write_scores(docs: DataFrame, path: str, column: str = "text") -> None:
    """Writes (key, log_ppl, log_var): mean and variance of the negative log probability of a word, by the
    counts of the half the text is not in. One row per distinct text that has words."""
    texts = docs.select(F.coalesce(F.col(column), F.lit("")).alias("text"), text_key(column).alias("key"))
    with _Scratch(docs.sparkSession) as scratch:
        blocks = scratch.written(texts.mapInArrow(partial(_blocks, BLOCK_WORDS), BLOCKS), "blocks", by="block")
        parts = max(1, -(-(blocks.agg(F.sum("n_words")).first()[0] or 0) // BLOCK_WORDS))
        here = blocks.groupBy("block")

        def answer(asks: DataFrame, level: int) -> DataFrame:
            return scratch.written(asks.groupBy("part").applyInArrow(lambda x: _answer(level, x), ANSWERS), f"answers-{level}")

        def by_block(answers: DataFrame):
            return here.cogroup(answers.filter("block IS NOT NULL").drop("stats").groupBy("block"))

        three = answer(blocks.mapInArrow(partial(_ask_triples, parts), ASKS), 3)
        two = answer(by_block(three).applyInArrow(lambda x, y: _ask_pairs(parts, x, y), ASKS), 2)
        one = answer(by_block(two).applyInArrow(lambda x, y: _ask_words(parts, x, y), ASKS), 1)
        stats = {3: _stats(three), 2: _stats(two), 1: _stats(one)}
        scores = by_block(three.union(two).union(one)).applyInArrow(lambda x, y: _score(stats, x, y), SCORES)
        scores.groupBy("key").agg(F.min("mean").alias("log_ppl"), F.min("var").alias("log_var")).write.parquet(path)


def score_texts(docs: DataFrame, column: str = "text") -> DataFrame:
    """The table of ``write_scores``, written to a scratch folder."""
    path = scratch_path(docs.sparkSession, "word-scores")
    write_scores(docs, path, column)
    return docs.sparkSession.read.parquet(path)

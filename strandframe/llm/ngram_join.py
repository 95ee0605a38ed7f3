"""N-gram Jaccard join with prefix trees, and the classes of documents it links.

A document's set holds its distinct shingles of ``rule.words`` words; sets link whose intersection
is at least ``rule.num / rule.den`` of their union. Documents with equal sets are one node. Shingles have one global order: rare before frequent, by a sketch of how often each of
2^SKETCH_BITS hash classes occurs in all documents (a fixed size, so it can be broadcast), then by
hash. Two sets that reach the threshold t share a shingle among their first ``n - ceil(t n) + 1``.

For each shingle that several nodes have there, a tree holds what else their prefixes share, in
that order. A node is looked up in the tree of those before it (by size): partial overlaps are
counted once per path, and a branch is left when what remains of both sets cannot reach the
threshold. The couples that come out are verified on the whole sets.

Links are needed only as far as they join classes. So a first round takes one partner per node,
and a second one all couples whose nodes are still in different classes, where branches that
hold nothing but the own class are left too. No couple of different classes is skipped.

A block above ``PART_BYTES`` of sets is cut into slices, so no task holds it whole. The first round
looks within slices; another one joins the classes of a block by one node of each; the last one
meets each slice with each other one that is in reach by size and not of the same class, one part
per two slices. So a block whose sets link costs little more than its slices, and only sets that
do not link are compared in all parts, which then lie in many tasks.

Nodes are 64-bit hashes of whole sets: two different sets would have to collide there to be
taken as equal. Null texts and texts without words have the empty set and link with nothing.
Repeated rows are equal sets. A null id takes part; a class of null ids alone has a null id.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator
from functools import lru_cache, partial
from itertools import chain
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import scratch_path
from .components import components
from .text import LOWER, SPACE, Texts, member, mix, slices, sums, windows


class Rule(NamedTuple):
    """Words of a shingle, and the threshold as a fraction: intersection / union >= num / den."""

    words: int = 3
    num: int = 90
    den: int = 100


#: What op7's contract asks for.
CONTRACT = Rule()
SKETCH_BITS, BITMAP_BITS = 18, 24
MARKS = 8
#: Whole sets in a slice of a block; a part of two slices is what a task holds at a time.
PART_BYTES = 16 << 20
#: Sets of so many shingles are added up wherever they are, smaller ones where many rows share a shingle.
LONG_SET = 8_000


def least_overlap(a: int, b: int, rule: Rule) -> int:
    """Smallest intersection of sets of these sizes that reaches the threshold."""
    _, num, den = rule
    return -(-num * (a + b) // (num + den))


def prefix_length(n, rule: Rule):
    _, num, den = rule
    return n - (num * n + den - 1) // den + 1


def shingle_sets(texts: Texts, words: int) -> Iterator[np.ndarray]:
    """Sorted distinct shingle hashes of each document."""
    low = Texts(LOWER[texts.data], texts.offsets)
    starts, ends, counts = low.spans(~SPACE)
    hashes = low.hashes(starts, ends)
    at, keys = windows(hashes, counts, words)
    last = np.cumsum(counts)
    edges = np.searchsorted(at, last)
    before = 0
    for i, n in enumerate(counts):
        if n >= words:
            yield np.unique(keys[before : edges[i]])
        elif n:
            own = hashes[last[i] - n : last[i]]  # too short for a shingle: all its words are one
            with np.errstate(over="ignore"):
                total = own[0] * np.uint64(n + 7)
                for k in range(1, n):
                    total += own[k] * np.uint64(pow(0x51ED2701, k, 1 << 64))
                yield mix(np.array([total], np.uint64))
        else:
            yield np.zeros(0, np.uint64)
        before = edges[i]


def weight(n):
    """Bytes of a set of this size and of what goes with it."""
    return 8 * n + 1000


def node_of(keys: np.ndarray) -> int:
    """A hash of the whole set."""
    with np.errstate(over="ignore"):
        return int(mix(np.array([mix(keys).sum(dtype=np.uint64) + np.uint64(len(keys))], np.uint64)).view(np.int64)[0])


SCANNED = ["id", "key", "n", "node", "bucket", "count"]


def _scan(words: int, batches):
    """Per row its id, set size and node; at the end of the task the sketch of all its sets."""
    sketch = np.zeros(1 << SKETCH_BITS, np.int64)
    for batch in batches:
        pa.default_memory_pool().release_unused()
        for first, end, part in slices(batch.column(1)):
            sizes, nodes, keys = [], [], []
            for s in shingle_sets(part, words):
                sizes.append(len(s))
                nodes.append(node_of(s) if len(s) else None)
                keys.append(s)
            sketch += np.bincount((np.concatenate(keys) >> np.uint64(64 - SKETCH_BITS)).astype(np.int64), minlength=len(sketch))
            none = pa.nulls(end - first, pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, end - first), batch.column(2).slice(first, end - first), pa.array(sizes, pa.int64()), pa.array(nodes, pa.int64()), none.cast(pa.int32()), none], names=SCANNED)
    at = np.flatnonzero(sketch)
    if len(at):
        none = pa.nulls(len(at), pa.int64())
        yield pa.RecordBatch.from_arrays([none, none, none, none, pa.array(at.astype(np.int32)), pa.array(sketch[at])], names=SCANNED)


def token_order(levels: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Shingles as numbers whose order is the global one."""
    level = levels[(keys >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)].astype(np.uint64)
    with np.errstate(over="ignore"):
        return np.sort((level << np.uint64(55)) | (mix(keys) >> np.uint64(9)))


def _levels(sketch: DataFrame) -> np.ndarray:
    """Frequency class of each hash class; at most 2^SKETCH_BITS rows reach the driver."""
    table = sketch.groupBy("bucket").agg(F.sum("count").alias("n")).toArrow()
    counts = np.zeros(1 << SKETCH_BITS)
    counts[table.column("bucket").to_numpy()] = table.column("n").to_numpy()
    return np.minimum(8 * np.log2(counts + 1), 255).astype(np.uint8)


def _lists(parts: list[np.ndarray], kind) -> pa.ListArray:
    offsets = np.cumsum([0, *map(len, parts)])
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(np.concatenate(parts).astype(kind)))


class Tree:
    """Prefix tree of the sequences of a block; a branch knows its sizes and its class, if it has one alone.

    A branch with a single node stays a leaf: the node, its sequence and how far that is used.
    """

    __slots__ = ("next", "held", "least", "most", "only")

    def __init__(self) -> None:
        self.next: dict[int, Tree | tuple] = {}
        self.held: list[tuple] = []
        self.least, self.most = 1 << 62, 0
        self.only: int | None = None

    def add(self, entry: tuple, sequence: list[int]) -> None:
        """A loop, not recursion: long near copies share paths of thousands of shingles."""
        here, at = self, 0
        while True:
            here._count(entry)
            if at == len(sequence):
                here.held.append(entry)
                return
            below = here.next.get(sequence[at])
            if below is None:
                here.next[sequence[at]] = (entry, sequence, at + 1)
                return
            if isinstance(below, tuple):
                leaf, below = below, Tree()
                here.next[sequence[at]] = below
                below._count(leaf[0])
                if leaf[2] == len(leaf[1]):
                    below.held.append(leaf[0])
                else:
                    below.next[leaf[1][leaf[2]]] = (leaf[0], leaf[1], leaf[2] + 1)
            here, at = below, at + 1

    def _count(self, entry: tuple) -> None:
        self.only = entry[1] if not self.most else self.only if self.only == entry[1] else None
        self.least, self.most = min(self.least, entry[2]), max(self.most, entry[2])

    def partners(self, entry: tuple, sequence: list[int], rule: Rule) -> Iterator[int]:
        """Places of earlier nodes of other classes that can still reach the threshold with ``entry``."""
        place, group, n, marks = entry
        _, num, den = rule
        tail = n - prefix_length(n, rule)
        at_of = {t: i for i, t in enumerate(sequence)}
        todo = [(self, 0, 0)]
        while todo:
            here, common, used = todo.pop()
            if here.most * den < n * num or (here.only is not None and here.only == group):
                continue
            # all that is left of the prefix, and the rest of the set behind it
            if 1 + common + (len(sequence) - used) + tail < least_overlap(n, here.least, rule):
                continue
            for other, its_group, size, its_marks in here.held:
                if its_group != group and reaches(n, marks, size, its_marks, 1 + common, rule):
                    yield other
            for token, below in here.next.items():
                at = at_of.get(token)
                if isinstance(below, tuple):
                    (other, its_group, size, its_marks), its_tokens, its_at = below
                    if its_group != group and size * den >= n * num:
                        shared = 1 + common + (at is not None) + sum(map(at_of.__contains__, its_tokens[its_at:]))
                        if reaches(n, marks, size, its_marks, shared, rule):
                            yield other
                else:
                    todo.append((below, common, used) if at is None else (below, common + 1, max(used, at + 1)))


def reaches(n: int, marks: list[int], m: int, other: list[int], shared: int, rule: Rule) -> bool:
    return m * rule.den >= n * rule.num and shared + rest_bound(n, marks, m, other, rule) >= least_overlap(n, m, rule)


@lru_cache(4096)
def mark_counts(n: int, rule: Rule) -> list[int]:
    """How many shingles of the prefix lie at or before each mark."""
    p = prefix_length(n, rule)
    return [-(-p * (j + 1) // MARKS) for j in range(MARKS)]


def rest_bound(n: int, marks: list[int], m: int, other: list[int], rule: Rule) -> int:
    """Most that two sets can share behind the place where the first of the prefixes ends."""
    if marks[-1] > other[-1]:
        n, marks, m, other = m, other, n, marks
    rest = n - prefix_length(n, rule)
    if marks[-1] == other[-1]:  # equal in the bits held: either may end first
        return max(rest, m - prefix_length(m, rule))
    at = bisect_left(other, marks[-1])
    return min(rest, m - (mark_counts(m, rule)[at - 1] if at else 0))


def _may_reach(n: np.ndarray, m: np.ndarray, shared: np.ndarray, rule: Rule) -> np.ndarray:
    """``reaches`` for arrays of couples, with a looser bound behind the prefixes; n <= m."""
    rest = m - prefix_length(m, rule)
    return (n * rule.den >= m * rule.num) & (shared + rest >= least_overlap(n, m, rule))


#: ``part`` is the first slice << 32, the second one << 2, and where the node is: 0 for a part of one slice, else 1 or 2.
BLOCK = "token long, part long, node long, partners array<long>"


def _couples(limit: int | None, rule: Rule):
    """Streams parts of blocks of one shingle, sorted by size. Gives a row for each node of a block that is in
    a couple, with the earlier nodes it may link to. A couple counts in the block of its first common shingle."""

    def block(out: list, token: int, rows: range, parts, nodes, groups, sizes, marks, tokens, offsets, at) -> None:
        trees, before, after = (Tree(), Tree(), Tree()), {}, {}
        found: dict[int, list[int]] = {}
        for i in rows:
            own = tokens[offsets[i] : offsets[i + 1]].tolist()
            before[i], after = set(own[: at[i]]), own[at[i] + 1 :]
            entry = (i, int(groups[i]), int(sizes[i]), marks[i].tolist())
            side = int(parts[i]) & 3
            other = trees[3 - side if side else 0]
            if other.most:
                n = 0
                for j in other.partners(entry, after, rule):
                    if before[i].isdisjoint(before[j]):
                        found.setdefault(i, []).append(j)
                        found.setdefault(j, [])
                        n += 1
                        if n == limit:
                            break
            trees[side].add(entry, after)
        for i, partners in found.items():
            out.append((token, int(parts[i]) >> 2, int(nodes[i]), [int(nodes[j]) for j in partners]))

    def emit(out: list) -> pa.RecordBatch:
        t, part, node, partners = zip(*out)
        out.clear()
        return pa.RecordBatch.from_arrays([pa.array(t, pa.int64()), pa.array(part, pa.int64()), pa.array(node, pa.int64()), pa.array(partners, pa.list_(pa.int64()))], names=["token", "part", "node", "partners"])

    def run(batches):
        out: list = []
        held = None
        for batch in chain(batches, [None]):
            if batch is not None:
                table = pa.Table.from_batches([batch] if held is None else [held, batch])
                batch = table.combine_chunks().to_batches()[0] if table.num_rows else batch
            else:
                batch = held
            if batch is None or not batch.num_rows:
                continue
            token = batch.column(0).to_numpy()
            parts = batch.column(1).to_numpy()
            edges = np.concatenate([[0], np.flatnonzero((np.diff(token) != 0) | (np.diff(parts >> 2) != 0)) + 1, [len(token)]])
            if held is not batch:  # the last block may go on
                held = batch.slice(int(edges[-2]))
                edges = edges[:-1]
            nodes, groups, sizes, at = (batch.column(k).to_numpy() for k in (2, 3, 4, 5))
            marks = batch.column(6).flatten().to_numpy().reshape(-1, MARKS)
            lists = batch.column(7)
            tokens, offsets = lists.values.to_numpy(), lists.offsets.to_numpy()
            after = np.diff(offsets) - at - 1
            counts = np.diff(edges)
            two = edges[:-1][counts == 2]  # most blocks: a look at the sizes settles nearly all
            two = two[_may_reach(sizes[two], sizes[two + 1], 1 + np.minimum(after[two], after[two + 1]), rule) & (groups[two] != groups[two + 1])]
            for first, n in chain(zip(two.tolist(), [2] * len(two)), zip(edges[:-1][counts > 2].tolist(), counts[counts > 2].tolist())):
                block(out, int(token[first]), range(first, first + n), parts, nodes, groups, sizes, marks, tokens, offsets, at)
                if len(out) > 20_000:
                    yield emit(out)
        if out:
            yield emit(out)

    return run


def _verified(rule: Rule, batches):
    """Streams parts with the whole sets of their nodes; gives links that join all that is linked in a part."""
    out: list[tuple[int, int]] = []
    sets: dict[int, np.ndarray] = {}
    wanted: dict[int, list[int]] = {}
    token = None

    def settle() -> None:
        parent = {x: x for x in sets}

        def root(x: int) -> int:
            while parent[x] != x:
                parent[x] = x = parent[parent[x]]
            return x

        for node, partners in wanted.items():
            partners = [p for p in partners if p in sets and root(p) != root(node)]
            for first in range(0, len(partners), 256):
                part = [p for p in partners[first : first + 256] if root(p) != root(node)]
                if not part:
                    continue
                own, lengths = sets[node], np.array([len(sets[p]) for p in part])
                shared = sums(member(own, np.concatenate([sets[p] for p in part]))[1], lengths)
                for p in np.flatnonzero(shared >= least_overlap(len(own), lengths, rule)).tolist():
                    if root(part[p]) != root(node):
                        parent[root(part[p])] = root(node)
                        out.append((node, part[p]))

    for batch in batches:
        for t, node, partners, keys in zip(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()), batch.column(2).to_pylist(), batch.column(3).to_pylist(), batch.column(4)):
            if t != token:
                settle()
                sets, wanted, token = {}, {}, t
                if len(out) > 20_000:
                    yield _pairs(out)
                    out = []
            sets[node] = np.frombuffer(keys.as_buffer(), np.uint64)
            if partners:
                wanted[node] = partners
    settle()
    if out:
        yield _pairs(out)


def _pairs(rows):
    a = np.sort(np.array(rows, np.int64), axis=1)
    return pa.RecordBatch.from_arrays([pa.array(a[:, 0]), pa.array(a[:, 1])], names=["a", "b"])


class Join:
    """The tables of one join; each is written, so a lost executor costs only its own tasks."""

    def __init__(self, docs: DataFrame, id_column: str, column: str, rule: Rule) -> None:
        self.spark, self.rule = docs.sparkSession, rule
        text = F.coalesce(F.col(column), F.lit(""))
        self.texts = docs.select(F.col(id_column).cast("long").alias("id"), text.alias("text"), F.xxhash64(text).alias("key"))
        scanned = self.keep(self.texts.mapInArrow(partial(_scan, rule.words), "id long, key long, n long, node long, bucket int, count long"), "sets")
        self.rows = scanned.filter("bucket IS NULL").select("id", "key", "n", "node")
        self.levels = self.spark.sparkContext.broadcast(_levels(scanned.filter("bucket IS NOT NULL")))
        self.heads = self.keep(self.prefixes(), "prefixes")
        self.entries = self.keep(self.blocks(), "blocks")
        heavy = self.keep(self.large_blocks(), "large")
        self.heavy = None if heavy.isEmpty() else heavy

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        path = scratch_path(self.spark, name)
        df.write.parquet(path)
        return self.spark.read.parquet(path)

    def prefixes(self) -> DataFrame:
        """(node, n, prefix, marks): its first shingles, and every eighth of them as a mark."""
        levels, rule = self.levels, self.rule

        def run(batches):
            order = levels.value
            for batch in batches:
                pa.default_memory_pool().release_unused()
                for _, _, part in slices(batch.column(0)):
                    nodes, sizes, heads, marks = [], [], [], []
                    for s in shingle_sets(part, rule.words):
                        if len(s):
                            nodes.append(node_of(s))
                            sizes.append(len(s))
                            heads.append(token_order(order, s)[: prefix_length(len(s), rule)].view(np.int64))
                            marks.append(heads[-1][np.array(mark_counts(len(s), rule)) - 1] >> 32)
                    if nodes:
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(nodes, pa.int64()), pa.array(sizes, pa.int64()), _lists(heads, np.int64), _lists(marks, np.int32)],
                            names=["node", "n", "prefix", "marks"])

        return self.texts.select("text").mapInArrow(run, "node long, n long, prefix array<long>, marks array<int>").dropDuplicates(["node"])

    def blocks(self) -> DataFrame:
        """(node, n, marks, tokens, places): each node's prefix, cut to shingles that other nodes have in theirs."""
        each = self.heads.select("node", F.posexplode("prefix").alias("place", "token"))
        shared = each.groupBy("token").agg(F.count("*").alias("_c")).filter("_c > 1").select("token")
        cut = each.join(shared, "token").groupBy("node").agg(F.sort_array(F.collect_list(F.struct("token", "place"))).alias("both"))
        cut = cut.select("node", F.col("both.token").alias("tokens"), F.col("both.place").alias("places"))
        return cut.join(self.heads.select("node", "n", "marks"), "node")

    def large_blocks(self) -> DataFrame:
        """Shingles whose nodes have sets of more than PART_BYTES; the first bits of a shingle tell how many rows may have it."""
        often = min(255, int(8 * np.log2(PART_BYTES // weight(LONG_SET) + 1)))
        each = self.entries.select("n", F.explode("tokens").alias("token")).filter((F.col("n") >= LONG_SET) | (F.shiftright("token", 55) >= often))
        return each.groupBy("token").agg(F.sum(weight(F.col("n"))).alias("_w")).filter(F.col("_w") > PART_BYTES).select("token")

    def sliced(self, met: DataFrame, within: bool) -> DataFrame:
        """Rows of large blocks in slices: (token, node, at, part), a row for each part it is in."""
        order = Window.partitionBy("token").orderBy(*([] if within else ["label"]), "n", "node").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        own = weight(F.col("n"))
        met = met.withColumn("slice", F.floor((F.sum(own).over(order) - own) / PART_BYTES).cast("long"))
        two = lambda a, b, side: (F.shiftleft(a, 32) + F.shiftleft(b, 2) + F.lit(side)).alias("part")
        if within:
            return met.select("token", "node", "at", two(F.col("slice"), F.col("slice"), 0))
        _, num, den = self.rule
        met = self.keep(met, "slices")
        a = self.keep(met.groupBy("token", "slice").agg(F.min("n").alias("lo"), F.max("n").alias("hi"), F.min("label").alias("x"), F.max("label").alias("y")), "slice-list")
        b = a.select("token", *[F.col(c).alias(f"{c}2") for c in ("slice", "lo", "hi", "x", "y")])
        pairs = a.join(b, "token").filter("slice <= slice2").filter((F.col("hi") * den >= F.col("lo2") * num) & (F.col("hi2") * den >= F.col("lo") * num))
        pairs = pairs.filter("least(x, x2) <> greatest(y, y2)")
        first = pairs.select("token", "slice", F.when(F.col("slice") == F.col("slice2"), two(F.col("slice"), F.col("slice2"), 0)).otherwise(two(F.col("slice"), F.col("slice2"), 1)).alias("part"))
        second = pairs.filter("slice < slice2").select("token", F.col("slice2").alias("slice"), two(F.col("slice"), F.col("slice2"), 2))
        return met.join(first.unionByName(second), ["token", "slice"]).select("token", "node", "at", "part")

    def parts(self, groups: DataFrame | None, representatives: bool = False) -> DataFrame:
        """(token, part, node, label, n, at, marks, own): what tasks get, a part at a time. With
        ``representatives`` only large blocks, and of each class in a block its smallest set."""
        entries, (_, num, den) = self.entries, self.rule
        if groups is None:
            entries = entries.withColumn("label", F.col("node"))
        else:
            known = groups.select(F.col("node").alias("_g"), "label")
            entries = entries.join(known, F.col("node") == F.col("_g"), "left").withColumn("label", F.coalesce("label", "node"))
        each = entries.select("node", "label", "n", "places", F.posexplode("tokens").alias("at", "token"))
        each = each.select("token", "node", "label", "n", "at", F.get("places", F.col("at")).alias("place"))
        if groups is not None:
            mixed = each.groupBy("token").agg(F.min("label").alias("_x"), F.max("label").alias("_y"))
            each = each.join(mixed.filter("_x <> _y").select("token"), "token")
        if representatives:
            each = each.join(self.heavy, "token", "left_semi").groupBy("token", "label").agg(F.min(F.struct("n", "node", "at", "place")).alias("r"))
            each = each.select("token", "r.node", "label", "r.n", "r.at", "r.place")
        # the smaller set of a couple has their first common shingle among even fewer of its first ones;
        # only rows that meet such a one of fitting size get their sequences
        order = Window.partitionBy("token").orderBy("n", "node")
        early = F.col("place") <= F.col("n") - F.ceil(F.lit(2 * num) * F.col("n") / F.lit(num + den))
        each = each.withColumn("early", early).withColumn("next", F.lead("n").over(order))
        each = each.withColumn("before", F.max(F.when(F.col("early"), F.col("n"))).over(order.rowsBetween(Window.unboundedPreceding, -1)))
        meets = (F.col("early") & (F.col("next") * num <= F.col("n") * den)) | (F.col("before") * den >= F.col("n") * num)
        met = each.filter(meets)
        one = F.lit(0).cast("long").alias("part")
        if self.heavy is None:
            met = met.select("token", "node", "at", one)
        else:
            met = self.keep(met.select("token", "node", "label", "n", "at"), "met")
            large = self.sliced(met.join(self.heavy, "token", "left_semi"), groups is None or representatives)
            met = met.join(self.heavy, "token", "left_anti").select("token", "node", "at", one).unionByName(large)
        whole = met.join(entries.select("node", "label", "n", "marks", F.col("tokens").alias("own")), "node")
        of = F.shiftright("part", 2)
        dealt = whole.repartition("token", of).sortWithinPartitions("token", of, "n", "node")
        return dealt.select("token", "part", "node", "label", "n", "at", "marks", "own")

    def couples(self, groups: DataFrame | None, limit: int | None, representatives: bool = False) -> DataFrame:
        """Blocks with the candidate couples of nodes in different classes."""
        return self.parts(groups, representatives).mapInArrow(_couples(limit, self.rule), BLOCK)

    def verify(self, blocks: DataFrame) -> DataFrame:
        """Links between nodes whose whole sets reach the threshold: enough to join all that the blocks link."""
        ends = blocks.select(F.col("node").alias("e")).distinct()
        texts = self.rows.groupBy("node").agg(F.min("key").alias("key")).join(ends, F.col("node") == F.col("e"), "left_semi").select("key")
        # a bitmap of fixed size tells most other texts apart before their sets are made
        texts = self.keep(texts.select(F.pmod("key", F.lit(1 << BITMAP_BITS)).alias("at")), "ends")
        words = texts.groupBy(F.shiftright("at", 6).alias("w")).agg(F.bit_or(F.expr("shiftleft(1L, CAST(at % 64 AS INT))")).alias("bits")).toArrow()
        bitmap = np.zeros(1 << (BITMAP_BITS - 6), np.int64)
        bitmap[words.column("w").to_numpy()] = words.column("bits").to_numpy()
        shared, rule = self.spark.sparkContext.broadcast(bitmap), self.rule

        def sets(batches):
            bits = shared.value
            for batch in batches:
                pa.default_memory_pool().release_unused()
                at = batch.column(1).to_numpy() & ((1 << BITMAP_BITS) - 1)
                batch = batch.filter(pa.array((bits[at >> 6] >> (at & 63) & 1).astype(bool)))
                for _, _, part in slices(batch.column(0)):
                    held = [s for s in shingle_sets(part, rule.words) if len(s)]
                    if held:
                        yield pa.RecordBatch.from_arrays([pa.array([node_of(s) for s in held], pa.int64()), pa.array([s.tobytes() for s in held], pa.binary())], names=["node", "keys"])

        whole = self.texts.select("text", "key").mapInArrow(sets, "node long, keys binary").dropDuplicates(["node"])
        both = blocks.join(whole, "node").select("token", "part", "node", "partners", "keys")
        return both.repartition("token", "part").sortWithinPartitions("token", "part").mapInArrow(partial(_verified, rule), "a long, b long")

    def links(self) -> tuple[DataFrame, DataFrame]:
        """Verified links that connect all classes, and (node, label)."""
        found = self.keep(self.verify(self.keep(self.couples(None, 1), "couples")), "links")
        groups = components(found)
        for representatives in (True, False) if self.heavy is not None else (False,):
            more = self.keep(self.couples(groups, 1 if representatives else None, representatives), "couples")
            if not more.isEmpty():
                found = found.unionByName(self.keep(self.verify(more), "links"))
                groups = components(found)
        return found, groups


def _classified(join: Join) -> DataFrame:
    """(node, label, low): class and smallest id of each node."""
    _, groups = join.links()
    own = join.rows.filter("node IS NOT NULL").groupBy("node").agg(F.min("id").alias("low"))
    label = groups.select(F.col("node").alias("_g"), "label")
    joined = own.join(label, F.col("node") == F.col("_g"), "left").withColumn("label", F.coalesce("label", "node"))
    return join.keep(joined.select("node", "label", "low"), "classes")


def ngram_classes(docs: DataFrame, id_column: str = "doc_id", column: str = "text", rule: Rule = CONTRACT) -> DataFrame:
    """(id, n_shingles, component_id): the smallest id that links reach, one row per input row."""
    join = Join(docs, id_column, column, rule)
    joined = _classified(join)
    lowest = joined.groupBy("label").agg(F.min("low").alias("component_id"))
    final = joined.join(lowest, "label").select(F.col("node").alias("_n"), "component_id")
    return join.rows.join(final, F.col("node") == F.col("_n"), "left").select(
        F.col("id").alias(id_column), F.col("n").alias("n_shingles"), F.when(F.col("node").isNull(), F.col("id")).otherwise(F.col("component_id")).alias("component_id")
    )


def keep_first(docs: DataFrame, id_column: str = "doc_id", column: str = "text", rule: Rule = CONTRACT) -> DataFrame:
    """One row of each class: the smallest id (null last), then the smallest text hash.

    Texts without words stay. Rows that repeat both id and text are kept once.
    """
    join = Join(docs, id_column, column, rule)
    classes = _classified(join).select(F.col("node").alias("_n"), "label")
    rank = F.struct(F.col("id").isNull().alias("none"), "id", "key")
    worded = join.rows.filter("node IS NOT NULL").groupBy("node").agg(F.min(rank).alias("r")).join(classes, F.col("node") == F.col("_n"))
    first = worded.groupBy("label").agg(F.min("r").alias("r")).select("r.id", "r.key")
    first = first.unionByName(join.rows.filter("node IS NULL").select("id", "key").distinct())
    first = first.select(F.xxhash64("id", "key").alias("_k"))
    keyed = docs.withColumn("_k", F.xxhash64(F.col(id_column).cast("long"), F.xxhash64(F.coalesce(F.col(column), F.lit("")))))
    return keyed.join(first, "_k", "left_semi").dropDuplicates(["_k"]).drop("_k")

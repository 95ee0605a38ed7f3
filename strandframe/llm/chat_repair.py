"""Conversations repaired at least cost into ``(system)? (user assistant)+`` or nothing.

A row is a symbol: its role's initial, in capitals when the text breaks off, or ``D`` when it has to go
(blank, or said before). Rows are laid out by conversation and turn in range partitions and cut into
segments, so a conversation of any length is spread over tasks. Frequent pairs of symbols of all distinct
segments become rules of a grammar (Re-Pair, several pairs a round, counted by Spark). Each rule holds one
min-plus matrix over the four states of the target pattern, with the least audit of each entry as a rope;
a rule's matrix is the product of its two sides, so it is evaluated once and shared by all segments. What a
segment does to the states is joined back by its symbols, and per conversation the segments' costs are
summed from the end and followed from the start.

Equal costs are settled by the audits: of two with the same cost and the same rows neither begins with the
other, and each matrix ends with a row's letter, so the order of audits survives concatenation and a
segment's rank among the exits of a state suffices to choose between them.

* Rows of a conversation go by turn (nulls first), role and text; rows that repeat one exactly are folded.
* A null role, text, turn or id counts as one space where text is asked for; a null id is a conversation.
* Only ``conv_id``, ``turn``, ``role`` and ``text`` are read, whatever other columns there are.
* A conversation without rows gets zeros, an empty audit and no turns; an empty table gives an empty table.
* Texts of any length stay whole in their row. The audit and the turns of a conversation are one row of output.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import scratch_path

KEEP, REROLE, DELETE, INSERT, BROKEN = 0, 1, 2, 5, 5
#: States are nothing, system, user, assistant; what each may be followed by.
SPOKEN = {"u": (0, 1, 3), "a": (2,), "s": (0,)}
REACHED = {"u": 2, "a": 3, "s": 1}
ROLES = {2: "user", 3: "assistant"}
#: Cost and letters that end the pattern from each state.
TAILS = ((0, ""), (2 * INSERT, "II"), (INSERT, "I"), (0, ""))
LEGAL = ("su", "ua", "au")
SEGMENT_ROWS = 512
BLANKS = " \t\n\x0b\f\r"


def next_role(state: int) -> int:
    """The state after a user or assistant turn that the pattern asks for."""
    return 3 if state == 2 else 2


# ---- grammar -------------------------------------------------------------------------------------


class Rope:
    """A text as a tree of shared parts; joined only where two of them are compared or returned."""

    __slots__ = ("left", "right", "_text")

    def __init__(self, left: Rope | None, right: Rope | None, text: str | None = None):
        self.left, self.right, self._text = left, right, text

    def text(self) -> str:
        if self._text is None:
            out, stack = [], [self]
            while stack:
                x = stack.pop()
                if x._text is not None:
                    out.append(x._text)
                else:
                    stack += [x.right, x.left]
            self._text = "".join(out)
        return self._text


Entry = tuple[int, Rope]
Matrix = dict[tuple[int, int], Entry]


def better(old: Entry | None, new: Entry) -> Entry:
    if old is None or new[0] < old[0] or (new[0] == old[0] and new[1].text() < old[1].text()):
        return new
    return old


def product(a: Matrix, b: Matrix) -> Matrix:
    out: Matrix = {}
    for (i, k), (x, left) in a.items():
        for j in range(4):
            if (k, j) in b:
                y, right = b[k, j]
                have = out.get((i, j))
                if have is None or x + y <= have[0]:
                    out[i, j] = better(have, (x + y, Rope(left, right)))
    return out


def symbol_matrix(symbol: str) -> Matrix:
    """Insertions in front of a row, then the row itself."""
    out: Matrix = {}

    def put(i: int, j: int, cost: int, letters: str) -> None:
        out[i, j] = better(out.get((i, j)), (cost, Rope(None, None, letters)))

    for i in range(4):
        at = i
        for n in range(3):  # three in a row would lead where one does
            cost, letters = n * INSERT, "I" * n
            put(i, at, cost + DELETE, letters + "D")
            if symbol != "D":
                lost = BROKEN if symbol.isupper() else 0
                put(i, next_role(at), cost + REROLE + lost, letters + "R")
                role = symbol.lower()
                if at in SPOKEN.get(role, ()):
                    put(i, REACHED[role], cost + KEEP + lost, letters + "K")
            at = next_role(at)
    return out


Rules = list[tuple[str, str]]
FIRST_RULE = 0x100


def compressed(seq: str, rules: Rules) -> str:
    for k, (a, b) in enumerate(rules):
        seq = seq.replace(a + b, chr(FIRST_RULE + k))
    return seq


def learn_grammar(patterns: DataFrame, rounds: int = 6, per_round: int = 32, least: int = 3) -> Rules:
    """Pairs to replace, in order: in each round the ``per_round`` most frequent ones of all patterns.

    At most ``rounds * per_round`` pairs of symbols reach the driver. Pairs beyond stay as they are,
    which makes a sequence longer and no result different.
    """
    rules: Rules = []
    for _ in range(rounds):

        def count(batches: Iterator[pa.RecordBatch], rules: Rules = tuple(rules)) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                text = "\n".join(compressed(s, rules) for s in batch.column(0).to_pylist())
                codes = np.frombuffer(text.encode("utf-32-le"), "<u4").astype(np.int64)
                pairs = (codes[:-1] << 32 | codes[1:])[(codes[:-1] != 10) & (codes[1:] != 10)]
                pair, n = np.unique(pairs, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(pair, pa.int64()), pa.array(n, pa.int64())], names=["pair", "n"])

        counts = patterns.select("seq").mapInArrow(count, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))
        best = counts.filter(F.col("n") >= least).orderBy(F.desc("n"), "pair").limit(per_round).collect()
        if not best:
            break
        rules += [(chr(r["pair"] >> 32), chr(r["pair"] & 0xFFFFFFFF)) for r in best]
    return rules


def rule_matrices(rules: Rules) -> dict[str, Matrix]:
    """Bottom-up: a rule only refers to symbols and to rules before it."""
    known = {s: symbol_matrix(s) for s in "DsuaoSUAO"}
    for k, (a, b) in enumerate(rules):
        known[chr(FIRST_RULE + k)] = product(known[a], known[b])
    return known


def segment_matrix(seq: str, rules: Rules, known: dict[str, Matrix]) -> Matrix:
    parts = [known[s] for s in compressed(seq, rules)]
    while len(parts) > 1:
        parts = [product(*parts[i : i + 2]) if i + 1 < len(parts) else parts[i] for i in range(0, len(parts), 2)]
    return parts[0]


PATTERN = "seq string, costs array<long>, ranks array<int>, audits array<string>"


def solve_patterns(patterns: DataFrame, rules: Rules) -> DataFrame:
    """Entry by entry (state before times 4 plus state behind): cost, rank among the exits of the state, audit."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = rule_matrices(rules)
        for batch in batches:
            seqs = batch.column(0).to_pylist()
            costs, ranks, audits = [], [], []
            for seq in seqs:
                made = segment_matrix(seq, rules, known)
                cells = [made.get((i, j)) for i in range(4) for j in range(4)]
                costs.append([c and c[0] for c in cells])
                audits.append([c and c[1].text() for c in cells])
                rank = [None] * 16
                for i in range(4):
                    for r, x in enumerate(sorted((i * 4 + j for j in range(4) if cells[i * 4 + j]), key=lambda x: audits[-1][x])):
                        rank[x] = r
                ranks.append(rank)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(costs, pa.list_(pa.int64())), pa.array(ranks, pa.list_(pa.int32())), pa.array(audits, pa.list_(pa.string()))],
                names=["seq", "costs", "ranks", "audits"])

    return patterns.select("seq").mapInArrow(run, PATTERN)


def follow(segments: list[tuple[list, list]]) -> tuple[int, list[tuple[int, int]]]:
    """Least cost of a conversation, and the states before and behind each segment; ties by rank."""
    togo = [[c for c, _ in TAILS]]
    for costs, _ in reversed(segments):
        ahead = togo[-1]
        togo.append([min(c + ahead[j] for j in range(4) if (c := costs[i * 4 + j]) is not None) for i in range(4)])
    togo.reverse()
    at, path = 0, []
    for (costs, ranks), ahead in zip(segments, togo[1:]):
        _, _, j = min((c + ahead[j], ranks[at * 4 + j], j) for j in range(4) if (c := costs[at * 4 + j]) is not None)
        path.append((at, j))
        at = j
    return togo[0][0], path


def apply_audit(rows: list[dict], letters: str, state: int) -> list[dict]:
    """The turns that the letters leave of folded rows; inserted ones are empty."""
    out, source = [], (r for r in rows for _ in range(r["m"]))
    for x in letters:
        row = {"text": ""} if x == "I" else next(source)
        if x == "D":
            continue
        if x == "K":
            state = REACHED[row["role"][0]]
            out.append({"role": row["role"], "text": row["text"]})
        else:
            state = next_role(state)
            out.append({"role": ROLES[state], "text": row["text"]})
    return out


# ---- rows and segments ---------------------------------------------------------------------------


def damage(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, copies): the damage of the contract, decided by id and turn; 0 copies is a dropped row."""
    spaced = {c: F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn", "role", "text")}
    k = F.crc32(F.concat(spaced["conv_id"], F.lit(":"), spaced["turn"]).cast("binary")) % 20
    text = F.when(k == 1, F.lit("")).when(k == 2, F.translate(spaced["text"], ".!?", "")).otherwise(spaced["text"])
    return conversations.select(
        "conv_id", "turn", F.when(k == 4, F.lit("user")).otherwise(spaced["role"]).alias("role"), text.alias("text"),
        F.when(k == 0, 0).when(k == 3, 2).otherwise(1).alias("copies"))


def _written(df: DataFrame, label: str) -> DataFrame:
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def faulty_rows(rows: DataFrame) -> DataFrame:
    """Equal rows folded to one, with their symbols and counts of faults."""
    folded = rows.filter("copies > 0").groupBy("conv_id", "turn", "role", "text").agg(F.sum("copies").alias("m"))
    said = F.unhex(F.md5(F.concat("role", F.lit("\0"), "text").cast("binary")))
    place = F.struct(F.col("turn").isNotNull().alias("known"), F.coalesce("turn", F.lit(0)).alias("turn"))
    folded = _written(folded.withColumn("said", said), "chat-rows")
    # a row said over and over is combined before it is shuffled, and met by one row
    first = folded.groupBy(F.col("conv_id").alias("_c"), F.col("said").alias("_s")).agg(F.min(place).alias("first"))
    met = folded.join(first, F.col("conv_id").eqNullSafe(F.col("_c")) & (F.col("said") == F.col("_s")))
    body = F.btrim("text", F.lit(BLANKS))
    blank, new = body == "", place == F.col("first")
    broken = ~F.right(body, F.lit(1)).isin(".", "!", "?")
    initial = F.left("role", F.lit(1))
    letter = F.when(initial.isin("s", "u", "a"), initial).otherwise("o")
    head = F.when(blank | ~new, F.lit("D")).when(broken, F.upper(letter)).otherwise(letter)
    zero = F.lit(0).cast("long")
    return met.select(
        "conv_id", "turn", "role", "text", "m", initial.alias("initial"), F.concat(head, F.repeat(F.lit("D"), (F.col("m") - 1).cast("int"))).alias("symbols"),
        F.when(blank, F.col("m")).otherwise(zero).alias("blank"), F.when(blank, zero).otherwise(F.col("m") - new.cast("long")).alias("duplicate"),
        (~blank & new & broken).cast("long").alias("truncated"))


SEGMENT = ("conv_id long, part int, seg long, seq string, first string, last string, blank long, duplicate long, truncated long, illegal long, "
           "rows array<struct<role:string,text:string,m:long>>")


def cut_segments(rows: DataFrame) -> DataFrame:
    """Runs of rows of one conversation, in order by (part, seg); each is bounded, whatever the conversation."""
    # the head of a text orders rows as the text does; only its whole order decides inside a partition
    laid = rows.repartitionByRange("conv_id", "turn", "role", F.left("text", F.lit(64))).sortWithinPartitions("conv_id", "turn", "role", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seg = TaskContext.get().partitionId(), 0
        for batch in batches:
            n = len(batch)
            if not n:
                continue
            col = {name: batch.column(i) for i, name in enumerate(batch.schema.names)}
            ids, known = col["conv_id"].fill_null(0).to_numpy(), col["conv_id"].is_valid().to_numpy(zero_copy_only=False)
            new = np.ones(n, bool)
            new[1:] = (ids[1:] != ids[:-1]) | (known[1:] != known[:-1])
            since = np.arange(n) - np.maximum.accumulate(np.where(new, np.arange(n), 0))
            starts = np.flatnonzero(since % SEGMENT_ROWS == 0)
            ends = np.append(starts[1:], n)
            offsets = pa.array(np.append(starts, n), pa.int32())
            pairs = pc.binary_join_element_wise(col["initial"].slice(0, n - 1), col["initial"].slice(1), "")
            odd = col["m"].to_numpy() - 1  # no role may follow itself
            odd[:-1] += ~pc.is_in(pairs, pa.array(LEGAL)).to_numpy(zero_copy_only=False)
            total = np.append(0, np.cumsum(odd))
            # the step from a segment's last row to the next segment is counted where both are known
            illegal = total[ends - 1] - total[starts] + (col["m"].to_numpy() - 1)[ends - 1]
            sums = [pa.array(np.add.reduceat(col[c].to_numpy(), starts)) for c in ("blank", "duplicate", "truncated")]
            yield pa.RecordBatch.from_arrays([
                col["conv_id"].take(pa.array(starts)), pa.array([part] * len(starts), pa.int32()), pa.array(np.arange(seg, seg + len(starts)), pa.int64()),
                pc.binary_join(pa.ListArray.from_arrays(offsets, col["symbols"]), ""), col["initial"].take(pa.array(starts)), col["initial"].take(pa.array(ends - 1)),
                *sums, pa.array(illegal, pa.int64()), pa.ListArray.from_arrays(offsets, pa.StructArray.from_arrays([col["role"], col["text"], col["m"]], ["role", "text", "m"]))],
                names=["conv_id", "part", "seg", "seq", "first", "last", "blank", "duplicate", "truncated", "illegal", "rows"])
            seg += len(starts)

    return laid.mapInArrow(run, SEGMENT)


CHOICE = "conv_id long, cost long, path array<struct<part:int,seg:long,before:int,behind:int>>"


def choose_states(met: DataFrame) -> DataFrame:
    """Per conversation: least cost, and the states around each of its segments."""
    packed = F.array_sort(F.collect_list(F.struct("part", "seg", "costs", "ranks"))).alias("segments")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            costs, paths = [], []
            for segments in batch.column(1).to_pylist():
                cost, path = follow([(s["costs"], s["ranks"]) for s in segments])
                costs.append(cost)
                paths.append([{"part": s["part"], "seg": s["seg"], "before": i, "behind": j} for s, (i, j) in zip(segments, path)])
            kind = pa.list_(pa.struct([("part", pa.int32()), ("seg", pa.int64()), ("before", pa.int32()), ("behind", pa.int32())]))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(costs, pa.int64()), pa.array(paths, kind)], names=["conv_id", "cost", "path"])

    return met.groupBy("conv_id").agg(packed).mapInArrow(run, CHOICE)


REPAIRED = "conv_id long, part int, seg long, audit string, turns array<struct<role:string,text:string>>"


def apply_edits(segments: DataFrame) -> DataFrame:
    """The turns that the audit of each segment leaves of its rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())]))
        for batch in batches:
            col = {name: batch.column(i) for i, name in enumerate(batch.schema.names)}
            turns = [apply_audit(rows.as_py(), audit.as_py(), state.as_py()) for rows, audit, state in zip(col["rows"], col["audit"], col["before"])]
            yield pa.RecordBatch.from_arrays([*[col[c] for c in ("conv_id", "part", "seg", "audit")], pa.array(turns, kind)], names=["conv_id", "part", "seg", "audit", "turns"])

    return segments.select("conv_id", "part", "seg", "audit", "rows", "before").mapInArrow(run, REPAIRED)


def _tail(state: Column, inserted: bool) -> Column:
    """Letters, or turns, that are added behind the last segment."""
    turn = [F.struct(F.lit(ROLES[k]).alias("role"), F.lit("").alias("text")) for k in (2, 3)]
    added = {1: F.array(*turn), 2: F.array(turn[1])} if inserted else {k: F.lit(TAILS[k][1]) for k in (1, 2)}
    none = F.array().cast("array<struct<role:string,text:string>>") if inserted else F.lit("")
    return F.when(state == 1, added[1]).when(state == 2, added[2]).otherwise(none)


def repair(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Repairs (conv_id, turn, role, text, copies), as ``damage`` gives them.

    The first table has a row per conversation: ``gaps``, ``blank``, ``duplicate``, ``truncated``, ``illegal``
    and ``cost``. The second has the audit and the turns in pieces, ordered by (part, seg); conversations
    without rows have none.
    """
    segments = _written(cut_segments(faulty_rows(rows)), "chat-segments")
    keys = segments.select("conv_id", "part", "seg", "seq")
    patterns = _written(keys.select("seq").distinct(), "chat-patterns")
    solved = _written(solve_patterns(patterns, learn_grammar(patterns)), "chat-solved")
    met = keys.join(solved, "seq")
    chosen = _written(choose_states(met), "chat-choices")

    end = F.element_at("path", -1)
    steps = chosen.select(F.explode("path").alias("p"), end.alias("e")).select("p.*", ((F.col("p.part") == F.col("e.part")) & (F.col("p.seg") == F.col("e.seg"))).alias("ends"))
    audits = met.join(steps, ["part", "seg"]).select(
        "part", "seg", "before", F.get("audits", F.col("before") * 4 + F.col("behind")).alias("audit"), F.when(F.col("ends"), F.col("behind")).alias("left"))
    edited = apply_edits(segments.join(audits.select("part", "seg", "before", "audit"), ["part", "seg"]))
    tails = audits.filter("left IN (1, 2)").select("part", "seg", _tail(F.col("left"), False).alias("letters"), _tail(F.col("left"), True).alias("more"))
    edited = edited.join(tails, ["part", "seg"], "left")
    pieces = edited.select(
        "conv_id", "part", "seg", F.concat("audit", F.coalesce("letters", F.lit(""))).alias("audit"), F.concat("turns", F.coalesce("more", _tail(F.lit(0), True))).alias("turns"))

    counts = segments.groupBy("conv_id").agg(
        *[F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated", "illegal")],
        F.transform(F.array_sort(F.collect_list(F.struct("part", "seg", "first", "last"))), lambda x: F.struct(x["first"], x["last"])).alias("edges"))
    # where one segment meets the next
    met_at = F.zip_with(F.slice("edges", 1, F.greatest(F.size("edges") - 1, F.lit(0))), F.slice("edges", 2, F.size("edges")), lambda a, b: F.concat(a["last"], b["first"]))
    counts = counts.withColumn("illegal", F.col("illegal") + F.size(F.filter(met_at, lambda x: ~x.isin(*LEGAL))))
    turn = F.when(F.col("copies") > 0, F.col("turn"))
    spans = rows.groupBy(F.col("conv_id").alias("_c")).agg(F.coalesce(F.max(turn) - F.min(turn) + 1 - F.count_distinct(turn), F.lit(0)).alias("gaps"))
    counts = counts.join(chosen.select(F.col("conv_id").alias("_d"), "cost"), F.col("conv_id").eqNullSafe(F.col("_d")))
    whole = spans.join(counts, F.col("_c").eqNullSafe(F.col("conv_id")), "left")
    return whole.select(F.col("_c").alias("conv_id"), "gaps", *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("blank", "duplicate", "truncated", "illegal", "cost")]), pieces


def repair_conversations(conversations: DataFrame) -> DataFrame:
    """One row per conversation: the counts of ``repair``, ``audit``, and ``turns`` after damage and repair."""
    summary, pieces = repair(damage(conversations))
    packed = F.array_sort(F.collect_list(F.struct("part", "seg", "audit", "turns")))
    whole = pieces.groupBy(F.col("conv_id").alias("_c")).agg(packed.alias("p")).select(
        "_c", F.array_join("p.audit", "").alias("audit"), F.flatten("p.turns").alias("turns"))
    out = summary.join(whole, F.col("conv_id").eqNullSafe(F.col("_c")), "left")
    return out.select(*summary.columns, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("turns", _tail(F.lit(0), True)).alias("turns"))

"""Contig sets: filter, measure, rename, split, tile, join and cut.

Contigs are rows of (file, name, seq).
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import dna
from ..functions.common import as_col
from ..session import cut_lineage
from . import pieces
from .scale import first_per_key, number_rows, running_sum

#: Letters of a piece whose k-mers are counted together; an Arrow batch holds up to 10,000 pieces.
PIECE = 5_000
#: Letters whose k-mers are coded at once, those after which blocks of k-mers leave a Python worker, and those of a
#: group whose k-mers one task takes.
CODED_LETTERS, BLOCK_LETTERS, PART_LETTERS = 1 << 20, 1 << 22, 1 << 23
#: k-mers after which a batch of counts leaves a Python worker.
BATCH_ROWS = 1 << 18
#: Letters of the parts of contigs after which a batch leaves.
BATCH_LETTERS = 1 << 23


def filter_contigs(contigs: DataFrame, min_len: int = 500, min_cov: float = 0.0, drop_uncomplex: bool = False,
                   strict: bool = False) -> DataFrame:
    """By length, by the ``cov_<number>`` in the name (absent = keep) and by complexity."""
    long_enough = F.length("seq") > min_len if strict else F.length("seq") >= min_len
    cov = F.regexp_extract("name", r"cov_([0-9.]*[0-9])", 1).try_cast("double")
    kept = contigs.filter(long_enough & F.coalesce(cov >= min_cov, F.lit(True)))
    return kept.filter(~dna.is_uncomplex("seq")) if drop_uncomplex else kept


def filter_min_reads(contigs: DataFrame, min_reads: int, description: str = "name") -> DataFrame:
    n = F.regexp_extract(description, r"numreads=(\d+)", 1).try_cast("bigint")
    return contigs.filter(F.coalesce(n >= min_reads, F.lit(True)))


def mask_lowercase(contigs: DataFrame) -> DataFrame:
    return contigs.withColumn("seq", dna.mask_lowercase("seq"))


def length_counts(contigs: DataFrame, by: Sequence[str]) -> DataFrame:
    """Contigs, bases, and G or C per distinct length, with the bases of shorter ones and of the whole group.

    A group is a row per distinct length when it is ordered, which the longest contig bounds, however many there are.
    """
    counts = contigs.groupBy(*by, F.length("seq").alias("len")).agg(F.count("*").alias("c"), F.sum(dna.gc_count("seq")).alias("gc"))
    counts = counts.withColumn("bases", F.col("len") * F.col("c"))
    group = Window.partitionBy(*by)
    return counts.withColumns({
        "upto": F.sum("bases").over(group.orderBy("len").rowsBetween(Window.unboundedPreceding, 0)), "size": F.sum("bases").over(group)})


def _half_length(genome_length: int | None) -> Column:
    size = F.lit(genome_length) if genome_length else F.col("size")
    return F.coalesce(F.min(F.when(F.col("upto") > size / 2, F.col("len"))).cast("double"), F.lit(0.01))


def n50(contigs: DataFrame, by: Sequence[str] = ("file",), genome_length: int | None = None) -> DataFrame:
    """First length, ascending, at which the running total exceeds half of the size."""
    return length_counts(contigs, by).groupBy(*by).agg(_half_length(genome_length).alias("N50"))


def _count_codes(by: Sequence[str], k: int):
    """Arrow batches of pieces -> (keys, code, text, n): k-mers of A, C, G, T as integers of two bits a
    base, any other k-mer as text, equal ones of a piece counted."""
    table = np.full(256, 4, dtype=np.int64)
    table[list(b"ACGT")] = range(4)

    def counted(piece: str):
        base = table[np.frombuffer(piece.encode("latin-1", "replace"), dtype=np.uint8)]
        windows = len(base) - k + 1
        if windows < 1:
            return None
        value = np.zeros(windows, dtype=np.int64)
        for j in range(k):
            value = (value << 2) | base[j : j + windows]
        seen = np.concatenate(([0], np.cumsum(base == 4)))
        odd = seen[k:] > seen[:windows]
        code, n = np.unique(value[~odd], return_counts=True)
        strange = [piece[j : j + k] for j in np.flatnonzero(odd)]
        return code, strange, np.concatenate((n, np.ones(len(strange), dtype=np.int64)))

    def table_of(batch: pa.RecordBatch, found: list) -> pa.RecordBatch:
        at = pa.array(np.concatenate([np.full(len(n), i) for i, _, _, n in found]))
        codes = [pa.concat_arrays([pa.array(code), pa.nulls(len(strange), pa.int64())]) for _, code, strange, _ in found]
        texts = [pa.concat_arrays([pa.nulls(len(code), pa.string()), pa.array(strange, pa.string())]) for _, code, strange, _ in found]
        return pa.RecordBatch.from_arrays(
            [*[batch.column(c).take(at) for c in by], pa.concat_arrays(codes), pa.concat_arrays(texts),
             pa.array(np.concatenate([n for *_, n in found]))],
            names=[*by, "code", "text", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, rows = [], 0
            for i, piece in enumerate(batch.column("_piece")):
                one = counted(piece.as_py())
                if one is None:
                    continue
                found.append((i, *one))
                rows += len(one[2])
                # what leaves at once is bounded by rows, not by the pieces of a batch
                if rows >= BATCH_ROWS:
                    yield table_of(batch, found)
                    found, rows = [], 0
            if found:
                yield table_of(batch, found)

    return run


def kmer_counts(contigs: DataFrame, by: Sequence[str], k: int = 21, legacy_last: bool = False) -> DataFrame:
    """How often each k-mer occurs per group (``code`` or ``text``, ``n``).

    Long contigs are cut into overlapping pieces first. A k-mer of up to 31 bases
    travels as one integer and is counted per piece before the shuffle.
    """
    if legacy_last:
        # the last k-mer of each sequence is left out
        source = contigs.withColumn("seq", F.expr("substring(seq, 1, greatest(length(seq) - 1, 0))"))
    else:
        source = contigs
    cut = source.select(*by, F.explode(dna.pieces("seq", PIECE, k - 1)).alias("_piece"))
    if k > 31:
        each = cut.select(*by, F.lit(None).cast("bigint").alias("code"), F.explode(dna.kmers("_piece", k)).alias("text"))
        return each.groupBy(*by, "code", "text").agg(F.count("*").alias("n"))
    schema = ", ".join(f"`{c}` {cut.schema[c].dataType.simpleString()}" for c in by)
    counted = cut.mapInArrow(_count_codes(by, k), f"{schema}, code bigint, text string, n bigint" if by else "code bigint, text string, n bigint")
    return counted.groupBy(*by, "code", "text").agg(F.sum("n").alias("n"))


def _planes(values: np.ndarray) -> bytes:
    """Whole numbers byte by byte: all lowest bytes, then the next ones, so that the empty high ones take no room."""
    return np.ascontiguousarray(values, np.int64).view(np.uint8).reshape(-1, 8).T.tobytes()


def _numbers(planes: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(planes, np.uint8).reshape(8, -1).T).view(np.int64).ravel()


def _codes_of(pieces: list[str], k: int) -> tuple[np.ndarray, np.ndarray, list[str], np.ndarray]:
    """(code, piece) of all k-mers of A, C, G, T, two bits a base, and (text, piece) of all others."""
    table = np.full(256, 4, dtype=np.int64)
    table[list(b"ACGT")] = range(4)
    joined = "".join(p + " " for p in pieces)
    base = table[np.frombuffer(joined.encode("latin-1", "replace"), dtype=np.uint8)]
    size = np.array([len(p) + 1 for p in pieces])
    owner = np.repeat(np.arange(len(pieces)), size)
    ends = np.zeros(len(base) + 1, np.int64)
    ends[np.cumsum(size)] = 1
    windows = len(base) - k + 1
    if windows < 1:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), [], np.zeros(0, np.int64)
    seen, ended = np.concatenate(([0], np.cumsum(base == 4))), np.cumsum(ends)
    value, have, power, width = None, 0, base & 3, 1
    # words of 1, 2, 4 .. letters make up one of k
    while True:
        if k & width:
            value = power[:windows].copy() if value is None else (value << 2 * width) | power[have : have + windows]
            have += width
        if 2 * width > k:
            break
        power, width = (power[:-width] << 2 * width) | power[width:], 2 * width
    across = ended[k : k + windows] > ended[:windows]
    odd = seen[k:] > seen[:windows]
    strange = np.flatnonzero(odd & ~across)
    return value[~odd], owner[:windows][~odd], [joined[j : j + k] for j in strange], owner[strange]


def _kmer_blocks(by: Sequence[str], k: int):
    """Arrow batches of pieces -> (keys, part, codes, times, texts, text_times): sorted k-mers of a group, each once, and how often it is there."""
    def blocks(held: dict, codes: list, owners: list, texts: dict):
        codes, owners = np.concatenate(codes), np.concatenate(owners)
        order = np.argsort(owners, kind="stable")
        edges = np.searchsorted(owners[order], np.arange(len(held) + 1))
        for (key, parts), i in held.items():
            code, times = np.unique(codes[order[edges[i] : edges[i + 1]]], return_counts=True)
            part = (((code ^ (code >> 21)) * 0x9E3779B1 & 0xFFFFFFFF) >> 7) % parts
            words = texts.get(i, {})
            for j in range(parts):
                here = part == j if parts > 1 else slice(None)
                some, mine = code[here], [w for w in words if zlib.crc32(w.encode()) % parts == j]
                if len(some) or mine:
                    yield (*key, j, _planes(np.diff(some, prepend=0)), _planes(times[here]), mine, [words[w] for w in mine])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema, held, codes, owners, texts, letters = None, {}, [], [], {}, 0

        def leave():
            rows = list(blocks(held, codes, owners, texts))
            columns = list(zip(*rows)) if rows else [[]] * len(schema)
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

        for batch in batches:
            schema = pa.schema([*(batch.schema.field(c) for c in by), ("part", pa.int32()), ("codes", pa.binary()), ("times", pa.binary()), ("texts", pa.list_(pa.string())), ("text_times", pa.list_(pa.int64()))])
            keys = list(zip(zip(*(batch.column(c).to_pylist() for c in by)) if by else [()] * len(batch), batch.column("_parts").to_pylist()))
            pieces, at = batch.column("_piece").to_pylist(), 0
            while at < len(pieces):
                some, size = [], 0
                while at < len(pieces) and size < CODED_LETTERS:
                    if pieces[at] is not None:
                        some.append(at)
                        size += len(pieces[at])
                    at += 1
                if not some:
                    continue
                who = np.array([held.setdefault(keys[i], len(held)) for i in some])
                code, owner, strange, strange_owner = _codes_of([pieces[i] for i in some], k)
                codes.append(code)
                owners.append(who[owner])
                # a long run of one letter is one text
                for (i, w), n in Counter(zip(who[strange_owner].tolist(), strange)).items():
                    texts.setdefault(i, Counter())[w] += n
                letters += size
                if letters >= BLOCK_LETTERS:
                    yield leave()
                    held, codes, owners, texts, letters = {}, [], [], {}, 0
        if codes:
            yield leave()

    return run


def _repeats(by: Sequence[str]):
    """The blocks of one part of a group -> its k-mers seen more than once, and all k-mers."""
    def merged(table: pa.Table) -> pa.Table:
        codes = np.concatenate([np.cumsum(_numbers(x.as_py())) for x in table.column("codes")])
        times = np.concatenate([_numbers(x.as_py()) for x in table.column("times")])
        order = np.argsort(codes)
        codes, times = codes[order], times[order]
        first = np.flatnonzero(np.concatenate(([True], codes[1:] != codes[:-1]))) if len(codes) else np.zeros(0, np.int64)
        n = np.add.reduceat(times, first) if len(codes) else times
        words = Counter()
        for texts, counts in zip(table.column("texts").to_pylist(), table.column("text_times").to_pylist()):
            for w, c in zip(texts, counts):
                words[w] += c
        out = {c: table.column(c).slice(0, 1).combine_chunks() for c in by}
        return pa.table(out | {"repeated": [int((n > 1).sum()) + sum(c > 1 for c in words.values())], "total": [int(times.sum()) + words.total()]})

    return merged


def kmer_repeat_fraction(contigs: DataFrame, by: Sequence[str] = ("file",), k: int = 21,
                         legacy_last: bool = False, sizes: DataFrame | None = None) -> DataFrame:
    """Distinct k-mers seen more than once over all k-mers; ``sizes`` (by, size) saves a pass if letters were counted.

    A k-mer of up to 31 bases travels as one integer, in sorted blocks of what one worker has seen; blocks of a large
    group are cut by a hash of the k-mer, and equal k-mers meet in the task of their part.
    """
    if k > 31:
        counts = kmer_counts(contigs, by, k, legacy_last)
        return counts.groupBy(*by).agg(F.round(F.count_if(F.col("n") > 1) / F.sum("n"), 4).alias("kmer21"))
    source = contigs.select(*by, F.expr("substring(seq, 1, greatest(length(seq) - 1, 0))").alias("seq")) if legacy_last else contigs.select(*by, "seq")
    sizes = source.groupBy(*by).agg(F.sum(F.length("seq")).alias("size")) if sizes is None else sizes
    sizes = sizes.withColumn("_parts", F.ceil(F.col("size") / PART_LETTERS).cast("int")).filter("_parts > 1")
    # no more groups than the whole has parts
    large = F.broadcast(sizes.select(*[F.col(c).alias(f"_g{i}") for i, c in enumerate(by)], "_parts"))
    same = F.lit(True)
    for i, c in enumerate(by):
        same = same & F.col(c).eqNullSafe(F.col(f"_g{i}"))
    cut = source.join(large, same, "left").select(*by, F.coalesce("_parts", F.lit(1)).alias("_parts"), F.explode(dna.pieces("seq", PIECE, k - 1)).alias("_piece"))
    kinds = "".join(f"`{c}` {cut.schema[c].dataType.simpleString()}, " for c in by)
    blocks = cut.mapInArrow(_kmer_blocks(by, k), f"{kinds}part int, codes binary, times binary, texts array<string>, text_times array<bigint>")
    counted = blocks.groupBy(*by, "part").applyInArrow(_repeats(by), f"{kinds}repeated bigint, total bigint")
    return counted.groupBy(*by).agg(F.round(F.sum("repeated") / F.sum("total"), 4).alias("kmer21"))


def gc_content(contigs: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    share = F.sum(dna.gc_count("seq")) / F.sum(F.length("seq"))
    return contigs.groupBy(*by).agg(share.alias("gc"))


def has_enough_sequence(contigs: DataFrame, min_len: int = 500, bases: int = 1_000_000) -> DataFrame:
    counted = F.coalesce(F.sum(F.when(F.length("seq") >= min_len, F.length("seq"))), F.lit(0))
    return contigs.agg(counted.alias("bases"), (counted > bases).alias("enough"))


def assembly_score(n50_col, contigs_col, length_col, expected: int | None) -> Column:
    covered = 1 - F.abs(1 - as_col(length_col) / F.lit(expected)) if expected else F.lit(1.0)
    covered = F.when(covered <= 0, F.lit(1 / 9999999999)).otherwise(covered)
    return F.round(F.log(as_col(n50_col) / as_col(contigs_col) * covered), 3)


# Named statistics of one group, from its ``length_counts``; a caller may ask for any of them.
STATS: dict[str, Callable[[int | None], Column]] = {
    "genomeLength": lambda _: F.sum("bases"),
    "numContigs": lambda _: F.sum("c"),
    "longestContig": lambda _: F.max("len"),
    "avgContigLength": lambda _: F.floor(F.sum("bases") / F.sum("c")),
    "GC": lambda _: F.round(F.sum("gc") / F.sum("bases"), 3) * 100,
    "N50": _half_length,
}
JOINED_STATS = ("kmer21", "assemblyScore")


def assembly_metrics(contigs: DataFrame, min_contig: int = 500, genome_length: int | None = None,
                     stats: Sequence[str] | None = None, by: Sequence[str] = ("file",)) -> DataFrame:
    """The named statistics per file: one pass over the lengths, one over the k-mers."""
    wanted = list(stats) if stats else [*STATS, *JOINED_STATS]
    unknown = set(wanted) - set(STATS) - set(JOINED_STATS)
    if unknown:
        raise ValueError(f"unknown statistics: {sorted(unknown)}")
    kept = contigs.filter(F.length("seq") >= min_contig)
    base = [s for s in STATS if s in wanted or "assemblyScore" in wanted]
    # a row per distinct length, read for the statistics and for the sizes of the groups
    counts = cut_lineage(length_counts(kept, by)) if "kmer21" in wanted else length_counts(kept, by)
    out = counts.groupBy(*by).agg(*[STATS[s](genome_length).alias(s) for s in base or ["numContigs"]])
    if "kmer21" in wanted:
        sizes = counts.groupBy(*by).agg(F.sum("bases").alias("size"))
        out = out.join(kmer_repeat_fraction(kept, by, sizes=sizes), list(by), "left").na.fill(0.0, ["kmer21"])
    if "assemblyScore" in wanted:
        out = out.withColumn("assemblyScore", assembly_score("N50", "numContigs", "genomeLength", genome_length))
    return out.select(*by, *wanted)


def contig_details(contigs: DataFrame) -> DataFrame:
    by = ["file", "name"]
    base = contigs.select(
        *by,
        F.length("seq").alias("length"),
        (F.round(dna.gc_count("seq") / F.length("seq"), 3) * 100).alias("GC"),
    )
    return base.join(kmer_repeat_fraction(contigs, by), by, "left").na.fill(0.0, ["kmer21"])


def choose_best(metrics: DataFrame, score: str = "assemblyScore") -> DataFrame:
    """The file with the highest score, the first name on a tie."""
    best = F.min(F.struct((-F.col(score)).alias("s"), F.col("file")))
    return metrics.agg(best.alias("b")).select("b.file", (-F.col("b.s")).alias(score))


def rank_assemblies(metrics: DataFrame, score: str = "assemblyScore") -> DataFrame:
    return number_rows(metrics, [(F.col(score), False), F.col("file")], name="rank")


def concat_contigs(*sets: DataFrame) -> DataFrame:
    """All contigs with names made unique by their file."""
    out = sets[0]
    for s in sets[1:]:
        out = out.unionByName(s)
    return out.withColumn("name", F.concat_ws("_", "file", "name"))


def overlay(base: DataFrame, later: DataFrame, key: Sequence[str]) -> DataFrame:
    """Union in which the later source replaces rows with the same key."""
    both = later.withColumn("_rank", F.lit(0)).unionByName(base.withColumn("_rank", F.lit(1)))
    rest = [c for c in base.columns if c not in key]
    return first_per_key(both, list(key), [F.col("_rank"), *[F.col(c) for c in rest]]).select(*base.columns)


def concatenate_with(contigs: DataFrame, joiner: str, by: Sequence[str] = ("file",)) -> DataFrame:
    """Layout of one long sequence per group: each contig with its number and its 1-based start in the whole."""
    numbered = number_rows(contigs, [F.col("name"), F.md5("seq")], within=by, name="k")
    sized = numbered.select(*by, "k", (F.length("seq") + F.lit(len(joiner))).alias("_len"))
    ends = running_sum(sized, by, "k", {"_end": "_len"}, width=1 << 12).select(*by, "k", (F.col("_end") - F.col("_len") + 1).alias("start"))
    return numbered.join(ends, [*by, "k"]).select(*contigs.columns, "k", "start")


def concatenated(contigs: DataFrame, joiner: str, by: Sequence[str] = ("file",)) -> DataFrame:
    """(by, piece, seq): the contigs of a group in order of name with the joiner between them, in pieces of one width."""
    placed = concatenate_with(contigs, joiner, by).withColumn("_key", F.struct(*by))
    text = F.concat("seq", F.when(F.col("k") < F.col("_last"), F.lit(joiner)).otherwise(F.lit("")))
    last = placed.groupBy("_key").agg(F.max("k").alias("_last"))
    parts = placed.join(last, "_key").withColumn("_text", text)
    return pieces.lay_end_to_end(parts, "_key", "start", "_text").select("_key.*", "piece", "seq")


def rename_contigs(contigs: DataFrame, prefix: str = "contig") -> DataFrame:
    """``contig%06d`` over the whole output, in order of file and name (of equal ones, by digest)."""
    numbered = number_rows(contigs, [F.col("file"), F.col("name"), F.md5("seq")], name="_n")
    return numbered.withColumn("name", F.format_string(f"{prefix}%06d", "_n")).drop("_n")


def _cut_at_gaps(keys: Sequence[str], texts: Sequence[str], min_gap: int):
    """Arrow batches of contigs -> their parts between long gaps, told apart by number and place."""
    gap = re.compile(f"[Nn]{{{min_gap},}}")

    def parts(seq: str):
        # N at the start go whatever their number
        i, at = 0, len(seq) - len(seq.lstrip("Nn"))
        for found in gap.finditer(seq, at):
            if found.start() > at:
                yield i, at, found.start()
            i, at = i + 1, found.end()
        if at < len(seq):
            yield i, at, len(seq)

    def table_of(batch: pa.RecordBatch, rows: list, of: list) -> pa.RecordBatch:
        contig, i, start = zip(*rows)
        return pa.RecordBatch.from_arrays(
            [*[batch.column(c).take(pa.array(contig)) for c in keys], pa.array(i, pa.int64()), pa.array(start, pa.int32()), *[pa.array(x, pa.string()) for x in of]],
            names=[*keys, "i", "start", *texts])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, of, letters = [], [[] for _ in texts], 0
            for contig in range(batch.num_rows):
                whole = [batch.column(c)[contig].as_py() for c in texts]
                if whole[0] is None:
                    continue
                for i, at, end in parts(whole[0]):
                    rows.append((contig, i, at + 1))
                    for x, text in zip(of, whole):
                        x.append(None if text is None else text[at:end])
                    letters += end - at
                    if letters >= BATCH_LETTERS or len(rows) >= BATCH_ROWS:
                        yield table_of(batch, rows, of)
                        rows, of, letters = [], [[] for _ in texts], 0
            if rows:
                yield table_of(batch, rows, of)

    return run


def split_at_gaps(contigs: DataFrame, min_gap: int, qual: str | None = None) -> DataFrame:
    """Cut at runs of at least ``min_gap`` N; leading N go with the first cut.

    A contig is cut in the task that holds its row, so nothing is moved; parts leave in batches.
    """
    texts = ["seq", *([qual] if qual else [])]
    keys = [c for c in contigs.columns if c not in texts]
    schema = ", ".join(f"`{c}` {contigs.schema[c].dataType.simpleString()}" for c in keys)
    named = ", ".join(f"`{c}` string" for c in texts)
    out = contigs.mapInArrow(_cut_at_gaps(keys, texts, min_gap), f"{schema}, i bigint, start int, {named}")
    return out.withColumn("name", F.concat("name", F.lit("_subcontig"), "i")).select(*contigs.columns, "start")


def tile(contigs: DataFrame, length: int = 5_000_000, size: str | None = None) -> DataFrame:
    """Windows of ``length`` per sequence; the last one absorbs a rest below a tenth."""
    n = F.col(size) if size else F.length("seq")
    whole = F.greatest(F.floor((n * 10 - 11 * length) / F.lit(10.0 * length)) + 1, F.lit(0))
    tiled = contigs.filter(n > 0).select("file", "name", n.cast("bigint").alias("_n"), whole.alias("_w"),
                                         F.explode(F.sequence(F.lit(0), whole)).alias("_i"))
    end = F.when(F.col("_i") == F.col("_w"), F.col("_n")).otherwise((F.col("_i") + 1) * length)
    return tiled.select("file", "name", (F.col("_i") * length + 1).alias("beg"), end.alias("end"))


def well_placed(mentions: DataFrame, limit: int = 3, key: str = "contig") -> DataFrame:
    return mentions.groupBy(key).agg(F.count("*").alias("mentions")).filter(F.col("mentions") < limit)


def sequence_md5(contigs: DataFrame) -> DataFrame:
    return contigs.select("file", "name", dna.letters_md5("seq").alias("md5"))


def set_md5(contigs: DataFrame, by: Sequence[str] = ("file",)) -> DataFrame:
    """Order-free fingerprint: the digests combined by exclusive or, 32 bits at a time."""
    digest = dna.letters_md5("seq")
    words = [F.bit_xor(F.conv(F.substring(digest, 1 + 8 * i, 8), 16, 10).cast("bigint")) for i in range(4)]
    return contigs.groupBy(*by).agg(
        F.concat(*[F.lpad(F.lower(F.hex(w)), 8, "0") for w in words]).alias("md5")
    )


def parse_regions(df: DataFrame, column: str = "region") -> DataFrame:
    """``chr:beg-end`` with thousands commas -> (name, beg, end); the end of an open region is null."""
    text = F.replace(F.col(column), F.lit(","), F.lit(""))
    pattern = r"^(.*?)(?::(\d*)(?:(-)(\d*))?)?$"
    beg = F.regexp_extract(text, pattern, 2).try_cast("bigint")
    end = F.regexp_extract(text, pattern, 4).try_cast("bigint")
    return df.withColumns(
        {
            "name": F.regexp_extract(text, pattern, 1),
            "beg": F.greatest(F.coalesce(beg, F.lit(1)), F.lit(1)),
            "end": end,
        }
    )


def subseq(contigs: DataFrame, regions: DataFrame) -> DataFrame:
    """Sub-sequences of (name, beg, end), clamped to the contig; a null end is the contig's."""
    sized = regions.join(contigs.select("name", F.length("seq").alias("_n")), "name")
    lo = F.least(F.greatest(F.col("beg"), F.lit(1)), F.col("_n"))
    hi = F.least(F.greatest(F.coalesce("end", "_n"), lo), F.col("_n"))
    asked = sized.withColumns({"_lo": lo.cast("bigint"), "_hi": hi.cast("bigint")})
    return pieces.fetch(asked, pieces.cut(contigs), ("name", "_lo", "_hi")).select(*regions.columns, "seq")


def parse_scaffold_spec(specs: DataFrame, default_spacing: int = 10) -> DataFrame:
    """``contig:spacing:-contig`` per (scaffold, spec) -> one row per part."""
    fields = F.split("spec", ":")
    count = F.ceil(F.size(fields) / 2).cast("int")
    part = F.transform(F.sequence(F.lit(0), count - 1), lambda i: F.struct(
        F.get(fields, i * 2).alias("text"),
        F.coalesce(F.nullif(F.get(fields, i * 2 + 1), F.lit("")).cast("int"), F.lit(default_spacing)).alias("gap"),
    ))
    rows = specs.select("scaffold", F.posexplode(part).alias("idx", "p"))
    sign = F.regexp_extract("p.text", "^([+-])", 1)
    return rows.select(
        "scaffold", "idx",
        F.when(sign == "", F.lit("+")).otherwise(sign).alias("strand"),
        F.regexp_replace("p.text", "^[+-]", "").alias("name"),
        F.col("p.gap").alias("gap"),
    )


def scaffold_pieces(contigs: DataFrame, parts: DataFrame) -> DataFrame:
    """(name, piece, seq) of scaffolds from ordered, signed contigs with N between them; other contigs pass through."""
    sized = parts.join(contigs.select("name", F.length("seq").alias("_n")), "name")
    last = sized.groupBy("scaffold").agg(F.max("idx").alias("_last"), F.array_join(F.transform(
        F.array_sort(F.collect_list(F.struct("idx", F.concat("strand", "name").alias("id")))), lambda x: x["id"]), "_").alias("_ids"))
    spaced = sized.join(last, "scaffold").withColumn("_gap", F.when(F.col("idx") < F.col("_last"), F.col("gap")).otherwise(0))
    spaced = spaced.withColumn("_len", (F.col("_n") + F.col("_gap")).cast("bigint"))
    placed = running_sum(spaced.select("scaffold", "idx", "_len"), ["scaffold"], "idx", {"_end": "_len"}).select(
        "scaffold", "idx", (F.col("_end") - F.col("_len") + 1).alias("start"))
    laid = spaced.join(placed, ["scaffold", "idx"]).join(contigs.select("name", "seq"), "name")
    oriented = F.when(F.col("strand") == "-", dna.reverse_complement("seq")).otherwise(F.col("seq"))
    laid = laid.select(
        F.concat(F.lit("Scaffold"), "scaffold", F.lit("_"), "_ids").alias("_scaffold"), "start", F.concat(oriented, F.repeat(F.lit("N"), F.col("_gap").cast("int"))).alias("_text"))
    built = pieces.lay_end_to_end(laid, "_scaffold", "start", "_text").withColumnRenamed("_scaffold", "name")
    rest = contigs.join(parts.select("name").distinct(), "name", "left_anti")
    return built.unionByName(pieces.cut(rest).select("name", "piece", "seq"))


def build_scaffolds(contigs: DataFrame, parts: DataFrame) -> DataFrame:
    """``scaffold_pieces`` with each sequence in one row."""
    return pieces.join_pieces(scaffold_pieces(contigs, parts))


def add_linker(contigs: DataFrame, linker: str) -> DataFrame:
    return contigs.withColumn("seq", F.concat(F.lit(linker), "seq", F.lit(linker)))


def remove_linker(contigs: DataFrame, features: DataFrame, linker: str) -> tuple[DataFrame, DataFrame]:
    """Strip linkers from both ends and move the features of each contig along."""
    stripped = contigs.withColumn("_head", F.regexp_replace("seq", f"^(?:{linker})+", ""))
    stripped = stripped.withColumn("_cut", F.when(F.length("_head") < F.length("seq"), len(linker)).otherwise(0))
    clean = stripped.withColumn("seq", F.regexp_replace("_head", f"(?:{linker})+$", "")).drop("_head")
    sizes = clean.select(F.col("name").alias("seqname"), "_cut", F.length("seq").alias("_len"))
    moved = features.join(sizes, "seqname").withColumns(
        {
            "lo": F.greatest(F.col("lo") - F.col("_cut"), F.lit(1)),
            "hi": F.least(F.col("hi") - F.col("_cut"), F.col("_len")),
        }
    )
    return clean.drop("_cut"), moved.select(*features.columns)

"""Per-site views of alignments: bases, counts, consensus and edits.

Site operators work on counts that are combined before the shuffle wherever
counts are enough, so a very deep site costs a task no more than a shallow one.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import cigar as cg
from ..functions import dna
from . import pieces
from .scale import number_rows

# Ambiguity codes of two bases.
AMBIGUITY = {
    "AA": "A", "CC": "C", "GG": "G", "TT": "T", "AC": "M", "AG": "R", "AT": "W", "CG": "S", "CT": "Y", "GT": "K",
}
# Fixed values of the genotype model.
DEPENDENCY, FLOOR, CAP_MAPQ, HET_PENALTY = 0.85, 0.03, 60, 27
LINES = "ref string, depth bigint, bases string, quals string, mapqs string"
CHUNK = 1 << 12
#: Bits of the bins in which reads look for wanted sites.
SITE_BITS = 8
#: Blocks of one bin that one task takes.
BIN_BLOCKS = 1 << 20
#: Blocks that one task takes, unless one bin has more, and those that are worth a task of their own.
PART_BLOCKS, MIN_BLOCKS = 1 << 17, 1 << 12


def reference_for(df: DataFrame, contigs: DataFrame) -> DataFrame:
    """Adds ``refseq``: the reference under each record, shorter at the end of the contig."""
    placed = df.withColumn("_end", F.col("pos").cast("bigint") + cg.reference_span("cigar") - 1)
    return pieces.fetch(placed, pieces.cut(contigs), ("rname", "pos", "_end"), ["refseq"]).drop("_end")


def aligned_blocks(df: DataFrame, keep: Sequence[str] = (), mask: int = cg.PILEUP_MASK, min_mapq: int = 0) -> DataFrame:
    """A row per aligned or deleted block: its place ``_at`` and length ``_len`` and the texts that belong to it."""
    kept = df.filter(cg.lacks("flag", mask) & (F.col("mapq") >= min_mapq))
    # the texts of a block travel with it; the whole read stays behind
    rows = kept.select("rname", "pos", "mapq", cg.has("flag", cg.REVERSE).alias("back"), *[c for c in keep if c not in ("rname", "pos", "mapq")], "seq", "qual", F.explode(cg.aligned("cigar")).alias("x"))
    x, match = F.col("x"), F.col("x.op") == "M"
    texts = {
        "_op": x["op"], "_at": (F.col("pos") + x["ref"]).cast("bigint"), "_len": x["len"], "_after": x["after"],
        "_ins": F.when(x["after"] > 0, F.substr("seq", x["nxt"] + 1, x["after"])).otherwise(F.lit("")),
        "_s": F.when(match, F.upper(F.substr("seq", x["qry"] + 1, x["len"]))),
        "_q": F.rpad(F.substr("qual", x["qry"] + 1, x["len"]), x["len"], F.lit("!")), "_opens": x["opens"], "_closes": x["closes"]}
    return rows.select("rname", "mapq", "back", *keep, *[v.alias(k) for k, v in texts.items()])


def _bins(at: Column, size: Column, bits: int) -> Column:
    """Bins that a block touches; a block without a place is in the bin null."""
    return F.when(at.isNull(), F.array(F.lit(None).cast("bigint"))).otherwise(F.sequence(F.shiftright(at, bits), F.shiftright(at + size - 1, bits)))


def cut_blocks(rows: DataFrame, bits: int, name: str, texts: Sequence[str] = ("_s", "_q")) -> DataFrame:
    """Blocks cut at the edges of bins of ``1 << bits`` positions; ``name`` is the bin. What follows a block stays with its end."""
    lo, size = F.col("_at"), F.col("_len")
    rows = rows.withColumn(name, F.explode(_bins(lo, size, bits)))
    first = F.greatest(F.shiftleft(F.col(name), bits) - lo, F.lit(0)).cast("int")
    stop = F.least(F.shiftleft(F.col(name) + 1, bits) - lo, size).cast("int")
    last = stop == size
    moved = {"_at": lo + first, "_len": stop - first, "_opens": F.col("_opens") & (first == 0), "_closes": F.col("_closes") & last,
             "_after": F.when(last, F.col("_after")).otherwise(0), "_ins": F.when(last, F.col("_ins")).otherwise(F.lit(""))}
    return rows.withColumns(moved | {c: F.substr(c, first + 1, stop - first) for c in texts})


def block_counts(kept: DataFrame) -> tuple[DataFrame, int, int]:
    """Blocks of the records ``kept`` per bin of sites, how many there are in all, and in the fullest bin."""
    block = F.explode(cg.aligned("cigar")).alias("b")
    spans = _bins(F.col("pos").cast("bigint") + F.col("b.ref"), F.col("b.len"), SITE_BITS)
    per = kept.select("rname", "pos", block).select("rname", F.explode(spans).alias("_bin")).groupBy("rname", "_bin").agg(F.count("*").alias("_n"))
    return per, *per.agg(F.coalesce(F.sum("_n"), F.lit(0)), F.coalesce(F.max("_n"), F.lit(0))).first()


def parts_for(rows: DataFrame, total: int) -> int:
    """A task takes a bounded number of blocks, however many there are."""
    return max(-(-total // PART_BLOCKS), min(rows.sparkSession.sparkContext.defaultParallelism, -(-total // MIN_BLOCKS)), 1)


def deal_blocks(rows: DataFrame, kept: DataFrame, most: int | None = None) -> DataFrame:
    """Blocks dealt by bin, so all that is asked of a site is answered where its blocks are.

    A bin of more than ``most`` blocks of the records ``kept`` is dealt to several tasks (``_salt``), whose sums have
    to be added.
    """
    most = most or BIN_BLOCKS
    per, total, top = block_counts(kept)
    parts = parts_for(rows, total)
    if top <= most:
        return rows.repartition(parts, "rname", "_bin")
    deep = per.filter(F.col("_n") > most).select(F.col("rname").alias("_r"), F.col("_bin").alias("_d"), F.ceil(F.col("_n") / most).alias("_n"))
    met = rows.join(F.broadcast(deep), F.col("rname").eqNullSafe(F.col("_r")) & F.col("_bin").eqNullSafe(F.col("_d")), "left")
    salt = F.coalesce(F.pmod(F.monotonically_increasing_id(), F.col("_n")) + 1, F.lit(0))
    return met.withColumn("_salt", salt).drop("_r", "_d", "_n").repartition(parts, "rname", "_bin", "_salt")


def _bases_of(rows: DataFrame, keep: Sequence[str]) -> DataFrame:
    """Rows of blocks with the offset ``_j`` -> rows of bases."""
    last = F.col("_j") == F.col("_len") - 1
    return rows.select(
        "rname", (F.col("_at") + F.col("_j")).alias("pos"),
        F.when(F.col("_op") == "D", F.lit("*")).otherwise(F.substr("_s", F.col("_j") + 1, F.lit(1))).alias("base"),
        (F.ascii(F.substr("_q", F.col("_j") + 1, F.lit(1))) - 33).alias("q"),
        "mapq", "back", F.when(last, F.col("_after")).otherwise(0).alias("indel"), F.when(last, F.col("_ins")).otherwise(F.lit("")).alias("ins"),
        (F.col("_opens") & (F.col("_j") == 0)).alias("head"), (F.col("_closes") & last).alias("tail"), *[F.col(c) for c in keep])


def read_bases(df: DataFrame, keep: Sequence[str] = (), mask: int = cg.PILEUP_MASK, min_mapq: int = 0,
               sites: DataFrame | None = None) -> DataFrame:
    """One row per aligned base or deleted position of every record, or only those at ``sites`` (rname, pos).

    Columns: rname, pos, base ('*' when deleted), qual, mapq, back (strand), indel
    (length after this base, negative for a deletion), ins (inserted text), head, tail.
    Without ``sites`` the blocks are dealt by bin before they fall into bases, and rows carry the columns ``_bin``
    (and ``_salt``, see ``deal_blocks``) that they are dealt by.
    """
    rows = aligned_blocks(df, keep, mask, min_mapq)
    if sites is None:
        kept = df.filter(cg.lacks("flag", mask) & (F.col("mapq") >= min_mapq))
        dealt = deal_blocks(cut_blocks(rows, SITE_BITS, "_bin"), kept)
        return _bases_of(dealt.withColumn("_j", F.explode(F.sequence(F.lit(0), F.col("_len") - 1))), [*keep, *dealt_by(dealt)])
    # blocks are cut at bin edges, and only those in the bin of a site fall into bases
    lo, hi = F.col("_at"), F.col("_at") + F.col("_len") - 1
    rows = rows.withColumn("_bin", F.explode(F.sequence(F.shiftright(lo, SITE_BITS), F.shiftright(hi, SITE_BITS))))
    spots = sites.select("rname", F.col("pos").cast("bigint").alias("pos")).distinct()
    rows = rows.join(spots.select("rname", F.shiftright("pos", SITE_BITS).alias("_bin")).distinct(), ["rname", "_bin"], "left_semi")
    first = F.greatest(F.shiftleft("_bin", SITE_BITS) - lo, F.lit(0)).cast("int")
    end = F.least(F.shiftleft(F.col("_bin") + 1, SITE_BITS) - 1 - lo, hi - lo).cast("int")
    each = rows.select("*", F.explode(F.sequence(first, end)).alias("_j")).withColumn("_p", lo + F.col("_j"))
    each = each.join(spots.withColumnRenamed("pos", "_p"), ["rname", "_p"], "left_semi")
    return _bases_of(each, keep)


def dealt_by(rows: DataFrame) -> list[str]:
    """Columns besides the reference that rows of blocks or bases are dealt by."""
    return [c for c in ("_bin", "_salt") if c in rows.columns]


def sums_by_site(bases: DataFrame, by: Sequence[str | Column], sums: Sequence[Column]) -> list[DataFrame]:
    """``bases`` grouped by site (and more), with ``_bin`` where they are dealt by it: each site is whole in one of the tables.

    ``sums`` are counts and sums. Those of bins that are dealt to several tasks are added up in a table of their own.
    """
    dealt = dealt_by(bases)
    grouped = bases.groupBy(*by, *dealt).agg(*sums)
    if "_salt" not in dealt:
        return [grouped]
    keys = [c for c in grouped.columns[:len(by)]]
    added = [F.sum(c).alias(c) for c in grouped.columns[len(by) + len(dealt):]]
    return [grouped.filter("_salt = 0"), grouped.filter("_salt > 0").drop("_salt").groupBy(*keys, "_bin").agg(*added)]


def site_counts(bases: DataFrame, by: Sequence[str] = ("rname", "pos")) -> DataFrame:
    """Depth, counts per base, insertions, deletions and RMS mapping quality per site."""
    capped = F.least(F.col("mapq"), F.lit(CAP_MAPQ)).cast("bigint")
    sums = [
        F.count("*").alias("depth"),
        *[F.count_if(F.col("base") == b).alias(b) for b in "ACGT"],
        F.count_if(F.col("base") == "*").alias("deleted"),
        F.count_if(~F.col("base").isin("A", "C", "G", "T", "*")).alias("other"),
        F.count_if(F.col("indel") > 0).alias("insertions"),
        F.count_if(F.col("indel") < 0).alias("deletions"),
        F.count_if("head").alias("starts"),
        F.count_if("tail").alias("ends"),
    ]
    names = [*by, "depth", *"ACGT", "deleted", "other", "insertions", "deletions", "starts", "ends"]
    rms = F.floor(F.sqrt(F.col("_sq") / F.col("depth")) + 0.499).cast("int").alias("rms_mapq")
    parts = [x.select(*names, rms) for x in sums_by_site(bases, by, [*sums, F.sum(capped * capped).alias("_sq")])]
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def pileup(df: DataFrame, order: Sequence[str], contigs: DataFrame | None = None, mask: int = cg.PILEUP_MASK,
           min_mapq: int = 0, sites: DataFrame | None = None, part_size: int = 10_000, by: Sequence[str] = ()) -> DataFrame:
    """Pileup lines: reference base, depth, bases, qualities and mapping qualities as text.

    A line longer than ``part_size`` reads continues in further rows (``part`` 1, 2,
    ...), so no row and no task holds an unbounded site. ``sites`` restricts the
    output; ``by`` adds grouping columns such as the sample.
    """
    return _pileup(df, order, contigs, mask, min_mapq, sites, part_size, by).drop("_bin")


def _pileup(df, order, contigs, mask, min_mapq, sites, part_size, by, packed=False) -> DataFrame:
    """``pileup`` with the bin that its sites are dealt by; ``packed``: a row per site, all ``lines`` in it, if no site is deep."""
    source = reference_for(df, contigs) if contigs is not None else df.withColumn("refseq", F.lit(""))
    source = source.withColumn("_start", F.col("pos"))
    shown_order = [c for c in order if c not in ("rname", "pos")]
    keep = list(dict.fromkeys([*by, "_start", *[c for c in order if c not in ("rname", "pos", "mapq")]]))
    rows = aligned_blocks(source, [*keep, "refseq"], mask, min_mapq)
    # the reference under a block, and what is lost after it
    at = (F.col("_at") - F.col("_start") + 1).cast("int")
    lost = F.rpad(F.substr("refseq", at + F.col("_len"), -F.col("_after")), -F.col("_after"), F.lit("N"))
    rows = rows.withColumns({"_r": F.substr("refseq", at, F.col("_len")), "_lost": lost}).drop("refseq")
    ranks = ["_start", *[c for c in shown_order if c not in by], "t", "qc", "mc"]

    def letters(x, j) -> dict[str, Column]:
        """What a block shows at its offset ``j``; ``x`` gives its columns."""
        op, back, mapq, after = x("_op"), x("back"), x("mapq"), x("_after")
        base = F.when(op == "D", F.lit("*")).otherwise(F.substr(x("_s"), j + 1, F.lit(1)))
        last = j == x("_len") - 1
        ref = F.substr(x("_r"), j + 1, F.lit(1))
        ref = F.when(ref == "", F.lit("N")).otherwise(ref)
        shown = F.when(base == "*", base).when(base == F.upper(ref), F.when(back, F.lit(",")).otherwise(F.lit("."))).otherwise(
            F.when(back, F.lower(base)).otherwise(base))
        changed = F.when(after > 0, F.concat(F.lit("+"), after, x("_ins"))).when(after < 0, F.concat(after.cast("string"), x("_lost")))
        changed = F.when(last & (base != "*") & (after != 0), F.when(back, F.lower(changed)).otherwise(F.upper(changed))).otherwise(F.lit(""))
        start = F.when(x("_opens") & (j == 0), F.concat(F.lit("^"), F.char(F.least(mapq + 33, F.lit(126))))).otherwise(F.lit(""))
        text = F.concat(start, shown, changed, F.when(x("_closes") & last, F.lit("$")).otherwise(F.lit("")))
        quality = F.ascii(F.substr(x("_q"), j + 1, F.lit(1))) - 33
        return {"ref": F.upper(ref), "t": text, "qc": F.char(F.least(quality + 33, F.lit(126))), "mc": F.char(F.least(mapq + 33, F.lit(126)))}

    def finish(grouped: DataFrame, keys: list[str], part: Column) -> DataFrame:
        def text_of(f):
            return F.array_join(F.transform("p", lambda x: x[f]), "")

        return grouped.select(*keys, part.alias("part"), "ref", "depth", text_of("t").alias("bases"), text_of("qc").alias("quals"), text_of("mc").alias("mapqs"))

    def by_base(rows: DataFrame, first: Column, last: Column, spots: DataFrame, how: str) -> DataFrame:
        """A row per base of the blocks at, or away from, ``spots``."""
        each = rows.withColumn("_j", F.explode(F.sequence(first, last))).withColumn("pos", F.col("_at") + F.col("_j")).join(spots, ["rname", "pos"], how)
        show = letters(F.col, F.col("_j"))
        return each.select(*by, "rname", "pos", "_bin", *[v.alias(k) for k, v in show.items()], "_start", *[F.col(c) for c in shown_order if c not in by])

    def gathered(lines: DataFrame, extra: Sequence[str] = ()) -> DataFrame:
        keys = [*by, "rname", "_bin", "pos"]
        packed = F.array_sort(F.collect_list(F.struct(*ranks))).alias("p")
        grouped = lines.groupBy(*keys, *extra).agg(F.max("ref").alias("ref"), F.count("*").alias("depth"), packed)
        return finish(grouped, keys, F.col("part") if extra else F.lit(0))

    def by_bin(rows: DataFrame) -> DataFrame:
        """Lines of whole bins: a block arrives in its bin and falls into bases there, in arrays."""
        own, group = [c for c in shown_order if c not in by], ["_bin", "rname"]
        dealt = rows.repartition(parts, "rname", "_bin")
        back, match, after = F.col("back"), F.col("_op") == "M", F.col("_after")
        changed = F.when(after > 0, F.concat(F.lit("+"), after, "_ins")).when(after < 0, F.concat(after.cast("string"), "_lost"))
        changed = F.when(match & (after != 0), F.when(back, F.lower(changed)).otherwise(F.upper(changed))).otherwise(F.lit(""))
        mapq = F.char(F.least(F.col("mapq") + 33, F.lit(126)))
        marks = match.cast("int") + F.when(back, 2).otherwise(0) + F.when(F.col("_closes"), 4).otherwise(0) + F.when(F.col("_s").isNull() & match, 8).otherwise(0)
        shown = dealt.select(
            *group, *by, "_at", "_len", F.dense_rank().over(Window.partitionBy(*group).orderBy("_start", *own)).alias("_rank"), marks.alias("_marks"),
            F.when(F.col("_opens"), F.concat(F.lit("^"), mapq)).otherwise(F.lit("")).alias("_head"), changed.alias("_changed"), mapq.alias("_mc"),
            # of the length of the block, whatever there is; what a base lacks is shown as nothing
            F.when(match, F.rpad(F.coalesce("_s", F.lit("")), F.col("_len"), F.lit("\0"))).otherwise(F.repeat(F.lit("*"), F.col("_len"))).alias("_s"),
            F.coalesce("_q", F.repeat(F.lit("~"), F.col("_len"))).alias("_q"), F.coalesce(F.rpad(F.upper("_r"), F.col("_len"), F.lit("N")), F.repeat(F.lit("\0"), F.col("_len"))).alias("_r"))
        kinds = {c: f"`{c}` {shown.schema[c].dataType.simpleString()}" for c in (*group, *by)}
        line = ", ".join([*(kinds[c] for c in by), LINES])
        return shown.groupBy(*group).applyInArrow(_lines_of(group, by), f"{', '.join(kinds[c] for c in group)}, pos bigint, lines array<struct<{line}>>")

    def singly(sites: DataFrame) -> DataFrame:
        lines = sites.select("rname", "_bin", "pos", F.inline("lines"))
        return lines.select(*by, "rname", "_bin", "pos", F.lit(0).alias("part"), "ref", "depth", "bases", "quals", "mapqs")

    from .alignments import depth_runs

    # A site is no deeper than its bin has blocks; the sweep over block ends finds deep ones without looking at bases.
    _, total, top = block_counts(df.filter(cg.lacks("flag", mask) & (F.col("mapq") >= min_mapq)))
    parts = parts_for(df, total)
    deep = depth_runs(df, mask, min_mapq).filter(F.col("depth") > part_size)
    has_deep = top > part_size and not deep.isEmpty()
    deep = deep.select("rname", F.explode(F.sequence(F.col("beg").cast("bigint"), F.col("end").cast("bigint"))).alias("pos"))
    zero, end = F.lit(0), F.col("_len") - 1
    if sites is not None:
        # blocks are cut at bin edges, and only those in the bin of a site fall into bases
        spots = sites.select("rname", F.col("pos").cast("bigint").alias("pos")).distinct()
        wanted = spots.select("rname", F.shiftright("pos", SITE_BITS).alias("_bin")).distinct()
        rows = cut_blocks(rows, SITE_BITS, "_bin", ("_s", "_q", "_r")).join(wanted, ["rname", "_bin"], "left_semi")
        lines = by_base(rows, zero, end, spots, "left_semi")
        if not has_deep:
            return gathered(lines)
        usual, lines = gathered(lines.join(deep, ["rname", "pos"], "left_anti")), lines.join(deep, ["rname", "pos"], "left_semi")
    else:
        rows = cut_blocks(rows, SITE_BITS, "_bin", ("_s", "_q", "_r"))
        if not has_deep:
            return by_bin(rows) if packed else singly(by_bin(rows))
        # bins with a deep site go base by base
        bins = deep.select("rname", F.shiftright("pos", SITE_BITS).alias("_bin")).distinct()
        among = rows.join(bins, ["rname", "_bin"], "left_semi")
        usual = singly(by_bin(rows.join(bins, ["rname", "_bin"], "left_anti"))).unionByName(gathered(by_base(among, zero, end, deep, "left_anti")))
        lines = by_base(among, zero, end, deep, "left_semi")
    numbered = number_rows(lines, [F.col(c) for c in ranks], within=[*by, "rname", "pos"], name="_n")
    parts = numbered.withColumn("part", F.floor((F.col("_n") - 1) / part_size).cast("int"))
    return usual.unionByName(gathered(parts, ["part"]))


def _letters(texts: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all texts in a row, and how many each has (none for a null)."""
    joined = "".join(x or "" for x in texts.to_pylist()).encode("utf-32-le")
    return np.frombuffer(joined, dtype=np.uint32), pc.utf8_length(texts).fill_null(0).to_numpy().astype(np.int64)


def _lowered(points: np.ndarray) -> np.ndarray:
    out = np.where((points >= 65) & (points <= 90), points + 32, points)
    for x in np.unique(points[points > 127]):
        low = chr(x).lower()
        out[points == x] = ord(low) if len(low) == 1 else x
    return out


def _within(n: np.ndarray) -> np.ndarray:
    """0, 1, .. n - 1 for each of ``n`` in a row."""
    return np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)


def _lines_of(group: Sequence[str], by: Sequence[str]):
    """The blocks of a bin, cut at its edges -> its sites, each with a pileup line for each value of ``by``."""
    def lines(table: pa.Table) -> pa.Table:
        at, size, rank, marks = (table.column(c).combine_chunks().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("_at", "_len", "_rank", "_marks"))
        who = np.zeros(len(at), np.int64)
        for c in by:
            code = table.column(c).combine_chunks().dictionary_encode(null_encoding="encode").indices.to_numpy(zero_copy_only=False).astype(np.int64)
            who = np.unique(who * (code.max() + 1) + code, return_inverse=True)[1]
        # reads without a place show all their bases in one line
        nowhere = table.column("_at").null_count == len(table)
        row, j = np.repeat(np.arange(len(at)), size), _within(size)
        last = j == size[row] - 1
        pos = np.zeros(len(row), np.int64) if nowhere else at[row] + j
        (base, _), (qual, _), (ref, _) = (_letters(table.column(c)) for c in ("_s", "_q", "_r"))
        back, void = marks[row] & 2 > 0, marks[row] & 8 > 0
        shown = np.where((base == ref) & (ref > 0), np.where(back, ord(","), ord(".")), np.where(back, _lowered(base), base))
        shown = np.where(base == ord("*"), base, shown)
        heads, head_size = _letters(table.column("_head"))
        changes, change_size = _letters(table.column("_changed"))
        mapqs, mapq_size = _letters(table.column("_mc"))
        qual = np.minimum(qual, 126)

        # the texts that are put together at a base, each with its letters, where they start and how many there are
        own = np.arange(len(row))
        texts = [
            (heads, (np.cumsum(head_size) - head_size)[row], np.where((j == 0) & ~void, head_size[row], 0)),
            (shown, own, np.where(void | (shown == 0), 0, 1)),
            (changes, (np.cumsum(change_size) - change_size)[row], np.where(last & ~void, change_size[row], 0)),
            (np.array([ord("$")], np.uint32), np.zeros(len(row), np.int64), (last & (marks[row] & 4 > 0) & ~void).astype(np.int64))]

        def text(i: int) -> str:
            return "".join("".join(map(chr, points[start[i] : start[i] + n[i]])) for points, start, n in texts)

        order = np.lexsort((rank[row], who[row], pos))
        new = pos[order][1:] != pos[order][:-1]
        line = new | (who[row][order][1:] != who[row][order][:-1])
        tied = ~line & (rank[row][order][1:] == rank[row][order][:-1])
        if tied.any():
            # bases of equal reads, or of one read without a place, go by what they show
            begins = np.flatnonzero(np.concatenate(([True], ~tied)))
            for first, stop in zip(begins, [*begins[1:], len(order)]):
                if stop - first > 1:
                    some = order[first:stop].tolist()
                    held = {i: ((0, "") if void[i] else (1, text(i)), int(qual[i]), int(mapqs[(np.cumsum(mapq_size) - mapq_size)[row[i]]]) if mapq_size[row[i]] else 0) for i in some}
                    order[first:stop] = sorted(some, key=held.__getitem__)
        sites = np.flatnonzero(np.concatenate(([True], line)))

        def put(parts: list) -> pa.Array:
            """The parts of each base in order, joined by site."""
            n = np.stack([n[order] for _, _, n in parts], axis=1)
            to = np.cumsum(n.ravel()) - n.ravel()
            out = np.zeros(n.sum(), np.uint32)
            for k, (points, start, _) in enumerate(parts):
                some = n[:, k] > 0
                m = n[some, k]
                step = _within(m)
                out[np.repeat(to[k :: len(parts)][some], m) + step] = points[np.repeat(start[order][some], m) + step]
            edges = np.concatenate((to[:: len(parts)][sites], [len(out)]))
            if len(out) == 0 or out.max() < 128:
                return pa.StringArray.from_buffers(len(sites), pa.py_buffer(edges.astype(np.int32)), pa.py_buffer(out.astype(np.uint8)))
            return pa.array([out[a:b].tobytes().decode("utf-32-le") for a, b in zip(edges[:-1], edges[1:])], pa.string())

        top = np.maximum.reduceat(ref[order], sites)
        first = np.flatnonzero(np.concatenate(([True], new)))
        edges = np.searchsorted(sites, np.concatenate((first, [len(order)]))).astype(np.int32)
        parts = {
            **{c: table.column(c).combine_chunks().take(pa.array(row[order][sites])) for c in by}, "ref": pa.array([chr(x) if x else None for x in top], pa.string()),
            "depth": pa.array(np.diff(np.concatenate((sites, [len(order)])))), "bases": put(texts), "quals": put([(qual, own, (qual > 0).astype(np.int64))]),
            "mapqs": put([(mapqs, (np.cumsum(mapq_size) - mapq_size)[row], mapq_size[row])])}
        return pa.table({
            **{c: table.column(c).combine_chunks().take(pa.array(row[order][first])) for c in group},
            "pos": pa.nulls(len(first), pa.int64()) if nowhere else pa.array(pos[order][first]),
            "lines": pa.ListArray.from_arrays(pa.array(edges), pa.StructArray.from_arrays(list(parts.values()), names=list(parts)))})

    return lines


def mpileup(df: DataFrame, sample: str, samples: Sequence[str], order: Sequence[str], **options) -> DataFrame:
    """One column group per sample; a sample without reads at a site shows depth 0 and ``*``."""
    defaults = {"contigs": None, "mask": cg.PILEUP_MASK, "min_mapq": 0, "sites": None, "part_size": 10_000}
    lines = _pileup(df, order, by=[sample], packed=True, **(defaults | options))
    if "lines" in lines.columns:
        def line_of(s):
            return F.get(F.filter("lines", lambda x: x[sample] == s), F.lit(0))

        found = [line_of(s) for s in samples]
        each = lines.select("rname", "pos", *[f.alias(f"_{i}") for i, f in enumerate(found)])
        shown = [F.coalesce(F.col(f"_{i}")[c], F.lit(none)).alias(f"{c}_{s}") for i, s in enumerate(samples) for c, none in (("depth", 0), ("bases", "*"), ("quals", "*"))]
        return each.select("rname", "pos", F.lit(0).alias("part"), *shown)
    keys = ["rname", "_bin", "pos", "part"]
    picks = []
    for s in samples:
        here = F.col(sample) == s
        picks += [
            F.coalesce(F.max(F.when(here, F.col("depth"))), F.lit(0)).alias(f"depth_{s}"),
            F.coalesce(F.max(F.when(here, F.col("bases"))), F.lit("*")).alias(f"bases_{s}"),
            F.coalesce(F.max(F.when(here, F.col("quals"))), F.lit("*")).alias(f"quals_{s}"),
        ]
    return lines.groupBy(*keys).agg(*picks).drop("_bin")


def call_consensus(bases: DataFrame, min_share: float = 0.80, min_depth: int = 1, max_depth: int | None = None,
                   inclusive: bool = False, min_quality: int | None = None) -> DataFrame:
    """The base whose share passes, else N; N outside the depth bounds."""
    used = bases if min_quality is None else bases.filter(F.col("q") > min_quality)
    counts = site_counts(used)
    limit = F.col("depth") <= max_depth if max_depth is not None else F.lit(True)
    inside = (F.col("depth") >= min_depth) & limit
    best = F.array_sort(F.array(*[F.struct((-F.col(b)).alias("n"), F.lit(b).alias("b")) for b in "ACGT"]))[0]
    share = -best["n"] / F.col("depth")
    passes = share >= min_share if inclusive else share > min_share
    return counts.select("rname", "pos", "depth", F.when(inside & passes, best["b"]).otherwise(F.lit("N")).alias("base"))


def call_genotypes(bases: DataFrame) -> DataFrame:
    """Best and second-best diploid genotype per site with their qualities.

    The cost of a base is the sum of its qualities, each damped by how many better
    ones of the same strand and base went before. Bases are sorted once, where their blocks
    are; those of a bin that is dealt to several tasks are counted per (site, strand, base,
    quality) first, and the damping of a run of equal qualities is a geometric sum.
    """
    dealt = dealt_by(bases)
    kind = F.when(F.col("base") == "A", 0).when(F.col("base") == "C", 2).when(F.col("base") == "G", 4).when(F.col("base") == "T", 6).otherwise(8)
    # rising: the best quality first, of equal ones those of a base with a quality
    rank = F.least(F.col("q"), F.col("mapq")).cast("bigint") * -2 + F.when(F.col("q") != 0, 0).otherwise(1)
    square = F.least(F.col("mapq"), F.lit(CAP_MAPQ)).cast("bigint")
    kinds = {"_kind": (kind + F.col("back").cast("int")).cast("int"), "_rank": rank, "all": F.lit(1).cast("bigint"), "sq": square * square}
    used = bases.filter(F.col("base") != "*").select("rname", "pos", *dealt, *[v.alias(k) for k, v in kinds.items()])
    if "_salt" not in dealt:
        return _genotypes(used)
    # bins that are dealt to several tasks: their counts are added first
    keys, sums = ["rname", "pos", "_bin", "_kind", "_rank"], [F.sum("all").alias("all"), F.sum("sq").alias("sq")]
    many = used.filter("_salt > 0").groupBy(*keys, "_salt").agg(*sums).groupBy(*keys).agg(*sums)
    return _genotypes(used.filter("_salt = 0")).unionByName(_genotypes(many))


def _genotypes(every: DataFrame) -> DataFrame:
    """``call_genotypes`` from bases, or counts of equal ones, per site, kind (base and strand) and rank of quality."""
    dealt = dealt_by(every)
    site = ["rname", "pos", *dealt]
    if not dealt:
        every = every.repartition("rname", "pos")
    quality, real = -F.floor(F.col("_rank") / 2), F.col("_rank") % 2 == 0
    usable = (F.col("_kind") < 8) & ((quality > 0) | real)
    counts = every.withColumn("c", F.when(usable, F.col("all")).otherwise(0))
    # one number for place and kind, so that rows are told apart by it when they are sorted
    w = Window.partitionBy(F.col("pos").cast("bigint") * 16 + F.col("_kind"), "pos", "_kind", "rname", *dealt).orderBy("_rank")
    before = F.sum("c").over(w.rowsBetween(Window.unboundedPreceding, 0)) - F.col("c")
    decay = F.when(F.col("c") == 1, 1 - DEPENDENCY).otherwise(1 - F.pow(F.lit(DEPENDENCY), F.col("c")))
    damped = F.lit(1 - FLOOR) * F.pow(F.lit(DEPENDENCY), "_before") * decay / F.lit(1 - DEPENDENCY) + F.lit(FLOOR) * F.col("c")
    eq = F.when((quality < 4) & real, 4).otherwise(quality)
    weighted = counts.withColumn("_before", before).withColumn("e", damped * eq).withColumn("_base", F.shiftright("_kind", 1))
    per_site = weighted.groupBy(*site).agg(
        *[F.sum(F.when(F.col("_base") == i, F.col("e")).otherwise(0.0)).alias(f"e_{b}") for i, b in enumerate("ACGT")],
        *[F.sum(F.when(F.col("_base") == i, F.col("c")).otherwise(0)).alias(f"c_{b}") for i, b in enumerate("ACGT")],
        F.sum("all").alias("depth"), F.floor(F.sqrt(F.sum("sq") / F.sum("all")) + 0.499).cast("int").alias("rms_mapq"),
    ).filter("c_A + c_C + c_G + c_T > 0")
    total = sum((F.col(f"c_{b}") for b in "CGT"), F.col("c_A"))
    scaled = per_site.withColumn("_n", total)
    scaled = scaled.withColumns(
        {f"c_{b}": F.when(F.col("_n") > 255, F.floor(254.0 * F.col(f"c_{b}") / F.col("_n") + 0.5)).otherwise(F.col(f"c_{b}"))
         for b in "ACGT"})
    log2 = 0.6931471805599453
    costs = {}
    for i, a in enumerate("ACGT"):
        for b in "ACGT"[i:]:
            rest = [x for x in "ACGT" if x not in (a, b)]
            others = sum((F.col(f"e_{x}") for x in rest[1:]), F.col(f"e_{rest[0]}"))
            costs[a + b] = others if a == b else others + 4.343 * log2 * (F.col(f"c_{a}") + F.col(f"c_{b}"))
    low = F.least(*costs.values())
    options = F.array_sort(F.array(*[
        F.struct(
            (F.least(F.floor(c - F.col("_low") + 0.5), F.lit(255)) + (0 if g[0] == g[1] else HET_PENALTY)).alias("v"),
            F.lit(i).alias("i"), F.lit(AMBIGUITY[g]).alias("g"))
        for i, (g, c) in enumerate(costs.items())]))
    ranked = scaled.withColumn("_low", low).withColumn("_o", options)
    return ranked.select(
        "rname", "pos", "depth", "rms_mapq", F.col("_o")[0]["g"].alias("consensus"), F.col("_o")[1]["g"].alias("second"),
        F.least(F.col("_o")[1]["v"] - F.col("_o")[0]["v"], F.lit(255)).cast("int").alias("quality"),
        F.least(F.col("_o")[2]["v"] - F.col("_o")[1]["v"], F.lit(255)).cast("int").alias("second_quality"))


def snp_quality(consensus: Column, second: Column, ref: Column, quality: Column, second_quality: Column) -> Column:
    """Quality of differing from the reference: zero for a match, more when the reference is not even second."""
    return F.when((consensus == ref) | ~ref.isin("A", "C", "G", "T"), F.lit(0)).when(second == ref, quality).otherwise(
        F.least(quality + second_quality, F.lit(255)))


def filter_pileup(sites: DataFrame, snp_quality: int = 20, indel_quality: int = 50, min_depth: int = 20) -> DataFrame:
    """Consensus-pileup rows with enough quality and depth."""
    indel = F.col("ref") == "*"
    good = F.when(indel, F.col("snp_quality") >= indel_quality).otherwise(F.col("snp_quality") >= snp_quality)
    return sites.filter(good & (F.col("depth") >= min_depth))


def basecall_changes(sites: DataFrame, min_depth: int = 20, percent: float = 90) -> DataFrame:
    """Consensus bases that enough reads show, and all indels (``+ACG`` or ``-ACG``)."""
    indel = F.col("ref") == "*"
    support = F.length("bases") - F.length(F.replace(F.lower("bases"), F.lower("consensus"), F.lit("")))  # a literal: "." is a base too
    wanted = F.when(F.col("allele1") == "*", F.col("allele2")).otherwise(F.col("allele1"))
    change = F.when(indel, wanted).when(support > F.lit(percent / 100) * F.col("depth"), F.col("consensus"))
    return sites.filter(F.col("depth") >= min_depth).select("rname", "pos", change.alias("change")).filter(
        F.col("change").isNotNull())


def as_edits(changes: DataFrame) -> DataFrame:
    """``G``, ``+ACG`` and ``-ACG`` at a position -> replace [pos, pos + span) by txt."""
    c = F.col("change")
    plus, minus = c.startswith("+"), c.startswith("-")
    text = F.regexp_replace(c, "^[+-]", "")
    return changes.select(
        "rname",
        F.when(plus | minus, F.col("pos") + 1).otherwise(F.col("pos")).alias("pos"),
        F.when(plus, F.lit(0)).when(minus, F.length(text)).otherwise(F.lit(1)).alias("span"),
        F.when(minus, F.lit("")).otherwise(text).alias("txt"),
    )


def alternates_as_edits(variants: DataFrame) -> DataFrame:
    """The first alternate in place of the base at the position, N when there is none."""
    alt = F.split("alt", ",")[0]
    return variants.select(
        F.col("chrom").alias("rname"), "pos", F.lit(1).alias("span"),
        F.when(alt.isin("", "."), F.lit("N")).otherwise(alt).alias("txt"))


def edited_pieces(contigs: DataFrame, edits: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """(name, piece, seq): edited contigs, a piece for each ``chunk`` letters before editing.

    A deletion across an edge is cut too. Where edits collide the one that begins first wins. An edit beyond the
    contig is ignored.
    """
    whole = contigs.select("name", F.posexplode(dna.pieces("seq", chunk)).alias("_c", "_text"))
    span = F.greatest(F.col("span"), F.lit(1))
    parts = F.explode(F.sequence(F.floor((F.col("pos") - 1) / chunk), F.floor((F.col("pos") + span - 2) / chunk)))
    cut = edits.withColumn("_c", parts).withColumn("_lo", F.greatest(F.col("pos"), F.col("_c") * chunk + 1))
    hi = F.least(F.col("pos") + F.col("span") - 1, (F.col("_c") + 1) * chunk)
    cut = cut.select(
        F.col("rname").alias("name"), "_c", (F.col("_lo") - F.col("_c") * chunk).cast("int").alias("at"),
        (hi - F.col("_c") * chunk).cast("int").alias("upto"),
        F.when(F.col("_lo") == F.col("pos"), F.col("txt")).otherwise(F.lit("")).alias("txt"))
    # one edit per position and kind, none that starts inside an earlier one
    one = cut.groupBy("name", "_c", "at", (F.col("upto") < F.col("at")).alias("_ins")).agg(
        F.max(F.struct("upto", "txt")).alias("e")).select("name", "_c", "at", "e.*")
    w = Window.partitionBy("name", "_c").orderBy("at", "upto").rowsBetween(Window.unboundedPreceding, -1)
    free = one.withColumn("_busy", F.coalesce(F.max("upto").over(w), F.lit(0))).filter(F.col("at") > F.col("_busy"))
    listed = free.groupBy("name", "_c").agg(F.array_sort(F.collect_list(F.struct("at", "upto", "txt"))).alias("e"))
    joined = whole.join(listed, ["name", "_c"], "left")
    size = F.length("_text")

    def piece(x, i):
        last = F.coalesce(F.get("e", i - 1)["upto"], F.lit(0))
        inside = x["at"] <= size + F.when(x["upto"] < x["at"], 1).otherwise(0)
        kept = F.substr("_text", last + 1, F.greatest(x["at"] - last - 1, F.lit(0)))
        return F.concat(kept, F.when(inside, x["txt"]).otherwise(F.lit("")))

    tail_from = F.coalesce(F.element_at("e", -1)["upto"], F.lit(0)) + 1
    edited = F.when(F.col("e").isNull(), F.col("_text")).otherwise(
        F.concat(F.array_join(F.transform("e", piece), ""), F.substr("_text", tail_from, F.greatest(size - tail_from + 1, F.lit(0)))))
    return joined.select("name", F.col("_c").cast("bigint").alias("piece"), edited.alias("seq"))


def apply_edits(contigs: DataFrame, edits: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """``edited_pieces`` with each contig in one row."""
    return pieces.join_pieces(edited_pieces(contigs, edits, chunk))


def apply_variants(contigs: DataFrame, changes: DataFrame) -> DataFrame:
    return apply_edits(contigs, as_edits(changes))


def apply_alternates(contigs: DataFrame, variants: DataFrame) -> DataFrame:
    return apply_edits(contigs, alternates_as_edits(variants))


def laid_out(sites: DataFrame, name: str, width: int = pieces.WIDTH) -> DataFrame:
    """Rows (name, pos, base, qchar), one per position -> (name, size, piece, seq, qual), gaps filled."""
    bounded = sites.withColumn("piece", F.floor((F.col("pos") - 1) / width))
    ends = sites.groupBy(name).agg(F.max("pos").cast("bigint").alias("size"))
    rows = bounded.groupBy(name, "piece").agg(F.array_sort(F.collect_list(F.struct("pos", "base", "qchar"))).alias("p"))
    grid = ends.select(name, "size", F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("size") - 1) / width))).alias("piece"))
    full = grid.join(rows, [name, "piece"], "left")
    stop = F.least((F.col("piece") + 1) * width, F.col("size"))
    start = F.col("piece") * width

    def padded(field, fill):
        here = F.transform("p", lambda x: x["pos"])
        before = F.concat(F.array(start), F.slice(here, 1, F.greatest(F.size(here) - 1, F.lit(0))))
        one = F.zip_with("p", before, lambda x, last: F.concat(F.repeat(F.lit(fill), (x["pos"] - last - 1).cast("int")), x[field]))
        tail = F.repeat(F.lit(fill), (stop - F.coalesce(F.element_at("p", -1)["pos"], start)).cast("int"))
        return F.when(F.col("p").isNull(), tail).otherwise(F.concat(F.array_join(one, ""), tail))

    return full.select(name, "size", "piece", padded("base", "n").alias("seq"), padded("qchar", "!").alias("qual"))


def lay_out(sites: DataFrame, name: str) -> DataFrame:
    """``laid_out`` with each sequence in one row."""
    return pieces.join_pieces(laid_out(sites, name), name, ["seq", "qual"])


def lower_near(sites: DataFrame, windows: DataFrame, name: str) -> DataFrame:
    """Lower-case the bases inside any window (name, beg, end)."""
    from .alignments import overlap

    spots = sites.withColumns({"_b": F.col("pos"), "_e": F.col("pos")})
    near = overlap(spots, windows, (name, "_b", "_e")).select(name, "pos").distinct().withColumn("_near", F.lit(True))
    marked = sites.join(near, [name, "pos"], "left")
    return marked.withColumn("base", F.when(F.col("_near"), F.lower("base")).otherwise(F.col("base"))).drop("_near")


def consensus_from_variants(rows: DataFrame, min_depth: int = 3, max_depth: int = 100_000, min_mapq: int = 10,
                            indel_window: int = 5) -> DataFrame:
    """Sequence and quality per chromosome from an all-site variant table."""
    info = F.col("info")

    def number(key, default):
        return F.coalesce(F.regexp_extract(info, rf"(?:^|;){key}=(-?[0-9.]+)", 1).try_cast("double"), F.lit(default))

    kept = rows.filter(~F.coalesce(F.col("gt").rlike("0/1"), F.lit(False)))
    simple = (F.length("ref") == 1) & ~info.rlike("INDEL") & F.col("alt").rlike(r"^[A-Za-z.](,[A-Za-z])*$")
    fq = number("FQ", 0.0)
    alt = F.substring("alt", 1, 1)
    pair = F.array_join(F.array_sort(F.array(F.upper("ref"), F.upper(alt))), "")
    code = F.create_map(*[F.lit(x) for kv in AMBIGUITY.items() if kv[0][0] != kv[0][1] for x in kv])
    hom = F.when((number("AF1", 0.0) < 0.5) | (alt == "."), F.col("ref")).otherwise(alt)
    base = F.when(fq < 0, hom).otherwise(F.coalesce(F.try_element_at(code, pair), F.lit("N")))
    sure = (number("MQ", -1.0) >= min_mapq) & number("DP", -1.0).between(min_depth, max_depth)
    sites = kept.filter(simple).select(
        F.col("chrom"), "pos", F.when(sure, F.upper(base)).otherwise(F.lower(base)).alias("base"),
        F.char(F.least(F.floor(F.abs(fq) + 33.499), F.lit(126)).cast("int")).alias("qchar"))
    sites = sites.groupBy("chrom", "pos").agg(F.min(F.struct("base", "qchar")).alias("s")).select("chrom", "pos", "s.*")
    gaps = kept.filter(~simple & (F.col("alt") != ".")).select(
        F.col("chrom").alias("name"), (F.greatest(F.col("pos") - indel_window, F.lit(0)) + 1).alias("beg"),
        (F.col("pos") + F.length("ref") + indel_window).alias("end")).distinct()
    return lay_out(lower_near(sites, gaps, "chrom"), "chrom")


def consensus_from_pileup(sites: DataFrame, min_depth: int = 3, max_depth: int = 255, min_mapq: int = 25,
                          min_indel_score: int = 25, indel_window: int = 10) -> DataFrame:
    """Sequence and quality per reference from consensus-pileup rows."""
    plain = sites.filter("ref <> '*'")
    sure = (F.col("rms_mapq") >= min_mapq) & F.col("depth").between(min_depth, max_depth)
    rows = plain.select(
        "rname", "pos", F.when(sure, F.upper("consensus")).otherwise(F.lower("consensus")).alias("base"),
        F.char(F.least(F.col("quality") + 33, F.lit(126))).alias("qchar"))
    gaps = sites.filter(F.col("ref") == "*").filter(F.col("snp_quality") >= min_indel_score).select(
        F.col("rname").alias("name"), (F.greatest(F.col("pos") - indel_window, F.lit(0)) + 1).alias("beg"),
        (F.greatest(F.col("pos") - indel_window, F.lit(0)) + 2 * indel_window).alias("end")).distinct()
    return lay_out(lower_near(rows, gaps, "rname"), "rname")


def alignments_to_consensus(df: DataFrame, min_gap: int = 3, k: float = 3, min_share: float = 0.8) -> DataFrame:
    """Depth bounds, majority calls, masking, then a cut at every long enough gap."""
    from .alignments import depth_bounds
    from .proximity import written

    bounds = depth_bounds(df, k)
    low, high = bounds.select("min_depth").scalar(), bounds.select("max_depth").scalar()
    calls = call_consensus(read_bases(df), min_share)
    inside = F.col("depth").between(low, high)
    sites = calls.select("rname", "pos", F.when(inside, F.col("base")).otherwise(F.lit("N")).alias("base"),
                         F.char(F.least(F.col("depth") + 33, F.lit(126))).alias("qchar"))
    # both are read several times, and the blocks are moved once
    sites = written(sites, "consensus-sites")
    # the pieces are masked and cut as they are; only the parts between gaps become rows
    held = written(laid_out(sites, "rname").withColumn("seq", dna.mask_lowercase("seq")), "consensus-pieces")
    parts = pieces.split_at_runs(held, "Nn", min_gap, "rname", ["seq", "qual"])
    return parts.select(F.concat("rname", F.lit("_subcontig"), "i").alias("name"), F.col("start").cast("int").alias("start"), "seq", "qual")

"""Open reading frames, gene predictions and features.

Predictions are rows of (seqname, lo, hi, start, stop, strand, predictor, ...), 1-based
and closed; on the reverse strand start > stop.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import dna
from ..session import cut_lineage
from . import pieces
from .contigs import overlay
from .scale import first_per_key, number_rows, running_sum

#: Reading frames after which a batch leaves a Python worker, and letters of their texts.
FRAME_ROWS, FRAME_LETTERS = 1 << 16, 1 << 23
FRAMES = "size bigint, strand string, c int, at bigint, len bigint, closed boolean, opens boolean, first bigint"


def _frames(edges: bool, min_len: int, with_seq: bool, start2stop: bool, width: int):
    """Arrow batches of pieces -> segments of their six frames: those at edges, which may go on in the next piece, or
    the frames that a piece holds whole, with their text if it is wanted."""
    swap, stop_codons, start_codons = str.maketrans("ATGCatgc", "TACGtacg"), dna.STOP_CODONS, dna.START_CODONS

    def codes_of(text: str) -> np.ndarray:
        return np.frombuffer(text.encode("ascii"), np.uint8) if text.isascii() else np.frombuffer(text.encode("utf-32-le"), np.uint32)

    def places(letters: np.ndarray, codons: Sequence[str]) -> np.ndarray:
        """Places at which any of the codons begins."""
        out = np.zeros(max(len(letters) - 2, 0), bool)
        for codon in codons:
            out |= (letters[:-2] == ord(codon[0])) & (letters[1:-1] == ord(codon[1])) & (letters[2:] == ord(codon[2]))
        return np.flatnonzero(out)

    def segments(text: str, off: int):
        """For each frame of the whole sequence (its number, first letter and end in ``text``, ends of segments, whether
        closed, places of their first start codons or -1). ``off`` is the place of the text."""
        letters = codes_of(text)
        stops, starts = (places(letters, x) if len(letters) > 2 else np.zeros(0, np.int64) for x in (stop_codons, start_codons))
        for c in range(3):
            skip = (c - off) % 3
            end = skip + max(len(letters) - skip, 0) // 3 * 3
            if end <= skip:
                continue
            ends = stops[stops % 3 == skip % 3] + 3
            shut = np.ones(len(ends) + 1, bool)
            if len(ends) and ends[-1] == end:
                shut = shut[:-1]
            else:
                ends, shut[-1] = np.append(ends, end), False
            begins = np.concatenate(([skip], ends[:-1]))
            own = starts[starts % 3 == skip % 3]
            at = np.searchsorted(own, begins)
            first = np.where(at < len(own), own[np.minimum(at, len(own) - 1)] if len(own) else -1, -1)
            yield c, begins, ends, shut, np.where(first < ends, first, -1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out, texts, rows, letters = [], [], 0, 0

            def table() -> pa.RecordBatch:
                of, strand, c, *columns = zip(*[(np.full(len(x[3]), x[0]), np.full(len(x[3]), x[1]), np.full(len(x[3]), x[2], np.int32), *x[3:]) for x in out])
                of, strand, c, at, size, shut, opens, first = map(np.concatenate, (of, strand, c, *columns))
                back = pa.array(strand).cast(pa.int32())
                arrays = [batch.column("_key").take(pa.array(of)), batch.column("size").take(pa.array(of)), pa.array(["+", "-"]).take(back),
                          pa.array(c), pa.array(at), pa.array(size), pa.array(shut), pa.array(opens), pa.array(first, mask=first < 0)]
                return pa.RecordBatch.from_arrays([*arrays, *([pa.array(texts, pa.string())] if with_seq else [])], names=names)

            names = ["_key", *[x.split()[0] for x in FRAMES.split(", ")], *(["seq"] if with_seq else [])]
            for k, (size, piece, seq, before, after) in enumerate(zip(*[batch.column(c).to_pylist() for c in ("size", "piece", "seq", "before", "after")])):
                at = piece * width
                reads = (seq + after, at), ((before + seq).translate(swap)[::-1], size - at - len(seq))
                for strand, (text, off) in enumerate(reads):
                    for c, begins, ends, shut, first in segments(text, off):
                        opens = np.zeros(len(begins), bool)
                        opens[0] = True
                        # a closed segment that does not begin the text is whole
                        inside = shut & ~opens
                        if edges:
                            kept = np.flatnonzero(~inside)
                        else:
                            kept = np.flatnonzero(inside & (first >= 0) & (ends - first >= min_len))
                        if not len(kept):
                            continue
                        b, e, f = begins[kept], ends[kept], first[kept]
                        if with_seq:
                            cut = [text[x:y] for x, y in zip((f if start2stop else b).tolist(), e.tolist())] if not edges else [None] * len(kept)
                            texts += cut
                            letters += 0 if edges else int((e - b).sum())
                        out.append((k, strand, c, b + off, e - b, shut[kept], opens[kept], np.where(f >= 0, f + off, -1)))
                        rows += len(kept)
                if rows >= FRAME_ROWS or letters >= FRAME_LETTERS:
                    yield table()
                    out, texts, rows, letters = [], [], 0, 0
            if out:
                yield table()

    return run


def find_orfs(contigs: DataFrame, min_len: int = 90, truncated: bool = False, start2stop: bool = False,
              with_seq: bool = False, keys: Sequence[str] = ("name",)) -> DataFrame:
    """Stop-to-stop reading frames in six frames that hold a start codon.

    Each piece cuts its three frames on both strands at stop codons, by array steps over its letters. A segment
    between two stops of a piece is a frame as it is, with its text. A segment at an edge goes on in the next piece
    unless a stop closes it, so one window over these few joins them; their text is fetched by place at the end.
    """
    held = pieces.cut(contigs.select(F.struct(*keys).alias("_key"), "seq"), "_key", edge=2)
    # reading six frames costs more than moving a letter, and a contig may be one row of many millions
    held = held.repartition("_key", "piece")
    if with_seq:  # the pieces are asked for their text too, and are made once
        held = cut_lineage(held)
    schema = f"_key {held.schema['_key'].dataType.simpleString()}, {FRAMES}" + (", seq string" if with_seq else "")

    def segments(edges):
        return held.mapInArrow(_frames(edges, min_len, with_seq, start2stop, pieces.WIDTH), schema)

    group = ["_key", "size", "strand", "c"]
    joined = pieces.linked(segments(True), group, F.col("opens") & ~F.col("_lag_closed")).groupBy(*group, "run").agg(
        F.min("at").alias("beg"), F.max(F.col("at") + F.col("len")).alias("end"), F.bool_or("closed").alias("closed"), F.min("first").alias("first"))
    joined = joined.filter((F.col("end") - F.col("beg") >= min_len) & (F.col("end") - F.col("first") >= min_len) & (F.col("closed") | F.lit(truncated)))

    back = F.col("strand") == "-"
    shift = F.when(back, F.pmod(F.col("size") - F.col("c"), F.lit(3))).otherwise(F.col("c"))

    def named(whole, *more):
        out = whole.select(
            "_key.*", "_key", F.concat(shift.cast("string"), F.when(back, F.lit("R")).otherwise(F.lit(""))).alias("frame"), "strand",
            F.when(back, F.col("size") - F.col("beg")).otherwise(F.col("beg") + 1).alias("ustop"),
            F.when(back, F.col("size") - F.col("first")).otherwise(F.col("first") + 1).alias("start"),
            F.when(back, F.col("size") - F.col("end") + 1).otherwise(F.col("end")).alias("stop"),
            (F.col("end") - F.col("beg")).alias("length"), (F.col("beg") < 3).alias("truncated_upstream"), (~F.col("closed")).alias("truncated_downstream"), *more)
        return out.withColumns({"lo": F.least("start", "stop"), "hi": F.greatest("start", "stop")})

    inside = segments(False).withColumnsRenamed({"at": "beg"}).withColumn("end", F.col("beg") + F.col("len"))
    if not with_seq:
        return named(inside).unionByName(named(joined)).drop("_key")
    out = named(joined)
    begin = F.col("start") if start2stop else F.col("ustop")
    out = out.withColumns({"_from": F.least(begin, F.col("stop")), "_to": F.greatest(begin, F.col("stop"))})
    out = pieces.fetch(out, held, ("_key", "_from", "_to"), name="_key").drop("_key", "_from", "_to")
    out = out.withColumn("seq", F.when(F.col("strand") == "-", dna.reverse_complement("seq")).otherwise(F.col("seq")))
    out = out.unionByName(named(inside, "seq").drop("_key"))
    return out.withColumn("aa_seq", dna.translate_dna("seq"))


def snap_to_start(rows: DataFrame) -> DataFrame:
    """Nearest start codon to ``pos`` inside the frame [lo, hi]; the next one wins a tie.

    ``seq`` is the forward text of [lo, hi].
    """
    wanted = F.when(F.col("strand") == "-", F.lit("CAT,CAC")).otherwise(F.lit(",".join(dna.START_CODONS)))
    base = F.col("lo") - 1
    here = F.col("pos") - 1 - F.pmod(F.col("pos") - 1 - base, F.lit(3))
    # one pass over the codons, in 0-based coordinates of the sequence
    hits = F.transform(dna.codons("seq"), lambda x, i: F.when((F.length(x) == 3) & F.contains(wanted, x), base + i * 3))
    sides = F.aggregate(
        hits, F.struct(F.lit(None).cast("bigint").alias("prev"), F.lit(None).cast("bigint").alias("next")),
        lambda acc, x: F.struct(F.when((x < here) & (x > base), x).otherwise(acc["prev"]).cast("bigint").alias("prev"),
                                F.coalesce(acc["next"], F.when(x >= here, x)).cast("bigint").alias("next")))
    found = rows.withColumn("_near", sides)
    nxt, prev, p = F.col("_near.next"), F.col("_near.prev"), F.col("pos") - 1
    best = F.when(nxt.isNull(), prev).when(prev.isNull(), nxt).when(p - prev < nxt - p, prev).otherwise(nxt)
    return found.withColumn("snapped", best + F.when(F.col("strand") == "-", 3).otherwise(1)).drop("_near")


KEY = ("seqname", "strand", "stop")


def reconcile_predictions(predictions: DataFrame, min_predictors: int = 2) -> tuple[DataFrame, DataFrame]:
    """One gene per (sequence, strand, stop) that enough predictors agree on, and the minority.

    The start is the one furthest downstream among the predictors that work from
    the sequence alone. A stop that only protein evidence supports has no start and
    goes to the minority. Predictions are counted per predictor first.
    """
    denovo = ~F.lower("predictor").contains("blast")
    per = predictions.groupBy(*KEY, "predictor").agg(
        F.count("*").alias("c"), F.max(F.when(denovo, F.col("start"))).alias("most"), F.min(F.when(denovo, F.col("start"))).alias("least"))
    groups = per.groupBy(*KEY).agg(
        F.sum("c").alias("contributors"),
        # as many entries as there are predictors
        F.array_join(F.array_sort(F.collect_set("predictor")), ",").alias("predictors"),
        F.when(F.col("strand") == "+", F.max("most")).otherwise(F.min("least")).alias("start"))
    called = (F.col("contributors") >= min_predictors) & F.col("start").isNotNull()
    genes = groups.filter(called).select(
        *KEY, "start", F.least("start", "stop").alias("lo"), F.greatest("start", "stop").alias("hi"), "predictors", "contributors")
    minority = predictions.join(groups.filter(~called).select(*KEY), list(KEY), "left_semi")
    return genes, minority


def gene_sequences(genes: DataFrame, contigs: DataFrame) -> DataFrame:
    """Coding text of each gene, reverse-complemented on '-', and its translation.

    The text is that of the pieces that the gene touches. Genes with ``places``, an array of (lo, hi), are the
    intervals joined. Genes of an unknown sequence are left out.
    """
    held = pieces.cut(contigs)
    known = genes.join(contigs.select(F.col("name").alias("seqname")).distinct(), "seqname", "left_semi")
    if "places" in genes.columns:
        return pieces.splice(known, held).withColumn("aa", dna.translate_dna("nt"))
    found = pieces.fetch(known, held, ("seqname", "lo", "hi"), ["nt"])
    found = found.withColumn("nt", F.when(F.col("strand") == "-", dna.reverse_complement("nt")).otherwise(F.col("nt")))
    return found.withColumn("aa", dna.translate_dna("nt"))


def is_abnormal(aa="aa", shortest: int = 30, longest: int = 2000) -> Column:
    n = F.length(aa)
    return (n < shortest) | (n > longest) | ~F.col(aa).rlike(r"M.+\*$")


def flag_abnormal(genes: DataFrame, **limits) -> DataFrame:
    return genes.withColumn("abnormal", is_abnormal(**limits))


def overlay_features(genes: DataFrame, *later: DataFrame) -> DataFrame:
    """RNA and repeat features replace a gene with the same sequence, strand and stop."""
    out = genes
    for features in later:
        out = overlay(out, features, KEY)
    return out


def orf_hits_to_genes(hits: DataFrame, min_coverage: float, min_identity: float) -> DataFrame:
    """Best protein hit per reading frame as a prediction that ends at the frame's stop.

    ``name1`` carries the frame: seqname_start_stop_strand_ustop_length_...
    """
    part = F.split("name1", "_")
    framed = hits.withColumns(
        {
            "seqname": F.replace(part[0], F.lit("---"), F.lit("_")), "o_start": part[1].cast("bigint"),
            "o_stop": part[2].cast("bigint"), "strand": part[3], "o_length": part[5].cast("bigint"),
        }
    )
    good = framed.filter(
        (F.col("al_len") * 3 / F.col("o_length") >= min_coverage) & (F.col("percent_id") >= min_identity * 100))
    order = ["name2", "start1", "end1"]
    best = first_per_key(
        good.select("name1", "bitscore", *order, "seqname", "o_start", "o_stop", "strand"), ["name1"],
        [-F.col("bitscore"), *[F.col(c) for c in order]])
    forward = F.col("strand") == "+"
    start = F.when(forward, F.col("o_start") + (F.col("start1") - 1) * 3).otherwise(F.col("o_start") - (F.col("start1") - 1) * 3)
    genes = best.select(
        "seqname", F.when(forward, start).otherwise(F.col("o_stop")).alias("lo"),
        F.when(forward, F.col("o_stop")).otherwise(start).alias("hi"), start.alias("start"), F.col("o_stop").alias("stop"),
        "strand", F.lit("CDS").alias("type"), F.lit("BLAST").alias("predictor"), F.col("bitscore").alias("score"))
    return first_per_key(genes, ["start", "stop", "strand", "seqname"], [-F.col("score")]).select(*genes.columns)


# Letter between prefix and number of a locus tag.
TAG_LETTERS = {"CDS": "", "tRNA": "t", "rRNA": "r", "repeat_region": "c"}


def assign_locus_tags(features: DataFrame, prefix: str) -> DataFrame:
    """``<prefix>_<letter><4 digits>``, numbered per type in order of sequence and stop."""
    order = [F.col("seqname"), F.col("stop"), F.col("strand"), F.col("start")]
    numbered = number_rows(features, order, within=["type"], name="_k")
    letter = F.lit("")
    for kind, mark in TAG_LETTERS.items():
        letter = F.when(F.col("type") == kind, F.lit(mark)).otherwise(letter)
    return numbered.withColumn("locus_tag", F.concat(F.lit(f"{prefix}_"), letter, F.format_string("%04d", "_k"))).drop("_k")


def extract_features(features: DataFrame, contigs: DataFrame, protein: bool = False) -> DataFrame:
    """Coding features as named sequences with gene, product or a default as description."""
    cut = gene_sequences(features.filter("type = 'CDS'"), contigs)
    text = F.replace(F.col("aa") if protein else F.col("nt"), F.lit("-"), F.lit("N"))
    return cut.select(
        F.concat_ws("|", F.lit("lcl"), "locus_tag", "type", F.col("lo").cast("string"), F.col("hi").cast("string")).alias("name"),
        F.coalesce("gene", "product", F.lit("predicted cds")).alias("description"), text.alias("seq"))


def feature_counts(sequences: DataFrame, features: DataFrame, types: Sequence[str]) -> DataFrame:
    """Genome length and number of features per type and file; a repeated sequence id counts once."""
    first = sequences.groupBy("file", "seqid").agg(F.min(F.struct("seq_no", "length")).alias("s")).select("file", "seqid", "s.*")
    kept = features.join(first.select("file", "seqid", "seq_no"), ["file", "seqid", "seq_no"], "left_semi")
    counts = kept.groupBy("file").pivot("type", list(types)).count()
    size = first.groupBy("file").agg(F.sum("length").alias("genomeLength"))
    joined = size.join(counts, "file", "left")
    return joined.select("file", "genomeLength", *[F.coalesce(F.col(f"`{t}`").cast("string"), F.lit(".")).alias(t) for t in types])


def annotation_metrics(features: DataFrame, types: Sequence[str] = ("gene", "CDS", "tRNA", "rRNA")) -> DataFrame:
    """Annotation counts per file; each condition is counted on its own."""
    misc = F.col("type").isin("misc_structure", "misc_feature")
    cds, named = F.col("type") == "CDS", F.coalesce(F.col("gene") != "", F.lit(False))
    product = F.coalesce(F.col("product"), F.lit(""))
    which = F.regexp_extract(product, "(putative|hypothetical)", 1)
    counts = features.groupBy("file").agg(
        *[F.count_if(F.col("type") == t).alias(t) for t in types],
        F.count_if(F.col("vfdb_id").isNotNull()).alias("vfdb_id"),
        F.count_if(misc & F.coalesce(F.lower("note").contains("transmembrane helix"), F.lit(False))).alias("transmembraneHelix"),
        F.count_if((F.col("type") == "gene") & named).alias("characterized"),
        F.count_if(cds & named).alias("CDS_gene"),
        F.count_if(cds & (which == "putative")).alias("CDS_putative"),
        F.count_if(cds & (which == "hypothetical")).alias("CDS_hypothetical"))
    return counts.join(genes_with_product(features), "file", "left")


def genes_with_product(features: DataFrame) -> DataFrame:
    """Stretches from one gene row to the next that hold a product, per file.

    Rows are numbered by range partitioning and the gene rows counted in two levels,
    so a file of any size is spread over the tasks.
    """
    order = [F.col(c) for c in ("seqname", "ord")]
    numbered = number_rows(features.select("file", "seqname", "ord", "type", "product"), order, within=["file"], name="n")
    marked = numbered.withColumn("is_gene", (F.col("type") == "gene").cast("int"))
    segments = running_sum(marked, ["file"], "n", {"segment": "is_gene"})
    held = segments.groupBy("file", "segment").agg(F.bool_or(F.col("product").isNotNull()).alias("has"))
    return held.groupBy("file").agg(F.count_if("has").alias("genesAnnotated"))


def clip_proteins(proteins: DataFrame, shortest: int = 20, longest: int = 2000) -> DataFrame:
    return proteins.filter(F.length("seq") >= shortest).withColumn("seq", F.substring("seq", 1, longest))


def codon_of_anticodon(anticodon) -> Column:
    return dna.reverse_complement(anticodon)


def predict(predictions: DataFrame, later: Sequence[DataFrame], prefix: str, min_predictors: int = 2) -> DataFrame:
    """Reconcile, overlay RNA and repeats, assign locus tags."""
    genes, _ = reconcile_predictions(predictions, min_predictors)
    columns = [*KEY, "start", "lo", "hi", "type"]
    typed = genes.withColumn("type", F.lit("CDS")).select(*columns)
    return assign_locus_tags(overlay_features(typed, *[x.select(*columns) for x in later]), prefix)

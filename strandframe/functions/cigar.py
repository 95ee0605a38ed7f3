"""CIGAR strings and flag bits as Column expressions."""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from .common import as_col

# Flag bits of an alignment record.
PAIRED, PROPER, UNMAPPED, MATE_UNMAPPED = 1, 2, 4, 8
REVERSE, MATE_REVERSE, FIRST, SECOND = 16, 32, 64, 128
SECONDARY, QC_FAIL, DUPLICATE = 256, 512, 1024
PILEUP_MASK = UNMAPPED | SECONDARY | QC_FAIL | DUPLICATE
FLAG_LETTERS = "pPuUrR12sfd"
FLAG_NAMES = (
    "paired proper_pair unmapped mate_unmapped reverse mate_reverse first second "
    "secondary qc_fail duplicate"
).split()


def has(flag, bits: int) -> Column:
    """All of ``bits`` are set."""
    return as_col(flag).bitwiseAND(F.lit(bits)) == bits


def lacks(flag, bits: int) -> Column:
    """None of ``bits`` is set."""
    return as_col(flag).bitwiseAND(F.lit(bits)) == 0


def parse_cigar(cigar) -> Column:
    """Text -> array of ``struct(len, op)``."""
    c = as_col(cigar)
    lengths = F.regexp_extract_all(c, F.lit(r"(\d+)([MIDNSHP])"), F.lit(1))
    ops = F.regexp_extract_all(c, F.lit(r"(\d+)([MIDNSHP])"), F.lit(2))
    return F.zip_with(lengths, ops, lambda n, o: F.struct(n.cast("int").alias("len"), o.alias("op")))


def op_total(cigar, ops: str) -> Column:
    """Summed length of the operations named in ``ops``."""
    found = F.regexp_extract_all(as_col(cigar), F.lit(rf"(\d+)[{ops}]"), F.lit(1))
    return F.aggregate(found, F.lit(0), lambda acc, n: acc + n.cast("int"))


def reference_span(cigar) -> Column:
    return op_total(cigar, "MDN")


def aligned_length(cigar) -> Column:
    return op_total(cigar, "MI")


def query_length(cigar) -> Column:
    return op_total(cigar, "MIS")


def expand_cigar(cigar) -> Column:
    """``3M1I`` -> ``MMMI``."""
    return F.array_join(F.transform(parse_cigar(cigar), lambda e: F.repeat(e["op"], e["len"])), "")


def blocks(cigar) -> Column:
    """Operations with the reference and query offset at which each begins (0-based)."""
    start = F.struct(
        F.lit(0).alias("ref"),
        F.lit(0).alias("qry"),
        F.array().cast("array<struct<len:int,op:string,ref:int,qry:int>>").alias("out"),
    )

    def step(acc, e):
        moves_ref = e["op"].isin("M", "D", "N")
        moves_qry = e["op"].isin("M", "I", "S")
        here = F.struct(e["len"].alias("len"), e["op"].alias("op"), acc["ref"].alias("ref"), acc["qry"].alias("qry"))
        return F.struct(
            (acc["ref"] + F.when(moves_ref, e["len"]).otherwise(0)).alias("ref"),
            (acc["qry"] + F.when(moves_qry, e["len"]).otherwise(0)).alias("qry"),
            F.concat(acc["out"], F.array(here)).alias("out"),
        )

    return F.aggregate(parse_cigar(cigar), start, step, lambda acc: acc["out"])


#: What ``aligned`` gives for a block; ``nxt`` is the query offset of what is inserted after it.
ALIGNED = "op string, ref int, qry int, len int, after int, nxt int, opens boolean, closes boolean"
_OPS, _WALLS = re.compile(r"([0-9]+)([MIDNSHP])"), "MNSH"


def _aligned_of(cigar: str) -> list[tuple]:
    """The M and D blocks of a CIGAR string."""
    ops, ref, qry, out = [(int(n), o) for n, o in _OPS.findall(cigar)], 0, 0, []
    walls = [i for i, (_, o) in enumerate(ops) if o in _WALLS]
    before, ahead = -1, 0
    for i, (n, o) in enumerate(ops):
        while ahead < len(walls) and walls[ahead] <= i:
            ahead += 1
        if o in "MD":
            m = o == "M"
            goes_on = ahead < len(walls) and ops[walls[ahead]][1] == "M"
            at = i + 2 if ops[i + 1 : i + 2] and ops[i + 1][1] == "P" else i + 1
            size, kind = ops[at] if at < len(ops) else (0, "")
            after = {"I": size, "D": -size}.get(kind, 0) if m and goes_on else 0
            # only P, which takes no letters, can lie between a block and what is inserted
            out.append((o, ref, qry, n, after, qry + n if m else qry, m and (before < 0 or ops[before][1] != "M"), m and not goes_on))
        if o in _WALLS:
            before = i
        ref += n if o in "MDN" else 0
        qry += n if o in "MIS" else 0
    return out


def aligned(cigar) -> Column:
    """The aligned and deleted blocks of a CIGAR column; equal strings of an Arrow batch are read once."""
    names = [f.split()[0] for f in ALIGNED.split(", ")]
    kinds = {"string": pa.string(), "int": pa.int32(), "boolean": pa.bool_()}
    fields = pa.struct([(f.split()[0], kinds[f.split()[1]]) for f in ALIGNED.split(", ")])

    @F.arrow_udf(f"array<struct<{', '.join(f.replace(' ', ':') for f in ALIGNED.split(', ')).replace(', ', ',')}>>")
    def read(cigars: pa.Array) -> pa.Array:
        coded = cigars.dictionary_encode()
        found = [_aligned_of(c) for c in coded.dictionary.to_pylist()]
        each = [b for blocks in found for b in blocks]
        held = pa.StructArray.from_arrays([pa.array([b[i] for b in each], f.type) for i, f in enumerate(fields)], names=names)
        sizes = np.array([len(blocks) for blocks in found], dtype=np.int64)
        starts = np.concatenate(([0], np.cumsum(sizes)))
        # rows without a CIGAR have no blocks
        codes = coded.indices.fill_null(len(found)).to_numpy(zero_copy_only=False).astype(np.int64)
        n = np.concatenate((sizes, [0]))[codes]
        ends = np.concatenate(([0], np.cumsum(n)))
        take = np.arange(ends[-1]) - np.repeat(ends[:-1] - starts[codes], n)
        return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), held.take(pa.array(take)))

    return read(as_col(cigar))


def flag_letters(flag) -> Column:
    """One letter per set bit, lowest bit first."""
    return F.concat(*[F.when(has(flag, 1 << i), F.lit(ch)).otherwise(F.lit("")) for i, ch in enumerate(FLAG_LETTERS)])


def flag_hex(flag) -> Column:
    return F.concat(F.lit("0x"), F.lower(F.hex(as_col(flag))))


def flag_struct(flag) -> Column:
    return F.struct(*[has(flag, 1 << i).alias(n) for i, n in enumerate(FLAG_NAMES)])

"""Nucleotide and protein sequences as Column expressions."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from .common import as_col, chars

# Bases in table order and the standard genetic code, one letter
# per codon with the third base changing fastest.
BASES = "TCAG"
GENETIC_CODE = "FFLLSSSSYY**CC*WLLLLPPPPHHQQRRRRIIIMTTTTNNKKSSRRVVVVAAAADDEEGGGG"
# Every base code and its complement, in both cases.
AMBIGUOUS_COMPLEMENT = ("ACGTRYMKWSNacgtrymkwsn", "TGCAYRKMWSNtgcayrkmwsn")
START_CODONS = ("ATG", "GTG")
STOP_CODONS = ("TAA", "TAG", "TGA")


def clean_sequence(seq) -> Column:
    """Upper case without white space."""
    return F.upper(F.regexp_replace(as_col(seq), r"\s", ""))


def wrap(seq, width: int = 80) -> Column:
    """A line break after every ``width`` characters, none at the end."""
    return F.rtrim(F.regexp_replace(as_col(seq), f"(.{{{width}}})", "$1\n"), F.lit("\n"))


def reverse_complement(seq) -> Column:
    return F.reverse(F.translate(as_col(seq), "ATGCatgc", "TACGtacg"))


def codons(seq) -> Column:
    """Consecutive triplets; a rest of one or two bases is kept as the last element."""
    return F.regexp_extract_all(as_col(seq), F.lit("(?s).{1,3}"), F.lit(0))


def amino_acid(codon: Column) -> Column:
    """One codon -> one letter, X when it is partial or holds another character."""

    def digit(i: int) -> Column:
        return F.instr(F.lit(BASES), F.substring(codon, i, 1)) - 1

    index = digit(1) * 16 + digit(2) * 4 + digit(3)
    known = (F.length(codon) == 3) & (F.length(F.translate(codon, BASES, "")) == 0)
    return F.when(known, F.substr(F.lit(GENETIC_CODE), index + 1, F.lit(1))).otherwise(F.lit("X"))


def _translator():
    digit_of = np.full(256, 64, np.int64)
    digit_of[[ord(b) for b in BASES]] = range(4)
    # a codon with another character is 64 or more
    letter_of = np.frombuffer(GENETIC_CODE.encode() + b"X" * (64 * 21 - 63), np.uint8)

    def translated(seq: str) -> str:
        # a character beyond one byte stands for one unknown base
        digit = digit_of[np.frombuffer(seq.encode("latin-1", "replace"), np.uint8)]
        whole = len(digit) // 3 * 3
        index = digit[0:whole:3] * 16 + digit[1:whole:3] * 4 + digit[2:whole:3]
        return letter_of[index].tobytes().decode() + "X" * (len(digit) > whole)

    def run(seqs: pd.Series) -> pd.Series:
        return seqs.map(translated, na_action="ignore")

    # else a filter on the protein would translate a second time
    return F.pandas_udf(run, StringType()).asNondeterministic()


_translate = _translator()


def translate_dna(seq) -> Column:
    """Codons to letters, X for one that is partial or holds another character; array steps per sequence."""
    return _translate(as_col(seq))


def gc_count(seq) -> Column:
    s = as_col(seq)
    return F.length(s) - F.length(F.translate(s, "GCgc", ""))


def all_indexes(text, pattern, block: int = 256) -> Column:
    """Every 1-based position of ``pattern``, overlapping matches included.

    The text is cut into blocks, each with the letters that a match may reach into, so the cost of a place does
    not grow with the text.
    """
    s, p = as_col(text), as_col(pattern)
    m = F.length(p)
    head = F.regexp_extract_all(s, F.lit(f"(?s).{{1,{block}}}"), F.lit(0))
    beyond = F.concat(F.lit(f"(?s).{{1,{block}}}(?=(.{{0,"), F.greatest(m - 1, F.lit(0)).cast("string"), F.lit("}))"))
    blocks = F.zip_with(head, F.regexp_extract_all(s, beyond, F.lit(1)), lambda h, t: F.concat(h, t))
    none = F.array().cast("array<int>")

    def places(x, i):
        hits = F.filter(F.sequence(F.lit(1), F.lit(block)), lambda j: F.substr(x, j, m) == p)
        return F.when(F.contains(x, p), F.transform(hits, lambda j: i * block + j)).otherwise(none)

    every = F.sequence(F.lit(1), F.length(s) + 1)
    return F.when(m == 0, every).otherwise(F.flatten(F.transform(blocks, places)))


def kmers(seq, k: int) -> Column:
    """Array of all substrings of length ``k``.

    One regular-expression pass with a look-ahead; cutting each one out with
    ``substring`` would walk the string from its start every time.
    """
    return F.regexp_extract_all(as_col(seq), F.lit(f"(?s)(?=(.{{{k}}}))"), F.lit(1))


def pieces(seq, size: int, overlap: int = 0) -> Column:
    """Consecutive pieces of ``size`` characters, each with the ``overlap`` characters that follow."""
    head = F.regexp_extract_all(as_col(seq), F.lit(f"(?s).{{1,{size}}}"), F.lit(0))
    if not overlap:
        return head
    tail = F.regexp_extract_all(as_col(seq), F.lit(f"(?s).{{1,{size}}}(?=(.{{0,{overlap}}}))"), F.lit(1))
    return F.zip_with(head, tail, lambda h, t: F.concat(h, t))


def is_uncomplex(seq, max_k: int = 19) -> Column:
    """One k-mer (k <= ``max_k``) repeated over the whole sequence plus a tail of at most k."""
    s = as_col(seq)
    n = F.length(s)

    def repeats(k):
        whole = F.floor(n / k).cast("int")
        m = F.when((n % k == 0) & (whole > 1), whole - 1).otherwise(whole)
        return (m >= 1) & (F.substr(s, F.lit(1), m * k) == F.repeat(F.substr(s, F.lit(1), k), m))

    return F.exists(F.sequence(F.lit(1), F.lit(max_k)), repeats)


def mask_lowercase(seq) -> Column:
    return F.translate(as_col(seq), "atcgn", "NNNNN")


def letters_md5(seq) -> Column:
    """md5 over the letters only, upper case."""
    return F.md5(F.upper(F.regexp_replace(as_col(seq), "[^A-Za-z]", "")))


def split_chars(seq) -> Column:
    return chars(seq)


def genome_position(aa_start, aa_end, lo, hi, strand) -> tuple[Column, Column]:
    """Protein interval -> nucleotide interval on the genome, both strands."""
    a, b, low, high, s = (as_col(x) for x in (aa_start, aa_end, lo, hi, strand))
    forward = (low + (a - 1) * 3, low + b * 3 - 1)
    backward = (high - b * 3 + 1, high - (a - 1) * 3)
    return (
        F.when(s == "-", backward[0]).otherwise(forward[0]),
        F.when(s == "-", backward[1]).otherwise(forward[1]),
    )

"""Quality rules: counts per document and bands of two language models per language.

Words are judged by the trigram model of ``word_model``, which grows with the corpus and stays in
Spark. Spelling is judged by a modified Kneser-Ney model of order four over 40 classes of bytes,
which has at most 40^4 = 2,560,000 entries however large the corpus is: that bounds what reaches
the driver and what is broadcast (under 45 MB). Both count every byte of every document.

Null and empty texts have no words, so they fail the base rules. A null language is a language
of its own. Ties and repeated rows get equal verdicts. Without any document nothing is trained
and the result is empty.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from . import word_model
from .text import SPACE, Texts, annotate, mix, repeated, replace_names, slices, sums, windows

CLASSES, ORDER = 40, 4
GRAMS = CLASSES**ORDER
COUNTS = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long"
#: Standard deviations of a byte's log perplexity, below and above the mean of the language. A text of few
#: bytes varies more: the variance of its bytes over their number is added.
LOWER_WIDTH, UPPER_WIDTH = 3.0, 2.5
#: The same for words, above the median, with the deviation from the quartiles: copies are well known to
#: the model and would move mean and variance. For the same reason there is no lower end: good near
#: copies lie lowest, and to drop them is another operator's job. Picked on the labels at sf0.1.
WORD_WIDTH = 3.2
#: A language table up to so many rows is broadcast; beyond it the join shuffles.
LANGUAGES_TO_BROADCAST = 10_000


def _classes() -> np.ndarray:
    """Byte -> class: 0 start, letters, digit, blanks, marks by kind, bytes of other scripts in seven groups."""
    out = np.full(256, 31, np.uint8)
    out[97:123] = np.arange(1, 27)
    out[65:91] = np.arange(1, 27)
    out[48:58] = 27
    out[SPACE] = 28
    out[10] = 29
    out[[ord(c) for c in ".,;:!?"]] = 30
    out[[ord(c) for c in "#*$%&|<>"]] = 32
    out[128:] = 33 + np.arange(128) % 7
    return out


CLASS_OF = _classes()
SYMBOL = np.zeros(256, bool)
SYMBOL[[ord(c) for c in "#*$%&|<>"]] = True


def grams(texts: Texts) -> np.ndarray:
    """The code of the four-gram that ends at each byte; a document begins with three start classes."""
    c = CLASS_OF[texts.data].astype(np.int32)
    code = c.copy()
    at = np.unique(texts.offsets[:-1][np.diff(texts.offsets) > 0])
    for back in range(1, ORDER):
        earlier = np.zeros_like(c)
        earlier[back:] = c[:-back]
        for k in range(back):  # what lies before the document's first byte
            place = at + k
            earlier[place[place < len(c)]] = 0
        code += earlier * CLASSES**back
    return code


def _counting(batches):
    total = np.zeros(GRAMS, np.int64)
    for batch in batches:
        for _, _, part in slices(batch.column(0)):
            if len(part.data):
                total += np.bincount(grams(part), minlength=GRAMS)
    at = np.flatnonzero(total)
    for i in range(0, len(at), 100_000):
        yield pa.RecordBatch.from_arrays([pa.array(at[i : i + 100_000].astype(np.int32)), pa.array(total[at[i : i + 100_000]])], names=["gram", "n"])


def count_grams(docs: DataFrame, column: str = "text") -> DataFrame:
    """How often each class four-gram occurs in all texts: (gram, n)."""
    parts = docs.select(column).mapInArrow(_counting, "gram int, n long")
    return parts.groupBy("gram").agg(F.sum("n").alias("n"))


@dataclass
class KneserNey:
    """Sorted n-gram codes with log probabilities, sorted contexts with log back-off weights, by order."""

    keys: list[np.ndarray]
    logp: list[np.ndarray]
    contexts: list[np.ndarray]
    backoff: list[np.ndarray]

    @classmethod
    def fit(cls, gram: np.ndarray, n: np.ndarray) -> KneserNey:
        dense = np.zeros(GRAMS, np.int64)
        dense[gram] = n
        tables = [dense.reshape((CLASSES,) * ORDER)]
        while tables[-1].ndim > 1:
            tables.append((tables[-1] > 0).sum(0))  # distinct left neighbours
        lower = np.full(CLASSES, 1 / CLASSES)
        keys, logp, contexts, backoff = [], [], [], []
        for counts in reversed(tables):
            of = [int((counts == k).sum()) for k in range(1, 5)]
            y = of[0] / max(1, of[0] + 2 * of[1])
            cut = [min(k, max(0.0, k - (k + 1) * y * of[k] / of[k - 1])) if of[k - 1] else 0.5 for k in (1, 2, 3)]
            discount = np.array([0.0, *cut])[np.minimum(counts, 3)]
            total = counts.sum(-1, keepdims=True)
            gamma = np.where(total > 0, discount.sum(-1, keepdims=True) / np.maximum(total, 1), 1.0)
            gamma = np.clip(gamma, 1e-9, 1.0)
            p = np.maximum(counts - discount, 0) / np.maximum(total, 1) + gamma * lower
            flat = np.flatnonzero(counts)
            keys.append(flat)
            logp.append(np.log(p.reshape(-1)[flat]).astype(np.float32))
            seen = np.flatnonzero(total.reshape(-1))
            contexts.append(seen)
            backoff.append(np.log(gamma.reshape(-1)[seen]).astype(np.float32))
            lower = p
        return cls(keys, logp, contexts, backoff)

    def score(self, codes: np.ndarray) -> np.ndarray:
        """Natural log probability of the last class of each four-gram given the three before it."""
        out = np.zeros(len(codes), np.float64)
        open_ = np.arange(len(codes))
        for level in range(ORDER - 1, -1, -1):
            code = codes[open_] % CLASSES ** (level + 1)
            at = np.minimum(np.searchsorted(self.keys[level], code), max(0, len(self.keys[level]) - 1))
            hit = self.keys[level][at] == code if len(self.keys[level]) else np.zeros(len(code), bool)
            out[open_[hit]] += self.logp[level][at[hit]]
            open_, code = open_[~hit], code[~hit]
            if not len(open_):
                return out
            context = code // CLASSES
            at = np.minimum(np.searchsorted(self.contexts[level], context), max(0, len(self.contexts[level]) - 1))
            known = self.contexts[level][at] == context if len(self.contexts[level]) else np.zeros(len(code), bool)
            out[open_[known]] += self.backoff[level][at[known]]
        out[open_] += np.log(1 / CLASSES)
        return out


def fit_model(docs: DataFrame, column: str = "text") -> KneserNey:
    """Count with Spark; the table of at most 40^4 rows becomes the model."""
    table = count_grams(docs, column).toArrow()
    return KneserNey.fit(table.column("gram").to_numpy(), table.column("n").to_numpy())


def base_counts(texts: Texts) -> list[np.ndarray]:
    starts, ends, counts = texts.spans(~SPACE)
    points = texts.code_points()
    document = np.repeat(np.arange(len(texts), dtype=np.uint64), counts)
    word_hash = texts.hashes(starts, ends)
    chars = sums(points[ends] - points[starts], counts)
    symbol_total = np.zeros(len(texts.data) + 1, np.int64)
    np.cumsum(SYMBOL[texts.data], out=symbol_total[1:])
    symbols = np.diff(symbol_total[texts.offsets])
    # lines
    not_end = np.ones(256, bool)
    not_end[10] = False
    line_start, line_end, per_doc = texts.spans(not_end)
    has_word = np.searchsorted(starts, line_end) > np.searchsorted(starts, line_start)
    line_doc = np.repeat(np.arange(len(texts), dtype=np.uint64), per_doc)
    with np.errstate(over="ignore"):
        line_key = mix(texts.hashes(line_start, line_end) + line_doc * np.uint64(0x9E3779B97F4A7C15))
    dup = np.zeros(len(line_key), bool)
    held = np.flatnonzero(has_word)
    if len(held):
        _, first = np.unique(line_key[held], return_index=True)
        dup[held] = True
        dup[held[first]] = False
    # words in windows of eight that occur again
    at, key = windows(word_hash, counts, 8)
    with np.errstate(over="ignore"):
        key = mix(key + document[at] * np.uint64(0x9E3779B97F4A7C15))
    again = at[repeated(key)]
    cover = np.zeros(len(starts) + 1, np.int64)
    np.add.at(cover, again, 1)
    np.add.at(cover, again + 8, -1)
    covered = np.cumsum(cover[:-1]) > 0
    return [counts, chars, symbols, sums(dup, per_doc), sums(covered, counts)]


def score_documents(docs: DataFrame, model: KneserNey, column: str = "text") -> DataFrame:
    """Adds the base counts, ``byte_ppl``, the mean negative log probability of a byte (null without text),
    and ``byte_var``, the variance of these."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def kernel():
        known = shared.value

        def run(texts: Texts) -> list:
            out = base_counts(texts)
            length = np.diff(texts.offsets)
            if len(texts.data):
                code = grams(texts)
                present = np.flatnonzero(np.bincount(code, minlength=GRAMS))
                dense = np.zeros(GRAMS, np.float32)
                dense[present] = known.score(present)
                each = dense[code].astype(np.float64)
                total, squares = -sums(each, length), sums(each * each, length)
            else:
                total = squares = np.zeros(len(texts))
            mean = total / np.maximum(length, 1)
            spread = np.maximum(squares / np.maximum(length, 1) - mean * mean, 0)
            return [*out, pa.array(mean, mask=length == 0), pa.array(spread, mask=length == 0)]

        return run

    return annotate(docs, COUNTS + ", byte_ppl double, byte_var double", kernel, column)


def base_failed() -> Column:
    return (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))


def language_bands(scored: DataFrame) -> DataFrame:
    """Per language, from all documents that pass the base rules: mean and variance of ``byte_ppl``, quartiles
    of ``log_ppl``, and the mean variances of a byte and of a word."""
    return (
        scored.filter(~base_failed()).groupBy(F.col("lang").alias("_lang"))
        .agg(
            F.avg("byte_ppl").alias("_mean"), F.coalesce(F.var_pop("byte_ppl"), F.lit(0.0)).alias("_var"), F.avg("byte_var").alias("_byte"),
            F.percentile_approx("log_ppl", [0.25, 0.5, 0.75]).alias("_quart"), F.avg("log_var").alias("_word"),
        )
    )


def quality_rules(docs: DataFrame, lower: float = LOWER_WIDTH, upper: float = UPPER_WIDTH, word: float = WORD_WIDTH) -> DataFrame:
    """Adds counts, ``log_ppl`` of a word and its upper limit ``ppl_high``, ``byte_ppl`` and its band
    (``byte_low``, ``byte_high``), ``base_failed`` and ``kept``.

    Needs ``text`` and ``lang``. Bands are one row per language in a written table; up to
    ``LANGUAGES_TO_BROADCAST`` of them are broadcast, more join by shuffle.
    """
    docs = replace_names(docs, ["log_ppl", "log_var", "ppl_high", "byte_ppl", "byte_var", "byte_low", "byte_high", "base_failed", "kept", "_key", "_bytes"])
    words = word_model.score_texts(docs).withColumnRenamed("key", "_k")
    scored = score_documents(docs.withColumn("_key", word_model.text_key("text")).withColumn("_bytes", F.octet_length("text")), fit_model(docs))
    scored = scored.join(words, F.col("_key") == F.col("_k"), "left").drop("_key", "_k")
    bands = cut_lineage(language_bands(scored))
    few = bands.limit(LANGUAGES_TO_BROADCAST + 1).count() <= LANGUAGES_TO_BROADCAST
    joined = scored.join(F.broadcast(bands) if few else bands, F.col("lang").eqNullSafe(F.col("_lang")), "left")
    width = F.sqrt(F.col("_var") + F.col("_byte") / F.greatest("_bytes", F.lit(1))) + 1e-9
    joined = joined.withColumn("byte_low", F.col("_mean") - lower * width).withColumn("byte_high", F.col("_mean") + upper * width)
    spread = (F.get("_quart", F.lit(2)) - F.get("_quart", F.lit(0))) / 1.349  # a normal distribution's deviation
    width = F.sqrt(spread * spread + F.col("_word") / F.greatest(F.col("n_words"), F.lit(1))) + 1e-9
    joined = joined.withColumn("ppl_high", F.get("_quart", F.lit(1)) + word * width)
    fits = F.coalesce(F.col("byte_ppl").between(F.col("byte_low"), F.col("byte_high")) & (F.col("log_ppl") <= F.col("ppl_high")), F.lit(False))
    return joined.withColumn("base_failed", base_failed()).withColumn("kept", ~base_failed() & fits).drop("_lang", "_mean", "_var", "_byte", "_quart", "_word", "_bytes", "log_var", "byte_var")

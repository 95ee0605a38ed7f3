"""Personal data: patterns, and a semi-Markov conditional random field over candidate segments.

A region is a stretch of number-like characters or of characters around an ``@``. Its tokens are
runs of letters, runs of digits and single marks. The field scores whole segments of up to
``LONGEST`` tokens with features of the span (digits, groups, check sum, lead, neighbours) for
each type, and one dynamic program over boundaries and types picks the best segmentation. Spans
found by the patterns stay; segments of the field that overlap none of them and whose score is at
least ``MARGIN`` are added.

The field is trained on regions of at most ``TRAINING_ROWS`` documents (those with a digit or an
``@``, in the order of a hash), whose pattern spans are the labels. Only this fit is bounded;
every text is searched whole.

Null and empty texts hold nothing. Repeated rows get the same spans. If no document has a region
the weights stay zero and nothing is added.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .text import Texts, annotate

KINDS = ("email", "ip", "card", "phone")
TRAINING_ROWS, EPOCHS, LONGEST, MARGIN = 400, 8, 16, 2.0

# Fixed patterns of the contract; the guards before digits only skip starts that would fail or be inside a match.
DOMAIN = re.compile(r"@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
IP = re.compile(r"(?<![0-9])[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
REGION = re.compile(r"[^\s@,;:<>|]{0,64}@[^\s@,;:<>|]{1,64}|[+(]?[0-9][0-9().+\x20-]{5,63}")
TOKEN = re.compile(r"[0-9]+|[^\W\d_]+|.", re.S)


def luhn(digits: str) -> bool:
    values = [int(c) for c in reversed(digits)]
    return (sum(values[::2]) + sum(d * 2 - 9 * (d > 4) for d in values[1::2])) % 10 == 0


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches found from each ``@``: the local part reaches back over its class."""
    low, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > low and text[start - 1] in LOCAL:
            start -= 1
        match = DOMAIN.match(text, at) if start < at else None
        if match:
            yield start, match.end()
            low = match.end()
        at = text.find("@", max(at + 1, low))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) of the patterns, by kind and start."""
    out = [(0, a, b) for a, b in emails(text)] if "@" in text else []
    out += [(1, m.start(), m.end()) for m in IP.finditer(text) if all(int(x[-4:]) <= 255 and len(x.lstrip("0")) <= 3 for x in m[0].split("."))]
    for m in CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 16 <= len(digits) <= 19 and luhn(digits):
            out.append((2, m.start(), m.end()))
    if "+" in text:
        out += [(3, m.start(), m.end()) for m in PHONE.finditer(text) if 8 <= sum(c.isdigit() for c in m[0]) <= 15]
    return out


def tokens(text: str, start: int, end: int) -> list[tuple[int, int]]:
    return [(m.start(), m.end()) for m in TOKEN.finditer(text, start, end)]


FEATURES = 22


def features(text: str, start: int, end: int) -> list[int]:
    """Numbers of the features that hold for a whole segment."""
    span = text[start:end]
    digits = re.sub("[^0-9]", "", span)
    n = len(digits)
    groups = span.split(".")
    out = [0]
    out.append(1 if n == 0 else 2 if n < 8 else 3 if n <= 12 else 4 if n <= 15 else 5 if n <= 19 else 6)
    if "@" in span:
        at = span.rindex("@")
        out.append(7 if at and "." in span[at:] and span[-1].isalnum() else 8)
    if len(groups) == 4 and all(g.isdigit() and len(g) <= 3 and int(g) <= 255 for g in groups):
        out.append(9)
    if 16 <= n <= 19:
        out.append(10 if luhn(digits) else 11)
    out.append(12 if span[0] == "+" else 13 if span[0].isdigit() else 14 if span[0].isalpha() else 15)
    if not (span[-1].isalnum()):
        out.append(16)
    if start and text[start - 1].isalnum():
        out.append(17)
    if end < len(text) and text[end].isalnum():
        out.append(18)
    if "(" in span and ")" in span:
        out.append(19)
    if any(c.isalpha() for c in span):
        out.append(20)
    if "  " in span or span != span.strip():
        out.append(21)
    return out


def candidates(text: str, cut: list[tuple[int, int]]) -> dict[tuple[int, int], list[int]]:
    """Segments of up to ``LONGEST`` tokens that begin and end like personal data, with their features."""
    out = {}
    for i, (a, _) in enumerate(cut):
        if not (text[a].isalnum() or text[a] in "+("):
            continue
        for j in range(i, min(len(cut), i + LONGEST)):
            b = cut[j][1]
            if text[b - 1].isalnum() and b - a >= 6:
                out[(i, j + 1)] = features(text, a, b)
    return out


def forward(size: int, scores: dict[tuple[int, int], np.ndarray]) -> np.ndarray:
    """Log sums over all segmentations of the first tokens; a token outside any segment scores 0."""
    by_end: dict[int, list] = {}
    for (i, j), s in scores.items():
        by_end.setdefault(j, []).append((i, np.logaddexp.reduce(s)))
    out = np.zeros(size + 1)
    for j in range(1, size + 1):
        terms = [out[j - 1], *[out[i] + s for i, s in by_end.get(j, ())]]
        out[j] = np.logaddexp.reduce(terms)
    return out


def best(size: int, scores: dict[tuple[int, int], np.ndarray]) -> list[tuple[int, int, int, float]]:
    """The segmentation with the highest score: (first token, end token, kind, score)."""
    by_end: dict[int, list] = {}
    for (i, j), s in scores.items():
        k = int(np.argmax(s))
        by_end.setdefault(j, []).append((i, k, float(s[k])))
    value, back = [0.0], [None]
    for j in range(1, size + 1):
        top, came = value[j - 1], None
        for i, k, s in by_end.get(j, ()):
            if value[i] + s > top:
                top, came = value[i] + s, (i, j, k, s)
        value.append(top)
        back.append(came)
    out, j = [], size
    while j:
        if back[j] is None:
            j -= 1
        else:
            out.append(back[j])
            j = back[j][0]
    return out[::-1]


def train(texts: list[str]) -> np.ndarray:
    """Weights (kind, feature) by gradient ascent on the likelihood of the pattern spans."""
    weights = np.zeros((len(KINDS), FEATURES))
    regions = []
    for text in texts:
        gold = {(a, b): k for k, a, b in base_spans(text)}
        for m in REGION.finditer(text):
            cut = tokens(text, m.start(), m.end())
            options = candidates(text, cut)
            if options:
                want = {seg: gold[(cut[seg[0]][0], cut[seg[1] - 1][1])] for seg in options if (cut[seg[0]][0], cut[seg[1] - 1][1]) in gold}
                regions.append((len(cut), options, want))
    for epoch in range(EPOCHS):
        rate = 0.5 / (1 + epoch)
        for size, options, want in regions:
            scores = {seg: weights[:, f].sum(1) for seg, f in options.items()}
            ahead = forward(size, scores)
            behind = forward(size, {(size - j, size - i): s for (i, j), s in scores.items()})[::-1]
            for seg, f in options.items():
                p = np.exp(np.minimum(0.0, ahead[seg[0]] + scores[seg] + behind[seg[1]] - ahead[size]))
                step = -p
                if seg in want:
                    step[want[seg]] += 1
                if np.abs(step).max() > 1e-4:
                    weights[:, f] += rate * (step[:, None] - 1e-3 * weights[:, f])
    return weights


def training_texts(docs: DataFrame, rows: int, column: str) -> list[str]:
    """Stretches around digits and ``@`` of at most ``rows`` documents: a bounded sample."""
    near = F.regexp_extract_all(column, F.lit(r"([^\n]{0,24}[0-9@][^\n]{0,64})"), 1)
    sample = docs.filter(F.col(column).rlike("[0-9@]")).select(F.xxhash64(column).alias("h"), F.slice(near, 1, 20).alias("near"))
    return [x for r in sample.orderBy("h", "near").limit(rows).collect() for x in r["near"]]


def find_personal(docs: DataFrame, rows: int = TRAINING_ROWS, column: str = "text", drop: bool = False) -> DataFrame:
    """Adds ``personal``: array of (kind, start, end, base) in code points, by kind as listed, then start."""
    weights = train(training_texts(docs, rows, column))
    shared = docs.sparkSession.sparkContext.broadcast(weights)
    trigger = np.zeros(256, bool)
    trigger[[64, *range(48, 58)]] = True

    def kernel():
        w = shared.value

        def added(text: str, base: list) -> Iterator[tuple[int, int, int]]:
            taken = sorted((a, b) for _, a, b in base)
            for m in REGION.finditer(text):
                cut = tokens(text, m.start(), m.end())
                scores = {seg: w[:, f].sum(1) for seg, f in candidates(text, cut).items()}
                for i, j, k, s in best(len(cut), scores):
                    a, b = cut[i][0], cut[j - 1][1]
                    if s >= MARGIN and not any(x < b and y > a for x, y in taken):
                        yield k, a, b

        def run(texts: Texts) -> list:
            total = np.concatenate([[0], np.cumsum(trigger[texts.data])])
            out = []
            for i in range(len(texts)):
                if total[texts.offsets[i + 1]] == total[texts.offsets[i]]:
                    out.append([])
                    continue
                text = texts.text(i)
                base = base_spans(text)
                spans = [(*x, True) for x in base] + [(*x, False) for x in added(text, base)]
                out.append([{"kind": KINDS[k], "start": a, "end": b, "base": own} for k, a, b, own in sorted(spans)])
            return [out]

        return run

    return annotate(docs, "personal array<struct<kind:string,start:int,end:int,base:boolean>>", kernel, column, drop)


def redact(docs: DataFrame, rows: int = TRAINING_ROWS, column: str = "text") -> DataFrame:
    """Every span replaced by its kind in angle brackets; overlapping spans become one, named after the first."""
    found = find_personal(docs, rows, column)
    ordered = F.array_sort(F.transform("personal", lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end"), x["kind"].alias("kind"))))

    def step(done, x):
        free = x["start"] >= done["end"]
        head = F.concat(done["text"], F.substring(F.col(column), done["end"] + 1, x["start"] - done["end"]), F.lit("<"), F.upper(x["kind"]), F.lit(">"))
        return F.struct(F.when(free, head).otherwise(done["text"]).alias("text"), F.greatest(done["end"], x["end"]).alias("end"))

    begin = F.struct(F.lit("").alias("text"), F.lit(0).alias("end"))
    body = F.aggregate(ordered, begin, step, lambda d: F.concat(d["text"], F.substring(F.col(column), d["end"] + 1, F.length(column))))
    return found.withColumn(column, F.when(F.size("personal") > 0, body).otherwise(F.col(column)))

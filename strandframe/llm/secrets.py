"""Secret scans: all rules in one automaton, one pass over the bytes.

The forward automaton marks where a rule's match ends. From the first end behind the last match
an anchored automaton of the reversed rules finds the start, an anchored forward one the longest
end. This gives the leftmost longest matches without overlap, for rules whose earlier match never
ends first later than a later match does; all rules here are such, as they begin with a fixed
word or are runs of one class.

Null and empty texts have no secrets. Repeated rows are scanned alike.
"""

from __future__ import annotations

import hashlib
import re
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .automaton import Dfa, backwards, parse
from .text import Texts, annotate

#: Fixed values of the contract, then further rules: kind -> pattern. Counted repeats multiply the
#: states of the combined automaton, so all but the hex run ask for their length afterwards.
BASE_RULES = {
    "assign": r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    "access": r"AKIA[A-Z0-9]+",
    "hex": r"[0-9a-f]{8,}",
}
MORE_RULES = {
    "github": r"gh[oprsu]_[A-Za-z0-9]+",
    "slack": r"xox[abprs]-[A-Za-z0-9-]+",
    "webtoken": r"eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+",
    "pem": r"-----BEGIN [A-Z ]*PRIVATE KEY-----",
}
#: Characters of a whole match at least; for assignments, of the value.
LEAST = {"assign": 6, "access": 20, "hex": 24, "github": 40, "slack": 15, "webtoken": 40}


@dataclass
class Scanner:
    names: list[str]
    search: Dfa
    ahead: Dfa
    back: Dfa

    @classmethod
    def compile(cls, rules: dict[str, str]) -> Scanner:
        trees = [parse(p) for p in rules.values()]
        return cls(list(rules), Dfa.build(trees, True), Dfa.build(trees, False), Dfa.build([backwards(t) for t in trees], False))

    def matches(self, texts: Texts) -> list[tuple[int, int, int, int]]:
        """(document, rule, start byte, end byte) in the slice, by document, rule and start."""
        at, bits = self.search.scan(texts)
        out = []
        if not len(at):
            return out
        document = np.searchsorted(texts.offsets, at - 1, "right") - 1
        data, offsets = texts.data, texts.offsets
        for rule in range(len(self.names)):
            on = np.flatnonzero(bits >> rule & 1)
            places, docs = at[on], document[on]
            i = 0
            last_doc, last_end = -1, 0
            while i < len(places):
                doc, end = int(docs[i]), int(places[i])
                low = max(int(offsets[doc]), last_end if doc == last_doc else 0)
                start = self.back.longest(data, end, low, rule, -1)
                if start < 0:
                    i += 1
                    continue
                stop = self.ahead.longest(data, start, int(offsets[doc + 1]), rule)
                out.append((doc, rule, start, stop))
                last_doc, last_end = doc, stop
                i = int(np.searchsorted(places, stop, "right"))
        return sorted(out)


_compiled: dict[tuple, Scanner] = {}


def scanner(rules: dict[str, str]) -> Scanner:
    key = tuple(rules.items())
    if key not in _compiled:
        made = Scanner.compile(rules)
        made.search.prepare()
        _compiled[key] = made
    return _compiled[key]


def _holds(kind: str, match: str) -> bool:
    """Is the match, of all that its rule takes, long enough?"""
    if kind == "assign":
        match = re.fullmatch(BASE_RULES["assign"], match)[2]
    return len(match) >= LEAST.get(kind, 0)


def find_secrets(docs: DataFrame, more_rules: dict[str, str] | None = None, column: str = "text", drop: bool = False) -> DataFrame:
    """Adds ``secrets``: array of (kind, start, end) in code points, by start, then kind as listed."""
    rules = BASE_RULES | (MORE_RULES if more_rules is None else more_rules)
    shared = docs.sparkSession.sparkContext.broadcast(scanner(rules))  # some hundred kilobytes, set by the rules alone

    def kernel():
        scan = shared.value
        scan.search.prepare()

        def run(texts: Texts) -> list:
            found: list[list] = [[] for _ in range(len(texts))]
            points: dict[int, np.ndarray] = {}
            for doc, rule, start, end in scan.matches(texts):
                first = int(texts.offsets[doc])
                if not _holds(scan.names[rule], texts.data[start:end].tobytes().decode("utf-8", "replace")):
                    continue
                if doc not in points:
                    body = texts.data[first : int(texts.offsets[doc + 1])]
                    points[doc] = np.concatenate([[0], np.cumsum((body & 0xC0) != 0x80)])
                found[doc].append((int(points[doc][start - first]), rule, int(points[doc][end - first])))
            return [[[{"kind": scan.names[r], "start": s, "end": e} for s, r, e in sorted(x)] for x in found]]

        return run

    return annotate(docs, "secrets array<struct<kind:string,start:int,end:int>>", kernel, column, drop)


def joined(spans, base: tuple[str, ...] | None = None):
    """``kind:start:end`` of the spans (of the kinds ``base``), comma-joined."""
    if base:
        spans = F.filter(spans, lambda x: x["kind"].isin(*base))
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")


def count_kind(spans, kind: str):
    return F.size(F.filter(spans, lambda x: x["kind"] == kind)).cast("long")


def digest(text):
    return F.sha2(text.cast("binary"), 256)

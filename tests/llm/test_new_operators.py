"""Line dedup, fill-in-the-middle and conversation repair: methods against brute force, odd inputs."""

import collections
import hashlib
import itertools
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from strandframe.llm import chat_repair, fill_middle, line_dedup
from strandframe.llm.text import slices

LONG = "lorem ipsum dolor sit amet, " * 40_000
LINE = "A line of more than forty characters, with Übung"


def fold(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


# ---- line dedup ----------------------------------------------------------------------------------


@pytest.mark.parametrize("n", [0, 1, 2, 1000, 20_000])
def test_perfect_hash(n):
    rng = np.random.default_rng(n)
    h = rng.integers(0, 1 << 63, n, dtype=np.uint64)
    f = rng.integers(0, 1 << 63, n, dtype=np.uint64) << np.uint64(1)
    h[: n // 2] = h[:1].repeat(n // 2)  # equal first halves
    counts, lasts = rng.integers(1, 700, n), rng.integers(0, 99, n)
    made = line_dedup.LineIndex.build(h, f, counts, lasts, 5)
    names = ("shard", "levels", "bits", "marks", "counts", "lasts")
    made = line_dedup.LineIndex.of_row(dict(zip(names, made.row(3))), 5)
    slots = made.slots(h, f)
    assert sorted(slots) == list(range(n)) and (made.counts[slots] == counts).all()
    known = np.ones(n, bool)
    assert (made.goes(h, f, lasts, known) == np.zeros(n)).all()
    assert (made.goes(h, f, lasts + 1, known) == (counts >= 5)).all()
    assert (made.goes(h, f, lasts, ~known) == (counts >= 5)).all()
    other = rng.integers(0, 1 << 63, 5000, dtype=np.uint64)
    assert not made.goes(other, other, np.zeros(5000), np.ones(5000, bool)).any()


def kept_lines(rows, least=40, min_docs=5):
    key = lambda line: fold(line.strip(" \t\n\v\f\r"))
    docs = collections.defaultdict(set)
    for i, text in rows:
        for line in (text or "").split("\n"):
            if len(key(line)) >= least:
                docs[key(line)].add(i)
    last = {k: max(d, key=lambda i: (i is not None, i or 0)) for k, d in docs.items() if len(d) >= min_docs}
    out = []
    for i, text in rows:
        lines = (text or "").split("\n")
        stay = [x for x in lines if key(x) not in last or last[key(x)] == i]
        out.append((i, len(lines), len(lines) - len(stay), "\n".join(stay)))
    return sorted(out, key=repr)


def test_dedup_lines(spark):
    rows = [(i, f"{LINE}\n own line {i} that is long enough to count, really\n\t{LINE.upper().replace('Ü', 'ü')} \n") for i in range(4)]
    rows += [(None, LINE), (9, f"x\n{LINE}\nshort\n{LINE}"), (9, f"x\n{LINE}\nshort\n{LINE}"), (9, LINE.replace("line", "LINE") + "\nother"), (7, None), (8, ""), (10, "\n"), (11, LONG + "\n" + LINE)]
    rows += [(100 + i, "é" * 40 + "\n" + "é" * 39) for i in range(6)] + [(None, "z" * 41), (None, "z" * 41)] + [(200 + i, "z" * 41) for i in range(3)]
    docs = spark.createDataFrame([(*r, "a", 1) for r in rows], "doc_id long, text string, N_lines string, t int")
    out = line_dedup.dedup_lines(docs)
    assert out.columns == ["doc_id", "text", "t", "n_lines", "n_dropped", "kept_text"]
    got = sorted([(r["doc_id"], r["n_lines"], r["n_dropped"], r["kept_text"]) for r in out.collect()], key=repr)
    assert got == kept_lines(rows)
    assert line_dedup.dedup_lines(docs.limit(0)).count() == 0
    with pytest.raises(ValueError):
        line_dedup.dedup_lines(docs, min_docs=1)


def test_dedup_parameters(spark):
    rng = random.Random(5)
    rows = [(rng.randint(0, 60), "\n".join(rng.choice(["abc", "Abc ", "abd", "x", "", " longer line"]) for _ in range(rng.randint(0, 6)))) for _ in range(80)]
    out = line_dedup.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string"), least=3, min_docs=2)
    assert sorted([(r["doc_id"], r["n_lines"], r["n_dropped"], r["kept_text"]) for r in out.collect()], key=repr) == kept_lines(rows, 3, 2)


# ---- fill-in-the-middle --------------------------------------------------------------------------


def test_units():
    rng = random.Random(1)
    letters = "abzAZ@[`{ \n0é漢🙂\x00\x7f<"
    words = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 30))) for _ in range(200)] + ["", "a", "🙂", "z" * 70]
    for _, _, texts in slices(pa.array(words)):
        units = fill_middle.Units(texts)
        base = units.up_to(texts.offsets[:-1])
        for i, word in enumerate(words):
            want = re.findall("[A-Za-z]+|[^A-Za-z]", word)
            assert units.up_to(texts.offsets[i + 1 : i + 2])[0] - base[i] == len(want)
            ends = units.after(base[i] + np.arange(1, len(want) + 1)) - texts.offsets[i]
            assert ends.tolist() == [len("".join(want[: k + 1]).encode()) for k in range(len(want))]


def fim(i, text):
    text = text or ""
    digest = hashlib.sha256(f"1:{'' if i is None else i}".encode()).hexdigest()
    h = [int(digest[8 * k : 8 * k + 8], 16) for k in range(4)]
    units = re.findall("[A-Za-z]+|[^A-Za-z]", text)
    a, b = sorted(x % (len(units) + 1) for x in h[:2])
    p, m, s = ("".join(units[x:y]) for x, y in ((0, a), (a, b), (b, None)))
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return (i, len(units), "plain", None, None, text)
    if h[3] % 100 < 20:
        return (i, len(units), "spm", p, m, f"<S>{s}<P>{p}<M>{m}")
    return (i, len(units), "psm", p, m, f"<P>{p}<S>{s}<M>{m}")


def test_fill_middle(spark):
    texts = ["", None, "a", "two words", "é🙂\n漢 <S", "P> <M", "with <P> mark", "<<S><M><P>", "<P", ">", LONG, "line\nline\n", "word" * 500]
    rows = [(i * 13 + k, t) for i in range(30) for k, t in enumerate(texts) if t != LONG or i < 2] + [(None, "no key at all"), (None, "no key at all"), (0, "twice"), (0, "twice")]
    docs = spark.createDataFrame([(*r, "x", 3) for r in rows], "doc_id long, text string, Form string, extra int")
    out = fill_middle.fill_middle(docs)
    assert out.columns == ["doc_id", "text", "extra", "n_units", "form", "prefix", "middle", "suffix", "output"]
    back = out.withColumn("back", fill_middle.restore("output", "form")).collect()
    got = [(r["doc_id"], r["n_units"], r["form"], r["prefix"], r["middle"], r["output"]) for r in back]
    assert sorted(got, key=repr) == sorted([fim(*r) for r in rows], key=repr)
    assert all(r["back"] == (r["text"] or "") for r in back)
    assert {r["form"] for r in back} == {"plain", "psm", "spm"}
    assert fill_middle.fill_middle(docs.limit(0)).count() == 0


# ---- conversation repair -------------------------------------------------------------------------


def least_repair(symbols):
    """(cost, audit) by a plain walk over (rows done, state), whole strings kept."""
    legal = {0: "su", 1: "u", 2: "a", 3: "u"}
    after = {"s": 1, "u": 2, "a": 3}

    def grown(front):
        for _ in range(3):
            for state, (cost, text) in list(front.items()):
                for x in "ua":
                    if x in legal[state]:
                        new = (cost + 5, text + "I")
                        if after[x] not in front or new < front[after[x]]:
                            front[after[x]] = new
        return front

    front = grown({0: (0, "")})
    for symbol in symbols:
        new = {}

        def put(state, cost, text):
            if state not in new or (cost, text) < new[state]:
                new[state] = (cost, text)

        for state, (cost, text) in front.items():
            put(state, cost + 2, text + "D")
            if symbol != "D":
                lost, role = 5 * symbol.isupper(), symbol.lower()
                if role in legal[state]:
                    put(after[role], cost + lost, text + "K")
                put(2 if "u" in legal[state] else 3, cost + lost + 1, text + "R")
        front = grown(new)
    return min(front[s] for s in (0, 3) if s in front)


def tried_out(symbols, limit):
    """All edit strings up to a number of insertions, by trial."""
    best = None
    for edits in itertools.product("KRD", repeat=len(symbols)):
        for holes in itertools.product(range(limit + 1), repeat=len(symbols) + 1):
            for fill in itertools.product("ua", repeat=sum(holes)):
                cost, audit, roles, more = 0, "", [""], iter(fill)
                for k in range(len(symbols) + 1):
                    for _ in range(holes[k]):
                        cost, audit, roles = cost + 5, audit + "I", [r + next(more) for r in roles[:1]]
                    if k == len(symbols):
                        break
                    x, s = edits[k], symbols[k]
                    if s == "D" and x != "D":
                        cost = 10_000
                    cost += {"K": 0, "R": 1, "D": 2}[x] + 5 * (s.isupper() and s != "D" and x != "D")
                    audit += x
                    if x == "K":
                        roles = [r + s.lower() for r in roles]
                    elif x == "R":
                        roles = [r + c for r in roles for c in "ua"]
                if any(re.fullmatch("(s?(ua)+)?", r) for r in roles) and (best is None or (cost, audit) < best):
                    best = (cost, audit)
    return best


def test_plain_walk():
    for n in range(3):
        for symbols in itertools.product("DsuaoSU", repeat=n):
            assert least_repair(symbols) == tried_out(symbols, 2)


def test_grammar_and_segments():
    rng = random.Random(3)
    rules = [("u", "a"), (chr(0x100), chr(0x100)), ("D", "D"), ("a", "u"), (chr(0x101), "s"), (chr(0x102), chr(0x102)), ("U", "a")]
    known = chat_repair.rule_matrices(rules)
    for trial in range(400):
        seq = "".join(rng.choice("uaDsoSUAO" if trial % 2 else "uauauaD") for _ in range(rng.randint(1, 60)))
        cuts = sorted(rng.sample(range(1, len(seq)), min(len(seq) - 1, rng.randint(0, 4)))) if len(seq) > 1 else []
        parts = [seq[a:b] for a, b in zip([0, *cuts], [*cuts, len(seq)])]
        solved = []
        for part in parts:
            made = chat_repair.segment_matrix(part, rules, known)
            cells = [made.get((i, j)) for i in range(4) for j in range(4)]
            ranks = [None] * 16
            for i in range(4):
                own = [x for x in range(4 * i, 4 * i + 4) if cells[x]]
                for r, x in enumerate(sorted(own, key=lambda x: cells[x][1].text())):
                    ranks[x] = r
            solved.append(([c and c[0] for c in cells], ranks, [c and c[1].text() for c in cells]))
        cost, path = chat_repair.follow([(c, r) for c, r, _ in solved])
        audit = "".join(a[i * 4 + j] for (_, _, a), (i, j) in zip(solved, path)) + chat_repair.TAILS[path[-1][1]][1]
        assert (cost, audit) == least_repair(seq), (seq, parts)


def by_hand(rows):
    """The contract, row by row: conv_id -> counts, audit and repaired lines."""
    sp = lambda x: " " if x is None else str(x)
    groups = {c: [] for c, *_ in rows}
    for conv, turn, role, text in rows:
        k = zlib.crc32(f"{sp(conv)}:{sp(turn)}".encode()) % 20
        role, text = sp(role), sp(text)
        text = "" if k == 1 else re.sub("[.!?]", "", text) if k == 2 else text
        groups[conv] += [(turn, "user" if k == 4 else role, text)] * (0 if k == 0 else 2 if k == 3 else 1)
    out = {}
    for conv, own in groups.items():
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        turns = [r[0] for r in own if r[0] is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        faults, symbols, seen = collections.Counter(), "", set()
        for _, role, text in own:
            body = text.strip(" \t\n\v\f\r")
            fault = "blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else ""
            seen.add((role, text))
            faults[fault] += 1
            mark = role[:1] if role[:1] in ("s", "u", "a") else "o"
            symbols += "D" if fault in ("blank", "duplicate") else mark.upper() if fault else mark
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(own, own[1:]))
        cost, audit = least_repair(symbols)
        lines, n, rest = [], len(audit.replace("D", "")), iter(own)
        for x in audit:
            row = None if x == "I" else next(rest)
            if x != "D":
                role = "user" if (len(lines) - n % 2) % 2 == 0 else "assistant"
                lines.append(f"{row[1] if x == 'K' else role}:{row[2] if row else ''}")
        out[conv] = (gaps, faults["blank"], faults["duplicate"], faults["truncated"], illegal, cost, audit, lines)
    return out


def test_repair(spark):
    rng = random.Random(8)
    roles, texts = ["user", "assistant", "system", "tool", "", None, "User"], ["Yes.", "No", "", None, " \t", "why?", "Ja!\n", "é 漢.", LONG[:300]]
    rows = [(rng.choice([None, *range(40)]), rng.choice([None, *range(12)]), rng.choice(roles[: rng.choice([2, 3, 7])]), rng.choice(texts)) for _ in range(600)]
    rows += [(1000, t, ["user", "assistant"][t % 2], f"Turn {t // 7}.") for t in range(1500)]  # several segments
    rows += [(1001, 5, "user", "the same")] * 1200 + [(1002, None, "system", "x.")] + [(1003, 0, "user", LONG)] * 2
    rows += [(c, t, "user", "alone.") for c in range(2000, 2100) for t in (3,)]
    frame = spark.createDataFrame([(*r, 1, "z") for r in rows], "conv_id long, turn long, role string, text string, m int, Audit string")
    got = {r["conv_id"]: r for r in chat_repair.repair_conversations(frame).collect()}
    want = by_hand(rows)
    assert set(got) == set(want)
    for conv, (*counts, audit, lines) in want.items():
        r = got[conv]
        assert [r[c] for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")] == counts, conv
        assert r["audit"] == audit and [f"{t['role']}:{t['text']}" for t in r["turns"]] == lines, conv
    assert sum(not lines for *_, lines in want.values()) > 3
    none = chat_repair.repair_conversations(frame.limit(0))
    assert none.count() == 0 and none.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "turns"]

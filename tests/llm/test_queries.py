"""The queries against brute force (or their oracles) on the smallest tables, and the pipeline."""

import collections
import hashlib
import re
import zlib

import duckdb
import pytest

import oracle_check
from strandframe.llm import decontaminate, pii, queries
from strandframe.plans.registry import Query
from strandframe.session import scratch_path

SF = "/root/testdata/sf0.001"


def fold(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


@pytest.fixture(scope="module")
def docs():
    return {i: t or "" for i, t in duckdb.connect().sql(f"SELECT doc_id, text FROM '{SF}/documents.parquet'").fetchall()}


def rows(spark, name):
    out = {}
    for r in queries.QUERIES[name](spark, SF).collect():
        out[r[0]] = r.asDict()
    return out


@pytest.mark.parametrize("name", list(queries.ORACLES))
def test_oracles(spark, name):
    con = oracle_check.connect(SF)
    oracle_check.REGISTRY[name] = Query(name, queries.QUERIES[name], queries.ORACLES[name])
    try:
        ok, text, _ = oracle_check.compare(spark, con, name, SF)
    finally:
        del oracle_check.REGISTRY[name]
    assert ok, text


def test_op1(spark, docs):
    items = duckdb.connect().sql(f"SELECT item_id, text FROM '{SF}/benchmark.parquet'").fetchall()
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    held = collections.defaultdict(set)
    for item, text in items:
        w = word.findall(fold(text or ""))
        n = min(10, len(w))
        for k in range(len(w) - n + 1 if n else 0):
            held[tuple(w[k : k + n])].add(str(item))
    got = rows(spark, "op1_decontaminate")
    assert set(got) == set(docs)
    for i, text in docs.items():
        w = word.findall(fold(text))
        hit, found = [0] * len(w), set()
        for n in set(map(len, held)):
            for k in range(len(w) - n + 1):
                if (own := held.get(tuple(w[k : k + n]))):
                    found |= own
                    hit[k : k + n] = [1] * n
        r = got[i]
        assert (r["n_words"], r["n_hit"], r["n_items"], r["contaminated"]) == (len(w), sum(hit), len(found), any(hit))
        assert r["items_sha256"] == sha(",".join(sorted(found)))


def test_op2(spark, docs):
    sentencepiece = pytest.importorskip("sentencepiece")
    from strandframe.llm import sentencepiece_scan as scan

    library = sentencepiece.SentencePieceProcessor(model_file=scan.default_model())
    model = scan.Pieces.read(scan.default_model())
    table = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    for chunk in (scan.CHUNK, 700):
        got = {r["doc_id"]: r["ids"] for r in scan.encode(table, model, chunk=chunk).collect()}
        assert all(got[i] == library.encode(t) for i, t in docs.items())
    assert all(r["round_trip"] for r in rows(spark, "op2_sentencepiece").values())


def test_op3(spark, docs):
    got = rows(spark, "op3_shard")
    assert set(got) == set(docs)
    shards = collections.defaultdict(list)
    for i, r in got.items():
        raw = docs[i].encode()
        assert (r["size"], r["text_crc32"], r["law"], r["grown_shard"]) == (len(raw) + 8, zlib.crc32(raw), "bytes", None)
        shards[r["shard"]].append(r)
    assert set(shards) <= set(range(24))
    for own in shards.values():
        assert sorted(r["slot"] for r in own) == list(range(len(own)))
    totals = [sum(r["size"] for r in shards[s]) for s in range(24)]
    largest = max(r["size"] for r in got.values())
    assert max(totals) - min(totals) <= 2 * largest


def test_op4(spark, docs):
    patterns = {"assign": r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", "access": "AKIA[A-Z0-9]+", "hex": "[0-9a-f]+"}
    got = rows(spark, "op4_find_secrets")
    for i, text in docs.items():
        spans = []
        for k, (kind, p) in enumerate(patterns.items()):
            for m in re.finditer(p, text):
                if len(m[2] if kind == "assign" else m[0]) >= {"assign": 6, "access": 20, "hex": 24}[kind]:
                    spans.append((m.start(), k, kind, m.end()))
        assert got[i]["base_sha256"] == sha(",".join(f"{kind}:{a}:{b}" for a, _, kind, b in sorted(spans)))


def test_op5(spark, docs):
    got = rows(spark, "op5_quality_rules")
    for i, text in docs.items():
        w = re.findall(r"[^\x20\x09-\x0D]+", text)
        lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        count = collections.Counter(tuple(w[k : k + 8]) for k in range(len(w) - 7))
        mark = [0] * len(w)
        for k in range(len(w) - 7):
            if count[tuple(w[k : k + 8])] > 1:
                mark[k : k + 8] = [1] * 8
        r = got[i]
        want = (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), sum(mark))
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == want
        failed = len(w) < 20 or 100 * sum(mark) > 30 * len(w)
        assert r["base_failed"] == failed and not (failed and r["kept"])


def shingles(text, n=3):
    w = re.findall(r"[^\x20\x09-\x0D]+", fold(text or ""))
    return frozenset(tuple(w[k : k + n]) for k in range(len(w) - n + 1)) if len(w) >= n else frozenset([tuple(w)] if w else [])


def classes(texts, words=3, least=90):
    """Class of each text by comparing all couples that share a shingle."""
    sets = {i: shingles(t, words) for i, t in texts.items()}
    parent = {i: i for i in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    holders = collections.defaultdict(list)
    for i in sorted(sets):
        shared = collections.Counter(j for x in sets[i] for j in holders[x])
        for j, n in shared.items():
            if 100 * n >= least * (len(sets[i]) + len(sets[j]) - n):
                a, b = sorted((root(i), root(j)))
                parent[b] = a
        for x in sets[i]:
            holders[x].append(i)
    return {i: (len(sets[i]), root(i)) for i in sets}


def test_op7(spark, docs):
    got = rows(spark, "op7_ngram_classes")
    assert {i: (r["n_shingles"], r["component_id"]) for i, r in got.items()} == classes(docs)


def luhn(digits):
    values = [int(c) for c in reversed(digits)]
    return (sum(values[::2]) + sum(sum(divmod(2 * x, 10)) for x in values[1::2])) % 10 == 0


def personal(text):
    spans = [("email", m.start(), m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    spans += [("ip", m.start(), m.end()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(x) <= 255 for x in m[0].split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = re.sub("[^0-9]", "", m[0])
        if 16 <= len(d) <= 19 and luhn(d):
            spans.append(("card", m.start(), m.end()))
    return spans + [("phone", m.start(), m.end()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 8 <= len(re.sub("[^0-9]", "", m[0])) <= 15]


def test_op9(spark, docs):
    got = rows(spark, "op9_find_personal")
    for i, text in docs.items():
        assert got[i]["base_sha256"] == sha(",".join(f"{k}:{a}:{b}" for k, a, b in personal(text)))
        assert set(f"{k}:{a}:{b}" for k, a, b in personal(text)) <= set(got[i]["spans"].split(",") if got[i]["spans"] else ())


def test_op10(spark):
    """Held-out accuracy on a larger table."""
    sf = "/root/testdata/sf0.1"
    got = {r["doc_id"]: r for r in queries.QUERIES["op10_score_toxicity"](spark, sf).collect()}
    labels = dict(duckdb.connect().sql(f"SELECT doc_id, toxic FROM '{sf}/labels.parquet'").fetchall())
    for i, r in got.items():
        assert r["held_out"] == (zlib.crc32(str(i).encode()) % 4 == 2) and 0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3)
    out = [(got[i]["score"], y) for i, y in labels.items() if got[i]["held_out"]]
    good = sum((s >= 0.3) == bool(y) for s, y in out) / len(out)
    assert good > 0.9
    assert sum(s >= 0.3 for s, y in out if y) > 0.6 * sum(y for _, y in out)


def without_passages(text, held):
    """Text without benchmark passages, or None where they are most of it."""
    w = list(re.finditer(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", fold(text)))
    hit = [False] * len(w)
    words = [m[0] for m in w]
    for n in {len(x) for x in held}:
        for k in range(len(w) - n + 1):
            if tuple(words[k : k + n]) in held:
                hit[k : k + n] = [True] * n
    if sum(hit) > decontaminate.MAX_COVERAGE * len(w):
        return None
    for k in reversed(range(len(w))):
        if hit[k] and (k + 1 == len(w) or not hit[k + 1]):
            first = k
            while first and hit[first - 1]:
                first -= 1
            if k + 1 - first > decontaminate.MAX_SPAN:
                text = text[: w[first].start()] + text[w[k].end() :]
    return text


def test_pipeline(spark, docs):
    """Every stage against brute force on what the one before kept; language models decide the first alone."""
    import corpus_pipeline

    seen = [spark.read.parquet(f"{SF}/documents.parquet")]
    for name, stage in corpus_pipeline.STAGES:
        path = scratch_path(spark, "stage")
        stage(spark, seen[-1], SF).write.parquet(path)
        seen.append(spark.read.parquet(path))
    texts = [{r["doc_id"]: r["text"] for r in x.select("doc_id", "text").collect()} for x in seen[:-1]]
    assert [x.columns for x in seen[1:-1]] == [seen[0].columns] * 4
    assert all(r["n_chars"] == len(r["text"]) for r in seen[4].collect())

    assert texts[1] == {i: docs[i] for i, r in rows(spark, "op5_quality_rules").items() if r["kept"]}
    first = {i for i, (_, c) in classes(texts[1], 5, 80).items() if i == c}
    assert texts[2] == {i: texts[1][i] for i in first}

    word, held = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"), set()
    for (text,) in duckdb.connect().sql(f"SELECT text FROM '{SF}/benchmark.parquet'").fetchall():
        w = word.findall(fold(text or ""))
        n = min(10, len(w))
        held |= {tuple(w[k : k + n]) for k in range(len(w) - n + 1) if n}
    cut = {i: t for i, x in texts[2].items() if (t := without_passages(x, held)) is not None}
    assert texts[3] == cut and cut != texts[2]

    # what the field adds is learnt; the patterns are not, and both are replaced
    added = {r["doc_id"]: [(x["kind"], x["start"], x["end"]) for x in r["personal"] if not x["base"]] for r in pii.find_personal(seen[3]).collect()}
    for i, text in texts[3].items():
        out, end = "", 0
        for a, b, kind in sorted((a, b, k) for k, a, b in personal(text) + added[i]):
            if a >= end:
                out += text[end:a] + f"<{kind.upper()}>"
            end = max(end, b)
        assert texts[4][i] == out + text[end:], i
    assert set(texts[4]) == set(texts[3]) and texts[4] != texts[3]

    ids = {r["doc_id"]: r for r in seen[5].collect()}
    assert set(ids) == set(texts[4]) and all(r["n_tokens"] == len(r["ids"]) for r in ids.values())
    sentencepiece = pytest.importorskip("sentencepiece")
    from strandframe.llm import sentencepiece_scan as scan

    library = sentencepiece.SentencePieceProcessor(model_file=scan.default_model())
    assert all(ids[i]["ids"] == library.encode(t) for i, t in texts[4].items())

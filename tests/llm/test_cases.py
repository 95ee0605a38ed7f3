"""Nulls, empty and long texts, ties, repeated rows, empty tables, clashing columns; and the methods by themselves."""

import collections
import math
import os
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from strandframe.llm import automaton, chat, decontaminate, ngram_join, pii, quality, secrets, sharding, toxicity, warc, word_model
from strandframe.llm import sentencepiece_scan as scan
from strandframe.llm.components import components
from strandframe.llm.text import slices
from strandframe.session import scratch_path

LONG = "lorem ipsum dolor sit amet " * 8000
SCHEMA = "doc_id long, text string, lang string, N_WORDS int, secrets string"


@pytest.fixture(scope="module")
def odd(spark):
    same = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen nineteen twenty more"
    data = [(1, None, "en", 1, "x"), (2, "", None, 2, "x"), (3, " \n\t ", "en", 3, "x"), (4, same, "en", 4, "x"), (4, same, "en", 4, "x"), (None, same, "de", 5, None), (5, LONG, "en", 6, "x"),
            (6, "Übung é 漢字 🙂 token = \"abcdef123456\" a.b@c.example; +1 (555) 555-1234; 10.0.0.1; 4111 1111 1111 1111", "en", 7, "x")]
    return spark.createDataFrame(data, SCHEMA)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def test_decontamination(spark, odd, none):
    bench = spark.createDataFrame([(1, "seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen"), (1, "Two, three!"), (2, None), (3, ""), (None, "ÜBUNG"), (None, "Übung")], "item_id long, text string")
    for words in (decontaminate.BLOCK_WORDS, 3):
        got = sorted((r["doc_id"] or 0, [(x["word"], x["word_end"]) for x in r["hit_spans"]], r["hit_items"]) for r in decontaminate.find_overlap(odd, bench, block_words=words).collect())
        assert got == [(0, [(1, 3), (6, 16)], ["1"]), (1, [], []), (2, [], []), (3, [], []), (4, [(1, 3), (6, 16)], ["1"]), (4, [(1, 3), (6, 16)], ["1"]), (5, [], []), (6, [(0, 1)], ["null"])]
    assert decontaminate.find_overlap(none, bench).count() == 0
    assert decontaminate.find_overlap(odd, bench.limit(0)).filter("size(hit_spans) > 0").count() == 0
    cut = {r["doc_id"]: r["text"] for r in decontaminate.remove_overlap(odd, bench, max_coverage=0.9).collect()}
    assert cut[4].startswith("one  four five six  seventeen") and cut[6].startswith(" é 漢字") and cut[1] is None
    assert 4 not in {r["doc_id"] for r in decontaminate.remove_overlap(odd, bench, max_coverage=0.5).collect()}


def test_suffix_automaton():
    rng = random.Random(2)
    for _ in range(50):
        items = [[rng.randint(0, 3) for _ in range(rng.randint(1, 9))] for _ in range(4)]
        made = decontaminate.SuffixAutomaton()
        for x in items:
            made.add(x)
        text = [rng.randint(0, 3) for _ in range(40)]
        held = {tuple(x[a:b]) for x in items for a in range(len(x)) for b in range(a + 1, len(x) + 1)}
        for k, (_, length) in enumerate(made.stream(text)):
            assert length == max([n for n in range(1, k + 2) if tuple(text[k + 1 - n : k + 1]) in held], default=0)


def test_sharding(odd, none):
    got = sharding.shard(odd, 3).collect()
    assert len(got) == odd.count()
    for s in range(3):
        own = sorted(r["slot"] for r in got if r["shard"] == s)
        assert own == list(range(len(own)))
    assert sharding.shard(none, 3).count() == 0


def test_hot_group_is_split(spark):
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, F.lit("the same text")).otherwise(F.concat(F.lit("text "), F.md5(F.col("id").cast("string")))).alias("text"))
    sizes = sharding.shard(docs, 6).groupBy("shard").agg(F.sum("size").alias("b"), F.count("*").alias("n"), F.sum("tokens").alias("t")).collect()
    for c in "bnt":
        values = [r[c] for r in sizes]
        assert len(values) == 6 and max(values) < 1.05 * min(values)


def test_secrets(odd, none):
    got = {r["doc_id"]: r["secrets"] for r in secrets.find_secrets(odd).collect()}
    assert [(x["kind"], x["start"]) for x in got[6]] == [("assign", 13)] and got[1] == [] and got[5] == []
    assert secrets.find_secrets(none).count() == 0


def test_automaton_agrees_with_patterns():
    rng = random.Random(3)
    made = secrets.scanner(secrets.BASE_RULES | secrets.MORE_RULES)
    parts = ["token", "secret=", 'Password: "', "api_key", "apikey", "=", ":", " ", "'", "abc", "deadbeef" * 3, "AKIA", "ABCDEFGH12345678", "é", ",", "\n", "xoxb-12345678901234567", "eyJab.cd.ef", "-----BEGIN ", "PRIVATE KEY-----", "."]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 60))) for _ in range(400)]
    for first, end, part in slices(pa.array(texts)):
        got = [[] for _ in range(first, end)]
        for d, r, a, b in made.matches(part):
            got[d].append((made.names[r], a - int(part.offsets[d]), b - int(part.offsets[d])))
        for text, own in zip(texts[first:end], got):
            want = [(k, m.start(), m.end()) for k, p in (secrets.BASE_RULES | secrets.MORE_RULES).items() for m in re.finditer(p.encode(), text.encode())]
            assert sorted(want) == sorted(own)


def test_smallest_automaton():
    dfa = automaton.Dfa.build([automaton.parse("(a|b)*abb")], False)
    assert len(dfa.move) == 5  # four states and the dead one


def test_quality(odd, none):
    got = {r["doc_id"]: r for r in quality.quality_rules(odd).collect()}
    assert got[1]["n_words"] == 0 and got[1]["base_failed"] and not got[2]["kept"] and got[5]["base_failed"]
    assert got[4]["kept"] and got[4]["N_WORDS".lower()] == 21
    assert quality.quality_rules(none).count() == 0


def test_word_model(spark):
    """Trigram probabilities of each half against a dictionary version."""
    rng = random.Random(5)
    texts = [" ".join(rng.choice("a b c d e A é".split()) for _ in range(rng.randint(0, 40))) for _ in range(60)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    halves = {r["doc_id"]: r["h"] for r in docs.select("doc_id", word_model.half(word_model.text_key("text")).alias("h")).collect()}
    words = set(" ".join(texts).split())

    def fit(h):
        three = collections.Counter(g for i, t in enumerate(texts) if halves[i] == h for w in [["", "", *t.split()]] for g in zip(w, w[1:], w[2:]))
        two = collections.Counter(g[1:] for g in three)
        one = collections.Counter(g[1:] for g in two)

        def level(counts, lower):
            of = [sum(n == k for n in counts.values()) for k in range(1, 5)]
            y = of[0] / max(1, of[0] + 2 * of[1])
            cut = [0, *(min(k, max(0.0, k - (k + 1) * y * of[k] / of[k - 1])) if of[k - 1] else 0.5 for k in (1, 2, 3))]
            total, gamma = collections.Counter(), collections.Counter()
            for g, n in counts.items():
                total[g[:-1]] += n
                gamma[g[:-1]] += cut[min(n, 3)]

            def p(g):
                if not total[g[:-1]]:
                    return lower(g[1:])
                return (counts[g] - cut[min(counts[g], 3)]) / total[g[:-1]] + min(1, max(1e-9, gamma[g[:-1]] / total[g[:-1]])) * lower(g[1:])

            return p

        return level(three, level(two, level(one, lambda g: 1 / (len(words) + 1))))

    p = [fit(0), fit(1)]
    got = {r["doc_id"]: r["log_ppl"] for r in docs.join(word_model.score_texts(docs), word_model.text_key("text") == F.col("key")).collect()}
    for i, t in enumerate(texts):
        w = ["", "", *t.split()]
        x = [-math.log(p[1 - halves[i]](g)) for g in zip(w, w[1:], w[2:])]
        assert (i in got) == bool(x) and (not x or abs(got[i] - sum(x) / len(x)) < 1e-9)


def test_word_model_blocks(spark, monkeypatch):
    """Words travel in blocks: scores do not depend on where these end, an n-gram takes under nine bytes, and nothing stays."""
    rng = random.Random(8)
    vocabulary = [f"w{k}" for k in range(2000)]
    texts = [" ".join(rng.choices(vocabulary, [1 / (k + 1) for k in range(2000)], k=rng.randint(0, 300))) for _ in range(80)]
    rows = [(i, t) for i, t in enumerate([*texts, *texts[:30], None, "", "the the the"])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    whole = {r["key"]: (r["log_ppl"], r["log_var"]) for r in word_model.score_texts(docs.coalesce(1)).collect()}
    monkeypatch.setattr(word_model, "BLOCK_WORDS", 700)
    got = word_model.score_texts(docs.repartition(9)).collect()
    assert len(got) == len(whole) == len({t for t in texts if t}) + 1
    assert all(abs(r["log_ppl"] - whole[r["key"]][0]) < 1e-9 and abs(r["log_var"] - whole[r["key"]][1]) < 1e-9 for r in got)

    keyed = pa.RecordBatch.from_arrays([pa.array([t for _, t in rows]), pa.array([i << 7 for i, _ in rows])], names=["text", "key"])
    (block,) = word_model._blocks(1 << 21, iter([keyed]))
    asks = pa.Table.from_batches(word_model._ask_triples(5, iter([block]))).to_pylist()
    want = {g for _, t in rows if t for w in [["", "", *t.split()]] for g in zip(w, w[1:], w[2:])}
    assert len(asks) == 5 and sum(r["n"] for r in asks) == len(want)
    assert sum(len(r["grams"]) + sum(map(len, r["counts"])) for r in asks) < 9 * len(want)

    scratch = word_model._Scratch(spark)
    with scratch:
        kept = scratch.written(spark.range(10).repartition(3, "id"), "kept")
        assert kept.count() == 10
    assert not any(os.path.exists(p.removeprefix("file:")) for p in scratch.paths)


def test_shuffled_words(spark):
    """Real words without order are rejected."""
    rng = random.Random(6)
    follow = {k: [rng.randrange(300) for _ in range(3)] for k in range(300)}

    def prose(n):
        out = [rng.randrange(300)]
        while len(out) < n:
            out.append(rng.choice(follow[out[-1]]))
        return [f"w{k}" for k in out]

    texts = {i: prose(rng.randint(40, 120)) for i in range(400)}
    for i in range(20):
        texts[400 + i] = rng.sample(texts[i], len(texts[i]))
    rows = [(i, " ".join(w), "en") for i, w in texts.items()]
    got = {r["doc_id"]: r["kept"] for r in quality.quality_rules(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()}
    assert sum(got[i] for i in range(400)) > 390 and sum(got[i] for i in range(400, 420)) <= 2


def test_kneser_ney_sums_to_one():
    rng = np.random.default_rng(1)
    codes = np.unique(rng.integers(0, 12, (3000, 4)) @ np.array([64000, 1600, 40, 1]), return_counts=True)
    model = quality.KneserNey.fit(*codes)
    for context in (0, 1 * 1600 + 2 * 40 + 3, 39 * 1600 + 39 * 40 + 39):
        total = np.exp(model.score(context * 40 + np.arange(40))).sum()
        assert abs(total - 1) < 1e-3


def test_chats(spark):
    rows = [(1, 0, '{"messages":[{"role":"human","content":"a<b\\\\l"},{"role":"assistant","content":"</turn>\\n"}]}'), (2, 0, '{"prompt":"p","completion":"c"}'),
            (3, 0, '{"instruction":"i","output":"o","input":"x"}'), (4, 0, '{"conversations":[{"from":"gpt","value":"v"}]}'), (5, 0, '{"other":1}'), (6, 0, None), (7, None, '{"role":"assistant"}'), (7, 1, "{}"),
            (8, 0, '{"input":{"messages":[{"role":"user","content":"deep"}]}}'), (9, 0, '{"messages":[]}')]
    records = spark.createDataFrame(rows, "conv_id long, turn long, record string")
    out = chat.format_chats(chat.canonical_turns(records)).select("conv_id", chat.read_turns(F.col("formatted")).alias("t"), chat.masked_text(F.col("formatted"), F.col("loss_mask")).alias("loss"))
    got = {r["conv_id"]: ([tuple(x) for x in r["t"]], r["loss"]) for r in out.collect()}
    assert got[1] == ([("user", "a<b\\l"), ("assistant", "</turn>\n")], "</turn>\n")
    assert got[2] == ([("user", "p"), ("assistant", "c")], "c")
    assert got[3] == ([("user", "i"), ("user", "x"), ("assistant", "o")], "o")
    assert got[4] == ([("assistant", "v")], "v") and got[8] == ([("user", "deep")], "") and got[7] == ([("assistant", ""), ("", "")], "")
    assert {r["conv_id"] for r in chat.unmapped(records).collect()} == {5, 6, 9}


def test_join(spark, odd, none):
    got = sorted((r["doc_id"] or 0, r["n_shingles"], r["component_id"] or 0) for r in ngram_join.ngram_classes(odd).collect())
    assert [x for x in got if x[0] in (0, 1, 2, 3, 4)] == [(0, 19, 4), (1, 0, 1), (2, 0, 2), (3, 0, 3), (4, 19, 4), (4, 19, 4)]
    assert ngram_join.ngram_classes(none).count() == 0
    kept = sorted(r["doc_id"] for r in ngram_join.keep_first(odd).collect())
    assert kept == [1, 2, 3, 4, 5, 6]


def test_join_against_all_couples(spark):
    from test_queries import classes

    rng = random.Random(4)
    texts = {}
    for family in range(12):
        base = [f"w{rng.randint(0, 60)}" for _ in range(rng.randint(3, 120))]
        for _ in range(14):
            copy = list(base)
            for _ in range(rng.randint(0, 3)):
                copy[rng.randrange(len(copy))] = f"w{rng.randint(0, 60)}"
            texts[len(texts)] = " ".join(copy[: len(copy) - rng.randint(0, 4)])
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in ngram_join.ngram_classes(docs).collect()}
    assert got == classes(texts)


def brute_classes(texts, words, num, den):
    """Class of each text by comparing all couples."""
    sets = {}
    for i, t in texts.items():
        w = t.split()
        sets[i] = {tuple(w[k : k + words]) for k in range(len(w) - words + 1)} or ({tuple(w)} if w else set())
    label = {i: i for i in sets}
    for i in sets:
        for j in sets:
            if i < j and label[i] != label[j] and den * len(sets[i] & sets[j]) >= num * len(sets[i] | sets[j]) > 0:
                a, b = sorted((label[i], label[j]))
                label = {k: a if x == b else x for k, x in label.items()}
    return label


def families(rng, count, copies, longest=120):
    texts = {}
    for _ in range(count):
        base = [f"w{rng.randint(0, 400)}" for _ in range(rng.randint(3, longest))]
        for _ in range(copies):
            copy = list(base)
            for _ in range(rng.randint(0, 4)):
                copy[rng.randrange(len(copy))] = f"w{rng.randint(0, 400)}"
            texts[len(texts)] = " ".join(copy[: len(copy) - rng.randint(0, 4)])
    return texts


def test_near_duplicates_stage(spark):
    """Copies between the thresholds of the contract (3 words, 0.9) and of the stage (5 words, 0.8) go."""
    import corpus_pipeline

    base = [f"a{k}" for k in range(100)]
    near, far = list(base), list(base)
    near[30], near[70] = "x", "y"
    for k in range(5, 100, 10):
        far[k] = "z"
    texts = {1: " ".join(base), 2: " ".join(near), 3: " ".join(far), 4: "one two three four", 5: "one two three five"}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    assert sorted(r["doc_id"] for r in corpus_pipeline.near_duplicates_stage(spark, docs, "").collect()) == [1, 3, 4, 5]
    assert sorted(r["doc_id"] for r in ngram_join.keep_first(docs).collect()) == [1, 2, 3, 4, 5]
    texts = families(random.Random(8), 12, 12)
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    want = sorted(set(brute_classes(texts, 5, 80, 100).values()))
    assert sorted(r["doc_id"] for r in corpus_pipeline.near_duplicates_stage(spark, docs, "").collect()) == want


def test_long_near_copies(spark):
    """Prefixes of thousands of shared shingles."""
    base = [f"a{k}" for k in range(12_000)]
    texts = {k: " ".join([*base[: 4000 * k], "x", *base[4000 * k + 1 :]]) for k in range(3)}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    for rule in (ngram_join.CONTRACT, ngram_join.Rule(5, 80, 100)):
        assert [r["doc_id"] for r in ngram_join.keep_first(docs, rule=rule).collect()] == [0]


def test_large_blocks_are_cut(spark, monkeypatch):
    """No part of a block exceeds two slices, whether its sets link or not, and the classes stay right."""
    from test_queries import classes

    rng = random.Random(9)
    template = [f"t{k}" for k in range(60)]
    texts = {}
    for k in range(60):
        copy = list(template)
        copy[rng.randrange(60)] = f"x{k}"
        texts[len(texts)] = " ".join(copy)
    for k in range(60):  # share their rarest shingle with many and reach the threshold with few
        own = [f"y{k // 2}-{j}" for j in range(57)]
        own[k % 2] = f"z{k}"
        texts[len(texts)] = " ".join(["p", "q", "r", *own])
    texts |= {len(texts) + i: t for i, t in enumerate(families(rng, 4, 12).values())}
    rows = list(texts.items())
    rng.shuffle(rows)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    monkeypatch.setattr(ngram_join, "PART_BYTES", 6000)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in ngram_join.ngram_classes(docs).collect()}
    assert got == classes(texts)
    join = ngram_join.Join(docs, "doc_id", "text", ngram_join.CONTRACT)
    assert join.heavy is not None
    groups = join.links()[1]
    for known in (None, groups):
        most = join.parts(known).groupBy("token", F.shiftright("part", 2)).agg(F.sum(ngram_join.weight(F.col("n"))).alias("w")).agg(F.max("w")).first()[0]
        assert most is None or most <= 2 * (6000 + ngram_join.weight(120))


def test_components(spark):
    links = spark.createDataFrame([(k, k + 1) for k in range(40)] + [(100, 101), (101, 102), (7, 7)], "a long, b long")
    got = {r["node"]: r["label"] for r in components(links).collect()}
    assert all(got[k] == 0 for k in range(41)) and got[102] == 100


def test_foreign_warc(spark, tmp_path):
    """Other versions, repeated fields, records inside payloads, wrong lengths."""

    def record(kind, name, block, to=None, version="1.0", length=None):
        head = f"WARC/{version}\r\nWARC-Type: {kind}\r\nWARC-Record-ID: <{name}>\r\n" + (f"WARC-Concurrent-To: <{to}>\r\n" if to else "")
        return f"{head}Content-Length: {len(block.encode()) if length is None else length}\r\n\r\n{block}\r\n\r\n"

    inner = record("response", "inner", "HTTP/1.1 200 OK\r\n\r\nno")
    body = "HTTP/1.1 200 OK\r\n\r\nsees WARC/ and WARC/1.1\r\n\r\n" + inner
    (tmp_path / "a.warc").write_text(record("response", "r1", body) + record("metadata", "m1", "page-id: 7\r\noutlink: a\r\noutlink: b: c\r\nplain\r\n", "r1") + record("request", "q1", "GET / HTTP/1.1", "r1", "0.18"), newline="")
    (tmp_path / "b.warc").write_text(record("response", "r2", "HTTP/1.1 200 OK\r\n\r\nx", length=10**6) + record("response", "r3", "HTTP/1.1 200 OK\r\n\r\nyé", version="1.1") + "trailing WARC/9", newline="")
    (tmp_path / "c.warc").write_text("")
    got = {r["record_id"]: r for r in warc.resolve(warc.assemble(warc.read_records(spark, str(tmp_path)))).collect()}
    assert set(got) == {"<r1>", "<r3>"}
    one = got["<r1>"]
    assert bytes(one["payload"]).decode() == body.split("\r\n\r\n", 1)[1] and one["page_id"] == 7
    assert [tuple(x) for x in one["field_lines"]] == [("page-id", "7"), ("outlink", "a"), ("outlink", "b: c"), ("plain", "")]
    assert one["fields"] == {"page-id": "7", "outlink": "a", "plain": ""} and one["request"]["block"].startswith("GET")
    assert bytes(got["<r3>"]["payload"]).decode() == "yé" and got["<r3>"]["request"] is None and got["<r3>"]["fields"] is None
    none = spark.createDataFrame([], "page_id long, url string, html string, digest string")
    path = scratch_path(spark, "warc-none")
    warc.write_captures(none, path)
    assert warc.resolve(warc.assemble(warc.read_records(spark, path))).count() == 0


def test_warc(spark):
    body = "x" * 200 + "\r\n\r\nWARC/1.1\r\nContent-Length: 3\r\n\r\nabc"
    pages = spark.createDataFrame([(3, "http://a/", body), (2, "http://b/", body), (2, "http://b/", body), (None, None, body), (5, "u", None), (6, "u", "é"), (7, "v", "é")], "page_id long, url string, html string")
    path = scratch_path(spark, "warc-test")
    warc.write_captures(pages, path)
    records = warc.read_records(spark, path)
    assert records.groupBy("type").count().filter("type = 'request'").first()["count"] == 7
    got = sorted((r["page_id"] or 0, r["type"], r["refers_to_page"], r["payload_bytes"]) for r in warc.resolve(warc.assemble(records)).collect())
    n = len(body)
    assert got == [(0, "revisit", 2, n), (2, "response", None, n), (2, "response", None, n), (3, "revisit", 2, n), (5, "response", None, 0), (6, "response", None, 2), (7, "response", None, 2)]


def test_personal(odd, none):
    got = {r["doc_id"]: [x["kind"] for x in r["personal"] if x["base"]] for r in pii.find_personal(odd).collect()}
    assert got[6] == ["email", "ip", "card", "phone"] and got[1] == []
    assert pii.find_personal(none).count() == 0
    text = {r["doc_id"]: r["text"] for r in pii.redact(odd).collect()}
    assert text[6].endswith("<EMAIL>; <PHONE>; <IP>; <CARD>") and text[1] is None and text[4].startswith("one two")


def test_semi_markov_sums():
    """The forward sums equal a sum over all segmentations."""
    scores = {(0, 2): np.array([0.5, 1.0]), (1, 3): np.array([0.2, -1.0]), (2, 4): np.array([2.0, 0.1]), (0, 1): np.array([0.3, 0.3])}

    def every(at):
        if at == 4:
            return [0.0]
        out = [x for x in every(at + 1)]
        for (i, j), s in scores.items():
            if i == at:
                out += [v + x for v in s for x in every(j)]
        return out

    assert abs(pii.forward(4, scores)[-1] - np.logaddexp.reduce(every(0))) < 1e-9
    assert abs(sum(x[3] for x in pii.best(4, scores)) - max(every(0))) < 1e-9


def test_toxicity(spark, odd, none):
    labels = spark.createDataFrame([(4, 1), (6, 0), (None, 1), (5, None)], "doc_id long, toxic int")
    model, share = toxicity.fit_model(odd, labels)
    assert all(0 <= r["score"] <= 1 for r in toxicity.score_toxicity(odd, model, share).collect())
    model, share = toxicity.fit_model(odd, labels.limit(0))
    assert model is None and toxicity.score_toxicity(odd, model, share).filter("score = 0").count() == odd.count()
    assert toxicity.score_toxicity(none, None, 0.0).count() == 0


def test_sentencepiece(spark, odd, none):
    model = scan.Pieces.read(scan.default_model())
    got = {r["doc_id"]: r["decoded"] for r in scan.decode(scan.encode(odd, model, chunk=50), model).collect()}
    assert got == {r["doc_id"]: r["text"] for r in odd.collect()}
    assert scan.encode(none, model).count() == 0


def test_both_kinds_of_model_by_chunks():
    """Chunks cut inside words give the library's ids for merges, and a best path for a unigram model."""
    sentencepiece = pytest.importorskip("sentencepiece")
    path = scan.default_model()
    library = sentencepiece.SentencePieceProcessor(model_file=path)
    rng = random.Random(1)
    words = ["a", "aa", "aaa", "the", "ing", "é", "漢", "🙂", "0", "http", "//", ".", "hello", " world", "  "]
    texts = ["".join(rng.choice(words) for _ in range(rng.randint(30, 90))) for _ in range(40)] + ["".join(rng.choice("aabtheing") for _ in range(300)), "a" * 200]

    def best_score(made, body):
        best = [0.0]
        for p in range(1, len(body) + 1):
            steps = [(q, made.model.numbers.get(body[q:p])) for q in range(max(0, p - made.model.width), p)]
            best.append(max(best[q] + (made.floor if i is None else made.model.scores[i]) for q, i in steps if i is not None or q == p - 1))
        return best[-1]

    for kind in (scan.MERGES, scan.UNIGRAM):
        made = scan.Scan(scan.Pieces.read(path, kind))
        for text in texts:
            if kind == scan.UNIGRAM:  # characters without a piece become bytes, whose score the ids do not tell
                text = text.replace("漢", "x")
            body = made.normal(text)
            cut, width, parts = rng.choice([33, 40, 57]), made.model.width, []
            for first in range(0, len(body), cut):
                lead = min(first, width)
                parts.append((body[first - lead : first + cut + width], lead, lead + min(cut, len(body) - first)))
            states = scan.boundary_states([made.matrix(p, a, b, k == 0) for k, (p, a, b) in enumerate(parts)])
            ids = [i for (p, a, b), s, e in zip(parts, states, states[1:]) for i in made.chunk_ids(p, a, b, s, e)]
            if kind == scan.MERGES:
                assert ids == library.encode(text) == made.encode(text)
            else:
                assert sum(made.model.scores[i] for i in ids) == sum(made.model.scores[i] for i in made.encode(text)) == best_score(made, body)
                assert made.decode(ids) == text


def test_training_rows_are_whole(spark):
    """A long document gives all its windows, so a short passage anywhere in it is trained on."""
    words = 3001 * toxicity.WINDOW
    ids = [r["doc_id"] for r in spark.range(20).withColumnRenamed("id", "doc_id").filter(~toxicity.held_out()).collect()]
    docs = spark.createDataFrame([(ids[0], "word " * words), (ids[1], "other words")], "doc_id long, text string")
    labels = spark.createDataFrame([(ids[0], 1), (ids[1], 0)], "doc_id long, toxic int")
    rows, _ = toxicity.training_rows(docs, labels, 10)
    assert sorted(len(np.unique(w)) for _, w, _ in rows) == [1, 3001]

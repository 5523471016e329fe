"""Row-wise operators against brute force on awkward rows."""

import collections
import hashlib
import random
import re
import tracemalloc
import zlib

import numpy as np
import pyarrow as pa
import pytest

from wearcast.llm import language_id, packing, pii, quality_classifier, quality_rules, token_files, tokens
from wearcast.llm import common as C

from .conftest import DOCS, awkward, prose, rows_of

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_statistics(text):
    t = text or ""
    w = WORD.findall(t)
    seen, dup = set(), 0
    for line in t.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    n = collections.Counter(tuple(w[i:i + 5]) for i in range(len(w) - 4))
    hit = {j for i in range(len(w) - 4) if n[tuple(w[i:i + 5])] > 1 for j in range(i, i + 5)}
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), dup, len(hit)


def test_rule_statistics_match_brute_force(docs):
    texts = awkward()
    got = sorted(rows_of(quality_rules.rule_statistics(docs), "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"), key=str)
    assert got == sorted(((r[0], *plain_statistics(r[1])) for r in texts), key=str)


def test_repeated_words_on_random_rows():
    rnd = np.random.default_rng(0)
    for _ in range(200):
        lens = rnd.integers(0, 30, 4)
        row = np.repeat(np.arange(4), lens)
        code = rnd.integers(0, 3, lens.sum())
        hit = quality_rules.repeated_words(row, code, 3)
        for i in range(4):
            w = code[row == i].tolist()
            n = collections.Counter(tuple(w[k:k + 5]) for k in range(len(w) - 4))
            want = {j for k in range(len(w) - 4) if n[tuple(w[k:k + 5])] > 1 for j in range(k, k + 5)}
            assert set(np.flatnonzero(hit[row == i]).tolist()) == want


def test_quality_rules_keep_and_reject(spark, docs, labels, empty):
    out = {(r["doc_id"], r["n_words"]): r for r in quality_rules.judge(docs, labels).collect()}
    assert out[(0, 0)]["base_failed"] and not out[(0, 0)]["kept"]
    assert not out[(25, 120)]["base_failed"]
    assert all(not r["kept"] for r in out.values() if r["base_failed"])
    assert quality_rules.judge(empty, labels).count() == 0
    good = [(i, prose(i, 80), "en", "s", 1) for i in range(60)]
    bad = [(100 + i, " ".join(w + "###" for w in prose(500 + i, 80).split()), "en", "s", 1) for i in range(6)]
    d = spark.createDataFrame(good + bad, "doc_id long, text string, lang string, source string, n_chars long")
    m = spark.createDataFrame([(i, 1) for i in range(60)] + [(100 + i, 0) for i in range(6)], "doc_id long, quality int")
    kept = {r["doc_id"] for r in quality_rules.judge(d, m).where("kept").collect()}
    assert kept == set(range(60))
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert quality_rules.judge(d, none).where("kept").count() == 66


def test_ids_equal_plain_encode():
    enc = tokens.Encoder()
    rnd = random.Random(3)
    parts = ["a", "b", " ", "  ", "\n", "\t", " ", "'s", "'ll", "é", "ß", "1", "23", "!", "$$$", "\u2003", "\u3000", "<|endoftext|>", "日本", "\x1c", "the", "😀", "\r\n", "\xa0", "¿"]
    texts = ["".join(rnd.choice(parts) for _ in range(rnd.randint(0, 14))) for _ in range(4000)] + [None, "", " ", "a ", "\n ", "a\n "]
    for arr in (pa.array(texts), pa.array(texts, pa.large_string()), pa.array(["x", *texts])[1:]):
        ids, off = enc.encode(arr)
        for i, t in enumerate(texts):
            assert ids[off[i]:off[i + 1]].tolist() == enc.tok.encode(t or "", add_special_tokens=False).ids, repr(t)


def test_memo_is_read_in_place_and_forgotten():
    enc = tokens.Encoder()
    text = pa.array(["word1 word2  word3 naïve"])
    first = enc.encode(text)[0].tolist()
    for k in range(0, 60_000, 20_000):
        enc.encode(pa.array([" ".join(f"x{i}y" for i in range(k, k + 20_000))]))
    tracemalloc.start()
    again = enc.encode(text)[0].tolist()
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert first == again == enc.whole(text[0].as_py()).tolist()
    assert peak < 200_000  # what is remembered is not copied for every slice
    enc.forget()
    assert not len(enc.keys) and not len(enc.flat) and not enc.pieces
    assert enc.encode(text)[0].tolist() == first


@pytest.mark.parametrize("seed", range(6))
def test_solution_holds_every_piece_and_is_near_the_bound(seed):
    rng = np.random.default_rng(seed)
    lengths = np.clip(rng.lognormal(5.5, 1.2, 4000).astype(int), 1, 1024) if seed % 2 else rng.integers(1, 1025, 4000)
    hist = {int(n): int(c) for n, c in zip(*np.unique(lengths, return_counts=True))}
    patterns = packing.solve(hist)
    got = collections.Counter()
    for copies, ls in patterns:
        assert copies > 0 and sum(ls) <= 1024
        for n in ls:
            got[n] += copies
    assert got == hist
    bound = -(-int(lengths.sum()) // 1024)
    plain = sum(c for c, _ in packing._best_fit([], sorted(hist.items(), reverse=True), 1024))
    assert sum(c for c, _ in patterns) <= max(plain * 1.005 + 1, bound * 1.01)
    assert packing.solve({}) == []


def test_packing_of_awkward_rows(docs, empty):
    enc = tokens.Encoder()
    out = packing.pack_documents(docs).collect()
    want = collections.Counter()
    for r in awkward():
        ids = np.array([*enc.whole(r[1] or ""), 2], "<u4")
        k = -(-len(ids) // 1024)
        head = len(ids) - (k - 1) * 1024
        for j in range(k):
            a = 0 if j == 0 else head + (j - 1) * 1024
            b = head if j == 0 else a + 1024
            want[(r[0], j, a, b - a, ids[a:b].tobytes())] += 1
    assert collections.Counter((r["doc_id"], r["piece"], r["start"], r["length"], bytes(r["ids"])) for r in out) == want
    seqs = collections.defaultdict(list)
    for r in out:
        seqs[r["sequence_id"]].append((r["offset"], r["length"]))
    for places in seqs.values():
        at = 0
        for off, n in sorted(places):
            assert off == at
            at += n
        assert at <= 1024
    assert packing.pack_documents(empty).count() == 0


def test_perfect_hash_and_fingerprints():
    rng = np.random.default_rng(1)
    for n in (0, 1, 2, 7, 1000, 5000):
        keys = np.unique(rng.integers(-(1 << 62), 1 << 62, n))
        mph = token_files.PerfectHash.build(keys)
        assert sorted(mph.slot(keys).tolist()) == list(range(len(keys)))
        raw = token_files.index_bytes(keys, np.zeros(len(keys)), np.arange(len(keys)), np.ones(len(keys)), np.ones(len(keys)), np.arange(len(keys)))
        index = token_files.Index(raw)
        assert (index.find(keys) >= 0).all()
        other = rng.integers(1 << 62, (1 << 63) - 1, 2000)
        assert (index.find(other) < 0).all()


def test_token_files_round_trip(spark, docs, empty):
    from pyspark.sql import functions as F

    path = C.fresh_dir(spark, "tok-test")
    m = token_files.write(docs, path)
    key = F.coalesce("doc_id", F.lit(int(token_files.NULL_KEY))).alias("key")
    got = token_files.read(docs.select(key), m).orderBy("start").collect()
    enc = tokens.Encoder()
    want = collections.Counter((r[0] if r[0] is not None else int(token_files.NULL_KEY), np.array([*enc.whole(r[1] or ""), 0], "<u4").tobytes()) for r in awkward())
    assert collections.Counter((r["key"], bytes(r["ids"])) for r in got) == want
    at = 0
    for r in got:
        assert r["start"] == at
        at += r["n_tokens"]
    assert [r["key"] for r in got] == sorted(r["key"] for r in got)
    unknown = spark.createDataFrame([(123456789,)], "key long")
    assert token_files.locate(unknown, m).count() == 0
    m = token_files.write(empty, C.fresh_dir(spark, "tok-empty"))
    assert m["documents"] == 0


def plain_base(text):
    out = [(m.start(), 0, m.end()) for m in pii.EMAIL.finditer(text)]
    out += [(m.start(), 1, m.end()) for m in pii.IP.finditer(text) if all(len(p) < 4000 and int(p) <= 255 for p in m[0].split("."))]
    for m in pii.CARD.finditer(text):
        d = re.sub("[^0-9]", "", m[0])
        total = sum(x if i % 2 == 0 else 2 * x - 9 * (2 * x > 9) for i, x in enumerate(map(int, reversed(d))))
        if 14 <= len(d) <= 19 and total % 10 == 0:
            out.append((m.start(), 2, m.end()))
    out += [(m.start(), 3, m.end()) for m in pii.PHONE.finditer(text) if 10 <= len(re.sub("[^0-9]", "", m[0])) <= 15]
    return sorted(out)


PERSONAL = ["write to jane.doe@mail.example.com or x@y@z.org now", "host 10.0.0.1 and 300.1.1.1 and 1.2.3.4.5 and 001.002.003.004", "card 4111 1111 1111 1111, not 4111111111111112",
            "call +1 (202) 555-0134 today", 'token = "681c09b8e90e7e8c9575180f595f646cf2969054"', "tel (020) 7946 0018 in the office", "a@b.c@d.e, über@straße.de, me (at) site (dot) org",
            "+1+12345678901", "9" * 6000, "@" * 50, "1.1.1.1", "é +49 30 1234567 é"]


def test_base_spans_match_the_patterns():
    rnd = random.Random(5)
    parts = ["a", "b.c", "@", "x@y.z", ".", "1", "12", "4111111111111111", " ", "-", "+", "(", ")", "255", "é", "\n", "_", "%"]
    texts = PERSONAL + ["".join(rnd.choice(parts) for _ in range(rnd.randint(0, 25))) for _ in range(3000)]
    for t in texts:
        assert pii.base_spans(t) == plain_base(t), t


def test_every_spelled_address_is_proposed(spark):
    said = ["Jane [AT] Example [DOT] com", "jane at example.com", "jane (At) example dot org", "jane\tat\texample\nDOT\norg", "jane AT example (DOT) com"]
    for t in said:
        assert pii.candidates("write " + t, []) == [(6, 0, 6 + len(t))], t
    d = spark.createDataFrame(list(enumerate(said)), "doc_id long, text string")
    assert {r["doc_id"]: [(x["start"], x["stop"]) for x in r["loose"]] for r in pii.find_spans(d).collect()} == {i: [(0, len(t))] for i, t in enumerate(said)}
    rnd = random.Random(5)
    bits = ["a", "at", "At", "b%", ".", ".c", "@", "(at)", "[AT]", " ", " ", "  ", "\n", "dot", "(dot)", "[Dot]", "é", "-", "_x", "(", "at "]
    for _ in range(20000):
        t = "".join(rnd.choice(bits) for _ in range(rnd.randint(1, 14)))
        assert pii.spelled(t) == [m.span() for m in pii.SPELLED.finditer(t)], t
    assert pii.spelled("x" * 300_000 + " at home") == pii.spelled("x" * 300_000 + ". Look (at home") == []


def test_pii_query_shape_and_redaction(spark, docs, empty):
    d = spark.createDataFrame(awkward(PERSONAL), DOCS)
    found = pii.detect(d).collect()
    assert len(found) == d.count()
    for r in found:
        base = [tuple(s)[:3] for s in r["base"]]
        spans = [tuple(s)[:3] for s in r["spans"]]
        assert set(base) <= set(spans) and spans == sorted(spans)
    out = pii.redact(d)
    assert out.schema == d.schema and out.count() == d.count()
    text = " ".join(t for (t,) in rows_of(out, "text") if t)
    assert "jane.doe" not in text and "4111 1111" not in text and "555-0134" not in text and "[EMAIL]" in text
    assert pii.detect(empty).count() == 0 and pii.redact(empty).count() == 0


def test_span_model_separates_votes():
    base, loose = np.zeros(pii.CELLS), np.zeros(pii.CELLS)
    yes, no = pii.pattern_number((1, 1, 1, 1, 1)), pii.pattern_number((-1, -1, -1, -1, -1))
    base[pii.cell_number(2, yes, 2)] = 50
    loose[pii.cell_number(2, yes, 2)], loose[pii.cell_number(2, no, 2)] = 10, 200
    m = pii.SpanModel(base, loose)
    assert m.p[pii.cell_number(2, yes, 2)] > 0.8 and m.p[pii.cell_number(2, no, 2)] < 0.2
    assert np.isfinite(pii.SpanModel(np.zeros(pii.CELLS), np.zeros(pii.CELLS)).p).all()


LANGS = {"aa": "ka ko ki ku kala kolo kuku kiki".split(), "bb": "szer grze prze strz krz szy".split()}


def spoken(spark, n=240):
    rnd = random.Random(2)
    rows = [(i, " ".join(rnd.choice(LANGS[lang]) + rnd.choice(["", "x", "na"]) for _ in range(15)), lang) for i in range(n) for lang in [["aa", "bb"][i % 2]]]
    rows += [(n, None, "aa"), (n + 1, "12 34 !!", "bb"), (n + 2, "", None), (None, "kala kolo", "aa"), (n + 3, "— …", "aa"), (n + 4, "kalakuna grzyx", None)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string")


def test_language_id_held_out_accuracy(spark, empty):
    d = spoken(spark)
    out = language_id.identify(d, language_id.fit(d))
    rows = {r["doc_id"]: r for r in out.collect()}
    truth = {r["doc_id"]: r["lang"] for r in d.where("doc_id < 240").collect()}
    held = [i for i in truth if rows[i]["held_out"]]
    assert held and all(zlib.crc32(str(i).encode()) % 3 == 1 for i in held)
    assert sum(rows[i]["lang_pred"] == truth[i] for i in held) >= 0.97 * len(held)
    for i in (240, 241, 242, 243):
        assert rows[i]["lang_pred"] == "und" and rows[i]["score"] == 0
    assert rows[None]["lang_pred"] == "aa" and rows[None]["held_out"] is False
    assert all(0 <= r["score"] <= 1 for r in rows.values())
    assert language_id.identify(empty, language_id.fit(empty)).count() == 0
    assert {r["lang_pred"] for r in language_id.identify(d, language_id.Model([])).collect()} == {"und"}


def test_language_back_off_is_word_first():
    m = language_id.Model([("aa", 0, "kala", 90), ("bb", 0, "kala", 10), ("aa", 0, "x", 10), ("bb", 0, "x", 90), ("aa", 4, "_szy", 1), ("bb", 4, "_szy", 99),
                           ("aa", 4, "_kal", 99), ("bb", 4, "_kal", 1), ("bb", 1, "q", 9), ("aa", 1, "q", 1), ("aa", 1, "z", 9), ("bb", 1, "z", 1)])
    assert m.word("kala").argmax() == 0 and m.word("szyna").argmax() == 1 and m.word("q").argmax() == 1
    assert (m.word("żó") == 0).all()


def test_quality_classifier_learns(spark, docs, empty, labels):
    rows = [(i, prose(i, 60), "en") if i % 2 else (i, " ".join(w + "%%%" for w in prose(i, 60).split()), "en") for i in range(300)]
    d = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    m = spark.createDataFrame([(i, i % 2) for i in range(300)] + [(1, None), (2, 7)], "doc_id long, quality int")
    out = quality_classifier.score(d, quality_classifier.fit(d, m)).collect()
    held = [r for r in out if r["held_out"]]
    assert held and all(zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0 for r in held)
    assert sum(r["predicted"] == r["doc_id"] % 2 for r in held) >= 0.95 * len(held)
    model = quality_classifier.fit(docs, labels)
    got = quality_classifier.score(docs, model).collect()
    assert len(got) == len(awkward()) and all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in got)
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert {r["score"] for r in quality_classifier.score(docs, quality_classifier.fit(docs, none)).collect()} == {0.5}
    assert quality_classifier.score(empty, model).count() == 0


def test_base_digest_form(spark):
    from pyspark.sql import functions as F

    d = spark.createDataFrame([(1, "x@y.org 1.2.3.4")], "doc_id long, text string")
    r = pii.detect(d).select(pii.listed("base").alias("b"), F.sha2(pii.listed("base"), 256).alias("h")).first()
    assert r["b"] == "email:0:7,ip:8:15" and r["h"] == hashlib.sha256(b"email:0:7,ip:8:15").hexdigest()

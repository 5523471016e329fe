"""Joins, files and filters against brute force on awkward rows, and the pipeline end to end."""

import base64
import collections
import hashlib
import random
import re

import numpy as np
import pytest

from wearcast.llm import common as C
from wearcast.llm import decontamination, graph, jaccard_join, url_filters, warc

from .conftest import CLASH, DOCS, awkward, prose, rows_of

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text, width):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    return frozenset(tuple(w[i:i + width]) for i in range(len(w) - width + 1)) if len(w) >= width else frozenset([tuple(w)] if w else [])


def plain_components(rows, width, percent):
    """Every pair compared; rows of one doc_id are one document."""
    sets = [(i, shingles(t, width)) for i, t in rows if i is not None]
    parent = {i: i for i, _ in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, (i, s) in enumerate(sets):
        for j, t in sets[:a]:
            both = len(s & t)
            if s and t and 100 * both >= percent * (len(s) + len(t) - both):
                x, y = find(i), find(j)
                parent[max(x, y)] = min(x, y)
    return collections.Counter((i, len(shingles(t, width)), (find(i) if shingles(t, width) else i) if i is not None else None) for i, t in rows)


def plain_rows(texts, width, percent):
    """(row, shingles, first row of its group) with every row a document."""
    return list(plain_components(list(enumerate(texts)), width, percent))


def near_copies(seed=9):
    rnd = random.Random(seed)
    rows = []
    for k in range(25):
        words = prose(1000 + k, rnd.choice([4, 12, 30, 80, 300])).split()
        for c in range(rnd.choice([1, 2, 6, 14])):
            w = list(words)
            for _ in range(rnd.randint(0, max(1, len(w) // 25))):
                w[rnd.randrange(len(w))] = rnd.choice(["alpha", "beta", "gamma", "delta"])
            rows.append((10_000 + 100 * k + c, " ".join(w[rnd.randint(0, 1):])))
    return rows


@pytest.mark.parametrize("width,percent", [(3, 90), (5, 80)])
def test_components_match_all_pairs(spark, docs, empty, width, percent):
    rows = [(r[0], r[1]) for r in awkward()] + near_copies()
    d = spark.createDataFrame([(i, t, "en", "s", 1, *CLASH) for i, t in rows], DOCS).repartition(4)
    got = collections.Counter(rows_of(jaccard_join.join(d, width, percent), "doc_id", "n_shingles", "component_id"))
    assert got == plain_components(rows, width, percent)
    if width == 3:
        assert jaccard_join.join(empty, width, percent).count() == 0


def test_routing_never_misses_a_linking_pair():
    rng = np.random.default_rng(0)
    for percent in (90, 80):
        router = jaccard_join.Router(percent)
        for n in [*range(1, 60), 100, 300, 1000]:
            x = np.unique(rng.integers(0, 1 << 64, n, dtype=np.uint64))
            for _ in range(30):
                k = len(x) - int(rng.integers(0, max(2, n // 8 + 2)))
                y = np.unique(np.concatenate([rng.permutation(x)[:max(k, 0)], rng.integers(0, 1 << 64, int(rng.integers(0, max(2, n // 8 + 2))), dtype=np.uint64)]))
                both = len(np.intersect1d(x, y))
                if len(y) and 100 * both >= percent * (len(x) + len(y) - both) and not np.array_equal(x, y):
                    assert len(np.intersect1d(router.signatures(x), router.signatures(y)))


def test_bitmap_grows_with_shared_signatures(spark):
    """a bitmap of fixed size filled up as the table grew, and rows of documents without a partner went to disk."""
    rows = [(i, prose(5000 + i, 120)) for i in range(60)] + [(1000 + i, t) for i, t in near_copies()]
    d = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    marks = jaccard_join.shared_bits(jaccard_join.signature_slices(d, 5, 80, 2), 2, 8)
    on = np.unpackbits(np.frombuffer(marks, np.uint8), bitorder="little")
    sigs = collections.defaultdict(set)
    for (i, _), s in zip(rows, jaccard_join.shingle_sets(C.pa.array([t for _, t in rows]), 5)):
        for x in jaccard_join.Router(80).signatures(s).tolist():
            sigs[x].add(i)
    shared = [x for x, ids in sigs.items() if len(ids) > 1]
    bits = len(on).bit_length() - 1
    assert all(on[x >> (64 - bits)] for x in shared) and len(on) >= 8 * len(shared) and on.mean() < 0.15
    posts = C.stored(jaccard_join.postings(d, marks, 5, 80), "posts")
    found = rows_of(posts, "doc_id", "sig")
    linked = {i for i, n, first in plain_components(rows, 5, 80) if i != first} | {first for i, n, first in plain_components(rows, 5, 80) if i != first}
    # every shared signature of a linked document is there, and few chance ones of documents like no other (a full bitmap lets all through)
    assert {(i, x) for x in shared for i in sigs[x] if i in linked} <= {(i, s % (1 << 64)) for i, s in found}
    assert sum(i < 60 for i, _ in found) < sum(i < 60 for x in sigs for i in sigs[x]) / 10
    C.drop(posts)
    with pytest.raises(Exception, match="(?i)path|exist|found"):
        posts.count()


def test_divide_skip_equals_intersection():
    rng = np.random.default_rng(1)
    sets = [np.unique(rng.integers(0, 200, rng.integers(1, 150), dtype=np.uint64)) for _ in range(80)]
    for q in sets[:25]:
        need = np.array([-(-90 * (len(s) + len(q)) // 190) for s in sets])
        need[::3] = need[::3] // 2 + 1
        both = np.array([len(np.intersect1d(q, s)) for s in sets])
        assert (jaccard_join.divide_skip(q, sets, need) == np.where(both >= need, both, -1)).all()


def test_components_of_a_long_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(200, 100)], "node long, root long")
    got = dict(rows_of(jaccard_join.components(edges), "node", "label"))
    assert got == {**{i: 0 for i in range(1, 61)}, 200: 100}
    assert jaccard_join.components(edges.limit(0)).count() == 0


def test_components_of_stars_need_no_round(spark, monkeypatch):
    names, stored = [], graph.C.stored
    monkeypatch.setattr(graph.C, "stored", lambda df, name: names.append(name) or stored(df, name))
    stars = spark.createDataFrame([(i, i % 3) for i in range(3, 40)] + [(1, 1), (4, 1)], "node long, root long")
    assert dict(rows_of(graph.components(stars), "node", "label")) == {i: i % 3 for i in range(3, 40)}
    assert names == ["edges"]
    names.clear()
    forked = spark.createDataFrame([(5, 1), (5, 2), (7, 5)], "node long, root long")
    assert dict(rows_of(graph.components(forked), "node", "label")) == {2: 1, 5: 1, 7: 1}
    assert names == ["edges", "star", "edges"]


def words4(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def plain_report(docs, items):
    out = collections.Counter()
    for i, t in docs:
        w, hit, ids = words4(t), set(), set()
        for item, text in items:
            v = words4(text)
            n = min(10, len(v))
            for s in range(len(v) - n + 1 if n else 0):
                for p in range(len(w) - n + 1):
                    if w[p:p + n] == v[s:s + n]:
                        hit |= set(range(p, p + n))
                        ids.add("" if item is None else str(item))
        out[(i, len(w), len(hit), len(ids), hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest(), bool(hit))] += 1
    return out


def test_decontamination_matches_brute_force(spark, empty):
    items = [(1, prose(70, 25)), (2, prose(71, 10)), (10, "Short Item-words"), (11, "lone"), (12, None), (13, ""), (14, "..."), (2, prose(71, 10)), (None, prose(72, 12)),
             (15, "aa bb aa bb aa bb aa bb aa bb aa bb aa bb")]
    p = prose(70, 25).split()
    texts = [(r[0], r[1]) for r in awkward()] + [
        (900, "start " + " ".join(p) + " end"), (901, " ".join(p[3:13]).upper() + "!"), (902, " ".join(p[3:12])), (903, "...SHORT item words, short item words"), (904, "lone lone x lone"),
        (905, prose(71, 10) + " " + prose(72, 12)), (906, "aa bb " * 30), (907, " ".join(p[:10]) + " " + " ".join(p[15:25])), (908, "!!" + prose(72, 12) + "??")]
    d = spark.createDataFrame([(i, t, "en", "s", 1, *CLASH) for i, t in texts], DOCS).repartition(3)
    b = spark.createDataFrame([(i, t, "x") for i, t in items], "item_id long, text string, rid string")
    got = collections.Counter(rows_of(decontamination.decontaminate(d, b), "doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"))
    assert got == plain_report(texts, items)
    assert decontamination.decontaminate(empty, b).count() == 0
    clean = decontamination.decontaminate(d, b.limit(0))
    assert clean.count() == len(texts) and clean.where("contaminated").count() == 0


def test_proximity(spark):
    d = spark.createDataFrame([(1, "zeta " + "x " * 10 + "omega"), (2, "zeta " + "x " * 40 + "omega"), (3, "omega zeta")], "doc_id long, text string")
    b = spark.createDataFrame([(5, "zeta omega")], "item_id long, text string")
    postings, _ = decontamination.search(d, b)
    items = decontamination.item_words(b)
    near = decontamination.proximity(items, postings, 20)
    got = {r[0] for r in postings.where("n_words is not null").join(near, "rid").select("doc_id").collect()}
    assert got == {1, 3}


def test_warc_round_trip(spark):
    pages = [(1, "http://a/x", "<p>same</p>"), (2, "http://b/", "<p>same</p>"), (3, None, None), (4, "http://c/\r\nEvil: 1", ""), (5, "http://d/é", "ü😀" * 5000), (None, "u", "<p>same</p>"),
             (6, "e", "\r\n\r\nx"), (2, "http://b/", "<p>same</p>")]
    df = spark.createDataFrame([(*p, "r", "d") for p in pages], "page_id long, url string, html string, record_type string, digest string").repartition(3)
    path = C.fresh_dir(spark, "warc-test")
    index = warc.write(df, path)
    got = warc.read(index, path).collect()
    last = {}
    for i, _, h in pages:
        last[h or ""] = max(last.get(h or "", -1), -1 if i is None else i)
    seen, want = set(), collections.Counter()
    for i, _, h in pages:
        raw = (h or "").encode()
        first = i == last[h or ""] and (i, h or "") not in seen
        seen.add((i, h or ""))
        want[(i, len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode(), "response" if first else "revisit", None if first else last[h or ""])] += 1
    assert collections.Counter((r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in got) == want
    assert {bytes(r["payload"]).decode() for r in got if r["payload"] is not None} == {"<p>same</p>", "", "ü😀" * 5000, "\r\n\r\nx"}
    some = warc.read(index.where("page_id = 5"), path).collect()
    assert len(some) == 1 and some[0]["url"] == "http://d/é"
    assert warc.read(warc.write(df.limit(0), C.fresh_dir(spark, "warc-empty")), path).count() == 0
    big = warc.write(df, C.fresh_dir(spark, "warc-min"), min_bytes=100)
    assert big.where("record_type = 'revisit'").count() == 0


URLS = [None, "no scheme", "http://", "HTTP://Example.ORG", "http://example.org/es/x?y#z", "https://sub.Example.org/en/12", "http://example.org/en/2", "http://org/a", "http://notorg/a", "http://x.com/fr/1",
        "http://x.com/de/1#/", "http://x.com/en/", "x://h?p/q", "x://h#f", "a://b://c/d", "http://ü.net/ä/é", "http://h.net/" + "/".join("abcdefghij"), "http://h.net/9f8e7d6c5b4a/77.html"]


def test_url_rules_and_templates(spark):
    d = spark.createDataFrame([(i, u, "h", "p") for i, u in enumerate(URLS)] + [(None, "http://x.com/fr/1", "h", "p"), (3, "http://x.com/fr/1", "h", "p")], "page_id long, url string, host string, template string")
    none = spark.createDataFrame([], "doc_id long, quality int")
    rows = url_filters.judge(d, none).collect()
    assert len(rows) == len(URLS) + 2 and all(r["verdict"] in ("allow", "block") for r in rows)
    for r in rows:
        if r["page_id"] is None:
            continue
        u = URLS[r["page_id"]] if (r["page_id"], r["host"]) != (3, "x.com") else "http://x.com/fr/1"
        host = path = ""
        if u and "://" in u:
            rest = u.split("://", 1)[1]
            host = re.match(r"[^/?#]*", rest)[0].translate(LOWER)
            path = re.match(r"[^?#]*", rest[len(host):])[0]
        fits = [(h + p, v) for h, p, v in url_filters.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
        rule, verdict = max(fits, key=lambda x: len(x[0])) if fits else (None, "allow")
        assert (r["host"], r["path"], r["rule"], r["verdict"]) == (host, path, rule, verdict)
    assert url_filters.judge(d.limit(0), none).count() == 0


def test_bad_templates_are_rejected(spark):
    rows = [(i, f"http://h.net/{'bad' if i % 2 else 'good'}/{i}.html") for i in range(200)] + [(500 + i, f"http://h.net/slug{chr(97 + i % 26)}{i}/x") for i in range(50)]
    d = spark.createDataFrame(rows, "page_id long, url string")
    m = spark.createDataFrame([(i, 0 if i % 2 else 1) for i in range(120)] + [(1, None)], "doc_id long, quality int")
    out = {r["page_id"]: r for r in url_filters.judge(d, m).collect()}
    assert all(out[i]["verdict"] == ("block" if i % 2 else "allow") for i in range(200))
    assert out[1]["template"] != out[0]["template"] and "{n}" not in out[500]["template"]


def test_sections_split_whatever_the_host_and_depth(spark):
    deep = "a/b/c/d/e/f/g/" + "h/" * 40
    urls = [f"http://hot.net/main/{i}" for i in range(3000)] + [f"http://hot.net/small/{i}" for i in range(40)]       # 1.3 % of the host
    bad = set(range(3000, 3040))
    for i in range(60):                                                                                                 # 60 equal sections
        for j in range(8):
            bad |= {len(urls)} if i % 2 else set()
            urls.append(f"http://many.net/s{chr(97 + i // 26)}{chr(97 + i % 26)}/{j}")
    for i in range(60):
        bad |= {len(urls)} if i % 2 else set()
        urls.append(f"http://deep.net/{deep}{'bad' if i % 2 else 'good'}/{i}")
    nested = len(urls)
    for i in range(240):                                                                                                # a split below a merged level and a split
        section, page = ("x", "y")[i % 2], ("p", "q")[i // 2 % 2]
        bad |= {len(urls)} if section == "x" or page == "p" else set()
        urls.append(f"http://nest.net/{'uvw'[i % 3]}/{section}/m/{page}/{i}")
    urls += ["http://nest.net/u", "http://nest.net/u/x", "http://nest.net/u/zz/m/p"]
    d = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string").repartition(3)
    m = spark.createDataFrame([(i, 0 if i in bad else 1) for i in range(nested + 240)], "doc_id long, quality int")
    out = {r["page_id"]: r for r in url_filters.judge(d, m).collect()}
    assert len(out) == len(urls)
    assert [i for i in range(nested + 240) if (out[i]["verdict"] == "block") != (i in bad)] == []
    assert out[nested]["template"] == "/*/x/*/*/*" and out[nested + 1]["template"] == "/*/y/*/p/*" and out[nested + 3]["template"] == "/*/y/*/q/*"
    assert [out[nested + 240 + i]["template"] for i in range(2)] == ["/*", "/*/x"]


def test_pipeline_stages(spark, labels, tmp_path):
    import corpus_pipeline as P

    near = near_copies()
    leak = prose(70, 25)
    rows = [(r[0], r[1], r[2], r[3], r[4]) for r in awkward(["mail jane@mail.example.com " + prose(5, 50), prose(6, 30) + " " + leak])]
    rows += [(i, t, "en", "s", len(t)) for i, t in near]
    d = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    d.write.parquet(str(tmp_path / "documents.parquet"))
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    spark.createDataFrame([(1, leak)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    docs, at = spark.read.parquet(str(tmp_path / "documents.parquet")), []
    for name, stage in P.STAGES:
        docs = C.stored(stage(spark, docs, str(tmp_path)), "t")
        at.append((name, docs))
    assert [n for n, _ in at] == ["quality rules", "n-gram Jaccard join", "benchmark decontamination", "PII", "best-fit packing"]
    assert all(x.columns == d.columns for _, x in at[:4])
    text = [dict(rows_of(x, "doc_id", "text")) for _, x in at[:4]]
    assert None not in [t for t in text[0].values()] and 15 not in text[0]
    kept = [(i, t) for i, t in rows_of(at[0][1], "doc_id", "text") if i is not None]
    comps = plain_components(kept, 5, 80)
    assert {i for i in text[1] if i is not None} == {i for i, _, c in comps if i == c}
    # rows as documents of their own: one of each group stays, whatever its id
    rows_in = rows_of(at[0][1], "doc_id", "text")
    group = [c for _, _, c in sorted(plain_rows([t for _, t in rows_in], 5, 80))]
    want = collections.Counter()
    for g in set(group):
        members = [rows_in[k] for k in range(len(rows_in)) if group[k] == g]
        want[min(members, key=lambda r: (r[0] is None, r[0] or 0))[0]] += 1 if shingles(members[0][1], 5) else len(members)
    assert collections.Counter(i for i, _ in rows_of(at[1][1], "doc_id", "text")) == want
    assert 80 in text[1] and 80 not in text[2]
    assert "jane@mail" in text[2][75] and "jane@mail" not in text[3][75] and "[EMAIL]" in text[3][75]
    packed = at[4][1]
    assert {r["doc_id"] for r in packed.collect()} == set(text[3])
    whole = P.run(spark, str(tmp_path))
    key = ("doc_id", "piece", "start", "length")
    assert sorted(rows_of(whole, *key), key=str) == sorted(rows_of(packed, *key), key=str)

"""Collocations, Merkle manifest and SimHash near-duplicates against brute force on awkward rows."""

import collections
import hashlib
import random
import re
import zlib

import numpy as np
import pytest
import xxhash

from wearcast.llm import collocations, graph, merkle, simhash_join

from .conftest import CLASH, DOCS, awkward, prose, rows_of

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def table(spark, rows, parts=3):
    return spark.createDataFrame([(*r, *CLASH) for r in rows], DOCS).repartition(parts)


# ---------------------------------------------------------------- collocations

def plain_collocations(rows, words=3, least=10, top=2000):
    f, n = collections.Counter(), collections.Counter()
    for _, text, lang, *_ in rows:
        lang = lang if lang is not None else "und"
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in range(1, words + 1):
                f.update((lang, tuple(w[i:i + k])) for i in range(len(w) - k + 1))
    cands = {k: a for k, a in f.items() if len(k[1]) > 1 and a >= least}
    longer = collections.Counter()
    for (lang, w), a in cands.items():
        for m in range(2, len(w)):
            for i in range(len(w) - m + 1):
                longer[lang, w[i:i + m]] = max(longer[lang, w[i:i + m]], a)
    out = collections.defaultdict(list)
    for (lang, w), a in cands.items():
        if (lang, w) in longer and 100 * longer[lang, w] >= 50 * a:
            continue
        cuts = [(1_000_000 * a * a // (f[lang, w[:k]] * f[lang, w[k:]]), k) for k in range(1, len(w))]
        score, k = min(cuts)
        out[lang].append((-score, -a, " ".join(w).encode(), f[lang, w[:k]], f[lang, w[k:]]))
    return {(lang, i + 1, p.decode(), -a, l, r, n[lang], -s) for lang, v in out.items() for i, (s, a, p, l, r) in enumerate(sorted(v)[:top])}


def phrase_rows(seed=4):
    rnd = random.Random(seed)
    vocab = ["Alpha", "beta", "gAmma", "delta", "naïve", "東京", "#x", "e", "f", "g"]
    rows = [(i, " ".join(rnd.choice(vocab) + rnd.choice(["", "", "", ",", ".", "\n", "\x0b", " \t"]) for _ in range(rnd.randint(0, 60))),
             rnd.choice(["en", "fr", "und", None]), "s", 1) for i in range(60)]
    rows += [(100 + i, "new york city is new york", "en", "s", 1) for i in range(15)]
    return rows + [(None, None, "en", None, None), (7, "", None, "s", 0), (8, "one", "de", "s", 1)]


@pytest.mark.parametrize("sizes", [{}, {"bits": 12, "mass": 64}, {"top": 5, "words": 4, "mass": 4096}])
def test_collocations_match_brute_force(spark, sizes):
    rows = phrase_rows() + [r[:5] for r in awkward()]
    got = rows_of(collocations.collocations(table(spark, rows), **sizes), "lang", "rank", "phrase", "a", "l", "r", "n", "score")
    plain = {k: v for k, v in sizes.items() if k in ("top", "words")}
    assert len(got) == len(set(got)) and set(got) == plain_collocations(rows, **plain)


def test_collocations_of_nothing_and_salted_ranks(spark, empty, monkeypatch):
    assert collocations.collocations(empty).count() == 0
    assert collocations.collocations(table(spark, [(1, None, None, None, None)])).count() == 0
    monkeypatch.setattr(collocations, "RANKED", 3)
    rows = phrase_rows()
    got = set(rows_of(collocations.collocations(table(spark, rows), top=4), "lang", "rank", "phrase", "a", "l", "r", "n", "score"))
    assert got == plain_collocations(rows, top=4)


def test_scores_pass_64_bits(spark):
    """1,000,000 * a * a needs more than 64 bits here; the counted table stands in for a corpus of that size."""
    a = 4_000_000_000
    row = spark.createDataFrame([(a, a + 1, a + 2)], "a long, l long, r long")
    f = collocations._wide
    from pyspark.sql import functions as F
    got = row.select((F.lit(1_000_000).cast("decimal(7,0)") * (f("a") * f("a"))).alias("top"), (f("l") * f("r")).alias("base")).selectExpr("top div base as s").first()[0]
    assert got == 1_000_000 * a * a // ((a + 1) * (a + 2))


def test_merged_summaries_keep_every_frequent_key():
    rng = np.random.default_rng(2)
    for least in (3, 10):
        stream = np.concatenate([rng.integers(0, 5000, 6000), np.repeat(rng.integers(0, 5000, 12), least)]).astype(np.uint32)
        rng.shuffle(stream)
        truth = collections.Counter(stream.tolist())
        capacity = len(stream) // least + 1
        parts = [np.unique(p, return_counts=True) for p in np.array_split(stream, 7)]
        # merged in any grouping, also one by one with cuts in between
        keys, counts = merged_one_by_one(parts, capacity)
        flat = collocations.merge(np.concatenate([k for k, _ in parts]), np.concatenate([c for _, c in parts]), capacity)
        # the error of the one merge is known: nothing that reaches the threshold is dropped by the upper bound
        assert {k for k, c in zip(flat[0].tolist(), flat[1].tolist()) if c + flat[2] >= least} == {k for k, c in truth.items() if c >= least}
        for kept, left in ((keys, counts), flat[:2]):
            assert len(kept) <= capacity
            have = dict(zip(kept.tolist(), left.tolist()))
            assert all(k in have and have[k] <= c for k, c in truth.items() if c >= least)
            assert all(c - have.get(k, 0) <= len(stream) // (capacity + 1) for k, c in truth.items())


def merged_one_by_one(parts, capacity):
    keys, counts = parts[0]
    for k, c in parts[1:]:
        keys, counts, _ = collocations.merge(np.concatenate([keys, k]), np.concatenate([counts, c]), capacity)
    return keys, counts


# ---------------------------------------------------------------- manifest

def sha(parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def plain_manifest(rows):
    """Leaves, level by level lists, and proofs by index arithmetic."""
    def leaf(r, text):
        i, _, lang, source, n = r
        return sha("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (i, source, lang, n, text))

    def tree(digests):
        levels = [digests]
        while len(levels[-1]) > 1:
            levels.append([sha(levels[-1][k:k + 3]) for k in range(0, len(levels[-1]), 3)])
        return levels

    def siblings(levels, pos):
        out = []
        for level in levels[:-1]:
            first = pos // 3 * 3
            run = level[first:first + 3]
            out.append((run[:pos - first], run[pos - first + 1:]))
            pos //= 3
        return out

    by = collections.defaultdict(list)
    for r in rows:
        by[r[3]].append((r[0] is not None, r[0] or 0, leaf(r, r[1]), r))
    order = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: tree([x[2] for x in sorted(by[s], key=lambda x: x[:3])]) for s in order}
    top = tree([trees[s][-1][0] for s in order])
    out = collections.Counter()
    for k, s in enumerate(order):
        for pos, (_, _, digest, r) in enumerate(sorted(by[s], key=lambda x: x[:3])):
            text = r[1]
            if r[0] is not None and text is not None and zlib.crc32(str(r[0]).encode()) % 2 == 0:
                text = text.replace("\n", "")
            path = siblings(trees[s], pos) + siblings(top, k)
            back = leaf(r, text)
            for before, after in path:
                back = sha([*before, back, *after])
            out[r[0], digest, trees[s][-1][0], top[-1][0], sha([x for b, a in path for x in b + a]), back, back == top[-1][0]] += 1
    return out


@pytest.mark.parametrize("levels", [7, 1, 2])
def test_manifest_matches_plain_trees(spark, monkeypatch, levels):
    monkeypatch.setattr(merkle, "LEVELS", levels)
    monkeypatch.setattr(merkle, "BLOCK", 3 ** levels)
    rows = [r[:5] for r in awkward()]
    rows += [(1000 + i, f"line {i}\nnext" if i % 3 else f"line {i}", "en", "hot", i) for i in range(40)]
    rows += [(5000, "same\nrow", "en", "hot", 3)] * 11 + [(6000, "Zé", None, "Ä", 1), (6001, "a\nb", "en", "z", None), (2, "x", "en", None, 1), (1 << 62, "\n", "en", None, 1)]
    # tasks import the package, so block sizes travel through a wrapped module constant only on this process
    got = collections.Counter(rows_of(in_process(merkle, spark, table(spark, rows)), "doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"))
    assert got == plain_manifest(rows)
    assert any(k[-1] for k in got) and any(not k[-1] for k in got)


def in_process(module, spark, docs):
    """Workers load the module afresh; hand them the patched block size with the functions."""
    import pyspark.cloudpickle as cp

    cp.register_pickle_by_value(module)
    try:
        out = module.manifest(docs)
        return spark.createDataFrame(out.collect(), out.schema)
    finally:
        cp.unregister_pickle_by_value(module)


def test_manifest_of_nothing_and_of_one(spark, empty):
    assert merkle.manifest(empty).count() == 0
    one = merkle.manifest(table(spark, [(3, "a\nb", "en", "s", 3)])).first()
    assert one["leaf"] == one["subroot"] == one["root"] and one["proof_sha256"] == hashlib.sha256(b"").hexdigest()
    assert one["verified"] == (zlib.crc32(b"3") % 2 == 1)


def test_descent_and_climb_are_inverse():
    for size in (1, 2, 3, 4, 9, 10, 28, 100):
        level = [hashlib.sha256(bytes([i])).digest() for i in range(size)]
        top, records = merkle.fold_up(level, True)
        for rank in range(size):
            found, path = merkle.descend(dict(records), top, rank, merkle.levels_of(size, True))
            assert found == level[rank] and merkle.climb(found, path)[0] == top
            if size > 1:
                assert merkle.climb(level[rank - 1], path)[0] != top


# ---------------------------------------------------------------- near-duplicates

def plain_fingerprint(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    grams = [" ".join(w[i:i + 3]) for i in range(len(w) - 2)] if len(w) >= 3 else [" ".join(w)] if w else []
    h = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def plain_groups(rows, radius=2):
    f = [plain_fingerprint(t) for _, t, *_ in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            if (f[a] ^ f[b]).bit_count() <= radius:
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    names = {}
    for i, r in enumerate(rows):
        if r[0] is not None:
            names[find(i)] = min(names.get(find(i), r[0]), r[0])
    return collections.Counter((r[0], f[i], names.get(find(i))) for i, r in enumerate(rows))


def copies(seed=3):
    rnd = random.Random(seed)
    rows = []
    for k in range(12):
        words = prose(700 + k, rnd.choice([3, 10, 60, 400])).split()
        for c in range(rnd.choice([1, 2, 8, 20])):
            w = list(words)
            if c % 3:
                w[rnd.randrange(len(w))] = "altered"
            rows.append((2000 + 50 * k + c, " ".join(w), "en", "s", 1))
    return rows + [(None, prose(700, 10), "en", "s", 1), (None, "only null ids here", "en", "s", 1), (None, "Only  null ids\there", "en", "s", 1)]


@pytest.mark.parametrize("fit", [{}, {"shard": 8, "visitors": 4, "sample": 40}])
def test_groups_match_all_pairs(spark, empty, fit):
    rows = [r[:5] for r in awkward()] + copies()
    out = simhash_join.join(table(spark, rows), **fit)
    got = collections.Counter((i, f % (1 << 64), c) for i, f, c in rows_of(out, "doc_id", "fingerprint", "component_id"))
    assert got == plain_groups(rows)
    assert simhash_join.join(empty, **fit).count() == 0


def random_prints(rng, n):
    """Dense balls around a few centres besides uniform ones."""
    centres = rng.integers(0, 1 << 64, 6, dtype=np.uint64)
    out = [rng.integers(0, 1 << 64, n // 2, dtype=np.uint64)]
    for c in centres:
        flips = np.zeros(n // 12, np.uint64)
        for _ in range(5):
            flips ^= np.uint64(1) << rng.integers(0, 64, n // 12).astype(np.uint64)
        out.append(c ^ flips)
    return np.unique(np.concatenate(out))


def closure(n, pairs):
    label = list(range(n))

    def find(x):
        while label[x] != x:
            x = label[x]
        return x

    for a, b in pairs:
        x, y = find(a), find(b)
        label[max(x, y)] = min(x, y)
    return [find(i) for i in range(n)]


def test_forest_connects_what_all_pairs_connect(monkeypatch):
    rng = np.random.default_rng(5)
    for local in (4, 64):
        monkeypatch.setattr(simhash_join, "LOCAL", local)
        p = random_prints(rng, 900)
        a, b = np.nonzero(np.bitwise_count(p[:, None] ^ p[None, :]) <= 2)
        keep = a > b
        m, r = simhash_join.forest(p, np.ones(len(p), bool), 2)
        assert len(m) < len(p) and closure(len(p), zip(m.tolist(), r.tolist())) == closure(len(p), zip(a[keep].tolist(), b[keep].tolist()))


def test_every_pair_meets_in_the_home_shard_of_one():
    rng = np.random.default_rng(6)
    p = random_prints(rng, 700)
    tree = simhash_join.Tree(p[::3], 8, 2)
    met = set()
    for _, homes, guests in tree.walk(p, np.ones(len(p), bool)):
        met.update((min(x, y), max(x, y)) for x in homes.tolist() for y in homes.tolist() + guests.tolist() if x != y)
    a, b = np.nonzero(np.bitwise_count(p[:, None] ^ p[None, :]) <= 2)
    assert {(x, y) for x, y in zip(a.tolist(), b.tolist()) if x < y} <= met
    assert len(met) < len(p) * (len(p) - 1) // 2


def test_hot_keys_join_and_star_components(spark, monkeypatch):
    monkeypatch.setattr(graph, "HOT", 4)
    left = spark.createDataFrame([(1, i) for i in range(40)] + [(2, 1), (3, 1), (None, 5)], "key long, v long")
    right = spark.createDataFrame([(1, "a"), (2, "b"), (9, "z")], "key long, w string")
    assert sorted(graph.hot_join(left, right, ["key"]).collect()) == sorted(left.join(right, ["key"]).select("key", "v", "w").collect())
    assert graph.hot_join(left, right, ["key"], "left").count() == 43
    edges = spark.createDataFrame([(i, 0) for i in range(1, 60)] + [(i, i + 1) for i in range(100, 130)] + [(59, 100)], "node long, root long")
    assert {r["label"] for r in graph.components(edges).collect()} == {0}

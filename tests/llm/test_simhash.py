"""Golay keys, fingerprints and components against brute force."""

import re

import numpy as np
import xxhash
from llm_fixtures import SF0001, documents  # noqa: F401
from pyspark.sql import functions as F

from caldim.llm import simhash as H
from caldim.llm.graph import components
from caldim.llm.queries import QUERIES


def plain_fingerprint(text, k=3):
    text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    if not words:
        return 0
    grams = [" ".join(words[i : i + k]) for i in range(max(1, len(words) - k + 1))]
    hs = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def plain_components(ids, fps, bits=2):
    par = {f: f for f in fps}

    def find(x):
        while par[x] != x:
            x = par[x]
        return x

    u = sorted(par)
    for i, a in enumerate(u):
        for b in u[i + 1 :]:
            if (a ^ b).bit_count() <= bits:
                x, y = find(a), find(b)
                par[max(x, y)] = min(x, y)
    least = {}
    for i, f in zip(ids, fps, strict=True):
        if i is not None:
            least[find(f)] = min(least.get(find(f), i), i)
    return [least.get(find(f)) for f in fps]


def test_golay_is_perfect_and_keys_meet():
    table, count = H.golay_tables()
    assert count.min() == 1 and sorted(set(count.tolist())) == [1, 6] and (count == 6).sum() == 1771
    rng = np.random.default_rng(5)
    x = rng.integers(0, 1 << 23, 3000)
    y = x ^ (1 << rng.integers(0, 23, 3000))
    sets = []
    for v in (x, y):
        s = [set() for _ in v]
        for r, i in zip(*H.codeword_indices(v), strict=True):
            s[r].add(int(i))
        sets.append(s)
    assert all(a & b for a, b in zip(*sets, strict=True))


def test_keys_cover_two_bits():
    rng = np.random.default_rng(6)
    x = rng.integers(-(1 << 63), (1 << 63) - 1, 4000)
    flips = [(np.uint64(1) << np.uint64(a)) ^ (np.uint64(1) << np.uint64(b)) for a, b in rng.integers(0, 64, (4000, 2))]
    y = (x.view(np.uint64) ^ np.array(flips, np.uint64)).view(np.int64)
    sets = []
    for v in (x, y):
        s = [set() for _ in v]
        for r, k in zip(*H.keys_of(v), strict=True):
            s[r].add(int(k))
        sets.append(s)
    assert all(a & b for a, b in zip(*sets, strict=True))


def test_links_connect_what_is_close(spark, monkeypatch):
    """Chains and dense groups, also with buckets far over the block size."""
    monkeypatch.setattr(H, "BLOCK", 16)
    rng = np.random.default_rng(7)
    fps = set()
    for centre in rng.integers(0, 1 << 62, 12).tolist():
        for _ in range(60):
            centre ^= (1 << int(rng.integers(0, 64))) | (1 << int(rng.integers(0, 64)))
            fps.add(centre)
    dense = int(rng.integers(0, 1 << 62))
    fps |= {dense ^ (1 << i) ^ (1 << j) for i in range(20) for j in range(20)}
    fps = sorted(fps)
    signed = np.array(fps, np.uint64).view(np.int64).tolist()
    df = spark.createDataFrame([(f,) for f in signed], "fp long")
    comp = {r.node: r.root for r in components(H.links(df), "a", "b").collect()}
    got = [comp.get(f, f) for f in signed]
    want = plain_components(range(len(fps)), fps)
    pairs = set(zip(got, want, strict=True))
    assert len(pairs) == len(set(got)) == len(set(want))


def test_bucket_edges_across_blocks(monkeypatch):
    monkeypatch.setattr(H, "BLOCK", 4)
    fp = np.sort(np.array([0, 1, 3, 7, 15, 31, 63, 7 << 40, (7 << 40) + 3, 7 << 50]))
    a, b = H.bucket_edges(fp, 1)
    par = {int(f): int(f) for f in fp}

    def find(x):
        while par[x] != x:
            x = par[x]
        return x

    for x, y in zip(a.tolist(), b.tolist(), strict=True):
        x, y = find(x), find(y)
        par[max(x, y)] = min(x, y)
    assert sorted(find(int(f)) for f in fp) == [0] * 7 + [7 << 40, (7 << 40) + 3, 7 << 50]


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(100)] + [(1000, 1000 + i) for i in range(1, 50)] + [(5, 5), (None, 3)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long"), "a", "b").collect()}
    assert got == {i: 0 for i in range(101)} | {1000 + i: 1000 for i in range(50)}
    assert components(spark.createDataFrame([], "a long, b long"), "a", "b").count() == 0


def test_documents(documents):
    base = " ".join(f"wörd{i} The" for i in range(400))
    rows = [(7, base), (3, base.upper().replace("Ö", "ö")), (9, base + " x"), (4, None), (2, ""), (6, "a b"), (None, "a  B"), (6, "a b")]
    rows += [(None, "only here without id"), (8, "one"), (10, "long " * 50_000)]
    df = documents(rows).withColumn("fp", F.lit("clash")).withColumn("fingerprint", F.lit(1))
    got = sorted((r.doc_id or -1, r.fingerprint, r.component_id or -1) for r in H.near_duplicates(df).collect())
    fps = [plain_fingerprint(t) for _, t in rows]
    comp = plain_components([i for i, _ in rows], fps)
    assert got == sorted((i or -1, f"{f:016x}", c or -1) for (i, _), f, c in zip(rows, fps, comp, strict=True))
    assert H.near_duplicates(documents(rows).limit(0)).count() == 0


def test_query(spark):
    rows = spark.read.parquet(f"{SF0001}/documents.parquet").select("doc_id", "text").collect()
    fps = [plain_fingerprint(r.text) for r in rows]
    want = {r.doc_id: (f"{f:016x}", c) for r, f, c in zip(rows, fps, plain_components([r.doc_id for r in rows], fps), strict=True)}
    got = QUERIES["op7_simhash_near_dedup"](spark, SF0001).collect()
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in got} == want

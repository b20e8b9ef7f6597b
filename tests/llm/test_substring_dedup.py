"""Word windows against brute force over all of them."""

import hashlib
import random
import re

import numpy as np
import pytest
from llm_fixtures import SF0001, documents  # noqa: F401
from pyspark.sql import functions as F

from caldim.llm import blocks as B
from caldim.llm import substring_dedup as S
from caldim.llm.queries import QUERIES


def expected(rows, length=13):
    words = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for _, t in rows]
    ids = [S.NO_ID if i is None else i for i, _ in rows]
    least, holders = {}, {}
    for k, w in enumerate(words):
        for i in range(len(w) - length + 1):
            win = tuple(w[i : i + length])
            least[win] = min(least.get(win, S.NO_ID), ids[k])
    longest, size = [0] * len(rows), length
    while True:
        holders = {}
        for k, w in enumerate(words):
            for i in range(len(w) - size + 1):
                holders.setdefault(tuple(w[i : i + size]), set()).add(k)
        found = set().union(*(h for h in holders.values() if len(h) > 1)) if holders else set()
        if not found:
            break
        for k in found:
            longest[k] = size
        size *= 2
    out = []
    for k, w in enumerate(words):
        gone = set()
        for i in range(len(w) - length + 1):
            if least[tuple(w[i : i + length])] < ids[k]:
                gone.update(range(i, i + length))
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((rows[k][0], len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest(), longest[k], kept))
    return sorted(out, key=repr)


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def some_rows(seed, n, vocabulary=400):
    rng = random.Random(seed)
    words = [rng.choice(["a", "bé", "c.", "long"]) + str(k) for k in range(vocabulary)]
    gaps = [" ", " ", "  ", "\n", "\t", "\x0b \x0c\r"]
    passages = [[rng.choice(words) for _ in range(rng.randint(8, 90))] for _ in range(12)]
    rows = []
    for k in range(n):
        w = []
        for _ in range(rng.randint(0, 5)):
            w += [rng.choice(words) for _ in range(rng.randint(0, 30))]
            if rng.random() < 0.5:
                w += rng.choice(passages)
        rows.append((k, "".join(x + rng.choice(gaps) for x in w)))
    return rows + [(n + k, rows[rng.randrange(n)][1]) for k in range(n // 4)]


def test_query(spark):
    docs = spark.read.parquet(f"{SF0001}/documents.parquet").select("doc_id", "text").collect()
    want = [r[:5] for r in expected([tuple(r) for r in docs])]
    assert got(QUERIES["op12_substring_dedup"](spark, SF0001)) == sorted(want, key=repr)


@pytest.mark.parametrize("length", [13, 2, 5])
def test_odd_documents(documents, monkeypatch, length):
    monkeypatch.setattr(B, "BLOCK", 2000)
    monkeypatch.setattr(S, "CHUNK", 300)
    rows = some_rows(1, 60)
    rows += [(100, None), (101, ""), (102, " \t\n"), (None, rows[3][1] + " tail"), (None, rows[3][1]), (5, "again " + rows[5][1]), (-3, rows[7][1])]
    rows += [(103, "x " * 400), (104, "x " * 90 + "y"), (105, "w" * 5000 + " " + rows[9][1])]
    random.Random(2).shuffle(rows)
    df = documents(rows).withColumn("block", F.lit("clash")).withColumn("raw", F.lit(1.5))
    assert got(S.dedup(df, length, keep_text=True)) == expected(rows, length)


def test_empty_tables(documents):
    df = documents([(1, "a b c")])
    assert S.dedup(df.limit(0)).count() == 0
    assert got(S.dedup(df)) == [(1, 3, 0, hashlib.sha256(b"a b c").hexdigest(), 0)]


def test_hot_passage_and_copies(documents, monkeypatch):
    monkeypatch.setattr(B, "BLOCK", 4000)
    hot = " ".join(f"hot{k}" for k in range(40))
    rows = [(k, f"start {k} {hot} end {k}") for k in range(300)] + [(1000 + k, "copy " * 30 + "of it") for k in range(100)]
    assert got(S.dedup(documents(rows).repartition(11), keep_text=True)) == expected(rows)


def test_names_do_not_depend_on_place():
    text = "one two  three one two\nthree four"
    words = S.Words(np.frombuffer((text * 2).encode(), np.uint8), np.array([0, len(text), 2 * len(text)]))
    h = words.hashes(1)
    assert words.counts.tolist() == [7, 7] and (h[:7] == h[7:]).all() and h[0] == h[3] != h[1]
    w = S.windows(h, 3)
    assert w[0] == w[3] and len(w) == 12 and len(set(w.tolist())) < 12

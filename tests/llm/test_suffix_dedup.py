"""Suffix-array dedup against brute force over all windows."""

import hashlib

import numpy as np
import pytest
from llm_fixtures import SF0001, documents  # noqa: F401
from pyspark.sql import functions as F

from caldim.llm import blocks as B
from caldim.llm import suffix_dedup as S
from caldim.llm.queries import QUERIES

NO_ID = S.NO_ID


def brute(rows, length=50):
    """(o, text) -> digest, by all windows of documents with smaller ids."""
    first = {}
    for o, text in rows:
        b = (text or "").encode()
        for k in range(len(b) - length + 1):
            w = b[k : k + length]
            first[w] = min(first.get(w, o), o)
    out = []
    for o, text in rows:
        b = (text or "").encode()
        mark = np.zeros(len(b), bool)
        for k in range(len(b) - length + 1):
            if first[b[k : k + length]] < o:
                mark[k : k + length] = True
        runs = int((np.diff(np.concatenate(([0], mark.astype(int)))) == 1).sum())
        kept = bytes(np.frombuffer(b, np.uint8)[~mark])
        out.append((o, len(b), int(mark.sum()), runs, hashlib.sha256(kept).hexdigest()))
    return sorted(out)


def digest(df):
    rows = df.select(F.coalesce("doc_id", F.lit(NO_ID)).alias("o"), "n_bytes", "n_removed", "n_spans", "kept_sha256")
    return sorted(tuple(r) for r in rows.collect())


@pytest.mark.parametrize(("n", "symbols"), [(5, 2), (64, 1), (300, 2), (4000, 3), (4000, 200)])
def test_suffix_ranks_order_all_suffixes(n, symbols):
    s = np.random.default_rng(n + symbols).integers(1, symbols + 1, n)
    b = bytes(s.astype(np.uint8))
    order = np.argsort(S.suffix_ranks(s, 50), kind="stable")
    assert [b[i : i + 50] for i in order] == sorted(b[i : i + 50] for i in range(n))


def test_equal_runs():
    texts = [b"a" * 60, b"b" + b"a" * 55, bytes(range(60)), b"a" * 50]
    run, owner = S.equal_runs(texts, 50)
    windows = [t[k : k + 50] for t in texts for k in range(len(t) - 49)]
    same = {}
    for r, w in zip(run.tolist(), windows, strict=True):
        assert same.setdefault(r, w) == w
    assert len(same) == len(set(windows)) and owner.tolist() == [0] * 11 + [1] * 7 + [2] * 11 + [3]


def corpus():
    rng = np.random.default_rng(3)
    word = lambda n: "".join(rng.choice(list("abcdeé "), n))
    shared, line = word(400), word(70)
    rows = [(k, word(int(rng.integers(0, 900)))) for k in range(60)]
    rows += [(100 + k, word(30) + shared[k : 300 + k] + word(40)) for k in range(20)]
    rows += [(200 + k, line + word(k)) for k in range(40)]  # one passage, many continuations
    rows += [(300 + k, shared) for k in range(10)]
    rows += [(400, "xy" * 500), (401, "yx" * 300), (402, None), (403, ""), (404, "a" * 49), (405, "a" * 50), (406, "a" * 50)]
    rows += [(407, word(70_000)), (5, rows[5][1]), (5, rows[6][1]), (None, shared), (None, shared), (None, word(80))]
    return rows


@pytest.mark.parametrize(("most", "block", "part"), [(S.MOST, B.BLOCK, S.SLICE), (200, 3000, 500), (S.MOST, 20_000, 2000)])
def test_matches_brute_force(documents, monkeypatch, most, block, part):
    """Copies, near copies, repeats, ties, nulls and repeated ids; also with
    every minimizer of a few bytes of contexts spread by its windows, small blocks and
    texts cut in slices."""
    monkeypatch.setattr(S, "MOST", most)
    monkeypatch.setattr(B, "BLOCK", block)
    monkeypatch.setattr(S, "SLICE", part)
    rows = corpus()
    got = digest(S.dedup(documents(rows).withColumn("n_bytes", F.lit("clash")).repartition(5)))
    assert got == brute([(NO_ID if i is None else i, t) for i, t in rows])


def test_kept_text_and_empty_table(spark, documents):
    rows = [(1, "x" * 20 + "abcdefghij" * 6), (2, "y" * 20 + "abcdefghij" * 6 + "z")]
    kept = {r.doc_id: bytes(r.kept) for r in S.dedup(documents(rows), keep_text=True).collect()}
    assert kept == {1: rows[0][1].encode(), 2: b"y" * 20 + b"z"}
    assert S.dedup(documents(rows).limit(0)).count() == 0


def test_query(spark):
    docs = spark.read.parquet(f"{SF0001}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    assert digest(QUERIES["op1_suffix_array_dedup"](spark, SF0001)) == brute(rows)


def test_one_passage_in_thousands_of_documents(documents):
    """Each continues it differently, so one minimizer has contexts without end."""
    line = "The same sixty bytes stand in every one of these documents."
    rows = [(k, f"{k * 7919 % 10007:09d}{line}{k * 104729 % 100003:09d}") for k in range(4000)]
    got = {r.doc_id: r.n_removed for r in S.dedup(documents(rows).repartition(7)).collect()}
    want = {r[0]: r[2] for r in brute(rows)}
    assert got == want and sum(v >= 50 for v in got.values()) == 3999

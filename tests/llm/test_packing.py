"""Tokens against the tokenizer itself, packing against its constraints."""

import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_fixtures import SF0001, documents  # noqa: F401
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from caldim.llm import packing as P
from caldim.llm.queries import QUERIES, tokenizer_path

ODD = [
    "",
    "Don't WON'T we'll 'S x's",
    "a\x1cb \x1f c",
    "<|endoftext|> mid<|startoftext|>dle",
    "ΑΣ ΣΑΣ Σ",
    "İstanbul é é ﬁ ǅ",
    "x\u0085y z w​v",
    "日本語テキスト 123 4,5.6 ½ ²",
    "word,word;(a) [b]!? ... --- #a",
    "Ünï,Cödé! ÉCOLE. naïve…",
    "tab\tline\nfeed\r\n\x0b\x0c",
    "😀 a😀b",
]


def check(df, docs, capacity=4096):
    tok = Tokenizer.from_file(tokenizer_path())
    rows = docs.select("doc_id", "text").collect()
    want = []
    for r in rows:
        ids = np.array([*tok.encode(r.text or "", add_special_tokens=False).ids, 1], "<u4")
        for p, s in enumerate(range(0, len(ids), capacity)):
            want.append((r.doc_id or -1, p, s, len(ids[s : s + capacity]), zlib.crc32(ids[s : s + capacity].tobytes())))
    got = df.collect()
    assert sorted((r.doc_id or -1, r.piece, r.start, r.length, r.ids_crc32) for r in got) == sorted(want)
    seqs = {}
    for r in got:
        seqs.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for s in seqs.values():
        at = 0
        for offset, length in sorted(s):
            assert offset == at
            at += length
        assert at <= capacity
    return len(seqs), sum(w[3] for w in want) / capacity


def test_words_are_tokenized_as_texts():
    tok, own = Tokenizer.from_file(tokenizer_path()), P.WordTokenizer(tokenizer_path())
    for text in [*ODD, " ".join(ODD), *ODD]:
        assert own(text).tolist() == tok.encode(text, add_special_tokens=False).ids, text


def test_store_of_words_is_bounded(monkeypatch):
    monkeypatch.setattr(P, "KEPT_WORDS", 10)
    tok, own = Tokenizer.from_file(tokenizer_path()), P.WordTokenizer(tokenizer_path())
    for k in range(20):
        text = " ".join(f"w{k}x{j}, abc" for j in range(8))
        assert own(text).tolist() == tok.encode(text, add_special_tokens=False).ids
        assert len(own.letters) + len(own.signs) + len(own.words) <= 30


def test_batches_of_texts():
    tok, own = Tokenizer.from_file(tokenizer_path()), P.WordTokenizer(tokenizer_path())
    for texts in (ODD, [t for t in ODD if not any(c in t for c in P.NOT_SPACE)], ["", " ", "a", ""]):
        ids, ends = own.many(pa.array(["before", *texts]).slice(1))
        want = [tok.encode(t, add_special_tokens=False).ids for t in texts]
        assert ids.tolist() == sum(want, []) and ends.tolist() == np.cumsum([len(w) for w in want]).tolist()


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(st.one_of(st.sampled_from("abcXYZ .,'!\n\t\x1c\x85\xa0\u2003Σσß<|>1²é"), st.characters(exclude_categories=["Cs"]))), max_size=4))
def test_any_text(texts):
    tok, own = Tokenizer.from_file(tokenizer_path()), P.tokenizer(tokenizer_path())
    ids, _ = own.many(pa.array(texts, pa.string()))
    assert ids.tolist() == sum((tok.encode(t, add_special_tokens=False).ids for t in texts), [])


def test_query(spark):
    n, least = check(QUERIES["op5_best_fit_packing"](spark, SF0001), spark.read.parquet(f"{SF0001}/documents.parquet"))
    assert n <= least * 1.02 + 1


def test_odd_documents(documents):
    rows = [(k, t) for k, t in enumerate(ODD)] + [(50, None), (None, "no id"), (51, "again"), (51, "again"), (52, "long text " * 9000)]
    df = documents(rows).withColumn("piece", F.lit("clash")).withColumn("length", F.lit(1.5))
    check(P.pack(df, tokenizer_path()), df)
    check(P.pack(df, tokenizer_path(), capacity=16), df, 16)
    assert P.pack(df.limit(0), tokenizer_path()).count() == 0


@pytest.mark.parametrize("rule", ["norm", "dot"])
@pytest.mark.parametrize(("docs", "cost"), [(4096, 4096**2), (5, 4096**2), (4096, 4096**2 // 4)])
def test_every_constraint_holds(rule, docs, cost):
    rng = np.random.default_rng(8)
    lengths = np.concatenate((rng.integers(1, 2048, 500), rng.integers(1, 60, 500)))
    bins, offsets = P.best_fit(lengths, 4096, docs, cost, rule, (1.0, 0.2, 0.2))
    for k in range(bins.max() + 1):
        own = np.sort(offsets[bins == k])
        size = lengths[bins == k][np.argsort(offsets[bins == k])]
        assert len(size) <= docs and size.sum() <= 4096 and (size**2).sum() <= cost
        assert (own == np.cumsum(size) - size).all()
    bound = max(lengths.sum() / 4096, len(lengths) / docs, (lengths**2).sum() / cost)
    assert bins.max() + 1 <= 1.15 * bound + 2


def test_best_fit_takes_the_fullest():
    bins, offsets = P.best_fit(np.array([60, 50, 40, 45, 5]), 100, 100, 10**4, "norm", (1.0, 0.0, 0.0))
    assert bins.tolist() == [0, 1, 0, 1, 1] and offsets.tolist() == [0, 0, 60, 50, 95]
    with pytest.raises(ValueError):
        P.pack(None, "", rule="first")

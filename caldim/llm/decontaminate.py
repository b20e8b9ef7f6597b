"""Benchmark decontamination: Wu-Manber search over words.

The symbols are words, so the alphabet is large and blocks of two words rarely
occur by chance. Patterns (windows of an item's words) are grouped by length;
for each length the block shift table holds, for every two-word block of a
pattern, how far the search may move without missing an occurrence that ends
later; blocks that no pattern has move it by the most. At shift zero the
suffix-hash bucket of the block gives the patterns that end so, and direct
comparison of all words confirms.

Patterns are held in blocks of bounded size (``block_windows`` window and item
pairs): one block is collected and broadcast at a time, searched in one pass over
the documents, and gone from the driver and all workers before the next; finds
are stored between passes and put together at the end. A benchmark of one block,
as usual, takes one pass without anything stored between.

Defined cases: null text has no words, n_words 0; null item text or one without
words makes no window; a null item_id is written as an empty string among the
item ids; items that repeat an id count once; repeated documents give repeated
rows; empty tables work; other columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caldim.llm.common import lower_ascii, prepare, stored, text_of

#: Words: letters and digits of ASCII, and whatever is not ASCII. Fixed value.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Lowers A-Z and turns ASCII other than letters and digits to spaces.
TO_WORDS = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256)
)


def windows(benchmark: DataFrame, size: int = 10) -> DataFrame:
    """(window, items): distinct windows as space-joined words, with the
    distinct ids, as strings, of the items that hold them."""
    words = F.regexp_extract_all(lower_ascii(text_of()), F.lit(f"({WORD})"), F.lit(1))
    w = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"), words.alias("w"))
    starts = F.sequence(F.lit(1), F.greatest(F.lit(1), F.size("w") - size + 1))
    w = w.filter(F.size("w") > 0).select("item", "w", F.explode(starts).alias("at"))
    w = w.select("item", F.array_join(F.slice("w", F.col("at"), size), " ").alias("window"))
    return w.groupBy("window").agg(F.collect_set("item").alias("items"))


class Patterns:
    """Shift tables, buckets and patterns of one length."""

    def __init__(self, length: int, found: list[tuple[list[bytes], list[str]]]):
        self.length, self.block = length, min(2, length)
        self.most = length - self.block + 1
        self.shift: dict = {}
        self.bucket: dict = {}
        for words, items in found:
            for end in range(self.block - 1, length):
                key = tuple(words[end - self.block + 1 : end + 1])
                self.shift[key] = min(self.shift.get(key, self.most), length - 1 - end)
            self.bucket.setdefault(key, {}).setdefault(words[0], []).append((words, items))

    def search(self, words: list[bytes], hit: set[int], items: set[str]) -> None:
        """Add the starts of occurrences to ``hit`` as (start, length) codes and
        the items of their windows."""
        length, block, most = self.length, self.block, self.most
        shift, bucket, n, at = self.shift, self.bucket, len(words), self.length - 1
        while at < n:
            key = (words[at - 1], words[at]) if block == 2 else (words[at],)
            step = shift.get(key, most)
            if step:
                at += step
                continue
            start = at - length + 1
            for pattern, ids in bucket[key].get(words[start], ()):
                if words[start : at + 1] == pattern:
                    hit.add(start * 64 + length)
                    items.update(ids)
            at += 1


def build(rows: list[tuple[str, list[str]]]) -> list[Patterns]:
    by_length: dict[int, list] = {}
    for window, items in rows:
        words = window.encode().split(b" ")
        by_length.setdefault(len(words), []).append((words, items))
    return [Patterns(n, found) for n, found in sorted(by_length.items())]


def find(docs: DataFrame, benchmark: DataFrame, size: int = 10, block_windows: int = 200_000) -> DataFrame:
    """(doc_id, n_words, n_hit, n_items, items_sha256, contaminated) of every
    document; windows have ``size`` (at most 63) words."""
    if not 1 <= size <= 63:
        raise ValueError("windows have 1 to 63 words")
    spark = docs.sparkSession
    prepare(spark)
    wins = stored(windows(benchmark, size), "benchmark-windows")
    pairs = wins.agg(F.sum(F.size("items"))).first()[0] or 0
    blocks = max(1, -(-pairs // block_windows))
    rows = docs.select("doc_id", text_of().cast("binary").alias("text"))
    none = [F.array().cast("array<long>").alias("hits"), F.array().cast("array<string>").alias("items")]
    if blocks == 1:
        rows = rows.select("*", *none)
        tables = spark.sparkContext.broadcast([(r[0], r[1]) for r in wins.collect()])
        return rows.mapInArrow(_pass(tables), rows.schema).mapInArrow(_digest, _result_schema(docs))
    rows = stored(rows.withColumn("rid", F.monotonically_increasing_id()), "decontamination-rows")
    look = rows.select("rid", "text", *none)
    finds = None
    for k in range(blocks):
        part = wins.filter(F.pmod(F.xxhash64("window"), F.lit(blocks)) == k)
        tables = spark.sparkContext.broadcast([(r[0], r[1]) for r in part.collect()])
        hit = look.mapInArrow(_pass(tables), look.schema).filter(F.size("hits") > 0).drop("text")
        hit = stored(hit, "decontamination-finds")
        tables.destroy()
        finds = hit if finds is None else finds.unionByName(hit)
    together = lambda c: F.array_distinct(F.flatten(F.collect_list(c))).alias(c)
    both = rows.join(finds.groupBy("rid").agg(together("hits"), together("items")), "rid", "left")
    empty = {c: F.coalesce(F.col(c), d) for c, d in zip(("hits", "items"), none, strict=True)}
    both = both.select("doc_id", "text", *(d.alias(c) for c, d in empty.items()))
    return both.mapInArrow(_digest, _result_schema(docs))


def _pass(tables):
    def run(batches):
        machines = build(tables.value)
        for b in batches:
            hits, items = [], []
            for text, h, i in zip(b.column(1), b.column(2), b.column(3), strict=True):
                words, hit, found = text.as_py().translate(TO_WORDS).split(), set(h.as_py()), set(i.as_py())
                for m in machines:
                    m.search(words, hit, found)
                hits.append(sorted(hit))
                items.append(sorted(found))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(hits, b.schema.field(2).type), pa.array(items, b.schema.field(3).type)],
                schema=b.schema,
            )

    return run


def _result_schema(docs: DataFrame):
    return docs.select(
        "doc_id",
        F.lit(0).cast("long").alias("n_words"),
        F.lit(0).cast("long").alias("n_hit"),
        F.lit(0).cast("long").alias("n_items"),
        F.lit("").alias("items_sha256"),
        F.lit(False).alias("contaminated"),
    ).schema


def _digest(batches):
    names = ["n_words", "n_hit", "n_items", "items_sha256", "contaminated"]
    for b in batches:
        out = []
        for text, hits, items in zip(b.column(1), b.column(2), b.column(3), strict=True):
            n = len(text.as_py().translate(TO_WORDS).split())
            mark = np.zeros(n, bool)
            for code in hits.as_py():
                mark[code // 64 : code // 64 + code % 64] = True
            ids = sorted(items.as_py())
            n_hit = int(mark.sum())
            out.append((n, n_hit, len(ids), hashlib.sha256(",".join(ids).encode()).hexdigest(), n_hit > 0))
        cols = list(zip(*out, strict=True)) or [()] * 5
        types = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.bool_()]
        yield pa.RecordBatch.from_arrays(
            [b.column(0), *(pa.array(c, t) for c, t in zip(cols, types, strict=True))], names=["doc_id", *names]
        )


def oracle_sql(size: int = 10) -> str:
    """All windows of documents joined to those of items, by their text."""
    words = f"""regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
      'abcdefghijklmnopqrstuvwxyz'), '{WORD}')"""
    return f"""
    WITH item AS (SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item, {words} AS w FROM benchmark),
    win AS (
      SELECT DISTINCT item, len(part) AS n, array_to_string(part, ' ') AS p FROM (
        SELECT item, w[i:i + {size - 1}] AS part
        FROM (SELECT item, w, unnest(range(1, greatest(1, len(w) - {size - 1}) + 1)) AS i FROM item WHERE len(w) > 0))),
    doc AS (SELECT doc_id, {words} AS w FROM documents),
    dw AS (
      SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS p FROM (
        SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM doc, (SELECT DISTINCT n FROM win) WHERE len(w) >= n)),
    occ AS (SELECT doc_id, i, dw.n, item FROM dw JOIN win ON dw.p = win.p AND dw.n = win.n),
    hit AS (SELECT doc_id, count(DISTINCT k) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS k FROM occ) GROUP BY doc_id),
    found AS (
      SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
      FROM (SELECT DISTINCT doc_id, item FROM occ) GROUP BY doc_id)
    SELECT doc.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
           CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
           coalesce(n_hit, 0) > 0 AS contaminated
    FROM doc LEFT JOIN hit USING (doc_id) LEFT JOIN found USING (doc_id)"""

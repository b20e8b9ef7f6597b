"""Quality classifier: hashed word n-grams, logistic regression by FTRL.

Features of a text, all hashed into ``BUCKETS`` places: its words, pairs of
neighbouring words, and the same n-grams (one to two) over word shapes - which
kinds of characters a word has, a coarse length, and whether it repeats the
word before - so that what makes a word odd is learnt once for all words.
Values are square roots of counts, scaled to norm one over words and over shapes.

Training uses at most ``train_rows`` labelled rows (those with the smallest
hashes of doc_id among the training folds, so the choice is fixed and uniform);
one task runs the follow-the-regularised-leader updates and its weights (1 MB
whatever the input) go to all executors, which score sparse dot products.

Defined cases: null text is the empty text, scored by the intercept alone; a
null doc_id is scored, is not held out and never trains; rows that repeat a
doc_id are scored each, and the one whose text has the smallest hash trains; of
contradicting labels the smallest counts, null labels do not; without any
training row every score is 0.5; an empty table gives none; other columns are
ignored. A text takes some 60 bytes of a task's memory for each of its own.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caldim.llm.common import fresh, prepare, text_of, utf8

#: Places of the hashed features.
BUCKETS = 1 << 18
#: Labelled rows that the classifier is fitted on, at most.
TRAIN_ROWS = 8000
EPOCHS, ALPHA, BETA, L1, L2 = 3, 0.3, 1.0, 0.01, 0.5

_MIX = np.uint64(0x9E3779B97F4A7C15)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(29))


def _tables() -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(7)
    return rng.integers(0, 1 << 63, 256, np.uint64), rng.integers(0, 1 << 62, 64, np.uint64) * np.uint64(2) + np.uint64(1)


_BYTE, _PLACE = _tables()
#: Kinds of bytes: upper case, lower case or not ASCII, digit, punctuation.
_KIND = np.array(
    [0 if 65 <= b <= 90 else 1 if 97 <= b <= 122 or b >= 128 else 2 if 48 <= b <= 57 else 3 for b in range(256)]
)


def features(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(places, values) of one text's UTF-8 bytes."""
    inside = raw > 32
    if not inside.any():
        return np.zeros(0, np.int64), np.zeros(0)
    edge = np.diff(inside.astype(np.int8), prepend=0, append=0)
    start, end = np.nonzero(edge == 1)[0], np.nonzero(edge == -1)[0]
    size = end - start
    body = raw[inside]
    first = np.concatenate(([0], np.cumsum(size)[:-1]))
    place = np.arange(len(body)) - np.repeat(first, size)
    word = _mix(np.add.reduceat(_BYTE[body] * _PLACE[place & 63], first) + size.astype(np.uint64))
    kinds = np.add.reduceat(np.eye(4, dtype=np.int32)[_KIND[body]], first, axis=0)
    same = np.zeros(len(size), np.int64)
    same[1:] = word[1:] == word[:-1]
    shape = np.minimum(kinds[:, 0], 2)
    for part, most in ((kinds[:, 1], 1), (kinds[:, 2], 1), (kinds[:, 3], 3), (size // 4, 4), (same, 1)):
        shape = shape * (most + 1) + np.minimum(part, most)
    shape = _mix((shape.astype(np.uint64) + np.uint64(1)) * _MIX)
    at, value = [], []
    for salt, gram in enumerate((word, shape)):
        grams = np.concatenate((gram, _mix(gram[:-1] * _MIX + gram[1:])))
        where, count = np.unique(_mix(grams + np.uint64(salt)) & np.uint64(BUCKETS - 1), return_counts=True)
        v = np.sqrt(count)
        at.append(where.astype(np.int32))
        value.append(v / np.linalg.norm(v))
    return np.concatenate(at), np.concatenate(value)


def ftrl(rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray) -> tuple[np.ndarray, float]:
    """Weights and intercept by FTRL-proximal updates over shuffled rows."""
    z, n, b = np.zeros(BUCKETS + 1), np.zeros(BUCKETS + 1), BUCKETS
    rng = np.random.default_rng(11)

    def weights(zi, ni):
        return np.where(np.abs(zi) <= L1, 0.0, -(zi - np.sign(zi) * L1) / ((BETA + np.sqrt(ni)) / ALPHA + L2))

    for _ in range(EPOCHS):
        for k in rng.permutation(len(rows)):
            at = np.append(rows[k][0], b)
            x = np.append(rows[k][1], 1.0)
            w = weights(z[at], n[at])
            g = (1 / (1 + np.exp(-np.clip(w @ x, -35, 35))) - labels[k]) * x
            s = (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / ALPHA
            np.add.at(z, at, g - s * w)
            np.add.at(n, at, g * g)
    w = weights(z, n)
    return w[:b], float(w[b])


def held_out(doc_id: Column | str = "doc_id") -> Column:
    c = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.crc32(c.cast("string")) % 4 == 2, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS) -> tuple[np.ndarray, float]:
    """Weights and intercept from labelled rows outside the held-out fold."""
    prepare(docs.sparkSession)
    marked = labels.filter("doc_id is not null and quality is not null").groupBy("doc_id").agg(F.min("quality").alias("y"))
    chosen = marked.filter(~held_out()).orderBy(F.xxhash64("doc_id"), "doc_id").limit(train_rows)
    some = docs.select("doc_id", text_of().alias("text")).join(F.broadcast(chosen), "doc_id")
    one = some.groupBy("doc_id").agg(F.min(F.struct(F.xxhash64("text").alias("hash"), "text", "y")).alias("row"))
    order = one.repartition(1).sortWithinPartitions(F.xxhash64("doc_id"), "doc_id").select("row.text", "row.y")

    def fit(batches):
        rows, y = [], []
        for b in batches:
            raw, off = utf8(b.column(0))
            rows += [features(raw[s:e]) for s, e in zip(off[:-1], off[1:], strict=True)]
            y += b.column(1).to_pylist()
        w, b0 = ftrl(rows, np.array(y, float)) if rows else (np.zeros(BUCKETS), 0.0)
        yield pa.RecordBatch.from_arrays([pa.array([w.astype("<f4").tobytes()]), pa.array([b0])], names=["w", "b"])

    fitted = order.mapInArrow(fit, "w binary, b double").collect()
    if not fitted:
        return np.zeros(BUCKETS, np.float32), 0.0
    return np.frombuffer(fitted[0]["w"], "<f4"), fitted[0]["b"]


def score(
    docs: DataFrame, model: tuple[np.ndarray, float], threshold: float = 0.7, names: tuple[str, str] = ("score", "predicted")
) -> DataFrame:
    """The documents with score (0 to 1) and predicted (1 from ``threshold``),
    under the given names; all columns of ``docs`` stay, but for those of these names."""
    prepare(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.drop(*names)
    (text,) = fresh(rows, "text_")
    schema = rows.withColumn(names[0], F.lit(0.0)).withColumn(names[1], F.lit(0)).schema
    rows = rows.withColumn(text, text_of())

    def run(batches):
        w, b0 = shared.value
        w = w.astype(float)
        for b in batches:
            raw, off = utf8(b.column(b.num_columns - 1))
            s = np.empty(b.num_rows)
            for k in range(b.num_rows):
                at, x = features(raw[off[k] : off[k + 1]])
                s[k] = w[at] @ x + b0
            p = 1 / (1 + np.exp(-np.clip(s, -35, 35)))
            cols = [*b.columns[:-1], pa.array(p), pa.array((p >= threshold).astype(np.int32))]
            yield pa.RecordBatch.from_arrays(cols, names=[*b.schema.names[:-1], *names])

    return rows.mapInArrow(run, schema)

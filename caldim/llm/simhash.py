"""SimHash near-duplicates, joined by Golay-code keys.

A document's fingerprint has 64 bits, cut into three segments of 22, 21 and 21
bits. Of at most two differing bits, some segment holds none, and the segment
after it (in a circle) at most one: else both errors fill two other segments,
one each, and again the follower of the free segment has one. So a pair at
distance <= 2 agrees, for one of the three (free, follower) choices, exactly on
``free`` and up to one bit on ``follower``.

One-bit tolerance comes from the perfect binary Golay code [23, 12]: every
23-bit word lies within distance 3 of exactly one codeword. A follower segment
(zero-extended to 23 bits) gets the indices of all codewords within distance 4:
one index if it lies within 2 of its codeword, else six (the codeword at 3 and
the five at 4, five being the number of weight-7 codewords over three given
places). Of two words that differ in one bit, one's nearest codeword (distance
<= 3) lies within 4 of the other, so they share an index. Keys are (choice,
exact segment, codeword index); rows with equal keys are verified by popcount.

Defined cases: null text has no words (fingerprint zero); null doc_id rows keep
a fingerprint and take part in linking, but never name a component (component
null if no member has an id); repeated rows give repeated results; an empty
table gives none; other columns are ignored.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caldim.llm.common import prepare, stored, text_of
from caldim.llm.graph import components

#: Generator polynomial of the Golay code: x^11+x^10+x^6+x^5+x^4+x^2+1. Fixed value.
GOLAY_POLYNOMIAL = 0b110001110101
#: Width of the three segments of a fingerprint.
SEGMENTS = (22, 21, 21)
#: Distinct fingerprints compared pairwise at once; larger buckets are split first.
BLOCK = 1024


def fingerprint(text: bytes, shingle: int) -> int:
    """Bit majority of the XXH64 hashes (seed 42) of the word shingles."""
    import xxhash

    words = text.lower().split()  # on bytes: A-Z and \x20\x09-\x0D only
    if not words:
        return 0
    joined, h = b" ".join(words), xxhash.xxh64_intdigest
    if len(words) <= shingle:
        hashes = np.array([h(joined, 42)], np.uint64)
    else:
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
        starts = np.concatenate(([0], ends[:-1] + 1))
        spans = zip(starts[: len(words) - shingle + 1].tolist(), ends[shingle - 1 :].tolist(), strict=True)
        hashes = np.array([h(joined[s:e], 42) for s, e in spans], np.uint64)
    n, counts = len(hashes), np.zeros(64, np.int64)
    for at in range(0, n, 1 << 14):
        part = np.ascontiguousarray(hashes[at : at + (1 << 14)])
        counts += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int32)
    return int(np.packbits(counts * 2 > n, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, shingle: int = 3) -> DataFrame:
    """(doc_id, fp): fp is the fingerprint's 64 bits as a signed long."""
    prepare(docs.sparkSession)
    rows = docs.select("doc_id", text_of().cast("binary").alias("text"))
    schema = rows.select("doc_id", F.lit(0).cast("long").alias("fp")).schema

    def run(batches):
        for b in batches:
            fp = np.array([fingerprint(t.as_py(), shingle) for t in b.column(1)], np.uint64)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fp.view(np.int64))], names=["doc_id", "fp"])

    return rows.mapInArrow(run, schema)


@lru_cache(1)
def golay_tables() -> tuple[np.ndarray, np.ndarray]:
    """For each of the 2048 syndromes: the error patterns of the codewords
    within distance 4 (padded by repeating the first), and how many they are."""
    ones = [1 << i for i in range(23)]
    synd = syndrome(np.array(ones, np.int64)).tolist()
    patterns: list[list[int]] = [[] for _ in range(2048)]
    patterns[0].append(0)
    level = [((i,), ones[i], synd[i]) for i in range(23)]
    for weight in (1, 2, 3, 4):
        for _, p, s in level:
            if weight < 4 or patterns[s][0].bit_count() == 3:
                patterns[s].append(p)
        level = [((*ix, j), p | ones[j], s ^ synd[j]) for ix, p, s in level for j in range(ix[-1] + 1, 23)] if weight < 4 else []
    count = np.array([len(p) for p in patterns])
    table = np.array([p + [p[0]] * (6 - len(p)) for p in patterns], np.int64)
    return table, count


def syndrome(x: np.ndarray) -> np.ndarray:
    """Remainder of 23-bit words by the generator polynomial."""
    r = x.astype(np.int64).copy()
    for bit in range(22, 10, -1):
        r ^= np.where(r >> bit & 1, GOLAY_POLYNOMIAL << (bit - 11), 0)
    return r


def codeword_indices(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each 23-bit word the 12-bit indices of the codewords within
    distance 4: (row number, index) pairs."""
    table, count = golay_tables()
    s = syndrome(x)
    near = (x[:, None] ^ table[s]) >> 11
    use = np.arange(6)[None, :] < count[s][:, None]
    row, col = np.nonzero(use)
    return row, near[row, col]


def keys_of(fp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row number, key) pairs of fingerprints: equal keys for some choice
    whenever two fingerprints differ in at most two bits."""
    u, parts, at = fp.view(np.uint64), [], 0
    for width in SEGMENTS:
        parts.append(((u >> np.uint64(at)) & np.uint64((1 << width) - 1)).astype(np.int64))
        at += width
    rows, keys = [], []
    for c in range(3):
        row, index = codeword_indices(parts[(c + 1) % 3])
        rows.append(row)
        keys.append((c << 34) | (parts[c][row] << 12) | index)
    return np.concatenate(rows), np.concatenate(keys)


def bucket_edges(fp: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Edges (larger, smaller) that connect what is linked within one bucket of
    distinct fingerprints; not every pair, but the same components.

    A bucket over BLOCK is cut again by pigeonhole: for each of max_bits + 1
    slices of the 64 bits, the rows that agree on the slice. A set that no slice
    splits further is compared block by block."""
    n = len(fp)
    if n < 2:
        return fp[:0], fp[:0]
    if n > BLOCK:
        out, width = [], 64 // (max_bits + 1)
        u = fp.view(np.uint64)
        for k in range(max_bits + 1):
            last = k == max_bits
            piece = u >> np.uint64(k * width)
            piece = piece if last else piece & np.uint64((1 << width) - 1)
            order = np.argsort(piece, kind="stable")
            cuts = np.nonzero(np.diff(piece[order]))[0] + 1
            for group in np.split(order, cuts):
                if len(group) > 1:
                    out.append(_block_edges(fp[group], max_bits))
        a, b = (np.concatenate(x) for x in zip(*out, strict=True)) if out else (fp[:0], fp[:0])
        return a, b
    return _block_edges(fp, max_bits)


def _block_edges(fp: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Each fingerprint with the smallest-placed one of its component, for
    every pair of blocks."""
    a, b = [], []
    for i in range(0, len(fp), BLOCK):
        for j in range(i, len(fp), BLOCK):
            if len(fp) > BLOCK and i == j:
                continue  # the block is compared with itself beside every other one
            f = fp[i : i + BLOCK] if i == j else np.concatenate((fp[i : i + BLOCK], fp[j : j + BLOCK]))
            u, label = f.view(np.uint64), np.arange(len(f))
            near = np.bitwise_count(u[:, None] ^ u[None, :]) <= max_bits
            while True:
                new = np.where(near, label[None, :], len(f)).min(1)
                if (new == label).all():
                    break
                label = new
            moved = np.nonzero(label != np.arange(len(f)))[0]
            a.append(f[moved])
            b.append(f[label[moved]])
    return np.concatenate(a), np.concatenate(b)


def links(distinct: DataFrame, max_bits: int = 2) -> DataFrame:
    """(a, b): edges that connect distinct fingerprints (column fp) within
    ``max_bits``. Linear in the keys: each bucket yields at most a few edges
    per row, never all its pairs."""
    if not 0 <= max_bits <= 2:
        raise ValueError("the segment keys cover distances 0, 1 and 2")

    def keys(batches):
        for b in batches:
            fp = b.column(0).to_numpy(zero_copy_only=False)
            row, key = keys_of(fp)
            yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(fp[row])], names=["key", "fp"])

    def verify(batches):
        rest_k, rest_f = np.zeros(0, np.int64), np.zeros(0, np.int64)

        def edges(k, f):
            starts = np.nonzero(np.diff(k, prepend=k[0] - 1 if len(k) else 0))[0]
            ends = np.append(starts[1:], len(k))
            many = ends - starts > 1
            found = [bucket_edges(f[s:e], max_bits) for s, e in zip(starts[many], ends[many], strict=True)]
            a, b = (np.concatenate(x) for x in zip(*found, strict=True)) if found else (f[:0], f[:0])
            return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

        for batch in batches:  # sorted by key: a bucket may go on in the next batch
            k = np.concatenate((rest_k, batch.column(0).to_numpy(zero_copy_only=False)))
            f = np.concatenate((rest_f, batch.column(1).to_numpy(zero_copy_only=False)))
            if not len(k):
                continue
            cut = np.searchsorted(k, k[-1])
            rest_k, rest_f = k[cut:], f[cut:]
            yield edges(k[:cut], f[:cut])
        yield edges(rest_k, rest_f)

    keyed = distinct.select("fp").mapInArrow(keys, "key long, fp long")
    return keyed.repartition("key").sortWithinPartitions("key", "fp").mapInArrow(verify, "a long, b long")


def near_duplicates(docs: DataFrame, shingle: int = 3, max_bits: int = 2) -> DataFrame:
    """(doc_id, fingerprint, component_id) of every document."""
    marks = stored(fingerprints(docs, shingle), "simhash")
    classes = stored(marks.groupBy("fp").agg(F.min("doc_id").alias("first")), "simhash-classes")
    comp = components(links(classes, max_bits), "a", "b").withColumnRenamed("node", "fp")
    # the component's smallest document: over its fingerprints' smallest ones
    rooted = classes.join(comp, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    ids = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    named = rooted.join(ids, "root").select("fp", "component_id")
    return marks.join(named, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )

"""Exact-substring dedup by difference-cover suffix sorting of what can repeat.

Every byte covered by a ``length``-byte string that also starts in a document
with a smaller id is removed. Sorting every suffix of a corpus would shuffle
several times its size, so what must be sorted is found first, by exchanges
between stored blocks of documents (``blocks``), in which a passage that a third
of all documents hold is one entry of each block:

1. Each window of ``length`` bytes is filed under its minimizer, the smallest
   hash among its ``GRAM``-byte substrings. Equal windows have equal minimizers,
   so a minimizer that only one document has rules its windows out.
2. Neighbouring windows with one shared minimizer form a context (the text that
   they cover). Of equal contexts (128 bits of hashes) only the smallest
   document's is left: the others are covered whole by it.
3. A minimizer with one context left is settled. For the others a task builds the
   suffix array of their contexts by the difference cover modulo 3: triples at
   places 1 and 2 mod 3 are sorted and named, the names' suffixes are ranked by
   recursion, the remaining suffixes (place 0) are sorted by their first byte and
   the rank that follows, and both are merged. The recursion ends once names
   cover ``length`` bytes, as no longer prefix is compared. Windows whose
   neighbours in the array share ``length`` bytes are equal; each is covered for
   documents after the smallest one of its run.
4. A minimizer may have any number of contexts (a line that many documents
   continue differently). Beyond ``MOST`` bytes they are too many for one task;
   their windows then go to buckets by hashes of their own.
5. Covered places meet their texts again.

Defined cases: null text is the empty text; a null doc_id counts as larger than
every id (rows without ids are no duplicates of each other); rows that repeat
an id do not make each other duplicates; texts shorter than ``length`` lose
nothing; an empty table gives none; other columns are ignored. A long text is a
block of its own, gone through in slices of ``SLICE`` bytes.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caldim.llm.blocks import (
    LISTS,
    NO_ID,
    Hasher,
    Names,
    Runs,
    Tables,
    answered,
    bits,
    blocks_of,
    buckets_for,
    flags,
    gather,
    ids_of,
    ids_packed,
    kept,
    low,
    mix,
    name_lists,
    owned,
    owned_lists,
    parts,
    repeated,
    rows_of,
    said,
)
from caldim.llm.common import prepare
from caldim.llm.turns import batch

#: Bytes of the substrings among which a window's minimizer is chosen.
GRAM = 20
#: Bytes of the contexts of one minimizer that a task sorts at most.
MOST = 1 << 18
#: Bytes that are hashed, and bytes of contexts that are sorted, at once.
SLICE, SORT = 1 << 17, 1 << 18

__all__ = ["NO_ID", "dedup", "equal_runs", "suffix_ranks"]


def _minimizers(raw: np.ndarray, off: np.ndarray, length: int):
    """(first window, windows, key) of each context of some documents: runs of
    windows with the same minimizer, places in ``raw``."""
    n = len(raw) - length + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
    h = Hasher(raw, 1).all(GRAM)
    width, have = length - GRAM + 1, 1
    while have * 2 <= width:
        h = np.minimum(h[: len(h) - have], h[have:])
        have *= 2
    if have < width:
        h = np.minimum(h[: len(h) - (width - have)], h[width - have :])
    # windows stay within a document
    inside = np.zeros(n + 1, np.int8)
    sizes = np.diff(off) - length + 1
    held = sizes > 0
    inside[off[:-1][held]] += 1
    inside[off[:-1][held] + sizes[held]] -= 1
    inside = np.cumsum(inside[:-1], dtype=np.int8).astype(bool)
    new = inside.copy()
    new[1:] &= (h[1:] != h[:-1]) | ~inside[:-1]
    new[off[:-1][held]] = True
    first = np.nonzero(new)[0]
    ends = np.zeros(n + 1, bool)  # a context ends before the next one, or with its document's windows
    ends[first] = True
    ends[off[:-1][held] + sizes[held]] = True
    stops = np.nonzero(ends)[0]
    return first, stops[np.searchsorted(stops, first, "right")] - first, h[first]


def _slices(off: np.ndarray, length: int):
    """(rows, start, stop, ends) of pieces of a block of about SLICE bytes: some
    texts, or a part of one (neighbours share ``length`` - 1 bytes)."""
    at, n = 0, len(off) - 1
    while at < n:
        to = max(at + 1, int(np.searchsorted(off, off[at] + SLICE, "right")) - 1)
        start, stop = int(off[at]), int(off[to])
        if stop - start <= 2 * SLICE:
            yield start, stop, off[at : to + 1] - start
        else:
            for a in range(start, stop - length + 1, SLICE):
                e = min(stop, a + SLICE + length - 1)
                yield a, e, np.array([0, e - a])
        at = to


def _spread(key: np.ndarray) -> np.ndarray:
    """Minimizers are small numbers; these spread over all buckets alike."""
    return mix(key)


class Contexts:
    """Contexts of a block: first window (place in the block), windows, row, key."""

    def __init__(self, off: np.ndarray, raw: np.ndarray, length: int, second: bool = False):
        found = []
        for start, stop, ends in _slices(off, length):
            part = raw[start:stop]
            first, windows, key = _minimizers(part, ends, length)
            name = Hasher(part, 2).of(first, first + windows + length - 1) if second and len(first) else key
            found.append((first + start, windows, key, name))
        none = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.uint64))]
        self.first, self.windows, self.key, self.name = (np.concatenate(x) for x in zip(*(found or none), strict=True))
        self.row = np.searchsorted(off, self.first, "right") - 1

    def names(self, buckets: int) -> Names:
        return Names(_spread(self.key), self.row, buckets)


def _triple_names(a: np.ndarray, b: np.ndarray, c: np.ndarray, most: int) -> np.ndarray:
    if most >= 1 << 20:
        a, b = np.unique(a * most + b, return_inverse=True)[1], np.zeros_like(a)
        return np.unique(a * most + c, return_inverse=True)[1]
    return np.unique((a * most + b) * most + c, return_inverse=True)[1]


def suffix_ranks(s: np.ndarray, depth: int) -> np.ndarray:
    """Ranks of all suffixes of ``s`` (symbols from 1) by the difference cover
    modulo 3, exact between suffixes whose first ``depth`` symbols differ:
    suffixes that share them hold neighbouring ranks, in no given order."""
    n = len(s)
    t = np.concatenate((s, np.zeros(6, np.int64)))
    most = int(t.max()) + 1
    # both rows of sampled places end with a triple beyond the text, the smallest of all
    one, two, zero = np.arange(1, n + 3, 3), np.arange(2, n + 3, 3), np.arange(0, n, 3)
    sample = np.concatenate((one, two))
    names = _triple_names(t[sample], t[sample + 1], t[sample + 2], most) + 1
    if depth > 3 and names.max() < len(names):
        names = suffix_ranks(names, -(-depth // 3)) + 1
    rank = np.zeros(n + 6, np.int64)
    rank[sample] = names
    high = int(names.max()) + 1
    # a suffix at 0 mod 3 meets one at 1 by (symbol, rank), one at 2 by (symbol, symbol, rank)
    pair = lambda i: _packed(t[i], rank[i + 1], high)
    triple = lambda i: _packed(_packed(t[i], t[i + 1], most), rank[i + 2], high)
    zeros, ones = _Sorted(pair(zero)), _Sorted(pair(one))
    zeros3, twos = _Sorted(triple(zero)), _Sorted(triple(two))
    times = np.bincount(names)
    among = (np.cumsum(times) - times)[names]  # sampled suffixes below each sampled one
    out = np.empty(n + 3, np.int64)
    out[one] = among[: len(one)] + ones.above(zeros)
    out[two] = among[len(one) :] + twos.above(zeros3)
    out[zero] = zeros.above(zeros) + zeros.above(ones) + zeros3.above(twos)
    return out[:n]


class _Sorted:
    """Values with their order, to count merges without random access."""

    def __init__(self, values: np.ndarray):
        self.order = np.argsort(values)
        self.values = values[self.order]

    def above(self, other: "_Sorted") -> np.ndarray:
        """How many of ``other``'s values lie below each value, by place."""
        out = np.empty(len(self.order), np.int64)
        out[self.order] = np.searchsorted(other.values, self.values, "left")
        return out


def _packed(a: np.ndarray, b: np.ndarray, most: int) -> np.ndarray:
    """Numbers in the order of the pairs (a, b), b below ``most``."""
    if (int(a.max()) + 1 if len(a) else 1) * most < 1 << 62:
        return a * most + b
    return a.astype(np.float128) * most + b


def equal_runs(texts: list[bytes], length: int) -> tuple[np.ndarray, np.ndarray]:
    """For the windows of all ``texts`` in order: the run of equal windows that
    each belongs to, and the text that it starts in."""
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    joined = np.frombuffer(b"\0".join(texts) + bytes(length + 3), np.uint8)
    ends = np.cumsum(sizes + 1) - 1
    s = joined.astype(np.int64) + 1
    s[ends] = 0
    rank = suffix_ranks(s, length)
    windows = sizes - length + 1
    owner = np.repeat(np.arange(len(texts)), windows)
    starts = np.arange(len(owner)) - np.repeat(np.cumsum(windows) - windows, windows) + (ends - sizes)[owner]
    order = np.argsort(rank[starts], kind="stable")
    sorted_starts = starts[order]
    new = np.ones(len(order), bool)
    view = np.lib.stride_tricks.sliding_window_view(joined, length)
    for at in range(0, len(order) - 1, 1 << 15):  # adjacent prefixes
        x, y = sorted_starts[at : at + (1 << 15) + 1][:-1], sorted_starts[at : at + (1 << 15) + 1][1:]
        new[at + 1 : at + 1 + len(y)] = (view[x] != view[y]).any(1)
    run = np.empty(len(order), np.int64)
    run[order] = np.cumsum(new) - 1
    return run, owner


def _shared(blocks: DataFrame, length: int, buckets: int) -> DataFrame:
    """Answers to blocks' minimizers: whether other documents have them."""

    def run(batches):
        for b in batches:
            for block, ids, off, raw in zip(*b.columns, strict=True):
                *_, ends = rows_of(ids.as_py(), off.as_py())
                yield name_lists(block.as_py(), Contexts(ends, _bytes(raw), length).names(buckets), 5)

    return gather(blocks.mapInArrow(run, LISTS), repeated(5))


def _bytes(value: pa.Scalar) -> np.ndarray:
    return np.frombuffer(value.as_buffer(), np.uint8) if value.as_buffer().size else np.zeros(0, np.uint8)


_HELD = pa.schema([(c, pa.int64() if c == "block" else pa.binary()) for c in ("block", "ids", "off", "first", "windows", "key", "name")])
HELD = "block long, ids binary, off binary, first binary, windows binary, key binary, name binary"


class Held:
    """Contexts with shared minimizers, as they are stored: first windows by their distance."""

    def __init__(self, ids, off, first, windows, key, name):
        self.owners, _, self.off = rows_of(ids, off)
        self.first, self.windows = np.cumsum(np.frombuffer(first, "<u4").astype(np.int64)), np.frombuffer(windows, "<u4").astype(np.int64)
        self.key, self.name = np.frombuffer(key, "<u8"), np.frombuffer(name, "<u8")
        self.row = np.searchsorted(self.off, self.first, "right") - 1
        self.owner = self.owners[self.row] if len(self.row) else np.zeros(0, np.int64)

    def names(self, buckets: int) -> Names:
        """Distinct contexts; a minimizer's go to buckets by their own hash."""
        return Names(self.key, self.row, buckets, self.name, mix(self.key) ^ self.name)


def _held(blocks: DataFrame, answers: DataFrame, length: int, buckets: int, tables: Tables) -> DataFrame:
    def run(batches):
        for b in batches:
            for block, ids, off, raw, answer in zip(*b.columns, strict=True):
                *_, ends = rows_of(ids.as_py(), off.as_py())
                found = Contexts(ends, _bytes(raw), length, True)
                use = found.names(buckets).spread(said(answer.as_py()))
                first = np.diff(found.first[use], prepend=0).astype("<u4")
                yield batch(
                    [(
                        block.as_py(), ids.as_py(), off.as_py(), first.tobytes(), found.windows[use].astype("<u4").tobytes(),
                        found.key[use].astype("<u8").tobytes(), found.name[use].astype("<u8").tobytes(),
                    )],
                    _HELD,
                )

    return tables.dealt(answered(blocks, answers).select("block", "ids", "off", "raw", "answers").mapInArrow(run, HELD), "contexts")


def _first_owners(held: DataFrame, buckets: int) -> DataFrame:
    """Answers to contexts: whether a smaller document has an equal one."""

    def run(batches):
        for b in batches:
            for block, *rest in zip(*(c.to_pylist() for c in b.columns), strict=True):
                contexts = Held(*rest)
                found = contexts.names(buckets)
                yield owned_lists(block, found, found.least(contexts.owner))

    return gather(held.mapInArrow(run, LISTS), owned)


_LEFT = pa.schema([(c, pa.int64() if c == "block" else pa.binary()) for c in ("block", "gone_a", "gone_b", "at", "windows", "key", "owner")])
LEFT = "block long, gone_a binary, gone_b binary, at binary, windows binary, key binary, owner binary"


def _left(held: DataFrame, answers: DataFrame, length: int, buckets: int, tables: Tables) -> DataFrame:
    """Spans that equal contexts cover whole, and the contexts that are left, the
    smallest documents' ones."""

    def run(batches):
        for b in batches:
            for block, *rest, answer in zip(*(c.to_pylist() for c in b.columns), strict=True):
                contexts = Held(*rest)
                found = contexts.names(buckets)
                least = found.spread(found.least(contexts.owner))
                smaller = found.spread(said(answer, 1))
                gone = smaller | (contexts.owner > least)
                a, e = _merged(contexts.first[gone], contexts.first[gone] + contexts.windows[gone] + length - 1)
                use = ~smaller & (contexts.owner == least)
                yield batch(
                    [(
                        block, a.astype("<i8").tobytes(), e.astype("<i8").tobytes(), contexts.first[use].astype("<i8").tobytes(),
                        contexts.windows[use].astype("<i8").tobytes(), contexts.key[use].astype("<u8").tobytes(), contexts.owner[use].astype("<i8").tobytes(),
                    )],
                    _LEFT,
                )

    return tables.dealt(answered(held, answers).select(*held.columns, "answers").mapInArrow(run, LEFT), "contexts-left")


def _merged(a: np.ndarray, e: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Spans in order of their starts, those that meet as one."""
    order = np.argsort(a, kind="stable")
    a, e = a[order], e[order]
    reach = np.maximum.accumulate(e) if len(e) else e
    new = np.ones(len(a), bool)
    new[1:] = a[1:] > reach[:-1]
    first = np.nonzero(new)[0]
    return a[first], reach[np.append(first[1:], len(a)) - 1] if len(a) else e


class Left:
    """Contexts that are left, as they are stored."""

    def __init__(self, at, windows, key, owner):
        self.at, self.windows = np.frombuffer(at, "<i8"), np.frombuffer(windows, "<i8")
        self.key, self.owner = np.frombuffer(key, "<u8"), np.frombuffer(owner, "<i8")

    def names(self, buckets: int) -> Names:
        return Names(_spread(self.key), np.zeros(len(self.key), np.int64), buckets)


def _crowds(left: DataFrame, length: int, buckets: int) -> DataFrame:
    """Answers to the minimizers of the contexts that are left: whether there are
    two or more, and more bytes of them than a task sorts."""

    def run(batches):
        for b in batches:
            for block, *rest in zip(*(c.to_pylist() for c in b.columns), strict=True):
                contexts = Left(*rest)
                found = contexts.names(buckets)
                count, size = found.times().astype("<i8"), found.total(contexts.windows + length - 1).astype("<i8")
                yield batch(
                    [
                        (block, k, e - a, low(found.names[a:e], 8) + count[a:e].tobytes() + size[a:e].tobytes())
                        for k, a, e in found.lists()
                    ],
                    _LISTS,
                )

    def answer(lists):
        runs = Runs(np.concatenate([np.frombuffer(data, "<u8", n) for n, data in lists]))
        count, size = (
            runs.spread(runs.over(np.add, np.concatenate([np.frombuffer(data, "<i8", n, at * n) for n, data in lists]))) for at in (8, 16)
        )
        return [bits(c > 1) + bits(s > MOST) for c, s in zip(parts(lists, count), parts(lists, size), strict=True)]

    return gather(left.select("block", "at", "windows", "key", "owner").mapInArrow(run, LISTS), answer)


_LISTS = pa.schema([("block", pa.int64()), ("bucket", pa.int64()), ("n", pa.int64()), ("data", pa.binary())])


def _texts(left: DataFrame, crowds: DataFrame, blocks: DataFrame, length: int, buckets: int) -> DataFrame:
    """LISTS of the contexts to be compared, packed with their texts (kind 0), or
    those of crowded minimizers by the names of their windows (kind 1)."""

    def run(batches):
        for b in batches:
            for block, *rest, answer, raw in zip(*b.columns, strict=True):
                block, raw = block.as_py(), _bytes(raw)
                contexts = Left(*(x.as_py() for x in rest))
                found = contexts.names(buckets)
                answer = answer.as_py()
                several, crowd = found.spread(said(answer)), found.spread(said(answer, 1))
                out = []
                use = np.nonzero(several & ~crowd)[0]
                bucket = (contexts.key[use] % np.uint64(buckets)).astype(np.int64)
                order = np.lexsort((contexts.at[use], contexts.key[use], bucket))
                use, bucket = use[order], bucket[order]
                cuts = np.concatenate(([0], np.nonzero(np.diff(bucket))[0] + 1, [len(use)]))
                for x, y in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
                    if y > x:
                        mine = use[x:y]
                        sizes = (contexts.windows[mine] + length - 1).astype("<u4")
                        texts = b"".join(raw[p : p + n].tobytes() for p, n in zip(contexts.at[mine].tolist(), sizes.tolist(), strict=True))
                        data = low(contexts.key[mine], 8) + ids_packed(contexts.owner[mine]) + contexts.at[mine].astype("<i8").tobytes()
                        out.append((0, block, int(bucket[x]), y - x, data + sizes.tobytes() + texts))
                for k, bucket, n, data in zip(*_window_lists(contexts, crowd, raw, block, length, buckets), strict=True):
                    out.append((1, k, bucket, n, data))
                yield batch(out, pa.schema([("kind", pa.int32()), *_LISTS]))

    rows = answered(left.select("block", "at", "windows", "key", "owner"), crowds).join(blocks.select("block", "raw"), "block")
    rows = rows.select("block", "at", "windows", "key", "owner", "answers", "raw")
    return kept(rows.mapInArrow(run, "kind int, " + LISTS), "context-texts")


def _windows_of(contexts: Left, crowd: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places and owners of the windows of some contexts."""
    use = np.nonzero(crowd)[0]
    times = contexts.windows[use]
    ends = np.cumsum(times)
    places = np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(contexts.at[use] - (ends - times), times)
    return places, np.repeat(contexts.owner[use], times)


def _window_names(contexts: Left, crowd: np.ndarray, raw: np.ndarray, length: int, buckets: int):
    places, owner = _windows_of(contexts, crowd)
    first, second = np.empty(len(places), np.uint64), np.empty(len(places), np.uint64)
    view = np.lib.stride_tricks.sliding_window_view(raw, length) if len(raw) >= length else raw.reshape(0, 1)
    for at in range(0, len(places), 1 << 14):
        texts = np.ascontiguousarray(view[places[at : at + (1 << 14)]]).reshape(-1)
        starts = np.arange(len(texts) // length) * length
        for seed, out in ((3, first), (4, second)):
            out[at : at + len(starts)] = Hasher(texts, seed).of(starts, starts + length)
    return places, owner, Names(first, np.zeros(len(places), np.int64), buckets, second)


def _window_lists(contexts: Left, crowd: np.ndarray, raw: np.ndarray, block: int, length: int, buckets: int) -> list:
    if not crowd.any():
        return [[], [], [], []]
    _, owner, found = _window_names(contexts, crowd, raw, length, buckets)
    return [c.to_pylist() for c in owned_lists(block, found, found.least(owner)).columns]


def covered(keys: np.ndarray, owners: np.ndarray, texts: list[bytes], length: int) -> list[tuple[int, int, int]]:
    """(context, from, to): bytes of contexts that windows of others with smaller
    owners cover. Contexts come by key; those of one key can have equal windows."""
    out: list[tuple[int, int, int]] = []
    cuts = np.concatenate((np.nonzero(np.concatenate(([True], keys[1:] != keys[:-1])))[0], [len(keys)])).tolist()
    at, size, group = 0, 0, 0
    for group in range(len(cuts) - 1):
        size += sum(len(t) for t in texts[cuts[group] : cuts[group + 1]])
        if size > SORT or group == len(cuts) - 2:
            low_, high_ = cuts[at], cuts[group + 1]
            out += [(c + low_, a, e) for c, a, e in _covered(owners[low_:high_], texts[low_:high_], length)]
            at, size = group + 1, 0
    return out


def _covered(owners: np.ndarray, texts: list[bytes], length: int) -> list[tuple[int, int, int]]:
    run, owner = equal_runs(texts, length)
    mine = owners[owner]
    least = np.full(run.max() + 1, NO_ID, np.int64)
    np.minimum.at(least, run, mine)
    dup = least[run] < mine
    begin = np.searchsorted(owner, np.arange(len(texts)))
    # runs of covered windows within a context
    start, stop = dup.copy(), dup.copy()
    same = owner[1:] == owner[:-1]
    start[1:] &= ~(dup[:-1] & same)
    stop[:-1] &= ~(dup[1:] & same)
    a, e = np.nonzero(start)[0], np.nonzero(stop)[0]
    at = begin[owner[a]]
    return list(zip(owner[a].tolist(), (a - at).tolist(), (e - at + length).tolist(), strict=True))


def _sorted(texts: DataFrame, length: int) -> DataFrame:
    """Answers to packed contexts: covered spans (places in the block)."""

    def answer(lists):
        keys, owners, places, texts, which = [], [], [], [], []
        for k, (n, data) in enumerate(lists):
            keys.append(np.frombuffer(data, "<u8", n))
            ids, at = ids_of(data, n, 8 * n)
            owners.append(ids)
            places.append(np.frombuffer(data, "<i8", n, at))
            ends = np.cumsum(np.frombuffer(data, "<u4", n, at + 8 * n).astype(np.int64)) + at + 12 * n
            texts += [data[a:e] for a, e in zip([at + 12 * n, *ends[:-1].tolist()], ends.tolist(), strict=True)]
            which.append(np.full(n, k))
        keys, owners, places, which = (np.concatenate(x) for x in (keys, owners, places, which))
        order = np.argsort(keys, kind="stable")
        found = covered(keys[order], owners[order], [texts[i] for i in order.tolist()], length)
        spans: list[list] = [[] for _ in lists]
        for c, a, e in found:
            i = order[c]
            spans[which[i]].append((int(places[i]) + a, int(places[i]) + e))
        return [np.array(s, "<i8").reshape(-1, 2).tobytes() for s in spans]

    return gather(texts.filter("kind = 0").drop("kind"), answer)


def dedup(docs: DataFrame, length: int = 50, keep_text: bool = False) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) of every document;
    with ``keep_text`` also kept, the remaining bytes."""
    if length < GRAM:
        raise ValueError(f"strings have {GRAM} bytes at least")
    prepare(docs.sparkSession)
    with Tables(docs.sparkSession) as tables:
        out = _deduped(docs, length, keep_text, tables)
    kind = docs.schema["doc_id"].dataType.simpleString()
    return out.select(F.col("o").cast(kind).alias("doc_id"), "n_bytes", "n_removed", "n_spans", "kept_sha256", *(["kept"] if keep_text else []))


def _deduped(docs: DataFrame, length: int, keep_text: bool, tables: Tables) -> DataFrame:
    blocks = blocks_of(docs, tables)
    buckets = buckets_for(blocks)
    held = _held(blocks, _shared(blocks, length, buckets), length, buckets, tables)
    left = _left(held, _first_owners(held, buckets), length, buckets, tables)
    crowds = _crowds(left, length, buckets)
    texts = _texts(left, crowds, blocks, length, buckets)
    sorted_spans = _sorted(texts, length)
    windows = gather(texts.filter("kind = 1").drop("kind"), owned)
    both = answered(answered(left, crowds, "crowds"), windows, "windows_said")
    spans = sorted_spans.groupBy("block").agg(F.collect_list("data").alias("spans"))
    both = blocks.join(both.join(spans.hint("shuffle_hash"), "block", "left"), "block")
    both = both.select("ids", "off", "raw", "gone_a", "gone_b", "at", "windows", "key", "owner", "crowds", "windows_said", "spans")
    schema = pa.schema([
        ("o", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string()),
        ("kept", pa.binary()),
    ])

    def run(batches):
        for b in batches:
            for ids, off, raw, gone_a, gone_b, *rest, crowd, answers, spans in zip(*b.columns, strict=True):
                owners, none, ends = rows_of(ids.as_py(), off.as_py())
                raw = _bytes(raw)
                found = [np.stack([np.frombuffer(x.as_py(), "<i8") for x in (gone_a, gone_b)], 1)]
                found += [np.frombuffer(s, "<i8").reshape(-1, 2) for s in spans.as_py() or ()]
                answers = answers.as_py()
                if answers:
                    contexts = Left(*(x.as_py() for x in rest))
                    many = contexts.names(buckets).spread(said(crowd.as_py(), 1))
                    places, owner, names = _window_names(contexts, many, raw, length, buckets)
                    gone = names.spread(said(answers, 1)) | (owner > names.spread(names.least(owner)))
                    found.append(np.stack((places[gone], places[gone] + length), 1))
                yield batch(list(_digests(raw, ends, owners, none, np.concatenate(found), keep_text)), schema)

    ddl = "o long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary"
    return kept(both.mapInArrow(run, ddl), "kept-bytes")


def _digests(raw, off, owners, none, spans, keep_text):
    change = np.zeros(len(raw) + 1, np.int64)
    np.add.at(change, spans[:, 0], 1)
    np.add.at(change, spans[:, 1], -1)
    gone = np.cumsum(change[:-1]) > 0
    start = gone.copy()
    start[1:] &= ~gone[:-1]
    inner = off[:-1][(off[:-1] < len(raw)) & (np.diff(off) > 0)]
    start[inner] = gone[inner]
    removed = np.concatenate(([0], np.cumsum(gone, dtype=np.int64)))[off]
    runs = np.concatenate(([0], np.cumsum(start, dtype=np.int64)))[off]
    rest, at = raw[~gone].tobytes(), 0
    for k in range(len(owners)):
        size, lost = int(off[k + 1] - off[k]), int(removed[k + 1] - removed[k])
        text = rest[at : at + size - lost]
        at += size - lost
        yield (
            None if none[k] else int(owners[k]), size, lost, int(runs[k + 1] - runs[k]), hashlib.sha256(text).hexdigest(),
            text if keep_text else None,
        )

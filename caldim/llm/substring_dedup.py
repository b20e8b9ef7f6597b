"""Substring dedup by level-wise doubling of repeated word windows.

Every word covered by a window of ``length`` words whose words also stand in a
row with a smaller id is removed. Windows grow: only those that repeat at one
length are extended, first from half of ``length`` to ``length``, which decides
what goes, then to twice that and so on until no window repeats any more, which
tells how long each row's longest repeated passage is.

Rows are first put into blocks of about ``BLOCK`` bytes, stored, so that a
window is known by its place in a block. One level is one exchange:

1. A block names its candidates (hashes of their words) and sends each distinct
   name once, packed by bucket of the name, with a mark on those that several of
   its rows have. A passage in a third of all rows costs one name a block.
2. A bucket gathers what repeats and answers each block with a bit per name.
3. Blocks meet their answers; windows that repeat and whose continuation repeats
   too are candidates of the next length.

The first level sends five bytes a window and only prunes, so that a hash that
two windows share does no harm. At ``length`` names have 96 bits, which decide
equality, and carry the smallest id that a block has for them. Later levels work
on the names of that one, without any text: a window of twice the length is named
by those of its parts.

Words are runs of bytes other than space and x09 to x0D. Defined cases: null
text has no words; a null doc_id counts as larger than every id (rows without
ids remove nothing from each other); rows that repeat an id remove nothing from
each other, but count as rows where passages repeat; rows with fewer words than a window lose nothing;
an empty table gives none; other columns are ignored. A long text is a block of
its own; a task holds some 15 bytes for each byte of it.
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
    Tables,
    answered,
    bits,
    blocks_of,
    buckets_for,
    flags,
    gather,
    join,
    kept,
    mix,
    name_lists,
    note,
    owned,
    owned_lists,
    powers,
    repeated,
    rows_of,
    said,
)
from caldim.llm.common import prepare
from caldim.llm.turns import batch

#: Bytes that are hashed at once.
CHUNK = 1 << 17
_WHITE = np.zeros(256, bool)
_WHITE[[0x20, *range(0x09, 0x0E)]] = True

__all__ = ["NO_ID", "dedup", "oracle_sql"]


class Words:
    """Places of the words of a block's rows."""

    def __init__(self, raw: np.ndarray, off: np.ndarray):
        self.raw = raw
        shown = ~_WHITE[raw]
        edge = np.zeros(len(raw) + 1, bool)  # a row's first byte begins a word
        edge[off] = True
        begin, end = shown.copy(), shown.copy()
        begin[1:] &= ~shown[:-1] | edge[1:-1]
        end[:-1] &= ~shown[1:] | edge[1:-1]
        self.starts, self.stops = np.nonzero(begin)[0], np.nonzero(end)[0] + 1
        cuts = np.searchsorted(self.starts, off)
        self.counts = np.diff(cuts)
        self.row = np.repeat(np.arange(len(off) - 1), self.counts)
        self.last = cuts[1:][self.row]  # behind the last word of its row

    def hashes(self, seed: int) -> np.ndarray:
        out, n, at = np.empty(len(self.starts), np.uint64), len(self.starts), 0
        while at < n:
            first = self.starts[at]
            to = max(at + 1, int(np.searchsorted(self.stops, first + CHUNK, "right")))
            part = Hasher(self.raw[first : self.stops[to - 1]], seed)
            out[at:to] = part.of(self.starts[at:to] - first, self.stops[at:to] - first)
            at = to
        return out


def windows(h: np.ndarray, length: int) -> np.ndarray:
    """Names of all runs of ``length`` neighbours, by doubling."""
    sized, size, out, have = h, 1, None, 0
    while True:
        if length & size:
            if out is None:
                out = sized
            else:
                n = max(0, len(h) - have - size + 1)
                out = join(out[:n], sized[have : have + n])
            have += size
        if have == length:
            return out
        n = max(0, len(h) - 2 * size + 1)
        sized, size = join(sized[:n], sized[size : size + n]), 2 * size


def _read(ids: bytes, off: bytes, raw: bytes) -> tuple[np.ndarray, np.ndarray, Words]:
    owners, none, ends = rows_of(ids, off)
    return owners, none, Words(np.frombuffer(raw, np.uint8), ends)


def _fits(words: Words, length: int) -> np.ndarray:
    """Words at which a window of their row begins."""
    return np.arange(len(words.row)) + length <= words.last


def _first_names(words: Words, half: int, buckets: int) -> tuple[np.ndarray, np.ndarray, Names]:
    """Places of the first level's windows, their names, and these made distinct."""
    h = windows(words.hashes(1), half)
    at = np.nonzero(_fits(words, half))[0]
    return at, h, Names(h[at], words.row[at], buckets)


def _first_level(blocks: DataFrame, half: int, buckets: int) -> DataFrame:
    def run(batches):
        for b in batches:
            for block, ids, off, raw in zip(*b.columns, strict=True):
                *_, words = _read(ids.as_py(), off.as_py(), raw.as_py())
                *_, found = _first_names(words, half, buckets)
                yield name_lists(block.as_py(), found, 5)

    return gather(blocks.mapInArrow(run, LISTS), repeated(5))


_CANDIDATES = pa.schema([(c, pa.int64() if c in ("block", "n") else pa.binary()) for c in ("block", "n", "ids", "counts", "at", "first", "second")])
CANDIDATES = "block long, n long, ids binary, counts binary, at binary, first binary, second binary"


def _candidates(blocks: DataFrame, answers: DataFrame, length: int, buckets: int, tables: Tables) -> DataFrame:
    """Windows of ``length`` words whose two halves repeat: a bit for each word
    of a block, and the windows' names."""
    half, step = (length + 1) // 2, length // 2

    def run(batches):
        for b in batches:
            for block, ids, off, raw, answers in zip(*b.columns, strict=True):
                owners, _, words = _read(ids.as_py(), off.as_py(), raw.as_py())
                at, h, found = _first_names(words, half, buckets)
                repeats = np.zeros(len(words.row) + step, bool)
                repeats[at] = found.spread(said(answers.as_py()))
                use = repeats[: len(words.row)] & repeats[step:] & _fits(words, length)
                where = np.nonzero(use)[0]
                g = windows(words.hashes(2), half)
                second = join(g[where + step], g[where]) & np.uint64(0xFFFFFFFF)
                yield batch(
                    [(
                        block.as_py(), len(where), owners.tobytes(), words.counts.astype("<i8").tobytes(), bits(use),
                        join(h[where], h[where + step]).astype("<u8").tobytes(), second.astype("<u4").tobytes(),
                    )],
                    _CANDIDATES,
                )

    rows = answered(blocks, answers).select("block", "ids", "off", "raw", "answers")
    return tables.dealt(rows.mapInArrow(run, CANDIDATES), "candidates")


class Held:
    """Candidates of a block as ``_candidates`` stores them."""

    def __init__(self, counts, at, first, ids=b"", second=b""):
        self.owners, self.counts = np.frombuffer(ids, np.int64), np.frombuffer(counts, "<i8")
        self.words = int(self.counts.sum())
        held = flags(at, self.words)
        self.where = np.nonzero(held)[0]
        self.first, self.second = np.frombuffer(first, "<u8"), np.frombuffer(second, "<u4").astype(np.uint64)
        self.row = np.repeat(np.arange(len(self.counts)), self.counts)[held]

    def names(self, buckets: int) -> Names:
        return Names(self.first, self.row, buckets, self.second)


#: What the levels need of the candidates, and what the decision needs.
_NAMED = ["block", "counts", "at", "first"]
_HELD = [*_NAMED, "ids", "second"]


def _decide(candidates: DataFrame, buckets: int) -> DataFrame:
    """Answers to the names at the length that decides."""

    def run(batches):
        for b in batches:
            for block, *held in zip(*(c.to_pylist() for c in b.columns), strict=True):
                held = Held(*held)
                found = held.names(buckets)
                yield owned_lists(block, found, found.least(held.owners[held.row]))

    return gather(candidates.select(*_HELD).mapInArrow(run, LISTS), owned)


_STATE = pa.schema([("block", pa.int64()), ("alive", pa.binary()), ("gone", pa.binary())])


def _decided(candidates: DataFrame, answers: DataFrame, length: int, buckets: int) -> DataFrame:
    """(block, alive, gone): windows that repeat, a bit for each candidate, and
    words that go, a bit for each word."""

    def run(batches):
        for b in batches:
            out = []
            for block, *held, answers in zip(*(c.to_pylist() for c in b.columns), strict=True):
                held = Held(*held)
                found = held.names(buckets)
                owner = held.owners[held.row]
                alive = found.spread(said(answers))
                gone = found.spread(said(answers, 1)) | (owner > found.spread(found.least(owner)))
                cover = np.zeros(held.words + 1, np.int8)
                cover[held.where[gone]] += 1
                cover[held.where[gone] + length] -= 1
                out.append((block, bits(alive), bits(np.cumsum(cover[:-1], dtype=np.int32) > 0)))
            yield batch(out, _STATE)

    rows = answered(candidates, answers).select(*_HELD, "answers")
    return kept(rows.mapInArrow(run, "block long, alive binary, gone binary"), "decided")


class Ladder:
    """Names of the windows of doubled lengths: sums of the names of windows
    ``length`` words apart, times powers, so that any length takes one step."""

    def __init__(self, held: Held, length: int):
        self.held, self.length = held, length
        rows = -(-held.words // length) + 1
        known = np.zeros(rows * length, np.uint64)
        known[held.where] = held.first
        sums = np.zeros((rows + 1, length), np.uint64)
        np.cumsum(known.reshape(rows, length) * powers(5, rows)[:, None], axis=0, out=sums[1:])
        self.sums, self.back = sums.reshape(-1), powers(-5, rows + 1)

    def candidates(self, alive: np.ndarray, size: int) -> np.ndarray:
        """Numbers of the candidates that begin a window of twice ``size`` words
        whose halves repeat; ``alive`` marks those whose windows of ``size`` do."""
        held = self.held
        lives = np.zeros(held.words + size, bool)
        lives[held.where[alive]] = True
        end = np.cumsum(held.counts)[held.row]
        return np.nonzero(alive & lives[held.where + size] & (held.where + 2 * size <= end))[0]

    def names(self, which: np.ndarray, size: int, buckets: int) -> Names:
        at = self.held.where[which]
        return Names(mix((self.sums[at + size] - self.sums[at]) * self.back[at // self.length]), self.held.row[which], buckets)


def _climb(candidates: DataFrame, known: DataFrame, length: int, size: int, buckets: int) -> DataFrame:
    """Answers to the names of the windows of twice ``size`` words, and each
    block's note: for ``size`` words, which candidates repeat (n: how many) and
    for each row how many lengths it has reached. ``known`` are the same for the
    length before, or at first the state after the decision; blocks in which
    nothing repeated are not gone through again."""
    first = size == length

    def run(batches):
        for b in batches:
            for block, *held, before in zip(*(c.to_pylist() for c in b.columns), strict=True):
                held = Held(*held)
                n, ladder = len(held.where), Ladder(held, length)
                if first:
                    alive, reached = flags(before, n), np.zeros(len(held.counts), np.uint8)
                else:
                    (own,) = (a["data"] for a in before if a["bucket"] < 0)
                    reached = np.frombuffer(own, np.uint8, len(held.counts)).copy()
                    which = ladder.candidates(flags(own, n, len(reached)), size // 2)
                    alive = np.zeros(n, bool)
                    alive[which] = ladder.names(which, size, buckets).spread(said(before))
                reached[held.row[alive]] += 1
                yield note(block, int(alive.sum()), reached.tobytes() + bits(alive))
                yield name_lists(block, ladder.names(ladder.candidates(alive, size), 2 * size, buckets), 8)

    if first:
        rows = candidates.join(known.select("block", "alive").hint("shuffle_hash"), "block").select(*_NAMED, "alive")
    else:
        rows = answered(candidates, known.filter("bucket >= 0 or n > 0"), how="inner").select(*_NAMED, "answers")
    return gather(rows.mapInArrow(run, LISTS), repeated(8))


def dedup(docs: DataFrame, length: int = 13, keep_text: bool = False) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256, longest): longest is the number
    of words of the longest window that another row has too, of those of length
    ``length``, twice that and so on (0: none); with ``keep_text`` also kept, the
    remaining words joined by a space."""
    if length < 2:
        raise ValueError("windows have two words at least")
    prepare(docs.sparkSession)
    with Tables(docs.sparkSession) as tables:
        out = _deduped(docs, length, keep_text, tables)
    kind = docs.schema["doc_id"].dataType.simpleString()
    rest = [F.col("kept").cast("string").alias("kept")] if keep_text else []
    return out.select(F.col("o").cast(kind).alias("doc_id"), "n_words", "n_removed", "kept_sha256", "longest", *rest)


def _deduped(docs: DataFrame, length: int, keep_text: bool, tables: Tables) -> DataFrame:
    blocks = blocks_of(docs, tables)
    buckets = buckets_for(blocks)
    first = _first_level(blocks, (length + 1) // 2, buckets)
    candidates = _candidates(blocks, first, length, buckets, tables)
    decided = _decided(candidates, _decide(candidates, buckets), length, buckets)
    size, known = length, _climb(candidates, decided, length, length, buckets)
    last = "bucket < 0 and n = 0"  # a block's last note
    notes = known.filter(last)
    while not known.filter("bucket < 0 and n > 0").isEmpty():
        size *= 2
        known = _climb(candidates, known, length, size, buckets)
        notes = notes.unionByName(known.filter(last))
    notes = notes.select("block", F.col("data").alias("note"))
    both = blocks.join(decided.select("block", "gone").hint("shuffle_hash"), "block").join(notes.hint("shuffle_hash"), "block")
    schema = pa.schema([
        ("o", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_sha256", pa.string()), ("longest", pa.int64()),
        ("kept", pa.binary()),
    ])

    def run(batches):
        for b in batches:
            for ids, off, raw, gone, own in zip(*b.columns, strict=True):
                owners, none, words = _read(ids.as_py(), off.as_py(), raw.as_py())
                n, rows = len(words.row), len(owners)
                gone = flags(gone.as_py(), n)
                reached = np.frombuffer(own.as_py(), np.uint8, rows).astype(np.int64)
                longest = np.where(reached > 0, length << np.maximum(reached - 1, 0), 0)
                removed = np.bincount(words.row[gone], minlength=rows)
                out = []
                for k, text in enumerate(_kept(words, ~gone, rows)):
                    out.append((
                        None if none[k] else int(owners[k]), int(words.counts[k]), int(removed[k]), hashlib.sha256(text).hexdigest(),
                        int(longest[k]), text if keep_text else None,
                    ))
                yield batch(out, schema)

    rows = both.select("ids", "off", "raw", "gone", "note")
    ddl = "o long, n_words long, n_removed long, kept_sha256 string, longest long, kept binary"
    return kept(rows.mapInArrow(run, ddl), "kept-words")


def _kept(words: Words, keep: np.ndarray, rows: int):
    """For each row its kept words, joined by a space: their bytes, and the byte
    behind each but a row's last, made a space."""
    starts, stops, row = words.starts[keep], words.stops[keep], words.row[keep]
    more = np.zeros(len(row), bool)
    more[:-1] = row[1:] == row[:-1]
    ends = stops + more
    change = np.zeros(len(words.raw) + 2, np.int8)
    change[starts] += 1
    change[ends] -= 1
    use = np.cumsum(change[: len(words.raw)], dtype=np.int8).astype(bool)
    text = words.raw.copy()
    text[stops[more]] = 0x20
    data = text[use].tobytes()
    sizes = np.bincount(row, ends - starts, rows).astype(np.int64)
    at = 0
    for n in sizes.tolist():
        yield data[at : at + n]
        at += n


def oracle_sql(length: int = 13) -> str:
    """The digest of ``dedup`` by all windows as joined words, those of doubled
    lengths in rows that have one of the length before."""
    return f"""
    WITH RECURSIVE words AS (
      SELECT doc_id, row_number() OVER () AS r, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w
      FROM documents),
    starts AS (
      SELECT doc_id, r, unnest(range(1, greatest(len(w) - {length} + 2, 1))) AS i, w FROM words),
    named AS (SELECT doc_id, r, i, md5(array_to_string(w[i:i + {length - 1}], ' ')) AS k FROM starts),
    gone AS (
      SELECT DISTINCT r, unnest(range(i, i + {length})) AS i
      FROM (SELECT doc_id, r, i, min(doc_id) OVER (PARTITION BY k) AS least FROM named) WHERE least < doc_id),
    cut AS (SELECT r, list(i) AS cut FROM gone GROUP BY r),
    levels AS (
      SELECT r, i, {length} AS size FROM (SELECT r, i, min(r) OVER w AS a, max(r) OVER w AS b FROM named WINDOW w AS (PARTITION BY k)) WHERE a <> b
      UNION ALL
      SELECT r, i, 2 * size FROM (
        SELECT r, i, size, min(r) OVER n AS a, max(r) OVER n AS b FROM (
          SELECT l.r, l.i, l.size, md5(array_to_string(d.w[l.i:l.i + 2 * l.size - 1], ' ')) AS k
          FROM levels l JOIN words d USING (r) WHERE l.i + 2 * l.size - 1 <= len(d.w))
        WINDOW n AS (PARTITION BY k)) WHERE a <> b),
    reach AS (SELECT r, max(size) AS longest FROM levels GROUP BY r)
    SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(len(cut), 0) AS BIGINT) AS n_removed,
           sha256(array_to_string(CASE WHEN cut IS NULL THEN w
             ELSE list_transform(list_filter(range(1, len(w) + 1), lambda i: NOT list_contains(cut, i)), lambda i: w[i]) END, ' ')) AS kept_sha256,
           CAST(coalesce(longest, 0) AS BIGINT) AS longest
    FROM words d LEFT JOIN cut USING (r) LEFT JOIN reach USING (r)"""

"""Documents in stored blocks, and exchanges of packed names between them.

A block is some rows' texts, ids and ends, stored once, so that a place in a
block means the same in every later pass, and dealt to buckets of a table by block. What blocks have in common is found by
an exchange: each block packs its distinct names (hashes) into one list for each
bucket; a bucket gathers the lists of all blocks and answers each of them in the
order of its names; a block meets its answers again. A name that a third of all
rows hold is one entry for each block that has it, so no bucket outgrows the others.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caldim.llm.common import CLEANUP, settings, stored, text_of, utf8
from caldim.llm.turns import batch, partitions
from caldim.session import work_dir

#: Bytes of text in a block, bytes of text whose names a bucket gathers, bytes of an Arrow batch.
BLOCK, BUCKET, BATCH = 1 << 20, 8 << 20, 8 << 20
NO_ID = (1 << 63) - 1

_BLOCKS = pa.schema([("block", pa.int64()), ("ids", pa.binary()), ("off", pa.binary()), ("raw", pa.binary())])
_LISTS = pa.schema([("block", pa.int64()), ("bucket", pa.int64()), ("n", pa.int64()), ("data", pa.binary())])
LISTS = "block long, bucket long, n long, data binary"


def kept(df: DataFrame, name: str) -> DataFrame:
    """``stored`` with batches of some blocks at a time, as rows are large."""
    with settings(df.sparkSession, {"spark.sql.execution.arrow.maxBytesPerBatch": str(BATCH)}):
        return stored(df, name)


class Tables:
    """Tables of blocks dealt by block, so that answers come to them and they are
    not shuffled again. They are known to the session until ``close``; their files
    lie in the shared work folder like all others."""

    def __init__(self, spark: SparkSession):
        self.spark, self.names = spark, []

    def dealt(self, df: DataFrame, name: str) -> DataFrame:
        n = partitions(df)
        path = work_dir(self.spark, name)
        self.names.append(f"caldim_{name.replace('-', '_')}_{path[-12:]}")
        with settings(self.spark, {"spark.sql.execution.arrow.maxBytesPerBatch": str(BATCH), CLEANUP: "true"}):
            spread = df.repartition(n, "block").write.bucketBy(n, "block").option("path", path).option("compression", "zstd")
            spread.format("parquet").saveAsTable(self.names[-1])
        return self.spark.table(self.names[-1])

    def __enter__(self) -> Tables:
        return self

    def __exit__(self, *_) -> None:
        for name in self.names:
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")


def blocks_of(docs: DataFrame, tables: Tables) -> DataFrame:
    """(block, ids, off, raw) of documents: ids (and whether they are null), ends
    of the texts, texts. A long text is a block of its own."""
    rows = docs.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("o"), F.col("doc_id").isNull().alias("none"), text_of().alias("text")
    )

    def run(batches):
        number, held, size = TaskContext.get().partitionId() << 33, [], 0

        def block():
            ids, none, off, raw = (np.concatenate(x) for x in zip(*held, strict=True))
            off = np.concatenate(([0], np.cumsum(off)))
            return number, ids.tobytes() + none.tobytes(), off.tobytes(), raw.tobytes()

        for b in batches:
            ids = b.column(0).to_numpy(zero_copy_only=False)
            none = b.column(1).to_numpy(zero_copy_only=False)
            raw, off = utf8(b.column(2))
            at, n = 0, len(ids)
            while at < n:
                to = max(at + 1, int(np.searchsorted(off, off[at] + BLOCK - size, "right")) - 1)
                held.append((ids[at:to], none[at:to], np.diff(off[at : to + 1]), raw[off[at] : off[to]].copy()))
                size += int(off[to] - off[at])
                at = to
                if size >= BLOCK or at < n:
                    yield batch([block()], _BLOCKS)
                    number, held, size = number + 1, [], 0
        if held:
            yield batch([block()], _BLOCKS)

    return tables.dealt(rows.mapInArrow(run, "block long, ids binary, off binary, raw binary"), "blocks")


def buckets_for(blocks: DataFrame) -> int:
    """Buckets, by the bytes of all texts."""
    total = blocks.agg(F.sum(F.length("raw"))).first()[0] or 0
    return max(partitions(blocks), total // BUCKET)


def rows_of(ids: bytes, off: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ids, whether they are null, and ends of a block's texts."""
    ends = np.frombuffer(off, np.int64)
    n = len(ends) - 1
    return np.frombuffer(ids, np.int64, n), np.frombuffer(ids, bool, n, 8 * n), ends


# --- hashes -------------------------------------------------------------------


def mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(31))
    x *= np.uint64(0x7FB5D329728EA185)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x81DADEF4BC2DD44D)
    x ^= x >> np.uint64(33)
    return x


def join(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Names of windows from those of two parts."""
    return mix(a * np.uint64(0x9E3779B97F4A7C15) + b)


_POWERS: dict[int, np.ndarray] = {}


def powers(seed: int, n: int) -> np.ndarray:
    """The first powers of an odd number modulo 2 ** 64; of its inverse for a
    negative seed."""
    if seed not in _POWERS or len(_POWERS[seed]) < n:
        base = 6364136223846793005 + 8 * abs(seed)
        steps = np.full(max(n, 1 << 16), base if seed > 0 else pow(base, -1, 1 << 64), np.uint64)
        steps[0] = 1
        _POWERS[seed] = np.multiply.accumulate(steps)
    return _POWERS[seed][:n]


class Hasher:
    """Hashes of any ranges of a byte string, equal wherever equal bytes stand:
    sums of byte values times powers of an odd number modulo 2 ** 64, with the
    power of the first place taken off."""

    def __init__(self, raw: np.ndarray, seed: int):
        rng = np.random.default_rng(seed)
        table = rng.integers(0, 1 << 63, 256, np.uint64) * np.uint64(2) + np.uint64(1)
        self.back = powers(-seed, len(raw) + 1)
        self.total = np.zeros(len(raw) + 1, np.uint64)
        values = table[raw]
        values *= powers(seed, len(raw))
        np.cumsum(values, out=self.total[1:])

    def of(self, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
        return mix((self.total[stops] - self.total[starts]) * self.back[starts] + (stops - starts).astype(np.uint64))

    def all(self, length: int) -> np.ndarray:
        """Of every range of ``length`` bytes."""
        n = len(self.total) - length
        x = self.total[length:] - self.total[:n] if n > 0 else np.zeros(0, np.uint64)
        x *= self.back[: len(x)]
        return mix(x)


# --- names and lists ----------------------------------------------------------


class Names:
    """Distinct names of some places, in the order of their buckets. ``row`` is
    each place's row; ``several``: names that different rows have."""

    def __init__(self, names: np.ndarray, row: np.ndarray, buckets: int, second: np.ndarray | None = None, by: np.ndarray | None = None):
        """Names are equal where ``second`` is too; buckets are ranges of ``by`` or
        of the names. (Should ``by`` tie for different names, a name may come
        twice; buckets compare names whole.)"""
        place = names if by is None else by
        self.order = np.argsort(place)
        names, row = names[self.order], row[self.order]
        new = np.ones(len(names), bool)
        new[1:] = names[1:] != names[:-1]
        if second is not None:
            second = second[self.order]
            new[1:] |= second[1:] != second[:-1]
        self.first = np.nonzero(new)[0]
        self.run = np.cumsum(new) - 1
        self.names, self.second = names[self.first], None if second is None else second[self.first]
        self.several = self.least(row, True) != self.most(row, True)
        at = place[self.order[self.first]] >> np.uint64(32)
        self.bucket = ((at * np.uint64(buckets)) >> np.uint64(32)).astype(np.int64)
        self.cuts = np.concatenate(([0], np.nonzero(np.diff(self.bucket))[0] + 1, [len(self.first)]))

    def least(self, values: np.ndarray, ordered: bool = False) -> np.ndarray:
        """The smallest value of each name's places."""
        values = values if ordered else values[self.order]
        return np.minimum.reduceat(values, self.first) if len(self.first) else values

    def most(self, values: np.ndarray, ordered: bool = False) -> np.ndarray:
        values = values if ordered else values[self.order]
        return np.maximum.reduceat(values, self.first) if len(self.first) else values

    def total(self, values: np.ndarray) -> np.ndarray:
        return np.add.reduceat(values[self.order], self.first) if len(self.first) else values

    def times(self) -> np.ndarray:
        return np.diff(np.append(self.first, len(self.order)))

    def lists(self) -> Iterator[tuple[int, int, int]]:
        """(bucket, from, to) of the names of each bucket."""
        for a, b in zip(self.cuts[:-1].tolist(), self.cuts[1:].tolist(), strict=True):
            if b > a:
                yield int(self.bucket[a]), a, b

    def spread(self, of_names: np.ndarray) -> np.ndarray:
        """Values of the places, in their own order, from those of the names."""
        out = np.empty(len(self.order), of_names.dtype)
        out[self.order] = of_names[self.run]
        return out


def low(names: np.ndarray, width: int) -> bytes:
    return np.ascontiguousarray(names.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width]).tobytes()


def high(data: bytes, n: int, width: int) -> np.ndarray:
    out = np.zeros((n, 8), np.uint8)
    out[:, :width] = np.frombuffer(data, np.uint8, n * width).reshape(n, width)
    return out.view("<u8").reshape(-1)


def bits(flags: np.ndarray) -> bytes:
    return np.packbits(flags).tobytes()


def flags(data: bytes, n: int, at: int = 0) -> np.ndarray:
    return np.unpackbits(np.frombuffer(data, np.uint8, -(-n // 8), at), count=n).astype(bool)


def ids_packed(ids: np.ndarray) -> bytes:
    """Ids, the distinct ones once."""
    known, which = np.unique(ids, return_inverse=True)
    which = which.astype("<u2" if len(known) <= 1 << 16 else "<u4")
    return len(known).to_bytes(4, "little") + known.astype("<i8").tobytes() + which.tobytes()


def ids_of(data: bytes, n: int, at: int) -> tuple[np.ndarray, int]:
    """Ids packed from ``at``, and the place behind them."""
    size = int.from_bytes(data[at : at + 4], "little")
    known = np.frombuffer(data, "<i8", size, at + 4)
    kind, at = ("<u2" if size <= 1 << 16 else "<u4"), at + 4 + 8 * size
    return known[np.frombuffer(data, kind, n, at)], at + n * int(kind[-1])


def gather(lists: DataFrame, answer: Callable[[list[tuple]], list[bytes]]) -> DataFrame:
    """The lists (LISTS) answered: ``answer`` gets the (n, data) of a bucket's
    lists and returns a byte string for each. A block's own notes (``note``) come
    back as they are."""

    def run(batches):
        now, held = None, []

        def answers():
            said = answer([(n, data) for _, n, data in held])
            return batch([(block, now, n, data) for (block, n, _), data in zip(held, said, strict=True)], _LISTS)

        for b in batches:
            notes = []
            for block, bucket, n, data in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if bucket < 0:
                    notes.append((block, bucket, n, data))
                    continue
                if bucket != now and held:
                    yield answers()
                    held = []
                now = bucket
                held.append((block, n, data))
            if notes:
                yield batch(notes, _LISTS)
        if held:
            yield answers()

    spread = lists.repartition(partitions(lists), "bucket").sortWithinPartitions("bucket")
    return kept(spread.mapInArrow(run, LISTS), "answers")


def answered(rows: DataFrame, answers: DataFrame, name: str = "answers", how: str = "left") -> DataFrame:
    """Rows of blocks with the answers to their names, in the order of these."""
    lists = answers.groupBy("block").agg(F.sort_array(F.collect_list(F.struct("bucket", "n", "data"))).alias(name))
    return rows.join(lists.hint("shuffle_hash"), "block", how)  # few bits each, while rows are large


def said(answers, at: int = 0) -> np.ndarray:
    """The bits of all names of a block, the ``at``-th ones of each list."""
    answers = [a for a in answers or () if a["bucket"] >= 0]
    if not answers:
        return np.zeros(0, bool)
    return np.concatenate([flags(a["data"], a["n"], at * -(-a["n"] // 8)) for a in answers])


def parts(held: list[tuple], values: np.ndarray) -> Iterator[np.ndarray]:
    """Values of a bucket's names, list by list."""
    at = 0
    for n, _ in held:
        yield values[at : at + n]
        at += n


class Runs:
    """Equal names of a bucket's lists."""

    def __init__(self, names: np.ndarray, second: np.ndarray | None = None):
        self.order = np.argsort(names)
        new = self._new(names)
        if second is not None and (self._new(second) & ~new).any():  # one name, two seconds
            self.order = np.lexsort((second, names))
            new = self._new(names) | self._new(second)
        self.first, self.run = np.nonzero(new)[0], np.cumsum(new) - 1

    def _new(self, values: np.ndarray) -> np.ndarray:
        ordered = values[self.order]
        new = np.ones(len(ordered), bool)
        new[1:] = ordered[1:] != ordered[:-1]
        return new

    def size(self) -> np.ndarray:
        return np.diff(np.append(self.first, len(self.order)))

    def over(self, ufunc: np.ufunc, values: np.ndarray) -> np.ndarray:
        return ufunc.reduceat(values[self.order], self.first)

    def spread(self, values: np.ndarray) -> np.ndarray:
        out = np.empty(len(self.order), values.dtype)
        out[self.order] = values[self.run]
        return out


def repeated(width: int) -> Callable[[list[tuple]], list[bytes]]:
    """Answers: whether other rows have a name. Lists hold names of ``width``
    bytes, and a bit for those that several rows of the block have."""

    def answer(held):
        names = np.concatenate([high(data, n, width) for n, data in held])
        several = np.concatenate([flags(data, n, n * width) for n, data in held])
        runs = Runs(names)
        more = runs.spread((runs.size() > 1) | runs.over(np.logical_or, several))
        return [bits(x) for x in parts(held, more)]

    return answer


def owned(held: list[tuple]) -> list[bytes]:
    """Answers: whether other rows have a name, whether a smaller id does. Lists
    are those of ``owned_list``."""
    names, second, least, several = [], [], [], []
    for n, data in held:
        names.append(high(data, n, 8))
        second.append(np.frombuffer(data, "<u8", n, 8 * n))
        ids, at = ids_of(data, n, 16 * n)
        least.append(ids)
        several.append(flags(data, n, at))
    runs = Runs(np.concatenate(names), np.concatenate(second))
    least = np.concatenate(least)
    more = runs.spread((runs.size() > 1) | runs.over(np.logical_or, np.concatenate(several)))
    smaller = runs.spread(runs.over(np.minimum, least)) < least
    return [bits(a) + bits(b) for a, b in zip(parts(held, more), parts(held, smaller), strict=True)]


def owned_lists(block: int, found: Names, least: np.ndarray) -> pa.RecordBatch:
    """Names with a second part, the smallest id of each, and a bit for those
    that several rows have."""
    out = []
    for bucket, a, e in found.lists():
        data = low(found.names[a:e], 8) + found.second[a:e].astype("<u8").tobytes() + ids_packed(least[a:e])
        out.append((block, bucket, e - a, data + bits(found.several[a:e])))
    return batch(out, _LISTS)


def note(block: int, n: int, data: bytes) -> pa.RecordBatch:
    """A list that only its own block reads again: what it knows besides the answers."""
    return batch([(block, -1 - block % 4096, n, data)], _LISTS)


def name_lists(block: int, found: Names, width: int) -> pa.RecordBatch:
    """Names, and a bit for those that several rows have."""
    out = [(block, bucket, e - a, low(found.names[a:e], width) + bits(found.several[a:e])) for bucket, a, e in found.lists()]
    return batch(out, _LISTS)

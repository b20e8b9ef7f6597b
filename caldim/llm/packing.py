"""Vector best-fit packing of tokenised documents into sequences.

Tokens: the ids of the tokenizer without special tokens, then an end id.
Documents longer than a sequence are cut into full pieces and a rest. A full
piece is a sequence of its own; the other pieces are dealt by hash to groups of
bounded size (``GROUP`` on average, so groups grow in number with the input,
never in size), and each group is packed in one task.

Packing: pieces in decreasing length; a piece goes to an open sequence that has
room in every dimension - tokens, documents and attention cost (sum of squared
lengths) - chosen by ``rule``: "dot" takes the largest weighted dot product of
demand and residual, "norm" the smallest weighted norm of the residual that
would be left. Tokens weigh most; documents and cost decide between sequences that
would be left about as full. A sequence is opened only if none has room.

Defined cases: null text is the empty text (its only id is the end id); a null
doc_id keeps its row; repeated rows are packed each for itself, their doc_id
and piece repeat; an empty table gives none; other columns are ignored.
"""

from __future__ import annotations

import zlib
from array import array
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caldim.llm.common import prepare, stored, text_of, utf8

#: Pieces that a task packs together, on average.
GROUP = 4096
#: Words whose ids a worker keeps; the store is emptied when full.
KEPT_WORDS = 400_000
#: Bytes of text that are split at once.
SLICE = 4 << 20
#: ASCII separators that Python splits at and the tokenizer does not. Fixed value.
NOT_SPACE = "\x1c\x1d\x1e\x1f"
#: Words whose lower case and composition are plain: characters below U+0250,
#: but for the dotted capital I.
LATIN = r"^[\x00-\x{12F}\x{131}-\x{24F}]*$"
PUNCTUATION = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"


class _Numbers(dict):
    """Numbers of strings; a new one is handed to ``add`` for its number."""

    def __init__(self, add):
        self.add = add

    def __missing__(self, text: str) -> int:
        number = self[text] = self.add(text)
        return number


class WordTokenizer:
    """Ids of texts by their white-space separated words.

    White space ends every token of this kind of vocabulary, so a text's ids
    are its words' ids in order. A word of Latin letters followed by ASCII
    punctuation is the ids of its lower-case letters and those of the rest,
    which are looked up if met before; any other word goes to the tokenizer as
    it is. A batch's words are made distinct first, so Python sees each once."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        self.model = self.tok.model
        # bytes as the printable characters that the vocabulary is written in
        keep = [*range(33, 127), *range(161, 173), *range(174, 256)]
        other = [b for b in range(256) if b not in set(keep)]
        self.chars = {b: chr(b) for b in keep} | {b: chr(256 + k) for k, b in enumerate(other)}
        self._clear()

    def _clear(self) -> None:
        self.letters, self.numbers = pa.array([], pa.string()), np.zeros(0, np.int64)
        self.signs, self.words = _Numbers(self._add_part), _Numbers(self._add_word)
        self.ids, self.starts = array("I"), array("q", [0, 0])  # number 0 has no ids

    def _add(self, ids: list[int]) -> int:
        self.ids.extend(ids)
        self.starts.append(len(self.ids))
        return len(self.starts) - 2

    def _add_part(self, text: str) -> int:
        shown = text if text.isascii() else text.encode().decode("latin-1").translate(self.chars)
        return self._add([t.id for t in self.model.tokenize(shown)])

    def _add_word(self, text: str) -> int:
        return self._add(self.tok.encode(text, add_special_tokens=False).ids)

    def _numbers(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of the letters and of the punctuation behind them, of each
        distinct word; of other words, their own and 0."""
        low = pc.utf8_lower(words)
        core = pc.utf8_rtrim(low, PUNCTUATION)
        plain = pc.and_(pc.match_substring_regex(words, LATIN), pc.match_substring_regex(core, r"^\pL+$"))
        plain = pc.and_not(plain, pc.match_substring(words, "<|"))
        first, second = np.zeros(len(words), np.int64), np.zeros(len(words), np.int64)
        plain = plain.to_numpy(zero_copy_only=False)
        at = pc.index_in(core, value_set=self.letters)
        new = plain & at.is_null().to_numpy(zero_copy_only=False)
        if new.any():
            unknown = pc.unique(core.filter(pa.array(new)))
            self.letters = pa.concat_arrays([self.letters, unknown])
            self.numbers = np.append(self.numbers, [self._add_part(t) for t in unknown.to_pylist()])
            at = pc.index_in(core, value_set=self.letters)
        first[plain] = self.numbers[at.fill_null(0).to_numpy()[plain]]
        other = words.filter(pa.array(~plain)).to_pylist()
        first[~plain] = np.fromiter(map(self.words.__getitem__, other), np.int64, len(other))
        size = pc.subtract(pc.binary_length(low), pc.binary_length(core)).to_numpy()
        raw, off = utf8(low)
        one = np.nonzero(plain & (size == 1))[0]
        signs, which = np.unique(raw[off[one + 1] - 1], return_inverse=True)
        second[one] = np.array([self.signs[chr(c)] for c in signs], np.int64)[which] if len(one) else 0
        for k in np.nonzero(plain & (size > 1))[0].tolist():
            second[k] = self.signs[raw[off[k + 1] - size[k] : off[k + 1]].tobytes().decode()]
        return first, second

    def __call__(self, text: str) -> np.ndarray:
        return self.many(pa.array([text]))[0]

    def many(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of some texts in a row, and where each text's end."""
        if pc.any(pc.match_substring_regex(texts, f"[{NOT_SPACE}]")).as_py():
            ids = [self._odd(t) for t in texts.to_pylist()]
            return np.concatenate(ids), np.cumsum([len(x) for x in ids])
        split = pc.utf8_split_whitespace(texts)
        words = split.flatten().dictionary_encode()
        if len(self.letters) + len(self.signs) + len(self.words) > KEPT_WORDS:
            self._clear()
        both = np.stack(self._numbers(words.dictionary), 1)
        index = both[words.indices.to_numpy()].reshape(-1)
        s, flat = np.frombuffer(self.starts, np.int64), np.frombuffer(self.ids, np.uint32)
        first = s[index]
        n = s[index + 1] - first
        ends = np.concatenate(([0], np.cumsum(n)))
        ids = flat[np.arange(ends[-1]) + np.repeat(first - ends[:-1], n)]
        return ids, ends[2 * np.cumsum(pc.list_value_length(split).to_numpy())]

    def _odd(self, text: str) -> np.ndarray:
        """Ids of a text that may hold separators which the tokenizer does not split at."""
        if any(c in text for c in NOT_SPACE):
            return np.array(self.tok.encode(text, add_special_tokens=False).ids, np.uint32)
        return self(text)


@lru_cache(1)
def tokenizer(path: str) -> WordTokenizer:
    return WordTokenizer(path)


def pieces(docs: DataFrame, path: str, capacity: int = 4096, end_id: int = 1) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32) of every document."""
    prepare(docs.sparkSession)
    rows = docs.select("doc_id", text_of().alias("text"))
    schema = rows.select(
        "doc_id",
        F.lit(0).alias("piece"),
        *(F.lit(0).cast("long").alias(c) for c in ("start", "length", "ids_crc32")),
    ).schema

    def run(batches):
        encode = tokenizer(path)
        for b in batches:
            row, piece, start, length, crc = [], [], [], [], []
            _, off = utf8(b.column(1))
            at = 0
            while at < b.num_rows:
                to = max(at + 1, int(np.searchsorted(off, off[at] + SLICE, "right")) - 1)
                ids, ends = encode.many(b.column(1).slice(at, to - at))
                # each text's ids, then the end id
                rows = np.arange(to - at)
                counts = np.diff(ends, prepend=0)
                whole = np.full(len(ids) + len(rows), end_id, "<u4")
                whole[np.arange(len(ids)) + np.repeat(rows, counts)] = ids
                stops = (ends + rows + 1).tolist()
                first = 0
                for k, stop in enumerate(stops, at):
                    for p, s in enumerate(range(first, stop, capacity)):
                        part = whole[s : min(s + capacity, stop)]
                        row.append(k)
                        piece.append(p)
                        start.append(s - first)
                        length.append(len(part))
                        crc.append(zlib.crc32(part))
                    first = stop
                at = to
            yield pa.RecordBatch.from_arrays(
                [
                    b.column(0).take(pa.array(row, pa.int64())),
                    pa.array(piece, pa.int32()),
                    *(pa.array(x, pa.int64()) for x in (start, length, crc)),
                ],
                names=["doc_id", "piece", "start", "length", "ids_crc32"],
            )

    return rows.mapInArrow(run, schema)


def best_fit(
    lengths: np.ndarray, capacity: int, max_docs: int, max_cost: int, rule: str, weights: tuple[float, float, float]
) -> tuple[np.ndarray, np.ndarray]:
    """(bin, offset) of each piece, in the order given."""
    order = np.argsort(-lengths, kind="stable")
    full = np.array([capacity, max_docs, max_cost], float)
    scale = np.array(weights, float) / full
    left = np.empty((len(lengths), 3))
    number = np.empty(len(lengths), np.int64)  # of the open bins
    used = np.zeros(len(lengths), np.int64)
    bins, offsets, n_open, n_bins = np.empty_like(lengths), np.empty_like(lengths), 0, 0
    least = lengths.min() if len(lengths) else 0
    for i in order:
        size = int(lengths[i])
        need = np.array([size, 1, size * size], float)
        rest = left[:n_open] - need
        fits = np.nonzero((rest >= 0).all(1))[0]
        if len(fits):
            r = rest[fits] * scale
            score = ((left[fits] * scale) @ (need * scale)) if rule == "dot" else -np.einsum("ij,ij->i", r, r)
            k = fits[score.argmax()]
        else:
            k, n_open = n_open, n_open + 1
            left[k], number[k], n_bins = full, n_bins, n_bins + 1
        bins[i], offsets[i] = number[k], used[number[k]]
        used[number[k]] += size
        left[k] -= need
        if left[k, 0] < least or left[k, 1] < 1 or left[k, 2] < least * least:  # closed: the last one takes its place
            n_open -= 1
            left[k], number[k] = left[n_open], number[n_open]
    return bins, offsets


def pack(
    docs: DataFrame,
    path: str,
    capacity: int = 4096,
    max_docs: int = 1024,
    max_cost: int | None = None,
    end_id: int = 1,
    rule: str = "norm",
    weights: tuple[float, float, float] = (1.0, 0.2, 0.2),
) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset).

    ``max_docs`` pieces and an attention cost of ``max_cost`` fit a sequence; by
    default that is the cost of one piece of full length, as less would not let
    full pieces in."""
    if rule not in ("dot", "norm"):
        raise ValueError("rule is 'dot' or 'norm'")
    max_cost = max_cost or capacity * capacity
    if max_cost < capacity * capacity:
        # a piece alone must fit its sequence
        capacity_of_piece = int(max_cost**0.5)
    else:
        capacity_of_piece = capacity
    cut = stored(pieces(docs, path, capacity_of_piece, end_id), "pieces")
    groups = max(1, -(-cut.filter(F.col("length") < capacity).count() // GROUP))
    dealt = cut.withColumn("part", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32", F.lit(5)), F.lit(groups)))
    alone = dealt.filter(F.col("length") == capacity).select(
        *cut.columns, (-1 - F.monotonically_increasing_id()).alias("sequence_id"), F.lit(0).cast("long").alias("offset")
    )
    shared = dealt.filter(F.col("length") < capacity)
    schema = alone.schema

    def place(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["length", "doc_id", "piece"], ascending=[False, True, True], kind="stable")
        bins, offsets = best_fit(pdf["length"].to_numpy(), capacity, max_docs, max_cost, rule, weights)
        out = pdf.drop(columns="part")
        out["sequence_id"] = pdf["part"].to_numpy() * (1 << 32) + bins
        out["offset"] = offsets
        return out

    return shared.groupBy("part").applyInPandas(place, schema).unionByName(alone)

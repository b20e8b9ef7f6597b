"""Conversation structure repair by Four-Russians block tables.

The roles of a repaired conversation spell ``(s?(ua)+)?`` in initials: nothing,
or user and assistant in turn after an optional system row. Rows may be kept
(K, free), given the role user or assistant (R, 2), deleted (D, 3) or preceded
by a new empty row of these roles (I, 2). Blank rows and repeats must go; a row
that stays without an end mark costs 1 more. The cheapest edits win, ties by
the least string of edit initials.

Costs from a row to the end form a vector over the four states of the pattern.
Its entries differ by a bounded amount, so only a few vectors exist once their
least entry is taken off. For each of them and each block of ``SIZE`` row
symbols a table holds the vector in front of the block and what it costs more.
Conversations are run through from their end block by block, by lookup; then
each block is expanded backward to the vectors of its rows, and the least edit
that keeps the cost is taken row by row from the front, so ties are exact.

A conversation of any size is a chain of segments (``turns``). For those that
cross partitions, a segment's costs between all pairs of states come from the
same tables, the vectors at their borders and then the states there follow on
the driver from at most two segments for each partition.

Defined cases: null role or text is one space; rows with a null conv_id form one
conversation; null turns come first, rows of one turn by role, then text; other
columns are ignored; conversations without rows are absent from ``repair`` and
all zeros in ``audit_of``; an empty table gives none. A repeat is told by a
128-bit hash of role and text.
"""

from __future__ import annotations

import hashlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caldim.llm.common import prepare, stored
from caldim.llm.turns import WHITE, batch, by_part, crossing, ordered, sql_crc32, types_of

#: Rows of a block; the tables hold 9 ** SIZE blocks for each vector.
SIZE = 4
#: Costs of the edits and of a row that stays without an end mark. Fixed values.
DELETE, INSERT, REROLE, OPEN_END = 3, 2, 2, 1
#: States: nothing yet, after system, after user, after assistant. What a row
#: with the initial s, u, a or another one leads to; None: not allowed.
NEXT = ((1, 2, None, None), (None, 2, None, None), (None, None, 3, None), (None, 2, None, None))
#: What a new or changed row leads to, and its role.
FILL = ((2, "user"), (2, "user"), (3, "assistant"), (2, "user"))
#: Costs from the states where no row is left (new rows may still come).
END = (0, 2 * INSERT, INSERT, 0)
#: Row symbols: initial (0-3), 4 more without an end mark; 8: must go.
SYMBOLS, NEVER = 9, 1 << 20
#: Bytes of repaired text handed on at once.
CHUNK = 1 << 20


def before(vector: tuple, symbol: int) -> tuple:
    """Costs in front of a row from those behind it."""
    costs = []
    for state in range(4):
        best = DELETE + vector[state]
        if symbol < 8:
            extra = OPEN_END * (symbol >= 4)
            kept = NEXT[state][symbol % 4]
            if kept is not None:
                best = min(best, extra + vector[kept])
            best = min(best, REROLE + extra + vector[FILL[state][0]])
        costs.append(best)
    # a new row in front, or two
    two, three = min(costs[2], INSERT + costs[3]), min(costs[3], INSERT + costs[2])
    return min(costs[0], INSERT + two), min(costs[1], INSERT + two), two, three


def _normal(vector: tuple) -> tuple[tuple, int]:
    least = min(vector)
    return tuple(min(c - least, NEVER) if c < NEVER else NEVER for c in vector), least


class Blocks:
    """Tables of all vectors that occur, by rows and by blocks of rows."""

    def __init__(self, size: int = SIZE):
        ends = [END] + [tuple(0 if s == e else NEVER for s in range(4)) for e in range(4)]
        self.number, self.vectors = {}, []
        for v in ends:
            self._known(_normal(v)[0])
        step, add, at = [], [], 0
        while at < len(self.vectors):
            found = [_normal(before(self.vectors[at], s)) for s in range(SYMBOLS)]
            step.append([self._known(v) for v, _ in found])
            add.append([c for _, c in found])
            at += 1
        step, add = np.array(step), np.array(add)
        self.size, self.step, self.add = size, [None, step], [None, add]
        for _ in range(1, size):
            # one more row in front: its symbol is the highest digit of a block's number
            last, cost = self.step[-1], self.add[-1]
            self.step.append(step[last].transpose(0, 2, 1).reshape(len(step), -1))
            self.add.append((cost[:, :, None] + add[last]).transpose(0, 2, 1).reshape(len(step), -1))
        self.traced: dict = {}

    def _known(self, vector: tuple) -> int:
        if vector not in self.number:
            self.number[vector] = len(self.vectors)
            self.vectors.append(vector)
        return self.number[vector]

    def codes(self, symbols: np.ndarray) -> list[tuple[int, int]]:
        """(rows, number) of each block."""
        whole = len(symbols) // self.size
        powers = SYMBOLS ** np.arange(self.size - 1, -1, -1)
        found = (symbols[: whole * self.size].astype(np.int64).reshape(whole, self.size) @ powers).tolist()
        out = [(self.size, c) for c in found]
        rest = symbols[whole * self.size :].astype(np.int64)
        if len(rest):
            out.append((len(rest), int(rest @ powers[self.size - len(rest) :])))
        return out

    def run(self, codes: list[tuple[int, int]], end: tuple) -> tuple[list[int], int]:
        """Numbers of the vectors at the block borders, and what is to be added
        to the first one."""
        vector, cost = _normal(end)
        at = self.number[vector]
        out = [at]
        for rows, code in reversed(codes):
            cost += int(self.add[rows][at, code])
            at = int(self.step[rows][at, code])
            out.append(at)
        return out[::-1], cost

    def piece(self, rows: int, code: int, right: int, state: int) -> tuple[str, int]:
        """Edits of a block from a state, and the state that they lead to."""
        key = (rows, code, right, state)
        got = self.traced.get(key)
        if got is None:
            if len(self.traced) > 1_000_000:
                self.traced.clear()
            got = self.traced[key] = self._expand(rows, code, right, state)
        return got

    def _expand(self, rows: int, code: int, right: int, state: int) -> tuple[str, int]:
        symbols = [code // SYMBOLS ** (rows - 1 - k) % SYMBOLS for k in range(rows)]
        costs = [self.vectors[right]]
        for s in reversed(symbols):
            costs.append(before(costs[-1], s))
        costs.reverse()
        edits = []
        for k, s in enumerate(symbols):
            while True:
                now, then, extra = costs[k][state], costs[k + 1], OPEN_END * (4 <= s < 8)
                fill = FILL[state][0]
                kept = NEXT[state][s % 4] if s < 8 else None
                if now == DELETE + then[state]:
                    edits.append("D")
                elif now == INSERT + costs[k][fill]:
                    edits.append("I")
                    state = fill
                    continue
                elif kept is not None and now == extra + then[kept]:
                    edits.append("K")
                    state = kept
                else:
                    edits.append("R")
                    state = fill
                break
        return "".join(edits), state

    def trace(self, codes: list[tuple[int, int]], borders: list[int], state: int, last: bool) -> tuple[str, int]:
        out = []
        for (rows, code), right in zip(codes, borders[1:], strict=True):
            edits, state = self.piece(rows, code, right, state)
            out.append(edits)
        while last and END[state]:
            out.append("I")
            state = FILL[state][0]
        return "".join(out), state


@lru_cache(1)
def blocks() -> Blocks:
    return Blocks()


def _codes() -> Column:
    """A row's code: initial, 4 open end, 8 blank, 16 repeat."""
    initial = F.left("role", F.lit(1))
    body = F.rtrim(F.col("text"), F.lit(WHITE))
    blank = body == ""
    kind = F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(3)
    open_end = ~F.right(body, F.lit(1)).isin(".", "!", "?")
    return F.when(blank, kind + 8).otherwise(kind + F.when(open_end, 4).otherwise(0))


def symbols_of(codes: np.ndarray) -> np.ndarray:
    return np.where(codes >= 8, 8, codes & 7).astype(np.uint8)


def _segments(t: DataFrame) -> DataFrame:
    """(conv_id, part, codes): a byte for each row of a segment."""
    rows = t.select(
        "conv_id", "part", "rid", _codes().alias("code"),
        F.xxhash64(F.col("role"), F.col("text")).alias("h1"), F.xxhash64(F.lit("second"), F.col("text"), F.col("role")).alias("h2"),
    )
    first = rows.filter("code < 8").groupBy("conv_id", "h1", "h2").agg(F.min("rid").alias("rid"))
    first = first.select("rid", F.lit(True).alias("fresh"))
    again = F.col("fresh").isNull() & (F.col("code") < 8)
    marked = rows.join(first, "rid", "left").select(
        "conv_id", "part", "rid", F.when(again, F.col("code") + 16).otherwise(F.col("code")).alias("code")
    )
    kind, arrow = types_of(t, "conv_id")
    schema = pa.schema([("conv_id", arrow), ("part", pa.int32()), ("codes", pa.binary())])

    def run(batches):
        now, held = None, []
        for b in batches:
            out = []
            convs, parts = b.column(0).to_pylist(), b.column(1).to_pylist()
            codes = b.column(3).to_numpy(zero_copy_only=False).astype(np.uint8).tobytes()
            start = 0
            for k, key in enumerate(zip(parts, convs, strict=True)):
                if key != now:
                    held.append(codes[start:k])
                    if now is not None:
                        out.append((now[1], now[0], b"".join(held)))
                    now, held, start = key, [], k
            held.append(codes[start:])
            yield batch(out, schema)
        if now is not None:
            yield batch([(now[1], now[0], b"".join(held))], schema)

    return stored(by_part(marked, "rid").mapInArrow(run, f"conv_id {kind}, part int, codes binary"), "segments")


def _borders(segments: DataFrame) -> dict:
    """For segments of conversations that cross partitions: the costs behind
    them, and whether they are the last of theirs."""
    kind, arrow = types_of(segments, "conv_id")
    schema = pa.schema([("conv_id", arrow), ("part", pa.int32()), ("costs", pa.list_(pa.int64()))])

    def run(batches):
        table = blocks()
        for b in batches:
            out = []
            for conv, part, codes in zip(*(c.to_pylist() for c in b.columns), strict=True):
                found = table.codes(symbols_of(np.frombuffer(codes, np.uint8)))
                costs = []
                for end in range(4):
                    borders, add = table.run(found, tuple(0 if s == end else NEVER for s in range(4)))
                    costs += [c + add if c < NEVER else NEVER for c in table.vectors[borders[0]]]
                out.append((conv, part, costs))
            yield batch(out, schema)

    rows = crossing(segments).mapInArrow(run, f"conv_id {kind}, part int, costs array<long>").collect()
    chains: dict = {}
    for r in rows:
        chains.setdefault(r.conv_id, []).append((r.part, r.costs))
    out = {}
    for conv, chain in chains.items():
        vector, last = END, True
        for part, costs in sorted(chain, reverse=True):
            out[conv, part] = (vector, last)
            vector = tuple(min(min(costs[4 * e + s] + vector[e] for e in range(4)), NEVER) for s in range(4))
            last = False
    return out


def _edits(segments: DataFrame, borders: dict) -> DataFrame:
    """(conv_id, part, start, stop, cost, audit and counts) of each segment, for
    those of crossing conversations once for every state in front of them."""
    kind, arrow = types_of(segments, "conv_id")
    known = segments.sparkSession.sparkContext.broadcast(borders)
    fields = [
        ("conv_id", arrow), ("part", pa.int32()), ("start", pa.int32()), ("stop", pa.int32()), ("cost", pa.int64()),
        ("audit", pa.string()), ("blank", pa.int64()), ("duplicate", pa.int64()), ("truncated", pa.int64()),
        ("illegal", pa.int64()), ("first", pa.int32()), ("last", pa.int32()),
    ]
    schema = pa.schema(fields)

    def run(batches):
        table, around = blocks(), known.value
        for b in batches:
            out = []
            for conv, part, codes in zip(*(c.to_pylist() for c in b.columns), strict=True):
                codes = np.frombuffer(codes, np.uint8)
                counts = (
                    int((codes & 8 > 0).sum()), int((codes & 16 > 0).sum()), int((codes & 28 == 4).sum()),
                    int((~_legal(codes[:-1] & 3, codes[1:] & 3)).sum()), int(codes[0] & 3), int(codes[-1] & 3),
                )
                vector, last = around.get((conv, part), (END, True))
                found = table.codes(symbols_of(codes))
                marks, add = table.run(found, vector)
                front = table.vectors[marks[0]]
                for state in range(4) if (conv, part) in around else (0,):
                    if front[state] < NEVER:
                        audit, stop = table.trace(found, marks, state, last)
                        out.append((conv, part, state, stop, front[state] + add, audit, *counts))
            yield batch(out, schema)

    ddl = (
        f"conv_id {kind}, part int, start int, stop int, cost long, audit string, blank long, duplicate long, "
        "truncated long, illegal long, first int, last int"
    )
    found = stored(segments.mapInArrow(run, ddl), "edits")
    if not borders:
        return found
    # the states that the chains go through: one row for each crossing segment
    chains: dict = {}
    for r in crossing(found.select("conv_id", "part", "start", "stop")).collect():
        if (r.conv_id, r.part) in borders:
            chains.setdefault(r.conv_id, {}).setdefault(r.part, {})[r.start] = r.stop
    taken = []
    for conv, segs in chains.items():
        state = 0
        for part in sorted(segs):
            taken.append((conv, part, state))
            state = segs[part][state]
    picks = found.sparkSession.createDataFrame(taken, f"c {kind}, p int, s int")
    on = F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("part") == F.col("p"))
    both = found.join(F.broadcast(picks), on, "left")
    return both.filter("s is null or start = s").drop("c", "p", "s")


def _legal(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Pairs of initials su, ua or au."""
    return ((left == 0) & (right == 1)) | ((left == 1) & (right == 2)) | ((left == 2) & (right == 1))


def _digests(t: DataFrame, edits: DataFrame, crossing_ids: set) -> DataFrame:
    """(conv_id, repaired_sha256): rows meet their segment's edits, repaired rows
    are hashed as they come; of conversations that cross partitions they are
    handed on in chunks and hashed in their order."""
    kind, arrow = types_of(t, "conv_id")
    several = t.sparkSession.sparkContext.broadcast(crossing_ids)
    plan = edits.select("conv_id", "part", F.lit(-1).cast("long").alias("rid"), F.col("start").cast("string").alias("role"), F.col("audit").alias("text"))
    both = plan.unionByName(t.select("conv_id", "part", "rid", "role", "text"))
    schema = pa.schema([("conv_id", arrow), ("part", pa.int32()), ("seq", pa.int32()), ("data", pa.binary())])

    def run(batches):
        ids = several.value
        now = edit = None
        out: list = []

        def put(text: str):
            data = ("\n" + text).encode()
            if now[1] not in ids:
                state["sha"].update(data[1:] if state["fresh"] else data)
                state["fresh"] = False
                return
            state["held"].append(data)
            state["size"] += len(data)
            if state["size"] > CHUNK:
                hand_on()

        def hand_on():
            if state["held"]:
                out.append((now[1], now[0], state["seq"], b"".join(state["held"])))
            state.update(held=[], size=0, seq=state["seq"] + 1)

        def fill():
            state["at"], role = FILL[state["at"]]
            return role

        def inserts():
            while edit[state["k"] : state["k"] + 1] == "I":
                put(fill() + ":")
                state["k"] += 1

        def close():
            inserts()
            if now[1] in ids:
                hand_on()
                out.append((now[1], now[0], state["seq"], b""))
            else:
                out.append((now[1], None, None, state["sha"].hexdigest().encode()))

        state: dict = {}
        for b in batches:
            for conv, part, rid, role, text in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if rid < 0:
                    if now is not None:
                        close()
                    now, edit = (part, conv), text
                    state = {"at": int(role), "k": 0, "sha": hashlib.sha256(), "fresh": True, "held": [], "size": 0, "seq": 0}
                    continue
                inserts()
                what = edit[state["k"]]
                state["k"] += 1
                if what == "R":
                    put(f"{fill()}:{text}")
                elif what == "K":
                    state["at"] = NEXT[state["at"]]["sua".find(role[:1]) if role[:1] else 3]
                    put(f"{role}:{text}")
            yield batch(out, schema)
            out.clear()
        if now is not None:
            close()
            yield batch(out, schema)

    ddl = f"conv_id {kind}, part int, seq int, data binary"
    rows = stored(by_part(both, "conv_id", "rid").mapInArrow(run, ddl), "repaired")
    whole = rows.filter("part is null").select("conv_id", F.col("data").cast("string").alias("repaired_sha256"))
    digest = pa.schema([("conv_id", arrow), ("repaired_sha256", pa.string())])

    def join(batches):
        now, sha, fresh = (), None, True
        for b in batches:
            out = []
            for conv, data in zip(b.column(0).to_pylist(), b.column(3), strict=True):
                if (conv,) != now:
                    if now:
                        out.append((now[0], sha.hexdigest()))
                    now, sha, fresh = (conv,), hashlib.sha256(), True
                data = data.as_py()
                if data:
                    sha.update(data[1:] if fresh else data)
                    fresh = False
            yield batch(out, digest)
        if now:
            yield batch([(now[0], sha.hexdigest())], digest)

    parts = rows.filter("part is not null").repartition("conv_id").sortWithinPartitions("conv_id", "part", "seq")
    return whole.unionByName(parts.mapInArrow(join, f"conv_id {kind}, repaired_sha256 string"))


def repair(rows: DataFrame) -> DataFrame:
    """(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit,
    repaired_sha256) of each conversation in (conv_id, turn, role, text)."""
    prepare(rows.sparkSession)
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c)
    t = ordered(rows.select("conv_id", "turn", space("role"), space("text")), ["conv_id", "turn", "role", "text"], "turns")
    segments = _segments(t)
    borders = _borders(segments)
    edits = _edits(segments, borders)
    turns = t.groupBy("conv_id", "turn").agg(F.lit(1).alias("one")).groupBy("conv_id")
    gaps = turns.agg(F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count("turn"), F.lit(0)).cast("long").alias("gaps"))
    chain = edits.groupBy("conv_id").agg(
        *(F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated", "illegal")),
        F.sort_array(F.collect_list(F.struct("part", "cost", "audit", "first", "last"))).alias("segs"),  # one a partition at most
    )
    pair = F.transform(
        F.sequence(F.lit(1), F.size("segs") - 1),
        lambda k: F.get("segs", k - 1)["last"] * 4 + F.get("segs", k)["first"],
    )
    across = F.when(F.size("segs") > 1, F.size(F.filter(pair, lambda p: ~p.isin(1, 6, 9)))).otherwise(0)
    chain = chain.select(
        "conv_id", "blank", "duplicate", "truncated", (F.col("illegal") + across).alias("illegal"),
        F.get("segs", F.lit(0))["cost"].alias("cost"), F.array_join(F.col("segs")["audit"], "").alias("audit"),
    )
    digests = _digests(t, edits, {c for c, _ in borders})
    named = lambda df, n: df.withColumnRenamed("conv_id", n)
    out = chain.join(named(gaps, "c1"), F.col("conv_id").eqNullSafe(F.col("c1")))
    out = out.join(named(digests, "c2"), F.col("conv_id").eqNullSafe(F.col("c2")))
    return out.select("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


def damaged(rows: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text) with rows dropped, emptied, cut, repeated or
    given to the user, as the checksum of their conversation and turn says."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    lot = F.crc32(F.concat(text("conv_id"), F.lit(":"), text("turn"))) % 20
    rows = rows.select("conv_id", "turn", text("role").alias("role"), text("text").alias("text"), lot.alias("lot"))
    changed = F.when(F.col("lot") == 1, "").when(F.col("lot") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    times = F.when(F.col("lot") == 3, 2).otherwise(1)
    return rows.filter("lot <> 0").select(
        "conv_id", "turn", F.when(F.col("lot") == 4, "user").otherwise(F.col("role")).alias("role"), changed.alias("text"),
        F.explode(F.array_repeat(F.lit(0), times)).alias("copy"),
    ).drop("copy")


def audit_of(conversations: DataFrame, rows: DataFrame) -> DataFrame:
    """``repair`` of ``rows`` for every conversation in ``conversations``; those
    without rows have nothing to repair."""
    ids = conversations.select(F.col("conv_id").alias("id")).distinct()
    both = ids.join(repair(rows), F.col("id").eqNullSafe(F.col("conv_id")), "left")
    none = hashlib.sha256(b"").hexdigest()
    return both.select(
        F.col("id").alias("conv_id"),
        *(F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")),
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.lit(none)).alias("repaired_sha256"),
    )


def oracle_sql() -> str:
    """``audit_of`` the damaged conversations, by a search from the front that
    keeps each state's least cost and edits after every row."""
    lot = sql_crc32("(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '))")
    row = "n.role || ':' || n.body"

    def option(state: str, cost: str, edit: str, text: str | None) -> str:
        t = f"{state}.t" if text is None else f"list_append({state}.t, {text})"
        return f"{{'c': {state}.c + {cost}, 'e': {state}.e || '{edit}', 't': {t}}}"

    def best(*found: str) -> str:
        return f"least({', '.join(found)})"

    stay = "(CASE WHEN n.must_go THEN 1000000 ELSE n.open_end END)"
    drop = [option(f"w.s{k}", "3", "D", None) for k in range(4)]
    kept = lambda s, initial: option(s, f"{stay} + CASE WHEN left(n.role, 1) = '{initial}' THEN 0 ELSE 1000000 END", "K", row)
    given = lambda s, role: option(s, f"{stay} + 2", "R", f"'{role}:' || n.body")
    new = lambda s, role: option(s, "2", "I", f"'{role}:'")
    to_user = [f(f"w.s{k}", x) for k in (0, 1, 3) for f, x in ((kept, "u"), (given, "user"))]
    consumed = f"""
      SELECT w.conv, n.i, {drop[0]} AS r0, {best(drop[1], kept("w.s0", "s"))} AS r1,
             {best(drop[2], *to_user)} AS r2, {best(drop[3], kept("w.s2", "a"), given("w.s2", "assistant"))} AS r3
      FROM walk w JOIN marked n ON n.conv IS NOT DISTINCT FROM w.conv AND n.i = w.i + 1"""
    closed = lambda of: f"""
      SELECT conv, i, r0 AS s0, r1 AS s1, r2 AS s2, {best("r3", new("r2", "assistant"))} AS s3
      FROM (SELECT conv, i, r0, r1, {best("r2", new("r0", "user"), new("r1", "user"), new("r3", "user"))} AS r2, r3 FROM ({of}))"""  # noqa: E731
    never = "{'c': 1000000::BIGINT, 'e': '', 't': []::VARCHAR[]}"
    start = f"SELECT conv, 0::BIGINT AS i, {{'c': 0::BIGINT, 'e': '', 't': []::VARCHAR[]}} AS r0, {never} AS r1, {never} AS r2, {never} AS r3 FROM ids"
    white = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
    return f"""
    WITH RECURSIVE ids AS (SELECT DISTINCT conv_id AS conv FROM conversations),
    lots AS (
      SELECT conv_id AS conv, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS body, {lot} % 20 AS lot
      FROM conversations),
    damaged AS (
      SELECT conv, turn, CASE WHEN lot = 4 THEN 'user' ELSE role END AS role,
             CASE lot WHEN 1 THEN '' WHEN 2 THEN regexp_replace(body, '[.!?]', '', 'g') ELSE body END AS body,
             unnest(range(CASE WHEN lot = 3 THEN 2 ELSE 1 END)) AS copy
      FROM lots WHERE lot <> 0),
    placed AS (
      SELECT *, row_number() OVER (PARTITION BY conv ORDER BY turn NULLS FIRST, role, body, copy) AS i,
             rtrim(body, {white}) AS seen
      FROM damaged),
    marked AS (
      SELECT conv, turn, role, body, i, seen = '' AS blank, lead(role) OVER (PARTITION BY conv ORDER BY i) AS next_role,
             seen <> '' AND row_number() OVER (PARTITION BY conv, role, body ORDER BY i) > 1 AS again,
             blank OR again AS must_go,
             CASE WHEN NOT must_go AND right(seen, 1) NOT IN ('.', '!', '?') THEN 1 ELSE 0 END AS open_end
      FROM placed),
    walk AS ({closed(start)} UNION ALL {closed(consumed)}),
    counts AS (
      SELECT conv, max(i) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
             count_if(blank) AS blank, count_if(again) AS duplicate, sum(open_end) AS truncated,
             count_if(next_role IS NOT NULL AND (left(role, 1) || left(next_role, 1)) NOT IN ('su', 'ua', 'au')) AS illegal
      FROM marked GROUP BY conv)
    SELECT i.conv AS conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, CAST(coalesce(blank, 0) AS BIGINT) AS blank,
           CAST(coalesce(duplicate, 0) AS BIGINT) AS duplicate, CAST(coalesce(truncated, 0) AS BIGINT) AS truncated,
           CAST(coalesce(illegal, 0) AS BIGINT) AS illegal, least(s0, s3).c AS cost, least(s0, s3).e AS audit,
           sha256(array_to_string(least(s0, s3).t, chr(10))) AS repaired_sha256
    FROM ids i LEFT JOIN counts k ON k.conv IS NOT DISTINCT FROM i.conv
    JOIN walk w ON w.conv IS NOT DISTINCT FROM i.conv AND w.i = coalesce(k.n, 0)"""

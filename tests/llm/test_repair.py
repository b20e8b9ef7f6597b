"""Structure repair against a plain search over all edits."""

import hashlib
import random
import re
import zlib
from functools import lru_cache

import pytest
from llm_fixtures import SF001, SF0001
from pyspark.sql import functions as F

from caldim.llm import repair as R
from caldim.llm.queries import QUERIES

WORDS = re.compile(r"[^\x20\x09-\x0D]")


def damage(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        show = lambda v: " " if v is None else str(v)
        lot = zlib.crc32(f"{show(conv)}:{show(turn)}".encode()) % 20
        if lot == 0:
            continue
        text = "" if lot == 1 else re.sub("[.!?]", "", text) if lot == 2 else text
        role = "user" if lot == 4 else role
        out += [(conv, turn, role, text)] * (2 if lot == 3 else 1)
    return out


def cheapest(rows):
    """(cost, audit, repaired rows): memoised search over edits."""
    spell = re.compile(r"(s?(ua)+)?")

    def after(state, c):  # states: "", "s", "u", "a"
        return {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("a", "u"): "u", ("u", "a"): "a"}.get((state, c))

    @lru_cache(None)
    def best(i, state, inserted):
        found = []
        if i == len(rows) and state in ("", "a"):
            found.append((0, "", ()))
        if inserted < 3:
            for role in ("user", "assistant"):
                to = after(state, role[0])
                if to:
                    c, a, t = best(i, to, inserted + 1)
                    found.append((c + 2, "I" + a, (f"{role}:", *t)))
        if i < len(rows):
            role, text, fault = rows[i]
            c, a, t = best(i + 1, state, 0)
            found.append((c + 3, "D" + a, t))
            if fault in (None, "truncated"):
                extra = int(fault == "truncated")
                for kind, price, new in (("K", 0, role), ("R", 2, "user"), ("R", 2, "assistant")):
                    to = after(state, new[:1])
                    if to:
                        c, a, t = best(i + 1, to, 0)
                        found.append((c + price + extra, kind + a, (f"{new}:{text}", *t)))
        return min(found, key=lambda x: x[:2]) if found else (1 << 30, "", ())

    for i in range(len(rows), 0, -1):  # from the end, so that no search is deep
        for state in ("", "s", "u", "a"):
            best(i, state, 0)
    cost, audit, repaired = best(0, "", 0)
    assert spell.fullmatch("".join(r[:1] for r in repaired))
    return cost, audit, hashlib.sha256("\n".join(repaired).encode()).hexdigest()


def expected(conv_rows, ids=()):
    convs = {c: [] for c in ids}
    for conv, turn, role, text in conv_rows:
        convs.setdefault(conv, []).append((turn is not None, turn or 0, role if role is not None else " ", text if text is not None else " "))
    out = {}
    for conv, rows in convs.items():
        rows.sort()
        seen, marked, counts = set(), [], {"blank": 0, "duplicate": 0, "truncated": 0}
        for _, _, role, text in rows:
            chars = WORDS.findall(text)
            fault = "blank" if not chars else "duplicate" if (role, text) in seen else "truncated" if chars[-1] not in ".!?" else None
            seen.add((role, text))
            if fault:
                counts[fault] += 1
            marked.append((role, text, fault))
        turns = [r[1] for r in rows if r[0]]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(marked, marked[1:]))
        out[conv] = (gaps, *counts.values(), illegal, *cheapest(tuple(marked)))
    return out


def got(df):
    rows = df.collect()
    out = {r.conv_id: tuple(r)[1:] for r in rows}
    assert len(out) == len(rows)
    return out


def test_blocks_equal_row_by_row():
    import numpy as np

    table, rng = R.Blocks(3), np.random.default_rng(1)
    for n in [1, 2, 3, 4, 7, 20]:
        for _ in range(30):
            symbols = rng.integers(0, 9, n)
            vector = R.END
            for s in reversed(symbols):
                vector = R.before(vector, int(s))
            borders, add = table.run(table.codes(symbols), R.END)
            assert tuple(c + add for c in table.vectors[borders[0]]) == vector


@pytest.mark.parametrize("sf", [SF0001, SF001])
def test_query(spark, sf):
    rows = spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()
    want = expected(damage([tuple(r) for r in rows]), {r.conv_id for r in rows})
    assert got(QUERIES["op13_conversation_repair"](spark, sf)) == want


def some_rows(seed, convs, most):
    rng = random.Random(seed)
    rows = []
    for c in range(convs):
        for _ in range(rng.randint(1, most)):
            text = rng.choice(["Hi.", "Yes!", "no end", "", " \t", "Again?", "x. \n", "Ünï."])
            rows.append((c, rng.choice([None, *range(12)]), rng.choice(["user", "assistant", "system", "user", "assistant", "tool", ""]), text))
    return rows


def test_odd_rows_against_search(spark):
    rows = some_rows(3, 120, 12) + [(None, 1, "user", "Hi."), (None, None, None, None), (500, 1, None, "long " * 40_000 + ".")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    df = df.withColumn("part", F.lit("clash")).withColumn("rid", F.lit(2.5))
    assert got(R.repair(df)) == expected(rows)
    assert R.repair(df.limit(0)).count() == 0


def test_one_conversation_over_many_partitions(spark):
    rng = random.Random(5)
    roles = ["user", "assistant", "system", "tool"]
    big = [(7, k, rng.choice(roles), rng.choice([f"t{k}.", f"open {k}", "same.", ""])) for k in range(400)]
    rows = big + some_rows(9, 6, 6)
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(9)
    assert got(R.repair(df)) == expected(rows)


def test_damage_and_absent_rows(spark):
    rows = [(c, t, r, x) for c, t, r, x in some_rows(8, 60, 3)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    assert got(R.audit_of(df, R.damaged(df))) == expected(damage(rows), {r[0] for r in rows})

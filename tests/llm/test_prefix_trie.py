"""The prefix trie against one built of whole turns."""

import hashlib
import random
import re
import zlib

import pytest
from llm_fixtures import SF001, SF0001
from pyspark.sql import functions as F

from caldim.llm import prefix_trie as P
from caldim.llm.queries import QUERIES

COLUMNS = "conv_id long, turn long, role string, text string"


def expected(rows):
    convs = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            convs.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    convs = {c: [(r, t) for _, _, r, t in sorted(own)] for c, own in convs.items()}
    nodes = {}
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % 4
        turns = tuple(convs.get(c - c % 20, [])[:h] + own[h:])
        for d in range(len(turns) + 1):
            node = nodes.setdefault(turns[:d], {"members": [], "ends": []})
            node["members"].append(c)
            if d == len(turns):
                node["ends"].append(c)
    for path in sorted(nodes, key=len, reverse=True):
        node = nodes[path]
        node.setdefault("children", 0)
        node.setdefault("leaves", 0)
        node["leaves"] += node["children"] == 0
        words = len(re.findall(r"[^\x20\x09-\x0D]+", path[-1][1])) if path else 0
        node["saved"] = node.get("saved", 0) + (len(node["members"]) - 1) * words
        if path:
            up = nodes[path[:-1]]
            up["children"] = up.get("children", 0) + 1
            up["leaves"] = up.get("leaves", 0) + node["leaves"]
            up["saved"] = up.get("saved", 0) + node["saved"]
    return {
        (min(n["members"]), len(p)): (
            min(nodes[p[:-1]]["members"]) if p else None, len(n["members"]), n["children"], n["leaves"], n["saved"],
            hashlib.sha256(",".join(map(str, sorted(n["ends"]))).encode()).hexdigest(),
        )
        for p, n in nodes.items()
    }


def got(df):
    rows = df.collect()
    assert df.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    out = {tuple(r)[:2]: tuple(r)[2:] for r in rows}
    assert len(out) == len(rows)
    return out


@pytest.mark.parametrize("sf", [SF0001, SF001])
def test_query(spark, sf):
    rows = spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()
    assert got(QUERIES["op11_prefix_trie"](spark, sf)) == expected([tuple(r) for r in rows])


def some_rows(seed, convs, most=6):
    rng = random.Random(seed)
    rows = []
    for c in rng.sample(range(3 * convs), convs):
        for _ in range(rng.randint(1, most)):
            text = rng.choice(["a b", "a  b", "hello there", "", None, "x y z", " t\n\x0bu "])
            rows.append((c, rng.choice([None, *range(5)]), rng.choice(["user", "assistant", None]), text))
    return rows


def test_odd_rows(spark):
    rows = some_rows(1, 150) + [(None, 1, "user", "no id"), (-25, 0, "user", "a b"), (10**12, 0, "user", "long " * 50_000)]
    df = spark.createDataFrame(rows, COLUMNS)
    df = df.withColumn("part", F.lit("clash")).withColumn("h1", F.lit(2.5))
    assert got(P.trie(df)) == expected([r for r in rows if r[0] != -25] + [(-25, 0, "user", "a b")])
    assert P.trie(df.limit(0)).count() == 0
    assert P.trie(df.filter("conv_id is null")).count() == 0


def test_one_conversation_over_partitions_and_blocks(spark, monkeypatch):
    monkeypatch.setattr(P, "BLOCK", 16)
    big = [(40, k, "user", f"word {k % 7}") for k in range(300)]
    copy = [(c, k, "user", f"word {k % 7}") for c in (41, 47) for k in range(280)]
    rows = big + copy + some_rows(4, 30)
    rows = [r for r in rows if r[0] not in (40, 41, 47)] + big + copy
    assert got(P.trie(spark.createDataFrame(rows, COLUMNS))) == expected(rows)


def test_hot_first_turn_and_copies(spark, monkeypatch):
    monkeypatch.setattr(P, "FEW", 3)
    monkeypatch.setattr(P, "CHUNK", 20)
    rows = [(c, 0, "system", "same start") for c in range(200)] + [(c, 1, "user", f"ask {c % 90}") for c in range(200)]
    rows += [(c, t, "user", f"copy {t}") for c in range(300, 420) for t in range(4)]
    assert got(P.trie(spark.createDataFrame(rows, COLUMNS))) == expected(rows)


def test_another_radix_where_products_collide(spark, monkeypatch):
    radix = P.radix
    monkeypatch.setattr(P, "radix", lambda attempt: 1 if attempt == 0 else radix(attempt))  # sums: order is lost
    rows = [(1, 0, "user", "a"), (1, 1, "user", "b"), (2, 0, "user", "b"), (2, 1, "user", "a")] + some_rows(2, 20)
    assert got(P.trie(spark.createDataFrame(rows, COLUMNS))) == expected(rows)

"""Wu-Manber search against a scan of every window."""

import hashlib
import re

import pytest
from llm_fixtures import documents  # noqa: F401
from pyspark.sql import functions as F

from caldim.llm import decontaminate as D


def words(text):
    text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text)


def plain(docs, items, size=10):
    wins = {}
    for i, t in items:
        w = words(t)
        for k in range(max(1, len(w) - size + 1) if w else 0):
            wins.setdefault(tuple(w[k : k + size]), set()).add("" if i is None else str(i))
    out = []
    for o, t in docs:
        w, hit, found = words(t), set(), set()
        for n in {len(x) for x in wins}:
            for k in range(len(w) - n + 1):
                if (ids := wins.get(tuple(w[k : k + n]))) is not None:
                    hit |= set(range(k, k + n))
                    found |= ids
        sha = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.append((o if o is not None else -1, len(w), len(hit), len(found), sha, len(hit) > 0))
    return sorted(out)


ITEM = "one two three four five six seven eight nine ten eleven twelve thirteen"
ITEMS = [(1, ITEM), (2, ITEM.upper() + " extra"), (30, "Short item, of six words!"), (4, "é"), (5, None), (6, " .,;"), (1, ITEM), (None, "a b c d e f g h i j")]
DOCS = [
    (1, f"x {ITEM} y"),
    (2, ITEM.replace(" ", "-") + "!" + ITEM),
    (3, "two three four five six seven eight nine ten"),
    (4, "short item of six words short item of six"),
    (5, "É É and é"),
    (6, None),
    (7, ""),
    (7, ITEM),
    (None, "a b c d e f g h i j"),
    (8, "one two " * 50_000 + ITEM),
    (9, "a a b c d e f g h i j j"),
]


@pytest.mark.parametrize("block", [200_000, 2])
def test_matches_brute_force(spark, documents, block):  # noqa: F811
    items = spark.createDataFrame(ITEMS, "item_id long, text string").withColumn("doc_id", F.lit("clash"))
    docs = documents(DOCS).withColumn("n_hit", F.lit("clash")).withColumn("items", F.lit("clash"))
    got = D.find(docs, items, block_windows=block).collect()
    assert sorted((-1 if r[0] is None else r[0], *r[1:]) for r in got) == plain(DOCS, ITEMS)


def test_random_words(spark, documents):  # noqa: F811
    import random

    rnd = random.Random(4)
    text = lambda n: " ".join(rnd.choice("ab") for _ in range(n))
    items = [(k, text(rnd.randint(1, 14))) for k in range(60)]
    docs = [(k, text(rnd.randint(0, 300))) for k in range(40)]
    got = D.find(documents(docs), spark.createDataFrame(items, "item_id long, text string"), size=6).collect()
    assert sorted(map(tuple, got)) == plain(docs, items, 6)


def test_empty_tables(spark, documents):  # noqa: F811
    none = spark.createDataFrame([], "item_id long, text string")
    assert [tuple(r)[1:4] for r in D.find(documents([(1, "a b")]), none).collect()] == [(2, 0, 0)]
    assert D.find(documents(DOCS).limit(0), spark.createDataFrame(ITEMS, "item_id long, text string")).count() == 0


def test_shifts_skip(spark):
    """Text without a pattern's blocks is read in steps of a window."""
    machine = D.build([(ITEM.rsplit(" ", 3)[0], ["1"])])[0]

    class Counted(list):
        reads = 0

        def __getitem__(self, k):
            Counted.reads += 1
            return list.__getitem__(self, k)

    machine.search(Counted([b"other"] * 9000), hit := set(), set())
    assert not hit and Counted.reads <= 2 * 1001


def test_many_blocks_keep_the_driver_small(spark, documents, monkeypatch):  # noqa: F811
    """However many windows there are, a block of them is collected at a time."""
    import random

    rnd = random.Random(6)
    text = lambda n: " ".join(rnd.choice("abcdefgh") for _ in range(n))
    items = [(k, text(rnd.randint(3, 40))) for k in range(120)]
    docs = [(k, text(rnd.randint(0, 60)) + " " + rnd.choice(items)[1]) for k in range(50)]
    seen, build = [], D._pass
    monkeypatch.setattr(D, "_pass", lambda tables: seen.append(sum(len(i) for _, i in tables.value)) or build(tables))
    got = D.find(documents(docs), spark.createDataFrame(items, "item_id long, text string"), size=8, block_windows=300)
    assert sorted(map(tuple, got.collect())) == plain(docs, items, 8)
    assert len(seen) > 5 and max(seen) < 600
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert plan.split("== Initial Plan ==")[0].count("MapInArrow") == 1

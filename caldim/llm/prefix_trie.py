"""Prefix trie of rebuilt conversations by composable fingerprints.

A rebuilt conversation is the head of another one (its base) followed by its own
turns after as many. No rebuilt text is made. A turn stands for itself by a
symbol, and a run of turns by its product in a monoid: (R ** turns, hash), where
joining two runs gives (P1 * P2, H1 * P2 + H2) modulo the prime 2 ** 127 - 1.
With the running products of every stored conversation, the product of a base's
head and of an own suffix, and so of each rebuilt prefix, follows from four
numbers.

1. Turns are sorted and stored (``turns``); running products are made for each
   segment of a conversation and carried over partition borders, which at most
   two segments a partition need.
2. Each prefix of each rebuilt conversation is an entry: depth, product, product
   of the prefix before it, and the hash of the stored turn that it ends with.
   Entries with the same depth and product are a node.
3. Equality is verified, not assumed: all members of a node must have the same
   node before them and end with turns of the same hash, and turns of one hash
   must be equal in role and text. Otherwise another radix and hash are taken.
4. A node is represented by its smallest member; the nodes that one conversation
   represents are a tail of its own prefixes. What they add up to from each depth
   on, summed over a node's members, is the sum over the node's subtree, so
   subtrees take one aggregation, whatever their depth.

Aggregations combine on the map side, so a prefix in a third of all
conversations arrives as one row from each task; parents of many children meet
them by a broadcast whose size is bounded (``HOT_NODES``); a node's conversations
are hashed as a stream of packed chunks.

Defined cases: rows with a null conv_id are ignored; null role or text is the
empty one; null turns come first, rows of one turn by role, then text; repeated
rows are turns of their own; other columns are ignored; an empty table gives no
node.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from caldim.llm.common import prepare, stored
from caldim.llm.turns import WHITE, batch, by_part, crossing, ordered, partitions, sql_crc32

PRIME = (1 << 127) - 1
#: Conversations of a base group, and most turns of a head plus one.
GROUP, HEADS = 20, 4
#: Rows of one conversation that are handled together.
BLOCK = 4096
#: Nodes that may be broadcast; any other has fewer children than a share of
#: 1 / HOT_NODES of all nodes, or than FEW.
HOT_NODES, FEW = 100_000, 256
#: Bytes of ids that are hashed at once.
CHUNK = 1 << 16
_LOW = (1 << 64) - 1


def _halves(v: int) -> tuple[int, int]:
    """A number below 2 ** 127 as two longs."""
    low = v & _LOW
    return v >> 64, low - (1 << 64) if low >> 63 else low


def _whole(high: int, low: int) -> int:
    return (high << 64) | (low & _LOW)


def _symbol(h1: int, h2: int) -> int:
    return (((h1 & _LOW) << 64) | (h2 & _LOW)) % PRIME


def radix(attempt: int) -> int:
    return int.from_bytes(hashlib.sha256(f"radix {attempt}".encode()).digest()[:16], "big") % PRIME


class Powers(list):
    """Powers of the radix, made up to those asked for and BLOCK at most."""

    def __init__(self, base: int):
        super().__init__([1])
        self.base = base

    def to(self, n: int) -> int:
        if n > BLOCK:
            return pow(self.base, n, PRIME)
        while len(self) <= n:
            self.append(self[-1] * self.base % PRIME)
        return self[n]


def _turns(conversations: DataFrame) -> DataFrame:
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c)
    rows = conversations.filter("conv_id is not null").select(F.col("conv_id").cast("long").alias("conv_id"), "turn", text("role"), text("text"))
    return ordered(rows, ["conv_id", "turn", "role", "text"], "turns")


def _words() -> Column:
    """Words of a text."""
    return F.regexp_count("text", F.lit(f"[^{WHITE}]+")).cast("long")


def _hashes(attempt: int) -> list[Column]:
    return [
        F.xxhash64(F.lit(attempt), F.col("role"), F.col("text")).alias("h1"),
        F.xxhash64(F.lit("second"), F.lit(attempt), F.col("text"), F.col("role")).alias("h2"),
    ]


PRODUCTS = "conv_id long, part int, k long, p1 long, p2 long, h1 long, h2 long, words long"
_PRODUCTS = pa.schema([(f.split()[0], pa.int32() if f.startswith("part") else pa.int64()) for f in PRODUCTS.split(", ")])


def _products(t: DataFrame, attempt: int) -> DataFrame:
    """Each turn with its place k in its conversation and the product up to it."""
    base = radix(attempt)
    rows = t.select("conv_id", "part", "rid", *_hashes(attempt), _words().alias("words"))

    def within(batches):
        now, k, p = None, 0, 0
        for b in batches:
            out = []
            for conv, part, _, h1, h2, words in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if (conv, part) != now:
                    now, k, p = (conv, part), 0, 0
                k, p = k + 1, (p * base + _symbol(h1, h2)) % PRIME
                out.append((conv, part, k, *_halves(p), h1, h2, words))
            yield batch(out, _PRODUCTS)

    local = stored(by_part(rows, "rid").mapInArrow(within, PRODUCTS), "segment-products")
    ends = local.groupBy("conv_id", "part").agg(F.max("k").alias("k"), F.max_by(F.struct("p1", "p2"), "k").alias("p"))
    chains: dict = {}
    for r in crossing(ends).collect():
        chains.setdefault(r.conv_id, []).append((r.part, r.k, _whole(r.p.p1, r.p.p2)))
    before = {}
    for conv, chain in chains.items():
        k, p = 0, 0
        for part, n, h in sorted(chain):
            before[conv, part] = (k, p)
            k, p = k + n, (p * pow(base, n, PRIME) + h) % PRIME
    carried = t.sparkSession.sparkContext.broadcast(before)

    def joined(batches):
        known, powers = carried.value, Powers(base)
        for b in batches:
            out = []
            for row in zip(*(c.to_pylist() for c in b.columns), strict=True):
                got = known.get(row[:2])
                if got:
                    k0, p0 = got
                    p = (p0 * powers.to(row[2]) + _whole(row[3], row[4])) % PRIME
                    row = (*row[:2], row[2] + k0, *_halves(p), *row[5:])
                out.append(row)
            yield batch(out, _PRODUCTS)

    return local.mapInArrow(joined, PRODUCTS)


ENTRY = "conv_id long, depth long, f1 long, f2 long, q1 long, q2 long, h1 long, h2 long, words long, ends boolean"
_ENTRY = pa.schema([(f.split()[0], pa.bool_() if f.startswith("ends") else pa.int64()) for f in ENTRY.split(", ")])


def _entries(products: DataFrame, attempt: int) -> DataFrame:
    """ENTRY rows: every prefix of every rebuilt conversation."""
    base = radix(attempt)
    back = pow(base, -1, PRIME)
    turn = F.struct("p1", "p2", "h1", "h2", "words")
    at = lambda j: F.max(F.when(F.col("k") == j, turn)).alias(f"t{j}")
    convs = products.groupBy("conv_id").agg(F.max("k").alias("n"), *(at(j) for j in range(1, HEADS)))
    convs = stored(convs, "conversation-heads")
    first = [f"t{j}" for j in range(1, HEADS)]
    bases = convs.select(F.col("conv_id").alias("base"), F.col("n").alias("base_n"), *(F.col(c).alias(f"base_{c}") for c in first))
    wanted = (F.crc32(F.col("conv_id").cast("string")) % HEADS).cast("int")
    convs = convs.withColumn("base", F.col("conv_id") - F.col("conv_id") % GROUP).withColumn("h", wanted)
    convs = convs.join(bases, "base", "left")
    convs = convs.withColumn("head", F.least("h", F.coalesce("base_n", F.lit(0))).cast("int"))
    convs = convs.withColumn("total", F.col("head") + F.greatest(F.col("n") - F.col("h"), F.lit(0)))
    none = F.struct(*(F.lit(0).cast("long").alias(c) for c in ("p1", "p2", "h1", "h2", "words")))
    heads = F.array(none, *(F.col(f"base_t{j}") for j in range(1, HEADS)))
    own = F.array(none, *(F.col(f"t{j}") for j in range(1, HEADS)))
    convs = convs.select(
        "conv_id", "n", "h", "head", "total", heads.alias("heads"),
        F.get("heads", "head").alias("from"), F.get(own, "h").alias("to"),
    )
    convs = stored(convs, "rebuilt")
    top = convs.select("conv_id", "total", F.posexplode(F.slice("heads", F.lit(1), F.col("head").cast("int") + 1)).alias("depth", "turn"), "heads")
    prior = F.coalesce(F.get("heads", F.col("depth") - 1), none)
    top = top.select(
        "conv_id", F.col("depth").cast("long").alias("depth"), F.col("turn.p1").alias("f1"), F.col("turn.p2").alias("f2"),
        prior["p1"].alias("q1"), prior["p2"].alias("q2"), F.col("turn.h1").alias("h1"), F.col("turn.h2").alias("h2"),
        F.col("turn.words").alias("words"), (F.col("depth") == F.col("total")).alias("ends"),
    )
    # a conversation's numbers meet its turns block by block
    blocks = F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(n - 1) div {BLOCK}"))).alias("block")
    numbers = convs.filter("n > h").select(
        "conv_id", "h", "head", "total", F.col("from.p1").alias("a1"), F.col("from.p2").alias("a2"), F.col("to.p1").alias("b1"), F.col("to.p2").alias("b2"), blocks
    )
    own = products.withColumn("block", F.expr(f"(k - 1) div {BLOCK}")).join(numbers, ["conv_id", "block"]).filter("k > h")
    own = own.select("conv_id", "k", "p1", "p2", "h1", "h2", "words", "h", "head", "total", "a1", "a2", "b1", "b2")

    def run(batches):
        powers = Powers(base)
        for b in batches:
            out = []
            for conv, k, p1, p2, h1, h2, words, h, head, total, a1, a2, b1, b2 in zip(*(c.to_pylist() for c in b.columns), strict=True):
                # head, then the own turns h + 1 to k: a product's tail is it less its beginning
                f = (_whole(p1, p2) + (_whole(a1, a2) - _whole(b1, b2)) * powers.to(k - h)) % PRIME
                q = (f - _symbol(h1, h2)) * back % PRIME
                depth = head + k - h
                out.append((conv, depth, *_halves(f), *_halves(q), h1, h2, words, depth == total))
            yield batch(out, _ENTRY)

    return stored(top.unionByName(own.mapInArrow(run, ENTRY)), "prefixes")


def _nodes(entries: DataFrame) -> tuple[DataFrame, bool]:
    """Nodes with their smallest member, and whether each one's members agree in
    what comes before and in their last turn."""
    same = ["q1", "q2", "h1", "h2", "words"]
    nodes = entries.groupBy("depth", "f1", "f2").agg(
        F.count("*").alias("n_convs"), F.min("conv_id").alias("conv_id"), F.sum(F.col("ends").cast("long")).alias("n_ends"),
        *(F.min(c).alias(c) for c in same), *(F.max(c).alias(f"most_{c}") for c in same),
    )
    nodes = stored(nodes, "nodes")
    differ = " or ".join(f"{c} <> most_{c}" for c in same)
    return nodes.drop(*(f"most_{c}" for c in same)), nodes.filter(differ).isEmpty()


def _one_turn_a_hash(t: DataFrame, attempt: int) -> bool:
    distinct = t.select(*_hashes(attempt), "role", "text").distinct()
    return distinct.groupBy("h1", "h2").agg(F.count("*").alias("n")).filter("n > 1").isEmpty()


def _ends(entries: DataFrame) -> DataFrame:
    """(depth, f1, f2, ends_sha256) of nodes at which conversations end."""
    keys = ["depth", "f1", "f2"]
    rows = entries.filter("ends").select(*keys, "conv_id")
    spread = rows.repartitionByRange(partitions(rows), *keys, "conv_id").sortWithinPartitions(*keys, "conv_id")
    packed = pa.schema([*((k, pa.int64()) for k in keys), ("first", pa.int64()), ("ids", pa.binary())])

    def pack(batches):
        now, first, held, size = None, None, [], 0
        for b in batches:
            out = []
            for d, f1, f2, conv in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if (d, f1, f2) != now or size > CHUNK:
                    if now is not None:
                        out.append((*now, first, b",".join(held)))
                    now, first, held, size = (d, f1, f2), conv, [], 0
                held.append(b"%d" % conv)
                size += len(held[-1]) + 1
            yield batch(out, packed)
        if now is not None:
            yield batch([(*now, first, b",".join(held))], packed)

    digests = pa.schema([*((k, pa.int64()) for k in keys), ("ends_sha256", pa.string())])

    def digest(batches):
        now, sha = None, None
        for b in batches:
            out = []
            keyed = zip(*(b.column(i).to_pylist() for i in range(3)), strict=True)
            for key, ids in zip(keyed, b.column(4), strict=True):
                if key != now:
                    if now is not None:
                        out.append((*now, sha.hexdigest()))
                    now, sha = key, hashlib.sha256()
                else:
                    sha.update(b",")
                sha.update(ids.as_buffer())
            yield batch(out, digests)
        if now is not None:
            yield batch([(*now, sha.hexdigest())], digests)

    ddl = "depth long, f1 long, f2 long, "
    chunks = spread.mapInArrow(pack, ddl + "first long, ids binary")
    chunks = chunks.repartition(*keys).sortWithinPartitions(*keys, "first")
    return chunks.mapInArrow(digest, ddl + "ends_sha256 string")


def _subtrees(entries: DataFrame, nodes: DataFrame) -> DataFrame:
    """(depth, f1, f2, n_leaves, saved_tokens): a conversation adds, at each of
    its prefixes, what the nodes that it represents hold from there on."""
    held = nodes.select(
        "conv_id", "depth", ((F.col("n_convs") - 1) * F.col("words")).alias("saved"), (F.col("n_ends") == F.col("n_convs")).cast("long").alias("leaf")
    )
    rows = entries.select("conv_id", "depth", "f1", "f2").join(held, ["conv_id", "depth"], "left")
    rows = rows.withColumn("block", F.expr(f"depth div {BLOCK}"))
    down = Window.partitionBy("conv_id", "block").orderBy(F.desc("depth")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = rows.select(
        "conv_id", "block", "depth", "f1", "f2", *(F.coalesce(F.sum(c).over(down), F.lit(0)).alias(c) for c in ("saved", "leaf"))
    )
    # blocks after the first one add what lies in them to those before
    totals = rows.groupBy("conv_id", "block").agg(F.max("saved").alias("all_saved"), F.max("leaf").alias("all_leaf"))
    after = Window.partitionBy("conv_id").orderBy(F.desc("block")).rowsBetween(Window.unboundedPreceding, -1)
    later = totals.select(
        "conv_id", "block", *(F.coalesce(F.sum(f"all_{c}").over(after), F.lit(0)).alias(f"more_{c}") for c in ("saved", "leaf"))
    )
    rows = rows.join(later, ["conv_id", "block"])
    return rows.groupBy("depth", "f1", "f2").agg(
        F.sum(F.col("leaf") + F.col("more_leaf")).alias("n_leaves"), F.sum(F.col("saved") + F.col("more_saved")).alias("saved_tokens")
    )


def _with_parents(nodes: DataFrame) -> DataFrame:
    """Nodes with their number of children and their parent's conv_id."""
    up = [(F.col("depth") - 1).alias("depth"), F.col("q1").alias("f1"), F.col("q2").alias("f2")]
    children = nodes.filter("depth > 0").select(*up).groupBy("depth", "f1", "f2").agg(F.count("*").alias("n_children"))
    nodes = nodes.join(children, ["depth", "f1", "f2"], "left").withColumn("n_children", F.coalesce("n_children", F.lit(0)))
    nodes = stored(nodes, "nodes-and-children")
    most = max(FEW, nodes.count() // HOT_NODES)
    parent = [F.col("depth").alias("d"), F.col("f1").alias("g1"), F.col("f2").alias("g2"), F.col("conv_id").alias("parent_conv_id")]
    on = (F.col("depth") - 1 == F.col("d")) & (F.col("q1") == F.col("g1")) & (F.col("q2") == F.col("g2"))
    hot = nodes.filter(F.col("n_children") > most).select(*parent)  # HOT_NODES at most
    rest = nodes.filter((F.col("n_children") > 0) & (F.col("n_children") <= most)).select(*parent)
    of_hot = nodes.join(F.broadcast(hot), on, "left")
    found = of_hot.filter("parent_conv_id is not null or depth = 0").drop("d", "g1", "g2")
    left = of_hot.filter("parent_conv_id is null and depth > 0").drop("d", "g1", "g2", "parent_conv_id")
    return found.unionByName(left.join(rest, on).drop("d", "g1", "g2"))


def trie(conversations: DataFrame) -> DataFrame:
    """(conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens, ends_sha256) of each node."""
    prepare(conversations.sparkSession)
    t = _turns(conversations)
    attempt = 0
    while True:
        while not _one_turn_a_hash(t, attempt):
            attempt += 1
        entries = _entries(_products(t, attempt), attempt)
        nodes, sure = _nodes(entries)
        if sure:
            break
        attempt += 1
    keys = ["depth", "f1", "f2"]
    out = _with_parents(nodes).join(_subtrees(entries, nodes), keys).join(_ends(entries), keys, "left")
    none = hashlib.sha256(b"").hexdigest()
    return out.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.lit(none)).alias("ends_sha256"),
    )


def oracle_sql() -> str:
    """The trie by lists of whole turns."""
    crc = sql_crc32("c.conv_id::VARCHAR")
    words = r"len(regexp_extract_all(text, '[^\x20\x09-\x0D]+'))"
    return f"""
    WITH placed AS (
      SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
             row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS k
      FROM conversations WHERE conv_id IS NOT NULL),
    convs AS (
      SELECT c.conv_id, n, {crc} % 4 AS h, c.conv_id - c.conv_id % 20 AS base
      FROM (SELECT conv_id, max(k) AS n FROM placed GROUP BY conv_id) c),
    rebuilt AS (
      SELECT c.conv_id, p.role, p.text, p.k AS o FROM convs c JOIN placed p ON p.conv_id = c.base AND p.k <= c.h
      UNION ALL
      SELECT c.conv_id, p.role, p.text, p.k + 10 FROM convs c JOIN placed p ON p.conv_id = c.conv_id AND p.k > c.h),
    deep AS (
      SELECT conv_id, text, row_number() OVER w AS depth, list([role, text]) OVER w AS path
      FROM rebuilt WINDOW w AS (PARTITION BY conv_id ORDER BY o)),
    entries AS (
      SELECT conv_id, depth, path, {words} AS words FROM deep
      UNION ALL SELECT conv_id, 0, []::VARCHAR[][], 0 FROM convs),
    totals AS (SELECT conv_id, max(depth) AS total FROM entries GROUP BY conv_id),
    nodes AS (
      SELECT depth, path, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(words) AS words,
             coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE depth = total), '') AS ends
      FROM entries JOIN totals USING (conv_id) GROUP BY depth, path),
    below AS (SELECT depth - 1 AS depth, path[:-2] AS path, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY ALL),
    under AS (
      SELECT e.depth, e.path, count_if(b.depth IS NULL) AS n_leaves, sum((d.n_convs - 1) * d.words) AS saved
      FROM nodes d LEFT JOIN below b ON b.depth = d.depth AND b.path = d.path
      JOIN entries e ON e.conv_id = d.conv_id AND e.depth <= d.depth GROUP BY ALL)
    SELECT n.conv_id, n.depth, p.conv_id AS parent_conv_id, n.n_convs, coalesce(b.n_children, 0) AS n_children,
           u.n_leaves, CAST(u.saved AS BIGINT) AS saved_tokens, sha256(n.ends) AS ends_sha256
    FROM nodes n JOIN under u ON u.depth = n.depth AND u.path = n.path
    LEFT JOIN below b ON b.depth = n.depth AND b.path = n.path
    LEFT JOIN nodes p ON p.depth = n.depth - 1 AND p.path = n.path[:-2]"""

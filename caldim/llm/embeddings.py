"""Near-duplicate vectors by collision counting on one-dimensional projections.

Unit vectors are projected on ``projections`` random directions. A pair at the
cosine limit c lies sqrt(2 - 2c) apart, so its difference on any one projection
is normal with that deviation, and each query-centred window of ``WIDTH``
deviations collides with a known probability. The count of collisions over all
projections is binomial; ``least_count`` is the largest count that a pair at the
limit reaches with probability ``recall`` (closer pairs more surely). Pairs that
reach it are verified by their cosine in double precision, so no pair below the
limit is ever linked.

Equal vectors (same label) are one class, whatever their number. Classes of a
label are cut by their first projection into cells and by hash into blocks of at
most about ``BLOCK`` rows; blocks whose cells lie within the first projection's
wide window (``REACH`` deviations) meet in one task each, sorted there on every
projection. A task returns, for each row, how many vectors it links to and one
edge of a spanning forest - as many rows as it reads, never its pairs.

Defined cases: vectors that are null, empty, zero or hold null or non-finite
components, and vectors without a label, link with nothing (n_links 0, component
their own id, kept); vectors of different lengths do not link; a null vec_id is
linked and counted, names no component and is not kept unless nothing is linked;
rows that repeat are linked to each other; an empty table gives none; other
columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caldim.llm.common import prepare, stored
from caldim.llm.graph import components

PROJECTIONS, WIDTH, REACH, RECALL = 32, 2.0, 5.0, 0.99999
BLOCK, SEED = 2048, 17


def directions(dim: int, projections: int) -> np.ndarray:
    return np.random.default_rng([SEED, dim]).standard_normal((dim, projections))


def least_count(projections: int, recall: float, width: float = WIDTH) -> int:
    """Largest count that Binomial(projections, P(|N| <= width)) reaches with
    probability ``recall``."""
    p = math.erf(width / math.sqrt(2))
    tail = 0.0
    for k in range(projections + 1):
        tail += math.comb(projections, k) * p**k * (1 - p) ** (projections - k)
        if tail > 1 - recall:
            return k
    return projections


def _matrix(col: pa.ChunkedArray | pa.Array) -> np.ndarray:
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    flat = col.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(col), -1) if len(col) else np.zeros((0, 0))


def block_links(
    u: np.ndarray, v: np.ndarray | None, limit: float, projections: int, least: int
) -> tuple[np.ndarray, np.ndarray]:
    """(i, j) of linked rows of u and v (None: u with itself, i < j)."""
    dirs = directions(u.shape[1], projections)
    unit = lambda x: x / np.linalg.norm(x, axis=1, keepdims=True)
    a = unit(u)
    b = a if v is None else unit(v)
    w = np.float32(WIDTH * math.sqrt(2 - 2 * limit))
    on_a, on_b = (a @ dirs).astype(np.float32), (b @ dirs).astype(np.float32)
    found = []
    for s in range(0, len(a), 256):
        rows = on_a[s : s + 256]
        count = np.zeros((len(rows), len(b)), np.uint8)
        for k in range(projections):
            order = np.argsort(on_b[:, k], kind="stable")
            ranked = on_b[order, k]
            # the window around each query is a run of the sorted projection
            low, high = np.searchsorted(ranked, rows[:, k] - w, "left"), np.searchsorted(ranked, rows[:, k] + w, "right")
            edge = np.zeros((len(rows), len(b) + 1), np.int8)
            at = np.arange(len(rows))
            edge[at, low] += 1
            edge[at, high] -= 1
            rank = np.empty(len(b), np.int64)
            rank[order] = np.arange(len(b))
            inside = np.cumsum(edge[:, :-1], axis=1, dtype=np.int8)
            count += inside[:, rank].view(np.uint8)
        i, j = np.nonzero(count >= least)
        if v is None:
            i, j = i[i + s < j], j[i + s < j]
        for t in range(0, len(i), 1 << 16):
            x, y = a[i[t : t + (1 << 16)] + s], b[j[t : t + (1 << 16)]]
            ok = np.einsum("ij,ij->i", x, y) >= limit
            found.append((i[t : t + (1 << 16)][ok] + s, j[t : t + (1 << 16)][ok]))
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    i, j = zip(*found, strict=True)
    return np.concatenate(i), np.concatenate(j)


def forest(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Smallest row of each row's component under the edges (i, j)."""
    label = np.arange(n)
    while True:
        new = label.copy()
        m = np.minimum(label[i], label[j])
        np.minimum.at(new, i, m)
        np.minimum.at(new, j, m)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def near_duplicates(
    vectors: DataFrame, limit: float = 0.93, projections: int = PROJECTIONS, recall: float = RECALL
) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every vector."""
    prepare(vectors.sparkSession)
    e = F.col("e")
    rows = vectors.select("vec_id", F.col("label").cast("string").alias("label"), F.col("embedding").cast("array<double>").alias("e"))
    usable = F.col("label").isNotNull() & (F.size("e") > 0) & F.forall("e", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = rows.withColumn("ok", F.coalesce(usable & F.exists(e, lambda x: x != 0), F.lit(False)))
    key = F.struct(F.xxhash64("label", "e").alias("h1"), F.xxhash64(F.lit("second"), "label", "e").alias("h2"))
    rows = stored(rows.withColumn("key", F.when(F.col("ok"), key)), "vectors")

    classes = rows.filter("ok").groupBy("key").agg(
        F.min("vec_id").alias("first"), F.count("*").alias("n"), F.first("label").alias("label"), F.first("e").alias("e")
    )
    cell_width = math.sqrt(2 - 2 * limit) * REACH / 3  # cells up to three apart can meet

    def cells(batches):
        for b in batches:
            out = []
            for x in b.column(b.num_columns - 1):
                v = np.array(x.as_py())
                out.append(int(math.floor(v @ directions(len(v), projections)[:, 0] / np.linalg.norm(v) / cell_width)))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(out, pa.int32())], names=[*b.schema.names, "cell"])

    celled = classes.select("key", "first", "n", "label", "e")
    schema = celled.withColumn("cell", F.lit(0)).schema
    celled = celled.mapInArrow(cells, schema).withColumn("cid", F.monotonically_increasing_id())
    celled = stored(celled.withColumn("dim", F.size("e")), "vector-classes")

    # blocks: how many parts a cell needs, and which blocks meet
    groups = celled.groupBy("label", "dim", "cell").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("parts"))
    blocks = groups.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).drop("parts")
    other = blocks.select("label", "dim", F.col("cell").alias("cell2"), F.col("part").alias("part2"))
    reach = blocks.withColumn("cell2", F.explode(F.sequence(F.col("cell"), F.col("cell") + 3)))
    meets = reach.join(other, ["label", "dim", "cell2"]).filter("cell2 > cell or part2 >= part")
    meets = meets.withColumn("pair", F.xxhash64("label", "dim", "cell", "part", "cell2", "part2"))
    alone = (F.col("cell2") == F.col("cell")) & (F.col("part2") == F.col("part"))
    first = meets.select("label", "dim", "cell", "part", "pair", F.when(alone, 2).otherwise(0).alias("side"))
    second = meets.filter("cell2 > cell or part2 > part").select(
        "label", "dim", F.col("cell2").alias("cell"), F.col("part2").alias("part"), "pair", F.lit(1).alias("side")
    )
    member = celled.join(groups, ["label", "dim", "cell"]).withColumn("part", F.pmod(F.xxhash64("cid"), F.col("parts")).cast("int"))
    dealt = member.join(first.unionByName(second), ["label", "dim", "cell", "part"]).select("pair", "side", "cid", "n", "e")
    least = least_count(projections, recall)

    def link(table: pa.Table) -> pa.Table:
        side = table["side"].to_numpy()
        cid, n = table["cid"].to_numpy(), table["n"].to_numpy()
        e = _matrix(table["e"])
        one, two = np.nonzero(side != 1)[0], np.nonzero(side == 1)[0]
        if side.max() == 2:  # a block that meets itself
            i, j = block_links(e, None, limit, projections, least)
        elif len(one) and len(two):
            i, j = block_links(e[one], e[two], limit, projections, least)
            i, j = one[i], two[j]
        else:
            i = j = np.zeros(0, np.int64)
        links = np.zeros(len(cid), np.int64)
        np.add.at(links, i, n[j])
        np.add.at(links, j, n[i])
        root = forest(len(cid), i, j)
        some = links > 0
        return pa.table({"cid": cid[some], "links": links[some], "root": cid[root[some]]})

    found = stored(dealt.groupBy("pair").applyInArrow(link, "cid long, links long, root long"), "vector-links")
    totals = found.groupBy("cid").agg(F.sum("links").alias("links"))
    comp = components(found, "cid", "root").select(F.col("node").alias("cid"), "root")
    named = celled.select("key", "cid", "first", "n").join(totals, "cid", "left").join(comp, "cid", "left")
    named = named.withColumn("root", F.coalesce("root", "cid"))
    smallest = named.groupBy("root").agg(F.min("first").alias("component"))
    named = named.join(smallest, "root").select("key", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("links"), "component")
    out = rows.select("vec_id", "ok", "key").join(named, "key", "left")
    component = F.when(F.col("ok"), F.col("component")).otherwise(F.col("vec_id"))
    return out.select(
        "vec_id",
        F.coalesce("links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        (component.eqNullSafe(F.col("vec_id")) & (F.col("vec_id").isNotNull() | (F.coalesce("links", F.lit(0)) == 0))).alias("kept"),
    )


def oracle_sql(limit: float = 0.93) -> str:
    """All pairs of a label, then the smallest id reachable."""
    return f"""
    WITH RECURSIVE v AS (
      SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
      WHERE label IS NOT NULL AND len(embedding) > 0
        AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
        AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
    edges AS (
      SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id
        AND len(a.e) = len(b.e) WHERE list_cosine_similarity(a.e, b.e) >= {limit}),
    reach(a, b) AS (
      SELECT vec_id, vec_id FROM embeddings UNION SELECT r.a, e.b FROM reach r JOIN edges e ON r.b = e.a),
    c AS (SELECT a AS vec_id, min(b) AS component_id FROM reach GROUP BY a),
    n AS (SELECT a AS vec_id, count(*) AS n_links FROM edges GROUP BY a)
    SELECT c.vec_id, CAST(coalesce(n.n_links, 0) AS BIGINT) AS n_links, c.component_id,
           c.vec_id = c.component_id AS kept
    FROM c LEFT JOIN n USING (vec_id)"""

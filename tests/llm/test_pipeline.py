"""The pipeline: each stage on its own input against brute force."""

import corpus_pipeline as C
from llm_fixtures import SF001, documents  # noqa: F401
from pyspark.sql import functions as F
from test_decontaminate import plain as plain_windows
from test_packing import check
from test_simhash import plain_components, plain_fingerprint

from caldim.llm import line_dedup, quality
from caldim.llm.common import stored


def test_stages(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    seen = [docs]
    for name, stage in C.STAGES:
        seen.append(stored(stage(spark, seen[-1], SF001), f"test-{name}"))
    assert all(d.columns == docs.columns for d in seen[:-1])
    rows = [{r.doc_id: r.text for r in d.select("doc_id", "text").collect()} for d in seen[:-1]]

    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF001}/labels.parquet").collect()}
    model = quality.train(docs, spark.read.parquet(f"{SF001}/labels.parquet"))
    kept = {r.doc_id for r in quality.score(docs, model).filter(f"score >= {C.KEEP_FROM}").collect()}
    assert set(rows[1]) == kept and all(rows[0][i] == t for i, t in rows[1].items())
    good = [i for i, q in labels.items() if q == 1]
    assert sum(i in rows[1] for i in good) >= 0.98 * len(good)

    sites = {}
    source = {r.doc_id: r.source for r in docs.collect()}
    first = {}
    for i, t in rows[1].items():
        for line in t.split("\n"):
            k = line.strip(" \t\r")
            sites.setdefault(k, set()).add(source[i])
            first[k] = min(first.get(k, i), i)
    usual, short = line_dedup.thresholds(len({source[i] for i in rows[1]}))
    for i, t in rows[1].items():
        lines = [x for x in t.split("\n") if not (k := x.strip(" \t\r")) or len(sites[k]) < (short if len(k) < 20 else usual) or first[k] == i]
        assert rows[2][i] == "\n".join(lines)
    assert all(r.n_chars == len(r.text) for r in seen[2].collect() if rows[1][r.doc_id] != r.text)

    ids = sorted(rows[2])
    comp = plain_components(ids, [plain_fingerprint(rows[2][i]) for i in ids])
    assert rows[3] == {i: rows[2][i] for i, c in zip(ids, comp, strict=True) if i == c}

    bench = [tuple(r) for r in spark.read.parquet(f"{SF001}/benchmark.parquet").select("item_id", "text").collect()]
    clean = {r[0] for r in plain_windows(sorted(rows[3].items()), bench) if not r[-1]}
    assert rows[4] == {i: rows[3][i] for i in clean}

    n, least = check(seen[-1], seen[-2])
    assert n <= least * 1.02 + 1
    digest = lambda d: sorted(map(tuple, d.select("doc_id", "piece", "ids_crc32").collect()))
    assert digest(C.run(spark, SF001)) == digest(seen[-1])


def test_rows_without_an_id_or_with_a_shared_one(spark, documents):  # noqa: F811
    """Each row is judged by itself; one row of a group stays."""
    left = lambda stage, rows: sorted(map(str, ((r.doc_id, r.text) for r in stage(spark, documents(rows), SF001).collect())))
    item = max((r.text or "" for r in spark.read.parquet(f"{SF001}/benchmark.parquet").collect()), key=len)
    rows = [(None, item), (None, "clean"), (5, item), (5, "clean too"), (6, "x " + item), (7, None), (7, None)]
    assert left(C.decontamination_filter, rows) == sorted(map(str, [(None, "clean"), (5, "clean too"), (7, None), (7, None)]))

    a, b, c, d = (" ".join(f"{x}{k}" for k in range(40)) for x in "abcd")
    rows = [(None, a), (None, a), (None, a), (3, b), (3, b), (4, b), (None, b), (3, c), (4, d), (None, d)]
    assert left(C.near_duplicate_filter, rows) == sorted(map(str, [(None, a), (3, b), (3, c), (4, d)]))
    assert left(C.near_duplicate_filter, [(None, None), (None, "")]) in (["(None, None)"], ["(None, '')"])


def test_columns_of_any_name_stay(spark, documents):  # noqa: F811
    """Extra columns come out as they went in, whatever the stages call theirs."""
    line = "A line that every one of these sites has in its documents."
    rows = [(k, f"{line}\nwords of {k} alone and more of them {k * 7}", f"s{k}") for k in range(12)]
    docs = documents(rows)
    extra = ["score", "predicted", "n_lines", "n_removed", "row", "__row", "cut", "cut_of", "kept_lines", "__id", "__cut", "__kept", "text_", "hot", "cold", "salt", "key"]
    for c in extra:
        docs = docs.withColumn(c, F.concat(F.lit(c), F.col("doc_id").cast("string")))
    for name, stage in C.STAGES[:-1]:
        out = stage(spark, docs, SF001)
        assert out.columns == docs.columns and out.dtypes == docs.dtypes, name
        got = out.collect()
        assert got or name == "quality_classifier"
        assert all(r[c] == f"{c}{r.doc_id}" for r in got for c in extra), name

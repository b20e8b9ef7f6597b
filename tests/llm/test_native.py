"""Line dedup, secret scan and license scan: defined cases, and no Python in their plans."""

import hashlib
import re

import duckdb
import pytest
from llm_fixtures import SF0001, documents  # noqa: F401
from pyspark.sql import functions as F

from caldim.llm import licenses, line_dedup, secrets
from caldim.llm.queries import ORACLE, QUERIES


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in ("documents", "embeddings", "pages", "benchmark", "conversations"):
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF0001}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF0001)
    res = con.execute(ORACLE[name])
    cols = [d[0] for d in res.description]
    assert sorted(cols) == sorted(df.columns)
    want = sorted(str([dict(zip(cols, r))[c] for c in sorted(cols)]) for r in res.fetchall())
    assert sorted(str([r[c] for c in sorted(cols)]) for r in df.collect()) == want


# line dedup

LONG = "a line that many sites share"


def test_lines(documents):  # noqa: F811
    """The first document keeps a line, others lose it; near-threshold lines are exact."""
    rows = [(k, f"own {k}\n {LONG}\t\r\nshort", f"s{k}") for k in range(20, 32)]
    rows += [(100 + k, "twelve lines of ten sites each", f"s{k % 10}") for k in range(12)]
    rows += [(200 + k, "twelve lines of nine sites each", f"s{k % 9}") for k in range(12)]
    rows += [(300 + k, "short and wide", f"s{k}") for k in range(20)]
    rows += [(500 + k, f"alone with its site {k}", f"s{k}") for k in range(50)]  # thresholds go by the number of sites
    rows += [(400, LONG + "\n\n" + LONG, "s1"), (None, LONG, "s2"), (401, None, "s3"), (402, "", "s4"), (403, "no site\n" + LONG, None), (20, LONG, "s5")]
    df = documents(rows).withColumn("key", F.lit("clash")).withColumn("salt", F.lit("clash")).withColumn("first", F.lit(1))
    got = {}
    for r in line_dedup.remove_boilerplate(df.withColumn("n_lines", F.lit("x"))).collect():
        got.setdefault(r.doc_id, []).append((r.text, r.n_lines, r.n_removed))
        assert r.key == "clash"
    assert sorted(got[20]) == [(LONG, 1, 0), (f"own 20\n {LONG}\t\r\nshort", 3, 0)]
    assert got[25] == [("own 25\nshort", 3, 1)] and got[100][0][2] == 0
    assert all(got[100 + k] == [("", 1, 1)] for k in range(1, 12))
    assert all(got[200 + k][0][2] == 0 for k in range(12)) and all(got[300 + k][0][2] == 0 for k in range(20))
    assert got[400] == [("", 3, 2)] and got[None] == [("", 1, 1)] and got[401] == [(None, 1, 0)]
    assert got[402] == [("", 1, 0)] and got[403] == [("no site", 2, 1)]
    assert line_dedup.remove_boilerplate(df.limit(0)).count() == 0


def test_sketches_and_exact_counts_agree(documents):  # noqa: F811
    """Spread from below to far above the threshold."""
    rows = [(n * 100 + k, f"a line of {n:03d} different sites", f"s{k}") for n in (1, 5, 9, 10, 11, 12, 40, 90) for k in range(n)]
    got = line_dedup.remove_boilerplate(documents(rows)).groupBy(F.expr("doc_id div 100").alias("n")).agg(F.sum("n_removed").alias("x")).collect()
    assert {r.n: r.x for r in got} == {1: 0, 5: 0, 9: 0, 10: 9, 11: 10, 12: 11, 40: 39, 90: 89}


def test_thresholds_go_by_the_number_of_sites(documents):  # noqa: F811
    """Two sites in a table of few, a quarter, ten at most; twice as many for short lines."""
    assert [line_dedup.thresholds(n) for n in (0, 1, 2, 8, 9, 20, 40, 1000)] == [(2, 3), (2, 3), (2, 3), (2, 4), (3, 5), (5, 10), (10, 20), (10, 50)]
    rows = [(k, f"Home\n\nA longer line that two sites share\nown line of the document {k}", f"s{k % 2}") for k in range(6)]
    rows += [(10 + k, f"Home\nabout\nown {k}", f"t{k}") for k in range(3)]
    got = {r.doc_id: r.text for r in line_dedup.remove_boilerplate(documents(rows)).collect()}
    assert got[0] == rows[0][1] and got[3] == "\nown line of the document 3"  # five sites: two, or three for short lines
    assert got[11] == "about\nown 1".replace("about\n", "") and got[10] == "about\nown 0"


def test_hot_lines_and_the_others_meet_alike(documents, monkeypatch):  # noqa: F811
    monkeypatch.setattr(line_dedup, "FEW", 5)
    monkeypatch.setattr(line_dedup, "HOT_KEYS", 10)
    rows = [(k, f"{LONG}\na line for {k // 4} that four of them have\nown {k}", f"s{k}") for k in range(40)]
    got = {r.doc_id: r.n_removed for r in line_dedup.remove_boilerplate(documents(rows), most_sites=3).collect()}
    assert got == {k: (k > 0) + (k % 4 > 0) for k in range(40)}


# secret scan


def base_spans(text):
    out = []
    assign = re.compile(r"""(?:(?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII)
    out += [(m.start(), 0, m.end()) for m in assign.finditer(text) if len(m[1]) >= 6]
    out += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    out += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(out)


def written(spans):
    return ",".join(f"{secrets.KINDS[k]}:{s}:{e}" for s, k, e in spans)


ID, KEY = "AKIA" + "Q1" * 8, "aB3/" * 10
TEXTS = [
    f"é😀 password = 'abc123' {ID}",
    "secret=token: abcdef123 PASSWORD:x api_key=\"a.b-c_d/e=f\" ApiKey :  zzzzzz token==abcdef",
    "0123456789abcdef" * 2 + " " + "ab" * 11 + " passwd=" + "c0ffee" * 5,
    f"{ID}\n{KEY}",
    f"{KEY} and http://host.example/x alone",
    f"{ID}" + " far" * 200 + KEY,
    f"http://host.example/x?y {ID} then {KEY}",
    f"http://host.example/x?y {ID}",
    f"https://h/ {ID} token=abcdefgh",
    "AKIA" + "A" * 15 + " AKIAAKIA" + "B" * 20,
    f"{ID} " * 300 + f"{KEY} " * 300,
    None,
    "",
    "token=abcdefg " * 20_000,
]


def test_secrets(documents):  # noqa: F811
    df = documents([(k if k != 3 else None, t) for k, t in enumerate(TEXTS)] + [(0, TEXTS[0])]).withColumn("row", F.lit("clash")).withColumn("base", F.lit(1))
    got = {}
    for r in secrets.scan(df).collect():
        spans = base_spans(TEXTS[3 if r.doc_id is None else r.doc_id] or "")
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(sum(k == n for _, k, _ in spans) for n in range(3)), r.doc_id
        assert r.base_sha256 == hashlib.sha256(written(spans).encode()).hexdigest()
        more = set(r.spans.split(",")) - set(written(spans).split(","))
        got[r.doc_id] = more
    assert got[None] == {"key:21:61"}  # beside an identifier
    assert not got[4] and not got[5] and not got[7] and not got[8] - {"endpoint:0:10"}
    assert got[6] == {"endpoint:0:23", "key:50:90"} and got[8] == {"endpoint:0:10"}
    assert len(got[10]) == sum(1 for k in range(300) if 300 * 21 + k * 41 <= 300 * 21 - 1 + 400)
    assert secrets.scan(df.limit(0)).count() == 0


def test_keys_after_names(documents):  # noqa: F811
    """NAME=key without spaces is a key beside its identifier, and completes an endpoint."""
    aws = "wJalrXUtnFEMI/K7MDENG/bPxRfiCY" + "EXAMPLE1KE"
    texts = [
        (f"aws_access_key_id={ID}\naws_secret_access_key=@", aws),
        (f"{ID} SecretAccessKey=@&x=1", aws),
        (f"{ID} KEY==@", aws),
        (f"{ID} KEY=@", aws[:39] + "="),
        (f"{ID} @", aws[:38] + "=="),
        (f"{ID} @", "k=" + aws[:38]),  # a whole run, as before
        (f"{ID} https://h/ AWS_SECRET_ACCESS_KEY=@", aws),
        (f"{ID} A=@ B=@", aws),
    ]
    none = [f"KEY={aws}", f"{ID} KEY={aws}x", f"{ID} KEY={aws}=", f"{ID} KEY={aws[:39]}", f"{ID} KEY={aws}={aws[:20]}", f"{ID} KEY={aws.lower()}"]
    rows = [(k, t.replace("@", key)) for k, (t, key) in enumerate(texts)] + [(100 + k, t) for k, t in enumerate(none)]
    got = {r.doc_id: [x for x in r.spans.split(",") if x.startswith(("key", "endpoint"))] for r in secrets.scan(documents(rows)).collect()}
    for k, (t, key) in enumerate(texts):
        want = [f"key:{m.start()}:{m.end()}" for m in re.finditer(re.escape(key), rows[k][1])]
        assert len(want) == t.count("@")
        assert [x for x in got[k] if x.startswith("key")] == want, (k, t)
    assert [x for x in got[6] if x.startswith("endpoint")] == ["endpoint:21:31"]
    assert not any(got[100 + k] for k in range(len(none)))


# license scan


def test_licenses(spark):
    t = licenses.TEMPLATES
    rows = [
        (1, "a/LICENSE", t["MIT"]),
        (2, "a/b/c/x.py", "# " + t["Apache-2.0"] + "\ncode here"),
        (3, "a/b/c/y.py", "nothing of the kind"),
        (4, "a/b/LICENSE.txt", "\n".join([t["GPL-3.0"]])),
        (5, "a/z.py", None),
        (6, "top.py", ""),
        (7, None, t["MIT"]),
        (8, None, "x"),
        (9, "ab/q.py", "x"),
        (10, "a/d/COPYING", "prose without a licence " * 50),
        (11, "a/d/w.py", "x"),
        (12, "a/d/w.py", "x"),
        (13, "a/e/long.py", "license word salad " + "many other words " * 3000),
        (14, "a/b/COPYING", t["BSD-3-Clause"]),
    ]
    df = spark.createDataFrame([(*r, "clash", "clash") for r in rows], "id long, path string, text string, dir string, word string")
    got = {r.id: (r.own_license, r.license, r.license_dir) for r in licenses.scan(df).collect()}
    assert got[1] == ("MIT", "MIT", None) and got[2] == ("Apache-2.0", "Apache-2.0", None)
    assert got[3] == (None, "BSD-3-Clause", "a/b")  # the first licence file of the nearest directory
    assert got[5] == (None, "MIT", "a") and got[6] == (None, None, None) and got[7] == ("MIT", "MIT", None)
    assert got[8] == (None, None, None) and got[9] == (None, None, None)
    assert got[10] == got[11] == got[12] == got[13] == (None, "MIT", "a") and len(got) == len(rows)
    assert licenses.scan(df.limit(0)).count() == 0


def test_root_licence(spark):
    rows = [(1, "LICENSE", licenses.TEMPLATES["MIT"]), (2, "a/b/x", "y"), (3, "/abs/x", "y"), (4, "/LICENSE", licenses.TEMPLATES["GPL-3.0"])]
    got = {r.id: (r.license, r.license_dir) for r in licenses.scan(spark.createDataFrame(rows, "id long, path string, text string")).collect()}
    assert got[2] == ("GPL-3.0", "") or got[2] == ("MIT", "")


def test_real_licences(spark):
    """SPDX lines, full texts and the headers of source files, in a table of other words."""
    from pathlib import Path

    text = {f.stem: f.read_text() for f in (Path(licenses.__file__).parent / "license_texts").glob("*.txt")}
    who = "Copyright (c) 2021 Jane Q. Example and contributors\n\n"
    gnu = "# This program is free software: you can redistribute it and/or modify\n# it under the terms of the GNU {} as published by\n# the Free Software Foundation, either version {} of the License, or\n# (at your option) any later version.\n"
    want = {
        "MIT": ["// SPDX-License-Identifier: MIT", "/* SPDX-License-Identifier: MIT */", "# " + text["MIT"].split("(c)\n\n")[1].replace("\n", "\n# ")],
        "Apache-2.0": ["# SPDX-License-Identifier: Apache-2.0", "# SPDX-License-Identifier: MIT OR Apache-2.0", '# Licensed under the Apache License, Version 2.0 (the "License");\n# you may not use this file except in compliance with the License.\nimport x'],
        "BSD-3-Clause": ["SPDX-License-Identifier: BSD-3-Clause\nAll rights reserved."],
        "GPL-3.0": ["SPDX-License-Identifier: GPL-3.0-only", gnu.format("General Public License", 3)],
        "GPL-2.0": [gnu.format("General Public License", 2)],
        "LGPL-3.0": [gnu.format("Lesser General Public License", 3), "SPDX-License-Identifier: LGPL-3.0-or-later"],
        "MPL-2.0": ["/* This Source Code Form is subject to the terms of the Mozilla Public\n * License, v. 2.0. If a copy of the MPL was not distributed with this\n * file, You can obtain one at https://mozilla.org/MPL/2.0/. */"],
        "Zlib": ["SPDX-License-Identifier: Zlib"],
        None: ["SPDX-License-Identifier: LicenseRef-Own", "SPDX-License-Identifier:"],
    }
    rows, expect = [], []
    for name, texts in want.items():
        for x in texts:
            rows.append((len(rows), f"p{len(rows)}/x.py", x + "\n\nprint(zebra)\n"))
            expect.append(name)
    for file, name in licenses.FULL_TEXTS.items():
        rows.append((len(rows), f"p{len(rows)}/LICENSE", who + text[file]))
        expect.append(name)
        rows.append((len(rows), f"p{len(rows)}/COPYING", who + " ".join(text[file].split())))
        expect.append(name)
    rows += [(len(rows) + k, "q/x.txt", f"the file of {k} and a list of words") for k in range(60)]
    found = licenses.scan(spark.createDataFrame(rows, "id long, path string, text string")).collect()
    got, ids = {r.id: r.own_license for r in found}, {r.id: r.spdx for r in found}
    assert ids[expect.index("Apache-2.0") + 1] == "MIT,Apache-2.0" and ids[expect.index("MIT")] == "MIT"
    assert [ids[k] for k, e in enumerate(expect) if e is None] == ["LicenseRef-Own", None]
    assert [got[k] for k in range(len(expect))] == expect
    assert not any(got[k] for k in range(len(expect), len(rows)))


def test_spdx_lines_by_sql(spark):
    """The SQL judges them too: several in a line, unknown ones, in licence files."""
    rows = [(1, "a/x.py", "# SPDX-License-Identifier: MIT\ncode"), (2, "a/LICENSE", "SPDX-License-Identifier: (Apache-2.0 OR GPL-2.0-only) AND Own-1.0")]
    rows += [(3, "a/b/y.py", "nothing"), (4, "c.py", "spdx-license-identifier:\tmit\r\nSPDX-License-Identifier: MIT"), (5, "d.py", "SPDX-License-Identifier: Own"), (6, "e.py", None)]
    df = spark.createDataFrame(rows, "id long, path string, text string")
    c = duckdb.connect()
    c.execute("CREATE TABLE f (id BIGINT, path VARCHAR, text VARCHAR)")
    c.executemany("INSERT INTO f VALUES (?, ?, ?)", rows)
    got = licenses.scan(df).withColumnRenamed("id", "doc_id")
    res = c.execute(licenses.oracle_sql("SELECT * FROM f"))
    cols = [d[0] for d in res.description]
    want = sorted(str([dict(zip(cols, r))[x] for x in sorted(cols)]) for r in res.fetchall())
    assert sorted(str([r[x] for x in sorted(cols)]) for r in got.collect()) == want
    assert {r.doc_id: (r.license, r.spdx) for r in got.collect()}[3] == ("Apache-2.0", None)


@pytest.mark.parametrize("name", ["op4_license_scan", "op6_secret_scan", "op10_line_dedup"])
def test_no_python_in_plans(spark, name):
    plan = QUERIES[name](spark, SF0001)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)

"""Secret scan with multipart credential linking.

Base kinds are found in whole texts by their patterns, leftmost and
non-overlapping per kind, and dropped if too short. Beside them weak candidates
are gathered: "key", 40 base64 characters with upper and lower case letters and
digits (a whole run, or what stands between "=" signs of a longer one, as in
NAME=key), and "endpoint", a URL. Alone these prove nothing; they are
reported only if the parts that complete a credential stand within ``scope``
characters: an access identifier for a key; an access identifier and a secret
(an assignment or a reported key) for an endpoint. The three kinds of parts meet
by interval joins: every interval is dealt to the cells of ``scope`` characters
it reaches, cells are joined by equality, distances compared. They are semi
joins, so many parts in one place give no pairs.

Only DataFrame functions run. Texts are read once; what is joined are spans.

Defined cases: null text is the empty text, without spans; a null doc_id keeps
its row; rows that repeat are scanned each; an empty table gives none; other
columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caldim.llm.common import stored, text_of

#: Patterns of the base kinds, in their order. Fixed values.
ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
HEX_LONG = r"[0-9a-f]{24}"
#: Weak candidates.
KEY = r"[A-Za-z0-9/+=]+"
KEY_LONG = r"[A-Za-z0-9/+=]{40}"
#: A run of 40, or 40 (with padding) after a "=" that ends what stands before. ``oracle_sql`` has whole
#: runs alone (its regular expressions cannot look around): it does not see the keys of NAME=key.
KEY_EDGED = (
    r"(?<![A-Za-z0-9/+=])[A-Za-z0-9/+=]{40}(?![A-Za-z0-9/+=])"
    r"|(?<![A-Za-z0-9/+])(?:[A-Za-z0-9/+]{40}|[A-Za-z0-9/+]{39}=|[A-Za-z0-9/+]{38}==)(?![A-Za-z0-9/+=])"
)
ENDPOINT = r"""https?://[^\x00-\x20"'<>]+"""
#: Kinds in the order that spans at one place are listed.
KINDS = ("assign", "access", "hex", "key", "endpoint")
#: Characters between the parts of a credential, at most.
SCOPE = 400


def _found(text: Column, pattern: str, kind: int, wanted, group: int | None = None) -> Column:
    """Spans (start, kind, end) of a pattern's matches for which ``wanted``
    (match, group) holds. Places are sums of what lies between matches."""
    p = F.lit(pattern)
    between, whole = F.split(text, pattern, -1), F.regexp_extract_all(text, p, F.lit(0))
    rows = F.arrays_zip(
        F.slice(between, 1, F.size(whole)).alias("b"), whole.alias("m"), *([F.regexp_extract_all(text, p, F.lit(group)).alias("g")] if group else [])
    )
    zero = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,kind:int,end:int>>").alias("out"))

    def step(acc, x):
        start = acc["at"] + F.length(x["b"])
        end = start + F.length(x["m"])
        span = F.struct(start.alias("start"), F.lit(kind).alias("kind"), end.alias("end"))
        out = F.when(wanted(x["m"], x["g"] if group else None), F.concat(acc["out"], F.array(span))).otherwise(acc["out"])
        return F.struct(end.alias("at"), out.alias("out"))

    return F.aggregate(rows, zero, step)["out"]


def _none() -> Column:
    return F.array().cast("array<struct<start:int,kind:int,end:int>>")


def spans(docs: DataFrame) -> DataFrame:
    """(row, doc_id, base, weak): spans of every document, written as a table."""
    t = F.col("t")
    rows = docs.select("doc_id", text_of().alias("t"))
    assign = _found(t, ASSIGN, 0, lambda m, g: F.length(g) >= 6, 2)
    access = _found(t, ACCESS, 1, lambda m, g: F.length(m) >= 20)
    hexes = _found(t, HEX, 2, lambda m, g: F.length(m) >= 24)
    keys = _found(t, KEY_EDGED, 3, lambda m, g: m.rlike("[A-Z]") & m.rlike("[a-z]") & m.rlike("[0-9]"))
    urls = _found(t, ENDPOINT, 4, lambda m, g: F.lit(True))
    some = rows.select(
        "doc_id",
        F.when(t.rlike(ASSIGN), assign).otherwise(_none()).alias("assign"),
        F.when(t.rlike(ACCESS), access).otherwise(_none()).alias("access"),
        F.when(t.rlike(HEX_LONG), hexes).otherwise(_none()).alias("hex"),
        F.when(t.contains("AKIA") & t.rlike(KEY_LONG), keys).otherwise(_none()).alias("keys"),
        F.when(t.contains("AKIA") & t.contains("://"), urls).otherwise(_none()).alias("urls"),
    )
    some = some.select(
        F.monotonically_increasing_id().alias("row"),
        "doc_id",
        F.array_sort(F.concat("assign", "access", "hex")).alias("base"),
        F.concat("keys", "urls").alias("weak"),
    )
    return stored(some, "secret-spans")  # row numbers are fixed from here


def _near(parts: DataFrame, others: DataFrame, scope: int) -> DataFrame:
    """The ``parts`` with one of ``others`` within ``scope`` in the same row."""

    def cells(low, high):
        return F.explode(F.sequence(F.floor(low / scope), F.floor(high / scope)))

    a = parts.withColumn("cell", cells(F.col("span.start"), F.col("span.end")))
    b = others.select("row", F.col("span.start").alias("s"), F.col("span.end").alias("e"))
    b = b.withColumn("cell", cells(F.col("s") - scope, F.col("e") + scope))
    close = (F.col("span.start") <= F.col("e") + scope) & (F.col("s") <= F.col("span.end") + scope)
    hit = a.alias("a").join(b.alias("b"), (F.col("a.row") == F.col("b.row")) & (F.col("a.cell") == F.col("b.cell")) & close, "left_semi")
    return hit.select("row", "span").distinct()


def link(found: DataFrame, scope: int = SCOPE) -> DataFrame:
    """(row, span): weak candidates whose complementary parts are near."""
    base = found.filter(F.size("weak") > 0).select("row", F.explode("base").alias("span"))
    weak = found.filter(F.size("weak") > 0).select("row", F.explode("weak").alias("span"))
    access = base.filter("span.kind = 1")
    keys = _near(weak.filter("span.kind = 3"), access, scope)
    secrets = base.filter("span.kind = 0").unionByName(keys)
    ends = _near(_near(weak.filter("span.kind = 4"), access, scope), secrets, scope)
    return keys.unionByName(ends)


def _written(col: str) -> Column:
    names = F.array(*(F.lit(k) for k in KINDS))
    return F.array_join(
        F.transform(col, lambda x: F.concat_ws(":", F.get(names, x["kind"]), x["start"].cast("string"), x["end"].cast("string"))), ","
    )


def scan(docs: DataFrame, scope: int = SCOPE) -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, base_sha256, spans) of every document."""
    found = spans(docs)
    linked = link(found, scope).groupBy("row").agg(F.collect_list("span").alias("more"))
    rows = found.join(linked, "row", "left").withColumn(
        "every", F.when(F.col("more").isNull(), F.col("base")).otherwise(F.array_sort(F.concat("base", "more")))
    )
    kinds = F.transform("base", lambda x: x["kind"])
    counts = [
        (F.size(kinds) - F.size(F.array_remove(kinds, F.lit(k)))).cast("long").alias(f"n_{KINDS[k]}") for k in range(3)
    ]
    return rows.select("doc_id", *counts, F.sha2(_written("base"), 256).alias("base_sha256"), _written("every").alias("spans"))


def oracle_sql(scope: int = SCOPE) -> str:
    """Base spans by sums of what lies between matches, parts by their distance."""

    def kind(k: int, pattern: str, docs: str, wanted: str) -> str:
        p = pattern.replace("'", "''")
        return f"""
      SELECT doc_id, {k} AS kind, s, s + length(m) AS e FROM (
        SELECT doc_id, ms[i] AS m, gs[i] AS g,
               list_sum(list_transform(bs[1:i], lambda x: length(x)))
               + coalesce(list_sum(list_transform(ms[1:i - 1], lambda x: length(x))), 0) AS s
        FROM (SELECT doc_id, ms, gs, bs, unnest(range(1, len(ms) + 1)) AS i FROM (
          SELECT doc_id, regexp_extract_all(text, '{p}', 0) AS ms, string_split_regex(text, '{p}') AS bs,
                 regexp_extract_all(text, '{p}', {2 if k == 0 else 0}) AS gs
          FROM documents WHERE {docs})))
      WHERE {wanted}"""

    names = ", ".join(f"'{x}'" for x in KINDS)
    written = f"concat_ws(':', [{names}][kind + 1], s, e), ',' ORDER BY s, kind, e"
    return f"""
    WITH base AS ({kind(0, ASSIGN, "true", "length(g) >= 6")} UNION ALL
      {kind(1, ACCESS, "true", "length(m) >= 20")} UNION ALL {kind(2, HEX, f"regexp_matches(text, '{HEX_LONG}')", "length(m) >= 24")}),
    weak AS ({kind(3, KEY, f"text LIKE '%AKIA%' AND regexp_matches(text, '{KEY_LONG}')",
        "length(m) = 40 AND regexp_matches(m, '[A-Z]') AND regexp_matches(m, '[a-z]') AND regexp_matches(m, '[0-9]')")}
      UNION ALL {kind(4, ENDPOINT, "text LIKE '%AKIA%' AND text LIKE '%://%'", "true")}),
    near_access AS (
      SELECT w.* FROM weak w WHERE EXISTS (
        SELECT 1 FROM base b WHERE b.doc_id = w.doc_id AND b.kind = 1 AND w.s <= b.e + {scope} AND b.s <= w.e + {scope})),
    secrets AS (SELECT * FROM base WHERE kind = 0 UNION ALL SELECT * FROM near_access WHERE kind = 3),
    more AS (
      SELECT * FROM near_access WHERE kind = 3 UNION ALL
      SELECT w.* FROM near_access w WHERE kind = 4 AND EXISTS (
        SELECT 1 FROM secrets b WHERE b.doc_id = w.doc_id AND w.s <= b.e + {scope} AND b.s <= w.e + {scope})),
    b AS (
      SELECT doc_id, count_if(kind = 0) AS n0, count_if(kind = 1) AS n1, count_if(kind = 2) AS n2,
             string_agg({written}) AS line FROM base GROUP BY doc_id),
    e AS (SELECT doc_id, string_agg({written}) AS line FROM (SELECT * FROM base UNION ALL SELECT * FROM more) GROUP BY doc_id)
    SELECT d.doc_id, CAST(coalesce(n0, 0) AS BIGINT) AS n_assign, CAST(coalesce(n1, 0) AS BIGINT) AS n_access,
           CAST(coalesce(n2, 0) AS BIGINT) AS n_hex, sha256(coalesce(b.line, '')) AS base_sha256, coalesce(e.line, '') AS spans
    FROM documents d LEFT JOIN b USING (doc_id) LEFT JOIN e USING (doc_id)"""

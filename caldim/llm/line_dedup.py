"""Line dedup by distinct-site spread.

A line (text between line feeds, trimmed of spaces, tabs and carriage returns)
that stands in documents of many distinct sites is boilerplate: in a quarter of
all sites that the table has, but two at least and ``MOST_SITES`` at most; a line
shorter than ``SHORT`` characters, such as a menu's, in half of them, but three at
least and five times ``MOST_SITES`` at most. It stays in the document with the
smallest id that holds it, and is cut from every other: so a text that many
sites copy is kept once. Empty lines stay.

Spread is counted by one HyperLogLog sketch of sites per 128-bit line hash,
built map-side and merged by the aggregation; lines whose estimate is within the
sketch's error of the threshold are counted exactly. Where lines meet a list of
keys, those that hold more than a hundred-thousandth of all lines in the list
come by broadcast (there are 100 000 at most), the others by key.

Only DataFrame functions run; the text itself is shuffled once, to meet its
document's list of cut lines.

Defined cases: null text is the empty text (one empty line); rows with a null
site spread nothing and do not count as a site; a null doc_id comes after every
id; rows that repeat a doc_id are treated alike; an empty table gives none; all
columns of ``docs`` stay, but for those named like the two counts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caldim.llm.common import fresh, stored, text_of

#: Sites that make any line boilerplate, however many there are.
MOST_SITES = 10
#: Lines of fewer characters take more sites.
SHORT = 20
#: lg of the sketch's registers; relative standard error 1.04 / sqrt(2 ** LG_K).
LG_K = 12
#: Keys that may be broadcast: any other has fewer than FEW lines, or than a
#: share of 1 / HOT_KEYS of all lines in its list.
HOT_KEYS, FEW = 100_000, 256


def thresholds(sites: int, most: int = MOST_SITES) -> tuple[int, int]:
    """Sites from which a line, and a short line, are boilerplate."""
    return min(most, max(2, -(-sites // 4))), min(5 * most, max(3, -(-sites // 2)))


def _trimmed(line: Column) -> Column:
    return F.btrim(line, F.lit(" \t\r"))


def _key(line: Column) -> Column:
    """Hash of a line, and whether it is short."""
    line = _trimmed(line)
    return F.struct(
        F.xxhash64(line).alias("h1"), F.xxhash64(F.lit("second"), line).alias("h2"), (F.length(line) < SHORT).alias("short")
    )


def _judged(line: Column) -> Column:
    return _trimmed(line) != ""


def _meeting(lines: DataFrame, few: DataFrame, *values: str) -> DataFrame:
    """Lines (with key) whose key ``few`` has (with its number n of lines), with its values."""
    most = max(FEW, (few.agg(F.sum("n")).first()[0] or 0) // HOT_KEYS)
    of = F.struct(*(F.col(v) for v in values), F.lit(1).alias("one")).alias
    hot = few.filter(F.col("n") > most).select("key", of("hot"))
    rest = few.filter(F.col("n") <= most).select("key", F.lit(0).alias("salt"), of("cold"))
    known = lines.join(F.broadcast(hot), "key", "left")
    # lines of hot keys need no partner and go anywhere
    salt = F.when(F.col("hot").isNotNull(), F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)).cast("int") + 1).otherwise(0)
    met = known.withColumn("salt", salt).join(rest, ["key", "salt"], "left").withColumn("met", F.coalesce("hot", "cold"))
    return met.filter("met is not null").select(*lines.columns, *(F.col("met")[v].alias(v) for v in values))


def boilerplate(lines: DataFrame, sites: int, most_sites: int = MOST_SITES) -> DataFrame:
    """(key, first, n): keys of boilerplate lines, with the smallest doc_id and
    about how many lines have it. ``lines`` has doc_id, site and key."""
    usual, short = thresholds(sites, most_sites)
    error = 4 * 1.04 / 2 ** (LG_K / 2)
    least = F.when(F.col("key.short"), short).otherwise(usual)
    spread = lines.groupBy("key").agg(
        F.hll_sketch_estimate(F.hll_sketch_agg("site", F.lit(LG_K))).alias("sites"), F.min("doc_id").alias("first"), F.count("*").alias("n")
    )
    spread = stored(spread.filter(F.col("sites") >= least * (1 - error) - 1), "spread-lines")
    near = spread.filter(F.col("sites") <= least * (1 + error) + 1)
    exact = (
        _meeting(lines, near.select("key", "n"))
        .groupBy("key", "site")
        .agg(F.min("doc_id").alias("first"), F.count("*").alias("n"))
        .groupBy("key")
        .agg(F.count("site").alias("sites"), F.min("first").alias("first"), F.sum("n").alias("n"))
        .filter(F.col("sites") >= least)
    )
    sure = spread.filter(F.col("sites") > least * (1 + error) + 1)
    return sure.select("key", "first", "n").unionByName(exact.select("key", "first", "n"))


def remove_boilerplate(
    docs: DataFrame, site: str = "source", most_sites: int = MOST_SITES, counts: tuple[str, str] = ("n_lines", "n_removed")
) -> DataFrame:
    """The documents with boilerplate lines cut from text, and the numbers of
    lines (of the input) and of those cut, under the given names."""
    docs = docs.drop(*counts)
    split = F.split(text_of(), "\n", -1)
    lines = (
        docs.select("doc_id", F.col(site).alias("site"), F.explode(split).alias("line"))
        .filter(_judged(F.col("line")))
        .select("doc_id", "site", _key(F.col("line")).alias("key"))
    )
    sites = docs.select(F.col(site).alias("site")).filter("site is not null").distinct().count()
    found = stored(boilerplate(lines, sites, most_sites), "boilerplate")
    gone, at, kept_lines = fresh(docs, "cut", "cut_of", "kept_lines")
    cut = (
        _meeting(lines.select("doc_id", "key"), found, "first")
        .filter(~F.col("doc_id").eqNullSafe(F.col("first")))
        .groupBy("doc_id")
        .agg(F.collect_set("key").alias(gone))
        .withColumnRenamed("doc_id", at)
    )
    both = docs.join(cut, F.col("doc_id").eqNullSafe(F.col(at)), "left")
    kept = F.filter(split, lambda x: ~(_judged(x) & F.array_contains(F.col(gone), _key(x))))
    both = both.withColumn(kept_lines, F.when(F.col(gone).isNotNull(), kept))
    n_lines = F.size(split)
    return both.select(
        *(
            F.when(F.col(gone).isNull(), F.col("text")).otherwise(F.array_join(kept_lines, "\n")).alias("text")
            if c == "text"
            else F.col(c)
            for c in docs.columns
        ),
        n_lines.alias(counts[0]),
        F.when(F.col(gone).isNull(), F.lit(0)).otherwise(n_lines - F.size(kept_lines)).alias(counts[1]),
    )


def oracle_sql(most_sites: int = MOST_SITES) -> str:
    """The digest of remove_boilerplate over documents, by exact counts."""
    return f"""
    WITH lines AS (
      SELECT d.doc_id, d.source, u.i, u.line, trim(u.line, ' ' || chr(9) || chr(13)) AS k
      FROM documents d, LATERAL (
        SELECT unnest(string_split(coalesce(d.text, ''), chr(10))) AS line,
               unnest(range(len(string_split(coalesce(d.text, ''), chr(10))))) AS i) u),
    sites AS (SELECT count(DISTINCT source) AS n FROM documents),
    spread AS (
      SELECT k, min(doc_id) AS first FROM lines WHERE k <> ''
      GROUP BY k HAVING count(DISTINCT source) >= CASE WHEN length(k) < {SHORT}
        THEN (SELECT least({5 * most_sites}, greatest(3, CAST(ceil(n / 2) AS BIGINT))) FROM sites)
        ELSE (SELECT least({most_sites}, greatest(2, CAST(ceil(n / 4) AS BIGINT))) FROM sites) END),
    marked AS (
      SELECT l.doc_id, l.i, l.line, coalesce(s.first <> l.doc_id, false) AS gone
      FROM lines l LEFT JOIN spread s ON l.k = s.k)
    SELECT doc_id, CAST(count(*) AS INTEGER) AS n_lines, CAST(count_if(gone) AS INTEGER) AS n_removed,
           sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT gone), '')) AS kept_sha256
    FROM marked GROUP BY doc_id"""

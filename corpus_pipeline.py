"""The corpus pipeline: documents to packed training sequences.

``STAGES`` are applied in order; each stage's rows are written as Parquet and
read again as the next one's documents. All but the last return the columns of
documents.

1. quality classifier: documents that it rejects go;
2. line dedup: lines that many sites share are cut from the texts;
3. SimHash near-dedup: of each group one row stays, that of the smallest id;
4. benchmark decontamination: documents that hold a benchmark window go;
5. best-fit packing: what is left, as pieces placed in sequences.

Defined cases are those of the operators. Stages 3 and 4 judge each row by
itself, whether its id is null, repeated or neither: a row without an id goes if
it is contaminated or a copy, and no row goes for another that shares its id. In
near-dedup ids come before null, then the smaller hash of the text, then any one
of the rows that are left. Line dedup goes by ids: rows of one id (or of none)
count as one document, cut alike.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caldim.llm import decontaminate, line_dedup, packing, quality, simhash
from caldim.llm.common import fresh, read, stored, text_of
from caldim.llm.queries import tokenizer_path

#: Score from which the classifier keeps a document.
KEEP_FROM = 0.5


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = quality.train(docs, read(spark, sf_dir, "labels"))
    names = fresh(docs, "score", "predicted")
    return quality.score(docs, model, KEEP_FROM, tuple(names)).filter(F.col(names[1]) == 1).select(docs.columns)


def line_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    n_lines, n_removed = fresh(docs, "n_lines", "n_removed")
    cut = line_dedup.remove_boilerplate(docs, counts=(n_lines, n_removed))
    if "n_chars" in docs.columns:
        cut = cut.withColumn("n_chars", F.when(F.col(n_removed) > 0, F.length("text").cast("long")).otherwise(F.col("n_chars")))
    return cut.select(docs.columns)


def near_duplicate_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    (row,) = fresh(docs, "row")
    rows = stored(docs.withColumn(row, F.monotonically_increasing_id()), "pipeline-near-rows")  # row numbers are fixed from here
    order = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", F.xxhash64(text_of()).alias("hash"), F.col(row).alias("row"))
    marks = simhash.near_duplicates(rows.select(order.alias("doc_id"), "text"), shingle=3, max_bits=2)
    gone = marks.filter("doc_id.row <> component_id.row").select(F.col("doc_id.row").alias(row))
    return rows.join(gone, row, "left_anti").select(docs.columns)


def decontamination_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    rows = docs.select(F.struct(*docs.columns).alias("doc_id"), "text")  # the row goes along with its verdict
    marks = decontaminate.find(rows, read(spark, sf_dir, "benchmark"), size=10)
    return marks.filter("not contaminated").select("doc_id.*")


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, tokenizer_path())


STAGES = [
    ("quality_classifier", quality_filter),
    ("line_dedup", line_filter),
    ("simhash_near_dedup", near_duplicate_filter),
    ("benchmark_decontamination", decontamination_filter),
    ("best_fit_packing", packed),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over documents, each one's result written and read again."""
    docs = read(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = stored(docs.withColumns({c: F.col(c) for c in docs.columns}), f"pipeline-{name}")
    return docs


#: A classifier, hashes and a tokenizer are not SQL; the tests hold each stage against brute force.
ORACLE_SQL = None

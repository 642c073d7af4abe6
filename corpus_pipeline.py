"""The stages that turn raw documents into a training mixture.

Each stage reads what its predecessor kept and works on all of it. Stages that drop rows decide on each row by itself, whatever
ids are null or repeated; the line stage goes by id and text, as said there."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tenderline.llm import toxicity
from tenderline.llm.decontamination import leaks
from tenderline.llm.line_dedup import without_duplicate_lines
from tenderline.llm.mixing import mixed_documents
from tenderline.llm.near_dedup import near_duplicates
from tenderline.llm.shared import stored

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with p_toxic below the cut of a model of the labels; null ids are rows like others."""
    model = toxicity.fit(toxicity.graded(spark.read.parquet(f"{sf_dir}/labels.parquet"), docs))
    scored = toxicity.severity(docs, model, carry=COLUMNS[1:])
    return scored.where("not toxic").select(*COLUMNS)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that others, or they themselves, have before; those left without any line go.

    Documents that had no line stay as they are, and so do the lines of those with a null id."""
    lines = without_duplicate_lines(docs, carry=("lang", "source", "n_chars")).where("n_kept > 0 or n_lines = 0")
    return lines.withColumn("n_chars", F.when(F.col("text").isNotNull(), F.length("text")).otherwise(F.col("n_chars")).cast("long")).select(*COLUMNS)


def _numbered(docs: DataFrame) -> DataFrame:
    """The rows with a number of their own, `__row`, that grows with the id: the id itself where each row has one of its own."""
    rows = docs.select(*COLUMNS)
    if rows.groupBy("doc_id").count().where("count > 1 or doc_id is null").isEmpty():
        return rows.withColumn("__row", F.col("doc_id"))
    by = F.asc_nulls_last("doc_id")
    return stored(rows.repartitionByRange(by, F.xxhash64("text")).sortWithinPartitions(by).withColumn("__row", F.monotonically_increasing_id()), "rows")


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near copies stays: that with the least id, null last.

    Each row is a document of its own, also one with a null id or an id that other rows have: of several copies under one id,
    one stays, and a row stays though another with its id goes."""
    rows = _numbered(docs)
    groups = near_duplicates(rows, id_col="__row").select(F.col("doc_id").alias("__row"), "component_id")
    placed = groups.join(rows.select("__row", "doc_id"), "__row")
    first = placed.groupBy("component_id").agg(F.min(F.struct(F.col("doc_id").isNull(), F.col("doc_id"), F.col("__row"))).alias("first"), F.count("*").alias("n"))
    gone = placed.join(first.where("n > 1"), "component_id").where("__row <> first.__row").select("__row")
    return rows.join(gone, "__row", "left_anti").select(*COLUMNS)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows without a passage of the benchmark; other rows with the same id, or also without one, stay."""
    rows = _numbered(docs)
    found = leaks(rows, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), id_col="__row").select(F.col("doc_id").alias("__row")).distinct()
    return rows.join(found, "__row", "left_anti").select(*COLUMNS)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of the mixture, once for each epoch that takes from them, with `epoch` and `tokens_taken`.

    Each row is a document of its own, also one with a null id or an id that other rows have: it is there at most once in an
    epoch, and `tokens_taken` adds up to what the mixture takes. Rows are numbered in a stored table and joined by that
    number, not by id."""
    rows = _numbered(docs)
    taken = mixed_documents(rows, carry=("__row",)).select("__row", "epoch", "tokens_taken")
    return rows.join(taken, "__row").select(*COLUMNS, "epoch", "tokens_taken")


STAGES = [
    ("toxicity", reject_toxic),
    ("line dedup", line_dedup),
    ("minhash near-dedup", near_dedup),
    ("benchmark decontamination", decontaminate),
    ("mixing", mix),
]

#: The classifier, the signatures and the components have no equivalent in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents, each written to the shared folder and read again by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)

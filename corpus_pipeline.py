"""A corpus from raw documents: rules, near copies, benchmark leaks, personal data, mix.

Each stage takes (spark, docs, sf_dir) and returns the documents it keeps, with the
columns of ``documents``; the last one returns what the mix takes of each. ``run``
writes the result of every stage below ``spark.checkpoint.dir`` and reads it again, so
a lost executor costs one stage at most.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.decontamination import find_leaks
from tidemark.llm.mixing import mix_sources
from tidemark.llm.quality_rules import quality_rules
from tidemark.llm.queries import PII_KEY, table
from tidemark.llm.simhash import simhash_components
from tidemark.llm.surrogates import replace_pii
from tidemark.session import work_dir


def aside(docs: DataFrame) -> tuple[DataFrame, list[str]]:
    """doc_id and text, and all columns under names that no operator uses."""
    names = [f"_c{i}" for i in range(len(docs.columns))]
    copies = [F.col(c).alias(n) for c, n in zip(docs.columns, names)]
    return docs.select("doc_id", "text", *copies), names


def back(found: DataFrame, docs: DataFrame, names: list[str]) -> DataFrame:
    """The columns that ``aside`` has put away."""
    return found.select(*(F.col(n).alias(c) for c, n in zip(docs.columns, names)))


def rule_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules."""
    rows, names = aside(docs)
    return back(quality_rules(rows, keep=names).filter("kept"), docs, names)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of near copies.

    Rows that repeat an id stand for one document, of which one row stays: the one with
    the smallest text. A group without any id stays as it is.
    """
    groups = simhash_components(docs, shingle=4, distance=4)
    kept = groups.filter(F.col("doc_id").eqNullSafe(F.col("component_id")))
    ids = kept.select(F.col("doc_id").alias("_kept")).distinct()
    chosen = docs.join(ids, docs["doc_id"].eqNullSafe(ids["_kept"]), "left_semi")
    named = chosen.filter("doc_id IS NOT NULL").groupBy("doc_id").agg(
        F.min_by(F.struct(*docs.columns), F.struct("text", F.hash(*docs.columns))).alias("_row")
    )
    return named.select("_row.*").union(chosen.filter("doc_id IS NULL")).select(docs.columns)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark item."""
    rows, names = aside(docs)
    found = find_leaks(rows, table(spark, sf_dir, "benchmark"), keep=names)
    return back(found.filter("NOT contaminated"), docs, names)


def hide_pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with surrogates for personal data; ``n_chars`` follows the new text."""
    rows, names = aside(docs)
    others = [n for c, n in zip(docs.columns, names) if c != "text"]
    found = replace_pii(rows, PII_KEY, keep=others)
    new = {"text": F.col("text"), "n_chars": F.length("text").cast("long")}
    return found.select(
        *(new.get(c, F.col(n)).alias(c) for c, n in zip(docs.columns, names))
    )


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What the mix of sources takes of each document."""
    return mix_sources(docs, keep=["doc_id", "source"])


STAGES = [
    ("quality rules", rule_quality),
    ("SimHash near-dedup", near_dedup),
    ("benchmark decontamination", decontaminate),
    ("PII", hide_pii),
    ("mixing sources to target weights", mix),
]

# Compression ratios, SimHash and the keyed cipher have no counterpart in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents, each on what the one before it kept."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = work_dir(spark, name.replace(" ", "-"))
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs

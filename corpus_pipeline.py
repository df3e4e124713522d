"""From raw documents to token ids: each stage calls one operator and works on all that the stage before kept.

The classifier drops documents of low quality; repeated long lines go; of near-duplicates (five-word shingles, Jaccard similarity 0.8 or
more, directly or over a chain) one row stays: the smallest identifier, nulls last, then by hash of the text and of the row; documents that hold benchmark passages go; what is left is encoded, and decoded again. Every stage but the last returns the columns of
its input; a changed text brings its ``n_chars`` along. Null and repeated identifiers, null texts and empty tables are treated as the operators
say; of repeated rows one stays. Rows are judged by their texts, so different texts stay, whatever identifiers they share or lack. Further columns of the
table, whatever their names, come through all stages but the last, which returns its own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from barloom.llm import bpe, decontaminate, line_dedup, line_quality, simhash
from barloom.llm.common import cut_lineage, table
from barloom.llm.queries import GOOD, held_out, tokenizer


def free_names(docs: DataFrame, *names: str) -> list[str]:
    """Names for helper columns that no column of the table has, in any spelling."""
    taken = {c.lower() for c in docs.columns}
    return [next(f"{name}_{i}" for i in range(len(taken) + 1) if f"{name}_{i}" not in taken) for name in names]


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose lines are labelled good as a whole."""
    model = line_quality.train(docs.select("doc_id", "text"), table(spark, sf_dir, "labels").where(~held_out()))
    (quality,) = free_names(docs, "quality")
    return line_quality.score(docs, model, out=quality).where(F.col(quality) >= GOOD).select(docs.columns)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the long lines that five or more of them share, except where the line stays."""
    kept = line_dedup.apply_bitmaps(docs, line_dedup.keep_bitmaps(docs))
    if "n_chars" in docs.columns:
        kept = kept.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return kept.select(docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near-duplicates."""
    name, root, place, row = free_names(docs, "name", "root", "place", "row")
    roots = simhash.similar_texts(docs).select(F.col("node").alias(name), F.col("root").alias(root))
    named = docs.withColumns({name: simhash.text_key("text"), row: F.xxhash64(*docs.columns)})
    # Which row stays is decided without the texts, which are shuffled once: by their names.
    order = [F.col("doc_id").asc_nulls_last(), name, row]
    first = Window.partitionBy(F.coalesce(root, name)).orderBy(*order)
    stays = named.select(name, "doc_id", row).join(roots, name, "left").withColumn(place, F.row_number().over(first)).where(F.col(place) == 1)
    once = Window.partitionBy(name, row).orderBy(*order)
    rows = named.join(stays.select(name, row), [name, row]).withColumn(place, F.row_number().over(once))
    return rows.where(F.col(place) == 1).select(docs.columns)


def drop_benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark passage."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, and the text decoded from them."""
    coded = bpe.round_trip(docs, *tokenizer(), keep=("doc_id", "lang", "source"))
    return coded.select("doc_id", "lang", "source", F.col("decoded").alias("text"), F.size("ids").cast("long").alias("n_tokens"), "ids")


STAGES = [
    ("quality_classifier", keep_good),
    ("line_dedup", drop_repeated_lines),
    ("simhash_near_dedup", drop_near_duplicates),
    ("decontamination", drop_benchmark_passages),
    ("byte_bpe", tokenize),
]

#: The classifier has no form in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; what a stage keeps is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = cut_lineage(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)

"""From raw documents to a training mix in five stages, each written as Parquet and read back as the next one's input.

quality_rules      documents that the rules reject go, and of the others the lines that fail
ngram_join         of each group of near copies the document of the least id stays
decontamination    documents that share template windows with a benchmark item go
secret_scan        secrets in texts become <secret>; n_chars follows
mixing             documents that the mix takes, with the words and copies it takes of each

Rows without an id stay in ngram_join and decontamination, and are mixed like others. Of near copies that share the least id
one row stays. Null texts are rejected by the first stage. Extra columns are carried along, except where they have the names of columns that a stage adds
or works with (_row is overwritten by row numbers, _blob is lost).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cadastra.llm import decontamination as decontaminate
from cadastra.llm import mixing as mixer
from cadastra.llm import ngram_join as ngrams
from cadastra.llm import quality_rules as rules
from cadastra.llm import secret_scan as secrets
from cadastra.llm.common import cut, table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    kept = rules.quality_rules(docs, remove=True).where("kept")
    return kept.withColumn("n_chars", F.when(F.col("n_lost_words") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))).select(*docs.columns)


def _rows(docs: DataFrame) -> DataFrame:
    """docs with _row, which tells rows apart whatever their ids; written, so that it doesn't change."""
    return cut(docs.withColumn("_row", F.monotonically_increasing_id()), "pipeline-rows")


def ngram_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    rows = _rows(docs)
    groups = ngrams.ngram_components(rows.select("_row", "text"), "_row").withColumnRenamed("id", "_row")
    known = cut(groups.join(rows.select("_row", "doc_id").where("doc_id is not null"), "_row"), "pipeline-groups")
    stays = known.groupBy("component_id").agg(F.min(F.struct("doc_id", "_row"))["_row"].alias("stays"))
    surplus = known.join(stays, "component_id").where("_row != stays").select("_row")
    return rows.join(surplus, "_row", "left_anti").select(*docs.columns)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = decontaminate.contaminated(docs.select("doc_id", "text"), table(spark, sf_dir, "benchmark"))
    return docs.join(found.select(F.col("id").alias("doc_id")).distinct(), "doc_id", "left_anti").select(*docs.columns)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = secrets.secret_scan(docs).withColumn("text", secrets.redact(F.col("text"), F.col("spans")))
    return found.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    added = ["size", "source_size", "target", "taken", "copies"]
    rows = _rows(docs)
    # Rows without an id, or of one id, are drawn by their texts too, and taken back row by row.
    sizes = rows.select(F.xxhash64("doc_id", "text").alias("key"), "source", mixer.word_count(F.col("text")).alias("size"), F.col("_row").alias("row"))
    taken = mixer.mix(sizes).where("taken > 0").select(F.col("row").alias("_row"), "size", "source_size", "target", "taken", F.expr("taken div size").alias("copies"))
    return rows.drop(*added).join(taken, "_row").select(*(c for c in docs.columns if c not in added), *added)


STAGES = [
    ("quality_rules", quality_rules),
    ("ngram_join", ngram_join),
    ("decontamination", decontamination),
    ("secret_scan", secret_scan),
    ("mixing", mixing),
]

#: The last stage draws random numbers, which SQL can't repeat; tests compare each stage with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = cut(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs

"""Corpus pipeline: toxicity, near duplicates, benchmark decontamination, secrets, token ids.

Each stage reads the documents that the one before kept, written as Parquet below the session's shared folder, and calls
one operator of ``yieldloom.llm``. All but the last return the columns of documents; ``n_chars`` follows a changed text.

Nulls: a null text is empty to every stage and stays null until the last. A document without id is judged for toxicity and
secrets, links with nothing and is never a duplicate; its passages of benchmark items still reject it. Rows of one id
with different texts are judged each by its own text. Rows that repeat in id and text are copies of each other, of which
one stays (the first by its other columns). Input columns may have any names. An empty table gives empty stages.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from yieldloom.llm import bpe, decontaminate, jaccard, secret_scan, toxicity
from yieldloom.llm.queries import BPE_FILE
from yieldloom.session import fresh_path

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def free_name(docs: DataFrame, name: str) -> str:
    """A column name that the documents do not use."""
    while name in docs.columns:
        name += "_"
    return name


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are likelier toxic than not go."""
    scorer = toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    score = free_name(docs, "toxicity")
    return toxicity.scored(docs, scorer, column=score).filter(F.col(score) < 0.5).drop(score)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of least id of each group of near duplicates stays; of rows that share id and text, one."""
    row, place = free_name(docs, "row"), free_name(docs, "place")
    # A row goes by its id and its text's hash, ordered by id first: so the least of a group is its least id.
    named = docs.filter("doc_id is not null").withColumn(row, F.struct("doc_id", F.xxhash64("text").alias("text")))
    groups = jaccard.near_duplicates(named.select(row, "text"), key=row)
    kept = groups.filter(F.col(row) == F.col("component_id")).groupBy(row).agg(F.count(F.lit(1)).alias("rows"))
    stays = named.join(kept.select(row), row, "left_semi")
    repeated = kept.filter("rows > 1").select(row)
    single = stays.join(repeated, row, "left_anti").select(*docs.columns)
    order = Window.partitionBy(row).orderBy(*[F.col(c) for c in docs.columns if c not in ("doc_id", "text")] or [F.lit(1)])
    first = stays.join(repeated, row, "left_semi").withColumn(place, F.row_number().over(order)).filter(F.col(place) == 1)
    return single.unionByName(first.select(*docs.columns)).unionByName(docs.filter("doc_id is null"))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    found = decontaminate.contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return docs.join(found.select("doc_id").distinct(), docs["doc_id"].eqNullSafe(found["doc_id"]), "left_anti")


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced by a mark; every document stays."""
    return secret_scan.redact(docs).withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def encode_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each text, read back: ``(doc_id, n_tokens, ids_sha256, decoded_sha256)``."""
    coded = bpe.encode(docs, public_tokenizers.path(BPE_FILE), public_tokenizers.PATTERN, decoded=True)
    return bpe.digest(coded)


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("near duplicates", drop_near_duplicates),
    ("benchmark decontamination", drop_contaminated),
    ("secrets", redact_secrets),
    ("token ids", encode_tokens),
]

# Learned scores, inferred automata and token merges are beyond SQL; tests hold each stage against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows for the documents of a folder of tables."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = fresh_path(spark, "stage-" + name.replace(" ", "-"))
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs

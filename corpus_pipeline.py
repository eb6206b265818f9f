"""A training corpus from the documents: five stages, each written and read again by the next."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from boardlens.llm.common import table, written
from boardlens.llm.mixing import fit_domains, fit_mixture, memberships, mixed
from boardlens.llm.near_minhash import near_duplicates
from boardlens.llm.packing import pack
from boardlens.llm.queries import domains_of
from boardlens.llm.secret_scan import redact, secrets
from boardlens.llm.toxicity import fit_toxicity, without_toxic


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below 0.3 stay."""
    return without_toxic(docs, fit_toxicity(docs, table(spark, sf_dir, "labels")))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The smallest id of each group stays, with one row for each of its texts that isn't like another; rows without an id stay."""
    key, known = F.xxhash64("text"), docs.filter("doc_id IS NOT NULL")
    texts = known.groupBy("doc_id").agg(F.min(key).alias("lo"), F.max(key).alias("hi"))
    if texts.filter("lo <> hi").isEmpty():
        return _one_of_each(docs, "doc_id")
    # ids with several texts: numbers in the order of ids stand for each id and text
    pairs = known.select(F.col("doc_id").alias("__d"), key.alias("__k")).distinct()
    numbers = written(pairs.orderBy("__d", "__k").withColumn("__pair", F.monotonically_increasing_id()))
    rows = docs.join(numbers, (F.col("doc_id") == F.col("__d")) & (key == F.col("__k")), "left").select(*docs.columns, "__pair")
    return _one_of_each(written(rows), "__pair").select(*docs.columns)


def _one_of_each(docs: DataFrame, doc_id: str) -> DataFrame:
    """The smallest ``doc_id`` of each group, with one row, and rows without one."""
    seen = near_duplicates(docs, doc_id)
    marks = written(
        seen.filter("doc_id IS NOT NULL")
        .groupBy(F.col("doc_id").alias("__id"))
        .agg(F.max((~F.col("kept")).cast("int")).alias("__gone"), F.count("*").alias("__rows"))
        .filter("__gone = 1 OR __rows > 1")
    )
    once = docs.join(marks.select("__id"), F.col(doc_id) == F.col("__id"), "left_anti")
    again = docs.join(marks.filter("__gone = 0"), F.col(doc_id) == F.col("__id"))
    first = again.withColumn("__n", F.row_number().over(Window.partitionBy("__id").orderBy(*docs.columns)))
    return once.union(first.filter("__n = 1").select(*docs.columns))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document stays; secrets in its text are replaced, and its length follows."""
    out = redact(docs, secrets(docs))
    if "n_chars" in out.columns:
        out = out.withColumn("n_chars", F.coalesce(F.length("text"), F.col("n_chars")).cast(docs.schema["n_chars"].dataType))
    return out.select(*docs.columns)


def mix_domains(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Good documents are repeated until nine tenths of the expected tokens are good; every document stays."""
    model = fit_domains(docs, domains_of(table(spark, sf_dir, "labels")).filter("domain <> 'toxic'"))
    members = written(memberships(docs, model, keep=tuple(docs.columns)))
    return mixed(members, model, fit_mixture(members, model, {"good": 0.9, "poor": 0.1}, floor=1.0))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The place of each piece of each document in sequences of 4096 tokens."""
    return pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("secrets", redact_secrets),
    ("mixing", mix_domains),
    ("packing", pack_sequences),
]

#: Classifiers, signatures and packing can't be said in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir))
    return docs

"""Corpus pipeline: language ID, SimHash near-duplicates, benchmark decontamination, mixing, sharding.

Every stage takes (spark, docs, sf_dir), docs with the columns of ``documents``, and returns a
DataFrame of the same columns (the last one: and ``shard``). ``run`` writes what each stage returns as
Parquet in the shared folder and reads it again for the next.

Rows are told apart by (doc_id, hash of the text), nulls included; of rows that repeat both, a
stage keeps or drops all, but for the near-duplicates, of which one row a group stays: of rows equal
in both, the one with the least hash of its other columns, so a rerun keeps the same.
Empty inputs give empty results; columns beside those of ``documents`` are passed through, whatever
their names, but for one named ``shard``, which the last stage's takes the place of.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sensorlake.llm import decontam, language, mixing, sharding, simhash
from sensorlake.llm.common import table, tie
from sensorlake.session import delete_path, scratch_path


def _key(doc_id: str, text_hash: Column) -> Column:
    """A row's name; never null, so it joins."""
    return F.struct(F.col(doc_id).isNull().alias("none"), F.coalesce(F.col(doc_id).cast("long"), F.lit(0)).alias("id"),
                    text_hash.alias("text"))


def _rows(docs: DataFrame) -> DataFrame:
    """``_row``: the whole row, so that no column name can clash, and ``_key``."""
    return docs.select(F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("_row"),
                       _key("doc_id", F.xxhash64("text")).alias("_key"), tie(docs).alias("_tie"))


def identify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is known; ``lang`` is filled with it where it is null.

    Learned from all rows with a label. Rejected: texts without a letter (``und``).
    """
    model = language.learn(docs.select("text", "lang"))
    rest = [f for f in docs.schema.fields if f.name != "text"]      # in one struct: no name can clash
    kind = "struct<" + ", ".join(f"`{f.name}`: {f.dataType.simpleString()}" for f in rest) + ">"
    known = language.predict(docs.select(F.struct(*[docs[f"`{f.name}`"] for f in rest]).alias("_rest"), "text"), model,
                             {"_rest": kind, "text": "string"}).filter(F.col("lang_pred") != language.UNKNOWN)
    column = lambda c: F.col("text") if c == "text" else F.col("_rest")[c]
    return known.select(*[(F.coalesce(column(c), "lang_pred") if c == "lang" else column(c)).alias(c) for c in docs.columns])


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group: the one with the smallest doc_id (3 words, 3 bits, as the operator's query)."""
    named = docs.select("doc_id", F.xxhash64("text").alias("th"), "text")
    groups = simhash.near_duplicates(named, {"doc_id": "long", "th": "long"})
    first = F.min(_key("doc_id", F.col("th"))).alias("_key")
    kept = groups.groupBy("group").agg(first).select("_key")
    one = Window.partitionBy("_key").orderBy("_tie")
    return (_rows(docs).join(kept, "_key").withColumn("_i", F.row_number().over(one)).filter("_i = 1").select("_row.*"))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of ``benchmark``."""
    hits = decontam.contaminated(docs, table(spark, sf_dir, "benchmark"))
    return _rows(docs).join(hits.select(_key("doc_id", F.col("th")).alias("_key")).distinct(), "_key", "left_anti").select("_row.*")


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it (0 to 3 times)."""
    return mixing.mix(docs)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their shard; copies of one document share it."""
    return sharding.place(docs)


STAGES = [("language", identify), ("simhash", near_duplicates), ("decontaminate", decontaminate), ("mix", mix),
          ("shard", shard)]

#: Language identification and alignment have no SQL form; tests/llm/test_pipeline.py checks the stages by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        if before:
            delete_path(spark, before)
        before = path
    return STAGES[-1][1](spark, docs, sf_dir)

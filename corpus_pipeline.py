"""A corpus pipeline: quality, near duplicates, repeated passages, benchmark leaks, token ids.

Every stage takes (spark, docs, sf_dir) and works on all rows that the one before kept. In all stages a null text counts as
an empty one (and stays null), rows with a null id are rows of their own, an empty table gives an empty one, and columns
beside doc_id and text are handed on unread, whatever their names; n_chars follows a text that is cut. Ids must be integers.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lumenfold.llm import decontaminate, fm_dedup, jaccard_join, quality, sp_codec
from lumenfold.llm.bloom import Bloom
from lumenfold.llm.common import free_name, table
from lumenfold.llm.queries import vocabulary
from lumenfold.plans.shared import materialize, release, written


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts; it learns from the labels of the documents given. A score on the
    threshold is accepted, repeated rows share their score and stay or go together, and without labels all stay."""
    model = quality.train(docs, table(spark, sf_dir, "labels"))
    name = free_name("score", docs.columns)
    return quality.score(docs, model, docs.columns, name).where(F.col(name) >= 0.3).select(*docs.columns)


def without(docs: DataFrame, rows: DataFrame, gone: str) -> DataFrame:
    """docs without the ids of those rows (doc_id, among all of docs') that a condition holds for. Most texts aren't shuffled: one
    Bloom filter holds the ids that go, another those of the ids that stay which the first lets through; only documents that
    both let through are joined. The filters' size is bounded; fuller ones send more documents to the join."""
    key = lambda d: F.xxhash64(d["doc_id"].cast("long"))

    def within(filter_: Bloom):
        @F.arrow_udf("boolean")
        def found(h: pa.Array) -> pa.Array:
            out = np.zeros(len(h), bool)
            out[filter_.find(h.to_numpy().view(np.uint64))] = True
            return pa.array(out)

        return found

    extra = materialize(rows.where(gone).select("doc_id").distinct(), "gone")
    n = extra.count()
    if not n:
        return docs
    first = within(Bloom(extra.select(key(extra).alias("h")), "h", n))
    spared = rows.where(f"doc_id IS NOT NULL AND NOT ({gone})").select(key(rows).alias("h")).where(first("h"))
    spared = materialize(spared, "spared")
    second = within(Bloom(spared, "h", spared.count()))
    both = F.coalesce(F.col("doc_id").isNotNull() & first(key(docs)) & second(key(docs)), F.lit(False))
    one = F.coalesce(F.col("doc_id").isNotNull() & first(key(docs)), F.lit(False))
    return docs.where(~one).unionByName(docs.where(both).join(extra, "doc_id", "left_anti").select(*docs.columns))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: the one with the smallest id. Rows that repeat an id are one document:
    of those with words the one with the smallest text stays. Texts without words are in no group and stay."""
    groups = materialize(jaccard_join.near_duplicates(docs, k=5, percent=80).select("doc_id", "n_shingles", "component_id"), "groups")
    out = without(docs, groups, "doc_id <> component_id").select(*docs.columns)
    twice = groups.where("n_shingles > 0 AND doc_id = component_id").groupBy("doc_id").count().where("count > 1").select("doc_id")
    if twice.isEmpty():
        return out
    again = out.join(twice, "doc_id", "left_semi").select(*docs.columns)
    wordless = F.coalesce("text", F.lit("")).rlike("^[\\x20\\x09-\\x0D]*$")
    row = F.struct(*docs.columns)
    first = again.where(~wordless).groupBy("doc_id").agg(F.min_by(row, "text").alias(free_name("row", docs.columns))).select(free_name("row", docs.columns) + ".*")
    return out.join(twice, "doc_id", "left_anti").select(*docs.columns).unionByName(again.where(wordless)).unionByName(first)


def drop_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the words of repeated passages; a text that loses none stays as it is, one that loses all goes.
    Repeated rows don't remove each other's words."""
    prefix = free_name("cut", docs.columns) + "_"
    mine = lambda c: F.col(prefix + c)
    cut = fm_dedup.dedup(docs, docs.columns, prefix=prefix).where((mine("n_removed") < mine("n_words")) | (mine("n_words") == 0))
    changed = mine("n_removed") > 0
    out = cut.withColumn("text", F.when(changed, mine("kept")).otherwise(F.col("text")))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(changed, F.length("text").cast(dict(docs.dtypes)["n_chars"])).otherwise(F.col("n_chars")))
    return out.select(*docs.columns)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark; repeated rows stay or go together."""
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark")).select(*docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every row's whole text (null for a null one, none for an empty one)."""
    return sp_codec.encode(docs, sp_codec.codec(vocabulary())).select("doc_id", "n_tokens", "ids")


STAGES = [
    ("quality_classifier", keep_quality),
    ("jaccard_join", drop_near_duplicates),
    ("substring_dedup", drop_repeats),
    ("decontamination", drop_leaks),
    ("sentencepiece", encode),
]
#: SQL can't express a trained classifier.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages; the tables that a stage wrote for itself go as soon as its result is stored."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        mark = written()
        docs = materialize(stage(spark, docs, sf_dir), name)
        release(spark, mark, last=False)
    return docs

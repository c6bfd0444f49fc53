"""From raw documents to packed sequences: each stage is one operator, written and read again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millwatch.llm import exact_dedup, langid, mixing, ngram_join, packing
from millwatch.llm.common import join_ids, quoted, same_columns, table, unused, without_ids, written

# Near copies: five-word shingles, a similarity of 0.8 or more.
NEAR = {"n": 5, "num": 80, "den": 100}


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is told; the model learns from the labels of ``docs`` itself.

    Documents without a letter and those below the calibrated threshold go. If no row has
    a label there is no language to tell, and every document goes. Rows are matched by id;
    an id that several rows share stays if any of them does, rows without id stay.
    """
    model = langid.fit_model(docs)
    judged = langid.identify(docs, model).filter("doc_id IS NOT NULL")
    rejected = judged.groupBy("doc_id").agg(F.min("rejected").alias("all_rejected")).filter("all_rejected")
    return without_ids(docs, written(rejected.select("doc_id"), "rejected-ids"))


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each text, that of the smallest id; null counts as the empty text, which is one text too.

    Of rows that repeat an id and a text one stays; an empty table stays empty; all columns are kept.
    """
    return exact_dedup.drop_copies(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, that of the smallest id.

    Rows without id, and null, empty and blank texts, are nobody's copies and stay; an empty
    table stays empty; all columns are kept.
    """
    return ngram_join.drop_near_copies(docs, **NEAR)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it: not at all, once or twice.

    Documents without words weigh nothing in the mix and stay once, as do rows without id.
    """
    taken = mixing.mix(docs)
    key, times, copy = unused(docs, "_mw_id"), unused(docs, "_mw_times"), unused(docs, "_mw_copy")
    often = F.when(F.col("size") > 0, F.col("taken") / F.col("size")).otherwise(1).cast("int")
    by_id = taken.filter("doc_id IS NOT NULL").groupBy(F.col("doc_id").alias(key)).agg(F.max(often).alias(times))
    changed = written(by_id.filter(F.col(times) != 1), "mix-times")
    marked = join_ids(docs.withColumn(key, F.col(quoted("doc_id")).cast("bigint")), changed, key, "left")
    taken_times = F.coalesce(times, F.lit(1))
    copies = marked.filter(taken_times > 0).withColumn(copy, F.explode(F.sequence(F.lit(1), taken_times)))
    return same_columns(copies, docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all sequences: of every row, whatever its id, one of the end token alone for null and empty texts.

    An empty table gives no pieces.
    """
    return packing.pack(docs)


STAGES = [
    ("language_id", language_id),
    ("exact_dedup", exact_copies),
    ("near_dedup", near_copies),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

# Neither the trained model nor the knapsack nor the tokenizer can be said in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs

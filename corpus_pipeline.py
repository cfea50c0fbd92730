"""Corpus pipeline: toxicity, line dedup, near-duplicate removal, mixing,
packing.

Every stage takes (spark, docs, sf_dir) and returns the documents it keeps
with the columns of ``documents`` (the last one returns the packing); its
result is written as Parquet and read again as the next stage's ``docs``.

Defined cases: those of the operators; besides, line dedup drops a document
only when the lines removed leave it without a word; the near-duplicate stage
decides row by row: rows equal in id and text are one (the least row), rows
that share an id or have none go only if their own texts are linked to the row
that stays (unlike texts all stay); columns beyond those of ``documents``
travel along unchanged, under names of their own within a stage, and an empty table passes through.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from squall.llm.bbit_minhash import near_duplicates
from squall.llm.binpack import best_fit_pack
from squall.llm.common import BLANKS, cut_lineage, null_safe, scratch_table, table, text_or_empty
from squall.llm.line_spread import line_dedup
from squall.llm.pfair import in_mix_order, mix_sources
from squall.llm.toxicity_crf import fit, score_documents


COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def apart(stage: Callable) -> Callable:
    """The stage with the columns beyond ``documents`` out of its operator's
    way, whatever they are called."""
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        own = {c: f"__own{i}" for i, c in enumerate(docs.columns) if c not in COLUMNS}
        return stage(spark, docs.withColumnsRenamed(own), sf_dir).withColumnsRenamed({n: c for c, n in own.items()})
    run.__name__, run.__doc__ = stage.__name__, stage.__doc__
    return run


@apart
def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents predicted toxic go."""
    scored = score_documents(docs, fit(docs, table(spark, sf_dir, "labels")))
    return scored.filter("predicted = 0").select(*docs.columns)


@apart
def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cross-site boilerplate lines go, but for their first document."""
    df = line_dedup(docs)
    changed = F.col("n_removed_lines") > 0
    df = df.filter(~(changed & (F.translate("kept_text", BLANKS, "") == "")))
    new = {"text": F.when(changed, F.col("kept_text")).otherwise(F.col("text")),
           "n_chars": F.when(changed, F.length("kept_text").cast(docs.schema["n_chars"].dataType))
           .otherwise(F.col("n_chars"))}
    return df.select(*[new[c].alias(c) if c in new else F.col(c) for c in docs.columns])


@apart
def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays."""
    shared = cut_lineage(docs.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"))
                         .filter("n > 1 OR doc_id IS NULL").select(F.col("doc_id").alias("__shared")))
    if shared.isEmpty():
        kept = near_duplicates(docs).filter("kept").select(F.col("doc_id").alias("__kept"))
        return docs.join(kept, docs["doc_id"] == kept["__kept"], "left_semi").select(*docs.columns)
    # rows without an id of their own go by the hash of id and text, one row
    # for each; the others keep their id
    alone = docs.filter("doc_id IS NOT NULL").join(shared, docs["doc_id"] == shared["__shared"], "left_anti")
    rows = docs.join(shared, null_safe(docs["doc_id"], shared["__shared"]), "left_semi")
    rows = rows.groupBy(F.xxhash64(F.lit("row"), "doc_id", text_or_empty()).alias("__row")).agg(
        F.min(F.struct(*docs.columns)).alias("__least"))
    rows = cut_lineage(rows.select("__row", "__least.*"))
    near = near_duplicates(alone.select(F.col("doc_id").alias("__row"), "text").union(rows.select("__row", "text")),
                           doc_id="__row").select(F.col("doc_id").alias("__node"), "component_id")
    ids = rows.select(F.col("__row").alias("__of"), F.col("doc_id").alias("__id"))
    named = near.join(ids, near["__node"] == ids["__of"], "left").withColumn(
        "__id", F.when(F.col("__of").isNull(), F.col("__node")).otherwise(F.col("__id")))
    # the smallest id of a component stays, a row without id only among its like
    kept = cut_lineage(named.groupBy("component_id").agg(F.min(F.struct(
        F.col("__id").isNull(), "__id", "__node"))["__node"].alias("__kept")).select("__kept"))
    return (alone.join(kept, alone["doc_id"] == kept["__kept"], "left_semi").select(*docs.columns)
            .union(rows.join(kept, rows["__row"] == kept["__kept"], "left_semi").select(*docs.columns)))


@apart
def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in the order of the mix; files hold stretches of it."""
    return in_mix_order(mix_sources(docs)).select(*docs.columns)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences: every document's pieces with their bins."""
    return best_fit_pack(docs)


STAGES = [("toxicity", toxicity), ("line_dedup", lines), ("near_duplicates", near_copies),
          ("mixing", mixing), ("packing", packing)]

#: the trained and iterative stages have no SQL form; tests check them
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = scratch_table(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)

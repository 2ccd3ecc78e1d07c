"""From raw documents to packed sequences: toxicity, language, near copies, benchmark passages, packing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from featherline.llm import decontaminate, language_id, lsh_forest, packing, toxicity
from featherline.llm.common import materialize, table

#: No SQL expresses the stages; tests hold them against brute force.
ORACLE_SQL = None


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score 0.3 or more go; learnt from those that have a label, outside fold 2.

    Null and empty texts score as texts without words and stay unless those are mostly toxic. Repeated rows and equal texts go
    or stay together; a document labelled twice counts as toxic if either label says so. Without labels all stay; an empty
    table stays empty. All columns stay, whatever their names.
    """
    index = toxicity.fit(toxicity.labelled(docs, table(spark, sf_dir, "labels")))
    return toxicity.keep_clean(docs, index)


def drop_unknown_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without letters, null and empty texts among them, or with a language that scores below 0.4 go; learnt from those that have one.

    Without any language, all texts with letters stay. Equal texts go or stay together; of languages that tie the first by
    name is taken. An empty table stays empty. All columns stay, whatever their names.
    """
    return language_id.keep_known(docs, language_id.fit(docs))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of texts with a Jaccard similarity of 0.8 or more stays: the least doc_id, null first.

    Texts without words, null and empty ones too, are classes of their own. Of rows that repeat both id and text one stays. An
    empty table stays empty. All columns stay, whatever their names.
    """
    return lsh_forest.keep_one(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold ten words in a row of a benchmark item, or all of a shorter one, go.

    Null and empty texts stay; items without words match nothing; equal texts go or stay together. An empty table stays
    empty, an empty benchmark takes nothing. All columns stay, whatever their names.
    """
    return decontaminate.keep_uncontaminated(docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of at most 1024 tokens, with their ids.

    Null and empty texts are their end token alone; repeated rows are packed each; of cuts that tie the earliest is taken. An
    empty table gives no pieces. Other columns are not read.
    """
    return packing.pack(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("language_id", drop_unknown_language),
    ("jaccard_join", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)

"""A corpus pipeline over the ``documents`` table: five stages, each an operator, each written and read again.

Toxic documents go; of lines that repeat, exactly or nearly, one stays; of documents that are near copies one stays; sources
are mixed to target weights; the mix is packed into sequences. All stages but the last return the columns of documents.

Null and empty texts pass the first three stages, hold no words to mix and so leave there. Rows without an id are kept by the
near-duplicate stages. Rows that repeat id and text are one document, of which the third stage keeps one row. Ties go to the
smaller id. Very long texts are handled whole. An empty table gives no rows. Further columns pass as they are, whatever their
names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from taxalith.llm import jaccard, lines, mixing, packing, toxicity
from taxalith.llm.common import staged, table


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.without_toxic(docs, table(spark, sf_dir, "labels"))


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return lines.without_repeats(docs)


def dedup_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard.one_of_each(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.packed(docs)


STAGES = [("toxicity", clean), ("line_dedup", dedup_lines), ("jaccard_join", dedup_documents), ("mixing", mix), ("packing", pack)]

#: A trained model decides in the first stage, so SQL can't express the rows.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = staged(docs)
    return docs

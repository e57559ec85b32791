"""A corpus pipeline of five stages: from raw documents to token digests.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir) and returns the next
stage's documents with all their columns, the last one a row of digests per document:

1. quality_rules: documents that a rule rejects go;
2. line_dedup: of each component of fuzzy lines one line stays, all documents remain;
3. near_dedup: of each component of near copies the document with the smallest id stays;
4. decontamination: words of benchmark passages are cut out, documents mostly made of them go;
5. bpe: doc_id, n_tokens, ids_sha256, decoded_sha256 of what is left.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from botlens.llm import bpe, decontaminate, line_dedup, near_dedup, quality_rules
from botlens.llm.common import saved, ship_package, table, tokenizer_file

#: Rows of an Arrow batch at most: 10,000 texts, Spark's own number, are held several times in an executor that goes through all stages.
ARROW_ROWS = 2000


def _prepared(spark: SparkSession) -> None:
    ship_package(spark)
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    # The stages' results are computed later, so the setting stays.
    if not 0 < int(spark.conf.get(name)) <= ARROW_ROWS:
        spark.conf.set(name, str(ARROW_ROWS))


def _quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    _prepared(spark)
    return quality_rules.kept_documents(docs)


def _lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    _prepared(spark)
    return line_dedup.without_repeats(docs)


def _near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    _prepared(spark)
    return near_dedup.one_of_each(docs)


def _benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    _prepared(spark)
    return decontaminate.decontaminated(docs, table(spark, sf_dir, "benchmark"))


def _tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    _prepared(spark)
    return bpe.round_trips(docs, tokenizer_file("byte_bpe_50k.json"))


STAGES = [
    ("quality_rules", _quality),
    ("line_dedup", _lines),
    ("near_dedup", _near),
    ("decontamination", _benchmark),
    ("bpe", _tokens),
]

#: Similarity components and token merges are beyond SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the documents of a folder, each on the saved result of the one before."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
        if name != STAGES[-1][0]:
            docs = saved(docs)
    return docs

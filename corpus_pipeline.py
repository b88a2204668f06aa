"""Corpus pipeline over ``documents``: each stage reads what the one before kept.

1. quality classifier: documents scored below 0.3 go;
2. quality rules: documents that fail a rule or, on a bad host, a soft one go;
3. n-gram Jaccard join: one document of each group of links stays;
4. mixture: documents are drawn to a token budget spread over domain, language and source;
5. BPE: the drawn documents are encoded, and decoded again for a checksum.

Stages 1 to 4 return the columns of ``documents``.
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from recspark.llm import bpe, quality_model  # noqa: E402
from recspark.llm.common import stored, table  # noqa: E402
from recspark.llm.jaccard_join import one_of_each  # noqa: E402
from recspark.llm.mixture import mix, plan_mixture  # noqa: E402
from recspark.llm.quality_rules import quality_rules  # noqa: E402
from recspark.llm.queries import domain_of, vocabulary  # noqa: E402
from recspark.session import ship_package  # noqa: E402

_LEVELS = ("domain", "lang", "source")


def _apart(docs: DataFrame, *used: str):
    """``docs`` with the columns not in ``used`` renamed, so that no operator's output meets them, and the way back."""
    names = [c if c in used else f"carried{k}" for k, c in enumerate(docs.columns)]
    return docs.toDF(*names), lambda df: df.select(*[F.col(n).alias(c) for n, c in zip(names, docs.columns, strict=True)])


def classify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the documents whose quality score is at least 0.3."""
    ship_package(spark)
    model = quality_model.fit(docs, table(spark, sf_dir, "labels", "doc_id", "quality"))
    return quality_model.score(docs, model, score_col="__score").filter(F.col("__score") >= 0.3).select(docs.columns)


def rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the documents that the host-level rules keep."""
    apart, back = _apart(docs, "text", "source")
    return back(quality_rules(apart).filter("kept"))


def dedupe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the document with the smallest id of each group, and documents without an id.

    Documents are linked by five-word shingles at a similarity of 0.8.
    """
    return one_of_each(docs, width=5, num=4, den=5)


def draw(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Draw documents to the mixture's budgets; a document comes once for each of its epochs."""
    ship_package(spark)
    apart, back = _apart(docs, "doc_id", "text", "lang", "source")
    with_tree = apart.withColumn("domain", domain_of(F.col("source")))
    return back(mix(with_tree, plan_mixture(with_tree, _LEVELS), _LEVELS))


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, their number, and the checksum of the decoded text."""
    ship_package(spark)
    coded = bpe.decode(bpe.encode(docs.select("doc_id", "lang", "source", "text"), vocabulary()).drop("text"), vocabulary())
    return coded.select("doc_id", "lang", "source", F.size("ids").cast("long").alias("n_tokens"), "ids",
                        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


STAGES = [("quality classifier", classify), ("quality rules", rules), ("n-gram Jaccard join", dedupe),
          ("mixture", draw), ("BPE", tokenize)]

#: The classifier and the join have no SQL form; tests/llm/test_pipeline.py checks the stages one by one.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-"))
    return docs

"""A corpus pipeline: documents in, token ids of the documents that stay out.

Each stage takes (spark, docs, sf_dir), works on all that its predecessor kept, and returns the columns of
documents; the last one returns token ids. Between stages the rows are written as Parquet and read again, so a
lost executor costs one stage's tasks at most.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from wxspark.llm import byte_bpe, decontaminate, language, near_duplicates, toxicity
from wxspark.llm.common import stored, table

#: Similarity of five-word shingles, in hundredths, from which the stage links two documents.
NEAR = 80


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier chain, trained on the labelled ones among them, does not call toxic."""
    return toxicity.without_toxic(docs, toxicity.learn(docs, table(spark, sf_dir, "labels")))


def drop_unidentified(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is told by a margin; dictionaries are cut from a third's rest of them."""
    return language.identified(docs, language.learn(language.learnable(docs)))


def keep_one_of_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of the smallest id of each group of near-duplicates; they are linked from NEAR on, op7's from 0.85."""
    return near_duplicates.deduplicated(docs, NEAR)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any window of a benchmark item."""
    return decontaminate.decontaminated(docs, table(spark, sf_dir, "benchmark"))


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, the digests of the ids and of what they decode to, and the ids."""
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return byte_bpe.digest_table(docs, path, public_tokenizers.PATTERN, with_ids=True)


STAGES = [
    ("toxicity", drop_toxic),
    ("language", drop_unidentified),
    ("near_duplicates", keep_one_of_near_duplicates),
    ("decontamination", drop_contaminated),
    ("byte_bpe", tokenize),
]

#: Classifiers and compressors have no SQL form; tests hold every stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)

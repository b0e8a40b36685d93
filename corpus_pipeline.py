"""The corpus pipeline: toxicity, line dedup, near-dedup, source mix, token ids.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; run() writes each stage's rows to the shared folder
and reads them again for the next, so a lost executor costs a stage's tasks and not the stages before it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terrawarp.llm.bpe import round_trip
from terrawarp.llm.common import Scratch, table
from terrawarp.llm.line_dedup import dedup_lines
from terrawarp.llm.mixing import mixed
from terrawarp.llm.simhash import drop_near_duplicates
from terrawarp.llm.toxicity import fit, fold, score


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, fitted on the labels outside the held-out fifth, scores below one half."""
    model = fit(docs, table(spark, sf_dir, "labels"), fold(F.col("doc_id"), 5) != 0)
    return score(docs, model).where("predicted = 0").select(docs.columns)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without later copies of runs of 50 words or more; documents of which nothing is left go."""
    got = dedup_lines(docs).where("NOT (n_removed > 0 AND n_removed = n_lines)")
    n_chars = F.when(F.col("n_removed") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))
    return got.withColumn("n_chars", n_chars).select(docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of texts whose five-word shingles are 0.8 similar or more, the document of the smallest id."""
    return drop_near_duplicates(docs, words=5, similarity=0.8)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix by weights 3, 1, 2 and a share of 150 % takes them."""
    return mixed(docs)


def encode_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each text by the public 50k vocabulary, and what they decode to."""
    import public_tokenizers

    return round_trip(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, with_ids=True)


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_repeated_lines),
    ("near_dedup", drop_near_copies),
    ("mix", mix_sources),
    ("encode", encode_texts),
]
#: The classifier and the shingle fingerprints are beyond SQL. Tests hold the operator of each stage against brute force
#: and the stages, one after another, against planted cases.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder."""
    scratch, docs, path = Scratch(spark), table(spark, sf_dir, "documents"), None
    for _, stage in STAGES[:-1]:
        new, new_path = scratch.write(stage(spark, docs, sf_dir))
        scratch.drop(path)
        docs, path = new, new_path
    return STAGES[-1][1](spark, docs, sf_dir)

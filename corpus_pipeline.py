"""From raw documents to tokens: the stages of a corpus build, each a Spark job over all that is left."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparcel.llm import decontaminate, langid, line_dedup, ngram_join, pieces
from sparcel.llm.common import prepare, stored, table
from sparcel.llm.queries import TOKENIZERS

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]

#: A document goes if its language is undetermined, or none of the languages holds this share of its letters.
LEAST_SHARE = 0.35


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents without letters and those that no language fits; ``lang`` becomes the predicted one."""
    prepare(spark)
    found = langid.identify(docs, langid.fit(docs), predicted="__lang", score="__score")
    kept = found.where((F.col("__lang") != langid.UNDETERMINED) & (F.col("__score") >= LEAST_SHARE))
    return kept.select("doc_id", "text", F.col("__lang").alias("lang"), "source", "n_chars")


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cut repeated three-line passages; documents of which nothing is left go. ``n_chars`` follows the text."""
    out = line_dedup.dedup_lines(docs)
    left = out.where("n_removed < n_lines OR n_lines = 0")
    chars = F.when(F.col("n_removed") > 0, F.char_length("text").cast("long")).otherwise(F.col("n_chars").cast("long"))
    return left.withColumn("n_chars", chars).select(*COLUMNS)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the document with the smallest id of each group that n-gram Jaccard links connect."""
    prepare(spark)
    return ngram_join.one_of_each(docs).select(*COLUMNS)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that hold an item of the benchmark, up to edits."""
    prepare(spark)
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark")).select(*COLUMNS)


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of what is left, checked by decoding."""
    prepare(spark)
    vocabulary = pieces.Vocabulary.read(f"{TOKENIZERS}/piece_bpe_32k.model")
    encoded = pieces.encode(docs, vocabulary, check=True)
    return encoded.select("doc_id", "lang", "source", "n_chars", "token_ids", "n_tokens", "round_trip")


STAGES = [
    ("language_id", identify_language),
    ("line_dedup", drop_repeated_lines),
    ("ngram_jaccard", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("pieces", encode_pieces),
]

#: The classifier, the search for edited passages and the encoding have no SQL form; tests hold each
#: stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``; what a stage keeps is written and read again by the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)

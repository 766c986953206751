"""Corpus preparation: documents in, token ids of the documents that stay out.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run``
writes what a stage returns to the shared scratch folder and gives the next
one the table read back.  All stages but the last return the columns of
``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pixelchange.llm import decontaminate, lang_id, ngram_jaccard, relative_lz, sentencepiece_rounds
from pixelchange.llm.common import materialise, table
from pixelchange.llm.queries import piece_model

# A language that is less sure than this is none.
MIN_LANGUAGE_SCORE = 0.5


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter or without a clear language go."""
    named = lang_id.identify(docs, lang_id.train(lang_id.training_rows(docs)))
    sure = named.where((F.col("lang_pred") != lang_id.UNDETERMINED) & (F.col("score") >= MIN_LANGUAGE_SCORE))
    return sure.select(*[F.col(f"row.`{c}`") for c in docs.columns])


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document with the least id stays; of equal
    rows one.  Documents without id stay."""
    kept = ngram_jaccard.near_duplicates(docs).where("class_id = doc_id").select("doc_id").distinct()
    first = docs.join(kept, "doc_id", "left_semi").dropDuplicates(["doc_id", "text"])
    return first.unionByName(docs.where("doc_id IS NULL")).select(*docs.columns)


def cut_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words of passages that an earlier document has are taken out; a document of
    which nothing is left goes.  Untouched texts stay as they are."""
    parsed = relative_lz.remove_repeats(docs)
    touched = F.col("n_removed") > 0
    new = {"text": F.when(touched, F.col("kept_text")).otherwise(F.col("row.text"))}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.when(touched, F.length("kept_text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("row.n_chars"))
    return (parsed.where((F.col("n_removed") < F.col("n_words")) | (F.col("n_words") == 0))
            .select(*[new.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns]))


def drop_benchmark_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a passage that copies a test item go."""
    clean = decontaminate.find_leaks(docs, table(spark, sf_dir, "benchmark")).where(~decontaminate.leaked())
    return clean.select(*[F.col(f"row.`{c}`") for c in docs.columns])


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids, their number, and digests of the ids and of the text decoded again."""
    return sentencepiece_rounds.encode_documents(docs, piece_model())


STAGES = [
    ("language identification", identify_language),
    ("n-gram Jaccard join", drop_near_duplicates),
    ("substring dedup", cut_repeated_passages),
    ("benchmark decontamination", drop_benchmark_copies),
    ("SentencePiece", encode),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)


# Language identification and the tokenizer can't be put in SQL; tests/llm holds
# the stages against brute force.
ORACLE_SQL = None

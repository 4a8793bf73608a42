"""A training corpus from raw documents: five stages, each on all that the one before kept.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the
columns of ``documents``. ``run`` writes the result of a stage to the shared folder and starts
the next one from the files.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from uptake.llm.common import read, shipped, stored
from uptake.llm.decontamination import leaks
from uptake.llm.jaccard_join import keep_one
from uptake.llm.language_id import UNDETERMINED, fit, held_out, language_of
from uptake.llm.packing import pack, tokenised_pieces
from uptake.llm.sanitisation import disclosing_terms, sanitise, text_key

LEAST_CONFIDENCE = 0.5  # mean over the words of the probability of their likeliest language


@shipped
def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose words have a language, one or several; those without letters go as well."""
    found = language_of(F.col("text"), fit(docs.where(~held_out("doc_id"))))
    return docs.where((found["lang_pred"] != UNDETERMINED) & (found["confidence"] >= LEAST_CONFIDENCE))


@shipped
def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that with the smallest id, of each group of near copies."""
    return keep_one(docs)


@shipped
def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark item in them, in its words or re-parameterised."""
    row = F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("row")
    keyed = docs.select(text_key(F.coalesce("text", F.lit(""))).alias("key"), "text", row)
    leaky = leaks(keyed, read(spark, sf_dir, "benchmark"), id_col="key")
    leaky = leaky.select(F.col("id").alias("key")).distinct()
    return keyed.join(leaky, "key", "left_anti").select("row.*")


@shipped
def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data and words that disclose it generalised to their kind."""
    clean = sanitise(docs, disclosing_terms(docs))
    return clean.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


@shipped
def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of all documents, packed into sequences of 1024."""
    pieces = tokenised_pieces(
        docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    )
    return pack(pieces, docs.count()).select(
        F.col("id").alias("doc_id"), "start", "length", "ids", "ids_crc32", "doc_tokens",
        "sequence_id", "offset",
    )


STAGES = [
    ("language ID", language_id),
    ("n-gram Jaccard join", near_duplicates),
    ("benchmark decontamination", decontamination),
    ("PII", personal_data),
    ("packing", packing),
]

#: SQL has neither the tokenizer nor the language model; tests hold every stage against a plain
#: version of it.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = stored(docs, f"stage-{i}")
    return docs

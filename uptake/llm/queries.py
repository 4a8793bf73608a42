"""The registered queries of the operators, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from uptake.llm.chat_format import format_chats, read_chats
from uptake.llm.common import read, shipped
from uptake.llm.decontamination import leaks
from uptake.llm.html_extraction import main_text
from uptake.llm.jaccard_join import near_duplicate_classes
from uptake.llm.language_id import fit, held_out, identify
from uptake.llm.licenses import license_matches, templates
from uptake.llm.packing import pack, tokenised_pieces
from uptake.llm.phrases import collocations, count_phrases
from uptake.llm.prefix_trie import ordered_turns, rebuilt, trie_nodes
from uptake.llm.sanitisation import KINDS, disclosing_terms, find_spans
from uptake.llm.sharding import shard_documents
from uptake.llm.topk import top_k
from uptake.llm.warc import read_archive, write_archive
from uptake.sources.files import scratch_path


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = read(spark, sf_dir, "documents")
    pieces = tokenised_pieces(
        docs,
        public_tokenizers.path("byte_bpe_50k.tiktoken"),
        public_tokenizers.PATTERN,
        keep_ids=False,
    )
    packed = pack(pieces, docs.count())
    return packed.select(
        F.col("id").alias("doc_id"),
        *["start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"],
    )


def op2_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(read(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_path(spark, "archive")
    write_archive(read(spark, sf_dir, "pages"), folder)
    return read_archive(spark, folder).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = license_matches(read(spark, sf_dir, "documents"), templates(spark), best=True)
    return found.withColumnRenamed("id", "doc_id")


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    weights = {shard: 1.0 for shard in range(17)}
    rows = shard_documents(
        read(spark, sf_dir, "documents"), {s: weights[s] for s in range(16)}, weights
    )
    return rows.select(
        F.col("id").alias("doc_id"), "size", "text_crc32", F.lit("key").alias("law"),
        "shard", "slot", "grown_shard",
    )


def op6_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = main_text(read(spark, sf_dir, "pages"))
    return texts.select(
        F.col("id").alias("page_id"), "url", "text", F.length("text").cast("long").alias("n_chars")
    )


def op7_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = near_duplicate_classes(read(spark, sf_dir, "documents"))
    return rows.select(F.col("id").alias("doc_id"), "n_shingles", "component_id")


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = leaks(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
    return found.drop("row").withColumnRenamed("id", "doc_id")


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    model = fit(docs.where(~held_out("doc_id")))
    return identify(docs, model).select(
        F.col("id").alias("doc_id"), held_out("id").alias("held_out"), "lang_pred", "score"
    )


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    rows = find_spans(docs, disclosing_terms(docs))

    def joined(spans: Column) -> Column:
        return F.array_join(
            F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ","
        )

    def number(kind: str) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return rows.select(
        F.col("id").alias("doc_id"),
        *[number(kind) for kind in KINDS],
        F.sha2(joined(F.col("base")), 256).alias("base_sha256"),
        joined(F.concat("base", "terms")).alias("spans"),
    )


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    conv = F.col("conv")
    shared = (F.crc32(conv.cast("string").cast("binary")) % 4).cast("long")
    turns = ordered_turns(read(spark, sf_dir, "conversations"))
    return trie_nodes(*rebuilt(turns, shared, conv - conv % 20, most=3))


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    phrases, totals = count_phrases(read(spark, sf_dir, "documents"))
    return collocations(phrases, totals, most=2000)


def op13_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    control = "</s>[INST] ok [/INST]"
    added = spark.createDataFrame(
        [(-1, 0, "user", control), (-1, 1, "assistant", control)],
        "conv_id bigint, turn bigint, role string, text string",
    )
    return read_chats(*format_chats(turns.unionByName(added))).withColumnRenamed("id", "conv_id")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    query.__name__: shipped(query)
    for query in (
        op1_packing,
        op2_topk,
        op3_warc,
        op4_license_scan,
        op5_sharding,
        op6_html_extraction,
        op7_jaccard_join,
        op8_decontamination,
        op9_language_id,
        op10_pii,
        op11_prefix_trie,
        op12_collocations,
        op13_chat_format,
    )
}

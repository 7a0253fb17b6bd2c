"""The registered queries of this package: each applies one operator, with its production
parameters, to the whole of its table and derives the contract's columns from the output."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventlake.llm import (audit, bpe, chat, credentials, lines, minhash, packing, pii, quality, spelling,
                            token_files, toxicity, vectors)
from eventlake.llm.common import materialise, table
from eventlake.session import scratch_path


def tokenizer(name: str) -> str:
    """The place of a public tokenizer file (every node has the package)."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_multi_index_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.near_vectors(table(spark, sf_dir, "embeddings"), cosine=0.9)


def op2_chat_masks(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    says = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame([(-7, 0, "user", says), (-7, 1, "assistant", says)], own.schema)
    segments = chat.format_conversations(own.unionByName(extra), tokenizer("byte_bpe_50k.json"))
    return chat.read_back(segments)


def op3_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.personal_data(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", *[F.size(F.filter("__base", _of(k))).cast("long").alias(f"n_{k}") for k in pii.KINDS],
                        F.sha2(pii.joined("__base").cast("binary"), 256).alias("base_sha256"),
                        pii.joined("__spans").alias("spans"))


def _of(kind: str):
    return lambda s: s["kind"] == kind


def op4_bpe_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = bpe.encode_texts(table(spark, sf_dir, "documents"), tokenizer("word_bpe_49k.json"))
    return out.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
                      F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


def op5_toxic_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    remainder = lambda i: F.crc32(i.cast("string").cast("binary")) % 3
    model = toxicity.train(docs, labels, learn=lambda i: remainder(i) != 1)
    out = toxicity.scored(docs, model)
    return out.select("doc_id", (remainder(F.col("doc_id")) == 1).alias("held_out"), "score",
                      (F.col("score") >= 0.7).cast("int").alias("predicted"), F.size("passages").alias("n_passages"))


def op6_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.cut_pieces(table(spark, sf_dir, "documents"), tokenizer("byte_bpe_50k.json"),
                                size=1024, end_id=2)
    light = pieces.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"))
    return packing.pack(light, size=1024)


def op7_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = scratch_path(spark, "token-files")
    token_files.write_token_files(table(spark, sf_dir, "documents"), tokenizer("word_bpe_49k.json"), out, end_id=1)
    rows = token_files.read_token_files(spark, out)
    rows = materialise(rows.select("part", "block", "doc_id", "local", "n_tokens",
                                   F.crc32("ids").alias("ids_crc32")), "token-rows")
    return token_files.with_starts(rows).select("doc_id", "start", "n_tokens", "ids_crc32")


def op8_adaptive_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    out = quality.judged(docs)
    return out.select("doc_id", *[F.col(f"__{c}").alias(c) for c in (
        "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")])


def op9_line_spread(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = lines.without_boilerplate(table(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    return out.select("doc_id", F.col("__n_lines").alias("n_lines"), F.col("__n_removed").alias("n_removed"),
                      F.length("text").cast("long").alias("chars_left"),
                      F.sha2(F.col("text").cast("binary"), 256).alias("text_sha256"))


def op10_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), words=3, num=85, den=100)


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = audit.audit_documents(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return audit.order_report(found, {"good_lost": "good", "toxic_lost": "toxic"})


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = spelling.word_counts(table(spark, sf_dir, "documents"), drop_every=31)
    return spelling.variants(counts, least=7, least_n=2, times=10)


def op13_secret_ownership(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A document's source stands for the owner, the document for the repository."""
    found, _ = credentials.scanned(table(spark, sf_dir, "documents"), F.col("source"), F.col("doc_id"))
    base = F.filter("spans", lambda s: s["base"])
    return found.select("doc_id", *[F.size(F.filter("spans", _of(k))).cast("long").alias(f"n_{k}")
                                    for k in credentials.BASE_KINDS],
                        F.sha2(credentials.joined(base).cast("binary"), 256).alias("base_sha256"),
                        credentials.joined(F.col("spans")).alias("spans"))


QUERIES = {f.__name__: f for f in (
    op1_multi_index_dedup, op2_chat_masks, op3_personal_data, op4_bpe_roundtrip, op5_toxic_segments,
    op6_best_fit_packing, op7_token_files, op8_adaptive_quality, op9_line_spread, op10_minhash_dedup,
    op11_filter_audit, op12_spelling_variants, op13_secret_ownership)}

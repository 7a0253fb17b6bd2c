"""The corpus pipeline: quality rules, line dedup, near-duplicate removal, personal data masking,
packing.  Each stage is a DataFrame in, a DataFrame out; its result is written as Parquet and
read again as the next stage's documents.  Part of the training-data package ``eventlake.llm``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventlake.llm import lines, minhash, packing, pii, quality
from eventlake.llm.common import free_name, materialise, table
from eventlake.llm.queries import tokenizer


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules and their group's fences keep."""
    return quality.quality_filter(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without cross-site boilerplate lines (all but a line's first place)."""
    return lines.line_dedup(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates (5-word shingles, similarity 0.8), the one
    with the smallest doc_id; of repeated rows of it, one.  Documents without words stay."""
    groups = minhash.near_duplicates(docs, words=5, num=80, den=100, marks=True)
    mark = free_name(docs.columns, "mark")
    gone = groups.where("not kept").select("doc_id", F.col("mark").alias(mark)).distinct()
    marked = docs.withColumn(mark, minhash.text_mark(F.col("text").cast("string")))
    left = marked.join(gone, ["doc_id", mark], "left_anti").select(*docs.columns)
    named = left.where(F.col("doc_id").isNotNull()).dropDuplicates(["doc_id", "text"])
    return named.unionByName(left.where(F.col("doc_id").isNull()))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with personal data masked."""
    return pii.masked(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The packed pieces: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    pieces = packing.cut_pieces(docs, tokenizer("byte_bpe_50k.json"), size=1024, end_id=2)
    return packing.pack(pieces.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32")),
                        size=1024)


STAGES = [("quality_rules", quality_rules), ("line_dedup", line_dedup), ("near_dedup", near_dedup),
          ("personal_data", personal_data), ("pack", pack)]

#: The tokenizer and the trained span classifier have no SQL form.  The tests hold the operators
#: against brute force, and the stages and run on hard rows.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, from the given documents to packed sequences."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)

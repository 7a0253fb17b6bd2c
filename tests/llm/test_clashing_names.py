"""Columns that bear the operators' own inner names pass through every operator and stage unchanged, and
nothing of a text is found in them."""

import re
from pathlib import Path

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
import public_tokenizers
from eventlake.llm import common, lines, packing, pii, quality

HERE = Path(common.__file__).parent
INNER = sorted({n for p in HERE.glob("*.py") for n in re.findall(r"[\"'](__\w+)[\"']", p.read_text())}
               | {f"__{t}{x}_{k}" for t in "bl" for x in "fps" for k in pii.KINDS} | {"__T", "passing0x0", "mark_0", "mark"})
SECRET = "me.x@y.org"
PROSE = " ".join(f"word{chr(97 + k % 26)}{chr(97 + k // 26)}" for k in range(60))


def documents(spark):
    rows = [(i, f"{PROSE} {i} Mail {SECRET} now.\nshared line of more than ten words stands here in every single text\n{PROSE[::-1]} {i * 7919}",
             "en", f"s{i % 3}") for i in range(12)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    names = {n.lower(): n for n in INNER}                          # Spark's names know no case
    return df.select("*", *[F.concat(F.lit(f"{n}="), F.col("doc_id").cast("string")).alias(n) for n in names.values()])


def check(out, added=()):
    rows = [r.asDict() for r in out.collect()]
    assert rows
    for r in rows:
        for n in set(out.columns) - {"doc_id", "text", "lang", "source", *added}:
            assert r[n] == f"{n}={r['doc_id']}", n
    return rows


@pytest.mark.parametrize("stage", [pii.masked, lines.line_dedup, quality.quality_filter,
                                   lambda d: corpus_pipeline.near_dedup(d.sparkSession, d, "")],
                         ids=["masked", "line_dedup", "quality_filter", "near_dedup"])
def test_stages_pass_inner_names_through(spark, stage):
    docs = documents(spark)
    out = stage(docs)
    assert out.columns == docs.columns
    rows = check(out)
    if stage is pii.masked:
        assert all(SECRET not in str(v) for r in rows for v in r.values()) and all("<EMAIL>" in r["text"] for r in rows)


@pytest.mark.parametrize("operator, adds", [
    (pii.personal_data, {"__base", "__spans"}), (lines.without_boilerplate, {"__n_lines", "__n_removed"}),
    (quality.judged, {"__base_failed", "__kept", "__n_words", "__word_chars", "__n_symbols", "__n_dup_lines", "__n_repeat_words"})])
def test_operators_refuse_the_columns_that_they_add_and_pass_the_others(spark, operator, adds):
    docs = documents(spark)
    with pytest.raises(ValueError, match="adds columns"):
        operator(docs)
    rest = docs.drop(*adds)
    check(operator(rest), added=adds)


def test_packing_passes_inner_names_through(spark):
    docs = documents(spark)
    names = [c for c in docs.columns if c not in ("doc_id", "text", "lang", "source")]
    pieces = packing.cut_pieces(docs.select("doc_id", "text"), public_tokenizers.path("byte_bpe_50k.json"), size=64, end_id=2)
    light = pieces.select("doc_id", "piece", "length").join(docs.select("doc_id", *names), "doc_id")
    out = packing.pack(light, size=64)
    check(out, added=("piece", "length", "sequence_id", "offset"))
    assert out.count() == light.count()

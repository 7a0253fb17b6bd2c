"""The pipeline on tables with nulls, repeated rows, ties, empty and very long texts, clashing columns, and none."""

import random
from collections import defaultdict

import corpus_pipeline
import public_tokenizers
from eventlake.llm import tokens

RNG = random.Random(6)
PROSE = [" ".join("".join(RNG.choice("abcdefghijklmnop") for _ in range(6)) for _ in range(40 + d)) for d in range(12)]
LONG = " ".join("".join(RNG.choice("abcdefghijklmnop") for _ in range(6)) for _ in range(6000))
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, __t string, mark string, sequence_id long"


def tables(spark, folder, rows):
    made = [(i, t, lang, src, None if t is None else len(t), "x", "y", 5) for i, t, lang, src in rows]
    spark.createDataFrame(made, SCHEMA).repartition(3).write.parquet(f"{folder}/documents.parquet")
    return folder


ROWS = [*[(d, p, "en", f"s{d % 4}") for d, p in enumerate(PROSE)],
        (50, PROSE[0], "en", "s9"), (51, PROSE[1] + " tail", "en", "s9"),           # an exact and a near copy
        (52, PROSE[2], "en", "s2"), (52, PROSE[2], "en", "s2"),                     # repeated rows, copies of 2
        (None, " ".join(reversed(PROSE[3].split())), None, None), (60, None, "en", "s1"), (61, "", "en", "s1"),
        (62, " \n ", None, "s1"), (63, LONG, "fr", None), (64, PROSE[4][::-1] + " Mail me.x@y.org now", "en", "s3")]


def test_run_on_hard_rows(spark, tmp_dir):
    rows = [r.asDict() for r in corpus_pipeline.run(spark, tables(spark, tmp_dir, ROWS)).collect()]
    got = {r["doc_id"] for r in rows}
    # without words: rejected; copies: the smallest id stays; all others are there
    assert got == {*range(12), None, 63, 64}
    lib = tokens.PieceEncoder(public_tokenizers.path("byte_bpe_50k.json")).lib
    sizes, places = defaultdict(int), defaultdict(list)
    for r in rows:
        sizes[r["doc_id"]] += r["length"]
        places[r["sequence_id"]].append((r["offset"], r["length"]))
    for i, t, *_ in ROWS:
        if i in (0, 5, 63):
            assert sizes[i] == len(lib.encode(t, add_special_tokens=False).ids) + 1
    for own in places.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= 1024


def test_run_on_no_rows(spark, tmp_dir):
    assert corpus_pipeline.run(spark, tables(spark, tmp_dir, [])).count() == 0


def test_stages_keep_the_columns_and_mask(spark, tmp_dir):
    docs = spark.read.parquet(f"{tables(spark, tmp_dir, ROWS)}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, tmp_dir)
        assert out.columns == docs.columns, name
        docs = spark.createDataFrame(out.collect(), out.schema)
    left = {r["doc_id"]: r for r in docs.collect()}
    assert "<EMAIL>" in left[64]["text"] and "me.x@y.org" not in str(left[64])
    assert left[64]["n_chars"] == len(left[64]["text"]) and left[63]["text"] == LONG and left[63]["__t"] == "x"

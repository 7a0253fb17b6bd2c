"""Each operator against brute force, an exact round trip or held-out accuracy, and on nulls, empty
and very long texts, ties and repeated rows, empty tables and clashing extra columns."""

import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from eventlake.llm import (bpe, chat, components, lines, minhash, packing, pii, quality, token_files,
                           tokens, toxicity, vectors)
from tests.conftest import SF001
from tests.llm import brute

WORD, BYTE = public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.path("byte_bpe_50k.json")
DOCS = "doc_id long, text string, lang string, source string, key string, n long, id long, sig string"


def docs_of(spark, texts, source="s"):
    """Documents with extra columns whose names the operators use inside, in several partitions."""
    rows = [(i, t, "en", source, "k", 1, 2, "x") for i, t in texts]
    return spark.createDataFrame(rows, DOCS).repartition(3)


LONG = " ".join(f"w{k % 977}" for k in range(30_000))
HARD = [(1, None), (2, ""), (3, " \n\t "), (4, "one"), (5, "one two"), (6, LONG), (7, LONG + " tail"), (8, "a b c d e f g h i j " * 4),
        (8, "a b c d e f g h i j " * 4), (9, "x" * 40_000), (10, "Mail me.x@y.org, call +1 (555) 010-9999\n" * 30),
        (11, "Grüße 🙂 é \x1c\x85 <|endoftext|> 中文 it's"), (12, "0" * 30_000), (13, "a@" * 3000), (14, "1.2.3.4 " * 600)]
UNIQUE = [*HARD[:7], HARD[7], *HARD[9:]]


# --- tokens ------------------------------------------------------------------------------------

@pytest.mark.parametrize("path", [WORD, BYTE])
def test_pieces_give_the_librarys_ids(path):
    own = tokens.PieceEncoder(path, long_piece=48)
    rng = random.Random(5)
    letters = ["a", "the", "'s", "'re", "'", "!", "**", " ", "  ", "\n", "\t", " \n", "é", "ß", "Σ", "İ", "é", "́",
               "\x1c", "\x85", "\xa0", " ", "中文", "🙂", "<|endoftext|>", "<|", "12", "½", "Ⅷ", "​", "한국", "ǅ"]
    for _ in range(3000):
        text = "".join(rng.choice(letters) for _ in range(rng.randint(0, 14)))
        want = own.lib.encode(text, add_special_tokens=False).ids
        assert own.ids(text).tolist() == want, text
        assert own.decode(want) == own.lib.decode(want, skip_special_tokens=False)


@pytest.mark.parametrize("path", [WORD, BYTE])
def test_tree_concatenation_is_exact(path):
    own = tokens.PieceEncoder(path, long_piece=32)
    rng = random.Random(6)
    for kind in (["a"], ["ab"], ["a", "b", "'"], ["!", "'", "s", "re"], ["é", "e", "́", "한"], list("etaoinshrdlu")):
        for _ in range(40):
            text = "".join(rng.choice(kind) for _ in range(rng.randint(33, 700)))
            assert tokens.tree_encode(own, text)[0] == own.lib.encode(text, add_special_tokens=False).ids


def test_bpe_round_trip(spark):
    lib = tokens.PieceEncoder(WORD).lib
    rows = bpe.encode_texts(docs_of(spark, HARD), WORD).collect()
    want = defaultdict(list)
    for i, t in HARD:
        want[i].append(lib.encode(t or "", add_special_tokens=False).ids)
    assert len(rows) == len(HARD)
    for r in rows:
        ids = np.frombuffer(r["ids"], "<u4").tolist()
        assert ids in want[r["doc_id"]] and r["n_tokens"] == len(ids)
        assert r["decoded"] == lib.decode(ids, skip_special_tokens=False)
    assert bpe.encode_texts(docs_of(spark, []), WORD).count() == 0


# --- packing -----------------------------------------------------------------------------------

def check_slots(rows, size):
    seqs = defaultdict(list)
    for r in rows:
        seqs[r["sequence_id"]].append((r["offset"], r["length"]))
    for own in seqs.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= size
    return len(seqs)


def test_packing(spark):
    lib = tokens.PieceEncoder(BYTE).lib
    pieces = packing.cut_pieces(docs_of(spark, UNIQUE), BYTE, size=64, end_id=2)
    rows = packing.pack(pieces, size=64).collect()
    total = 0
    for i, t in UNIQUE:
        ids = [*lib.encode(t or "", add_special_tokens=False).ids, 2]
        own = sorted((r for r in rows if r["doc_id"] == i), key=lambda r: r["piece"])
        assert [x for r in own for x in np.frombuffer(r["ids"], "<u4").tolist()] == ids
        assert all(r["length"] == 64 for r in own[1:]) and len(own) == -(-len(ids) // 64)
        total += len(ids)
    assert check_slots(rows, 64) <= -(-total // 64) * 11 // 9 + 1
    whole = packing.sequences(packing.pack(pieces, size=64)).collect()
    assert sum(len(r["ids"]) // 4 for r in whole) == total
    assert packing.pack(packing.cut_pieces(docs_of(spark, []), BYTE)).count() == 0
    with pytest.raises(ValueError):
        packing.pack(spark.createDataFrame([(1, 70)], "doc_id long, length long"), size=64)


def test_plan_matches_best_fit_item_by_item():
    rng = random.Random(7)
    for _ in range(60):
        size = rng.choice([8, 16, 33])
        items = [rng.randint(1, size) for _ in range(rng.randint(1, 120))]
        free: list[int] = []
        for x in sorted(items, reverse=True):
            fits = [f for f in free if f >= x]
            if fits:
                free[free.index(min(fits))] -= x
            else:
                free.append(size - x)
        counts = {x: items.count(x) for x in set(items)}
        plan = packing.plan_best_fit(counts, size)
        used = {s + k for _, a, b, s, _ in plan for k in range(b - a)}
        assert len(used) == len(free)
        for x, n in counts.items():
            assert sorted(r for l, a, b, _, _ in plan if l == x for r in range(a, b)) == list(range(n))


# --- token files -------------------------------------------------------------------------------

def test_byte_code():
    ranks = np.array([0, 255, 256, 65535, 65536, 2 ** 24 - 1, 2 ** 24, 2 ** 32 - 1, 7], np.uint32)
    control, data = token_files.pack_ranks(ranks)
    back = token_files.unpack_ranks(np.frombuffer(control, np.uint8), np.frombuffer(data, np.uint8), len(ranks))
    assert back.tolist() == ranks.tolist() and len(data) == 1 + 1 + 2 + 2 + 3 + 3 + 4 + 4 + 1
    empty = token_files.pack_ranks(np.zeros(0, np.uint32))
    assert len(token_files.unpack_ranks(np.frombuffer(empty[0], np.uint8), np.frombuffer(empty[1], np.uint8), 0)) == 0


@pytest.mark.parametrize("path", [WORD, BYTE])
def test_plain_texts_give_the_librarys_ids(path):
    rng, own = random.Random(5), tokens.PieceEncoder(path, long_piece=40, cache=64)
    letters = ["  ", " ", "\n", "'", "s", "re", "a", "Bc", "é", "Ü", "7", "42", ".", "!!", "^", "<|", "ß", "x" * 45]
    texts = ["".join(rng.choices(letters, k=rng.randrange(40))) for _ in range(1500)]
    texts += ["", " ", "\n\n", "a \n", " a", "it's 'save\n\n\nb  c"]
    got = [np.frombuffer(b, own.dtype).tolist() for k in range(0, len(texts), 90) for b in own.encode(texts[k:k + 90])]
    assert got == [own.lib.encode(t, add_special_tokens=False).ids for t in texts]


def test_token_files(spark, tmp_dir):
    lib = tokens.PieceEncoder(WORD).lib
    token_files.write_token_files(docs_of(spark, UNIQUE), WORD, tmp_dir + "/out", block_tokens=500)
    rows = {r["doc_id"]: r for r in token_files.with_starts(token_files.read_token_files(spark, tmp_dir + "/out")).collect()}
    at = 0
    for i, t in sorted(UNIQUE, key=lambda d: d[0]):
        ids = [*lib.encode(t or "", add_special_tokens=False).ids, 1]
        assert np.frombuffer(rows[i]["ids"], "<u4").tolist() == ids
        assert (rows[i]["start"], rows[i]["n_tokens"]) == (at, len(ids))
        at += len(ids)
    nulls = spark.createDataFrame([(None, "b a"), (None, "c"), (3, "d")], "doc_id long, text string")
    token_files.write_token_files(nulls, WORD, tmp_dir + "/nulls")
    got = token_files.with_starts(token_files.read_token_files(spark, tmp_dir + "/nulls")).collect()
    assert sorted((r["doc_id"] is None, r["n_tokens"]) for r in got) == [(False, 2), (True, 2), (True, 3)]
    token_files.write_token_files(docs_of(spark, []), WORD, tmp_dir + "/none")
    assert token_files.read_token_files(spark, tmp_dir + "/none").count() == 0


# --- near duplicates -----------------------------------------------------------------------------

def test_components(spark):
    rng = random.Random(8)
    for n, m in ((40, 30), (60, 90)):
        links = [(rng.randrange(n), rng.randrange(n)) for _ in range(m)] + [(k, k + 1) for k in range(100, 130)]
        want = brute.components(list({x for p in links for x in p}), links)
        got = components.connected_components(spark.createDataFrame(links, "a long, b long")).collect()
        assert {r["node"]: r["component"] for r in got} == {k: v for k, v in want.items() if any(k in p for p in links if p[0] != p[1])}
    assert components.connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def edited(rng, words, share):
    return " ".join(w if rng.random() > share else f"e{rng.randrange(10 ** 6)}" for w in words)


@pytest.mark.parametrize("k,num,den,block", [(3, 85, 100, 1024), (5, 80, 100, 8)])
def test_near_duplicates(spark, k, num, den, block):
    rng = random.Random(9)
    texts, i = [], 0
    for _ in range(12):
        base = [f"v{rng.randrange(3000)}" for _ in range(rng.choice([4, 30, 120]))]
        for _ in range(rng.choice([1, 3, 25])):
            texts.append((i, edited(rng, base, rng.choice([0, 0.01, 0.02, 0.06]))))
            i += 1
    texts += [(i, None), (i + 1, ""), (i + 2, "Solo"), (i + 3, "solo"), (i + 4, LONG), (i + 5, LONG.upper())]
    want = brute.near_duplicates(texts, k, num, den)
    got = minhash.near_duplicates(docs_of(spark, texts), words=k, num=num, den=den, block=block).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in got} == want


def test_near_duplicates_edge_rows(spark):
    rows = [(None, "a b c d"), (5, "a b c d"), (5, "a b c d"), (6, "A b c d"), (7, "other words in here")]
    got = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), words=3, num=85, den=100).collect()
    assert sorted((r["doc_id"] or -1, r["component_id"], r["kept"]) for r in got) == [
        (-1, None, True), (5, 5, True), (5, 5, True), (6, 5, False), (7, 7, True)]
    assert minhash.near_duplicates(docs_of(spark, [])).count() == 0


def test_one_id_on_two_texts_is_two_documents(spark):
    """(5, A), (5, B), (2, near copy of B): A has no duplicate and stays, in the pipeline as well; of
    two near copies under one id, one stays."""
    words = [f"b{k}" for k in range(100)]
    near = " ".join([*words[:-1], "other"])
    a, b = " ".join(f"a{k}" for k in range(60)), " ".join(words)
    c = [f"c{k}" for k in range(100)]
    rows = [(5, a), (5, b), (2, near), (9, " ".join(c)), (9, " ".join([*c[:-1], "other"]))]
    got = minhash.near_duplicates(docs_of(spark, rows), marks=True)
    by_text = {r["text"]: r for r in docs_of(spark, rows).select("doc_id", "text", minhash.text_mark(F.col("text")).alias("mark"))
               .join(got, ["doc_id", "mark"]).collect()}
    assert (by_text[a]["component_id"], by_text[a]["kept"]) == (5, True)
    assert (by_text[b]["component_id"], by_text[b]["kept"]) == (2, False)
    assert (by_text[near]["component_id"], by_text[near]["kept"]) == (2, True)
    left = [(r["doc_id"], r["text"]) for r in corpus_pipeline.near_dedup(spark, docs_of(spark, rows), "").collect()]
    assert sorted(x for x in left if x[0] != 9) == [(2, near), (5, a)] and len(left) == 3


def test_near_vectors(spark):
    rng = np.random.default_rng(3)
    base = rng.standard_normal((12, 16))
    rows = [(i, (base[i % 12] + rng.standard_normal(16) * rng.choice([0.01, 0.1, 0.25])).tolist()) for i in range(300)]
    rows += [(300, rows[0][1]), (301, [2 * x for x in rows[0][1]]), (302, None), (303, [0.0] * 16),
             (304, [float("nan")] * 16), (305, [float("inf")] + [0.0] * 15), (306, [None] + [1.0] * 15), (307, [])]
    df = spark.createDataFrame([(i, v, 1, "n", "c") for i, v in rows], "vec_id long, embedding array<double>, label int, node string, cell string")
    x = np.array([v for _, v in rows[:302]])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    hit = x @ x.T >= 0.9
    np.fill_diagonal(hit, False)
    root = brute.components(list(range(308)), zip(*map(list, np.nonzero(hit)), strict=True))
    for block in (1024, 16):
        got = {r["vec_id"]: r for r in vectors.near_vectors(df, codewords=8, block=block).collect()}
        assert len(got) == 308
        found = sum(r["n_links"] for r in got.values())
        assert found >= 0.97 * hit.sum() and all(got[i]["n_links"] <= hit[i].sum() for i in range(302))
        assert sum(got[i]["component_id"] == root[i] for i in range(308)) >= 300
        assert all(got[i]["n_links"] == 0 and got[i]["kept"] for i in range(302, 308))
    assert vectors.near_vectors(df.limit(0)).count() == 0


def test_every_length_of_vectors_is_indexed(spark):
    assert vectors._lengths(spark.range(1, 1501).select(F.col("id").cast("int").alias("dim"))) == list(range(1, 1501))


def test_multi_sequence_visits_in_order():
    d1, d2 = np.array([3.0, 1.0, 2.0]), np.array([0.5, 4.0])
    cells = vectors.multi_sequence(d1, d2, 5.0)
    near = sorted((d1[i] + d2[j], i * 2 + j) for i in range(3) for j in range(2) if d1[i] + d2[j] <= 5.0)
    assert sorted(cells) == sorted(c for _, c in near)
    assert [d1[c // 2] + d2[c % 2] for c in cells] == sorted(d for d, _ in near)


# --- chat ----------------------------------------------------------------------------------------

def test_chat(spark):
    says = ["</s>[INST] ok [/INST]", None, "", "plain 🙂 é", "back\\slash <|done|>\n<|turn|>", "x" * 5000, " lead", "tail<"]
    rng = random.Random(10)
    rows = [(c, t, rng.choice(["user", "assistant", None]), rng.choice(says)) for c in (1, 2, 3, None) for t in range(40)]
    df = spark.createDataFrame([(*r, "extra") for r in rows], "conv_id long, turn long, role string, text string, part string")
    for chars in (1 << 18, 50):
        got = {r["conv_id"]: r for r in chat.read_back(chat.format_conversations(df, BYTE, segment_chars=chars)).collect()}
        for c in (1, 2, 3, None):
            own = sorted((r for r in rows if r[0] == c), key=lambda r: r[1])
            turns = "".join(f"{r or ''}\n{t or ''}\n" for _, _, r, t in own)
            loss = "".join(t or "" for _, _, r, t in own if r == "assistant")
            assert got[c]["turns_sha256"] == hashlib.sha256(turns.encode()).hexdigest()
            assert (got[c]["n_turns"], got[c]["loss_chars"]) == (40, len(loss))
            assert got[c]["loss_sha256"] == hashlib.sha256(loss.encode()).hexdigest()
    one = chat.format_conversations(df, BYTE, segment_chars=50)
    two = chat.format_conversations(df, BYTE)
    ids = lambda f: {c: b"".join(r["ids"] for r in sorted(rs, key=lambda r: (r["part"], r["segment"])))
                     for c, rs in _grouped(f.collect()).items()}
    assert ids(one) == ids(two)          # cutting into segments does not change the tokens
    assert chat.read_back(chat.format_conversations(df.limit(0), BYTE)).count() == 0


def _grouped(rows):
    out = defaultdict(list)
    for r in rows:
        out[r["conv_id"]].append(r)
    return out


# --- personal data, quality, lines (DataFrame functions only) ------------------------------------

def test_base_spans(spark):
    texts = [*UNIQUE, (20, "a@b.c@d.e x_a@b.co_z@q.r 1.2.3.4.5.6.7.8 300.1.1.1 4111 1111 1111 1111 4111-1111-1111-1112"),
             (21, "+1 (555) 010-9999 +33 1 23 45 67 89 +1 2 a+b@c.de +++1234567890"), (22, "é🙂 me@x.org 10.0.0.1")]
    got = {r["doc_id"]: r for r in pii.personal_data(docs_of(spark, texts)).collect()}
    for i, t in texts:
        want = brute.base_spans(t)
        assert [tuple(s) for s in got[i]["__base"]] == want, i
        assert set(want) <= {tuple(s) for s in got[i]["__spans"]}
    assert pii.personal_data(docs_of(spark, [])).count() == 0


def test_masking(spark):
    texts = [(1, "write me@x.org now"), (2, None), (3, "clean"), (4, "é 10.0.0.1")]
    df = docs_of(spark, texts).withColumn("n_chars", F.length("text").cast("long"))
    got = {r["doc_id"]: r for r in pii.masked(df).collect()}
    assert [got[i]["text"] for i in (1, 2, 3, 4)] == ["write <EMAIL> now", None, "clean", "é <IP>"]
    assert got[1]["n_chars"] == len("write <EMAIL> now") and got[1].asDict().keys() == set(df.columns)


def test_reliabilities_find_the_false_kind():
    votes = lambda p, g: {"pattern": p, "gazetteer": g, "context": 0, "surround": 1, "variety": 0}
    counts = [{"kind": "card", **votes(1, 1), "n": 500}, {"kind": "card", **votes(-1, -1), "n": 500},
              {"kind": "card", **votes(-1, 1), "n": 40}]
    fit = pii.reliabilities(counts)
    assert fit["posterior"][0] > 0.9 and fit["posterior"][1] < 0.1 and fit["posterior"][2] < 0.5


def test_quality_statistics(spark):
    texts = [*UNIQUE, (30, "#a $b\n#a $b\n\n \nc d"), (31, "p q r s t u v w " * 3 + "end")]
    got = {r["doc_id"]: r for r in quality.judged(docs_of(spark, texts)).collect()}
    for i, t in texts:
        r = got[i]
        assert tuple(r[f"__{c}"] for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")) == brute.text_statistics(t), i
        n, _, _, _, rep = brute.text_statistics(t)
        assert r["__base_failed"] == (n < 20 or 100 * rep > 30 * n)
        assert not (r["__base_failed"] and r["__kept"])
    assert quality.judged(docs_of(spark, [])).count() == 0


def test_quality_fences_adapt_and_keep_clean_documents(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    labels = spark.read.parquet(f"{SF001}/labels.parquet")
    out = quality.judged(docs.drop("lang").withColumn("lang", F.lit(None).cast("string"))).join(labels, "doc_id")
    c = {(r["quality"], r["__kept"]): r["n"] for r in out.groupBy("quality", "__kept").agg(F.count("*").alias("n")).collect()}
    good = c.get((1, True), 0)
    assert good >= 0.9 * (good + c.get((1, False), 0))


def test_quality_fences_follow_each_sources_own_spread(spark):
    """Word lengths spread little in one source and much in the other, repeated lines differ in the
    tail alone: the fences differ, junk in a tail does not widen its fence, and a source without
    any spread takes the assumed one."""
    rows = []
    for source, step, tail in (("narrow", 1, 4), ("wide", 6, 30)):
        rows += [("en", source, "word_length", 500 + step * (k % 41 - 20), 10) for k in range(41)]
        rows += [("en", source, "dup_lines", 0, 360), ("en", source, "dup_lines", tail, 50)]
        rows += [("en", source, "symbols", 0, 350), ("en", source, "symbols", 2900, 60)]
        rows += [("en", source, "repeated", 0, 410)]
    sketch = spark.createDataFrame(rows, "lang string, source string, feature string, bucket long, n long")
    sketch = (sketch.withColumn("bucket", quality._bucket(F.col("bucket")))
              .groupBy("lang", "source", "feature", "bucket").agg(F.sum("n").alias("n")))
    got = {r["source"]: r for r in quality.thresholds(sketch).collect()}
    slim, wide = got["narrow"], got["wide"]
    assert slim["lo_word_length"] > wide["lo_word_length"] + 200 and slim["hi_word_length"] < wide["hi_word_length"] - 200
    assert (slim["hi_dup_lines"], wide["hi_dup_lines"]) == (8, 60)
    assert slim["hi_symbols"] == wide["hi_symbols"] == 300 and slim["hi_repeated"] == 270


def test_lines(spark):
    rng = random.Random(11)
    pool = [f"boiler {k}" for k in range(6)] + ["  padded\t", "", "   "]
    rows = []
    for i in range(80):
        text = None if i == 7 else "\n".join(rng.choice(pool) if rng.random() < 0.6 else f"own {i} {k}" for k in range(rng.randint(0, 9)))
        rows.append((i, text, rng.choice([None, "a", "b", "c", "d", "e", "f"]), "x"))
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, site string").repartition(4)
    for most in (2, 5):
        want = brute.without_boilerplate([r[:3] for r in rows], most)
        got = {r["doc_id"]: (r["__n_lines"], r["__n_removed"], r["text"]) for r in lines.without_boilerplate(df, most_sites=most).collect()}
        assert got == want
    kept = {r["doc_id"] for r in lines.line_dedup(df, most_sites=2).collect()}
    want = brute.without_boilerplate([r[:3] for r in rows], 2)
    assert kept == {i for i, (n, gone, _) in want.items() if not gone or gone < n}
    assert lines.without_boilerplate(df.limit(0)).count() == 0


def test_line_spread_is_judged_by_what_chance_explains(spark):
    """Ordinary short lines stay as the corpus grows, although they reach every site; a long line on
    two to four sites goes, and so does a short one that its words do not explain."""
    rng = random.Random(13)
    common = [f"c{k}" for k in range(12)]
    long_line = " ".join(f"terms{k}" for k in range(30))

    def removed(size):
        rows = []
        for i in range(size):
            text = [f"{rng.choice(common)}.", f"{rng.choice(common)} and {rng.choice(common)}."]
            text += [" ".join([f"own{i}", *rng.choices(common, k=5)]), " ".join(f"body{i}x{k}" for k in range(40))]
            text += [long_line] if i in (3, 24, 45) else []
            text += ["Alle Rechte vorbehalten."] if i % 9 == 0 else []
            rows.append((i, "\n".join(text), f"s{i % 20}"))
        df = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(4)
        left = {r["doc_id"]: r["text"] for r in lines.without_boilerplate(df).collect()}
        return [sorted(set(t.split("\n")) - set(left[i].split("\n"))) for i, t, _ in rows]

    for size in (200, 2000):
        gone = removed(size)
        assert {x for g in gone for x in g} == {long_line, "Alle Rechte vorbehalten."}, size
        assert long_line not in gone[3] and long_line in gone[24] and long_line in gone[45]


# --- toxicity ------------------------------------------------------------------------------------

def test_maximal_segments_against_brute_force():
    """A maximal segment has no better proper part at its ends and is in no larger such segment."""
    def slow(scores, a, b):
        if a >= b or max(scores[a:b], default=0) <= 0:
            return []
        best = max(((sum(scores[i:j]), -(j - i), -i) for i in range(a, b) for j in range(i + 1, b + 1)))
        i, j = -best[2], -best[2] - best[1]
        return [*slow(scores, a, i), (i, j, best[0]), *slow(scores, j, b)]

    rng = random.Random(12)
    for _ in range(400):
        scores = [rng.randint(-5, 5) + rng.random() / 7 for _ in range(rng.randint(0, 14))]
        got = toxicity.maximal_segments(scores)
        want = slow(scores, 0, len(scores))
        assert [(a, b) for a, b, _ in got] == [(a, b) for a, b, _ in want]
        assert all(abs(x[2] - y[2]) < 1e-9 for x, y in zip(got, want, strict=True))


def test_toxicity_on_held_out_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    rest = lambda i: F.crc32(i.cast("string").cast("binary")) % 3
    model = toxicity.train(docs, labels, learn=lambda i: rest(i) != 1)
    out = toxicity.scored(docs, model).join(labels, "doc_id").where(rest(F.col("doc_id")) == 1).collect()
    yes, no = ([r["score"] for r in out if r["toxic"] == k] for k in (1, 0))
    assert sum((a > b) + 0.5 * (a == b) for a in yes for b in no) / len(yes) / len(no) > 0.75
    hard = toxicity.scored(docs_of(spark, HARD), model).collect()
    assert len(hard) == len(HARD) and all(0 <= r["score"] <= 1 for r in hard)
    assert toxicity.scored(docs_of(spark, []), model).count() == 0
    assert toxicity.train(docs.limit(0), labels.limit(0)).odds == {}


def test_crc_helper_matches_zlib(spark):
    r = spark.range(1).select(F.crc32(F.lit("42").cast("binary")).alias("c")).first()
    assert r["c"] == zlib.crc32(b"42")

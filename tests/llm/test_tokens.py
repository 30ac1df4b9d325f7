"""Tokenisation, packing, the token store and chat formatting."""

import hashlib
import struct
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from arborpay.llm import token_store
from arborpay.llm.chat_format import conversation_digests, covered, escape, format_conversations, mask, parse, render, unescape
from arborpay.llm.packing import pack_examples, pack_documents, piece_digests, place
from arborpay.llm.token_store import TokenStore, crc32_joined, cuts, store_documents
from arborpay.llm.tokens import ChunkTokenizer

ODD = [None, "", "  ", "a b c", "x|y | z", "İstanbul ΣΑΣ don't I'LL 's", "é a ́x", " foo\x1cbar\x85baz", "<|endoftext|> a<|ENDOFTEXT|>b", "12ab 3.4 ,,, ...", "中文 字。", "ﬁ ǅ ʰ", "µ ß ÿ'd Ångström²"]


@pytest.fixture(scope="module")
def tokenizer():
    return ChunkTokenizer("word_bpe_49k.json")


def test_chunks_equal_the_library(tokenizer):
    assert tokenizer.encode([None if t is None else t.encode() for t in ODD]) == [tokenizer.whole(t or "") for t in ODD]


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.characters(exclude_categories=["Cs"]), max_size=40))
def test_any_text_equals_the_library(text):
    tok = test_any_text_equals_the_library.__dict__.setdefault("tok", ChunkTokenizer("word_bpe_49k.json"))
    assert tok.encode([text.encode()]) == [tok.whole(text)]


def documents(spark):
    rows = [(i * 3, t, "x", 1.0) for i, t in enumerate(ODD)] + [(900, "the quick brown fox jumps. " * 4000, "x", 1.0), (7, "a b", "x", 1.0), (7, "a b", "x", 1.0), (None, "null id", "x", 1.0)]
    return spark.createDataFrame(rows, "doc_id long, text string, start string, length double").repartition(3), rows


def test_packing_places_every_id_once(spark, tokenizer):
    docs, rows = documents(spark)
    got = pack_documents(docs).collect()
    want = {}
    for i, t, *_ in rows:
        want.setdefault(i, []).append(tokenizer.whole(t or "") + struct.pack("<I", 1))
    pieces = {}
    for r in sorted(got, key=lambda r: r["start"]):
        pieces.setdefault(r["doc_id"], []).append(r)
    for i, texts in want.items():
        assert sum(len(r["ids"]) for r in pieces[i]) == sum(map(len, texts))
        if len(texts) == 1:
            assert b"".join(bytes(r["ids"]) for r in pieces[i]) == texts[0]
    sequences = {}
    for r in sorted(got, key=lambda r: r["offset"]):
        at = sequences.get(r["sequence_id"], 0)
        assert r["offset"] == at
        sequences[r["sequence_id"]] = at + r["length"]
    assert max(sequences.values()) <= 2048
    crcs = piece_digests(pack_documents(docs)).where("doc_id = 900 and start = 0").first()
    assert crcs["ids_crc32"] == zlib.crc32(want[900][0][: 4 * crcs["length"]])


def test_placing_keeps_all_limits():
    rng = np.random.default_rng(2)
    tokens = rng.integers(1, 1500, 600)
    loss = (tokens * rng.random(600)).astype(int)
    bins = place(tokens, loss, (2048, 5, 900)) if (loss <= 900).all() else place(np.minimum(tokens, 900), np.minimum(loss, 900), (2048, 5, 900))
    assert sorted(i for b in bins for i in b) == list(range(600))
    for b in bins:
        assert tokens[b].clip(max=2048).sum() <= 2048 or len(b) == 1 or np.minimum(tokens, 900)[b].sum() <= 2048
        assert len(b) <= 5 and np.minimum(loss, 900)[b].sum() <= 900


@pytest.mark.parametrize("parts", [1, 60])
def test_packing_leaves_little_padding(spark, parts):
    rng = np.random.default_rng(4)
    rows = [(i, " ".join(["word"] * int(n))) for i, n in enumerate(rng.integers(1, 3000, 400))]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(parts)
    used = pack_documents(docs).groupBy("sequence_id").agg(F.sum("length").alias("n")).agg(F.sum("n"), F.count("*")).first()
    assert used[0] / (used[1] * 2048) > 0.98


def test_packing_of_nothing(spark):
    assert pack_documents(spark.createDataFrame([], "doc_id long, text string")).count() == 0


@pytest.mark.parametrize("segments, loss_limit", [(3, 2048), (256, 500), (4, 300)])
def test_packing_of_instruction_data_keeps_all_limits(spark, segments, loss_limit):
    """Formatted conversations with their masks, under limits on segments and on loss that bind."""
    rng = np.random.default_rng(6)
    rows = [(c, t, ["user", "assistant"][t % 2], " ".join(["word"] * int(rng.integers(0, 400)))) for c in range(80) for t in range(int(rng.integers(1, 6)))]
    examples = format_conversations(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).select(F.col("conv_id").alias("doc_id"), "ids", "loss", F.lit(1).alias("length"))
    want = {r["doc_id"]: (list(r["ids"]), bytes(r["loss"])) for r in examples.collect()}
    got = pack_examples(examples, 2048, segments, loss_limit).collect()
    held, whole = {}, {}
    for r in sorted(got, key=lambda r: r["offset"]):
        own = held.setdefault(r["sequence_id"], [0, 0, 0])
        assert own[0] == r["offset"] and sum(bytes(r["loss"])) == r["loss_tokens"]
        own[0], own[1], own[2] = own[0] + r["length"], own[1] + 1, own[2] + r["loss_tokens"]
        whole.setdefault(r["doc_id"], []).append((r["start"], bytes(r["ids"]), bytes(r["loss"])))
    tops = np.array(list(held.values())).max(axis=0)
    assert tops[0] <= 2048 and tops[1] <= segments and tops[2] <= loss_limit
    assert (tops[1] == segments and segments < 10) or tops[2] >= 0.95 * loss_limit  # the limit under test binds
    for doc, parts in whole.items():
        parts.sort()
        assert np.frombuffer(b"".join(p[1] for p in parts), "<u4").tolist() == want[doc][0] and b"".join(p[2] for p in parts) == want[doc][1]
    assert set(whole) == set(want)


def test_store_gives_back_every_document(spark, tokenizer):
    docs, rows = documents(spark)
    store = store_documents(docs)
    want = sorted(((-1 if i is None else i), tokenizer.whole(t or "") + struct.pack("<I", 2)) for i, t, *_ in rows)
    start, expected = 0, []
    for i, ids in sorted(want, key=lambda w: (w[0], len(w[1]))):
        expected.append((None if i < 0 else i, start, len(ids) // 4, zlib.crc32(ids)))
        start += len(ids) // 4
    got = [tuple(r) for r in store.digests().orderBy("start").collect()]
    assert got == expected
    ids = {r["start"]: np.asarray(r["ids"], "<u4").tobytes() for r in store.documents().collect()}
    assert {s: zlib.crc32(x) for s, x in ids.items()} == {e[1]: e[3] for e in expected}
    chunks = store.chunks()
    assert chunks.count() == chunks.select("digest").distinct().count()


def test_store_notices_damage(spark, tmp_path):
    docs = spark.createDataFrame([(1, "a b c"), (2, "d e f")], "doc_id long, text string")
    store = store_documents(docs, f"file://{tmp_path}/s")
    manifest = store.table("manifest").collect()
    spark.createDataFrame(manifest, store.table("manifest").schema).withColumn("root", F.lit(b"x")).write.parquet(f"file://{tmp_path}/t/manifest")
    for part in ("objects", "recipes"):
        (tmp_path / "t" / part).symlink_to(tmp_path / "s" / part)
    (tmp_path / "t" / "top").symlink_to(tmp_path / "s" / "top")
    with pytest.raises(Exception, match="differs from its (manifest|top)"):
        TokenStore(spark, f"file://{tmp_path}/t").digests().collect()


@pytest.mark.parametrize("table", ["recipes", "manifest"])
def test_store_notices_a_lost_file(spark, tmp_path, table):
    docs = spark.createDataFrame([(i, f"a b {i}") for i in range(400)], "doc_id long, text string").repartition(4)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        store = store_documents(docs, f"file://{tmp_path}/s")
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert store.digests().count() == 400
    files = sorted((tmp_path / "s" / table).glob("part-*.parquet"))
    files[len(files) // 2].unlink()
    with pytest.raises(Exception, match="differs from its (manifest|top)"):
        TokenStore(spark, f"file://{tmp_path}/s").digests().collect()


def test_store_of_nothing(spark):
    assert store_documents(spark.createDataFrame([], "doc_id long, text string")).digests().count() == 0


def test_cuts_follow_content():
    rng = np.random.default_rng(5)
    ids = rng.integers(0, 49_000, 60_000).astype(np.uint32)
    ends = cuts(ids)
    sizes = np.diff([0, *ends])
    assert ends[-1] == len(ids) and sizes.max() <= token_store.MOST and sizes[:-1].min() >= token_store.LEAST
    moved = set(np.asarray(cuts(np.concatenate([rng.integers(0, 9, 77).astype(np.uint32), ids]))) - 77)
    assert len(moved & set(ends)) > 0.8 * len(ends)


@given(st.binary(max_size=40), st.binary(max_size=40))
def test_crcs_join(a, b):
    assert crc32_joined(zlib.crc32(a), zlib.crc32(b), len(b)) == zlib.crc32(a + b)


@settings(deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "a|\\\nn"]), st.text(alphabet="<|\\im_end>start\n é", max_size=30)), max_size=4))
def test_rendering_reads_back(turns):
    text, spans = render(turns)
    assert parse(text) == turns
    assert [unescape(text[a:b]) for a, b, _ in spans] == [t for _, t in turns]
    assert all("<|" not in escape(t) for _, t in turns)


def test_mask_takes_whole_tokens_within_spans():
    starts, ends = np.array([0, 2, 4, 4, 7, 9]), np.array([2, 4, 7, 7, 9, 12])
    bears = mask([(2, 7), (9, 9), (9, 12)], starts, ends)
    assert bears.tolist() == [False, True, True, True, False, True] and covered(bears, starts, ends) == [(2, 7), (9, 12)]


def test_no_loss_token_reaches_out_of_its_text(spark):
    """Over all conversations: every character of an assistant's text is under the mask, and no token touches anything else."""
    rows = format_conversations(spark.read.parquet("/root/testdata/sf0.01/conversations.parquet")).collect()
    assert len(rows) >= 100
    for r in rows:
        inside = np.zeros(len(r["text"]), bool)
        at = 0
        for role, text in parse(r["text"]):
            _, spans = render([(role, text)])
            if role == "assistant":
                inside[at + spans[0][0] : at + spans[0][1]] = True
            at += len(render([(role, text)])[0])
        under = np.zeros(len(r["text"]), bool)
        for a, b, bears in zip(r["token_starts"], r["token_ends"], r["loss"], strict=True):
            if bears:
                under[a:b] = True
        assert (under == inside).all()


def test_conversations(spark):
    rows = [(1, 1, "assistant", "<|im_end|><|im_start|>assistant ok"), (1, 0, "user", None), (1, 2, "assistant", "\n\n é中\n"), (2, 0, "user", "x"), (3, None, None, "y"), (3, 5, "assistant", ""), (None, 0, "assistant", "<\\|"), (4, 0, "assistant", "a"), (4, 0, "assistant", "a"), (5, 0, "assistant", "long ü" * 30_000)]
    df = spark.createDataFrame([(*r, "c") for r in rows], "conv_id long, turn long, role string, text string, ids string")
    formatted = format_conversations(df)
    got = {r["conv_id"]: r for r in conversation_digests(formatted).collect()}
    groups = {}
    for c, t, role, text in sorted(rows, key=lambda r: (-1 if r[0] is None else r[0], -1 if r[1] is None else r[1])):
        groups.setdefault(c, []).append((role or "", text or ""))
    assert set(got) == set(groups)
    for c, turns in groups.items():
        loss = "".join(t for r, t in turns if r == "assistant")
        assert got[c]["n_turns"] == len(turns)
        assert got[c]["turns_sha256"] == hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest()
        assert (got[c]["loss_chars"], got[c]["loss_sha256"]) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
    row = formatted.where("conv_id = 2").first()
    assert not any(row["loss"]) and len(row["ids"]) == len(row["token_starts"]) == len(row["loss"])
    assert conversation_digests(format_conversations(df.limit(0))).count() == 0


def test_a_long_word_is_encoded_once_with_and_without_a_mark():
    tok = ChunkTokenizer("word_bpe_49k.json")
    asked, model = [], tok.model

    class Counted:
        def tokenize(self, piece):
            asked.append(piece)
            return model.tokenize(piece)

    tok.model = Counted()
    text = "Qwertyuiopas qwertyuiopas, qwertyuiopas. QWERTYUIOPAS; short short. a! b's x.y é, naïvetés. qwertyuiopas.. 1? ?"
    assert tok.encode([text.encode()]) == [tok.whole(text)]
    assert asked.count("qwertyuiopas") == 2  # once for the cache, once in a chunk of other marks


def test_words_beyond_ascii_are_encoded_without_splitting():
    tok = ChunkTokenizer("word_bpe_49k.json")
    split, asked = tok.split, []
    tok.split = lambda chunk: asked.append(chunk) or split(chunk)
    text = "Ñandúes canción, canción. CANCIÓN; ß é. Ångströmen! µ ªº été's naïve.. 1é ÿ² \u212bngström \u212a."
    assert tok.encode([text.encode()]) == [tok.whole(text)]
    assert asked == ["été's", "naïve..", "1é", "ÿ²"]


def test_cuts_of_streams_that_stand_together():
    rng = np.random.default_rng(5)
    run = rng.integers(0, 49_000, 9000).astype("<u4")
    streams = [run[:n] for n in (1, 300, 9000, 256, 257, 5, 9000)] + [np.full(9000, 7, "<u4"), run[:1], rng.integers(0, 9, 20_000).astype("<u4"), run[1:4000]]
    got = list(token_store.cuts_of_all(np.concatenate(streams), [len(x) for x in streams]))
    assert got == [cuts(x) for x in streams] and len(got[2]) > 5

"""Alignment of two tokenisers against both libraries and a plain count over all links."""

import hashlib
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from arborpay.llm import token_alignment
from arborpay.llm.token_alignment import Aligner, align_tokens, chunks_of

NAMES = ("byte_bpe_50k.tiktoken", "piece_bpe_32k.model")
ODD = [None, "", "a b c", "x|y | z", "İstanbul ΣΑΣ don't I'LL 's", "é a ́x", " foo\x1cbar\x85baz", "<|endoftext|> a<|ENDOFTEXT|>b </s> <s>", "12ab 3.4 ,,, ...", "中文 字。", "  two  spaces  ", "x\n  y \n z", "▁x y", "x▁", " ", "   ", "\n", "a\xa0 b", "　 x", "a\x00b", "x \t y", "<unk> <0x41>", "a ", "\U0001f600 \U0001f468‍\U0001f469‍\U0001f467"]


def libraries():
    """Both tokenisers as published: (ids, bytes) of a text under each."""
    import public_tokenizers
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(NAMES[1]))
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = {chr(x): x for x in own} | {chr(256 + i): x for i, x in enumerate(x for x in range(256) if x not in own)}

    def piece(i):
        return bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode()

    def encode(text):
        x, y = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
        return [(i, bytes(letters[c] for c in a.id_to_token(i))) for i in x], [(i, piece(i)) for i in y]

    return encode


def intervals(tokens):
    at, out = 0, []
    for i, raw in tokens:
        out.append((i, at, at + len(raw)))
        at += len(raw)
    return out


def plain(texts, encode=None):
    """(n_a, n_b, n_groups, n_links, n_best, count_sum, sha) of each text."""
    encode = encode or libraries()
    rows = []
    for text in texts:
        a, b = encode(text) if text else ([], [])
        raw = (" " + (text or "")).encode()
        if not text or b"".join(x for _, x in a) != raw or b"".join(x for _, x in b) != raw:
            rows.append(None)
            continue
        a, b = intervals(a), intervals(b)
        ends, groups, start = sorted({e for *_, e in a} & {e for *_, e in b}), [], 0
        for e in ends:
            groups.append("|".join(",".join(str(i) for i, s, t in side if start <= s < e) for side in (a, b)))
            start = e
        rows.append((len(a), len(b), groups, [(i, j) for i, s, e in a for j, u, v in b if s < v and u < e]))
    count = Counter(link for r in rows if r for link in r[3])
    most = {}
    for (_, j), n in count.items():
        most[j] = max(n, most.get(j, 0))
    out = []
    for r in rows:
        if r is None:
            out.append((0, 0, 0, 0, 0, 0, ""))
        else:
            sha = hashlib.sha256(";".join(r[2]).encode()).hexdigest()
            out.append((r[0], r[1], len(r[2]), len(r[3]), sum(count[x] == most[x[1]] for x in r[3]), sum(count[x] for x in r[3]), sha))
    return out


COLUMNS = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


@pytest.mark.parametrize("block", [4_000_000, 300])
def test_equal_to_the_libraries_and_a_plain_count(spark, monkeypatch, block):
    monkeypatch.setattr(token_alignment, "BLOCK", block)  # many blocks share their counts
    texts = [*ODD, *ODD[2:6], "the quick brown fox jumps over the lazy dog. " * 60, "x" * 5000, "word " * 40]
    rows = [(i if i % 5 else None, t, "clash", i) for i, t in enumerate(texts)]
    got = align_tokens(spark.createDataFrame(rows, "doc_id long, text string, n_links string, block int").repartition(3)).collect()
    want = plain(texts)
    assert sorted(((r["doc_id"], *(r[c] for c in COLUMNS)) for r in got), key=str) == sorted(((r[0], *w) for r, w in zip(rows, want, strict=True)), key=str)
    assert {w[0] for t, w in zip(texts, want, strict=True) if t and "▁" in t} == {0}


def test_no_rows(spark):
    assert align_tokens(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_chunks_give_the_text_back():
    for t in filter(None, ODD):
        assert "".join(chunks_of(t)) == " " + t


@settings(max_examples=80, deadline=None)
@given(st.text(alphabet=st.one_of(st.sampled_from("ab .'\n\t  ▁é1"), st.characters(exclude_categories=["Cs"])), min_size=1, max_size=40))
def test_any_text_is_aligned_as_by_the_libraries(text):
    held = test_any_text_is_aligned_as_by_the_libraries.__dict__
    own = held.setdefault("own", Aligner(*NAMES))
    encode = held.setdefault("encode", libraries())
    (numbers,) = own.documents([text])
    want = plain([text], encode)[0]
    if numbers is None:
        assert want[0] == 0
        return
    counts, first, pairs = own.tables()
    assert tuple(counts[numbers].sum(axis=0).tolist()) == want[:4]
    assert hashlib.sha256(";".join(own.texts[k] for k in numbers).encode()).hexdigest() == want[6]
    links = Counter(p for k in numbers for p in pairs[first[k] : first[k + 1]].tolist())
    assert sum(n * n for n in links.values()) == want[5]

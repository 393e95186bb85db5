import random
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from tierline.llm import words as W
from tierline.llm.packing import pack_documents, piece_lengths, write_buckets
from tierline.llm.token_counts import answer, quantile_length, token_counts
from tierline.llm.tokens import PieceEncoder, default_tokenizer

ODD = ["a 's b<|endoftext|>c <|startoftext|>x", "  x y z", "é ́x I'LL they're ΑΣ Σ", "\x1c\x1d a\x85b", "", "   ",
       "x" * 5000, "日本語 テスト 123", "a\x00b", "ÀÉÞß×÷ÿŸ ¡ª²", "Abc,def;12ab%%%", "º1ªb", "ÁB É", "×x", "café É́",
       "a\xa0b c", "Ã\x83 Ã", "don't DON'T 'tis", "<| <|x|>", "naïve coöperate"]


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(default_tokenizer())


def encode(encoder, texts):
    raw = [t.encode() for t in texts]
    ids, at = encoder.encode(np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0] + [len(t) for t in raw]))
    return [ids[a:b].tolist() for a, b in zip(at, at[1:])]


def test_ids_are_the_tokenizers(tokenizer, monkeypatch):
    encoder = PieceEncoder(default_tokenizer())
    assert encode(encoder, ODD) == [tokenizer.encode(t, add_special_tokens=False).ids for t in ODD]
    rng = random.Random(9)
    letters = "aAzZ019 \n\t'<|>.,%éÉßÿŸ÷×ªσΣ́日\x00\x7f\xa0"
    for block in (5, 16, 1 << 20):
        monkeypatch.setattr(W, "BLOCK", block)
        W._powers.cache_clear()
        for _ in range(60):
            texts = ["".join(rng.choice(letters) for _ in range(rng.randrange(40))) for _ in range(rng.randrange(1, 6))]
            assert encode(encoder, texts) == [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
    W._powers.cache_clear()


def test_a_full_memory_starts_again(tokenizer, monkeypatch):
    monkeypatch.setattr("tierline.llm.tokens.KEPT_UNITS", 5)
    encoder = PieceEncoder(default_tokenizer())
    for n in range(6):
        texts = [f"some words {n} and more {n * 7}x", "the same again"]
        assert encode(encoder, texts) == [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]


def test_piece_lengths():
    for n in range(1, 9000, 7):
        cut = piece_lengths(n)
        assert sum(cut) == n and all(c & (c - 1) == 0 and c <= 2048 for c in cut)
        assert len([c for c in cut if c < 2048]) == bin(n % 2048).count("1")
    assert piece_lengths(0) == []


def test_packing_round_trip(spark, docs_of, with_clashes, tokenizer, tmp_path):
    rows = list(enumerate(ODD)) + [(100, None), (None, "no id"), (101, "word " * 5000), (101, "again"), (101, "again")]
    packed = pack_documents(with_clashes(docs_of(rows)))
    out = packed.collect()
    assert len({r.sequence_id for r in out}) == len(out) and {r.offset for r in out} == {0}
    docs = {}
    for r in out:
        ids = np.frombuffer(r.token_bytes, "<u4")
        assert len(ids) == r.length == 1 << r.bucket <= 2048 and zlib.crc32(r.token_bytes) == r.ids_crc32
        docs.setdefault((r.doc_id, r.doc_tokens), []).append((r.start, ids.tolist()))
    want = {i: tokenizer.encode(t or "", add_special_tokens=False).ids + [1] for i, t in rows if i != 101}
    for i, ids in want.items():
        pieces = sorted(docs[i, len(ids)])
        assert [x for _, p in pieces for x in p] == ids
        assert [s for s, _ in pieces] == np.cumsum([0] + [len(p) for _, p in pieces])[:-1].tolist()
    assert sum(r.length for r in out) == sum(map(len, want.values())) + sum(
        len(tokenizer.encode(t, add_special_tokens=False).ids) + 1 for i, t in rows if i == 101)
    assert pack_documents(docs_of([])).collect() == []
    write_buckets(packed, str(tmp_path / "packed"))
    assert spark.read.parquet(str(tmp_path / "packed")).count() == len(out)


def test_limit_table_against_counting(spark, tokenizer):
    rng = random.Random(4)
    rows = [(rng.choice(["en", "de", None]), " ".join(rng.choice(["the", "cat", "x1"]) for _ in range(rng.randrange(300))))
            for _ in range(150)] + [("en", None), ("en", ""), ("fr", "w " * 3000)]
    df = spark.createDataFrame(rows, "lang string, text string")
    limits = token_counts(spark, df)
    lengths = {"*": []}
    for g, t in rows:
        n = len(tokenizer.encode(t or "", add_special_tokens=False).ids)
        lengths.setdefault(g, []).append(n)
        lengths["*"].append(n)
    seen = {}
    for r in limits.collect():
        have = lengths[r.grp]
        seen.setdefault(r.grp, set()).add(r.length)
        assert (r.docs, r.docs_longer, r.docs_total) == (have.count(r.length), sum(n > r.length for n in have), len(have))
        assert (r.tokens_total, r.tokens_longer) == (sum(have), sum(n for n in have if n > r.length))
        assert r.truncated_total == sum(min(n, r.length) for n in have)
        assert abs(r.quantile - sum(n <= r.length for n in have) / len(have)) < 1e-12
    assert seen == {g: set(v) for g, v in lengths.items()}
    for limit in (0, 1, 77, 128, 512, 10 ** 6):
        for r in answer(limits, limit).collect():
            assert r.truncated_total == sum(min(n, limit) for n in lengths[r.grp])
    for r in quantile_length(limits, 0.5).collect():
        have = sorted(lengths[r.grp])
        assert r.length == have[-(-len(have) // 2) - 1]


def test_token_counts_of_an_empty_table(spark):
    assert token_counts(spark, spark.createDataFrame([], "lang string, text string")).collect() == []

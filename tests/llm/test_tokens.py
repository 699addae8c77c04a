import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tests.llm.helpers import empty_docs, odd_docs, odd_rows
from tidewire.llm import packing, token_counts
from tidewire.llm.encoders import TokenCounter, WordEncoder, open_tokenizer

FOLDER = "/root/testdata/sf0.01"
COUNTER, BYTES = TokenCounter(token_counts.BYTE_BPE), open_tokenizer(token_counts.BYTE_BPE)
ENCODER, WORDS = WordEncoder(packing.WORD_BPE), open_tokenizer(packing.WORD_BPE)
ODD = [
    "", "  ", "a<|endoftext|>b", "<|EndOfText|> <|startoftext|>", "É é́ İstanbul ſ ẞ", "漢字 かな 12³", "a\x1cb\x85c\xa0d",
    "don't I'll WE'RE x's", "_a_ 1a2 ½", "x" * 3000, "\n\n\n   \t a", "😀 hi😀", "ÿ þÿ", "a\x00b", "e ́a",
]


def same(text):
    assert COUNTER.count(text) == len(BYTES.encode(text, add_special_tokens=False).ids)
    assert ENCODER.encode(text).tolist() == WORDS.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("text", ODD)
def test_encoders_equal_the_library(text):
    same(text)


@settings(max_examples=150, deadline=None)
@given(st.text(st.characters(exclude_categories=["Cs"]), max_size=40))
def test_encoders_equal_the_library_on_any_text(text):
    same(text)


def test_long_white_space_is_counted():
    text = "a" + " " * 1_100_000 + "b"
    assert COUNTER.count(text) == len(BYTES.encode(text, add_special_tokens=False).ids)


def test_forgetting_changes_nothing():
    small = WordEncoder(packing.WORD_BPE, limit=5)
    for text in ("one two three four five six", "six seven eight nine", "one two") * 2:
        assert small.encode(text).tolist() == ENCODER.encode(text).tolist()


def test_counts_equal_the_library(spark, tmp_path):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    for r in token_counts.count_tokens(docs, str(tmp_path / "cache")).collect():
        n = len(BYTES.encode(texts[r.doc_id], add_special_tokens=False).ids)
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len(texts[r.doc_id].encode()), n, n > 1024)


def test_cache_is_used_and_grows(spark, tmp_path):
    cache = str(tmp_path / "cache")
    docs = odd_docs(spark, "digest", "n_tokens")
    first = sorted(map(str, token_counts.count_tokens(docs, cache).collect()))
    assert len(first) == len(odd_rows())
    stored = spark.read.parquet(cache).count()
    assert stored == len({t or "" for _, t, *_ in odd_rows()})
    key = token_counts.tokenizer_version(token_counts.BYTE_BPE)
    assert sorted(map(str, token_counts.count_tokens(docs, cache).collect())) == first
    assert spark.read.parquet(cache).count() == stored
    more = docs.limit(1).selectExpr("42L AS doc_id", "'quite new' AS text")
    assert token_counts.count_tokens(more, cache).first().n_tokens == 2
    assert token_counts.read_cache(spark, cache, key).count() == stored + 1
    assert token_counts.read_cache(spark, cache, "other tokenizer").count() == 0
    assert token_counts.count_tokens(empty_docs(spark), cache).count() == 0


def check_packing(rows, texts, size=packing.SIZE):
    """Every id once, right checksums, sequences without gaps; returns the share of padding."""
    docs, places = {}, {}
    for r in rows:
        docs.setdefault(r.doc_id, []).append(r)
        places.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for doc_id, found in docs.items():
        if doc_id in texts:
            ids = np.append(ENCODER.encode(texts[doc_id] or ""), 1).astype("<u4")
            at = 0
            for r in sorted(found, key=lambda r: r.start):
                assert (r.start, r.doc_tokens) == (at, len(ids))
                assert r.ids_crc32 == zlib.crc32(ids[at : at + r.length].tobytes())
                at += r.length
            assert at == len(ids)
    for parts in places.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= size
    return 1 - sum(r.length for r in rows) / (size * len(places)) if places else 0


def test_packing_keeps_every_id(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    rows = packing.pack(packing.pieces(docs)).collect()
    texts = {r.doc_id: r.text for r in docs.collect()}
    assert {r.doc_id for r in rows} == set(texts)
    assert check_packing(rows, texts) < 0.02


def test_packing_odd_rows_and_sequences(spark):
    docs = odd_docs(spark, "length", "rank", "bucket", "sequence_id")
    packed = packing.pack(packing.pieces(docs, size=64, with_ids=True), 64).cache()
    rows = packed.collect()
    texts = {d: t for d, t, *_ in odd_rows() if d not in (None, 3)}
    check_packing(rows, texts, 64)
    assert sum(r.start == 0 for r in rows) == len(odd_rows())
    made = {r.sequence_id: r.ids for r in packing.sequences(packed, 64).collect()}
    for r in rows:
        assert made[r.sequence_id][r.offset : r.offset + r.length] == r.ids
    assert all(len(ids) == 64 or len(ids) & (len(ids) - 1) == 0 for ids in made.values())
    assert packing.pack(packing.pieces(empty_docs(spark))).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(1, 32), st.integers(1, 40), max_size=12))
def test_histogram_packing(histogram):
    size = 32
    placed, fill = dict.fromkeys(histogram, 0), {}
    for p in packing.pack_histogram(histogram, size):
        assert p.rank == placed[p.length]
        placed[p.length] += p.count
        for s in range(p.sequence, p.sequence + p.count):
            assert fill.get(s, 0) == p.offset
            fill[s] = p.offset + p.length
    assert placed == histogram and all(f <= size for f in fill.values())
    assert sorted(fill) == list(range(len(fill)))


def test_ranks_are_whole_for_hot_lengths(spark, monkeypatch):
    monkeypatch.setattr(packing, "RANK_ROWS", 100)
    parts = spark.range(1500).selectExpr(
        "id AS doc_id", "0L AS start", "if(id % 3 = 0, id % 7, 5) AS length", "1L AS ids_crc32", "5L AS doc_tokens"
    )
    counts = {r["length"]: r["count"] for r in parts.groupBy("length").count().collect()}
    seen = {}
    for r in packing.ranked(parts, counts).collect():
        seen.setdefault(r.length, []).append(r["rank"])
    assert all(sorted(v) == list(range(counts[k])) for k, v in seen.items())

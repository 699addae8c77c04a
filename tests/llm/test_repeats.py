import hashlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from __spark_entry__ import queries
from tests.llm.helpers import DOCS, empty_docs, odd_docs, odd_rows
from tidewire.llm import repeats, suffixes

FOLDER = "/root/testdata/sf0.01"


def brute(rows, length=100):
    """By definition: every string of each document, in the order of documents. Rows are (doc_id, text)."""
    texts = {(i, t or "") for i, t in rows}
    tie = {}
    for i, t in texts:
        tie[i, t] = t
    seen, out = set(), {}
    by_id = defaultdict(list)
    for i, t in texts:
        by_id[i].append(t)
    assert all(len(v) == 1 for v in by_id.values()), "the order of documents with one id is a hash's"
    for i in sorted(by_id, key=lambda x: (x is None, x)):
        data = by_id[i][0].encode()
        gone = np.zeros(len(data) + 1, np.int32)
        for k in range(len(data) - length + 1):
            string = data[k : k + length]
            digest = hashlib.blake2b(string, digest_size=12).digest()
            if digest in seen:
                gone[k] += 1
                gone[k + length] -= 1
            seen.add(digest)
        mask = np.cumsum(gone)[:-1] > 0
        kept = np.frombuffer(data, np.uint8)[~mask].tobytes()
        runs = int((np.diff(np.append(0, mask.astype(int))) == 1).sum())
        out[i] = (len(data), int(mask.sum()), runs, hashlib.sha256(kept).hexdigest())
    return out


def results(df):
    out = {}
    for r in df.select("doc_id", "text", "removed", "kept").collect():
        data = r.text.encode()
        cut, at = b"", 0
        for piece in r.removed:
            assert piece.start > at or not cut and piece.start >= at
            cut, at = cut + data[at : piece.start], piece.start + piece.length
        assert cut + data[at:] == bytes(r.kept)
        got = (len(data), sum(p.length for p in r.removed), len(r.removed), hashlib.sha256(bytes(r.kept)).hexdigest())
        assert out.setdefault(r.doc_id, got) == got
    return out


def test_query_equals_brute_force(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    expected = brute([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()])
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in queries()["op11_repeated_passages"](spark, FOLDER).collect()}
    assert got == expected and sum(v[1] for v in got.values()) > 0


def made_up(seed, n=120):
    """Texts with copies, shared passages at all offsets, periods, and runs of one character."""
    rng = np.random.default_rng(seed)
    word = lambda: "".join(map(chr, rng.integers(97, 123, rng.integers(2, 9))))
    prose = lambda k: " ".join(word() for _ in range(k))
    passages = [prose(40) for _ in range(4)]
    rows = []
    for i in range(n):
        kind = i % 8
        if kind == 0 and rows:
            text = rows[rng.integers(len(rows))][1]
        elif kind == 1:
            text = ("ab" * 300)[: rng.integers(50, 500)] + prose(5)
        elif kind == 2:
            text = "x" * int(rng.integers(90, 400))
        else:
            p = passages[rng.integers(4)]
            a = int(rng.integers(0, 60))
            text = prose(rng.integers(0, 30)) + p[a : a + int(rng.integers(80, 200))] + "é漢" * int(rng.integers(0, 3)) + prose(rng.integers(0, 30))
        rows.append((i, text, "en", "s", 1))
    rows.append((n, rows[3][1] + rows[3][1] + "\x00" * 250, "en", "s", 1))
    return rows


@pytest.mark.parametrize(("seed", "options"), [
    (0, {}),
    # Slices cut texts, tasks hand over few anchors, shards are many, and the sort is done on disk.
    (1, {"slice_bytes": 300, "held": 50, "shard_bytes": 4000, "memory": 64}),
    # Every anchor counts as one with very many contexts.
    (2, {"contexts": 0, "held": 200, "shard_bytes": 2000}),
    (3, {"length": 40, "gram": 12}),
])
def test_equals_brute_force(spark, seed, options, monkeypatch):
    rows = made_up(seed)
    config = repeats.RepeatConfig(**options)
    docs = spark.createDataFrame(rows, DOCS).repartition(5)
    assert results(repeats.remove_repeats(docs, config)) == brute([r[:2] for r in rows], config.length)


def test_odd_rows(spark):
    clash = ("id", "h", "row", "kind", "place", "removed", "kept", "gone", "bytes", "wanted")
    got = repeats.remove_repeats(odd_docs(spark, *clash))
    assert set(got.columns) == {"doc_id", "text", "lang", "source", "n_chars", *clash}
    rows = got.collect()
    assert len(rows) == len(odd_rows())
    by_text = defaultdict(list)
    for r in rows:
        by_text[r.doc_id, r.text].append(r)
    text = odd_rows()[2][1]
    # Id 3, twice, comes first; it is one document. Id 6 and the document without an id repeat it.
    assert [r.removed for r in by_text[3, text]] == [[], []]
    assert [tuple(p) for p in by_text[None, text][0].removed] == [(0, len(text))]
    assert [tuple(p) for p in by_text[6, text + " more"][0].removed] == [(0, len(text))]
    assert all(r.removed == [] for r in rows if r.doc_id in (1, 2, 4, 5, 7)) and by_text[1, ""]
    assert repeats.remove_repeats(empty_docs(spark)).collect() == []


def test_hot_group_of_copies(spark):
    rng = np.random.default_rng(5)
    common = " ".join(str(x) for x in rng.integers(10**6, 10**7, 60))
    rows = [(i, common if i % 3 == 0 else f"{rng.integers(10**12)} {common[:150]} {rng.integers(10**12)} {i}", "en", "s", 1) for i in range(600)]
    docs = spark.createDataFrame(rows, DOCS).repartition(16)
    assert results(repeats.remove_repeats(docs, repeats.RepeatConfig(contexts=20))) == brute([r[:2] for r in rows])


@pytest.mark.parametrize(("seed", "options"), [
    (4, {"contexts": 3, "share": 1}),
    # All spans are split down to single strings; blocks of keys are cut between batches.
    (5, {"contexts": 0, "share": 1, "slice_bytes": 300, "held": 50, "shard_bytes": 4000, "memory": 64}),
    (6, {"contexts": 10, "share": 2, "length": 40, "gram": 12}),
])
def test_split_spans_equal_brute_force(spark, seed, options):
    rows = made_up(seed)
    config = repeats.RepeatConfig(**options)
    docs = spark.createDataFrame(rows, DOCS).repartition(5)
    assert len(repeats.hot_keys(repeats.keyed(docs), config))
    assert results(repeats.remove_repeats(docs, config)) == brute([r[:2] for r in rows], config.length)


def test_a_common_line_is_not_searched_string_by_string(spark, monkeypatch):
    """The bytes that are sorted follow the spans at the line's ends, not all strings that overlap it."""
    rng = np.random.default_rng(8)
    word = lambda: "".join(map(chr, rng.integers(97, 123, 7)))
    prose = lambda k: " ".join(word() for _ in range(k))
    line = prose(18)
    rows = [(i, f"{prose(30)}\n{line}\n{prose(30)}", "en", "s", 1) for i in range(1200)]
    docs = spark.createDataFrame(rows, DOCS).repartition(16)
    searched, search = [], repeats.search
    monkeypatch.setattr(repeats, "search", lambda cut, config: (searched.append(cut), search(cut, config))[1])
    assert results(repeats.remove_repeats(docs, repeats.RepeatConfig(contexts=100))) == brute([r[:2] for r in rows])
    assert 0 < searched[0].agg(F.sum(F.octet_length("bytes"))).first()[0] < 1000 * len(rows)


def test_a_common_anchor_alone_is_not_searched(spark, monkeypatch):
    """Texts that share less than a string share no core and are left out."""
    rng = np.random.default_rng(9)
    word = lambda: "".join(map(chr, rng.integers(97, 123, 7)))
    line = " ".join(word() for _ in range(6))
    rows = [(i, " ".join([*(word() for _ in range(20)), line, *(word() for _ in range(20))]), "en", "s", 1) for i in range(50)]
    rows.append((50, rows[0][1][:300], "en", "s", 1))
    docs = spark.createDataFrame(rows, DOCS).repartition(4)
    searched, search = [], repeats.search
    monkeypatch.setattr(repeats, "search", lambda cut, config: (searched.append(cut), search(cut, config))[1])
    assert results(repeats.remove_repeats(docs)) == brute([r[:2] for r in rows])
    assert 0 <= (searched[0].agg(F.sum(F.octet_length("bytes"))).first()[0] or 0) < 1000


def test_parts_hold_every_string_once_and_equal_ones_under_one_key():
    rng = np.random.default_rng(3)
    config = repeats.RepeatConfig()
    passage = rng.integers(97, 123, 160).astype(np.uint8)
    texts = [np.concatenate([rng.integers(97, 123, rng.integers(0, 200)).astype(np.uint8), passage[a:], np.frombuffer(b"ab" * 70, np.uint8)]) for a in rng.integers(0, 40, 30)]
    texts.append(passage[:99])
    data, ends = np.concatenate(texts), np.cumsum([len(t) for t in texts])
    hashes = repeats.Hashes(len(data))
    hot, sizes = np.zeros(0, np.uint64), []
    for _ in range(6):
        found = repeats.spans(data, ends, hashes, config, hot)
        keys, covered = {}, []
        for begin, count, key in zip(found.begin, found.count, found.key, strict=True):
            for i in range(begin, begin + count):
                assert keys.setdefault(data[i : i + config.length].tobytes(), key) == key
                covered.append(i)
        starts = np.append(0, ends[:-1])
        assert sorted(covered) == [i for a, b in zip(starts, ends, strict=True) for i in range(a, b - config.length + 1)]
        sizes.append(int((found.high - found.low).max()))
        # Every other key is hot, and in the end all of them.
        hot = np.union1d(hot, found.key if len(sizes) > 1 else found.key[::2])
    assert sizes[0] == 77 and sizes[-1] == 1


def test_texts_are_shuffled_once(spark):
    plan = repeats.remove_repeats(spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text"))
    text = plan._jdf.queryExecution().toString()
    assert "CartesianProduct" not in text and "BroadcastNestedLoop" not in text


# ---- suffixes -------------------------------------------------------------------------------------


def text_of(data, cap):
    padded = suffixes.scratch(len(data) + 1 + cap, np.uint16)
    padded[: len(data)] = np.frombuffer(data, np.uint8).astype(np.uint16) + 2
    return suffixes.Text(padded, len(data) + 1, 9, 258)


@pytest.mark.parametrize("block", [7, 64, 1 << 16])
@pytest.mark.parametrize("memory", [16, 100, 1 << 20])
def test_suffixes_equal_plain_sorting(block, memory, monkeypatch):
    monkeypatch.setattr(suffixes, "BLOCK", block)
    rng, cap = np.random.default_rng(block * memory % 1009), 20
    for trial in range(25):
        data = rng.integers(0, rng.integers(1, 5), rng.integers(0, 400)).astype(np.uint8).tobytes()
        if trial % 5 == 0:
            data = data + data[: len(data) // 2] + b"\xff" * int(rng.integers(0, 50))
        pos, lcp = [], []
        for p, c in suffixes.descending(text_of(data, cap), memory, cap):
            pos += p.tolist()
            lcp += c.tolist()
        assert pos == sorted(range(len(data)), key=lambda i: data[i:], reverse=True)
        for (a, b), c in zip(zip(pos, pos[1:], strict=False), lcp[1:], strict=True):
            shared = 0
            while shared < min(cap, len(data) - max(a, b)) and data[a + shared] == data[b + shared]:
                shared += 1
            assert c == shared


def test_sorted_runs_are_merged():
    rng = np.random.default_rng(1)
    a, b = rng.integers(0, 9, 5000), rng.integers(0, 9, 5000)
    blocks = ((a[i : i + 100], b[i : i + 100], np.arange(i, i + 100)) for i in range(0, 5000, 100))
    out = [np.concatenate(c) for c in zip(*suffixes.ordered(blocks, 2, 300), strict=True)]
    by = np.lexsort((b, a))
    assert (out[0] == a[by]).all() and (out[1] == b[by]).all() and set(out[2]) == set(range(5000))

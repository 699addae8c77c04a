import collections
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from sentencepiece import SentencePieceProcessor

from tests.llm.helpers import empty_docs, odd_docs, odd_rows
from tidewire.llm import queries
from tidewire.llm import segmentation as sg

PATH = sg.DEFAULT.path
MODEL = sg.PieceModel(PATH, 1.0)


def lattice_of(text):
    cut = sg.chunks_of(text)
    known = {c: i for i, c in enumerate(dict.fromkeys(cut))}
    return sg.Lattice(list(known), MODEL), np.array([known[c] for c in cut])


def brute(text):
    """Probability of every segmentation, by enumeration."""
    marked = f"{sg.MARK}{text}".replace(" ", sg.MARK)
    ids = {p: i for i, p in enumerate(MODEL.pieces) if i > 258}
    out = {}

    def go(at, sizes, weight):
        if at == len(marked):
            out[tuple(sizes)] = weight
            return
        fits = [n for n in range(1, 17) if at + n <= len(marked) and marked[at : at + n] in ids]
        for n in fits:
            go(at + n, [*sizes, n], weight + MODEL.weight[ids[marked[at : at + n]]])
        if 1 not in fits:
            go(at + 1, [*sizes, 1], weight + len(marked[at].encode()) * MODEL.byte_weight)

    go(0, [], 0.0)
    total = np.logaddexp.reduce(list(out.values()))
    return {s: float(np.exp(w - total)) for s, w in out.items()}


def test_samples_are_drawn_without_replacement_in_proportion():
    text, n = "an it\nx", 6000
    exact = brute(text)
    lattice, chunks = lattice_of(text)
    keys = np.array([xxhash.xxh3_64_intdigest(f"t {i}") for i in range(n)], np.uint64)
    got = collections.defaultdict(list)
    for i, _, path, value, _ in sg.search(lattice, [chunks] * n, keys, 3):
        got[i].append((tuple(path.length.tolist()), value, path.log_prob))
    counts = [collections.Counter(rows[k][0] for rows in got.values()) for k in range(2)]
    for rows in got.values():
        assert len({r[0] for r in rows}) == 3 and rows[0][1] >= rows[1][1] >= rows[2][1]
        assert all(abs(np.exp(r[2]) - exact[r[0]]) < 1e-9 for r in rows)
    for s, p in exact.items():
        second = sum(exact[a] * p / (1 - exact[a]) for a in exact if a != s)
        assert abs(counts[0][s] / n - p) < 0.02 and abs(counts[1][s] / n - second) < 0.02


@pytest.mark.parametrize("text", ["a", "in a", "the"])
def test_a_text_gives_all_its_segmentations_once(text):
    exact = {s: p for s, p in brute(text).items()}
    lattice, chunks = lattice_of(text)
    rows = list(sg.search(lattice, [chunks], np.array([5], np.uint64), len(exact) + 3))
    found = {tuple(r[2].length.tolist()) for r in rows}
    assert found <= set(exact) and len(found) == len(rows) and sum(exact[s] for s in found) > 1 - 1e-9
    assert rows[-1][4] == 0.0


def test_logarithms_agree_with_odds(monkeypatch):
    text = "hello wonderful people"
    plain, _ = lattice_of(text)
    monkeypatch.setattr(sg, "UNDERFLOW", 0)
    logs, _ = lattice_of(text)
    assert np.allclose(plain.probability, logs.probability)
    monkeypatch.undo()
    long, _ = lattice_of("abc" * 400)
    assert np.allclose(long.probability[:-1].sum(axis=1), 1)


def test_odd_rows_and_round_trip(spark):
    docs = odd_docs(spark, "rank", "ids")
    rows = sg.sample(docs, sg.SegmentConfig(k=3)).collect()
    library = SentencePieceProcessor(model_file=PATH)
    texts = collections.defaultdict(set)
    for d, t, *_ in odd_rows():
        texts[d].add(t or "")
    assert all(r.round_trip for r in rows) and {r.n_pieces for r in rows if r.doc_id in (1, 2)} == {0}
    for r in rows:
        assert library.decode(r.ids) in texts[r.doc_id] and len(r.ids) == r.n_pieces
    assert sum(r.doc_id == 5 for r in rows) == 3 and sum(r.doc_id == 3 for r in rows) == 6
    assert len({(r["rank"], r.ids_crc32) for r in rows if r.doc_id == 3}) == 3
    again = sg.sample(docs.repartition(3), sg.SegmentConfig(k=3)).collect()
    assert sorted(map(str, again)) == sorted(map(str, rows))
    assert sg.sample(empty_docs(spark)).count() == 0


def test_query_returns_the_encoding(spark):
    rows = queries.op6_sentencepiece(spark, "/root/testdata/sf0.001").where("doc_id < 20").collect()
    for r in rows:
        assert len(r.ids) == r.n_pieces and zlib.crc32(np.array(r.ids, "<u4").tobytes()) == r.ids_crc32


def test_texts_are_searched_side_by_side(monkeypatch):
    """Drawing takes as many array operations for many texts as for one, and gives each text what it gets alone."""
    texts = ["hello wonderful people", "in a", "  spaces  in\nbetween ", "\u4e2d\u6587 text"] * 10
    cut = [sg.chunks_of(t) for t in texts]
    known = {c: i for i, c in enumerate(dict.fromkeys(c for cs in cut for c in cs))}
    lattice, keys = sg.Lattice(list(known), MODEL), np.arange(len(texts), dtype=np.uint64)
    occurrences = [np.array([known[c] for c in cs]) for cs in cut]
    calls, uniform = [], sg.uniform
    monkeypatch.setattr(sg, "uniform", lambda *a: calls.append(1) or uniform(*a))
    together = list(sg.search(lattice, occurrences, keys, 2))
    assert len(calls) < len(texts)
    alone = [(i, *row[1:]) for i in range(len(texts)) for row in sg.search(lattice, occurrences[i : i + 1], keys[i : i + 1], 2)]
    plain = lambda rows: [(i, r, p.slot.tolist(), p.length.tolist(), p.log_prob, v, x) for i, r, p, v, x in rows]
    assert plain(together) == plain(alone)


def test_chunks_of_texts_side_by_side():
    texts = ["a", " ", "  b  c", f"{sg.MARK}x {sg.MARK}", "end ", " next", "\u00e2\u2580\u2581\u4e2d \U0001f600\n"]
    chunks, n_chunks = sg.chunked(sg.marked(pa.array(["skipped", *texts], pa.large_string()).slice(1)))
    plain = [re.findall(f"{sg.MARK}+[^{sg.MARK}]*", f"{sg.MARK}{t}".replace(" ", sg.MARK)) for t in texts]
    assert chunks.to_pylist() == sum(plain, []) and n_chunks.tolist() == [len(cs) for cs in plain]

import random

import numpy as np
from pyspark.sql import functions as F

from tests.llm.helpers import DOCS, empty_docs, odd_docs, odd_rows
from tidewire.llm import minhash as mh
from tidewire.llm.components import components

FOLDER = "/root/testdata/sf0.01"


def shingle_set(text):
    words = text.split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))}


def brute_classes(texts, threshold=0.8):
    """Classes by the plain similarity of all pairs."""
    sets = {i: shingle_set(t) for i, t in texts.items() if t and t.split()}
    parent = {i: i for i in texts}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[:n]:
            small, large = sorted((len(sets[a]), len(sets[b])))
            if small >= threshold * large:
                shared = len(sets[a] & sets[b])
                if shared >= threshold * (small + large - shared):
                    parent[find(a)] = find(b)
    groups = {}
    for i in texts:
        groups.setdefault(find(i), set()).add(i)
    return {frozenset(g) for g in groups.values()}


def classes(rows):
    got = {}
    for r in rows:
        got.setdefault(r.class_id, set()).add(r.doc_id)
    return {frozenset(g) for g in got.values()}


def test_equals_brute_force(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    rows = mh.near_duplicates(docs).collect()
    texts = {r.doc_id: r.text for r in docs.collect()}
    assert classes(rows) == brute_classes(texts)
    assert all(r.class_id == min(c) and r.class_size == len(c) for c in classes(rows) for r in rows if r.doc_id in c)


def mutated(words, rng, n):
    words = list(words)
    for at in rng.sample(range(0, len(words), 10), n):
        words[at] = f"new{rng.random()}"
    return " ".join(words)


def test_copies_of_a_text_that_only_it_ties_together(spark):
    """Copies are similar to the original, hardly ever to each other, and a shared passage ties nothing."""
    rng = random.Random(3)
    words = [f"w{i}" for i in range(300)]
    passage = " ".join(f"p{i}" for i in range(60))
    rows = [(i, mutated(words, rng, 6), "en", "s", 1) for i in range(150)]
    rows.append((150, " ".join(words), "en", "s", 1))
    rows += [(i, " ".join(f"d{i}x{k}" for k in range(150)) + " " + passage, "en", "s", 1) for i in range(200, 260)]
    got = classes(mh.near_duplicates(spark.createDataFrame(rows, DOCS)).collect())
    assert frozenset(range(151)) in got and len(got) == 61


def test_odd_rows(spark):
    docs = odd_docs(spark, "node", "__doc", "bands")
    rows = mh.near_duplicates(docs).collect()
    assert len(rows) == len(odd_rows())
    sizes = sorted((r.class_id is None, r.class_id or 0, r.class_size) for r in rows)
    assert sizes.count((False, 3, 4)) == 4  # the equal rows, the one without id and its extension
    kept = mh.keep_first(docs.drop("__doc"))
    assert kept.columns == docs.drop("__doc").columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == ["1", "2", "3", "4", "5", "7", "None"]
    assert mh.near_duplicates(empty_docs(spark)).count() == mh.keep_first(empty_docs(spark)).count() == 0


def test_samples_agree_as_often_as_texts_are_similar():
    rng = np.random.default_rng(5)
    keys = np.sort(rng.integers(0, 2**63, 1400, dtype=np.uint64))
    weights = rng.uniform(0.5, 4, 1400).astype(np.float32)
    a, b = (keys[:1200], weights[:1200]), (keys[200:], weights[200:])
    sampler = mh.Sampler(4000, 1)
    one = sampler.sample(np.concatenate([a[0], b[0]]), np.concatenate([a[1], b[1]]), np.array([0, 1200]))
    shared = weights[200:1200].sum()
    expected = shared / (weights.sum())
    assert abs((one[0] == one[1]).mean() - expected) < 0.03


def test_long_texts_without_a_common_shingle_do_not_agree():
    """300,000 shingles fill all slots of the tables several times."""
    rng = np.random.default_rng(6)
    sampler = mh.Sampler(200, 1)
    for n in (1_000, 300_000):
        keys = rng.permutation(np.unique(rng.integers(0, 2**63, 2 * n + 100, dtype=np.uint64)))[: 2 * n]
        a, b = np.sort(keys[:n]), np.sort(keys[n:])
        weights = rng.uniform(0.5, 4, 2 * n).astype(np.float32)
        one = sampler.sample(np.concatenate([a, b]), weights, np.array([0, n]))
        assert (one[0] == one[1]).mean() < 0.01
        # Nine tenths in common: as often equal as similar.
        mixed = np.sort(np.concatenate([a[: 9 * n // 10], b[: n // 10]]))
        flat = np.ones(2 * n, np.float32)
        two = sampler.sample(np.concatenate([a, mixed]), flat, np.array([0, n]))
        assert abs((two[0] == two[1]).mean() - 0.9 / 1.1) < 0.12


def test_components(spark):
    rng = random.Random(1)
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, i) for i in range(101, 160)] + [(5, 5)]
    rng.shuffle(edges)
    frame = spark.createDataFrame(edges, "u bigint, v bigint")
    got = {r.node: r.component for r in components(frame).collect()}
    assert got == {i: 0 for i in range(41)} | {i: 100 for i in range(100, 160)}
    more = spark.createDataFrame([(40, 130), (500, 501)], "u bigint, v bigint")
    got = {r.node: r.component for r in components(more, components(frame)).collect()}
    assert {v for k, v in got.items() if k < 200} == {0} and (got[500], got[501]) == (500, 500)
    assert components(frame.where(F.lit(False))).count() == 0

import re
from collections import Counter, defaultdict

import numpy as np
from pyspark.sql import functions as F

from tests.llm.helpers import DOCS, empty_docs, odd_docs, odd_rows
from tidewire.llm import divergence as dv

FOLDER = "/root/testdata/sf0.001"


def brute(rows, min_docs=10, top=10):
    """The audit by its definition: every kept term for every pair of sources."""
    n, docs, groups = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for _, text, lang, source, *_ in rows:
        lang, source = lang or "", source or ""
        groups[lang].add(source)
        found = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", text or "")
        found = [re.sub("[A-Z]", lambda m: m[0].lower(), w) for w in found]
        n[lang, source].update(found)
        docs[lang].update(set(found))
    out = set()
    for lang, sources in groups.items():
        kept = [t for t, d in docs[lang].items() if d >= min_docs]
        share = {}
        for s in (*sources, None):
            count = Counter() if s is None else n[lang, s]
            if s is None:
                for x in sources:
                    count.update(n[lang, x])
            total = sum(count[t] for t in kept)
            share[s] = {t: 1 + 1_000_000_000 * (count[t] + 2) // (total + 2 * len(kept)) for t in kept}
        f = lambda p, q: (p - q) * (p - q) // (p + q)
        for s in sources:
            pairs = [(-sum(f(share[s][t], share[o][t]) for t in kept), o.encode(), o) for o in sources if o != s]
            out |= {(lang, s, "pair", o, -v, r) for r, (v, _, o) in enumerate(sorted(pairs), 1)}
            terms = [(-f(share[s][t], share[None][t]), t.encode(), t) for t in kept if n[lang, s][t] and share[s][t] > share[None][t]]
            out |= {(lang, s, "term", t, -v, r) for r, (v, _, t) in enumerate(sorted(terms)[:top], 1)}
    return out


def results(df):
    rows = [tuple(r) for r in df.select("lang", "source", "part", "item", "value", "rank").collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def test_equals_brute_force(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    assert results(dv.audit(docs)) == brute([tuple(r) for r in docs.collect()])


def test_odd_rows_and_thresholds(spark):
    clash = ("p", "q", "number", "term", "path", "value", "n", "none", "held")
    for min_docs in (1, 2, 10):
        got = results(dv.audit(odd_docs(spark, *clash), min_docs))
        assert got == brute(odd_rows(), min_docs)
    # With a threshold of 10 nothing is kept, and every pair is 0.
    assert got and all(r[2] == "pair" and r[4] == 0 for r in got)
    assert results(dv.audit(empty_docs(spark))) == set()


def test_hot_source_ties_and_letters(spark):
    rows = [(i, f"Alpha bÉta İx a{i}b {'gamma ' * (i % 4)}", "en", "hot" if i % 3 else f"s{i % 5}", 1) for i in range(90)]
    rows += [(i, "one two three", "de", f"s{i % 4}", 1) for i in range(40)] + [(7, "one\x00two\x7fThree", None, None, 1)] * 11
    assert results(dv.audit(spark.createDataFrame(rows, DOCS))) == brute(rows)


def test_terms():
    assert [t for t in dv.terms_of("Ab1cDÉ_x漢\x7f[z") if t] == ["ab".encode(), b"cd\xc3\x89", "x漢".encode(), b"z"]


def test_tree_meets_each_node_and_ancestor_once():
    rng = np.random.default_rng(3)
    paths = sorted(
        [(s, int(rng.integers(1, 4)) * 100, 7 + s) for s in range(5) if rng.random() < 0.7] for _ in range(300)
    )
    tree, expected = dv.Tree(pending=50), Counter()
    for path in paths:
        tree.insert(path, 2)
        for j, (s, p, z) in enumerate(path):
            for t, q, y in path[:j]:
                f = lambda a, b: (a - b) ** 2 // (a + b)
                expected[t, s] += 2 * (f(p, q) - f(p, y) - f(z, q) + f(z, y))
    assert tree.take() == expected
    whole = dv.Tree(pending=1 << 30)
    for path in paths:
        whole.insert(path, 1)
    whole.close(0)
    nodes = {tuple(path[: d + 1]) for path in paths for d in range(len(path))}
    assert sum(len(a) for a in whole.above) == sum(len(node) - 1 for node in nodes)


def test_counts_are_flushed(spark, monkeypatch):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").select("lang", "source", F.coalesce("text", F.lit("")).alias("text"))
    sums = lambda: {tuple(r) for r in dv.count_terms(docs.na.fill("")).groupBy("lang", "source", "term").agg(F.sum("n"), F.sum("docs")).collect()}
    whole = sums()
    monkeypatch.setattr(dv, "HELD_ENTRIES", 50)
    assert sums() == whole

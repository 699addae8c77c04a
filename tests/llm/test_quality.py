import pytest
from pyspark.sql import functions as F

from tests.llm.helpers import empty_docs, odd_docs, odd_rows
from tidewire.llm import quality as q


def brute_repeats(words):
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    return len({i + d for i, w in enumerate(windows) if windows.count(w) > 1 for d in range(3)})


@pytest.mark.parametrize("text", ["a b c", "a a a a", "a b c x a b c", "a b c a b c a", "", "x y z y z y z y", "é b c d é b c"])
def test_repeated_words(text):
    assert q.repeated_words(text.encode().split()) == brute_repeats(text.split())


def test_measures():
    text = "A# b|\nA# b|\n \n  \nlast\x1cone"
    names = dict(zip(q.MEASURES, q.measure(text), strict=True))
    assert names == {
        "n_words": 6, "word_chars": 17, "n_symbols": 4, "n_dup_lines": 1, "n_repeat_words": 0, "n_lines": 4,
        "n_upper": 2, "n_lower": 9,
    }


def test_odd_rows(spark):
    judged = q.apply_policy(q.ledger(odd_docs(spark, "failed", "n_words")))
    rows = judged.collect()
    assert len(rows) == len(odd_rows())
    by = {(r.doc_id, r.n_words): r.kept for r in rows}
    assert by[(1, 0)] is False and by[(3, 80)] is True and by[(None, 80)] is True and by[(5, 20_000)] is True
    kept = q.keep_good(odd_docs(spark, "failed"))
    assert kept.columns[-1] == "failed" and kept.count() == 5
    assert q.ledger(empty_docs(spark)).count() == q.keep_good(empty_docs(spark)).count() == 0


def test_ablation_reads_the_bits(spark):
    bits = [0, q.BIT["symbols"], q.BIT["symbols"] | q.BIT["capitals"], q.BIT["few_words"]]
    judged = spark.createDataFrame([(i, b) for i, b in enumerate(bits)], "doc_id bigint, failed bigint")
    got = {r.rule: (r.failed, r.failed_alone, r.kept_without) for r in q.ablation(judged).collect()}
    assert got["symbols"] == (2, 1, 2) and got["capitals"] == (1, 0, 1) and got["few_words"] == (1, 1, 2)
    strict, loose = (q.apply_policy(judged, q.Policy(n, m)) for n, m in (("a", q.BIT["symbols"]), ("b", 0)))
    assert [r.kept for r in strict.orderBy("doc_id").collect()] == [True, False, False, False]
    assert loose.where("kept").count() == 3 and {r.policy for r in loose.collect()} == {"b"}
    assert judged.where(F.col("failed") == 0).count() == 1

import collections
import math
import random
import re

from pyspark.sql import functions as F

from tests.llm.helpers import DOCS, empty_docs, odd_docs, odd_rows
from tidewire.llm import language as la

FOLDER = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    got = la.predict(docs, la.fit(docs)).join(docs.select("doc_id", "lang"), "doc_id").where(la.held_out())
    right = got.where(F.col("lang") == F.col("lang_pred")).count()
    assert right / got.count() > 0.98


def test_other_columns_are_no_input(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").limit(200)
    model = la.fit(docs)
    plain = la.predict(docs, model).orderBy("doc_id").collect()
    blind = la.predict(docs.withColumns({"lang": F.lit("en"), "source": F.lit("x")}), model)
    assert plain == blind.orderBy("doc_id").collect()


def plain_grams(text):
    letters = "".join(c if c.isalpha() else " " for c in f" {text.lower()} ")
    letters = re.sub(" +", " ", letters)
    return [letters[i : i + n] for n in (1, 2, 3) for i in range(len(letters) - n + 1)]


def bucket_of(gram, buckets):
    h = len(gram)
    for c in gram:
        h = (h * 0x9E3779B97F4A7C15 & 2**64 - 1) ^ ord(c)
    return ((h * 0xD6E8FEB86659FD93 & 2**64 - 1) >> 40) % buckets


def test_equals_plain_naive_bayes(spark):
    """Class and posterior of every text by the definition: priors, smoothed counts, products over n-grams."""
    rng = random.Random(2)
    word = {"en": "the of and to in".split(), "de": "der die und zu ein".split(), "fr": "le la et à un".split()}
    rows = [(i, " ".join(rng.choices(word[lang], k=rng.randint(1, 6))) + f" {i}!", lang, "s", 1)
            for i in range(90) for lang in [rng.choice(["en", "en", "en", "de", "fr"])]]
    config = la.LanguageConfig(buckets=512)
    docs = spark.createDataFrame(rows, DOCS)
    got = {r.doc_id: (r.lang_pred, r.score) for r in la.predict(docs, la.train(docs, config)).collect()}
    langs = sorted(word)
    counts = {lang: collections.Counter(bucket_of(g, 512) for _, t, x, *_ in rows if x == lang for g in plain_grams(t)) for lang in langs}
    size = {lang: sum(counts[lang].values()) + 0.5 * 512 for lang in langs}
    own = collections.Counter(r[2] for r in rows)
    for i, text, *_ in rows:
        logs = [math.log((own[lang] + 1) / (len(rows) + 3)) + sum(math.log((counts[lang][bucket_of(g, 512)] + 0.5) / size[lang]) for g in plain_grams(text))
                for lang in langs]
        top = max(logs)
        assert got[i][0] == langs[logs.index(top)]
        assert abs(got[i][1] - 1 / sum(math.exp(x - top) for x in logs)) < 1e-4


def test_sample_bound_and_counts(spark):
    rows = [(i, f"abc def {i}", "en" if i % 3 else "de", "s", 1) for i in range(900)]
    docs = spark.createDataFrame(rows, DOCS)
    config = la.LanguageConfig(sample_per_language=50)
    chosen = la.training_rows(docs, config).groupBy("lang").count().collect()
    assert {r.lang for r in chosen} == {"en", "de"} and all(25 < r["count"] <= 50 for r in chosen)
    try:
        la.training_rows(docs, la.LanguageConfig(max_languages=1))
    except ValueError as error:
        assert "max_languages" in str(error)
    else:
        raise AssertionError("a language was left out")


def test_odd_rows(spark):
    docs = odd_docs(spark, "score", "lang_pred")
    model = la.train(docs)
    assert model.languages == ("de", "en", "zh")
    rows = la.predict(docs, model).collect()
    assert len(rows) == len(odd_rows()) and all(0 <= r.score <= 1 for r in rows)
    assert {r.lang_pred for r in rows if r.doc_id in (1, 2, 4)} == {"und"}
    assert la.keep_known(docs, model).columns == docs.columns
    none = la.train(empty_docs(spark))
    assert {r.lang_pred for r in la.predict(docs, none).collect()} == {"und"}
    assert la.predict(empty_docs(spark), model).count() == 0


def test_grams_stay_inside_a_text():
    apart = [la.grams([t], (1, 2, 3), 1 << 16)[0] for t in ("Ab c", "d1e")]
    both, who, has = la.grams(["Ab c", None, "42", "d1e"], (1, 2, 3), 1 << 16)
    assert sorted(both[who == 0]) == sorted(apart[0]) and sorted(both[who == 3]) == sorted(apart[1])
    assert has.tolist() == [True, False, False, True]

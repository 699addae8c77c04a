"""Language identification by multinomial naive Bayes over hashed character n-grams.

Counts are gathered on Spark; the matrix of log-probabilities (languages x buckets) is small by
construction and is broadcast; texts are scored in batches with numpy.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidewire.llm.common import Keep, filter_rows, slices

UNDETERMINED = "und"


@dataclass(frozen=True)
class LanguageConfig:
    """n-gram orders, number of buckets, smoothing, and the bound of the training sample.

    `sample_per_language` is the largest number of training rows per language; `max_languages` bounds
    the matrix: a table with more language values is refused, none is left out.
    """

    orders: tuple[int, ...] = (1, 2, 3)
    buckets: int = 1 << 16
    alpha: float = 0.5
    sample_per_language: int = 2000
    max_languages: int = 128
    min_score: float = 0.5


DEFAULT = LanguageConfig()


@dataclass(frozen=True)
class LanguageModel:
    languages: tuple[str, ...]
    log_prob: np.ndarray  # buckets x languages, float32
    log_prior: np.ndarray
    config: LanguageConfig


LETTERS = np.array([chr(c).isalpha() for c in range(0x10000)])


def grams(texts: list[str | None], orders: tuple[int, ...], buckets: int) -> tuple[np.ndarray, ...]:
    """Bucket of every n-gram of all texts, the text each belongs to, and which texts have a letter.

    Texts are lower-cased, every run of other characters than letters is one space, and n-grams do not
    reach over a text's ends. Characters beyond the basic plane count as letters.
    """
    codes, owner = [], []
    for i, text in enumerate(texts):
        if text:
            points = np.frombuffer(f" {text.lower()} ".encode("utf-32-le", "surrogatepass"), np.uint32)
            letter = LETTERS[np.minimum(points, 0xFFFF)] | (points > 0xFFFF)
            keep = letter.copy()
            keep[1:] |= letter[:-1]
            keep[0] = True
            points = np.where(letter, points, 32)[keep]
            if letter.any():
                codes.append(points)
                owner.append(np.full(len(points), i, np.int32))
    has = np.zeros(len(texts), bool)
    if not codes:
        return np.zeros(0, np.int64), np.zeros(0, np.int32), has
    points, owners = np.concatenate(codes).astype(np.uint64), np.concatenate(owner)
    has[np.unique(owners)] = True
    out, who = [], []
    for n in orders:
        if len(points) < n:
            continue
        size = len(points) - n + 1
        h = np.full(size, n, np.uint64)
        for k in range(n):
            h = (h * np.uint64(0x9E3779B97F4A7C15)) ^ points[k : k + size]
        h *= np.uint64(0xD6E8FEB86659FD93)
        inside = owners[:size] == owners[n - 1 :]
        out.append((h >> np.uint64(40)).astype(np.int64)[inside] % buckets)
        who.append(owners[:size][inside])
    return np.concatenate(out), np.concatenate(who), has


def labelled_rows(docs: DataFrame) -> DataFrame:
    return docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull())


def rows_of_languages(docs: DataFrame, config: LanguageConfig) -> dict[str, int]:
    """How many labelled rows each language has; more than `max_languages` languages are refused."""
    counts = labelled_rows(docs).groupBy("lang").count().limit(config.max_languages + 1).collect()
    if len(counts) > config.max_languages:
        raise ValueError(f"more than {config.max_languages} language values; raise max_languages")
    return {row["lang"]: row["count"] for row in counts}


def training_rows(docs: DataFrame, config: LanguageConfig, counts: dict[str, int] | None = None) -> DataFrame:
    """At most `sample_per_language` rows per language, chosen by a hash of doc_id and text.

    Rows are first thinned by that hash to about twice the bound, so no language is ranked as a whole. Rows that are equal
    in both share their luck.
    """
    labelled, steps = labelled_rows(docs), 1 << 30
    counts = rows_of_languages(docs, config) if counts is None else counts
    share = [
        part for lang, n in counts.items() for part in (F.lit(lang), F.lit(int(2 * steps * config.sample_per_language / n)))
    ]
    if not share:
        return labelled.select("lang", "text").limit(0)
    draw = F.xxhash64(F.lit("sample"), "doc_id", "text")
    thin = labelled.where(F.pmod(draw, F.lit(steps)) < F.create_map(*share)[F.col("lang")])
    order = Window.partitionBy("lang").orderBy(draw, "doc_id")
    chosen = thin.select("lang", "doc_id", "text").withColumn("__at", F.row_number().over(order))
    return chosen.where(F.col("__at") <= config.sample_per_language).select("lang", "text")


def train(docs: DataFrame, config: LanguageConfig = DEFAULT) -> LanguageModel:
    """A model from rows with `doc_id`, `lang` and `text`; rows with NULL text or lang teach nothing.

    A language's prior is its share of all labelled rows, each language counted once more; the sample bounds what
    the n-grams are counted on. The driver gets one number per language and bucket, which the configuration bounds.
    """
    seen = rows_of_languages(docs, config)
    rows = training_rows(docs, config, seen)
    orders, buckets = config.orders, config.buckets

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[str, np.ndarray] = {}
        for batch in slices(batches):
            langs = batch.column("lang").to_pylist()
            bucket, who, _ = grams(batch.column("text").to_pylist(), orders, buckets)
            names = sorted(set(langs))
            index = np.array([names.index(x) for x in langs])
            for i, name in enumerate(names):
                here = np.bincount(bucket[index[who] == i], minlength=buckets) if len(who) else 0
                total[name] = total.get(name, np.zeros(buckets, np.int64)) + here
        for name, counts in total.items():
            found = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * len(found), pa.string()), pa.array(found), pa.array(counts[found])],
                ["lang", "bucket", "n"],
            )

    sums = rows.mapInArrow(count, "lang string, bucket bigint, n bigint").groupBy("lang", "bucket").agg(
        F.sum("n").alias("n")
    ).toArrow()
    table_langs = sums.column("lang").to_pylist()
    languages = tuple(sorted(set(table_langs)))
    place = {name: i for i, name in enumerate(languages)}
    counts = np.full((buckets, len(languages)), config.alpha)
    at = (sums.column("bucket").to_numpy(), np.array([place[x] for x in table_langs], np.int64))
    np.add.at(counts, at, sums.column("n").to_numpy())
    log_prob = np.log(counts / counts.sum(axis=0)).astype(np.float32) if languages else counts
    shares = np.array([seen[name] + 1 for name in languages], np.float64)
    prior = np.log(shares / shares.sum())
    return LanguageModel(languages, log_prob, prior, config)


def score(texts: list[str | None], model: LanguageModel) -> tuple[list[str], np.ndarray]:
    """Best language of each text and its posterior; `und` and 0 without a letter or a model.

    Equal scores go to the language that sorts first.
    """
    bucket, who, has = grams(texts, model.config.orders, model.config.buckets)
    names, best = [UNDETERMINED] * len(texts), np.zeros(len(texts))
    if not model.languages or not len(bucket):
        return names, best
    sums = np.stack(
        [np.bincount(who, model.log_prob[bucket, k], len(texts)) for k in range(len(model.languages))], axis=1
    ) + model.log_prior
    top = sums.argmax(axis=1)
    best = 1 / np.exp(sums - sums.max(axis=1, keepdims=True)).sum(axis=1) * has
    return [model.languages[k] if h else UNDETERMINED for k, h in zip(top, has, strict=True)], best


def _ship(spark: SparkSession, model: LanguageModel) -> Callable[[], LanguageModel]:
    """The model's arrays as a broadcast; the result rebuilds the model on a worker."""
    config = model.config
    shared = spark.sparkContext.broadcast((model.languages, model.log_prob, model.log_prior))
    return lambda: LanguageModel(*shared.value, config)


def predict(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """doc_id, lang_pred and score of every row, from the whole text and nothing else.

    A NULL text or one without a letter is `und` with score 0, as is every text under a model without languages. Long
    texts are read whole. Equal scores go to the language that sorts first, repeated rows get equal
    results, an empty table gives none, and other columns are left out.
    """
    model_of = _ship(docs.sparkSession, model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = model_of()
        for batch in slices(batches, 64):
            names, scores = score(batch.column("text").to_pylist(), model)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(names, pa.string()), pa.array(scores, pa.float64())],
                ["doc_id", "lang_pred", "score"],
            )

    narrow = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"))
    return narrow.mapInArrow(run, "doc_id bigint, lang_pred string, score double")


def keep_known(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """Rows whose language is determined with at least `min_score`; all columns stay, whatever they are called.

    Rows with a NULL text or without a letter go; an empty table stays empty.
    """
    model_of, least = _ship(docs.sparkSession, model), model.config.min_score

    def keeper() -> Keep:
        model = model_of()

        def keep(texts: list[str | None]) -> list[bool]:
            names, scores = score(texts, model)
            return [n != UNDETERMINED and s >= least for n, s in zip(names, scores, strict=True)]

        return keep

    return filter_rows(docs, keeper)


def held_out() -> Column:
    """Whether a document is kept from training: crc32 of its id as text, modulo 4, is 2."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False))


def fit(docs: DataFrame, config: LanguageConfig = DEFAULT) -> LanguageModel:
    """A model from the documents that are not held out."""
    return train(docs.where(~held_out()).select("doc_id", "lang", "text"), config)

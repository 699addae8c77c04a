"""Noise verdicts: prompts, pluggable classifier, positional attachment, offline rules."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewire.functions.basics import bind, literal_array
from tidewire.functions.text import article_text, lowered
from tidewire.functions.verdicts import fallback_verdict, parse_verdicts
from tidewire.operators.articles import arrival_order
from tidewire.operators.ordered import row_index
from tidewire.session import materialize

# Our own wording; pass another text to `build_prompts` to match a model.
INSTRUCTIONS = (
    "Decide for each numbered article whether it is noise or a confirmed market event. Reply with JSON "
    'only: {"results": [{"is_noise": true, "reason": "why, in a few words", "category": "topic"}]}.'
)

# Our own approximation of the noise criteria for running without a model.
SPECULATION = ("will ", "could ", "might ", "expected to", "forecast", "prediction", "opinion")
# Word edges are spelled out: regex engines differ in what `\b` takes for a letter.
_FIRST, _LAST = r"(?:^|[^\p{L}\p{N}])", r"(?:[^\p{L}\p{N}]|$)"
LISTICLES = tuple(
    _FIRST + words + _LAST
    for words in ("top [0-9]+", "best [0-9]*", "[0-9]+ (?:coins|tokens|things|reasons)", "(?:coins?|tokens?) to watch")
)


def shown_content(chars: int | None) -> Column:
    """The content a prompt shows: all of it, or its first `chars` characters."""
    content = F.coalesce("content", F.lit(""))
    return content if chars is None else F.substring(content, 1, chars)


def prompt_parts(df: DataFrame, *keys: str, content_chars: int | None = None) -> DataFrame:
    """Keys, title and the content shown: all that a prompt shows, and all that batching moves."""
    return df.select(*keys, "title", shown_content(content_chars).alias("content"))


def assign_batches(
    df: DataFrame, size: int = 1, by: Sequence[str] = ("window_start",), entries_per_chunk: int = 4096
) -> DataFrame:
    """Add `batch` (number inside the window) and `pos` (place in the batch), in order of arrival.

    Positions come from chunk counts, so an hour with most of the rows is not ranked in one task. A
    chunk is a part of what one feed delivered at one ingestion time.
    """
    landed = [F.col(c) for c in ("ingestion_time",) if c in df.columns]
    chunk = F.struct(*landed, F.col("feed_ord"), F.floor(F.col("entry_ord") / entries_per_chunk))
    ordered = row_index(df, by, arrival_order(df), chunk)
    return (
        ordered.withColumn("batch", F.floor(F.col("_idx") / size))
        .withColumn("pos", (F.col("_idx") % size).cast("int"))
        .drop("_idx")
    )


def article_block(pos: Column, content_chars: int | None = None) -> Column:
    # The labels and line breaks of an article in a prompt.
    return F.concat(
        F.lit("\n"), pos.cast("string"), F.lit(":\ntitle: "), F.coalesce("title", F.lit("")),
        F.lit("\ncontent: "),
        shown_content(content_chars), F.lit("\n"),
    )


def _prompt(articles: Column, instructions: str) -> Column:
    return F.concat(F.lit(instructions), F.lit("\nARTICLES:\n"), articles)


def single_prompts(
    df: DataFrame, instructions: str = INSTRUCTIONS, content_chars: int | None = None
) -> DataFrame:
    """One prompt per article, as in batches of one; a projection without a shuffle."""
    return df.withColumn("prompt", _prompt(article_block(F.lit(0), content_chars), instructions))


def build_prompts(
    batched: DataFrame, by: Sequence[str] = ("window_start",), instructions: str = INSTRUCTIONS,
    key: str | None = None,
) -> DataFrame:
    """One prompt per batch. A group is one batch, so it never holds more than the batch size.

    With `key` the articles' keys travel along as the array `keys`, in the prompt's order; a reply is
    later matched by them, whatever order a second run would have put the articles in.
    """
    carried = [F.col(key).alias("key")] if key else []
    block = F.struct(F.col("pos"), article_block(F.col("pos")).alias("text"), *carried)
    return (
        batched.groupBy(*by, "batch")
        .agg(F.sort_array(F.collect_list(block)).alias("_blocks"))
        .select(
            *by, "batch", F.size("_blocks").alias("n_articles"),
            _prompt(F.array_join(F.transform("_blocks", lambda b: b["text"]), ""), instructions)
            .alias("prompt"),
            *([F.transform("_blocks", lambda b: b["key"]).alias("keys")] if key else []),
        )
    )


def ask_classifier(
    prompts: DataFrame,
    classifier_factory: Callable[[], Callable[[list[str]], list[str | None]]],
    retries: int = 3,
    delay_seconds: float = 2.0,
) -> DataFrame:
    """Add `reply` and `reply_error` from user code, built once per task.

    `classifier_factory()` returns a function from a list of prompts to a list of replies. A call that
    fails is retried, then its prompts are asked one by one, so that one bad prompt costs no other its
    reply; what still fails has a NULL reply and the error's text. Only prompts go to Python and only
    replies come back. Parallelism is the number of partitions: `repartition(n)` limits concurrent calls.
    """

    @F.pandas_udf("reply string, reply_error string")
    def ask(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        classify = classifier_factory()

        def attempt(texts: list[str]) -> tuple[list[str | None] | None, str | None]:
            error = None
            for n in range(retries):
                if n:
                    time.sleep(delay_seconds)
                try:
                    replies = list(classify(texts))
                    if len(replies) == len(texts):
                        return replies, None
                    error = f"{len(replies)} replies to {len(texts)} prompts"
                except Exception as failure:  # noqa: BLE001 - user code; its error is the result
                    error = f"{type(failure).__name__}: {failure}"
            return None, error

        for batch in batches:
            texts = list(batch)
            replies, error = attempt(texts) if texts else ([], None)
            if replies is not None:
                rows = [(r, None) for r in replies]
            elif len(texts) == 1:
                rows = [(None, error)]
            else:
                rows = []
                for text in texts:
                    one, error = attempt([text])
                    rows.append((one[0] if one else None, error))
            yield pd.DataFrame(rows, columns=["reply", "reply_error"], index=batch.index, dtype="object")

    return prompts.withColumn("_asked", ask("prompt")).select(*prompts.columns, "_asked.*")


class ReplyStore:
    """Replies of one model by the digest of their prompt, kept over runs in a Parquet table.

    A prompt is asked once: not again in a later run, nor for a second row with the same text. Replies are
    appended part by part, so a run that fails loses the part it was in and keeps those before it. Calls
    that failed are not stored and are asked again by the next run. One writer at a time.
    """

    def __init__(self, spark: SparkSession, path: str, model: str):
        self.spark, self.path, self.model = spark, path.rstrip("/"), model

    def replies(self) -> DataFrame:
        """digest and reply of every prompt that was answered."""
        try:
            stored = self.spark.read.schema("digest string, reply string, model string").parquet(self.path)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            stored = self.spark.createDataFrame([], "digest string, reply string, model string")
        return stored.where(F.col("model") == self.model).drop("model")

    def ask(
        self, prompts: DataFrame, classifier_factory: Callable[[], Callable[[list[str]], list[str | None]]],
        parts: int = 8, **options,
    ) -> DataFrame:
        """`prompts` with `reply` and `reply_error`, asking only what the store does not hold.

        Missing prompts are asked in `parts` jobs, dealt by digest. A NULL prompt has no reply and no error. Texts meet the
        store as digests; only misses are moved as text.
        """
        keyed = prompts.withColumn("_digest", F.sha2("prompt", 256))
        missing = keyed.where(F.col("_digest").isNotNull()).select("_digest", "prompt").join(
            self.replies().select(F.col("digest").alias("_digest")), "_digest", "left_anti"
        )
        # Copies of a prompt meet by digest, thinned by each task first.
        missing = materialize(missing.groupBy("_digest").agg(F.first("prompt").alias("prompt")), "missing-prompts")
        part = F.pmod(F.xxhash64("_digest"), F.lit(parts))
        failed = None
        for number in range(parts):
            asked = materialize(
                ask_classifier(missing.where(part == number), classifier_factory, **options).drop("prompt"), "replies"
            )
            asked.where(F.col("reply").isNotNull()).select(
                F.col("_digest").alias("digest"), "reply", F.lit(self.model).alias("model")
            ).write.mode("append").partitionBy("model").parquet(self.path)
            errors = asked.where(F.col("reply").isNull()).select("_digest", "reply_error")
            failed = errors if failed is None else failed.unionByName(errors)
        known = self.replies().dropDuplicates(["digest"]).select(F.col("digest").alias("_digest"), "reply")
        return keyed.join(known, "_digest", "left").join(failed, "_digest", "left").select(
            *prompts.columns, "reply", "reply_error"
        )


def ask_in_rounds(
    first: DataFrame, ask: Callable[[DataFrame], DataFrame], follow_up: Callable[[DataFrame], Column], rounds: int
) -> DataFrame:
    """Sequences of prompts, each made from the reply before: `first` with `n_asked`, `reply` and `reply_error`.

    `first` has the first `prompt` of every row. `ask` adds `reply` and `reply_error` to rows with a prompt (see
    `ask_classifier`, `ReplyStore.ask`); `follow_up` gives the next prompt of answered rows, or NULL where the sequence ends. Each
    round asks the rows that are still open, in one job whose rows are written, so a lost executor never makes an earlier round
    ask again. After `rounds` rounds, and after a call that failed, the last reply stands.
    """
    if rounds < 1:
        raise ValueError("at least one round")
    columns = first.columns
    open_rows, done = materialize(first, "round-0"), None
    for number in range(1, rounds + 1):
        asked = materialize(ask(open_rows).withColumn("n_asked", F.lit(number)), f"round-{number}")
        after = asked.withColumn("_next", F.when(F.col("reply").isNotNull(), follow_up(asked)))
        ends = F.col("_next").isNull() if number < rounds else F.lit(True)
        over = after.where(ends).select(*columns, "n_asked", "reply", "reply_error")
        done = over if done is None else done.unionByName(over)
        if number < rounds:
            open_rows = after.where(~ends).withColumn("prompt", F.col("_next")).select(*columns)
    return done


def attach_verdicts(articles: DataFrame, replies: DataFrame, key: str = "id") -> DataFrame:
    """Join each batch's parsed reply to its articles by their keys.

    `replies` has one row per batch with `keys` (of the articles, in the prompt's order) and `reply`.
    Articles without a reply get the fallback verdict.
    """
    parsed = parse_verdicts(F.col("reply"), F.size("keys"))
    verdicts = replies.select(F.inline(F.arrays_zip(F.col("keys").alias("_key"), parsed.alias("_verdict")))).toDF(
        "_key", "_verdict"
    )
    joined = articles.join(verdicts, articles[key] == verdicts["_key"], "left")
    return joined.select(
        *[articles[c] for c in articles.columns], F.coalesce("_verdict", fallback_verdict()).alias("verdict")
    ).select(*articles.columns, "verdict.*")


def noise_gate(df: DataFrame) -> DataFrame:
    """Only a verdict that says false passes; NULL does not."""
    return df.where(~F.col("is_noise"))


def classify_noise_rules(df: DataFrame) -> DataFrame:
    """Offline verdicts: speculation first, then listicles, else a signal."""
    def read(text: Column) -> Column:
        speculative = F.exists(literal_array(SPECULATION), lambda w: F.contains(text, w))
        listicle = text.rlike("|".join(LISTICLES))
        reason = F.when(speculative, "speculation").when(listicle, "listicle").otherwise("event")
        return reason

    reason = bind(lowered(article_text(F.col("title"), F.col("content"))), read)
    return (
        df.withColumn("reason", reason)
        .withColumn("is_noise", F.col("reason") != "event")
        .withColumn("category", F.lit("unknown"))
    )

"""Line dedup by a log-template tree, in DataFrame operations only.

Numbers in a line are masked, then the line goes down a tree of fixed depth: its token count, then its
first `depth` tokens. Lines in one leaf are compared in EIGHT equal runs of tokens: lines that share most
runs are of one template, the others are its variable fields; a leaf holds any number of templates. So are
lines that share most tokens, wherever the others stand. A template seen in enough documents recurs; it stays
in the document with the smallest doc_id and is dropped elsewhere.

How many documents are enough depends on what the lines have in common. Only words count, tokens
without a masked number; where lines differ, only words behind the tokens that the leaf has fixed
anyway. Eight words that agree do so in two documents for a reason, fewer have to be found in many.
"""

from __future__ import annotations

import random
from dataclasses import dataclass
from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewire.session import materialize

EIGHT = 8
LAST = 2**63 - 1
BLANKS = " \t\x0b\x0c\r"


@dataclass(frozen=True)
class TemplateConfig:
    """Depth of the tree and what counts as recurring.

    Lines of `min_tokens` words and more recur from `min_docs` documents on and are generalised: lines of a leaf
    fit one template if `same_runs` of their eight runs agree, or the share `same_tokens` of all tokens:
    of two lines of 20 tokens or more that do, one in 40,000 at most shares none of the `bands`. The template needs `min_tokens`
    constant words behind the leaf's tokens. Lines of fewer words recur as they are, with their numbers: those of
    `min_tokens` tokens from `min_docs` documents on, those of `short_tokens` words from `short_docs` on. Templates of
    fewer constants, `short_tokens` at least, occur by chance, also those of lines that agree in all but their
    numbers, or of short ones that agree in all tokens but one: they recur if their documents fill `short_slots` of 64
    slots by their hash, which takes at least as many documents, 44 on average. Still shorter lines stay.
    """

    depth: int = 4
    min_tokens: int = 8
    min_docs: int = 2
    same_runs: int = 6
    same_tokens: float = 0.8
    bands: int = 28
    seed: int = 1
    short_tokens: int = 3
    short_docs: int = 20
    short_slots: int = 32


DEFAULT = TemplateConfig()
NUMBER = r"[0-9]+"
MASK = "<*>"
# Stands in front of a line that is compared with its numbers; no line holds one.
NUMERIC = "\n"


def masked(text: Column) -> Column:
    return F.regexp_replace(text, NUMBER, MASK)


def masks_in(line: Column) -> Column:
    """How many masked numbers a line holds."""
    found = (F.length(line) - F.length(F.replace(line, F.lit(MASK), F.lit("")))) / len(MASK)
    return F.when(F.contains(line, F.lit(MASK)), found.cast("int")).otherwise(0)


def n_tokens(line: Column) -> Column:
    return F.length(line) - F.length(F.replace(line, F.lit(" "), F.lit(""))) + 1


def known_lines(text: Column, config: TemplateConfig) -> Column:
    """The lines of a text, outer blanks cut, in the form in which they are compared.

    Numbers are masked where `min_tokens` words are left beside them; a line that is mostly numbers keeps them, behind
    NUMERIC. Tokens are what single spaces part.
    """
    cut = lambda x: F.btrim(x, F.lit(BLANKS))

    def form(mask: Column, line: Column) -> Column:
        few = F.contains(mask, F.lit(MASK)) & (n_tokens(cut(mask)) - masks_in(mask) < config.min_tokens)
        return F.when(few, F.concat(F.lit(NUMERIC), cut(line))).otherwise(cut(mask))

    numbered = F.zip_with(F.split(masked(text), "\n"), F.split(text, "\n"), form)
    return F.when(text.rlike("[0-9]"), numbered).otherwise(F.transform(F.split(text, "\n"), cut))


def runs_of(tokens: str, n: str) -> Column:
    """The eight runs' hashes, one byte each, in one long."""
    start = lambda i: f"cast(floor({n} * {i} / {EIGHT}) AS int)"
    run = f"slice({tokens}, {start('i')} + 1, {start('(i + 1)')} - {start('i')})"
    return F.expr(f"aggregate(sequence(0, {EIGHT - 1}), 0L, (all, i) -> all | shiftleft(cast(hash({run}) & 255 AS bigint), 8 * i))")


def token_hashes(line: Column) -> Column:
    """Two bytes per token."""
    return F.transform(F.split(line, " "), lambda x: F.hash(x).bitwiseAND(F.lit(2**15 - 1)).cast("smallint"))


def counted_lines(docs: DataFrame, config: TemplateConfig = DEFAULT) -> DataFrame:
    """Every distinct line that may recur: its documents, tokens and place in the tree.

    line (hash), tokens (hashes), n (tokens), masks (numbers), shape (hash of a numeric line's masked form), leaf (hash, NULL
    for lines that are no part of the tree), n_docs, first (the smallest doc_id) and slots. A line that a third of
    all rows share arrives as one row per task.
    """
    each = docs.select(
        F.coalesce(F.col("doc_id").cast("bigint"), F.lit(LAST)).alias("doc"),
        F.explode(F.array_distinct(known_lines(F.col("text"), config))).alias("text"),
    )
    text, numeric = F.col("text"), F.startswith("text", F.lit(NUMERIC))
    n = n_tokens(text)
    shown = each.where((n >= config.short_tokens) & (F.length("text") >= 2 * config.short_tokens - 1)).select(
        "doc", F.xxhash64("text").alias("line"), n.alias("n"), token_hashes(text).alias("tokens"),
        masks_in(F.when(numeric, masked(text)).otherwise(text)).alias("masks"),
        F.when(numeric, F.xxhash64(masked(text))).alias("shape"),
    )
    # n is counted and not the size of `tokens`: a filter on it is applied before the count, where tokens are dear.
    counted = shown.groupBy("line", "n", "tokens", "masks", "shape").agg(
        F.count(F.lit(1)).alias("n_docs"), F.min("doc").alias("first"),
        F.expr("bit_or(shiftleft(1L, cast(pmod(xxhash64(doc), 64) as int)))").alias("slots"),
    )
    words = F.col("n") - F.col("masks")
    return counted.where((words >= config.short_tokens) | (F.col("n") >= config.min_tokens)).withColumn(
        "leaf", F.when(words >= config.min_tokens, F.xxhash64("n", F.slice("tokens", 1, config.depth)))
    )


def recurring_lines(docs: DataFrame, config: TemplateConfig = DEFAULT) -> DataFrame:
    """line (hash of a line as compared) and `first`, the smallest doc_id its template occurs in.

    Only lines of leaves with several different lines are compared.
    """
    counted = materialize(counted_lines(docs, config), "lines-counted")
    long = F.col("leaf").isNotNull()
    enough = F.when(F.col("n") >= config.min_tokens, config.min_docs).otherwise(config.short_docs)
    exact = counted.where(F.col("n_docs") >= enough)
    leaves = counted.where(long).groupBy("leaf").agg(F.count(F.lit(1)).alias("n_lines")).where("n_lines > 1")
    several = counted.where(long).join(leaves, "leaf", "left_semi").withColumn("runs", runs_of("tokens", "n"))
    several = materialize(several, "lines-several")
    few = counted.where(~long & (F.col("n") - F.col("masks") >= config.short_tokens))
    found = exact.select("line", "first").unionByName(same_run_lines(several, config))
    found = found.unionByName(same_token_lines(several, config)).unionByName(short_lines(few, config))
    return found.groupBy("line").agg(F.min("first").alias("first"))


def by_constants(constants: Column, config: TemplateConfig) -> Column:
    """Whether a group of lines recurs whose template has so many constant words behind the leaf's tokens."""
    many = F.bit_count(F.bit_or("slots")) >= config.short_slots
    return ((constants >= config.min_tokens) & (F.sum("n_docs") >= config.min_docs)) | many


def same_run_lines(several: DataFrame, config: TemplateConfig) -> DataFrame:
    """line and `first` of the lines that agree with others of their leaf in `same_runs` of the eight runs.

    Each choice of that many runs, with what they hold, is a template; a leaf may have any number. Its constants are the
    tokens of these runs behind the leaf's, without as many as the line has masks. Choices with fewer than
    `short_tokens` constants are none.
    """
    # Columns of a choice are computed from the runs it leaves out; with the sizes of all eight runs spelled out, the
    # code for a row is longer than the JVM compiles (8,000 bytes).
    end = lambda i: F.greatest(F.floor(F.col("n") * i / EIGHT).cast("int"), F.lit(config.depth))
    choices = []
    for choice in combinations(range(EIGHT), config.same_runs):
        mask = sum(255 << 8 * i for i in choice)
        out = [F.lit(i) for i in range(EIGHT) if i not in choice]
        choices.append(F.struct(F.lit(mask - 2**64 if mask >= 2**63 else mask).alias("mask"), F.array(*out).alias("left_out")))
    # The choices are rows of their own before anything is computed of them, so the code for a row stays small.
    places = several.select("line", "n_docs", "first", "slots", "masks", "leaf", "runs", "n", F.inline(F.array(*choices))).withColumn(
        "key", F.xxhash64("leaf", "mask", F.col("runs").bitwiseAND(F.col("mask")))
    )
    left_out = [F.get("left_out", F.lit(j)) for j in range(EIGHT - config.same_runs)]
    behind = F.greatest("n", F.lit(config.depth)) - config.depth
    constants = reduce(lambda all_, i: all_ - (end(i + 1) - end(i)), left_out, behind) - F.col("masks")
    members = places.select("line", "n_docs", "first", "slots", "key", constants.alias("constants")).where(
        F.col("constants") >= config.short_tokens
    )
    return of_groups(members, by_constants(F.min("constants"), config))


def same_token_lines(several: DataFrame, config: TemplateConfig) -> DataFrame:
    """line and `first` of the lines that share `same_tokens` of all tokens with a leader, in the same places.

    Lines of a leaf that agree in one of `bands` samples of four tokens are a group, led by the two lines
    with the smallest and the largest hash. A line and its leaders are compared token by token. What they have in common
    behind the leaf's tokens, without as many as the line has masks, has to be `min_tokens` words at least.
    """
    rng = random.Random(config.seed)
    depth, n = config.depth, F.col("n")
    # Lines that are too short for that many constants have no partner.
    able = several.where(n - depth - F.col("masks") >= config.min_tokens)

    bands = F.array(*[
        F.struct(F.lit(band).alias("band"), F.array(*[F.lit(rng.random()) for _ in range(4)]).alias("at")) for band in range(config.bands)
    ])
    token = lambda j: F.get("tokens", F.floor((n - depth) * F.get("at", F.lit(j))).cast("int") + depth)
    members = able.select("line", "leaf", "tokens", "n", F.inline(bands)).select(
        "line", F.xxhash64("leaf", "band", *[token(j) for j in range(4)]).alias("key")
    )
    groups = members.groupBy("key").agg(F.min("line").alias("low"), F.max("line").alias("high")).where("low <> high")
    pairs = members.join(groups, "key").select("line", F.explode(F.array("low", "high")).alias("leader")).where(
        "line <> leader"
    ).distinct()
    lines = able.select("line", "tokens", "n", "masks", "n_docs", "first")
    leaders = lines.select(*[F.col(c).alias("leader" if c == "line" else f"l_{c}") for c in lines.columns])
    equal = F.size(F.filter(F.zip_with("tokens", "l_tokens", lambda a, b: a == b), lambda x: x))
    alike = (equal >= config.same_tokens * n) & (equal - depth - F.col("masks") >= config.min_tokens)
    stars = materialize(
        pairs.join(lines, "line").join(leaders, "leader").where(alike).select(
            "leader", "line", "n_docs", "first", "l_n_docs", "l_first"
        ),
        "line-stars",
    )
    recurring = stars.groupBy("leader").agg(
        F.least(F.min("first"), F.min("l_first")).alias("first"), (F.sum("n_docs") + F.min("l_n_docs")).alias("n_docs")
    ).where(F.col("n_docs") >= config.min_docs).drop("n_docs")
    led = stars.select("leader", "line").join(recurring, "leader").select("line", "first")
    return led.unionByName(recurring.withColumnRenamed("leader", "line"))


def short_lines(counted: DataFrame, config: TemplateConfig) -> DataFrame:
    """line and `first` of the lines of few words that agree with others in all but numbers, or in all tokens but one.

    Documents are counted by slots, so one document with many lines of a template counts once.
    """
    n = F.size("tokens")
    others = [
        F.when(
            (n > i) & (n < config.min_tokens) & (F.col("n") - F.col("masks") > config.short_tokens - 1),
            F.xxhash64(n, F.lit(i), F.concat(F.slice("tokens", 1, i), F.slice("tokens", i + 2, n))),
        )
        for i in range(config.min_tokens - 1)
    ]
    members = counted.select("line", "slots", "first", F.explode(F.array_compact(F.array("shape", *others))).alias("key"))
    return of_groups(members, F.bit_count(F.bit_or("slots")) >= config.short_slots)


def of_groups(members: DataFrame, recurs: Column) -> DataFrame:
    """line and the `first` of its groups, of groups (by `key`) of several lines that recur."""
    groups = members.groupBy("key").agg(
        F.min("first").alias("first"), ((F.count(F.lit(1)) > 1) & recurs).alias("recurs")
    ).where("recurs")
    return members.select("line", "key").join(groups.select("key", "first"), "key").groupBy("line").agg(
        F.min("first").alias("first")
    )


def without(lines: Column, dropped: Column) -> Column:
    """`lines` without the positions in `dropped`, in time linear in both."""
    at = F.array_sort(dropped)
    starts = F.concat(F.array(F.lit(0)), F.transform(at, lambda i: i + 1))
    ends = F.concat(at, F.array(F.size(lines)))
    return F.flatten(F.zip_with(starts, ends, lambda a, b: F.slice(lines, a + 1, b - a)))


def edited(docs: DataFrame, config: TemplateConfig = DEFAULT) -> DataFrame:
    """All columns of `docs` with `text` edited, and `__dropped`: how many lines went."""
    recurring = materialize(recurring_lines(docs, config), "lines-recurring")
    key = {"__doc": F.col("doc_id").cast("bigint"), "__text": F.xxhash64("text")}
    places = docs.select(
        *[c.alias(n) for n, c in key.items()],
        F.posexplode(F.transform(known_lines(F.col("text"), config), lambda x: F.xxhash64(x))).alias("at", "line"),
    )
    later = F.coalesce(F.col("__doc"), F.lit(LAST)) != F.col("first")
    dropped = places.join(recurring, "line").where(later).groupBy("__doc", "__text").agg(
        F.collect_set("at").alias("__at")
    )
    left, right = docs.withColumns(key).alias("l"), dropped.alias("r")
    same = F.col("l.__doc").eqNullSafe(F.col("r.__doc")) & (F.col("l.__text") == F.col("r.__text"))
    joined = left.join(right, same, "left").select("l.*", "r.__at")
    kept = F.when(F.col("__at").isNull(), F.col("text")).otherwise(
        F.array_join(without(F.split("text", "\n"), F.col("__at")), "\n")
    )
    return joined.withColumns({"text": kept, "__dropped": F.coalesce(F.size("__at"), F.lit(0)).cast("bigint")}).drop(
        "__doc", "__text", "__at"
    )


def drop_recurring(docs: DataFrame, config: TemplateConfig = DEFAULT) -> DataFrame:
    """doc_id, the text without its recurring lines, n_lines of the whole text and n_dropped.

    A NULL text stays NULL with 0 lines. Rows with the same doc_id are one document, so repeated rows
    stay equal; rows without doc_id are one document that comes last. A line repeated inside its first
    document stays there. An empty table gives an empty result; further columns are left out.
    """
    rows = edited(docs.select("doc_id", "text", F.size(F.split("text", "\n")).alias("n_lines")), config)
    return rows.select(
        "doc_id", "text", F.coalesce("n_lines", F.lit(0)).cast("bigint").alias("n_lines"),
        F.col("__dropped").alias("n_dropped"),
    )


def dedup_lines(docs: DataFrame, config: TemplateConfig = DEFAULT) -> DataFrame:
    """The pipeline's form: the columns of `docs`, texts edited, without rows that lost all their words.

    `n_chars` follows the text where the table has it.
    """
    changed = F.col("__dropped") > 0
    rows = edited(docs, config).where(~changed | F.col("text").rlike(r"[^\x20\x09-\x0D]"))
    if "n_chars" in docs.columns:
        n_chars = F.when(changed, F.length("text").cast("bigint")).otherwise(F.col("n_chars"))
        rows = rows.withColumn("n_chars", n_chars)
    return rows.select(*docs.columns)

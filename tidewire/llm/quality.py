"""Quality rules as a bitmask ledger: measure and judge once, then apply policies to the stored bits.

`ledger` runs every rule on every whole text and stores one bit per failed rule beside the measurements.
A policy is a versioned bitmask; `apply_policy` and `ablation` read the ledger only and never the texts.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewire.llm.common import Keep, filter_rows, slices

MEASURES = (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_lower",
)
SCHEMA = "doc_id bigint, " + ", ".join(f"{name} bigint" for name in MEASURES) + ", failed bigint"

# A rule holds a name and a condition under which a text fails; conditions are SQL over the measures and
# use whole numbers only, so that every engine decides alike. The position in the tuple is the bit.
RULES = (
    ("few_words", "n_words < 50"),
    ("repeated_windows", "100 * n_repeat_words > 50 * n_words"),
    ("symbols", "10 * n_symbols > n_words"),
    ("repeated_lines", "100 * n_dup_lines > 30 * n_lines + 200"),
    ("capitals", "n_upper > n_lower"),
    ("long_words", "word_chars > 40 * n_words"),
)
BIT = {name: 1 << i for i, (name, _) in enumerate(RULES)}
BASE = BIT["few_words"] | BIT["repeated_windows"]


@dataclass(frozen=True)
class Policy:
    """The rules that reject a document, as a mask over the ledger's bits."""

    version: str
    mask: int


DEFAULT_POLICY = Policy("v1", sum(BIT.values()))


def repeated_words(words: list[bytes]) -> int:
    """Words that lie in a three-word window which the text holds twice or more."""
    n = len(words)
    if n < 4:
        return 0
    seen: dict[bytes, int] = {}
    ids = np.fromiter((seen.setdefault(w, len(seen)) for w in words), np.int64, n)
    pairs = ids[:-1] * len(seen) + ids[1:]
    if len(seen) > 2_000_000:  # the product of three numbers would not fit
        pairs = np.unique(pairs, return_inverse=True)[1]
    windows = pairs[:-1] * len(seen) + ids[2:]
    order = np.argsort(windows, kind="stable")
    same = windows[order[1:]] == windows[order[:-1]]
    twice = np.zeros(n - 2, bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    covered = np.zeros(n, bool)
    for shift in range(3):
        covered[shift : n - 2 + shift] |= twice
    return int(covered.sum())


def measure(text: str | None) -> tuple[int, ...]:
    """The values of MEASURES; a NULL text counts as empty.

    Words are runs of characters other than space and \\t to \\r, which is how bytes.split() cuts.
    """
    text = text or ""
    data = text.encode()
    words = data.split()
    blanks = sum(data.count(c) for c in (b" ", b"\t", b"\n", b"\v", b"\f", b"\r"))
    lines = [line for line in data.split(b"\n") if line and not line.isspace()]
    capitals = len(data) - len(data.translate(None, b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"))
    small = len(data) - len(data.translate(None, b"abcdefghijklmnopqrstuvwxyz"))
    symbols = len(data) - len(data.translate(None, b"#*$%&|<>"))
    return (
        len(words), len(text) - blanks, symbols, len(lines) - len(set(lines)), repeated_words(words),
        len(lines), capitals, small,
    )


def failed_bits(values: tuple[int, ...]) -> int:
    """The bits of the rules that the measured values fail."""
    names = dict(zip(MEASURES, values, strict=True))
    return sum(1 << i for i, (_, rule) in enumerate(COMPILED) if eval(rule, {}, names))  # noqa: S307


COMPILED = tuple((name, compile(rule, name, "eval")) for name, rule in RULES)


def ledger(docs: DataFrame) -> DataFrame:
    """doc_id, all measures and `failed`, one row per row of `docs`, in one pass over the texts.

    NULL and empty texts fail `few_words`. Repeated rows, NULL ids and further columns are no special
    case: each row is judged by its text alone. An empty table gives an empty ledger.
    """
    rules = RULES

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compiled = [compile(rule, name, "eval") for name, rule in rules]
        for batch in slices(batches):
            rows = [measure(t) for t in batch.column("text").to_pylist()]
            columns = list(zip(*rows, strict=True)) or [()] * len(MEASURES)
            arrays = {name: np.array(c, np.int64) for name, c in zip(MEASURES, columns, strict=True)}
            failed = np.zeros(len(rows), np.int64)
            for bit, rule in enumerate(compiled):
                failed |= np.asarray(eval(rule, {}, arrays)).astype(np.int64) << bit  # noqa: S307
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *(pa.array(a) for a in arrays.values()), pa.array(failed)],
                ["doc_id", *MEASURES, "failed"],
            )

    narrow = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"))
    return narrow.mapInArrow(run, SCHEMA)


def apply_policy(judged: DataFrame, policy: Policy = DEFAULT_POLICY) -> DataFrame:
    """The ledger with `policy`, `base_failed` and `kept`; no text is read."""
    return judged.withColumns({
        "policy": F.lit(policy.version),
        "base_failed": F.col("failed").bitwiseAND(F.lit(BASE)) != 0,
        "kept": F.col("failed").bitwiseAND(F.lit(policy.mask | BASE)) == 0,
    })


def ablation(judged: DataFrame, policy: Policy = DEFAULT_POLICY) -> DataFrame:
    """Per rule: failures under it, rejections it alone causes, and what is kept without it.

    One aggregate over the ledger's bits; the result has one row per rule of the policy.
    """
    hits = F.col("failed").bitwiseAND(F.lit(policy.mask))
    rules = [(name, BIT[name]) for name, _ in RULES if policy.mask & BIT[name]]
    counts = [F.count(F.lit(1)).alias("n"), F.count_if(hits == 0).alias("kept")]
    for name, bit in rules:
        counts += [
            F.count_if(hits.bitwiseAND(F.lit(bit)) != 0).alias(f"{name}_failed"),
            F.count_if(hits == bit).alias(f"{name}_alone"),
        ]
    row = F.explode(F.array(*[
        F.struct(
            F.lit(name).alias("rule"), F.col(f"{name}_failed").alias("failed"),
            F.col(f"{name}_alone").alias("failed_alone"),
            (F.col("kept") + F.col(f"{name}_alone")).alias("kept_without"),
        )
        for name, _ in rules
    ]))
    return judged.agg(*counts).select(F.lit(policy.version).alias("policy"), "n", row.alias("r")).select(
        "policy", "n", "r.*"
    )


def keep_good(docs: DataFrame, policy: Policy = DEFAULT_POLICY) -> DataFrame:
    """Rows of `docs` that the policy keeps, with all their columns."""
    mask = policy.mask | BASE

    def keeper() -> Keep:
        return lambda texts: [failed_bits(measure(t)) & mask == 0 for t in texts]

    return filter_rows(docs, keeper)


def rule_counts(rows: list[int]) -> Counter[str]:
    """How often each rule occurs in a list of ledger bits; for reading small samples."""
    return Counter(name for bits in rows for name, bit in BIT.items() if bits & bit)

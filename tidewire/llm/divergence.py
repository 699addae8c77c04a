"""Divergence of the sources of a language, from one frequent-pattern tree over its terms.

A term row lists the sources that hold the term, in source order, with the smoothed share of the term in
each. Rows are inserted into a prefix tree with their multiplicities: rows with equal first entries share
nodes. For two sources s, t the sum over all terms of f(p_s, p_t) is what it would be if no source held any
term, plus a correction for the terms one of them holds, plus a correction for the terms both hold. The last
is one number for each node and ancestor, times the number of rows through the node, so it is computed
once per combination and not once per term.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewire.session import materialize

MIN_DOCS = 10
SCALE = 1_000_000_000
TOP_TERMS = 10
HELD_ENTRIES = 200_000

# Everything that is no letter of ASCII and no byte of a longer character separates terms; A-Z become a-z.
_FOLDED = bytes(
    32 if b <= 0x40 or 0x5B <= b <= 0x60 or 0x7B <= b <= 0x7F else b + 32 if 0x41 <= b <= 0x5A else b
    for b in range(256)
)


def terms_of(text: str) -> list[bytes]:
    """The terms of a text in order: runs of letters and of characters beyond ASCII, A-Z lower-cased."""
    return text.encode("utf-8").translate(_FOLDED).split(b" ")


def count_terms(docs: DataFrame) -> DataFrame:
    """lang, source, term, n, docs: partial counts, added up over up to HELD_ENTRIES entries of a task."""

    def rows(held: dict) -> pa.RecordBatch:
        found = [(l, s, t.decode("utf-8"), n, d) for (l, s), terms in held.items() for t, (n, d) in terms.items()]
        columns = list(zip(*found, strict=True)) or [[]] * 5
        kinds = (pa.string(), pa.string(), pa.string(), pa.int64(), pa.int64())
        return pa.record_batch(
            [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["lang", "source", "term", "n", "docs"]
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[str, str], dict[bytes, list[int]]] = {}
        entries = 0
        for batch in batches:
            for lang, source, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                counts = Counter(terms_of(text))
                del counts[b""]
                terms = held.setdefault((lang, source), {})
                before = len(terms)
                for term, n in counts.items():
                    if (known := terms.get(term)) is None:
                        terms[term] = [n, 1]
                    else:
                        known[0] += n
                        known[1] += 1
                entries += len(terms) - before
                if entries >= HELD_ENTRIES:
                    yield rows(held)
                    held, entries = {}, 0
        yield rows(held)

    schema = "lang string, source string, term string, n bigint, docs bigint"
    return docs.select("lang", "source", "text").mapInArrow(run, schema)


def share(count: Column, total: Column, kept: Column) -> Column:
    """1 + floor(SCALE * (count + 2) / (total + 2 * kept)), exactly; NULL where nothing is kept."""
    big = lambda c: c.cast("decimal(19,0)")
    return F.call_function("div", F.lit(SCALE).cast("decimal(10,0)") * big(count + 2), big(F.nullif(total + 2 * kept, F.lit(0)))) + 1


def gap(p: Column, q: Column) -> Column:
    """floor((p - q)^2 / (p + q)); shares are at most SCALE + 1, so the square is a long."""
    return F.call_function("div", (p - q) * (p - q), p + q)


def gaps(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) * (p - q) // (p + q)


class Tree:
    """The open path of a prefix tree whose rows arrive in order, and what closed nodes add to pairs.

    Only the path from the root to the last row is held. A node closes when a row leaves it; its number of
    rows is then final, and each of its ancestors gives one correction.
    """

    def __init__(self, pending: int = 1 << 18):
        self.path: list[tuple[int, int, int]] = []
        self.counts: list[int] = []
        self.open = np.empty((64, 3), np.int64)
        self.nodes: list[tuple[int, int, int, int, int]] = []
        self.above: list[np.ndarray] = []
        self.waiting, self.pending = 0, pending
        self.sums: dict[tuple[int, int], int] = {}

    def insert(self, path: list[tuple[int, int, int]], count: int) -> None:
        shared, limit = 0, min(len(path), len(self.path))
        while shared < limit and path[shared] == self.path[shared]:
            shared += 1
        self.close(shared)
        if len(path) > len(self.open):
            self.open = np.concatenate([self.open, np.empty((len(path), 3), np.int64)])
        for depth in range(shared, len(path)):
            self.open[depth] = path[depth]
            self.counts.append(0)
        self.path = path
        for depth in range(len(path)):
            self.counts[depth] += count

    def close(self, depth: int) -> None:
        """Close the nodes at this depth and below."""
        for d in range(len(self.counts) - 1, depth - 1, -1):
            if d:
                self.nodes.append((*self.path[d], self.counts[d], d))
                self.above.append(self.open[:d].copy())
                self.waiting += d
        del self.counts[depth:]
        if self.waiting >= self.pending:
            self.settle()

    def settle(self) -> None:
        """Add the corrections of all closed nodes and ancestors to the sums of their pairs."""
        if not self.nodes:
            return
        nodes, t = np.array(self.nodes, np.int64), np.concatenate(self.above)
        s = np.repeat(nodes, nodes[:, 4], axis=0)
        p, z, q, y = s[:, 1], s[:, 2], t[:, 1], t[:, 2]
        value = (gaps(p, q) - gaps(p, y) - gaps(z, q) + gaps(z, y)) * s[:, 3]
        # Ancestors come earlier in source order, so a pair is always met the same way round.
        pair, inverse = np.unique((t[:, 0] << 32) | s[:, 0], return_inverse=True)
        total = np.zeros(len(pair), np.int64)
        np.add.at(total, inverse, value)
        for code, v in zip(pair.tolist(), total.tolist(), strict=True):
            key = (code >> 32, code & 0xFFFFFFFF)
            self.sums[key] = self.sums.get(key, 0) + v
        self.nodes, self.above, self.waiting = [], [], 0

    def take(self) -> dict[tuple[int, int], int]:
        """Close everything and hand over the sums."""
        self.close(0)
        self.settle()
        self.path, sums, self.sums = [], self.sums, {}
        return sums


def _pair_corrections(paths: DataFrame) -> DataFrame:
    """lang, a, b, value: partial sums of the corrections for terms that sources a < b both hold.

    `paths` has lang, path (source number, share, share without the term) and `rows`. They are dealt by range,
    so that a task's rows share as many nodes as possible; a node that lies on a border is only computed twice.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree, current = Tree(), None

        def out() -> pa.RecordBatch:
            sums = tree.take()
            return pa.record_batch([
                pa.array([current] * len(sums), pa.string()),
                pa.array([a for a, _ in sums], pa.int32()), pa.array([b for _, b in sums], pa.int32()),
                pa.array(list(sums.values()), pa.int64()),
            ], ["lang", "a", "b", "value"])

        for batch in batches:
            path = batch.column("path")
            entries = path.flatten()
            numbers = [entries.field(i).to_pylist() for i in range(3)]
            triples = list(zip(*numbers, strict=True))
            start = 0
            langs, rows = batch.column("lang").to_pylist(), batch.column("rows").to_pylist()
            for lang, size, count in zip(langs, pc.list_value_length(path).to_pylist(), rows, strict=True):
                if lang != current or len(tree.sums) > HELD_ENTRIES:
                    yield out()
                    current = lang
                tree.insert(triples[start : start + size], count)
                start += size
        yield out()

    ordered = paths.repartitionByRange("lang", "path").sortWithinPartitions("lang", "path")
    return ordered.select("lang", "path", "rows").mapInArrow(run, "lang string, a int, b int, value bigint")


def audit(docs: DataFrame, min_docs: int = MIN_DOCS, top_terms: int = TOP_TERMS) -> DataFrame:
    """lang, source, part, item, value, rank: how far the sources of each language lie apart, and by which terms.

    Part `pair` has every other source of the language, part `term` the `top_terms` terms that the source
    holds more of than the language does. A NULL text, lang or source is read as ''. A group without kept
    terms takes part with counts of 0; a language without any gives 0 for all its pairs. Texts are read whole,
    each row is a document of its own (repeated rows count again), other columns are not looked at. Equal
    values are ranked by the UTF-8 order of the item. An empty table gives an empty result.
    """
    read = docs.select(*[F.coalesce(F.col(c), F.lit("")).alias(c) for c in ("lang", "source", "text")])
    counted = count_terms(read).groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    rows = counted.groupBy("lang", "term").agg(
        F.sum("n").alias("total"), F.sum("docs").alias("docs"), F.collect_list(F.struct("source", "n")).alias("held")
    )
    terms = materialize(rows.where(F.col("docs") >= min_docs).drop("docs"), "kept-terms")
    held = terms.select("lang", "term", "total", F.inline("held"))

    of_lang = terms.groupBy("lang").agg(F.count(F.lit(1)).alias("kept"), F.sum("total").alias("lang_total"))
    of_group = held.groupBy("lang", "source").agg(F.sum("n").alias("group_total"))
    number = F.row_number().over(Window.partitionBy("lang").orderBy("source"))
    groups = (
        read.select("lang", "source").distinct()
        .join(of_lang, "lang", "left").join(of_group, ["lang", "source"], "left")
        .fillna(0, ["kept", "lang_total", "group_total"])
        .withColumns({"number": number, "none": share(F.lit(0), F.col("group_total"), F.col("kept"))})
    )
    groups = materialize(groups, "groups")
    shares = materialize(
        held.join(groups, ["lang", "source"]).select(
            "lang", "source", "term", "number", "none",
            share(F.col("n"), F.col("group_total"), F.col("kept")).alias("p"),
            share(F.col("total"), F.col("lang_total"), F.col("kept")).alias("q"),
        ), "shares",
    )

    best = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    over = shares.where("p > q").select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), gap(F.col("p"), F.col("q")).alias("value"))
    term_part = over.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top_terms)

    entry = F.struct("number", F.col("p").alias("p"), F.col("none").alias("z"))
    paths = (
        shares.groupBy("lang", "term").agg(F.sort_array(F.collect_list(entry)).alias("path"))
        .groupBy("lang", "path").agg(F.count(F.lit(1)).alias("rows"))
    )
    both = _pair_corrections(paths)
    one = (
        shares.groupBy("lang", "number", "none", "p").agg(F.count(F.lit(1)).alias("rows"))
        .join(groups.select("lang", F.col("number").alias("other"), F.col("none").alias("y")), "lang")
        .where("number <> other")
        .select("lang", F.least("number", "other").alias("a"), F.greatest("number", "other").alias("b"),
                (F.col("rows") * (gap(F.col("p"), F.col("y")) - gap(F.col("none"), F.col("y")))).alias("value"))
    )
    side = lambda n: groups.select("lang", "kept", F.col("number").alias(n), F.col("none").alias(f"z{n}"))
    empty = side("a").join(side("b").drop("kept"), "lang").where("a < b").select(
        "lang", "a", "b",
        F.when(F.col("kept") == 0, 0).otherwise(F.col("kept") * gap(F.col("za"), F.col("zb"))).cast("bigint").alias("value"),
    )
    sums = both.unionByName(one).unionByName(empty).groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))
    turned = sums.select("lang", F.col("a").alias("number"), F.col("b").alias("other"), "value").unionByName(
        sums.select("lang", F.col("b").alias("number"), F.col("a").alias("other"), "value")
    )
    names = groups.select("lang", "number", "source")
    others = groups.select("lang", F.col("number").alias("other"), F.col("source").alias("item"))
    pair_part = (
        turned.join(names, ["lang", "number"]).join(others, ["lang", "other"])
        .select("lang", "source", F.lit("pair").alias("part"), "item", "value")
        .withColumn("rank", F.row_number().over(best))
    )
    return pair_part.unionByName(term_part)

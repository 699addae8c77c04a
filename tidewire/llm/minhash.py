"""Near-duplicates by improved consistent weighted sampling over TF-IDF weighted word shingles.

1. Words are counted per hash bucket: in how many documents each occurs. A shingle of five words weighs
   its count in the text times the mean inverse document frequency of its words.
2. Each text gets K consistent weighted samples, cut into bands; texts with a band in common are
   candidates.
3. Candidates are verified on their whole texts: the weighted Jaccard similarity of the two profiles, or
   the plain one of their shingle sets, must reach the threshold.
4. Linked texts form components. A bucket is first checked as a star around its smallest member; then
   members that are still apart are compared with all others of the bucket whose samples agree enough.

Texts with equal words are one node from the start, so copies never meet in a bucket.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewire.llm.common import slices, worker_cache
from tidewire.llm.components import components
from tidewire.session import materialize

LAST = 2**63 - 1
MIX = np.uint64(0x9E3779B97F4A7C15)
MIX2 = np.uint64(0xD6E8FEB86659FD93)
TABLE_BITS = 16


@dataclass(frozen=True)
class MinHashConfig:
    """Shingle width, similarity, bands x rows samples, and buckets of the word statistics.

    With 22 bands of 4 rows a pair at similarity 0.8 is missed about once in 100,000, one at 0.24 becomes a
    candidate once in fourteen. `least_agree` is the share of equal samples below which late candidates
    are not verified; at 0.8 a share under 0.6 is more than four deviations away.
    """

    width: int = 5
    threshold: float = 0.8
    bands: int = 22
    rows: int = 4
    word_bits: int = 16
    least_agree: float = 0.6
    seed: int = 1

    @property
    def samples(self) -> int:
        return self.bands * self.rows


DEFAULT = MinHashConfig()


class WordHashes:
    """64-bit hashes of words with a memory of `limit` words."""

    def __init__(self, limit: int = 300_000):
        self.known: dict[bytes, int] = {}
        self.limit = limit

    def of(self, words: list[bytes]) -> np.ndarray:
        found = list(map(self.known.get, words))
        if None in found:
            if len(self.known) > self.limit:
                self.known.clear()
            missing = {w for w, h in zip(words, found, strict=True) if h is None}
            self.known.update((w, xxhash.xxh3_64_intdigest(w)) for w in missing)
            found = [
                self.known[w] if h is None else h for w, h in zip(words, found, strict=True)
            ]
        return np.array(found, np.uint64)


def shingles(words: np.ndarray, idf: np.ndarray, width: int, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes, sorted, and their weights; a shorter text is one shingle."""
    n = max(1, len(words) - width + 1)
    size = min(width, len(words))
    h, weight = np.zeros(n, np.uint64), np.zeros(n)
    word_idf = idf[(words >> np.uint64(64 - bits)).astype(np.int64)]
    for i in range(size):
        h = (h ^ words[i : i + n]) * MIX
        h ^= h >> np.uint64(29)
        weight += word_idf[i : i + n]
    keys, first, counts = np.unique(h * MIX2, return_index=True, return_counts=True)
    return keys, (weight[first] / size * counts).astype(np.float32)


def similar(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """The larger of the weighted and the plain Jaccard similarity of two profiles."""
    _, i, j = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    shared = np.minimum(a[1][i], b[1][j]).sum(dtype=np.float64)
    weighted = shared / (a[1].sum(dtype=np.float64) + b[1].sum(dtype=np.float64) - shared)
    return max(weighted, len(i) / (len(a[0]) + len(b[0]) - len(i)))


class Sampler:
    """Improved consistent weighted sampling with its random numbers taken from tables.

    For hash number k a shingle's r, c and beta are read at a slot that its hash and k choose. The sample is the
    shingle with the smallest ln a, of several in one slot that with the smallest hash, and its t: 32 bits of the
    shingle's hash, mixed with ln a, which for a given shingle is a function of t. So long texts that fill the same
    slots with different shingles have different samples.
    """

    def __init__(self, samples: int, seed: int):
        rng = np.random.default_rng(seed)
        size = 1 << TABLE_BITS
        r = rng.gamma(2, 1, size)
        beta = rng.uniform(0, 1, size)
        self.inverse = (1 / r).astype(np.float32)
        self.r, self.beta = r.astype(np.float32), beta.astype(np.float32)
        self.base = (np.log(rng.gamma(2, 1, size)) - r * (1 - beta)).astype(np.float32)
        self.odd = rng.integers(0, 2**63, samples, dtype=np.uint64) * np.uint64(2) + np.uint64(1)

    def sample(self, keys: np.ndarray, weights: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """One row of samples per text; text i holds the shingles from starts[i] on, sorted by hash."""
        out = np.empty((len(starts), len(self.odd)), np.uint32)
        log_weight = np.log(weights)
        text = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(keys))))
        short = (keys >> np.uint64(32)).astype(np.uint32)
        for k, odd in enumerate(self.odd):
            slot = ((keys * odd) >> np.uint64(64 - TABLE_BITS)).astype(np.intp)
            t = np.floor(log_weight * self.inverse[slot] + self.beta[slot])
            value = self.base[slot] - self.r[slot] * t
            least = np.minimum.reduceat(value, starts)
            hit = np.flatnonzero(value == least[text])
            first = hit[np.append(True, text[hit[1:]] != text[hit[:-1]])]
            out[:, k] = short[first] ^ least.view(np.uint32)
        return out


def document_frequencies(docs: DataFrame, config: MinHashConfig) -> np.ndarray:
    """Mean-one inverse document frequencies per word bucket: at most 2 ** word_bits numbers."""
    bits = config.word_bits

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = worker_cache("word hashes", WordHashes)
        total, n = np.zeros(1 << bits, np.int64), 0
        for batch in slices(batches):
            for text in batch.column("text").to_pylist():
                words = (text or "").encode().split()
                if words:
                    n += 1
                    total[np.unique(hashes.of(words) >> np.uint64(64 - bits)).astype(np.int64)] += 1
        found = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(found, -1)), pa.array(np.append(total[found], n))], ["bucket", "n"]
        )

    sums = docs.select(F.col("text").cast("string")).mapInArrow(count, "bucket bigint, n bigint").groupBy(
        "bucket"
    ).agg(F.sum("n").alias("n")).toArrow()
    bucket, n = sums.column("bucket").to_numpy(), sums.column("n").to_numpy()
    frequency = np.zeros(1 << bits)
    frequency[bucket[bucket >= 0]] = n[bucket >= 0]
    total = n[bucket < 0].sum()
    return (1 + np.log((1 + total) / (1 + frequency))).astype(np.float32)


def signatures(docs: DataFrame, idf: np.ndarray, config: MinHashConfig) -> DataFrame:
    """doc, text_hash, node (hash of the words), bands and samples of every row.

    `doc` is doc_id, or the largest long where that is NULL. Without a word the last three are NULL.
    """
    shared = docs.sparkSession.sparkContext.broadcast(idf)
    samples, rows, width, bits, seed = config.samples, config.rows, config.width, config.word_bits, config.seed

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, sampler = worker_cache("word hashes", WordHashes), Sampler(samples, seed)

        def sign_texts(keys: list, weights: list, starts: list[int]) -> tuple[np.ndarray, list[bytes]]:
            if not starts:
                return np.empty((0, 0)), []
            sampled = sampler.sample(np.concatenate(keys), np.concatenate(weights), np.array(starts))
            band = np.zeros((len(starts), samples // rows), np.uint64)
            for r in range(rows):
                band = (band ^ sampled[:, r::rows]) * MIX
                band ^= band >> np.uint64(31)
            band = (band + np.arange(band.shape[1], dtype=np.uint64)) * MIX2
            short = ((sampled * np.uint32(0x9E3779B1)) >> np.uint32(16)).astype("<u2")
            return band.astype(np.int64), [t.tobytes() for t in short]

        for batch in slices(batches, 64):
            keys, weights, starts, nodes, used = [], [], [], [None] * batch.num_rows, 0
            at = []
            for i, text in enumerate(batch.column("text").to_pylist()):
                words = (text or "").encode().split()
                if words:
                    h, w = shingles(hashes.of(words), shared.value, width, bits)
                    keys.append(h)
                    weights.append(w)
                    starts.append(used)
                    used += len(h)
                    nodes[i] = xxhash.xxh3_64_intdigest(b" ".join(words)) - 2**63
                    at.append(i)
            bands, short = [None] * batch.num_rows, [None] * batch.num_rows
            for i, b, t in zip(at, *sign_texts(keys, weights, starts), strict=True):
                bands[i], short[i] = b, t
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc"), batch.column("text_hash"), pa.array(nodes, pa.int64()),
                 pa.array(bands, pa.list_(pa.int64())), pa.array(short, pa.binary())],
                ["doc", "text_hash", "node", "bands", "samples"],
            )

    rows_in = docs.select(
        F.coalesce(F.col("doc_id").cast("bigint"), F.lit(LAST)).alias("doc"),
        F.xxhash64("text").alias("text_hash"), F.col("text").cast("string"),
    )
    return rows_in.mapInArrow(
        sign, "doc bigint, text_hash bigint, node bigint, bands array<bigint>, samples binary"
    )


def verify(pairs: DataFrame, texts: DataFrame, idf: np.ndarray, config: MinHashConfig) -> DataFrame:
    """The pairs (u, v) whose texts reach the threshold. `texts` has node and text.

    A node with many pairs is dealt to groups of a thousand, each with its own copy of that node's text;
    a task streams through the groups and holds one profile at a time.
    """
    shared = pairs.sparkSession.sparkContext.broadcast(idf)
    threshold, width, bits = config.threshold, config.width, config.word_bits
    sizes = pairs.groupBy("u").agg(F.ceil(F.count(F.lit(1)) / 1000).cast("int").alias("parts"))
    members = pairs.join(sizes, "u").select(
        "u", F.pmod(F.xxhash64("v"), F.col("parts")).cast("int").alias("part"), F.col("v").alias("node")
    )
    heads = sizes.select("u", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.col("u").alias("node"))
    dealt = members.unionByName(heads).join(texts, "node").repartition("u", "part").sortWithinPartitions(
        "u", "part", F.col("node") != F.col("u")
    )

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, head, profile = worker_cache("word hashes", WordHashes), None, None
        for batch in slices(batches):
            u, v = [], []
            columns = (batch.column(c).to_pylist() for c in ("u", "node", "text"))
            for a, b, text in zip(*columns, strict=True):
                own = shingles(hashes.of((text or "").encode().split()), shared.value, width, bits)
                if a == b:
                    head, profile = a, own
                elif a == head and similar(profile, own) >= threshold:
                    u.append(a)
                    v.append(b)
            yield pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], ["u", "v"])

    return dealt.select("u", "node", "text").mapInArrow(compare, "u bigint, v bigint")


def late_links(
    members: DataFrame, labels: DataFrame, samples: DataFrame, texts: DataFrame, idf: np.ndarray, config: MinHashConfig
) -> DataFrame:
    """Links (u, v) between members of a bucket that are still in different components.

    In each bucket the largest component need not be compared with itself: every other member meets
    every member, in blocks that bring both sides' texts. Pairs are looked at once, in the first band they
    share, where their samples agree often enough, most similar first; those whose components have
    meanwhile met in the block are passed over. Only links leave a task, so nothing is emitted for pairs.
    """
    named = members.join(labels, "node", "left").withColumn("component", F.coalesce("component", "node"))
    per = named.groupBy("bucket", "component").agg(F.count(F.lit(1)).alias("n"))
    buckets = per.groupBy("bucket").agg(
        F.max_by("component", F.struct("n", "component")).alias("main"), F.sum("n").alias("n"),
        (F.sum("n") - F.max("n")).alias("apart"),
    ).where((F.col("apart") > 0) & (F.col("n") > 2))
    rows = named.join(materialize(buckets, "open-buckets"), "bucket").join(samples, "node").withColumns({
        "lefts": F.ceil(F.col("apart") / 256).cast("int"), "rights": F.ceil(F.col("n") / 1024).cast("int"),
        "minor": F.col("component") != F.col("main"),
    })
    h = F.xxhash64(F.lit("block"), "node")
    i, j = F.pmod(h, F.col("lefts")).cast("int"), F.pmod(h, F.col("rights")).cast("int")
    base = ("bucket", "band", "node", "component", "minor", "samples")
    each = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    left = rows.where("minor").select(*base, F.lit(True).alias("left"), i.alias("i"), each("rights").alias("j"))
    right = rows.select(*base, F.lit(False).alias("left"), each("lefts").alias("i"), j.alias("j"))
    ordered = left.unionByName(right).join(texts, "node").repartition("bucket", "i", "j").sortWithinPartitions(
        "bucket", "i", "j"
    )
    shared = members.sparkSession.sparkContext.broadcast(idf)
    least, threshold = int(np.ceil(config.least_agree * config.samples)), config.threshold
    width, bits, bands = config.width, config.word_bits, config.bands

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = worker_cache("word hashes", WordHashes)
        group: list[tuple] = []
        names = ("bucket", "i", "j", "left", "band", "node", "component", "minor", "samples", "text")
        for batch in slices(batches):
            found: list[tuple[int, int]] = []
            for row in zip(*(batch.column(c).to_pylist() for c in names), strict=True):
                if group and row[:3] != group[-1][:3]:
                    found += links(group, hashes)
                    group = []
                group.append(row)
            yield to_batch(found)
        yield to_batch(links(group, hashes))

    def to_batch(found: list[tuple[int, int]]) -> pa.RecordBatch:
        u, v = zip(*found, strict=True) if found else ((), ())
        return pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], ["u", "v"])

    def links(group: list[tuple], hashes: WordHashes) -> list[tuple[int, int]]:
        own, other = ([r for r in group if r[3] is side] for side in (True, False))
        if not own or not other:
            return []
        band = group[0][4]
        signs = np.stack([np.frombuffer(r[8], "<u2") for r in other])
        nodes, comps, minor = (np.array([r[k] for r in other]) for k in (5, 6, 7))
        profiles: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        parent: dict[int, int] = {}

        def root(c: int) -> int:
            while parent.get(c, c) != c:
                c = parent[c]
            return c

        def profile(row: tuple) -> tuple[np.ndarray, np.ndarray]:
            if row[5] not in profiles:
                words = hashes.of((row[9] or "").encode().split())
                profiles[row[5]] = shingles(words, shared.value, width, bits)
            return profiles[row[5]]

        found = []
        for row in own:
            equal = np.frombuffer(row[8], "<u2") == signs
            agree = equal.sum(axis=1)
            whole = equal.reshape(len(signs), bands, -1).all(axis=2)
            here = whole[:, band] & ~whole[:, :band].any(axis=1) & (agree >= least) & (comps != row[6])
            here &= ~minor | (nodes > row[5])
            for k in np.flatnonzero(here)[np.argsort(-agree[here], kind="stable")]:
                a, b = root(row[6]), root(int(comps[k]))
                if a != b and similar(profile(row), profile(other[k])) >= threshold:
                    parent[a] = b
                    found.append((row[5], int(nodes[k])))
        return found

    return ordered.mapInArrow(run, "u bigint, v bigint")


def linked(docs: DataFrame, config: MinHashConfig = DEFAULT) -> DataFrame:
    """doc, text_hash, node and `first`, the smallest (doc, text_hash) of the row's class, and its size."""
    docs = docs.select("doc_id", "text")
    idf = document_frequencies(docs, config)
    signed = materialize(signatures(docs, idf, config), "signatures")
    nodes = materialize(
        signed.where("node IS NOT NULL").groupBy("node").agg(
            F.min(F.struct("doc", "text_hash")).alias("first"), F.count(F.lit(1)).alias("n_rows"),
            F.first("bands").alias("bands"), F.first("samples").alias("samples"),
        ),
        "nodes",
    )
    members = nodes.select("node", F.posexplode("bands").alias("band", "bucket"))
    stars = members.groupBy("bucket").agg(F.min("node").alias("u"), F.count(F.lit(1)).alias("n")).where("n > 1")
    members = materialize(members.join(stars, "bucket"), "members")
    texts = docs.select(
        F.coalesce(F.col("doc_id").cast("bigint"), F.lit(LAST)).alias("doc"), F.xxhash64("text").alias("text_hash"),
        "text",
    )
    wanted = members.select("node").distinct().join(nodes, "node").select("node", "first.*")
    texts = materialize(wanted.join(texts, ["doc", "text_hash"]).select("node", "text"), "texts")
    pairs = members.where("node <> u").select("u", F.col("node").alias("v")).distinct()
    labels = components(materialize(verify(pairs, texts, idf, config), "links"))
    places = members.where("n > 2").select("bucket", "band", "node")
    late = late_links(places, labels, nodes.select("node", "samples"), texts, idf, config)
    labels = components(materialize(late, "late-links"), labels)
    named = nodes.select("node", "first", "n_rows").join(labels, "node", "left").withColumn(
        "component", F.coalesce("component", "node")
    )
    classes = named.groupBy("component").agg(F.min("first").alias("first"), F.sum("n_rows").alias("size"))
    of_node = named.select("node", "component").join(materialize(classes, "classes"), "component").drop("component")
    own = F.struct("doc", "text_hash")
    return signed.select("doc", "text_hash", "node").join(materialize(of_node, "node-classes"), "node", "left").select(
        "doc", "text_hash", "node", F.coalesce("first", own).alias("first"), F.coalesce("size", F.lit(1)).alias("size")
    )


def near_duplicates(docs: DataFrame, config: MinHashConfig = DEFAULT) -> DataFrame:
    """doc_id, class_id (smallest doc_id of the class) and class_size of every row of `docs`.

    Texts with equal words are one class; so are texts linked, directly or over others, by a similarity
    of at least the threshold. A text of fewer than five words is one shingle; a NULL text or one
    without words is a class of its own. Rows without doc_id are compared like others and come last.
    """
    rows = linked(docs, config)
    doc_id = lambda c: F.nullif(F.col(c), F.lit(LAST))
    return rows.select(
        doc_id("doc").alias("doc_id"), doc_id("first.doc").alias("class_id"), F.col("size").alias("class_size")
    )


def keep_first(docs: DataFrame, config: MinHashConfig = DEFAULT) -> DataFrame:
    """The columns of `docs`; of each class the row with the smallest doc_id, and one of equal rows."""
    rows = linked(docs, config)
    kept = rows.where((F.col("doc") == F.col("first.doc")) & (F.col("text_hash") == F.col("first.text_hash")))
    kept = kept.select(F.col("doc").alias("__doc"), F.col("text_hash").alias("__text")).distinct()
    key = {
        "__doc": F.coalesce(F.col("doc_id").cast("bigint"), F.lit(LAST)), "__text": F.xxhash64("text"),
    }
    return docs.withColumns(key).join(kept, ["__doc", "__text"], "left_semi").dropDuplicates(
        ["__doc", "__text"]
    ).drop("__doc", "__text")

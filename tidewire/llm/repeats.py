"""Removal of passages that occur before, byte by byte, by suffix arrays built in external memory.

A byte goes if a string of `length` bytes that covers it also starts earlier: in a document with a smaller id,
or further to the front of the same one. Equal strings have to meet in one task. Each string of that length
therefore has an anchor, the least of the hashes of its `gram`-byte pieces; equal strings have equal anchors. Strings
that follow one another and have the same piece for an anchor form a span. Anchors that occur once cannot
belong to a repeated string; of spans with equal bytes only the first can hold first occurrences, and
the others go as a whole. Strings of a span that have the anchor at about the same place also share the bytes around it,
their core: of spans with one anchor in different surroundings, only strings whose core occurs again are left.
They are dealt to shards by anchor, and each shard's suffixes are sorted with their common prefixes (`suffixes`). In a run of
suffixes with `length` bytes in common all but the earliest repeat it.

An anchor that occurs in very many surroundings, as in a common line, is no key to deal by: its spans are split into
parts with cores of their own, these again, down to single strings, and the cores are the keys.

Spans are compared by 128 bits of hashes, strings in a shard by their bytes.
"""

from __future__ import annotations

import tempfile
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidewire.llm import suffixes
from tidewire.llm.common import slices
from tidewire.session import materialize


@dataclass(frozen=True)
class RepeatConfig:
    """Bytes of a repeated string and of the pieces that anchor it; bytes of text hashed at once and anchors
    held before they leave a task; contexts of a key beyond which its spans are split, and the share of the documents
    (one in so many) on which contexts are estimated; bytes a shard, and entries that its sort may hold in memory."""

    length: int = 100
    gram: int = 24
    slice_bytes: int = 1 << 20
    held: int = 1 << 18
    contexts: int = 2048
    share: int = 64
    shard_bytes: int = 4 << 20
    memory: int = 1 << 22


DEFAULT = RepeatConfig()

# A place is a start in its document and the number of strings of a span, in one long.
PACK = 1 << 10
# Parts a span is split into. Until spans are judged, a place has the strings of each part, from the last to the first.
PARTS = 4
_BITS = 8
_COUNTS = PARTS * _BITS
_MULTIPLIER = 0x9E3779B97F4A7C15
_INVERSE = pow(_MULTIPLIER, -1, 1 << 64)


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(32))


class Hashes:
    """Hashes of all substrings of a piece of text, from sums of its bytes times powers."""

    def __init__(self, size: int):
        ones = np.full(size + 1, _MULTIPLIER, np.uint64)
        ones[0] = 1
        self.powers = np.cumprod(ones, dtype=np.uint64)
        ones[1:] = _INVERSE
        self.inverse = np.cumprod(ones, dtype=np.uint64)
        self.bytes = mixed(np.arange(1, 257, dtype=np.uint64))

    def load(self, data: np.ndarray) -> None:
        terms = self.bytes[data] * self.powers[: len(data)]
        self.sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(terms, dtype=np.uint64)])

    def pieces(self, size: int) -> np.ndarray:
        """Of every piece of `size` bytes."""
        n = len(self.sums) - size
        return mixed((self.sums[size:] - self.sums[:n]) * self.inverse[:n])

    def ranges(self, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        return mixed((self.sums[stop] - self.sums[start]) * self.inverse[start] + (stop - start).astype(np.uint64))


def least_in_windows(x: np.ndarray, size: int) -> np.ndarray:
    done = 1
    while 2 * done <= size:
        x = np.minimum(x[:-done], x[done:])
        done *= 2
    rest = size - done
    return np.minimum(x[: len(x) - rest], x[rest:]) if rest else x


@dataclass
class Spans:
    """Where anchors are, first strings and strings of spans, and which places of the anchor in a string
    they take: from `low` to below `high`. `key` is the anchor's hash or that of the core."""

    at: np.ndarray
    begin: np.ndarray
    count: np.ndarray
    low: np.ndarray
    high: np.ndarray
    key: np.ndarray

    def __getitem__(self, rows: np.ndarray) -> Spans:
        return Spans(*(c[rows] for c in vars(self).values()))

    def part(self, number: int, hashes: Hashes, length: int) -> Spans:
        """A part of each span, with the core of its strings for a key; without strings where it has none."""
        width = self.high - self.low
        low, high = self.low + width * number // PARTS, self.low + width * (number + 1) // PARTS
        begin = np.maximum(self.begin, self.at - high + 1)
        count = np.maximum(0, np.minimum(self.begin + self.count, self.at - low + 1) - begin)
        some = count > 0
        core = hashes.ranges(np.where(some, self.at - low, 0), np.where(some, self.at - high + 1 + length, 0))
        return Spans(self.at, begin, count, low, high, mixed(core + low.astype(np.uint64)))


def joined(parts: list[Spans]) -> Spans:
    return parts[0] if len(parts) == 1 else Spans(*map(np.concatenate, zip(*(vars(p).values() for p in parts), strict=True)))


def among(keys: np.ndarray, some: np.ndarray) -> np.ndarray:
    """Which of the keys are in a sorted list."""
    return some[np.minimum(np.searchsorted(some, keys), len(some) - 1)] == keys if len(some) else np.zeros(len(keys), bool)


def spans(data: np.ndarray, ends: np.ndarray, hashes: Hashes, config: RepeatConfig, hot: np.ndarray) -> Spans | None:
    """Of texts that lie one after another; what has a hot key is split. Leaves the sums of the bytes in `hashes`."""
    length, gram = config.length, config.gram
    if len(data) < length:
        return None
    starts = np.append(0, ends[:-1])
    hashes.load(data)
    pieces = hashes.pieces(gram)
    low = np.uint64((1 << len(data).bit_length()) - 1)
    # The leftmost piece of those with the least hash, whose upper bits decide.
    order = (pieces & ~low) | np.arange(len(pieces), dtype=np.uint64)
    at = (least_in_windows(order, length - gram + 1) & low).astype(np.int64)
    inside = np.zeros(len(at) + 1, np.int8)
    whole = ends - starts >= length
    np.add.at(inside, starts[whole], 1)
    np.add.at(inside, ends[whole] - length + 1, -1)
    string = np.flatnonzero(np.cumsum(inside[:-1], dtype=np.int8))
    if not len(string):
        return None
    at = at[string]
    new = np.append(True, (string[1:] != string[:-1] + 1) | (at[1:] != at[:-1]))
    first = np.flatnonzero(new)
    count = np.diff(np.append(first, len(string)))
    at = at[first]
    left = Spans(at, string[first], count, np.zeros_like(at), np.full_like(at, length - gram + 1), pieces[at])
    done = []
    while (split := among(left.key, hot) & (left.high - left.low > 1)).any():
        done.append(left[~split])
        left = left[split]
        parts = [left.part(i, hashes, length) for i in range(PARTS)]
        left = joined([p[p.count > 0] for p in parts])
    return joined([*done, left])


def columns_of(found: Spans, ends: np.ndarray, hashes: Hashes, config: RepeatConfig) -> tuple[np.ndarray, ...]:
    """Text, start in it, strings of each part, key, hash, and 16 bits of each part's core (0 where it has no strings)."""
    span = hashes.ranges(found.begin, found.begin + found.count + config.length - 1)
    counts, cores = np.zeros(len(span), np.int64), np.zeros(len(span), np.uint64)
    for i in range(PARTS):
        part = found.part(i, hashes, config.length)
        counts |= part.count << (_BITS * i)
        core = np.where(part.count > 0, np.maximum(part.key >> np.uint64(48), np.uint64(1)), np.uint64(0))
        cores |= core << np.uint64(16 * i)
    text = np.searchsorted(ends, found.begin, "right")
    return text, found.begin - np.append(0, ends[:-1])[text], counts, found.key.view(np.int64), span.view(np.int64), cores.view(np.int64)


def bytes_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts, and where each begins and the last one ends in them."""
    texts = texts.cast(pa.large_binary())
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    return np.frombuffer(texts.buffers()[2], np.uint8) if texts.buffers()[2] else np.zeros(0, np.uint8), offsets


def in_slices(batch: pa.RecordBatch, size: int, overlap: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Bytes of a few texts at a time, where each ends, its row, and what of it came in earlier slices.

    A text of more than `size` bytes is cut into pieces that overlap.
    """
    data, offsets = bytes_of(batch.column("text"))
    row = 0
    while row < batch.num_rows:
        begin = offsets[row]
        stop = max(row + 1, int(np.searchsorted(offsets, begin + size, "right")) - 1)
        end = offsets[stop]
        if end - begin <= size:
            rows = np.arange(row, stop)
            yield data[begin:end], offsets[row + 1 : stop + 1] - begin, rows, np.zeros(len(rows), np.int64)
        else:
            for at in range(begin, end - overlap, size):
                piece = data[at : min(at + size + overlap, end)]
                yield piece, np.array([len(piece)]), np.array([row]), np.array([at - begin])
        row = stop


def hot_keys(docs: DataFrame, config: RepeatConfig) -> np.ndarray:
    """Keys that occur in very many contexts, in order; estimated on a share of the documents (id, h, text).

    They only say how spans are dealt: with any other list, or none, the result is the same.
    """
    width = config.length - config.gram + 1

    def counted(held: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
        key, span = (np.concatenate(c) for c in zip(*held, strict=True))
        order = np.lexsort((span, key))
        key, span = key[order], span[order]
        new = np.append(True, (key[1:] != key[:-1]) | (span[1:] != span[:-1]))[: len(key)]
        key, n = np.unique(key[new], return_counts=True)
        return pa.record_batch([pa.array(key.view(np.int64)), pa.array(n)], ["key", "n"])

    def contexts(hot: np.ndarray):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            hashes = Hashes(config.slice_bytes + config.length)
            held, n = [], 0
            for batch in batches:
                for data, ends, _, _ in in_slices(batch, config.slice_bytes, config.length - 1):
                    if (found := spans(data, ends, hashes, config, hot)) is not None:
                        # Whole spans are counted in the first round, their parts in the others.
                        size = found.high - found.low
                        found = found[(size > 1) & ((size < width) if len(hot) else True)]
                        held.append((found.key, hashes.ranges(found.begin, found.begin + found.count + config.length - 1)))
                        n += len(found.key)
                    if n >= config.held:
                        yield counted(held)
                        held, n = [], 0
            if held:
                yield counted(held)

        return run

    # In few files, since it is read once a round.
    some = materialize(docs.where(F.rand(0) * config.share < 1).select("id", "h", "text").hint("rebalance"), "share")
    hot = np.zeros(0, np.uint64)
    while True:
        sums = some.mapInArrow(contexts(hot), "key bigint, n bigint").groupBy("key").agg(F.sum("n").alias("n"))
        rows = sums.where(F.col("n") * config.share > config.contexts).select("key").collect()
        more = np.union1d(hot, np.array([r["key"] for r in rows], np.int64).view(np.uint64))
        if len(more) == len(hot):
            return hot
        hot = more


REMOVE, SEARCH = 0, 1
_MARKS = "dealt bigint, span bigint, cores bigint, id bigint, h bigint, place bigint"


def marks_of(held: list[tuple[np.ndarray, ...]]) -> pa.RecordBatch:
    """Spans with equal bytes in one task: the first stays to be compared, the others go right away: their cores are 0."""
    id_, h, place, key, span, cores = (np.concatenate(c) for c in zip(*held, strict=True))
    order = np.argsort(key ^ (span << 1), kind="stable")
    same = (key[order][1:] == key[order][:-1]) & (span[order][1:] == span[order][:-1])
    again = np.zeros(len(order), bool)
    again[1:] |= same
    again[:-1] |= same
    goes, keep = np.zeros(len(order), bool), np.ones(len(order), bool)
    some = order[again]
    if len(some):
        some = some[np.lexsort((place[some], h[some], id_[some], span[some], key[some]))]
        new = np.append(True, (key[some][1:] != key[some][:-1]) | (span[some][1:] != span[some][:-1]))
        first = some[np.maximum.accumulate(np.where(new, np.arange(len(some)), 0))]
        # A repeated row has its spans where the first one has them.
        there = (id_[some] == id_[first]) & (h[some] == h[first]) & (place[some] == place[first])
        goes[some[~there]] = True
        keep[some[there & (some != first)]] = False
    anywhere = mixed(id_.view(np.uint64) ^ mixed(place.view(np.uint64) ^ mixed(h.view(np.uint64)))).view(np.int64)
    columns = (np.where(goes, anywhere, key), span, np.where(goes, 0, cores), id_, h, place)
    return pa.record_batch([pa.array(c[keep]) for c in columns], ["dealt", "span", "cores", "id", "h", "place"])


def mark_spans(docs: DataFrame, config: RepeatConfig, hot: np.ndarray) -> DataFrame:
    """The spans of every text (id, h, text), those a task can tell to be repeats apart from the others."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = Hashes(config.slice_bytes + config.length)
        held, n = [], 0
        for batch in batches:
            ids, hs = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("id", "h"))
            for data, ends, rows, before in in_slices(batch, config.slice_bytes, config.length - 1):
                if (found := spans(data, ends, hashes, config, hot)) is not None:
                    text, start, counts, key, span, cores = columns_of(found, ends, hashes, config)
                    row = rows[text]
                    held.append((ids[row], hs[row], (start + before[text]) << _COUNTS | counts, key, span, cores))
                    n += len(row)
                if n >= config.held:
                    yield marks_of(held)
                    held, n = [], 0
        if held:
            yield marks_of(held)

    return docs.select("id", "h", "text").mapInArrow(run, _MARKS)


def strings_of(place: np.ndarray, first: np.ndarray | int, last: np.ndarray | int) -> np.ndarray:
    """The place of the strings of some parts of a span, from the `first` part to the `last`."""
    start, count = place >> _COUNTS, np.zeros(len(place), np.int64)
    for i in range(PARTS):
        n = place >> (_BITS * i) & ((1 << _BITS) - 1)
        # The strings of later parts begin further to the front.
        start = start + np.where(i > last, n, 0)
        count += np.where((first <= i) & (i <= last), n, 0)
    return start * PACK + count


def verdicts(dealt, span, cores, id_, h, place) -> tuple[np.ndarray, ...]:
    """kind, anchor, id, h, place: of all spans of some keys, those that go and what of the others has to be searched."""
    same = np.append(False, dealt[1:] == dealt[:-1])
    some = np.flatnonzero(same | np.append(same[1:], False))
    some = some[np.lexsort((place[some], h[some], id_[some], span[some], dealt[some]))]
    dealt, span, cores, id_, h, place = (c[some] for c in (dealt, span, cores, id_, h, place))
    index = np.arange(len(some))
    differ = dealt[1:] != dealt[:-1]
    new = np.append(True, differ | (span[1:] != span[:-1]))[: len(some)]
    first = np.maximum.accumulate(np.where(new, index, 0))
    goes = np.flatnonzero((id_ != id_[first]) | (h != h[first]) | (place != place[first]))
    heads = np.flatnonzero(new)
    group = np.cumsum(np.append(0, differ))[: len(some)][heads]
    least, most = np.full(len(heads), PARTS), np.full(len(heads), -1)
    for i in range(PARTS):
        core = cores[heads] >> (16 * i) & 0xFFFF
        there = np.flatnonzero(core)
        by = there[np.argsort(group[there] << 16 | core[there], kind="stable")]
        equal = np.append(False, (group[by][1:] == group[by][:-1]) & (core[by][1:] == core[by][:-1]))[: len(by)]
        shared = by[equal | np.append(equal[1:], False)[: len(by)]]
        least[shared] = np.minimum(least[shared], i)
        most[shared] = i
    search = np.flatnonzero(most >= 0)
    found = heads[search]
    rows = np.append(goes, found)
    places = np.append(strings_of(place[goes], 0, PARTS - 1), strings_of(place[found], least[search], most[search]))
    kind = np.repeat(np.array([REMOVE, SEARCH], np.int32), [len(goes), len(found)])
    return kind, dealt[rows], id_[rows], h[rows], places


def judged(marks: DataFrame, config: RepeatConfig) -> DataFrame:
    """Spans that go, and the first of spans with equal bytes as far as their strings may occur in others (`kind` SEARCH)."""
    names = ["kind", "anchor", "id", "h", "place"]

    def whole(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        columns = (np.concatenate([b.column(c).to_numpy() for b in held]) for c in ("dealt", "span", "cores", "id", "h", "place"))
        return pa.record_batch([pa.array(c) for c in verdicts(*columns)], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in batches:
            open_ = batch.column("cores").to_numpy() != 0
            if not open_.all():
                goes = batch.filter(pa.array(~open_))
                place = strings_of(goes.column("place").to_numpy(), 0, PARTS - 1)
                kind = np.full(len(place), REMOVE, np.int32)
                yield pa.record_batch([pa.array(kind), *(goes.column(c) for c in ("dealt", "id", "h")), pa.array(place)], names)
                batch = batch.filter(pa.array(open_))
            if not batch.num_rows:
                continue
            if n >= config.held:
                # What is held ends where the next key begins, in this batch.
                dealt = batch.column("dealt").to_numpy()
                last = held[-1].column("dealt")[-1].as_py()
                cut = int(np.searchsorted(dealt, last, "right"))
                if cut < len(dealt):
                    yield whole([*held, batch.slice(0, cut)])
                    held, n, batch = [], 0, batch.slice(cut)
            held.append(batch)
            n += batch.num_rows
        if held:
            yield whole(held)

    dealt = marks.repartition("dealt").sortWithinPartitions("dealt")
    return dealt.mapInArrow(run, "kind int, anchor bigint, id bigint, h bigint, place bigint")


_SPANS = "id bigint, h bigint, place bigint, dealt bigint, bytes binary"


def cut_spans(texts: DataFrame, config: RepeatConfig) -> DataFrame:
    """The bytes of the strings to be searched, and where to; `wanted` lists a text's spans."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            data, offsets = bytes_of(batch.column("text"))
            row = pc.list_parent_indices(batch.column("wanted")).to_numpy()
            place, anchor = (c.to_numpy(zero_copy_only=False) for c in batch.column("wanted").flatten().flatten())
            size = place % PACK + config.length - 1
            ends = np.cumsum(size)
            at = np.repeat(offsets[row] + place // PACK - (ends - size), size) + np.arange(size.sum())
            cut = pa.Array.from_buffers(pa.large_binary(), len(row), [None, pa.py_buffer(np.append(0, ends)), pa.py_buffer(data[at])])
            yield pa.record_batch([
                batch.column("id").take(pa.array(row)), batch.column("h").take(pa.array(row)),
                pa.array(place), pa.array(anchor), cut.cast(pa.binary()),
            ], ["id", "h", "place", "dealt", "bytes"])

    # With the columns that `finish` reads, texts are shuffled once for both.
    return texts.select("row", "id", "h", "text", "wanted").mapInArrow(run, _SPANS)


class Numbers:
    """Numbers that arrive in parts, in memory up to so many and in a scratch file beyond."""

    def __init__(self, dtype, memory: int):
        self.dtype, self.memory, self.parts, self.n, self.file = dtype, memory, [], 0, None

    def add(self, part: np.ndarray) -> None:
        self.parts.append(part)
        self.n += len(part)
        if self.file or self.n > self.memory:
            self.file = self.file or tempfile.TemporaryFile(prefix="repeats-")
            for held in self.parts:
                self.file.write(np.ascontiguousarray(held, self.dtype).data)
            self.parts = []

    def whole(self) -> np.ndarray:
        if self.file is None:
            return np.concatenate(self.parts)
        self.file.flush()
        return np.memmap(self.file, self.dtype, "r", shape=(self.n,))


class Shard:
    """The spans of a shard in the order of their places, one after another, a separator behind each.

    What exceeds the memory of the sort goes to scratch files.
    """

    def __init__(self, config: RepeatConfig):
        self.config, self.size, self.rows, self.last = config, 0, 0, None
        self.text, self.table = Numbers(np.uint16, config.memory), Numbers(np.int64, config.memory)

    def add(self, ids, hs, places, strings: pa.Array) -> None:
        """Spans in order; a span that the row before has, too, is left out."""
        key = np.stack([ids, hs, places], axis=1)
        new = np.append(self.last is None or (key[0] != self.last).any(), (key[1:] != key[:-1]).any(axis=1)) if len(key) else np.zeros(0, bool)
        if not new.any():
            return
        self.last = key[-1]
        chosen = strings.filter(pa.array(new)).cast(pa.large_binary())
        offsets = np.frombuffer(chosen.buffers()[1], np.int64)[chosen.offset : chosen.offset + len(chosen) + 1]
        data = np.frombuffer(chosen.buffers()[2], np.uint8)[offsets[0] : offsets[-1]]
        ends = offsets[1:] - offsets[0]
        # 1 separates, bytes follow from 2 on.
        text = np.insert(data.astype(np.uint16) + 2, ends, 1)
        starts = np.append(0, ends[:-1]) + np.arange(len(ends)) + self.size
        self.text.add(text)
        self.table.add(np.concatenate([starts[:, None], key[new]], axis=1).astype(np.int64).ravel())
        self.size += len(text)
        self.rows += len(ends)

    def repeats(self) -> Iterator[tuple[np.ndarray, ...]]:
        """id, h, start, strings: runs of strings that also occur earlier, in order."""
        if not self.rows:
            return
        config = self.config
        self.text.add(np.zeros(config.length + 1, np.uint16))
        data, table = self.text.whole(), self.table.whole().reshape(self.rows, 4)
        starts, places = np.array(table[:, 0]), table[:, 3]
        n = self.size + 1
        block = suffixes.BLOCK
        found = suffixes.Queue(np.arange(0, n, block), n, config.memory)
        best = None
        for pos, lcp in suffixes.descending(suffixes.Text(data, n, 9, 258), config.memory, config.length):
            tied = lcp >= config.length
            if not tied[0]:
                best = None
            # Of neighbours with a common string only the earliest stays; a run may go on in the next block.
            head = np.flatnonzero(~tied)
            head = head if len(head) and head[0] == 0 else np.append(0, head)
            earliest = np.minimum.reduceat(pos, head)
            run = np.repeat(np.arange(len(head)), np.diff(np.append(head, len(pos))))
            gone = [pos[pos != earliest[run]]]
            if best is not None:
                gone.append(np.array([max(best, earliest[0])]))
                earliest[0] = min(best, earliest[0])
            best = earliest[-1]
            gone = np.concatenate(gone)
            span = np.searchsorted(starts, gone, "right") - 1
            # Strings begin in the first places of a span only.
            gone = gone[gone - starts[span] < places[span] % PACK]
            found.push((gone,))
        while (part := found.peek(1 << 60)) is not None:
            gone = np.unique(part[0])
            found.take(len(part[0]))
            span = np.searchsorted(starts, gone, "right") - 1
            new = np.append(True, (gone[1:] != gone[:-1] + 1) | (span[1:] != span[:-1]))
            at = np.flatnonzero(new)
            span = span[at]
            count = np.diff(np.append(at, len(gone)))
            place = places[span]
            yield table[span, 1], table[span, 2], place // PACK + gone[at] - starts[span], count


_GONE = "id bigint, h bigint, start bigint, strings bigint"


def search(cut: DataFrame, config: RepeatConfig) -> DataFrame:
    """Sort the suffixes of each partition."""
    names = ["id", "h", "start", "strings"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = Shard(config)
        for batch in batches:
            ids, hs, places = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("id", "h", "place"))
            shard.add(ids, hs, places, batch.column("bytes"))
        for part in shard.repeats():
            yield pa.record_batch([pa.array(c) for c in part], names)

    return cut.select("id", "h", "place", "bytes").mapInArrow(run, _GONE)


def keyed(docs: DataFrame) -> DataFrame:
    """row (the columns but the text), text ('' for NULL), and the place of the document among all: id, h.

    A hash of the text, h, orders documents that share an id or have none. Where every id is there and occurs
    once, nothing is left to order, and 0 in its place shuffles in fewer bytes.
    """
    shared = docs.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).where((F.col("n") > 1) | F.col("doc_id").isNull())
    plain = shared.limit(1).count() == 0
    others = [F.col(f"`{c}`") for c in docs.columns if c != "text"]
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select(
        F.struct(*others).alias("row"),
        F.coalesce(F.col("doc_id").cast("bigint"), F.lit(2**63 - 1)).alias("id"),
        (F.lit(0).cast("bigint") if plain else F.xxhash64(text, F.col("doc_id").isNull())).alias("h"), text.alias("text"),
    )


def remove_repeats(docs: DataFrame, config: RepeatConfig = DEFAULT) -> DataFrame:
    """The columns of `docs` (doc_id and text among them), `removed` and `kept`.

    `removed` lists the maximal runs of bytes that go, in order, as start and length; `kept` is the rest as
    binary, because a cut may fall inside a character. Texts are their UTF-8 bytes; a NULL text
    is empty and comes back so. What is removed is decided on the input, not on what is left of it.

    Documents are ordered by doc_id, those without one after all others; documents that share an id, or have none,
    by a hash of their text. Rows that are equal in doc_id and text are one document, and all of them get its result. Texts
    shorter than a string keep everything; very long ones are hashed in overlapping slices. Columns that are
    called `removed` or `kept` are replaced. An empty table gives an empty result.
    """
    whole = keyed(docs)
    marks = materialize(judged(mark_spans(whole, config, hot_keys(whole, config)), config), "spans")
    to_search = marks.where(F.col("kind") == SEARCH)
    count = F.pmod("place", F.lit(PACK))
    size = to_search.agg(F.sum(count + config.length).alias("n")).first()["n"]
    shards = max(1, -(-(size or 0) // config.shard_bytes))
    wanted = to_search.groupBy("id", "h").agg(F.collect_set(F.struct("place", "anchor")).alias("wanted"))
    cut = cut_spans(whole.join(wanted, ["id", "h"]), config)
    dealt = cut.repartition(shards, "dealt").sortWithinPartitions("id", "h", "place")
    gone = search(dealt, config).unionByName(
        marks.where(F.col("kind") == REMOVE).select("id", "h", F.floor(F.col("place") / PACK).alias("start"), count.alias("strings"))
    )
    runs = gone.groupBy("id", "h").agg(F.collect_list(F.struct("start", "strings")).alias("gone"))
    return finish(whole.join(runs, ["id", "h"], "left"), docs, config)


def finish(texts: DataFrame, docs: DataFrame, config: RepeatConfig) -> DataFrame:
    """Join the runs of strings into runs of bytes and take them out of the texts."""
    found = StructType.fromDDL("removed array<struct<start:bigint,length:bigint>>, kept binary")
    schema = StructType([*texts.select("row", "text").schema, *found])
    pieces = pa.struct([("start", pa.int64()), ("length", pa.int64())])

    def cut(texts: pa.Array, gone: pa.Array) -> tuple[pa.Array, pa.Array]:
        data, offsets = bytes_of(texts)
        n = len(texts)
        row = pc.list_parent_indices(gone).to_numpy()
        start, strings = (c.to_numpy(zero_copy_only=False) for c in gone.flatten().flatten())
        start = offsets[row] + start
        order = np.lexsort((start, row))
        row, start, stop = row[order], start[order], (start + strings + config.length - 1)[order]
        reach = np.maximum.accumulate(stop)
        new = np.append(True, (row[1:] != row[:-1]) | (start[1:] > reach[:-1]))[: len(row)]
        row, start, stop = row[new], start[new], reach[np.append(np.flatnonzero(new)[1:] - 1, len(reach) - 1)[: new.sum()]]
        # Kept is what lies before the first run, between two runs and behind the last.
        edges = np.zeros(offsets[-1] - offsets[0] + 1, np.int8)
        np.add.at(edges, start - offsets[0], 1)
        np.add.at(edges, stop - offsets[0], -1)
        kept = data[offsets[0] : offsets[-1]][np.cumsum(edges[:-1], dtype=np.int8) == 0]
        lost = np.bincount(row, weights=stop - start, minlength=n).astype(np.int64)
        ends = np.append(0, np.cumsum(np.diff(offsets) - lost))
        runs = pa.StructArray.from_arrays([pa.array(start - offsets[row]), pa.array(stop - start)], fields=list(pieces))
        counts = np.append(0, np.cumsum(np.bincount(row, minlength=n))).astype(np.int32)
        whole = pa.Array.from_buffers(pa.large_binary(), n, [None, pa.py_buffer(ends), pa.py_buffer(kept)])
        return pa.ListArray.from_arrays(pa.array(counts), runs), whole.cast(pa.binary())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            found = cut(part.column("text"), part.column("gone"))
            yield pa.record_batch([part.column("row"), part.column("text"), *found], ["row", "text", "removed", "kept"])

    cleaned = texts.select("row", "id", "h", "text", "gone").mapInArrow(run, schema)
    kept = [c for c in docs.columns if c not in ("removed", "kept")]
    return cleaned.select(*[F.col("text") if c == "text" else F.col(f"row.`{c}`") for c in kept], "removed", "kept")

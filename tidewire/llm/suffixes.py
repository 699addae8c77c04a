"""Suffixes of a long text in order, with common prefixes, by induced sorting in external memory.

Only suffixes at certain positions are sorted: those that are smaller than their successor while their
predecessor is larger. Their substrings up to the next such position become the symbols of a shorter text,
which is sorted by the same method until it fits in memory. All other suffixes follow by induction: a queue
hands out suffixes in order, and each puts its predecessor back if that sorts on the far side of it. A queue entry
is a tuple of the first symbol, the position, the common prefix with the entry before it under the same symbol,
and the next symbols to the left, so that the text itself is read seldom.

Queues, runs and texts live in scratch files of the task, which the system removes when they are closed, at the
latest with the process; a lost task starts anew. `memory` bounds the entries held at once.
"""

from __future__ import annotations

import tempfile
from collections.abc import Iterator

import numpy as np
from numpy.lib.stride_tricks import sliding_window_view

Entries = tuple[np.ndarray, ...]

BLOCK = 1 << 16
FAR = np.iinfo(np.int64).max


def scratch(n: int, dtype, memory: int = 0) -> np.ndarray:
    """An array of zeros, in a scratch file if it has more than `memory` entries."""
    if n <= memory:
        return np.zeros(n, dtype)
    file = tempfile.TemporaryFile(prefix="suffixes-")
    file.truncate(n * np.dtype(dtype).itemsize)
    return np.memmap(file, dtype, "r+", shape=(n,))


def joined(parts: list[Entries]) -> Entries:
    return parts[0] if len(parts) == 1 else tuple(np.concatenate(c) for c in zip(*parts, strict=True))


class Spill:
    """Parts of entries, written one after another to a scratch file."""

    def __init__(self):
        self.file = None
        self.end = 0

    def put(self, part: Entries) -> list[tuple[int, int, np.dtype]]:
        self.file = self.file or tempfile.TemporaryFile(prefix="suffixes-")
        self.file.seek(self.end)
        refs = []
        for column in part:
            refs.append((self.end, len(column), column.dtype))
            self.file.write(np.ascontiguousarray(column).data)
            self.end += column.nbytes
        return refs

    def get(self, refs: list[tuple[int, int, np.dtype]], start: int = 0, stop: int | None = None) -> Entries:
        out = []
        for at, n, dtype in refs:
            last = n if stop is None else min(stop, n)
            self.file.seek(at + start * dtype.itemsize)
            out.append(np.frombuffer(self.file.read(max(0, last - start) * dtype.itemsize), dtype))
        return tuple(out)


class Queue:
    """A priority queue on disk; the first column of its entries is the key, equal keys come out as they went in.

    Keys are dealt to buckets that begin at `starts`. A bucket of one key is a list of parts in order of arrival; another one
    is sorted when its turn comes, and again with what arrives meanwhile. Beyond `memory` entries the
    parts of all later buckets go to a scratch file.
    """

    def __init__(self, starts: np.ndarray, stop: int, memory: int):
        self.starts, self.memory = starts, memory
        self.single = np.diff(np.append(starts, stop)) == 1
        self.parts: list[list] = [[] for _ in starts]
        self.held, self.at, self.spill = 0, 0, None
        self.current: Entries | None = None

    def push(self, entries: Entries) -> None:
        """Add entries; equal keys in the order given."""
        if not len(entries[0]):
            return
        bucket = np.searchsorted(self.starts, entries[0], "right") - 1
        if len(self.starts) < 1 << 15:
            bucket = bucket.astype(np.int16)
        order = np.argsort(bucket, kind="stable")
        bucket = bucket[order]
        entries = tuple(c[order] for c in entries)
        cuts = np.flatnonzero(bucket[1:] != bucket[:-1]) + 1
        for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(bucket)], strict=True):
            self.parts[bucket[a]].append(tuple(c[a:b] for c in entries))
        self.held += len(bucket)
        if self.held > self.memory:
            self.flush()

    def flush(self) -> None:
        self.spill = self.spill or Spill()
        for b in range(self.at + 1, len(self.parts)):
            fresh = [p for p in self.parts[b] if isinstance(p, tuple)]
            if fresh:
                self.parts[b] = [p for p in self.parts[b] if not isinstance(p, tuple)] + [self.spill.put(joined(fresh))]
                self.held -= sum(len(p[0]) for p in fresh)

    def _load(self, limit: int) -> list[Entries]:
        """Parts of the bucket at hand, up to about `limit` entries where it is of one key."""
        parts, got, found = self.parts[self.at], 0, []
        while parts and (got < limit or not self.single[self.at]):
            part = parts[0]
            if isinstance(part, tuple):
                parts.pop(0)
                self.held -= len(part[0])
            elif self.single[self.at] and part[0][1] > limit:
                # The rest of a large part stays on disk.
                refs, part = part, self.spill.get(part, 0, limit)
                parts[0] = [(at + limit * d.itemsize, n - limit, d) for at, n, d in refs]
            else:
                parts.pop(0)
                part = self.spill.get(part)
            found.append(part)
            got += len(part[0])
        return found

    def peek(self, limit: int) -> Entries | None:
        """The first entries, at most about `limit`; None when there are none."""
        while True:
            held = [self.current] if self.current is not None and len(self.current[0]) else []
            if self.single[self.at]:
                if not held and (fresh := self._load(limit)):
                    held, self.current = [joined(fresh)], joined(fresh)
            elif fresh := self._load(limit):
                whole = joined(held + fresh)
                order = np.argsort(whole[0], kind="stable")
                held = [tuple(c[order] for c in whole)]
                self.current = held[0]
            if held:
                return tuple(c[:limit] for c in self.current)
            self.current = None
            if self.at + 1 == len(self.parts):
                return None
            self.at += 1

    def take(self, n: int) -> None:
        """Remove the first n entries of what `peek` has shown."""
        self.current = tuple(c[n:] for c in self.current)


def ordered(blocks: Iterator[Entries], keys: int, memory: int) -> Iterator[Entries]:
    """The entries by their first `keys` columns: sorted runs of `memory` entries, merged from disk."""
    runs, waiting, n, spill = [], [], 0, None

    def run() -> Entries:
        whole = joined(waiting)
        order = np.lexsort(whole[:keys][::-1])
        return tuple(c[order] for c in whole)

    for block in blocks:
        if len(block[0]):
            waiting.append(block)
            n += len(block[0])
        if n >= memory:
            spill = spill or Spill()
            runs.append(spill.put(run()))
            waiting, n = [], 0
    if not runs:
        if waiting:
            yield run()
        return
    if waiting:
        runs.append(spill.put(run()))
    share = max(1, memory // len(runs))
    heads, read = [spill.get(r, 0, share) for r in runs], [share] * len(runs)
    while True:
        for i, refs in enumerate(runs):
            if not len(heads[i][0]) and read[i] < refs[0][1]:
                heads[i] = spill.get(refs, read[i], read[i] + share)
                read[i] += share
        # What is not above the least of the last entries read can meet nothing smaller any more.
        lasts = [tuple(int(c[-1]) for c in h[:keys]) for h, r, refs in zip(heads, read, runs, strict=True) if len(h[0]) and r < refs[0][1]]
        if not any(len(h[0]) for h in heads):
            return
        out = []
        for i, head in enumerate(heads):
            k = len(head[0]) if not lasts else not_above(head[:keys], min(lasts))
            out.append(tuple(c[:k] for c in head))
            heads[i] = tuple(c[k:] for c in head)
        waiting = [p for p in out if len(p[0])]
        yield run()


def not_above(columns: Entries, bound: tuple[int, ...]) -> int:
    """How many of the sorted rows are not above the bound."""
    low, high = 0, len(columns[0])
    for column, value in zip(columns, bound, strict=True):
        value = np.array(value, column.dtype)
        rows = column[low:high]
        low, high = low + int(np.searchsorted(rows, value, "left")), low + int(np.searchsorted(rows, value, "right"))
    return high


class Text:
    """A text of whole numbers on disk that ends with its only 0, and `bits` that hold any of its symbols.

    The array has `spare` more zeros behind the end, so that prefixes can be read over it.
    """

    def __init__(self, data: np.ndarray, n: int, bits: int, symbols: int):
        self.data, self.n, self.bits, self.symbols = data, n, bits, symbols
        self.lanes, self.mask = 63 // bits, (1 << bits) - 1

    def before(self, pos: np.ndarray) -> np.ndarray:
        """The symbols to the left of positions, the nearest in the lowest bits; 0 beyond the start."""
        out = np.zeros(len(pos), np.int64)
        for lane in range(self.lanes):
            at = pos - 1 - lane
            symbol = self.data[np.maximum(at, 0)].astype(np.int64)
            out |= np.where(at >= 0, symbol, 0) << (self.bits * lane)
        return out

    def chunk(self, start: np.ndarray, length: np.ndarray, number: int) -> np.ndarray:
        """Some symbols of substrings in one number; what has ended is filled with the largest symbol."""
        out = np.zeros(len(start), np.int64)
        for lane in range(self.lanes):
            off = number * self.lanes + lane
            symbol = self.data[np.minimum(start + off, self.n - 1)].astype(np.int64)
            out = out << self.bits | np.where(off < length, symbol, self.mask)
        return out

    def ended(self, chunk: np.ndarray) -> np.ndarray:
        return (chunk & self.mask) == self.mask

    def common(self, a: np.ndarray, b: np.ndarray, cap: int) -> np.ndarray:
        """Length of the common prefix of the suffixes at positions a and b, at most `cap`."""
        windows, out = sliding_window_view(self.data, cap), np.empty(len(a), np.uint8)
        for i in range(0, len(a), 1 << 13):
            part = slice(i, i + (1 << 13))
            differ = windows[a[part]] != windows[b[part]]
            first = differ.argmax(axis=1)
            out[part] = np.where(differ[np.arange(len(first)), first], first, cap)
        return out

    def starts(self, memory: int) -> np.ndarray:
        """Where the buckets of a queue begin: keys are 2 * symbol and 2 * symbol + 1.

        One bucket a key for few symbols; otherwise runs of symbols that are as frequent as a block of entries.
        """
        if self.symbols <= 1 << 10:
            return np.arange(2 * self.symbols, dtype=np.int64)
        counts = scratch(self.symbols, np.int64, memory)
        for i in range(0, self.n, BLOCK):
            found, n = np.unique(self.data[i : min(i + BLOCK, self.n)], return_counts=True)
            counts[found] += n
        size = max(BLOCK, min(self.n // 64, memory // 4))
        heavy = np.flatnonzero(counts >= size)
        after = np.cumsum(counts) // size
        cuts = np.flatnonzero(np.diff(after)) + 1
        symbols = np.unique(np.concatenate([[0], cuts, heavy, heavy + 1]))
        symbols = symbols[symbols < self.symbols]
        return np.unique(np.concatenate([2 * symbols, 2 * heavy + 1])).astype(np.int64)


def turns(text: Text, memory: int) -> np.ndarray:
    """The positions whose suffix is smaller than the next one and whose predecessor's is larger, in text order."""
    rising = scratch(text.n, np.bool_, 4 * memory)
    carry = True
    for end in range(text.n, 0, -BLOCK):
        start = max(0, end - BLOCK)
        here = text.data[start:end].astype(np.int64)
        after = np.append(here[1:], text.data[end] if end < text.n else -1)
        step = np.sign(after - here)
        if end == text.n:
            step[-1] = 1  # the end is smaller than all
        # Equal neighbours are as the next unequal one.
        at = np.where(step != 0, np.arange(len(step)), len(step))
        at = np.minimum.accumulate(at[::-1])[::-1]
        up = np.append(step > 0, carry)[at]
        rising[start:end] = up
        carry = bool(up[0])
    found = []
    for start in range(1, text.n, BLOCK):
        up = rising[start - 1 : min(start + BLOCK, text.n)]
        found.append(np.flatnonzero(up[1:] & ~up[:-1]) + start)
    n = sum(map(len, found))
    out = scratch(n, np.int64, memory)
    if n:
        np.concatenate(found, out=out)
    return out


def names(text: Text, at: np.ndarray, memory: int) -> tuple[np.ndarray, bool]:
    """For each turn a number that orders the substrings from a turn to the next, and whether all differ.

    The number is how many substrings are smaller. Substrings are compared some symbols at a time; only
    those that are still equal and have not ended go on.
    """
    m = len(at)
    name = scratch(m, np.int64, memory)
    unique = True

    def chunks(number: int, members) -> Iterator[Entries]:
        for group, j in members:
            start = at[j]
            length = np.where(j + 1 < m, at[np.minimum(j + 1, m - 1)] - start + 1, 1)
            yield group, text.chunk(start, length, number), j

    def everything() -> Iterator[Entries]:
        for i in range(0, m, BLOCK):
            j = np.arange(i, min(i + BLOCK, m))
            yield np.zeros(len(j), np.int64), j

    members, number = everything(), 0
    while members is not None:
        left, kept = Spill(), []
        # Of the group of equal entries that the last block may have cut: key, place and entries so far.
        last, first, place, in_group = None, 0, 0, 0
        open_parts: list[np.ndarray] = []

        def close(chunk: int) -> None:
            nonlocal unique
            whole = np.concatenate(open_parts)
            if len(whole) > 1:
                if bool(text.ended(np.array([chunk]))[0]):
                    unique = False
                else:
                    kept.append(left.put((np.full(len(whole), first), whole)))

        for group, chunk, j in ordered(chunks(number, members), 2, memory):
            new = np.append(True, (group[1:] != group[:-1]) | (chunk[1:] != chunk[:-1]))
            if last is not None and (int(group[0]), int(chunk[0])) == last:
                new[0] = False
            elif last is not None:
                close(last[1])
                open_parts = []
            # Places count on from the start of the group of the round before.
            fresh = np.append(last is None or int(group[0]) != last[0], group[1:] != group[:-1])
            index = np.arange(len(j))
            begin = np.maximum.accumulate(np.where(fresh, index, -1))
            within = np.where(begin >= 0, index - begin, index + in_group)
            spot = group + within
            start = np.maximum.accumulate(np.where(new, index, -1))
            value = np.where(start >= 0, spot[np.maximum(start, 0)], first)
            name[j] = value
            # Groups that lie inside the block, in one go; the last one stays open.
            heads = np.flatnonzero(new)
            if len(heads):
                if open_parts:
                    open_parts.append(j[: heads[0]])
                    close(last[1])
                    open_parts = []
                tail = heads[-1]
                sizes = np.diff(np.append(heads, len(j)))[:-1]
                alive = np.repeat((sizes > 1) & ~text.ended(chunk[heads[:-1]]), sizes)
                unique &= not bool(((sizes > 1) & text.ended(chunk[heads[:-1]])).any())
                if alive.any():
                    body = slice(heads[0], tail)
                    kept.append(left.put((value[body][alive], j[body][alive])))
                open_parts, first = [j[tail:]], int(value[tail])
            else:
                open_parts.append(j)
            last, in_group = (int(group[-1]), int(chunk[-1])), int(within[-1]) + 1
        if last is not None:
            close(last[1])
        members = map(left.get, kept) if kept else None
        number += 1
    return name, unique


def doubled(rank: np.ndarray) -> np.ndarray:
    """The order of the suffixes of a text in memory from the numbers of its symbols, by prefix doubling."""
    rank = np.array(rank)
    order = np.argsort(rank, kind="stable")
    h, open_ = 1, order
    while True:
        key = rank[open_]
        again = np.zeros(len(open_), bool)
        if len(open_) > 1:
            same = key[1:] == key[:-1]
            again[1:] |= same
            again[:-1] |= same
        open_ = open_[again]
        if not len(open_):
            break
        key, after = rank[open_], rank[open_ + h]
        by = np.lexsort((after, key))
        open_, key, after = open_[by], key[by], after[by]
        index = np.arange(len(open_))
        fresh = np.append(True, key[1:] != key[:-1])
        new = fresh | np.append(True, after[1:] != after[:-1])
        begin = np.maximum.accumulate(np.where(fresh, index, 0))
        rank[open_] = key + np.maximum.accumulate(np.where(new, index, 0)) - begin
        h *= 2
    out = np.empty(len(rank), np.int64)
    out[rank] = np.arange(len(rank))
    return out


class Prefixes:
    """Common prefixes of entries put back under the same symbol: one more than the least between their sources."""

    def __init__(self, text: Text, cap: int):
        self.text, self.cap = text, cap
        self.low = np.full(text.symbols, cap, np.int64)
        self.last: tuple[int, int] | None = None

    def settled(self, key: np.ndarray, pos: np.ndarray, lcp: np.ndarray) -> np.ndarray:
        """Common prefixes with the entry handed out before; where the key changes, the stored one says nothing."""
        lcp = lcp.astype(np.int64)
        before = np.append(self.last[0] if self.last else FAR, key[:-1])
        change = np.flatnonzero(key != before)
        lcp[change] = 0
        seams = change[np.abs(key[change]) >> 1 == np.abs(before[change]) >> 1] if self.last or len(change) > 1 else change[:0]
        for i in seams.tolist():
            if i or self.last:
                other = pos[i - 1] if i else self.last[1]
                lcp[i] = self.text.common(np.array([pos[i]]), np.array([other]), self.cap)[0]
        self.last = int(key[-1]), int(pos[-1])
        return lcp

    def induced(self, lcp: np.ndarray, source: np.ndarray, symbol: np.ndarray) -> np.ndarray:
        """For entries put back by the sources (places in the block), in order, under their symbols."""
        levels = [lcp]
        while 2 ** len(levels) <= len(lcp):
            half = 2 ** (len(levels) - 1)
            levels.append(np.minimum(levels[-1][:-half], levels[-1][half:]))
        by = np.argsort(symbol.astype(np.uint16), kind="stable")
        s, at = symbol[by], source[by]
        first = np.append(True, s[1:] != s[:-1]) if len(s) else np.zeros(0, bool)
        start = np.where(first, 0, np.append(0, at[:-1] + 1)[: len(at)])
        out = least(levels, start, at)
        out = np.where(first, np.minimum(out, self.low[s]), out)
        result = np.empty(len(out), np.int64)
        result[by] = np.minimum(out + 1, self.cap)
        self.low = np.minimum(self.low, lcp.min())
        if len(s):
            final = np.flatnonzero(np.append(first[1:], True))
            rest = at[final] + 1
            inside = rest < len(lcp)
            after = np.full(len(final), self.cap, np.int64)
            after[inside] = least(levels, rest[inside], np.full(inside.sum(), len(lcp) - 1))
            self.low[s[final]] = after
        return result.astype(np.uint8)


def least(levels: list[np.ndarray], start: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """Minima of the ranges start to stop, both included, from minima of powers of two."""
    out = np.empty(len(start), np.int64)
    power = np.log2(stop - start + 1).astype(np.int64) if len(start) else start
    for p in np.unique(power).tolist():
        here = power == p
        a, b = start[here], stop[here]
        out[here] = np.minimum(levels[p][a], levels[p][b - (1 << p) + 1])
    return out


def induce(text: Text, queue: Queue, down: bool, prefixes: Prefixes | None) -> Iterator[Entries]:
    """Hand out the entries of a queue in order while each puts its predecessor back; blocks of entries.

    Upwards, entries with an even key are suffixes larger than their successor, and put back such
    predecessors; odd keys are the sorted turns. Downwards, with keys negated, it is the other way round. A block
    is only used as far as nothing it puts back comes before its end.
    """
    limit = BLOCK
    while (block := queue.peek(limit)) is not None:
        key, pos, lcp, left = block
        dry = np.flatnonzero((left == 0) & (pos > 0))
        if len(dry):
            left = left.copy()
            left[dry] = text.before(pos[dry])
        symbol, before = np.abs(key) >> 1, left & text.mask
        if down:
            back = (before < symbol) | ((before == symbol) & (key & 1 == 1))
            target = -(2 * before + 1)
        else:
            back, target = before >= symbol, 2 * before
        back &= pos > 0
        n = len(key)
        if not queue.single[queue.at]:
            bound = np.minimum.accumulate(np.where(back, target, FAR))
            late = key[1:] > bound[:-1]
            n = int(late.argmax()) + 1 if late.any() else n
            limit = max(256, limit // 2) if n < limit // 4 else min(BLOCK, limit * 2) if n == limit else limit
        used = slice(0, n)
        key, pos, left = key[used], pos[used], left[used]
        source = np.flatnonzero(back[used])
        if prefixes:
            lcp = prefixes.settled(key, pos, lcp[used])
            carried = prefixes.induced(lcp, source, before[source])
            lcp = lcp.astype(np.uint8)
        else:
            lcp = lcp[used]
            carried = lcp[source]
        queue.take(n)
        queue.push((target[source], pos[source] - 1, carried, left[source] >> text.bits))
        yield key, pos, lcp, left


def order(text: Text, memory: int) -> np.ndarray:
    """The positions of all suffixes, the smallest first."""
    out, place = scratch(text.n, np.int64, memory), text.n
    for pos, _ in descending(text, memory, 0):
        out[place - len(pos) : place] = pos[::-1]
        place -= len(pos)
    out[0] = text.n - 1
    return out


def sorted_turns(text: Text, memory: int) -> np.ndarray:
    """The turns of a text by their suffixes."""
    at = turns(text, memory)
    m = len(at)
    name, unique = names(text, at, memory)
    if unique:
        by = scratch(m, np.int64, memory)
        for i in range(0, m, BLOCK):
            by[name[i : i + BLOCK]] = np.arange(i, min(i + BLOCK, m))
    elif m <= memory:
        by = doubled(name)
    else:
        # The last turn is the end, the smallest of all: its number is 0 and no other's.
        by = order(Text(name, m, 31, m), memory)
    out = scratch(m, np.int64, memory)
    for i in range(0, m, BLOCK):
        out[i : i + BLOCK] = at[by[i : i + BLOCK]]
    return out


def descending(text: Text, memory: int, cap: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Positions of all suffixes but the end, the largest first, and common prefixes with the one before.

    The end of the text is the smallest suffix and is left out. Prefixes are counted up to `cap`; with a cap
    of 0 they are not computed.
    """
    starts, stop = text.starts(memory), 2 * text.symbols
    seeds = sorted_turns(text, memory)
    up = Queue(starts, stop, memory)
    for i in range(0, len(seeds), BLOCK):
        pos = np.array(seeds[i : i + BLOCK])
        lcp = np.zeros(len(pos), np.uint8)
        if cap:
            lcp = text.common(pos, np.array(seeds[max(i - 1, 0) : i + len(pos) - 1]) if i else np.append(pos[:1], pos[:-1]), cap)
        up.push((2 * text.data[pos].astype(np.int64) + 1, pos, lcp, np.zeros(len(pos), np.int64)))
    larger, parts, held = Spill(), [], 0
    for key, pos, lcp, left in induce(text, up, False, Prefixes(text, cap) if cap else None):
        even = key & 1 == 0
        if even.any():
            part = (key[even], pos[even], lcp[even], left[even])
            held += len(part[0])
            parts.append(part if held <= memory else larger.put(part))
    del up, seeds
    down = Queue(np.sort(1 - np.append(starts[1:], stop)), 1, memory)
    follows = 0
    while parts:
        part = parts.pop()
        key, pos, lcp, left = (c[::-1] for c in (part if isinstance(part, tuple) else larger.get(part)))
        down.push((-key, pos, np.append(np.uint8(follows), lcp[:-1]), left))
        follows = lcp[-1]
    del larger
    for _, pos, lcp, _ in induce(text, down, True, Prefixes(text, cap) if cap else None):
        yield pos, lcp

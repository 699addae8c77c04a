"""Sampled SentencePiece segmentations without replacement, by perturbed A-star search over the lattice.

A text is cut at its word marks, which no piece crosses, so its lattice is a chain of word lattices. The
weight of a piece falls with its rank in the model. Backward sums over the lattice give every arc its
conditional probability. The search keeps sets of segmentations as nodes, each with its log-probability
and the largest Gumbel-perturbed value in it, and always opens the node with the largest value: opening
one emits the segmentation that has this value and splits the rest of the set at each arc of the path.
Perturbed values of the parts are drawn below their set's, so the first k emitted are a sample of k
distinct segmentations without replacement. All random numbers come from the row's key.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from heapq import heappop, heappush

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from sentencepiece import SentencePieceProcessor

from tidewire.llm.common import slices, worker_cache

MARK = "▁"
GAMMA, MIX, MIX2 = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB))
TINY = 1e-13
UNDERFLOW = 600


@dataclass(frozen=True)
class SegmentConfig:
    """Samples per row, temperature of the piece weights, seed, and the model's file."""

    k: int = 2
    temperature: float = 1.0
    seed: int = 1
    path: str = public_tokenizers.path("piece_bpe_32k.model")


DEFAULT = SegmentConfig()


class PieceModel:
    """Pieces by length: sorted hashes, ids, and which leading bits occur in them and in longer pieces."""

    def __init__(self, path: str, temperature: float):
        model = SentencePieceProcessor(model_file=path)
        self.pieces = [model.id_to_piece(i) for i in range(model.vocab_size())]
        rank = np.array([-model.get_score(i) for i in range(len(self.pieces))])
        special = [model.is_control(i) or model.is_unknown(i) for i in range(len(self.pieces))]
        byte = [model.is_byte(i) for i in range(len(self.pieces))]
        self.byte_ids = np.flatnonzero(byte)
        self.weight = -np.log(rank + 2) / temperature
        self.odds = np.exp(self.weight)
        self.byte_weight = -np.log(len(self.pieces) + 2) / temperature
        plain = [i for i in range(len(self.pieces)) if not (special[i] or byte[i])]
        self.longest = max(len(self.pieces[i]) for i in plain)
        self.by_length = []
        for n in range(1, self.longest + 1):
            ids = np.array([i for i in plain if len(self.pieces[i]) == n], np.int64)
            codes = np.array([[ord(c) for c in self.pieces[i]] for i in ids], np.uint64).reshape(-1, n)
            h = np.zeros(len(ids), np.uint64)
            for k in range(n):
                h = roll(h, codes[:, k])
            order = np.argsort(h)
            longer = np.zeros(1 << 20, bool)
            for p in {self.pieces[i][:n] for i in plain if len(self.pieces[i]) > n}:
                code = np.array([[ord(c)] for c in p], np.uint64)
                start = np.zeros(1, np.uint64)
                for c in code:
                    start = roll(start, c)
                longer[int(start[0]) >> 44] = True
            known = np.zeros(1 << 20, bool)
            known[h >> np.uint64(44)] = True
            self.by_length.append((h[order], ids[order], known, longer))
        first = int(self.byte_ids[0])
        self.bytes_of = [
            bytes([i - first]) if byte[i] else p.replace(MARK, " ").encode() for i, p in enumerate(self.pieces)
        ]
        # The characters of every piece, one after another; a byte piece is read where it is a whole character.
        read = [chr(i - first) if byte[i] else p for i, p in enumerate(self.pieces)]
        self.sizes = np.array([len(p) for p in read], np.int64)
        self.offsets = np.cumsum(self.sizes) - self.sizes
        self.codes = np.frombuffer("".join(read).encode("utf-32-le"), np.uint32)

    def decode(self, ids: list[int]) -> str:
        """The text of a segmentation; the first word mark is the one that encoding added."""
        return b"".join([self.bytes_of[i] for i in ids]).decode("utf-8", "replace")[1:]


def roll(h: np.ndarray, code: np.ndarray) -> np.ndarray:
    h = (h ^ code) * GAMMA
    return h ^ (h >> np.uint64(31))


def uniform(key: np.ndarray, counter: np.ndarray) -> np.ndarray:
    """Numbers in (0, 1) from keys and counters, the same in every task."""
    z = key + (counter.astype(np.uint64) + np.uint64(1)) * GAMMA
    z = (z ^ (z >> np.uint64(30))) * MIX
    z = (z ^ (z >> np.uint64(27))) * MIX2
    z ^= z >> np.uint64(31)
    return ((z >> np.uint64(11)).astype(np.float64) + 0.5) / (1 << 53)


def code_points(texts: pa.Array) -> np.ndarray:
    """The characters of texts, one after another."""
    _, offsets, data = texts.buffers()
    ends = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    whole = str(memoryview(data or b"")[ends[0] : ends[-1]], "utf-8")
    return np.frombuffer(whole.encode("utf-32-le"), np.uint32)


class Lattice:
    """The lattices of distinct chunks side by side: one slot per character and one per chunk's end."""

    def __init__(self, chunks: list[str] | pa.Array, model: PieceModel):
        chunks = chunks if isinstance(chunks, pa.Array) else pa.array(chunks, pa.large_string())
        sizes = pc.utf8_length(chunks).to_numpy().astype(np.int64)
        self.start = np.concatenate([[0], np.cumsum(sizes + 1)])[:-1]
        self.end = self.start + sizes
        total = int(sizes.sum() + len(chunks))
        code = np.zeros(total + model.longest, np.uint64)
        inside = np.ones(total, bool)
        inside[self.end] = False
        code[:total][inside] = code_points(chunks)
        left = np.repeat(self.end, sizes + 1) - np.arange(total)
        at = np.flatnonzero(left > 0)
        h = np.zeros(len(at), np.uint64)
        hits = []
        for n in range(1, model.longest + 1):
            h = roll(h, code[at + (n - 1)])
            keys, ids, known, longer = model.by_length[n - 1]
            top = (h >> np.uint64(44)).astype(np.intp)
            maybe = np.flatnonzero(known[top])
            place = np.minimum(np.searchsorted(keys, h[maybe]), len(keys) - 1)
            hit = keys[place] == h[maybe]
            if hit.any():
                hits.append((n, at[maybe[hit]], ids[place[hit]]))
            on = longer[top] & (left[at] > n)
            at, h = at[on], h[on]
        width = max((n for n, _, _ in hits), default=1)
        self.ids = np.full((total, width), -1, np.int32)
        weight = np.zeros((total, width))
        for n, slots, found in hits:
            self.ids[slots, n - 1] = found
            weight[slots, n - 1] = model.odds[found]
        unknown = np.flatnonzero((left > 0) & (self.ids[:, 0] < 0))
        n_bytes = 1 + (code[unknown] > 0x7F) + (code[unknown] > 0x7FF) + (code[unknown] > 0xFFFF)
        weight[unknown, 0] = np.exp(n_bytes * model.byte_weight)
        ascii_ = unknown[code[unknown] < 0x80]
        self.ids[ascii_, 0] = model.byte_ids[code[ascii_].astype(np.int64)]
        self.code = code
        n_bytes = 1 + (code[:total] > 0x7F) + (code[:total] > 0x7FF) + (code[:total] > 0xFFFF).astype(np.int64)
        n_bytes = np.append(0, np.cumsum(np.where(inside, n_bytes, 0)))
        small = (n_bytes[self.end] - n_bytes[self.start]) * -model.byte_weight < UNDERFLOW
        total_odds = np.zeros(total + width + 1)
        total_odds[self.end] = 1
        after = np.lib.stride_tricks.sliding_window_view(total_odds[1:], width)
        # Odds of the last `width` distances from the end; longer chunks come first, so columns line up.
        last = [np.ones(int(small.sum()))]
        for at in self._from_ends(sizes, small):
            arcs, odds = weight[at], np.zeros(len(at))
            for n, ahead in enumerate(reversed(last)):
                odds += arcs[:, n] * ahead[: len(at)]
            total_odds[at] = odds
            last = [*last[1 - width :], odds] if width > 1 else [odds]
        total_odds[:total][total_odds[:total] == 0] = 1
        late = list(self._in_logarithms(weight, sizes, ~small))
        weight *= after[:total]  # in place: these are the largest arrays here
        weight /= total_odds[:total, None]
        for at, probability in late:
            weight[at] = probability
        self.probability = weight
        self.likeliest = self.probability.argmax(axis=1)
        self.of_likeliest = self.probability[np.arange(total), self.likeliest]


    def _from_ends(self, sizes: np.ndarray, chosen: np.ndarray) -> Iterator[np.ndarray]:
        """The slots one, two, ... characters before the ends of the chosen chunks."""
        order = np.argsort(-sizes[chosen], kind="stable")
        ends, ordered = self.end[chosen][order], -sizes[chosen][order]
        for d in range(1, -int(ordered[0]) + 1 if len(ordered) else 1):
            yield ends[: np.searchsorted(ordered, -d, "right")] - d

    def _in_logarithms(
        self, weight: np.ndarray, sizes: np.ndarray, chosen: np.ndarray
    ) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Slots and probabilities of chunks so long that their odds leave the range of a double."""
        if not chosen.any():
            return
        total, width = weight.shape
        beta = np.full(total + width, -np.inf)
        beta[self.end] = 0
        steps = np.arange(1, width + 1)
        with np.errstate(divide="ignore"):
            for at in self._from_ends(sizes, chosen):
                value = np.log(weight[at]) + beta[at[:, None] + steps]
                most = value.max(axis=1)
                beta[at] = most + np.log(np.exp(value - most[:, None]).sum(axis=1))
                yield at, np.exp(value - beta[at][:, None])


@dataclass
class Path:
    """A segmentation in steps: chunk occurrence, slot and piece length of each, and log-probabilities."""

    occurrence: np.ndarray
    slot: np.ndarray
    length: np.ndarray
    log_arc: np.ndarray  # of each step
    log_after: np.ndarray  # of the arcs up to each step, with it
    log_prob: float


def other_arcs(lattice: Lattice, slot: np.ndarray, u: np.ndarray) -> np.ndarray:
    """Arcs of slots whose number u lies above the likeliest arc's share, by the shares of the others."""
    first, taken = lattice.likeliest[slot], lattice.of_likeliest[slot]
    row = lattice.probability[slot]
    row[np.arange(len(slot)), first] = 0
    row = np.cumsum(row, axis=1)
    rest = row[:, -1]
    at = (u - taken) / np.maximum(1 - taken, 1e-300) * rest
    return np.where(rest > 0, np.minimum((at[:, None] >= row).sum(axis=1), row.shape[1] - 1), first)


def walk(lattice: Lattice, slot: np.ndarray, end: np.ndarray, key: np.ndarray, counter: np.ndarray) -> list[tuple]:
    """Draw arcs from every starting slot to its chunk's end: (walker, slot, length) arrays per step."""
    who, out = np.arange(len(slot)), []
    step = 0
    while len(who):
        u = uniform(key[who], counter[who] + np.uint64(step))
        length = 1 + lattice.likeliest[slot]
        other = np.flatnonzero(u >= lattice.of_likeliest[slot])
        if len(other):
            length[other] = 1 + other_arcs(lattice, slot[other], u[other])
        out.append((who, slot, length))
        slot = slot + length
        going = slot < end[who]
        who, slot = who[going], slot[going]
        step += 1
    return out


def search(
    lattice: Lattice, occurrences: list[np.ndarray], keys: np.ndarray, k: int
) -> Iterator[tuple[int, int, Path, float, float]]:
    """(text, rank, path, perturbed value, log of the inclusion probability) of k samples per text.

    `occurrences` holds the chunk numbers of each text. Texts advance together, one sample a round. The
    inclusion probability of a sample is that of a perturbed value above the first one not emitted.
    """
    n = len(occurrences)
    heaps: list[list[tuple]] = [[] for _ in range(n)]
    emitted: list[list[tuple[Path, float]]] = [[] for _ in range(n)]
    chunks = np.concatenate([np.zeros(0, np.int64), *occurrences])
    n_chunks = np.array([len(o) for o in occurrences], np.int64)
    first_chunk = np.cumsum(n_chunks) - n_chunks
    arcs = np.arange(lattice.probability.shape[1])
    root = -np.log(-np.log(uniform(keys, np.full(n, 2**40, np.uint64))))
    for i in range(n):
        heappush(heaps[i], (-float(root[i]), 0, None, 0, 0))
    for rank in range(k):
        opened = [(i, heappop(heaps[i])) for i in range(n) if heaps[i]]
        if not opened:
            break
        text = np.array([i for i, _ in opened])
        # Sets that are a part of another: they keep its path's steps before t and take another arc there.
        split = np.array([j for j, (_, node) in enumerate(opened) if node[2] is not None], np.int64)
        nodes = [opened[j][1] for j in split]
        skipped = np.zeros(len(opened), np.int64)
        skipped[split] = [base.occurrence[t] for _, _, base, t, _ in nodes]
        fork = np.array([base.slot[t] for _, _, base, t, _ in nodes], np.int64)
        gone = (np.array([banned for *_, banned in nodes], np.int64)[:, None] >> arcs) & 1 == 1
        shares = lattice.probability[fork]
        total = np.cumsum(np.where(gone, 0, shares), axis=1)
        u = uniform(keys[text[split]], np.full(len(split), 2**41 + 7919 * rank, np.uint64)) * total[:, -1]
        turn = 1 + (u[:, None] >= total).sum(axis=1)
        left = n_chunks[text] - skipped
        begin = np.cumsum(left) - left
        who = np.repeat(np.arange(len(opened)), left)
        number = np.arange(len(who)) - (begin - skipped)[who]
        chunk = chunks[first_chunk[text][who] + number]
        flat, ends = lattice.start[chunk], lattice.end[chunk]
        flat[begin[split]] = fork + turn
        live = np.flatnonzero(flat < ends)
        counter = (number.astype(np.uint64) << np.uint64(12)) + (np.uint64(rank + 1) << np.uint64(44))
        steps = walk(lattice, flat[live], ends[live], keys[text[who[live]]], counter[live])
        walker = np.concatenate([begin[split], *(live[s[0]] for s in steps)])
        slot = np.concatenate([fork, *(s[1] for s in steps)])
        length = np.concatenate([turn, *(s[2] for s in steps)])
        order = np.argsort(walker, kind="stable")  # the steps of a walker are in order already
        walker, slot, length = walker[order], slot[order], length[order]
        bounds = np.searchsorted(walker, np.append(begin, len(who)))
        p = lattice.probability[slot, length - 1]
        log_p, occurrence = np.log(p), number[walker]
        after = log_p.copy()
        for j, (_, _, base, t, _) in zip(split, nodes, strict=True):
            if t:
                after[bounds[j]] += base.log_after[t - 1]
        parts = [slice(a, b) for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)]
        for part in parts:
            np.cumsum(after[part], out=after[part])
        rest = 1 - p
        rest[bounds[split]] -= np.where(gone, shares, 0).sum(axis=1)
        can = np.flatnonzero(rest > TINY)
        of = who[walker[can]]
        at = can - bounds[of]
        phi = after[can] - log_p[can] + np.log(rest[can])
        draw = uniform(keys[text[of]], (np.uint64(rank + 1) << np.uint64(52)) + at.astype(np.uint64))
        # A Gumbel with location phi below the set's value, in logarithms as phi may be far below.
        value = np.array([-minus for _, (minus, *_) in opened])[of]
        g = phi - np.logaddexp(phi - value, np.log(-np.log(draw)))
        found = np.searchsorted(can, bounds).tolist()
        for j, (i, (minus, _, base, t, banned)) in enumerate(opened):
            part = parts[j]
            fields = [occurrence[part], slot[part], length[part], log_p[part], after[part]]
            if base is not None:
                before = (base.occurrence, base.slot, base.length, base.log_arc, base.log_after)
                fields = [np.concatenate([b[:t], f]) for b, f in zip(before, fields, strict=True)]
            path = Path(*fields, float(fields[3].sum()))
            emitted[i].append((path, -minus))
            for x in largest(g[found[j] : found[j + 1]], k - rank):
                x += found[j]
                step = int(at[x])
                used = 1 << int(path.length[t + step]) - 1 | (banned if step == 0 and base is not None else 0)
                heappush(heaps[i], (-float(g[x]), rank + 1, path, t + step, used))
    for i in range(n):
        limit = -heaps[i][0][0] if heaps[i] else -np.inf
        for rank, (path, value) in enumerate(emitted[i]):
            x = path.log_prob - limit
            included = 0.0 if x > 30 else x if x < -30 else float(np.log(-np.expm1(-np.exp(x))))
            yield i, rank + 1, path, value, included


def largest(g: np.ndarray, n: int) -> list[int]:
    """Places of the n largest numbers, the largest first."""
    if n == 1:
        return [int(g.argmax())] if len(g) else []
    some = np.argpartition(-g, n)[:n] if n < len(g) else np.arange(len(g))
    return some[np.argsort(-g[some], kind="stable")].tolist()


def spelled(lattice: Lattice, slot: np.ndarray, ids: np.ndarray, model: PieceModel) -> tuple[np.ndarray, np.ndarray]:
    """The characters that pieces at these slots spell, one after another, and how many each has.

    A character in several bytes is read from the lattice.
    """
    known = np.maximum(ids, 0)
    sizes = np.where(ids >= 0, model.sizes[known], 1)
    before = np.cumsum(sizes) - sizes
    codes = model.codes[np.repeat(model.offsets[known] - before, sizes) + np.arange(int(sizes.sum()))]
    in_bytes = np.flatnonzero(ids < 0)
    codes[before[in_bytes]] = lattice.code[slot[in_bytes]]
    return codes, sizes


def piece_ids(lattice: Lattice, slot: np.ndarray, ids: np.ndarray, model: PieceModel) -> np.ndarray:
    """The ids of a path; a character without a piece of its own is its UTF-8 bytes."""
    if not len(ids) or ids.min() >= 0:
        return ids
    first = int(model.byte_ids[0])
    out: list[int] = []
    for i, at in zip(ids.tolist(), slot.tolist(), strict=True):
        out += [i] if i >= 0 else [first + b for b in chr(lattice.code[at]).encode()]
    return np.array(out, np.int32)


def portions(batches: Iterator[pa.RecordBatch], chars: int = 800_000) -> Iterator[tuple[list[int | None], pa.Array]]:
    """doc_ids and texts (NULL: empty) of consecutive rows, of about `chars` characters; a longer text is by itself."""
    for batch in slices(batches):
        ids = batch.column("doc_id").to_pylist()
        texts = pc.fill_null(batch.column("text").cast(pa.large_string()), "")
        start, size = 0, 0
        for i, n in enumerate(pc.utf8_length(texts).to_pylist()):
            if i > start and size + n > chars:
                yield ids[start:i], texts.slice(start, i - start)
                start, size = i, 0
            size += n
        if len(ids) > start:
            yield ids[start:], texts.slice(start)


def marked(texts: pa.Array) -> pa.Array:
    """Texts as encoding sees them: a word mark in front and in place of each space."""
    spaced = pc.replace_substring(texts, " ", MARK)
    return pc.binary_join_element_wise(pa.scalar(MARK, spaced.type), spaced, pa.scalar("", spaced.type))


def chunked(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The chunks of marked texts, one after another, and each text's number of chunks.

    A chunk begins at a text's beginning and at each word mark that follows no other mark of its text.
    """
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    raw = np.frombuffer(data or b"", np.uint8)[: offsets[-1]]
    mark = np.frombuffer(MARK.encode(), np.uint8)
    at = np.flatnonzero(raw[: 1 - len(mark)] == mark[0])
    at = at[(raw[at + 1] == mark[1]) & (raw[at + 2] == mark[2])]
    follows = np.append(False, at[1:] == at[:-1] + len(mark))
    follows[np.searchsorted(at, offsets[:-1])] = False
    begins = at[~follows]
    n_chunks = np.diff(np.searchsorted(begins, offsets))
    begins = np.append(begins, offsets[-1])
    return pa.LargeStringArray.from_buffers(len(begins) - 1, pa.py_buffer(begins), data), n_chunks


def chunks_of(text: str) -> list[str]:
    return chunked(marked(pa.array([text], pa.large_string())))[0].to_pylist() if text else []


def sample(docs: DataFrame, config: SegmentConfig = DEFAULT, with_ids: bool = True) -> DataFrame:
    """doc_id, rank, n_pieces, ids_crc32, log_prob, perturbed, log_inclusion, round_trip and `ids`.

    Up to `k` distinct segmentations of every whole text, the one with the largest perturbed value
    first; fewer where the text has fewer. A NULL or empty text has one, without pieces. Rows with equal
    doc_id and text get equal samples; rows without doc_id share one key. `round_trip` says that decoding
    gives the text back (a word mark that is written in the text itself comes back as a space). Values
    are computed in double precision; sets with a relative mass under 1e-13 count as empty.
    """
    k, seed, path, temperature = config.k, config.seed, config.path, config.temperature
    numbers = ["log_prob", "perturbed", "log_inclusion"]
    names = ["doc_id", "rank", "n_pieces", "ids_crc32", *numbers, "round_trip", *(["ids"] if with_ids else [])]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = worker_cache(f"pieces {path} {temperature}", lambda: PieceModel(path, temperature))
        for doc_ids, texts in portions(batches):
            keys = np.array([xxhash.xxh3_64_intdigest(f"{seed} {d}") for d in doc_ids], np.uint64)
            sizes = pc.utf8_length(texts).to_numpy()
            filled = np.flatnonzero(sizes)
            rows = [(doc_ids[i], 1, 0, 0, 0.0, 0.0, 0.0, True) for i in np.flatnonzero(sizes == 0)]
            parts = [np.zeros(0, np.int32)] * len(rows)
            if len(filled):
                given = marked(texts.take(filled))
                chunks, n_chunks = chunked(given)
                coded = chunks.dictionary_encode()
                lattice = Lattice(coded.dictionary, model)
                occurrences = np.split(coded.indices.to_numpy().astype(np.int64), np.cumsum(n_chunks)[:-1])
                found = list(search(lattice, occurrences, keys[filled], k))
                slots = np.concatenate([taken.slot for _, _, taken, _, _ in found])
                arcs = lattice.ids[slots, np.concatenate([taken.length for _, _, taken, _, _ in found]) - 1]
                codes, spelt = spelled(lattice, slots, arcs, model)
                ends = np.cumsum([len(taken.slot) for _, _, taken, _, _ in found])
                ends_of_codes = np.cumsum(spelt)[ends - 1].tolist()
                whole = np.split(code_points(given), np.cumsum(sizes[filled] + 1)[:-1])
                a = c = 0
                for (j, rank, taken, value, included), b, d in zip(found, ends.tolist(), ends_of_codes, strict=True):
                    same = np.array_equal(codes[c:d], whole[j])
                    ids = piece_ids(lattice, slots[a:b], arcs[a:b], model)
                    crc = zlib.crc32(np.ascontiguousarray(ids, "<i4").data)
                    rows.append((doc_ids[filled[j]], rank, len(ids), crc, taken.log_prob, value, included, same))
                    parts.append(ids)
                    a, c = b, d
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), *[pa.float64()] * 3, pa.bool_()]
            columns = list(zip(*rows, strict=True)) or [()] * len(kinds)
            arrays = [pa.array(c, kind) for c, kind in zip(columns, kinds, strict=True)]
            ends = np.cumsum([0, *map(len, parts)]).astype(np.int32)
            arrays.append(pa.ListArray.from_arrays(ends, pa.array(np.concatenate([np.zeros(0, np.int32), *parts]))))
            yield pa.RecordBatch.from_arrays(arrays[: len(names)], names)

    schema = (
        "doc_id bigint, rank int, n_pieces bigint, ids_crc32 bigint, log_prob double, perturbed double, "
        "log_inclusion double, round_trip boolean" + (", ids array<int>" if with_ids else "")
    )
    return docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string")).mapInArrow(run, schema)

"""Language-model scoring with a log-frequency Bloom filter.

Counts of words and word pairs are quantised to a logarithmic scale and stored in a Bloom
filter: an n-gram of level q is inserted with the suffixes 1..q, and a count is read back by
probing levels until one misses (doubling steps, then halving).  The filter has no keys, only bits, and is
built in segments by the tasks that count; it grows with the n-grams.  A hit may be chance, and after one context
the whole vocabulary may hit; the expected number of such hits, known from the filter's fill, enters every
context's count, and a context's pairs weigh as much as its count outweighs them, so that the probabilities
after every context sum to one at every size of filter and vocabulary.  Up to a bound it is broadcast to the
scorers; beyond it the distinct n-grams of the texts are sent to the segments and their levels back.

Exact word counts serve the add-one baseline: frequent words (a bounded number of them) are
broadcast, the rest are joined.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import arrays as A
from .store import Shared, col, drop_held, materialise, partitions

_U = np.uint64


@dataclass(frozen=True)
class Params:
    """word_ratio, pair_ratio: steps of the scales above the counts that they hold exactly.  pair_min: least count of a pair in the model.  bits: filter bits per insertion, which set the probes.
    More of them leave less to chance and let rarer contexts' pairs count.  max_bytes: a larger
    filter is not broadcast but asked by shuffle, with the same levels.  pair_weight: largest weight of the pair estimate.  frequent: words whose share of
    all tokens is above 1 / frequent are broadcast with exact counts, so at most so many.
    held_mod, held_rest: documents with crc32(id) mod held_mod = held_rest are not learned from.
    flush: distinct n-grams a task holds before it sends them on.
    """

    word_ratio: float = 1.04
    pair_ratio: float = 1.12
    pair_min: int = 1
    bits: float = 12.0
    max_bytes: int = 1 << 28
    pair_weight: float = 0.3
    frequent: int = 1 << 20
    held_mod: int = 7
    held_rest: int = 2
    flush: int = 1 << 20


END = A.mix64(np.array([0x5EED], _U))  # the end token's hash
_BEGIN = A.mix64(np.array([0xBE61], _U))  # context of a text's first token


def tokens(buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(token hashes with an end after each text, context hashes, offsets per text)."""
    h, woff = A.words(buf, off)
    toff = woff + np.arange(len(woff))
    out = np.empty(toff[-1], _U)
    ends = toff[1:] - 1
    inner = np.ones(len(out), bool)
    inner[ends] = False
    out[inner], out[ends] = h, END
    context = np.empty_like(out)
    context[1:] = out[:-1]
    context[toff[:-1]] = _BEGIN
    return out, context, toff


def pair_key(context: np.ndarray, token: np.ndarray) -> np.ndarray:
    return A.mix64(context * _U(0x8CB92BA72F3D8DD7) ^ (token + _U(0x2545F4914F6CDD1D)))


def held_out(ids: list, p: Params) -> np.ndarray:
    return np.array([i is not None and zlib.crc32(b"%d" % i) % p.held_mod == p.held_rest for i in ids], bool)


# --- counting -----------------------------------------------------------------------------

WORDS = T.StructType([T.StructField("h", T.LongType()), T.StructField("c", T.LongType()), T.StructField("seen", T.LongType())])
PAIRS = T.StructType([T.StructField("part", T.IntegerType()), T.StructField("keys", T.BinaryType()), T.StructField("counts", T.BinaryType())])


def _merge(keys: list[np.ndarray], weights: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys and their summed weights.  Both lists are emptied."""
    k, w = np.concatenate(keys), np.concatenate(weights)
    keys.clear()
    weights.clear()
    if not len(k):
        return k, w
    order = np.argsort(k, kind="stable")
    k, w = k[order], w[order]
    first = np.flatnonzero(np.append(True, k[1:] != k[:-1]))
    return k[first], np.add.reduceat(w, first)


class _Counts:
    """Distinct keys with weights, merged whenever enough have been added."""

    def __init__(self):
        self.keys, self.weights, self.fresh = [], [], 0

    def add(self, keys: np.ndarray, weights: np.ndarray) -> None:
        self.keys.append(keys)
        self.weights.append(weights)
        self.fresh += len(keys)

    def take(self) -> tuple[np.ndarray, np.ndarray]:
        keys, weights = self.keys, self.weights
        self.keys, self.weights, self.fresh = [], [], 0
        return _merge(keys, weights) if keys else (np.empty(0, _U), np.empty(0, np.int64))


#: Rows whose texts are copied out of an Arrow batch at once, and bytes of text scored at once.
SLICE, SCORED_CHUNK = 1000, A.CHUNK // 4
#: Most keys of a packed row: some 300 KB, so that the JVM, Arrow and Parquet need no large buffer for one.
PACKED = 1 << 15
_HELD = ("n-gram filter", "frequent words")  # kinds of what workers hold of a model


def _lean(run: Callable, drop: tuple[str, ...] = ()) -> Callable:
    """``run`` in a worker that gives freed memory back before and after it.

    Workers stay alive between stages beside a grown JVM.  ``drop`` names what they hold of a former model."""

    def lean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        drop_held(*drop)
        A.release()
        try:
            yield from run(batches)
        finally:
            A.release()

    return lean


def _pieces(part: np.ndarray, parts: int) -> list[tuple[int, int, int]]:
    """(part, from, to) of the runs of equal parts in sorted ``part``, cut after ``PACKED`` keys."""
    edge = np.searchsorted(part, np.arange(parts + 1, dtype=part.dtype)).tolist()
    return [(s, lo, min(lo + PACKED, hi)) for s, (at, hi) in enumerate(zip(edge[:-1], edge[1:], strict=True)) for lo in range(at, hi, PACKED)]


def _packed(batch: pa.RecordBatch) -> Iterator[list]:
    """The rows of a batch, binary values as views of its memory."""
    views = [pa.types.is_binary(c.type) for c in batch.columns]
    for i in range(batch.num_rows):
        yield [c[i].as_buffer() if view else c[i].as_py() for c, view in zip(batch.columns, views, strict=True)]


def _batches(batches, p: Params, limit: int = A.CHUNK):
    """(token hashes, contexts, offsets, ids, held, first row) by chunk of texts."""
    for batch in batches:
        for first in range(0, batch.num_rows, SLICE):
            part = batch.slice(first, SLICE)
            buf, off = A.text_buffer(part.column(1))
            ids = part.column(0).to_pylist()
            held = held_out(ids, p)
            for lo, hi in A.doc_chunks(off, limit):
                tok, ctx, toff = tokens(buf[off[lo] : off[hi]], off[lo : hi + 1] - off[lo])
                yield tok, ctx, toff, ids[lo:hi], held[lo:hi], first + lo


def _count_words(p: Params):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = _Counts()

        def out():
            k, w = counts.take()
            return pa.RecordBatch.from_arrays([pa.array(k.view(np.int64)), pa.array(w >> 32), pa.array(w & 0xFFFFFFFF)], names=WORDS.names)

        held_size = 0
        for tok, _, toff, _, held, _ in _batches(batches, p):
            learn = np.repeat(~held, np.diff(toff))
            # One weight holds both counts: learned above, all below.
            k, inv = np.unique(tok, return_inverse=True)
            seen = np.bincount(inv, minlength=len(k)).astype(np.int64)
            c = np.bincount(inv[learn], minlength=len(k)).astype(np.int64)
            counts.add(k, (c << 32) + seen)
            if counts.fresh > held_size + p.flush // 2:
                k, w = counts.take()
                counts.add(k, w)
                held_size = len(k)
                if len(k) > p.flush:
                    yield out()
                    held_size = 0
        yield out()

    return run


def _count_pairs(p: Params, parts: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held_keys: list[np.ndarray] = []
        size = 0

        def out():
            k = np.concatenate(held_keys)
            held_keys.clear()
            k.sort()
            first = np.flatnonzero(np.append(True, k[1:] != k[:-1]))
            n = np.minimum(np.diff(np.append(first, len(k))), 0xFFFFFFFF).astype(np.uint32)
            k = k[first]
            # The top bits name the part, so the parts are runs of the sorted keys.
            part = (k >> _U(32)) * _U(parts) >> _U(32)
            some = _pieces(part, parts)
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([s for s, _, _ in some], pa.int32()),
                    pa.array([k[lo:hi].tobytes() for _, lo, hi in some], pa.binary()),
                    pa.array([_pack(n[lo:hi]) for _, lo, hi in some], pa.binary()),
                ],
                names=PAIRS.names,
            )

        for tok, ctx, toff, _, held, _ in _batches(batches, p):
            learn = np.repeat(~held, np.diff(toff))
            held_keys.append(pair_key(ctx[learn], tok[learn]))
            size += len(held_keys[-1])
            if size > 2 * p.flush:
                yield out()
                held_keys, size = [], 0
        if size:
            yield out()

    return run


def _pack(n: np.ndarray) -> bytes:
    """Counts as one byte each; 255 marks those that follow at the end as four bytes."""
    return np.minimum(n, 255).astype(np.uint8).tobytes() + n[n >= 255].astype(np.uint32).tobytes()


def _unpack(raw: bytes, size: int) -> np.ndarray:
    n = np.frombuffer(raw, np.uint8, size).astype(np.int64)
    n[n == 255] = np.frombuffer(raw, np.uint32, offset=size)
    return n


# --- the filter ----------------------------------------------------------------------------


def level_of(count: np.ndarray, base: float) -> np.ndarray:
    """1 for a count of 1, then one more for every factor of ``base``."""
    return 1 + np.floor(np.log(np.maximum(count, 1)) / np.log(base) + 1e-9).astype(np.int64)


def count_of(level: np.ndarray, base: float) -> np.ndarray:
    """The geometric middle of the whole counts that a level stands for; 0 for level 0."""
    low = np.ceil(np.power(base, level - 1.0) - 1e-9)
    high = np.maximum(np.ceil(np.power(base, level * 1.0) - 1e-9) - 1, low)
    return np.where(level > 0, np.sqrt(low * high), 0.0)


def _steps(ratio: float) -> np.ndarray:
    """Least counts of the levels 1, 2, ...: every whole number while ``ratio`` asks for smaller steps."""
    lows = [1]
    while lows[-1] < 1 << 52:
        lows.append(max(lows[-1] + 1, int(np.ceil(lows[-1] * ratio))))
    return np.array(lows, np.int64)


_STEPS: dict[float, np.ndarray] = {}


def steps(ratio: float) -> np.ndarray:
    if ratio not in _STEPS:
        _STEPS[ratio] = _steps(ratio)
    return _STEPS[ratio]


def step_of(count: np.ndarray, ratio: float) -> np.ndarray:
    return np.searchsorted(steps(ratio), count, "right")


def step_count(level: np.ndarray, ratio: float) -> np.ndarray:
    """The geometric middle of the whole counts of a level; 0 for level 0."""
    lows = steps(ratio)
    at = np.clip(level, 1, len(lows) - 1) - 1
    return np.where(level > 0, np.sqrt(lows[at] * (lows[at + 1] - 1.0)), 0.0)


def _spots(key: np.ndarray, level: int | np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two hashes of (key, level), from which all probes follow."""
    a = A.mix64(key + np.asarray(level).astype(_U) * _U(0x9E3779B97F4A7C15))
    return a, A.mix64(a ^ _U(0x94D049BB133111EB)) | _U(1)


def _position(a: np.ndarray, bits: int) -> np.ndarray:
    """Bit in a segment of at most 2**32 bits."""
    at = a >> _U(32)
    at *= _U(bits)
    at >>= _U(32)
    return at


class Filter:
    """Segments of bits; a key's top bits choose its segment.  Levels read before are kept for the commonest keys."""

    #: Most keys kept, and bytes of bits for each.
    KEPT, KEPT_PER = 1 << 20, 128

    def __init__(self, segments: list[np.ndarray] | np.ndarray, bits: int, probes: int):
        # One array is taken as it is: workers hold the broadcast filter once.
        self.bytes = segments if isinstance(segments, np.ndarray) else np.concatenate(segments)
        self.bits, self.probes, self.parts = bits, probes, 8 * len(self.bytes) // bits
        size = 1 << max(2, min(len(self.bytes) // self.KEPT_PER, self.KEPT)).bit_length() - 1
        self.kept, self.kept_level = np.zeros(size, _U), np.zeros(size, np.uint16)
        self.kept[0] = 1  # like the zeros elsewhere, no key of its place

    def has(self, key: np.ndarray, level: int | np.ndarray) -> np.ndarray:
        """Whether every probe of (key, level) hits."""
        a, b = _spots(key, level)
        base = ((key >> _U(32)) * _U(self.parts) >> _U(32)) * _U(self.bits)
        left = np.arange(len(key))
        for probe in range(self.probes):
            if probe:
                a += b  # double hashing
            at = _position(a, self.bits)
            at += base
            on = self.bytes.take((at >> _U(3)).view(np.int64))
            at &= _U(7)
            on >>= at.astype(np.uint8)
            on &= np.uint8(1)
            on = np.flatnonzero(on)
            if len(on) < len(left):
                left, a, b, base = left[on], a[on], b[on], base[on]
                if not len(left):
                    break
        out = np.zeros(len(key), bool)
        out[left] = True
        return out

    def levels(self, key: np.ndarray) -> np.ndarray:
        """The stored level of every key, 0 if level 1 misses (too high by chance, never too low).

        Of keys with one place the one of the highest level is kept: it costs most and comes most often."""
        at = (key & _U(len(self.kept) - 1)).view(np.int64)
        out = self.kept_level[at].astype(np.int64)
        new = np.flatnonzero(self.kept[at] != key)
        if len(new):
            key, at = key[new], at[new]
            out[new] = level = self._read(key)
            more = np.flatnonzero(level > self.kept_level[at])
            at = at[more]
            self.kept[at], self.kept_level[at] = key[more], level[more]
        return out

    def _read(self, key: np.ndarray) -> np.ndarray:
        """The levels of keys from the bits.

        All levels up to a key's own are set: doubled levels are asked until one misses, then the gap is halved."""
        out = np.zeros(len(key), np.int64)
        live = np.flatnonzero(self.has(key, 1))
        out[live] = 1
        low, high = [], []
        while len(live):
            on = self.has(key[live], 2 * out[live])
            low.append(live[~on])
            live = live[on]
            out[live] *= 2
            if len(live) and int(out[live[0]]) >= 1 << 11:  # above every level there is
                break
        open_ = np.concatenate(low) if low else np.empty(0, np.int64)
        high = 2 * out[open_]
        while len(open_):
            wide = high - out[open_] > 1
            open_, high = open_[wide], high[wide]
            middle = (out[open_] + high) // 2
            on = self.has(key[open_], middle)
            out[open_[on]] = middle[on]
            high = np.where(on, high, middle)
        return out


def segment(keys: np.ndarray, levels: np.ndarray, bits: int, probes: int) -> np.ndarray:
    """The bits of one segment holding ``keys`` at their ``levels``, packed to bytes."""
    field = np.zeros(bits, bool)
    level = 0
    while len(keys):
        level += 1
        on = levels >= level
        keys, levels = keys[on], levels[on]
        a, b = _spots(keys, level)
        for probe in range(probes):
            if probe:
                a += b
            field[_position(a, bits).view(np.int64)] = True
    return np.packbits(field, bitorder="little")


SEGMENT = T.StructType([T.StructField("part", T.IntegerType()), T.StructField("bits", T.BinaryType()), T.StructField("ones", T.LongType())])
KEPT = T.StructType([T.StructField("part", T.IntegerType()), T.StructField("keys", T.BinaryType()), T.StructField("levels", T.BinaryType()), T.StructField("inserts", T.LongType())])


def _kept_pairs(p: Params):
    """Sorted rows (part, keys, counts) of one part merged: keys with their levels."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, counts = None, _Counts()

        def out():
            k, n = counts.take()
            k, n = k[n >= p.pair_min], n[n >= p.pair_min]
            level = step_of(n, p.pair_ratio)
            for at in range(0, max(len(k), 1), PACKED):
                q = level[at : at + PACKED]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([now], pa.int32()), pa.array([k[at : at + PACKED].tobytes()], pa.binary()), pa.array([q.astype(np.uint16).tobytes()], pa.binary()), pa.array([int(q.sum())], pa.int64())],
                    names=KEPT.names,
                )

        held = 0
        for batch in batches:
            for part, keys, n in _packed(batch):
                if part != now:
                    if now is not None:
                        yield from out()
                    now, held = part, 0
                k = np.frombuffer(keys, _U)
                counts.add(k, _unpack(n, len(k)))
                if counts.fresh > 2 * held + p.flush:
                    k, w = counts.take()
                    counts.add(k, w)
                    held = len(k)
        if now is not None:
            yield from out()

    return run


def _segments(bits: int, probes: int):
    """Rows (part, keys, levels) sorted by part: one segment for each part."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, keys, levels = None, [], []

        def out():
            made = segment(np.concatenate(keys), np.concatenate(levels), bits, probes)
            ones = int(np.bitwise_count(made).sum())
            return pa.RecordBatch.from_arrays([pa.array([now], pa.int32()), pa.array([made.tobytes()], pa.binary()), pa.array([ones], pa.int64())], names=SEGMENT.names)

        for batch in batches:
            for part, k, q in _packed(batch):
                if part != now:
                    if now is not None:
                        yield out()
                    now, keys, levels = part, [], []
                keys.append(np.frombuffer(k, _U))
                levels.append(np.frombuffer(q, np.uint16))
        if now is not None:
            yield out()

    return run


def _word_rows(p: Params, parts: int):
    """Word counts as packed rows (part, keys, levels)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            k = batch.column(0).to_numpy().view(_U)
            q = step_of(batch.column(1).to_numpy(), p.word_ratio).astype(np.uint16)
            part = ((k >> _U(32)) * _U(parts) >> _U(32)).astype(np.int64)
            order = np.argsort(part, kind="stable")
            k, q, part = k[order], q[order], part[order]
            some = _pieces(part, parts)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([s for s, _, _ in some], pa.int32()),
                    pa.array([k[lo:hi].tobytes() for _, lo, hi in some], pa.binary()),
                    pa.array([q[lo:hi].tobytes() for _, lo, hi in some], pa.binary()),
                    pa.array([int(q[lo:hi].astype(np.int64).sum()) for _, lo, hi in some], pa.int64()),
                ],
                names=KEPT.names,
            )

    return run


def _read_counts(p: Params):
    """The sum of all learned words' counts as the filter gives them back, plus one for each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = 0.0
        for batch in batches:
            total += float((step_count(step_of(batch.column(0).to_numpy(), p.word_ratio), p.word_ratio) + 1).sum())
        yield pa.RecordBatch.from_pydict({"mass": [total]})

    return run


@dataclass
class Model:
    """counts: (h, c, seen) by word; total: learned tokens; vocabulary: distinct ones.
    filter: broadcast, or the table of its segments (part, bits) with parts of that many bits.
    mass: what the words' read counts, each plus one, and one for all unknown words sum to.
    excess: expected chance hits of the vocabulary after one context, from the filter's fill."""

    counts: DataFrame
    total: int
    vocabulary: int
    seen: int
    filter: Shared | DataFrame
    params: Params
    parts: int
    bits: int
    probes: int
    mass: float
    excess: float


def fit(docs: DataFrame, p: Params | None = None, id_col: str = "doc_id", text_col: str = "text") -> Model:
    """Count the words and word pairs of all documents that are not held out and build the filter."""
    p = p or Params()
    parts = partitions(docs)
    src = docs.select(col(id_col).cast("long").alias("doc_id"), col(text_col).alias("text"))
    counts = src.mapInArrow(_lean(_count_words(p), _HELD), WORDS).groupBy("h").agg(F.sum("c").alias("c"), F.sum("seen").alias("seen"))
    counts = materialise(counts, "word-counts")
    total, vocabulary, seen = counts.agg(F.sum("c"), F.count_if(F.col("c") > 0), F.sum("seen")).first()
    total, vocabulary, seen = total or 0, vocabulary or 0, seen or 0

    # Word pairs travel as packed arrays, one for each task and part.
    sent = src.mapInArrow(_lean(_count_pairs(p, parts)), PAIRS).repartition(parts, "part").sortWithinPartitions("part")
    words = counts.where("c > 0").select("h", "c").mapInArrow(_lean(_word_rows(p, parts)), KEPT)
    kept = materialise(sent.mapInArrow(_lean(_kept_pairs(p)), KEPT).union(words), "ngrams")
    inserts = kept.agg(F.sum("inserts")).first()[0] or 0
    read = counts.where("c > 0").select("c").mapInArrow(_read_counts(p), "mass double")
    mass = 1.0 + (read.agg(F.sum("mass")).first()[0] or 0.0)
    # Half of the bits are set then: an absent n-gram hits with probability 2**-probes.
    probes = max(1, round(p.bits * float(np.log(2))))
    bits = max(64, int(inserts * p.bits / parts) // 64 * 64)
    made = kept.select("part", "keys", "levels").repartition(parts, "part").sortWithinPartitions("part")
    made = made.mapInArrow(_lean(_segments(bits, probes)), SEGMENT)

    def excess(ones: int) -> float:
        return vocabulary * (ones / (parts * bits)) ** probes

    if parts * bits > 8 * p.max_bytes:
        made = materialise(made, "segments")
        ones = made.agg(F.sum("ones")).first()[0] or 0
        return Model(counts, total, vocabulary, seen, made.select("part", "bits"), p, parts, bits, probes, mass, excess(ones))
    whole, ones = np.zeros(parts * bits // 8, np.uint8), 0  # at most max_bytes, gathered part by part
    for r in materialise(made, "segments").toLocalIterator():
        at = r["part"] * bits // 8
        whole[at : at + bits // 8] = np.frombuffer(r["bits"], np.uint8)
        ones += r["ones"]
    return Model(counts, total, vocabulary, seen, Shared(docs, _HELD[0], (whole, bits)), p, parts, bits, probes, mass, excess(ones))


# --- scoring -------------------------------------------------------------------------------

PARTIAL = T.StructType(
    [
        T.StructField("row", T.LongType()),
        T.StructField("doc_id", T.LongType()),
        T.StructField("held_out", T.BooleanType()),
        T.StructField("n_tokens", T.LongType()),
        T.StructField("n_known", T.LongType()),
        T.StructField("base", T.DoubleType()),
        T.StructField("score", T.DoubleType()),
        T.StructField("rare", T.ArrayType(T.LongType())),
    ]
)

def probabilities(tok, ctx, own, before, levels: Callable, mass: float, excess: float, p: Params) -> np.ndarray:
    """The smoothed probability of every token after its context (own, before: read counts of token and context).

    After a seen context the pairs' read counts sum to about its count and the expected chance hits; their share
    of the mass is the largest weight times the count's part of that sum.  After any other the words alone share
    everything.  In both cases the vocabulary and one unknown word sum to one."""
    word = (own + 1) / mass
    kk, kinv = np.unique(pair_key(ctx, tok), return_inverse=True)
    both = step_count(levels(kk), p.pair_ratio)[kinv]
    whole = np.maximum(before + excess, 1e-9)
    weight = p.pair_weight * before / whole
    mixed = weight * both / whole + (1 - weight) * word
    return np.where(before > 0, mixed, word)


@dataclass(frozen=True)
class Scorer:
    """What tasks need of a model beside its filter and counts."""

    params: Params
    total: int
    vocabulary: int
    probes: int
    mass: float
    excess: float


def _log_probs(k, inv, ctx, levels: Callable, mass: float, excess: float, p: Params) -> np.ndarray:
    """log10 of the probability of every token of a chunk (distinct tokens k, places inv), from the levels alone."""
    tok = k[inv]
    # Before a text's first token stands another text's end token, whose count is the number of texts.
    own = step_count(levels(k), p.word_ratio)[inv]
    return np.log10(probabilities(tok, ctx, own, np.roll(own, 1), levels, mass, excess, p))


def _scored(tok, ctx, toff, ids, held, rows, levels: Callable, frequent, m: Scorer) -> pa.RecordBatch:
    """The scores of a chunk of texts."""
    common, common_count = frequent
    size = np.log10(m.total + m.vocabulary + 1.0)
    k, inv = np.unique(tok, return_inverse=True)
    score = np.add.reduceat(_log_probs(k, inv, ctx, levels, m.mass, m.excess, m.params), toff[:-1])
    at = np.minimum(np.searchsorted(common, k), max(len(common) - 1, 0))
    hit = common[at] == k if len(common) else np.zeros(len(k), bool)
    c = np.where(hit, common_count[at], 0) if len(common) else np.zeros(len(k))
    hit, c = hit[inv], c[inv]
    base = np.add.reduceat(np.where(hit, np.log10(c + 1.0) - size, 0.0), toff[:-1])
    known = np.add.reduceat(hit & (c > 0), toff[:-1], dtype=np.int64)
    rare = tok[~hit].view(np.int64)
    roff = np.concatenate([[0], np.cumsum(~hit)])[toff].astype(np.int32)
    return pa.RecordBatch.from_arrays(
        [
            rows,
            pa.array(ids, pa.int64()),
            pa.array(held),
            pa.array(np.diff(toff)),
            pa.array(known),
            pa.array(base),
            pa.array(score),
            pa.ListArray.from_arrays(pa.array(roff), pa.array(rare)),
        ],
        names=PARTIAL.names,
    )


def _score(m: Scorer, model_filter: Shared, frequent: Shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bloom = model_filter.get(lambda value: Filter(*value, m.probes))
        for batch in batches:
            for tok, ctx, toff, ids, held, lo in _batches([batch], m.params, SCORED_CHUNK):
                rows = batch.column(2).slice(lo, len(ids))
                yield _scored(tok, ctx, toff, ids, held, rows, bloom.levels, frequent.get(), m)

    return run


# --- scoring by shuffle ---------------------------------------------------------------------

CHUNKS = T.StructType(
    [
        T.StructField("chunk", T.LongType()),
        T.StructField("tokens", T.BinaryType()),
        T.StructField("offsets", T.BinaryType()),
        T.StructField("ids", T.ArrayType(T.LongType())),
        T.StructField("rows", T.ArrayType(T.LongType())),
    ]
)
ASKED = T.StructType([T.StructField("part", T.IntegerType()), T.StructField("chunk", T.LongType()), T.StructField("keys", T.BinaryType())])
TOLD = T.StructType([T.StructField("chunk", T.LongType()), T.StructField("part", T.IntegerType()), T.StructField("levels", T.BinaryType())])


def _chunks(p: Params):
    """Chunks of texts as token hashes, named by their first row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for tok, _, toff, ids, _, lo in _batches([batch], p):
                rows = batch.column(2).slice(lo, len(ids)).to_pylist()
                yield pa.RecordBatch.from_pylist(
                    [{"chunk": rows[0], "tokens": tok.tobytes(), "offsets": toff.astype(np.int64).tobytes(), "ids": ids, "rows": rows}],
                    pa.schema([("chunk", pa.int64()), ("tokens", pa.binary()), ("offsets", pa.binary()), ("ids", pa.list_(pa.int64())), ("rows", pa.list_(pa.int64()))]),
                )

    return run


def _contexts(tok: np.ndarray, toff: np.ndarray) -> np.ndarray:
    context = np.roll(tok, 1)
    context[toff[:-1]] = _BEGIN
    return context


def _keys(tok: np.ndarray, ctx: np.ndarray) -> np.ndarray:
    """All that scoring asks the filter for, distinct and sorted, so in runs by part."""
    return np.unique(np.concatenate([tok, pair_key(ctx, tok)]))


def _ask(parts: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk, tokens_, offsets in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                tok = np.frombuffer(tokens_, _U)
                k = _keys(tok, _contexts(tok, np.frombuffer(offsets, np.int64)))
                part = (k >> _U(32)) * _U(parts) >> _U(32)
                edge = np.searchsorted(part, np.arange(parts + 1, dtype=_U))
                some = np.flatnonzero(np.diff(edge))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(some, pa.int32()),
                        pa.array(np.full(len(some), chunk), pa.int64()),
                        pa.array([k[edge[s] : edge[s + 1]].tobytes() for s in some], pa.binary()),
                    ],
                    names=ASKED.names,
                )

    return run


def _tell(bits: int, probes: int):
    """Rows (part, chunk, keys) sorted by part, chunk: the keys' levels.  Chunk -1 has the part's
    bits in place of keys; a part without it holds nothing."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now = bloom = None
        for batch in batches:
            for part, chunk, keys in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if part != now:
                    now = part
                    made = np.frombuffer(keys, np.uint8) if chunk < 0 else np.zeros(bits // 8, np.uint8)
                    bloom = Filter([made], bits, probes)
                if chunk >= 0:
                    levels = bloom.levels(np.frombuffer(keys, _U)).astype(np.uint16).tobytes()
                    yield pa.RecordBatch.from_arrays([pa.array([chunk], pa.int64()), pa.array([part], pa.int32()), pa.array([levels], pa.binary())], names=TOLD.names)

    return run


def _score_told(m: Scorer, frequent: Shared):
    """Rows (chunk, part, levels, tokens, offsets, ids, rows) sorted by chunk, part: the chunk's texts
    come first (part -1), then its levels, which in the order of parts are those of its sorted keys."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts, told = None, []

        def out():
            tokens_, offsets, ids, rows = texts
            tok, toff = np.frombuffer(tokens_, _U), np.frombuffer(offsets, np.int64)
            ctx = _contexts(tok, toff)
            keys, levels = _keys(tok, ctx), np.concatenate(told).astype(np.int64)
            if len(keys) != len(levels):
                raise ValueError("levels are missing")
            find = lambda k: levels[np.searchsorted(keys, k)]
            return _scored(tok, ctx, toff, ids, held_out(ids, m.params), pa.array(rows, pa.int64()), find, frequent.get(), m)

        for batch in batches:
            for _, part, levels, *rest in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if part < 0:
                    if texts:
                        yield out()
                    texts, told = rest, []
                else:
                    told.append(np.frombuffer(levels, np.uint16))
        if texts:
            yield out()

    return run


def _by_shuffle(src: DataFrame, model: Model, frequent: Shared, m: Scorer) -> DataFrame:
    """What ``_score`` gives, with the filter's segments left where they are made: the distinct
    n-grams of each chunk of texts go to the segments, their levels to the chunk."""
    p, parts = model.params, model.parts
    chunks = materialise(src.mapInArrow(_chunks(p), CHUNKS), "chunks")
    asked = chunks.select("chunk", "tokens", "offsets").mapInArrow(_ask(parts), ASKED)
    held = model.filter.select("part", F.lit(-1).cast("long").alias("chunk"), F.col("bits").alias("keys"))
    told = held.union(asked).repartition(parts, "part").sortWithinPartitions("part", "chunk").mapInArrow(_tell(model.bits, m.probes), TOLD)
    texts = chunks.withColumn("part", F.lit(-1))
    both = told.unionByName(texts, allowMissingColumns=True).select("chunk", "part", "levels", "tokens", "offsets", "ids", "rows")
    both = both.repartition(parts, "chunk").sortWithinPartitions("chunk", "part")
    return both.mapInArrow(_score_told(m, frequent), PARTIAL)


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) for every row of ``docs``.

    score: log10 probability under the interpolated pair model, read from the filter.
    base_score: add-one word model with exact counts.  A null text counts as empty and has the one
    end token.  A null id is never held out; repeated rows are scored each on its own.
    """
    p = model.params
    least = max(1, model.seen // p.frequent)
    # Each frequent word makes up more than 1 / frequent of all tokens, so there are fewer than that.
    common = model.counts.where(F.col("seen") > least).select("h", "c").toArrow()
    h = common.column("h").to_numpy().view(_U)
    order = np.argsort(h)
    frequent = Shared(docs, _HELD[1], (h[order], common.column("c").to_numpy()[order]))
    src = docs.select(col(id_col).cast("long").alias("doc_id"), col(text_col).alias("text"), F.monotonically_increasing_id().alias("row"))
    m = Scorer(p, model.total, model.vocabulary, model.probes, model.mass, model.excess)
    if isinstance(model.filter, Shared):
        first = src.mapInArrow(_lean(_score(m, model.filter, frequent)), PARTIAL)
    else:
        first = _by_shuffle(src, model, frequent, m)
    first = materialise(first, "scores")
    rest = model.counts.where(F.col("seen") <= least).select("h", "c")
    size = float(np.log10(model.total + model.vocabulary + 1.0))
    rare = first.select("row", F.explode("rare").alias("h")).join(rest, "h").groupBy("row").agg(
        F.sum((F.col("c") > 0).cast("long")).alias("more_known"), F.sum(F.log10(F.col("c") + 1.0) - F.lit(size)).alias("more_base")
    )
    return first.join(rare, "row", "left").select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("n_known") + F.coalesce("more_known", F.lit(0))).alias("n_known"),
        F.lit(model.total).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("more_base", F.lit(0.0))).alias("base_score"),
        "score",
    )

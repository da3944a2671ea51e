"""Document fingerprints by locally consistent parsing.

A text is parsed in levels.  On each level runs of one symbol become one symbol, then
deterministic coin tossing gives every symbol a label: the position and value of the lowest bit
in which it differs from its left neighbour, and the same again on the labels until six
values are left.  Phrases begin at local maxima of the labels, and a phrase's name is a hash of
its symbols; the names are the symbols of the next level.  A phrase boundary depends on a
few neighbours only, so equal substrings share their interior names wherever they lie.

The fingerprint is the sorted sketch of the smallest hashed names that span SPAN code points or
more (and of the name of the whole text); the likeness of two is the sketches' estimate of the
names' multiset Jaccard similarity, exact for texts with fewer names than the sketch holds.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import arrays as A
from .store import col, partitions

SPAN = 8
SKETCH = 64
_CHUNK = 1 << 18  # code points parsed at once; a longer text is parsed alone

_U = np.uint64


def _coin_table() -> np.ndarray:
    """label after one toss, by (left label, own label), for labels below 128."""
    left, own = np.meshgrid(np.arange(128), np.arange(128), indexing="ij")
    diff = left ^ own
    low = np.where(diff, np.bitwise_count((diff & -diff) - 1), 0)
    return (2 * low + ((own >> low) & 1)).astype(np.uint8).ravel()


_TOSS = _coin_table()


def _labels(x: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Labels below 6, different for neighbours; ``first``: positions that begin a text."""
    left = np.empty_like(x)
    left[1:] = x[:-1]
    left[first] = ~x[first]
    diff = x ^ left
    low = np.bitwise_count((diff & (~diff + _U(1))) - _U(1))
    label = (low << 1) | ((x >> low.astype(_U)) & _U(1)).astype(np.uint8)
    for _ in range(3):
        at = label.astype(np.uint16)
        at[1:] += label[:-1].astype(np.uint16) << np.uint16(7)
        at[first] = (label[first].astype(np.uint16) ^ np.uint16(1)) << np.uint16(7) | label[first]
        label = _TOSS[at]
    return label


def _level(x: np.ndarray, span: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Names, spans and offsets of one level's phrases.  All texts in ``off`` hold symbols."""
    begins = np.ones(len(x), bool)
    np.not_equal(x[1:], x[:-1], out=begins[1:])
    begins[off[:-1]] = True
    starts = np.flatnonzero(begins)
    if len(starts) < len(x):
        runs = np.diff(np.append(starts, len(x)))
        x, span = x[starts], np.add.reduceat(span, starts)
        long = runs > 1
        x[long] = A.mix64(x[long] ^ A.salted(runs[long].astype(_U), 3))
        off = np.searchsorted(starts, off)
    first = off[:-1]
    label = _labels(x, first)
    peak = np.zeros(len(x), bool)
    peak[1:-1] = (label[1:-1] > label[:-2]) & (label[1:-1] > label[2:])
    peak[off[1:] - 1] = False
    peak[first] = True
    starts = np.flatnonzero(peak)
    return A.segment_hashes(A.mix64(x + _U(1)), starts), np.add.reduceat(span, starts), np.searchsorted(starts, off)


def sketches(texts: list[str]) -> list[np.ndarray]:
    """The fingerprint of every text as a sorted array of at most SKETCH 32-bit values."""
    out: list[np.ndarray] = []
    lo = 0
    while lo < len(texts):
        hi, size = lo, 0
        while hi < len(texts) and (hi == lo or size + len(texts[hi]) <= _CHUNK):
            size += len(texts[hi])
            hi += 1
        out += _sketch_chunk(texts[lo:hi])
        lo = hi
    return out


def _sketch_chunk(texts: list[str]) -> list[np.ndarray]:
    sizes = np.array([len(t) for t in texts])
    x = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32).astype(_U)
    who = np.flatnonzero(sizes)  # texts still being parsed
    off = np.zeros(len(who) + 1, np.int64)
    np.cumsum(sizes[who], out=off[1:])
    span = np.ones(len(x), np.int64)
    found = []
    level = 0
    while len(who):
        x, span, off = _level(x, span, off)
        level += 1
        count = np.diff(off)
        names = (A.salted(x, level) >> _U(32)) | (np.repeat(who, count).astype(_U) << _U(32))
        done = count == 1
        found.append(names[(span >= SPAN) | np.repeat(done, count)])
        if done.any():
            stay = np.repeat(~done, count)
            x, span, who = x[stay], span[stay], who[~done]
            off = np.zeros(len(who) + 1, np.int64)
            np.cumsum(count[~done], out=off[1:])
    names = np.sort(np.concatenate(found)) if found else np.empty(0, _U)
    # The n-th occurrence of a name counts as an item of its own, so repeated passages keep their weight.
    runs = np.flatnonzero(np.append(True, names[1:] != names[:-1])) if len(names) else np.empty(0, np.int64)
    nth = np.arange(len(names)) - np.repeat(runs, np.diff(np.append(runs, len(names))))
    names = np.sort((names & _U(0xFFFFFFFF00000000)) | (A.salted((names << _U(32)) + nth.astype(_U), 5) >> _U(32)))
    edge = np.searchsorted(names, np.arange(len(texts) + 1, dtype=_U) << _U(32))
    low = (names & _U(0xFFFFFFFF)).astype(np.uint32)
    return [low[a : min(a + SKETCH, b)] for a, b in zip(edge[:-1], edge[1:], strict=True)]


def to_text(sketch: np.ndarray) -> str:
    return sketch.astype(">u4").tobytes().hex()


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Estimated Jaccard similarity of the name sets, 0 to 1; two empty texts are alike (1)."""
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    x, y = set(a.tolist()), set(b.tolist())
    least = sorted(x | y)[:SKETCH]
    both = x & y
    return sum(v in both for v in least) / len(least)


FINGERPRINT = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("fingerprint", T.StringType())])


def fingerprint(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fingerprint) of every row; a null or empty text has the empty fingerprint."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            marks = [to_text(s) for s in sketches([t or "" for t in A.text_list(batch.column(1))])]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(marks, pa.string())], names=FINGERPRINT.names)

    return docs.select(col(id_col).cast("long").alias("doc_id"), col(text_col).alias("text")).mapInArrow(run, FINGERPRINT)


# --- neighbours in id order -------------------------------------------------------------------

_PIECES = 64


def _buckets(ids: DataFrame, parts: int) -> Column:
    """A bucket number that rises with doc_id: quantile pieces, each cut evenly."""
    share = [k / _PIECES for k in range(_PIECES + 1)]
    edges = ids.agg(F.percentile_approx("doc_id", share, 10000)).first()[0] or [0]
    edges = sorted(set(edges))
    cuts = F.array(*[F.lit(e).cast("long") for e in edges])
    piece = F.greatest(F.size(F.filter(cuts, lambda e: e <= F.col("doc_id"))), F.lit(1))
    low = F.element_at(cuts, piece)
    high = F.element_at(cuts, F.least(piece + 1, F.lit(len(edges))))
    each = -(-parts // len(edges))
    span = F.greatest(high.cast("double") - low.cast("double"), F.lit(1.0))  # ids may span more than 2**63
    inside = F.floor((F.col("doc_id").cast("double") - low.cast("double")) / span * each)
    return (piece * (each + 2) + F.least(F.greatest(inside, F.lit(0)), F.lit(each))).cast("int")


def _home(bucket: Column, spread: int) -> Column:
    """The row's bucket; rows without an id have no neighbours and are spread by text hash."""
    return F.when(F.col("doc_id").isNull(), F.pmod(F.xxhash64("text"), F.lit(spread)).cast("int")).otherwise(bucket)


EDITED = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("n_chars", T.LongType()),
        T.StructField("edited_sha256", T.StringType()),
        T.StructField("fingerprint", T.StringType()),
        T.StructField("edited_fingerprint", T.StringType()),
        T.StructField("near_edited", T.DoubleType()),
        T.StructField("near_next", T.DoubleType()),
    ]
)


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (bucket, own, doc_id, text) sorted by bucket, own, doc_id; own = 0 marks a copy of the
    row before the bucket's first."""
    bucket = lower = now = None  # lower, now: (doc_id, text, sketch) of the next smaller id and of this one
    for batch in batches:
        for lo in range(0, len(batch), 128):
            *ids, texts = batch.slice(lo, 128).columns
            rows = list(zip(*(c.to_pylist() for c in ids), A.text_list(texts), strict=True))
            own_sketch = sketches([r[3] or "" for r in rows])
            kept, edited = [], []
            for (b, own, doc_id, text), sketch in zip(rows, own_sketch, strict=True):
                text = text or ""
                if doc_id is None:
                    follows = (None, "", np.empty(0, np.uint32))
                else:
                    if b != bucket:
                        bucket, lower, now = b, None, None
                    if not own:
                        now = now or (doc_id, text, sketch)
                        continue
                    # The copy comes first; its id is not compared (the smallest id is followed by the largest).
                    if lower is None or doc_id != now[0]:
                        lower, now = now, (doc_id, text, sketch)
                    follows = lower
                k = len(text) // 3
                kept.append((doc_id, text, sketch, follows[2]))
                edited.append(text[: len(text) - k] + follows[1][:k])
            marks = sketches(edited)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([r[0] for r in kept], pa.int64()),
                    pa.array([len(r[1]) for r in kept], pa.int64()),
                    pa.array([hashlib.sha256(t.encode("utf-8", "surrogatepass")).hexdigest() for t in edited], pa.string()),
                    pa.array([to_text(r[2]) for r in kept], pa.string()),
                    pa.array([to_text(m) for m in marks], pa.string()),
                    pa.array([likeness(r[2], m) for r, m in zip(kept, marks, strict=True)], pa.float64()),
                    pa.array([likeness(r[2], r[3]) for r in kept], pa.float64()),
                ],
                names=EDITED.names,
            )


def edit_neighbours(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of every text and of its edited text, whose last third is replaced by the start
    of the next document in descending id order (after the last comes the first).

    The texts are shuffled once, by bucket of ids; each bucket also gets a copy of the one row
    that follows its smallest id.  Null texts count as empty.  Rows that repeat an id share the
    next smaller id's document; where that id repeats, the row with the smallest text hash stands
    for it.  A row without an id has no place in the order: an empty text follows it.  Bytes that are
    not UTF-8 count as replacement characters.
    """
    rows = docs.select(col(id_col).cast("long").alias("doc_id"), col(text_col).alias("text"))
    ids = rows.select("doc_id").where("doc_id is not null")
    parts = partitions(docs)
    bucket = _buckets(ids, 4 * parts)
    ends = sorted(tuple(r) for r in ids.groupBy(bucket.alias("b")).agg(F.max("doc_id")).collect())  # at most a few per partition
    # The bucket above needs the largest id of the bucket below; the lowest needs the largest of all.
    ghosts = [(top, into) for (_, top), (into, _) in zip(ends[-1:] + ends[:-1], ends, strict=True)]
    spark = docs.sparkSession
    copies = spark.createDataFrame(ghosts, "doc_id long, into int")
    placed = rows.join(F.broadcast(copies), "doc_id", "left")
    here = F.struct(_home(bucket, 4 * parts).alias("b"), F.lit(1).alias("own"))
    there = F.struct(F.col("into").alias("b"), F.lit(0).alias("own"))
    both = F.when(F.col("into").isNull(), F.array(here)).otherwise(F.array(here, there))
    placed = placed.select(F.explode(both).alias("at"), "doc_id", "text").select("at.b", "at.own", "doc_id", "text")
    order = ["b", "own", "doc_id", F.xxhash64("text")]
    dealt = placed.repartition(parts, "b").sortWithinPartitions(*order)
    return dealt.mapInArrow(_compare, EDITED)

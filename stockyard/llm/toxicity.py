"""Toxicity by the nearest labelled examples under TF-IDF cosine.

Terms are words and word beginnings that mark one of the labels; all other words of a text
count as one pooled term, so a vector tells how dense its marked words are.

Labelled examples form an inverted index whose postings are cut into blocks of examples, each
with its largest weight per term.  For a text, the block maxima bound what any example of a
block can reach; blocks are scored from the highest bound down until no bound can enter the k
nearest, so the k nearest are exact.  Votes weigh by closeness and are calibrated on labelled
rows outside the index; the neighbours are the evidence.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import arrays as A
from .store import Shared, col, materialise

_U = np.uint64
#: Word beginnings of so many bytes are terms too.
PREFIXES = (4, 5, 6)


@dataclass(frozen=True)
class Params:
    """per_class: examples in the index for each label; calibration: further labelled rows that fit
    the scores (both bound the sample the model is fitted on).  terms: vocabulary bound;
    least_chi2: association with the label that a term needs in the examples; least_gap: difference
    it needs between the shares of the two classes that hold it, which keeps out the words of a
    small group of copies.  k: neighbours.
    block: examples in a block.  threshold: score from which a text is predicted toxic.
    held_mod, held_rest: rows with crc32(id) mod held_mod = held_rest are not learned from.
    """

    per_class: int = 1500
    calibration: int = 4000
    terms: int = 2048
    least_chi2: float = 30.0
    least_gap: float = 0.03
    k: int = 10
    block: int = 32
    threshold: float = 0.7
    held_mod: int = 3
    held_rest: int = 1
    seed: int = 17


def held_out(id_col: Column, p: Params) -> Column:
    rest = F.crc32(id_col.cast("string").cast("binary")) % p.held_mod == p.held_rest
    return F.coalesce(rest, F.lit(False))


# --- term vectors --------------------------------------------------------------------------

BAG = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("terms", T.ArrayType(T.LongType())), T.StructField("counts", T.ArrayType(T.LongType()))])


def _bags(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        buf, off = A.text_buffer(batch.column(1))
        h, woff = A.words(buf, off, A.ALNUM_WORDS, PREFIXES)
        terms, counts = [], []
        for a, b in zip(woff[:-1], woff[1:], strict=True):
            t, n = np.unique(h[a:b], return_counts=True)
            terms.append(t[t != 0].view(np.int64))
            counts.append(n[t != 0])
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(terms, pa.list_(pa.int64())), pa.array(counts, pa.list_(pa.int64()))], names=BAG.names
        )


class Vocabulary:
    """Maps word hashes to term numbers through a bit table that turns most words away at once."""

    def __init__(self, terms: np.ndarray):
        self.terms = np.sort(terms)
        self.maybe = np.zeros(1 << 20, bool)
        self.maybe[self.terms >> _U(44)] = True

    def find(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(positions in ``h`` that hold a term, their term numbers)."""
        at = np.flatnonzero(self.maybe[h >> _U(44)])
        if not len(at):
            return at, at
        number = np.minimum(np.searchsorted(self.terms, h[at]), len(self.terms) - 1)
        ok = self.terms[number] == h[at]
        return at[ok], number[ok]


def _term_counts(buf, off, vocabulary: Vocabulary):
    """Sorted (document, term) pairs of a batch with their counts; the term after the last is the
    pooled one, which counts the words that neither are nor begin with a term."""
    docs, terms, counts = [], [], []
    size, width = len(vocabulary.terms) + 1, 1 + len(PREFIXES)
    for lo, hi in A.doc_chunks(off):
        h, woff = A.words(buf[off[lo] : off[hi]], off[lo : hi + 1] - off[lo], A.ALNUM_WORDS, PREFIXES)
        at, term = vocabulary.find(h)
        key, n = np.unique((np.searchsorted(woff, at, "right") - 1) * size + term, return_counts=True)
        marked = np.searchsorted(woff, np.unique(at // width) * width, "right") - 1
        rest = np.diff(woff) // width - np.bincount(marked, minlength=hi - lo)
        some = np.flatnonzero(rest)
        key, n = np.append(key, some * size + size - 1), np.append(n, rest[some])
        order = np.argsort(key)
        docs.append(key[order] // size + lo)
        terms.append(key[order] % size)
        counts.append(n[order])
    if not docs:
        return (np.empty(0, np.int64),) * 3
    return np.concatenate(docs), np.concatenate(terms), np.concatenate(counts)


def _document_counts(terms):
    """(term, df) of a task's documents, and their number as term -1."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = terms.get(Vocabulary)
        df, n = np.zeros(len(vocabulary.terms) + 1, np.int64), 0
        for batch in batches:
            buf, off = A.text_buffer(batch.column(0))
            df += np.bincount(_term_counts(buf, off, vocabulary)[1], minlength=len(df))
            n += len(batch)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(np.arange(len(df)), -1)), pa.array(np.append(df, n))], names=["term", "df"])

    return run


VECTOR = T.StructType([BAG["doc_id"], T.StructField("toxic", T.IntegerType()), T.StructField("use", T.StringType()), BAG["terms"], BAG["counts"]])


def _vectors(terms: Shared):
    """(doc_id, toxic, use, text) rows with the text as term numbers and counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = terms.get(Vocabulary)
        for batch in batches:
            buf, off = A.text_buffer(batch.column(3))
            doc, term, count = _term_counts(buf, off, vocabulary)
            edge = pa.array(np.searchsorted(doc, np.arange(len(off))).astype(np.int32))
            lists = [pa.ListArray.from_arrays(edge, pa.array(x.astype(np.int64))) for x in (term, count)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], *lists], names=VECTOR.names)

    return run


# --- index ---------------------------------------------------------------------------------


@dataclass
class Index:
    """Postings by term (example, weight), sorted by example, with the block maxima of each term."""

    terms: np.ndarray
    idf: np.ndarray
    examples: np.ndarray  # ids
    labels: np.ndarray
    start: np.ndarray  # [term, block]: where a term's postings of a block begin; one more column for the end
    example: np.ndarray
    weight: np.ndarray
    top: np.ndarray  # [term, block]
    block: int
    curve: tuple = field(default=((0.0, 1.0), (0.0, 1.0)))
    no_evidence: float = 0.0

    def weigh(self, term: np.ndarray, count: np.ndarray) -> np.ndarray:
        w = np.sqrt(count) * self.idf[term]
        return w / np.sqrt((w * w).sum())

    def nearest(self, term: np.ndarray, weight: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Exactly the k nearest examples with positive cosine: (numbers, cosines), ties by number."""
        bound = weight @ self.top[term]
        order = np.argsort(-bound, kind="stable")
        order = order[bound[order] > 0]
        got, cos, kth, at, step = [], [], 0.0, 0, 2
        while at < len(order):
            blocks = order[at : at + step]
            # What rounding may cost a bound stays within the margin.
            blocks = blocks[bound[blocks] >= kth - 1e-9]
            if not len(blocks):
                break
            lo, hi = self.start[term][:, blocks].ravel(), self.start[term][:, blocks + 1].ravel()
            n = hi - lo
            idx = np.repeat(lo - (np.cumsum(n) - n), n) + np.arange(n.sum())
            near, inv = np.unique(self.example[idx], return_inverse=True)
            dots = np.bincount(inv, self.weight[idx] * np.repeat(np.repeat(weight, len(blocks)), n))
            got.append(near)
            cos.append(dots)
            at += step
            step *= 2
            found = np.concatenate(cos)
            if len(found) >= k:
                kth = np.partition(found, len(found) - k)[len(found) - k]
        if not got:
            return np.empty(0, np.int64), np.empty(0)
        near, dots = np.concatenate(got), np.minimum(np.concatenate(cos), 1.0)
        best = np.lexsort((near, -dots))[:k]
        return near[best], dots[best]


def build_index(terms: np.ndarray, idf: np.ndarray, rows: list[tuple[int, int, np.ndarray, np.ndarray]], block: int) -> Index:
    """rows: (id, label, term numbers, counts) of the examples.  Examples without a term match nothing."""
    index = Index(terms, idf, *(np.empty(0, np.int64),) * 2, *(np.empty(0, np.int64),) * 2, np.empty(0), np.empty(0), block)
    vectors = [(i, y, t, index.weigh(t, n)) for i, y, t, n in rows if len(t)]
    # Examples that share label and heaviest term share blocks, which keeps the block maxima tight.
    vectors.sort(key=lambda v: (v[1], v[2][np.argmax(v[3])], v[0]))
    blocks = -(-len(vectors) // block)
    term = np.concatenate([v[2] for v in vectors]) if vectors else np.empty(0, np.int64)
    who = np.repeat(np.arange(len(vectors)), [len(v[2]) for v in vectors])
    weight = np.concatenate([v[3] for v in vectors]) if vectors else np.empty(0)
    order = np.lexsort((who, term))
    term, who, weight = term[order], who[order], weight[order]
    cell = term * (blocks + 1) + who // block
    top = np.zeros((len(idf), blocks))
    np.maximum.at(top, (term, who // block), weight)
    index.start = np.searchsorted(cell, np.arange(len(idf) * (blocks + 1))).reshape(len(idf), blocks + 1)
    index.example, index.weight, index.top = who, weight, top
    index.examples = np.array([v[0] for v in vectors], np.int64)
    index.labels = np.array([v[1] for v in vectors], np.int64)
    return index


def vote(labels: np.ndarray, cosines: np.ndarray) -> float:
    """Share of the neighbours' votes for label 1; a vote weighs 1 / (distance + 0.05)."""
    w = 1.0 / (1.05 - cosines)
    return float((w * labels).sum() / w.sum())


def calibrate(votes: np.ndarray, labels: np.ndarray) -> tuple[tuple[float, ...], tuple[float, ...]]:
    """Rising curve from votes to shares of label 1: pooled adjacent violators, with one prior row in each pool."""
    order = np.argsort(votes, kind="stable")
    pools: list[list[float]] = []  # sum of votes, rows, positives
    for v, y in zip(votes[order], labels[order], strict=True):
        pools.append([v, 1, y])
        while len(pools) > 1 and pools[-2][2] / pools[-2][1] >= pools[-1][2] / pools[-1][1]:
            last = pools.pop()
            pools[-1] = [a + b for a, b in zip(pools[-1], last, strict=True)]
    rate = labels.mean() if len(labels) else 0.5
    x = [0.0] + [s / n for s, n, _ in pools] + [1.0]
    y = [(t + rate) / (n + 1) for _, n, t in pools]
    y = list(np.maximum.accumulate([y[0], *y, y[-1]])) if y else [0.0, 1.0]
    return tuple(x), tuple(float(v) for v in y)


SCORED = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("score", T.DoubleType()),
        T.StructField("vote", T.DoubleType()),
        T.StructField("evidence", T.ArrayType(T.LongType())),
        T.StructField("cosines", T.ArrayType(T.DoubleType())),
    ]
)


def _evaluate(model, p: Params):
    """(score, vote, neighbours, cosines) for the texts of a batch."""

    def run(column):
        index, vocabulary = model
        known: dict[int, tuple] = {}  # texts with a single term share a vector
        buf, off = A.text_buffer(column)
        doc, term, count = _term_counts(buf, off, vocabulary)
        edge = np.searchsorted(doc, np.arange(len(off)))
        for a, b in zip(edge[:-1], edge[1:], strict=True):
            if b - a == 1 and int(term[a]) in known:
                yield known[int(term[a])]
                continue
            near, cos = index.nearest(term[a:b], index.weigh(term[a:b], count[a:b]), p.k) if a < b else (np.empty(0, np.int64), np.empty(0))
            out = (index.no_evidence, None, [], [])
            if len(near):
                v = vote(index.labels[near], cos)
                out = (float(np.interp(v, *index.curve)), v, index.examples[near].tolist(), cos.tolist())
            if b - a == 1:
                known[int(term[a])] = out
            yield out

    return run


def _loaded(index: Index) -> tuple[Index, Vocabulary]:
    return index, Vocabulary(index.terms)


def _score(shared: Shared, p: Params):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        evaluate = _evaluate(shared.get(_loaded), p)
        for batch in batches:
            rows = list(evaluate(batch.column(1)))
            cols = list(zip(*rows, strict=True)) if rows else [[]] * 4
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(list(c), t) for c, t in zip(cols, (pa.float64(), pa.float64(), pa.list_(pa.int64()), pa.list_(pa.float64())), strict=True))],
                names=SCORED.names,
            )

    return run


def _sample(docs: DataFrame, labels: DataFrame, p: Params) -> DataFrame:
    """Bounded labelled sample with its bags of words: (doc_id, toxic, use, terms, counts)."""
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
    known = known.where("toxic in (0, 1)").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    known = known.where(F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"), p)).withColumn("o", F.xxhash64("doc_id", F.lit(p.seed)))
    known = known.join(docs.select(F.col("doc_id")).distinct(), "doc_id", "left_semi")
    known = materialise(known, "labelled")
    # Two thirds of the labelled rows may enter the index, the others fit the curve.
    pool = F.pmod(F.xxhash64("doc_id", F.lit(p.seed + 1)), F.lit(3)) < 2
    picked = [known.where(pool & (F.col("toxic") == y)).orderBy("o", "doc_id").limit(p.per_class).withColumn("use", F.lit("index")) for y in (0, 1)]
    rest = known.where(~pool).orderBy("o", "doc_id").limit(p.calibration).withColumn("use", F.lit("curve"))
    chosen = materialise(picked[0].union(picked[1]).union(rest), "sample")
    texts = docs.join(F.broadcast(chosen.select("doc_id")), "doc_id", "left_semi").select("doc_id", "text")
    bags = texts.mapInArrow(_bags, BAG).dropDuplicates(["doc_id"])
    return materialise(bags.join(F.broadcast(chosen.drop("o")), "doc_id"), "bags")


def fit(docs: DataFrame, labels: DataFrame, p: Params | None = None, id_col: str = "doc_id", text_col: str = "text") -> Index:
    """The index over a bounded sample of labelled rows; document frequencies count all documents."""
    p = p or Params()
    src = docs.select(col(id_col).cast("long").alias("doc_id"), col(text_col).alias("text"))
    sample = _sample(src, labels, p)
    n1, n0 = sample.where("use = 'index'").agg(F.count_if(F.col("toxic") == 1), F.count_if(F.col("toxic") == 0)).first()
    a, b = F.col("a"), F.col("b")
    c, d = F.lit(float(n1)) - a, F.lit(float(n0)) - b
    chi2 = (n1 + n0) * (a * d - b * c) * (a * d - b * c) / ((a + c) * (b + d) * (a + b) * (c + d))
    used = (
        sample.where("use = 'index'")
        .select("toxic", F.explode("terms").alias("term"))
        .groupBy("term")
        .agg(F.sum("toxic").cast("double").alias("a"), F.sum(1 - F.col("toxic")).cast("double").alias("b"))
        .where((a + b < n1 + n0) & (F.lit(n1 * n0) > 0))
        .withColumn("chi2", chi2)
        .where((F.col("chi2") >= p.least_chi2) & (F.abs(a / n1 - b / n0) >= p.least_gap))
        .orderBy(F.desc("chi2"), "term")
        .limit(p.terms)
    )
    terms = np.sort(np.array([r[0] for r in used.select("term").collect()], np.int64).view(_U))
    shared = Shared(docs, "terms", terms)
    freq = np.zeros(len(terms) + 2, np.int64)
    found = src.select("text").mapInArrow(_document_counts(shared), "term long, df long").groupBy("term").agg(F.sum("df"))
    for t, n in found.collect():
        freq[t] = n
    idf = np.log((freq[-1] + 1.0) / (freq[:-1] + 1.0)) + 1.0
    rows = {"index": [], "curve": []}
    chosen = sample.select("doc_id", "toxic", "use")
    vectors = src.join(F.broadcast(chosen), "doc_id").select("doc_id", "toxic", "use", "text").mapInArrow(_vectors(shared), VECTOR)
    for r in vectors.dropDuplicates(["doc_id"]).collect():  # the bounded sample, vocabulary terms only
        rows[r["use"]].append((r["doc_id"], r["toxic"], np.array(r["terms"], np.int64), np.array(r["counts"], np.int64)))
    index = build_index(terms, idf, sorted(rows["index"], key=lambda r: r[0]), p.block)
    votes, truth, silent = [], [], []
    for _, y, t, n in sorted(rows["curve"] or rows["index"], key=lambda r: r[0]):
        near, cos = index.nearest(t, index.weigh(t, n), p.k) if len(t) else ([], [])
        if len(near):
            votes.append(vote(index.labels[near], cos))
            truth.append(y)
        else:
            silent.append(y)
    if votes:
        index.curve = calibrate(np.array(votes), np.array(truth, float))
    index.no_evidence = (sum(silent) + 0.1) / (len(silent) + 1)
    return index


def score(docs: DataFrame, index: Index, p: Params | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, held_out, score, predicted, vote, evidence, cosines) for every row of ``docs``.

    Texts without a word (null and empty ones too) have no neighbours: null vote, no evidence, and
    the share of label 1 among labelled rows like them as score.
    """
    p = p or Params()
    shared = Shared(docs, "examples", index)
    src = docs.select(col(id_col).cast("long").alias("doc_id"), col(text_col).alias("text"))
    out = src.mapInArrow(_score(shared, p), SCORED)
    return out.select(
        "doc_id",
        held_out(F.col("doc_id"), p).alias("held_out"),
        "score",
        (F.col("score") >= p.threshold).cast("int").alias("predicted"),
        "vote",
        "evidence",
        "cosines",
    )


def keep_clean(docs: DataFrame, index: Index, p: Params | None = None, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that are not predicted toxic, all columns unchanged."""
    p = p or Params()
    shared = Shared(docs, "examples", index)
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        evaluate = _evaluate(shared.get(_loaded), p)
        for batch in batches:
            keep = [r[0] < p.threshold for r in evaluate(batch.column(at))]
            yield batch.filter(pa.array(keep, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)

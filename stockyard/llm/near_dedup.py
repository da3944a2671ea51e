"""MinHash near-duplicate detection with sequential Bayesian verification.

Banded MinHash proposes candidates; a candidate pair's signatures are compared a
batch of positions at a time, and the pair is dropped as soon as the posterior
probability that its Jaccard similarity reaches the threshold falls below the chosen
miss probability; the survivors are verified exactly on their full shingle sets.

Texts with equal shingle sets are one class, so copies never meet in pairs.  Members of
a bucket are not all paired: two rounds link them to one centre each, and only members
that these links do not yet join are compared across, in blocks of bounded size.  What is lost is only what the bands or the chosen miss probability lose.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import arrays as A
from .graph import components
from .store import bounded, col, materialise, partitions


@dataclass(frozen=True)
class Params:
    """width: words per shingle; a link needs percent * |union| <= 100 * |intersection|.

    bands x rows signature positions: a pair at the threshold of 0.8 is missed by all bands
    with probability (1 - 0.8**rows)**bands, below 1e-5.  miss: posterior bound at which a
    pair is pruned.  batch: positions compared between two looks at the posterior.  block:
    shingles (about) in one block of bucket members; two blocks are compared in one group.
    broadcast_rows: bound of a counted broadcast.
    """

    width: int = 5
    percent: int = 80
    bands: int = 30
    rows: int = 5
    batch: int = 30
    miss: float = 1e-5
    block: int = 1_000_000
    star_rounds: int = 2
    broadcast_rows: int = 1_000_000


def shingles(buf: np.ndarray, off: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash of every ``width``-word window, offsets per document); a text with fewer
    words but at least one gives one shingle, its whole sequence."""
    h, woff = A.words(buf, off)
    n = np.diff(woff)
    count = np.where(n == 0, 0, np.maximum(n - width + 1, 1))
    soff = np.zeros(len(woff), np.int64)
    np.cumsum(count, out=soff[1:])
    at = np.arange(soff[-1]) - np.repeat(soff[:-1] - woff[:-1], count)
    left = np.repeat(np.minimum(n, width), count)  # words in the window
    out = A.salted(left.astype(np.uint64), 7)
    for k in range(width):
        more = left > k
        if more.all():
            out = A.mix64(out * np.uint64(0xA0761D6478BD642F) ^ h[at + k])
        elif more.any():
            out[more] = A.mix64(out[more] * np.uint64(0xA0761D6478BD642F) ^ h[at[more] + k])
    return out, soff


def _multipliers(p: Params) -> tuple[np.ndarray, np.ndarray]:
    salt = A.salted(np.arange(2 * p.bands * p.rows, dtype=np.uint64), 11)
    mul, add = (salt >> np.uint64(32)).astype(np.uint32).reshape(2, -1, 1)
    return mul | np.uint32(1), add


def signature(items: np.ndarray, p: Params, mul: np.ndarray, add: np.ndarray) -> np.ndarray:
    """MinHash values of one non-empty set of 64-bit shingle hashes."""
    x = (items >> np.uint64(32)).astype(np.uint32)
    best = None
    for k in range(0, len(x), 4096):
        low = (mul * x[None, k : k + 4096] + add).min(axis=1)
        best = low if best is None else np.minimum(best, low)
    return best


SKETCH = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("n_shingles", T.LongType()),
        T.StructField("set_a", T.LongType()),
        T.StructField("set_b", T.LongType()),
        T.StructField("sig", T.BinaryType()),
        T.StructField("keys", T.ArrayType(T.LongType())),
    ]
)


def _sketch(p: Params):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mul, add = _multipliers(p)
        for batch in batches:
            buf, off = A.text_buffer(batch.column(1))
            n = len(batch)
            size = np.zeros(n, np.int64)
            ids = np.zeros((2, n), np.uint64)
            sigs, keys = [None] * n, [None] * n
            for lo, hi in A.doc_chunks(off):
                sh, soff = shingles(buf[off[lo] : off[hi]], off[lo : hi + 1] - off[lo], p.width)
                for i in range(hi - lo):
                    s = np.unique(sh[soff[i] : soff[i + 1]])
                    if not len(s):
                        continue
                    k = lo + i
                    size[k] = len(s)
                    ids[0, k] = A.salted(s, 1).sum()
                    ids[1, k] = A.salted(s, 2).sum()
                    sig = signature(s, p, mul, add)
                    sigs[k] = (sig >> np.uint32(24)).astype(np.uint8).tobytes()
                    rows = sig.reshape(p.bands, p.rows).astype(np.uint64)
                    key = np.arange(p.bands, dtype=np.uint64)
                    for r in range(p.rows):
                        key = A.mix64(key * np.uint64(0xA0761D6478BD642F) + rows[:, r])
                    keys[k] = key.view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(size),
                    pa.array(ids[0].view(np.int64)),
                    pa.array(ids[1].view(np.int64)),
                    pa.array(sigs, pa.binary()),
                    pa.array(keys, pa.list_(pa.int64())),
                ],
                names=SKETCH.names,
            )

    return run


def least_matches(p: Params) -> np.ndarray:
    """For each number n of compared positions, the fewest matches with which a pair lives on.

    Under a uniform prior the chance that a position agrees, given m of n agreeing, has a
    Beta(m + 1, n - m + 1) posterior; its upper tail at t is P(Binomial(n + 1, t) <= m).
    Positions keep 8 bits, so unequal values agree by chance 1 time in 256.
    """
    t = p.percent / 100
    t = t + (1 - t) / 256
    out = np.zeros(p.bands * p.rows + 1, np.int64)
    for n in range(1, len(out)):
        tail, m = 0.0, 0
        while m <= n:
            tail += comb(n + 1, m) * t**m * (1 - t) ** (n + 1 - m)
            if tail >= p.miss:
                break
            m += 1
        out[n] = m
    return out


def alive(a: np.ndarray, b: np.ndarray, p: Params, least: np.ndarray) -> np.ndarray:
    """Rows of the signature matrices ``a`` and ``b`` that no look at the posterior prunes."""
    left, matches, total = np.arange(len(a)), np.zeros(len(a), np.int64), a.shape[1]
    for k in range(0, total, p.batch):
        end = min(k + p.batch, total)
        matches = matches + (a[left, k:end] == b[left, k:end]).sum(axis=1)
        good = matches >= least[end]
        left, matches = left[good], matches[good]
        if not len(left):
            break
    return left


def _matrix(column, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, width)


PAIR = T.StructType([T.StructField("u", T.LongType()), T.StructField("v", T.LongType())])


def _pair_batch(u, v) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], names=["u", "v"])


def _prune(p: Params):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        least, width = least_matches(p), p.bands * p.rows
        for batch in batches:
            if len(batch):
                keep = alive(_matrix(batch.column(2), width), _matrix(batch.column(3), width), p, least)
                yield batch.take(pa.array(keep)).select([0, 1])

    return run


def _verify(p: Params):
    """Exact check on full shingle sets.  Neighbouring rows that repeat a text reuse its set."""

    def sets_of(text: str) -> np.ndarray:
        raw = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
        return np.unique(shingles(raw, np.array([0, len(raw)]), p.width)[0])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: list[tuple[str, np.ndarray]] = [("", np.empty(0, np.uint64))] * 2
        for batch in batches:
            ok = []
            for k, two in enumerate(zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)):
                for side, text in enumerate(two):
                    if seen[side][0] != text:
                        seen[side] = (text, sets_of(text))
                a, b = seen[0][1], seen[1][1]
                both = len(np.intersect1d(a, b, assume_unique=True))
                if 100 * both >= p.percent * (len(a) + len(b) - both) and both:
                    ok.append(k)
            yield batch.take(pa.array(ok, pa.int64())).select([0, 1])

    return run


def _links(candidates: DataFrame, sigs: DataFrame, texts: DataFrame, p: Params) -> DataFrame:
    """The distinct candidate pairs (u, v) that are links, written out."""
    s = sigs.select(F.col("id").alias("v"), F.col("sig").alias("sig_v"))
    pairs = candidates.join(s, "v").join(s.toDF("u", "sig_u"), "u").select("u", "v", "sig_u", "sig_v")
    pairs = materialise(pairs.mapInArrow(_prune(p), PAIR), "survivors")
    t = texts.select(F.col("id").alias("v"), F.col("text").alias("text_v"))
    whole = pairs.join(t, "v").join(t.toDF("u", "text_u"), "u").select("u", "v", "text_u", "text_v")
    return materialise(whole.mapInArrow(_verify(p), PAIR), "links")


def _near_labels(links: DataFrame) -> DataFrame:
    """(id, component): a smaller id that ``id`` surely reaches, at most two links away.

    Enough to tell most pairs of one component without the rounds of ``components``."""
    least = materialise(links.groupBy(F.col("v").alias("id")).agg(F.min("u").alias("component")), "near-labels")
    further = least.select(F.col("id").alias("component"), F.col("component").alias("further"))
    return least.join(further, "component", "left").select("id", F.coalesce("further", "component").alias("component"))


def _centre_pairs(members: DataFrame, labels: DataFrame | None, turn: int) -> DataFrame:
    """One centre for each bucket, paired with the bucket's members not yet known in the centre's component."""
    rows = members
    if labels is not None:
        rows = rows.join(labels, "id", "left").withColumn("component", F.coalesce("component", "id"))
    else:
        rows = rows.withColumn("component", F.col("id"))
    order = F.struct(F.xxhash64("id", F.lit(turn)).alias("o") if turn else F.col("id").alias("o"), "id", "component")
    centre = rows.groupBy("key").agg(F.min(order).alias("c")).select("key", "c.id", "c.component")
    # Written first, so that the join's exchanges stand directly below it and a hot bucket is split.
    centre = materialise(centre.toDF("key", "centre", "centre_component"), "centres")
    far = rows.join(centre, "key").where("component != centre_component")
    return far.select(F.least("id", "centre").alias("u"), F.greatest("id", "centre").alias("v")).distinct()


def _blocks(members: DataFrame, labels: DataFrame, p: Params) -> DataFrame:
    """Bucket members dealt to groups of at most two blocks, so that every two members of a
    bucket that lie in different components share a group.  Rows: key, i, j, side, id, component.

    The bucket's largest component needs no comparison within itself: its blocks (side 1)
    only meet the blocks of the others (side 0).
    """
    rows = members.join(labels, "id", "left").withColumn("component", F.coalesce("component", "id"))
    by = rows.groupBy("key", "component").agg(F.sum("n").alias("n"))
    mixed = (
        by.groupBy("key")
        .agg(F.max(F.struct("n", "component")).alias("top"), F.sum("n").alias("all"), F.count(F.lit(1)).alias("parts"))
        .where("parts > 1")
        .select(
            "key",
            F.col("top.component").alias("main"),
            F.ceil(F.col("top.n") / p.block).alias("mains"),
            F.ceil((F.col("all") - F.col("top.n")) / p.block).alias("others"),
        )
    )
    rows = rows.join(materialise(mixed, "mixed"), "key")  # written, as the centres are
    rows = rows.withColumn("side", (F.col("component") == F.col("main")).cast("int"))
    own = F.pmod(F.xxhash64("id"), F.when(F.col("side") == 1, F.col("mains")).otherwise(F.col("others")))
    rows = rows.withColumn("own", own)
    seq = lambda n: F.sequence(F.lit(0).cast("long"), n - 1)
    main = F.transform(seq(F.col("others")), lambda i: F.struct(i.alias("i"), F.col("own").alias("j"), F.lit(True).alias("main_side")))
    met = F.transform(seq(F.col("mains")), lambda j: F.struct(F.col("own").alias("i"), j.alias("j"), F.lit(True).alias("main_side")))
    rest = F.transform(
        seq(F.col("others")),
        lambda j: F.struct(F.least(j, F.col("own")).alias("i"), F.greatest(j, F.col("own")).alias("j"), F.lit(False).alias("main_side")),
    )
    rows = rows.withColumn("g", F.explode(F.when(F.col("side") == 1, main).otherwise(F.concat(met, rest))))
    return rows.select("key", "g.i", "g.j", "g.main_side", "side", "id", "component")


def _across(p: Params):
    """For sorted rows (key, i, j, main_side, side, id, component, sig, text): in each group of equal
    key, i, j and main_side, links (u, v) that join all members a link of the group joins.

    Candidates of different components pass the sequential test and are verified on their
    shingle sets; a link makes its components one, so what is joined already is not
    compared, and a group gives fewer links than it has members.
    """

    def flush(rows, main_side, least) -> tuple[list[int], list[int]]:
        side, ids, comps, sigs, texts = zip(*rows, strict=True)
        side, ids = np.array(side), np.array(ids)
        root = np.unique(comps, return_inverse=True)[1]
        u, v = [], []
        if root.max() == 0:
            return u, v
        sig = np.frombuffer(b"".join(sigs), np.uint8).reshape(len(ids), -1)
        raw = [t.encode("utf-8", "surrogatepass") for t in texts]
        off = np.zeros(len(raw) + 1, np.int64)
        np.cumsum([len(t) for t in raw], out=off[1:])
        sh, soff = shingles(np.frombuffer(b"".join(raw), np.uint8), off, p.width)
        who = A.owners(soff)
        # Distinct (member, shingle) pairs, shingles as small numbers.
        number = np.unique(sh, return_inverse=True)[1]
        item = np.unique(who * (number.max() + 1) + number)
        who, number = np.divmod(item, number.max() + 1)
        edge = np.searchsorted(who, np.arange(len(ids) + 1))
        size = np.diff(edge)
        mark = np.zeros(number.max() + 1, bool)
        for k in np.flatnonzero(side == 0):
            other = (root != root[k]) & ((side == 1) if main_side else (np.arange(len(ids)) > k))
            near = np.flatnonzero(other)
            if not len(near):
                continue
            near = near[alive(np.broadcast_to(sig[k], (len(near), sig.shape[1])), sig[near], p, least)]
            if not len(near):
                continue
            own = number[edge[k] : edge[k + 1]]
            mark[own] = True
            n = size[near]
            at = np.arange(n.sum()) + np.repeat(edge[near] - (np.cumsum(n) - n), n)
            both = np.add.reduceat(mark[number[at]], np.cumsum(n) - n, dtype=np.int64)
            mark[own] = False
            linked = near[100 * both >= p.percent * (size[k] + n - both)]
            found, first = np.unique(root[linked], return_index=True)
            u += [int(ids[k])] * len(found)
            v += ids[linked[first]].tolist()
            root[np.isin(root, found)] = root[k]
        return u, v

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        least = least_matches(p)
        now, held, u, v = None, [], [], []
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if row[:4] != now:
                    if held:
                        for into, more in zip((u, v), flush(held, now[3], least), strict=True):
                            into += more
                    now, held = row[:4], []
                held.append(row[4:])
            yield _pair_batch(u, v)
            u, v = [], []
        if held:
            yield _pair_batch(*flush(held, now[3], least))

    return run


def near_duplicates(
    docs: DataFrame, p: Params | None = None, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for every row of ``docs``.

    component_id is the smallest id reachable over links, kept whether it is the row's own.
    Null or blank texts have no shingles and are linked with nothing.  Rows that repeat an id
    are one document: their texts' links are joined.  A row without an id can be no one's
    component: it gets its n_shingles, a null component_id and kept = true.  Other columns of
    ``docs`` are not read; an empty table gives no rows.
    """
    p = p or Params()
    src = docs.select(col(id_col).cast("long").alias("doc_id"), col(text_col).alias("text"))
    sketch = materialise(src.mapInArrow(_sketch(p), SKETCH), "sketch")
    named = sketch.where("n_shingles > 0 and doc_id is not null")
    classes = named.groupBy("set_a", "set_b").agg(
        F.min("doc_id").alias("id"), F.min_by("sig", "doc_id").alias("sig"), F.min_by("keys", "doc_id").alias("keys"), F.first("n_shingles").alias("n")
    )
    classes = materialise(classes, "classes")
    rows = classes.select("id", "n", F.explode("keys").alias("key"))
    shared = rows.groupBy("key").agg(F.count("id").alias("n")).where("n > 1").select("key")
    members = materialise(rows.join(shared, "key", "left_semi"), "members")
    sigs = classes.select("id", "sig")
    involved = bounded(members.select(F.col("id").alias("doc_id")).distinct(), p.broadcast_rows)
    texts = materialise(src.join(involved, "doc_id", "left_semi").select(F.col("doc_id").alias("id"), "text").distinct(), "texts")

    # Rows that repeat an id under another text join their classes.
    same = named.select("doc_id", "set_a", "set_b").join(
        classes.select("set_a", "set_b", "id"), ["set_a", "set_b"]
    )
    edges = same.where("doc_id != id").select(F.col("id").alias("u"), F.col("doc_id").alias("v"))
    found, labels = None, None
    for turn in range(p.star_rounds):
        links = _links(_centre_pairs(members, labels, turn), sigs, texts, p)
        found = links if found is None else found.union(links)
        labels = materialise(_near_labels(found), "labels")
    order = ["key", "i", "j", "main_side"]
    groups = _blocks(members, labels, p).join(sigs.join(texts, "id"), "id").select(*order, "side", "id", "component", "sig", "text")
    across = groups.repartition(partitions(docs), *order).sortWithinPartitions(*order).mapInArrow(_across(p), PAIR)
    labels = materialise(components(found.union(across).union(edges)), "labels")
    out = sketch.select("doc_id", "n_shingles").join(labels, sketch["doc_id"] == labels["id"], "left")
    component = F.coalesce("component", "doc_id")
    return out.select(
        "doc_id",
        "n_shingles",
        component.alias("component_id"),
        (F.col("doc_id").isNull() | (F.col("doc_id") == component)).alias("kept"),
    )


def keep_representatives(docs: DataFrame, p: Params | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the rows whose component has a smaller id, columns unchanged.

    Rows that repeat the kept id all stay (they are one document); rows without an id stay.
    """
    found = near_duplicates(docs, p, id_col, text_col)
    gone = found.where("not kept").select(F.col("doc_id").alias("_gone")).distinct()
    # Few enough ids are broadcast after a count; more are joined by shuffle.
    gone = bounded(materialise(gone, "dropped"), (p or Params()).broadcast_rows)
    packed = docs.select(F.struct(*[col(c) for c in docs.columns]).alias("row"), col(id_col).cast("long").alias("_id"))
    return packed.join(gone, F.col("_id") == F.col("_gone"), "left_anti").select("row.*")

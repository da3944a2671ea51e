"""Language identification by hierarchical discrimination.

Linear support vector machines over hashed byte n-grams first predict the language family
(one against the rest); within it, one machine for each pair of languages votes.  Machines
are trained on a bounded sample of labelled documents, each in its own task.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import arrays as A
from .store import Shared, bounded, col, materialise

# Families of ISO 639-1 language codes; other codes are families of their own.
FAMILIES = {
    "germanic": ("en", "de", "nl", "af", "sv", "da", "no", "nb", "nn", "is", "lb", "fy", "yi"),
    "romance": ("fr", "es", "it", "pt", "ro", "ca", "gl", "oc", "la"),
    "slavic": ("ru", "uk", "be", "pl", "cs", "sk", "sl", "hr", "sr", "bs", "bg", "mk"),
    "baltic": ("lt", "lv"),
    "uralic": ("fi", "et", "hu"),
    "turkic": ("tr", "az", "kk", "uz", "ky", "tk", "tt"),
    "indo-aryan": ("hi", "ur", "bn", "pa", "mr", "gu", "ne", "si"),
    "semitic": ("ar", "he", "mt", "am"),
    "celtic": ("ga", "gd", "cy", "br"),
}
#: Languages up to this count have their cut-offs broadcast (counted).
MOST_LANGUAGES = 100_000
_FAMILY = {code: name for name, codes in FAMILIES.items() for code in codes}


def family(lang: str) -> str:
    return _FAMILY.get(lang.lower().split("-")[0], lang)


@dataclass(frozen=True)
class Params:
    """per_language: labelled documents in the sample for each language; family_rows: rows of the
    sample (about) that train the family machines.  bits: log2 of the feature count.
    epochs, c: training.  held_mod, held_rest: documents with crc32(id) mod held_mod = held_rest
    are not learned from.
    """

    per_language: int = 400
    family_rows: int = 3200
    bits: int = 13
    epochs: int = 12
    c: float = 4.0
    held_mod: int = 4
    held_rest: int = 2
    seed: int = 23


def held_out(id_col: Column, p: Params) -> Column:
    rest = F.crc32(id_col.cast("string").cast("binary")) % p.held_mod == p.held_rest
    return F.coalesce(rest, F.lit(False))


# Letters keep their (lowered) byte, bytes of non-ASCII characters too, all else is a space.
_FOLD = np.full(256, 32, np.uint8)
_FOLD[97:123] = np.arange(97, 123)
_FOLD[65:91] = np.arange(97, 123)
_FOLD[128:] = np.arange(128, 256)


def features(raw: np.ndarray, bits: int) -> np.ndarray:
    """Unit vector of square-rooted counts of hashed byte pairs and triples; zero if there are none."""
    size = 1 << bits
    b = _FOLD[raw]
    blank = b == 32
    b = b[~(blank & np.append(True, blank[:-1]))].astype(np.uint32)
    out = np.zeros(size, np.float32)
    if len(b) >= 2:
        shift = np.uint32(32 - bits)
        two = b[:-1] * np.uint32(2654435761) + b[1:] * np.uint32(2246822519)
        counts = np.bincount((two ^ (two >> np.uint32(15))) * np.uint32(3266489917) >> shift, minlength=size)
        three = two[:-1] * np.uint32(668265263) + b[2:] * np.uint32(374761393)
        counts += np.bincount((three ^ (three >> np.uint32(15))) * np.uint32(3266489917) >> shift, minlength=size)
        out = np.sqrt(counts).astype(np.float32)
        out /= np.sqrt(counts.sum())
    return out


def train(x: np.ndarray, y: np.ndarray, p: Params) -> np.ndarray:
    """Weights (bias last) of a linear SVM: dual coordinate descent on the hinge loss, classes balanced."""
    x = np.hstack([x, np.ones((len(x), 1), x.dtype)]).astype(np.float64)
    s = np.where(y, 1.0, -1.0)
    positives = max(int(y.sum()), 1)
    bound = p.c * np.where(y, len(y) / (2.0 * positives), len(y) / (2.0 * max(len(y) - positives, 1)))
    alpha, w = np.zeros(len(x)), np.zeros(x.shape[1])
    norm = (x * x).sum(axis=1)
    rng = np.random.default_rng(p.seed)
    for _ in range(p.epochs):
        for i in rng.permutation(len(x)):
            new = min(max(alpha[i] - (s[i] * (w @ x[i]) - 1.0) / norm[i], 0.0), bound[i])
            w += (new - alpha[i]) * s[i] * x[i]
            alpha[i] = new
    return w


SAMPLE = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("lang", T.StringType()), T.StructField("x", T.BinaryType())])


@dataclass
class Model:
    languages: list[str]
    families: dict[str, list[str]]
    family_weights: dict[str, np.ndarray]
    pair_weights: dict[tuple[str, str], np.ndarray]
    bits: int


def _smallest_hashes(known: DataFrame, p: Params) -> DataFrame:
    """(doc_id, lang) of the ``per_language`` ids of every language with the smallest hashes.

    A cut-off of the hash from each language's (approximate) number of ids lets about eight times as many
    through, so the window that takes the smallest sorts a bounded number of rows however many there are."""
    unit = F.shiftrightunsigned(F.xxhash64("doc_id", F.lit(p.seed)), 11) / float(1 << 53)
    sizes = known.groupBy("lang").agg(F.approx_count_distinct("doc_id").alias("n"))
    cuts = materialise(sizes.select("lang", (F.lit(8.0 * p.per_language) / F.greatest("n", F.lit(1))).alias("cut")), "language-cuts")
    few = known.join(bounded(cuts, MOST_LANGUAGES), "lang").where(unit < F.col("cut")).select("doc_id", "lang").distinct()
    turn = F.row_number().over(Window.partitionBy("lang").orderBy(unit, "doc_id"))
    return few.withColumn("turn", turn).where(F.col("turn") <= p.per_language)


def fit(docs: DataFrame, p: Params | None = None, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> Model:
    """Train on at most per_language documents of every language (those with the smallest hash)."""
    p = p or Params()
    src = docs.select(col(id_col).cast("long").alias("doc_id"), col(lang_col).cast("string").alias("lang"), col(text_col).alias("text"))
    known = src.where(F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"), p)).select("doc_id", "lang")
    chosen = materialise(_smallest_hashes(known, p), "language-sample")

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            buf, off = A.text_buffer(batch.column(2))
            x = [features(buf[a:b], p.bits).tobytes() for a, b in zip(off[:-1], off[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(x, pa.binary())], names=SAMPLE.names)

    picked = src.join(F.broadcast(chosen.select("doc_id", "lang")), ["doc_id", "lang"], "left_semi")
    # Of rows that share id and language the one with the smallest text hash is learned.
    least = F.min(F.struct(F.xxhash64("text").alias("h"), F.col("text")))
    picked = picked.groupBy("doc_id", "lang").agg(least.alias("one")).select("doc_id", "lang", "one.text")
    sample = materialise(picked.mapInArrow(vectors, SAMPLE), "language-vectors")
    languages = sorted(r[0] for r in sample.select("lang").distinct().collect())
    families: dict[str, list[str]] = {}
    for lang in languages:
        families.setdefault(family(lang), []).append(lang)

    # One group of the sample for each machine.
    few = max(20, p.family_rows // max(len(languages), 1))
    jobs = [("family", f, "", lang) for f in families for lang in languages] if len(families) > 1 else []
    jobs += [("pair", a, b, lang) for group in families.values() for k, a in enumerate(group) for b in group[k + 1 :] for lang in (a, b)]
    model = Model(languages, families, {}, {}, p.bits)
    if not jobs:
        return model
    wanted = docs.sparkSession.createDataFrame(jobs, "kind string, a string, b string, lang string")
    turn = F.row_number().over(Window.partitionBy("lang").orderBy(F.xxhash64("doc_id", F.lit(p.seed)), "doc_id"))
    rows = sample.withColumn("turn", turn).join(F.broadcast(wanted), "lang").where((F.col("kind") == "pair") | (F.col("turn") <= few))

    def machine(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["doc_id", "lang"])
        kind, a, b = rows.iloc[0][["kind", "a", "b"]]
        x = np.frombuffer(b"".join(rows["x"]), np.float32).reshape(len(rows), -1)
        y = (rows["lang"] == a).to_numpy() if kind == "pair" else rows["lang"].map(family).eq(a).to_numpy()
        return pd.DataFrame({"kind": [kind], "a": [a], "b": [b], "w": [train(x, y, p).tobytes()]})

    for kind, a, b, w in rows.groupBy("kind", "a", "b").applyInPandas(machine, "kind string, a string, b string, w binary").collect():
        if kind == "family":
            model.family_weights[a] = np.frombuffer(w)
        else:
            model.pair_weights[a, b] = np.frombuffer(w)
    return model


def _sigmoid(x):
    return 1.0 / (1.0 + np.exp(-np.clip(4.0 * x, -50, 50)))


_LETTER = re.compile(r"[^\W\d_]")
PREDICTED = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])


def decide(x: np.ndarray, model: Model) -> tuple[str, float]:
    """(language, score): the likeliest family, then the language that wins most pairs within it."""
    share, name = 1.0, next(iter(model.families))
    if model.family_weights:
        names = sorted(model.family_weights)
        s = _sigmoid(np.array([x @ model.family_weights[f][:-1] + model.family_weights[f][-1] for f in names]))
        best = int(np.argmax(s))
        name, share = names[best], float(s[best] / s.sum())
    group = model.families[name]
    if len(group) == 1:
        return group[0], share
    wins, sure = dict.fromkeys(group, 0), dict.fromkeys(group, 0.0)
    for k, a in enumerate(group):
        for b in group[k + 1 :]:
            w = model.pair_weights[a, b]
            q = float(_sigmoid(x @ w[:-1] + w[-1]))
            wins[a if q >= 0.5 else b] += 1
            sure[a] += q
            sure[b] += 1 - q
    best = max(group, key=lambda lang: (wins[lang], sure[lang]))
    return best, share * sure[best] / (len(group) - 1)


def predict(docs: DataFrame, model: Model, p: Params | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, held_out, lang_pred, score) for every row of ``docs``.

    A text that is null or has no letter gets ``und`` with score 0; so does every text when no
    document has a language to learn.  Of languages with equal votes the surer, then the first by code, wins.
    Rows are independent; repeated rows get equal results.
    """
    p = p or Params()
    shared = Shared(docs, "language model", model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = shared.get()
            buf, off = A.text_buffer(batch.column(1))
            lang, score = [], []
            for a, b in zip(off[:-1], off[1:], strict=True):
                raw = buf[a:b]
                if not made.languages or _LETTER.search(raw.tobytes().decode("utf-8", "replace")) is None:
                    lang.append("und")
                    score.append(0.0)
                    continue
                got = decide(features(raw, made.bits), made)
                lang.append(got[0])
                score.append(got[1])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(lang, pa.string()), pa.array(score, pa.float64())], names=PREDICTED.names)

    src = docs.select(col(id_col).cast("long").alias("doc_id"), col(text_col).alias("text"))
    return src.mapInArrow(run, PREDICTED).select("doc_id", held_out(F.col("doc_id"), p).alias("held_out"), "lang_pred", "score")

"""The n-gram model as a probability: sums over the vocabulary, and scores against exact counts."""

import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from stockyard.llm import arrays, ngram_lm, store

SF = "/root/testdata/sf0.01"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def az_lower(text):
    return text.translate({c: c + 32 for c in range(65, 91)})


@pytest.fixture(scope="module")
def texts():
    return {r["doc_id"]: [az_lower(w) for w in WORD.findall(r["text"] or "")] for r in pq.read_table(f"{SF}/documents.parquet").to_pylist()}


@pytest.fixture(scope="module")
def exact(texts):
    """Counts of words (None: end) and of pairs after each context (\"\": begin)."""
    words, after = Counter(), defaultdict(Counter)
    for i, ws in texts.items():
        if zlib.crc32(b"%d" % i) % 7 != 2:
            words.update([*ws, None])
            for a, b in zip(["", *ws], [*ws, None]):
                after[a][b] += 1
    return words, after


@pytest.fixture(scope="module")
def model(spark):
    return ngram_lm.fit(spark.read.parquet(f"{SF}/documents.parquet"))


def hashes(words):
    data = [w.encode() for w in words]
    off = np.concatenate([[0], np.cumsum([len(d) for d in data])]).astype(np.int64)
    h, woff = arrays.words(np.frombuffer(b"".join(data), np.uint8), off)
    assert len(h) == len(words) and (np.diff(woff) == 1).all()
    return h


def test_probabilities_sum_to_one_after_every_kind_of_context(model, exact):
    """Contexts learned once, rarely, often and very often."""
    words, after = exact
    p = model.params
    bloom = ngram_lm.Filter(*model.filter.broadcast.value, model.probes)
    names = [w for w in words if w is not None]
    vocabulary = np.append(hashes(names), ngram_lm.END)
    own = ngram_lm.step_count(bloom.levels(vocabulary), p.word_ratio)
    by_hash = dict(zip(names, vocabulary))
    assert len(vocabulary) == model.vocabulary
    rng = np.random.default_rng(0)
    kinds = {(1, 1): 60, (2, 3): 40, (4, 10): 40, (50, 200): 40, (1000, 10**9): 20}
    for (low, high), n in kinds.items():
        some, sums = [c for c in names if low <= words[c] <= high], []
        for c in rng.choice(some, min(n, len(some)), replace=False):
            context = np.full(len(vocabulary), by_hash[c])
            before = ngram_lm.step_count(bloom.levels(context[:1]), p.word_ratio)[0]
            probs = ngram_lm.probabilities(vocabulary, context, own, np.full(len(vocabulary), before), bloom.levels, model.mass, model.excess, p)
            unknown = 1 / model.mass
            sums.append(probs.sum() + unknown)
        # In expectation one; the chance hits of a single context vary about their expected number.
        assert 0.98 <= np.mean(sums) <= 1.02 and 0.9 <= min(sums) and max(sums) <= 1.1, (low, sums)
        assert low < 1000 or 0.98 <= min(sums) and max(sums) <= 1.02
    for before in (0.0, float(words[None])):  # after an unknown word, and at the begin of a text
        context = np.full(len(vocabulary), ngram_lm._BEGIN[0] if before else 12345, np.uint64)
        probs = ngram_lm.probabilities(vocabulary, context, own, np.full(len(vocabulary), before), bloom.levels, model.mass, model.excess, p)
        assert 0.98 <= probs.sum() <= 1.02


def test_score_against_exact_counts(spark, model, texts, exact):
    """A token's probability is off by at most the middle of a step of each scale, sqrt(1.12) and sqrt(1.04) twice,
    and by chance hits, which are rare and weigh little."""
    words, after = exact
    total, distinct, most = sum(words.values()), len(words), model.params.pair_weight
    step, off, n = math.log10(math.sqrt(1.12) * 1.04) + 0.005, 0.0, 0
    for r in ngram_lm.score(spark.read.parquet(f"{SF}/documents.parquet"), model).collect():
        ws, want = texts[r["doc_id"]], 0.0
        for a, b in zip(["", *ws], [*ws, None]):
            before = words[None] if a == "" else words[a]
            word, whole = (words[b] + 1) / (total + distinct + 1), before + model.excess
            weight = most * before / whole
            want += math.log10(weight * after[a][b] / whole + (1 - weight) * word)
        assert abs(r["score"] - want) <= step * (len(ws) + 1) + 1, (r["doc_id"], r["score"], want)
        off, n = off + (r["score"] - want), n + len(ws) + 1
    assert abs(off / n) < 0.003


def test_more_bits_leave_less_to_chance(spark, exact):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    score = {}
    for bits in (8.0, 30.0):
        model = ngram_lm.fit(docs, ngram_lm.Params(bits=bits))
        rows = [r for r in ngram_lm.score(docs, model).collect() if r["held_out"]]
        score[bits] = sum(r["score"] for r in rows) / sum(r["n_tokens"] for r in rows), model.excess
        base = sum(r["base_score"] for r in rows) / sum(r["n_tokens"] for r in rows)
    assert score[30.0][1] < 0.1 < 100 < score[8.0][1]
    assert base < score[8.0][0] < score[30.0][0]


def test_steps_are_exact_below_their_ratio():
    counts = np.arange(1, 2000)
    read = ngram_lm.step_count(ngram_lm.step_of(counts, 1.04), 1.04)
    assert (read[:25] == counts[:25]).all() and np.abs(read / counts - 1).max() < 0.03
    assert ngram_lm.step_count(np.array([0]), 1.04)[0] == 0


def test_doubling_and_halving_read_every_level():
    rng = np.random.default_rng(1)
    keys = rng.integers(0, 2**64, 3000, dtype=np.uint64)
    level = rng.integers(1, 700, len(keys))
    bits = 64 * (int(level.sum()) * 30 // 64)
    made = ngram_lm.Filter([ngram_lm.segment(keys, level, bits, 20)], bits, 20)
    got = made.levels(keys)
    assert (got >= level).all() and (got > level).mean() < 0.01
    assert not made.levels(rng.integers(0, 2**64, 50_000, dtype=np.uint64)).any()


class Asked(ngram_lm.Filter):
    asked = 0

    def has(self, key, level):
        self.asked += len(key)
        return super().has(key, level)


def test_common_keys_are_asked_once():
    """Frequent n-grams come in every chunk of texts; each of them was asked level by level anew."""
    rng = np.random.default_rng(2)
    keys = np.unique(rng.integers(0, 2**64, 2000, dtype=np.uint64))
    level = rng.integers(1, 300, len(keys))
    bits = 64 * (int(level.sum()) * 30 // 64)
    made = Asked([ngram_lm.segment(keys, level, bits, 20)], bits, 20)
    first, n = made.levels(keys), made.asked
    assert np.array_equal(made.levels(keys), first)
    assert made.asked - n < n / 4


def test_keys_of_one_place_keep_their_own_levels():
    """Whatever was read before, in whatever order, a key's level is what a new filter reads."""
    rng = np.random.default_rng(4)
    some = rng.integers(0, 2**64, 300, dtype=np.uint64)
    keys = np.unique(np.concatenate([some, some << np.uint64(24), some | np.uint64(0xFFFFFF), np.array([0, 1, 2, 2**64 - 1], np.uint64)]))
    level = rng.integers(1, 90, len(keys))
    bits = 64 * (int(level.sum()) * 12 // 64)
    new = lambda: ngram_lm.Filter([ngram_lm.segment(keys, level, bits, 8)], bits, 8)
    absent = np.concatenate([rng.integers(0, 2**64, 300, dtype=np.uint64), keys[:50] ^ np.uint64(1 << 60)])
    asked = np.concatenate([keys, absent])
    want, made = new().levels(asked), new()
    for _ in range(5):
        order = rng.permutation(len(asked))
        for lo in range(0, len(order), 200):
            at = order[lo : lo + 200]
            assert np.array_equal(made.levels(asked[at]), want[at])
    assert all(new().levels(asked[i : i + 1])[0] == want[i] for i in range(0, len(asked), 50))
    empty = ngram_lm.Filter([np.zeros(8, np.uint8)], 64, 8)
    assert not empty.levels(np.array([0, 1, 2**64 - 1], np.uint64)).any() and not len(empty.levels(keys[:0]))


def test_packed_rows_stay_small_and_whole():
    """Pairs and kept n-grams travel in rows of a bounded number of keys, and none is lost (one row held a whole part)."""
    p, n = ngram_lm.Params(), 3 * ngram_lm.PACKED + 5
    rng = np.random.default_rng(3)
    keys = np.unique(rng.integers(0, 1 << 64, n, np.uint64))
    counts = rng.integers(1, 400, len(keys))
    cut = lambda a, size: [a[i : i + size] for i in range(0, len(a), size)]
    sent = pa.RecordBatch.from_arrays(
        [
            pa.array([0, 0], pa.int32()),
            pa.array([k.tobytes() for k in cut(keys, len(keys) // 2 + 1)], pa.binary()),
            pa.array([ngram_lm._pack(c) for c in cut(counts, len(keys) // 2 + 1)], pa.binary()),
        ],
        names=ngram_lm.PAIRS.names,
    )
    rows = [r for b in ngram_lm._kept_pairs(p)(iter([sent, sent])) for r in b.to_pylist()]
    assert len(rows) > 1 and all(len(r["keys"]) <= 8 * ngram_lm.PACKED for r in rows)
    assert np.array_equal(np.concatenate([np.frombuffer(r["keys"], np.uint64) for r in rows]), keys)
    level = ngram_lm.step_of(2 * counts, p.pair_ratio)
    assert np.array_equal(np.concatenate([np.frombuffer(r["levels"], np.uint16) for r in rows]), level)
    assert sum(r["inserts"] for r in rows) == level.sum()
    words = pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(counts)], names=["h", "c"])
    rows = [r for b in ngram_lm._word_rows(p, 2)(iter([words])) for r in b.to_pylist()]
    assert {r["part"] for r in rows} == {0, 1} and all(len(r["keys"]) <= 8 * ngram_lm.PACKED for r in rows)
    assert np.array_equal(np.sort(np.concatenate([np.frombuffer(r["keys"], np.uint64) for r in rows])), keys)


def test_counting_tasks_drop_a_former_model(monkeypatch):
    freed = []
    monkeypatch.setattr(arrays, "release", lambda: freed.append(dict(store._held)))
    monkeypatch.setattr(store, "_held", {"n-gram filter": ("a", 1), "frequent words": ("b", 2), "other": ("c", 3)})
    assert list(ngram_lm._lean(lambda batches: batches, ngram_lm._HELD)(iter([1, 2]))) == [1, 2]
    assert freed == [{"other": ("c", 3)}] * 2  # before the task's work and after it

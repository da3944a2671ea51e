"""Nulls, empty and long texts, ties, repeated rows, empty tables, clashing column names."""

import math
import random
from collections import Counter
from datetime import date

import numpy as np
import pytest
from pyspark.sql import functions as F

from stockyard.llm import arrays, bpe, exact_dedup, fingerprint, graph, language, licenses, mixing, near_dedup, ngram_lm, pii, toxicity

LONG = "the quick brown fox jumps over a lazy dog " * 20_000
CLASH = "id u v component row h sha maybe word mask copies rate target size text_v sig key label score kept _gone _text _id _mask place"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{c}` string" for c in CLASH.split())
EXTRA = tuple("x" for _ in CLASH.split())
ROWS = [
    (1, "Alpha beta gamma delta epsilon zeta", "en", "a", 5),
    (1, "Alpha beta gamma delta epsilon zeta", "en", "a", 5),  # repeated row
    (2, "ALPHA beta gamma delta epsilon zeta", "en", "b", None),
    (3, None, None, None, None),
    (4, "", "fr", "a", 0),
    (5, " \t\n", "fr", None, 3),
    (6, LONG, "en", "b", len(LONG)),
    (None, "alpha beta gamma delta epsilon zeta", "de", "c", 1),
    (None, None, None, None, None),
    (8, "\U0001f600 é 1234 !!", "de", "c", 1),
    (9, "solo", "en", "c", 1),
    (9, "another text under the same id", "en", "c", 1),
]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([r + EXTRA for r in ROWS], SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(1, 1), (2, 0), (4, 0), (9, 0), (None, 1), (6, None), (77, 1)], "doc_id long, toxic int")


def rows(df):
    return [r.asDict(recursive=True) for r in df.collect()]


def test_fingerprint(docs, none):
    got = rows(fingerprint.edit_neighbours(docs))
    assert Counter(r["doc_id"] for r in got) == Counter(r[0] for r in ROWS)
    ones = [r for r in got if r["doc_id"] == 1]
    assert ones[0] == ones[1]
    first = ones[0]
    text, last = ROWS[0][1], {"solo", ROWS[-1][1]}  # after the smallest id comes the largest
    edits = [text[: len(text) - 11] + x[:11] if len(x) >= 11 else text[: len(text) - 11] + x for x in last]
    import hashlib

    assert first["edited_sha256"] in {hashlib.sha256(e.encode()).hexdigest() for e in edits}
    empty = next(r for r in got if r["doc_id"] == 3)
    assert (empty["n_chars"], empty["fingerprint"], empty["near_edited"]) == (0, "", 1.0)
    assert rows(fingerprint.edit_neighbours(none)) == []
    marks = rows(fingerprint.fingerprint(docs))
    assert len(marks) == len(ROWS) and len({r["fingerprint"] for r in marks if r["doc_id"] == 1}) == 1


def test_fingerprint_is_locally_consistent():
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 8)))
    body = " ".join(word() for _ in range(400))
    a, b, c = (" ".join(word() for _ in range(n)) for n in (7, 30, 400))
    x, y, z = fingerprint.sketches([a + body, b + " " + body, c])
    assert fingerprint.likeness(x, y) > 0.75 > 0.05 > fingerprint.likeness(x, z)


def test_near_duplicates_edges(docs, none):
    got = rows(near_dedup.near_duplicates(docs, near_dedup.Params(width=2)))
    assert len(got) == len(ROWS)
    by = {}
    for r in got:
        by.setdefault(r["doc_id"], []).append(r)
    assert [r["component_id"] for r in by[1]] == [1, 1] and by[2][0]["component_id"] == 1 and not by[2][0]["kept"]
    assert by[3][0]["n_shingles"] == by[4][0]["n_shingles"] == by[5][0]["n_shingles"] == 0
    assert all(r["component_id"] is None and r["kept"] for r in by[None])
    assert by[6][0]["n_shingles"] == 9
    assert sorted(r["n_shingles"] for r in by[9]) == [1, 5]
    kept = near_dedup.keep_representatives(docs, near_dedup.Params(width=2))
    assert kept.columns == docs.columns and kept.count() == len(ROWS) - 1
    assert rows(near_dedup.near_duplicates(none)) == [] and near_dedup.keep_representatives(none).count() == 0


@pytest.mark.parametrize("block,turns", [(250, 1), (150, 2), (100_000, 1)])
def test_near_duplicates_in_blocks(spark, block, turns):
    """A chain and a cloud of near copies: components need links that no centre has."""
    rng = random.Random(5)
    base = [f"w{k}" for k in range(60)]
    texts = []
    for k in range(40):
        w = list(base)
        for _ in range(k % 5):
            w[rng.randrange(60)] = f"x{rng.random()}"
        texts.append(" ".join(w))
    for k in range(25):  # each shares 90 % with the one before
        texts.append(" ".join(f"c{j}" for j in range(3 * k, 3 * k + 60)))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    from test_llm_queries import brute_components

    want = brute_components({i: {"text": t} for i, t in enumerate(texts)}, 2)
    got = near_dedup.near_duplicates(docs, near_dedup.Params(width=2, block=block, star_rounds=turns))
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in rows(got)} == want


def test_sequential_pruning_keeps_the_threshold():
    p = near_dedup.Params()
    least = near_dedup.least_matches(p)
    rng = np.random.default_rng(1)
    a = rng.integers(0, 256, (20_000, p.bands * p.rows), dtype=np.uint8)
    same = rng.random(a.shape) < 0.8
    b = np.where(same, a, rng.integers(0, 256, a.shape, dtype=np.uint8))
    assert len(near_dedup.alive(a, b, p, least)) >= 20_000 - 5
    c = np.where(rng.random(a.shape) < 0.4, a, rng.integers(0, 256, a.shape, dtype=np.uint8))
    assert len(near_dedup.alive(a, c, p, least)) < 20


def test_components(spark):
    rng = random.Random(2)
    edges = [(k, k + 1) for k in range(100, 140)] + [(7, k) for k in range(200, 260)] + [(rng.randrange(1000, 1100), rng.randrange(1000, 1100)) for _ in range(60)]
    edges += [(7, 7), (140, 139)]
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for u, v in edges:
        x, y = find(u), find(v)
        parent[max(x, y)] = min(x, y)
    got = {r["id"]: r["component"] for r in rows(graph.components(spark.createDataFrame(edges, "u long, v long")))}
    assert got == {k: find(k) for k in parent if any(k in e and e[0] != e[1] for e in edges)}
    assert rows(graph.components(spark.createDataFrame([], "u long, v long"))) == []


def test_toxicity_edges(docs, none, labels):
    index = toxicity.fit(docs, labels)
    got = rows(toxicity.score(docs, index))
    assert len(got) == len(ROWS) and all(0 <= r["score"] <= 1 for r in got)
    assert all(r["vote"] is None and r["evidence"] == [] for r in got if r["doc_id"] in (3, 4, 5))
    kept = toxicity.keep_clean(docs, index)
    assert kept.schema == docs.schema and kept.count() == sum(r["predicted"] == 0 for r in got)
    assert rows(toxicity.score(none, toxicity.fit(none, labels))) == []
    assert len(rows(toxicity.score(docs, toxicity.fit(docs, labels.where("false"))))) == len(ROWS)


def test_block_max_search_is_exact():
    rng = np.random.default_rng(4)
    examples = []
    for i in range(300):
        t = np.sort(rng.choice(40, rng.integers(0, 8), replace=False))
        examples.append((i, int(rng.random() < 0.4), t, rng.integers(1, 9, len(t))))
    idf = 1 + rng.random(41)
    index = toxicity.build_index(np.arange(40, dtype=np.uint64), idf, examples, 16)
    dense = np.zeros((len(index.examples), 41))
    by_id = {e[0]: e for e in examples}
    for k, i in enumerate(index.examples):
        dense[k, by_id[i][2]] = index.weigh(by_id[i][2], by_id[i][3])
    for _ in range(100):
        t = np.sort(rng.choice(40, rng.integers(1, 6), replace=False))
        w = index.weigh(t, rng.integers(1, 9, len(t)))
        near, cos = index.nearest(t, w, 7)
        all_cos = dense[:, t] @ w
        want = [k for k in np.lexsort((np.arange(len(all_cos)), -all_cos)) if all_cos[k] > 0][:7]
        assert np.allclose(cos, all_cos[want]) and np.allclose(all_cos[near], cos)


def test_licenses_edges(spark, docs, none):
    assert rows(licenses.scan(docs)) == [] == rows(licenses.scan(none))
    texts = [
        (1, "foo\nreleased UNDER the mit   license!\nbar"),
        (1, "foo\nreleased UNDER the mit   license!\nbar"),
        (2, "Released under the MIT License."),
        (None, "This work is licensed under the GNU General Public License, version 2."),
        (3, "released license"),
    ]
    got = sorted((str(r["doc_id"]), r["line"], r["license"], r["dice"]) for r in rows(licenses.scan(spark.createDataFrame(texts, "doc_id long, text string"))))
    assert got == [("1", 2, "MIT", 1.0), ("1", 2, "MIT", 1.0), ("2", 1, "MIT", 1.0), ("None", 1, "GPL-2.0", 1.0)]


def test_mixing_edges(spark, docs, none):
    got = rows(mixing.plan(docs))
    assert len(got) == len(ROWS) and all(r["taken"] <= 3 * r["size"] for r in got)
    assert rows(mixing.plan(none)) == [] and mixing.mix(none).count() == 0
    mixed = mixing.mix(docs)
    assert mixed.columns == docs.columns
    want = Counter({(r["doc_id"], r["size"]): r["taken"] // r["size"] for r in got if r["size"] and r["doc_id"] not in (1, None)})
    have = Counter((r["doc_id"], len((r["text"] or "").split())) for r in rows(mixed) if (r["text"] or "").strip() and r["doc_id"] not in (1, None))
    assert have == +want
    blank = spark.createDataFrame([(1, "", "a"), (2, None, None)], "doc_id long, text string, source string")
    assert [r["target"] for r in rows(mixing.plan(blank))] == [0.0, 0.0] and mixing.mix(blank).count() == 2


def test_mixing_hot_source(spark):
    """A third of all rows in one source; every source's words come near its target."""
    n = 9000
    docs = spark.range(n).select(
        F.col("id").alias("doc_id"), F.lit("a b c d e f g h i j").alias("text"),
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("s"), (F.col("id") % 7).cast("string"))).alias("source"),
    )
    got = rows(mixing.plan(docs).join(docs.select("doc_id", "source"), "doc_id").groupBy("source").agg(F.sum("taken").alias("taken"), F.max("target").alias("target")))
    assert all(abs(r["taken"] - r["target"]) < 0.1 * r["target"] for r in got)
    assert abs(sum(r["target"] for r in got) - 10 * n) < 1e-6


def test_exact_dedup_edges(docs, none):
    got = rows(exact_dedup.annotate(docs))
    assert len(got) == len(ROWS)
    alpha = [r for r in got if r["doc_id"] in (1, 2) or (r["doc_id"] is None and r["group_size"] == 4)]
    assert {(r["keep_id"], r["group_size"], r["kept"]) for r in alpha} == {(2, 4, False), (2, 4, True)}
    blank = [r for r in got if r["keep_id"] == 4]
    assert len(blank) == 3 and sum(r["kept"] for r in blank) == 1  # null and empty are equal, white space is not
    one = exact_dedup.deduplicate(docs)
    assert one.columns == docs.columns
    assert Counter(r["doc_id"] for r in rows(one)) == Counter([2, 4, 5, 6, 8, 9, 9])
    assert rows(exact_dedup.annotate(none)) == [] and exact_dedup.deduplicate(none).count() == 0


def test_exact_dedup_filter_passes_most_unique_rows(spark):
    keys = spark.range(50_000).select(F.xxhash64("id").alias("h"))
    words = exact_dedup._filter_words(50_000)
    twice = keys.union(keys.limit(100))
    flagged = exact_dedup.flag_repeated(twice, exact_dedup.repeated_filter(twice, words), words)
    n = flagged.where("maybe").count()
    assert 200 <= n < 4000
    copies = flagged.join(keys.limit(100), "h", "left_semi")
    assert copies.where("not maybe").count() == 0


def test_exact_dedup_by_slices_of_the_filter(spark, monkeypatch):
    n = 40_000
    text = F.when(F.col("id") % 3 == 0, F.lit(None)).when(F.col("id") % 7 == 0, F.concat(F.lit("Copy "), F.col("id") % 500)).otherwise(F.concat(F.lit("Text "), "id"))
    docs = spark.range(n).select(F.col("id").alias("doc_id"), text.alias("text"))
    plain = sorted(rows(exact_dedup.annotate(docs)), key=lambda r: r["doc_id"])
    monkeypatch.setattr(exact_dedup, "SLICE", 6)  # the filter takes four slices
    assert -(-exact_dedup._filter_words(n) * 64 // (exact_dedup.BITMAP * exact_dedup.SLICE)) > 2
    got = exact_dedup.annotate(docs)
    assert sorted(rows(got), key=lambda r: r["doc_id"]) == plain
    groups = {}
    for r in docs.collect():
        groups.setdefault((r["text"] or "").lower(), []).append(r["doc_id"])
    want = {i: (max(g), len(g)) for g in groups.values() for i in g}
    assert {r["doc_id"]: (r["keep_id"], r["group_size"]) for r in plain} == want
    one = exact_dedup.deduplicate(docs)
    assert one.columns == docs.columns and sorted(r["doc_id"] for r in rows(one)) == sorted(max(g) for g in groups.values())


def test_exact_dedup_rows_that_are_alone_pass_no_exchange(spark, docs):
    keys = docs.select("doc_id", "text", exact_dedup.probe_key(F.col("text")).alias("h")).repartition(3)
    words = exact_dedup._filter_words(keys.count())
    held = spark.createDataFrame([tuple(r) for r in exact_dedup.repeated_filter(keys, words).collect()], "bitmap long, bits binary")
    alone = exact_dedup.flag_repeated(docs.select("text", exact_dedup.probe_key(F.col("text")).alias("h")), held, words).where("not maybe")
    plan = alone._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan


def test_exact_dedup_keeps_one_of_equal_ids_by_text(spark):
    docs = spark.createDataFrame([(1, "ALPHA", "x"), (1, "alpha", "x"), (1, "Alpha", "x")], "doc_id long, text string, lang string")
    for _ in range(3):
        assert [tuple(r) for r in exact_dedup.deduplicate(docs.repartition(3)).collect()] == [(1, "alpha", "x")]


def test_bpe_edges(docs, none):
    import public_tokenizers as P

    path = P.path("byte_bpe_50k.tiktoken")
    got = bpe.decode(bpe.encode(docs, path, P.PATTERN, carry=["source"]), path).collect()
    assert len(got) == len(ROWS)
    assert Counter(bytes(r["decoded"]).decode() for r in got) == Counter(r[1] or "" for r in ROWS)
    assert rows(bpe.encode(none, path, P.PATTERN)) == []


def test_bpe_long_runs_equal_the_library():
    import public_tokenizers as P

    codec = bpe.Codec(bpe.read_ranks(P.path("byte_bpe_50k.tiktoken")), P.PATTERN)
    rng = random.Random(1)
    texts = ["a" * 20_000 + " x", " \n\t" * 9000 + "y", "9" * 30_000, "!?" * 9000, "é" * 12_000 + " 's"]
    texts += ["".join(rng.choice("ab cdé1'\n ") for _ in range(150_000))]
    for text in texts:
        assert codec.encode(text) == codec.encoding.encode_ordinary(text)
        assert codec.decode(codec.encode(text)).decode() == text


def test_language_edges(docs, none):
    got = rows(language.predict(docs, language.fit(docs)))
    assert len(got) == len(ROWS) and all(0 <= r["score"] <= 1 for r in got)
    assert {r["lang_pred"] for r in got if r["doc_id"] in (3, 4, 5)} == {"und"}
    assert rows(language.predict(none, language.fit(none))) == []
    assert {r["lang_pred"] for r in rows(language.predict(docs, language.fit(none)))} == {"und"}


def test_lm_edges(docs, none):
    got = rows(ngram_lm.score(docs, ngram_lm.fit(docs)))
    assert len(got) == len(ROWS)
    assert {r["n_tokens"] for r in got if r["doc_id"] in (3, 4, 5)} == {1}
    assert all(r["score"] < 0 and r["base_score"] < 0 for r in got)
    assert rows(ngram_lm.score(none, ngram_lm.fit(none))) == []
    assert all(r["n_known"] == 0 for r in rows(ngram_lm.score(docs, ngram_lm.fit(none))))


def test_log_frequency_filter():
    """Counts read back are never below their level and rarely above it."""
    rng = np.random.default_rng(6)
    keys = rng.integers(0, 2**64, 20_000, dtype=np.uint64)
    level = ngram_lm.level_of(rng.geometric(0.3, len(keys)), 2.0)
    parts, bits = 4, 64 * (int(level.sum()) * 8 // 4 // 64)
    part = (keys >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)
    made = ngram_lm.Filter([ngram_lm.segment(keys[part == s], level[part == s], bits, 5) for s in range(parts)], bits, 5)
    got = made.levels(keys)
    assert (got >= level).all() and (got > level).mean() < 0.06
    assert (made.levels(rng.integers(0, 2**64, 20_000, dtype=np.uint64)) > 0).mean() < 0.06
    assert ngram_lm.count_of(np.array([0, 1, 2, 3]), 2.0).tolist() == [0.0, 1.0, 6**0.5, 28**0.5]


def test_log_frequency_filter_grows(spark, docs):
    """A filter above the broadcast bound gives the scores that a broadcast one gives."""
    rng = random.Random(8)
    many = spark.createDataFrame([(k, " ".join(f"w{int(rng.paretovariate(0.7)) % 3000}" for _ in range(rng.randint(0, 80)))) for k in range(400)], "doc_id long, text string").repartition(5)
    for table in (docs, many):
        small = ngram_lm.Params(max_bytes=256)
        want = sorted(map(str, rows(ngram_lm.score(table, ngram_lm.fit(table)))))
        assert sorted(map(str, rows(ngram_lm.score(table, ngram_lm.fit(table, small))))) == want
    assert rows(ngram_lm.score(docs.limit(0), ngram_lm.fit(many, small))) == []


def test_pairs_learned_once_count(spark):
    """A text holding a pair that was learned once scores above one whose pair was never learned."""
    texts = [(0, "alpha beta"), (1, "gamma delta"), *((k, "filler words") for k in (3, 4, 5, 6))]
    model = ngram_lm.fit(spark.createDataFrame(texts, "doc_id long, text string"), ngram_lm.Params(held_mod=10**12))
    asked = spark.createDataFrame([(1, "alpha beta"), (2, "alpha delta")], "doc_id long, text string")
    score = {r["doc_id"]: r["score"] for r in rows(ngram_lm.score(asked, model))}
    assert score[1] > score[2] + 0.3


def test_first_words_of_texts_count(spark):
    """The pair of a text's begin and its first word counts among the learned texts."""
    docs = spark.createDataFrame([(k, "alpha" if k < 32 else "beta alpha") for k in range(64)], "doc_id long, text string").coalesce(1)
    p = ngram_lm.Params(held_mod=10**12)
    score = {r["doc_id"]: r["score"] for r in rows(ngram_lm.score(docs, ngram_lm.fit(docs, p)))}
    # 160 tokens, 3 distinct: alpha 64, end 64, beta 32; half of the texts begin with alpha.
    alpha = math.log10(0.3 * 32 / 64 + 0.7 * 65 / 164) + math.log10(0.3 + 0.7 * 65 / 164)
    assert abs(score[0] - alpha) < 0.15


def test_licence_texts_and_wrapped_lines(spark):
    """The standard grant and texts are found whole, and by their usual first lines in a longer text."""
    grant = licenses._MIT[0]
    wrapped = "Permission is hereby granted, free of charge, to any person obtaining a copy\nof this software and associated documentation files (the \"Software\"), to deal\nin the Software without restriction"
    bsd = "Redistribution and use in source and binary forms, with or without\nmodification, are permitted provided that the following conditions\nare met:"
    texts = [grant, "MIT License\n\nCopyright (c) 2020 A B\n\n" + "\n\n".join(licenses._MIT), "other words here\n" * 40 + wrapped, "other words here\n" * 40 + bsd, "The MIT License (MIT)", "a permission to copy is granted"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {(r["doc_id"], r["line"]): r["license"] for r in rows(licenses.scan(docs))}
    assert got[0, 1] == got[1, 0] == got[2, 41] == got[2, 42] == got[4, 1] == "MIT"
    assert got[3, 41] == got[3, 42] == "BSD-3-Clause"
    assert not any(i == 5 for i, _ in got)


def test_rows_without_id_are_spread(spark):
    """Rows without an id go to buckets by text, those with one to their own bucket."""
    table = spark.createDataFrame([(None, f"text {k}") for k in range(200)] + [(k, "x") for k in range(50)], "doc_id long, text string")
    bucket = fingerprint._buckets(table.where("doc_id is not null"), 32)
    got = table.select("doc_id", fingerprint._home(bucket, 32).alias("home"), bucket.alias("bucket")).collect()
    assert len({r["home"] for r in got if r["doc_id"] is None}) > 20
    assert all(r["home"] == r["bucket"] for r in got if r["doc_id"] is not None)


def test_pii_more_formats():
    names = pii.Pseudonyms(b"k")
    text = "call (555) 123-4567, 555-123-4567 or +1 555 123-4567; London +44 20 7946 0958, Lisbon +351 912 345 678. Born March 14, 2015 or 14 March 2015. No: 123-456-7890-1234, 5551234567"
    new, spans = names.apply(text)
    assert Counter(k for k, _, _ in spans) == {"phone": 5, "date": 2}
    assert names.apply(new, back=True)[0] == text
    assert not any(x in new for x in ("123-4567", "7946", "912 345", "March 14, 2015")) and "+44 " in new and "+351 " in new
    phones = [pii._digits(new[a:b])[-10:] for k, a, b in names.apply(new)[1] if k == "phone"]
    assert phones[0] == phones[1] == phones[2]


def test_pii_formats():
    names = pii.Pseudonyms(b"k")
    text = "card 4111 1111 1111 1111 or 4111111111111111, bad 4111111111111112; +1 (415) 555-2671; 10.0.0.255 not 10.0.0.256; 078-05-1120; 2021-02-28, 28.02.2021, 02/28/2021, 28 February 2021, no 2021-02-30; DE89 3704 0044 0532 0130 00"
    new, spans = names.apply(text)
    assert Counter(k for k, _, _ in spans) == {"card": 2, "phone": 1, "ipv4": 1, "ssn": 1, "date": 4, "iban": 1}
    assert names.apply(new, back=True)[0] == text and new != text
    again = names.apply(new)[1]
    assert Counter(k for k, _, _ in again) == Counter(k for k, _, _ in spans)  # still valid in every format
    cards = [new[a:b] for k, a, b in again if k == "card"]
    assert cards[0].replace(" ", "") == cards[1]
    days = {x for k, a, b in again if k == "date" for x in [pii._day(*_parse(new[a:b]))]}
    assert len(days) == 1
    assert "4111111111111112" in new and "10.0.0.256" in new and "2021-02-30" in new


def _parse(text):
    import re

    if m := re.fullmatch(r"(\d{4})-(\d\d)-(\d\d)", text):
        return int(m[1]), int(m[2]), int(m[3])
    if m := re.fullmatch(r"(\d\d)\.(\d\d)\.(\d{4})", text):
        return int(m[3]), int(m[2]), int(m[1])
    if m := re.fullmatch(r"(\d\d)/(\d\d)/(\d{4})", text):
        a, b = int(m[1]), int(m[2])
        return (int(m[3]), a, b) if a <= 12 else (int(m[3]), b, a)
    d, m, y = text.split()
    return int(y), pii.MONTHS.index(m) + 1, int(d)


def test_feistel_permutes():
    f = pii.Feistel(b"key")
    for size in (1, 2, 10, 97, 1000):
        assert sorted(f.permute(k, size, "t") for k in range(size)) == list(range(size))
    big = 10**15
    assert all(f.invert(f.permute(k, big, "t"), big, "t") == k for k in (0, 1, 12345, big - 1))
    assert date.fromordinal(1)


def test_pii_edges(docs, none):
    got = rows(pii.pseudonymise(docs, b"k"))
    assert Counter(r["text"] for r in got) == Counter(r[1] for r in ROWS)
    assert rows(pii.pseudonymise(none, b"k")) == []


def test_words_match_bytes_split():
    import pyarrow as pa

    rng = random.Random(9)
    texts = ["", " ", "a", "A b\x0bc\x1cd\x85e", None, "é ü x", *("".join(rng.choice("ab \n\té") for _ in range(50)) for _ in range(50))]
    buf, off = arrays.text_buffer(pa.array(texts))
    h, woff = arrays.words(buf, off)
    seen = {}
    for k, t in enumerate(texts):
        w = (t or "").encode().lower().split()
        assert woff[k + 1] - woff[k] == len(w)
        for word, x in zip(w, h[woff[k] : woff[k + 1]].tolist(), strict=True):
            assert seen.setdefault(word, x) == x
    assert len(set(seen.values())) == len(seen)


def test_license_anchors_lose_no_match():
    """Every passage that reaches the threshold holds an anchor, however its words are cut or changed."""
    rng = random.Random(8)
    sets = [licenses._template_bigrams(t) for _, t in licenses.TEMPLATES]
    needed = licenses.anchors(sets, licenses.THRESHOLD)
    reached = 0
    for _ in range(4000):
        _, text = rng.choice(licenses.TEMPLATES)
        w = "".join(c if c.isalnum() else " " for c in text.lower()).split()
        for _ in range(rng.randint(0, 5)):
            k = rng.randrange(len(w))
            w[k : k + 1] = rng.choice([[], ["zz"], [w[k], "zz"], []])
            w = w or ["zz"]
        grams = {f"{a} {b}" for a, b in zip(w, w[1:], strict=False)}
        if grams and max(2 * len(grams & set(s)) / (len(grams) + len(s)) for s in sets) >= licenses.THRESHOLD:
            reached += 1
            assert any(a in " ".join(w) for a in needed)
    assert reached > 500

"""Conversation repair, line de-duplication and whitening: brute force and edge cases."""

import hashlib
import re
import zlib
from collections import defaultdict

import numpy as np
import pyarrow.parquet as pq
import pytest

from stockyard.llm import conversations, line_dedup, queries, whitening

SF = "/root/testdata/sf0.01"
WHITE = " \t\n\x0b\x0c\r"
SHAPE = re.compile(r"(s?(ua)+)?")


def damage(told):
    out = defaultdict(list)
    for conv, turn, role, text in told:
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        out[conv] += [(turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    return {c: sorted(r, key=lambda x: (x[0] is not None, x[0] or 0, x[1], x[2])) for c, r in out.items()}


def brute(rows):
    """The whole table of cheapest (cost, audit) pairs, forwards, by rows read and roles made so far."""
    seen, faults = set(), []
    for _, role, text in rows:
        body = text.rstrip(WHITE)
        faults.append("blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else "")
        seen.add((role, text))
    counts = {f: faults.count(f) for f in ("blank", "duplicate", "truncated")}
    initials = [r[1][:1] for r in rows]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
    turns = [r[0] for r in rows if r[0] is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0

    def begins(shape):  # could it go on to the pattern?
        return SHAPE.fullmatch(shape) or SHAPE.fullmatch(shape + "ua") or SHAPE.fullmatch(shape + "a")

    def reduce(shape):  # shapes that go on alike
        return shape if len(shape) < 5 else reduce(shape[:-4] + shape[-2:])

    table = {"": (0, "", ())}

    def put(into, shape, entry):
        key = reduce(shape)
        if begins(shape) and (key not in into or entry[:2] < into[key][:2]):
            into[key] = entry
            return True

    def inserted(table):
        changed = True
        while changed:
            changed = False
            for shape, (cost, audit, turns) in list(table.items()):
                for role in ("user", "assistant"):
                    changed |= bool(put(table, shape + role[0], (cost + 5, audit + "I", (*turns, (role, "")))))
        return table

    for (_, role, text), fault in zip(rows, faults):
        table, after = inserted(table), {}
        for shape, (cost, audit, turns) in table.items():
            put(after, shape, (cost + 2, audit + "D", turns))
            if fault in ("", "truncated"):
                stub = 5 if fault else 0
                put(after, shape + (role[:1] or "-"), (cost + stub, audit + "K", (*turns, (role, text))))
                for new in ("user", "assistant"):
                    put(after, shape + new[0], (cost + 1 + stub, audit + "R", (*turns, (new, text))))
        table = after
    table = inserted(table)
    cost, audit, turns = min(v for k, v in table.items() if SHAPE.fullmatch(k))
    sha = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in turns).encode()).hexdigest()
    return (gaps, counts["blank"], counts["duplicate"], counts["truncated"], illegal, cost, audit, sha), turns


NOTHING = (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())


def compare(told, df):
    made = damage(told)
    want = {conv: brute(made[conv])[0] if conv in made else NOTHING for conv, *_ in told}
    got = [tuple(r) for r in df.select("conv_id", *conversations._FIELDS).collect()]
    assert len(got) == len(want) and {r[0]: r[1:] for r in got} == want


def test_op11_against_brute_force(spark):
    told = [tuple(r.values()) for r in pq.read_table(f"{SF}/conversations.parquet").select(["conv_id", "turn", "role", "text"]).to_pylist()]
    compare(told, queries.queries()["op11_conversation_repair"](spark, SF))


SCHEMA = "conv_id long, turn long, role string, text string, n int, tag string, code string, codes string"


def told_frame(spark, told):
    return spark.createDataFrame([(*r, 1, "x", "y", "z") for r in told], SCHEMA).repartition(3)


def test_conversation_edges(spark, monkeypatch):
    """Nulls everywhere, ties, repeated rows, odd roles, a long conversation of many blocks, random ones."""
    rng = np.random.default_rng(5)
    roles = ["user", "assistant", "system", "tool", "User", "", None, "unknown"]
    texts = ["Yes.", "No!", "cut off", "", " \t", None, "Why?  ", "é.", "Yes."]
    told = [(None, None, None, None), (None, 3, "user", "a."), (None, 3, "user", "a."), (1, None, "user", "b."), (1, None, "user", "b.")]
    told += [(1, 9, "assistant", "c."), (1, 9, "user", "c."), (2, 0, "system", "only"), (3, 5, "\U0001f600", "x" * 200_000)]
    for conv in range(10, 60):
        for turn in range(int(rng.integers(1, 9))):
            told.append((conv, turn if rng.random() > 0.1 else None, roles[rng.integers(len(roles))], texts[rng.integers(len(texts))] if rng.random() < 0.5 else f"t{turn}."))
    for turn in range(700):  # eleven blocks and more
        told.append((99, turn, roles[rng.integers(3)], f"text {rng.integers(500)}{rng.choice(['.', ''])}"))
    df = told_frame(spark, told)
    compare(told, conversations.audit(df, conversations.damaged(df)))
    made = damage(told)
    stands = defaultdict(list)
    for r in conversations.repair(conversations.damaged(df)).orderBy("conv_id", "place").collect():
        assert r["place"] == len(stands[r["conv_id"]])
        stands[r["conv_id"]].append((r["role"], r["text"]))
    assert {c: tuple(t) for c, t in stands.items()} == {c: brute(r)[1] for c, r in made.items() if brute(r)[1]}
    none = told_frame(spark, told).where("false")
    assert conversations.audit(none, conversations.damaged(none)).collect() == []


def test_checkpoints_hold_a_square_root(spark):
    told = [(7, t, ("user", "assistant")[t % 2], f"turn {t}.") for t in range(3000)]
    df = told_frame(spark, told).selectExpr("conv_id", "turn", "role", "text", "1L AS copies")
    lines = conversations._streams(df)
    blocks = [len(r["codes"]) for r in lines.where("kind = 0").collect()]
    assert sum(blocks) == 3000 and max(blocks) <= 64 and len(blocks) <= 64 + 8


CLASH = "h g t u pos last gone doc n_docs batch _row _doc n_lines line"
DOCS = "doc_id long, text string, " + ", ".join(f"`{c}` string" for c in CLASH.split())
LINE = "the same forty characters or more stand in this line"


def brute_lines(rows, least=5):
    keys = defaultdict(set)
    for doc, text in rows:
        for line in (text or "").split("\n"):
            key = line.strip(WHITE).translate({c: c + 32 for c in range(65, 91)})
            if len(key) >= 40:
                keys[key].add(doc)
    out = []
    for doc, text in rows:
        lines, kept = (text or "").split("\n"), []
        for line in lines:
            held = keys.get(line.strip(WHITE).translate({c: c + 32 for c in range(65, 91)}), set())
            if len(held) < least or doc == max((d for d in held if d is not None), default=None):
                kept.append(line)
        out.append((doc, "\n".join(kept), len(lines), len(lines) - len(kept)))
    return sorted(out, key=repr)


def test_line_edges(spark):
    rows = [(k, f"head {k}\n {LINE.upper()}\t\nmid\n{LINE}\n") for k in range(1, 9)]
    rows += [(3, LINE), (3, LINE), (None, LINE), (None, f"x\n{LINE}"), (20, None), (21, ""), (None, None), (22, "\n".join([LINE + " four"] * 4))]
    rows += [(k, LINE + " four") for k in (30, 31, 32)] + [(k, "É" * 40 + "\n" + "É" * 39) for k in range(40, 46)]
    rows += [(50, "\n".join(f"{LINE} {k % 900}" for k in range(20_000)))] + [(k, "\n".join(f"{LINE} {j}" for j in range(900))) for k in range(51, 55)]
    df = spark.createDataFrame([(*r, *["x"] * len(CLASH.split())) for r in rows], DOCS).repartition(4)
    for params in (line_dedup.Params(), line_dedup.Params(batches=1)):
        got = line_dedup.deduplicate(df, params)
        assert [c for c in got.columns if c not in ("n_lines", "n_dropped")] == [c for c in df.columns if c != "n_lines"]
        found = [(r["doc_id"], r["text"] or "", r["n_lines"], r["n_dropped"]) for r in got.collect()]
        assert sorted(found, key=repr) == brute_lines(rows)
    assert line_dedup.deduplicate(df.where("false")).collect() == []


def test_line_runs_are_levelled_and_order_free(spark):
    rng = np.random.default_rng(3)
    rows = [(int(k), int(k) + 1, int(d)) for d in range(400) for k in rng.zipf(1.5, 6) % 60]
    lines = spark.createDataFrame(rows, "h long, g long, doc long")
    want = defaultdict(set)
    for h, _, doc in rows:
        want[h].add(doc)
    want = {h: max(d) for h, d in want.items() if len(d) >= 5}
    for order in (range(9, -1, -1), (3, 7, 0, 9, 1, 8, 2, 5, 4, 6)):
        runs = line_dedup.LineRuns(spark, min_docs=5, fanout=3)
        sizes = []
        for k in order:
            runs.add(lines.where(f"doc div 40 = {k}"))
            assert all(len(level) < 3 for level in runs.levels)
            sizes.append(runs.runs()[-1].files.count())
        assert len(runs.levels) == 3
        assert {r["h"]: r["last"] for r in runs.frequent().collect()} == want
    for run in runs.runs():  # sorted by hash inside each bucket, every key once
        assert run.files.count() == run.files.select("h", "g").distinct().count()


def test_descending_batches_add_only_unsettled_keys(spark):
    lines = spark.createDataFrame([(1, 1, d) for d in range(100)] + [(2 + d, 0, d) for d in range(100)], "h long, g long, doc long")
    runs = line_dedup.LineRuns(spark, min_docs=5, fanout=100)
    for k in (3, 2, 1, 0):
        runs.add(lines.where(f"doc div 25 = {k}"))
    assert [run.files.where("h = 1").count() for run in runs.runs()] == [1, 0, 0, 0]


def vectors(sf):
    t = pq.read_table(f"{sf}/embeddings.parquet")
    return t["vec_id"].to_pylist(), [np.array(v, np.float32).astype(float) for v in t["embedding"].to_pylist()]


def check_whitening(rows, ids, x, components=4):
    """Against the covariance formed and solved whole."""
    once = np.unique(np.array(x), axis=0)
    n, sums = len(once), [sum(int(v) for v in c) for c in once.T]
    away = once - np.array(sums) / n
    values, basis = np.linalg.eigh(away.T @ away / n)
    values, basis = values[::-1], basis[:, ::-1]
    trace = values.sum()
    by_id = defaultdict(list)
    for r in rows:
        by_id[r["vec_id"], r["component"]].append(r)
    assert sum(len(v) for v in by_id.values()) == len(ids) * components
    signs = {}
    for i, vec in zip(ids, x):
        deviation = sum((n * int(v) - s) ** 2 for v, s in zip(vec, sums))
        for k in range(components):
            r = by_id[i, k + 1][0]
            want = float((vec - np.array(sums) / n) @ basis[:, k]) / np.sqrt(values[k])
            if abs(want) > 1e-6:
                signs.setdefault(k, np.sign(want) * np.sign(r["whitened"]))
            assert abs(signs.get(k, 1) * r["whitened"] - want) < 1e-9
            assert r["n"] == n and r["deviation"] == deviation
            assert abs(r["explained"] - values[k] / trace) < 1e-12 and r["identity_error"] < 1e-9


def test_op13_against_the_formed_covariance(spark):
    ids, vecs = vectors(SF)
    rows = queries.queries()["op13_whitening"](spark, SF).collect()
    check_whitening(rows, ids, [np.floor(256 * v) + 0 for v in vecs])


VECS = "vec_id long, embedding array<float>, x string, component int, n string"


def test_whitening_edges(spark):
    rng = np.random.default_rng(1)
    good = [(k, [float(v) for v in rng.normal(0, 1 + np.arange(6), 6).astype(np.float32)]) for k in range(60)]
    good += [(100, good[0][1]), (100, good[0][1]), (None, good[1][1]), (101, [-0.0] * 6)]
    bad = [(200, None), (201, [1.0, None, 1.0, 1.0, 1.0, 1.0]), (202, [float("nan")] * 6), (203, [float("inf")] + [0.0] * 5), (204, [1.0, float("-inf")])]
    short = [(300, [1.0, 2.0]), (301, [])]
    frame = lambda r: spark.createDataFrame([(*v, "x", 1, "n") for v in r], VECS).repartition(3)
    x = [np.floor(256 * np.array(v + [0.0] * (6 - len(v)))) + 0 for _, v in good + short]
    check_whitening(whitening.whiten(frame(good + bad + short)).collect(), [i for i, _ in good + short], x)
    two = [(k, v[:2]) for k, v in good]
    check_whitening(whitening.whiten(frame(two)).collect(), [i for i, _ in two], [np.floor(256 * np.array(v)) + 0 for _, v in two], 2)
    for none in ([], bad, [(1, []), (2, [])], [(1, [1.0, 2.0])] * 3):
        assert whitening.whiten(frame(none)).collect() == []
    huge = whitening.whiten(frame([(1, [1e30, 0.0]), (2, [0.0, 1.0])])).collect()
    assert {r["deviation"] for r in huge} == {None} and len(huge) == 2


def test_equal_eigenvalues_and_locking():
    for values in ([5.0, 5, 5, 5, 5, 1, 0, 0], [9.0, 1, 1, 1, 1, 1, 1, 1], [1e-9, 1e-9, 0, 0, 0, 0, 0, 0], [0.0] * 8, list(range(40, 0, -1))):
        d = len(values)
        q, _ = np.linalg.qr(np.random.default_rng(d).standard_normal((d, d)))
        a = (q * values) @ q.T
        got, vecs = whitening.jacobi_davidson(lambda v, a=a: a @ v, d, whitening.Params())
        assert np.allclose(got, values[:4], rtol=0, atol=1e-12 * max(values))
        assert np.abs(vecs.T @ vecs - np.eye(4)).max() < 1e-13
        assert np.linalg.norm(a @ vecs - vecs * got) <= 1e-12 * max(values)


def test_minres_solves_indefinite_systems():
    rng = np.random.default_rng(0)
    a = rng.standard_normal((12, 12))
    a = a + a.T
    b = rng.standard_normal((12, 3))
    shifts = np.array([0.0, 1.5, -2.0])
    t = whitening.minres(lambda v: a @ v - v * shifts, b, 40)
    assert np.abs(a @ t - t * shifts - b).max() < 1e-8
    assert pytest.approx(0) == np.abs(whitening.minres(lambda v: a @ v, np.zeros((12, 2)), 5)).max()

"""Conversation structure repair by square-root checkpointed dynamic programming.

The cheapest edits that give a conversation the roles ``(s?(ua)+)?`` (initials of system, user,
assistant) come from a backward recursion over its rows: the cost to go from each of four states.
Only the cost vectors at checkpoints are stored, one for every block of about the square root of the
longest conversation's rows.  Blocks are compared in parallel, each as a min-plus matrix from the costs
behind it to the costs before it; the matrices of a conversation are chained from its end and leave a
vector at every checkpoint.  The forward walk streams the rows in order, recomputes the vectors of one
block at a time from its checkpoint, and takes among the tight edits the ASCII-least.

A conversation's rows are sorted over many tasks and its blocks are solved apart; only the walk, whose
SHA-256 has to read the repaired turns one after the other, passes a conversation through one task, as
a stream that holds one block's states and costs at a time.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from math import isqrt

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .store import materialise, partitions

WHITE = " \t\n\x0b\x0c\r"
STOPS = ".!?"
#: Costs of the edits; a truncated row that stays costs STUB more.
REROLE, DELETE, INSERT, STUB = 1, 2, 5, 5
LEAST_BLOCK = 64
_FAR = 1 << 60

# States of the role pattern: nothing yet, after the system turn, after a user turn, after an assistant turn.
START, SYSTEM, USER, ASSISTANT = range(4)
_NEXT = (USER, USER, ASSISTANT, USER)  # by the state: the turn that inserting or changing a role gives
_ROLE = {USER: "user", ASSISTANT: "assistant"}
# By the initial's class (s, u, a, other) and the state: the state after keeping the row.
_KEEP = ((SYSTEM, None, None, None), (USER, USER, None, USER), (None, None, ASSISTANT, None), (None,) * 4)
# Codes of a row: two that must go, else 2 * class + truncated + FIRST_CODE.
BLANK, DUPLICATE, FIRST_CODE = 0, 1, 2


def damaged(told: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, copies) of the rows after damage by crc32(``conv_id:turn``) % 20.

    0 drops the row, 1 empties its text, 2 removes its ``[.!?]``, 3 repeats it beside itself, 4 sets its role
    to user.  In the key, the role and the text a null counts as one space."""
    space = F.lit(" ")
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"), F.coalesce(F.col("turn").cast("string"), space))
    kind = F.crc32(key) % 20
    role, text = F.coalesce("role", space), F.coalesce("text", space)
    return told.where(kind != 0).select(
        "conv_id",
        "turn",
        F.when(kind == 4, F.lit("user")).otherwise(role).alias("role"),
        F.when(kind == 1, F.lit("")).when(kind == 2, F.translate(text, STOPS, "")).otherwise(text).alias("text"),
        F.when(kind == 3, F.lit(2)).otherwise(F.lit(1)).cast("long").alias("copies"),
    )


def _own_code() -> Column:
    """The code of a row that is no duplicate."""
    body = F.rtrim("text", F.lit(WHITE))
    initial = F.substring("role", 1, 1)
    kind = F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(3)
    truncated = (~F.right(body, F.lit(1)).isin(list(STOPS))).cast("int")
    return F.when(body == "", F.lit(BLANK)).otherwise(kind * 2 + truncated + FIRST_CODE)


def runs_of(rows: DataFrame) -> DataFrame:
    """(conv_id, turn, role, h, text, n, own): equal rows of a turn once, with their count and own fault code.

    Groups of equal rows meet only as partial aggregates."""
    digest = F.sha2(F.col("text").cast("binary"), 256)
    runs = rows.withColumn("h", digest).groupBy("conv_id", "turn", "role", "h").agg(
        F.max("text").alias("text"), F.sum("copies").alias("n")
    )
    return materialise(runs.withColumn("own", _own_code()), "turns")


def coded(ordered: DataFrame) -> DataFrame:
    """(conv_id, tag, n, code) of tagged runs: which of them are duplicates.

    The first row with its role and text in the conversation is the one of the least turn (nulls first);
    all others are duplicates.  Texts stay where they are: only their digests are compared."""
    runs = ordered.select("conv_id", "turn", "role", "h", "tag", "n", "own")
    none = F.max(F.col("turn").isNull())
    least = runs.groupBy("conv_id", "role", "h").agg(F.min("turn").alias("least"), none.alias("none"))
    least = least.select(
        F.col("conv_id").alias("_c"), F.col("role").alias("_r"), F.col("h").alias("_h"), F.when(~F.col("none"), F.col("least")).alias("_t")
    )
    # One row on each side for a key: no key is hot here.
    same = F.col("conv_id").eqNullSafe(F.col("_c")) & F.col("turn").eqNullSafe(F.col("_t"))
    same = same & (F.col("role") == F.col("_r")) & (F.col("h") == F.col("_h"))
    duplicate = (F.col("own") != BLANK) & F.col("_h").isNull()
    marked = runs.join(least, same, "left")
    return marked.select("conv_id", "tag", "n", F.when(duplicate, F.lit(DUPLICATE)).otherwise(F.col("own")).alias("code"))


def _step(cost: list[int], code: int, n: int) -> list[int]:
    """Costs to go before a run of ``n`` equal rows, from those behind it."""
    if code < FIRST_CODE:
        return [min(c + DELETE * n, _FAR) for c in cost]
    cost = [min(c + DELETE * (n - 1), _FAR) for c in cost]
    kind, stub = divmod(code - FIRST_CODE, 2)
    keeps, stub = _KEEP[kind], STUB * stub
    out = []
    for q in range(4):
        best = min(DELETE + cost[q], REROLE + stub + cost[_NEXT[q]])
        if keeps[q] is not None:
            best = min(best, stub + cost[keeps[q]])
        out.append(best)
    return _with_inserts(out)


def _with_inserts(cost: list[int]) -> list[int]:
    once = [min(c, INSERT + cost[_NEXT[q]]) for q, c in enumerate(cost)]
    return [min(c, INSERT + once[_NEXT[q]], _FAR) for q, c in enumerate(once)]


#: Costs to go behind the last row: nothing where the pattern is complete.
END = _with_inserts([0, _FAR, _FAR, 0])


def _matrices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The min-plus matrix of each block, by rows of the state before it."""
    for batch in batches:
        out = []
        for codes in batch.column("codes").to_pylist():
            columns = []
            for p in range(4):
                cost = [0 if q == p else _FAR for q in range(4)]
                for row in reversed(codes):
                    cost = _step(cost, row["code"], row["n"])
                columns.append(cost)
            out.append([columns[p][q] for q in range(4) for p in range(4)])
        yield pa.RecordBatch.from_arrays([batch.column("conv_id"), batch.column("tag"), pa.array(out, pa.list_(pa.int64()))], names=["conv_id", "tag", "matrix"])


def _chained(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The cost vector behind each block, from the matrices of the blocks after it."""
    for batch in batches:
        at, tags, vectors = [], [], []
        for k, blocks in enumerate(batch.column("blocks").to_pylist()):
            cost = END
            for block in reversed(blocks):
                at.append(k)
                tags.append(block["tag"])
                vectors.append(cost)
                m = block["matrix"]
                cost = [min(min(m[4 * q + p] + cost[p] for p in range(4)), _FAR) for q in range(4)]
        yield pa.RecordBatch.from_arrays(
            [batch.column("conv_id").take(pa.array(at, pa.int64())), pa.array(tags, pa.int64()), pa.array(vectors, pa.list_(pa.int64()))],
            names=["conv_id", "tag", "cost"],
        )


def checkpoints(codes: DataFrame, block: int) -> DataFrame:
    """(conv_id, tag, codes, cost): the blocks of ``coded`` rows with the cost vector behind each.

    A block is at most ``block`` rows (a power of two) of one conversation that lie in one task; tag is
    that of its first row."""
    bits = block.bit_length() - 1
    kind = dict(codes.dtypes)["conv_id"]
    row = F.struct("tag", "code", "n")
    blocks = codes.groupBy("conv_id", F.shiftright("tag", bits).alias("block")).agg(
        F.min("tag").alias("tag"), F.sort_array(F.collect_list(row)).alias("codes")
    )
    blocks = materialise(blocks.select("conv_id", "tag", F.transform("codes", lambda r: F.struct(r.code.alias("code"), r.n.alias("n"))).alias("codes")), "blocks")
    matrices = blocks.mapInArrow(_matrices, f"conv_id {kind}, tag long, matrix array<long>")
    chains = matrices.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("tag", "matrix"))).alias("blocks"))
    costs = chains.mapInArrow(_chained, f"conv_id {kind}, tag long, cost array<long>")
    return blocks.join(costs.select(F.col("tag").alias("_tag"), "cost"), F.col("tag") == F.col("_tag")).drop("_tag")


class _Walk:
    """One conversation's forward walk: fed its checkpoints and rows in order."""

    def __init__(self):
        self.state, self.cost, self.turns = START, 0, 0
        self.counts = {"blank": 0, "duplicate": 0, "truncated": 0, "illegal": 0}
        self.last = self.low = self.high = None
        self.distinct, self.initial = 0, None
        self.audit: list[str] = []
        self.sha, self.queue = hashlib.sha256(), iter(())

    def block(self, codes: list[dict], cost: list[int]) -> None:
        """Recompute the block's vectors from the checkpoint behind it; walk its tight edits."""
        costs = [cost]
        for row in reversed(codes):
            costs.append(_step(costs[-1], row["code"], row["n"]))
        costs.reverse()
        edits = []
        for k, row in enumerate(codes):
            code, n = row["code"], row["n"]
            if code < FIRST_CODE:
                edits.append((code, n, "D" * n, ()))
                continue
            after = [c + DELETE * (n - 1) for c in costs[k + 1]]
            edits.append((code, n, *self._edit(code, costs[k], after, "D" * (n - 1))))
        self.queue = iter(edits)

    def _edit(self, code: int, before: list[int], after: list[int], more: str) -> tuple[str, tuple]:
        kind, stub = divmod(code - FIRST_CODE, 2)
        marks, turns, left = "", [], before[self.state]
        while True:
            q = self.state
            if left == DELETE + after[q]:
                return marks + "D" + more, tuple(turns)
            if left == INSERT + before[_NEXT[q]]:
                self.state, left = _NEXT[q], left - INSERT
                marks += "I"
                turns.append((_ROLE[self.state], False))
                continue
            kept = _KEEP[kind][q]
            if kept is not None and left == STUB * stub + after[kept]:
                self.state = kept
                return marks + "K" + more, (*turns, (None, True))
            self.state = _NEXT[q]
            return marks + "R" + more, (*turns, (_ROLE[self.state], True))

    def row(self, turn, role: str, text: str) -> Iterator[tuple[int, str, str]]:
        """Count the next run's faults; yield (place, role, text) of every turn that its edits leave."""
        code, n, marks, turns = next(self.queue)
        if turn is not None:
            if turn != self.last:
                self.distinct += 1
            self.low, self.high, self.last = turn if self.low is None else self.low, turn, turn
        if code == BLANK:
            self.counts["blank"] += n
        elif code == DUPLICATE:
            self.counts["duplicate"] += n
        else:
            self.counts["duplicate"] += n - 1
            self.counts["truncated"] += (code - FIRST_CODE) % 2
        initial = role[:1]
        if self.initial is not None:
            self.counts["illegal"] += self.initial + initial not in ("su", "ua", "au")
        self.counts["illegal"] += n - 1
        self.initial = initial
        self.cost += INSERT * marks.count("I") + DELETE * marks.count("D") + REROLE * marks.count("R")
        if "K" in marks or "R" in marks:
            self.cost += STUB * ((code - FIRST_CODE) % 2)
        self.audit.append(marks)
        for new, own in turns:
            yield self._stands(role if new is None else new, text if own else "")

    def _stands(self, role: str, text: str) -> tuple[int, str, str]:
        self.sha.update(f"{chr(10) if self.turns else ''}{role}:{text}".encode("utf-8", "surrogatepass"))
        self.turns += 1
        return self.turns - 1, role, text

    def close(self) -> Iterator[tuple[int, str, str]]:
        """The turns inserted behind the last row."""
        while self.state not in (START, ASSISTANT):
            self.state = _NEXT[self.state]
            self.cost += INSERT
            self.audit.append("I")
            yield self._stands(_ROLE[self.state], "")

    def summary(self) -> list:
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.distinct
        return [gaps, *self.counts.values(), self.cost, "".join(self.audit), self.sha.hexdigest()]


_SUMMARY = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
_FIELDS = [f.split()[0] for f in _SUMMARY.split(", ")]


def _events(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """(conv_id, walk, turns that stand, whether the conversation ends here), in order."""
    walk, current = None, None
    for batch in batches:
        for r in batch.to_pylist():
            if walk is None or r["conv_id"] != current:
                if walk is not None:
                    yield current, walk, walk.close(), True
                walk, current = _Walk(), r["conv_id"]
            if r["codes"] is not None:
                walk.block(r["codes"], r["cost"])
            else:
                yield current, walk, walk.row(r["turn"], r["role"], r["text"]), False
    if walk is not None:
        yield current, walk, walk.close(), True


def _streams(rows: DataFrame) -> DataFrame:
    """Rows and checkpoints of each conversation together in one task, in order."""
    runs = runs_of(rows)
    longest = runs.groupBy("conv_id").count().agg(F.max("count").alias("n")).first()["n"] or 1
    block = 1 << max(LEAST_BLOCK, isqrt(longest - 1) + 1).bit_length() - 1
    ordered = runs.repartitionByRange(partitions(runs), "conv_id", "turn", "role", "text")
    ordered = ordered.sortWithinPartitions("conv_id", "turn", "role", "text").withColumn("tag", F.monotonically_increasing_id())
    ordered = materialise(ordered, "ordered")
    marks = checkpoints(coded(ordered), block).withColumn("kind", F.lit(0))
    lines = ordered.select("conv_id", "tag", "turn", "role", "text", F.lit(1).alias("kind")).unionByName(marks, allowMissingColumns=True)
    return lines.repartition(partitions(lines), "conv_id").sortWithinPartitions("conv_id", "tag", "kind")


def repair(rows: DataFrame) -> DataFrame:
    """The repaired conversations: (conv_id, place, role, text), place from 0 within a conversation.

    ``rows`` holds conv_id, turn, role, text and copies, as ``damaged`` gives them; rules as in ``audit``."""
    streams = _streams(rows)
    kind = dict(streams.dtypes)["conv_id"]

    def turns(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list] = [[], [], [], []]
        size = 0
        for conv, _, stands, _ in _events(batches):
            for place, role, text in stands:
                for column, value in zip(held, (conv, place, role, text), strict=True):
                    column.append(value)
                size += len(text)
            if len(held[0]) >= 4096 or size >= 1 << 22:
                yield _batch(held, schema)
                held, size = [[], [], [], []], 0
        yield _batch(held, schema)

    schema = f"conv_id {kind}, place long, role string, text string"
    return streams.mapInArrow(turns, schema)


_ARROW = {"long": pa.int64(), "bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}


def _batch(columns: list[list], schema: str) -> pa.RecordBatch:
    fields = [f.split() for f in schema.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, _ARROW.get(kind)) for c, (_, kind) in zip(columns, fields, strict=True)], names=[n for n, _ in fields])


def audit(told: DataFrame, rows: DataFrame) -> DataFrame:
    """One row for each conv_id of ``told`` (null is one of them): faults, edits and digest of ``rows``.

    ``rows`` are taken by turn, nulls first; rows of one turn by role and text (code points), so that equal
    rows are adjacent.  A row's first fault counts: blank, duplicate (role and text seen earlier), truncated.
    gaps, blank, duplicate, truncated, illegal and cost are counts, audit the initials of the cheapest
    edits in order (K keep, R rerole, D delete, I insert), ASCII-least among ties, repaired_sha256 the digest of
    the repaired ``role:text`` joined by newlines.  A conversation without rows has zeros, an empty audit
    and the digest of nothing.  Equal rows are one run with a count until the audit names each.  Columns
    other than conv_id, turn, role and text are not read; an empty table gives no rows.
    """
    streams = _streams(rows)
    kind = dict(streams.dtypes)["conv_id"]
    schema = f"conv_id {kind}, {_SUMMARY}"

    def summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list] = [[] for _ in range(1 + len(_FIELDS))]
        for conv, walk, stands, ends in _events(batches):
            for _ in stands:
                pass
            if ends:
                for column, value in zip(held, [conv, *walk.summary()], strict=True):
                    column.append(value)
                if len(held[0]) >= 1024:
                    yield _batch(held, schema)
                    held = [[] for _ in held]
        yield _batch(held, schema)

    found = streams.mapInArrow(summaries, schema).withColumnRenamed("conv_id", "_conv")
    every = told.select("conv_id").distinct()
    joined = every.join(found, F.col("conv_id").eqNullSafe(F.col("_conv")), "left")
    empty = {"audit": F.lit(""), "repaired_sha256": F.lit(hashlib.sha256().hexdigest())}
    return joined.select("conv_id", *[F.coalesce(c, empty.get(c, F.lit(0).cast("long"))).alias(c) for c in _FIELDS])

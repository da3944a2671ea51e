"""Line de-duplication over levelled sorted runs of line hashes, in DataFrame operations only.

Documents come in batches of whole documents.  A batch's line keys are aggregated to (hash,
documents, largest id) and merge-anti-joined with the runs there are: a key that some run already
knows as frequent, in a document with a larger id, needs no further count.  What is left becomes a
new run of level 0: a table bucketed and sorted by hash, so that later merges do not shuffle it
again.  ``fanout`` runs of a level are compacted to one run of the next.  A key's count is the sum over
the runs that hold it, and its largest id the maximum, whatever the order of the batches.

A line's key is the line without white space (``\\x20\\x09-\\x0D``) at its ends and with A-Z
lower-cased; keys are compared by 128 bits of hash.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path
from .exact_dedup import normalised
from .store import col, materialise, partitions

WHITE = " \t\n\x0b\x0c\r"


@dataclass(frozen=True)
class Params:
    #: Shorter keys are never dropped (code points).
    min_chars: int = 40
    #: Documents that must hold a key before its lines are dropped.
    min_docs: int = 5
    #: Batches a whole table is read in, by descending id.
    batches: int = 8
    #: Runs of one level that are compacted to one of the next.
    fanout: int = 4


def line_key(line: Column) -> Column:
    return normalised(F.btrim(line, F.lit(WHITE)))


def _hash(c: Column, seed: int) -> Column:
    return F.xxhash64(F.lit(seed), c)


@dataclass(frozen=True)
class Run:
    """A run of (h, g, n_docs, last), bucketed and sorted by hash, every key once."""

    table: DataFrame
    #: The same files without their buckets.  A union of bucketed scans claims their partitioning, and
    #: Spark 4.1 then groups it without an exchange, which leaves a key's rows of several runs apart.
    files: DataFrame


@dataclass
class LineRuns:
    """The levelled runs.  ``add`` takes rows of (h, g, doc); all rows of a document belong to one batch."""

    spark: SparkSession
    min_docs: int = 5
    fanout: int = 4
    levels: list[list[Run]] = field(default_factory=list)

    def runs(self) -> list[Run]:
        return [run for level in self.levels for run in level]

    def add(self, batch: DataFrame) -> None:
        own = batch.select("h", "g", "doc").distinct().groupBy("h", "g").agg(
            F.count(F.lit(1)).alias("n_docs"), F.max("doc").alias("last")
        )
        for run in self.runs():
            known = run.table.where(F.col("n_docs") >= self.min_docs).select(
                F.col("h").alias("_h"), F.col("g").alias("_g"), F.col("last").alias("_last")
            )
            later = F.col("last").isNull() | (F.col("_last") >= F.col("last"))
            own = own.join(known, (F.col("h") == F.col("_h")) & (F.col("g") == F.col("_g")) & later, "left_anti")
        self._keep(self._write(own), 0)

    def _keep(self, run: Run, level: int) -> None:
        while len(self.levels) <= level:
            self.levels.append([])
        self.levels[level].append(run)
        if len(self.levels[level]) >= self.fanout:
            merged = self._merged(self.levels[level])
            self.levels[level] = []
            self._keep(self._write(merged), level + 1)

    def _merged(self, runs: list[Run]) -> DataFrame:
        rows = runs[0].files
        for run in runs[1:]:
            rows = rows.unionByName(run.files)
        return rows.groupBy("h", "g").agg(F.sum("n_docs").alias("n_docs"), F.max("last").alias("last"))

    def frequent(self) -> DataFrame:
        """(h, g, n_docs, last) of the keys in at least ``min_docs`` documents.

        n_docs is a lower bound where later documents of a frequent key were not counted."""
        return self._merged(self.runs()).where(F.col("n_docs") >= self.min_docs)

    def _write(self, rows: DataFrame) -> Run:
        name, path = "stockyard_run_" + uuid.uuid4().hex, scratch_path(self.spark, "llm", "line_runs")
        out = rows.write.bucketBy(partitions(rows), "h", "g").sortBy("h", "g").format("parquet")
        out.option("path", path).saveAsTable(name)
        return Run(self.spark.table(name), self.spark.read.schema(rows.schema).parquet(path))


def line_rows(docs: DataFrame, params: Params, id_col: str, text_col: str) -> DataFrame:
    """(doc, t, u, pos, h, g): place and key hashes of every line that may be dropped.

    (doc, t, u) names a text of a document: its id and 128 bits of its text's hash."""
    text = F.coalesce(col(text_col).cast("string"), F.lit(""))
    lines = docs.select(
        col(id_col).cast("long").alias("doc"),
        _hash(text, 1).alias("t"),
        _hash(text, 2).alias("u"),
        F.posexplode(F.split(text, "\n")).alias("pos", "line"),
    )
    keyed = lines.select("doc", "t", "u", "pos", line_key(F.col("line")).alias("key"))
    return keyed.where(F.char_length("key") >= params.min_chars).select(
        "doc", "t", "u", "pos", _hash(F.col("key"), 1).alias("h"), _hash(F.col("key"), 2).alias("g")
    )


def _batched(lines: DataFrame, bounds: list[int]) -> DataFrame:
    """``lines`` with their batch: 0 holds the largest ids, the last one the smallest and those without."""
    batch = F.lit(len(bounds))
    for k, bound in reversed(list(enumerate(bounds))):
        batch = F.when(F.col("doc") > bound, k).otherwise(batch)
    return lines.withColumn("batch", batch)


def deduplicate(docs: DataFrame, params: Params = Params(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with the lines of frequent keys dropped, plus n_lines (before) and n_dropped.

    A key of at least ``min_chars`` code points in at least ``min_docs`` documents keeps its lines
    only in the document with the largest id that holds it (every time it stands there).  All other
    lines stay, joined by ``\\n``; a text that loses all its lines becomes empty.  A null or empty
    text is one empty line.  Rows that share an id are one document, rows without an id are one
    document that comes before all others; every row is returned.  Long texts are handled line by
    line.  Input columns named n_lines or n_dropped are replaced.  An empty table gives no rows.
    """
    spark = docs.sparkSession
    ids = docs.select(col(id_col).cast("long").alias("doc"))
    shares = [1 - k / params.batches for k in range(1, params.batches)]
    cuts = ids.agg(F.percentile_approx("doc", shares, 1000).alias("cuts")).first()["cuts"] if shares else None
    bounds = sorted(set(cuts or []), reverse=True)
    path = scratch_path(spark, "llm", "lines")
    _batched(line_rows(docs, params, id_col, text_col), bounds).write.partitionBy("batch").parquet(path)
    schema = "doc long, t long, u long, pos int, h long, g long, batch int"
    lines = spark.read.schema(schema).parquet(path)

    runs = LineRuns(spark, params.min_docs, params.fanout)
    for k in range(len(bounds) + 1):
        runs.add(lines.where(F.col("batch") == k))
    frequent = materialise(runs.frequent(), "frequent_lines")
    gone = _dropped(lines, frequent)
    places = materialise(gone.groupBy("doc", "t", "u").agg(F.collect_set("pos").alias("gone")), "dropped_lines")

    kept = [c for c in docs.columns if c not in ("n_lines", "n_dropped")]
    text = col(text_col).cast("string")
    whole = F.coalesce(text, F.lit(""))
    rows = docs.select(
        F.struct(*[F.lit(None).cast("string").alias(c) if c == text_col else col(c) for c in kept]).alias("_row"),
        text.isNull().alias("_null"),
        F.split(whole, "\n").alias("_lines"),
        col(id_col).cast("long").alias("_doc"),
        _hash(whole, 1).alias("_t"),
        _hash(whole, 2).alias("_u"),
    )
    same = F.col("_doc").eqNullSafe(F.col("doc")) & (F.col("_t") == F.col("t")) & (F.col("_u") == F.col("u"))
    joined = rows.join(places, same, "left")
    # Places are distinct, so the set operation only subtracts (and is hashed, linear in the lines).  The
    # lines come out of the join as a column: inside the lambda they are read, not split again.
    stay = F.array_except(F.sequence(F.lit(0), F.size("_lines") - 1), F.col("gone"))
    cut = F.array_join(F.transform(stay, lambda p: F.get("_lines", p)), "\n")
    cleaned = F.when(F.col("gone").isNotNull(), cut).when(~F.col("_null"), F.array_join("_lines", "\n"))
    return joined.select(
        *[(cleaned if c == text_col else F.col("_row").getField(c)).alias(c) for c in kept],
        F.size("_lines").cast("long").alias("n_lines"),
        F.coalesce(F.size("gone"), F.lit(0)).cast("long").alias("n_dropped"),
    )


def _dropped(lines: DataFrame, frequent: DataFrame) -> DataFrame:
    """The rows of ``lines`` that go.

    Both sides are written tables, so the exchanges stand directly below the join and Spark's skew
    handling splits the rows of a very common line."""
    known = frequent.select(F.col("h").alias("_h"), F.col("g").alias("_g"), "last")
    both = lines.join(known, (F.col("h") == F.col("_h")) & (F.col("g") == F.col("_g")))
    return both.where(~F.col("doc").eqNullSafe(F.col("last"))).select("doc", "t", "u", "pos")

"""Build the star schema once, write it to the shared folder, read it back.

Every analytics query runs over the materialised tables: the raw feed is
written once, the cleaned orders are computed once (one skew-safe
de-duplication shuffle), each dimension reads only its columns of them, and
the fact is written once.  Re-reading written
Parquet cuts lineage (a lost executor re-reads files instead of re-running
the joins) and gives the KPI scans column pruning and filter pushdown.

A build is a new version below its root and becomes current only when all of it is written
(``sources.versions``); ``open_warehouse`` reads the current one, also in later sessions.  The
fact is partitioned by the year of its date key: a slice of years reads only their folders, and
``replace_years`` rewrites only the years that a new feed holds.
"""

from __future__ import annotations

import logging
import threading
import uuid
from concurrent.futures import ThreadPoolExecutor
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.clean import ROW, SLICE, clean_orders
from ..operators.star import (
    PRODUCT_CATEGORY,
    REGION_ZONE,
    build_dim_date,
    build_dim_product,
    build_dim_region,
    build_dim_supplier,
    build_fact_orders,
    extended_ids,
    product_attributes,
    region_attributes,
    supplier_attributes,
)
from ..schemas import FACT_ORDERS, FACT_PARTITION, STAR_TABLES, column_names
from ..session import job_label, scratch_path, session_key
from ..sources import adapter, versions
from .joins import TableSize, lookup_join, measure

DIMENSIONS = ("dim_date", "dim_product", "dim_supplier", "dim_region")
# Buckets of the raw layer; each becomes one de-duplication task.  Size it so a
# bucket holds a few hundred MB (default: the shuffle partition count).
RAW_BUCKETS_CONF = "stockyard.raw.buckets"
# Rows of a file of cleaned orders.  Spark deals files to tasks by their bytes and a fixed cost of each, so
# files of some MB keep the rows few that a task sorts by date for the fact.
ORDER_FILE_ROWS = 200_000
log = logging.getLogger(__name__)


@dataclass
class StarSchema:
    dim_date: DataFrame
    dim_product: DataFrame
    dim_supplier: DataFrame
    dim_region: DataFrame
    fact_orders: DataFrame
    # Cleaned orders (names, not ids) and the raw enriched feed they came from.
    orders: DataFrame | None = None
    raw_orders: DataFrame | None = None
    # Row counts recorded at materialisation; used to prove broadcast sizes.
    rows: dict[str, int] = field(default_factory=dict)
    root: str | None = None
    # The fact with its partition column, for reports on some years.
    fact_by_year: DataFrame | None = None
    # Cells and lines of the feed that could not be read, by column (``*``: malformed lines).
    faults: dict[str, int] = field(default_factory=dict)

    def table(self, name: str) -> DataFrame:
        return getattr(self, name)

    def dim_rows(self, name: str) -> int | None:
        return self.rows.get(name)


def build_star_schema(
    orders: DataFrame,
    category_map: Mapping[str, str] = PRODUCT_CATEGORY,
    category_key: Callable[[Column], Column] | None = None,
    zone_map: Mapping[str, str] = REGION_ZONE,
    raw_orders: DataFrame | None = None,
) -> StarSchema:
    """All five tables from cleaned orders, without writing anything."""
    dd = build_dim_date(orders)
    dp = build_dim_product(orders, category_map, category_key)
    ds = build_dim_supplier(orders)
    dr = build_dim_region(orders, zone_map)
    fact = build_fact_orders(orders, dp, ds, dr)
    return StarSchema(dd, dp, ds, dr, fact, orders=orders, raw_orders=raw_orders)


def _write(df: DataFrame, path: str, file_rows: int = 0) -> DataFrame:
    """``df`` written (files of at most ``file_rows`` rows, where given) and read back."""
    with job_label(df.sparkSession, f"stockyard write {path.rstrip('/').rsplit('/', 1)[-1]}"):
        df.write.mode("overwrite").option("maxRecordsPerFile", file_rows).parquet(path)
    # The schema is known: passing it skips the footer-reading inference job.
    return df.sparkSession.read.schema(df.schema).parquet(path)


def write_fact(fact: DataFrame, path: str) -> DataFrame:
    """Write the fact partitioned by year, sorted by date inside each file, and read it back.

    Only the years that ``fact`` holds are replaced (dynamic partition overwrite); the files of all others
    stay as they are.  No exchange: each task writes one file for each of its years."""
    year = F.floor(F.col("date_id") / 10000).cast("int")
    with job_label(fact.sparkSession, "stockyard write fact_orders"):
        rows = fact.withColumn(FACT_PARTITION, year).sortWithinPartitions(FACT_PARTITION, "date_id")
        out = rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        out.partitionBy(FACT_PARTITION).parquet(path)
    return _read_fact(fact.sparkSession, path)


def _read_fact(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(f"{_ddl(FACT_ORDERS)}, {FACT_PARTITION} int").parquet(path)


def _ddl(schema) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)


def _write_bucketed(df: DataFrame, path: str, key: str, buckets: int) -> DataFrame:
    """Write ``df`` as an external Parquet table bucketed by ``key``; read it back.

    A bucketed scan reports hash partitioning by ``key`` with ``buckets``
    partitions, so aggregations keyed by it need no exchange."""
    spark = df.sparkSession
    name = "stockyard_" + uuid.uuid4().hex
    with job_label(spark, f"stockyard write {path.rstrip('/').rsplit('/', 1)[-1]} (bucketed)"):
        df.write.mode("overwrite").bucketBy(buckets, key).format("parquet").option("path", path).saveAsTable(name)
    return spark.table(name)


def materialize_star_schema(
    spark: SparkSession,
    orders: DataFrame,
    root: str,
    category_map: Mapping[str, str] = PRODUCT_CATEGORY,
    category_key: Callable[[Column], Column] | None = None,
    zone_map: Mapping[str, str] = REGION_ZONE,
    raw_orders: DataFrame | None = None,
) -> StarSchema:
    """Write cleaned orders, the four dimensions and the fact below ``root``.

    ``raw_orders`` (the feed, already written by the caller) is kept for the
    feed-level reports.  The fact is written sorted by ``date_id`` inside
    each task so Parquet row-group statistics can skip dates (period
    slicers, trend windows).
    """
    clean = _write(orders, f"{root}/orders_clean", ORDER_FILE_ROWS)
    builders = {
        "dim_date": lambda: build_dim_date(clean),
        "dim_product": lambda: build_dim_product(clean, category_map, category_key),
        "dim_supplier": lambda: build_dim_supplier(clean),
        "dim_region": lambda: build_dim_region(clean, zone_map),
    }
    written, rows = _write_dimensions(builders, root)
    fact = build_fact_orders(clean, written["dim_product"], written["dim_supplier"], written["dim_region"], rows)
    by_year = write_fact(fact, f"{root}/fact_orders")
    rows["fact_orders"] = by_year.count()
    return _star(written, by_year, rows, root, orders=clean, raw_orders=raw_orders)


def _write_dimensions(builders: Mapping[str, Callable[[], DataFrame]], root: str) -> tuple[dict[str, DataFrame], dict[str, int]]:
    """Write the dimensions as concurrent small jobs (they are independent); measure each."""

    def build(name: str) -> tuple[str, DataFrame, TableSize]:
        df = _write(builders[name](), f"{root}/{name}")
        return name, df, measure(df)

    with ThreadPoolExecutor(max_workers=len(builders)) as pool:
        done = list(pool.map(build, builders))
    return {name: df for name, df, _ in done}, {name: n for name, _, n in done}


def _star(dims: Mapping[str, DataFrame], by_year: DataFrame, rows: dict[str, int], root: str, **more) -> StarSchema:
    fact = by_year.select(*column_names(FACT_ORDERS))
    return StarSchema(*[dims[d] for d in DIMENSIONS], fact, rows=rows, root=root, fact_by_year=by_year, **more)


def _manifest(star: StarSchema, places: dict[str, str], folders: list[str]) -> versions.Manifest:
    return versions.Manifest(
        places,
        rows={name: int(n) for name, n in star.rows.items()},
        bytes={name: n.columns for name, n in star.rows.items() if isinstance(n, TableSize)},
        notes={"partitions": [FACT_PARTITION], "faults": star.faults},
        folders=folders,
    )


def open_warehouse(spark: SparkSession, root: str) -> StarSchema:
    """The star schema that is current below ``root``, in any session, without a job."""
    found = versions.current(spark, root)
    if found is None:
        raise FileNotFoundError(f"no warehouse was published below {root}")
    read = lambda name, schema: spark.read.schema(schema).parquet(found.tables[name])
    dims = {name: read(name, STAR_TABLES[name]) for name in DIMENSIONS}
    rows = {name: TableSize(n, found.bytes[name]) if name in found.bytes else n for name, n in found.rows.items()}
    return _star(dims, _read_fact(spark, found.tables["fact_orders"]), rows, root, faults=found.notes.get("faults", {}))


def replace_years(
    spark: SparkSession,
    root: str,
    orders: DataFrame,
    category_map: Mapping[str, str] = PRODUCT_CATEGORY,
    category_key: Callable[[Column], Column] | None = None,
    zone_map: Mapping[str, str] = REGION_ZONE,
) -> StarSchema:
    """Load cleaned ``orders`` of some years into the warehouse below ``root``.

    They replace all facts of the years they hold (of no year, for orders without a date); facts of other
    years, and their files, stay.  Ids stay, new names get ids after the largest; what the dimensions derive
    from the orders (mean cost, reliability, dates) is aggregated again from the whole fact.  The longer
    dimensions are published before the fact changes, so no reader meets a fact whose names it lacks."""
    old = open_warehouse(spark, root)
    found = versions.current(spark, root)
    fact_path = found.tables["fact_orders"]
    names = {
        "dim_product": ("product_id", "product_name", "product_name"),
        "dim_supplier": ("supplier_id", "supplier_name", "supplier_name"),
        "dim_region": ("region_id", "region_name", "region"),
    }
    with versions.new_version(spark, root) as folder:
        fresh = _write(orders, f"{folder}/orders_clean", ORDER_FILE_ROWS)
        ids = {}
        for dim, (key, name, source) in names.items():
            given = fresh.where(F.col(source).isNotNull()).select(F.col(source).alias(name))
            ids[dim] = _write(extended_ids(old.table(dim), given, key, name), f"{folder}/ids_{dim}")
        sizes = {dim: measure(ids[dim]) for dim in ids}

        def longer(dim: str) -> DataFrame:
            key, name, _ = names[dim]
            return ids[dim].join(old.table(dim).drop(name), key, "left").select(*column_names(STAR_TABLES[dim]))

        dates = lambda: old.dim_date.unionByName(build_dim_date(fresh)).distinct()
        first = {dim: (lambda dim=dim: longer(dim)) for dim in ids} | {"dim_date": dates}
        dims, rows = _write_dimensions(first, f"{folder}/longer")
        star = _star(dims, old.fact_by_year, rows | {"fact_orders": old.rows["fact_orders"]}, root, faults=old.faults)
        places = {d: f"{folder}/longer/{d}" for d in DIMENSIONS} | {"fact_orders": fact_path}
        versions.publish(spark, root, _manifest(star, places, [folder]))

    by_year = write_fact(build_fact_orders(fresh, ids["dim_product"], ids["dim_supplier"], ids["dim_region"], sizes), fact_path)
    with versions.new_version(spark, root) as folder:
        named = by_year
        for dim, (key, name, source) in names.items():
            named = lookup_join(named, ids[dim].select(key, F.col(name).alias(source)), key, "left", sizes[dim])
        named = named.withColumn("order_date", F.try_to_date(F.col("date_id").cast("string"), "yyyyMMdd"))
        made = {
            "dim_product": product_attributes(named, category_map, category_key),
            "dim_supplier": supplier_attributes(named),
            "dim_region": region_attributes(named, zone_map),
        }

        def again(dim: str) -> DataFrame:
            key, name, _ = names[dim]
            return ids[dim].join(made[dim], name).select(*column_names(STAR_TABLES[dim]))

        last = {dim: (lambda dim=dim: again(dim)) for dim in ids} | {"dim_date": lambda: build_dim_date(named)}
        dims, rows = _write_dimensions(last, folder)
        rows["fact_orders"] = by_year.count()
        star = _star(dims, by_year, rows, root, faults=old.faults)
        places = {d: f"{folder}/{d}" for d in DIMENSIONS} | {"fact_orders": fact_path}
        versions.publish(spark, root, _manifest(star, places, [folder]))
    return star


_LOCK = threading.Lock()
_CACHE: dict[tuple[str, str], StarSchema] = {}


def build_warehouse(
    spark: SparkSession,
    raw: DataFrame,
    root: str,
    first_by: Sequence[str] | None = None,
    colocate_by: Sequence[str] = (),
    category_map: Mapping[str, str] = PRODUCT_CATEGORY,
    category_key: Callable[[Column], Column] | None = None,
    zone_map: Mapping[str, str] = REGION_ZONE,
    observed: Callable[[], dict[str, int]] | None = None,
    wide_feed: bool = False,
) -> StarSchema:
    """Raw feed -> written raw layer -> cleaned orders -> dimensions -> fact, published below ``root``.

    By default de-duplication shuffles the feed once, to as many tasks as sort
    their rows in memory; copies of an order that holds very many rows are collapsed
    in every map task, so even one order holding a third of all rows never lands
    whole in one task (``clean.dedupe_spread``).

    ``wide_feed`` (for feeds whose rows are much wider than their order columns) buckets the raw layer by the task
    that wrote a row and shuffles keys, order columns and positions only (``clean.dedupe_late``).

    ``colocate_by`` (opt-in, for feeds whose keys are known not to be skewed)
    writes the raw layer bucketed by its first column
    (``stockyard.raw.buckets`` buckets, default one per shuffle partition) and
    de-duplicates by it as well without a shuffle; all copies of one key then
    share a bucket and a task.

    ``observed`` gives the feed's fault counts once the raw layer is written; they are stored with
    the tables."""
    with versions.new_version(spark, root) as folder:
        raw_t, colocated = _raw_layer(spark, raw, folder, colocate_by, wide_feed)
        faults = observed() if observed else {}
        orders = clean_orders(raw_t, first_by=first_by, colocate_by=colocated)
        star = materialize_star_schema(
            spark, orders, folder, category_map=category_map, category_key=category_key, zone_map=zone_map, raw_orders=raw_t
        )
        star.root, star.faults = root, faults
        places = {name: f"{folder}/{name}" for name in (*STAR_TABLES, "orders_clean")}
        versions.publish(spark, root, _manifest(star, places, [folder]))
    return star


def with_positions(raw: DataFrame) -> DataFrame:
    """``raw`` with the task that writes each row and the row's number there."""
    tag = F.monotonically_increasing_id()
    return raw.withColumns({SLICE: F.shiftright(tag, 33).cast("int"), ROW: tag.bitwiseAND(F.lit((1 << 33) - 1))})


def _raw_layer(spark: SparkSession, raw: DataFrame, root: str, colocate_by: Sequence[str], wide: bool) -> tuple[DataFrame, Sequence[str]]:
    """The feed written once, and the columns it is in fact co-located by."""
    if colocate_by:
        buckets = int(spark.conf.get(RAW_BUCKETS_CONF, spark.conf.get("spark.sql.shuffle.partitions")))
        try:
            return _write_bucketed(raw, f"{root}/raw_orders", colocate_by[0], buckets), colocate_by
        except AnalysisException as err:  # the catalog takes no table here: same result, one more shuffle
            log.warning("bucketed raw layer unavailable (%s); de-duplicating with a shuffle", err)
            return _write(raw, f"{root}/raw_orders_plain"), ()
    if not wide:
        return _write(raw, f"{root}/raw_orders_plain"), ()
    # More buckets than tasks, so that few slices share one; a task writes one file, its slice.
    buckets = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    try:
        return _write_bucketed(with_positions(raw), f"{root}/raw_orders", SLICE, buckets), ()
    except AnalysisException as err:
        log.warning("bucketed raw layer unavailable (%s); de-duplicating with whole rows", err)
        return _write(raw, f"{root}/raw_orders_plain"), ()


def warehouse(spark: SparkSession, sf_dir: str) -> StarSchema:
    """Star schema over the driver tables in ``sf_dir``, built once per session.

    Raw feed, cleaned orders, dimensions and fact are written below the
    shared folder; later queries of the same session reuse them."""
    key = (session_key(spark), sf_dir.rstrip("/"))
    with _LOCK:
        star = _CACHE.get(key)
        if star is None:
            star = build_warehouse(
                spark,
                adapter.raw_orders_from_tables(spark, sf_dir),
                scratch_path(spark, "warehouse"),
                first_by=adapter.FIRST_BY,
                category_map=adapter.PART_NOUN_CATEGORY,
                category_key=adapter.part_noun,
                zone_map=adapter.REGION_ZONE,
            )
            _CACHE[key] = star
        return star


def forget(spark: SparkSession, sf_dir: str | None = None) -> None:
    """Drop cached star schemas of this session (forces a rebuild).

    Their files stay until ``session.drop_scratch``."""
    app = session_key(spark)
    with _LOCK:
        for k in [k for k in _CACHE if k[0] == app and (sf_dir is None or k[1] == sf_dir.rstrip("/"))]:
            del _CACHE[k]

"""File sources and sinks: CSV feeds and outputs, Parquet tables, table DDL.

All writes replace what is there.  CSV outputs use ``mode("overwrite")`` and go to a folder of part files;
``single_file`` collapses to one part only for small frames (dimensions, report outputs) where one
file is the contract of a BI tool.  Parquet tables are written as a new version and switched last
(``versions``), so that a failed write leaves the old rows.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.clean import FILE_ORDER, MALFORMED, typed_feed
from ..schemas import FACT_PARTITION, RAW_CSV_SCHEMA, STAR_TABLES
from . import versions

# Rows up to which an output is gathered in one file.
SINGLE_FILE_ROWS = 1_000_000
EXPORT_TABLES = ("fact_orders", "dim_product", "dim_supplier", "dim_region", "dim_date")


def read_raw_orders_text(spark: SparkSession, path: str) -> DataFrame:
    """Raw order feed from CSV with a header, every cell as text.

    Adds ``_file_order`` = (file, block start, position inside the block) so
    that "first copy in file order" survives Spark's file splitting, and
    ``_malformed``: the whole line where it has too few or too many cells.  The
    always-empty ``actual_delivery`` column is dropped."""
    schema = T.StructType([*RAW_CSV_SCHEMA.fields, T.StructField(MALFORMED, T.StringType())])
    # Without pruning every line's cells are counted, whatever columns a query reads.
    reader = spark.read.options(header=True, mode="PERMISSIVE", columnPruning=False, columnNameOfCorruptRecord=MALFORMED)
    order = F.struct(
        F.input_file_name().alias("file"),
        F.input_file_block_start().alias("block"),
        F.monotonically_increasing_id().alias("pos"),
    )
    return reader.schema(schema).csv(path).drop("actual_delivery").withColumn(FILE_ORDER, order)


def read_raw_orders_csv(spark: SparkSession, path: str) -> DataFrame:
    """The CSV feed with the types of ``RAW_ORDERS`` (and ``_file_order``).

    Cells that do not parse are null; ``operators.clean.bad_cells`` over
    ``read_raw_orders_text`` counts them and the malformed lines."""
    return typed_feed(read_raw_orders_text(spark, path)).drop(MALFORMED)


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A saved output (forecast, KPI tables) read back with its declared schema."""
    return spark.read.option("header", True).schema(schema).csv(path)


def write_csv(df: DataFrame, path: str, single_file: bool = False, rows: int | None = None) -> str:
    """Write with a header, replacing what is there; returns the path.

    ``single_file`` gathers the rows in one part file, but only up to
    ``SINGLE_FILE_ROWS`` (``rows`` if known, else counted): one task writes it."""
    if single_file and (df.count() if rows is None else rows) > SINGLE_FILE_ROWS:
        single_file = False
    out = df.coalesce(1) if single_file else df
    out.write.mode("overwrite").option("header", True).csv(path)
    return path


def write_table(df: DataFrame, path: str, partition_by: list[str] | None = None) -> DataFrame:
    """Replace the Parquet table at ``path`` and return it read back (lineage cut).

    The old rows stay readable until the new ones are whole, and if the write fails."""
    spark = df.sparkSession
    with versions.new_version(spark, path) as folder:
        w = df.write.partitionBy(*partition_by) if partition_by else df.write
        w.parquet(folder)
        versions.publish(spark, path, versions.Manifest({"": folder}, folders=[folder]))
    return spark.read.schema(df.schema).parquet(folder)


def read_table_at(spark: SparkSession, path: str) -> DataFrame:
    """The current rows of a table that ``write_table`` wrote."""
    found = versions.current(spark, path)
    return spark.read.parquet(found.tables[""] if found else path)


def load_star_schema(tables: Mapping[str, DataFrame], root: str) -> dict[str, DataFrame]:
    """Replace the five star-schema tables below ``root``, all at once."""
    spark = tables["fact_orders"].sparkSession
    with versions.new_version(spark, root) as folder:
        for name in STAR_TABLES:
            tables[name].write.parquet(f"{folder}/{name}")
        places = {name: f"{folder}/{name}" for name in STAR_TABLES}
        versions.publish(spark, root, versions.Manifest(places, folders=[folder]))
    return {name: spark.read.schema(tables[name].schema).parquet(path) for name, path in places.items()}


def _ddl_type(t: T.DataType) -> str:
    return t.simpleString().upper()


def create_star_tables(spark: SparkSession, root: str, prefix: str = "", analyze: bool = True) -> list[str]:
    """``CREATE TABLE IF NOT EXISTS ... USING parquet`` for the star schema, over its current version.

    Idempotent, like the original DDL; a table made earlier is pointed at the version that is current now.
    ``analyze`` gathers row counts and column statistics of tables that hold rows, so that the planner knows
    widths and distinct counts.  Keys and NOT NULL are documented in the schemas and checked by
    ``operators.quality``, not enforced here."""
    names = []
    places = versions.resolve(spark, root, {name: f"{root}/{name}" for name in STAR_TABLES})
    for name, schema in STAR_TABLES.items():
        fields, parts = list(schema.fields), ""
        if name == "fact_orders" and versions.current(spark, root) and FACT_PARTITION in (versions.current(spark, root).notes.get("partitions") or []):
            fields, parts = [*fields, T.StructField(FACT_PARTITION, T.IntegerType())], f" PARTITIONED BY ({FACT_PARTITION})"
        cols = ", ".join(f"`{f.name}` {_ddl_type(f.dataType)}" for f in fields)
        table, place = f"{prefix}{name}", places[name]
        spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({cols}) USING parquet{parts} LOCATION '{place}'")
        spark.sql(f"ALTER TABLE {table} SET LOCATION '{place}'")
        if parts:
            spark.sql(f"MSCK REPAIR TABLE {table}")
        if analyze:
            spark.sql(f"ANALYZE TABLE {table} COMPUTE STATISTICS FOR ALL COLUMNS")
        names.append(table)
    return names

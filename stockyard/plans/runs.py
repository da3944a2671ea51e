"""End-to-end runs for a raw order feed: warehouse build, then the saved outputs.

``build_from_csv`` mirrors the batch steps of the original scripts (ingest a
feed, build and load the star schema, check it); ``write_outputs`` writes the
analytics tables and the BI exports.  All heavy work is Spark jobs; the
driver only names paths.
"""

from __future__ import annotations

import logging
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession

from ..operators import forecast as fc
from ..operators import inventory, kpis, mart, risk, variance
from ..operators.clean import observed_feed
from ..schemas import RAW_ORDERS, column_names
from ..sources.files import EXPORT_TABLES, read_raw_orders_text, write_csv, write_table
from .warehouse import StarSchema, build_warehouse

log = logging.getLogger(__name__)


def build_from_csv(spark: SparkSession, csv_path: str, root: str, **maps) -> StarSchema:
    """Raw CSV feed -> star schema written below ``root`` (first copy in file order wins).

    ``faults`` of the result counts the cells that did not parse, by column, and the malformed lines (``*``);
    they are counted while the raw layer is written and stored with the tables."""
    raw, faults = observed_feed(read_raw_orders_text(spark, csv_path))
    star = build_warehouse(spark, raw, root, observed=faults, **maps)
    lost = {c: n for c, n in star.faults.items() if n}
    if lost:
        log.warning("cells of %s that could not be read, by column (*: malformed lines): %s", csv_path, lost)
    return star


def outputs(star: StarSchema) -> dict[str, DataFrame]:
    """The five saved analytics tables, in report order."""
    return {
        "forecast": fc.forecast_rolling(fc.daily_series(star)).orderBy("date"),
        "kpi_inventory": inventory.inventory_kpis(star),
        "supplier_risk": risk.supplier_risk(star),
        "cost_variance": variance.cost_variance(star),
        "kpi_summary": kpis.kpi_summary(star),
    }


def write_outputs(star: StarSchema, root: str, parallel_jobs: int = 4) -> dict[str, str]:
    """Write each analytics table as CSV, the inventory snapshot of the feed as CSV and
    as table ``raw_inventory``, and the BI exports (five tables and the
    flattened mart as CSV).  Outputs and dimensions of at most
    ``SINGLE_FILE_ROWS`` rows are one file each.  The writes are independent
    Spark jobs and are submitted from ``parallel_jobs`` threads."""
    tasks: dict[str, tuple[DataFrame, str, bool, int | None]] = {
        name: (df, f"{root}/outputs/{name}", True, None) for name, df in outputs(star).items()
    }
    for name in EXPORT_TABLES:
        tasks[f"bi_{name}"] = (star.table(name), f"{root}/bi/{name}", name.startswith("dim_"), star.dim_rows(name))
    tasks["bi_mart"] = (mart.export_mart(star), f"{root}/bi/mart", False, None)
    if star.raw_orders is not None:
        snapshot = inventory.inventory_snapshot(star.raw_orders.select(*column_names(RAW_ORDERS)))
        snapshot = write_table(snapshot, f"{root}/tables/raw_inventory")
        tasks["inventory"] = (snapshot.orderBy("product_name"), f"{root}/raw/inventory", True, None)

    def run(item: tuple[str, tuple[DataFrame, str, bool, int | None]]) -> tuple[str, str]:
        name, (df, path, single, rows) = item
        return name, write_csv(df, path, single_file=single, rows=rows)

    with ThreadPoolExecutor(max_workers=parallel_jobs) as pool:
        return dict(pool.map(run, tasks.items()))

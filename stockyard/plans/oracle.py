"""Independent SQL (DuckDB dialect) for every registered query.

The SQL rebuilds the whole pipeline from the driver tables in one CTE chain:
feed -> first copy per order_id -> cleaned orders -> dimensions -> fact, then
each report joins the fact to its dimension and groups, the way the original
reports are written.  It shares no code with the Spark plans, only the
documented rules: SQL ``ROUND`` through ``decimal(28,10)``, pandas rounding as
``round_even(x * 10^n, 0) / 10^n``, money summed as ``decimal(18,2)``.
"""

from __future__ import annotations

from ..operators.curve import FEATURE_UNIT, VALUE_UNIT, Curve, wave_angles


def sround(x: str, n: int) -> str:
    return f"CAST(ROUND(CAST(({x}) AS DECIMAL(28,10)), {n}) AS DOUBLE)"


def pround(x: str, n: int) -> str:
    if n == 0:
        return f"round_even(({x}), 0)"
    f = f"{10**n}.0::DOUBLE"
    return f"(round_even(({x}) * {f}, 0) / {f})"


def money(x: str, n: int = 0) -> str:
    return f"CAST(ROUND(SUM(CAST({x} AS DECIMAL(18,2))), {n}) AS DOUBLE)"


def money_avg(x: str) -> str:
    return f"(CAST(SUM(CAST({x} AS DECIMAL(18,2))) AS DOUBLE) / COUNT({x}))"


def clip(x: str, lo: float | None, hi: float | None) -> str:
    e = x
    if lo is not None:
        e = f"GREATEST({e}, {lo}::DOUBLE)"
    if hi is not None:
        e = f"LEAST({e}, {hi}::DOUBLE)"
    return f"(CASE WHEN ({x}) IS NULL THEN NULL ELSE {e} END)"


def title(x: str) -> str:
    return (
        f"array_to_string(list_transform(string_split(lower(regexp_replace({x}, '^\\s+|\\s+$', '', 'g')), ' '), "
        "lambda w: upper(w[1]) || w[2:]), ' ')"
    )


def bins(x: str, edges: list[float], labels: list[str]) -> str:
    parts = [
        f"WHEN ({x}) > {lo}::DOUBLE AND ({x}) <= {hi}::DOUBLE THEN '{lab}'"
        for lo, hi, lab in zip(edges[:-1], edges[1:], labels)
    ]
    return "CASE " + " ".join(parts) + " END"


PREFIX = f"""
WITH feed AS (
  SELECT
    'ORD-' || CAST(l.l_orderkey AS VARCHAR) || '-' || CAST(l.l_linenumber AS VARCHAR) AS order_id,
    CAST(o.o_orderdate AS DATE) AS order_date,
    p.p_name AS product_name,
    s.s_name AS supplier_name,
    r.r_name AS region,
    CAST(l.l_quantity AS INTEGER) AS quantity_ordered,
    p.p_retailprice AS unit_cost,
    CAST(10 + (l.l_orderkey*7 + l.l_linenumber*13 + l.l_partkey*5) % (5 + (l.l_suppkey%4)*12) AS INTEGER) AS lead_time_days,
    CAST((l.l_orderkey*11) % 100 + (ascii(p.p_name)*37 + ascii(split_part(p.p_name, ' ', 2))*53 + length(p.p_name)*11) % 700 AS INTEGER) AS warehouse_stock,
    CAST(CASE WHEN (l.l_orderkey*31 + l.l_linenumber*17) % 100 >= 95 - (l.l_suppkey%3)*15
              THEN 1 + (l.l_orderkey + l.l_partkey) % 14 ELSE 0 END AS INTEGER) AS delay_days,
    l.l_orderkey AS k_order, l.l_partkey AS k_part, l.l_suppkey AS k_supp, l.l_quantity AS k_qty, l.l_extendedprice AS k_price, l.l_shipdate AS k_ship
  FROM lineitem l
  LEFT JOIN orders o ON l.l_orderkey = o.o_orderkey
  LEFT JOIN part p ON l.l_partkey = p.p_partkey
  LEFT JOIN supplier s ON l.l_suppkey = s.s_suppkey
  LEFT JOIN nation n ON s.s_nationkey = n.n_nationkey
  LEFT JOIN region r ON n.n_regionkey = r.r_regionkey
),
raw_orders AS (
  SELECT order_id, order_date, product_name, supplier_name, region, quantity_ordered, unit_cost,
         lead_time_days, warehouse_stock, delay_days,
         quantity_ordered * unit_cost AS total_cost,
         lead_time_days + delay_days AS actual_delivery_days,
         delay_days > 0 AS is_delayed,
         k_order, k_part, k_supp, k_qty, k_price, k_ship
  FROM feed
),
firsts AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY order_id
                                 ORDER BY order_date, k_part, k_supp, k_qty, k_price, k_ship) AS rn
    FROM raw_orders)
  WHERE rn = 1 AND order_id IS NOT NULL AND product_name IS NOT NULL
),
orders_clean AS (
  SELECT order_id, order_date,
         {title('product_name')} AS product_name,
         {title('supplier_name')} AS supplier_name,
         {title('region')} AS region,
         quantity_ordered,
         {pround('unit_cost', 2)} AS unit_cost,
         {pround('quantity_ordered * ' + pround('unit_cost', 2), 2)} AS total_cost,
         lead_time_days, actual_delivery_days, delay_days,
         CAST(is_delayed AS INTEGER) AS is_delayed,
         warehouse_stock
  FROM firsts
),
dim_date AS (
  SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_id, d AS full_date,
         CAST(year(d) AS INTEGER) AS year, CAST(quarter(d) AS INTEGER) AS quarter,
         CAST(month(d) AS INTEGER) AS month, monthname(d) AS month_name,
         CAST(strftime(d, '%W') AS INTEGER) AS week, dayname(d) AS day_of_week
  FROM (SELECT DISTINCT order_date AS d FROM orders_clean WHERE order_date IS NOT NULL)
),
dim_product AS (
  SELECT CAST(row_number() OVER (ORDER BY product_name) AS INTEGER) AS product_id, product_name,
         {pround(money_avg('unit_cost'), 2)} AS unit_cost,
         COALESCE(CASE string_split(product_name, ' ')[-1]
                    WHEN 'Gear' THEN 'Hardware' WHEN 'Bolt' THEN 'Hardware'
                    WHEN 'Ring' THEN 'Accessories' WHEN 'Rod' THEN 'Accessories'
                    WHEN 'Plate' THEN 'Metalwork' WHEN 'Anvil' THEN 'Metalwork'
                    WHEN 'Widget' THEN 'Devices' END, 'Other') AS category
  FROM orders_clean WHERE product_name IS NOT NULL GROUP BY product_name
),
dim_supplier AS (
  SELECT CAST(row_number() OVER (ORDER BY supplier_name) AS INTEGER) AS supplier_id, supplier_name,
         {bins('rate', [-0.01, 0.15, 0.30, 1.0], ['High', 'Medium', 'Low'])} AS reliability,
         'India' AS country
  FROM (SELECT supplier_name, AVG(is_delayed) AS rate FROM orders_clean
        WHERE supplier_name IS NOT NULL GROUP BY supplier_name)
),
dim_region AS (
  SELECT CAST(row_number() OVER (ORDER BY region_name) AS INTEGER) AS region_id, region_name,
         CASE region_name WHEN 'Africa' THEN 'Africa Zone' WHEN 'America' THEN 'America Zone'
                          WHEN 'Asia' THEN 'Asia Zone' WHEN 'Europe' THEN 'Europe Zone' END AS zone
  FROM (SELECT DISTINCT region AS region_name FROM orders_clean WHERE region IS NOT NULL)
),
fact_orders AS (
  SELECT o.order_id, CAST(strftime(o.order_date, '%Y%m%d') AS INTEGER) AS date_id,
         p.product_id, s.supplier_id, r.region_id,
         o.quantity_ordered, o.unit_cost, o.total_cost, o.lead_time_days, o.actual_delivery_days,
         o.delay_days, o.is_delayed, o.warehouse_stock
  FROM orders_clean o
  LEFT JOIN dim_product p ON o.product_name = p.product_name
  LEFT JOIN dim_supplier s ON o.supplier_name = s.supplier_name
  LEFT JOIN dim_region r ON o.region = r.region_name
)
"""

# The feed as typed again from text cells with planted faults.
TEXT_FEED = """
, text_orders AS (
  SELECT order_id, order_date, CASE WHEN k_order % 97 <> 3 THEN product_name END AS product_name, supplier_name, region,
         CASE WHEN k_order % 50 <> 7 THEN quantity_ordered END AS quantity_ordered, k_order % 50 = 7 AS quantity_bad,
         unit_cost, lead_time_days, warehouse_stock, delay_days,
         round_even(total_cost * 100, 0) / 100 + CASE WHEN k_order % 31 = 4 THEN 1 ELSE 0 END AS total_cost,
         CAST(NULL AS INTEGER) AS actual_delivery_days, is_delayed,
         k_order, k_part, k_supp, k_qty, k_price, k_ship
  FROM raw_orders
)
"""

RAW_COLS = (
    "order_id, order_date, product_name, supplier_name, region, quantity_ordered, unit_cost, "
    "lead_time_days, warehouse_stock, delay_days, total_cost, actual_delivery_days, is_delayed"
)

_RATE = "AVG(f.is_delayed)"

supplier_risk_base = f"""
supplier_base AS (
  SELECT s.supplier_name, s.reliability,
         COUNT(f.order_id) AS total_orders,
         {sround(_RATE + '*100', 2)} AS delay_rate_pct,
         {sround('AVG(f.lead_time_days)', 1)} AS avg_lead_time,
         {sround('MIN(f.lead_time_days)', 0)} AS min_lead_time,
         {sround('MAX(f.lead_time_days)', 0)} AS max_lead_time,
         {money('f.total_cost')} AS total_spend
  FROM fact_orders f JOIN dim_supplier s ON f.supplier_id = s.supplier_id
  GROUP BY s.supplier_name, s.reliability
),
supplier_scored AS (
  SELECT *,
         {clip('delay_rate_pct / 100 * 100', 0, 100)} AS delay_score,
         {clip('(avg_lead_time - 15.0::DOUBLE) / 15.0::DOUBLE * 100', 0, 100)} AS lead_time_score,
         CASE WHEN avg_lead_time = 0 AND max_lead_time > min_lead_time THEN 100.0::DOUBLE ELSE
         {clip('(max_lead_time - min_lead_time) / NULLIF(avg_lead_time, 0) * 100', 0, 100)} END AS variance_score
  FROM supplier_base
),
supplier_risk AS (
  SELECT *, {bins('risk_score', [-1, 30, 60, 101], ['Low Risk', 'Medium Risk', 'High Risk'])} AS risk_label
  FROM (SELECT *, {pround('delay_score * 0.40::DOUBLE + lead_time_score * 0.35::DOUBLE + variance_score * 0.25::DOUBLE', 1)} AS risk_score
        FROM supplier_scored)
)"""

inventory_base = f"""
inv_base AS (
  SELECT p.product_name, p.category,
         COUNT(f.order_id) AS total_orders,
         CAST(SUM(f.quantity_ordered) AS BIGINT) AS total_units_sold,
         {sround('AVG(f.warehouse_stock)', 0)} AS avg_stock,
         {sround('AVG(f.lead_time_days)', 1)} AS avg_lead_time,
         {money('f.total_cost')} AS total_revenue
  FROM fact_orders f JOIN dim_product p ON f.product_id = p.product_id
  GROUP BY p.product_name, p.category
),
inv_add AS (SELECT *, {pround('total_units_sold / 730', 2)} AS avg_daily_demand FROM inv_base),
inventory_kpis AS (
  SELECT *,
         CAST({pround('avg_daily_demand * avg_lead_time', 0)} AS BIGINT) AS reorder_point,
         CAST({pround('avg_daily_demand * avg_lead_time * 1.5::DOUBLE', 0)} AS BIGINT) AS safety_stock,
         {pround('total_units_sold / NULLIF(avg_stock, 0)', 2)} AS inventory_turnover,
         {pround('avg_stock / NULLIF(avg_daily_demand, 0)', 1)} AS days_of_stock,
         {bins('avg_stock', [-1, 100, 300, 99999], ['CRITICAL', 'LOW', 'ADEQUATE'])} AS stock_status
  FROM inv_add
)"""

cost_variance_base = f"""
cv_base AS (
  SELECT d.year, d.month, d.month_name, d.quarter, p.category,
         COUNT(f.order_id) AS total_orders,
         {money('f.total_cost')} AS planned_spend,
         {sround('AVG(f.lead_time_days)', 1)} AS planned_days,
         {sround('AVG(f.actual_delivery_days)', 1)} AS actual_days,
         {sround('AVG(f.delay_days)', 2)} AS avg_delay,
         CAST(SUM(f.is_delayed) AS BIGINT) AS delayed_orders
  FROM fact_orders f
  JOIN dim_date d ON f.date_id = d.date_id
  JOIN dim_product p ON f.product_id = p.product_id
  GROUP BY d.year, d.month, d.month_name, d.quarter, p.category
),
cost_variance AS (
  SELECT *,
         {pround('actual_days - planned_days', 2)} AS day_variance,
         {pround('planned_spend * avg_delay * 0.005::DOUBLE', 0)} AS delay_cost,
         {pround('1 - delayed_orders / total_orders', 3)} * 100 AS on_time_rate,
         CAST(year AS VARCHAR) || '-Q' || CAST(quarter AS VARCHAR) AS period
  FROM cv_base
)"""

kpi_long = f"""
fact_totals AS (
  SELECT CAST(COUNT(*) AS DOUBLE) AS total_orders,
         {money('total_cost')} AS total_revenue,
         {sround(money_avg('total_cost'), 0)} AS avg_order_value,
         {sround('(1 - AVG(is_delayed)) * 100', 1)} AS on_time_rate_pct,
         {sround('AVG(lead_time_days)', 1)} AS avg_lead_time_days,
         {sround('AVG(delay_days)', 2)} AS avg_delay_days,
         CAST(SUM(is_delayed) AS DOUBLE) AS total_delayed_orders
  FROM fact_orders
),
kpi_long AS (
  SELECT 1 AS o, 'total_orders' AS metric, total_orders AS value FROM fact_totals
  UNION ALL SELECT 2, 'total_revenue', total_revenue FROM fact_totals
  UNION ALL SELECT 3, 'avg_order_value', avg_order_value FROM fact_totals
  UNION ALL SELECT 4, 'on_time_rate_pct', on_time_rate_pct FROM fact_totals
  UNION ALL SELECT 5, 'avg_lead_time_days', avg_lead_time_days FROM fact_totals
  UNION ALL SELECT 6, 'avg_delay_days', avg_delay_days FROM fact_totals
  UNION ALL SELECT 7, 'total_delayed_orders', total_delayed_orders FROM fact_totals
  UNION ALL SELECT 8, 'high_risk_suppliers', CAST(COUNT(*) AS DOUBLE) FROM dim_supplier WHERE reliability = 'Low'
  UNION ALL SELECT 9, 'critical_stock_items', CAST(COUNT(*) AS DOUBLE) FROM (
      SELECT product_id FROM fact_orders GROUP BY product_id HAVING AVG(warehouse_stock) < 100)
)"""

daily = """
daily AS (
  SELECT d.full_date AS ds, CAST(SUM(f.quantity_ordered) AS DOUBLE) AS y
  FROM fact_orders f JOIN dim_date d ON f.date_id = d.date_id
  GROUP BY d.full_date
)"""

daily_cat = """
daily_cat AS (
  SELECT p.category, d.full_date AS ds, CAST(SUM(f.quantity_ordered) AS DOUBLE) AS y
  FROM fact_orders f JOIN dim_date d ON f.date_id = d.date_id
  JOIN dim_product p ON f.product_id = p.product_id
  GROUP BY p.category, d.full_date
)"""


def _rolling(src: str, keys: list[str], segment: bool = False) -> str:
    k = ", ".join(keys)
    kc = (k + ", ") if keys else ""
    part = f"PARTITION BY {k} " if keys else ""
    seg_h = ", 'actual' AS segment" if segment else ""
    seg_f = ", 'forecast' AS segment" if segment else ""
    return f"""
last30 AS (
  SELECT * FROM (SELECT *, row_number() OVER ({part}ORDER BY ds DESC) AS rn FROM {src}) WHERE rn <= 30
),
stats AS (
  SELECT {kc}MAX(ds) AS last_ds, CASE WHEN COUNT(y) = 30 THEN AVG(y) END AS m
  FROM last30 {('GROUP BY ' + k) if keys else ''}
),
fut AS (
  SELECT {kc}CAST(unnest(generate_series(last_ds + INTERVAL 1 DAY, last_ds + INTERVAL 90 DAY, INTERVAL 1 DAY)) AS DATE) AS date, m
  FROM stats
),
forecast AS (
  SELECT {kc}ds AS date, y AS forecast_qty, y * 0.85::DOUBLE AS lower_bound, y * 1.15::DOUBLE AS upper_bound{seg_h} FROM {src}
  UNION ALL
  SELECT {kc}date, m AS forecast_qty, m * 0.85::DOUBLE AS lower_bound, m * 1.15::DOUBLE AS upper_bound{seg_f} FROM fut
)"""


def _seasonal(src: str, keys: list[str]) -> str:
    k = ", ".join(keys)
    kc = (k + ", ") if keys else ""
    part = f"PARTITION BY {k}" if keys else ""
    pk = (k + ", ") if keys else ""
    return f"""
ends AS (SELECT {kc}MAX(ds) AS last_ds FROM {src} {('GROUP BY ' + k) if keys else ''}),
fut AS (
  SELECT {kc}CAST(unnest(generate_series(last_ds + INTERVAL 1 DAY, last_ds + INTERVAL 90 DAY, INTERVAL 1 DAY)) AS DATE) AS ds,
         CAST(NULL AS DOUBLE) AS y
  FROM ends
),
allrows AS (
  SELECT {kc}ds, y, CAST(date_diff('day', DATE '1970-01-01', ds) AS DOUBLE) AS x,
         dayofweek(ds) AS dow, month(ds) AS mon
  FROM (SELECT {kc}ds, y FROM {src} UNION ALL SELECT {kc}ds, y FROM fut)
),
trended AS (
  SELECT *, regr_intercept(y, x) OVER ({part}) + regr_slope(y, x) OVER ({part}) * x AS trend FROM allrows
),
ratios AS (SELECT *, y / CASE WHEN trend > 0 THEN trend END AS ratio FROM trended),
wix AS (SELECT *, AVG(ratio) OVER (PARTITION BY {pk}dow) AS wi FROM ratios),
mix AS (SELECT *, AVG(ratio / NULLIF(wi, 0)) OVER (PARTITION BY {pk}mon) AS mi FROM wix),
fitted AS (SELECT *, trend * COALESCE(wi, 1.0::DOUBLE) * COALESCE(mi, 1.0::DOUBLE) AS yhat FROM mix),
banded AS (SELECT *, 1.2816::DOUBLE * STDDEV_SAMP(y - yhat) OVER ({part}) AS band FROM fitted),
forecast AS (
  SELECT {kc}ds AS date,
         {pround(clip('yhat', 0, None), 0)} AS forecast_qty,
         {pround(clip('yhat - band', 0, None), 0)} AS lower_bound,
         {pround('yhat + band', 0)} AS upper_bound
  FROM banded
)"""


def _gram(src: str, keys: list[str]) -> str:
    """Sums of products of the model forecast's features, as whole numbers."""
    c = Curve()
    kc = "".join(k + ", " for k in keys)
    part = f"PARTITION BY {', '.join(keys)}" if keys else ""
    whole = lambda e, unit=FEATURE_UNIT: f"CAST(floor(({e}) * {unit}.0::DOUBLE + 0.5::DOUBLE) AS BIGINT)"
    knots = [whole(f"greatest(t - {(k + 1) / (c.knots + 1) * c.knot_share!r}::DOUBLE, 0.0::DOUBLE)") for k in range(c.knots)]
    waves = [f"{fn}(x * {a!r}::DOUBLE)" for a in wave_angles(c) for fn in ("sin", "cos")]
    cells = [str(FEATURE_UNIT), whole("t"), *knots, *map(whole, waves), *[whole(w + " * t") for w in waves], whole("y", VALUE_UNIT)]
    return f"""
spans AS (SELECT *, MIN(ds) OVER ({part}) AS first_ds, MAX(ds) OVER ({part}) AS last_ds FROM {src} WHERE y IS NOT NULL),
scaled AS (
  SELECT {kc}y, CAST(ds - DATE '1970-01-01' AS DOUBLE) AS x,
         CAST(ds - first_ds AS DOUBLE) / CAST(greatest(last_ds - first_ds, 1) AS DOUBLE) AS t,
         last_ds - first_ds >= {3 * c.horizon} AND last_ds - ds < {c.horizon} AS held
  FROM spans
),
cells AS (SELECT {kc}held, [{', '.join(cells)}] AS f FROM scaled),
firsts_of AS (SELECT {kc}held, f, unnest(generate_series(1, len(f))) AS i FROM cells),
pairs AS (SELECT {kc}held, f, i, unnest(generate_series(i, len(f))) AS j FROM firsts_of)
SELECT {kc}held, CAST(i - 1 AS INTEGER) AS i, CAST(j - 1 AS INTEGER) AS j,
       CAST(SUM(CAST(f[i] AS HUGEINT) * CAST(f[j] AS HUGEINT)) AS DOUBLE) AS total
FROM pairs GROUP BY {kc}held, i, j"""


def _with(*ctes: str) -> str:
    return PREFIX + "".join("," + c for c in ctes) + "\n"


def _by_product(select: str, order: str = "") -> str:
    return (
        PREFIX
        + f"SELECT {select} FROM fact_orders f JOIN dim_product p ON f.product_id = p.product_id "
        + f"GROUP BY p.product_name, p.category {order}"
    )


def _by_supplier(select: str, order: str = "") -> str:
    return (
        PREFIX
        + f"SELECT {select} FROM fact_orders f JOIN dim_supplier s ON f.supplier_id = s.supplier_id "
        + f"GROUP BY s.supplier_name, s.reliability {order}"
    )


def _by_region(select: str, order: str = "") -> str:
    return (
        PREFIX
        + f"SELECT {select} FROM fact_orders f JOIN dim_region r ON f.region_id = r.region_id "
        + f"GROUP BY r.region_name {order}"
    )


def _by_month(select: str, order: str = "") -> str:
    return (
        PREFIX
        + f"SELECT {select} FROM fact_orders f JOIN dim_date d ON f.date_id = d.date_id "
        + f"GROUP BY d.year, d.month, d.month_name {order}"
    )


def _profile_col(name: str, expr: str, unit: str) -> str:
    return f"""
  SELECT '{name}' AS column_name, COUNT(v) AS count,
         CAST(SUM(CAST(v AS HUGEINT)) AS DOUBLE) / COUNT(v) / {unit} AS mean,
         CAST(ROUND(CAST(sqrt(CASE WHEN COUNT(v) > 1 THEN
              CAST(CAST(COUNT(v) AS HUGEINT) * SUM(CAST(v AS HUGEINT) * CAST(v AS HUGEINT)) - SUM(CAST(v AS HUGEINT)) * SUM(CAST(v AS HUGEINT)) AS DOUBLE)
              / (CAST(COUNT(v) AS DOUBLE) * CAST(COUNT(v) - 1 AS DOUBLE)) END) / {unit} AS DECIMAL(28,10)), 6) AS DOUBLE) AS std,
         CAST(MIN(v) AS DOUBLE) / {unit} AS min,
         quantile_cont(v, 0.25) / {unit} AS p25,
         quantile_cont(v, 0.5) / {unit} AS p50,
         quantile_cont(v, 0.75) / {unit} AS p75,
         CAST(MAX(v) AS DOUBLE) / {unit} AS max
  FROM (SELECT {expr} AS v FROM raw_orders)"""


def oracle_sql() -> dict[str, str]:
    q: dict[str, str] = {}
    q["enrich_orders"] = PREFIX + f"SELECT {RAW_COLS} FROM raw_orders"
    q["clean_orders"] = PREFIX + "SELECT * FROM orders_clean"
    q["profile_orders"] = PREFIX + " UNION ALL ".join(
        [
            _profile_col("quantity_ordered", "CAST(quantity_ordered AS BIGINT)", "1.0::DOUBLE"),
            _profile_col("lead_time_days", "CAST(lead_time_days AS BIGINT)", "1.0::DOUBLE"),
            _profile_col("warehouse_stock", "CAST(warehouse_stock AS BIGINT)", "1.0::DOUBLE"),
            _profile_col("delay_days", "CAST(delay_days AS BIGINT)", "1.0::DOUBLE"),
            _profile_col("actual_delivery_days", "CAST(actual_delivery_days AS BIGINT)", "1.0::DOUBLE"),
            _profile_col("unit_cost", "CAST(round_even(unit_cost * 100.0::DOUBLE, 0) AS BIGINT)", "100.0::DOUBLE"),
            _profile_col(
                "total_cost",
                "CAST(quantity_ordered AS BIGINT) * CAST(round_even(unit_cost * 100.0::DOUBLE, 0) AS BIGINT)",
                "100.0::DOUBLE",
            ),
        ]
    )
    q["feed_summary"] = PREFIX + f"""
SELECT COUNT(*) AS total_orders, CAST(13 AS BIGINT) AS n_columns,
       '{RAW_COLS.replace(", ", ",")}' AS column_list,
       CAST(ROUND(SUM(CAST(quantity_ordered AS DECIMAL(18,0)) * CAST(unit_cost AS DECIMAL(18,2))), 0) AS DOUBLE) AS total_value,
       CAST(SUM(CAST(is_delayed AS INTEGER)) AS BIGINT) AS delayed_orders,
       {sround('AVG(CAST(is_delayed AS INTEGER)) * 100', 1)} AS delayed_pct,
       MIN(order_date) AS first_order_date, MAX(order_date) AS last_order_date
FROM raw_orders"""
    q["inventory_snapshot"] = PREFIX + f"""
SELECT *, CASE WHEN avg_stock < reorder_point THEN 'Low Stock' ELSE 'Adequate' END AS stock_status
FROM (
  SELECT product_name, AVG(warehouse_stock) AS avg_stock,
         CAST(SUM(quantity_ordered) AS BIGINT) AS total_ordered,
         CAST(SUM(CAST(quantity_ordered AS DECIMAL(18,0)) * CAST(unit_cost AS DECIMAL(18,2))) AS DOUBLE) AS total_cost,
         AVG(lead_time_days) AS avg_lead_time,
         {pround('AVG(lead_time_days) * (SUM(quantity_ordered) / 730)', 0)} AS reorder_point
  FROM raw_orders GROUP BY product_name)"""
    text = PREFIX + TEXT_FEED
    cells = (
        "order_date", "quantity_ordered", "unit_cost", "lead_time_days", "warehouse_stock", "delay_days", "total_cost",
        "actual_delivery_days", "is_delayed",
    )
    q["text_bad_cells"] = text + " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, COUNT(*) FILTER (WHERE {'quantity_bad' if c == 'quantity_ordered' else 'false'}) AS bad_cells FROM text_orders"
        for c in cells
    )
    typed = lambda sql: text + sql.removeprefix(PREFIX).replace("raw_orders", "text_orders")
    q["text_profile_orders"] = typed(q["profile_orders"]).replace(
        "CAST(quantity_ordered AS BIGINT) * CAST(round_even(unit_cost * 100.0::DOUBLE, 0) AS BIGINT)",
        "CAST(round_even(total_cost * 100.0::DOUBLE, 0) AS BIGINT)",
    )
    value = "CAST(quantity_ordered AS DECIMAL(18,0)) * CAST(unit_cost AS DECIMAL(18,2))"
    q["text_feed_summary"] = typed(q["feed_summary"]).replace(value, "CAST(total_cost AS DECIMAL(18,2))")
    q["text_inventory_snapshot"] = typed(q["inventory_snapshot"]).replace(value, "CAST(total_cost AS DECIMAL(18,2))").replace(
        "FROM text_orders GROUP BY", "FROM text_orders WHERE product_name IS NOT NULL GROUP BY"
    )
    # The cleaned orders of the text feed: the rows of text_orders through the rules of orders_clean.
    firsts, cleaned = PREFIX[PREFIX.index("firsts AS ("):PREFIX.index("orders_clean AS (")], PREFIX[PREFIX.index("orders_clean AS ("):PREFIX.index("dim_date AS (")]
    q["text_clean_orders"] = (
        text + "," + firsts.replace("firsts", "text_firsts").replace("raw_orders", "text_orders")
        + cleaned.replace("orders_clean", "text_clean").replace("FROM firsts", "FROM text_firsts").rstrip().rstrip(",")
        + " SELECT * FROM text_clean"
    )
    for t in ("dim_date", "dim_product", "dim_supplier", "dim_region", "fact_orders"):
        q[t] = PREFIX + f"SELECT * FROM {t}"
    q["export_mart"] = PREFIX + """
SELECT p.product_name, p.category, r.region_name, s.supplier_name, s.reliability,
       d.year, d.month, d.month_name, d.quarter,
       f.quantity_ordered, f.total_cost, f.lead_time_days, f.actual_delivery_days,
       f.delay_days, f.is_delayed, f.warehouse_stock
FROM fact_orders f
JOIN dim_product p ON f.product_id = p.product_id
JOIN dim_supplier s ON f.supplier_id = s.supplier_id
JOIN dim_region r ON f.region_id = r.region_id
JOIN dim_date d ON f.date_id = d.date_id"""
    q["validate_schema"] = PREFIX + f"""
SELECT "check", value FROM (
  SELECT 1 AS o, 'Total orders' AS "check", CAST(COUNT(*) AS DOUBLE) AS value FROM fact_orders
  UNION ALL SELECT 2, 'Unique products', CAST(COUNT(*) AS DOUBLE) FROM dim_product
  UNION ALL SELECT 3, 'Unique suppliers', CAST(COUNT(*) AS DOUBLE) FROM dim_supplier
  UNION ALL SELECT 4, 'Delayed order %', {sround('AVG(is_delayed) * 100', 1)} FROM fact_orders
  UNION ALL SELECT 5, 'Avg lead time (days)', {sround('AVG(lead_time_days)', 1)} FROM fact_orders
  UNION ALL SELECT 6, 'Total revenue', {money('total_cost')} FROM fact_orders
  UNION ALL SELECT 7, 'Null product_ids', CAST(COUNT(*) AS DOUBLE) FROM fact_orders WHERE product_id IS NULL
) ORDER BY o"""
    q["fact_null_cells"] = PREFIX + """
SELECT CAST(SUM((order_id IS NULL)::INT + (date_id IS NULL)::INT + (product_id IS NULL)::INT
    + (supplier_id IS NULL)::INT + (region_id IS NULL)::INT + (quantity_ordered IS NULL)::INT
    + (unit_cost IS NULL)::INT + (total_cost IS NULL)::INT + (lead_time_days IS NULL)::INT
    + (actual_delivery_days IS NULL)::INT + (delay_days IS NULL)::INT + (is_delayed IS NULL)::INT
    + (warehouse_stock IS NULL)::INT) AS BIGINT) AS null_cells FROM fact_orders"""
    fk_rows = []
    for fk, dim in (("date_id", "dim_date"), ("product_id", "dim_product"), ("supplier_id", "dim_supplier"), ("region_id", "dim_region")):
        fk_rows.append(
            f"SELECT '{fk}' AS fk_column, '{dim}' AS dim_table, "
            f"CAST(COUNT(*) FILTER (WHERE f.{fk} IS NULL) AS BIGINT) AS null_refs, "
            f"CAST(COUNT(*) FILTER (WHERE f.{fk} IS NOT NULL AND d.{fk} IS NULL) AS BIGINT) AS orphan_refs "
            f"FROM fact_orders f LEFT JOIN {dim} d ON f.{fk} = d.{fk}"
        )
    q["dq_foreign_keys"] = PREFIX + " UNION ALL ".join(fk_rows)
    cons = []
    specs = [
        ("dim_date", "date_id", None, ["full_date"]),
        ("dim_product", "product_id", "product_name", ["product_name"]),
        ("dim_supplier", "supplier_id", "supplier_name", ["supplier_name"]),
        ("dim_region", "region_id", "region_name", ["region_name"]),
        ("fact_orders", "order_id", None, []),
    ]
    for t, pk, uq, nn in specs:
        cons.append(f"SELECT '{t}' AS table_name, 'PRIMARY KEY' AS constraint_type, '{pk}' AS column_name, CAST(COUNT({pk}) - COUNT(DISTINCT {pk}) AS BIGINT) AS violations FROM {t}")
        cons.append(f"SELECT '{t}', 'NOT NULL', '{pk}', CAST(COUNT(*) - COUNT({pk}) AS BIGINT) FROM {t}")
        if uq:
            cons.append(f"SELECT '{t}', 'UNIQUE', '{uq}', CAST(COUNT({uq}) - COUNT(DISTINCT {uq}) AS BIGINT) FROM {t}")
        for c in nn:
            cons.append(f"SELECT '{t}', 'NOT NULL', '{c}', CAST(COUNT(*) - COUNT({c}) AS BIGINT) FROM {t}")
    q["dq_constraints"] = PREFIX + " UNION ALL ".join(cons)

    q["inventory_kpis"] = _with(inventory_base) + "SELECT * FROM inventory_kpis ORDER BY total_revenue DESC, product_name"
    q["inventory_alerts"] = _with(inventory_base) + (
        "SELECT product_name, stock_status, days_of_stock, days_of_stock < 30 AS below_threshold FROM inventory_kpis"
    )
    q["inventory_health"] = _with(inventory_base) + (
        "SELECT product_name, avg_stock, reorder_point, days_of_stock, stock_status FROM inventory_kpis"
    )
    q["supplier_risk"] = _with(supplier_risk_base) + "SELECT * FROM supplier_risk ORDER BY delay_rate_pct DESC, supplier_name"
    q["supplier_risk_view"] = _with(supplier_risk_base) + (
        "SELECT supplier_name, delay_rate_pct, avg_lead_time, risk_score, risk_label FROM supplier_risk"
    )
    q["cost_variance"] = _with(cost_variance_base) + "SELECT * FROM cost_variance ORDER BY year, month, category"
    q["monthly_category_spend"] = _with(cost_variance_base) + """
SELECT month,
       COALESCE(SUM(planned_spend) FILTER (WHERE category = 'Accessories'), 0.0) AS "Accessories",
       COALESCE(SUM(planned_spend) FILTER (WHERE category = 'Devices'), 0.0) AS "Devices",
       COALESCE(SUM(planned_spend) FILTER (WHERE category = 'Hardware'), 0.0) AS "Hardware",
       COALESCE(SUM(planned_spend) FILTER (WHERE category = 'Metalwork'), 0.0) AS "Metalwork",
       COALESCE(SUM(planned_spend) FILTER (WHERE category = 'Other'), 0.0) AS "Other"
FROM cost_variance GROUP BY month ORDER BY month"""
    q["monthly_on_time"] = _with(cost_variance_base) + """
SELECT month, rate AS on_time_rate, 80.0::DOUBLE AS sla_target, rate < 80.0::DOUBLE AS below_sla,
       GREATEST(80.0::DOUBLE - rate, 0.0::DOUBLE) AS sla_gap
FROM (SELECT month, CAST(SUM(CAST(round_even(on_time_rate * 10.0::DOUBLE, 0) AS BIGINT)) AS DOUBLE) / COUNT(*) / 10.0::DOUBLE AS rate
      FROM cost_variance WHERE on_time_rate IS NOT NULL GROUP BY month) ORDER BY month"""
    q["kpi_summary"] = _with(kpi_long) + """
SELECT CASE metric
         WHEN 'total_orders' THEN 'Total Orders' WHEN 'total_revenue' THEN 'Total Revenue'
         WHEN 'avg_order_value' THEN 'Avg Order Value' WHEN 'on_time_rate_pct' THEN 'On Time Rate Pct'
         WHEN 'avg_lead_time_days' THEN 'Avg Lead Time Days' WHEN 'avg_delay_days' THEN 'Avg Delay Days'
         WHEN 'critical_stock_items' THEN 'Critical Stock Items' WHEN 'high_risk_suppliers' THEN 'High Risk Suppliers'
       END AS "KPI", value AS "Value"
FROM kpi_long WHERE metric <> 'total_delayed_orders'"""
    q["executive_kpis"] = _with(kpi_long) + """
SELECT CAST(MAX(value) FILTER (WHERE metric = 'total_orders') AS BIGINT) AS total_orders,
       MAX(value) FILTER (WHERE metric = 'total_revenue') AS total_revenue,
       MAX(value) FILTER (WHERE metric = 'avg_order_value') AS avg_order_value,
       MAX(value) FILTER (WHERE metric = 'on_time_rate_pct') AS on_time_rate_pct,
       MAX(value) FILTER (WHERE metric = 'avg_lead_time_days') AS avg_lead_time_days,
       MAX(value) FILTER (WHERE metric = 'avg_delay_days') AS avg_delay_days,
       CAST(MAX(value) FILTER (WHERE metric = 'total_delayed_orders') AS BIGINT) AS total_delayed_orders,
       CAST(MAX(value) FILTER (WHERE metric = 'high_risk_suppliers') AS BIGINT) AS high_risk_suppliers,
       CAST(MAX(value) FILTER (WHERE metric = 'critical_stock_items') AS BIGINT) AS critical_stock_items
FROM kpi_long"""
    q["kpi_by_region"] = _by_region(
        f"r.region_name, COUNT(f.order_id) AS total_orders, {money('f.total_cost')} AS total_revenue, "
        f"{sround(_RATE + '*100', 1)} AS delay_rate_pct",
        "ORDER BY total_revenue DESC, r.region_name",
    )
    q["kpi_by_product"] = _by_product(
        f"p.product_name, p.category, CAST(SUM(f.quantity_ordered) AS BIGINT) AS total_qty, "
        f"{money('f.total_cost')} AS total_revenue, {sround('AVG(f.warehouse_stock)', 0)} AS avg_stock, "
        f"{sround('AVG(f.lead_time_days)', 1)} AS avg_lead_time",
        "ORDER BY total_revenue DESC, p.product_name",
    )
    q["kpi_monthly_trend"] = _by_month(
        f"d.year, d.month, d.month_name, COUNT(f.order_id) AS total_orders, {money('f.total_cost')} AS total_revenue, "
        f"{sround(_RATE + '*100', 1)} AS delay_rate_pct",
        "ORDER BY d.year, d.month",
    )
    q["daily_demand"] = _with(daily) + "SELECT ds, y FROM daily ORDER BY ds"
    q["forecast_rolling"] = _with(daily, _rolling("daily", [])) + "SELECT * FROM forecast"
    q["forecast_segments"] = _with(daily, _rolling("daily", [], segment=True)) + (
        "SELECT * FROM forecast WHERE forecast_qty IS NOT NULL AND lower_bound IS NOT NULL AND upper_bound IS NOT NULL"
    )
    q["forecast_tail"] = _with(daily, _rolling("daily", [])) + """
SELECT date, forecast_qty, lower_bound, upper_bound FROM (
  SELECT * FROM forecast ORDER BY date DESC LIMIT 10)
WHERE date > (SELECT MAX(date) FROM forecast) - INTERVAL 90 DAY ORDER BY date"""
    q["forecast_seasonal"] = _with(daily, _seasonal("daily", [])) + "SELECT * FROM forecast"
    q["forecast_rolling_by_category"] = _with(daily_cat, _rolling("daily_cat", ["category"])) + "SELECT * FROM forecast"
    q["forecast_seasonal_by_category"] = _with(daily_cat, _seasonal("daily_cat", ["category"])) + "SELECT * FROM forecast"

    q["forecast_gram"] = _with(daily, _gram("daily", []))
    q["forecast_gram_by_category"] = _with(daily_cat, _gram("daily_cat", ["category"]))

    q["stg_monthly_volume"] = _by_month(
        f"d.year, d.month_name, d.month, COUNT(f.order_id) AS total_orders, "
        f"CAST(SUM(f.quantity_ordered) AS BIGINT) AS total_units, {money('f.total_cost')} AS total_revenue",
        "ORDER BY d.year, d.month",
    )
    q["stg_supplier_performance"] = _by_supplier(
        f"s.supplier_name, s.reliability, COUNT(f.order_id) AS total_orders, "
        f"{sround('AVG(f.lead_time_days)', 1)} AS avg_lead_time, {sround('AVG(f.actual_delivery_days)', 1)} AS avg_actual_days, "
        f"{sround(_RATE + ' * 100', 1)} AS delay_rate_pct, {money('f.total_cost')} AS total_value",
        "ORDER BY delay_rate_pct DESC, s.supplier_name",
    )
    q["stg_product_profitability"] = _by_product(
        f"p.product_name, p.category, COUNT(f.order_id) AS order_count, CAST(SUM(f.quantity_ordered) AS BIGINT) AS total_qty, "
        f"{sround(money_avg('f.unit_cost'), 2)} AS avg_unit_cost, {money('f.total_cost')} AS total_revenue, "
        f"{sround('AVG(f.warehouse_stock)', 0)} AS avg_stock",
        "ORDER BY total_revenue DESC, p.product_name",
    )
    q["stg_region_performance"] = _by_region(
        f"r.region_name, COUNT(f.order_id) AS total_orders, {money('f.total_cost')} AS total_revenue, "
        f"{sround('AVG(f.delay_days)', 1)} AS avg_delay_days, {sround(_RATE + '*100', 1)} AS delay_rate_pct",
        "ORDER BY total_revenue DESC, r.region_name",
    )
    q["stg_stock_alert"] = _by_product(
        f"p.product_name, p.category, {sround('AVG(f.warehouse_stock)', 0)} AS current_stock, "
        f"{sround('AVG(f.lead_time_days)', 0)} AS avg_lead_time, COUNT(f.order_id) AS monthly_demand, "
        "CASE WHEN AVG(f.warehouse_stock) < 100 THEN 'CRITICAL' WHEN AVG(f.warehouse_stock) < 250 THEN 'LOW' "
        "ELSE 'ADEQUATE' END AS stock_status",
        "ORDER BY current_stock ASC, p.product_name",
    )
    q["stg_cost_variance"] = _by_product(
        f"p.product_name, {sround('AVG(f.lead_time_days)', 1)} AS planned_days, "
        f"{sround('AVG(f.actual_delivery_days)', 1)} AS actual_days, "
        f"{sround('AVG(f.actual_delivery_days) - AVG(f.lead_time_days)', 1)} AS avg_variance_days, "
        f"{money('f.total_cost')} AS total_spend",
        "ORDER BY avg_variance_days DESC, p.product_name",
    )
    q["sql_overall_health"] = PREFIX + f"""
SELECT COUNT(*) AS total_orders, {money('total_cost')} AS total_revenue,
       {sround(money_avg('total_cost'), 0)} AS avg_order_value,
       {sround('(1 - AVG(is_delayed))*100', 1)} AS on_time_rate_pct,
       {sround('AVG(lead_time_days)', 1)} AS avg_lead_time,
       {sround('AVG(delay_days)', 2)} AS avg_delay_days
FROM fact_orders"""
    q["sql_monthly_revenue"] = PREFIX + f"""
SELECT year, month_name, orders, revenue FROM (
  SELECT d.year, d.month, d.month_name, COUNT(f.order_id) AS orders, {money('f.total_cost')} AS revenue
  FROM fact_orders f JOIN dim_date d ON f.date_id = d.date_id
  GROUP BY d.year, d.month, d.month_name) ORDER BY year, month"""
    q["sql_top_products"] = _by_product(
        f"p.product_name, p.category, {money('f.total_cost')} AS revenue, CAST(SUM(f.quantity_ordered) AS BIGINT) AS units_sold",
        "ORDER BY revenue DESC, p.product_name LIMIT 5",
    )
    q["sql_supplier_leaderboard"] = _by_supplier(
        f"s.supplier_name, s.reliability, {sround(_RATE + '*100', 1)} AS delay_rate_pct, "
        f"{sround('AVG(f.lead_time_days)', 1)} AS avg_lead_days, COUNT(f.order_id) AS total_orders",
        "ORDER BY delay_rate_pct DESC, s.supplier_name",
    )
    q["sql_region_sla"] = _by_region(
        f"r.region_name, {money('f.total_cost')} AS revenue, {sround(_RATE + '*100', 1)} AS delay_pct, "
        f"{sround('(1-' + _RATE + ')*100', 1)} AS on_time_pct",
        "ORDER BY on_time_pct DESC, r.region_name",
    )
    q["sql_top_products_orders"] = _by_product(
        f"p.product_name, p.category, COUNT(f.order_id) AS orders, {money('f.total_cost')} AS revenue",
        "ORDER BY revenue DESC, p.product_name LIMIT 5",
    )
    q["kpi_sliced"] = PREFIX + f"""
SELECT d.year, p.category, {money('f.total_cost')} AS total_revenue,
       {sround('(1 - AVG(f.is_delayed)) * 100', 1)} AS on_time_rate_pct,
       COUNT(f.order_id) AS total_orders, {sround('AVG(f.lead_time_days)', 1)} AS avg_lead_time
FROM fact_orders f JOIN dim_date d ON f.date_id = d.date_id JOIN dim_product p ON f.product_id = p.product_id
GROUP BY d.year, p.category ORDER BY d.year, p.category"""
    keep = (
        ", shown AS (SELECT f.* FROM fact_orders f JOIN dim_product p ON f.product_id = p.product_id "
        "WHERE f.date_id // 10000 IN (1996, 1997) AND p.category IN ('Hardware', 'Other'))\n"
    )
    for name, source in (
        ("sliced_cards", "kpi_sliced"),
        ("sliced_by_region", "kpi_by_region"),
        ("sliced_by_product", "kpi_by_product"),
        ("sliced_monthly_trend", "kpi_monthly_trend"),
        ("sliced_supplier_leaderboard", "sql_supplier_leaderboard"),
        ("sliced_stock_alert", "stg_stock_alert"),
    ):
        report = q[source].removeprefix(PREFIX)
        assert "fact_orders f" in report
        q[name] = PREFIX + keep + report.replace("fact_orders f", "shown f")
    q["revenue_concentration"] = PREFIX + f"""
, per AS (
  SELECT p.product_name, SUM(CAST(f.total_cost AS DECIMAL(18,2))) AS rev
  FROM fact_orders f JOIN dim_product p ON f.product_id = p.product_id GROUP BY p.product_name
), ranked AS (
  SELECT product_name, rev, row_number() OVER (ORDER BY rev DESC, product_name) AS revenue_rank,
         SUM(rev) OVER (ORDER BY rev DESC, product_name ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum,
         SUM(rev) OVER () AS tot
  FROM per
)
SELECT CAST(revenue_rank AS INTEGER) AS revenue_rank, product_name, {sround('CAST(rev AS DOUBLE)', 0)} AS total_revenue,
       {sround('CAST(rev * 100 AS DOUBLE) / CAST(tot * 100 AS DOUBLE) * 100', 2)} AS revenue_share_pct,
       {sround('CAST(cum * 100 AS DOUBLE) / CAST(tot * 100 AS DOUBLE) * 100', 2)} AS cumulative_share_pct
FROM ranked WHERE revenue_rank <= 3 ORDER BY revenue_rank"""
    q["delay_per_affected"] = PREFIX + f"""
SELECT CAST(SUM(is_delayed) AS BIGINT) AS delayed_orders, {sround('AVG(is_delayed) * 100', 1)} AS delayed_pct,
       {sround('AVG(CASE WHEN delay_days > 0 THEN delay_days END)', 1)} AS avg_delay_per_affected
FROM fact_orders"""
    q["kpi_targets"] = _with(kpi_long, inventory_base, supplier_risk_base) + f"""
, vals AS (
  SELECT metric, value FROM kpi_long WHERE metric IN ('on_time_rate_pct', 'avg_lead_time_days', 'critical_stock_items')
  UNION ALL SELECT 'avg_inventory_turnover', {sround('AVG(inventory_turnover)', 2)} FROM inventory_kpis
  UNION ALL SELECT 'max_supplier_risk_score', MAX(risk_score) FROM supplier_risk
), spec AS (
  SELECT * FROM (VALUES ('on_time_rate_pct', '>=', 80.0::DOUBLE, 1), ('avg_lead_time_days', '<=', 20.0::DOUBLE, 2),
                        ('avg_inventory_turnover', '>=', 6.0::DOUBLE, 3), ('max_supplier_risk_score', '<=', 30.0::DOUBLE, 4),
                        ('critical_stock_items', '<=', 0.0::DOUBLE, 5)) t(metric, comparator, target, o)
)
SELECT v.metric, v.value, s.comparator, s.target,
       CASE WHEN (CASE WHEN s.comparator = '>=' THEN v.value >= s.target ELSE v.value <= s.target END)
            THEN 'MET' ELSE 'NOT MET' END AS status
FROM vals v JOIN spec s ON v.metric = s.metric ORDER BY s.o"""
    return q

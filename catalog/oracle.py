"""SQL twins of the registered queries, for DuckDB over the same files."""

from __future__ import annotations

from shelf.operators.features import MODEL_FEATURES

SEQ = "l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_tax"

RAW = f"""
base AS (
  SELECT CAST(l_shipdate AS DATE) AS date, r_name AS store,
         concat('CAT_', CAST(CAST(substr(p_brand, 7) AS INT) % 5 AS VARCHAR)) AS category,
         p_brand AS product, l_extendedprice / l_quantity AS unit_price,
         l_discount AS discount_pct, CAST(l_quantity AS INT) AS demand, {SEQ}
  FROM lineitem
  JOIN part ON l_partkey = p_partkey
  JOIN orders ON l_orderkey = o_orderkey
  JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey
  JOIN region ON n_regionkey = r_regionkey),
summed AS (
  SELECT *, CAST(SUM(demand) OVER (PARTITION BY store, product ORDER BY date, {SEQ}
                                   ROWS UNBOUNDED PRECEDING) AS BIGINT) AS cum
  FROM base),
sold AS (
  SELECT *, least(CAST(demand AS BIGINT), 500 - ((cum - demand) % 500)) AS actual_sales,
         unit_price * (1 - discount_pct) AS effective_price,
         500 - (cum % 500) AS current_stock
  FROM summed),
raw AS (
  SELECT date, store, category, product, unit_price, discount_pct, effective_price, demand,
         actual_sales, demand - actual_sales AS lost_sales,
         actual_sales * effective_price AS revenue, current_stock,
         CASE WHEN round(discount_pct * 100) >= 8 THEN 1 ELSE 0 END AS is_promotion,
         CASE WHEN demand > actual_sales THEN 1 ELSE 0 END AS stockout_flag, {SEQ}
  FROM sold)"""


def fill(source: str, name: str, columns: str = "", zeroed: str = "") -> str:
    """Gap fill of ``source``; further ``columns`` stay null in gaps, ``zeroed`` ones become zero."""
    extra = "".join(f", d.{c}" for c in columns.split())
    carry = "".join(
        f", last_value({c} IGNORE NULLS) OVER w AS {c}"
        for c in ("category", "unit_price", "current_stock")
    )
    zero = "".join(
        f", coalesce(d.{c}, 0) AS {c}"
        for c in (
            "actual_sales", "demand", "revenue", "is_promotion", "stockout_flag", "discount_pct",
            *zeroed.split(),
        )
    )
    return f"""
{name}_days AS (
  SELECT store, product,
         CAST(unnest(generate_series(CAST(min(date) AS TIMESTAMP), CAST(max(date) AS TIMESTAMP),
                                     INTERVAL 1 DAY)) AS DATE) AS date
  FROM {source} GROUP BY store, product),
{name} AS (
  SELECT date, store, product{carry}{zero}{extra}
  FROM {name}_days AS c LEFT JOIN {source} AS d USING (store, product, date)
  WINDOW w AS (PARTITION BY store, product ORDER BY date ROWS UNBOUNDED PRECEDING))"""


DAILY = f"""
daily AS (
  SELECT date, store, category, product,
         CAST(sum(actual_sales) AS BIGINT) AS actual_sales, CAST(sum(demand) AS BIGINT) AS demand,
         sum(revenue) AS revenue, CAST(sum(lost_sales) AS BIGINT) AS lost_sales, last(current_stock ORDER BY {SEQ}) AS current_stock,
         max(is_promotion) AS is_promotion, max(stockout_flag) AS stockout_flag,
         first(unit_price ORDER BY {SEQ}) AS unit_price, avg(discount_pct) AS discount_pct
  FROM raw GROUP BY date, store, category, product)"""

PANEL = DAILY + "," + fill("daily", "panel", zeroed="lost_sales")

CALENDAR = """CAST(year(date) AS INT) AS year, CAST(month(date) AS INT) AS month,
  CAST(day(date) AS INT) AS day, CAST(isodow(date) - 1 AS INT) AS day_of_week,
  CAST(weekofyear(date) AS INT) AS week_of_year, CAST(quarter(date) AS INT) AS quarter,
  CAST(isodow(date) >= 6 AS INT) AS is_weekend, CAST(day(date) = 1 AS INT) AS is_month_start,
  CAST(last_day(date) = date AS INT) AS is_month_end,
  CAST(dayofyear(date) AS INT) AS day_of_year"""

LAGS = ", ".join(f"lag(actual_sales, {n}) OVER s AS lag_{n}d" for n in (1, 7, 14, 30))
ROLLING = ", ".join(
    f"avg(actual_sales) OVER (s ROWS BETWEEN {n} PRECEDING AND 1 PRECEDING) AS rolling_mean_{n}d, "
    f"stddev_samp(actual_sales) OVER (s ROWS BETWEEN {n} PRECEDING AND 1 PRECEDING) "
    f"AS rolling_std_{n}d"
    for n in (7, 14, 30)
)
EXPANDING = "avg(actual_sales) OVER (s ROWS UNBOUNDED PRECEDING) AS expanding_mean"
PROMO = """is_promotion * is_weekend AS promo_x_weekend, is_promotion * month AS promo_x_month,
  coalesce(lag(is_promotion) OVER s, 0) AS promo_lag1"""
SERIES = "WINDOW s AS (PARTITION BY store, product ORDER BY date)"

SEGMENTS = """
segment_stats AS (
  SELECT store, product, avg(CASE WHEN actual_sales = 0 THEN 1 ELSE 0 END) AS zero_share,
         avg(actual_sales) AS mean, quantile_cont(actual_sales, 0.25) AS q25,
         quantile_cont(actual_sales, 0.75) AS q75
  FROM panel GROUP BY store, product),
segments AS (
  SELECT *, CASE WHEN zero_share > 0.4 THEN 'INTERMITTENT' WHEN mean >= q75 THEN 'HIGH'
                 WHEN mean <= q25 THEN 'LOW' ELSE 'MEDIUM' END AS demand_segment
  FROM segment_stats)"""


def codes(column: str) -> str:
    return f"""
{column}_codes AS (
  SELECT {column}, CAST(row_number() OVER (ORDER BY f) - 1 AS INT) AS {column}_enc
  FROM (SELECT {column}, min(concat_ws(chr(1), store, product, CAST(date AS VARCHAR))) AS f
        FROM panel GROUP BY {column}))"""


CODES = ",".join(codes(c) for c in ("store", "category", "product"))

FEATURES = (
    SEGMENTS + "," + CODES + f""",
dated AS (SELECT *, {CALENDAR} FROM panel),
windowed AS (SELECT *, {LAGS}, {ROLLING}, {EXPANDING}, {PROMO} FROM dated {SERIES}),
features AS (
  SELECT w.*, demand_segment, store_enc, category_enc, product_enc
  FROM windowed AS w
  JOIN segments USING (store, product)
  JOIN store_codes USING (store) JOIN category_codes USING (category)
  JOIN product_codes USING (product)
  WHERE lag_7d IS NOT NULL AND rolling_mean_7d IS NOT NULL)"""
)


def abc(source: str, keys: str, scale: int | None = None, name: str = "abc") -> str:
    share = "total_revenue / sum(total_revenue) OVER () * 100"
    upto = f"sum(revenue_pct) OVER (ORDER BY total_revenue DESC, {keys} ROWS UNBOUNDED PRECEDING)"
    if scale is not None:
        share, upto = f"round_even({share}, {scale})", f"round_even({upto}, {scale})"
    return f"""
{name}_revenue AS (
  SELECT {keys}, sum(revenue) AS total_revenue, CAST(sum(actual_sales) AS BIGINT) AS total_units,
         avg(unit_price) AS avg_unit_price
  FROM {source} GROUP BY {keys}),
{name}_share AS (SELECT *, {share} AS revenue_pct FROM {name}_revenue),
{name}_upto AS (SELECT *, {upto} AS cumulative_pct FROM {name}_share),
{name} AS (
  SELECT *, CASE WHEN cumulative_pct <= 70 THEN 'A' WHEN cumulative_pct <= 90 THEN 'B'
                 ELSE 'C' END AS abc_class
  FROM {name}_upto)"""


FORECAST = """
recent_forecast AS (
  SELECT store, product, avg(actual_sales) AS forecast_avg_daily
  FROM (SELECT *, row_number() OVER (PARTITION BY store, product ORDER BY date DESC) AS rn
        FROM panel) WHERE rn <= 30 GROUP BY store, product)"""


def inventory(ordering_cost: float = 50.0, demand: str = "avg_daily_demand") -> str:
    return (
        abc("panel", "product, category") + "," + FORECAST + f""",
stats AS (
  SELECT store, product, category, avg(actual_sales) AS avg_daily_demand,
         coalesce(stddev_samp(actual_sales), 0) AS std_daily_demand,
         CAST(sum(actual_sales) AS BIGINT) AS total_units_sold, sum(revenue) AS total_revenue,
         first(unit_price ORDER BY date) AS unit_price,
         last(current_stock ORDER BY date) AS current_stock,
         CAST(sum(stockout_flag) AS BIGINT) AS stockout_count, count(date) AS total_days,
         round_even(sum(stockout_flag) / count(date) * 100, 2) AS stockout_rate_pct
  FROM panel GROUP BY store, product, category),
limits AS (
  SELECT s.*, coalesce(f.forecast_avg_daily, avg_daily_demand) AS forecast_avg_daily,
         round_even(1.65 * std_daily_demand * sqrt(7), 2) AS safety_stock
  FROM stats AS s LEFT JOIN recent_forecast AS f USING (store, product)),
thresholds AS (
  SELECT *, round_even({demand} * 7 + safety_stock, 2) AS reorder_point,
         CASE WHEN unit_price > 0 AND {demand} > 0
              THEN round_even(sqrt(2 * {demand} * 365 * {ordering_cost} / (unit_price * 0.25)), 2)
              ELSE 0 END AS eoq
  FROM limits),
status AS (
  SELECT *, CASE WHEN {demand} > 0 THEN round_even(current_stock / {demand}, 1)
                 ELSE 999 END AS days_of_stock,
         current_stock <= reorder_point AS stockout_risk,
         current_stock > reorder_point + eoq * 1.5 AS overstock_flag,
         current_stock <= safety_stock AS low_stock_flag,
         round_even(current_stock * unit_price * 0.25 / 365, 2) AS holding_cost_daily
  FROM thresholds),
risk AS (
  SELECT *, CASE WHEN stockout_risk OR low_stock_flag THEN 'HIGH'
                 WHEN current_stock <= reorder_point * 1.2 THEN 'MEDIUM'
                 WHEN overstock_flag THEN 'OVERSTOCK' ELSE 'HEALTHY' END AS risk_level,
         CASE WHEN stockout_risk THEN round_even(eoq, 0) ELSE 0.0 END AS recommended_order
  FROM status),
inv AS (
  SELECT r.* REPLACE (round_even(avg_daily_demand, 2) AS avg_daily_demand,
                      round_even(std_daily_demand, 2) AS std_daily_demand,
                      CAST(current_stock AS DOUBLE) AS current_stock),
         coalesce(abc_class, 'C') AS abc_class,
         CASE abc_class WHEN 'A' THEN 3 WHEN 'B' THEN 2 ELSE 1 END AS abc_score,
         CASE risk_level WHEN 'HIGH' THEN 3 WHEN 'MEDIUM' THEN 2 WHEN 'OVERSTOCK' THEN 1
                         ELSE 0 END AS risk_score,
         abc_score + risk_score AS priority_score
  FROM risk AS r LEFT JOIN (SELECT product, category, abc_class FROM abc)
       USING (product, category))"""
    )


def shift(digits: int) -> float:
    return 10.0**-digits * 0.2718281828


def sql(select: str, *ctes: str, digits: int = 6, doubles: str = "", **own: int) -> str:
    """``WITH ctes select`` with the named double columns rounded."""
    places = {**{c: digits for c in doubles.split()}, **own}
    body = f"WITH {','.join(ctes)}\n{select}"
    if not places:
        return body
    # Prices end on decimal halves, where the noise of float sums decides how they
    # round; a shift by part of the last place moves all halves aside.
    rounds = ", ".join(f"round({c} + {shift(n)}, {n}) AS {c}" for c, n in places.items())
    return f"SELECT * REPLACE ({rounds}) FROM (\n{body}\n)"


def _rolled(measure: str, days: int) -> str:
    frame = f"(ORDER BY date ROWS BETWEEN {days - 1} PRECEDING AND CURRENT ROW)"
    total = f"CAST(sum({measure}) AS BIGINT)" if measure == "actual_sales" else f"sum({measure})"
    return f"""SELECT *, CASE WHEN count(*) OVER {frame} = {days}
                        THEN avg({measure}) OVER {frame} END AS rolling_{days}d
  FROM (SELECT date, {total} AS {measure} FROM panel GROUP BY date)"""


def _performance(by: str) -> str:
    return f"""SELECT {by}, sum(revenue) AS total_revenue,
  CAST(sum(actual_sales) AS BIGINT) AS total_units,
  CAST(sum(stockout_flag) AS BIGINT) AS stockout_count, sum(revenue) / 1e6 AS revenue_millions
  FROM panel GROUP BY {by}"""


NULLED = f"""
nulled AS (
  SELECT * REPLACE (CASE WHEN l_orderkey % 29 <> 0 THEN date END AS date,
                    CASE WHEN l_orderkey % 17 <> 0 THEN unit_price END AS unit_price,
                    CASE WHEN l_orderkey % 19 <> 0 THEN actual_sales END AS actual_sales,
                    CASE WHEN l_orderkey % 23 <> 0 THEN category END AS category)
  FROM raw)"""

# The numeric columns of the raw rows without the keys that order them.
NUMERIC = (
    "unit_price discount_pct effective_price demand actual_sales lost_sales revenue current_stock "
    "is_promotion stockout_flag"
).split()

IMPUTED = """
dated_rows AS (SELECT * FROM nulled WHERE date IS NOT NULL),
medians AS (SELECT {medians} FROM dated_rows),
imputed AS (
  SELECT d.* REPLACE ({filled}, coalesce(category, 'Unknown') AS category)
  FROM dated_rows AS d, medians)""".format(
    medians=", ".join(f"quantile_cont(CAST({c} AS DOUBLE), 0.5) AS m_{c}" for c in NUMERIC),
    filled=", ".join(f"coalesce(CAST({c} AS DOUBLE), m_{c}) AS {c}" for c in NUMERIC),
)

TYPED = """
typed AS (
  SELECT * REPLACE (CAST(trunc(actual_sales) AS BIGINT) AS actual_sales,
                    CAST(trunc(demand) AS BIGINT) AS demand,
                    CAST(trunc(current_stock) AS BIGINT) AS current_stock,
                    CAST(trunc(is_promotion) AS INTEGER) AS is_promotion,
                    CAST(trunc(stockout_flag) AS INTEGER) AS stockout_flag)
  FROM imputed)"""


def first_rows(source: str, name: str) -> str:
    return f"""
{name} AS (
  SELECT * EXCLUDE (rn)
  FROM (SELECT *, row_number() OVER (PARTITION BY date, store, product ORDER BY {SEQ}) AS rn
        FROM {source}) WHERE rn = 1)"""


def fenced(source: str, name: str, multiplier: float) -> str:
    columns = ("actual_sales", "demand", "revenue")
    quart = ", ".join(
        f"quantile_cont({c}, 0.25) AS q1_{c}, quantile_cont({c}, 0.75) AS q3_{c}" for c in columns
    )
    bounds = ", ".join(
        f"q1_{c} - {multiplier} * (q3_{c} - q1_{c}) AS lo_{c}, "
        f"q3_{c} + {multiplier} * (q3_{c} - q1_{c}) AS hi_{c}"
        for c in columns
    )
    clip = ", ".join(
        f"least(greatest(CAST({c} AS DOUBLE), lo_{c}), hi_{c}) AS {c}" for c in columns
    )
    outside = " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", max(lo_{c}) AS lower, max(hi_{c}) AS upper, "
        f"count(*) FILTER (WHERE {c} < lo_{c} OR {c} > hi_{c}) AS outliers "
        f"FROM {source}, {name}_bounds"
        for c in columns
    )
    return f"""
{name}_quartiles AS (SELECT {quart} FROM {source}),
{name}_bounds AS (SELECT {bounds} FROM {name}_quartiles),
{name} AS (SELECT s.* REPLACE ({clip}) FROM {source} AS s, {name}_bounds),
{name}_counts AS ({outside})"""


SPLIT = """
per_day AS (SELECT date, count(*) AS n FROM features GROUP BY date),
upto AS (SELECT date, sum(n) OVER (ORDER BY date) AS upto, sum(n) OVER () AS total FROM per_day),
cut AS (SELECT min(date) AS split_date FROM upto WHERE upto > floor(total * 0.8::DOUBLE)),
train AS (SELECT * FROM features, cut WHERE date < split_date),
test AS (SELECT * FROM features, cut WHERE date >= split_date)"""

METRICS = """'{name}' AS model, avg(abs(y - p)) AS mae, sqrt(avg((y - p) * (y - p))) AS rmse,
  avg(CASE WHEN y <> 0 THEN abs((y - p) / y) END) * 100 AS mape_pct,
  1 - sum((y - p) * (y - p)) / (var_pop(y) * count(y)) AS r2"""



def _jittered(replicas: int = 2, noise: float = 0.05, seed: int = 42) -> str:
    """Box-Muller over the 52-bit halves of an MD5 of (key, replica, pair of features, seed)."""

    def uniform(digest: str, place: int) -> str:
        return f"CAST(CAST('0x' || substr({digest}, {1 + 13 * place}, 13) AS BIGINT) AS DOUBLE)"

    hashes, moved = [], []
    for i, name in enumerate(MODEL_FEATURES):
        digest = f"h{i // 2}"
        if i % 2 == 0:
            hashes.append(
                f"md5(concat_ws('|', store, product, CAST(date AS VARCHAR), CAST(_replica AS VARCHAR), '{i // 2}', "
                f"'{seed}')) AS {digest}"
            )
        radius = f"sqrt(-2 * ln(({uniform(digest, 0)} + 1) / 4503599627370496))"
        turn = "sin" if i % 2 else "cos"
        normal = f"{radius} * {turn}(2 * pi() * {uniform(digest, 1)} / 4503599627370496)"
        moved.append(
            f"coalesce(CAST({name} AS DOUBLE), 0) + CASE _replica WHEN 0 THEN 0 ELSE {normal} * {noise} END AS {name}"
        )
    return (
        f"SELECT store, product, date, _replica, {', '.join(moved)} FROM (SELECT *, {', '.join(hashes)} FROM ("
        f"SELECT test.*, CAST(r AS INTEGER) AS _replica FROM test, range(0, {replicas + 1}) AS x(r)))"
    )


NAIVE = """
naive AS (
  SELECT avg(actual_sales) AS p
  FROM (SELECT actual_sales FROM train ORDER BY date DESC, store DESC, product DESC LIMIT 7)),
naive_test AS (SELECT t.*, p, CAST(actual_sales AS DOUBLE) AS y FROM test AS t, naive)"""

NAIVE_SERIES = """
naive_series AS (
  SELECT store, product, avg(actual_sales) AS p
  FROM (SELECT *, row_number() OVER (PARTITION BY store, product ORDER BY date DESC) AS rn
        FROM train) WHERE rn <= 7 GROUP BY store, product),
series_test AS (
  SELECT t.*, p, CAST(actual_sales AS DOUBLE) AS y
  FROM test AS t LEFT JOIN naive_series USING (store, product))"""

def _profile() -> str:
    """All columns; numbers and dates have their ends in columns of their own."""
    parts = []
    for c in (*NUMERIC, *SEQ.split(", ")):
        parts.append(
            f"""SELECT '{c}' AS "column", count({c}) AS count, count(*) - count({c}) AS missing,
  (count(*) - count({c})) / count(*) * 100 AS missing_pct, avg({c}) AS mean,
  stddev_samp({c}) AS std, CAST(min({c}) AS DOUBLE) AS min_number, CAST(max({c}) AS DOUBLE) AS max_number,
  CAST(NULL AS VARCHAR) AS min_date, CAST(NULL AS VARCHAR) AS max_date,
  quantile_cont(CAST({c} AS DOUBLE), 0.25) AS q25,
  quantile_cont(CAST({c} AS DOUBLE), 0.5) AS q50, quantile_cont(CAST({c} AS DOUBLE), 0.75) AS q75,
  CAST(NULL AS BIGINT) AS "unique", CAST(NULL AS VARCHAR) AS top, CAST(NULL AS BIGINT) AS freq
  FROM nulled"""
        )
    for c in ("store", "category", "product"):
        parts.append(
            f"""SELECT '{c}', count({c}), count(*) - count({c}),
  (count(*) - count({c})) / count(*) * 100, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, count(DISTINCT {c}),
  (SELECT {c} FROM nulled WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY count(*) DESC, {c} LIMIT 1),
  (SELECT max(n) FROM (SELECT count(*) AS n FROM nulled WHERE {c} IS NOT NULL GROUP BY {c}))
  FROM nulled"""
        )
    parts.append(
        """SELECT 'date', count(date), count(*) - count(date), (count(*) - count(date)) / count(*) * 100,
  NULL, NULL, NULL, NULL, CAST(min(date) AS VARCHAR), CAST(max(date) AS VARCHAR), NULL, NULL, NULL, NULL, NULL, NULL FROM nulled"""
    )
    return " UNION ALL ".join(parts)


def _kpis(facts: str) -> str:
    return f"""SELECT (SELECT count(*) FROM inv) AS store_product_pairs,
  round_even(avg(stockout_flag) * 100, 2) AS stockout_rate_before_pct,
  round_even(avg(stockout_flag) * 100 * (1 - 0.6), 2) AS stockout_rate_after_pct,
  (SELECT count(*) FROM inv WHERE stockout_risk) AS high_risk_items,
  (SELECT count(*) FROM inv WHERE overstock_flag) AS overstock_items,
  CAST(sum(lost_sales) AS BIGINT) AS total_lost_units,
  round_even(sum(lost_sales * unit_price), 0) AS estimated_lost_revenue,
  round_even(sum(lost_sales * unit_price) * 0.6, 0) AS projected_recovery,
  round_even(sum(revenue) / (SELECT avg(current_stock * unit_price) FROM inv), 2)
    AS inventory_turnover,
  round_even(sum(revenue), 0) AS total_revenue FROM {facts}"""


# The numeric columns of the feature table besides the target.
CORRELATED = (
    "year month day day_of_week week_of_year quarter is_weekend is_month_start is_month_end "
    "day_of_year lag_1d lag_7d lag_14d lag_30d rolling_mean_7d rolling_mean_14d rolling_mean_30d "
    "rolling_std_7d rolling_std_14d rolling_std_30d expanding_mean is_promotion promo_x_weekend "
    "promo_x_month promo_lag1 unit_price discount_pct demand revenue lost_sales current_stock stockout_flag "
    "store_enc category_enc product_enc"
).split()


def _correlations() -> str:
    union = " UNION ALL ".join(
        f"SELECT '{c}' AS feature, corr(CAST({c} AS DOUBLE), CAST(actual_sales AS DOUBLE)) "
        "AS correlation FROM features"
        for c in CORRELATED
    )
    return f"SELECT * FROM ({union}) ORDER BY abs(correlation) DESC NULLS LAST, feature LIMIT 15"


FUTURE = """
placed AS (
  SELECT *, row_number() OVER (PARTITION BY store, product ORDER BY date DESC) AS back
  FROM features),
frozen AS (
  SELECT store, product,
         CAST(max(CASE WHEN back = 1 THEN actual_sales END) AS DOUBLE) AS lag_1d,
         CAST(coalesce(max(CASE WHEN back = 7 THEN actual_sales END), 0) AS DOUBLE) AS lag_7d,
         CAST(coalesce(max(CASE WHEN back = 14 THEN actual_sales END), 0) AS DOUBLE) AS lag_14d,
         CAST(coalesce(max(CASE WHEN back = 30 THEN actual_sales END), 0) AS DOUBLE) AS lag_30d,
         avg(CASE WHEN back <= 7 THEN actual_sales END) AS rolling_mean_7d,
         avg(CASE WHEN back <= 14 THEN actual_sales END) AS rolling_mean_14d,
         avg(CASE WHEN back <= 30 THEN actual_sales END) AS rolling_mean_30d,
         CASE WHEN count(*) >= 7 THEN stddev_pop(CASE WHEN back <= 7 THEN actual_sales END)
              ELSE 0 END AS rolling_std_7d,
         CASE WHEN count(*) >= 14 THEN stddev_pop(CASE WHEN back <= 14 THEN actual_sales END)
              ELSE 0 END AS rolling_std_14d,
         avg(CASE WHEN back <= 30 THEN actual_sales END) AS expanding_mean
  FROM placed GROUP BY store, product),
ahead AS (
  SELECT p.store, p.product, p.category, p.unit_price, p.discount_pct, p.store_enc,
         p.category_enc, p.product_enc, CAST(p.date + CAST(h AS INT) AS DATE) AS date
  FROM placed AS p, range(1, 31) AS r(h) WHERE back = 1)"""

SALE_DAYS = """
events(rank, m, d, discount) AS (
  VALUES (0, 1, 26, 0.20), (1, 3, 10, 0.15), (2, 8, 15, 0.18), (3, 10, 24, 0.30),
         (4, 11, 11, 0.35), (5, 12, 25, 0.25))"""

SEASONS = """
seasons(category, m, season) AS (
  VALUES ('CAT_0', 10, 1.8), ('CAT_0', 11, 2.2), ('CAT_0', 12, 2.0), ('CAT_0', 1, 1.3),
         ('CAT_1', 10, 1.4), ('CAT_1', 11, 1.3), ('CAT_1', 4, 1.2), ('CAT_1', 8, 1.2),
         ('CAT_2', 10, 1.9), ('CAT_2', 11, 1.8), ('CAT_2', 2, 1.5), ('CAT_2', 9, 1.4),
         ('CAT_3', 10, 1.6), ('CAT_3', 11, 1.5), ('CAT_3', 1, 1.3),
         ('CAT_4', 4, 1.3), ('CAT_4', 5, 1.3), ('CAT_4', 6, 1.2))"""

PANEL_COLUMNS = (
    "date, store, category, product, actual_sales, demand, revenue, lost_sales, current_stock, is_promotion, "
    "stockout_flag, unit_price, discount_pct"
)
PRICES = "unit_price discount_pct"
STATS = "rolling_mean_7d rolling_std_7d rolling_mean_14d rolling_std_14d rolling_mean_30d rolling_std_30d"
INV_DOUBLES = (
    "avg_daily_demand std_daily_demand unit_price stockout_rate_pct forecast_avg_daily "
    "safety_stock reorder_point eoq days_of_stock holding_cost_daily recommended_order"
)


def oracle_sql() -> dict[str, str]:
    inv = inventory()
    base = (RAW, PANEL)
    feat = (RAW, PANEL, FEATURES)
    split = (*feat, SPLIT)
    stock = (*base, inv)
    return {
        # sources and sinks
        "retail_view": sql("SELECT * FROM raw", RAW, doubles="unit_price effective_price revenue l_extendedprice"),
        "csv_round_trip": sql(f"SELECT {PANEL_COLUMNS} FROM panel", *base, doubles=PRICES, revenue=4),
        "filtered_export": sql(
            "SELECT store, product, category, abc_class, current_stock, safety_stock, "
            "reorder_point, eoq, stockout_rate_pct, risk_level FROM inv "
            "WHERE risk_level IN ('HIGH', 'MEDIUM') AND abc_class IN ('A', 'B')",
            *stock, doubles="safety_stock reorder_point eoq stockout_rate_pct",
        ),
        # cleaning
        "impute": sql("SELECT * FROM imputed", RAW, NULLED, IMPUTED,
                      doubles="unit_price effective_price revenue l_extendedprice"),
        "fix_types": sql("SELECT * FROM typed", RAW, NULLED, IMPUTED, TYPED,
                         doubles="unit_price effective_price revenue l_extendedprice"),
        "dedupe_first": sql("SELECT * FROM firsts", RAW, first_rows("raw", "firsts"),
                            doubles="unit_price effective_price revenue l_extendedprice"),
        "cap_outliers": sql("SELECT * FROM capped", RAW, fenced("raw", "capped", 0.25),
                            doubles="unit_price effective_price actual_sales demand revenue l_extendedprice"),
        "outlier_counts": sql("SELECT * FROM capped_counts", RAW, fenced("raw", "capped", 0.25),
                              doubles="lower upper"),
        "fill_date_gaps": sql(f"SELECT {PANEL_COLUMNS} FROM panel", *base, doubles=PRICES, revenue=4),
        "missing_columns": sql(
            " UNION ALL ".join(
                f"SELECT '{c}' AS \"column\", count(*) - count({c}) AS missing FROM nulled"
                for c in ("date", "unit_price", "actual_sales", "category")
            ), RAW, NULLED,
        ),
        "quality_audit": sql(
            "SELECT (SELECT count(*) FROM nulled) AS rows_in, "
            "(SELECT count(*) FROM nulled WHERE date IS NULL) AS null_dates, "
            "(SELECT count(*) FROM imputed) - (SELECT count(*) FROM firsts) AS duplicates, "
            "(SELECT count(*) FROM firsts) AS rows_out",
            RAW, NULLED, IMPUTED, first_rows("imputed", "firsts"),
        ),
        "preprocess": sql(
            "SELECT * FROM clean",
            RAW, NULLED, IMPUTED, TYPED, first_rows("typed", "firsts"),
            fenced("firsts", "capped", 3.0),
            fill("capped", "clean", "effective_price lost_sales l_orderkey l_linenumber l_partkey "
                 "l_suppkey l_extendedprice l_tax"),
            doubles="unit_price effective_price actual_sales demand revenue l_extendedprice",
        ),
        "preprocess_audit": sql(
            "SELECT 'rows_in' AS measure, CAST(NULL AS VARCHAR) AS \"column\", count(*) AS rows FROM nulled "
            "UNION ALL SELECT 'null_dates', NULL, count(*) FILTER (WHERE date IS NULL) FROM nulled "
            "UNION ALL SELECT 'duplicates', NULL, (SELECT count(*) FROM imputed) - (SELECT count(*) FROM firsts) "
            "UNION ALL SELECT 'rows_out', NULL, count(*) FROM firsts "
            + "".join(
                f"UNION ALL SELECT 'filled', '{c}', count(*) - count({c}) FROM dated_rows "
                for c in (*NUMERIC, "store", "category", "product")
            )
            + " ".join(
                f"UNION ALL SELECT 'capped', '{c}', count(*) FILTER (WHERE CAST({c} AS DOUBLE) < lo_{c} "
                f"OR CAST({c} AS DOUBLE) > hi_{c}) FROM firsts, capped_bounds"
                for c in ("actual_sales", "demand", "revenue")
            ),
            RAW, NULLED, IMPUTED, TYPED, first_rows("typed", "firsts"), fenced("firsts", "capped", 3.0)),
        "accepted_rows": sql(
            "SELECT store, count(*) AS rows, CAST(sum(demand) AS BIGINT) AS demand, min(date) AS first_date, "
            "max(date) AS last_date, avg(unit_price) AS unit_price FROM raw "
            "WHERE l_orderkey % 31 <> 0 AND l_orderkey % 37 <> 0 AND l_orderkey % 41 <> 0 GROUP BY store",
            RAW, doubles="unit_price"),
        "rejected_rows": sql(
            "SELECT CAST(l_orderkey AS VARCHAR) AS l_orderkey, CAST(l_linenumber AS VARCHAR) AS l_linenumber, "
            "CASE WHEN l_orderkey % 31 = 0 THEN 'yesterday' ELSE CAST(date AS VARCHAR) END AS date, "
            "CASE WHEN l_orderkey % 37 = 0 THEN 'many' ELSE CAST(demand AS VARCHAR) END AS demand, "
            "concat_ws(' ', CASE WHEN l_orderkey % 31 = 0 THEN 'date' END, CASE WHEN l_orderkey % 41 = 0 THEN "
            "'unit_price' END, CASE WHEN l_orderkey % 37 = 0 THEN 'demand' END) AS problems FROM raw "
            "WHERE l_orderkey % 31 = 0 OR l_orderkey % 37 = 0 OR l_orderkey % 41 = 0", RAW),
        # roll-up and reports
        "daily_rollup": sql("SELECT * FROM daily", RAW, DAILY, doubles=PRICES, revenue=4),
        "dataset_summary": sql(
            "SELECT count(*) AS rows, min(date) AS first_date, max(date) AS last_date, "
            "count(DISTINCT store) AS stores, count(DISTINCT category) AS categories, "
            "count(DISTINCT product) AS products, sum(revenue) AS total_revenue, "
            "CAST(sum(actual_sales) AS BIGINT) AS total_units, "
            "CAST(sum(stockout_flag) AS BIGINT) AS stockout_events, "
            "CAST(sum(is_promotion) AS BIGINT) AS promotion_days FROM raw",
            RAW, total_revenue=2,
        ),
        "sales_trend": sql(_rolled("actual_sales", 30), *base, doubles="rolling_30d"),
        "revenue_trend": sql(_rolled("revenue", 7), *base, revenue=4, rolling_7d=4),
        "category_month": sql(
            "SELECT strftime(date, '%Y-%m') AS month, category, "
            "CAST(sum(actual_sales) AS BIGINT) AS actual_sales FROM panel GROUP BY 1, 2", *base),
        "category_totals": sql(_performance("category"), *base, total_revenue=2, revenue_millions=6),
        "category_share": sql(
            "SELECT category, CAST(sum(actual_sales) AS BIGINT) AS actual_sales, "
            "sum(actual_sales) / sum(sum(actual_sales)) OVER () * 100 AS share_pct "
            "FROM panel GROUP BY category", *base, doubles="share_pct"),
        "store_performance": sql(_performance("store"), *base, total_revenue=2, revenue_millions=6),
        "monthly_totals": sql(
            "SELECT strftime(date, '%Y-%m') AS month, "
            "CAST(sum(actual_sales) AS BIGINT) AS actual_sales FROM panel GROUP BY 1", *base),
        "weekday_mean": sql(
            "SELECT dayname(date) AS dow, avg(actual_sales) AS actual_sales FROM panel GROUP BY 1",
            *base, doubles="actual_sales"),
        "promotion_impact": sql(
            "SELECT CASE is_promotion WHEN 1 THEN 'Promotion' ELSE 'No Promotion' END AS label, "
            "avg(actual_sales) AS mean, quantile_cont(CAST(actual_sales AS DOUBLE), 0.5) AS median, "
            "CAST(sum(actual_sales) AS BIGINT) AS sum, stddev_samp(actual_sales) AS std "
            "FROM raw GROUP BY is_promotion", RAW, doubles="mean median std"),
        "promo_uplift": sql(
            "SELECT (b - a) / a * 100 AS uplift_pct FROM (SELECT "
            "avg(actual_sales) FILTER (WHERE is_promotion = 0) AS a, "
            "avg(actual_sales) FILTER (WHERE is_promotion = 1) AS b FROM panel)",
            *base, doubles="uplift_pct"),
        "box_stats": sql(
            "SELECT CASE is_promotion WHEN 1 THEN 'Promotion' ELSE 'No Promotion' END AS label, "
            + ", ".join(
                f"quantile_cont(CAST(actual_sales AS DOUBLE), {p}) AS {n}"
                for p, n in ((0, "min"), (0.25, "q1"), (0.5, "median"), (0.75, "q3"), (1, "max"))
            ) + " FROM raw GROUP BY is_promotion",
            RAW, doubles="min q1 median q3 max"),
        "column_profile": sql(_profile(), RAW, NULLED,
                              doubles="missing_pct mean std min_number max_number q25 q50 q75"),
        "kpi_overview": sql(
            "SELECT sum(revenue) AS total_revenue, CAST(sum(actual_sales) AS BIGINT) AS total_units, "
            "avg(stockout_flag) * 100 AS stockout_rate_pct, count(DISTINCT product) AS products, "
            "count(DISTINCT store) AS stores FROM panel", *base,
            total_revenue=2, stockout_rate_pct=6),
        "distinct_values": sql(
            " UNION ALL ".join(
                f"SELECT DISTINCT '{c}' AS \"column\", {c} AS value FROM panel"
                for c in ("store", "category", "product")
            ), *base),
        "seasonality_pivot": sql(
            "SELECT CAST(isodow(date) - 1 AS INT) AS day_of_week, " + ", ".join(
                f"avg(actual_sales) FILTER (WHERE month(date) = {i}) AS \"{n}\""
                for i, n in enumerate("Jan Feb Mar Apr May Jun Jul Aug Sep Oct Nov Dec".split(), 1)
            ) + " FROM panel GROUP BY 1",
            *base, doubles="Jan Feb Mar Apr May Jun Jul Aug Sep Oct Nov Dec"),
        "top_products": sql(
            "SELECT product, category, sum(revenue) AS revenue FROM panel "
            "GROUP BY 1, 2 ORDER BY revenue DESC, 1, 2 LIMIT 10", *base, revenue=2),
        "filtered_sales": sql(
            "SELECT strftime(date, '%Y-%m') AS month, "
            "CAST(sum(actual_sales) AS BIGINT) AS actual_sales FROM panel "
            "WHERE store = 'ASIA' AND category = 'CAT_1' GROUP BY 1", *base),
        "series_history": sql(
            "SELECT date, CAST(sum(actual_sales) AS BIGINT) AS actual_sales FROM panel "
            "WHERE store = 'ASIA' AND product = 'Brand#11' GROUP BY date ORDER BY date DESC LIMIT 120",
            *base),
        "last_rows": sql(
            "SELECT date, store, product, actual_sales FROM (SELECT *, row_number() OVER "
            "(PARTITION BY store, product ORDER BY date DESC) AS rn FROM panel) WHERE rn <= 60", *base),
        "target_correlation": sql(_correlations(), *feat, doubles="correlation"),
        # features
        "date_features": sql(f"SELECT date, store, product, {CALENDAR} FROM panel", *base),
        "lag_features": sql(f"SELECT date, store, product, actual_sales, {LAGS} FROM panel {SERIES}", *base),
        "bucketed_lags": sql(f"SELECT date, store, product, actual_sales, {LAGS} FROM panel {SERIES}", *base),
        "rolling_features": sql(f"SELECT date, store, product, {ROLLING} FROM panel {SERIES}",
                                *base, digits=8, doubles=STATS),
        "expanding_mean": sql(f"SELECT date, store, product, {EXPANDING} FROM panel {SERIES}",
                              *base, digits=9, doubles="expanding_mean"),
        "expanding_mean_leak_free": sql(
            "SELECT date, store, product, avg(actual_sales) OVER (s ROWS BETWEEN UNBOUNDED PRECEDING "
            f"AND 1 PRECEDING) AS expanding_mean FROM panel {SERIES}",
            *base, digits=9, doubles="expanding_mean"),
        "promo_features": sql(
            f"SELECT date, store, product, {PROMO} FROM (SELECT *, {CALENDAR} FROM panel) {SERIES}", *base),
        "category_codes": sql(
            " UNION ALL ".join(
                f"SELECT '{c}' AS \"column\", {c} AS value, {c}_enc AS code FROM {c}_codes"
                for c in ("store", "category", "product")
            ), *base, CODES),
        "demand_segments": sql("SELECT * FROM segments", *base, SEGMENTS,
                               digits=8, doubles="zero_share mean q25 q75"),
        "features": sql("SELECT * FROM features", *feat, digits=8,
                        doubles=f"{PRICES} {STATS} expanding_mean", revenue=4),
        "season_factor": sql(
            "SELECT date, store, product, CAST(coalesce(season, 1.0) * CASE WHEN isodow(date) >= 6 "
            "THEN 1.25 ELSE 1.0 END AS DOUBLE) AS season_factor FROM panel AS p "
            "LEFT JOIN seasons AS s ON s.category = p.category AND s.m = month(date)",
            *base, SEASONS, doubles="season_factor"),
        "promo_calendar": sql(
            "SELECT date, store, product, CASE WHEN discount IS NULL THEN 0 ELSE 1 END AS is_sale, "
            "CAST(coalesce(discount, 0) AS DOUBLE) AS sale_discount FROM panel "
            "LEFT JOIN events ON m = month(date) AND abs(day(date) - d) <= 3",
            *base, SALE_DAYS, doubles="sale_discount"),
        # stock
        "abc_analysis": sql("SELECT * FROM abc", RAW, abc("raw", "product, category"),
                            total_revenue=2, doubles="avg_unit_price revenue_pct cumulative_pct"),
        "abc_rounded": sql("SELECT * FROM abc", RAW, abc("raw", "product, category", 2),
                           total_revenue=2, doubles="avg_unit_price revenue_pct cumulative_pct"),
        "abc_parts": sql("SELECT * FROM abc", RAW, abc("raw", "l_partkey, category"),
                         total_revenue=2, doubles="avg_unit_price revenue_pct cumulative_pct"),
        "abc_summary": sql(
            "SELECT abc_class, count(*) AS num_products, sum(total_revenue) AS total_revenue, "
            "sum(revenue_pct) AS revenue_pct FROM abc GROUP BY 1",
            RAW, abc("raw", "product, category"), total_revenue=2, revenue_pct=6),
        "inventory_recommendations": sql("SELECT * FROM inv", *stock, doubles=INV_DOUBLES,
                                         total_revenue=2),
        "inventory_files": sql("SELECT * FROM inv", *base, inventory(5e6), doubles=INV_DOUBLES, total_revenue=2),
        "inventory_by_forecast": sql(
            "SELECT * FROM inv", *base, inventory(5e6, "forecast_avg_daily"),
            doubles=INV_DOUBLES, total_revenue=2),
        "reorder_alerts": sql(
            "SELECT store, product, abc_class, current_stock, reorder_point, eoq, risk_level FROM inv "
            "WHERE stockout_risk ORDER BY priority_score DESC, store, product, category LIMIT 20",
            *stock, doubles="reorder_point eoq"),
        "reorder_labels": sql(
            "SELECT concat(product, ' | ', right(store, 3)) AS label, eoq FROM inv WHERE stockout_risk "
            "ORDER BY priority_score DESC, store, product, category LIMIT 15", *stock, doubles="eoq"),
        "risk_distribution": sql("SELECT risk_level, count(*) AS count FROM inv GROUP BY 1", *stock),
        "status_counts": sql(
            "SELECT count(*) FILTER (WHERE stockout_risk) AS reorder_now, "
            "count(*) FILTER (WHERE risk_level = 'MEDIUM') AS monitor, "
            "count(*) FILTER (WHERE overstock_flag) AS overstock, "
            "count(*) FILTER (WHERE risk_level = 'HEALTHY') AS healthy FROM inv",
            *base, inventory(5e6)),
        "inventory_averages": sql(
            "SELECT avg(safety_stock) AS avg_safety_stock, avg(eoq) AS avg_eoq FROM inv",
            *stock, doubles="avg_safety_stock avg_eoq"),
        "stock_levels": sql(
            "SELECT product, avg(current_stock) AS current_stock, avg(safety_stock) AS safety_stock, "
            "avg(reorder_point) AS reorder_point FROM inv GROUP BY 1",
            *stock, doubles="current_stock safety_stock reorder_point"),
        "stockout_by_category": sql(
            "SELECT category, avg(stockout_rate_pct) AS stockout_rate_pct FROM inv GROUP BY 1",
            *stock, doubles="stockout_rate_pct"),
        "business_kpis": sql(_kpis("raw"), *stock),
        "business_kpis_by_day": sql(_kpis("panel"), *stock),
        # forecasting
        "jittered_features": sql(_jittered(), *split, doubles=" ".join(MODEL_FEATURES)),
        "time_split": sql(
            "SELECT 'train' AS part, count(*) AS rows, min(date) AS first_date, max(date) AS last_date "
            "FROM train UNION ALL SELECT 'test', count(*), min(date), max(date) FROM test", *split),
        "naive_metrics": sql(f"SELECT {METRICS.format(name='Naive Baseline')} FROM naive_test",
                             *split, NAIVE, doubles="mae rmse mape_pct r2"),
        "naive_series_metrics": sql(f"SELECT {METRICS.format(name='Naive Series')} FROM series_test",
                                    *split, NAIVE_SERIES, doubles="mae rmse mape_pct r2"),
        "naive_residuals": sql(
            "SELECT date, store, product, actual_sales, p AS predicted_sales, y - p AS residual, "
            "CASE WHEN y - p < 0 THEN 0.0 ELSE y - p END AS clamped FROM series_test",
            *split, NAIVE_SERIES, doubles="predicted_sales residual clamped"),
        "metrics_by_store": sql(
            f"SELECT store, {METRICS.format(name='Naive Series')} FROM series_test GROUP BY store",
            *split, NAIVE_SERIES, doubles="mae rmse mape_pct r2"),
        "baseline_improvement": sql(
            f"""SELECT arg_min(model, mae) AS best_model, min(mae) AS best_mae,
  (max(mae) FILTER (WHERE model = 'Naive Baseline') - min(mae))
  / max(mae) FILTER (WHERE model = 'Naive Baseline') * 100 AS improvement_pct
  FROM (SELECT model, round_even(mae, 4) AS mae FROM (
    SELECT {METRICS.format(name='Naive Baseline')} FROM naive_test UNION ALL
    SELECT {METRICS.format(name='Naive Series')} FROM series_test))""",
            *split, NAIVE, NAIVE_SERIES, doubles="best_mae improvement_pct"),
        "forecast_vs_actual": sql(
            "SELECT date, CAST(sum(actual_sales) AS BIGINT) AS actual, sum(p) AS predicted "
            "FROM series_test GROUP BY date", *split, NAIVE_SERIES, doubles="predicted"),
        "residual_stats": sql(
            "SELECT avg(g) AS mean, stddev_samp(g) AS std, max(g) AS max, min(g) AS min FROM ("
            "SELECT date, sum(actual_sales) - sum(p) AS g FROM series_test GROUP BY date)",
            *split, NAIVE_SERIES, doubles="mean std max min"),
        "future_features": sql(
            f"SELECT store, product, category, date, unit_price, discount_pct, store_enc, category_enc, "
            f"product_enc, f.* EXCLUDE (store, product), {CALENDAR}, 0 AS is_promotion, "
            "0 AS promo_x_weekend, 0 AS promo_lag1 FROM ahead JOIN frozen AS f USING (store, product)",
            *feat, FUTURE, digits=8,
            doubles=f"{PRICES} rolling_mean_7d rolling_mean_14d rolling_mean_30d rolling_std_7d "
                    "rolling_std_14d expanding_mean"),
    }

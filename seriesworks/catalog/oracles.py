"""Reference SQL (DuckDB dialect) for the query catalogue."""

from __future__ import annotations

from seriesworks import config

_SALES_BODY = """
    SELECT p_brand AS gcode, CAST(l_shipdate AS DATE) AS create_dt, l_quantity AS qty,
           l_extendedprice / l_quantity AS invoice_price, {customer} AS cust_name,
           CAST(l_partkey AS VARCHAR) AS code, p_name AS gname,
           CAST(c_nationkey AS VARCHAR) AS sale_area_id, CAST(l_orderkey AS VARCHAR) AS contno,
           l_tax AS invoice_tax_rate, DATE '2001-11-04' AS dt
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey
    JOIN customer ON o_custkey = c_custkey JOIN part ON l_partkey = p_partkey {more}
"""

# Common table expressions by name; each may use the ones above it.
_CTES = {
    "sales": _SALES_BODY.format(customer="c_mktsegment", more=""),
    "nation_sales": _SALES_BODY.format(
        customer="n_name", more="JOIN nation ON c_nationkey = n_nationkey"
    ),
    "series": "SELECT gcode AS drug_id, cust_name AS hospital_id, create_dt AS date, qty AS sales_quantity FROM sales",
    "nation_series": "SELECT gcode AS drug_id, cust_name AS hospital_id, create_dt AS date, qty AS sales_quantity FROM nation_sales",
    "daily": "SELECT drug_id, hospital_id, date, sum(sales_quantity) AS sales_quantity FROM series GROUP BY ALL",
    "nation_daily": "SELECT drug_id, hospital_id, date, sum(sales_quantity) AS sales_quantity FROM nation_series GROUP BY ALL",
    "spine": """
        SELECT drug_id, hospital_id,
               CAST(unnest(generate_series(min(date), max(date), INTERVAL 1 DAY)) AS DATE) AS date
        FROM daily GROUP BY drug_id, hospital_id""",
    "nation_spine": """
        SELECT drug_id, hospital_id,
               CAST(unnest(generate_series(min(date), max(date), INTERVAL 1 DAY)) AS DATE) AS date
        FROM nation_daily GROUP BY drug_id, hospital_id""",
    "dense": """
        SELECT s.drug_id, s.hospital_id, s.date,
               last_value(d.sales_quantity IGNORE NULLS) OVER (
                   PARTITION BY s.drug_id, s.hospital_id ORDER BY s.date
                   ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS sales_quantity
        FROM spine s LEFT JOIN daily d USING (drug_id, hospital_id, date)""",
    "nation_dense": """
        SELECT s.drug_id, s.hospital_id, s.date,
               last_value(d.sales_quantity IGNORE NULLS) OVER (
                   PARTITION BY s.drug_id, s.hospital_id ORDER BY s.date
                   ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS sales_quantity
        FROM nation_spine s LEFT JOIN nation_daily d USING (drug_id, hospital_id, date)""",
    "gappy": """
        SELECT s.drug_id, s.hospital_id, s.date,
               CASE WHEN d.sales_quantity <= 50 THEN d.sales_quantity END AS sales_quantity
        FROM spine s LEFT JOIN daily d USING (drug_id, hospital_id, date)""",
    "lagged7": """
        SELECT drug_id, hospital_id, date, sales_quantity AS actual,
               lag(sales_quantity, 7) OVER (PARTITION BY drug_id, hospital_id ORDER BY date) AS predicted
        FROM dense""",
    "preds": "SELECT * FROM lagged7 WHERE predicted IS NOT NULL",
    "lags": "SELECT *, {lags} FROM dense WINDOW w AS (PARTITION BY drug_id, hospital_id ORDER BY date)".format(
        lags=", ".join(f"lag(sales_quantity, {n}) OVER w AS lag_{n}" for n in config.LAGS)
    ),
    "lag_models": "SELECT drug_id, hospital_id, date, sales_quantity AS actual, model, trial, predicted FROM ("
    + " UNION ALL ".join(
        f"SELECT drug_id, hospital_id, date, sales_quantity, 'lag_{n}' AS model, {n} AS trial, lag_{n} AS predicted FROM lags WHERE lag_30 IS NOT NULL"
        for n in config.LAGS
    )
    + ")",
    "samples": """
        SELECT ts >= TIMESTAMP '2024-01-16 00:00:00' AS is_current, value, CAST(hour(ts) AS DOUBLE) AS hour,
               CAST(json_extract_string(props, '$.k') AS DOUBLE) AS k FROM events""",
    "long_samples": """
        SELECT is_current, 'value' AS feature, value AS x FROM samples
        UNION ALL SELECT is_current, 'hour', hour FROM samples
        UNION ALL SELECT is_current, 'k', k FROM samples""",
}

_NEEDS = {
    "series": ["sales"],
    "nation_series": ["nation_sales"],
    "daily": ["series"],
    "nation_daily": ["nation_series"],
    "spine": ["daily"],
    "nation_spine": ["nation_daily"],
    "dense": ["spine", "daily"],
    "nation_dense": ["nation_spine", "nation_daily"],
    "gappy": ["spine", "daily"],
    "lagged7": ["dense"],
    "preds": ["lagged7"],
    "lags": ["dense"],
    "lag_models": ["lags"],
    "long_samples": ["samples"],
}

_KEYS = "drug_id, hospital_id"
_W = f"(PARTITION BY {_KEYS} ORDER BY date)"
_BY_SERIES = f"PARTITION BY {_KEYS}"


def _closure(names: list[str]) -> set[str]:
    found: set[str] = set()
    todo = list(names)
    while todo:
        name = todo.pop()
        if name not in found:
            found.add(name)
            todo += _NEEDS.get(name, [])
    return found


def _sql(body: str, *ctes: str, extra: str = "") -> str:
    needed = _closure(list(ctes))
    parts = [f"{name} AS ({text})" for name, text in _CTES.items() if name in needed]
    if extra:
        parts.append(extra)
    return (f"WITH {', '.join(parts)} " if parts else "") + body


def _r(expr: str, name: str, digits: int = 6) -> str:
    return f"round(CAST({expr} AS DOUBLE) + 1e-9, {digits}) + 0.0 AS {name}"


_SALES_COLUMNS = (
    "gcode, create_dt, qty, invoice_price, cust_name, code, gname, sale_area_id, contno, invoice_tax_rate"
)

_METRICS = """
    sqrt(avg((actual - predicted) * (actual - predicted))) AS rmse,
    avg(abs(actual - predicted)) AS mae,
    CASE WHEN var_pop(actual) * count(*) = 0
         THEN CASE WHEN sum((actual - predicted) * (actual - predicted)) = 0 THEN 1.0 ELSE 0.0 END
         ELSE 1 - sum((actual - predicted) * (actual - predicted)) / (var_pop(actual) * count(*)) END AS r2,
    coalesce(avg(CASE WHEN actual <> 0 THEN abs((actual - predicted) / actual) END) * 100,
             CAST('inf' AS DOUBLE)) AS mape
"""
_METRIC_NAMES = ["rmse", "mae", "r2", "mape"]


def _rounded(names, digits=6) -> str:
    return ", ".join(_r(n, n, digits) for n in names)


def _rolling(windows, statistics, source="sales_quantity", digits=5, ending=0) -> str:
    functions = {
        "mean": "avg({x})", "std": "stddev_samp({x})", "min": "min({x})", "max": "max({x})",
        "median": "quantile_cont({x}, 0.5)",
    }
    out = []
    for n in windows:
        first, last = n - 1 + ending, f"{ending} PRECEDING" if ending else "CURRENT ROW"
        over = f"OVER ({_BY_SERIES} ORDER BY date ROWS BETWEEN {first} PRECEDING AND {last})"
        for s in statistics:
            value = functions[s].format(x=source) + " " + over
            out.append(
                f"CASE WHEN count({source}) {over} = {n} THEN round({value} + 1e-9, {digits}) + 0.0 END "
                f"AS sales_quantity_rolling_{n}_{s}"
            )
    return ", ".join(out)


_CUTOFFS = """cutoffs AS (SELECT drug_id, hospital_id, CAST(unnest(generate_series(CAST(max(date) - INTERVAL 30 DAY AS TIMESTAMP),
    CAST(min(date) + INTERVAL 365 DAY AS TIMESTAMP), INTERVAL (-90) DAY)) AS DATE) AS cutoff FROM daily GROUP BY 1, 2)"""
#: Mean over the last ``size`` rows: the sums so far less those before the window.
_WINDOWED = "({m}_total - (f_{m}_total - f_{m} + (total - size - f_total + f_n) * f_{m} / f_n)) / size"


def _lag_list(lags, prefix="sales_quantity_lag_") -> str:
    return ", ".join(f"lag(sales_quantity, {n}) OVER {_W} AS {prefix}{n}" for n in lags)


_CALENDAR = {
    "year": "CAST(year(date) AS INTEGER)",
    "month": "CAST(month(date) AS INTEGER)",
    "day": "CAST(day(date) AS INTEGER)",
    "dayofweek": "CAST(isodow(date) - 1 AS INTEGER)",
    "quarter": "CAST(quarter(date) AS INTEGER)",
    "is_weekend": "CAST(isodow(date) >= 6 AS INTEGER)",
    "is_month_start": "CAST(day(date) = 1 AS INTEGER)",
    "is_month_end": "CAST(date = last_day(date) AS INTEGER)",
    "is_quarter_start": "CAST(day(date) = 1 AND month(date) IN (1, 4, 7, 10) AS INTEGER)",
    "is_quarter_end": "CAST(date = last_day(date) AND month(date) IN (3, 6, 9, 12) AS INTEGER)",
}


def _cyclic(digits: int) -> str:
    parts = {
        "month_sin": "sin(2 * pi() * month(date) / 12)",
        "month_cos": "cos(2 * pi() * month(date) / 12)",
        "dayofweek_sin": "sin(2 * pi() * (isodow(date) - 1) / 7)",
        "dayofweek_cos": "cos(2 * pi() * (isodow(date) - 1) / 7)",
    }
    return ", ".join(_r(e, n, digits) for n, e in parts.items())


_CALENDAR_LIST = ", ".join(f"{e} AS {n}" for n, e in _CALENDAR.items())
_SO_FAR = f"OVER ({_BY_SERIES} ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
_EXPANDING = (
    f"CASE WHEN sales_quantity IS NOT NULL THEN round(sum(sales_quantity) {_SO_FAR} + 1e-9, 5) + 0.0 END AS sales_quantity_cumsum, "
    f"round(avg(sales_quantity) {_SO_FAR} + 1e-9, 5) + 0.0 AS sales_quantity_cummean, "
    f"round(stddev_samp(sales_quantity) {_SO_FAR} + 1e-9, 5) + 0.0 AS sales_quantity_cumstd"
)
_DIFFS = ", ".join(
    f"sales_quantity - lag(sales_quantity, {p}) OVER {_W} AS sales_quantity_diff_{p}" for p in config.DIFF_PERIODS
)

_CLIPPED = f"""clipped AS (
    SELECT drug_id, hospital_id, date,
           least(greatest(sales_quantity, q1 - 3.0 * (q3 - q1)), q3 + 3.0 * (q3 - q1)) AS sales_quantity
    FROM (SELECT *, quantile_cont(sales_quantity, 0.25) OVER ({_BY_SERIES}) AS q1,
                 quantile_cont(sales_quantity, 0.75) OVER ({_BY_SERIES}) AS q3 FROM dense))"""

_FULL_SELECT = f"""
    SELECT drug_id, hospital_id, date, round(sales_quantity + 1e-9, 5) + 0.0 AS sales_quantity, {_CALENDAR_LIST},
           {_cyclic(5)}, {", ".join(f"round(lag(sales_quantity, {n}) OVER {_W} + 1e-9, 5) + 0.0 AS sales_quantity_lag_{n}" for n in config.LAGS)},
           {_rolling(config.WINDOWS, config.STATISTICS)},
           {", ".join(f"round(sales_quantity - lag(sales_quantity, {p}) OVER {_W} + 1e-9, 5) + 0.0 AS sales_quantity_diff_{p}" for p in config.DIFF_PERIODS)},
           {_EXPANDING}
    FROM clipped"""
_FULL_FEATURES = [
    *config.DATE_FEATURES, "month_sin", "month_cos", "dayofweek_sin", "dayofweek_cos",
    *[f"sales_quantity_lag_{n}" for n in config.LAGS],
    *[f"sales_quantity_rolling_{n}_{s}" for n in config.WINDOWS for s in config.STATISTICS],
    *[f"sales_quantity_diff_{p}" for p in config.DIFF_PERIODS],
    "sales_quantity_cumsum", "sales_quantity_cummean", "sales_quantity_cumstd",
]
_FULL = f"{_CLIPPED}, feats AS ({_FULL_SELECT}), full_feats AS (SELECT * FROM feats WHERE sales_quantity_rolling_90_mean IS NOT NULL)"


def _family(name: str) -> str:
    for part, family in (("_lag_", "lag"), ("_rolling_", "rolling"), ("_diff_", "diff"), ("_cum", "cumulative")):
        if part in name:
            return family
    return "date"


def _per_feature(expr: str, names, table: str, value: str) -> str:
    return " UNION ALL ".join(f"SELECT '{n}' AS feature, {expr.format(c=n)} AS {value} FROM {table}" for n in names)


def _fill(expr: str, source: str = "gappy") -> str:
    return _sql(f"SELECT drug_id, hospital_id, date, {_r(expr, 'sales_quantity')} FROM {source}", source)


_UP = f"OVER ({_BY_SERIES} ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
_DOWN = f"OVER ({_BY_SERIES} ORDER BY date ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)"

_ENDS = {
    "D": ("date", "INTERVAL 1 DAY"),
    "W": ("CAST(date + CAST(7 - isodow(date) AS INTEGER) AS DATE)", "INTERVAL 7 DAY"),
    "M": ("last_day(date)", "INTERVAL 1 MONTH"),
    "Q": ("last_day(CAST(date_trunc('quarter', date) + INTERVAL 2 MONTH AS DATE))", "INTERVAL 3 MONTH"),
}


def _resample(freq: str, aggregate: str, empty: str, source: str = "nation_daily") -> str:
    label, step = _ENDS[freq]
    # month and quarter ends are stepped from the first of the month
    first = "date_trunc('month', min(label))" if freq in "MQ" else "min(label)"
    day = "last_day(CAST(p AS DATE))" if freq in "MQ" else "CAST(p AS DATE)"
    extra = f"""grouped AS (
        SELECT drug_id, hospital_id, {label} AS label, {aggregate} AS v FROM {source} GROUP BY 1, 2, 3),
        periods AS (SELECT drug_id, hospital_id, {day} AS label FROM (
            SELECT drug_id, hospital_id, unnest(generate_series(CAST({first} AS TIMESTAMP), CAST(max(label) AS TIMESTAMP), {step})) AS p
            FROM grouped GROUP BY 1, 2))"""
    value = f"coalesce(v, {empty})" if empty != "NULL" else "v"
    return _sql(
        f"SELECT drug_id, hospital_id, label AS date, {_r(value, 'sales_quantity')} "
        "FROM periods LEFT JOIN grouped USING (drug_id, hospital_id, label)",
        source,
        extra=extra,
    )


_NUMBERED = f"numbered AS (SELECT *, row_number() OVER {_W} - 1 AS pos, count(*) OVER ({_BY_SERIES}) AS n FROM {{source}})"
_FOLDS = (
    "folded AS (SELECT *, CASE WHEN n // 6 = 0 THEN NULL WHEN pos < n - 5 * (n // 6) THEN 0 "
    "ELSE CAST((pos - (n - 5 * (n // 6))) // (n // 6) + 1 AS INTEGER) END AS fold FROM numbered)"
)
_SPLIT3 = (
    "CASE WHEN pos < CAST(floor(n * 0.8) AS BIGINT) - CAST(floor(floor(n * 0.8) * 0.1) AS BIGINT) THEN 'train' "
    "WHEN pos < CAST(floor(n * 0.8) AS BIGINT) THEN 'valid' ELSE 'test' END"
)

_KS = """ks_counts AS (SELECT feature, x, count(*) FILTER (NOT is_current) AS b, count(*) FILTER (is_current) AS c
        FROM {source} WHERE x IS NOT NULL GROUP BY feature, x),
    ks_cum AS (SELECT feature, x, sum(b) OVER w AS cb, sum(c) OVER w AS cc,
               sum(b) OVER (PARTITION BY feature) AS nb, sum(c) OVER (PARTITION BY feature) AS nc
        FROM ks_counts WINDOW w AS (PARTITION BY feature ORDER BY x ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
    ks AS (SELECT feature, max(abs(cb / nb - cc / nc)) AS statistic, CAST(max(nb) AS BIGINT) AS n_baseline,
           CAST(max(nc) AS BIGINT) AS n_current FROM ks_cum GROUP BY feature)"""
_KS_LAMBDA = "sqrt(CAST(n_baseline AS DOUBLE) * n_current / (n_baseline + n_current)) * statistic"
_KS_P = (
    f"CASE WHEN {_KS_LAMBDA} < 0.2 THEN 1.0 ELSE least(greatest(2 * list_sum([(CASE WHEN k % 2 = 1 THEN 1.0 ELSE -1.0 END) "
    f"* exp(-2.0 * k * k * ({_KS_LAMBDA}) * ({_KS_LAMBDA})) FOR k IN range(1, 101)]), 0), 1) END"
)
_KS_ALL = _KS.format(source="long_samples") + f", tested AS (SELECT *, {_KS_P} AS p_value FROM ks)"

_BINS = """edges AS (SELECT feature, list_sort(list_distinct(quantile_cont(x, [0, .1, .2, .3, .4, .5, .6, .7, .8, .9, 1]))) AS e
        FROM long_samples WHERE x IS NOT NULL GROUP BY feature),
    binned AS (SELECT l.feature, len(e) - 1 AS bins, greatest(len([v FOR v IN e IF v < x]), 1) AS bin, is_current
        FROM long_samples l JOIN edges USING (feature) WHERE x IS NOT NULL),
    cells AS (SELECT feature, bins, bin, count(*) FILTER (NOT is_current) AS b, count(*) FILTER (is_current) AS c
        FROM binned GROUP BY feature, bins, bin)"""
_CHI2 = (
    _BINS
    + """, totals AS (SELECT *, sum(b) OVER (PARTITION BY feature) AS nb, sum(c) OVER (PARTITION BY feature) AS nc FROM cells),
    chi2 AS (SELECT feature, sum((b - nb * (b + c) / (nb + nc)) * (b - nb * (b + c) / (nb + nc)) / (nb * (b + c) / (nb + nc))
               + (c - nc * (b + c) / (nb + nc)) * (c - nc * (b + c) / (nb + nc)) / (nc * (b + c) / (nb + nc))) AS statistic,
           CAST(max(bins) - 1 AS INTEGER) AS dof, CAST(max(nb) AS BIGINT) AS n_baseline, CAST(max(nc) AS BIGINT) AS n_current
        FROM totals GROUP BY feature)"""
)

# upper tail by Simpson's rule over the density
_CHI2_P = (
    "1 - statistic / 4000 / 3 * list_sum([(CASE WHEN i IN (0, 4000) THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END) "
    "* pow(i * statistic / 4000, dof / 2 - 1) * exp(-i * statistic / 8000) FOR i IN range(0, 4001)]) "
    "/ (pow(2, dof / 2) * gamma(dof / 2))"
)

_HISTORY = """product_history AS (
        SELECT gcode, event_timestamp, prod_cat1, dosage_form FROM (
            SELECT p_brand AS gcode, CAST(DATE '1995-01-01' + CAST(p_size * 30 AS INTEGER) AS DATE) AS event_timestamp,
                   p_type AS prod_cat1, CAST(p_size AS VARCHAR) AS dosage_form,
                   row_number() OVER (PARTITION BY p_brand, p_size ORDER BY p_type DESC, CAST(p_size AS VARCHAR) DESC) AS rn
            FROM part) WHERE rn = 1)"""
_VIEW = f"""view_rows AS (SELECT drug_id AS gcode, hospital_id AS cust_name, date AS create_dt,
        CAST(month(date) AS BIGINT) AS month, CAST(isodow(date) - 1 AS BIGINT) AS dayofweek,
        CAST(quarter(date) AS BIGINT) AS quarter, CAST(isodow(date) >= 6 AS BIGINT) AS is_weekend,
        {_lag_list([1, 7, 30])}, {_rolling([7, 14, 30], ["mean", "std"], digits=9)} FROM dense)"""
_VIEW_FLOATS = [
    "sales_quantity_lag_1", "sales_quantity_lag_7", "sales_quantity_lag_30",
    "sales_quantity_rolling_7_mean", "sales_quantity_rolling_14_mean", "sales_quantity_rolling_30_mean",
    "sales_quantity_rolling_7_std", "sales_quantity_rolling_30_std",
]

_NAIVE = """nation_lag AS (SELECT drug_id, hospital_id, sales_quantity AS actual,
        lag(sales_quantity, 7) OVER (PARTITION BY drug_id, hospital_id ORDER BY date) AS predicted FROM nation_dense),
    nation_metrics AS (SELECT drug_id, hospital_id, {metrics} FROM nation_lag WHERE predicted IS NOT NULL GROUP BY 1, 2),
    nation_status AS (SELECT drug_id, hospital_id, count(*) AS data_points FROM nation_series GROUP BY 1, 2),
    naive_batch AS (SELECT s.drug_id, s.hospital_id, CASE WHEN data_points < 100 THEN 'failed' ELSE 'success' END AS status,
        CASE WHEN data_points < 100 THEN 'not enough data points (' || data_points || ' < 100)' ELSE '' END AS message,
        data_points, rmse, mae, r2, mape FROM nation_status s LEFT JOIN nation_metrics USING (drug_id, hospital_id))""".format(
    metrics=_METRICS
)


def _fourier() -> str:
    t = "date_diff('day', DATE '1970-01-01', date)"
    return ", ".join(
        _r(f"{f}(2 * pi() * {k} * {t} / {period})", f"{name}_{f}_{k}")
        for name, period, order in config.SEASONALITIES
        for k in range(1, order + 1)
        for f in ("sin", "cos")
    )


def _long_metrics(source: str, by: str, names) -> str:
    return " UNION ALL ".join(f"SELECT {by}, '{m}' AS metric, CAST({m} AS DOUBLE) AS value FROM {source}" for m in names)


def _holiday_list() -> str:
    from seriesworks.catalog.queries import HOLIDAYS

    return "[" + ", ".join(f"DATE '{h}'" for h in HOLIDAYS) + "]"


_CALENDAR_SPLIT = """rows_split AS (
    SELECT *, CASE WHEN date < DATE '2000-01-01' THEN 'train' ELSE 'valid' END AS split FROM daily)"""


def _boosting_first_split(leaves_only: bool = False) -> str:
    """The nodes of the best split; with ``leaves_only`` the leaves' predictions and rows."""
    features = {"month": "month(date)", "quarter": "quarter(date)", "day": "day(date)", "dayofweek": "isodow(date) - 1"}
    long = " UNION ALL ".join(
        f"SELECT {i} AS pos, '{name}' AS feature, CAST({x} AS DOUBLE) AS x, g FROM train" for i, (name, x) in enumerate(features.items())
    )

    def value(g, n):
        return f"sign({g}) * greatest(abs({g}) - 5, 0) / ({n} + 3)"

    def gain(g, n):
        return f"greatest(abs({g}) - 5, 0) * greatest(abs({g}) - 5, 0) / ({n} + 3)"

    no = {"feature": "VARCHAR", "threshold": "DOUBLE", "left_node": "INTEGER", "right_node": "INTEGER", "gain": "DOUBLE"}
    leaf = ", ".join(f"CAST(NULL AS {t}) AS {c}" for c, t in no.items())
    extra = f"""{_CALENDAR_SPLIT},
    train AS (SELECT date, sales_quantity - avg(sales_quantity) OVER () AS g FROM rows_split WHERE split = 'train'),
    total AS (SELECT sum(g) AS tg, count(*) AS tn FROM train),
    binned AS (SELECT pos, feature, x, sum(g) AS g, count(*) AS n FROM ({long}) GROUP BY ALL),
    upto AS (SELECT pos, feature, x, sum(g) OVER w AS lg, sum(n) OVER w AS ln FROM binned
             WINDOW w AS (PARTITION BY feature ORDER BY x)),
    best AS (SELECT *, tg - lg AS rg, tn - ln AS rn, {gain("lg", "ln")} + {gain("tg - lg", "(tn - ln)")} - {gain("tg", "tn")} AS gain
             FROM upto, total WHERE ln >= 20 AND tn - ln >= 20 ORDER BY gain DESC, pos, x LIMIT 1)"""
    if leaves_only:
        mean = "(SELECT avg(sales_quantity) FROM rows_split WHERE split = 'train')"
        body = f"""
        SELECT {_r(f"{mean} + {value('lg', 'ln')}", "predicted", 4)}, CAST(ln AS BIGINT) AS rows FROM best
        UNION ALL SELECT {_r(f"{mean} + {value('rg', 'rn')}", "predicted", 4)}, CAST(rn AS BIGINT) FROM best"""
        return _sql(body, "daily", extra=extra)
    body = f"""
    SELECT 0 AS node, feature, {_r("x", "threshold", 4)}, 1 AS left_node, 2 AS right_node, {_r("gain", "gain", 4)},
           CAST(NULL AS DOUBLE) AS value, CAST(tn AS BIGINT) AS rows FROM best
    UNION ALL SELECT 1, {leaf}, {_r(value("lg", "ln"), "value", 4)}, CAST(ln AS BIGINT) FROM best
    UNION ALL SELECT 2, {leaf}, {_r(value("rg", "rn"), "value", 4)}, CAST(rn AS BIGINT) FROM best"""
    return _sql(body, "daily", extra=extra)


def _series_first_splits() -> str:
    features = {"month": "month(date)", "day": "day(date)", "dayofweek": "isodow(date) - 1"}
    keys = "drug_id, hospital_id"
    long = " UNION ALL ".join(
        f"SELECT {keys}, {i} AS pos, '{name}' AS feature, CAST({x} AS DOUBLE) AS x, g FROM train" for i, (name, x) in enumerate(features.items())
    )

    def shrunk(g):
        return f"greatest(abs({g}) - 5, 0)"

    def value(g, n):
        return f"sign({g}) * {shrunk(g)} / ({n} + 3)"

    def gain(g, n):
        return f"{shrunk(g)} * {shrunk(g)} / ({n} + 3)"

    extra = f"""{_CALENDAR_SPLIT},
    train AS (SELECT {keys}, date, sales_quantity - avg(sales_quantity) OVER (PARTITION BY {keys}) AS g FROM rows_split WHERE split = 'train'),
    total AS (SELECT {keys}, sum(g) AS tg, count(*) AS tn FROM train GROUP BY {keys}),
    binned AS (SELECT {keys}, pos, feature, x, sum(g) AS g, count(*) AS n FROM ({long}) GROUP BY ALL),
    upto AS (SELECT {keys}, pos, feature, x, sum(g) OVER w AS lg, sum(n) OVER w AS ln FROM binned
             WINDOW w AS (PARTITION BY {keys}, feature ORDER BY x)),
    best AS (SELECT *, tg - lg AS rg, tn - ln AS rn, {gain("lg", "ln")} + {gain("(tg - lg)", "(tn - ln)")} - {gain("tg", "tn")} AS gain
             FROM upto JOIN total USING ({keys}) WHERE ln >= 20 AND tn - ln >= 20
             QUALIFY row_number() OVER (PARTITION BY {keys} ORDER BY gain DESC, pos, x) = 1),
    split AS (SELECT * FROM best WHERE gain > 1e-9)"""
    no = "CAST(NULL AS VARCHAR) AS feature, CAST(NULL AS DOUBLE) AS threshold, CAST(NULL AS DOUBLE) AS gain"
    body = f"""
    SELECT {keys}, 1 AS node, feature, {_r("x", "threshold", 4)}, {_r("gain", "gain", 4)}, CAST(NULL AS DOUBLE) AS value, CAST(tn AS BIGINT) AS rows FROM split
    UNION ALL SELECT {keys}, 2, {no}, {_r(value("lg", "ln"), "value", 4)}, CAST(ln AS BIGINT) FROM split
    UNION ALL SELECT {keys}, 3, {no}, {_r(value("rg", "rn"), "value", 4)}, CAST(rn AS BIGINT) FROM split"""
    return _sql(body, "daily", extra=extra)


def _ordered_encoding() -> str:
    def one(c):
        before = f"PARTITION BY {c} ORDER BY date RANGE BETWEEN UNBOUNDED PRECEDING AND INTERVAL 1 DAY PRECEDING"
        y = "CASE WHEN split = 'train' THEN sales_quantity END"
        early = f"(coalesce(sum({y}) OVER ({before}), 0) + 10 * prior) / (count({y}) OVER ({before}) + 10)"
        late = f"(coalesce(sum({y}) OVER (PARTITION BY {c}), 0) + 10 * prior) / (count({y}) OVER (PARTITION BY {c}) + 10)"
        return _r(f"CASE WHEN split = 'train' THEN {early} ELSE {late} END", f"{c}_encoded")

    body = f"""SELECT drug_id, hospital_id, date, split, {one("drug_id")}, {one("hospital_id")}
    FROM rows_split, (SELECT avg(sales_quantity) AS prior FROM rows_split WHERE split = 'train')"""
    return _sql(body, "daily", extra=_CALENDAR_SPLIT)


def _trend_intervals() -> str:
    extra = """points AS (SELECT *, CAST(date - DATE '1970-01-01' AS DOUBLE) AS t FROM daily),
    line AS (SELECT drug_id, hospital_id, regr_slope(sales_quantity, t) AS slope, regr_intercept(sales_quantity, t) AS a,
                    avg(t) AS mt, avg(sales_quantity) AS my, max(date) AS last, count(*) AS n FROM points GROUP BY ALL HAVING count(*) > 1),
    spread AS (SELECT drug_id, hospital_id, sum(power(sales_quantity - my - slope * (t - mt), 2)) / (any_value(n) - 2) AS variance
               FROM points JOIN line USING (drug_id, hospital_id) GROUP BY ALL),
    ahead AS (SELECT *, CAST(last + CAST(h AS INTEGER) AS DATE) AS date FROM line, (SELECT unnest(range(1, 8)) AS h))"""
    at = "(my + slope * (CAST(date - DATE '1970-01-01' AS DOUBLE) - mt))"
    half = "1.9599639845400536 * sqrt(variance)"
    body = f"""SELECT drug_id, hospital_id, date, {_r(at, "predicted", 3)}, {_r(f"{at} - {half}", "lower", 3)}, {_r(f"{at} + {half}", "upper", 3)}
    FROM ahead JOIN spread USING (drug_id, hospital_id)"""
    return _sql(body, "daily", extra=extra)


def _ks_exact() -> str:
    """Shares of lattice paths that have been as far off the diagonal as the statistic, one anti-diagonal after the other."""
    return """
WITH RECURSIVE long AS (
    SELECT 's_acctbal' AS feature, s_acctbal AS x, s_suppkey % 2 AS c FROM supplier
    UNION ALL SELECT 's_nationkey', CAST(s_nationkey AS DOUBLE), s_suppkey % 2 FROM supplier
), sizes AS (SELECT feature, count(*) FILTER (c = 0) AS n1, count(*) FILTER (c = 1) AS n2 FROM long GROUP BY feature),
steps AS (
    SELECT DISTINCT feature, sum(1 - c) OVER w AS b, sum(c) OVER w AS d FROM long WINDOW w AS (PARTITION BY feature ORDER BY x)
), ks AS (
    SELECT feature, n1, n2, max(abs(b * n2 - d * n1)) AS far, max(abs(b / n1 - d / n2)) AS statistic
    FROM steps JOIN sizes USING (feature) GROUP BY ALL
), paths(feature, k, i, q) AS (
    SELECT feature, CAST(0 AS BIGINT), CAST(0 AS BIGINT), CAST(0 AS DOUBLE) FROM ks
    UNION ALL
    SELECT feature, k, i, CASE WHEN abs(i * n2 - (k - i) * n1) >= any_value(far) THEN 1.0 ELSE sum(part) END
    FROM (
        SELECT feature, k + 1 AS k, i + s AS i, q * CASE WHEN s = 1 THEN i + 1 ELSE k + 1 - i END / (k + 1) AS part
        FROM paths, (SELECT unnest([0, 1]) AS s) WHERE i >= 0
    ) JOIN ks USING (feature)
    WHERE i <= n1 AND k - i <= n2 AND k <= n1 + n2
    GROUP BY feature, k, i, n1, n2
), tested AS (SELECT feature, q AS p_value FROM paths JOIN ks USING (feature) WHERE k = n1 + n2 AND i = n1)
SELECT feature, """ + _r("statistic", "statistic") + ", " + _r("p_value", "p_value") + """,
       CAST(n1 AS BIGINT) AS n_baseline, CAST(n2 AS BIGINT) AS n_current, 'exact' AS method, p_value < 0.05 AS is_drift
FROM ks JOIN tested USING (feature)"""


def oracles() -> dict[str, str]:
    holidays = _holiday_list()
    nearest = f"least(list_min([abs(date_diff('day', h, date)) FOR h IN {holidays}]), 999)"
    out = {
        # scans
        "sales_scan": _sql(
            f"SELECT {_SALES_COLUMNS} FROM sales WHERE create_dt BETWEEN DATE '1996-01-01' AND DATE '1998-12-31'", "sales"
        ),
        "sales_one_series": _sql(
            f"SELECT {_SALES_COLUMNS} FROM sales WHERE gcode = 'Brand#2' AND cust_name = 'BUILDING'", "sales"
        ),
        "sales_default_window": _sql(
            f"SELECT {_SALES_COLUMNS} FROM sales WHERE dt = DATE '2001-11-04' "
            "AND create_dt BETWEEN CAST(DATE '2001-11-05' - INTERVAL 1825 DAY AS DATE) AND DATE '2001-11-05'",
            "sales",
        ),
        "sales_in_list": _sql(
            f"SELECT {_SALES_COLUMNS} FROM sales WHERE dt = DATE '2001-11-04' AND gcode IN ('Brand#1', 'Brand#5', 'Brand#9') "
            "AND cust_name IN ('BUILDING', 'MACHINERY') AND create_dt BETWEEN DATE '1997-01-01' AND DATE '1999-12-31'",
            "sales",
        ),
        "sales_key_table": _sql(
            "SELECT gcode, cust_name, create_dt, qty, contno FROM sales WHERE gcode IN "
            "(SELECT p_brand FROM part GROUP BY p_brand HAVING arg_min(p_type, p_partkey) = 'ECONOMY')",
            "sales",
        ),
        "product_info": "SELECT p_brand AS gcode, arg_min(p_type, p_partkey) AS prod_cat1, "
        "CAST(arg_min(p_size, p_partkey) AS VARCHAR) AS dosage_form, arg_min(p_name, p_partkey) AS prod_sale_name "
        "FROM part GROUP BY p_brand",
        "customer_info": "SELECT n_name AS hospital_id, n_name AS hospital_name, r_name AS region "
        "FROM nation JOIN region ON n_regionkey = r_regionkey",
        "bound_sql": _sql(
            "SELECT gcode, cust_name, count(*) AS records, sum(qty) AS total_qty FROM sales "
            "WHERE create_dt BETWEEN DATE '1997-01-01' AND DATE '1997-12-31' GROUP BY gcode, cust_name",
            "sales",
        ),
        "table_columns": _sql(
            " UNION ALL ".join(
                f"SELECT '{c}' AS column_name, count({c}) AS non_null, count(*) - count({c}) AS missing FROM sales"
                for c in (
                    "gcode", "create_dt", "qty", "invoice_price", "cust_name", "code", "gname", "sale_area_id",
                    "contno", "invoice_tax_rate",
                )
            ),
            "sales",
        ),
        "table_rows": _sql("SELECT count(*) AS records FROM sales", "sales"),
        # profile
        "valid_keys": _sql(
            "SELECT gcode, cust_name, count(*) AS records FROM sales WHERE trim(gcode) NOT IN ('', 'None') "
            "AND trim(cust_name) NOT IN ('', 'None') GROUP BY 1, 2",
            "sales",
        ),
        "valid_keys_with_blanks": _sql(
            "SELECT gcode, cust_name, count(*) AS records FROM sales WHERE qty % 5 > 2 GROUP BY 1, 2", "sales"
        ),
        "snapshot_counts_by_month": _sql(
            "SELECT last_day(create_dt) AS dt, count(*) AS count FROM sales GROUP BY 1 ORDER BY 1 DESC LIMIT 10", "sales"
        ),
        "distinct_products": _sql("SELECT DISTINCT gcode FROM sales ORDER BY gcode", "sales"),
        "distinct_customers": _sql("SELECT DISTINCT cust_name FROM nation_sales ORDER BY cust_name", "nation_sales"),
        "series_profile": _sql(
            "SELECT gcode, count(*) AS total_count, min(create_dt) AS min_date, max(create_dt) AS max_date, "
            f"count(DISTINCT cust_name) AS unique_customers, {_r('sum(qty)', 'total_qty')}, {_r('avg(qty)', 'avg_qty')} "
            "FROM sales GROUP BY gcode",
            "sales",
        ),
        "yearly_distribution": _sql(
            "SELECT CAST(year(create_dt) AS INTEGER) AS year, count(*) AS record_count, sum(qty) AS total_qty "
            "FROM sales GROUP BY 1 ORDER BY 1 DESC LIMIT 20",
            "sales",
        ),
        "snapshot_counts": _sql("SELECT dt, count(*) AS count FROM sales GROUP BY dt ORDER BY dt DESC LIMIT 10", "sales"),
        "filter_variant_counts": _sql(
            "SELECT gcode, count(*) AS no_filter, "
            "count(*) FILTER (create_dt BETWEEN DATE '1997-01-01' AND DATE '2000-12-31') AS business_date, "
            "count(*) FILTER (dt = DATE '2001-11-04') AS snapshot, "
            "count(*) FILTER (create_dt BETWEEN DATE '1997-01-01' AND DATE '2000-12-31' AND dt = DATE '2001-11-04') AS both "
            "FROM sales GROUP BY gcode",
            "sales",
        ),
        "date_range": _sql(
            "SELECT min(create_dt) AS min_date, max(create_dt) AS max_date FROM sales WHERE gcode = 'Brand#7'", "sales"
        ),
        "customer_stats": _sql(
            f"SELECT cust_name, count(*) AS record_count, {_r('sum(qty)', 'total_qty')}, {_r('avg(qty)', 'avg_qty')}, "
            "min(create_dt) AS first_date, max(create_dt) AS last_date FROM nation_sales GROUP BY cust_name",
            "nation_sales",
        ),
        "top_customers": _sql(
            f"SELECT cust_name, count(*) AS record_count, {_r('sum(qty)', 'total_qty')}, {_r('avg(qty)', 'avg_qty')}, "
            "min(create_dt) AS first_date, max(create_dt) AS last_date FROM nation_sales GROUP BY cust_name "
            "ORDER BY count(*) DESC, cust_name LIMIT 10",
            "nation_sales",
        ),
        "largest_customer": _sql(
            "SELECT cust_name, count(*) AS record_count FROM nation_sales GROUP BY cust_name "
            "ORDER BY count(*) DESC, cust_name LIMIT 1",
            "nation_sales",
        ),
        "top_customers_per_product": _sql(
            "SELECT * FROM (SELECT gcode, cust_name, count(*) AS record_count, sum(qty) AS total_qty, "
            "CAST(row_number() OVER (PARTITION BY gcode ORDER BY count(*) DESC, cust_name) AS INTEGER) AS rank "
            "FROM nation_sales GROUP BY gcode, cust_name) WHERE rank <= 3",
            "nation_sales",
        ),
        "latest_sales": _sql(
            "SELECT create_dt, contno, code, gcode, cust_name, qty, invoice_price "
            "FROM (SELECT * FROM sales ORDER BY create_dt DESC, contno, code, gcode, cust_name, qty, invoice_price LIMIT 10)",
            "sales",
        ),
        "series_status": _sql(
            "SELECT drug_id, hospital_id, count(*) AS data_points, "
            "CASE WHEN count(*) < 100 THEN 'skipped' ELSE 'ready' END AS status, "
            "CASE WHEN count(*) < 100 THEN 'not enough data points (' || count(*) || ' < 100)' ELSE '' END AS message "
            "FROM nation_series GROUP BY drug_id, hospital_id",
            "nation_series",
        ),
        "combination_status": _sql(
            "SELECT gcode, cust_name, coalesce(n, 0) AS data_points, "
            "CASE WHEN n IS NULL THEN 'missing' WHEN n < 450 THEN 'skipped' ELSE 'ready' END AS status, "
            "CASE WHEN n IS NULL THEN 'no data' WHEN n < 450 THEN 'not enough data points (' || n || ' < 450)' ELSE '' END AS message "
            "FROM (SELECT DISTINCT p_brand AS gcode FROM part) CROSS JOIN (SELECT unnest(['AUTOMOBILE', 'BUILDING', "
            "'FURNITURE', 'HOUSEHOLD', 'MACHINERY', 'WHOLESALE']) AS cust_name) "
            "LEFT JOIN (SELECT gcode, cust_name, count(*) AS n FROM sales GROUP BY 1, 2) USING (gcode, cust_name)",
            "sales",
        ),
        "combination_coverage": _sql(
            "SELECT count(DISTINCT gcode) AS products, count(DISTINCT cust_name) AS customers, "
            "count(DISTINCT gcode || '|' || cust_name) AS present, count(DISTINCT gcode) * count(DISTINCT cust_name) AS possible, "
            "count(DISTINCT gcode) * count(DISTINCT cust_name) - count(DISTINCT gcode || '|' || cust_name) AS missing FROM nation_sales",
            "nation_sales",
        ),
        "auto_select": _sql(
            "SELECT gcode, cust_name, n AS record_count, CAST(total AS BIGINT) AS total_records FROM ("
            "SELECT *, row_number() OVER (PARTITION BY gcode ORDER BY n DESC, cust_name) AS rn FROM "
            "(SELECT gcode, cust_name, count(*) AS n FROM nation_sales GROUP BY 1, 2) JOIN "
            "(SELECT gcode, count(*) AS total FROM nation_sales GROUP BY 1 HAVING count(*) >= 2400 ORDER BY 2 DESC, 1 LIMIT 8) "
            "USING (gcode)) WHERE rn <= 5",
            "nation_sales",
        ),
        "stale_dates": _sql(
            "SELECT gcode, min(create_dt) AS min_date, year(min(create_dt)) < 1996 AS is_stale, "
            "count(*) FILTER (year(create_dt) < 1996) AS stale_rows FROM sales GROUP BY gcode",
            "sales",
        ),
        "target_profile": _sql(
            f"SELECT drug_id, count(sales_quantity) AS count, {_r('avg(sales_quantity)', 'mean')}, "
            f"{_r('stddev_samp(sales_quantity)', 'std')}, {_r('min(sales_quantity)', 'min')}, {_r('max(sales_quantity)', 'max')}, "
            f"{_r('quantile_cont(sales_quantity, 0.25)', 'q25')}, {_r('quantile_cont(sales_quantity, 0.5)', 'median')}, "
            f"{_r('quantile_cont(sales_quantity, 0.75)', 'q75')} FROM dense GROUP BY drug_id",
            "dense",
        ),
        "pooled_samples": _sql("SELECT is_current, value, hour, k FROM samples", "samples"),
        # panel and preparation
        "daily_sales": _sql("SELECT * FROM daily", "daily"),
        "daily_sales_from_timestamps": _sql(
            f"SELECT drug_id, hospital_id, date, {_r('sum(CASE WHEN sales_quantity % 7 > 0 THEN sales_quantity ELSE 0 END)', 'sales_quantity')} "
            "FROM series GROUP BY drug_id, hospital_id, date",
            "series",
        ),
        "densified_series": _sql("SELECT * FROM dense", "dense"),
        "densified_zero": _sql(
            "SELECT s.drug_id, s.hospital_id, s.date, coalesce(d.sales_quantity, 0) AS sales_quantity "
            "FROM spine s LEFT JOIN daily d USING (drug_id, hospital_id, date)",
            "spine",
            "daily",
        ),
        "missing_counts": _sql(
            " UNION ALL ".join(
                f"SELECT '{c}' AS column_name, count(*) - count({c}) AS missing FROM gappy"
                for c in ("drug_id", "hospital_id", "date", "sales_quantity")
            ),
            "gappy",
        ),
        "fill_forward": _fill(f"coalesce(last_value(sales_quantity IGNORE NULLS) {_UP}, 0)"),
        "fill_backward": _fill(f"coalesce(first_value(sales_quantity IGNORE NULLS) {_DOWN}, 0)"),
        "fill_mean": _fill(f"coalesce(sales_quantity, avg(sales_quantity) OVER ({_BY_SERIES}), 0)"),
        "fill_median": _fill(f"coalesce(sales_quantity, quantile_cont(sales_quantity, 0.5) OVER ({_BY_SERIES}), 0)"),
        "fill_drop": _sql(
            f"SELECT drug_id, hospital_id, date, {_r('sales_quantity', 'sales_quantity')} FROM gappy WHERE sales_quantity IS NOT NULL",
            "gappy",
        ),
        "fill_interpolate": _sql(
            f"SELECT drug_id, hospital_id, date, {_r('coalesce(sales_quantity, v0 + (v1 - v0) * date_diff(chr(100) || chr(97) || chr(121), d0, date) / date_diff(chr(100) || chr(97) || chr(121), d0, d1), v0, 0)', 'sales_quantity')} FROM ends",
            "gappy",
            extra=f"""ends AS (SELECT *, last_value(sales_quantity IGNORE NULLS) {_UP} AS v0,
                last_value(CASE WHEN sales_quantity IS NOT NULL THEN date END IGNORE NULLS) {_UP} AS d0,
                first_value(sales_quantity IGNORE NULLS) {_DOWN} AS v1,
                first_value(CASE WHEN sales_quantity IS NOT NULL THEN date END IGNORE NULLS) {_DOWN} AS d1 FROM gappy)""",
        ).replace("chr(100) || chr(97) || chr(121)", "'day'"),
        "clip_iqr": _sql(
            f"SELECT drug_id, hospital_id, date, {_r('least(greatest(sales_quantity, q1 - 0.5 * (q3 - q1)), q3 + 0.5 * (q3 - q1))', 'sales_quantity')} "
            f"FROM (SELECT *, quantile_cont(sales_quantity, 0.25) OVER ({_BY_SERIES}) AS q1, "
            f"quantile_cont(sales_quantity, 0.75) OVER ({_BY_SERIES}) AS q3 FROM dense)",
            "dense",
        ),
        "zscore_replace": _sql(
            f"SELECT drug_id, hospital_id, date, {_r('CASE WHEN abs(sales_quantity - m) / nullif(s, 0) > 3 THEN m ELSE sales_quantity END', 'sales_quantity')} "
            f"FROM (SELECT *, avg(sales_quantity) OVER ({_BY_SERIES}) AS m, stddev_samp(sales_quantity) OVER ({_BY_SERIES}) AS s FROM dense)",
            "dense",
        ),
        "winsorize": _sql(
            f"SELECT drug_id, hospital_id, date, {_r('least(greatest(sales_quantity, lo), hi)', 'sales_quantity')} "
            f"FROM (SELECT *, quantile_cont(sales_quantity, 0.01) OVER ({_BY_SERIES}) AS lo, "
            f"quantile_cont(sales_quantity, 0.99) OVER ({_BY_SERIES}) AS hi FROM dense)",
            "dense",
        ),
        "outlier_counts": _sql(
            "SELECT drug_id, hospital_id, count(*) AS points, "
            "count(*) FILTER (sales_quantity < q1 - 3 * (q3 - q1) OR sales_quantity > q3 + 3 * (q3 - q1)) AS iqr_outliers, "
            "count(*) FILTER (abs(sales_quantity - m) > 3 * s) AS zscore_outliers, "
            "count(*) FILTER (sales_quantity < lo OR sales_quantity > hi) AS clip_outliers "
            "FROM dense JOIN (SELECT drug_id, hospital_id, quantile_cont(sales_quantity, 0.25) AS q1, "
            "quantile_cont(sales_quantity, 0.75) AS q3, quantile_cont(sales_quantity, 0.01) AS lo, "
            "quantile_cont(sales_quantity, 0.99) AS hi, avg(sales_quantity) AS m, stddev_samp(sales_quantity) AS s "
            "FROM dense GROUP BY 1, 2) USING (drug_id, hospital_id) GROUP BY 1, 2",
            "dense",
        ),
        "resample_day_sum": _resample("D", "sum(sales_quantity)", "0", "daily"),
        "resample_week_sum": _resample("W", "sum(sales_quantity)", "0"),
        "resample_week_max": _resample("W", "max(sales_quantity)", "NULL"),
        "resample_month_mean": _resample("M", "avg(sales_quantity)", "NULL"),
        "resample_month_min": _resample("M", "min(sales_quantity)", "NULL"),
        "resample_quarter_median": _resample("Q", "quantile_cont(sales_quantity, 0.5)", "NULL"),
        "scale_minmax": _sql(
            f"SELECT drug_id, hospital_id, date, {_r('coalesce((sales_quantity - lo) / nullif(hi - lo, 0), 0)', 'sales_quantity')} "
            f"FROM (SELECT *, min(sales_quantity) OVER ({_BY_SERIES}) AS lo, max(sales_quantity) OVER ({_BY_SERIES}) AS hi FROM dense)",
            "dense",
        ),
        "scale_standard": _sql(
            f"SELECT drug_id, hospital_id, date, {_r('coalesce((sales_quantity - m) / nullif(s, 0), 0)', 'sales_quantity')} "
            f"FROM (SELECT *, avg(sales_quantity) OVER ({_BY_SERIES}) AS m, stddev_pop(sales_quantity) OVER ({_BY_SERIES}) AS s FROM dense)",
            "dense",
        ),
        "scaler_parameters": _sql(
            f"SELECT drug_id, hospital_id, {_r('avg(sales_quantity)', 'sales_quantity_shift')}, "
            f"{_r('coalesce(nullif(stddev_pop(sales_quantity), 0), 1)', 'sales_quantity_scale')} FROM dense GROUP BY 1, 2",
            "dense",
        ),
        "sequences": _sql(
            "SELECT drug_id, hospital_id, date, array_to_string(xs, ',') AS x, array_to_string(ys, ',') AS y FROM ("
            f"SELECT drug_id, hospital_id, date, list(CAST(sales_quantity AS BIGINT)) OVER ({_BY_SERIES} ORDER BY date ROWS BETWEEN CURRENT ROW AND 13 FOLLOWING) AS xs, "
            f"list(CAST(sales_quantity AS BIGINT)) OVER ({_BY_SERIES} ORDER BY date ROWS BETWEEN 14 FOLLOWING AND 15 FOLLOWING) AS ys FROM nation_daily) "
            "WHERE len(xs) = 14 AND len(ys) = 2",
            "nation_daily",
        ),
        # features
        "calendar_features": _sql(
            f"SELECT date, {_CALENDAR_LIST}, CAST(dayofyear(date) AS INTEGER) AS dayofyear, CAST(week(date) AS INTEGER) AS weekofyear, "
            f"{_cyclic(6)} FROM (SELECT DISTINCT date FROM daily)",
            "daily",
        ),
        "lag_features": _sql(f"SELECT drug_id, hospital_id, date, sales_quantity, {_lag_list(config.LAGS)} FROM dense", "dense"),
        "rolling_features": _sql(
            f"SELECT drug_id, hospital_id, date, round(sales_quantity + 1e-9, 5) + 0.0 AS sales_quantity, {_rolling(config.WINDOWS, config.STATISTICS)} FROM dense",
            "dense",
        ),
        "rolling_after_spike": _sql(
            "SELECT * EXCLUDE (since) FROM (SELECT drug_id, hospital_id, date, since, round(sales_quantity + 1e-9, 5) + 0.0 AS sales_quantity, "
            f"{_rolling(config.WINDOWS, config.STATISTICS)} FROM spiked) WHERE since > 90",
            "dense",
            extra=f"""spiked AS (SELECT drug_id, hospital_id, date, since, CASE WHEN since = 0 THEN 1e9 ELSE sales_quantity END AS sales_quantity
                FROM (SELECT *, CAST(date - min(date) OVER ({_BY_SERIES}) AS INTEGER) AS since FROM dense))""",
        ),
        "rolling_sparse": _sql(
            f"SELECT drug_id, hospital_id, date, round(sales_quantity + 1e-9, 5) + 0.0 AS sales_quantity, {_rolling([3], config.STATISTICS)} FROM gappy",
            "gappy",
        ),
        "diff_features": _sql(f"SELECT drug_id, hospital_id, date, sales_quantity, {_DIFFS} FROM dense", "dense"),
        "expanding_features": _sql(
            f"SELECT drug_id, hospital_id, date, round(sales_quantity + 1e-9, 5) + 0.0 AS sales_quantity, {_EXPANDING} FROM gappy", "gappy"
        ),
        "holiday_features": _sql(
            f"SELECT date, CAST(list_contains({holidays}, date) AS INTEGER) AS is_holiday, CAST({nearest} AS INTEGER) AS days_to_holiday, "
            f"CAST({nearest} <= 3 AS INTEGER) AS is_before_holiday FROM (SELECT DISTINCT date FROM daily)",
            "daily",
        ),
        "interaction_features": _sql(
            "SELECT drug_id, hospital_id, date, sales_quantity, sales_quantity_lag_1, sales_quantity_lag_7, "
            f"{_r('sales_quantity_lag_1 * sales_quantity_lag_7', 'sales_quantity_lag_1_x_sales_quantity_lag_7', 4)}, "
            f"{_r('sales_quantity_lag_1 / (sales_quantity_lag_7 + 1e-5)', 'sales_quantity_lag_1_div_sales_quantity_lag_7', 4)}, "
            f"{_r('sales_quantity * sales_quantity_lag_1', 'sales_quantity_x_sales_quantity_lag_1', 4)}, "
            f"{_r('sales_quantity / (sales_quantity_lag_1 + 1e-5)', 'sales_quantity_div_sales_quantity_lag_1', 4)} "
            f"FROM (SELECT drug_id, hospital_id, date, sales_quantity, {_lag_list([1, 7])} FROM dense)",
            "dense",
        ),
        "compact_dates": _sql("SELECT date, strftime(date, '%Y%m%d') AS compact FROM (SELECT DISTINCT date FROM daily)", "daily"),
        "date_spine": _sql(
            "SELECT CAST(unnest(generate_series(min(create_dt), max(create_dt), INTERVAL 1 DAY)) AS DATE) AS date FROM sales", "sales"
        ),
        "model_file_names": "SELECT p_partkey, replace(substring(p_name || '/' || p_brand || '/' || p_type, 1, 20), '/', '_') AS file_name FROM part",
        "full_features": _sql("SELECT * FROM full_feats", "dense", extra=_FULL),
        "increment_features": _sql(
            "SELECT full_feats.* FROM full_feats LEFT JOIN known USING (drug_id, hospital_id) WHERE date > coalesce(until, DATE '0001-01-01')",
            "dense", "daily",
            extra=_FULL.replace(_CLIPPED, "clipped AS (SELECT * FROM dense)")
            + ", known AS (SELECT drug_id, hospital_id, max(date) AS until FROM daily WHERE date < DATE '2000-01-01' GROUP BY ALL)",
        ),
        "full_features_no_leak": _sql(
            "SELECT * FROM built WHERE sales_quantity_rolling_30_mean IS NOT NULL",
            "dense",
            extra=f"""past AS (SELECT *, lag(sales_quantity) OVER {_W} AS prev FROM dense),
                built AS (SELECT drug_id, hospital_id, date, sales_quantity,
                    {", ".join(f"lag(sales_quantity, {n}) OVER {_W} AS sales_quantity_lag_{n}" for n in (1, 7))},
                    {_rolling([7, 30], config.STATISTICS, source="prev")},
                    {", ".join(f"prev - lag(prev, {p}) OVER {_W} AS sales_quantity_diff_{p}" for p in config.DIFF_PERIODS)},
                    {_EXPANDING.replace("(sales_quantity)", "(prev)").replace("sales_quantity IS NOT NULL", "prev IS NOT NULL")}
                FROM past)""",
        ),
        "feature_families": _sql(
            " UNION ALL ".join(
                f"SELECT '{n}' AS feature, '{_family(n)}' AS family, count({n}) AS non_null FROM full_feats" for n in _FULL_FEATURES
            ),
            "dense",
            extra=_FULL.replace("full_feats AS (", "full_feats AS MATERIALIZED ("),
        ),
        "select_by_correlation": _sql(
            "SELECT feature, round(score + 1e-9, 5) + 0.0 AS score, coalesce(score > 0.01, false) AS selected FROM ("
            + _per_feature("abs(CASE WHEN isnan(corr({c}, sales_quantity)) THEN NULL ELSE corr({c}, sales_quantity) END)", _FULL_FEATURES, "full_feats", "score")
            + ")",
            "dense",
            extra=_FULL.replace("full_feats AS (", "full_feats AS MATERIALIZED ("),
        ),
        "select_by_variance": _sql(
            "SELECT feature, round(score + 1e-9, 4) + 0.0 AS score, coalesce(score > 150, false) AS selected FROM ("
            + _per_feature(
                "var_samp({c})",
                [f"sales_quantity_lag_{n}" for n in config.LAGS]
                + [f"sales_quantity_rolling_{n}_{s}" for n in config.WINDOWS for s in ("mean", "max")],
                "rolled",
                "score",
            )
            + ")",
            "dense",
            extra=f"rolled AS MATERIALIZED (SELECT *, {_lag_list(config.LAGS)}, {_rolling(config.WINDOWS, ['mean', 'max'], digits=12)} FROM dense)",
        ),
        # splits
        "time_split": _sql(
            "SELECT drug_id, hospital_id, date, sales_quantity, CASE WHEN pos < floor(n * 0.8) THEN 'train' ELSE 'test' END AS split FROM numbered",
            "daily",
            extra=_NUMBERED.format(source="daily"),
        ),
        "three_way_split": _sql(
            f"SELECT drug_id, hospital_id, date, sales_quantity, {_SPLIT3} AS split FROM numbered",
            "daily",
            extra=_NUMBERED.format(source="daily"),
        ),
        "cv_folds": _sql(
            "SELECT drug_id, hospital_id, date, sales_quantity, fold FROM folded",
            "daily",
            extra=_NUMBERED.format(source="daily") + ", " + _FOLDS,
        ),
        "cv_fold_sizes": _sql(
            "SELECT drug_id, hospital_id, f.fold, count(*) FILTER (folded.fold < f.fold) AS train_rows, "
            "count(*) FILTER (folded.fold = f.fold) AS valid_rows FROM folded JOIN "
            "(SELECT CAST(unnest(range(1, 6)) AS INTEGER) AS fold) f ON folded.fold <= f.fold GROUP BY 1, 2, 3",
            "nation_daily",
            extra=_NUMBERED.format(source="nation_daily") + ", " + _FOLDS,
        ),
        "rolling_cutoffs": _sql(
            "SELECT drug_id, hospital_id, s AS train_start, CAST(c AS DATE) AS cutoff, CAST(c + INTERVAL 30 DAY AS DATE) AS valid_end FROM ("
            "SELECT drug_id, hospital_id, min(date) AS s, unnest(generate_series(CAST(max(date) - INTERVAL 30 DAY AS TIMESTAMP), "
            "CAST(min(date) + INTERVAL 365 DAY AS TIMESTAMP), INTERVAL (-90) DAY)) AS c FROM daily GROUP BY 1, 2)",
            "daily",
        ),
        "rolling_origin": _sql(
            "SELECT d.drug_id, d.hospital_id, d.date, sales_quantity, cutoff, CAST(date_diff('day', cutoff, d.date) AS INTEGER) AS horizon "
            "FROM dense d JOIN cutoffs c ON d.drug_id = c.drug_id AND d.hospital_id = c.hospital_id "
            "AND d.date > cutoff AND d.date <= CAST(cutoff + INTERVAL 30 DAY AS DATE)",
            "dense",
            extra="""cutoffs AS (SELECT drug_id, hospital_id, CAST(unnest(generate_series(CAST(max(date) - INTERVAL 30 DAY AS TIMESTAMP),
                CAST(min(date) + INTERVAL 365 DAY AS TIMESTAMP), INTERVAL (-90) DAY)) AS DATE) AS cutoff FROM daily GROUP BY 1, 2)""",
        ),
        "additive_cross_validation": _sql(
            "SELECT d.drug_id, d.hospital_id, cutoff, count(*) AS days, count(*) AS predicted_days, "
            "CAST(min(date_diff('day', cutoff, d.date)) AS INTEGER) AS first_day, CAST(max(date_diff('day', cutoff, d.date)) AS INTEGER) AS last_day, "
            "round(CAST(sum(sales_quantity) AS DOUBLE), 3) AS actual_total "
            "FROM dense d JOIN cutoffs c ON d.drug_id = c.drug_id AND d.hospital_id = c.hospital_id "
            "AND d.date > cutoff AND d.date <= CAST(cutoff + INTERVAL 30 DAY AS DATE) GROUP BY 1, 2, 3",
            "dense",
            extra=_CUTOFFS,
        ),
        "additive_trend": _sql(
            f"SELECT drug_id, hospital_id, 'trained' AS message, {_r('regr_intercept(sales_quantity, t)', 'intercept', 3)}, "
            f"{_r('regr_slope(sales_quantity, t)', 'slope', 3)}, {_r('any_value(origin)', 'origin', 3)} FROM "
            f"(SELECT *, date_diff('day', DATE '1970-01-01', min(date) OVER ({_BY_SERIES})) AS origin, "
            f"date_diff('day', min(date) OVER ({_BY_SERIES}), date) AS t FROM dense) GROUP BY 1, 2",
            "dense",
        ),
        "series_ridge": _sql(
            "SELECT drug_id, hospital_id, CAST(n AS BIGINT) AS feature_rows, "
            f"{_r('intercept', 'intercept')}, {_r('coefficient', 'coefficient')}, "
            f"{_r('sqrt(avg((y - intercept - coefficient * x) * (y - intercept - coefficient * x)))', 'rmse')}, "
            f"{_r('avg(abs(y - intercept - coefficient * x))', 'mae')} "
            "FROM numbered JOIN fits USING (drug_id, hospital_id) WHERE i > train GROUP BY drug_id, hospital_id, n, intercept, coefficient",
            "dense",
            extra=f"""lagged AS (SELECT *, sales_quantity AS y, lag(sales_quantity, 7) OVER {_W} AS x FROM dense),
                counted AS (SELECT *, row_number() OVER {_W} AS i, count(*) OVER ({_BY_SERIES}) AS n FROM lagged WHERE x IS NOT NULL),
                numbered AS (SELECT *, floor(n * {1 - config.TEST_SIZE!r}::DOUBLE) AS train FROM counted WHERE n >= 100),
                fits AS (SELECT drug_id, hospital_id, avg(y) - avg(x) * slope AS intercept, slope AS coefficient FROM (
                    SELECT *, count(*) OVER s * covar_pop(y, x) OVER s / (var_pop(x) OVER s * (count(*) OVER s + 10)) AS slope FROM numbered
                    WHERE i <= train - floor(train * {config.VALIDATION_SHARE!r}::DOUBLE) WINDOW s AS ({_BY_SERIES}))
                    GROUP BY drug_id, hospital_id, slope)""",
        ),
        "recursive_forecast": _sql(
            f"SELECT drug_id, hospital_id, CAST(date + CAST(7 * weeks AS INTEGER) AS DATE) AS date, CAST(7 * weeks - back AS INTEGER) AS step, "
            f"{_r('sales_quantity', 'predicted')} FROM (SELECT *, CAST(max(date) OVER ({_BY_SERIES}) - date AS INTEGER) AS back FROM dense) "
            "CROSS JOIN (SELECT unnest(range(1, 6)) AS weeks) WHERE back < 7 AND 7 * weeks - back <= 30",
            "dense",
        ),
        "csv_round_trip": _sql("SELECT * FROM daily", "daily"),
        "parquet_round_trip": _sql("SELECT * FROM daily", "daily"),
        # metrics
        "horizon_metrics_windowed": _sql(
            "SELECT horizon, size AS n, "
            + ", ".join(
                _r(value, name)
                for name, value in (
                    ("mse", _WINDOWED.format(m="mse")), ("rmse", f"sqrt({_WINDOWED.format(m='mse')})"),
                    ("mae", _WINDOWED.format(m="mae")), ("smape", _WINDOWED.format(m="smape")),
                )
            )
            + " FROM (SELECT t.*, f.n AS f_n, f.total AS f_total, f.mse AS f_mse, f.mae AS f_mae, f.smape AS f_smape, f.mse_total AS f_mse_total, "
            "f.mae_total AS f_mae_total, f.smape_total AS f_smape_total FROM upto t JOIN upto f ON f.total > t.total - t.size "
            "AND f.total - f.n <= t.total - t.size)",
            "dense",
            extra=f"""lag30 AS (SELECT *, lag(sales_quantity, 30) OVER {_W} AS predicted FROM dense), {_CUTOFFS},
                rows_ AS (SELECT CAST(date_diff('day', cutoff, d.date) AS INTEGER) AS horizon, sales_quantity AS y, predicted AS p
                    FROM lag30 d JOIN cutoffs c ON d.drug_id = c.drug_id AND d.hospital_id = c.hospital_id
                    AND d.date > cutoff AND d.date <= CAST(cutoff + INTERVAL 30 DAY AS DATE) WHERE predicted IS NOT NULL),
                each_ AS (SELECT horizon, count(*) AS n, sum((y - p) * (y - p)) AS mse, sum(abs(y - p)) AS mae,
                    sum(coalesce(2 * abs(y - p) / nullif(abs(y) + abs(p), 0), 0)) AS smape FROM rows_ GROUP BY horizon),
                upto AS (SELECT *, sum(n) OVER o AS total, sum(mse) OVER o AS mse_total, sum(mae) OVER o AS mae_total, sum(smape) OVER o AS smape_total,
                    CAST(greatest(floor(sum(n) OVER () * 0.1), 1) AS BIGINT) AS size FROM each_ WINDOW o AS (ORDER BY horizon))""",
        ),
        "forecast_errors": _sql(
            f"SELECT drug_id, hospital_id, date, {_rounded(['actual', 'predicted'])}, {_r('actual - predicted', 'error')}, "
            f"{_r('abs(actual - predicted)', 'abs_error')}, {_r('abs(actual - predicted) / nullif(actual, 0) * 100', 'percentage_error')} FROM preds",
            "preds",
        ),
        "error_summary": _sql(
            f"SELECT drug_id, hospital_id, count(*) AS records, {_r('avg(actual - predicted)', 'mean_error')}, "
            f"{_r('avg(abs(actual - predicted))', 'mean_abs_error')}, "
            f"{_r('avg(abs(actual - predicted) / nullif(actual, 0) * 100)', 'mean_percentage_error')}, "
            f"{_r('max(predicted)', 'max_prediction')}, {_r('min(predicted)', 'min_prediction')} FROM preds GROUP BY 1, 2",
            "preds",
        ),
        "forecast_metrics": _sql(
            f"SELECT drug_id, hospital_id, n, {_rounded([*_METRIC_NAMES, 'mean_error', 'std_error', 'max_error', 'min_error'])} FROM ("
            f"SELECT drug_id, hospital_id, count(*) AS n, {_METRICS}, avg(actual - predicted) AS mean_error, "
            "stddev_pop(actual - predicted) AS std_error, max(abs(actual - predicted)) AS max_error, "
            "min(abs(actual - predicted)) AS min_error FROM preds GROUP BY 1, 2)",
            "preds",
        ),
        "split_metrics": _sql(
            f"SELECT drug_id, hospital_id, split, n, {_rounded(_METRIC_NAMES)} FROM (SELECT drug_id, hospital_id, split, count(*) AS n, {_METRICS} "
            f"FROM (SELECT *, {_SPLIT3} AS split FROM numbered) GROUP BY 1, 2, 3)",
            "preds",
            extra=_NUMBERED.format(source="preds"),
        ),
        "evaluation_report": _sql(
            "SELECT drug_id, metric, round(value + 1e-9, 6) + 0.0 AS value FROM ("
            + _long_metrics("m", "drug_id", ["n", *_METRIC_NAMES, "mean_error", "std_error", "max_error", "min_error"])
            + ")",
            "preds",
            extra=f"m AS (SELECT drug_id, count(*) AS n, {_METRICS}, avg(actual - predicted) AS mean_error, "
            "stddev_pop(actual - predicted) AS std_error, max(abs(actual - predicted)) AS max_error, "
            "min(abs(actual - predicted)) AS min_error FROM preds GROUP BY 1)",
        ),
        "cv_summary": _sql(
            "SELECT drug_id, hospital_id, count(*) AS folds, "
            + ", ".join(f"{_r(f'avg({m})', f'{m}_mean')}, {_r(f'stddev_pop({m})', f'{m}_std')}" for m in _METRIC_NAMES)
            + " FROM m GROUP BY 1, 2",
            "preds",
            extra=_NUMBERED.format(source="preds")
            + ", "
            + _FOLDS
            + f", m AS (SELECT drug_id, hospital_id, fold, {_METRICS} FROM folded WHERE fold > 0 GROUP BY 1, 2, 3)",
        ),
        "horizon_metrics": _sql(
            "SELECT horizon, count(*) AS n, "
            f"{_r('avg((actual - predicted) * (actual - predicted))', 'mse')}, {_r('sqrt(avg((actual - predicted) * (actual - predicted)))', 'rmse')}, "
            f"{_r('avg(abs(actual - predicted))', 'mae')}, {_r('avg(abs(actual - predicted) / nullif(abs(actual), 0))', 'mape')}, "
            f"{_r('quantile_cont(abs(actual - predicted) / nullif(abs(actual), 0), 0.5)', 'mdape')}, "
            f"{_r('avg(coalesce(2 * abs(actual - predicted) / nullif(abs(actual) + abs(predicted), 0), 0))', 'smape')}, "
            f"{_r('avg(CASE WHEN actual BETWEEN predicted - 20 AND predicted + 20 THEN 1.0 ELSE 0.0 END)', 'coverage')} FROM rows_ GROUP BY horizon",
            "dense",
            extra=f"""lag30 AS (SELECT *, lag(sales_quantity, 30) OVER {_W} AS predicted FROM dense),
                cutoffs AS (SELECT drug_id, hospital_id, CAST(unnest(generate_series(CAST(max(date) - INTERVAL 30 DAY AS TIMESTAMP),
                    CAST(min(date) + INTERVAL 365 DAY AS TIMESTAMP), INTERVAL (-90) DAY)) AS DATE) AS cutoff FROM daily GROUP BY 1, 2),
                rows_ AS (SELECT CAST(date_diff('day', cutoff, d.date) AS INTEGER) AS horizon, sales_quantity AS actual, predicted
                    FROM lag30 d JOIN cutoffs c ON d.drug_id = c.drug_id AND d.hospital_id = c.hospital_id
                    AND d.date > cutoff AND d.date <= CAST(cutoff + INTERVAL 30 DAY AS DATE))""",
        ),
        "residual_histogram": _sql(
            f"SELECT drug_id, bin, {_r('lo + bin * (hi - lo) / 50', 'bin_start', 4)}, {_r('lo + (bin + 1) * (hi - lo) / 50', 'bin_end', 4)}, "
            "coalesce(n, 0) AS count FROM limits CROSS JOIN (SELECT CAST(unnest(range(0, 50)) AS INTEGER) AS bin) "
            "LEFT JOIN (SELECT drug_id, least(CAST(floor((r - lo) / ((hi - lo) / 50)) AS INTEGER), 49) AS bin, count(*) AS n "
            "FROM res JOIN limits USING (drug_id) GROUP BY 1, 2) USING (drug_id, bin)",
            "preds",
            extra="res AS (SELECT drug_id, actual - predicted AS r FROM preds), "
            "limits AS (SELECT drug_id, CASE WHEN min(r) = max(r) THEN min(r) - 0.5 ELSE min(r) END AS lo, "
            "CASE WHEN min(r) = max(r) THEN max(r) + 0.5 ELSE max(r) END AS hi FROM res GROUP BY 1)",
        ),
        "prediction_summary": _sql(
            f"SELECT drug_id, hospital_id, count(*) AS total_records, {_r('avg(predicted)', 'avg_prediction')}, "
            f"{_r('max(predicted)', 'max_prediction')}, {_r('min(predicted)', 'min_prediction')}, min(date) AS start_date, max(date) AS end_date "
            "FROM preds GROUP BY 1, 2",
            "preds",
        ),
        "model_comparison": _sql(
            f"SELECT model, {_rounded(_METRIC_NAMES)} FROM (SELECT model, {_METRICS} FROM lag_models GROUP BY model)", "lag_models"
        ),
        "running_best": _sql(
            f"SELECT drug_id, hospital_id, trial, {_r('rmse', 'score')}, {_r(f'min(rmse) OVER ({_BY_SERIES} ORDER BY trial)', 'best_so_far')} "
            f"FROM (SELECT drug_id, hospital_id, trial, {_METRICS} FROM lag_models GROUP BY 1, 2, 3)",
            "lag_models",
        ),
        "weighted_ensemble": _sql(
            f"SELECT drug_id, hospital_id, date, {_r('(0.5 * lag_1 + 0.3 * lag_7 + 0.2 * lag_30)', 'predicted')}, CAST(3 AS BIGINT) AS models "
            "FROM lags WHERE lag_30 IS NOT NULL",
            "lags",
        ),
        "batch_summary": _sql(
            "SELECT count(*) AS total, count(*) FILTER (status = 'success') AS succeeded, count(*) FILTER (status <> 'success') AS failed, "
            f"{_r('count(*) FILTER (status = chr(115)) / count(*) * 100', 'success_rate')}, ".replace("chr(115)", "'success'")
            + ", ".join(_r(f"avg({m}) FILTER (status = 'success')", f"avg_{m}") for m in ("rmse", "mae", "mape", "r2"))
            + " FROM naive_batch",
            "nation_dense",
            extra=_NAIVE,
        ),
        "failed_series": _sql(
            "SELECT drug_id, hospital_id, message, data_points FROM naive_batch WHERE status = 'failed'", "nation_dense", extra=_NAIVE
        ),
        "rmse_alert": _sql(
            f"SELECT {_r('avg(rmse)', 'avg_rmse')}, CASE WHEN avg(rmse) IS NULL THEN 'no_results' WHEN avg(rmse) > 15 THEN 'alert' ELSE 'ok' END AS status "
            "FROM naive_batch WHERE status = 'success'",
            "nation_dense",
            extra=_NAIVE,
        ),
        # drift
        "baseline_stats": _sql(
            f"SELECT feature, {_r('avg(x)', 'mean')}, {_r('stddev_samp(x)', 'std')}, {_r('min(x)', 'min')}, {_r('max(x)', 'max')}, "
            f"{_r('quantile_cont(x, 0.5)', 'median')}, {_r('quantile_cont(x, 0.25)', 'q25')}, {_r('quantile_cont(x, 0.75)', 'q75')} "
            "FROM long_samples WHERE NOT is_current GROUP BY feature",
            "long_samples",
        ),
        "sales_first_rows": _sql(
            f"SELECT {_SALES_COLUMNS} FROM sales WHERE gcode = 'Brand#2' ORDER BY create_dt, "
            + ", ".join(c.strip() for c in _SALES_COLUMNS.split(",") if c.strip() != "create_dt")
            + " LIMIT 200",
            "sales",
        ),
        "sales_date_parts": _sql(
            "SELECT part, CAST(count(create_dt) AS BIGINT) AS rows FROM ("
            "SELECT 'part_' || i AS part, CAST(DATE '1995-01-01' + CAST(1826 * i // 7 AS INTEGER) AS DATE) AS a, "
            "CAST(DATE '1995-01-01' + CAST(1826 * (i + 1) // 7 AS INTEGER) AS DATE) AS b FROM (SELECT unnest(range(0, 7)) AS i)"
            ") LEFT JOIN sales ON create_dt >= a AND create_dt < b GROUP BY part",
            "sales",
        ),
        "table_sink": _sql(f"SELECT drug_id, hospital_id, date, {_r('sales_quantity', 'sales_quantity')} FROM nation_daily", "nation_daily"),
        "expected_columns": _sql(
            "SELECT 'gcode' AS column_name, true AS present, '' AS suggestions, count(gcode) AS non_null FROM sales "
            "UNION ALL SELECT 'cust_name', true, '', count(cust_name) FROM sales "
            "UNION ALL SELECT 'price', false, 'invoice_price', NULL UNION ALL SELECT 'CREATE_DT', false, 'create_dt', NULL "
            "UNION ALL SELECT 'nothing', false, '', NULL",
            "sales",
        ),
        "described_table": _sql(
            " UNION ALL ".join(
                f"SELECT '{c}' AS column_name, '{t}' AS data_type, false AS is_partition, count(DISTINCT {c}) AS distinct_values FROM sales"
                for c, t in (("gcode", "string"), ("create_dt", "date"), ("qty", "double"), ("cust_name", "string"))
            ),
            "sales",
        ),
        "run_log": _sql(
            " UNION ALL ".join(
                f"SELECT 'lag_{n}' AS run, metric, {_r('value', 'value', 4)}, '{{\"lag\": {n}}}' AS params FROM ("
                f"UNPIVOT (SELECT rmse, mae, r2 FROM (SELECT {_METRICS} FROM (SELECT sales_quantity AS actual, lag_{n} AS predicted FROM lags WHERE lag_{n} IS NOT NULL))) "
                "ON rmse, mae, r2 INTO NAME metric VALUE value)"
                for n in (1, 7)
            ),
            "lags",
        ),
        "boosting_first_split": _boosting_first_split(),
        "stage_round_trip": _boosting_first_split(leaves_only=True),
        "series_first_splits": _series_first_splits(),
        "ordered_encoding": _ordered_encoding(),
        "trend_intervals": _trend_intervals(),
        "ks_exact": _ks_exact(),
        "ks_drift": _sql(
            f"SELECT feature, {_rounded(['statistic', 'p_value'])}, n_baseline, n_current, p_value < 0.05 AS is_drift FROM tested",
            "long_samples",
            extra=_KS_ALL,
        ),
        "chi2_drift": _sql(
            f"SELECT feature, {_rounded(['statistic'])}, dof, n_baseline, n_current FROM chi2", "long_samples", extra=_CHI2
        ),
        "aligned_bins": _sql(
            "SELECT feature, CAST(bin AS INTEGER) AS bin, b AS n_baseline, c AS n_current FROM cells", "long_samples", extra=_BINS
        ),
        "sales_ks_drift": _sql(
            f"SELECT feature, {_rounded(['statistic'])}, n_baseline, n_current FROM ks",
            "dense",
            extra=f"""rolled AS MATERIALIZED (SELECT *, {_lag_list([7])}, {_rolling([7, 30], ["mean", "max"], digits=6)} FROM dense),
                stacked AS ("""
            + " UNION ALL ".join(
                f"SELECT date >= DATE '1998-07-01' AS is_current, '{c}' AS feature, {c} AS x FROM rolled"
                for c in (
                    "sales_quantity", "sales_quantity_lag_7", "sales_quantity_rolling_7_mean", "sales_quantity_rolling_7_max",
                    "sales_quantity_rolling_30_mean", "sales_quantity_rolling_30_max",
                )
            )
            + "), "
            + _KS.format(source="stacked"),
        ),
        "detect_drift": _sql(
            f"SELECT feature, p_value < 0.05 AS is_drift, {_rounded(['statistic', 'p_value'])}, 'ks' AS method, CAST(NULL AS VARCHAR) AS error FROM tested",
            "long_samples",
            extra=_KS_ALL,
        ),
        "detect_drift_chi2": _sql(
            f"SELECT feature, p_value < 0.05 AS is_drift, {_rounded(['statistic', 'p_value'])}, 'chi2' AS method, "
            f"CAST(NULL AS VARCHAR) AS error FROM (SELECT feature, statistic, {_CHI2_P} AS p_value FROM chi2)",
            "long_samples",
            extra=_CHI2,
        ),
        "drift_summary": _sql(
            "SELECT count(*) AS features, count(*) FILTER (p_value < 0.5) AS drifted, "
            f"{_r('count(*) FILTER (p_value < 0.5) / count(*)', 'drift_ratio')} FROM tested",
            "long_samples",
            extra=_KS_ALL,
        ),
        "drift_report_drifted": _sql(
            "SELECT 'summary' AS section, 'all' AS feature, count(*) AS features, count(*) FILTER (p_value < 0.7) AS drifted, "
            f"{_r('count(*) FILTER (p_value < 0.7) / count(*)', 'drift_ratio')}, CAST(NULL AS VARCHAR) AS method, "
            "CAST(NULL AS DOUBLE) AS statistic, CAST(NULL AS DOUBLE) AS p_value FROM tested "
            f"UNION ALL SELECT 'drifted', feature, NULL, NULL, NULL, 'ks', {_rounded(['statistic', 'p_value'])} FROM tested WHERE p_value < 0.7",
            "long_samples",
            extra=_KS_ALL,
        ),
        "drift_report": _sql(
            "SELECT 'summary' AS section, 'all' AS feature, count(*) AS features, count(*) FILTER (p_value < 0.5) AS drifted, "
            f"{_r('count(*) FILTER (p_value < 0.5) / count(*)', 'drift_ratio')}, CAST(NULL AS VARCHAR) AS method, "
            "CAST(NULL AS DOUBLE) AS statistic, CAST(NULL AS DOUBLE) AS p_value FROM tested "
            f"UNION ALL SELECT 'drifted', feature, NULL, NULL, NULL, 'ks', {_rounded(['statistic', 'p_value'])} FROM tested WHERE p_value < 0.5",
            "long_samples",
            extra=_KS_ALL,
        ),
        "performance_drift": _sql(
            "SELECT drug_id, metric, CASE WHEN b = 0 THEN abs(c - b) ELSE abs((c - b) / b) END > 0.02 AS is_drift, "
            f"{_r('b', 'baseline')}, {_r('c', 'current')}, {_r('CASE WHEN b = 0 THEN abs(c - b) ELSE abs((c - b) / b) END', 'relative_change')}, "
            f"{_r('c - b', 'absolute_change')} FROM (SELECT e.drug_id, e.metric, e.value AS b, l.value AS c FROM early_long e JOIN late_long l USING (drug_id, metric))",
            "preds",
            extra=f"""early AS (SELECT drug_id, {_METRICS} FROM preds WHERE date < DATE '1998-07-01' GROUP BY 1),
                late AS (SELECT drug_id, {_METRICS} FROM preds WHERE date >= DATE '1998-07-01' GROUP BY 1),
                early_long AS ({_long_metrics('early', 'drug_id', _METRIC_NAMES)}),
                late_long AS ({_long_metrics('late', 'drug_id', _METRIC_NAMES)})""",
        ),
        # feature store
        "pit_join": """
            WITH e AS (SELECT event_id, user_id, ts FROM events WHERE event_type = 'error'),
            f AS (SELECT user_id, ts AS fts, event_type, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id, ts
                  ORDER BY event_type DESC, value DESC) AS rn FROM events WHERE event_type <> 'error') WHERE rn = 1)
            SELECT event_id, e.user_id, ts, CASE WHEN fts >= ts - INTERVAL 1 DAY THEN event_type END AS last_type,
                   CASE WHEN fts >= ts - INTERVAL 1 DAY THEN value END AS last_value
            FROM e ASOF LEFT JOIN f ON e.user_id = f.user_id AND e.ts >= f.fts""",
        "historical_features": _sql(
            "SELECT e.gcode, e.cust_name, e.event_timestamp, "
            "CASE WHEN v.create_dt >= e.event_timestamp - INTERVAL 365 DAY THEN round(v.sales_quantity_lag_1 + 1e-9, 5) + 0.0 END AS sales_quantity_lag_1, "
            "CASE WHEN v.create_dt >= e.event_timestamp - INTERVAL 365 DAY THEN round(v.sales_quantity_rolling_30_mean + 1e-9, 5) + 0.0 END AS sales_quantity_rolling_30_mean, "
            "CASE WHEN v.create_dt >= e.event_timestamp - INTERVAL 365 DAY THEN CAST(v.month AS INTEGER) END AS month, "
            "CASE WHEN h.event_timestamp >= e.event_timestamp - INTERVAL 3650 DAY THEN h.prod_cat1 END AS prod_cat1, "
            "CASE WHEN h.event_timestamp >= e.event_timestamp - INTERVAL 3650 DAY THEN h.dosage_form END AS dosage_form "
            "FROM entity e ASOF LEFT JOIN view_rows v ON e.gcode = v.gcode AND e.cust_name = v.cust_name AND e.event_timestamp >= v.create_dt "
            "ASOF LEFT JOIN product_history h ON e.gcode = h.gcode AND e.event_timestamp >= h.event_timestamp",
            "dense",
            extra=f"{_VIEW}, {_HISTORY}, entity AS (SELECT drug_id AS gcode, hospital_id AS cust_name, CAST(date + INTERVAL 45 DAY AS DATE) AS event_timestamp FROM daily)",
        ),
        "materialize": _sql(
            "SELECT gcode, cust_name, create_dt, month, dayofweek, quarter, is_weekend, "
            + ", ".join(f"round(CAST(CAST({c} AS FLOAT) AS DOUBLE) + 1e-9, 3) + 0.0 AS {c}" for c in _VIEW_FLOATS)
            + " FROM (SELECT *, row_number() OVER (PARTITION BY gcode, cust_name ORDER BY create_dt DESC) AS rn FROM view_rows "
            "WHERE create_dt BETWEEN DATE '1996-01-01' AND DATE '1999-06-30') WHERE rn = 1",
            "dense",
            extra=_VIEW,
        ),
        "latest_lookup": """
            SELECT c_custkey AS user_id, event_type, value FROM customer LEFT JOIN (
                SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn
                FROM events WHERE event_type <> 'error') WHERE rn = 1) l ON c_custkey = l.user_id""",
        "prepared_for_store": _sql(
            "SELECT drug_id AS gcode, hospital_id AS cust_name, CAST(date AS TIMESTAMP) AS event_timestamp, sales_quantity FROM daily", "daily"
        ),
        # models
        "fourier_features": _sql(f"SELECT date, {_fourier()} FROM (SELECT DISTINCT date FROM daily)", "daily"),
        "batch_training_status": _sql(
            "SELECT drug_id, hospital_id, CASE WHEN data_points < 100 OR days < 140 THEN 'failed' ELSE 'success' END AS status, "
            "CASE WHEN data_points < 100 THEN 'not enough data points (' || data_points || ' < 100)' "
            "WHEN days < 140 THEN 'not enough rows after features (' || greatest(days - 90, 0) || ')' ELSE 'trained' END AS message, "
            "data_points FROM (SELECT drug_id, hospital_id, count(*) AS data_points, date_diff('day', min(date), max(date)) + 1 AS days "
            "FROM nation_series GROUP BY 1, 2)",
            "nation_series",
        ),
        "batch_prediction_coverage": _sql(
            "SELECT drug_id, hospital_id, coalesce(greatest(days - 90, 0), 0) AS predictions, "
            "CAST(coalesce(days, 0) <= 90 AS BIGINT) AS errors "
            "FROM (SELECT DISTINCT p_brand AS drug_id FROM part) CROSS JOIN (SELECT unnest(['AUTOMOBILE', 'BUILDING', "
            "'FURNITURE', 'HOUSEHOLD', 'MACHINERY', 'WHOLESALE']) AS hospital_id) LEFT JOIN "
            "(SELECT drug_id, hospital_id, CASE WHEN count(*) >= 100 THEN date_diff('day', min(date), max(date)) + 1 END AS days "
            "FROM series GROUP BY 1, 2) USING (drug_id, hospital_id)",
            "series",
        ),
        "stacking_weights": _sql(
            f"SELECT feature, {_r('weight', 'weight', 4)} FROM (SELECT 'lag_1' AS feature, b1 AS weight FROM b "
            "UNION ALL SELECT 'lag_7', b7 FROM b UNION ALL SELECT 'intercept', my - b1 * m1 - b7 * m7 FROM b)",
            "lags",
            extra="""c AS (SELECT var_pop(lag_1) AS s11, var_pop(lag_7) AS s77, covar_pop(lag_1, lag_7) AS s17,
                    covar_pop(lag_1, sales_quantity) AS s1y, covar_pop(lag_7, sales_quantity) AS s7y,
                    avg(lag_1) AS m1, avg(lag_7) AS m7, avg(sales_quantity) AS my FROM lags WHERE lag_7 IS NOT NULL),
                b AS (SELECT *, (s77 * s1y - s17 * s7y) / (s11 * s77 - s17 * s17) AS b1,
                    (s11 * s7y - s17 * s1y) / (s11 * s77 - s17 * s17) AS b7 FROM c)""",
        ),
        "future_days": _sql(
            "SELECT drug_id, hospital_id, CAST(unnest(generate_series(max(date) + INTERVAL 1 DAY, max(date) + INTERVAL 30 DAY, INTERVAL 1 DAY)) AS DATE) AS date, "
            "true AS is_future FROM daily GROUP BY 1, 2",
            "daily",
        ),
        "future_weeks": _sql(
            "SELECT drug_id, hospital_id, date, false AS is_future FROM daily UNION ALL "
            "SELECT drug_id, hospital_id, CAST(unnest(generate_series(CAST(f AS TIMESTAMP), f + INTERVAL 49 DAY, INTERVAL 7 DAY)) AS DATE), true FROM ("
            "SELECT drug_id, hospital_id, CAST(max(date) + 1 + CAST(7 - isodow(max(date) + 1) AS INTEGER) AS DATE) AS f FROM daily GROUP BY 1, 2)",
            "daily",
        ),
        "future_months": _sql(
            "SELECT drug_id, hospital_id, last_day(CAST(p AS DATE)) AS date, true AS is_future FROM ("
            "SELECT drug_id, hospital_id, unnest(generate_series(CAST(date_trunc('month', max(date) + 1) AS TIMESTAMP), "
            "date_trunc('month', max(date) + 1) + INTERVAL 5 MONTH, INTERVAL 1 MONTH)) AS p FROM daily GROUP BY 1, 2)",
            "daily",
        ),
    }
    return out

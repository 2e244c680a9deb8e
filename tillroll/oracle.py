"""The registered queries as plain SQL for a second engine.

Each statement starts from the base tables and counts everything directly, without
the pre-aggregations the Spark jobs use.
"""

from __future__ import annotations

from tillroll.operators.assertions import FACT_PARENTS, NOT_NULL, UNIQUE
from tillroll.operators.personal_data import PATTERNS
from tillroll.sinks.tables import PUBLISHED
from tillroll.sources.inference import TAKES, WRITTEN

# Views every statement may start from, in dependency order.
VIEWS = {
    "stg_orders": """
        SELECT o_orderkey AS order_id, o_custkey AS user_id,
               CAST(row_number() OVER hist AS INTEGER) AS order_number,
               CAST(extract(dow FROM CAST(o_orderdate AS DATE)) AS INTEGER) AS order_dow,
               CAST(o_orderkey % 24 AS INTEGER) AS order_hour_of_day,
               CAST(date_diff('day', lag(o_orderdate) OVER hist, o_orderdate) AS INTEGER) AS days_since_prior_order,
               CAST(o_orderdate AS DATE) AS order_date
        FROM orders
        WINDOW hist AS (PARTITION BY o_custkey ORDER BY CAST(o_orderdate AS DATE), o_orderkey)""",
    "stg_products": """
        SELECT p_partkey AS product_id, p_name AS product_name, p_size AS aisle_id,
               CAST(substring(p_brand, 7) AS INTEGER) AS department_id
        FROM part""",
    "stg_order_products": """
        SELECT order_id, product_id,
               CAST(row_number() OVER (PARTITION BY order_id ORDER BY first_line, product_id) AS INTEGER)
                   AS add_to_cart_order,
               reordered
        FROM (SELECT l_orderkey AS order_id, l_partkey AS product_id, min(l_linenumber) AS first_line,
                     CAST(max(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) AS INTEGER) AS reordered
              FROM lineitem GROUP BY ALL) grain""",
    "stg_aisles": """
        SELECT DISTINCT p_size AS aisle_id, 'aisle_' || p_size AS aisle_name FROM part""",
    "stg_departments": """
        SELECT DISTINCT department_id, 'department_' || department_id AS department_name FROM stg_products""",
    "batch_runs": """
        SELECT event_id AS run_id, CAST(ts AS DATE) AS run_date, ts AS started_at,
               ts + to_seconds(CAST(floor(value * 10) AS BIGINT)) AS completed_at,
               CAST(floor(value * 10) AS INTEGER) AS duration_seconds,
               user_id * 1000 AS rows_processed,
               floor(value * 10) <= 1800 AS sla_met,
               CAST(1 AS DOUBLE) - CAST(event_id % 20 AS DOUBLE) / 100 AS quality_score,
               CASE WHEN event_type = 'error' THEN 'failed' ELSE 'success' END AS status,
               CAST(NULL AS VARCHAR) AS error_message, CAST(NULL AS VARCHAR) AS notes
        FROM events""",
    "fct_orders": """
        SELECT l.order_id, o.user_id, l.product_id, p.department_id, p.aisle_id,
               o.order_hour_of_day AS order_hour, o.order_dow, o.days_since_prior_order,
               l.reordered, l.add_to_cart_order,
               CAST(strftime(o.order_date, '%Y%m%d') AS INTEGER) AS order_date_id, o.order_date
        FROM stg_order_products l
        JOIN stg_orders o ON o.order_id = l.order_id
        JOIN stg_products p ON p.product_id = l.product_id""",
    "dim_users": """
        SELECT user_id, total_orders, days_since_first_order, 0 AS days_since_last_order,
               avg_days_between_orders, reorder_rate,
               CASE WHEN total_orders >= 10 THEN 'high_frequency'
                    WHEN total_orders >= 5 THEN 'medium' ELSE 'low_frequency' END AS user_segment
        FROM (SELECT o.user_id,
                     count(DISTINCT o.order_id) AS total_orders,
                     max(o.order_number) - min(o.order_number) AS days_since_first_order,
                     round(avg(o.days_since_prior_order)) AS avg_days_between_orders,
                     count(*) FILTER (l.reordered = 1) / CAST(nullif(count(DISTINCT l.product_id), 0) AS DOUBLE)
                         AS reorder_rate
              FROM stg_orders o LEFT JOIN stg_order_products l ON l.order_id = o.order_id
              GROUP BY o.user_id) u""",
    "dim_products": """
        SELECT p.product_id, p.product_name, p.aisle_id, 'Aisle_' || p.aisle_id AS aisle_name,
               p.department_id, 'Department_' || p.department_id AS department_name,
               count(*) FILTER (l.reordered = 1) AS reorder_count,
               coalesce(count(*) FILTER (l.reordered = 1) / CAST(nullif(count(DISTINCT l.order_id), 0) AS DOUBLE), 0)
                   AS reorder_rate
        FROM stg_products p LEFT JOIN stg_order_products l ON l.product_id = p.product_id
        GROUP BY p.product_id, p.product_name, p.aisle_id, p.department_id""",
    "dim_departments": """
        SELECT d.department_id, d.department_name, count(DISTINCT p.product_id) AS total_products,
               count(DISTINCT l.order_id) AS total_orders
        FROM stg_departments d
        LEFT JOIN stg_products p ON p.department_id = d.department_id
        LEFT JOIN stg_order_products l ON l.product_id = p.product_id
        GROUP BY d.department_id, d.department_name""",
    "dim_aisles": """
        SELECT a.aisle_id, a.aisle_name, h.department_id
        FROM stg_aisles a
        LEFT JOIN (SELECT aisle_id, department_id,
                          row_number() OVER (PARTITION BY aisle_id ORDER BY count(*) DESC, department_id) AS pos
                   FROM stg_products GROUP BY aisle_id, department_id) h
          ON h.aisle_id = a.aisle_id AND h.pos = 1""",
    "dim_time": """
        SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_id, CAST(d AS DATE) AS order_date,
               CAST(extract(dow FROM d) AS INTEGER) AS order_dow, dayname(d) AS day_of_week_name,
               CAST(weekofyear(d) AS INTEGER) AS week_of_year, CAST(month(d) AS INTEGER) AS month,
               CAST(quarter(d) AS INTEGER) AS quarter, CAST(year(d) AS INTEGER) AS year,
               CASE WHEN extract(dow FROM d) IN (0, 6) THEN 1 ELSE 0 END AS is_weekend
        FROM (SELECT unnest(generate_series(min(order_date), max(order_date), INTERVAL 1 DAY)) AS d
              FROM stg_orders) days""",
    "dim_products_scd": """
        SELECT product_id, product_name, aisle_id, department_id, DATE '1995-01-01' AS valid_from,
               DATE '9999-12-31' AS valid_to, TRUE AS is_current
        FROM stg_products""",
    "product_funnel": """
        SELECT o.order_date AS metric_date, o.order_dow,
               count(DISTINCT o.user_id) AS daily_users,
               count(DISTINCT o.order_id) AS daily_orders,
               count(DISTINCT p.product_id) AS daily_products_added,
               count(*) FILTER (l.reordered = 1) AS daily_reordered_items,
               count(DISTINCT o.order_id) FILTER (l.reordered = 1) AS orders_with_reorders,
               count(DISTINCT o.order_id) / CAST(nullif(count(DISTINCT o.user_id), 0) AS DOUBLE) AS orders_per_user,
               count(DISTINCT p.product_id) / CAST(nullif(count(DISTINCT o.order_id), 0) AS DOUBLE)
                   AS avg_items_per_order,
               coalesce(count(*) FILTER (l.reordered = 1)
                        / CAST(nullif(count(DISTINCT l.product_id), 0) AS DOUBLE), 0) AS reorder_rate
        FROM stg_orders o
        LEFT JOIN stg_order_products l ON l.order_id = o.order_id
        LEFT JOIN stg_products p ON p.product_id = l.product_id
        GROUP BY o.order_date, o.order_dow""",
    "user_retention": """
        SELECT *, CASE WHEN total_orders = 1 THEN 'single_order' WHEN total_orders <= 5 THEN 'light_user'
                       WHEN total_orders <= 20 THEN 'medium_user' ELSE 'heavy_user' END AS user_cohort
        FROM (SELECT user_id, count(DISTINCT order_id) AS total_orders,
                     max(order_number) - min(order_number) AS order_span
              FROM stg_orders GROUP BY user_id) u""",
    "department_performance": """
        SELECT *, CASE WHEN order_volume_rank <= 5 THEN 'top_tier'
                       WHEN order_volume_rank <= 10 THEN 'mid_tier' ELSE 'emerging' END AS performance_tier
        FROM (SELECT *, dense_rank() OVER (ORDER BY total_orders DESC) AS order_volume_rank,
                     dense_rank() OVER (ORDER BY reordered_items DESC) AS reorder_rank
              FROM (SELECT p.department_id,
                           count(DISTINCT o.order_id) AS total_orders,
                           count(DISTINCT o.user_id) AS unique_users,
                           count(DISTINCT l.product_id) AS unique_products,
                           count(*) FILTER (l.reordered = 1) AS reordered_items,
                           count(DISTINCT l.product_id) AS total_items_added,
                           coalesce(count(*) FILTER (l.reordered = 1)
                                    / CAST(nullif(count(DISTINCT l.product_id), 0) AS DOUBLE), 0) AS reorder_rate,
                           coalesce(count(DISTINCT o.order_id) FILTER (l.reordered = 1)
                                    / CAST(nullif(count(DISTINCT o.order_id), 0) AS DOUBLE), 0)
                               AS orders_with_reorders_pct
                    FROM stg_products p
                    LEFT JOIN stg_order_products l ON l.product_id = p.product_id
                    LEFT JOIN stg_orders o ON o.order_id = l.order_id
                    GROUP BY p.department_id) d) r""",
    "department_dow_cohorts": """
        SELECT p.department_id, o.order_dow, count(DISTINCT o.user_id) AS users_by_dow,
               count(DISTINCT o.order_id) AS orders_by_dow,
               count(*) FILTER (l.reordered = 1) / CAST(nullif(count(DISTINCT l.product_id), 0) AS DOUBLE)
                   AS reorder_rate_by_dow
        FROM stg_products p
        LEFT JOIN stg_order_products l ON l.product_id = p.product_id
        LEFT JOIN stg_orders o ON o.order_id = l.order_id
        GROUP BY p.department_id, o.order_dow""",
    "daily_product_metrics": """
        SELECT f.order_date, f.product_id, d.product_name, d.department_id,
               count(*) AS daily_orders, count(DISTINCT f.user_id) AS daily_unique_users,
               round(100e0 * count(*) FILTER (f.reordered = 1) / count(*), 2) AS daily_reorder_rate,
               count(DISTINCT f.order_id) AS daily_distinct_orders
        FROM fct_orders f JOIN dim_products d ON d.product_id = f.product_id
        GROUP BY f.order_date, f.product_id, d.product_name, d.department_id""",
    # Product versions after the second snapshot, worked out case by case.
    "versions": """
        SELECT product_id, product_name, aisle_id,
               CASE WHEN aisle_id BETWEEN 20 AND 29 AND NOT first_version THEN department_id + 100
                    ELSE department_id END AS department_id,
               CASE WHEN first_version THEN DATE '1995-01-01' ELSE DATE '1997-01-01' END AS valid_from,
               CASE WHEN first_version AND (aisle_id = 50 OR aisle_id BETWEEN 20 AND 29)
                    THEN DATE '1997-01-01' ELSE DATE '9999-12-31' END AS valid_to,
               NOT (first_version AND (aisle_id = 50 OR aisle_id BETWEEN 20 AND 29)) AS is_current
        FROM stg_products, (VALUES (TRUE), (FALSE)) v(first_version)
        WHERE CASE WHEN first_version THEN aisle_id <> 1 ELSE aisle_id = 1 OR aisle_id BETWEEN 20 AND 29 END""",
    "raw_catalogue": """
        SELECT CAST(p_partkey AS VARCHAR) AS product_id,
               CASE WHEN p_size < 10 THEN p_brand ELSE CAST(p_size AS VARCHAR) END AS aisle_id,
               p_brand AS department_id
        FROM part""",
    "sales": """
        SELECT product_id, count(DISTINCT order_id) AS orders, count(*) AS lines,
               count(*) FILTER (reordered = 1) AS again,
               count(*) FILTER (reordered = 1) / CAST(count(*) AS DOUBLE) AS share
        FROM fct_orders GROUP BY product_id""",
    "day_users": """
        SELECT order_dow, count(DISTINCT user_id) AS users FROM fct_orders GROUP BY order_dow""",
}


def _mentioned(text: str) -> set[str]:
    words = set("".join(ch if ch.isalnum() or ch == "_" else " " for ch in text).split())
    return words & set(VIEWS)


def with_views(body: str) -> str:
    """Put the views a statement uses, and those they use, in front of it."""
    needed, todo = set(), _mentioned(body)
    while todo:
        name = todo.pop()
        if name not in needed:
            needed.add(name)
            todo |= _mentioned(VIEWS[name])
    ctes = [f"{name} AS ({text})" for name, text in VIEWS.items() if name in needed]
    return ("WITH " + ",\n".join(ctes) + "\n" if ctes else "") + body


def union_all(parts) -> str:
    return "\nUNION ALL\n".join(parts)


def _six(body: str, *columns: str) -> str:
    """Round doubles that are not rounded by definition."""
    replaced = ", ".join(f"round({c}, 6) AS {c}" for c in columns)
    return f"SELECT * REPLACE ({replaced}) FROM ({body}) q"


UNIQUE_COLUMNS = [(t, c) for t, columns in UNIQUE.items() for c in columns]
TEXT_COLUMNS = {
    "documents": ["text", "lang", "source"],
    "conversations": ["role", "text"],
    "pages": ["url", "html"],
    "customer": ["c_name", "c_mktsegment"],
}


def _nulls(table: str, column: str, label: str | None = None) -> str:
    return (
        f"SELECT '{label or table}' AS table_name, '{column}' AS column_name, "
        f"count(*) FILTER ({column} IS NULL) AS failures FROM {table}"
    )


def _repeated(table: str, column: str, label: str | None = None) -> str:
    return (
        f"SELECT '{label or table}' AS table_name, '{column}' AS column_name, count(*) AS failures "
        f"FROM (SELECT {column} FROM {table} WHERE {column} IS NOT NULL GROUP BY {column} HAVING count(*) > 1) q"
    )


def _orphans(child: str, parent: str, column: str) -> str:
    return (
        f"SELECT '{child}' AS table_name, '{column}' AS column_name, '{parent}' AS parent_table, "
        f"count(*) AS failures FROM {child} c WHERE c.{column} IS NOT NULL "
        f"AND NOT EXISTS (SELECT 1 FROM {parent} p WHERE p.{column} = c.{column})"
    )


def _out_of(table: str, column: str, low: float, high: float) -> str:
    return (
        f"SELECT '{table}' AS table_name, '{column}' AS column_name, CAST({low} AS DOUBLE) AS low, "
        f"CAST({high} AS DOUBLE) AS high, count(*) FILTER ({column} < {low} OR {column} > {high}) AS failures "
        f"FROM {table}"
    )


def _pii(table: str) -> str:
    return union_all(
        f"SELECT '{table}' AS table_name, '{c}' AS column_name, '{kind}' AS pii_type, "
        f"count(*) FILTER (regexp_matches(lower({c}), '{pattern}')) AS matches FROM {table}"
        for c in TEXT_COLUMNS[table]
        for kind, pattern in PATTERNS.items()
    )


def _rule(table: str, kind: str, column: str, violations: str) -> str:
    return (
        f"SELECT '{table}' AS table_name, '{kind}' AS rule, '{column}' AS column_name, 'error' AS severity, "
        f"CAST({violations} AS BIGINT) AS violations FROM stg_{table}"
    )


def _validation() -> str:
    columns = {
        "orders": [
            "order_id", "user_id", "order_number", "order_dow", "order_hour_of_day", "days_since_prior_order",
        ],
        "products": ["product_id", "product_name", "aisle_id", "department_id"],
        "aisles": ["aisle_id", "aisle_name"],
        "departments": ["department_id", "department_name"],
        "order_products": ["order_id", "product_id", "add_to_cart_order", "reordered"],
    }
    least = {"orders": 100000, "products": 1000, "aisles": 50, "departments": 5, "order_products": 100000}
    bad = {
        ("orders", "order_id"): "order_id < 1",
        ("orders", "user_id"): "user_id < 1",
        ("orders", "order_dow"): "order_dow < 0 OR order_dow > 6",
        ("orders", "order_hour_of_day"): "order_hour_of_day < 0 OR order_hour_of_day > 23",
        ("products", "product_id"): "product_id < 1",
        ("products", "aisle_id"): "aisle_id < 1",
        ("products", "department_id"): "department_id < 1",
        ("order_products", "add_to_cart_order"): "add_to_cart_order < 1",
    }
    keys = [("orders", "order_id"), ("products", "product_id"), ("aisles", "aisle_id"), ("departments", "department_id")]
    parts = [_rule(t, "type", c, "0 * count(*)") for t, cs in columns.items() for c in cs]
    # order_date is the one column beyond the declared layout.
    parts.append(
        "SELECT 'orders' AS table_name, 'extra_column' AS rule, 'order_date' AS column_name, "
        "'warning' AS severity, CAST(1 AS BIGINT) AS violations"
    )
    parts += [_rule(t, "range", c, f"count(*) FILTER ({cond})") for (t, c), cond in bad.items()]
    parts += [_rule(t, "unique", c, f"count(*) - count(DISTINCT {c}) - max(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END)") for t, c in keys]
    parts.append(_rule("order_products", "values", "reordered", "count(*) FILTER (reordered IS NULL OR reordered NOT IN (0, 1))"))
    parts += [_rule(t, "min_rows", "*", f"greatest({n} - count(*), 0)") for t, n in least.items()]
    return (
        "SELECT *, severity = 'warning' OR violations = 0 AS passed FROM (" + union_all(parts) + ") checks"
    )


def _scorecard() -> str:
    nulls = "count(*) FILTER (order_id IS NULL) / CAST(nullif(count(*), 0) AS DOUBLE)"
    twice = "CAST(count(*) - count(DISTINCT (order_id, product_id)) AS DOUBLE)"
    share = "count(*) FILTER (reordered = 1) / CAST(nullif(count(*), 0) AS DOUBLE)"
    size = "CAST(count(*) AS DOUBLE)"

    def one(name, column, value, expected, passed, anomaly):
        return (
            f"SELECT '{name}' AS metric_name, {column} AS column_name, v AS metric_value, "
            f"CAST({expected} AS DOUBLE) AS expected_value, {passed} AS passed, {anomaly} AS anomaly_detected "
            f"FROM (SELECT {value} AS v FROM fct_orders) m"
        )

    parts = [
        one("null_rate", "'order_id'", nulls, 0, "v = 0", "v > 0.05"),
        one("duplicate_count", "'order_id, product_id'", twice, 0, "v = 0", "v > 0"),
        one("row_count", "CAST(NULL AS VARCHAR)", size, 3000000, "v > 0", "abs(v - 3000000) > 300000"),
        one("reorder_rate", "'reordered'", share, 0.5, "v BETWEEN 0 AND 1", "v < 0.1 OR v > 0.9"),
    ]
    return (
        "SELECT metric_name, 'fact_orders' AS table_name, column_name, round(metric_value, 6) AS metric_value, "
        "expected_value, round(metric_value, 6) AS actual_value, passed, anomaly_detected, "
        "avg(CASE WHEN passed THEN 1e0 ELSE 0e0 END) OVER () AS quality_score "
        "FROM (" + union_all(parts) + ") metrics"
    )


def _results() -> list[tuple[str, str, str, str]]:
    """(category, table, column, failures SQL) of every table test."""
    tests = [("not_null", t, c, _nulls(t, c)) for t, cs in NOT_NULL.items() for c in cs]
    tests += [("unique", t, c, _repeated(t, c)) for t, c in UNIQUE_COLUMNS]
    tests.append(("row_count", "fct_orders", "*", "SELECT CASE WHEN count(*) = 0 THEN 1 ELSE 0 END AS failures FROM fct_orders"))
    for parent, c in FACT_PARENTS.items():
        tests.append(("relationships", "fct_orders", c, _orphans("fct_orders", parent, c)))
    tests.append(("range", "dim_products", "reorder_rate", _out_of("dim_products", "reorder_rate", 0, 1)))
    tests.append(
        ("range", "daily_product_metrics", "daily_reorder_rate", _out_of("daily_product_metrics", "daily_reorder_rate", 0, 100))
    )
    tests.append(
        (
            "invariant",
            "daily_product_metrics",
            "daily_orders",
            "SELECT count(*) FILTER (daily_orders < daily_distinct_orders) AS failures FROM daily_product_metrics",
        )
    )
    return tests


def _test_summary() -> str:
    rows = union_all(
        f"SELECT '{cat}' AS category, '{t}' AS table_name, (SELECT failures FROM ({sql}) f) = 0 AS passed"
        for cat, t, _, sql in _results()
    )
    return (
        "SELECT coalesce(category, 'all') AS category, coalesce(table_name, 'all') AS table_name, "
        "count(*) AS total_tests, count(*) FILTER (passed) AS passed, count(*) FILTER (NOT passed) AS failed, "
        "round(100e0 * count(*) FILTER (passed) / count(*), 6) AS pass_rate "
        f"FROM ({rows}) results GROUP BY GROUPING SETS ((category), (table_name), ())"
    )


def _counts(*tables: tuple[str, str]) -> str:
    return union_all(f"SELECT '{label}' AS table_name, count(*) AS row_count FROM {t}" for label, t in tables)


THREE = [("fact_orders", "fct_orders"), ("dim_users", "dim_users"), ("dim_products", "dim_products")]
RANK = "round(100e0 * {n} / sum({n}) OVER (), 2)"
UPSERTED = """
    SELECT f.* REPLACE (f.add_to_cart_order + CASE WHEN f.order_id > top // 2 THEN 1000 ELSE 0 END
                        AS add_to_cart_order)
    FROM fct_orders f, (SELECT max(order_id) AS top FROM stg_orders) m"""


def _day_name(dow: str) -> str:
    names = "'Sunday','Monday','Tuesday','Wednesday','Thursday','Friday','Saturday'"
    return f"[{names}][{dow} + 1]"


def _inferred(name: str, value: str, table: str, declared: str | None) -> str:
    """One column's type from all its values."""
    casts = {"long": "BIGINT", "double": "DOUBLE", "date": "DATE", "timestamp": "TIMESTAMP", "boolean": "BOOLEAN"}
    cases = " ".join(
        f"WHEN count(*) FILTER (x IS NOT NULL AND NOT (regexp_matches(x, '{pattern}') AND TRY_CAST(x AS {casts[kind]}) IS NOT NULL)) = 0 THEN '{kind}'"
        for kind, pattern in WRITTEN.items()
    )
    takes = ", ".join(f"'{k}'" for k in sorted(TAKES[declared])) if declared else ""
    drift = f"coalesce(inferred_type NOT IN ({takes}), FALSE)" if declared else "FALSE"
    label = f"'{declared}'" if declared else "CAST(NULL AS VARCHAR)"
    return f"""
        SELECT *, {label} AS declared_type, {drift} AS drift FROM (
            SELECT '{name}' AS column_name, count(x) AS value_count, count(*) - count(x) AS null_count,
                   CAST(max(length(x)) AS INTEGER) AS longest, CASE WHEN count(x) = 0 THEN NULL {cases} ELSE 'string' END AS inferred_type
            FROM (SELECT {value} AS x FROM {table}) t) m"""


def statements() -> dict[str, str]:
    q: dict[str, str] = {}

    # sources and sinks
    q["load_staging"] = union_all(
        f"SELECT '{t}' AS table_name, count(*) AS row_count, CAST(sum({k}) AS BIGINT) AS key_sum, "
        f"CAST(sum({v}) AS BIGINT) AS value_sum FROM {t}"
        for t, k, v in [
            ("stg_orders", "order_id", "order_dow + order_hour_of_day + coalesce(days_since_prior_order, 0)"),
            ("stg_products", "product_id", "aisle_id + department_id + length(product_name || ', 12\" \"thin\"')"),
            ("stg_aisles", "aisle_id", "length(aisle_name)"),
            ("stg_departments", "department_id", "length(department_name)"),
            ("stg_order_products", "order_id", "product_id + add_to_cart_order + reordered"),
        ]
    )
    q["source_inventory"] = union_all(
        [
            f"SELECT '{name}' AS name, count(*) AS rows, TRUE AS present, TRUE AS has_bytes FROM {t}"
            for name, t in [
                ("orders.csv", "stg_orders"),
                ("products.csv", "stg_products"),
                ("aisles.csv", "stg_aisles"),
                ("departments.csv", "stg_departments"),
                ("order_products__train.csv", "stg_order_products"),
            ]
        ]
        + ["SELECT 'returns.csv', CAST(NULL AS BIGINT), FALSE, CAST(NULL AS BOOLEAN)"]
    )
    for name in ("stg_orders", "stg_products", "stg_order_products"):
        q[name] = f"SELECT * FROM {name}"
    q["write_mart"] = _six("SELECT * FROM dim_products", "reorder_rate")
    q["upsert_fact"] = UPSERTED
    q["merge_fact_blocks"] = UPSERTED
    q["append_run_log"] = (
        "SELECT run_id, CAST(run_date AS VARCHAR) AS run_date, duration_seconds, rows_processed, sla_met, "
        "round(quality_score, 6) AS quality_score, status FROM batch_runs"
    )
    q["append_ops_table"] = "SELECT run_id, run_date, duration_seconds, sla_met, status FROM batch_runs"
    q["publish_marts"] = _counts(*[(t, t) for t in PUBLISHED])

    # validation
    affected = "(SELECT count(*) FROM part)"
    q["check_columns"] = union_all(
        f"SELECT '{rule}' AS rule, '{c}' AS column_name, '{severity}' AS severity, {affected} AS rows_affected"
        for rule, c, severity in [
            ("missing_column", "product_name", "error"),
            ("extra_column", "name", "warning"),
            ("extra_column", "kind", "warning"),
        ]
    )
    q["check_types"] = union_all(
        f"SELECT '{c}' AS column_name, '{t}' AS declared_type, "
        f"count(*) FILTER ({c} IS NOT NULL AND TRY_CAST({c} AS {sql_type}) IS NULL) AS violations FROM raw_catalogue"
        for c, t, sql_type in [
            ("product_id", "bigint", "BIGINT"),
            ("aisle_id", "int", "INTEGER"),
            ("department_id", "int", "INTEGER"),
        ]
    )
    q["check_min_max"] = union_all(
        f"SELECT '{c}' AS column_name, '{side}' AS bound, count(*) FILTER ({c} {op} {limit}) AS violations "
        "FROM stg_orders"
        for c, side, op, limit in [
            ("order_id", "min", "<", 1),
            ("order_dow", "min", "<", 0),
            ("order_dow", "max", ">", 6),
            ("order_hour_of_day", "min", "<", 6),
            ("order_hour_of_day", "max", ">", 22),
            ("days_since_prior_order", "min", "<", 0),
            ("days_since_prior_order", "max", ">", 365),
        ]
    )
    q["check_unique"] = union_all(
        f"SELECT '{label}' AS column_name, CAST(sum(n - 1) AS BIGINT) AS duplicates "
        f"FROM (SELECT count(*) AS n FROM {t} GROUP BY {c}) g"
        for label, c, t in [
            ("order_id", "order_id", "stg_orders"),
            ("product_name", "product_name", "stg_products"),
            ("days_since_prior_order", "days_since_prior_order", "stg_orders"),
            ("line_order", "l_orderkey", "lineitem"),
        ]
    )
    q["check_values"] = union_all(
        f"SELECT '{c}' AS column_name, CAST({c} AS VARCHAR) AS invalid_value, count(*) AS violations FROM {t} "
        f"WHERE {c} IS NULL OR {c} NOT IN ({allowed}) GROUP BY {c}"
        for c, t, allowed in [
            ("order_dow", "stg_orders", "1, 2, 3, 4, 5"),
            ("reordered", "stg_order_products", "0, 1"),
            ("order_number", "stg_orders", "1, 2, 3, 4, 5, 6, 7, 8, 9, 10"),
        ]
    )
    q["check_min_rows"] = union_all(
        f"SELECT '{t}' AS table_name, count(*) AS row_count, {n} AS min_rows, count(*) >= {n} AS passed FROM stg_{t}"
        for t, n in [("orders", 100000), ("products", 1000), ("order_products", 10000)]
    )
    q["validate_tables"] = _validation()
    q["validation_summary"] = (
        "SELECT count(*) FILTER (ok) AS tables_passed, count(*) AS tables_checked "
        f"FROM (SELECT table_name, bool_and(passed) AS ok FROM ({_validation()}) v GROUP BY table_name) t"
    )
    q["pii_scan"] = _pii("documents")
    q["pii_summary"] = (
        "SELECT table_name, count(*) FILTER (matches > 0) AS findings, CAST(sum(matches) AS BIGINT) AS matches, "
        "sum(matches) = 0 AS clean FROM (" + union_all(_pii(t) for t in TEXT_COLUMNS) + ") s GROUP BY table_name"
    )

    # table tests and quality
    q["test_not_null"] = union_all(
        [_nulls(t, c) for t, cs in NOT_NULL.items() for c in cs]
        + [_nulls("stg_orders", "days_since_prior_order", "stg_orders_gap")]
    )
    q["test_unique"] = union_all(
        [_repeated(t, c) for t, c in UNIQUE_COLUMNS] + [_repeated("stg_products", "product_name", "stg_products_name")]
    )
    q["test_row_count_gt_zero"] = union_all(
        f"SELECT '{label}' AS table_name, count(*) AS row_count FROM {t} HAVING count(*) = 0"
        for label, t in [
            ("fct_orders", "fct_orders"),
            ("undated_lines", "(SELECT 1 AS one FROM lineitem WHERE l_shipdate IS NULL) u"),
        ]
    )
    q["test_null_rate"] = union_all(
        f"SELECT 'stg_orders' AS table_name, '{c}' AS column_name, round(r, 6) AS null_rate FROM "
        f"(SELECT count(*) FILTER ({c} IS NULL) / CAST(nullif(count(*), 0) AS DOUBLE) AS r FROM stg_orders) n "
        "WHERE r > 0.05"
        for c in ("days_since_prior_order", "user_id")
    )
    q["test_relationships"] = union_all(
        [
            *[_orphans("fct_orders", parent, c) for parent, c in FACT_PARENTS.items()],
            _orphans("stg_orders", "fct_orders", "order_id"),
        ]
    )
    q["test_accepted_range"] = union_all(
        [
            _out_of("dim_products", "reorder_rate", 0, 1),
            _out_of("daily_product_metrics", "daily_reorder_rate", 0, 100),
            _out_of("dim_users", "reorder_rate", 0, 0.5),
        ]
    )
    q["test_metric_invariants"] = (
        "SELECT 'daily_product_metrics' AS table_name, 'daily_orders' AS column_name, "
        "count(*) FILTER (daily_orders < daily_distinct_orders) AS failures FROM daily_product_metrics"
    )
    q["test_summary"] = _test_summary()
    q["dq_null_rate"] = (
        "SELECT r AS null_rate, r = 0 AS passed, r > 0.05 AS anomaly_detected FROM "
        "(SELECT count(*) FILTER (order_id IS NULL) / CAST(nullif(count(*), 0) AS DOUBLE) AS r FROM fct_orders) m"
    )
    q["dq_duplicate_count"] = (
        "SELECT n AS duplicate_count, n = 0 AS passed, n > 0 AS anomaly_detected FROM "
        "(SELECT count(*) - count(DISTINCT (order_id, product_id)) AS n FROM fct_orders) m"
    )
    q["dq_row_count"] = (
        "SELECT count(*) AS row_count, CAST(3000000 AS BIGINT) AS expected_rows, count(*) > 0 AS passed, "
        "abs(count(*) - 3000000) > 300000 AS anomaly_detected FROM fct_orders"
    )
    q["dq_reorder_rate"] = (
        "SELECT round(r, 6) AS reorder_rate, r BETWEEN 0 AND 1 AS passed, r < 0.1 OR r > 0.9 AS anomaly_detected FROM "
        "(SELECT count(*) FILTER (reordered = 1) / CAST(nullif(count(*), 0) AS DOUBLE) AS r FROM fct_orders) m"
    )
    q["dq_scorecard"] = _scorecard()
    q["dq_row_count_change"] = """
        SELECT table_name, run_date, row_count, previous_count, round(change, 6) AS change,
               coalesce(abs(change) > 0.2, FALSE) AS anomaly_detected
        FROM (SELECT *, (row_count - previous_count) / CAST(nullif(previous_count, 0) AS DOUBLE) AS change
              FROM (SELECT event_type AS table_name, CAST(ts AS DATE) AS run_date, count(*) AS row_count,
                           lag(count(*)) OVER (PARTITION BY event_type ORDER BY CAST(ts AS DATE)) AS previous_count
                    FROM events GROUP BY event_type, CAST(ts AS DATE)) h) c"""
    q["warehouse_counts"] = _counts(*THREE)

    # star schema and marts
    for name, doubles in {
        "fct_orders": (),
        "dim_users": ("avg_days_between_orders", "reorder_rate"),
        "dim_products": ("reorder_rate",),
        "dim_products_scd": (),
        "dim_departments": (),
        "dim_aisles": (),
        "dim_time": (),
        "product_funnel": ("orders_per_user", "avg_items_per_order", "reorder_rate"),
        "user_retention": (),
        "department_performance": ("reorder_rate", "orders_with_reorders_pct"),
        "department_dow_cohorts": ("reorder_rate_by_dow",),
        "daily_product_metrics": (),
    }.items():
        body = f"SELECT * FROM {name}"
        q[name] = _six(body, *doubles) if doubles else body
    q["product_funnel_anchored"] = _six(
        VIEWS["product_funnel"].replace(
            "o.order_date", "CAST(DATE '2024-01-01' + CAST(o.order_id % 365 AS INTEGER) AS DATE)"
        ),
        "orders_per_user", "avg_items_per_order", "reorder_rate",
    )
    q["scd2_merge"] = "SELECT * FROM versions"
    q["scd2_as_of"] = """
        SELECT v.department_id, count(*) AS lines, count(DISTINCT l.product_id) AS products
        FROM stg_order_products l
        JOIN stg_orders o ON o.order_id = l.order_id
        LEFT JOIN versions v
          ON v.product_id = l.product_id AND v.valid_from <= o.order_date AND o.order_date < v.valid_to
        GROUP BY v.department_id"""
    q["derive_reordered"] = """
        SELECT l.order_id, l.product_id, o.user_id,
               CASE WHEN row_number() OVER (PARTITION BY o.user_id, l.product_id
                                            ORDER BY o.order_date, o.order_id) > 1 THEN 1 ELSE 0 END AS reordered
        FROM stg_order_products l JOIN stg_orders o ON o.order_id = l.order_id"""
    q["derive_order_sequence"] = "SELECT order_id, user_id, order_number, days_since_prior_order FROM stg_orders"

    # dashboards
    q["health_daily"] = """
        SELECT order_dow AS day_of_week, count(DISTINCT user_id) AS daily_active_users,
               count(DISTINCT order_id) AS daily_orders, count(DISTINCT product_id) AS unique_products_ordered,
               round(count(DISTINCT product_id) / CAST(count(DISTINCT order_id) AS DOUBLE), 2) AS avg_items_per_order,
               round(count(*) FILTER (reordered = 1) / CAST(count(*) AS DOUBLE), 2) AS reorder_rate
        FROM fct_orders GROUP BY order_dow"""
    q["health_top_reorder"] = """
        SELECT s.product_id, d.product_name, s.orders AS times_ordered, round(s.share, 3) AS reorder_rate,
               d.department_name
        FROM sales s JOIN dim_products d ON d.product_id = s.product_id
        WHERE s.orders >= 10 ORDER BY reorder_rate DESC, s.product_id LIMIT 20"""
    q["health_department_share"] = f"""
        SELECT *, {RANK.format(n='total_orders')} AS pct_of_orders
        FROM (SELECT d.department_id, d.department_name, count(DISTINCT f.order_id) AS total_orders,
                     count(DISTINCT f.product_id) AS unique_products
              FROM fct_orders f JOIN dim_products d ON d.product_id = f.product_id
              GROUP BY d.department_id, d.department_name) g"""
    q["health_user_segments"] = f"""
        SELECT user_segment, user_count, avg_orders, avg_reorder_rate, {RANK.format(n='n')} AS pct_of_users
        FROM (SELECT user_segment, count(DISTINCT user_id) AS user_count, round(avg(total_orders), 1) AS avg_orders,
                     round(avg(reorder_rate), 3) AS avg_reorder_rate, count(*) AS n
              FROM dim_users GROUP BY user_segment) g"""
    q["retention_cohorts"] = f"""
        SELECT user_cohort, user_count, avg_orders_per_user, avg_order_span, {RANK.format(n='n')} AS pct_of_users
        FROM (SELECT user_cohort, count(DISTINCT user_id) AS user_count,
                     round(avg(total_orders), 1) AS avg_orders_per_user,
                     round(avg(order_span), 1) AS avg_order_span, count(*) AS n
              FROM user_retention GROUP BY user_cohort) g"""
    q["retention_order_frequency"] = f"""
        SELECT total_orders, user_count, {RANK.format(n='n')} AS pct_of_users
        FROM (SELECT total_orders, count(DISTINCT user_id) AS user_count, count(*) AS n
              FROM user_retention GROUP BY total_orders) g
        ORDER BY total_orders LIMIT 30"""
    q["retention_reorder_windows"] = f"""
        SELECT reorder_window, order_count, {RANK.format(n='order_count')} AS pct_of_orders
        FROM (SELECT CASE WHEN days_since_prior_order IS NULL THEN 'First Order'
                          WHEN days_since_prior_order <= 7 THEN '1-7 days'
                          WHEN days_since_prior_order <= 14 THEN '8-14 days'
                          WHEN days_since_prior_order <= 30 THEN '15-30 days' ELSE '30+ days' END AS reorder_window,
                     count(*) AS order_count
              FROM fct_orders GROUP BY ALL) g"""
    q["retention_segment_rate"] = """
        SELECT user_segment, round(avg(reorder_rate), 3) AS avg_reorder_rate, count(DISTINCT user_id) AS user_count,
               round(stddev_samp(reorder_rate), 6) AS reorder_rate_variance
        FROM dim_users GROUP BY user_segment"""
    q["funnel_daily"] = """
        SELECT metric_date, daily_users AS users, daily_orders AS orders,
               round(daily_orders / CAST(nullif(daily_users, 0) AS DOUBLE), 2) AS conversion_rate,
               round(daily_products_added / CAST(nullif(daily_orders, 0) AS DOUBLE), 2) AS avg_items_per_order,
               round(daily_reordered_items / CAST(nullif(daily_products_added, 0) AS DOUBLE), 3) AS reorder_rate
        FROM product_funnel ORDER BY metric_date DESC, order_dow LIMIT 30"""
    q["funnel_top_reordered"] = """
        SELECT s.product_id, d.product_name, d.department_name, s.orders AS times_ordered, s.again AS reorder_count,
               round(s.share, 3) AS reorder_rate
        FROM sales s JOIN dim_products d ON d.product_id = s.product_id
        WHERE s.orders >= 5 ORDER BY s.again DESC, s.product_id LIMIT 25"""
    q["funnel_department"] = """
        SELECT d.department_name, count(DISTINCT f.order_id) AS order_count, count(DISTINCT f.user_id) AS unique_users,
               round(count(DISTINCT f.order_id) / CAST(count(DISTINCT f.user_id) AS DOUBLE), 2) AS orders_per_user,
               round(count(*) FILTER (f.reordered = 1) / CAST(count(*) AS DOUBLE), 3) AS reorder_rate
        FROM fct_orders f JOIN dim_products d ON d.product_id = f.product_id
        GROUP BY d.department_name"""
    q["funnel_cart_composition"] = """
        SELECT CASE WHEN items = 1 THEN '1 item' WHEN items <= 5 THEN '2-5 items' WHEN items <= 10 THEN '6-10 items'
                    WHEN items <= 20 THEN '11-20 items' ELSE '20+ items' END AS order_size,
               count(*) AS order_count, round(avg(share), 3) AS avg_reorder_rate
        FROM (SELECT order_id, count(DISTINCT product_id) AS items,
                     round(count(*) FILTER (reordered = 1) / CAST(count(*) AS DOUBLE), 3) AS share
              FROM fct_orders GROUP BY order_id) b
        GROUP BY ALL"""

    # run log
    newest = "ORDER BY run_date DESC, started_at DESC, run_id DESC"
    q["ops_latest_run"] = (
        "SELECT run_id, run_date, started_at, completed_at, duration_seconds, sla_met, "
        f"round(quality_score, 6) AS quality_score, status, notes FROM batch_runs {newest} LIMIT 1"
    )
    q["ops_sla_trend"] = """
        SELECT run_date, count(*) AS total_runs, count(*) FILTER (sla_met) AS sla_met_count,
               round(100e0 * count(*) FILTER (sla_met) / count(*), 2) AS sla_compliance_pct,
               round(avg(duration_seconds), 0) AS avg_duration_sec, max(duration_seconds) AS max_duration_sec
        FROM batch_runs GROUP BY run_date ORDER BY run_date DESC LIMIT 30"""
    q["ops_quality_trend"] = """
        SELECT run_date, count(*) AS run_count, round(avg(quality_score), 3) AS avg_quality_score,
               round(min(quality_score), 3) AS min_quality_score, round(max(quality_score), 3) AS max_quality_score
        FROM batch_runs GROUP BY run_date ORDER BY run_date DESC LIMIT 30"""
    q["ops_volume"] = """
        SELECT run_date, CAST(sum(rows_processed) AS BIGINT) AS total_rows_processed, count(*) AS run_count,
               round(avg(rows_processed), 0) AS avg_rows_per_run
        FROM batch_runs WHERE status = 'success' GROUP BY run_date ORDER BY run_date DESC LIMIT 30"""
    q["ops_table_counts"] = (
        f"SELECT *, round(row_count / 1000000e0, 2) AS millions_of_rows FROM ({_counts(*THREE)}) c"
    )
    minutes = "epoch(completed_at - started_at) / 60"
    q["api_pipeline_health"] = (
        "SELECT CAST(30 AS DOUBLE) AS sla_threshold_mins, "
        "round(100e0 * count(*) FILTER (sla_met) / count(*), 1) AS sla_compliance_rate, "
        f"round(avg({minutes}), 1) AS avg_duration_mins FROM batch_runs"
    )
    q["api_recent_runs"] = (
        f"SELECT run_date AS date, round({minutes}, 1) AS duration_mins, rows_processed AS rows, sla_met, status, "
        f"notes FROM batch_runs {newest} LIMIT 10"
    )
    q["log_runs"] = """
        SELECT run_date, started_at, completed_at, duration_seconds, rows_processed, sla_met,
               round(quality_score, 6) AS quality_score, status, error_message,
               'Quality score: ' || printf('%.2f', quality_score) || ', Fact rows: '
                   || format('{:,}', rows_processed) AS notes
        FROM batch_runs"""
    q["sla_breaches"] = """
        SELECT run_id, run_date, duration_seconds, 1800 AS threshold_seconds,
               'SLA breached: ' || duration_seconds || 's > 1800s' AS alert
        FROM batch_runs WHERE duration_seconds > 1800"""
    q["sla_compliance"] = """
        SELECT run_date, count(*) AS total_runs, count(*) FILTER (sla_met) AS sla_met_count,
               round(100e0 * count(*) FILTER (sla_met) / count(*), 2) AS sla_compliance_pct,
               round(avg(quality_score), 6) AS avg_quality_score
        FROM batch_runs WHERE run_date >= DATE '2024-01-25' - 7 GROUP BY run_date"""

    # headline figures
    q["api_metrics"] = """
        SELECT count(*) AS fact_orders, count(DISTINCT user_id) AS users, count(DISTINCT product_id) AS products,
               round(100e0 * count(*) FILTER (reordered = 1) / count(*), 2) AS reorder_rate
        FROM fct_orders"""
    q["api_daily_stats"] = f"""
        SELECT order_dow, {_day_name('order_dow')} AS day, count(DISTINCT user_id) AS users,
               round(100e0 * count(*) FILTER (reordered = 1) / count(*), 1) AS reorder_rate
        FROM fct_orders GROUP BY order_dow"""
    q["api_top_products"] = """
        SELECT d.product_name, count(*) AS times_ordered,
               CAST(round(100e0 * count(*) FILTER (f.reordered = 1) / count(*)) AS INTEGER) AS reorder_rate
        FROM fct_orders f JOIN dim_products d ON d.product_id = f.product_id
        GROUP BY d.product_name ORDER BY times_ordered DESC, d.product_name LIMIT 10"""
    q["adhoc_select"] = """
        SELECT *, count(*) OVER () AS row_count
        FROM (SELECT d.department_id, d.product_id, d.product_name, count(*) AS times_ordered
              FROM fct_orders f JOIN dim_products d ON d.product_id = f.product_id
              GROUP BY d.department_id, d.product_id, d.product_name) a
        ORDER BY times_ordered DESC, product_id LIMIT 100"""
    q["reorder_rate_overall"] = """
        SELECT count(*) AS total_items, count(*) FILTER (reordered = 1) AS reordered_items,
               round(100e0 * count(*) FILTER (reordered = 1) / count(*), 2) AS reorder_rate
        FROM fct_orders"""
    q["habit_products"] = (
        "SELECT count(*) AS products, round(avg(orders), 6) AS avg_orders FROM sales WHERE orders >= 10 AND share >= 0.5"
    )
    q["peak_day"] = (
        f"SELECT order_dow, {_day_name('order_dow')} AS day, users FROM day_users ORDER BY users DESC, order_dow LIMIT 1"
    )
    q["day_vs_week_avg"] = """
        SELECT order_dow, users, round(avg(users) OVER (), 2) AS week_avg,
               round(100e0 * (users - avg(users) OVER ()) / avg(users) OVER (), 2) AS pct_vs_avg
        FROM day_users"""
    q["sticky_products"] = """
        SELECT product_id, lines AS times_ordered, round(share, 6) AS reorder_rate
        FROM sales WHERE share > 0.5 ORDER BY share DESC, lines DESC, product_id"""
    q["product_reorder_rate"] = "SELECT product_id, round(avg(reordered), 6) AS reorder_rate FROM fct_orders GROUP BY product_id"
    q["avg_basket_size"] = """
        SELECT count(*) AS orders, round(avg(items), 6) AS avg_basket_size
        FROM (SELECT order_id, count(DISTINCT product_id) AS items FROM fct_orders GROUP BY order_id) b"""
    q["product_penetration"] = """
        SELECT product_id, orders, round(100e0 * orders / (SELECT count(DISTINCT order_id) FROM fct_orders), 4)
                   AS pct_of_orders
        FROM sales"""
    q["product_day_drilldown"] = """
        SELECT * FROM daily_product_metrics
        WHERE product_id = 1 AND order_date = (SELECT max(order_date) FROM fct_orders WHERE product_id = 1)"""

    # day by day
    q["incremental_daily_metrics"] = q["daily_product_metrics"]
    q["incremental_product_funnel"] = q["product_funnel"]
    q["users_by_weekday"] = "SELECT order_dow, count(DISTINCT user_id) AS users FROM stg_orders GROUP BY order_dow"
    q["incremental_order_sequence"] = q["derive_order_sequence"]
    q["rejected_rows"] = """
        SELECT 'order_dow' AS column_name, 'Sunday' AS value, 'int' AS wanted, count(*) AS row_count FROM stg_orders WHERE order_id % 50 = 0
        UNION ALL SELECT 'order_hour_of_day', 'noon', 'int', count(*) FROM stg_orders WHERE order_id % 70 = 0
        UNION ALL SELECT 'accepted', NULL, NULL, count(*) FROM stg_orders WHERE order_id % 50 <> 0 AND order_id % 70 <> 0
        UNION ALL SELECT 'rejected', NULL, NULL, count(*) FROM stg_orders WHERE order_id % 50 = 0 OR order_id % 70 = 0"""
    q["publish_changes"] = """
        SELECT 'dim_products' AS table_name, CAST(department_id AS VARCHAR) AS part, count(*) AS source_rows, count(*) AS copy_rows,
               department_id % 5 = 0 AS written, TRUE AS equal
        FROM dim_products GROUP BY department_id"""
    day = "CAST(CAST(o_orderdate AS DATE) AS VARCHAR)"
    q["infer_types"] = union_all(
        _inferred(*column)
        for column in [
            ("product_id", "CAST(p_partkey AS VARCHAR)", "part", "long"),
            ("product_name", "p_name", "part", None),
            ("aisle_id", "CASE WHEN p_size < 10 THEN p_brand ELSE CAST(p_size AS VARCHAR) END", "part", "int"),
            ("price", "CASE WHEN p_size > 1 THEN p_size || '.50' END", "part", "long"),
            ("nothing", "CASE WHEN p_size > 100 THEN 'never' END", "part", "int"),
            ("large", "CAST(p_size > 10 AS VARCHAR)", "part", "boolean"),
            ("order_date", day, "orders", "timestamp"),
            ("ordered_at", f"{day} || ' 10:30:00'", "orders", "date"),
        ]
    )
    q["stream_arrivals"] = "SELECT * FROM stg_order_products"

    # the batch
    built = [
        "fct_orders", "dim_users", "dim_products", "dim_departments", "dim_aisles", "dim_products_scd",
        "user_retention", "department_performance", "department_dow_cohorts",
    ]
    anchored = "(SELECT *, CAST(DATE '2024-01-01' + CAST(order_id % 365 AS INTEGER) AS DATE) AS day FROM {}) a"
    parts = [f"SELECT '{t}' AS item, count(*) AS value FROM {t}" for t in built]
    parts += [
        "SELECT 'dim_time', CAST(max(day) - min(day) + 1 AS BIGINT) FROM " + anchored.format("stg_orders"),
        "SELECT 'product_funnel', count(*) FROM (SELECT DISTINCT day, order_dow FROM "
        + anchored.format("stg_orders") + ") x",
        "SELECT 'daily_product_metrics', count(*) FROM (SELECT DISTINCT day, product_id FROM "
        + anchored.format("fct_orders") + ") x",
        f"SELECT 'rules_checked', (SELECT count(*) FROM ({_validation()}) v WHERE rule <> 'extra_column')",
        f"SELECT 'tests_passed', CAST({len(_results())} AS BIGINT)",
        "SELECT 'run_rows_processed', count(*) FROM fct_orders",
        "SELECT 'sla_breaches', CAST(0 AS BIGINT)",
    ]
    q["run_batch"] = union_all(parts)
    return {name: with_views(body) for name, body in q.items()}

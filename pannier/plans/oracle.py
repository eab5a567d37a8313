"""The registered queries in SQL over the same Parquet tables, for DuckDB."""

from __future__ import annotations

from pannier.sources.schemas import CANDIDATES, MASTER

# Written out here, so that a wrong constant of the engine shows.
KS = (1, 3, 5, 10)
SAMPLE_ORDERS, SAMPLE_USERS, THRESHOLD = 1000, 100, 0.16
CATEGORICAL = "order_dow order_hour_of_day trigger_product_id recommended_product_id recommended_department_id".split()
NUMERIC = "days_since_prior_order order_number cart_size trigger_reordered support confidence lift".split()
RANGES = {
    "order_dow": (0, 6),
    "order_hour_of_day": (0, 23),
    "order_number": (1, None),
    "days_since_prior_order": (0, 30),
}

# Named sub-queries in dependency order: name -> (names it reads, body).
_PARTS: dict[str, tuple[list[str], str]] = {
    "part_products": (
        [],
        """SELECT p_partkey, CAST(split_part(p_brand, '#', 2) AS BIGINT) AS product_id, p_brand AS product_name
        FROM part""",
    ),
    "products_c": (
        ["part_products"],
        """SELECT DISTINCT product_id, product_name, CAST((product_id - 1) // 5 + 1 AS INTEGER) AS department_id
        FROM part_products""",
    ),
    "departments_c": (
        ["products_c"],
        """SELECT DISTINCT department_id, 'Department#' || CAST(department_id AS VARCHAR) AS department
        FROM products_c""",
    ),
    "orders_c": (
        [],
        """SELECT o_orderkey AS order_id, o_custkey AS user_id,
          CASE WHEN lead(o_orderkey) OVER w IS NULL THEN 'train' ELSE 'prior' END AS eval_set,
          CAST(row_number() OVER w AS INTEGER) AS order_number,
          CAST(dayofweek(o_orderdate) AS INTEGER) AS order_dow,
          CAST(o_orderkey % 24 AS INTEGER) AS order_hour_of_day,
          CAST(date_diff('day', lag(o_orderdate) OVER w, o_orderdate) AS DOUBLE) AS days_since_prior_order
        FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)""",
    ),
    "lines_c": (
        ["part_products", "orders_c"],
        """SELECT l.order_id, l.product_id, l.add_to_cart_order,
          CAST(coalesce(o.order_number > min(o.order_number) OVER (PARTITION BY o.user_id, l.product_id), false)
            AS INTEGER) AS reordered
        FROM (SELECT order_id, product_id,
            CAST(row_number() OVER (PARTITION BY order_id ORDER BY line, product_id) AS INTEGER) AS add_to_cart_order
          FROM (SELECT l_orderkey AS order_id, product_id, min(l_linenumber) AS line
            FROM lineitem JOIN part_products ON l_partkey = p_partkey GROUP BY 1, 2)) l
        LEFT JOIN orders_c o ON o.order_id = l.order_id""",
    ),
    "prior_c": (["orders_c"], "SELECT * FROM orders_c WHERE eval_set = 'prior'"),
    "order_sample": (
        ["prior_c"],
        f"""SELECT order_id FROM prior_c
        ORDER BY md5('sample:' || CAST(order_id AS VARCHAR) || ':42'), order_id LIMIT {SAMPLE_ORDERS}""",
    ),
    "user_sample": (
        ["prior_c"],
        f"""SELECT user_id FROM (SELECT DISTINCT user_id FROM prior_c)
        ORDER BY md5('sample:' || CAST(user_id AS VARCHAR) || ':42'), user_id LIMIT {SAMPLE_USERS}""",
    ),
    "full_master": (
        ["prior_c", "lines_c", "products_c", "departments_c"],
        """SELECT order_id, order_dow, order_hour_of_day,
          coalesce(days_since_prior_order, -1.0) AS days_since_prior_order, order_number, product_id,
          add_to_cart_order, reordered, product_name, department_id, department, user_id,
          CASE WHEN substr(md5(CAST(order_id AS VARCHAR) || ':42'), 1, 8) < '33333333'
            THEN 'test' ELSE 'train' END AS split
        FROM prior_c JOIN lines_c USING (order_id) JOIN products_c USING (product_id)
          JOIN departments_c USING (department_id)""",
    ),
    "train_lines": (["full_master"], "SELECT * FROM full_master WHERE split = 'train'"),
    "test_lines": (["full_master"], "SELECT * FROM full_master WHERE split = 'test'"),
    "type_lines": (
        [],
        """SELECT l_orderkey AS order_id, p_type AS product_name
        FROM lineitem JOIN part ON l_partkey = p_partkey""",
    ),
}


def _add_rules(x: str, lines: str, min_confidence: float) -> None:
    """Sub-queries for the pair rules of ``lines`` under the prefix ``x``."""
    _PARTS[f"{x}_items"] = ([lines], f"SELECT DISTINCT order_id, product_name AS item FROM {lines}")
    _PARTS[f"{x}_n"] = ([f"{x}_items"], f"SELECT CAST(count(DISTINCT order_id) AS DOUBLE) AS n FROM {x}_items")
    _PARTS[f"{x}_singles"] = (
        [f"{x}_items", f"{x}_n"],
        f"""SELECT item, count(*) AS freq, CAST(count(*) AS DOUBLE) / (SELECT n FROM {x}_n) AS support
        FROM {x}_items GROUP BY item""",
    )
    _PARTS[f"{x}_pairs"] = (
        [f"{x}_items", f"{x}_n"],
        f"""SELECT * FROM (SELECT a.item AS item_a, b.item AS item_b, count(*) AS freq,
            CAST(count(*) AS DOUBLE) / (SELECT n FROM {x}_n) AS support
          FROM {x}_items a JOIN {x}_items b ON a.order_id = b.order_id AND a.item < b.item GROUP BY 1, 2)
        WHERE support >= 0.01""",
    )
    _PARTS[f"{x}_rules"] = (
        [f"{x}_pairs", f"{x}_singles"],
        f"""SELECT antecedent, consequent, a.support AS antecedent_support, c.support AS consequent_support,
          d.support, d.support / a.support AS confidence, d.support / a.support / c.support AS lift
        FROM (SELECT item_a AS antecedent, item_b AS consequent, support FROM {x}_pairs
          UNION ALL SELECT item_b, item_a, support FROM {x}_pairs) d
        JOIN {x}_singles a ON a.item = antecedent JOIN {x}_singles c ON c.item = consequent
        WHERE d.support / a.support >= {min_confidence}""",
    )


def _add_candidates(x: str, lines: str, rules: str) -> None:
    """Sub-queries for the candidates of ``lines`` under ``rules``."""
    _PARTS[f"{x}_products"] = (
        [lines],
        f"SELECT DISTINCT product_id, product_name, department_id, department FROM {lines}",
    )
    _PARTS[f"{x}_candidates"] = (
        [lines, rules, f"{x}_products"],
        f"""SELECT l.order_id, l.order_dow, l.order_hour_of_day, l.days_since_prior_order, l.order_number,
          l.add_to_cart_order AS cart_size, l.product_id AS trigger_product_id,
          l.product_name AS trigger_product_name, l.reordered AS trigger_reordered,
          p.product_id AS recommended_product_id, p.product_name AS recommended_product_name,
          p.department_id AS recommended_department_id, p.department AS recommended_department_name,
          r.support, r.confidence, r.lift,
          CAST(coalesce(b.add_to_cart_order > l.add_to_cart_order, false) AS INTEGER) AS label
        FROM {lines} l JOIN {rules} r ON r.antecedent = l.product_name
        LEFT JOIN {lines} b ON b.order_id = l.order_id AND b.product_name = r.consequent
        LEFT JOIN {x}_products p ON p.product_name = r.consequent""",
    )


def _add_rankings(x: str) -> None:
    """Sub-queries for rankings of the candidates ``x`` by confidence."""
    _PARTS[f"{x}_ranked"] = (
        [f"{x}_candidates"],
        f"""SELECT *, row_number() OVER (PARTITION BY order_id, trigger_product_id
          ORDER BY confidence DESC, recommended_product_id) AS rank FROM {x}_candidates""",
    )
    _PARTS[f"{x}_first"] = (
        [f"{x}_candidates"],
        f"""SELECT order_id, recommended_product_id, cart_size, trigger_product_id, confidence, label
        FROM (SELECT *, row_number() OVER (PARTITION BY order_id, recommended_product_id
          ORDER BY cart_size, trigger_product_id) AS nth FROM {x}_candidates) WHERE nth = 1""",
    )
    _PARTS[f"{x}_order_ranked"] = (
        [f"{x}_first"],
        f"""SELECT *, row_number() OVER (PARTITION BY order_id
          ORDER BY confidence DESC, recommended_product_id) AS rank FROM {x}_first""",
    )
    measures = ", ".join(
        f"coalesce(CAST(sum(label) FILTER (rank <= {k}) AS DOUBLE) / count(*) FILTER (rank <= {k}), 0) AS precision_{k}, "
        f"CASE WHEN sum(label) > 0 THEN CAST(sum(label) FILTER (rank <= {k}) AS DOUBLE) / sum(label) ELSE 0.0 END AS recall_{k}"
        for k in KS
    )
    _PARTS[f"{x}_by_order"] = ([f"{x}_order_ranked"], f"SELECT order_id, {measures} FROM {x}_order_ranked GROUP BY order_id")
    _PARTS[f"{x}_by_group"] = (
        [f"{x}_ranked"],
        f"SELECT order_id, trigger_product_id, sum(label) AS positives, {measures} FROM {x}_ranked GROUP BY 1, 2",
    )


_add_rules("train", "train_lines", 0.15)
_add_rules("test", "test_lines", 0.15)
_add_rules("all", "full_master", 0.15)
_add_candidates("train", "train_lines", "train_rules")
_add_candidates("test", "test_lines", "test_rules")
_add_candidates("honest", "test_lines", "train_rules")
_add_rankings("test")
_add_rankings("honest")

_PARTS |= {
    "both_candidates": (
        ["train_candidates", "test_candidates"],
        "SELECT * FROM train_candidates UNION ALL SELECT * FROM test_candidates",
    ),
    "all_catalogue": (
        ["full_master"],
        "SELECT DISTINCT product_id, product_name, department_id, department FROM full_master",
    ),
    "both_expanded": (
        ["train_lines", "test_lines", "train_rules", "test_rules"],
        """SELECT l.order_id, l.product_name, l.add_to_cart_order, r.consequent, r.lift
        FROM train_lines l JOIN train_rules r ON r.antecedent = l.product_name
        UNION ALL SELECT l.order_id, l.product_name, l.add_to_cart_order, r.consequent, r.lift
        FROM test_lines l JOIN test_rules r ON r.antecedent = l.product_name""",
    ),
    "train_catalogue": (
        ["train_lines"],
        "SELECT DISTINCT product_id, product_name, department_id, department FROM train_lines",
    ),
    "order_stats": (
        ["both_candidates"],
        """SELECT order_id, count(*) AS candidates, CAST(sum(label) AS BIGINT) AS positives
        FROM both_candidates GROUP BY order_id""",
    ),
    "type_items": (["type_lines"], "SELECT DISTINCT order_id, product_name AS item FROM type_lines"),
    "subsets": (
        ["type_items"],
        """SELECT order_id, [item] AS items, item AS tail FROM type_items
        UNION ALL SELECT s.order_id, list_append(s.items, i.item), i.item
        FROM subsets s JOIN type_items i ON i.order_id = s.order_id AND i.item > s.tail""",
    ),
    "type_sets": (
        ["subsets", "type_items"],
        """SELECT * FROM (SELECT items, len(items) AS size, count(*) AS freq,
            CAST(count(*) AS DOUBLE) / (SELECT CAST(count(DISTINCT order_id) AS DOUBLE) FROM type_items) AS support
          FROM subsets GROUP BY items) WHERE support >= 0.01""",
    ),
    "type_rules": (
        ["type_sets"],
        """SELECT a.items[1] AS antecedent, c.items[1] AS consequent, z.support,
          z.support / a.support AS confidence, z.support / a.support / c.support AS lift
        FROM type_sets z JOIN type_sets a ON a.size < z.size AND list_has_all(z.items, a.items)
        JOIN type_sets c ON c.size + a.size = z.size AND list_has_all(z.items, c.items)
          AND NOT list_has_any(a.items, c.items)
        WHERE z.support / a.support >= 0.15""",
    ),
    "type_carts": (
        [],
        """SELECT order_id, product_name, dense_rank() OVER (ORDER BY product_name) AS product_id,
          row_number() OVER (PARTITION BY order_id ORDER BY line, product_name) AS position
        FROM (SELECT l_orderkey AS order_id, p_type AS product_name, min(l_linenumber) AS line
          FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1, 2)""",
    ),
    "type_candidates": (
        ["type_carts", "type_rules"],
        """SELECT l.order_id, l.product_id AS trigger_product_id, l.position AS cart_size,
          p.product_id AS recommended_product_id, r.support, r.confidence, r.lift,
          CAST(coalesce(b.position > l.position, false) AS INTEGER) AS label
        FROM type_carts l JOIN type_rules r ON r.antecedent = l.product_name
        JOIN (SELECT DISTINCT product_name, product_id FROM type_carts) p ON p.product_name = r.consequent
        LEFT JOIN type_carts b ON b.order_id = l.order_id AND b.product_name = r.consequent""",
    ),
    "codes": (
        ["train_candidates"],
        "\n        UNION ALL ".join(
            f"""SELECT '{c}' AS column_name, CAST({c} AS VARCHAR) AS value,
          CAST(row_number() OVER (ORDER BY count(*) DESC, CAST({c} AS VARCHAR)) - 1 AS DOUBLE) AS code
        FROM train_candidates GROUP BY {c}"""
            for c in CATEGORICAL
        ),
    ),
    "unseen": (["codes"], "SELECT column_name, CAST(count(*) AS DOUBLE) AS code FROM codes GROUP BY column_name"),
    "test_values": (
        ["test_candidates"],
        "\n        UNION ALL ".join(
            f"SELECT '{c}' AS column_name, {at} AS position, CAST({c} AS VARCHAR) AS value, count(*) AS n FROM test_candidates GROUP BY {c}"
            for at, c in enumerate(CATEGORICAL)
        ),
    ),
    "test_codes": (
        ["test_values", "codes", "unseen"],
        """SELECT v.column_name, v.position, v.value, coalesce(c.code, u.code) AS code, v.n
        FROM test_values v JOIN unseen u ON u.column_name = v.column_name
        LEFT JOIN codes c ON c.column_name = v.column_name AND c.value = v.value""",
    ),
    "requests": (
        ["test_lines"],
        """SELECT DISTINCT product_id AS trigger_product_id, order_hour_of_day, order_dow, add_to_cart_order AS cart_size
        FROM test_lines""",
    ),
    "best_rules": (
        ["train_rules", "train_catalogue"],
        """SELECT * FROM (SELECT t.product_id AS trigger_product_id, p.product_id AS recommended_product_id,
            p.product_name AS recommended_product_name, support, confidence, lift, confidence AS score,
            row_number() OVER (PARTITION BY t.product_id ORDER BY confidence DESC, p.product_id) AS rank
          FROM train_rules JOIN train_catalogue t ON t.product_name = antecedent
          JOIN train_catalogue p ON p.product_name = consequent) WHERE rank = 1""",
    ),
    "score_counts": (
        ["test_candidates"],
        """SELECT confidence AS score, CAST(sum(label) AS DOUBLE) AS pos, CAST(sum(1 - label) AS DOUBLE) AS neg
        FROM test_candidates GROUP BY confidence""",
    ),
    "confusion": (
        ["test_candidates"],
        f"""SELECT CAST(count(*) FILTER (label = 1 AND confidence >= {THRESHOLD}) AS DOUBLE) AS tp,
          CAST(count(*) FILTER (label = 0 AND confidence >= {THRESHOLD}) AS DOUBLE) AS fp,
          CAST(count(*) FILTER (label = 1 AND confidence < {THRESHOLD}) AS DOUBLE) AS fn,
          CAST(count(*) FILTER (label = 0 AND confidence < {THRESHOLD}) AS DOUBLE) AS tn
        FROM test_candidates""",
    ),
}


def _sql(select: str, *needs: str) -> str:
    """``select`` with the sub-queries it needs, each computed once."""
    wanted: set[str] = set()
    stack = list(needs)
    while stack:
        name = stack.pop()
        if name not in wanted:
            wanted.add(name)
            stack += [part for part in _PARTS[name][0] if part != name]
    if not wanted:
        return select
    parts = [
        f"{name} AS ({_PARTS[name][1]})" if name == "subsets" else f"{name} AS MATERIALIZED ({_PARTS[name][1]})"
        for name in _PARTS
        if name in wanted
    ]
    return f"WITH RECURSIVE {', '.join(parts)} {select}"


def _columns(names: list[str]) -> str:
    return ", ".join(names)


_ORDER_COLUMNS = "order_id, order_dow, order_hour_of_day, days_since_prior_order, order_number"
_RULE_COLUMNS = """antecedent AS antecedents, consequent AS consequents, antecedent_support, consequent_support,
    support, confidence, lift"""


def _counts(tables: dict[str, tuple[str, int]]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{name}' AS table_name, count(*) AS n_rows, CAST({width} AS BIGINT) AS n_columns FROM {source}"
        for name, (source, width) in tables.items()
    )


def _info(name: str, source: str, types: dict[str, str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{name}' AS table_name, '{c}' AS column_name, count({c}) AS non_null, '{kind}' AS type_name FROM {source}"
        for c, kind in types.items()
    )


_TYPES = {
    "order_id": "bigint",
    "user_id": "bigint",
    "product_id": "bigint",
    "eval_set": "string",
    "product_name": "string",
    "department": "string",
    "days_since_prior_order": "double",
}


def _typed(columns: list[str]) -> dict[str, str]:
    return {c: _TYPES.get(c, "int") for c in columns}


_ORDERS = ["order_id", "user_id", "eval_set", "order_number", "order_dow", "order_hour_of_day", "days_since_prior_order"]
_LINES = ["order_id", "product_id", "add_to_cart_order", "reordered"]


def _means(x: str, per: str) -> str:
    """Means of precision and recall per k; groups without positives have no recall, orders have 0."""
    recall = "CASE WHEN positives > 0 THEN recall_{k} END" if per == "group" else "recall_{k}"
    return " UNION ALL ".join(
        f"SELECT {k} AS k, round(avg(precision_{k}), 9) AS precision, round(avg({recall.format(k=k)}), 9) AS recall FROM {x}_by_{per}"
        for k in KS
    )


def _describe(column: str) -> str:
    quantiles = ", ".join(f"round(quantile_cont({column}, {q}), 9) AS q{int(q * 100)}" for q in (0.25, 0.5, 0.75))
    return f"""SELECT '{column}' AS column_name, CAST(count({column}) AS DOUBLE) AS n, round(avg({column}), 9) AS mean,
      round(stddev_samp({column}), 9) AS std, CAST(min({column}) AS DOUBLE) AS min, {quantiles},
      CAST(max({column}) AS DOUBLE) AS max FROM order_stats"""


def _range_check(column: str, low: int, high: int | None) -> str:
    above = "" if high is None else f" OR {column} > {high}"
    return f"SELECT '{column}' AS column_name, count(*) FILTER ({column} < {low}{above}) AS n_outside FROM orders_c"


def _observed(name: str, source: str, types: dict[str, str], unique: str | None = None) -> str:
    """What the job that writes a clean table counts, per column."""
    rows = []
    for c, kind in types.items():
        outside = "CAST(NULL AS BIGINT)"
        if name == "orders" and c in RANGES:
            low, high = RANGES[c]
            outside = f"count(*) FILTER ({c} < {low}" + ("" if high is None else f" OR {c} > {high}") + ")"
        alike = f"(SELECT max(n) FROM (SELECT count(*) AS n FROM {source} GROUP BY {c}))" if c == unique else "CAST(NULL AS BIGINT)"
        rows.append(
            f"SELECT '{name}' AS table_name, '{c}' AS column_name, '{kind}' AS type_name, count(*) AS n_rows, count({c}) AS non_null, "
            f"count(*) - count({c}) AS nulls, {outside} AS n_outside, {alike} AS most_alike FROM {source}"
        )
    return " UNION ALL ".join(rows)


# Columns of the given tables, and those whose least and greatest values footers hold.
_GIVEN = {
    "orders": dict.fromkeys("o_orderkey o_custkey".split(), True) | dict.fromkeys("o_orderstatus o_totalprice o_orderdate o_orderpriority".split(), False),
    "lineitem": dict.fromkeys("l_orderkey l_partkey l_suppkey l_linenumber".split(), True) | dict.fromkeys("l_quantity l_extendedprice l_discount l_tax l_returnflag l_linestatus l_shipdate".split(), False),
    "part": dict.fromkeys("p_partkey p_size".split(), True) | dict.fromkeys("p_name p_brand p_type p_retailprice".split(), False),
}


def _footers(name: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{name}' AS table_name, '{c}' AS column_name, count({c}) AS non_null, "
        + (f"CAST(min({c}) AS VARCHAR) AS least, CAST(max({c}) AS VARCHAR) AS greatest" if ranged else "CAST(NULL AS VARCHAR) AS least, CAST(NULL AS VARCHAR) AS greatest")
        + f" FROM {name}"
        for c, ranged in _GIVEN[name].items()
    )


def _distinct(table: str, source: str, columns: list[str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(DISTINCT {c}) AS n_distinct, '{table}' AS table_name FROM {source}"
        for c in columns
    )


SQL: dict[str, str] = {
    "scan_csv_orders": _sql("SELECT * FROM orders_c", "orders_c"),
    "scan_csv_order_products": _sql("SELECT * FROM lines_c", "lines_c"),
    "scan_csv_products": _sql("SELECT * FROM products_c", "products_c"),
    "scan_csv_departments": _sql("SELECT * FROM departments_c", "departments_c"),
    "scan_master": _sql(f"SELECT {_columns(MASTER.names)}, split FROM full_master", "full_master"),
    "write_master_csv": _sql(f"SELECT {_columns(MASTER.names)} FROM full_master", "full_master"),
    "write_candidates": _sql(
        " UNION ALL ".join(
            f"""SELECT '{s}' AS split, count(*) AS n_rows, CAST(sum(label) AS BIGINT) AS positives,
            CAST(sum(cart_size) AS BIGINT) AS sum_cart_size FROM {s}_candidates"""
            for s in ("train", "test")
        ),
        "train_candidates",
        "test_candidates",
    ),
    "clean_tables": _sql(
        _counts(
            {
                "orders": ("orders_c", 7),
                "order_products": ("lines_c", 4),
                "products": ("products_c", 3),
                "departments": ("departments_c", 2),
            }
        ),
        "orders_c",
        "lines_c",
        "products_c",
        "departments_c",
    ),
    "row_counts": _sql(
        _counts(
            {
                "orders": ("orders_c", 7),
                "order_products": ("lines_c", 4),
                "master": ("full_master", len(MASTER.names)),
                "test_candidates": ("test_candidates", len(CANDIDATES.names)),
            }
        ),
        "orders_c",
        "lines_c",
        "full_master",
        "test_candidates",
    ),
    "table_info": _sql(
        " UNION ALL ".join(
            [
                _info("orders", "orders_c", _typed(_ORDERS)),
                _info("order_products", "lines_c", _typed(_LINES)),
                _info("master", "full_master", _typed(MASTER.names)),
            ]
        ),
        "orders_c",
        "lines_c",
        "full_master",
    ),
    "order_context": _sql(f"SELECT {_ORDER_COLUMNS} FROM orders_c", "orders_c"),
    "prior_orders": _sql("SELECT * FROM prior_c", "prior_c"),
    "member_lines": _sql(
        "SELECT * FROM lines_c WHERE order_id IN (SELECT order_id FROM order_sample)", "lines_c", "order_sample"
    ),
    "missing_days": _sql(
        "SELECT order_id, days_since_prior_order FROM orders_c WHERE days_since_prior_order IS NULL", "orders_c"
    ),
    "filled_days": _sql(
        "SELECT order_id, coalesce(days_since_prior_order, -1.0) AS days_since_prior_order FROM orders_c", "orders_c"
    ),
    "largest_order_lines": _sql(
        """SELECT order_id, product_id, product_name, add_to_cart_order FROM full_master
        WHERE order_id = (SELECT order_id FROM full_master GROUP BY order_id ORDER BY count(*) DESC, order_id DESC LIMIT 1)
        ORDER BY add_to_cart_order""",
        "full_master",
    ),
    "first_orders": _sql("SELECT * FROM orders_c WHERE order_number = 1", "orders_c"),
    "renamed_lines": _sql(
        f"""SELECT {_ORDER_COLUMNS}, product_id AS trigger_product_id, add_to_cart_order AS cart_size,
        reordered AS trigger_reordered, product_name AS trigger_product_name, department_id, department
        FROM full_master""",
        "full_master",
    ),
    "later_purchase_labels": _sql(
        "SELECT order_id, trigger_product_id, recommended_product_id, label FROM both_candidates", "both_candidates"
    ),
    "purchased_flags": _sql(
        """SELECT CASE WHEN label = 1 THEN 'Yes' ELSE 'No' END AS candidate_purchased, count(*) AS n
        FROM both_candidates GROUP BY 1""",
        "both_candidates",
    ),
    "rules_min_confidence": _sql(f"SELECT {_RULE_COLUMNS} FROM train_rules WHERE confidence >= 0.16", "train_rules"),
    "rules_min_lift": _sql(f"SELECT {_RULE_COLUMNS} FROM train_rules WHERE lift >= 1.02", "train_rules"),
    "coerced_numbers": """SELECT p_partkey,
        coalesce(TRY_CAST(split_part(p_brand, '#', 2) AS DOUBLE), 0.0) AS brand_number,
        coalesce(TRY_CAST(p_name AS DOUBLE), 0.0) AS p_name, coalesce(p_retailprice, 0.0) AS p_retailprice FROM part""",
    "sampled_orders": _sql("SELECT order_id FROM order_sample", "order_sample"),
    "sampled_users": _sql(
        "SELECT * FROM prior_c WHERE user_id IN (SELECT user_id FROM user_sample)", "prior_c", "user_sample"
    ),
    "split_sides": _sql(
        """SELECT order_id, CASE WHEN substr(md5(CAST(order_id AS VARCHAR) || ':42'), 1, 8) < '33333333'
        THEN 'test' ELSE 'train' END AS split FROM orders_c""",
        "orders_c",
    ),
    "random_peek": _sql(
        """SELECT order_id, days_since_prior_order FROM orders_c
        ORDER BY md5('sample:' || CAST(order_id AS VARCHAR) || ':42'), order_id LIMIT 10""",
        "orders_c",
    ),
    "orders_with_lines": _sql(
        f"""SELECT {_ORDER_COLUMNS}, product_id, add_to_cart_order, reordered
        FROM orders_c JOIN lines_c USING (order_id)""",
        "orders_c",
        "lines_c",
    ),
    "lines_with_products": _sql(
        "SELECT * FROM lines_c JOIN products_c USING (product_id)", "lines_c", "products_c"
    ),
    "lines_with_departments": _sql(
        "SELECT * FROM lines_c JOIN products_c USING (product_id) JOIN departments_c USING (department_id)",
        "lines_c",
        "products_c",
        "departments_c",
    ),
    "orphan_counts": _sql(
        """SELECT 'lines_without_order' AS check_name, count(*) AS n FROM lines_c ANTI JOIN orders_c USING (order_id)
        UNION ALL SELECT 'lines_without_product', count(*) FROM lines_c ANTI JOIN products_c USING (product_id)
        UNION ALL SELECT 'products_without_department', count(*) FROM products_c ANTI JOIN departments_c USING (department_id)
        UNION ALL SELECT 'orders_without_lines', count(*) FROM orders_c ANTI JOIN lines_c USING (order_id)""",
        "lines_c",
        "orders_c",
        "products_c",
        "departments_c",
    ),
    "sampled_master": _sql(
        f"SELECT {_columns(MASTER.names)} FROM full_master WHERE order_id IN (SELECT order_id FROM order_sample)",
        "full_master",
        "order_sample",
    ),
    "user_sampled_master": _sql(
        f"SELECT {_columns(MASTER.names)} FROM full_master WHERE user_id IN (SELECT user_id FROM user_sample)",
        "full_master",
        "user_sample",
    ),
    "candidate_expansion": _sql(
        """SELECT product_name, consequent, count(*) AS n, CAST(sum(add_to_cart_order) AS BIGINT) AS sum_positions
        FROM both_expanded GROUP BY 1, 2""",
        "both_expanded",
    ),
    "outcome_lookup": _sql(
        """SELECT x.order_id, x.product_name, x.consequent, b.add_to_cart_order AS actual_add_to_cart_order
        FROM both_expanded x LEFT JOIN full_master b ON b.order_id = x.order_id AND b.product_name = x.consequent""",
        "both_expanded",
        "full_master",
    ),
    "recommended_attributes": _sql(
        """SELECT antecedent, consequent, product_id AS recommended_product_id,
        product_name AS recommended_product_name, department_id AS recommended_department_id,
        department AS recommended_department_name
        FROM all_rules LEFT JOIN all_catalogue ON product_name = consequent""",
        "all_rules",
        "all_catalogue",
    ),
    "candidates_test": _sql("SELECT * FROM test_candidates", "test_candidates"),
    "candidates_train": _sql("SELECT * FROM train_candidates", "train_candidates"),
    "candidates_test_train_rules": _sql("SELECT * FROM honest_candidates", "honest_candidates"),
    "basket_items": _sql(
        """SELECT order_id, string_agg(DISTINCT product_name, ',' ORDER BY product_name) AS items
        FROM full_master GROUP BY order_id""",
        "full_master",
    ),
    "encoded_items": _sql("SELECT DISTINCT order_id, product_name FROM full_master", "full_master"),
    "encoded_vectors": _sql(
        "SELECT product_name AS item, count(DISTINCT order_id) AS n_orders FROM full_master GROUP BY 1", "full_master"
    ),
    "item_support": _sql("SELECT item, freq, support FROM all_singles", "all_singles"),
    "frequent_pairs": _sql("SELECT item_a, item_b, freq, support FROM all_pairs", "all_pairs"),
    "frequent_itemsets": _sql(
        """SELECT array_to_string(items, ',') AS items, CAST(size AS INTEGER) AS size, freq, support
        FROM type_sets""",
        "type_sets",
    ),
    "itemset_sizes": _sql(
        "SELECT CAST(size AS INTEGER) AS size, count(*) AS n FROM type_sets GROUP BY 1", "type_sets"
    ),
    "general_rules": _sql(
        """SELECT array_to_string(a.items, ',') AS antecedents, array_to_string(c.items, ',') AS consequents,
        a.support AS antecedent_support, c.support AS consequent_support, z.support,
        z.support / a.support AS confidence, z.support / a.support / c.support AS lift
        FROM type_sets z JOIN type_sets a ON a.size < z.size AND list_has_all(z.items, a.items)
        JOIN type_sets c ON c.size + a.size = z.size AND list_has_all(z.items, c.items)
          AND NOT list_has_any(a.items, c.items)
        WHERE z.support / a.support >= 0.15""",
        "type_sets",
    ),
    "candidates_general_rules": _sql(
        """SELECT trigger_product_id, recommended_product_id, count(*) AS n, CAST(sum(label) AS BIGINT) AS positives,
        round(max(lift), 9) AS max_lift FROM type_candidates GROUP BY 1, 2""",
        "type_candidates",
    ),
    "ranked_general_rules": _sql(
        """SELECT order_id, trigger_product_id, CAST(rank AS INTEGER) AS rank, recommended_product_id,
        round(confidence, 9) AS confidence, label
        FROM (SELECT *, row_number() OVER (PARTITION BY order_id, trigger_product_id ORDER BY confidence DESC,
          recommended_product_id, cart_size, lift DESC, support DESC) AS rank FROM type_candidates) WHERE rank <= 5""",
        "type_candidates",
    ),
    "first_general_rules": _sql(
        """SELECT order_id, recommended_product_id, CAST(cart_size AS INTEGER) AS cart_size, trigger_product_id,
        round(confidence, 9) AS confidence, label
        FROM (SELECT *, row_number() OVER (PARTITION BY order_id, recommended_product_id ORDER BY cart_size,
          trigger_product_id, lift DESC, confidence DESC, support DESC) AS nth FROM type_candidates) WHERE nth = 1""",
        "type_candidates",
    ),
    "pair_rules": _sql(f"SELECT {_RULE_COLUMNS} FROM train_rules", "train_rules"),
    "pair_rules_test": _sql(f"SELECT {_RULE_COLUMNS} FROM test_rules", "test_rules"),
    "mined_rules": _sql(f"SELECT {_RULE_COLUMNS} FROM all_rules", "all_rules"),
    "eval_set_counts": _sql("SELECT eval_set, count(*) AS n FROM orders_c GROUP BY 1", "orders_c"),
    "user_counts": _sql("SELECT user_id, count(*) AS n FROM orders_c GROUP BY 1", "orders_c"),
    "label_balance": _sql(
        """SELECT label, round(CAST(count(*) AS DOUBLE) / (SELECT count(*) FROM both_candidates), 9) AS share
        FROM both_candidates GROUP BY label""",
        "both_candidates",
    ),
    "distinct_counts": _sql(
        " UNION ALL ".join(
            [
                _distinct("orders", "orders_c", ["order_id"]),
                _distinct("order_products", "lines_c", ["product_id"]),
                _distinct("master", "full_master", ["order_id", "product_id", "product_name"]),
            ]
        ),
        "orders_c",
        "lines_c",
        "full_master",
    ),
    "null_counts": _sql(
        " UNION ALL ".join(
            f"SELECT '{name}' AS table_name, '{c}' AS column_name, count(*) FILTER ({c} IS NULL) AS nulls FROM {source}"
            for name, source, columns in (
                ("orders", "orders_c", _ORDERS),
                ("order_products", "lines_c", _LINES),
                ("products", "products_c", ["product_id", "product_name", "department_id"]),
                ("departments", "departments_c", ["department_id", "department"]),
            )
            for c in columns
        ),
        "orders_c",
        "lines_c",
        "products_c",
        "departments_c",
    ),
    "order_candidate_stats": _sql("SELECT * FROM order_stats", "order_stats"),
    "order_stats_summary": _sql(f"{_describe('candidates')} UNION ALL {_describe('positives')}", "order_stats"),
    "orders_with_positive": _sql(
        "SELECT round(avg(CASE WHEN positives > 0 THEN 1.0 ELSE 0.0 END), 9) AS share FROM order_stats", "order_stats"
    ),
    "product_catalogue": _sql(
        "SELECT DISTINCT product_id, product_name, department_id, department FROM full_master", "full_master"
    ),
    "value_ranges": _sql(" UNION ALL ".join(_range_check(c, *bounds) for c, bounds in RANGES.items()), "orders_c"),
    "top_recommendations": _sql(
        """SELECT order_id, trigger_product_id, recommended_product_id, label, CAST(rank AS INTEGER) AS rank
        FROM test_ranked WHERE rank <= 5""",
        "test_ranked",
    ),
    "first_recommendations": _sql("SELECT * FROM test_first", "test_first"),
    "ranked_recommendations": _sql(
        """SELECT order_id, recommended_product_id, confidence, label, CAST(rank AS INTEGER) AS rank
        FROM test_order_ranked WHERE rank <= 10""",
        "test_order_ranked",
    ),
    "sorted_orders": _sql("SELECT * FROM orders_c ORDER BY user_id, order_number, order_id", "orders_c"),
    "sorted_expansion": _sql(
        """SELECT order_id, add_to_cart_order, product_name, consequent, lift
        FROM both_expanded ORDER BY order_id, add_to_cart_order, consequent""",
        "both_expanded",
    ),
    "best_bundles": _sql(
        """SELECT q.trigger_product_id, order_hour_of_day, order_dow, cart_size, recommended_product_id,
        recommended_product_name, support, confidence, lift, score
        FROM requests q LEFT JOIN best_rules b ON b.trigger_product_id = q.trigger_product_id""",
        "requests",
        "best_rules",
    ),
    "feature_frame": _sql(
        f"""SELECT {_columns(CATEGORICAL)}, {", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in NUMERIC)}, label
        FROM test_candidates""",
        "test_candidates",
    ),
    "category_codes": _sql("SELECT column_name, value, code, n FROM test_codes", "test_codes"),
    "assembled_vectors": _sql(
        "SELECT position, round(sum(code * n), 4) AS total FROM test_codes GROUP BY position"
        + "".join(
            f" UNION ALL SELECT {at}, round(sum(CAST({c} AS DOUBLE)), 4) FROM test_candidates"
            for at, c in enumerate(NUMERIC, len(CATEGORICAL))
        ),
        "test_codes",
        "test_candidates",
    ),
    "decisions": _sql(
        f"""SELECT label, CASE WHEN confidence >= {THRESHOLD} THEN 1 ELSE 0 END AS prediction, count(*) AS n
        FROM test_candidates GROUP BY 1, 2""",
        "test_candidates",
    ),
    "classification_metrics": _sql(
        """SELECT round((tp + tn) / (tp + fp + fn + tn), 9) AS accuracy,
        round(CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0 END, 9) AS precision,
        round(CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0 END, 9) AS recall,
        round(CASE WHEN tp + fp + fn > 0 THEN 2 * tp / (2 * tp + fp + fn) ELSE 0 END, 9) AS f1 FROM confusion""",
        "confusion",
    ),
    "roc_auc": _sql(
        """SELECT round(sum(pos * (below + neg / 2)) / (sum(pos) * sum(neg)), 9) AS roc_auc
        FROM (SELECT pos, neg, coalesce(sum(neg) OVER (ORDER BY score
          ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below FROM score_counts)""",
        "score_counts",
    ),
    "precision_recall_at_k": _sql(_means("test", "group"), "test_by_group"),
    "precision_recall_train_rules": _sql(_means("honest", "group"), "honest_by_group"),
    "rule_scores_by_order": _sql(
        "SELECT order_id, "
        + ", ".join(f"round({m}_{k}, 9) AS {m}_{k}" for m in ("precision", "recall") for k in KS)
        + " FROM test_by_order",
        "test_by_order",
    ),
    "model_score_counts": _sql(
        "SELECT label, count(*) AS n_scored, count(*) AS n_probabilities FROM test_candidates GROUP BY label", "test_candidates"
    ),
    "model_decision_totals": _sql(
        "SELECT label, count(*) AS n_decided, count(*) AS n_agreeing FROM test_candidates GROUP BY label", "test_candidates"
    ),
    "model_bundle_checks": _sql(
        """SELECT trigger_product_id, order_hour_of_day, order_dow, cart_size, trigger_product_id IN (
          SELECT product_id FROM train_rules JOIN train_catalogue ON product_name = antecedent) AS allowed FROM requests""",
        "requests",
        "train_rules",
        "train_catalogue",
    ),
    "rule_precision_recall_at_k": _sql(_means("test", "order"), "test_by_order"),
}
SQL |= {f"bucketed_{name}": SQL[name] for name in ("orders_with_lines", "basket_items", "outcome_lookup")}
SQL["tree_scores"] = _sql(
    """SELECT order_id, trigger_product_id, recommended_product_id, cart_size, round(p, 9) AS score, CAST(p >= 0.4 AS INTEGER) AS prediction
    FROM (SELECT *, 1 / (1 + exp(-2 * CAST(a + b + c AS DOUBLE))) AS p FROM (SELECT *,
      CASE WHEN confidence > 0.2 THEN CASE WHEN lift > 1.05 THEN 0.375 ELSE 0.125 END
        WHEN order_hour_of_day IN (10, 13, 14) THEN -0.5 WHEN order_hour_of_day BETWEEN 9 AND 14 THEN -0.8
        ELSE -0.8 END AS a,
      CASE WHEN cart_size > 3.5 THEN CASE WHEN coalesce(days_since_prior_order, 0) > 2 THEN -0.01875 ELSE 0.00625 END ELSE 0.0375 END AS b,
      CASE WHEN order_dow IN (6, 3) THEN 0.075 ELSE -0.1 END AS c
      FROM test_candidates))""",
    "test_candidates",
)
SQL["bucketed_order_lines"] = SQL["largest_order_lines"]
SQL["streamed_best_bundles"] = SQL["best_bundles"]
SQL["sketched_distinct_counts"] = _sql(
    " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(DISTINCT {c}) AS n_distinct, true AS is_close FROM full_master"
        for c in ("order_id", "product_id", "product_name")
    ),
    "full_master",
)
SQL["footer_row_counts"] = SQL["clean_tables"]
SQL["footer_column_ranges"] = " UNION ALL ".join(map(_footers, _GIVEN))
SQL["observed_table_checks"] = _sql(
    "SELECT * FROM ("
    + " UNION ALL ".join(
        [
            _observed("orders", "orders_c", _typed(_ORDERS)),
            _observed("order_products", "lines_c", _typed(_LINES)),
            _observed("products", "products_c", _typed(["product_id", "product_name", "department_id"]), "product_name"),
            _observed("departments", "departments_c", _typed(["department_id", "department"]), "department"),
        ]
    )
    + ") UNPIVOT (n FOR check_name IN (n_rows, non_null, nulls, n_outside, most_alike))",
    "orders_c",
    "lines_c",
    "products_c",
    "departments_c",
)
SQL["sparse_vectors"] = _sql(
    """SELECT product_name AS item, count(DISTINCT order_id) AS n_orders,
    (SELECT count(DISTINCT product_name) + max(CAST(product_name IS NULL AS INTEGER)) FROM full_master) AS width
    FROM full_master GROUP BY 1""",
    "full_master",
)

"""SQL that computes each registered query on the same tables, for comparison."""

from __future__ import annotations


def _flag(condition: str) -> str:
    return f"CASE WHEN {condition} THEN 'Y' ELSE 'N' END"


EMAIL = r"'^[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}$'"

# -- feeds shaped from the star schema -----------------------------------

RAW_ORDERS = """
    SELECT CASE WHEN l_discount <> CAST(0.09 AS DOUBLE) THEN concat_ws('-', l_orderkey, l_linenumber) END AS order_id,
           CASE WHEN l_tax <> CAST(0.08 AS DOUBLE) THEN CAST(l_suppkey AS VARCHAR) END AS customer_id,
           CAST(l_partkey AS VARCHAR) AS product_id,
           CAST(CAST(l_shipdate AS DATE) + INTERVAL 24 YEAR AS DATE) AS order_date,
           CAST(l_quantity AS INTEGER) - 3 AS quantity,
           CASE WHEN l_discount = CAST(0.1 AS DOUBLE) THEN concat_ws(',', l_orderkey, l_linenumber) END AS _corrupt_records,
           l_shipdate AS inserted
    FROM lineitem
"""

RAW_CUSTOMERS = """
    SELECT CASE WHEN o_orderpriority <> '5-LOW' THEN 'C' || o_custkey END AS customer_id,
           c_name AS first_name,
           c_mktsegment AS last_name,
           CASE WHEN o_orderpriority = '1-URGENT' THEN c_name
                WHEN o_orderstatus <> 'P' THEN lower(replace(c_name, '#', '.')) || '@example.com' END AS email,
           CASE WHEN o_orderpriority <> '1-URGENT' THEN o_orderpriority END AS phone_number,
           CAST(o_orderdate AS DATE) AS signup_date,
           lower(n_name) AS country_code,
           ' ' || o_orderstatus AS department_code,
           CASE WHEN o_totalprice < 20000 THEN concat_ws(',', o_orderkey, o_custkey) END AS _corrupt_records,
           o_orderdate AS inserted
    FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
"""

RAW_PRODUCTS = """
    SELECT CAST(user_id AS VARCHAR) AS product_id,
           ' ' || props || '-' || event_type AS product_name,
           CASE event_type WHEN 'purchase' THEN 'Electronics' WHEN 'view' THEN 'Books ' WHEN 'click' THEN 'Clothing'
                WHEN 'error' THEN 'Jewels' END AS category,
           CASE WHEN value > 1 THEN (value - 5) * 10 END AS price,
           CASE WHEN value > 100 THEN props END AS _corrupt_records,
           ts AS inserted
    FROM events
"""

ORDER_FLAGS = {
    "has_null_required": _flag("order_id IS NULL OR customer_id IS NULL OR product_id IS NULL OR order_date IS NULL"),
    "is_valid_quantity": _flag("quantity > 0"),
    "is_valid_date": _flag("order_date >= DATE '2020-01-01'"),
}
ORDER_FAILURES = [
    ("has_null_required = 'Y'", "Required field is null"),
    ("is_valid_quantity = 'N'", "Invalid quantity (zero or negative)"),
    ("is_valid_date = 'N'", "Invalid order date"),
]
ORDER_COLUMNS = ["order_id", "customer_id", "product_id", "order_date", "quantity"]

CUSTOMER_FLAGS = {
    "has_null_required": _flag("customer_id IS NULL OR email IS NULL"),
    "is_valid_email": _flag(f"regexp_matches(email, {EMAIL})"),
    "is_valid_country": _flag("country_code IN (SELECT lower(n_name) FROM nation WHERE n_regionkey < 4)"),
    "is_valid_department": _flag("department_code IN (SELECT ' ' || l_linestatus FROM lineitem)"),
}
CUSTOMER_FAILURES = [
    ("has_null_required = 'Y'", "Required field is null"),
    ("is_valid_email = 'N'", "Invalid email format"),
]
CUSTOMER_COLUMNS = [
    "customer_id", "first_name", "last_name", "email", "phone_number", "signup_date", "country_code", "department_code",
]

PRODUCT_FLAGS = {
    "has_null_required": _flag("product_id IS NULL OR product_name IS NULL OR category IS NULL"),
    "is_valid_price": _flag("price > 0"),
    "is_valid_category": _flag("category IN ('Electronics', 'Clothing', 'Food', 'Books')"),
}
PRODUCT_FAILURES = [
    ("has_null_required = 'Y'", "Required field is null"),
    ("is_valid_price = 'N'", "Invalid price (zero, negative, or non-numeric)"),
]
PRODUCT_COLUMNS = ["product_id", "product_name", "category", "price"]


def _routed(
    raw: str,
    columns: list[str],
    flags: dict[str, str],
    failures: list[tuple[str, str]],
    null_keys_are_duplicates: bool = False,
    prefer_valid: bool = False,
    batch: str = "0",
) -> str:
    """Rows of a feed with flags, outcome, reason and detail."""
    key, rest = columns[0], columns[1:]
    failed = " OR ".join(f"({condition})" for condition, _ in failures)
    valid_first = f"CASE WHEN {failed} THEN 1 ELSE 0 END, " if prefer_valid else ""
    order = valid_first + "inserted DESC NULLS LAST, " + ", ".join(f"{c} ASC NULLS FIRST" for c in rest)
    exempt = "_corrupt_records IS NOT NULL"
    if not null_keys_are_duplicates:
        exempt += f" OR {key} IS NULL"
    messages = ", ".join(f"CASE WHEN {condition} THEN '{message}' END" for condition, message in failures)
    return f"""(
      WITH raw AS ({raw}),
      flagged AS (SELECT *, {", ".join(f"{sql} AS {name}" for name, sql in flags.items())}, {batch} AS batch FROM raw),
      ranked AS (
        SELECT *, ({exempt}) AS exempt,
               row_number() OVER (PARTITION BY batch, ({exempt}), {key} ORDER BY {order}) AS rank
        FROM flagged),
      routed AS (
        SELECT *, CASE WHEN _corrupt_records IS NOT NULL THEN 'corrupt'
                       WHEN NOT exempt AND rank > 1 THEN 'duplicate'
                       WHEN {failed} THEN 'failed' ELSE 'clean' END AS outcome
        FROM ranked)
      SELECT *,
             CASE outcome WHEN 'corrupt' THEN 'Corrupt record - parsing failed' WHEN 'duplicate' THEN 'Duplicate record'
                          WHEN 'failed' THEN 'Data quality check failed' END AS rejection_reason,
             CASE WHEN outcome = 'failed' THEN concat_ws('; ', {messages}) END AS rejection_detail
      FROM routed)"""


ROUTED_ORDERS = _routed(RAW_ORDERS, ORDER_COLUMNS, ORDER_FLAGS, ORDER_FAILURES)
ROUTED_CUSTOMERS = _routed(RAW_CUSTOMERS, CUSTOMER_COLUMNS, CUSTOMER_FLAGS, CUSTOMER_FAILURES)
ROUTED_PRODUCTS = _routed(RAW_PRODUCTS, PRODUCT_COLUMNS, PRODUCT_FLAGS, PRODUCT_FAILURES)
OUTCOME = ["outcome", "rejection_reason", "rejection_detail"]


def _select(columns: list[str], source: str, dates: tuple[str, ...] = ()) -> str:
    listed = ", ".join(f"strftime({c}, '%Y-%m-%d') AS {c}" if c in dates else c for c in columns)
    return f"SELECT {listed} FROM {source} r"


LAYERS = " UNION ALL ".join(
    f"SELECT '{feed}' AS feed, '{layer}' AS layer, count(*) AS rows FROM {routed} r WHERE {condition}"
    for feed, routed in (("customers", ROUTED_CUSTOMERS), ("orders", ROUTED_ORDERS), ("products", ROUTED_PRODUCTS))
    for layer, condition in (("raw", "true"), ("structured", "outcome = 'clean'"), ("rejected", "outcome <> 'clean'"))
)

CUSTOMERS_WITH_GAPS = """(
    SELECT c_custkey, c_acctbal,
           CASE WHEN c_nationkey <> 3 THEN c_mktsegment END AS c_mktsegment,
           CASE WHEN c_mktsegment = 'FURNITURE' THEN c_name
                WHEN c_mktsegment <> 'MACHINERY' THEN replace(c_name, '#', '_') || '@mail.example.org' END AS email
    FROM customer)"""
GAP_NULL = "c_mktsegment IS NULL OR email IS NULL"
GAP_EMAIL = f"email IS NULL OR NOT regexp_matches(email, {EMAIL})"

LINES = """(SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax,
                   l_returnflag, l_linestatus, strftime(l_shipdate, '%Y-%m-%d') AS l_shipdate FROM lineitem)"""
LINE_COLUMNS = [
    "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
    "l_returnflag", "l_linestatus", "l_shipdate",
]


def _ranked_lines(keys: list[str], condition: str) -> str:
    order = ", ".join(f"{c} NULLS FIRST" for c in LINE_COLUMNS if c not in keys)
    return f"""
        SELECT {", ".join(LINE_COLUMNS)} FROM (
          SELECT *, row_number() OVER (PARTITION BY {", ".join(keys)} ORDER BY {order}) AS rank FROM {LINES} l)
        WHERE rank {condition}"""


COUNTRY_SALES = """(
    SELECT c_nationkey, CAST(sum(CAST(l_quantity AS INTEGER) * CAST(p_retailprice AS DECIMAL(18, 6))) AS DECIMAL(28, 2)) AS sales
    FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey
                  LEFT JOIN customer ON o_custkey = c_custkey
                  LEFT JOIN part ON l_partkey = p_partkey
    GROUP BY c_nationkey)"""

PART_CHANGES = """(
    SELECT p_partkey * 2 AS p_partkey, p_name || ' II' AS p_name, p_brand, p_type, p_size + 1 AS p_size, p_retailprice
    FROM part)"""
MERGED_PARTS = f"""
    SELECT * FROM {PART_CHANGES} c
    UNION ALL
    SELECT p_partkey, p_name, p_brand, p_type, p_size, p_retailprice FROM part
    WHERE p_partkey NOT IN (SELECT p_partkey * 2 FROM part)"""

RAW_ORDERS_BY_SUPPLIER = f"SELECT * REPLACE (customer_id AS order_id) FROM ({RAW_ORDERS})"
RAW_ORDERS_ONE_STAMP = f"SELECT * REPLACE (DATE '2024-01-01' AS inserted) FROM ({RAW_ORDERS})"
LATEST_EVENTS = """
    SELECT event_id, user_id, event_type, value FROM (
      SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id) AS rank FROM events)
    WHERE rank = 1"""
ROUTED_ORDERS_ONE_STAMP = _routed(RAW_ORDERS_ONE_STAMP, ORDER_COLUMNS, ORDER_FLAGS, ORDER_FAILURES)
LATE_ORDERS = _routed(
    f"""SELECT * REPLACE (CASE WHEN quantity < 20 THEN DATE '2024-01-02'
                            WHEN quantity % 2 <> 0 THEN DATE '2023-01-01' END AS inserted) FROM ({RAW_ORDERS})""",
    ORDER_COLUMNS,
    ORDER_FLAGS,
    ORDER_FAILURES,
    batch="CASE WHEN quantity < 20 THEN 1 ELSE 2 END",
)
BATCHED_CUSTOMERS = _routed(
    RAW_CUSTOMERS,
    CUSTOMER_COLUMNS,
    CUSTOMER_FLAGS,
    CUSTOMER_FAILURES,
    batch="CASE WHEN phone_number IS NULL THEN 1 ELSE 2 END",
)
BATCHED_ORDERS = _routed(
    RAW_ORDERS_ONE_STAMP,
    ORDER_COLUMNS,
    ORDER_FLAGS,
    ORDER_FAILURES,
    batch="CASE WHEN quantity < 20 THEN 1 ELSE 2 END",
)


def _run_report(routed: str) -> str:
    """Structured rows by month, the newest batch of each key, and rejects by reason and batch."""
    return f"""
        WITH routed AS (SELECT * FROM {routed} r),
        clean AS (SELECT *, row_number() OVER (PARTITION BY order_id ORDER BY batch DESC) AS newest
                  FROM routed WHERE outcome = 'clean')
        SELECT 'structured' AS layer, '' AS reason, CAST(year(order_date) AS INTEGER) AS order_year,
               CAST(month(order_date) AS INTEGER) AS order_month, count(*) AS rows, CAST(sum(quantity) AS BIGINT) AS quantity
        FROM clean WHERE newest = 1 GROUP BY 3, 4
        UNION ALL
        SELECT 'rejected', rejection_reason, batch, 0, count(*), CAST(sum(quantity) AS BIGINT)
        FROM routed WHERE outcome <> 'clean' GROUP BY rejection_reason, batch"""


ORACLE_SQL: dict[str, str] = {
    "scan_filter_project": """
        SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderdate >= DATE '1997-01-01' AND o_orderstatus = 'F'""",
    "scan_sql": "SELECT o_orderpriority, count(*) AS orders FROM orders GROUP BY o_orderpriority",
    "scan_incremental": "SELECT event_id, user_id, value FROM events WHERE ts > TIMESTAMP '2024-01-20 12:00:00'",
    "read_static_lookup": "SELECT p_partkey, p_name, p_retailprice FROM part",
    "read_static_lookup_inferred": "SELECT CAST(s_suppkey AS INTEGER) AS s_suppkey, s_name, s_acctbal FROM supplier",
    "split_corrupt_valid": "SELECT event_id, event_type, value FROM events WHERE NOT value > 60",
    "split_corrupt_bad": "SELECT event_id, event_type, value, props AS _corrupt_records FROM events WHERE value > 60",
    "check_required": f"SELECT c_custkey, {_flag(GAP_NULL)} AS has_null_required FROM {CUSTOMERS_WITH_GAPS} c",
    "check_email": f"""
        SELECT c_custkey, email, {_flag(f"regexp_matches(email, {EMAIL})")} AS is_valid_email FROM {CUSTOMERS_WITH_GAPS} c""",
    "check_positive": f"""
        SELECT c_custkey, {_flag("c_acctbal > 0")} AS is_valid_c_acctbal, {_flag("c_nationkey > 0")} AS is_valid_c_nationkey
        FROM customer""",
    "check_date_range": f"""
        SELECT o_orderkey, {_flag("o_orderdate BETWEEN DATE '1996-01-01' AND DATE '2000-06-30'")} AS is_valid_date
        FROM orders""",
    "check_date_range_timed": f"""
        SELECT event_id, {_flag("ts BETWEEN TIMESTAMP '2024-01-03 12:00:00' AND TIMESTAMP '2024-01-20 06:30:00.5'")} AS is_valid_date
        FROM events""",
    "check_length": f"""
        SELECT doc_id, {_flag("length(text) BETWEEN 20 AND 2000")} AS is_valid_length_text,
               {_flag("length(source) >= 5")} AS is_valid_length_source
        FROM documents""",
    "check_reference": f"""
        SELECT doc_id, lang, {_flag("doc_id IN (SELECT doc_id FROM labels)")} AS is_valid_ref FROM documents""",
    "check_reference_shuffled": f"""
        SELECT l_suppkey, {_flag("l_suppkey IN (SELECT s_suppkey FROM supplier WHERE s_acctbal > 2000)")} AS is_known_supplier,
               count(*) AS lines
        FROM lineitem GROUP BY 1, 2""",
    "check_reference_filtered": f"""
        SELECT l_suppkey, {_flag("l_suppkey IN (SELECT s_suppkey FROM supplier WHERE s_acctbal > 7000)")} AS is_known_supplier,
               count(*) AS lines
        FROM lineitem GROUP BY 1, 2""",
    "check_domain": f"""
        SELECT c_custkey, c_mktsegment, {_flag("c_mktsegment IN ('BUILDING', 'FURNITURE', 'MACHINERY')")} AS is_valid_segment
        FROM {CUSTOMERS_WITH_GAPS} c""",
    "rejection_reasons": f"""
        SELECT c_custkey, nullif(concat_ws('; ', CASE WHEN {GAP_NULL} THEN 'Required field is null' END,
                                                 CASE WHEN {GAP_EMAIL} THEN 'Invalid email format' END,
                                                 CASE WHEN c_acctbal <= 0 THEN 'Invalid balance' END), '') AS rejection_reason
        FROM {CUSTOMERS_WITH_GAPS} c""",
    "rule_counts": f"""
        SELECT count(*) AS rows, count(*) FILTER (WHERE {GAP_NULL}) AS failed_has_null_required,
               count(*) FILTER (WHERE {GAP_EMAIL}) AS failed_is_valid_email,
               count(*) FILTER (WHERE c_acctbal <= 0) AS failed_is_valid_c_acctbal
        FROM {CUSTOMERS_WITH_GAPS} c""",
    "dedup_keep": _ranked_lines(["l_orderkey", "l_linenumber"], "= 1"),
    "dedup_rejects": _ranked_lines(["l_orderkey", "l_linenumber"], "> 1"),
    "dedup_rejects_hot": _ranked_lines(["l_returnflag", "l_linestatus"], "> 1"),
    "dedup_split_hot_ties": """
        SELECT l_returnflag, l_linestatus, 1 AS kept, count(*) AS rows, count(*) AS distinct_rows,
               max(l_quantity) AS kept_quantity
        FROM lineitem GROUP BY 1, 2""",
    "hash_pii": "SELECT c_custkey, sha256(c_name) AS c_name FROM customer",
    "normalize_codes": "SELECT c_custkey, upper(trim('  ' || lower(c_mktsegment) || ' ')) AS code FROM customer",
    "date_parts": """
        SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS order_year,
               CAST(month(o_orderdate) AS INTEGER) AS order_month, CAST(day(o_orderdate) AS INTEGER) AS order_day
        FROM orders""",
    "clean_names": r"""
        SELECT p_partkey, trim(p_name) AS p_name, regexp_replace(trim(p_brand), '[^a-zA-Z0-9\s]', '', 'g') AS p_brand_cleaned
        FROM part""",
    "price_bands": """
        SELECT item, id, CASE WHEN value < 50 THEN 'Budget' WHEN value < 200 THEN 'Mid-Range' WHEN value < 500 THEN 'Premium'
                              ELSE 'Luxury' END AS price_category
        FROM (SELECT 'event' AS item, event_id AS id, value FROM events
              UNION ALL SELECT 'part', p_partkey, p_retailprice FROM part)""",
    "route_orders": _select(
        [*ORDER_COLUMNS, "_corrupt_records", *ORDER_FLAGS, *OUTCOME], ROUTED_ORDERS, ("order_date",)
    ),
    "route_customers": _select(
        [*CUSTOMER_COLUMNS, "_corrupt_records", *CUSTOMER_FLAGS, *OUTCOME], ROUTED_CUSTOMERS, ("signup_date",)
    ),
    "route_products": _select([*PRODUCT_COLUMNS, "_corrupt_records", *PRODUCT_FLAGS, *OUTCOME], ROUTED_PRODUCTS),
    "route_orders_hot": f"""
        SELECT order_id, outcome, count(*) AS rows
        FROM {_routed(RAW_ORDERS_BY_SUPPLIER, ORDER_COLUMNS, ORDER_FLAGS, ORDER_FAILURES, null_keys_are_duplicates=True)} r
        GROUP BY order_id, outcome""",
    "route_orders_prefer_valid": _select(
        [*ORDER_COLUMNS, "outcome", "rejection_detail"],
        _routed(RAW_ORDERS, ORDER_COLUMNS, ORDER_FLAGS, ORDER_FAILURES, prefer_valid=True),
        ("order_date",),
    ),
    "structured_stamp": f"""
        SELECT CAST(year(order_date) AS INTEGER) AS order_year, count(*) AS stamped, 1 AS stamps
        FROM {ROUTED_ORDERS} r WHERE outcome = 'clean' GROUP BY 1""",
    "structured_orders": f"""
        SELECT order_id, customer_id, product_id, strftime(order_date, '%Y-%m-%d') AS order_date,
               CAST(year(order_date) AS INTEGER) AS order_year, CAST(month(order_date) AS INTEGER) AS order_month,
               CAST(day(order_date) AS INTEGER) AS order_day, quantity, is_valid_quantity
        FROM {ROUTED_ORDERS} r WHERE outcome = 'clean'""",
    "structured_customers": f"""
        SELECT customer_id, sha256(first_name) AS first_name, sha256(last_name) AS last_name, sha256(email) AS email,
               sha256(phone_number) AS phone_number, strftime(signup_date, '%Y-%m-%d') AS signup_date,
               upper(trim(country_code)) AS country_code, upper(trim(department_code)) AS department_code,
               is_valid_country, is_valid_department
        FROM {ROUTED_CUSTOMERS} r WHERE outcome = 'clean'""",
    "structured_products": rf"""
        SELECT product_id, trim(product_name) AS product_name,
               regexp_replace(trim(product_name), '[^a-zA-Z0-9\s]', '', 'g') AS product_name_cleaned,
               trim(category) AS category, price,
               CASE WHEN price < 50 THEN 'Budget' WHEN price < 200 THEN 'Mid-Range' WHEN price < 500 THEN 'Premium'
                    ELSE 'Luxury' END AS price_category,
               is_valid_price
        FROM {ROUTED_PRODUCTS} r WHERE outcome = 'clean'""",
    "rejected_customers": _select(
        [*CUSTOMER_COLUMNS, "_corrupt_records", "rejection_reason", "rejection_detail"],
        ROUTED_CUSTOMERS,
        ("signup_date",),
    )
    + " WHERE outcome <> 'clean'",
    "layer_counts": LAYERS,
    "rejection_rates": f"""
        SELECT feed, valid_rows, rejected_rows, rejected_rows * CAST(100 AS DOUBLE) / (valid_rows + rejected_rows) AS rejection_rate
        FROM (SELECT feed, CAST(sum(rows) FILTER (WHERE layer = 'structured') AS BIGINT) AS valid_rows,
                     CAST(sum(rows) FILTER (WHERE layer = 'rejected') AS BIGINT) AS rejected_rows
              FROM ({LAYERS}) GROUP BY feed)""",
    "quality_rate": f"""
        SELECT raw_rows, structured_rows, structured_rows * CAST(100 AS DOUBLE) / raw_rows AS quality_rate
        FROM (SELECT CAST(sum(rows) FILTER (WHERE layer = 'raw') AS BIGINT) AS raw_rows,
                     CAST(sum(rows) FILTER (WHERE layer = 'structured') AS BIGINT) AS structured_rows
              FROM ({LAYERS}))""",
    "reason_histogram": " UNION ALL ".join(
        f"SELECT '{feed}' AS feed, rejection_reason, count(*) AS rows FROM {routed} r WHERE outcome <> 'clean' GROUP BY 2"
        for feed, routed in (("customers", ROUTED_CUSTOMERS), ("orders", ROUTED_ORDERS), ("products", ROUTED_PRODUCTS))
    ),
    "ingest_batches": """
        SELECT count(DISTINCT date_trunc('day', ts)) AS ingest_batches, strftime(max(ts), '%Y-%m-%d') AS last_ingest
        FROM events""",
    "footer_totals": """
        SELECT 'status ' || o_orderstatus AS name, count(*) AS rows, min(o_orderkey) AS min_key, max(o_orderkey) AS max_key,
               min(o_totalprice) AS min_value, max(o_totalprice) AS max_value FROM orders GROUP BY 1
        UNION ALL SELECT 'lineitem', count(*), min(l_orderkey), max(l_orderkey), min(l_extendedprice), max(l_extendedprice) FROM lineitem
        UNION ALL SELECT 'customer', count(*), min(c_custkey), max(c_custkey), min(c_acctbal), max(c_acctbal) FROM customer
        UNION ALL SELECT 'part', count(*), min(p_partkey), max(p_partkey), CAST(min(p_size) AS DOUBLE), CAST(max(p_size) AS DOUBLE) FROM part""",
    "distinct_bitmaps": " UNION ALL ".join(
        f"""SELECT '{key}' AS key, {flag} AS l_returnflag, {status} AS l_linestatus, count(DISTINCT {key}) AS keys
        FROM lineitem{' GROUP BY ' + groups if groups else ''}"""
        for key in ("l_orderkey", "l_partkey")
        for flag, status, groups in (
            ("l_returnflag", "l_linestatus", "l_returnflag, l_linestatus"),
            ("l_returnflag", "'all'", "l_returnflag"),
            ("'all'", "'all'", ""),
        )
    ),
    "entity_counts": """
        SELECT 'orders' AS entity, count(DISTINCT l_orderkey) AS entities FROM lineitem
        UNION ALL SELECT 'customers', count(DISTINCT c_custkey) FROM customer
        UNION ALL SELECT 'products', count(DISTINCT p_partkey) FROM part""",
    "total_sales": """
        SELECT CAST(sum(CAST(l_quantity AS INTEGER) * CAST(p_retailprice AS DECIMAL(18, 6))) AS DECIMAL(28, 2)) AS total_sales,
               count(*) FILTER (WHERE p_retailprice IS NULL) AS unpriced_orders
        FROM lineitem LEFT JOIN part ON l_partkey = p_partkey""",
    "total_sales_extremes": """
        SELECT CAST(sum(CAST(l_quantity AS INTEGER) * CASE p_partkey % 50
                          WHEN 0 THEN CAST(2000000000000 AS DECIMAL(24, 9)) WHEN 1 THEN NULL
                          WHEN 2 THEN CAST(0.0000001 AS DECIMAL(24, 9))
                          ELSE CAST(p_retailprice AS DECIMAL(24, 9)) END) AS DECIMAL(28, 2)) AS total_sales,
               count(*) FILTER (WHERE p_partkey % 50 = 1) AS unpriced_orders
        FROM lineitem LEFT JOIN part ON l_partkey = p_partkey""",
    "sales_by_country_top10": f"""
        SELECT CAST(c_nationkey AS VARCHAR) AS country_code, sales, n_name AS country_name
        FROM {COUNTRY_SALES} s LEFT JOIN nation ON c_nationkey = n_nationkey
        ORDER BY sales DESC, 1 LIMIT 10""",
    "sales_by_region": f"""
        SELECT r_name AS region, CAST(sum(sales) AS DECIMAL(28, 2)) AS sales
        FROM {COUNTRY_SALES} s JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
        GROUP BY r_name""",
    "customers_by_segment": """
        SELECT c_mktsegment AS department_code, count(*) AS customers,
               CASE WHEN c_mktsegment <> 'FURNITURE'
                    THEN upper(substr(c_mktsegment, 1, 1)) || lower(substr(c_mktsegment, 2)) END AS department_name
        FROM customer GROUP BY c_mktsegment""",
    "merge_upsert": MERGED_PARTS,
    "merge_catalog_table": MERGED_PARTS,
    "merge_partitioned_table": """
        SELECT o_orderkey,
               CASE WHEN o_totalprice > 400000 THEN o_totalprice
                    WHEN o_orderstatus = 'F' THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice,
               CASE WHEN o_totalprice > 400000 THEN 'it''s X/Y'
                    WHEN o_orderstatus = 'O' AND o_totalprice < 100000 THEN 'F' ELSE o_orderstatus END AS o_orderstatus,
               CASE WHEN o_totalprice > 400000 THEN 'late' END AS note
        FROM orders""",
    "merge_bucketed_table": """
        SELECT o_orderkey,
               CASE WHEN o_totalprice > 400000 OR o_orderstatus = 'O' THEN o_totalprice ELSE o_totalprice + 1 END AS o_totalprice,
               o_orderstatus, CASE WHEN o_totalprice > 400000 THEN 'high' END AS note
        FROM orders""",
    "append_partitioned": """
        SELECT o_orderkey, o_totalprice, o_orderstatus,
               CASE WHEN o_orderstatus <> 'F' THEN o_orderpriority END AS o_orderpriority,
               CAST(year(o_orderdate) AS INTEGER) AS order_year
        FROM orders""",
    "catalog_setup": f"SELECT product_id, product_name, category, price, _corrupt_records FROM ({RAW_PRODUCTS})",
    "catalog_run": f"""
        SELECT kind, count(*) AS rows, max(price) AS highest
        FROM (SELECT price, CASE WHEN outcome <> 'clean' THEN rejection_reason WHEN price < 50 THEN 'Budget'
                                 WHEN price < 200 THEN 'Mid-Range' WHEN price < 500 THEN 'Premium' ELSE 'Luxury' END AS kind
              FROM {ROUTED_PRODUCTS} r)
        GROUP BY kind""",
    "quarantine": f"""
        SELECT c_custkey, c_acctbal, c_mktsegment, email, 'Data quality check failed' AS rejection_reason
        FROM {CUSTOMERS_WITH_GAPS} c WHERE {GAP_EMAIL}""",
    "stream_ingest": """
        WITH lines AS (
          SELECT CAST(event_id AS VARCHAR) AS order_id, CAST(user_id AS VARCHAR) AS customer_id, event_type AS product_id,
                 value > 100 AS bad, strftime(ts, '%Y-%m-%d') AS order_date,
                 CASE WHEN value >= 1 THEN CAST(floor(value) AS INTEGER) END AS quantity,
                 CASE WHEN event_type = 'purchase' THEN 2 ELSE 1 END AS batch
          FROM events)
        SELECT order_id, customer_id, product_id, CASE WHEN NOT bad THEN order_date END AS order_date, quantity,
               CASE WHEN bad THEN order_id || ',' || customer_id || ',' || product_id || ',INVALID_DATE,' || quantity END
                 AS _corrupt_records,
               batch
        FROM lines""",
    "stream_upsert": LATEST_EVENTS,
    "stream_upsert_two_sources": LATEST_EVENTS,
    "stream_widen": """
        SELECT sink, p_partkey, p_name, CASE WHEN p_partkey % 2 <> 0 THEN p_size END AS p_size
        FROM part CROSS JOIN (VALUES ('folder'), ('table')) sinks(sink)""",
    "incremental_runs": _run_report(BATCHED_ORDERS),
    "incremental_runs_late": _run_report(LATE_ORDERS),
    "run_rule_counts": " UNION ALL ".join(
        f"SELECT '{name}' AS name, count(*) AS rows FROM {ROUTED_ORDERS_ONE_STAMP} r WHERE {condition}"
        for name, condition in {
            "rows": "true",
            **{outcome: f"outcome = '{outcome}'" for outcome in ("clean", "corrupt", "duplicate", "failed")},
            "failed_has_null_required": "outcome <> 'corrupt' AND has_null_required = 'Y'",
            "failed_is_valid_quantity": "outcome <> 'corrupt' AND is_valid_quantity = 'N'",
            "failed_is_valid_date": "outcome <> 'corrupt' AND is_valid_date = 'N'",
        }.items()
    ),
    "lake_layers": """
        SELECT feed, layer, CASE WHEN feed = 'orders' THEN rows ELSE 0 END AS rows FROM (
          SELECT 'raw' AS layer, count(*) AS rows FROM events
          UNION ALL SELECT 'structured', count(*) FILTER (WHERE value >= 1 AND value <= 100) FROM events
          UNION ALL SELECT 'rejected', count(*) FILTER (WHERE NOT coalesce(value >= 1 AND value <= 100, false)) FROM events) counted
        CROSS JOIN (VALUES ('customers'), ('orders'), ('products')) feeds(feed)""",
    "lake_rounds": """
        WITH customers AS (
          SELECT c_custkey AS k, c_acctbal >= 0 AS good, lower(c_mktsegment) AS department,
                 CASE WHEN c_custkey % 10 = 0 THEN (c_nationkey + 1) % 25 ELSE c_nationkey END AS nation FROM customer),
        products AS (SELECT p_partkey AS k, p_size % 10 <> 0 AS good, p_retailprice AS price FROM part),
        lines AS (
          SELECT o_orderkey AS k, o_custkey AS c, o_orderkey % 200 + 1 AS p, o_orderkey % 7 + CASE WHEN o_orderkey % 3 = 1 THEN 1 ELSE 0 END AS q
          FROM orders),
        sales AS (
          SELECT n.n_name AS country, CAST(sum(l.q * CAST(p.price AS DECIMAL(18, 6))) AS DECIMAL(28, 2)) AS sales
          FROM lines l JOIN products p ON l.p = p.k AND p.good LEFT JOIN customers c ON l.c = c.k AND c.good
          LEFT JOIN nation n ON n.n_nationkey = c.nation WHERE l.q > 0 GROUP BY c.nation, n.n_name),
        figures AS (
          SELECT 'layer_counts' AS report, 'customers raw' AS name, count(*) + count(*) FILTER (WHERE k % 10 = 0) AS value FROM customers
          UNION ALL SELECT 'layer_counts', 'customers structured', count(*) FILTER (WHERE good) FROM customers
          UNION ALL SELECT 'layer_counts', 'customers rejected', count(*) FILTER (WHERE NOT good) + count(*) FILTER (WHERE NOT good AND k % 10 = 0) FROM customers
          UNION ALL SELECT 'layer_counts', 'products raw', count(*) FROM products
          UNION ALL SELECT 'layer_counts', 'products structured', count(*) FILTER (WHERE good) FROM products
          UNION ALL SELECT 'layer_counts', 'products rejected', count(*) FILTER (WHERE NOT good) FROM products
          UNION ALL SELECT 'layer_counts', 'orders raw', count(*) + count(*) FILTER (WHERE k % 3 = 1) FROM lines
          UNION ALL SELECT 'layer_counts', 'orders structured', count(*) FILTER (WHERE q > 0) FROM lines
          UNION ALL SELECT 'layer_counts', 'orders rejected', count(*) FILTER (WHERE k % 7 = 0) FROM lines
          UNION ALL SELECT 'entity_counts', 'customers', count(*) FILTER (WHERE good) FROM customers
          UNION ALL SELECT 'entity_counts', 'products', count(*) FILTER (WHERE good) FROM products
          UNION ALL SELECT 'entity_counts', 'orders', count(*) FILTER (WHERE q > 0) FROM lines
          UNION ALL SELECT 'customers_by_department', department, count(*) FROM customers WHERE good GROUP BY department)
        SELECT report, name, CAST(value AS DECIMAL(28, 2)) AS value FROM figures
        UNION ALL SELECT 'reason_histogram', replace(name, 'rejected', 'Data quality check failed'), CAST(value AS DECIMAL(28, 2))
                  FROM figures WHERE name LIKE '% rejected' AND value > 0
        UNION ALL SELECT 'total_sales', 'all', CAST(sum(sales) AS DECIMAL(28, 2)) FROM sales
        UNION ALL SELECT * FROM (SELECT 'top_countries', country, sales FROM sales WHERE country IS NOT NULL ORDER BY sales DESC LIMIT 10)""",
    "scan_clustered": "SELECT event_id, user_id, value FROM events WHERE ts > TIMESTAMP '2024-01-28 00:00:00'",
    "scan_by_name": """
        SELECT 'filtered' AS read, event_id, value FROM events WHERE event_type = 'click' AND value > 20
        UNION ALL SELECT 'newer', event_id, value FROM events WHERE ts > TIMESTAMP '2024-01-20 12:00:00'
        UNION ALL SELECT * FROM (SELECT 'preview', event_id, value FROM events ORDER BY value DESC, event_id LIMIT 20)""",
    "catalog_run_customers": f"""
        WITH routed AS (SELECT * FROM {BATCHED_CUSTOMERS} r),
        clean AS (SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY batch DESC) AS newest
                  FROM routed WHERE outcome = 'clean'),
        rows AS (SELECT is_valid_country || ' ' || is_valid_department AS kind, signup_date FROM clean WHERE newest = 1
                 UNION ALL SELECT rejection_reason, signup_date FROM routed WHERE outcome <> 'clean')
        SELECT kind, count(*) AS rows, strftime(max(signup_date), '%Y-%m-%d') AS last FROM rows GROUP BY kind""",
}

# The sales reports among the figures of those rounds.
ORACLE_SQL["lake_sales_corrected"] = f"""
        SELECT * FROM ({ORACLE_SQL["lake_rounds"]}) WHERE report IN ('total_sales', 'top_countries', 'customers_by_department')"""

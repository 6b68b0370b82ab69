"""The registered queries once more, as SQL over the given tables.

Nothing here goes through feeds or operators: each statement states the expected result directly.
"""

from __future__ import annotations

AS_OF = "2001-08-01"
FIRST_CATALOGUE = "1994-01-01"
READ_AT = "1998-04-14 23:58:00"

# Tables that several statements share, in order of dependence.
_SHARED = {
    "customers": """
        SELECT CAST(c_custkey AS VARCHAR) AS customer_id, 'Customer' AS first_name,
               substr(c_name, 10) AS last_name,
               CASE WHEN c_custkey % 2 = 1 THEN 'male' ELSE 'female' END AS gender,
               DATE '1970-01-01' + CAST(c_custkey % 14000 - 3000 AS INTEGER) AS date_of_birth,
               'c' || c_custkey || '@example.com' AS email,
               '09' || lpad(CAST(c_custkey AS VARCHAR), 8, '0') AS phone_number,
               n_name AS country,
               DATE '1970-01-01' + CAST(8766 + c_custkey % 365 AS INTEGER)
                   AS customer_creation_date,
               c_custkey % 11 = 0 AS updated
        FROM customer JOIN nation ON c_nationkey = n_nationkey""",
    "products": """
        SELECT CAST(p_partkey AS VARCHAR) AS product_id, p_name AS product_name,
               'URL ' || p_partkey AS product_link,
               CAST(round(p_retailprice * 100) AS BIGINT) / 100.0 AS price,
               CAST(round((p_retailprice + p_size / 100.0) * 100) AS BIGINT) / 100.0 AS base_price,
               'USD' AS currency, CAST(p_size AS VARCHAR) AS sale_percents,
               p_type AS product_type
        FROM part""",
    "transactions": f"""
        SELECT concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey,
                         strftime(l_shipdate, '%Y%m%d')) AS transaction_id,
               CASE WHEN l_orderkey % 10 = 0
                    THEN md5('09' || lpad(CAST(o_custkey AS VARCHAR), 8, '0') || '{AS_OF}')
                    ELSE CAST(o_custkey AS VARCHAR) END AS customer_id,
               CAST(l_partkey AS VARCHAR) AS product_id,
               '09' || lpad(CAST(o_custkey AS VARCHAR), 8, '0') AS phone_number,
               p_name AS product_name,
               CAST(round(p_retailprice * 100) AS BIGINT) / 100.0 AS price,
               CAST(l_quantity AS BIGINT) AS quantity,
               CAST(round(l_extendedprice * 100) AS BIGINT) / 100.0 AS total_amount,
               CASE WHEN l_orderkey % 10 = 0 THEN 'store' ELSE 'web' END AS source,
               CAST(o_orderdate AS TIMESTAMP) AS sold_at,
               l_orderkey % 10 = 0 AS is_new_customer
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey
        WHERE l_orderkey % 101 <> 0 AND l_orderkey % 97 <> 0""",
    "activities": """
        SELECT CAST(event_id AS VARCHAR) AS event_id, event_type AS type,
               CAST(user_id AS VARCHAR) AS customer_id,
               CASE WHEN event_id % 3 <> 0
                    THEN 'https://shop.example/' || event_type || '/' || event_id END AS url,
               CAST(ts AS TIMESTAMP) AS time_stamp
        FROM events WHERE user_id IS NOT NULL""",
    "walkins": """
        SELECT customer_id, any_value(phone_number) AS phone_number,
               CAST(sold_at AS DATE) AS effective_date
        FROM transactions WHERE is_new_customer GROUP BY customer_id, CAST(sold_at AS DATE)""",
    "customer_versions": f"""
        SELECT md5(customer_id || '{AS_OF}') AS customer_sk, customer_id, first_name, last_name,
               gender, date_of_birth, phone_number, country, DATE '{AS_OF}' AS effective_date,
               DATE '9999-12-31' AS expired_date, TRUE AS is_current
        FROM customers
        UNION ALL
        SELECT md5(customer_id || strftime(effective_date, '%Y-%m-%d')), customer_id, 'Unknown',
               'Unknown', 'Unknown', NULL, phone_number, 'Unknown', effective_date,
               coalesce(lead(effective_date) OVER w, DATE '9999-12-31'),
               lead(effective_date) OVER w IS NULL
        FROM walkins WINDOW w AS (PARTITION BY customer_id ORDER BY effective_date)""",
    "facts": f"""
        SELECT md5(transaction_id) AS transaction_sk,
               CAST(strftime(sold_at, '%Y%m%d') AS INTEGER) AS date_key, v.customer_sk,
               t.customer_id, md5(product_id || '{AS_OF}') AS product_sk, transaction_id,
               price AS unit_sales_price, CAST(quantity AS DOUBLE) AS quantity, total_amount,
               sold_at, t.product_id
        FROM transactions t
        LEFT JOIN customer_versions v ON v.customer_id = t.customer_id AND v.is_current""",
    "price_changes": """
        SELECT CAST(l_partkey AS VARCHAR) AS product_id, 'repriced' AS product_name,
               concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey,
                         strftime(l_shipdate, '%Y%m%d')) AS product_link,
               CAST(round(l_extendedprice * 100) AS BIGINT) / 100.0 AS price,
               l_returnflag AS product_type, CAST(l_shipdate AS DATE) AS day,
               l_shipdate AS shipped_at, l_orderkey * 8 + l_linenumber AS position
        FROM lineitem""",
    "daily_orders": """
        SELECT CAST(o_custkey AS VARCHAR) AS customer_id,
               CAST(o_orderdate AS DATE) AS effective_date,
               arg_max(o_orderpriority, (o_orderdate, o_orderkey)) AS country
        FROM orders GROUP BY ALL""",
}

_NEEDS = {
    "walkins": ["transactions"],
    "customer_versions": ["customers", "transactions", "walkins"],
    "facts": ["customers", "transactions", "walkins", "customer_versions"],
}


def _with(names: str, select: str) -> str:
    wanted = [n for name in names.split() for n in [*_NEEDS.get(name, []), name]]
    ctes = [f"{name} AS ({sql})" for name, sql in _SHARED.items() if name in wanted]
    return f"WITH {', '.join(ctes)}{select if select.lstrip().startswith(',') else ' ' + select}"


def _day(column: str) -> str:
    return f"strftime({column}, '%Y-%m-%d')"


def _time(column: str) -> str:
    return f"strftime({column}, '%Y-%m-%d %H:%M:%S.%f')"


_CUSTOMER_COLUMNS = f"""customer_id, first_name, last_name, gender,
    {_day('date_of_birth')} AS date_of_birth, email, phone_number, country,
    {_day('customer_creation_date')} AS customer_creation_date"""

_PLACEHOLDERS = f"""
    SELECT customer_id, 'Unknown' AS first_name, 'Unknown' AS last_name, 'Unknown' AS gender,
           CAST(NULL AS VARCHAR) AS date_of_birth, 'Unknown' AS email, phone_number,
           'Unknown' AS country, {_day('sold_at')} AS customer_creation_date
    FROM transactions WHERE is_new_customer"""

_FACT_COLUMNS = f"""transaction_sk, date_key, customer_sk, customer_id, product_sk,
    transaction_id, unit_sales_price, quantity, total_amount, {_time('sold_at')} AS time_stamp"""

_FACTS = _with("facts", f"SELECT {_FACT_COLUMNS} FROM facts")

_FEED_COUNTS = """
    SELECT 'customer' AS key, count(*) + count_if(c_custkey % 13 = 0) AS records FROM customer
    UNION ALL SELECT 'product', count(*) + count_if(p_partkey % 13 = 0) FROM part
    UNION ALL SELECT 'transaction', count(*) FROM lineitem
    UNION ALL SELECT 'event', count(*) FROM events"""

_HISTORY = f"""
    SELECT md5(customer_id || {_day('effective_date')}) AS customer_sk, customer_id, country,
           {_day('effective_date')} AS effective_date,
           coalesce({_day('lead(effective_date) OVER w')}, '9999-12-31') AS expired_date,
           lead(effective_date) OVER w IS NULL AS is_current
    FROM daily_orders WINDOW w AS (PARTITION BY customer_id ORDER BY effective_date)"""

_VERSIONS = _with(
    "customer_versions",
    f"""SELECT customer_sk, customer_id, first_name, phone_number, country,
               {_day('effective_date')} AS effective_date,
               {_day('expired_date')} AS expired_date, is_current
        FROM customer_versions""",
)

_ACTIVITY = _with(
    "activities",
    f"SELECT customer_id, event_id, type, url, {_time('time_stamp')} AS time_stamp FROM activities",
)


def _entries(people: str, sales: str, key: str, columns: str, *amounts: str) -> str:
    """Entries of sales and activities with the columns of their people, and people without any.

    ``people`` are all documents; ``amounts`` are the sales' columns besides the transaction id.
    """
    sold = ", ".join(f"s.{name}" for name in amounts)
    none = ", ".join(f"NULL AS {name}" for name in amounts)
    own = ", ".join(f"p.{name}" for name in columns.split(", "))
    return f"""
        SELECT p.{key}, {own}, transaction_id, {sold}, NULL AS event_id, NULL AS type, NULL AS url
               {"" if "time_stamp" in amounts else ", NULL AS time_stamp"}
        FROM ({people}) p JOIN ({sales}) s ON s.customer_id = p.{key}
        UNION ALL BY NAME
        SELECT p.{key}, {own}, NULL AS transaction_id, {none.replace(", NULL AS time_stamp", "")},
               event_id, type, url, {_time('a.time_stamp')} AS time_stamp
        FROM ({people}) p JOIN activities a ON a.customer_id = p.{key}
        UNION ALL BY NAME
        SELECT p.{key}, {own} FROM ({people}) p
        WHERE p.{key} NOT IN (SELECT customer_id FROM ({sales}))
          AND p.{key} NOT IN (SELECT customer_id FROM activities)"""


_FACT_ENTRIES = f"""SELECT customer_id, transaction_id, unit_sales_price, quantity, total_amount,
    {_time('sold_at')} AS time_stamp FROM facts"""
_FACT_AMOUNTS = ("unit_sales_price", "quantity", "total_amount", "time_stamp")
_PHONE_ENTRIES = """SELECT c.customer_id, transaction_id, product_id, product_name, price, quantity,
    total_amount FROM transactions t JOIN customers c ON c.phone_number = t.phone_number"""
_PHONE_AMOUNTS = ("product_id", "product_name", "price", "quantity", "total_amount")

# Numbers are unique per customer, and every walk-in gave the number of a customer.
_PERSONS = """
    SELECT customer_id, customer_id AS person_id FROM customers
    UNION ALL
    SELECT DISTINCT w.customer_id, c.customer_id
    FROM walkins w JOIN customers c ON c.phone_number = w.phone_number"""

_RESOLVED = _with(
    "customers transactions",
    """SELECT c.customer_id, transaction_id, product_id, product_name, price, quantity, total_amount
       FROM transactions t JOIN customers c ON c.phone_number = t.phone_number""",
)

_SILVER_CUSTOMER = _with(
    "customers walkins",
    f"""SELECT {_CUSTOMER_COLUMNS} FROM customers
        UNION ALL
        SELECT customer_id, 'Unknown', 'Unknown', 'Unknown', NULL, 'Unknown',
               any_value(phone_number), 'Unknown', {_day('max(effective_date)')}
        FROM walkins GROUP BY customer_id""",
)

ORACLES = {
    "route_feed": _FEED_COUNTS,
    "stream_bronze_counts": _FEED_COUNTS,
    "clean_customer": _with("customers", f"SELECT {_CUSTOMER_COLUMNS} FROM customers"),
    "clean_customer_phone_compat": """
        SELECT CAST(c_custkey AS VARCHAR) AS customer_id,
               CASE WHEN c_custkey % 3 = 0 THEN '084' ELSE '0' END || '9'
                   || lpad(CAST(c_custkey AS VARCHAR), 8, '0') AS phone_number
        FROM customer""",
    "clean_product": _with("products", "SELECT * FROM products"),
    "clean_transaction": _with(
        "transactions",
        f"""SELECT transaction_id, customer_id, product_id, phone_number, product_name, price,
                   quantity, total_amount, source, {_time('sold_at')} AS "timestamp",
                   is_new_customer
            FROM transactions""",
    ),
    "clean_event": _ACTIVITY,
    "quarantine": """
        SELECT CAST(p_partkey AS VARCHAR) AS "offset", 'product' AS key,
               CASE WHEN p_type = 'ECONOMY' THEN 'undecodable price' ELSE 'malformed json' END
                   AS reason
        FROM part WHERE p_type = 'ECONOMY' OR p_partkey % 7 = 0""",
    "quarantine_overflow": """
        SELECT CAST(o_orderkey AS VARCHAR) AS "offset", 'transaction' AS key,
               'overflowing quantity' AS reason
        FROM orders WHERE o_orderkey % 5 = 0""",
    "placeholder_customers": _with("transactions", _PLACEHOLDERS),
    "customers_with_placeholders": _with(
        "customers transactions",
        f"SELECT {_CUSTOMER_COLUMNS} FROM customers UNION ALL {_PLACEHOLDERS}",
    ),
    "hide_bookkeeping_columns": _with("products", "SELECT * FROM products"),
    "latest_per_key": _with(
        "transactions",
        f"""SELECT customer_id, transaction_id, total_amount, {_time('sold_at')} AS "timestamp"
            FROM transactions
            QUALIFY row_number() OVER (
                PARTITION BY customer_id ORDER BY sold_at DESC, transaction_id DESC) = 1""",
    ),
    "upsert_customer_guarded": _with(
        "customers",
        f"""
        , changes AS (
            SELECT CAST(o_custkey AS VARCHAR) AS customer_id,
                   CASE o_orderstatus WHEN 'P' THEN 'Unknown' WHEN 'O' THEN 'Buyer' END
                       AS first_name,
                   CAST(o_orderkey AS VARCHAR) AS last_name,
                   '09' || lpad(CAST(o_custkey AS VARCHAR), 8, '0') AS phone_number,
                   o_orderpriority AS country, {_day('o_orderdate')} AS customer_creation_date,
                   coalesce(o_orderstatus = 'O', FALSE) AS named
            FROM orders
            QUALIFY row_number() OVER (
                PARTITION BY o_custkey
                ORDER BY coalesce(o_orderstatus = 'O', FALSE) DESC, o_orderdate DESC,
                         o_orderkey DESC) = 1),
        stored AS (
            SELECT customer_id, first_name, last_name, phone_number, country,
                   {_day('customer_creation_date')} AS customer_creation_date
            FROM customers WHERE NOT updated)
        SELECT coalesce(s.customer_id, c.customer_id) AS customer_id,
               CASE WHEN use_change THEN c.first_name ELSE s.first_name END AS first_name,
               CASE WHEN use_change THEN c.last_name ELSE s.last_name END AS last_name,
               CASE WHEN use_change THEN c.phone_number ELSE s.phone_number END AS phone_number,
               CASE WHEN use_change THEN c.country ELSE s.country END AS country,
               CASE WHEN use_change THEN c.customer_creation_date
                    ELSE s.customer_creation_date END AS customer_creation_date
        FROM (SELECT s.customer_id AS sid, c.customer_id AS cid,
                     s.customer_id IS NULL OR coalesce(c.named, FALSE) AS use_change
              FROM stored s FULL JOIN changes c ON s.customer_id = c.customer_id) m
        LEFT JOIN stored s ON s.customer_id = m.sid
        LEFT JOIN changes c ON c.customer_id = m.cid""",
    ),
    "upsert_product": _with(
        "products price_changes",
        """
        , newest AS (
            SELECT * FROM price_changes
            QUALIFY row_number() OVER (
                PARTITION BY product_id
                ORDER BY shipped_at DESC, position DESC, product_link DESC) = 1)
        SELECT p.product_id, coalesce(n.product_name, p.product_name) AS product_name,
               coalesce(n.product_link, p.product_link) AS product_link,
               coalesce(n.price, p.price) AS price,
               coalesce(n.product_type, p.product_type) AS product_type
        FROM products p LEFT JOIN newest n ON n.product_id = p.product_id""",
    ),
    "append_transaction": _with(
        "transactions",
        """SELECT transaction_id, customer_id, product_id, product_name, price,
                  CAST(quantity AS DOUBLE) AS quantity, total_amount
           FROM transactions""",
    ),
    "scd2_customer_full": _with("daily_orders", _HISTORY),
    "scd2_customer_merge": _with("daily_orders", _HISTORY),
    "scd2_product_merge": _with(
        "products price_changes",
        f"""
        , versions AS (
            SELECT product_id, product_link, price, DATE '{FIRST_CATALOGUE}' AS day FROM products
            UNION ALL
            (SELECT product_id, product_link, price, day FROM price_changes
             QUALIFY row_number() OVER (
                 PARTITION BY product_id, day
                 ORDER BY shipped_at DESC, position DESC, product_link DESC) = 1))
        SELECT md5(product_id || {_day('day')}) AS product_sk, product_id, product_link, price,
               {_day('day')} AS effective_date,
               coalesce({_day('lead(day) OVER w')}, '9999-12-31') AS expired_date,
               lead(day) OVER w IS NULL AS is_current
        FROM versions WINDOW w AS (PARTITION BY product_id ORDER BY day)""",
    ),
    "walkin_dim_insert": _VERSIONS,
    "stream_dim_customer": _VERSIONS,
    "stream_current_customer": f"SELECT * FROM ({_VERSIONS}) WHERE is_current",
    "stream_silver_customer": _SILVER_CUSTOMER,
    "stream_customer_changes": _SILVER_CUSTOMER,
    "backfill_tables": _with(
        "customers transactions walkins customer_versions activities",
        f"""
        , feed AS ({_FEED_COUNTS}),
        resolved AS (SELECT count(*) AS n FROM transactions)
        SELECT 'raw_table' AS name, CAST(sum(records) AS BIGINT) AS n FROM feed
        UNION ALL SELECT 'silver_customer',
            (SELECT count(*) FROM customers) + (SELECT count(DISTINCT customer_id) FROM walkins)
        UNION ALL SELECT 'silver_product', count(*) FROM part
        UNION ALL SELECT 'silver_transaction', n FROM resolved
        UNION ALL SELECT 'dim_customer', count(*) FROM customer_versions
        UNION ALL SELECT 'dim_product', count(*) FROM part
        UNION ALL SELECT 'dim_date', 18263
        UNION ALL SELECT 'fact_transaction', n FROM resolved
        UNION ALL SELECT 'people', count(*) FROM customers
        UNION ALL SELECT 'activity', count(*) FROM activities
        UNION ALL SELECT 'purchases', n FROM resolved""",
    ),
    "dim_date": f"""
        WITH days AS (
            SELECT CAST(d AS DATE) AS day
            FROM generate_series(DATE '{AS_OF}' - INTERVAL 25 YEAR,
                                 DATE '{AS_OF}' + INTERVAL 25 YEAR, INTERVAL 1 DAY) AS g(d)),
        per_day AS (
            SELECT CAST(o_orderdate AS DATE) AS day, count(*) AS orders FROM orders GROUP BY 1)
        SELECT CAST(strftime(days.day, '%Y%m%d') AS INTEGER) AS date_key,
               {_day('days.day')} AS "date", year(days.day) AS "year", month(days.day) AS "month",
               day(days.day) AS "day", isodow(days.day) AS day_of_week,
               quarter(days.day) AS quarter, coalesce(orders, 0) AS orders
        FROM days LEFT JOIN per_day ON per_day.day = days.day""",
    "fact_transaction": _FACTS,
    "stream_fact_equals_batch": _FACTS,
    "stream_fact_by_snapshot": _FACTS,
    "fact_transaction_shuffled": _FACTS,
    "fact_transaction_uuid": f"""
        SELECT * EXCLUDE (transaction_sk), 36 AS key_length, CAST(1 AS BIGINT) AS uses
        FROM ({_FACTS})""",
    "fact_late_products": _with(
        "facts products",
        f"""SELECT transaction_sk,
                   CASE WHEN product_type = 'ECONOMY' THEN product_sk
                        ELSE md5(f.product_id || {_day('sold_at')}) END AS product_sk, date_key
            FROM facts f JOIN products p ON p.product_id = f.product_id""",
    ),
    "star_revenue_by_type_quarter": _with(
        "facts products",
        """SELECT product_type, year(sold_at) AS "year", quarter(sold_at) AS quarter,
                  sum(CAST(f.quantity AS DOUBLE)) AS quantity,
                  CAST(sum(CAST(f.total_amount AS DECIMAL(18,2))) AS DOUBLE) AS total_amount,
                  count(*) AS sales
           FROM facts f JOIN products p ON p.product_id = f.product_id
           GROUP BY ALL""",
    ),
    "star_revenue_one_quarter": _with(
        "facts",
        """SELECT date_key, sum(CAST(quantity AS DOUBLE)) AS quantity,
                  CAST(sum(CAST(total_amount AS DECIMAL(18,2))) AS DOUBLE) AS total_amount,
                  count(*) AS sales
           FROM facts WHERE date_key BETWEEN 19970101 AND 19970331 GROUP BY date_key""",
    ),
    "star_revenue_by_weekday": _with(
        "facts",
        """SELECT CAST(isodow(sold_at) AS INTEGER) AS day_of_week,
                  sum(CAST(quantity AS DOUBLE)) AS quantity,
                  CAST(sum(CAST(total_amount AS DECIMAL(18,2))) AS DOUBLE) AS total_amount,
                  count(*) AS sales
           FROM facts WHERE date_key BETWEEN 19970401 AND 19970630 GROUP BY ALL""",
    ),
    "fact_on_sale_day": _with(
        "transactions products price_changes daily_orders",
        f"""
        , customer_days AS (
            SELECT customer_id, effective_date AS since,
                   coalesce(lead(effective_date) OVER w, DATE '9999-12-31') AS until
            FROM daily_orders WINDOW w AS (PARTITION BY customer_id ORDER BY effective_date)
        ), product_days AS (
            SELECT product_id, since, coalesce(lead(since) OVER w, DATE '9999-12-31') AS until
            FROM (SELECT product_id, DATE '{FIRST_CATALOGUE}' AS since FROM products
                  UNION SELECT product_id, day FROM price_changes)
            WINDOW w AS (PARTITION BY product_id ORDER BY since))
        SELECT md5(transaction_id) AS transaction_sk,
               CAST(strftime(sold_at, '%Y%m%d') AS INTEGER) AS date_key,
               md5(t.customer_id || {_day('coalesce(c.since, sold_at)')}) AS customer_sk,
               t.customer_id, md5(t.product_id || {_day('coalesce(p.since, sold_at)')})
                   AS product_sk, transaction_id,
               price AS unit_sales_price, CAST(quantity AS DOUBLE) AS quantity, total_amount,
               {_time('sold_at')} AS time_stamp
        FROM transactions t
        LEFT JOIN customer_days c ON c.customer_id = t.customer_id
             AND CAST(sold_at AS DATE) >= c.since AND CAST(sold_at AS DATE) < c.until
        LEFT JOIN product_days p ON p.product_id = t.product_id
             AND CAST(sold_at AS DATE) >= p.since AND CAST(sold_at AS DATE) < p.until""",
    ),
    "fact_repaired": _FACTS,
    "persons": _with("customers transactions walkins", _PERSONS),
    "revenue_by_person": _with(
        "facts",
        f"""
        , persons AS ({_PERSONS})
        SELECT p.person_id AS customer_id, count(*) AS sales,
               CAST(sum(CAST(total_amount AS DECIMAL(18,2))) AS DOUBLE) AS total_amount
        FROM facts f JOIN persons p ON p.customer_id = f.customer_id GROUP BY ALL""",
    ),
    "busy_activity_log": f"""
        WITH placed AS (
            SELECT CASE WHEN event_id % 3 = 0 THEN 'busy' ELSE CAST(user_id AS VARCHAR) END AS customer_id,
                   CASE WHEN event_id % 10 <> 0 THEN CAST(ts AS TIMESTAMP) END AS moment
            FROM events WHERE event_id % 3 = 0 OR user_id IS NOT NULL
        ), numbered AS (
            SELECT *, CAST((row_number() OVER (PARTITION BY customer_id ORDER BY moment NULLS FIRST) - 1)
                // 64 AS INTEGER) AS page FROM placed
        )
        SELECT customer_id, page, CAST(count(*) AS INTEGER) AS entries,
               {_time('min(moment)')} AS first_time, {_time('max(moment)')} AS last_time
        FROM numbered GROUP BY customer_id, page""",
    "stream_revenue_cube": _with(
        "facts",
        """SELECT CAST(grouping(sale_month) * 2 + grouping(product_sk) AS BIGINT) AS level, sale_month,
                  product_sk, sum(CAST(quantity AS DOUBLE)) AS quantity,
                  CAST(sum(CAST(total_amount AS DECIMAL(18,2))) AS DOUBLE) AS total_amount,
                  count(*) AS sales
           FROM (SELECT *, CAST(date_key // 100 AS INTEGER) AS sale_month FROM facts)
           GROUP BY GROUPING SETS ((sale_month, product_sk), (sale_month), (product_sk), ())""",
    ),
    "star_revenue_by_country": _with(
        "facts",
        """SELECT v.country, sum(CAST(f.quantity AS DOUBLE)) AS quantity,
                  CAST(sum(CAST(f.total_amount AS DECIMAL(18,2))) AS DOUBLE) AS total_amount,
                  count(*) AS sales
           FROM facts f JOIN customer_versions v ON v.customer_sk = f.customer_sk
           GROUP BY ALL""",
    ),
    "resolve_transactions": _RESOLVED,
    "resolve_transactions_in_time": f"{_RESOLVED} WHERE sold_at <= TIMESTAMP '{READ_AT}'"
                                    " + INTERVAL 3 MINUTE",
    "stream_transaction_log": _RESOLVED,
    "activity_log": _ACTIVITY,
    "stream_activity_log": _ACTIVITY,
    "stream_windowed_activity_log": _ACTIVITY,
    "stream_sales_near_changes": _with(
        "transactions",
        f"""SELECT transaction_id, phone_number, {_time('sold_at')} AS timestamp,
                   CAST(o_orderkey AS VARCHAR) AS change,
                   {_time('CAST(o_orderdate AS TIMESTAMP)')} AS changed_at
            FROM transactions
            JOIN orders ON phone_number = '09' || lpad(CAST(o_custkey AS VARCHAR), 8, '0')
             AND CAST(o_orderdate AS TIMESTAMP) BETWEEN sold_at - INTERVAL 3 MINUTE
                                                    AND sold_at + INTERVAL 30 DAY""",
    ),
    "transaction_log": _with(
        "facts",
        f"""SELECT customer_id, transaction_id, unit_sales_price, quantity, total_amount,
                   {_time('sold_at')} AS time_stamp
            FROM facts""",
    ),
    "unified_profile": _with(
        "facts activities",
        _entries(
            f"""SELECT customer_id AS master_id, first_name, last_name, gender,
                       {_day('date_of_birth')} AS date_of_birth
                FROM customer_versions WHERE is_current""",
            _FACT_ENTRIES, "master_id", "first_name, last_name, gender, date_of_birth",
            *_FACT_AMOUNTS,
        ),
    ),
    "merge_profile_documents": _with(
        "facts activities",
        _entries(
            """SELECT customer_id, first_name, gender FROM customers
               UNION ALL SELECT DISTINCT customer_id, NULL, NULL
               FROM (SELECT customer_id FROM facts UNION SELECT customer_id FROM activities)
               WHERE customer_id NOT IN (SELECT customer_id FROM customers)""",
            _FACT_ENTRIES, "customer_id", "first_name, gender", *_FACT_AMOUNTS,
        ),
    ),
    "set_document_fields": _with(
        "customers activities",
        f"""SELECT coalesce(c.customer_id, a.customer_id) AS customer_id, first_name, gender, events,
                   last_seen
            FROM customers c FULL JOIN (
                SELECT customer_id, count(*) AS events, max({_time('time_stamp')}) AS last_seen
                FROM activities WHERE customer_id IS NOT NULL GROUP BY customer_id
            ) a ON a.customer_id = c.customer_id""",
    ),
    "stream_profiles": _with(
        "customers transactions activities",
        _entries(
            """SELECT customer_id, first_name, gender FROM customers
               UNION ALL SELECT DISTINCT customer_id, NULL, NULL FROM activities
               WHERE customer_id NOT IN (SELECT customer_id FROM customers)""",
            _PHONE_ENTRIES, "customer_id", "first_name, gender", *_PHONE_AMOUNTS,
        ),
    ),
}

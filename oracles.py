"""Reference SQL for DuckDB, one statement per registered query.

Only the derivation of the input rows (``raw``, ``sales``, ``messages``) is
shared with ``tillwright.plans.bridge``. Every rule and result is written out
here independently.
"""

from __future__ import annotations

from tillwright.plans import bridge


def _select(columns, mapping, extra: str = "") -> str:
    froms = ["lineitem"]
    for join in bridge.needed_joins(columns, mapping):
        table, renamed, condition, _ = bridge.JOINS[join]
        source = table
        if renamed:
            source = f"(SELECT {', '.join(f'{a} AS {b}' for a, b in renamed.items())} FROM {table})"
        froms.append(f"JOIN {source} AS t_{join} ON {condition}")
    picks = ", ".join(f'{mapping[c][0]} AS "{c}"' for c in columns)
    return f"SELECT {picks}{extra} FROM {' '.join(froms)}"


def r3(x: str) -> str:
    """Half-up rounding of the shortest decimal text of a double, as Spark rounds."""
    return f"CAST(round(CAST(CAST({x} AS VARCHAR) AS DECIMAL(38, 18)), 3) AS DOUBLE)"


def mean_of(x: str, digits: int) -> str:
    """Rounded mean, nudged off the point exactly between two roundings."""
    return f"round(avg({x}) + 5e-{digits + 4}, {digits})"


DISCOUNT = """CASE WHEN offer_1 = 'True' THEN 0.05::DOUBLE WHEN offer_2 = 'True' THEN 0.10::DOUBLE
    WHEN offer_3 = 'True' THEN 0.15::DOUBLE WHEN offer_4 = 'True' THEN 0.20::DOUBLE
    WHEN offer_5 = 'True' THEN 0.25::DOUBLE ELSE 0.0::DOUBLE END"""
STATE_CASE = """CASE {c} WHEN 'AZ' THEN 'Arizona' WHEN 'CA' THEN 'California'
    WHEN 'DC' THEN 'District of Columbia' WHEN 'TN' THEN 'Tennessee' ELSE {c} END"""
# A missing part of the address is null, not an empty text.
PART = "string_split(shipping_address, '/')[{i}]"
LENIENT = r"""regexp_replace(regexp_replace(customer_email, '\s+', '', 'g'),
    '^(.+@.+)\.[^.]+$', '\1.com')"""
_ADDRESS = r"^[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}"
STRICT = rf"""nullif(regexp_extract(CASE WHEN contains(customer_email, '.')
    THEN regexp_replace(trim(customer_email), '[^.]+$', 'com') END, '{_ADDRESS}'), '')"""
VALIDATE = rf"nullif(regexp_extract(trim(customer_email), '{_ADDRESS}'), '')"
TRX = """CASE WHEN regexp_replace(transaction_id, '[^0-9]', '', 'g') <> ''
    THEN 'trx-' || regexp_replace(transaction_id, '[^0-9]', '', 'g') END"""
FULL_NAME = "customer_fname || ' ' || customer_lname"
STATE = STATE_CASE.format(c=PART.format(i=3))

RAW = f"raw AS ({_select(list(bridge.RAW), bridge.RAW)})"


def std(email: str = LENIENT, price: str = "abs(unit_price)") -> str:
    """CTEs raw and std: the cleaned rows with every column of both channels."""
    return f"""{RAW},
    std0 AS (SELECT {TRX} AS transaction_id, transaction_date, customer_id,
        {FULL_NAME} AS customer_name, {email} AS customer_email, product_id, product_name,
        product_category, units, {price} AS unit_price, {DISCOUNT} AS discount, payment_method,
        "group", is_online, CASE WHEN is_online = 'yes' THEN 'online' ELSE 'offline' END
        AS transaction_type, sales_agent_id, name AS sales_agent_name,
        hire_date AS sales_agent_hire_date, branch_id, location AS branch_location,
        class AS branch_class, establish_date AS branch_establish_date,
        {PART.format(i=1)} AS shipping_street_name, {PART.format(i=2)} AS shipping_city,
        {STATE} AS shipping_state, {PART.format(i=4)} AS shipping_zip_code FROM raw),
    std AS (SELECT *, {r3('units * unit_price * (1 - discount)')} AS total_price FROM std0)"""


STD = std()
DAY = "CAST({c} AS VARCHAR) AS {c}"
ONLINE = f"""transaction_id, {DAY.format(c='transaction_date')}, customer_id, customer_name,
    customer_email, product_id, product_name, product_category, units, unit_price, discount,
    total_price, payment_method, shipping_street_name, shipping_city, shipping_state,
    shipping_zip_code, "group\""""
OFFLINE = f"""transaction_id, {DAY.format(c='transaction_date')}, customer_id, customer_name,
    customer_email, sales_agent_id, branch_id, product_id, product_name, product_category, units,
    unit_price, discount, total_price, payment_method, sales_agent_name,
    {DAY.format(c='sales_agent_hire_date')}, branch_location,
    {DAY.format(c='branch_establish_date')}, branch_class, "group\""""
ALL_COLUMNS = """transaction_id, transaction_date, transaction_type, customer_id, customer_name,
    customer_email, product_id, product_name, product_category, units, unit_price, discount,
    payment_method, "group", sales_agent_id, sales_agent_name, sales_agent_hire_date, branch_id,
    branch_location, branch_class, shipping_street_name, shipping_city, shipping_state,
    shipping_zip_code"""
# Online rows hold no agent or branch and offline rows no address, by layout.
ALL = f"""allsales AS (SELECT * REPLACE (
    CASE WHEN transaction_type = 'offline' THEN sales_agent_id END AS sales_agent_id,
    CASE WHEN transaction_type = 'offline' THEN sales_agent_name END AS sales_agent_name,
    CASE WHEN transaction_type = 'offline' THEN sales_agent_hire_date END AS sales_agent_hire_date,
    CASE WHEN transaction_type = 'offline' THEN branch_id END AS branch_id,
    CASE WHEN transaction_type = 'offline' THEN branch_location END AS branch_location,
    CASE WHEN transaction_type = 'offline' THEN branch_class END AS branch_class,
    CASE WHEN transaction_type = 'online' THEN shipping_street_name END AS shipping_street_name,
    CASE WHEN transaction_type = 'online' THEN shipping_city END AS shipping_city,
    CASE WHEN transaction_type = 'online' THEN shipping_state END AS shipping_state,
    CASE WHEN transaction_type = 'online' THEN shipping_zip_code END AS shipping_zip_code
    ) FROM std)"""


def dated(columns: str) -> str:
    for c in ("transaction_date", "sales_agent_hire_date", "branch_establish_date"):
        columns = columns.replace(f"{c},", f"CAST({c} AS VARCHAR) AS {c},")
    return columns


FIRST = "transaction_date < DATE '1998-01-01'"
_ONLINE_ORDER = ["transaction_date", "customer_id", "customer_name", "customer_email",
                 "product_id", "product_name", "product_category", "units", "unit_price",
                 "discount", "total_price", "payment_method", "shipping_street_name",
                 "shipping_city", "shipping_state", "shipping_zip_code", '"group"']
_OFFLINE_ORDER = ["transaction_date", "customer_id", "customer_name", "customer_email",
                  "sales_agent_id", "branch_id", "product_id", "product_name",
                  "product_category", "units", "unit_price", "discount", "total_price",
                  "payment_method", "sales_agent_name", "sales_agent_hire_date",
                  "branch_location", "branch_establish_date", "branch_class", '"group"']
_ONLINE_PLAIN = ", ".join(["transaction_id", *_ONLINE_ORDER])
_OFFLINE_PLAIN = ", ".join(["transaction_id", *_OFFLINE_ORDER])


def two_loads(name: str, source: str, columns: str) -> str:
    """What two loads of a channel store: distinct early rows, then those with other ids."""
    return f"""{name}_rows AS (SELECT DISTINCT {columns}, {FIRST} AS early FROM {source}
        WHERE transaction_id IS NOT NULL),
    {name}_first AS (SELECT DISTINCT transaction_id AS id FROM {name}_rows WHERE early),
    {name}_fresh AS (SELECT * FROM {name}_rows WHERE NOT early
        AND transaction_id NOT IN (SELECT id FROM {name}_first)),
    {name}_stored AS (SELECT * FROM {name}_rows WHERE early UNION ALL SELECT * FROM {name}_fresh)"""


def balance(name: str, columns: str) -> str:
    """Where the rows of the second load go."""
    return f"""SELECT '{name}' AS channel, count(*) AS rows_in,
        (SELECT count(*) FROM {name}_fresh) AS stored,
        count(*) FILTER (transaction_id IS NOT NULL AND ({FIRST} OR transaction_id NOT IN
            (SELECT id FROM {name}_first))) - (SELECT count(*) FROM {name}_fresh) AS known,
        count(*) FILTER (transaction_id IS NULL OR (NOT {FIRST} AND transaction_id IN
            (SELECT id FROM {name}_first))) AS set_aside
        FROM std WHERE transaction_type = '{name}'"""


def dim(name: str, source: str, columns: list[str], where: str = "TRUE") -> str:
    """One row per id: the attributes of the latest sale, keys in id order."""
    natural, attributes = columns[0], columns[1:]
    order = ", ".join(f"{c} DESC NULLS LAST" for c in ["transaction_date", *attributes])
    return f"""{name}0 AS (SELECT {', '.join(columns)} FROM {source}
        WHERE {natural} IS NOT NULL AND {where}
        QUALIFY row_number() OVER (PARTITION BY {natural} ORDER BY {order}) = 1),
    {name} AS (SELECT *, row_number() OVER (ORDER BY {natural}) AS {name}_key FROM {name}0)"""


OFF = "transaction_type = 'offline'"
DIMS = {
    "product": dim("product", "std",
                   ["product_id", "product_name", "product_category", "unit_price"]),
    "customer": dim("customer_", "std", ["customer_id", "customer_name", "customer_email"]).replace(
        "customer__key", "customer_key"),
    "branch": dim("branch", "std", ["branch_id", "branch_location", "branch_establish_date",
                                    "branch_class"], OFF),
    "sales_agent": dim("sales_agent", "std", ["sales_agent_id", "sales_agent_hire_date",
                                              "sales_agent_name"], OFF),
}
DATE_KEY = "CAST(strftime(transaction_date, '%Y%m%d') AS BIGINT)"
ONLINE_JOINS = """JOIN product p ON p.product_id = s.product_id
    JOIN customer_ c ON c.customer_id = s.customer_id"""
OFFLINE_JOINS = f"""{ONLINE_JOINS} JOIN branch b ON b.branch_id = s.branch_id
    JOIN sales_agent a ON a.sales_agent_id = s.sales_agent_id"""


def _dims(*names: str) -> str:
    return ", ".join(DIMS[n] for n in names)


def fact(columns: str, channel: str) -> str:
    names = ("product", "customer") if channel == "online" else tuple(DIMS)
    joins = ONLINE_JOINS if channel == "online" else OFFLINE_JOINS
    return f"""WITH {STD}, {_dims(*names)} SELECT {columns} FROM std s {joins}
        WHERE s.transaction_type = '{channel}'"""


def raw(columns: list[str], select: str, rest: str = "") -> str:
    return f"WITH raw AS ({_select(columns, bridge.RAW)}) SELECT {select} FROM raw {rest}"


def sales(columns: list[str], select: str, rest: str, channel: str | None = None) -> str:
    """Statement over the star schema sales; ``total_price`` is always there."""
    rows = _select(columns, bridge.SALES, f", {r3(bridge.AMOUNT)} AS total_price")
    if channel:
        rows += " WHERE l_orderkey % 2 " + ("= 0" if channel == "online" else "<> 0")
    return f"WITH sales AS ({rows}) SELECT {select} FROM sales {rest}"


TOTAL = "round(sum(total_price), 3) AS total_sales"
DATES = "JOIN (SELECT DISTINCT CAST(o_orderdate AS DATE) AS d FROM orders) ON strftime(d, '%Y%m%d') = CAST(date_key AS VARCHAR)"
PRODUCT = "JOIN part ON p_partkey = product_key"
CUSTOMER = "JOIN customer ON c_custkey = customer_key"
BRANCH = "JOIN nation ON n_nationkey = branch_key"


def channel_means(key: str, measure: str, label: str, name: str, joins: str, digits: int) -> str:
    """Average of the channel averages."""
    columns = ["transaction_type", key] + ([measure] if measure != "total_price" else [])
    base = sales(columns, f"transaction_type, {key}, avg({measure}) AS m",
                 f"GROUP BY transaction_type, {key}")
    return f"""SELECT {label}, {name} FROM (SELECT {key}, {mean_of('m', digits)} AS {name}
        FROM ({base}) GROUP BY {key}) {joins}"""


# Of every mart: the columns that name a row, and its numbers.
MART_COLUMNS = {
    "total_monthly_sales": (("year", "month"), ("total_sales",)),
    "total_product_sales": (("product_name",), ("total_sales",)),
    "total_payment_method_sales": (("payment_method",), ("total_sales",)),
    "total_customer_sales": (("customer_id",), ("total_sales",)),
    "branch_sales": (("branch_id",), ("total_sales",)),
    "agent_sales": (("sales_agent_name",), ("total_sales",)),
    "top_products": (("product_name",), ("total_units",)),
    "discount_by_product": (("product_name",), ("average_discount",)),
    "total_sales_trend": (("datee",), ("total_sales",)),
    "total_category_sales": (("product_category",), ("total_sales",)),
    "avg_sales_per_customer": (("customer_name",), ("average_sales",)),
    "freq_customers": (("customer_name",), ("total_transactions",)),
    "total_sales_by_state": (("shipping_state",), ("total_sales",)),
    "clv": (("customer_name",), ("total_sales", "total_units")),
    "monthly_sales": (("year", "month"), ("total_sales", "prev_month_sales", "growth_rate")),
}


def all_marts(out: dict[str, str]) -> str:
    """The rows of all marts in one layout."""
    def part(name: str) -> str:
        labels, values = MART_COLUMNS[name]
        label = " || '/' || ".join(f"CAST({c} AS VARCHAR)" for c in labels)
        numbers = [f"CAST({c} AS DOUBLE)" for c in values] + ["CAST(NULL AS DOUBLE)"] * (3 - len(values))
        first, second, third = numbers
        return f"""SELECT '{name}' AS mart, {label} AS label, {first} AS first_value,
            {second} AS second_value, {third} AS third_value FROM ({out[name]})"""
    return " UNION ALL ".join(part(name) for name in MART_COLUMNS)


def export(select: str) -> str:
    """Statement over the careless export: its fields as text, and its lines."""
    fields = ", ".join(f'{e} AS "{c}"' for c, e in bridge.EXPORT.items())
    parts = ", ".join(f"{e} AS f{i}" for i, e in enumerate(bridge.EXPORT.values(), 1))
    return f"""WITH raw AS ({_select(bridge.EXPORT_COLUMNS, bridge.RAW)}),
        fields AS (SELECT {fields} FROM raw WHERE NOT ({bridge.EXPORT_MALFORMED})),
        lines AS (SELECT {bridge.EXPORT_LINE} AS line FROM (SELECT product_id, {parts} FROM raw)
            WHERE {bridge.EXPORT_MALFORMED}),
        misfits AS ({" UNION ALL ".join(
            f"""SELECT transaction_id, '{c}' AS rejected_column, replace({c}, '""', '') AS value
            FROM fields WHERE {c} <> '' AND try_cast({c} AS {kind}) IS NULL"""
            for c, kind in (("units", "BIGINT"), ("unit_price", "DOUBLE"), ("transaction_date", "DATE")))})
        {select}"""


def customers_of(unit: str) -> str:
    return f"""SELECT '{unit}' AS unit, "eventType", category,
        strftime(date_trunc('{unit}', timestamp), '%Y-%m-%d %H:%M:%S') AS period,
        count(*) AS events, count(DISTINCT "customerId") AS customers, TRUE AS within_error
        FROM events_ WHERE "customerId" IS NOT NULL GROUP BY ALL"""


def manifest() -> str:
    return """files AS (SELECT '/drops/group' || (o_custkey % 6 + 1) || '/' ||
        CASE o_orderkey % 3 WHEN 0 THEN 'branches' WHEN 1 THEN 'sales_agents'
             ELSE 'sales_transactions' END || '_' || o_orderkey || '.csv' AS path,
        CAST(o_custkey % 6 + 1 AS INTEGER) AS group_number,
        CASE o_orderkey % 3 WHEN 0 THEN 'branches' WHEN 1 THEN 'sales_agents'
             ELSE 'sales_transactions' END AS kind, o_orderdate AS modified FROM orders),
    recent AS (SELECT * FROM files
        WHERE modified > TIMESTAMP '2001-07-31 00:00:00' - INTERVAL 20 DAY
        QUALIFY row_number() OVER (PARTITION BY group_number, kind
                                   ORDER BY modified DESC, path DESC) = 1),
    complete AS (SELECT * FROM recent WHERE group_number IN (
        SELECT group_number FROM recent GROUP BY group_number HAVING count(*) = 3))"""


def messages() -> str:
    e = bridge.EVENTS
    return f"""events_ AS (SELECT {e['eventType']} AS "eventType", {e['customerId']} AS "customerId",
        json_extract_string(props, '$.k') AS "productId", date_trunc('second', ts) AS timestamp,
        {e['category']} AS category, {e['source']} AS source, {e['quantity']} AS quantity,
        {e['totalAmount']} AS "totalAmount", {e['paymentMethod']} AS "paymentMethod",
        CASE WHEN event_type = 'click' THEN json_extract_string(props, '$.k') END
            AS "recommendedProductId", {e['algorithm']} AS algorithm FROM events)"""


def window(seconds: int, key: str, measures: str, delay: int | None = None) -> str:
    """Purchases by key and epoch-aligned window; with a delay, closed windows only."""
    start = f"epoch(timestamp)::BIGINT // {seconds} * {seconds}"
    closed = ""
    if delay is not None:
        closed = f"""HAVING start_ + {seconds} <=
            (SELECT epoch(max(timestamp))::BIGINT FROM events_
                WHERE "eventType" = 'purchase') - {delay}"""
    text = "strftime(make_timestamp({x} * 1000000), '%Y-%m-%d %H:%M:%S')"
    return f"""WITH {messages()} SELECT {key}, {text.format(x='start_')} AS window_start,
        {text.format(x=f'(start_ + {seconds})')} AS window_end, {measures}
        FROM (SELECT *, {start} AS start_ FROM events_) WHERE "eventType" = 'purchase'
        GROUP BY {key}, start_ {closed}"""


def amounts(count: str, total: str, mean: str) -> str:
    return f"""count(*) AS {count}, round(sum("totalAmount"), 4) AS {total},
        {mean_of('"totalAmount"', 6)} AS {mean}"""


HOUR, DAY_S = 3600, 86400
_FLAT = """"eventType", "customerId", "productId",
    strftime(timestamp, '%Y-%m-%d %H:%M:%S') AS timestamp, category, source,
    quantity, "totalAmount", "paymentMethod", "recommendedProductId", algorithm,
    CAST(CAST(timestamp AS DATE) AS VARCHAR) AS date"""
_TIE = ", ".join(f'"{c}" DESC NULLS LAST' for c in (
    "eventType", "productId", "category", "source", "quantity", "totalAmount", "paymentMethod",
    "recommendedProductId", "algorithm"))
LATEST = f"""WITH {messages()} SELECT {_FLAT} FROM events_ QUALIFY row_number() OVER (
    PARTITION BY "customerId" ORDER BY timestamp DESC, {_TIE}) = 1"""


def window_count(name: str, seconds: int, key: str, delay: int) -> str:
    inner = window(seconds, key, "count(*) AS n", delay)
    return f"SELECT '{name}' AS sink, (SELECT count(*) FROM ({inner})) AS rows"


def stream_counts() -> str:
    parts = ["SELECT 'archive' AS sink, (SELECT count(*) FROM events) AS rows"]
    for name, seconds, key, delay in (
        ("hourly_sales", HOUR, '"productId"', 2 * HOUR),
        ("category_performance", HOUR, "category", 2 * HOUR),
        ("payment_method_trends", DAY_S, '"paymentMethod"', 48 * HOUR),
        ("customer_segmentation", 30 * DAY_S, '"customerId"', 30 * DAY_S),
        ("product_inventory", HOUR, '"productId"', 2 * HOUR),
    ):
        parts.append(window_count(name, seconds, key, delay))
    return " UNION ALL ".join(parts)


def build() -> dict[str, str]:
    offers = [f"offer_{i}" for i in range(1, 6)]
    out = {
        "clean_discount": raw(["transaction_id", *offers],
                              f"transaction_id, {DISCOUNT} AS discount"),
        "clean_address": raw(
            ["transaction_id", "shipping_address"],
            f"""transaction_id, {PART.format(i=1)} AS shipping_street_name,
            {PART.format(i=2)} AS shipping_city, {STATE} AS shipping_state,
            {PART.format(i=4)} AS shipping_zip_code"""),
        "clean_state": raw(["shipping_address"], f"{PART.format(i=3)} AS code, {STATE} AS state"),
        "clean_email_lenient": raw(["customer_id", "customer_email"],
                                   f"customer_id, {LENIENT} AS email"),
        "clean_email_strict": raw(["customer_id", "customer_email"],
                                  f"customer_id, {STRICT} AS email"),
        "clean_email_validate": raw(["customer_id", "customer_email"],
                                    f"customer_id, {VALIDATE} AS email"),
        "clean_trx_id": raw(["transaction_id"],
                            f"transaction_id AS raw_id, {TRX} AS transaction_id"),
        "clean_price": raw(["transaction_id", "unit_price"],
                           "transaction_id, abs(unit_price) AS unit_price"),
        "customer_full_name": raw(["customer_id", "customer_fname", "customer_lname"],
                                  f"customer_id, {FULL_NAME} AS customer_name"),
        "total_price": raw(
            ["transaction_id", "units", "unit_price", *offers],
            f"""transaction_id,
            {r3(f'units * abs(unit_price) * (1 - {DISCOUNT})')} AS total_price"""),
        "cast_dates_and_ids": raw(
            ["transaction_id", "transaction_date", "sales_agent_id", "branch_id"],
            """transaction_id, CAST(transaction_date AS VARCHAR) AS transaction_date,
            sales_agent_id, nullif(branch_id, 3) AS branch_id"""),
        "drop_blank_columns": raw(["transaction_id", "group", "offer_5", "is_online"],
                                  'transaction_id, "group", offer_5, is_online'),
        "rename_columns": raw(
            ["customer_lname", "sales_agent_id", "name", "hire_date", "location",
             "establish_date", "class"],
            """customer_lname, sales_agent_id, name AS sales_agent_name,
            CAST(hire_date AS VARCHAR) AS sales_agent_hire_date, location AS branch_location,
            CAST(establish_date AS VARCHAR) AS branch_establish_date, class AS branch_class"""),
        "row_index": "SELECT count(*) AS rows, count(*) AS distinct_indexes FROM lineitem",
        "cleaned_layout": f"""WITH {STD} SELECT {dated(ALL_COLUMNS.replace('transaction_type, ', ''))},
            CASE WHEN is_online = 'yes' THEN 'yes' ELSE 'no' END AS is_online FROM std""",
        "channel_tag": raw(["transaction_id", "is_online"],
                           """transaction_id, CASE WHEN is_online = 'yes' THEN 'online'
                           ELSE 'offline' END AS transaction_type"""),
        "channel_split": raw(["transaction_id", "is_online", "units"],
                             """transaction_id, units, CASE is_online WHEN 'yes' THEN 'online'
                             ELSE 'offline' END AS channel""", "WHERE is_online IN ('yes', 'no')"),
        "channel_split_losses": raw(["is_online"],
                                    "coalesce(is_online, 'null') AS is_online, count(*) AS dropped_rows",
                                    "WHERE coalesce(is_online, '') NOT IN ('yes', 'no') GROUP BY 1"),
        "standardize_online": f"WITH {STD} SELECT {ONLINE} FROM std WHERE transaction_type = 'online'",
        "standardize_offline": f"WITH {STD} SELECT {OFFLINE} FROM std WHERE {OFF}",
        "standardize_strict_online":
            f"""WITH {std(STRICT, 'unit_price')} SELECT {ONLINE} FROM std
            WHERE is_online = 'yes'""",
        "standardize_strict_offline":
            f"""WITH {std(STRICT, 'unit_price')} SELECT {OFFLINE} FROM std
            WHERE is_online = 'no'""",
        "all_sales_union": f"""WITH {STD}, {ALL} SELECT {dated(ALL_COLUMNS)}, total_price
            FROM allsales""",
        "enrich_left_joins": raw(
            ["transaction_id", "sales_agent_id", "branch_id", "units"],
            """transaction_id, sales_agent_id, branch_id, units, s_name AS name,
            CAST(DATE '2015-01-01' + CAST(s_suppkey % 3000 AS INTEGER) AS VARCHAR) AS hire_date,
            n_name AS location, 'group1' AS "group\"""",
            """LEFT JOIN supplier ON s_suppkey = sales_agent_id
            LEFT JOIN nation ON n_nationkey = branch_id"""),
        "complete_drops": f"""WITH {manifest()} SELECT group_number, kind, path,
            strftime(modified, '%Y-%m-%d %H:%M:%S') AS modified FROM complete""",
        "latest_complete_group": f"""WITH {manifest()} SELECT group_number, kind, path,
            strftime(modified, '%Y-%m-%d %H:%M:%S') AS modified FROM complete
            WHERE group_number = (SELECT min(group_number) FROM complete)""",
        "newest_file": f"""WITH {manifest()} SELECT path FROM files
            ORDER BY modified DESC, path DESC LIMIT 1""",
        "newest_file_by_prefix": f"""WITH {manifest()} SELECT path FROM files
            WHERE kind = 'branches' ORDER BY split_part(path, '/', 4) DESC, path DESC LIMIT 1""",
        "group_numbers": f"""WITH {manifest()} SELECT group_number,
            'group' || group_number AS business_group, count(*) AS files FROM files
            GROUP BY group_number""",
        "csv_enforced_schema": f"""WITH {RAW} SELECT * REPLACE (
            CAST(transaction_date AS VARCHAR) AS transaction_date,
            CAST(hire_date AS VARCHAR) AS hire_date,
            CAST(establish_date AS VARCHAR) AS establish_date) FROM raw""",
        "csv_without_header": raw(["transaction_id", "units", "unit_price"],
                                  "transaction_id, units, unit_price"),
        "reconcile_schema": raw(
            ["transaction_id", "units", "transaction_date", "unit_price"],
            """trim(transaction_id) AS transaction_id, units, unit_price,
            CAST(transaction_date AS VARCHAR) AS transaction_date,
            CAST(NULL AS VARCHAR) AS logs, 'kept' AS remark"""),
        "rejected_values": export("""SELECT * FROM misfits
            UNION ALL SELECT NULL, NULL, line FROM lines"""),
        "rejected_counts": export("""SELECT 'rows_in' AS counted, (SELECT count(*) FROM raw) AS "rows"
            UNION ALL SELECT 'malformed', (SELECT count(*) FROM lines)
            UNION ALL SELECT c, (SELECT count(*) FROM misfits WHERE rejected_column = c)
            FROM (VALUES ('transaction_id'), ('units'), ('unit_price'), ('transaction_date')) t(c)"""),
        "accepted_rows": export("""SELECT transaction_id, try_cast(units AS BIGINT) AS units,
            try_cast(unit_price AS DOUBLE) AS unit_price,
            CAST(try_cast(transaction_date AS DATE) AS VARCHAR) AS transaction_date FROM fields"""),
        "json_by_extension": raw(["transaction_id", "units", "unit_price", "payment_method"],
                                 "* REPLACE (abs(unit_price) AS unit_price)"),
        "merge_schema_scan": raw(
            ["transaction_id", "units", "group"],
            """transaction_id, units, CASE WHEN "group" > 'group3' THEN "group" END AS "group",
            CAST(CASE WHEN "group" > 'group3' THEN 2 ELSE 1 END AS INTEGER) AS day"""),
        "standardized_store":
            f"WITH {STD} SELECT {ONLINE} FROM std WHERE transaction_type = 'online'",
        "drop_to_standardized": f"""WITH {STD} SELECT {ONLINE} FROM std
            WHERE transaction_type = 'online' AND "group" = 'group2'""",
        "incremental_new_rows": f"""WITH {STD}, chan AS (SELECT * FROM std
            WHERE transaction_type = 'online'), {two_loads('online', 'chan', _ONLINE_PLAIN)}
            SELECT {ONLINE} FROM online_fresh""",
        "load_balance": f"""WITH {STD}, onl AS (SELECT * FROM std
            WHERE transaction_type = 'online'), off AS (SELECT * FROM std WHERE {OFF}),
            {two_loads('online', 'onl', _ONLINE_PLAIN)},
            {two_loads('offline', 'off', _OFFLINE_PLAIN)}
            {balance('online', _ONLINE_PLAIN)} UNION ALL {balance('offline', _OFFLINE_PLAIN)}""",
        "quarantined_rows": f"""WITH {STD} SELECT transaction_type, count(*) AS rows FROM std
            WHERE transaction_id IS NULL GROUP BY 1""",
        "merge_dedup": f"""WITH {STD} SELECT DISTINCT {ONLINE} FROM std
            WHERE transaction_type = 'online'""",
        "denormalised_append": f"""WITH {STD}, onl AS (SELECT * FROM std
            WHERE transaction_type = 'online'), off AS (SELECT * FROM std WHERE {OFF}),
            {two_loads('online', 'onl', _ONLINE_PLAIN)},
            {two_loads('offline', 'off', _OFFLINE_PLAIN)}, allsales AS (
                SELECT 'online' AS transaction_type, * FROM online_stored
                UNION ALL BY NAME SELECT 'offline' AS transaction_type, * FROM offline_stored)
            SELECT {dated(ALL_COLUMNS)} FROM allsales""",
        "interrupted_load": f"""WITH {STD}, onl AS (SELECT * FROM std
            WHERE transaction_type = 'online'), off AS (SELECT * FROM std WHERE {OFF}),
            {two_loads('online', 'onl', _ONLINE_PLAIN)},
            {two_loads('offline', 'off', _OFFLINE_PLAIN)}, allsales AS (
                SELECT 'online' AS transaction_type, * FROM online_stored
                UNION ALL BY NAME SELECT 'offline' AS transaction_type, * FROM offline_stored)
            SELECT {dated(ALL_COLUMNS)} FROM allsales""",
        "replaced_load": f"""WITH {STD}, onl AS (SELECT * FROM std
            WHERE transaction_type = 'online' AND units <= 25), off AS (SELECT * FROM std
            WHERE {OFF} AND units <= 25),
            o AS (SELECT DISTINCT {_ONLINE_PLAIN} FROM onl), f AS (SELECT DISTINCT {_OFFLINE_PLAIN} FROM off),
            n AS (SELECT (SELECT count(*) FROM o WHERE transaction_id IS NOT NULL) AS o_new,
                (SELECT count(*) FROM f WHERE transaction_id IS NOT NULL) AS f_new,
                (SELECT count(*) FROM o WHERE transaction_id IS NULL) AS o_aside,
                (SELECT count(*) FROM f WHERE transaction_id IS NULL) AS f_aside)
            SELECT 'all' AS table_name, o_new + f_new AS rows FROM n
            UNION ALL SELECT 'online', o_new FROM n UNION ALL SELECT 'offline', f_new FROM n
            UNION ALL SELECT 'online_set_aside', o_aside FROM n
            UNION ALL SELECT 'offline_set_aside', f_aside FROM n""",
        "id_index_known": f"""WITH {STD}, onl AS (SELECT * FROM std WHERE transaction_type = 'online')
            SELECT DISTINCT transaction_id FROM onl WHERE transaction_id IN (
                SELECT transaction_id FROM onl WHERE transaction_date < DATE '1998-01-01')""",
        "date_dim": """WITH days AS (SELECT CAST(unnest(generate_series(min(o_orderdate),
            max(o_orderdate), INTERVAL 1 DAY)) AS DATE) AS d FROM orders)
            SELECT CAST(d AS VARCHAR) AS datee, CAST(strftime(d, '%Y%m%d') AS BIGINT) AS date_key,
            CAST(day(d) AS INTEGER) AS day, CAST(dayofweek(d) + 1 AS INTEGER) AS day_of_week,
            CAST(dayofyear(d) AS INTEGER) AS day_of_year,
            CAST(weekofyear(d) AS INTEGER) AS week_of_year, CAST(month(d) AS INTEGER) AS month,
            CAST(quarter(d) AS INTEGER) AS quarter, CAST(year(d) AS INTEGER) AS year,
            CAST(dayofweek(d) IN (5, 6) AS INTEGER) AS is_weekend,
            monthname(d) AS month_name, dayname(d) AS day_name,
            strftime(d, '%Y%m') AS year_month FROM days""",
        "product_dim": f"WITH {STD}, {DIMS['product']} SELECT * FROM product",
        "customer_dim": f"WITH {STD}, {DIMS['customer']} SELECT * FROM customer_",
        "branch_dim": f"""WITH {STD}, {DIMS['branch']} SELECT * REPLACE (
            CAST(branch_establish_date AS VARCHAR) AS branch_establish_date) FROM branch""",
        "sales_agent_dim": f"""WITH {STD}, {DIMS['sales_agent']} SELECT * REPLACE (
            CAST(sales_agent_hire_date AS VARCHAR) AS sales_agent_hire_date) FROM sales_agent""",
        "product_dim_distinct": f"""WITH {std(price='unit_price')}, d AS (SELECT DISTINCT
            product_id, product_name, product_category, unit_price FROM std)
            SELECT *, row_number() OVER (ORDER BY product_id, product_name, product_category,
            unit_price) AS product_key FROM d""",
        "location_dim": f"""WITH {STD}, d AS (SELECT DISTINCT shipping_street_name, shipping_city,
            shipping_state, shipping_zip_code FROM std WHERE transaction_type = 'online'
            AND shipping_street_name IS NOT NULL)
            SELECT *, row_number() OVER (ORDER BY shipping_street_name NULLS FIRST,
            shipping_city NULLS FIRST, shipping_state NULLS FIRST, shipping_zip_code NULLS FIRST)
            AS location_id FROM d""",
        "reference_values": f"WITH {STD} " + " UNION ".join(
            f"SELECT '{name}' AS list_name, {column} AS value FROM std" for name, column in (
                ("products", "product_name"), ("categories", "product_category"),
                ("streets", "shipping_street_name"), ("states", "shipping_state"),
                ("cities", "shipping_city"), ("zip_codes", "shipping_zip_code"),
                ("branch_locations", "branch_location"), ("branch_classes", "branch_class"),
                ("groups", '"group"'))),
        "shipping_locations": f"""WITH {STD} SELECT DISTINCT shipping_street_name, shipping_city,
            shipping_state, shipping_zip_code FROM std""",
        "category_products": f"WITH {STD} SELECT DISTINCT product_category, product_name FROM std",
        "stable_keys": f"""WITH {STD}, ids AS (SELECT customer_id, bool_or({FIRST}) AS early
            FROM std GROUP BY customer_id)
            SELECT customer_id, row_number() OVER (ORDER BY early DESC, customer_id)
            AS customer_key FROM ids""",
        "online_fact": fact(f"""transaction_id, customer_key, product_key, {DATE_KEY} AS date_key,
            units, s.unit_price, discount, payment_method, "group", total_price,
            shipping_zip_code, shipping_state, shipping_city, shipping_street_name""", "online"),
        "offline_fact": fact(f"""transaction_id, customer_key, sales_agent_key, branch_key,
            product_key, {DATE_KEY} AS date_key, units, s.unit_price, discount, payment_method,
            total_price, CAST(transaction_date AS VARCHAR) AS transaction_date""", "offline"),
        "online_fact_csv_layout": fact(f"""transaction_id, units, discount, payment_method, "group",
            total_price, {DATE_KEY} AS date_key, shipping_zip_code, shipping_state, shipping_city,
            shipping_street_name, product_key, customer_key""", "online"),
        "offline_fact_csv_layout": fact(f"""transaction_id, units, discount, payment_method,
            total_price, {DATE_KEY} AS date_key, product_key, s.customer_name, s.customer_email,
            customer_key, branch_key, sales_agent_key""", "offline"),
        "online_fact_slim": f"""WITH {STD}, onl AS (SELECT * FROM std
            WHERE transaction_type = 'online'), d AS (SELECT DISTINCT shipping_street_name,
            shipping_city, shipping_state, shipping_zip_code FROM onl),
            places AS (SELECT *, row_number() OVER (ORDER BY shipping_street_name NULLS FIRST,
            shipping_city NULLS FIRST, shipping_state NULLS FIRST, shipping_zip_code NULLS FIRST)
            AS location_id FROM d)
            SELECT CAST(transaction_date AS VARCHAR) AS transaction_date, transaction_id,
            customer_id, product_id, units, unit_price, discount, payment_method, location_id,
            "group" FROM onl o JOIN places p
            ON o.shipping_street_name IS NOT DISTINCT FROM p.shipping_street_name
            AND o.shipping_city IS NOT DISTINCT FROM p.shipping_city
            AND o.shipping_state IS NOT DISTINCT FROM p.shipping_state
            AND o.shipping_zip_code IS NOT DISTINCT FROM p.shipping_zip_code""",
        "offline_fact_slim": f"""WITH {STD} SELECT transaction_id,
            CAST(transaction_date AS VARCHAR) AS transaction_date, customer_id, sales_agent_id,
            branch_id, product_id, units, unit_price, discount, payment_method, "group"
            FROM std WHERE {OFF}""",
        "fact_losses": f"""WITH {STD}, r AS (SELECT *, year(transaction_date) NOT BETWEEN 1996
            AND 1999 AS no_date FROM std WHERE {OFF})
            SELECT count(*) AS rows_in,
            count(*) FILTER (WHERE NOT (no_date OR branch_id IS NULL OR sales_agent_id IS NULL))
            AS rows_kept,
            count(*) FILTER (WHERE no_date OR branch_id IS NULL OR sales_agent_id IS NULL)
            AS rows_lost, count(*) FILTER (WHERE no_date) AS without_date,
            CAST(0 AS BIGINT) AS without_product_key, CAST(0 AS BIGINT) AS without_customer_key,
            count(*) FILTER (WHERE branch_id IS NULL) AS without_branch_key,
            count(*) FILTER (WHERE sales_agent_id IS NULL) AS without_sales_agent_key FROM r""",
        "skewed_lookup": sales(["sales_agent_key", "units"],
                               f"""s_name AS sales_agent_name, count(*) AS sales,
                               CAST(sum(units) AS BIGINT) AS units, {TOTAL}""",
                               "LEFT JOIN supplier ON s_suppkey = sales_agent_key GROUP BY 1"),
        "pipeline_category_sales": f"""WITH {STD}, onl AS (SELECT * FROM std
            WHERE transaction_type = 'online'), off AS (SELECT * FROM std WHERE {OFF}),
            kept AS (SELECT product_category, total_price FROM (SELECT DISTINCT {_ONLINE_PLAIN}
                FROM onl) WHERE transaction_id IS NOT NULL UNION ALL
                SELECT product_category, total_price FROM (SELECT DISTINCT {_OFFLINE_PLAIN}
                FROM off) WHERE transaction_id IS NOT NULL AND branch_id IS NOT NULL)
            SELECT product_category, {TOTAL} FROM kept GROUP BY 1""",
        "total_monthly_sales": sales(
            ["date_key"], f"CAST(year(d) AS INTEGER) AS year, CAST(month(d) AS INTEGER) AS month, {TOTAL}",
            f"{DATES} GROUP BY 1, 2"),
        "total_product_sales": sales(["product_key"], f"p_name AS product_name, {TOTAL}",
                                     f"{PRODUCT} GROUP BY 1"),
        "total_payment_method_sales": sales(["payment_method"], f"payment_method, {TOTAL}",
                                            "GROUP BY 1"),
        "total_customer_sales": sales(["customer_key"], f"c_custkey AS customer_id, {TOTAL}",
                                      f"{CUSTOMER} GROUP BY 1"),
        "branch_sales": sales(["branch_key"], f"n_nationkey AS branch_id, {TOTAL}",
                              f"{BRANCH} GROUP BY 1", "offline"),
        "agent_sales": sales(["sales_agent_key"], f"s_name AS sales_agent_name, {TOTAL}",
                             "JOIN supplier ON s_suppkey = sales_agent_key GROUP BY 1", "offline"),
        "discount_by_product": channel_means(
            "product_key", "discount", "p_name AS product_name", "average_discount", PRODUCT, 6),
        "discount_by_product_weighted": f"""SELECT p_name AS product_name, average_discount FROM ({
            sales(["product_key", "discount"],
                  f"product_key, {mean_of('discount', 6)} AS average_discount",
                  "GROUP BY product_key")}) {PRODUCT}""",
        "total_sales_trend": sales(["date_key"], f"CAST(d AS VARCHAR) AS datee, {TOTAL}",
                                   f"{DATES} GROUP BY 1"),
        "total_category_sales": sales(["product_key"], f"p_type AS product_category, {TOTAL}",
                                      f"{PRODUCT} GROUP BY 1"),
        "avg_sales_per_customer": channel_means(
            "customer_key", "total_price", "c_name AS customer_name", "average_sales", CUSTOMER, 4),
        "avg_sales_per_customer_weighted": f"""SELECT c_name AS customer_name, average_sales FROM ({
            sales(["customer_key"], f"customer_key, {mean_of('total_price', 4)} AS average_sales",
                  "GROUP BY customer_key")}) {CUSTOMER}""",
        "freq_customers": sales(["customer_key"],
                                "c_name AS customer_name, count(*) AS total_transactions",
                                f"{CUSTOMER} GROUP BY customer_key, c_name"),
        "total_sales_by_state": sales(
            ["transaction_type", "shipping_state", "branch_key"],
            f"""CASE WHEN transaction_type = 'online' THEN shipping_state ELSE n_name END
            AS shipping_state, {TOTAL}""",
            "LEFT JOIN nation ON n_nationkey = branch_key GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10"),
        "clv": sales(["customer_key", "units"], f"""c_name AS customer_name, {TOTAL},
            CAST(sum(units) AS BIGINT) AS total_units""", f"{CUSTOMER} GROUP BY customer_key, c_name"),
        "daily_agent_dump": f"""WITH {STD} SELECT sales_agent_name, product_name,
            CAST(sum(units) AS BIGINT) AS total_sold_units FROM std WHERE {OFF} GROUP BY 1, 2""",
        "event_decode": f"""WITH {messages()} SELECT "eventType", "customerId", "productId",
            strftime(timestamp, '%Y-%m-%d %H:%M:%S') AS timestamp, category, source,
            quantity, "totalAmount", "paymentMethod", "recommendedProductId", algorithm,
            CAST(CAST(timestamp AS DATE) AS VARCHAR) AS date FROM events_""",
        "hourly_sales": window(HOUR, '"productId"',
                               amounts("num_purchases", "total_sales", "avg_sale_value")),
        "category_performance": window(
            HOUR, "category", amounts("num_purchases", "total_sales", "avg_sale_value")
            + ", TRUE AS within_bound"),
        "payment_method_trends": window(
            DAY_S, '"paymentMethod"',
            amounts("num_transactions", "total_amount", "avg_transaction_value")),
        "customer_segmentation": window(
            30 * DAY_S, '"customerId"',
            """count(*) AS purchase_frequency, round(sum("totalAmount"), 4) AS total_spend,
            CASE WHEN count(*) > 10 AND sum("totalAmount") > 1000 THEN 'High Value'
                 WHEN count(*) > 5 AND sum("totalAmount") > 500 THEN 'Medium Value'
                 ELSE 'Low Value' END AS segment"""),
        "product_inventory": window(HOUR, '"productId"',
                                    "CAST(sum(quantity) AS BIGINT) AS quantity_sold"),
        **{name: f"WITH {messages()} {customers_of('day')} UNION ALL {customers_of('month')}"
           for name in ("merged_distinct_customers", "stream_merged_distinct_customers")},
        "latest_event_per_customer": LATEST,
        "stream_hourly_sales": window(
            HOUR, '"productId"', amounts("num_purchases", "total_sales", "avg_sale_value"),
            2 * HOUR),
        "stream_payment_method_trends": window(
            DAY_S, '"paymentMethod"',
            amounts("num_transactions", "total_amount", "avg_transaction_value"), 48 * HOUR),
        "stream_product_inventory": window(
            HOUR, '"productId"', "CAST(sum(quantity) AS BIGINT) AS quantity_sold", 2 * HOUR),
        "stream_event_archive": f"""WITH {messages()} SELECT "eventType",
            CAST(CAST(timestamp AS DATE) AS VARCHAR) AS date, count(*) AS events FROM events_
            GROUP BY 1, 2""",
        "stream_latest_per_customer": LATEST,
        "stream_all_views": stream_counts(),
    }
    top = f"""(SELECT product_key, total_units FROM ({sales(
        ["product_key", "units"], "product_key, CAST(sum(units) AS BIGINT) AS total_units",
        "GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10")})) {PRODUCT}"""
    out["top_products"] = f"SELECT p_name AS product_name, total_units FROM {top}"
    out["top_products_formatted"] = f"""SELECT p_name AS product_name,
        format('{{:,}}.00', total_units) AS total_units FROM {top}"""
    out["monthly_sales"] = f"""WITH m AS ({out['total_monthly_sales']}), g AS (
        SELECT *, lag(total_sales) OVER (ORDER BY year, month) AS prev_month_sales FROM m)
        SELECT *, round((total_sales - prev_month_sales) / prev_month_sales * 100, 2)
        AS growth_rate FROM g"""
    for channel in ("online", "offline"):
        best = sales(["product_key", "units"],
                     """p_partkey AS "ProductID", p_name AS "ProductName",
                     CAST(sum(units) AS BIGINT) AS "TotalUnitsSold",
                     round(sum(total_price), 3) AS "TotalRevenue\"""",
                     f"{PRODUCT} GROUP BY 1, 2", channel)
        out[f"most_selling_products_{channel}"] = best
        out[f"most_redeemed_offers_{channel}"] = sales(
            ["discount"], 'discount AS "Offer", count(*) AS most_redeemed_offers',
            "GROUP BY 1", channel)
        out[f"most_redeemed_offers_per_product_{channel}"] = sales(
            ["product_key", "discount"],
            """p_partkey AS productid, p_name AS productname, discount AS offers,
            count(*) AS most_redeemed_offers_per_product""",
            f"{PRODUCT} WHERE discount > 0 GROUP BY 1, 2, 3", channel)
    out["external_table_best_sellers"] = out["most_selling_products_online"]
    days = "(SELECT DISTINCT d FROM (SELECT CAST(unnest(generate_series(min(o_orderdate), max(o_orderdate), INTERVAL 1 DAY)) AS DATE) AS d FROM orders))"
    out["external_tables"] = " UNION ALL ".join(
        f"SELECT '{name}' AS table_name, count(*) AS rows, count(*) AS with_first_column FROM {source}"
        for name, source in (
            ("branches_dim", "nation"), ("sales_agent_dim", "supplier"), ("product_dim", "part"),
            ("customer_dim", "customer"), ("date_dim", days),
            ("offline_transactions_fact", "lineitem WHERE l_orderkey % 2 <> 0"),
            ("online_transactions_fact", "lineitem WHERE l_orderkey % 2 = 0")))
    out["lowest_sales_cities_online"] = sales(
        ["shipping_city"], f"shipping_city AS city, {TOTAL}",
        "GROUP BY 1 ORDER BY 2, 1 LIMIT 10", "online")
    out["lowest_sales_cities_offline"] = sales(
        ["branch_key"], f"n_name AS city, {TOTAL}",
        f"{BRANCH} GROUP BY 1 ORDER BY 2, 1 LIMIT 10", "offline")
    out["marts_one_scan"] = out["maintained_marts"] = all_marts(out)
    out["registered_views"] = " UNION ALL ".join(
        f"SELECT 'report_{name}' AS view_name, (SELECT count(*) FROM ({out[name]})) AS rows"
        for name in [f"{view}_{channel}" for channel in ("online", "offline") for view in (
            "most_selling_products", "most_redeemed_offers", "most_redeemed_offers_per_product",
            "lowest_sales_cities")])
    return out

"""Retail inputs derived from the order tables at hand.

No retail transactions are available as files, so the tables ``lineitem orders
customer part supplier nation events`` stand in: one order line is one sale.
Even orders are online, odd ones offline; the supplier is the sales agent and
the supplier's nation the branch.

Only the tables that the requested columns need are joined. The expressions are
SQL that DuckDB reads as well, so that a reference query can start from the same
input rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# join name -> (table, columns renamed, condition, joins it needs)
JOINS = {
    "orders": ("orders", {}, "o_orderkey = l_orderkey", ()),
    "part": ("part", {}, "p_partkey = l_partkey", ()),
    "supplier": ("supplier", {}, "s_suppkey = l_suppkey", ()),
    "customer": ("customer", {}, "c_custkey = o_custkey", ("orders",)),
    "c_nation": ("nation", {"n_nationkey": "cn_key", "n_name": "cn_name", "n_regionkey": "cn_region"},
                 "cn_key = c_nationkey", ("customer",)),
    "s_nation": ("nation", {"n_nationkey": "sn_key", "n_name": "sn_name", "n_regionkey": "sn_region"},
                 "sn_key = s_nationkey", ("supplier",)),
    "c_region": ("region", {}, "r_regionkey = cn_region", ("c_nation",)),
}

_ONLINE = "l_orderkey % 2 = 0"
_CENTS = "CAST(round(l_discount * 100) AS INT)"

# Raw merged transaction: column -> (expression, joins). Deliberately dirty.
RAW = {
    "transaction_date": ("CAST(o_orderdate AS DATE)", ("orders",)),
    "transaction_id": ("""CASE WHEN l_partkey % 97 = 13 THEN ' trx '
        WHEN l_linenumber % 3 = 0 THEN concat(' trx-', l_orderkey, '|', l_linenumber)
        WHEN l_linenumber % 3 = 1 THEN concat('TRX', l_orderkey, '-', l_linenumber, ' ')
        ELSE concat('trx-', l_orderkey, l_linenumber) END""", ()),
    "customer_id": ("o_custkey", ("orders",)),
    "customer_fname": ("CASE WHEN c_custkey % 50 = 7 THEN NULL ELSE split_part(c_name, '#', 1) END",
                       ("customer",)),
    "customer_lname": ("split_part(c_name, '#', 2)", ("customer",)),
    "customer_email": ("""CASE c_custkey % 5
        WHEN 0 THEN concat(' c', c_custkey, '@mail.org ')
        WHEN 1 THEN concat('c', c_custkey, '@shop.co.uk')
        WHEN 2 THEN concat('c ', c_custkey, '@mail.comjunk!')
        WHEN 3 THEN concat('noat', c_custkey, '.com')
        ELSE NULL END""", ("customer",)),
    "sales_agent_id": (f"CASE WHEN {_ONLINE} THEN NULL ELSE l_suppkey END", ()),
    "branch_id": (f"CASE WHEN {_ONLINE} THEN NULL ELSE CAST(s_nationkey AS BIGINT) END",
                  ("supplier",)),
    "product_id": ("l_partkey", ()),
    "product_name": ("p_name", ("part",)),
    "product_category": ("p_type", ("part",)),
    "offer_1": (f"CASE WHEN {_CENTS} IN (1, 6) THEN 'True' WHEN {_CENTS} = 9 THEN '' END", ()),
    "offer_2": (f"CASE WHEN {_CENTS} IN (2, 6, 7) THEN 'True' WHEN {_CENTS} = 10 THEN 'promo' END",
                ()),
    "offer_3": (f"CASE WHEN {_CENTS} IN (3, 7) THEN 'True' END", ()),
    "offer_4": (f"CASE WHEN {_CENTS} IN (4, 8) THEN 'True' END", ()),
    "offer_5": (f"CASE WHEN {_CENTS} IN (5, 8) THEN 'True' END", ()),
    "units": ("CAST(l_quantity AS BIGINT)", ()),
    "unit_price": ("CASE WHEN l_linenumber = 3 THEN -p_retailprice ELSE p_retailprice END",
                   ("part",)),
    "is_online": (f"""CASE WHEN l_orderkey % 20 = 19 THEN NULL WHEN l_orderkey % 20 = 17 THEN 'Y'
        WHEN {_ONLINE} THEN 'yes' ELSE 'no' END""", ()),
    "payment_method": ("o_orderpriority", ("orders",)),
    "shipping_address": (f"""CASE WHEN NOT ({_ONLINE}) THEN NULL
        WHEN l_orderkey % 22 = 0 THEN concat('Lot ', l_linenumber, '/', cn_name)
        ELSE concat(l_linenumber, ' Main St/', cn_name, '/',
            CASE cn_key % 6 WHEN 0 THEN 'AZ' WHEN 1 THEN 'CA' WHEN 2 THEN 'DC'
                 WHEN 3 THEN 'Washington' WHEN 4 THEN 'TN' ELSE 'ZZ' END,
            '/', lpad(CAST(c_custkey % 90000 AS STRING), 5, '0')) END""", ("c_nation",)),
    "name": (f"CASE WHEN {_ONLINE} THEN NULL ELSE s_name END", ("supplier",)),
    "hire_date": (f"""CASE WHEN {_ONLINE} THEN NULL
        ELSE DATE '2015-01-01' + CAST(s_suppkey % 3000 AS INT) END""", ("supplier",)),
    "location": (f"CASE WHEN {_ONLINE} THEN NULL ELSE sn_name END", ("s_nation",)),
    "establish_date": (f"""CASE WHEN {_ONLINE} THEN NULL
        ELSE DATE '2000-01-01' + CAST(sn_key * 30 AS INT) END""", ("s_nation",)),
    "class": (f"CASE WHEN {_ONLINE} THEN NULL ELSE substr('ABCD', sn_key % 4 + 1, 1) END",
              ("s_nation",)),
    "group": ("concat('group', l_suppkey % 6 + 1)", ()),
}

# Star schema sale: both facts as one table. The line amount is units x unit price.
SALES = {
    "transaction_type": (f"CASE WHEN {_ONLINE} THEN 'online' ELSE 'offline' END", ()),
    "date_key": ("""CAST(year(o_orderdate) * 10000 + month(o_orderdate) * 100
        + day(o_orderdate) AS BIGINT)""", ("orders",)),
    "product_key": ("l_partkey", ()),
    "customer_key": ("o_custkey", ("orders",)),
    "branch_key": (f"CASE WHEN {_ONLINE} THEN NULL ELSE s_nationkey END", ("supplier",)),
    "sales_agent_key": (f"CASE WHEN {_ONLINE} THEN NULL ELSE l_suppkey END", ()),
    "units": ("CAST(l_quantity AS BIGINT)", ()),
    "discount": ("l_discount", ()),
    "payment_method": ("o_orderpriority", ("orders",)),
    "shipping_state": (f"CASE WHEN {_ONLINE} THEN r_name END", ("c_region",)),
    "shipping_city": (f"CASE WHEN {_ONLINE} THEN cn_name END", ("c_nation",)),
}
AMOUNT = "l_extendedprice * (1 - l_discount)"

# Fields of a CSV line as a careless export writes them, over columns of RAW, and the whole
# line: some have a field too many, some lack the last two.
EXPORT = {
    "units": """CASE WHEN product_id % 11 = 3 THEN concat(units, ' pcs')
        WHEN product_id % 13 = 5 THEN '""' ELSE CAST(units AS STRING) END""",
    "transaction_id": "transaction_id",
    "unit_price": """CASE WHEN product_id % 17 = 2 THEN 'n/a' WHEN product_id % 19 = 6 THEN ''
        ELSE CAST(unit_price AS STRING) END""",
    "transaction_date": """CASE WHEN customer_id % 19 = 4
        THEN concat(substr(CAST(transaction_date AS STRING), 1, 8), '32')
        ELSE CAST(transaction_date AS STRING) END""",
}
EXPORT_COLUMNS = ("units", "transaction_id", "unit_price", "transaction_date", "product_id", "customer_id")
EXPORT_LINE = """CASE WHEN product_id % 23 = 7
    THEN concat(f1, ',', f2, ',', f3, ',', f4, ',surplus')
    WHEN product_id % 29 = 9 THEN concat(f1, ',', f2)
    ELSE concat(f1, ',', f2, ',', f3, ',', f4) END"""
EXPORT_MALFORMED = "product_id % 23 = 7 OR product_id % 29 = 9"

# Event message fields. Sign-ups and errors have no counterpart; they keep their type.
EVENTS = {
    "eventType": """CASE event_type WHEN 'view' THEN 'productView'
        WHEN 'click' THEN 'recommendationClick' ELSE event_type END""",
    "customerId": "CAST(user_id AS STRING)",
    "source": "CASE WHEN event_type = 'view' THEN 'Search' END",
    "category": "CASE WHEN event_type = 'view' THEN concat('Category ', user_id % 4) END",
    "quantity": "CASE WHEN event_type = 'purchase' THEN CAST(event_id % 5 + 1 AS INT) END",
    "totalAmount": "CASE WHEN event_type = 'purchase' THEN value END",
    "paymentMethod": """CASE WHEN event_type = 'purchase' THEN
        CASE user_id % 3 WHEN 0 THEN 'Credit Card' WHEN 1 THEN 'Debit Card'
             ELSE 'PayPal' END END""",
    "algorithm": """CASE WHEN event_type = 'click' THEN
        CASE event_id % 2 WHEN 0 THEN 'content_based' ELSE 'collaborative_filtering' END END""",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def needed_joins(columns: Sequence[str], mapping: dict) -> list[str]:
    """Joins for these columns, prerequisites first."""
    wanted: list[str] = []

    def add(join: str) -> None:
        for before in JOINS[join][3]:
            add(before)
        if join not in wanted:
            wanted.append(join)

    for column in columns:
        for join in mapping[column][1]:
            add(join)
    return wanted


def _lines(
    df: DataFrame, spark: SparkSession, sf_dir: str, joins: Sequence[str], of_customer: Sequence[str] = ()
) -> DataFrame:
    """``df`` with these joins. Customers go to the orders first, of which there are fewer than lines.

    ``of_customer`` are columns of RAW that are computed once per customer instead of once per line.
    """
    def joined(rows: DataFrame, join: str) -> DataFrame:
        name, renamed, condition, _ = JOINS[join]
        other = table(spark, sf_dir, name).withColumnsRenamed(renamed)
        if join == "customer":
            other = other.withColumns({c: F.expr(RAW[c][0]) for c in of_customer})
        if join == "orders":
            other = reduce(joined, [j for j in joins if _of_orders(j)], other)
        return rows.join(other, F.expr(condition))

    return reduce(joined, [j for j in joins if not _of_orders(j)], df)


def _of_orders(join: str) -> bool:
    return any(before == "orders" or _of_orders(before) for before in JOINS[join][3])


def raw_transactions(
    spark: SparkSession, sf_dir: str, columns: Sequence[str] | None = None
) -> DataFrame:
    """Raw merged transactions, all 27 columns or the requested ones."""
    columns = list(columns or RAW)
    joins = needed_joins(columns, RAW)
    # The joins of a line alone come first, while it is narrow: those of its order bring most columns.
    first = [j for j in ("supplier", "part") if j in joins]
    lines = _lines(table(spark, sf_dir, "lineitem"), spark, sf_dir, first)
    # The file may be one row group, which is one task for all that follows; a landing zone is not.
    # Dealt by the key of the join with the orders, which then needs no shuffle of its own; lines of
    # an order lie together afterwards, which whatever is written of them compresses best.
    lines = lines.repartition("l_orderkey")
    # Their expressions name columns of the customers alone.
    of_customer = [c for c in columns if RAW[c][1] == ("customer",)]
    lines = _lines(lines, spark, sf_dir, [j for j in joins if j not in first], of_customer)
    return lines.select(*[c if c in of_customer else F.expr(RAW[c][0]).alias(c) for c in columns])


def careless_export(spark: SparkSession, sf_dir: str, path: str) -> None:
    """Sales as CSV lines with texts that are no numbers or dates, and with lines of other lengths."""
    raw = raw_transactions(spark, sf_dir, EXPORT_COLUMNS)
    fields = raw.select("product_id", *[F.expr(e).alias(f"f{i}") for i, e in enumerate(EXPORT.values(), 1)])
    line = F.expr(EXPORT_LINE).alias(",".join(EXPORT))
    # One column that holds whole lines: a separator and a quote that no line holds.
    fields.select(line).write.options(
        header=True, sep="\u0001", quote="\u0002", escapeQuotes=False, ignoreLeadingWhiteSpace=False,
        ignoreTrailingWhiteSpace=False).csv(path)


def sales(spark: SparkSession, sf_dir: str, *columns: str, channel: str | None = None) -> DataFrame:
    """Star schema sales with the requested columns; ``total_price`` is one of them.

    ``channel`` keeps one channel's rows, which is that channel's fact.
    """
    mapped = [c for c in columns if c != "total_price"]
    lines = table(spark, sf_dir, "lineitem")
    lines = _lines(lines, spark, sf_dir, needed_joins(mapped, SALES))
    if channel:
        online = F.expr(_ONLINE)
        lines = lines.where(online if channel == "online" else ~online)
    exprs = [F.expr(SALES[c][0]).alias(c) for c in mapped]
    if "total_price" in columns:
        exprs.append(F.round(F.expr(AMOUNT), 3).alias("total_price"))
    return lines.select(*exprs)


def product_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").selectExpr(
        "p_partkey AS product_key", "p_partkey AS product_id", "p_name AS product_name",
        "p_type AS product_category", "p_retailprice AS unit_price")


def customer_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").selectExpr(
        "c_custkey AS customer_key", "c_custkey AS customer_id", "c_name AS customer_name")


def branch_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "nation").selectExpr(
        "n_nationkey AS branch_key", "n_nationkey AS branch_id", "n_name AS branch_location")


def sales_agent_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "supplier").selectExpr(
        "s_suppkey AS sales_agent_key", "s_suppkey AS sales_agent_id",
        "s_name AS sales_agent_name")


def event_messages(events: DataFrame) -> DataFrame:
    """The events table, or a stream of it, as JSON message text."""
    time = F.date_format(F.col("ts").cast("timestamp"), "yyyy-MM-dd'T'HH:mm:ss")
    field = {name: F.expr(text).alias(name) for name, text in EVENTS.items()}
    product = F.get_json_object("props", "$.k")
    return events.select(F.to_json(F.struct(
        field["eventType"], field["customerId"], product.alias("productId"),
        time.alias("timestamp"),
        F.struct(field["category"], field["source"]).alias("metadata"),
        field["quantity"], field["totalAmount"], field["paymentMethod"],
        F.when(F.col("event_type") == "click", product).alias("recommendedProductId"),
        field["algorithm"],
    )).alias("value"))


def events_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events table as a file stream."""
    schema = table(spark, sf_dir, "events").schema
    rows = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf_dir)
    return event_messages(rows)

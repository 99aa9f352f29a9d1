"""Declared schemas, as one line of text per group of columns.

Column names and types are fixed values: they are the file and table formats
this package exchanges with the outside.
"""

from __future__ import annotations

from pyspark.sql.types import StructType


def ddl(text: str) -> StructType:
    """Schema from ``name type, name type``; unlike Spark's own, needs no session."""
    schema = StructType()
    for column in text.split(","):
        name, kind = column.split()
        schema = schema.add(name, kind)
    return schema


# Merged hourly drop: transaction columns, then agent and branch columns.
RAW = ddl("""
    transaction_date date, transaction_id string, customer_id long,
    customer_fname string, customer_lname string, customer_email string,
    sales_agent_id long, branch_id long,
    product_id long, product_name string, product_category string,
    offer_1 string, offer_2 string, offer_3 string, offer_4 string, offer_5 string,
    units long, unit_price double, is_online string, payment_method string,
    shipping_address string,
    name string, hire_date date, location string, establish_date date, class string,
    group string
""")

# Older drops carry two more columns: at the end, or (one group) after the address.
_AUDIT = ddl("logs string, source string").fields
RAW_WITH_AUDIT = StructType(RAW.fields + _AUDIT)
_ADDRESS_END = RAW.fieldNames().index("shipping_address") + 1
RAW_AUDIT_INSIDE = StructType(RAW.fields[:_ADDRESS_END] + _AUDIT + RAW.fields[_ADDRESS_END:])

BRANCH_FILE = ddl("branch_id long, location string, establish_date date, class string")
AGENT_FILE = ddl("sales_person_id long, name string, hire_date string")

_COMMON = """
    transaction_date date, transaction_id string, customer_id long,
    customer_name string, customer_email string
"""
_PRODUCT = """
    product_id long, product_name string, product_category string, units long,
    unit_price double, discount double, total_price double, payment_method string
"""
OFFLINE = ddl(f"""{_COMMON}, sales_agent_id long, branch_id long, {_PRODUCT},
    sales_agent_name string, sales_agent_hire_date date, branch_location string,
    branch_establish_date date, branch_class string, group string""")
ONLINE = ddl(f"""{_COMMON}, {_PRODUCT}, shipping_street_name string,
    shipping_city string, shipping_state string, shipping_zip_code string, group string""")

# Column order of the table that holds both channels.
ALL_SALES = [
    "transaction_id", "transaction_date", "transaction_type", "customer_id",
    "customer_name", "customer_email", "product_id", "product_name",
    "product_category", "units", "unit_price", "discount", "payment_method", "group",
    "sales_agent_id", "sales_agent_name", "sales_agent_hire_date", "branch_id",
    "branch_location", "branch_class", "shipping_street_name", "shipping_city",
    "shipping_state", "shipping_zip_code",
]
# The cleaned, not yet split layout differs in one column only.
CLEANED = [c for c in ALL_SALES if c != "transaction_type"]
CLEANED.insert(CLEANED.index("group") + 1, "is_online")

DATE_DIM = ddl("""
    datee date, date_key long, day integer, day_of_week integer, day_of_year integer,
    week_of_year integer, month integer, quarter integer, year integer, is_weekend integer,
    month_name string, day_name string, year_month string
""")
PRODUCT_DIM = ddl("""
    product_id long, product_name string, product_category string,
    unit_price double, product_key long
""")
CUSTOMER_DIM = ddl(
    "customer_id long, customer_name string, customer_email string, customer_key long")
BRANCH_DIM = ddl("""
    branch_id long, branch_location string, branch_establish_date date,
    branch_class string, branch_key long
""")
SALES_AGENT_DIM = ddl("""
    sales_agent_id long, sales_agent_hire_date date, sales_agent_name string,
    sales_agent_key long
""")
LOCATION_DIM = ddl("""
    shipping_street_name string, shipping_city string, shipping_state string,
    shipping_zip_code string, location_id long
""")

ONLINE_FACT = [
    "transaction_id", "customer_key", "product_key", "date_key", "units", "unit_price",
    "discount", "payment_method", "group", "total_price", "shipping_zip_code",
    "shipping_state", "shipping_city", "shipping_street_name",
]
OFFLINE_FACT = [
    "transaction_id", "customer_key", "sales_agent_key", "branch_key", "product_key",
    "date_key", "units", "unit_price", "discount", "payment_method", "total_price",
    "transaction_date",
]
# Layouts of the CSV star schema: no unit price, offline rows keep the customer.
ONLINE_FACT_CSV = [
    "transaction_id", "units", "discount", "payment_method", "group", "total_price",
    "date_key", "shipping_zip_code", "shipping_state", "shipping_city",
    "shipping_street_name", "product_key", "customer_key",
]
OFFLINE_FACT_CSV = [
    "transaction_id", "units", "discount", "payment_method", "total_price", "date_key",
    "product_key", "customer_name", "customer_email", "customer_key", "branch_key",
    "sales_agent_key",
]
# Layouts that keep natural ids; the address is a location id.
ONLINE_SLIM = [
    "transaction_date", "transaction_id", "customer_id", "product_id", "units", "unit_price",
    "discount", "payment_method", "location_id", "group",
]
OFFLINE_SLIM = [
    "transaction_id", "transaction_date", "customer_id", "sales_agent_id", "branch_id",
    "product_id", "units", "unit_price", "discount", "payment_method", "group",
]

EVENT = StructType(
    ddl("eventType string, customerId string, productId string, timestamp timestamp").fields
    + StructType().add("metadata", ddl("category string, source string")).fields
    + ddl("""quantity integer, totalAmount double, paymentMethod string,
             recommendedProductId string, algorithm string""").fields
)

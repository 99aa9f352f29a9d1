"""

Every query reads whole tables of ``sf_dir``. Results are brought to plain
types (text dates, rounded sums) here, so that the library itself returns
unrounded numbers and real dates.
"""

from __future__ import annotations

import os
import shutil
import sys
import tempfile
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import oracles  # noqa: E402
from tillwright.functions import cleaning, measures  # noqa: E402
from tillwright.operators import (  # noqa: E402
    channels, dims, facts, id_index, incremental, keys, lookup, shaping,
)
from tillwright.plans import (  # noqa: E402
    bridge, denormalise, mart_states, marts, merge, model, standardize, views,
)
from tillwright.sources import (  # noqa: E402
    commits, manifest, readers, rejects, schemas, sinks, tables, workspace,
)
from tillwright.streaming import distinct  # noqa: E402
from tillwright.streaming import events as ev  # noqa: E402
from tillwright.streaming import runner  # noqa: E402
from tillwright.streaming import sinks as stream_sinks  # noqa: E402
from tillwright.streaming import views as stream_views  # noqa: E402

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}

RUN_STAMP = "20240712135616"
FIRST_LOAD_BEFORE = "1998-01-01"


def query(fn: Query) -> Query:
    _QUERIES[fn.__name__] = fn
    return fn


def _plain(df: DataFrame, **decimals: int) -> DataFrame:
    """Dates and times as text, the named numbers rounded."""
    out = []
    for field in df.schema.fields:
        c = F.col(f"`{field.name}`")
        kind = field.dataType.typeName()
        if kind == "date":
            c = c.cast("string")
        elif kind.startswith("timestamp"):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss")
        elif field.name in decimals:
            places = decimals[field.name]
            if field.name.startswith(("average_", "avg_")):
                # A mean can lie exactly between two roundings, where float noise
                # would decide; a nudge far above that noise decides it instead.
                c = c + 5 * 10.0 ** -(places + 4)
            c = F.round(c, places)
        out.append(c.alias(field.name))
    return df.select(*out)


def _raw(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    return bridge.raw_transactions(spark, sf_dir, columns)


def _cleaned(spark: SparkSession, sf_dir: str, **options) -> DataFrame:
    return standardize.standardize(bridge.raw_transactions(spark, sf_dir), **options)


def _channels(
    spark: SparkSession, sf_dir: str, stored: bool = False
) -> tuple[DataFrame, DataFrame]:
    """Standardized online and offline rows; ``stored`` writes them once for several uses."""
    cleaned = _cleaned(spark, sf_dir)
    if stored:
        cleaned = workspace.materialize(cleaned, "cleaned")
    return standardize.channel(cleaned, "online"), standardize.channel(cleaned, "offline")


def _raw_layer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All raw rows, stored as the landing zone would hold them."""
    return workspace.materialize(bridge.raw_transactions(spark, sf_dir), "raw")


def _day(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dims.date_dim_for(bridge.table(spark, sf_dir, "orders"), "o_orderdate")


# --- cleaning rules -------------------------------------------------------------


@query
def clean_discount(spark, sf_dir):
    raw = _raw(spark, sf_dir, "transaction_id", *cleaning.OFFERS)
    return raw.select("transaction_id", cleaning.discount().alias("discount"))


@query
def clean_address(spark, sf_dir):
    raw = _raw(spark, sf_dir, "transaction_id", "shipping_address")
    return raw.select("transaction_id", *cleaning.address_parts())


@query
def clean_state(spark, sf_dir):
    raw = _raw(spark, sf_dir, "shipping_address")
    code = F.get(F.split("shipping_address", "/"), F.lit(2))
    return raw.select(code.alias("code"), cleaning.state_name(code).alias("state"))


@query
def clean_email_lenient(spark, sf_dir):
    raw = _raw(spark, sf_dir, "customer_id", "customer_email")
    return raw.select("customer_id", cleaning.email("customer_email").alias("email"))


@query
def clean_email_strict(spark, sf_dir):
    raw = _raw(spark, sf_dir, "customer_id", "customer_email")
    return raw.select("customer_id", cleaning.email("customer_email", "strict").alias("email"))


@query
def clean_email_validate(spark, sf_dir):
    raw = _raw(spark, sf_dir, "customer_id", "customer_email")
    return raw.select("customer_id", cleaning.email("customer_email", "validate").alias("email"))


@query
def clean_trx_id(spark, sf_dir):
    raw = _raw(spark, sf_dir, "transaction_id")
    return raw.select(F.col("transaction_id").alias("raw_id"),
                      cleaning.transaction_id("transaction_id").alias("transaction_id"))


@query
def clean_price(spark, sf_dir):
    raw = _raw(spark, sf_dir, "transaction_id", "unit_price")
    return raw.select("transaction_id", cleaning.unit_price("unit_price").alias("unit_price"))


@query
def customer_full_name(spark, sf_dir):
    raw = _raw(spark, sf_dir, "customer_id", "customer_fname", "customer_lname")
    return raw.select("customer_id", cleaning.full_name(
        "customer_fname", "customer_lname").alias("customer_name"))


@query
def total_price(spark, sf_dir):
    raw = _raw(spark, sf_dir, "transaction_id", "units", "unit_price", *cleaning.OFFERS)
    priced = raw.withColumns({"discount": cleaning.discount(),
                              "unit_price": cleaning.unit_price("unit_price")})
    return priced.select("transaction_id", cleaning.total_price(
        "units", "unit_price", "discount").alias("total_price"))


@query
def cast_dates_and_ids(spark, sf_dir):
    raw = _raw(spark, sf_dir, "transaction_id", "transaction_date", "sales_agent_id", "branch_id")
    text = raw.select(
        "transaction_id", F.col("transaction_date").cast("string").alias("transaction_date"),
        F.concat(F.col("sales_agent_id").cast("string"), F.lit(".0")).alias("sales_agent_id"),
        F.when(F.col("branch_id") == 3, F.lit("x")).otherwise(
            F.col("branch_id").cast("string")).alias("branch_id"))
    return _plain(shaping.cast_ids(shaping.cast_dates(text)))


@query
def drop_blank_columns(spark, sf_dir):
    raw = _raw(spark, sf_dir, "transaction_id", "group", "offer_5", "is_online")
    audited = readers.reconcile(
        raw, readers.text_schema(["transaction_id", "logs", "source", "group", "offer_5"]))
    return shaping.drop_blank_columns(audited)


@query
def rename_columns(spark, sf_dir):
    raw = _raw(spark, sf_dir, "customer_lname", "sales_agent_id", "name", "hire_date",
               "location", "establish_date", "class")
    odd = raw.withColumnsRenamed(
        {"customer_lname": "cusomter_lname", "sales_agent_id": "sales_person_id"})
    return _plain(shaping.rename_business(shaping.repair_headers(odd)))


@query
def row_index(spark, sf_dir):
    indexed = shaping.row_index(_raw(spark, sf_dir, "transaction_id"))
    return indexed.agg(F.count("*").alias("rows"),
                       F.count_distinct("row_index").alias("distinct_indexes"))


@query
def cleaned_layout(spark, sf_dir):
    return _plain(standardize.cleaned_layout(_cleaned(spark, sf_dir)), discount=2)


# --- channels --------------------------------------------------------------------


@query
def channel_tag(spark, sf_dir):
    raw = _raw(spark, sf_dir, "transaction_id", "is_online")
    return raw.select("transaction_id", channels.tag().alias("transaction_type"))


@query
def channel_split(spark, sf_dir):
    parts = channels.split(_raw(spark, sf_dir, "transaction_id", "is_online", "units"))
    return channels.stack(*[
        rows.withColumn("channel", F.lit(name)) for name, rows in parts.items()])


@query
def channel_split_losses(spark, sf_dir):
    losses = channels.split_losses(_raw(spark, sf_dir, "is_online"))
    return losses.select(F.coalesce("is_online", F.lit("null")).alias("is_online"), "dropped_rows")


@query
def standardize_online(spark, sf_dir):
    return _plain(_channels(spark, sf_dir)[0])


@query
def standardize_offline(spark, sf_dir):
    return _plain(_channels(spark, sf_dir)[1])


@query
def standardize_strict_online(spark, sf_dir):
    raw = bridge.raw_transactions(spark, sf_dir)
    return _plain(standardize.standardize_strict(raw)["online"])


@query
def standardize_strict_offline(spark, sf_dir):
    raw = bridge.raw_transactions(spark, sf_dir)
    return _plain(standardize.standardize_strict(raw)["offline"])


@query
def all_sales_union(spark, sf_dir):
    return _plain(channels.all_sales(*_channels(spark, sf_dir), extra=("total_price",)))


# --- merging a drop, file manifests ------------------------------------------------


@query
def enrich_left_joins(spark, sf_dir):
    sold = _raw(spark, sf_dir, "transaction_id", "sales_agent_id", "branch_id", "units")
    agents = bridge.table(spark, sf_dir, "supplier").selectExpr(
        "s_suppkey AS sales_person_id", "s_name AS name",
        "DATE '2015-01-01' + CAST(s_suppkey % 3000 AS INT) AS hire_date")
    branches = bridge.table(spark, sf_dir, "nation").selectExpr(
        "CAST(n_nationkey AS BIGINT) AS branch_id", "n_name AS location")
    return _plain(merge.merge_group(sold, agents, branches, "group1"))


def _manifest(spark, sf_dir):
    """Drop files as a listing would show them: one per order."""
    kind = F.element_at(F.array(*[F.lit(k) for k in manifest.KINDS]),
                        (F.col("o_orderkey") % 3 + 1).cast("int"))
    return bridge.table(spark, sf_dir, "orders").select(
        F.concat(F.lit("/drops/group"), (F.col("o_custkey") % 6 + 1).cast("string"), F.lit("/"),
                 kind, F.lit("_"), F.col("o_orderkey").cast("string"), F.lit(".csv")).alias("path"),
        F.col("o_orderdate").cast("timestamp").alias("modified"))


AS_OF = "2001-07-31 00:00:00"


@query
def complete_drops(spark, sf_dir):
    as_of = F.lit(AS_OF).cast("timestamp")
    return _plain(manifest.complete_drops(_manifest(spark, sf_dir), as_of, "20 days"))


@query
def latest_complete_group(spark, sf_dir):
    as_of = F.lit(AS_OF).cast("timestamp")
    return _plain(manifest.latest_complete_group(_manifest(spark, sf_dir), as_of, "20 days"))


@query
def newest_file(spark, sf_dir):
    return manifest.newest_row(_manifest(spark, sf_dir))


@query
def newest_file_by_prefix(spark, sf_dir):
    return manifest.newest_by_name_row(_manifest(spark, sf_dir), "branches")


@query
def group_numbers(spark, sf_dir):
    files = _manifest(spark, sf_dir)
    return files.groupBy(
        manifest.group_number("path").alias("group_number"),
        manifest.path_part("path", 3).alias("business_group"),
    ).agg(F.count("*").alias("files"))


def _drop_file(df, folder, name):
    """One CSV file of a drop, as another system would put it there; its one task only copies rows."""
    spark = df.sparkSession
    stored = workspace.materialize(df, "drop-rows")
    sinks.write_csv(stored.coalesce(1), f"{folder}/_{name}")
    workspace.drop(stored)
    part = manifest.newest(manifest.listing(spark, f"{folder}/_{name}", "part-*"))
    target = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/{name}.csv")
    files = target.getFileSystem(spark._jsc.hadoopConfiguration())
    files.rename(spark._jvm.org.apache.hadoop.fs.Path(part), target)


@query
def drop_to_standardized(spark, sf_dir):
    """Files of two groups, one of them complete, through the raw layer to a stored table."""
    base = workspace.fresh_path(spark, "drop")
    sold = bridge.raw_transactions(spark, sf_dir).where("`group` = 'group2'").drop(
        "name", "hire_date", "location", "establish_date", "class", "group")
    agents = bridge.table(spark, sf_dir, "supplier").selectExpr(
        "s_suppkey AS sales_person_id", "s_name AS name",
        "DATE '2015-01-01' + CAST(s_suppkey % 3000 AS INT) AS hire_date")
    branches = bridge.table(spark, sf_dir, "nation").selectExpr(
        "n_nationkey AS branch_id", "n_name AS location",
        "DATE '2000-01-01' + CAST(n_nationkey * 30 AS INT) AS establish_date",
        "substr('ABCD', n_nationkey % 4 + 1, 1) AS class")
    _drop_file(branches, f"{base}/drops/group1", "branches_SS_raw_1")
    for name, rows in (("branches", branches), ("sales_agents", agents), ("sales_transactions", sold)):
        _drop_file(rows, f"{base}/drops/group2", f"{name}_SS_raw_2")
    path = merge.land(spark, f"{base}/drops", f"{base}/raw", RUN_STAMP, F.current_timestamp())
    raw = readers.read_csv(spark, path, schemas.RAW)
    paths = standardize.run(raw, f"{base}/standardized", RUN_STAMP)
    return _plain(readers.read_with_sidecar(spark, paths["online"]))


# --- files -----------------------------------------------------------------------


@query
def csv_enforced_schema(spark, sf_dir):
    path = workspace.fresh_path(spark, "raw-csv")
    sinks.write_csv(bridge.raw_transactions(spark, sf_dir), path)
    return _plain(readers.read_csv(spark, f"{path}/*.csv", schemas.RAW))


@query
def csv_without_header(spark, sf_dir):
    path = workspace.fresh_path(spark, "plain-csv")
    raw = _raw(spark, sf_dir, "transaction_id", "units", "unit_price")
    sinks.write_csv(raw, path, header=False)
    return readers.read_csv(spark, path, raw.schema, header=False)


@query
def reconcile_schema(spark, sf_dir):
    path = workspace.fresh_path(spark, "odd-csv")
    odd = _raw(spark, sf_dir, "units", "transaction_id", "transaction_date", "unit_price").select(
        "units", "unit_price", F.lit("kept").alias("remark"), "transaction_date",
        F.trim("transaction_id").alias("transaction_id"))
    sinks.write_csv(odd, path)
    expected = schemas.ddl(
        "transaction_id string, transaction_date date, units long, unit_price double, logs string")
    return _plain(readers.reconcile(readers.read_csv(spark, path), expected, partitions=8))


def _careless_intake(spark, sf_dir):
    path = workspace.fresh_path(spark, "careless-csv")
    bridge.careless_export(spark, sf_dir, path)
    target = workspace.fresh_path(spark, "careless-intake")
    expected = schemas.ddl("transaction_id string, units long, unit_price double, transaction_date date")
    return target, rejects.intake(spark, path, expected, target)


@query
def rejected_values(spark, sf_dir):
    """Every text that does not fit its column, and every line of another length."""
    target, _ = _careless_intake(spark, sf_dir)
    return rejects.ledger(spark, target, ["transaction_id"]).drop(rejects.FILE)


@query
def rejected_counts(spark, sf_dir):
    """The counts taken while the rows were written."""
    _, got = _careless_intake(spark, sf_dir)
    counts = {"rows_in": got.rows_in, "malformed": got.malformed, **got.rejected}
    return spark.createDataFrame(list(counts.items()), "counted string, rows long")


@query
def accepted_rows(spark, sf_dir):
    target, _ = _careless_intake(spark, sf_dir)
    return _plain(rejects.accepted(spark, target))


@query
def json_by_extension(spark, sf_dir):
    path = workspace.fresh_path(spark, "drop") + ".json"
    raw = _raw(spark, sf_dir, "transaction_id", "units", "unit_price", "payment_method")
    raw.write.json(path)
    return readers.read_any(spark, path, raw.schema,
                            strategy=lambda df: df.withColumn(
                                "unit_price", cleaning.unit_price("unit_price")))


@query
def merge_schema_scan(spark, sf_dir):
    path = workspace.fresh_path(spark, "grown")
    raw = _raw(spark, sf_dir, "transaction_id", "units", "group")
    raw.where("`group` <= 'group3'").drop("group").write.parquet(f"{path}/day=1")
    raw.where("`group` > 'group3'").write.parquet(f"{path}/day=2")
    return readers.read_parquet(spark, path, merge_schema=True)


@query
def standardized_store(spark, sf_dir):
    base = workspace.fresh_path(spark, "standardized")
    paths = standardize.run(
        _raw_layer(spark, sf_dir), base, RUN_STAMP, "group1", grain="month")
    return _plain(readers.read_with_sidecar(spark, paths["online"]))


@query
def external_table_best_sellers(spark, sf_dir):
    path = workspace.fresh_path(spark, "star-csv")
    fact = bridge.sales(spark, sf_dir, "product_key", "units", "total_price", channel="online")
    products = bridge.product_dim(spark, sf_dir)
    sinks.write_csv(fact, f"{path}/fact")
    sinks.write_csv(products, f"{path}/product")
    database = "retail_" + path.rsplit("-", 1)[-1]
    tables.create_external(spark, database, {
        "online_transactions_fact": (fact.schema, f"{path}/fact"),
        "product_dim": (products.schema, f"{path}/product"),
    }, location=f"{path}/database")
    return _plain(views.most_selling_products(
        spark.table(f"{database}.online_transactions_fact"),
        spark.table(f"{database}.product_dim")), TotalRevenue=3)


@query
def external_tables(spark, sf_dir):
    """All seven star tables as external tables over CSV files, counted by name."""
    path = workspace.fresh_path(spark, "star-tables")
    common = ["product_key", "customer_key", "date_key", "units", "discount", "total_price",
              "payment_method"]
    star = {
        "branches_dim": bridge.branch_dim(spark, sf_dir),
        "sales_agent_dim": bridge.sales_agent_dim(spark, sf_dir),
        "product_dim": bridge.product_dim(spark, sf_dir),
        "customer_dim": bridge.customer_dim(spark, sf_dir),
        "date_dim": _day(spark, sf_dir),
        "offline_transactions_fact": bridge.sales(
            spark, sf_dir, *common, "branch_key", "sales_agent_key", channel="offline"),
        "online_transactions_fact": bridge.sales(
            spark, sf_dir, *common, "shipping_state", "shipping_city", channel="online"),
    }
    for name, rows in star.items():
        sinks.write_csv(rows, f"{path}/{name}")
    database = "star_" + path.rsplit("-", 1)[-1]
    tables.create_external(
        spark, database, {name: (rows.schema, f"{path}/{name}") for name, rows in star.items()},
        location=f"{path}/database")
    return channels.stack(*[
        spark.table(f"{database}.{name}").agg(
            F.lit(name).alias("table_name"), F.count("*").alias("rows"),
            F.count(F.col(rows.columns[0])).alias("with_first_column"))
        for name, rows in star.items()])


# --- incremental loading -----------------------------------------------------------


def _two_loads(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """An early load and a later one that repeats it."""
    return rows.where(F.col("transaction_date") < FIRST_LOAD_BEFORE), rows


@query
def incremental_new_rows(spark, sf_dir):
    first, second = _two_loads(_channels(spark, sf_dir)[0])
    return _plain(incremental.new_rows(second, first, "transaction_id"))


@query
def quarantined_rows(spark, sf_dir):
    cleaned = _cleaned(spark, sf_dir)
    return incremental.quarantined(cleaned, "transaction_id").groupBy("transaction_type").agg(
        F.count("*").alias("rows"))


@query
def merge_dedup(spark, sf_dir):
    first, second = _two_loads(_channels(spark, sf_dir, stored=True)[0])
    return _plain(incremental.merge_distinct(first, second))


@query
def denormalised_append(spark, sf_dir):
    base = workspace.fresh_path(spark, "denormalised")
    online, offline = _channels(spark, sf_dir, stored=True)
    online_loads, offline_loads = _two_loads(online), _two_loads(offline)
    denormalise.load(online_loads[0], offline_loads[0], base, "month")
    denormalise.load(online_loads[1], offline_loads[1], base, "month")
    # The same rows a second time add nothing.
    denormalise.load(online_loads[1], offline_loads[1], base, "month")
    workspace.drop(online)
    return _plain(shaping.in_order(denormalise.stored(spark, base)["all"], schemas.ALL_SALES))


@query
def load_balance(spark, sf_dir):
    """Where the rows of a second load go: stored, known before, or set aside."""
    base = workspace.fresh_path(spark, "balance")
    online, offline = _channels(spark, sf_dir, stored=True)
    early = [_two_loads(rows)[0] for rows in (online, offline)]
    denormalise.load(*early, base)
    loads = denormalise.load(online, offline, base)
    workspace.drop(online)
    return spark.createDataFrame(
        [(name, x.rows_in, x.stored, x.known, x.set_aside) for name, x in loads.items()],
        "channel string, rows_in long, stored long, known long, set_aside long")


class _Ends(commits.Log):
    """A log whose loads end after some tables are written, as a lost driver would end them."""

    def __init__(self, spark, base, writes):
        super().__init__(spark, base)
        self.writes = writes

    def begin(self, load):
        work, real = commits.Load(self, load), commits.Load.write

        def write(*args, **how):
            if len(work.tables) >= self.writes:
                raise InterruptedError
            return real(work, *args, **how)
        work.write = write
        return work


@query
def interrupted_load(spark, sf_dir):
    """All sales after loads that ended halfway and before their last table, each repeated."""
    base = workspace.fresh_path(spark, "interrupted")
    online, offline = _channels(spark, sf_dir, stored=True)
    for batches in zip(_two_loads(online), _two_loads(offline)):
        for writes in (3, 6):
            try:
                denormalise.load(*batches, base, "month", log=_Ends(spark, base, writes))
            except InterruptedError:
                continue
            raise AssertionError("the load was to end early")
        denormalise.load(*batches, base, "month")
        commits.Log(spark, base).sweep()
    workspace.drop(online)
    return _plain(shaping.in_order(denormalise.stored(spark, base)["all"], schemas.ALL_SALES))


@query
def replaced_load(spark, sf_dir):
    """Rows per table after a load was repeated under its id with half of its rows."""
    base = workspace.fresh_path(spark, "replaced")
    batches = _channels(spark, sf_dir, stored=True)
    denormalise.load(*batches, base, "month", "day 1")
    half = [rows.where(F.col("units") <= 25) for rows in batches]
    denormalise.load(*half, base, "month", "day 1")
    workspace.drop(batches[0])
    log = commits.Log(spark, base)
    names = {**denormalise.TABLES, **{f"{c}{suffix}": denormalise.TABLES[c] + suffix
             for c in ("online", "offline") for suffix in (denormalise.ASIDE,)}}
    return spark.createDataFrame(
        [(name, commits.rows_of(log.read(path))) for name, path in sorted(names.items())],
        "table_name string, rows long")


@query
def id_index_known(spark, sf_dir):
    """Ids of a later load that the bitmap index of an early one holds."""
    online = shaping.in_order(_channels(spark, sf_dir)[0], ["transaction_id", "transaction_date"])
    first, second = _two_loads(workspace.materialize(online, "online-ids"))
    index = workspace.materialize(id_index.entries(first, "transaction_id"), "ids")
    asked = second.select("transaction_id").distinct()
    return id_index.among(asked, index, "transaction_id")


# --- dimensions ----------------------------------------------------------------------


@query
def date_dim(spark, sf_dir):
    return _plain(_day(spark, sf_dir))


def _keyed(spark, sf_dir, name):
    online, offline = _channels(spark, sf_dir)
    source = channels.all_sales(online, offline) if name in ("product", "customer") else offline
    rows = getattr(dims, name)(source)
    return _plain(keys.assign_keys(rows, *model.KEYS[name]))


@query
def product_dim(spark, sf_dir):
    return _keyed(spark, sf_dir, "product")


@query
def customer_dim(spark, sf_dir):
    return _keyed(spark, sf_dir, "customer")


@query
def branch_dim(spark, sf_dir):
    return _keyed(spark, sf_dir, "branch")


@query
def sales_agent_dim(spark, sf_dir):
    return _keyed(spark, sf_dir, "sales_agent")


@query
def product_dim_distinct(spark, sf_dir):
    rows = dims.distinct_rows(_cleaned(spark, sf_dir, fix_price=False), dims.PRODUCT)
    return keys.assign_keys(rows, "product_key", "product_id", order=dims.PRODUCT)


@query
def location_dim(spark, sf_dir):
    rows = dims.location(_channels(spark, sf_dir)[0])
    return keys.assign_keys(rows, "location_id", "shipping_street_name", order=dims.LOCATION)


@query
def reference_values(spark, sf_dir):
    return dims.single_value_lists(_cleaned(spark, sf_dir))


@query
def shipping_locations(spark, sf_dir):
    return dims.value_list(_cleaned(spark, sf_dir), "shipping_locations")


@query
def category_products(spark, sf_dir):
    return dims.value_list(_cleaned(spark, sf_dir), "category_products")


@query
def stable_keys(spark, sf_dir):
    customers = _cleaned(spark, sf_dir).select("transaction_date", *dims.CUSTOMER)
    first, second = _two_loads(customers)
    stored = keys.assign_keys(dims.customer(first), "customer_key", "customer_id")
    return keys.assign_keys(
        dims.customer(second), "customer_key", "customer_id", stored=stored
    ).select("customer_id", "customer_key")


# --- facts -----------------------------------------------------------------------------


def _star(spark, sf_dir, channel, layout=()):
    """Standardized rows of a channel and the dimensions its fact needs.

    Read several times, so stored once: the columns of the dimensions and of the fact's ``layout``.
    Every file holds one channel.
    """
    sales = channels.all_sales(
        *_channels(spark, sf_dir), extra=("branch_establish_date", "total_price"))
    used = {"transaction_date", "transaction_type", *dims.PRODUCT, *dims.CUSTOMER, *dims.BRANCH,
            *dims.SALES_AGENT, *layout}
    sales = workspace.materialize(shaping.in_order(sales, [c for c in sales.columns if c in used]), "sales")
    rows = {name: sales.where(F.col("transaction_type") == name) for name in ("online", "offline")}
    names = ("product", "customer") if channel == "online" else tuple(model.KEYS)
    out = model.keyed_dimensions(sales, rows["offline"], names)
    out["date"] = _day(spark, sf_dir)
    return rows[channel], out


@query
def online_fact(spark, sf_dir):
    online, star = _star(spark, sf_dir, "online", schemas.ONLINE_FACT)
    return _plain(facts.online(online, star))


@query
def offline_fact(spark, sf_dir):
    offline, star = _star(spark, sf_dir, "offline", schemas.OFFLINE_FACT)
    return _plain(facts.offline(offline, star))


@query
def online_fact_csv_layout(spark, sf_dir):
    online, star = _star(spark, sf_dir, "online", schemas.ONLINE_FACT_CSV)
    return _plain(facts.online(online, star, csv=True))


@query
def offline_fact_csv_layout(spark, sf_dir):
    offline, star = _star(spark, sf_dir, "offline", schemas.OFFLINE_FACT_CSV)
    return _plain(facts.offline(offline, star, csv=True))


@query
def online_fact_slim(spark, sf_dir):
    online = _channels(spark, sf_dir)[0]
    used = [c for c in online.columns if c in {*schemas.ONLINE_SLIM, *dims.LOCATION}]
    online = workspace.materialize(shaping.in_order(online, used), "online")
    places = keys.assign_keys(
        dims.location(online), "location_id", "shipping_street_name", order=dims.LOCATION)
    return _plain(facts.slim_online(online, places))


@query
def offline_fact_slim(spark, sf_dir):
    return _plain(facts.slim_offline(_channels(spark, sf_dir)[1]))


@query
def fact_losses(spark, sf_dir):
    """Losses under a calendar that covers 1996 to 1999 only."""
    offline, star = _star(spark, sf_dir, "offline")
    star["date"] = dims.date_dim(spark, "1996-01-01", "1999-12-31")
    return facts.losses(offline, star, "offline")


@query
def skewed_lookup(spark, sf_dir):
    """The join for a large dimension, hot keys dealt out."""
    sales = bridge.sales(spark, sf_dir, "sales_agent_key", "units", "total_price")
    agents = bridge.sales_agent_dim(spark, sf_dir)
    joined = lookup.salted(sales, agents, "sales_agent_key", "left",
                           lookup.hot_keys(sales, "sales_agent_key", 0.008))
    return _plain(joined.groupBy("sales_agent_name").agg(
        F.count("*").alias("sales"), F.sum("units").alias("units"),
        F.sum("total_price").alias("total_sales")), total_sales=3)


@query
def pipeline_category_sales(spark, sf_dir):
    """Raw rows to a mart through every stored layer."""
    base = workspace.fresh_path(spark, "layers")
    raw = _raw_layer(spark, sf_dir)
    standardize.run(raw, f"{base}/standardized", RUN_STAMP, "group1", grain="month")
    workspace.drop(raw)
    denormalise.run(spark, f"{base}/standardized", f"{base}/denormalised", grain="month")
    star = model.refresh(spark, f"{base}/normalised", f"{base}/denormalised")
    return _plain(marts.total_category_sales(model.sales(star), star["product"]), total_sales=3)


# --- marts -------------------------------------------------------------------------------


def _sales(spark, sf_dir, *columns):
    return bridge.sales(spark, sf_dir, "transaction_type", *columns)


@query
def total_monthly_sales(spark, sf_dir):
    sales = _sales(spark, sf_dir, "date_key", "total_price")
    return _plain(marts.total_monthly_sales(sales, _day(spark, sf_dir)), total_sales=3)


@query
def total_product_sales(spark, sf_dir):
    sales = _sales(spark, sf_dir, "product_key", "total_price")
    return _plain(marts.total_product_sales(sales, bridge.product_dim(spark, sf_dir)),
                  total_sales=3)


@query
def total_payment_method_sales(spark, sf_dir):
    sales = _sales(spark, sf_dir, "payment_method", "total_price")
    return _plain(marts.total_payment_method_sales(sales), total_sales=3)


@query
def total_customer_sales(spark, sf_dir):
    sales = _sales(spark, sf_dir, "customer_key", "total_price")
    return _plain(marts.total_customer_sales(sales, bridge.customer_dim(spark, sf_dir)),
                  total_sales=3)


@query
def branch_sales(spark, sf_dir):
    sales = _sales(spark, sf_dir, "branch_key", "total_price")
    return _plain(marts.branch_sales(sales, bridge.branch_dim(spark, sf_dir)), total_sales=3)


@query
def agent_sales(spark, sf_dir):
    sales = _sales(spark, sf_dir, "sales_agent_key", "total_price")
    return _plain(marts.agent_sales(sales, bridge.sales_agent_dim(spark, sf_dir)), total_sales=3)


@query
def top_products(spark, sf_dir):
    sales = _sales(spark, sf_dir, "product_key", "units")
    return marts.top_products(sales, bridge.product_dim(spark, sf_dir))


@query
def top_products_formatted(spark, sf_dir):
    return measures.formatted(top_products(spark, sf_dir), total_units=2)


@query
def discount_by_product(spark, sf_dir):
    sales = _sales(spark, sf_dir, "product_key", "discount")
    return _plain(marts.discount_by_product(sales, bridge.product_dim(spark, sf_dir)),
                  average_discount=6)


@query
def discount_by_product_weighted(spark, sf_dir):
    sales = _sales(spark, sf_dir, "product_key", "discount")
    return _plain(marts.discount_by_product(sales, bridge.product_dim(spark, sf_dir), True),
                  average_discount=6)


@query
def total_sales_trend(spark, sf_dir):
    sales = _sales(spark, sf_dir, "date_key", "total_price")
    return _plain(marts.total_sales_trend(sales, _day(spark, sf_dir)), total_sales=3)


@query
def total_category_sales(spark, sf_dir):
    sales = _sales(spark, sf_dir, "product_key", "total_price")
    return _plain(marts.total_category_sales(sales, bridge.product_dim(spark, sf_dir)),
                  total_sales=3)


@query
def avg_sales_per_customer(spark, sf_dir):
    sales = _sales(spark, sf_dir, "customer_key", "total_price")
    return _plain(marts.avg_sales_per_customer(sales, bridge.customer_dim(spark, sf_dir)),
                  average_sales=4)


@query
def avg_sales_per_customer_weighted(spark, sf_dir):
    sales = _sales(spark, sf_dir, "customer_key", "total_price")
    return _plain(marts.avg_sales_per_customer(sales, bridge.customer_dim(spark, sf_dir), True),
                  average_sales=4)


@query
def freq_customers(spark, sf_dir):
    sales = _sales(spark, sf_dir, "customer_key")
    return marts.freq_customers(sales, bridge.customer_dim(spark, sf_dir))


@query
def total_sales_by_state(spark, sf_dir):
    sales = _sales(spark, sf_dir, "shipping_state", "branch_key", "total_price")
    return _plain(marts.total_sales_by_state(sales, bridge.branch_dim(spark, sf_dir)),
                  total_sales=3)


@query
def clv(spark, sf_dir):
    sales = _sales(spark, sf_dir, "customer_key", "total_price", "units")
    return _plain(marts.clv(sales, bridge.customer_dim(spark, sf_dir)), total_sales=3)


@query
def monthly_sales(spark, sf_dir):
    sales = _sales(spark, sf_dir, "date_key", "total_price")
    return _plain(marts.monthly_sales(sales, _day(spark, sf_dir)),
                  total_sales=3, prev_month_sales=3)


def _mart_inputs(spark, sf_dir, channel=None):
    """All columns the marts need; offline sales have no shipping state."""
    return bridge.sales(spark, sf_dir, mart_states.CHANNEL, *mart_states.GRAINS,
                        "total_price", "units", "discount", channel=channel)


def _mart_star(spark, sf_dir):
    return {"date": _day(spark, sf_dir), "product": bridge.product_dim(spark, sf_dir),
            "customer": bridge.customer_dim(spark, sf_dir), "branch": bridge.branch_dim(spark, sf_dir),
            "sales_agent": bridge.sales_agent_dim(spark, sf_dir)}


def _one_layout(found: dict[str, DataFrame]) -> DataFrame:
    """The rows of all marts, names as text and numbers rounded as in the single queries."""
    decimals = {"total_sales": 3, "prev_month_sales": 3, "average_discount": 6, "average_sales": 4}
    out = []
    for name, (labels, values) in oracles.MART_COLUMNS.items():
        places = {c: decimals[c] for c in values if c in decimals}
        rows = _plain(found[name], **places)
        numbers = [F.col(c).cast("double") for c in values] + [F.lit(None).cast("double")] * (3 - len(values))
        out.append(rows.select(
            F.lit(name).alias("mart"),
            F.concat(*[F.concat(F.lit("/" if i else ""), F.col(c)) for i, c in enumerate(labels)]).alias("label"),
            *[n.alias(c) for n, c in zip(numbers, ("first_value", "second_value", "third_value"))]))
    return channels.stack(*out)


@query
def marts_one_scan(spark, sf_dir):
    """The fifteen marts from states that one scan of the sales wrote."""
    stored = workspace.materialize(mart_states.states(_mart_inputs(spark, sf_dir)), "mart-states")
    return _one_layout(mart_states.build(stored, _mart_star(spark, sf_dir)))


@query
def maintained_marts(spark, sf_dir):
    """The same after three loads of facts, the second one wrong at first and then replaced."""
    base = workspace.fresh_path(spark, "maintained")
    star, log = f"{base}/star", commits.Log(spark, f"{base}/star")
    third = F.col("date_key") % 3
    sales = workspace.materialize(_mart_inputs(spark, sf_dir), "mart-inputs")
    for load, part in (("a", third == 0), ("b", third < 2), ("b", third == 1), ("c", third == 2)):
        work = log.begin(load)
        for channel in ("online", "offline"):
            fact = sales.where((F.col(mart_states.CHANNEL) == channel) & part).drop(mart_states.CHANNEL)
            work.write(model.fact_path(channel), fact)
        work.commit()
        mart_states.refresh(spark, f"{base}/marts", star)
    stored = workspace.materialize(mart_states.refresh(spark, f"{base}/marts", star), "mart-states")
    return _one_layout(mart_states.build(stored, _mart_star(spark, sf_dir)))


# --- views ---------------------------------------------------------------------------------


def _fact(spark, sf_dir, channel, *columns):
    return bridge.sales(spark, sf_dir, *columns, channel=channel)


@query
def most_selling_products_online(spark, sf_dir):
    fact = _fact(spark, sf_dir, "online", "product_key", "units", "total_price")
    return _plain(views.most_selling_products(fact, bridge.product_dim(spark, sf_dir)),
                  TotalRevenue=3)


@query
def most_selling_products_offline(spark, sf_dir):
    fact = _fact(spark, sf_dir, "offline", "product_key", "units", "total_price")
    return _plain(views.most_selling_products(fact, bridge.product_dim(spark, sf_dir)),
                  TotalRevenue=3)


@query
def most_redeemed_offers_online(spark, sf_dir):
    return views.most_redeemed_offers(_fact(spark, sf_dir, "online", "discount"))


@query
def most_redeemed_offers_offline(spark, sf_dir):
    return views.most_redeemed_offers(_fact(spark, sf_dir, "offline", "discount"))


@query
def most_redeemed_offers_per_product_online(spark, sf_dir):
    return views.most_redeemed_offers_per_product(
        _fact(spark, sf_dir, "online", "product_key", "discount"),
        bridge.product_dim(spark, sf_dir))


@query
def most_redeemed_offers_per_product_offline(spark, sf_dir):
    return views.most_redeemed_offers_per_product(
        _fact(spark, sf_dir, "offline", "product_key", "discount"),
        bridge.product_dim(spark, sf_dir))


@query
def lowest_sales_cities_online(spark, sf_dir):
    fact = _fact(spark, sf_dir, "online", "shipping_city", "total_price")
    return _plain(views.lowest_sales_cities_online(fact), total_sales=3)


@query
def lowest_sales_cities_offline(spark, sf_dir):
    fact = _fact(spark, sf_dir, "offline", "branch_key", "total_price")
    return _plain(views.lowest_sales_cities_offline(fact, bridge.branch_dim(spark, sf_dir)),
                  total_sales=3)


@query
def registered_views(spark, sf_dir):
    """The eight views by their names in the session."""
    columns = ["product_key", "units", "discount", "total_price"]
    names = views.register(
        _fact(spark, sf_dir, "online", *columns, "shipping_city"),
        _fact(spark, sf_dir, "offline", *columns, "branch_key"),
        bridge.product_dim(spark, sf_dir), bridge.branch_dim(spark, sf_dir), prefix="report_")
    return channels.stack(*[
        spark.table(name).agg(F.lit(name).alias("view_name"), F.count("*").alias("rows"))
        for name in names])


@query
def daily_agent_dump(spark, sf_dir):
    _, offline = _channels(spark, sf_dir)
    path = workspace.fresh_path(spark, "agent-dump")
    report = views.daily_agent_dump(offline)
    sinks.write_report(report, path, "sales_agent_name", "product_name", single=True)
    return readers.read_csv(spark, path, report.schema)


# --- events ----------------------------------------------------------------------------------


def _events(spark, sf_dir):
    return ev.decode(bridge.event_messages(bridge.table(spark, sf_dir, "events")))


def _flat_events(events):
    return _plain(events.select(
        "eventType", "customerId", "productId", "timestamp",
        F.col("metadata.category").alias("category"), F.col("metadata.source").alias("source"),
        "quantity", "totalAmount",
        "paymentMethod", "recommendedProductId", "algorithm", "date"))


@query
def event_decode(spark, sf_dir):
    return _flat_events(_events(spark, sf_dir))


@query
def hourly_sales(spark, sf_dir):
    return _plain(stream_views.hourly_sales(_events(spark, sf_dir)),
                  total_sales=4, avg_sale_value=6)


@query
def category_performance(spark, sf_dir):
    """The view, its approximate customer count held against the exact one."""
    events = _events(spark, sf_dir)
    view = stream_views.category_performance(events)
    exact = events.where("eventType = 'purchase'").groupBy(
        F.col("metadata.category").alias("category"), F.window("timestamp", "1 hour")
    ).agg(F.count_distinct("customerId").alias("exact")).select(
        "category", F.col("window.start").alias("window_start"), "exact")
    checked = view.alias("v").join(
        exact.alias("e"), F.col("v.category").eqNullSafe(F.col("e.category"))
        & (F.col("v.window_start") == F.col("e.window_start"))
    ).select("v.*", (F.abs(F.col("unique_customers") - F.col("exact"))
                     <= F.greatest(F.lit(1.0), F.col("exact") * 0.15)).alias("within_bound"))
    return _plain(checked.drop("unique_customers"), total_sales=4, avg_sale_value=6)


@query
def payment_method_trends(spark, sf_dir):
    return _plain(stream_views.payment_method_trends(_events(spark, sf_dir)),
                  total_amount=4, avg_transaction_value=6)


@query
def customer_segmentation(spark, sf_dir):
    return _plain(stream_views.customer_segmentation(_events(spark, sf_dir)), total_spend=4)


@query
def product_inventory(spark, sf_dir):
    return _plain(stream_views.product_inventory(_events(spark, sf_dir)))


@query
def latest_event_per_customer(spark, sf_dir):
    return _flat_events(stream_sinks.newest_per_customer(_events(spark, sf_dir)))


def _stream(spark, sf_dir):
    return ev.decode(bridge.events_stream(runner.state_session(spark), sf_dir))


def _drained(spark, sf_dir, name):
    """Run one view as a stream over the events file; what it has emitted at the end."""
    base = workspace.fresh_path(spark, f"stream-{name}")
    view = stream_views.VIEWS[name](_stream(spark, sf_dir))
    stream_sinks.write_view(view, f"{base}/out", f"{base}/checkpoint",
                            stream_sinks.DRAIN).awaitTermination()
    return spark.read.schema(view.schema).parquet(f"{base}/out")


@query
def stream_hourly_sales(spark, sf_dir):
    return _plain(_drained(spark, sf_dir, "hourly_sales"), total_sales=4, avg_sale_value=6)


@query
def stream_payment_method_trends(spark, sf_dir):
    return _plain(_drained(spark, sf_dir, "payment_method_trends"),
                  total_amount=4, avg_transaction_value=6)


@query
def stream_product_inventory(spark, sf_dir):
    return _plain(_drained(spark, sf_dir, "product_inventory"))


@query
def stream_event_archive(spark, sf_dir):
    base = workspace.fresh_path(spark, "stream-archive")
    stream_sinks.archive(_stream(spark, sf_dir), f"{base}/out", f"{base}/checkpoint",
                         stream_sinks.DRAIN).awaitTermination()
    archived = spark.read.parquet(f"{base}/out")
    return archived.groupBy("eventType", F.col("date").cast("string").alias("date")).agg(
        F.count("*").alias("events"))


@query
def stream_latest_per_customer(spark, sf_dir):
    base = workspace.fresh_path(spark, "stream-latest")
    stream_sinks.write_latest(_stream(spark, sf_dir), f"{base}/out", f"{base}/checkpoint",
                              stream_sinks.DRAIN).awaitTermination()
    return _flat_events(stream_sinks.latest_snapshot(spark, f"{base}/out"))


@query
def stream_all_views(spark, sf_dir):
    """Archive and all five views side by side; rows each has written at the end."""
    base = workspace.fresh_path(spark, "stream-all")
    events = _stream(spark, sf_dir)
    runner.wait_all(events.sparkSession, runner.start_all(events, base, drain=True))
    counts = [spark.read.schema(events.schema).parquet(f"{base}/archive").agg(
        F.lit("archive").alias("sink"), F.count("*").alias("rows"))]
    for name, view in stream_views.VIEWS.items():
        rows = spark.read.schema(view(events).schema).parquet(f"{base}/{name}")
        counts.append(rows.agg(F.lit(name).alias("sink"), F.count("*").alias("rows")))
    return channels.stack(*counts)


def _customers_of_periods(events, sketches):
    """Merged estimates of days and months held against exact counts."""
    parts = []
    for unit in ("day", "month"):
        exact = events.where("customerId IS NOT NULL").groupBy(
            "eventType", "category", F.date_trunc(unit, "timestamp").alias("period")).agg(
            F.count("*").alias("events"), F.count_distinct("customerId").alias("customers"))
        merged = distinct.merge(sketches, unit).select(
            F.col("eventType").alias("t"), F.col("category").alias("c"), F.col("period").alias("p"),
            F.col("events").alias("n"), distinct.estimate().alias("estimate"))
        both = exact.join(merged, F.col("eventType").eqNullSafe(F.col("t"))
                          & F.col("category").eqNullSafe(F.col("c")) & (F.col("period") == F.col("p")), "full")
        parts.append(both.select(
            F.lit(unit).alias("unit"), "eventType", "category", "period", F.col("n").alias("events"), "customers",
            distinct.within_error("estimate", "customers").alias("within_error")))
    return _plain(channels.stack(*parts))


def _categorised(events):
    return events.withColumn("category", F.col("metadata.category"))


@query
def merged_distinct_customers(spark, sf_dir):
    events = _categorised(_events(spark, sf_dir))
    stored = workspace.materialize(distinct.hourly(events, ["eventType", "category"]), "hour-sketches")
    return _customers_of_periods(events, stored)


@query
def stream_merged_distinct_customers(spark, sf_dir):
    base = workspace.fresh_path(spark, "stream-sketches")
    distinct.write_hours(_categorised(_stream(spark, sf_dir)), ["eventType", "category"], f"{base}/out",
                         f"{base}/checkpoint", stream_sinks.DRAIN).awaitTermination()
    return _customers_of_periods(
        _categorised(_events(spark, sf_dir)), distinct.stored_hours(spark, f"{base}/out"))


# --- contract ------------------------------------------------------------------------------------


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: the best selling products of the online shop."""
    return most_selling_products_online(spark, "/root/testdata/sf0.001")


_shipped_to: set[str] = set()


def _shipped(fn: Query) -> Query:
    """Send the package to the Python workers first, wherever the driver was started."""
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        context = spark.sparkContext
        if context.applicationId not in _shipped_to:
            folder = os.path.realpath(tempfile.mkdtemp())
            root = os.path.dirname(os.path.abspath(__file__))
            context.addPyFile(shutil.make_archive(f"{folder}/tillwright", "zip", root, "tillwright"))
            _shipped_to.add(context.applicationId)
        return fn(spark, sf_dir)
    return run


def _pipeline_parts() -> tuple[dict[str, Query], dict[str, str]]:
    """Queries and SQL of the training-data operators; none where they are not installed."""
    try:
        from tillwright.llm import queries as operators
        import corpus_pipeline
    except ModuleNotFoundError as error:
        if error.name in ("tillwright.llm", "corpus_pipeline"):
            return {}, {}
        raise
    found, sql = dict(operators.QUERIES), dict(operators.ORACLES)
    found["pipeline"] = corpus_pipeline.run
    found = {name: _shipped(fn) for name, fn in found.items()}
    if corpus_pipeline.ORACLE_SQL:
        sql["pipeline"] = corpus_pipeline.ORACLE_SQL
    return found, sql


def queries() -> dict[str, Query]:
    return {**_QUERIES, **_pipeline_parts()[0]}


def oracle_sql() -> dict[str, str]:
    return {**oracles.build(), **_pipeline_parts()[1]}

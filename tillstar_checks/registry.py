"""The registered queries: (session, folder of test tables) -> DataFrame.

Cleaning and rollup queries run on the raw lines derived from the tables. Load, quality and analysis
queries run on a star that the package's own load has written from them: once per session and
folder, under the shared working folder.
"""

import uuid
from datetime import datetime
from functools import cache

from pyspark.sql import functions as F

from tillstar_checks.oracle import EARLY_CUT, FULL_SEED, LATE_SEED
from tillstar.functions import dates
from tillstar.functions.dates import INVOICE_DATE_FORMAT
from tillstar.operators import cleaning, dimensions, facts, keys, lookup, membership, quality, updates
from tillstar.plans import analysis, flat, views
from tillstar.plans.load import load_batch
from tillstar.schemas import MALFORMED_LINE, RAW_COLUMNS, UNFIT
from tillstar.session import shared_folder
from tillstar.sources.csv_source import read_csv, source_profile
from tillstar.sources.sample import raw_sales
from tillstar.sources.warehouse import Star, Warehouse
from tillstar.streaming.incremental import read_parquet_stream, start_load

_loaded = {}


def _stored_raw(spark, folder, varied=False):
    """The raw lines as a table, for queries that load them in several parts."""
    return lookup.written_once(raw_sales(spark, folder, varied))


def new_folder(spark, name):
    return f"{shared_folder(spark)}/tillstar-{uuid.uuid4().hex[:12]}/{name}"


def _warehouse(spark, folder, seed, raw=None):
    """A loaded warehouse, built on first use in a session. raw: its lines, if they are at hand."""
    key = (spark.sparkContext.applicationId, folder, seed)
    if key not in _loaded:
        warehouse = Warehouse(spark, new_folder(spark, "star"))
        warehouse.create(datetime.fromisoformat(seed))
        if raw is None:
            # Rows at or before the mark are a second pass.
            raw = raw_sales(spark, folder) if seed == FULL_SEED else _stored_raw(spark, folder)
        load_batch(raw, warehouse)
        _loaded[key] = warehouse
    return _loaded[key]


def full(spark, folder):
    return _warehouse(spark, folder, FULL_SEED)


def late(spark, folder):
    """Facts above a late mark only: some products and customers have no sales."""
    return _warehouse(spark, folder, LATE_SEED)


def _full_and_raw(spark, folder):
    """The full warehouse and the raw lines, which are derived once for both if it is not loaded yet."""
    if (spark.sparkContext.applicationId, folder, FULL_SEED) in _loaded:
        return full(spark, folder), raw_sales(spark, folder)
    raw = _stored_raw(spark, folder)
    return _warehouse(spark, folder, FULL_SEED, raw), raw


def cleaned_rows(spark, folder):
    """The raw lines after all cleaning rules."""
    return cleaning.clean(raw_sales(spark, folder))


def _timestamp(text):
    return F.lit(text).cast("timestamp_ntz")


def _early(cleaned):
    """What an earlier load would have seen."""
    return cleaned.filter(F.col("InvoiceDate") <= _timestamp(EARLY_CUT))


# -- source and cleaning -------------------------------------------------------------------

CLEANING = [
    ("t2_drop_nulls", cleaning.drop_null_keys),
    ("t3_dedup", cleaning.drop_exact_duplicates),
    ("t4_parse_date", cleaning.parse_invoice_date),
    ("t6_drop_cancelled", cleaning.drop_cancelled),
    ("t7_positive", cleaning.keep_positive),
    ("t8_amount", cleaning.add_amount),
    ("t9_strip", cleaning.strip_text),
    ("t10_customer_int", cleaning.customer_to_integer),
    ("t11_date_parts", cleaning.add_date_parts),
    ("t12_datekey", cleaning.add_date_key),
]


def _cleaned_through(last):
    def query(spark, folder):
        rows = raw_sales(spark, folder)
        for name, step in CLEANING:
            rows = rows.transform(step)
            if name == last:
                return rows

    return query


def csv_scan(spark, folder):
    """The raw lines, written as Latin-1 CSV and read back through the CSV source."""
    path = new_folder(spark, "csv")
    raw_sales(spark, folder).write.options(
        header=True, encoding="ISO-8859-1", quote='"', escape='"',
        ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False,
    ).csv(path)
    return read_csv(spark, path).select(RAW_COLUMNS)


def date_range(spark, folder):
    return cleaning.date_range(_cleaned_through("t4_parse_date")(spark, folder))


# -- dimensions and load -------------------------------------------------------------------


def new_dates(spark, folder):
    cleaned = cleaned_rows(spark, folder)
    return dimensions.insert_if_absent(
        dimensions.date_dimension(cleaned), dimensions.date_dimension(_early(cleaned)), "DateKey"
    )


def new_products(spark, folder):
    cleaned = cleaned_rows(spark, folder)
    return dimensions.insert_if_absent(
        dimensions.first_products(cleaned), dimensions.first_products(_early(cleaned)), "StockCode"
    )


def new_customers(spark, folder):
    cleaned = cleaned_rows(spark, folder)
    return dimensions.insert_if_absent(
        dimensions.customer_rollup(cleaned), dimensions.customer_rollup(_early(cleaned)),
        "CustomerID",
    )


def surrogate_keys(spark, folder):
    star = full(spark, folder).star()
    products = star.products.select(
        F.lit("dim_product").alias("table_name"), F.col("ProductKey").alias("key_value"),
        F.col("StockCode").alias("business_key"),
    )
    customers = star.customers.select(
        F.lit("dim_customer"), "CustomerKey", F.col("CustomerID").cast("string")
    )
    return products.unionAll(customers)


def increment(spark, folder):
    return facts.increment(
        cleaned_rows(spark, folder), datetime.fromisoformat(LATE_SEED)
    )


LOOKED_UP = [
    "InvoiceNo", "StockCode", "CustomerID", "InvoiceDate", "Quantity", "ProductKey", "CustomerKey"
]


def _to_look_up(spark, folder):
    """What the lookups return of the cleaned rows, and what their reasons are told by."""
    return cleaned_rows(spark, folder).select(*LOOKED_UP[:5], "Country", "UnitPrice", "TotalSalesAmount")


def lookups(spark, folder):
    warehouse = full(spark, folder)
    star = warehouse.star()
    return facts.resolve(_to_look_up(spark, folder), star.products, star.customers).select(LOOKED_UP)


def salted_lookups(spark, folder):
    """The same lookups through the path for dimensions too big to broadcast."""
    warehouse = full(spark, folder)
    star = warehouse.star()
    customers = star.customers.select(F.col("CustomerID").cast("bigint"), "CustomerKey")
    rows = lookup.written_once(cleaned_rows(spark, folder).select(LOOKED_UP[:5]))
    keyed = lookup.salted_lookup(rows, star.products.select("StockCode", "ProductKey"), "StockCode")
    return lookup.salted_lookup(keyed, customers, "CustomerID", source=rows).select(LOOKED_UP)


def missing_keys(spark, folder):
    """All rows looked up in the dimensions of an earlier load: those that find no key."""
    cleaned = cleaned_rows(spark, folder)
    early = _early(cleaned)
    products = keys.assign_surrogate_keys(
        dimensions.first_products(early), "StockCode", "ProductKey"
    )
    customers = keys.assign_surrogate_keys(
        dimensions.customer_rollup(early), "CustomerID", "CustomerKey"
    )
    return (
        facts.resolve(cleaned, products, customers)
        .filter(F.col("Reason").isNotNull())
        .select("InvoiceNo", "StockCode", "CustomerID", "InvoiceDate", "Reason")
    )


# Which invoices the stream fixtures deliver twice, and which get a bad line.
TWICE, BAD_LINE = 20, 50

# Prices in a unit a million times smaller: some no longer fit the fact table's decimals.
SMALL_UNITS = 1_000_000


# What the queries of rejects return of each row.
_REJECTED = ["InvoiceNo", "StockCode", "Quantity", "CustomerID"]


def _scaled(cleaned):
    return (
        cleaned.withColumn("UnitPrice", F.col("UnitPrice") * SMALL_UNITS)
        .transform(cleaning.add_amount)
    )


def rejects(spark, folder):
    warehouse, raw = _full_and_raw(spark, folder)
    star = warehouse.star()
    # Whether a row fits is told before the lookups, which then carry no price, amount and country.
    rows = facts.with_unfit(_scaled(cleaning.clean(raw))).select(*_REJECTED, UNFIT)
    resolved = facts.resolve(rows, star.products, star.customers)
    return facts.as_rejects(resolved, "fact_sales").select("TargetTable", "Reason", *_REJECTED)


def fact_sales(warehouse):
    """Facts with business keys in place of surrogate keys."""
    star = warehouse.star()
    return (
        # Customers first: an invoice's lines lie together and stay so in that shuffle, which compresses them.
        star.fact.join(star.customers.select("CustomerKey", "CustomerID"), "CustomerKey")
        .join(star.products.select("ProductKey", "StockCode"), "ProductKey")
        .select(
            "InvoiceNo", "DateKey", "StockCode", "CustomerID", "Quantity", "UnitPrice",
            "TotalSalesAmount", "Country",
        )
    )


def rerun_adds_nothing(spark, folder):
    warehouse = late(spark, folder)
    before = warehouse.state().load_id
    load_batch(_stored_raw(spark, folder), warehouse)
    parts = []
    for table in ["dim_date", "dim_product", "dim_customer", "fact_sales"]:
        old = warehouse.read(table, before).agg(F.count(F.lit(1)).alias("rows_before"))
        new = warehouse.read_load(table, before + 1).agg(F.count(F.lit(1)).alias("rows_added"))
        both = old.unionByName(new, allowMissingColumns=True).agg(
            F.lit(table).alias("table_name"),
            F.max("rows_before").alias("rows_before"),
            F.max("rows_added").alias("rows_added"),
        )
        parts.append(both)
    result = parts[0]
    for part in parts[1:]:
        result = result.unionAll(part)
    return result


# -- quality -------------------------------------------------------------------------------


def _tables(warehouse):
    return {**quality.star_tables(warehouse.star()), "watermark": warehouse.watermark()}


def orphans_of_early_dims(spark, folder):
    warehouse = full(spark, folder)
    early = dimensions.first_products(_early(cleaned_rows(spark, folder)))
    return quality.orphans(fact_sales(warehouse), early, "StockCode")


def dirty(spark, folder):
    """The full star with every rule broken somewhere."""
    star = full(spark, folder).star()
    rest = F.col("InvoiceNo").cast("int") % 100

    def planted(column, broken):
        value = F.col(column)
        for number, wrong in broken.items():
            value = F.when(rest == number, F.lit(wrong)).otherwise(value)
        return value.cast(star.fact.schema[column].dataType).alias(column)

    broken = {
        "ProductKey": {1: None, 2: -1}, "CustomerKey": {3: -1}, "DateKey": {4: 19000101},
        "Quantity": {5: 0}, "UnitPrice": {6: 0}, "TotalSalesAmount": {7: -1},
        "InvoiceNo": {8: "9" * 21, 9: None}, "Country": {10: "x" * 101},
    }
    fact = star.fact.unionAll(star.fact.filter(rest == 0))
    fact = fact.select(*[planted(c, broken.get(c, {})) for c in star.fact.columns])
    long_text = F.when(F.col("StockCode").endswith("77"), F.lit("d" * 256)).otherwise(F.col("Description"))
    products = star.products.unionAll(star.products.filter(F.col("StockCode").endswith("55")))
    customers = star.customers.unionAll(star.customers.filter("CustomerID % 100 = 0"))
    dates = star.dates.unionAll(star.dates.filter("Day = 31"))
    month = F.when(F.col("Day") != 30, F.col("MonthName"))
    return Star(
        fact, dates.withColumn("MonthName", month), products.withColumn("Description", long_text), customers
    )


# -- extensions ----------------------------------------------------------------------------

SLICES = 4


def _order_number(rows):
    """The number in an invoice's number."""
    return F.replace("InvoiceNo", F.lit("C"), F.lit("")).cast("int")


def _streamed(spark, folder, varied=False, **options):
    """A warehouse loaded by a stream of four slices, each of which spans all dates, so that most
    rows arrive after later ones; some invoices come in two slices."""
    root = new_folder(spark, "stream")
    landing = f"{root}/landing"
    raw = _stored_raw(spark, folder, varied)
    number = _order_number(raw)
    warehouse = Warehouse(spark, f"{root}/star").create()
    for i in reversed(range(SLICES)):
        inside = number % SLICES == i
        if i == SLICES - 1:
            inside |= number % TWICE == 0
        # The lines as they lie, without a shuffle; the stream goes on where it was, with what is new.
        raw.filter(inside).write.mode("append").option("compression", "zstd").parquet(landing)
        start_load(read_parquet_stream(spark, landing), warehouse, **options).awaitTermination()
    return warehouse


def stream_load(spark, folder):
    return fact_sales(_streamed(spark, folder))


def membership_index(spark, folder):
    """What the index of a warehouse with a third of the orders says of all rows, by month: how many
    rows there are, how many are loaded, and how many of these the index has missed."""
    warehouse = Warehouse(spark, new_folder(spark, "indexed")).create()
    raw = _stored_raw(spark, folder)
    for i in (0, 3):
        load_batch(raw.filter(_order_number(raw) % 6 == i), warehouse, use_mark=False)
    rows = cleaning.classify(raw, None).filter((F.col("RowStatus") == cleaning.KEPT) & F.col("InvoiceDate").isNotNull())
    rows = warehouse.write_working("rows", rows)
    fact = warehouse.read("fact_sales")
    months = facts.months_of(rows)
    possible = membership.possible_copies(rows, warehouse.read("fact_index"), months, rows.count())
    possible = warehouse.write_working("possible", possible)
    new = membership.not_loaded(rows, fact, possible)
    missed = fact.join(possible, ["SalesMonth", "RowHash"], "left_anti")
    return (
        rows.select("DateKey", F.lit(1).alias("rows"), F.lit(1).alias("loaded"), F.lit(0).alias("missed"))
        .unionAll(new.select("DateKey", F.lit(0), F.lit(-1), F.lit(0)))
        .unionAll(missed.select("DateKey", F.lit(0), F.lit(0), F.lit(1)))
        .groupBy(dates.month_of_key(F.col("DateKey")).alias("SalesMonth"))
        .agg(*[F.sum(name).alias(name) for name in ("rows", "loaded", "missed")])
    )


def stream_audit(spark, folder):
    """What became of the rows of a streamed load, over all its batches."""
    audit = _streamed(spark, folder).read("load_audit")
    copies = F.col("step").isin("drop_duplicates", "skip_already_loaded")
    return audit.groupBy(F.when(copies, "copies").otherwise(F.col("step")).alias("step")).agg(
        F.sum("removed").alias("removed")
    )


def bad_lines(spark, folder):
    """Lines with a field too many, as the CSV source finds them, by invoice."""
    path = new_folder(spark, "bad_csv")
    raw = raw_sales(spark, folder)
    line = F.concat(
        F.to_csv(F.struct(*RAW_COLUMNS)),
        F.when(_order_number(raw) % BAD_LINE == 1, F.lit(",surplus")).otherwise(""),
    )
    # The first line of each file is its header.
    first = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)) == 0
    text = F.concat(F.when(first, F.lit(",".join(RAW_COLUMNS) + "\n")).otherwise(""), line)
    raw.select(text.alias("value")).write.text(path)
    found = read_csv(spark, path).filter(F.col(MALFORMED_LINE).isNotNull())
    return found.groupBy(F.split(MALFORMED_LINE, ",")[0].alias("InvoiceNo")).agg(
        F.count(F.lit(1)).alias("lines"), F.count("StockCode").alias("with_stock_code")
    )


def _unfit(spark, folder):
    """A warehouse whose load had to set rows aside, loaded twice."""
    key = (spark.sparkContext.applicationId, folder, "unfit")
    if key not in _loaded:
        warehouse = Warehouse(spark, new_folder(spark, "unfit")).create()
        raw = _stored_raw(spark, folder).withColumn("UnitPrice", F.col("UnitPrice") * SMALL_UNITS)
        for _ in range(2):
            load_batch(raw, warehouse, use_mark=False)
        _loaded[key] = warehouse
    return _loaded[key]


def load_rejects(spark, folder):
    return _unfit(spark, folder).read("rejects").select(
        "TargetTable", "Reason", "InvoiceNo", "StockCode", "Quantity", "CustomerID"
    )


def updated_customers(spark, folder):
    """Two loads, the later of which takes over what it knows better of the customers."""
    warehouse = Warehouse(spark, new_folder(spark, "updated")).create()
    raw = _stored_raw(spark, folder)
    moment = F.to_timestamp_ntz("InvoiceDate", F.lit(INVOICE_DATE_FORMAT))
    load_batch(raw.filter(moment <= _timestamp(EARLY_CUT)), warehouse)
    load_batch(raw, warehouse, customers="update")
    return warehouse.star().customers.select("CustomerID", *updates.TRACKED)


def updated_varied_customers(spark, folder):
    """Two loads of a source that grows, over countries that change: the latest known one stays."""
    warehouse = Warehouse(spark, new_folder(spark, "updated_varied")).create()
    raw = _stored_raw(spark, folder, varied=True)
    moment = F.to_timestamp_ntz("InvoiceDate", F.lit(INVOICE_DATE_FORMAT))
    for part in (raw.filter(moment <= _timestamp(EARLY_CUT)), raw):
        load_batch(part, warehouse, customers="update")
    return warehouse.star().customers.select("CustomerID", *updates.TRACKED)


def customer_history(spark, folder):
    """Two loads that keep history, over countries that change, the second of the grown source."""
    warehouse = Warehouse(spark, new_folder(spark, "history")).create()
    raw = _stored_raw(spark, folder, varied=True)
    early = F.to_timestamp_ntz("InvoiceDate", F.lit(INVOICE_DATE_FORMAT)) <= _timestamp(EARLY_CUT)
    for part in (raw.filter(early), raw):
        load_batch(part, warehouse, customers="history")
    return _versions_with_facts(warehouse)


def history_any_order(spark, folder):
    """Three loads that span all dates each, so that later ones split versions and move facts."""
    warehouse = Warehouse(spark, new_folder(spark, "any_order")).create()
    raw = _stored_raw(spark, folder, varied=True)
    for i in (2, 0, 1):
        load_batch(raw.filter(_order_number(raw) % 3 == i), warehouse, customers="history", use_mark=False)
    return _versions_with_facts(warehouse)


def history_in_a_stream(spark, folder):
    """The same from a stream."""
    return _versions_with_facts(_streamed(spark, folder, varied=True, customers="history"))


def _versions_with_facts(warehouse):
    """The versions of all customers, with the number of facts that point to each."""
    sold = warehouse.star().fact.groupBy("CustomerKey").agg(F.count(F.lit(1)).alias("facts"))
    return warehouse.read("customer_versions").join(sold, "CustomerKey", "left").select(
        "CustomerID", "Country", "ValidFrom", "ValidTo", "IsCurrent",
        F.coalesce("facts", F.lit(0)).alias("facts"),
    )


# Fixed value: the sizes of the folder fixture's folders, as tenths of the orders, by path.
FILES = {"a": 1, "b": 7, "c": 2}


def folder_order(spark, folder):
    """First products of a folder of CSV files of unlike size, by path and line."""
    root = new_folder(spark, "folder_csv")
    raw = raw_sales(spark, folder, varied=True)
    tenth, start = _order_number(raw) % 10, 0
    for name, size in FILES.items():
        part = raw.filter(tenth.between(start, start + size - 1)).withColumn("number", _order_number(raw))
        # Many tasks write a folder: their files' names follow the order of the lines, and so does the path.
        order = ["number", "StockCode", F.asc_nulls_first("Description")]
        rows = part.repartitionByRange("number").sortWithinPartitions(*order).drop("number")
        rows.write.options(
            header=True, encoding="ISO-8859-1", quote='"', escape='"',
            ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False,
        ).csv(f"{root}/{name}")
        start += size
    return dimensions.first_products(cleaning.clean(read_csv(spark, f"{root}/*")))


def dim_update(spark, folder):
    cleaned = cleaned_rows(spark, folder)
    existing = keys.assign_surrogate_keys(
        dimensions.customer_rollup(_early(cleaned)), "CustomerID", "CustomerKey"
    )
    last_key = existing.agg(F.max("CustomerKey")).first()[0] or 0
    updated = updates.update_in_place(existing, dimensions.customer_rollup(cleaned), last_key)
    return updated.select(F.col("CustomerID").cast("int"), *updates.TRACKED)


def dim_history(spark, folder):
    cleaned = cleaned_rows(spark, folder)
    early = dimensions.customer_rollup(_early(cleaned))
    late_rows = dimensions.customer_rollup(cleaned)
    history = updates.start_history(early, "1995-04-01")
    changed = updates.update_history(history, late_rows, "CustomerID", "2001-08-01")
    return changed.withColumn("CustomerID", F.col("CustomerID").cast("int"))


def view_by_sql(spark, folder):
    """A registered view, queried with SQL; the date filter reaches the fact partitions."""
    views.register(full(spark, folder))
    return spark.sql(
        "SELECT Country, COUNT(*) AS days, CAST(SUM(DailyRevenue) AS DECIMAL(30,2)) AS revenue "
        "FROM vw_DailySalesSummary WHERE FullDate >= DATE '2000-01-01' GROUP BY Country"
    )


# -- the registry --------------------------------------------------------------------------


def _on_raw(function):
    return lambda spark, folder: function(raw_sales(spark, folder))


def _on_cleaned(function):
    return lambda spark, folder: function(cleaned_rows(spark, folder))


def _on_star(function, which=full):
    return lambda spark, folder: function(which(spark, folder).star())


def _on_flat(function):
    return lambda spark, folder: function(full(spark, folder).star())


def _on_varied(function):
    return lambda spark, folder: function(cleaning.clean(raw_sales(spark, folder, varied=True)))


def _on_dirty(function):
    return lambda spark, folder: function(quality.star_tables(dirty(spark, folder)))


def _on_tables(function):
    return lambda spark, folder: function(_tables(full(spark, folder)))


@cache
def registry():
    found = {
        "s1_csv_scan": csv_scan,
        "s2_source_profile": _on_raw(source_profile),
        "t1_null_profile": _on_raw(cleaning.null_profile),
        "t5_date_range": date_range,
        "t13_audit": _on_raw(cleaning.audit),
        "d1_dim_date": _on_cleaned(dimensions.date_dimension),
        "l1_new_dates": new_dates,
        "l2_first_product": _on_cleaned(dimensions.first_products),
        "l3_new_products": new_products,
        "l4_customer_rollup": _on_cleaned(dimensions.customer_rollup),
        "l5_new_customers": new_customers,
        "l6_surrogate_keys": surrogate_keys,
        "l7_watermark": lambda spark, folder: full(spark, folder).watermark(),
        "l8_increment": increment,
        "l10_l11_lookups": lookups,
        "l10_l11_salted_lookups": salted_lookups,
        "l12_missing_keys": missing_keys,
        "l13_fact_sales": lambda spark, folder: fact_sales(full(spark, folder)),
        "l14_rejects": rejects,
        "l15_new_mark": _on_cleaned(facts.new_mark),
        "l18_rerun_adds_nothing": rerun_adds_nothing,
        "c1_unique_keys": _on_tables(quality.unique_key_check),
        "c2_not_null": _on_tables(quality.not_null_check),
        "c3_value_rules": _on_star(lambda star: quality.value_rules(star.fact)),
        "c4_references": _on_star(quality.reference_check),
        "c4_orphans_of_early_dims": orphans_of_early_dims,
        "c5_length_limits": _on_tables(quality.limit_check),
        "c5_precision": _on_cleaned(quality.precision_check),
        "c6_rejected_rows": _on_raw(cleaning.rejected_rows),
        "c7_date_range": _on_star(
            lambda star: quality.date_range_check(star, "1996-01-01", "2000-12-31")
        ),
        "q1_overall_metrics": _on_star(analysis.overall_metrics),
        "q2_top_customers": _on_star(analysis.top_customers),
        "q3_customer_segments": _on_star(analysis.customer_segments),
        "q4_top_products": _on_star(analysis.top_products),
        "q5_price_dispersion": _on_star(analysis.price_dispersion),
        "q6_revenue_by_country": _on_star(analysis.revenue_by_country),
        "q7_monthly_trend": _on_star(analysis.monthly_trend),
        "q8_weekday_pattern": _on_star(analysis.weekday_pattern),
        "q9_quality_summary": _on_star(quality.quality_summary),
        "v1_daily_sales": _on_star(analysis.daily_sales_summary),
        "v2_product_performance": _on_star(analysis.product_performance),
        "v3_customer_summary": _on_star(analysis.customer_summary),
        "v2_product_performance_unsold": _on_star(analysis.product_performance, late),
        "v3_customer_summary_unsold": _on_star(analysis.customer_summary, late),
        "s1_bad_lines": bad_lines,
        "l2_first_product_varied": _on_varied(dimensions.first_products),
        "l4_customer_rollup_varied": _on_varied(dimensions.customer_rollup),
        "c1_unique_keys_broken": _on_dirty(quality.unique_key_check),
        "c2_not_null_broken": _on_dirty(quality.not_null_check),
        "c3_value_rules_broken": lambda spark, folder: quality.value_rules(dirty(spark, folder).fact),
        "c4_references_broken": lambda spark, folder: quality.reference_check(dirty(spark, folder)),
        "c5_length_limits_broken": _on_dirty(quality.limit_check),
        "c5_precision_broken": lambda spark, folder: quality.precision_check(
            _scaled(cleaned_rows(spark, folder))
        ),
        "c6_load_rejects": load_rejects,
        "x1_stream_audit": stream_audit,
        "x1_membership_index": membership_index,
        "x2_load_updates_customers": updated_customers,
        "x2_load_keeps_history": customer_history,
        "x2_load_updates_customers_varied": updated_varied_customers,
        "x2_history_any_order": history_any_order,
        "x2_history_stream": history_in_a_stream,
        "l2_first_product_folder": folder_order,
        "s9_view_by_sql": view_by_sql,
        "a1_flat_top_customers": _on_flat(flat.top_customers),
        "a2_flat_top_countries": _on_flat(flat.top_countries),
        "a3_flat_top_products": _on_flat(flat.top_products),
        "r1_top_customers_short": _on_star(analysis.top_customers_short),
        "r2_monthly_trend_short": _on_star(analysis.monthly_trend_short),
        "x1_stream_load": stream_load,
        "x2_dim_update": dim_update,
        "x2_dim_history": dim_history,
    }
    for name, _ in CLEANING:
        found[name] = _cleaned_through(name)
    return found

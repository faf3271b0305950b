"""The incremental load: clean, dimensions, facts, high-water mark.

The source is read once and what is new in it shuffled once in full, for the copy removal. The
classified rows go to a working table that everything after reads, each step with only the columns
it needs. Rows at or before the mark do not enter that shuffle: if there are any, a second pass
over the source gathers what the dimensions need of them, map-side.
"""

import logging
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field, replace
from datetime import datetime
from functools import reduce

from pyspark import inheritable_thread_target
from pyspark.sql import functions as F

from tillstar.functions import dates
from tillstar.operators import cleaning, dimensions, facts, history, keys, membership, updates
from tillstar.operators.lookup import broadcast_rows
from tillstar.schemas import (
    AUDIT,
    CLEAN_COLUMNS,
    MALFORMED_LINE,
    ROW_HASH,
    SOURCE_POSITION,
    TEXT_LIMITS,
    UNFIT,
)
from tillstar.session import sized_shuffles
from tillstar.sources.frames import as_raw
from tillstar.sources.warehouse import INDEXED

log = logging.getLogger(__name__)

# What a load does with customers it knows.
INSERT, UPDATE, HISTORY = "insert", "update", "history"


@dataclass(frozen=True)
class LoadReport:
    """What a load really wrote."""

    load_id: int
    mark: datetime | None
    added: dict = field(default_factory=dict)
    rejected: int = 0
    nulls: dict = field(default_factory=dict)


@dataclass
class _Load:
    """One load under way. values: what the dimensions need of old rows, if there are any. moved: the
    customers and days whose earlier facts belong to another version now, if there are any. complete:
    whether the dimensions have taken all their rows, so that every row of the batch has its keys."""

    warehouse: object
    load_id: int
    base: object
    summary: object
    cleaned: object
    values: object = None
    moved: object = None
    complete: bool = False

    def of(self, part, own, columns):
        """The batch's values of one dimension, those of the old rows included."""
        if self.values is None:
            return own
        old = self.values.filter(F.col("part") == part).select(*columns)
        return own.unionByName(old.select(*own.columns))


def load_batch(
    raw, warehouse, use_mark=True, batch=None, stream="", strict=True, customers=INSERT,
    partitions=None,
):
    """Load one batch of raw invoice lines into the warehouse and publish it.

    use_mark: only rows after the high-water mark become facts. A stream turns it off: every
    dated row becomes a fact, unless it is a copy of a published one. batch: the batch's number in
    its stream, kept in the state by stream, so that a repeated batch is skipped. strict: a bad
    date, a fractional id or a malformed line fails the batch; otherwise such rows are set aside
    with the other rejects. customers: "insert" leaves known customers as they are, "update" takes
    over the latest known country of new sales and widens the dates, "history" keeps a version of a
    customer, with a key of its own, for each stretch of days with one country; facts point to the
    version of their day, also if later batches change which one that is. A warehouse stays with
    one of the last two. partitions: of the shuffles, instead of a
    number from the size of what is read.
    """
    raw = as_raw(raw)
    state = warehouse.state()
    if state is None:
        raise ValueError(f"{warehouse.root} has no load state; call create() first")
    if batch is not None and batch <= state.batches.get(stream, -1):
        log.info("batch %s is already loaded", batch)
        return LoadReport(state.load_id, state.mark)
    with sized_shuffles(raw, warehouse.spark, partitions=partitions):
        report, loaded = _load(raw, warehouse, state, use_mark, strict, customers)
    if batch is not None:
        loaded = replace(loaded, batches={**state.batches, stream: batch})
    warehouse.publish(loaded)
    warehouse.remove(warehouse.working(""))
    return report


def _load(raw, warehouse, state, use_mark, strict, customers):
    """Write everything of a load but its state, which is returned."""
    load_id = state.load_id + 1
    mark = state.mark if use_mark else None
    classified = facts.with_unfit(cleaning.classify(raw, mark)).drop(*cleaning.DERIVED)
    rows = cleaning.derived_again(warehouse.write_working("cleaned", classified))
    summary = cleaning.batch_summary(rows, facts.is_due(mark), F.col(UNFIT).isNotNull()).first()
    log.info("load %s: %s raw rows", load_id, summary["n0"])
    cleaning.check_batch(summary, strict)
    load = _Load(warehouse, load_id, state, summary, _kept(rows))
    if summary["step_skip_at_or_before_mark"]:
        load.values = _old_values(raw, mark, warehouse, strict)

    rejects = [] if strict else _unusable(rows)
    added = {}
    # The dimensions do not depend on each other; their small jobs share the cluster.
    in_session = inheritable_thread_target(warehouse.spark)
    steps = {
        "dim_date": _load_dates,
        "dim_product": _insert_products,
        "dim_customer": CUSTOMERS[customers],
    }
    with ThreadPoolExecutor(len(steps)) as pool:
        started = {table: pool.submit(in_session(step), load) for table, step in steps.items()}
    set_aside = []
    for table, result in started.items():
        added[table], bad = result.result()
        set_aside += bad
    rejects += set_aside
    load.complete = not set_aside
    loaded, bad = _load_facts(load, use_mark, customers)
    added["fact_sales"] = loaded["good"]
    if loaded["bad"]:
        rejects.append(bad)
    rejected = _write_rejects(warehouse, load_id, rejects)
    later = {
        "skip_without_date": summary["kept_rows"] - summary["due_rows"],
        "skip_already_loaded": summary["due_rows"] - loaded["good"] - loaded["bad"],
        "set_aside_unfit": loaded["bad"],
    }
    audit = cleaning.load_audit(summary, later)
    warehouse.write("load_audit", load_id, _as_rows(warehouse.spark, audit, AUDIT))

    # The mark never falls, and moves only after everything else is in place.
    dates = [d for d in (state.mark, summary["last_date"]) if d is not None]
    new_mark = max(dates, default=None)
    log.info("load %s: added %s, rejected %s, mark %s", load_id, added, rejected, new_mark)
    nulls = {k[5:]: v for k, v in summary.asDict().items() if k.startswith("null_")}
    bases = dict(state.bases)
    if customers != INSERT:
        bases["dim_customer"] = load_id
    if customers == HISTORY:
        bases["customer_versions"] = load_id
    bases |= {f"fact_sales/{month}": load_id for month in loaded["rewritten"]}
    return LoadReport(load_id, new_mark, added, rejected, nulls), replace(
        state, load_id=load_id, mark=new_mark, last_sales_key=loaded["last_key"], bases=bases
    )


def _as_rows(spark, values, schema):
    """A few rows as a frame, without a Python worker."""
    names = schema.fieldNames()
    entries = [F.struct(*[F.lit(v).alias(n) for v, n in zip(row, names, strict=True)]) for row in values]
    return spark.range(1).select(F.inline(F.array(*entries)))


def _old_values(raw, mark, warehouse, strict):
    """What the dimensions need of the rows at or before the mark: one map-side aggregate."""
    values = dimensions.all_values(cleaning.old_rows(raw, mark))
    values = warehouse.write_working("old_values", values)
    if strict and not values.filter("fractional > 0").isEmpty():
        raise cleaning.BadBatch("rows with a fractional CustomerID")
    return values


def _unusable(rows):
    """Rows that would fail a strict batch, as rejects."""
    reason = F.when(F.col("RowStatus") == cleaning.BAD_DATE, "bad InvoiceDate").when(
        F.col("RowStatus") == cleaning.FRACTIONAL_ID, "fractional CustomerID"
    )
    found = [facts.as_rejects(rows.withColumn("Reason", reason), "fact_sales")]
    if MALFORMED_LINE in rows.columns:
        lines = rows.filter(F.col("RowStatus") == cleaning.MALFORMED).select(
            F.explode(F.array_repeat(F.lit("malformed line"), F.col("Copies").cast("int"))).alias("Reason"),
            F.col(MALFORMED_LINE).alias("RawLine"),
            F.xxhash64(MALFORMED_LINE).alias(ROW_HASH.name),
        )
        found.append(facts.as_rejects(lines, "fact_sales"))
    return found


def _load_dates(load):
    warehouse = load.warehouse
    days = load.of("date", dimensions.sale_dates(load.cleaned), ["FullDate"]).distinct()
    new = dimensions.insert_if_absent(
        dimensions.date_attributes(days), warehouse.read("dim_date", load.load_id - 1), "DateKey"
    )
    warehouse.write("dim_date", load.load_id, new)
    return warehouse.read_load("dim_date", load.load_id).count(), []


def _insert_keyed(load, candidates, table, business_key, key, reason):
    """Insert the absent candidates under new surrogate keys; set bad ones aside."""
    warehouse, load_id = load.warehouse, load.load_id
    key_type = candidates.schema[business_key].dataType
    existing = warehouse.read(table, load_id - 1).withColumn(
        business_key, F.col(business_key).cast(key_type)
    )
    absent = warehouse.write_working(
        f"new_{table}",
        dimensions.insert_if_absent(candidates, existing, business_key).withColumn(
            "Reason", reason
        ),
    )
    sizes = absent.agg(
        F.count_if(F.col("Reason").isNull()).alias("good"), F.count("Reason").alias("bad")
    ).first()
    rejects = [facts.as_rejects(absent, table)] if sizes["bad"] else []
    if not sizes["good"]:
        warehouse.write_nothing(table, load_id)
        return 0, rejects
    last_key = existing.agg(F.max(key)).first()[0] or 0
    good = absent.filter(F.col("Reason").isNull()).drop("Reason")
    warehouse.write(
        table, load_id, keys.assign_surrogate_keys(good, business_key, key, last_key)
    )
    return sizes["good"], rejects


def _insert_products(load):
    columns = ["StockCode", "Description", "seen"]
    values = load.of("product", dimensions.product_values(load.cleaned), columns)
    return _insert_keyed(
        load, dimensions.products_of(values),
        "dim_product", "StockCode", "ProductKey", facts.product_reason(),
    )


def _rolled_up_customers(load, own=None):
    """own: the batch's customer_values(), if they are at hand."""
    columns = ["CustomerID", "Country", "seen", "earliest", "latest"]
    own = dimensions.customer_values(load.cleaned) if own is None else own
    return dimensions.customers_of(load.of("customer", own, columns))


def _insert_customers(load):
    return _insert_keyed(
        load, _rolled_up_customers(load),
        "dim_customer", "CustomerID", "CustomerKey", facts.customer_reason(),
    )


def _update_customers(load):
    """The whole dimension anew: known customers with the batch's values merged in, new ones added."""
    warehouse, load_id = load.warehouse, load.load_id
    # Twice of use, and far fewer than the rows.
    values = warehouse.write_working("customer_values", dimensions.customer_values(load.cleaned))
    rolled = warehouse.write_working(
        "new_dim_customer", _rolled_up_customers(load, values).withColumn("Reason", facts.customer_reason())
    )
    existing = warehouse.read("dim_customer", load_id - 1)
    known = existing.agg(F.count(F.lit(1)).alias("rows"), F.max("CustomerKey").alias("last")).first()
    good = rolled.filter(F.col("Reason").isNull()).drop("Reason")
    latest = dimensions.latest_countries(_fitting(values))
    good = updates.taking_over(good, existing, latest)
    warehouse.write("dim_customer", load_id, updates.update_in_place(existing, good, known["last"] or 0))
    written = warehouse.read_load("dim_customer", load_id).count()
    return written - known["rows"], _set_aside(rolled)


def _set_aside(rolled):
    """Customers with a reason, as rejects, if there are any."""
    found = facts.as_rejects(rolled, "dim_customer")
    return [] if found.isEmpty() else [found]


def _fitting(rows):
    """Rows whose country fits the dimension."""
    country = F.col("Country")
    return rows.filter(country.isNull() | (F.length(country) <= TEXT_LIMITS["dim_customer"]["Country"]))


def _keep_versions(load):
    """The versions of all customers anew, and the dimension with a row for each.

    Only customers with days that were not known are worked on; the others' versions are copied.
    """
    warehouse, load_id = load.warehouse, load.load_id
    rolled = warehouse.write_working(
        "new_dim_customer", _rolled_up_customers(load).withColumn("Reason", facts.customer_reason())
    )
    good = rolled.filter(F.col("Reason").isNull()).drop("Reason")
    versions = warehouse.read("customer_versions", load_id - 1)
    starts = versions.isEmpty()
    if starts:
        # What earlier loads have inserted is valid from ever.
        customers = warehouse.read("dim_customer", load_id - 1)
        versions = customers.withColumns({
            "ValidFrom": F.lit(None).cast("date"), "ValidTo": F.lit(None).cast("date"), "IsCurrent": F.lit(True),
        })
        sold = history.days_of_facts(warehouse.read("fact_sales", load_id - 1), customers)
        days = warehouse.write_working("first_days", history.merged(sold, history.from_ever(customers)))
    else:
        days = warehouse.read("customer_days", load_id - 1)
    added = history.sale_days(_fitting(load.cleaned)).join(good, "CustomerID", "left_semi")
    added = added.unionByName(_days_from_ever(load, good, versions, added))
    added = warehouse.write_working("added_days", added)
    met = days.join(added.select("CustomerID").distinct(), "CustomerID", "left_semi")
    met = history.merged(met, added.limit(0))
    changed = warehouse.write_working("changed_days", history.changed_days(met, added))
    whose = changed.select("CustomerID").distinct()
    met = warehouse.write_working("met_days", met.join(whose, "CustomerID", "left_semi"))

    by_id = versions.withColumn("CustomerID", F.col("CustomerID").cast("bigint"))
    old = by_id.join(whose, "CustomerID", "left_semi")
    known = versions.agg(F.count(F.lit(1)).alias("rows"), F.max("CustomerKey").alias("last")).first()
    keyed = warehouse.write_working("keyed", history.keyed(history.intervals(history.merged(met, changed)), old))
    new = warehouse.write_working("new_versions", history.numbered(keyed, known["last"] or 0))
    kept = by_id.join(whose, "CustomerID", "left_anti")
    warehouse.write("customer_versions", load_id, kept.unionByName(new))
    warehouse.write("customer_days", load_id, history.merged(days, changed) if starts else changed)
    written = warehouse.read_load("customer_versions", load_id)
    warehouse.write("dim_customer", load_id, written)
    moved = warehouse.write_working("moved", history.moved_days(met, old, new))
    load.moved = None if moved.isEmpty() else moved
    return written.count() - known["rows"], _set_aside(rolled)


def _days_from_ever(load, good, versions, added):
    """What new customers have had from ever: their country in rows at or before the mark, if there
    are any, or the batch's if they have no dated sale."""
    known = versions.select(F.col("CustomerID").cast("bigint").alias("CustomerID"))
    new = good.join(known, "CustomerID", "left_anti")
    undated = new.join(added, "CustomerID", "left_anti")
    if load.values is None:
        return history.from_ever(undated)
    before = dimensions.latest_countries(_fitting(load.values.filter("part = 'customer'")))
    old = before.join(new, "CustomerID", "left_semi")
    return history.from_ever(old).unionByName(history.from_ever(undated.join(old, "CustomerID", "left_anti")))


CUSTOMERS = {INSERT: _insert_customers, UPDATE: _update_customers, HISTORY: _keep_versions}


def _load_facts(load, use_mark, customers):
    """Append the increment, and rewrite the months whose facts change versions. Returns the rows
    written and set aside with the last SalesKey, and the latter rows as rejects."""
    warehouse, load_id, summary = load.warehouse, load.load_id, load.summary
    last_key = load.base.last_sales_key
    if summary["due_rows"] == 0:
        log.info("load %s: no new rows", load_id)
        warehouse.write_nothing("fact_sales", load_id)
        warehouse.write_nothing("fact_index", load_id)
        return {"good": 0, "bad": 0, "last_key": last_key, "rewritten": []}, None

    dated = load.cleaned.filter(F.col("InvoiceDate").isNotNull())
    sizes = {"good": summary["due_rows"] - summary["unfit_rows"], "bad": summary["unfit_rows"]}
    # Each row of a complete load has its keys, so those that do not fit are told without a lookup, and
    # were no facts before either. The others go through the lookups with no more than a fact holds.
    fits = load.complete and summary["unfit_rows"]
    asked = due = dated.filter(F.col(UNFIT).isNull()) if fits else dated
    if not use_mark and load_id > 1:
        due = _not_loaded(load, asked)
    if due is not asked:
        # Not twice: the lookups may count it first.
        due = warehouse.write_working("due", due.drop(*cleaning.DERIVED))
        due = cleaning.derived_again(due)
    if load.complete:
        rejected = dated.withColumn("Reason", F.col(UNFIT))
        if due is not asked:
            sizes["good"] = due.count()
        fitting = facts.to_look_up(due)
        resolved = _looked_up(load, fitting, customers)
        indexed_rows = fitting
    else:
        # Looked up once, then split into facts and rejects.
        resolved = warehouse.write_working("resolved", _looked_up(load, due, customers))
        rejected = resolved
        sizes = _sizes(resolved)
        indexed_rows = resolved.filter(F.col("Reason").isNull())
    first, last = summary["due_first"], summary["due_last"]
    months = (last.year - first.year) * 12 + last.month - first.month + 1
    parts = int(warehouse.spark.conf.get("spark.sql.shuffle.partitions"))
    rows, rewritten = None, []
    if sizes["good"]:
        placed = facts.lay_out(facts.fact_rows(resolved), months, parts)
        rows = keys.assign_sales_keys(placed, last_key)
    parts_of_facts = [] if rows is None else [rows]
    if load.moved is not None:
        bound = broadcast_rows(warehouse.spark)
        groups = facts.month_groups(load.moved, bound)
        rewritten = [month for months, _ in groups for month in months]
        log.info("load %s: rewriting months %s", load_id, rewritten)
        stored = warehouse.read("fact_sales", load_id - 1)
        parts_of_facts += [_rewritten(stored, load.moved, months, size <= bound) for months, size in groups]
    if not parts_of_facts:
        warehouse.write_nothing("fact_sales", load_id)
        warehouse.write_nothing("fact_index", load_id)
    else:
        # Rewritten facts are in the index already. Its small job fills the cluster's gaps.
        words = membership.words_of(indexed_rows)
        with ThreadPoolExecutor(1) as pool:
            in_session = inheritable_thread_target(warehouse.spark)
            indexed = pool.submit(in_session(warehouse.write), "fact_index", load_id, words)
            warehouse.write("fact_sales", load_id, parts_of_facts[0])
            for rows in parts_of_facts[1:]:
                warehouse.write_more("fact_sales", load_id, rows)
        indexed.result()
        # Rewritten facts have earlier keys.
        written = warehouse.read_load("fact_sales", load_id).agg(
            F.max("SalesKey").alias("last"), F.count_if(F.col("SalesKey") > last_key).alias("new")
        ).first()
        if load.complete and written["new"] != sizes["good"]:
            # Keys that are missing or not unique in a dimension after all: look every row up whole.
            log.warning("load %s: %s facts of %s rows", load_id, written["new"], sizes["good"])
            return _load_facts(replace(load, complete=False), use_mark, customers)
        last_key = max(last_key, written["last"] or 0)
    loaded = {"good": sizes["good"], "bad": sizes["bad"], "last_key": last_key, "rewritten": rewritten}
    return loaded, facts.as_rejects(rejected, "fact_sales")


def _rewritten(stored, moved, months, few):
    """The facts of these months with the keys of their versions as they are now. few: the customers
    and days that moved there may be broadcast; the facts then stay in the layout they are stored in."""
    old = stored.filter(F.col("SalesMonth").isin(months))
    moved = moved.filter(dates.month_of_key(F.col("DateKey")).isin(months))
    if few:
        old = history.rekeyed(old, F.broadcast(moved))
    else:
        old = history.rekeyed(old, moved).hint("rebalance", "SalesMonth")
    return old.sortWithinPartitions("SalesMonth", "DateKey", "InvoiceNo")


def _sizes(rows):
    """How many rows have no Reason, and how many have one."""
    return rows.agg(F.count_if(F.col("Reason").isNull()).alias("good"), F.count("Reason").alias("bad")).first()


def _looked_up(load, due, customers):
    """The rows, of a working table, with their keys."""
    warehouse, load_id = load.warehouse, load.load_id
    products = warehouse.read("dim_product", load_id)
    if customers == HISTORY:
        return facts.resolve_versions(due, products, warehouse.read_load("customer_versions", load_id))
    # An update has written the whole dimension as this load's part.
    read = warehouse.read_load if customers == UPDATE else warehouse.read
    return facts.resolve(due, products, read("dim_customer", load_id), stored=True)


def _not_loaded(load, due):
    """Dated rows that no published fact is a copy of."""
    warehouse, last = load.warehouse, load.load_id - 1
    fact, months = warehouse.read("fact_sales", last), facts.months_of(due)
    if INDEXED not in load.base.bases:
        return facts.not_loaded(due, fact, months)
    index = warehouse.read("fact_index", last)
    possible = membership.possible_copies(due, index, months, load.summary["due_rows"])
    return membership.not_loaded(due, fact, warehouse.write_working("possible_copies", possible))


def _write_rejects(warehouse, load_id, rejects):
    """Set rows aside that no earlier load has. Returns how many."""
    if not rejects:
        warehouse.write_nothing("rejects", load_id)
        return 0
    found = reduce(lambda a, b: a.unionAll(b), rejects)
    if load_id > 1:
        found = facts.new_rejects(found, warehouse.read("rejects", load_id - 1))
    warehouse.write("rejects", load_id, found)
    return warehouse.read_load("rejects", load_id).count()


def load_csv(spark, path, warehouse, multi_line=False, strict=True, **options):
    """The whole job: read a CSV, clean it, load the star, move the mark."""
    from tillstar.sources.csv_source import read_csv

    raw = read_csv(spark, path, multi_line=multi_line, strict=strict)
    return load_batch(raw, warehouse, strict=strict, **options)


def _kept(rows):
    """The rows that passed every cleaning rule, from a load's working table."""
    return rows.filter(F.col("RowStatus") == cleaning.KEPT).select(
        *CLEAN_COLUMNS, ROW_HASH.name, UNFIT, *[c for c in rows.columns if c == SOURCE_POSITION]
    )

"""Cleaning rules for raw invoice lines, one function per rule.

The order of the rules is part of the result: missing keys, exact copies (on the untouched
columns), date parsing, cancelled invoices, non-positive values, amount, stripping, ids, dates.

clean() is one lazy plan with a single shuffle, the copy removal. The filters after it only use
its grouping columns, so Catalyst moves them below the shuffle and into the scan.
"""

from functools import reduce

from pyspark.sql import functions as F

from tillstar.functions import dates, money, text
from tillstar.schemas import (
    CLEAN_COLUMNS,
    KEY_COLUMNS,
    MALFORMED_LINE,
    RAW_COLUMNS,
    ROW_HASH,
    SOURCE_POSITION,
    TEXT_COLUMNS,
)

# What became of a raw row, in the order the rules apply.
MALFORMED = "malformed"
MISSING_KEY = "missing_key"
AT_OR_BEFORE_MARK = "at_or_before_mark"
BAD_DATE = "bad_date"
CANCELLED = "cancelled"
NON_POSITIVE = "non_positive"
FRACTIONAL_ID = "fractional_id"
KEPT = "kept"


class BadBatch(Exception):
    """The batch breaks a rule that fails it as a whole; nothing was written."""


class EmptyBatch(BadBatch):
    """The batch has no rows."""


def _has_keys():
    return reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in KEY_COLUMNS])


def _is_positive():
    return (F.col("Quantity") > 0) & (F.col("UnitPrice") > 0)


def _is_fractional(number):
    return number.isNotNull() & (F.isnan(number) | (number != F.floor(number)))


def null_profile(raw):
    """Missing values per column, as (column_name, null_count, row_count) rows from one pass."""
    counted = raw.agg(
        F.count(F.lit(1)).alias("row_count"),
        *[F.count_if(F.col(c).isNull()).alias(c) for c in RAW_COLUMNS],
    )
    return counted.select(
        F.explode(
            F.array(*[
                F.struct(F.lit(c).alias("column_name"), F.col(c).alias("null_count"))
                for c in RAW_COLUMNS
            ])
        ).alias("entry"),
        "row_count",
    ).select("entry.column_name", "entry.null_count", "row_count")


def drop_null_keys(df):
    return df.filter(_has_keys())


def drop_exact_duplicates(df):
    """One row per distinct raw row; missing values equal each other.

    A hash aggregate with a map-side pass: a group of copies, however large, leaves at most one
    row per task before the shuffle. With a source position, the first copy's is kept.
    """
    if SOURCE_POSITION in df.columns:
        return df.groupBy(RAW_COLUMNS).agg(F.min(SOURCE_POSITION).alias(SOURCE_POSITION))
    return df.dropDuplicates(RAW_COLUMNS)


def parse_invoice_date(df):
    return df.withColumn("InvoiceDate", dates.parse_invoice_date(F.col("InvoiceDate")))


def date_range(df):
    return df.agg(
        F.min("InvoiceDate").alias("min_date"), F.max("InvoiceDate").alias("max_date")
    )


def drop_cancelled(df):
    return df.filter(~text.is_cancelled(F.col("InvoiceNo")))


def keep_positive(df):
    return df.filter(_is_positive())


def add_amount(df):
    return df.withColumn(
        "TotalSalesAmount", money.line_amount(F.col("Quantity"), F.col("UnitPrice"))
    )


def strip_text(df):
    return df.withColumns({c: text.strip(F.col(c)) for c in TEXT_COLUMNS})


def customer_to_integer(df):
    """Ids arrive as floats. A fractional id fails the job; it is never cut off."""
    number = F.col("CustomerID")
    return df.withColumn(
        "CustomerID",
        F.when(
            _is_fractional(number),
            F.raise_error(F.concat(F.lit("fractional CustomerID: "), number)).cast("bigint"),
        ).otherwise(number.cast("bigint")),
    )


def add_date_parts(df):
    return df.withColumns(
        {
            "InvoiceYear": F.year("InvoiceDate"),
            "InvoiceMonth": F.month("InvoiceDate"),
            "InvoiceDay": F.dayofmonth("InvoiceDate"),
        }
    )


def add_date_key(df):
    return df.withColumn("DateKey", dates.date_key(F.col("InvoiceDate")))


def _derive(df):
    """The column steps that follow the filters."""
    return (
        df.transform(add_amount)
        .transform(strip_text)
        .transform(customer_to_integer)
        .transform(add_date_parts)
        .transform(add_date_key)
    )


def _with_position(df, columns):
    return df.select(*columns, *[c for c in df.columns if c == SOURCE_POSITION])


def clean(raw):
    """All rules in order, as one lazy plan."""
    rows = (
        raw.transform(drop_null_keys)
        .transform(drop_exact_duplicates)
        .transform(parse_invoice_date)
        .transform(drop_cancelled)
        .transform(keep_positive)
        .transform(_derive)
    )
    return _with_position(rows, CLEAN_COLUMNS)


def _missing_columns():
    """Bit i is set if raw column i is missing."""
    bits = [F.when(F.col(c).isNull(), 1 << i).otherwise(0) for i, c in enumerate(RAW_COLUMNS)]
    return reduce(lambda a, b: a + b, bits)


def _malformed(rows):
    return F.col(MALFORMED_LINE).isNotNull() if MALFORMED_LINE in rows.columns else F.lit(False)


def is_old(mark, spark):
    """Raw rows that have keys and a date at or before the mark: no facts, whatever else they are."""
    if mark is None:
        return F.lit(False)
    moment = dates.date_or_null(F.col("InvoiceDate"), spark)
    return _has_keys() & F.coalesce(moment <= F.lit(mark).cast("timestamp_ntz"), F.lit(False))


def condense(raw, mark=None):
    """Distinct raw rows, with their number of copies and the columns they miss.

    One pass and one shuffle serve the copy removal, the audit and the null profile. Rows that
    lack a key column, and rows at or before the mark, are blanked to the pattern of what they
    miss, so however many there are, a handful of rows per task enter the shuffle. A group of copies
    shrinks map-side as well.
    """
    good = ~_malformed(raw)
    old = is_old(mark, raw.sparkSession) & good
    whole = _has_keys() & good & ~old
    blanked = raw.select(
        *[F.when(whole, F.col(c)).alias(c) for c in RAW_COLUMNS],
        _missing_columns().alias("MissingColumns"),
        old.alias("Old"),
        *[c for c in raw.columns if c in (SOURCE_POSITION, MALFORMED_LINE)],
    )
    sums = [F.count(F.lit(1)).alias("Copies")]
    if SOURCE_POSITION in raw.columns:
        sums.append(F.min(SOURCE_POSITION).alias(SOURCE_POSITION))
    line = [c for c in raw.columns if c == MALFORMED_LINE]
    return blanked.groupBy(*RAW_COLUMNS, "MissingColumns", "Old", *line).agg(*sums)


def row_status(rows, bad_date=None):
    """The first rule a row breaks, or kept. Condensed rows also say whether they are old. bad_date:
    which rows have one, if that is known already."""
    if bad_date is None:
        bad_date = dates.is_bad_date(F.col("InvoiceDate"))
    status = F.when(_malformed(rows), MALFORMED)
    if "Old" in rows.columns:
        status = status.when(F.col("Old"), AT_OR_BEFORE_MARK)
    return (
        status.when(~_has_keys(), MISSING_KEY)
        .when(bad_date, BAD_DATE)
        .when(text.is_cancelled(F.col("InvoiceNo")), CANCELLED)
        .when(~F.coalesce(_is_positive(), F.lit(False)), NON_POSITIVE)
        .when(_is_fractional(F.col("CustomerID")), FRACTIONAL_ID)
        .otherwise(KEPT)
    )


def _classified(rows):
    """As clean(), but nothing is dropped and nothing raises: RowStatus says what each row is."""
    moment = F.col("_moment")
    return (
        rows.withColumn(ROW_HASH.name, F.xxhash64(*RAW_COLUMNS))
        # Read once, for the status and for the value.
        .withColumn("_moment", dates.date_or_null(F.col("InvoiceDate"), rows.sparkSession))
        .withColumn("RowStatus", row_status(rows, F.col("InvoiceDate").isNotNull() & moment.isNull()))
        .withColumn("InvoiceDate", moment)
        .withColumn("CustomerID", F.when(~_is_fractional(F.col("CustomerID")), F.col("CustomerID")))
        .transform(_derive)
        .drop("_moment")
    )


def classify(raw, mark=None):
    """The condensed rows, each with its status and its values as a clean row has them.

    A load writes this once. The kept rows feed the tables, the others the audit, the null
    profile and the whole-batch checks, without a second pass over the source.
    """
    rows = _classified(condense(raw, mark))
    line = [c for c in raw.columns if c == MALFORMED_LINE]
    return _with_position(
        rows, [*CLEAN_COLUMNS, "RowStatus", "Copies", "MissingColumns", ROW_HASH.name, *line]
    )


# What a load's working table leaves out, as reading it derives it again.
DERIVED = ["TotalSalesAmount", "InvoiceYear", "InvoiceMonth", "InvoiceDay", "DateKey"]


def derived_again(rows):
    """Classified rows that were written without the columns that follow from others."""
    return rows.transform(add_amount).transform(add_date_parts).transform(add_date_key)


def old_rows(raw, mark):
    """The rows at or before the mark that no rule drops, as far as the dimensions need them.

    Copies are not removed and texts not stripped. They have keys and a date, so the rules left
    are few; a fractional id is flagged.
    """
    stays = ~text.is_cancelled(F.col("InvoiceNo")) & F.coalesce(_is_positive(), F.lit(False))
    return raw.filter(is_old(mark, raw.sparkSession) & ~_malformed(raw) & stays).select(
        "StockCode", "Description", "Country", "CustomerID",
        dates.read_date(F.col("InvoiceDate")).alias("InvoiceDate"),
        _is_fractional(F.col("CustomerID")).alias("Fractional"),
        *[c for c in raw.columns if c == SOURCE_POSITION],
    )


# Audit steps, in the order the rules apply.
AUDIT_STEPS = ["drop_null_keys", "drop_duplicates", "drop_cancelled", "keep_positive"]
# The steps of a load, with the statuses whose rows they take; the audit of a load says of every raw
# row what became of it.
LOAD_STEPS = {
    "set_aside_malformed": MALFORMED,
    "drop_null_keys": MISSING_KEY,
    "skip_at_or_before_mark": AT_OR_BEFORE_MARK,
    "drop_duplicates": None,
    "set_aside_bad_date": BAD_DATE,
    "drop_cancelled": CANCELLED,
    "keep_positive": NON_POSITIVE,
    "set_aside_fractional_id": FRACTIONAL_ID,
}
# Of these every copy counts; of the others, whose copies went before, one.
_UNCONDENSED = (MALFORMED, MISSING_KEY, AT_OR_BEFORE_MARK)


def step_counts(status):
    """Row counts n0..n4 before and after the audit steps, from condensed rows."""
    copies = F.col("Copies")
    gone = [MISSING_KEY]
    columns = [
        F.coalesce(F.sum(copies), F.lit(0)).alias("n0"),
        F.coalesce(F.sum(F.when(status != MISSING_KEY, copies)), F.lit(0)).alias("n1"),
    ]
    for i, step in enumerate([None, CANCELLED, NON_POSITIVE], start=2):
        if step:
            gone.append(step)
        columns.append(F.count_if(~status.isin(gone)).alias(f"n{i}"))
    return columns


def removed_counts(status):
    """How many rows each step of a load takes, from condensed rows."""
    copies = F.col("Copies")
    columns = []
    for step, taken in LOAD_STEPS.items():
        if taken is None:
            counted = F.sum(F.when(~status.isin(*_UNCONDENSED), copies - 1))
        else:
            counted = F.sum(F.when(status == taken, copies if taken in _UNCONDENSED else 1))
        columns.append(F.coalesce(counted, F.lit(0)).alias(f"step_{step}"))
    return columns


def load_audit(summary, later):
    """(step, rows_in, rows_out, removed) of a load, closing with the facts it wrote.

    later: steps after the cleaning, with the rows each took. Of the steps that are no cleaning
    rules only those are listed that took rows.
    """
    removed = {step: summary[f"step_{step}"] for step in LOAD_STEPS} | later
    rows, found = summary["n0"], []
    for step, gone in removed.items():
        if gone or step in AUDIT_STEPS:
            found.append((step, rows, rows - gone, gone))
        rows -= gone
    return found


def null_counts():
    """Missing values per raw column, from condensed rows."""
    return [
        F.coalesce(
            F.sum(F.when(F.col("MissingColumns").bitwiseAND(F.lit(1 << i)) != 0, F.col("Copies"))),
            F.lit(0),
        ).alias(f"null_{c}")
        for i, c in enumerate(RAW_COLUMNS)
    ]


def batch_summary(rows, due=None, unfit=None):
    """Everything the audit, the null profile, the whole-batch checks and the fact load need to
    know about a batch, as one row from one pass. due: which kept rows become facts. unfit: which of
    them do not fit."""
    status, date = F.col("RowStatus"), F.col("InvoiceDate")
    kept = status == KEPT
    loaded = kept if due is None else kept & due
    return rows.agg(
        *step_counts(status),
        *removed_counts(status),
        *null_counts(),
        F.count_if(status == BAD_DATE).alias("bad_dates"),
        F.count_if(status == FRACTIONAL_ID).alias("fractional_ids"),
        F.max(F.when(kept, date)).alias("last_date"),
        F.count_if(kept).alias("kept_rows"),
        F.count_if(loaded).alias("due_rows"),
        F.count_if(loaded & (F.lit(False) if unfit is None else unfit)).alias("unfit_rows"),
        F.min(F.when(loaded, date)).alias("due_first"),
        F.max(F.when(loaded, date)).alias("due_last"),
    )


def _step_of(status):
    return next(step for step, taken in LOAD_STEPS.items() if taken == status)


def check_batch(summary, strict=True):
    """Fail, before any table is touched, if the batch as a whole is unusable.

    An explicit check, because Catalyst is free to skip the expression that would have raised.
    """
    if summary["n0"] == 0:
        raise EmptyBatch("the source has no rows")
    if strict and summary[f"step_{_step_of(MALFORMED)}"]:
        raise BadBatch(f"{summary[f'step_{_step_of(MALFORMED)}']} malformed lines")
    if strict and summary["bad_dates"]:
        raise BadBatch(f"{summary['bad_dates']} distinct rows with a bad InvoiceDate")
    if strict and summary["fractional_ids"]:
        raise BadBatch(f"{summary['fractional_ids']} distinct rows with a fractional CustomerID")


def audit_rows(counts):
    """(step, rows_in, rows_out, removed) rows from a one-row frame of the step counts."""
    return counts.select(
        F.explode(
            F.array(*[
                F.struct(
                    F.lit(step).alias("step"),
                    F.col(f"n{i}").alias("rows_in"),
                    F.col(f"n{i + 1}").alias("rows_out"),
                    (F.col(f"n{i}") - F.col(f"n{i + 1}")).alias("removed"),
                )
                for i, step in enumerate(AUDIT_STEPS)
            ])
        ).alias("entry")
    ).select("entry.*")


def audit(raw):
    """Rows removed per step."""
    rows = condense(raw)
    return audit_rows(rows.agg(*step_counts(row_status(rows))))


def rejected_rows(raw):
    """Raw rows a cleaning filter drops, with the first rule they break (copies are no rejects)."""
    reason = (
        F.when(~_has_keys(), "missing key column")
        .when(text.is_cancelled(F.col("InvoiceNo")), "cancelled invoice")
        .when(~F.coalesce(_is_positive(), F.lit(False)), "quantity or price not positive")
    )
    return raw.select(*RAW_COLUMNS, reason.alias("Reason")).filter(F.col("Reason").isNotNull())

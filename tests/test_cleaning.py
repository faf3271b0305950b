from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tillstar.functions.dates import INVOICE_DATE_FORMAT
from tillstar.operators import cleaning
from tillstar.schemas import CLEAN_COLUMNS, RAW_COLUMNS


def test_rows_without_a_key_are_dropped_and_a_missing_description_is_kept(lines):
    raw = lines(
        {"InvoiceNo": None}, {"StockCode": None}, {"CustomerID": None}, {"Description": None}
    )
    kept = cleaning.drop_null_keys(raw).collect()
    assert [r.Description for r in kept] == [None]


def test_exact_copies_go_also_with_missing_values(lines):
    raw = lines({"Description": None}, {"Description": None}, {}, {})
    assert cleaning.drop_exact_duplicates(raw).count() == 2


def test_rows_that_differ_by_a_space_both_stay(lines):
    raw = lines({"Country": "France"}, {"Country": "France "})
    assert [r.Country for r in cleaning.clean(raw).collect()] == ["France", "France"]


def test_only_an_upper_case_c_at_the_start_is_cancelled(lines, values):
    raw = lines({"InvoiceNo": "C1"}, {"InvoiceNo": "c1"}, {"InvoiceNo": " C1"}, {"InvoiceNo": "1C"})
    assert values(cleaning.drop_cancelled(raw), "InvoiceNo") == [" C1", "1C", "c1"]
    # Stripping comes after the test, so the padded one survives as "C1".
    assert values(cleaning.clean(raw), "InvoiceNo") == ["1C", "C1", "c1"]


def test_only_positive_quantities_and_prices_stay(lines, values):
    raw = lines(
        {"Quantity": 0}, {"Quantity": -1}, {"Quantity": None}, {"UnitPrice": 0.0},
        {"UnitPrice": -0.5}, {"UnitPrice": None}, {"UnitPrice": 0.001}, {"Quantity": 1},
    )
    assert values(cleaning.keep_positive(raw), "UnitPrice") == [0.001, 2.55]


def test_both_date_forms_are_read(lines, values):
    raw = lines({"InvoiceDate": "12/1/2010 8:26"}, {"InvoiceDate": "12/01/2010 08:26"})
    dates = values(cleaning.parse_invoice_date(raw), "InvoiceDate")
    assert dates == [datetime(2010, 12, 1, 8, 26)] * 2


@pytest.mark.parametrize("bad", ["2010-12-01", "13/1/2010 8:26", "2/30/2010 8:26", "12/1/2010"])
def test_a_bad_date_raises_also_without_ansi(spark, lines, bad):
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        with pytest.raises(Exception, match="bad InvoiceDate"):
            cleaning.parse_invoice_date(lines({"InvoiceDate": bad})).collect()
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")


def test_dates_do_not_depend_on_the_session_zone(spark, lines):
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        # 2:30 does not exist on this day in that zone.
        row = cleaning.clean(lines({"InvoiceDate": "3/13/2011 2:30"})).first()
        assert row.InvoiceDate == datetime(2011, 3, 13, 2, 30)
        assert row.DateKey == 20110313
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_every_kind_of_whitespace_is_stripped(lines):
    raw = lines({"Description": "\t  RED  BOX \r\n", "Country": None, "StockCode": " a\x1c"})
    row = cleaning.strip_text(raw).first()
    assert (row.Description, row.Country, row.StockCode) == ("RED  BOX", None, "a")


def test_ids_become_integers_and_fractions_fail(lines):
    assert cleaning.customer_to_integer(lines({})).first().CustomerID == 17850
    with pytest.raises(Exception, match="fractional CustomerID"):
        cleaning.customer_to_integer(lines({"CustomerID": 17850.5})).collect()


def test_derived_columns(lines):
    row = cleaning.clean(lines({"Quantity": 3, "UnitPrice": 0.3335})).first()
    assert row.TotalSalesAmount == Decimal("1.000500")
    assert (row.InvoiceYear, row.InvoiceMonth, row.InvoiceDay) == (2010, 12, 1)
    assert row.DateKey == 20101201


def test_null_profile(lines):
    raw = lines({"Description": None}, {"Description": None, "CustomerID": None}, {})
    found = {r.column_name: r.null_count for r in cleaning.null_profile(raw).collect()}
    assert found["Description"] == 2 and found["CustomerID"] == 1 and found["Country"] == 0


MIXED = [
    {"InvoiceNo": None}, {"CustomerID": None, "Description": None}, {"InvoiceNo": "C9"},
    {"InvoiceNo": "C9"}, {}, {}, {}, {"Quantity": 0}, {"Description": None},
]


def test_audit_closes(lines):
    raw = lines(*MIXED)
    steps = {r.step: (r.rows_in, r.rows_out, r.removed) for r in cleaning.audit(raw).collect()}
    assert steps == {
        "drop_null_keys": (9, 7, 2),
        "drop_duplicates": (7, 4, 3),
        "drop_cancelled": (4, 3, 1),
        "keep_positive": (3, 2, 1),
    }
    assert cleaning.clean(raw).count() == 2


def test_the_condensed_rows_give_the_same_as_the_plain_steps(lines):
    raw = lines(*MIXED)
    rows = cleaning.classify(raw)
    kept = rows.filter(F.col("RowStatus") == cleaning.KEPT).select(CLEAN_COLUMNS)
    assert sorted(map(str, kept.collect())) == sorted(map(str, cleaning.clean(raw).collect()))
    summary = cleaning.batch_summary(rows).first()
    nulls = {r.column_name: r.null_count for r in cleaning.null_profile(raw).collect()}
    assert {c: summary[f"null_{c}"] for c in RAW_COLUMNS} == nulls


def test_a_bad_date_in_a_row_that_a_filter_drops_still_fails_the_batch(lines):
    rows = cleaning.classify(lines({}, {"InvoiceNo": "C1", "InvoiceDate": "yesterday"}))
    summary = cleaning.batch_summary(rows).first()
    with pytest.raises(cleaning.BadBatch, match="bad InvoiceDate"):
        cleaning.check_batch(summary)
    cleaning.check_batch(summary, strict=False)


def test_a_fractional_id_counts_only_in_rows_that_stay(lines):
    dropped = cleaning.classify(lines({"CustomerID": 1.5, "Quantity": 0}, {}))
    cleaning.check_batch(cleaning.batch_summary(dropped).first())
    kept = cleaning.classify(lines({"CustomerID": 1.5}, {}))
    with pytest.raises(cleaning.BadBatch, match="fractional"):
        cleaning.check_batch(cleaning.batch_summary(kept).first())


def test_an_empty_batch_fails(lines, spark):
    rows = cleaning.classify(lines({}).limit(0))
    with pytest.raises(cleaning.BadBatch, match="no rows"):
        cleaning.check_batch(cleaning.batch_summary(rows).first())


@pytest.mark.parametrize(
    "step",
    [cleaning.drop_null_keys, cleaning.drop_exact_duplicates, cleaning.keep_positive,
     cleaning.strip_text, cleaning.drop_cancelled],
)
def test_steps_are_idempotent(lines, step):
    once = step(lines(*MIXED))
    assert sorted(map(str, step(once).collect())) == sorted(map(str, once.collect()))


def test_rejected_rows_name_the_first_broken_rule(lines):
    found = [r.Reason for r in cleaning.rejected_rows(lines(*MIXED)).collect()]
    assert sorted(found) == [
        "cancelled invoice", "cancelled invoice", "missing key column", "missing key column",
        "quantity or price not positive",
    ]


def test_the_date_format_is_the_documented_one():
    assert INVOICE_DATE_FORMAT == "M/d/yyyy H:m"

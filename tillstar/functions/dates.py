"""Date rules."""

from pyspark.sql import functions as F

# Fixed value: the invoice date's text form; takes padded and unpadded fields.
INVOICE_DATE_FORMAT = "M/d/yyyy H:m"

# Names of the zone that has every local time once.
ZONES_WITHOUT_SHIFTS = ["UTC", "Etc/UTC", "GMT", "Z", "+00:00"]

# Weekday names, in report order.
WEEKDAYS = ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"]


def is_bad_date(text):
    """True for a text that is not a date in the expected form; a missing text is not bad."""
    return text.isNotNull() & F.try_to_timestamp(text, F.lit(INVOICE_DATE_FORMAT)).isNull()


def date_or_null(text, spark):
    """As read_date(); NULL for a text that is not a date.

    Where no local time is skipped the moment in the session's zone says both, so a text is read once.
    """
    if spark.conf.get("spark.sql.session.timeZone") in ZONES_WITHOUT_SHIFTS:
        return F.try_to_timestamp(text, F.lit(INVOICE_DATE_FORMAT)).cast("timestamp_ntz")
    return F.when(~is_bad_date(text), read_date(text))


def read_date(text):
    """Timestamp without zone of a text that is known to be a date."""
    return F.to_timestamp_ntz(text, F.lit(INVOICE_DATE_FORMAT))


def parse_invoice_date(text):
    """Timestamp without zone; a bad text fails the job, whatever the ANSI setting."""
    parsed = read_date(text)
    return F.when(
        is_bad_date(text),
        F.raise_error(F.concat(F.lit("bad InvoiceDate: "), text)).cast("timestamp_ntz"),
    ).otherwise(parsed)


def date_key(date):
    """YYYYMMDD as an integer, by arithmetic: no text formatting, no session zone."""
    return (F.year(date) * 10000 + F.month(date) * 100 + F.dayofmonth(date)).cast("int")


def month_of_key(key):
    """YYYYMM of a YYYYMMDD key."""
    return (key / 100).cast("int")


def day_of_key(key):
    """The date of a YYYYMMDD key."""
    return F.make_date((key / 10000).cast("int"), (key / 100).cast("int") % 100, key % 100)


def weekday_rank(name):
    rank = F.lit(None).cast("int")
    for position, weekday in reversed(list(enumerate(WEEKDAYS, start=1))):
        rank = F.when(name == weekday, position).otherwise(rank)
    return rank

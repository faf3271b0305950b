"""Text rules."""

from pyspark.sql import functions as F

# The characters str.strip() takes as whitespace.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# Texts a CSV field may hold that mean "missing".
NULL_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]

# Fixed value: the first character of a cancelled invoice's number.
CANCEL_PREFIX = "C"


def strip(column):
    """Remove whitespace of any kind at both ends.

    btrim looks up every character in the list; most texts need no trim, which their first and
    last characters tell much faster.
    """
    ends = F.substring(column, 1, 1), F.substring(column, -1, 1)
    padded = ends[0].isin(list(WHITESPACE)) | ends[1].isin(list(WHITESPACE))
    return F.when(padded, F.btrim(column, F.lit(WHITESPACE))).otherwise(column)


def null_tokens_to_null(column):
    return F.when(~column.isin(NULL_TOKENS), column)


def is_cancelled(invoice_no):
    """Case-sensitive prefix test; a missing number counts as not cancelled."""
    return F.coalesce(invoice_no.startswith(CANCEL_PREFIX), F.lit(False))


def strict_cast(column, data_type):
    """Cast that fails the job on text that does not convert, whatever the ANSI setting."""
    converted = column.try_cast(data_type)
    return F.when(
        column.isNotNull() & converted.isNull(),
        F.raise_error(F.concat(F.lit(f"cannot read as {data_type}: "), column)).cast(data_type),
    ).otherwise(converted)

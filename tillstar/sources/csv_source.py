"""CSV input."""

from pyspark.errors import AnalysisException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillstar.functions.text import null_tokens_to_null, strict_cast
from tillstar.schemas import MALFORMED_LINE, OPTIONAL_COLUMNS, RAW, RAW_COLUMNS, SOURCE_POSITION

_IRREGULAR = "_irregular_line"
AS_TEXT = T.StructType(
    [T.StructField(f, T.StringType()) for f in [*RAW_COLUMNS, _IRREGULAR]]
)

# Header row, Latin-1, doubled quotes inside quoted fields.
OPTIONS = {
    "header": "true",
    "encoding": "ISO-8859-1",
    "quote": '"',
    "escape": '"',
    "enforceSchema": "false",
    "columnNameOfCorruptRecord": _IRREGULAR,
    # Else a query of few columns would not see that a line has too many fields.
    "columnPruning": "false",
}


class SourceUnavailable(Exception):
    """The input is missing, unreadable or empty; the job stops before any write."""


def malformed(line):
    """Whether a line that has not the expected fields has too many, or an open quote.

    A line with too few is no fault: the fields it lacks are missing. Counted outside of quoted
    parts; a quote that is open in a complete line's last field ends with the line.
    """
    plain = F.regexp_replace(line, '"([^"]|"")*"', "")
    return (F.size(F.split(plain, ",")) > len(RAW_COLUMNS)) | F.contains(plain, F.lit('"'))


def from_text(rows, strict=True):
    """Text fields to the raw schema: missing tokens become NULL.

    Lines that are malformed carry their text in MalformedLine; the load fails a batch with such
    lines or sets them aside. A bad number fails the job; if not strict, or in a line that lacks
    fields, its line counts as malformed.
    """
    fields = {f.name: null_tokens_to_null(F.col(f.name)) for f in RAW}
    numbers = [f for f in RAW if not isinstance(f.dataType, T.StringType)]
    irregular = F.col(_IRREGULAR)
    unread = F.lit(False)
    for f in numbers:
        unread |= fields[f.name].isNotNull() & fields[f.name].try_cast(f.dataType).isNull()
    bad = F.when(irregular.isNotNull() & (malformed(irregular) | unread), irregular)
    if not strict:
        line = F.concat_ws(",", *[F.coalesce(F.col(c), F.lit("")) for c in RAW_COLUMNS])
        bad = F.coalesce(bad, F.when(unread, line))
    columns = []
    for field in RAW:
        value = fields[field.name]
        if field in numbers:
            # Short expressions: they are repeated wherever a later step filters by the column.
            known = value.try_cast(field.dataType)
            if strict:
                known = F.when(
                    irregular.isNull(), strict_cast(value, field.dataType.simpleString())
                ).otherwise(known)
            value = known
        columns.append(value.alias(field.name))
    position = [c for c in rows.columns if c == SOURCE_POSITION]
    return rows.select(*columns, *position, bad.alias(MALFORMED_LINE))


def read_csv(spark, path, multi_line=False, keep_position=True, strict=True):
    """Invoice lines of a CSV file or folder.

    multi_line allows line breaks inside quoted fields, but then a file is one task; leave it
    off for big files (without it, a line break in quotes makes its line malformed). keep_position
    numbers the rows in the order of the files' paths and of the lines in them, so that "first row wins"
    means the first row of the folder, whatever order the files are scanned in.
    """
    try:
        text = (
            spark.read.options(**OPTIONS).option("multiLine", multi_line).schema(AS_TEXT).csv(path)
        )
    except AnalysisException as problem:
        raise SourceUnavailable(f"cannot read {path}: {problem}") from problem
    if keep_position:
        text = _with_position(text, path)
    return from_text(text, strict)


# A position is the number of a stretch of the folder's bytes, above the row's number in its task.
_ROW_BITS = 33
_STRETCHES = 1 << 30
_LEAST_STRETCH = 4096


def _with_position(text, path):
    """Rows with SOURCE_POSITION, a number that grows with the file's path and the place in the file.

    A split of a file is read by one task, in order; the number of the stretch its first byte is in
    puts splits in order. Stretches are counted through the files as sorted by path, about 2 ** 30 of
    them however large the folder is, so that a position stays a long and minima of it fit hash
    aggregates. The only list is that of the files, which the driver holds to plan any scan.
    """
    spark = text.sparkSession
    listed = spark.read.format("binaryFile").load(path).select("_metadata.file_path", "_metadata.file_size")
    files = sorted((r.file_path, r.file_size) for r in listed.collect())
    stretch = max(_LEAST_STRETCH, sum(size for _, size in files) // _STRETCHES + 1)
    first, starts = 0, []
    for name, size in files:
        starts.append((name, first))
        first += size // stretch + 1
    row = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    placed = text.select("*", "_metadata.file_path", "_metadata.file_block_start", row.alias("_row"))
    if len(starts) > 1:
        table = spark.createDataFrame(starts, "file_path string, _first long")
        placed = placed.join(F.broadcast(table), "file_path", "left")
    else:
        placed = placed.withColumn("_first", F.lit(0).cast("long"))
    place = F.col("_first") + F.floor(F.col("file_block_start") / stretch)
    return placed.select(*text.columns, (F.shiftleft(place, _ROW_BITS) + F.col("_row")).alias(SOURCE_POSITION))


def source_profile(raw):
    """Row count, column count and column names of a source, as one row."""
    names = [c for c in raw.columns if c not in OPTIONAL_COLUMNS]
    return raw.agg(
        F.count(F.lit(1)).alias("row_count"),
        F.lit(len(names)).alias("column_count"),
        F.lit(",".join(names)).alias("column_names"),
    )

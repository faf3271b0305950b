"""An index of the rows a warehouse has taken: what of a batch can be a copy of a published fact.

The index is a Bloom filter over the facts' row hashes, kept as a table: a hash names a 64-bit word
of its month and BITS bits of that word. Every load writes the words of the facts it adds; a word
is one aggregated row for ROWS_A_WORD hashes or fewer, on average, of one load and month. So a
filter never has to grow: a large month has more words (Scale is the logarithm of their number), and
each load's words are asked for themselves.

A row whose bits are not all in one word of any load was never loaded. What is left, the copies and
about one in a hundred others, is looked up exactly, in the months of these rows alone.
"""

from pyspark.sql import functions as F

from tillstar.functions import dates
from tillstar.operators.lookup import broadcast_rows, is_small, written_once
from tillstar.schemas import FACT_INDEX, ROW_HASH

BITS = 4
ROWS_A_WORD = 4
# What a copy shares with its fact: the hash of its untouched columns, and what a fact keeps as it was.
SAME = [ROW_HASH.name, "InvoiceNo", "DateKey", "Quantity"]


def _mask():
    """The bits of a row within its word, from a second hash: the first one names the word."""
    again = f"xxhash64({ROW_HASH.name})"
    bits = [f"shiftleft(1L, cast(shiftrightunsigned({again}, {6 * i}) & 63 AS int))" for i in range(BITS)]
    return F.expr(" | ".join(bits))


def _word(scale="Scale"):
    return F.expr(f"{ROW_HASH.name} & (shiftleft(1L, {scale}) - 1)")


def words_of(rows):
    """The index of rows with a hash and a DateKey.

    The words are counted by month first, as a month's rows decide how many it needs. That is one
    number a month, so broadcast; the words themselves are united map-side, then by (month, word).
    """
    hashes = rows.select(dates.month_of_key(F.col("DateKey")).alias("SalesMonth"), ROW_HASH.name)
    hashes = hashes.dropna()
    scale = F.greatest(F.lit(0), F.ceil(F.log2(F.col("n") / ROWS_A_WORD))).cast("int")
    sizes = hashes.groupBy("SalesMonth").agg(F.count(F.lit(1)).alias("n"))
    scaled = hashes.join(F.broadcast(sizes.select("SalesMonth", scale.alias("Scale"))), "SalesMonth")
    words = scaled.select("SalesMonth", "Scale", _word().alias("Word"), _mask().alias("Mask"))
    united = words.groupBy("SalesMonth", "Scale", "Word").agg(F.bit_or("Mask").alias("Mask"))
    return united.select(FACT_INDEX.fieldNames()).hint("rebalance", "SalesMonth")


def possible_copies(rows, index, months, size):
    """Month and hash of the rows that the index may hold, each once.

    size: at most how many rows there are. So many that the broadcast bound allows it: the rows are
    broadcast and the index of their months is only scanned. Beyond, both are shuffled by (month,
    word), which are spread evenly whatever the rows; of a row no more than month, scale and hash, as
    its word and bits follow from these.
    """
    asked = rows.select(dates.month_of_key(F.col("DateKey")).alias("SalesMonth"), ROW_HASH.name)
    index = index.filter(F.col("SalesMonth").isin(months))
    # Two numbers for each month and power of two that a load of it had.
    scales = index.select("SalesMonth", "Scale").distinct()
    probes = asked.join(F.broadcast(scales), "SalesMonth")
    probes = probes.select(F.col("SalesMonth").alias("_month"), F.col("Scale").alias("_scale"), ROW_HASH.name)
    if size <= broadcast_rows(rows.sparkSession):
        probes = F.broadcast(probes.distinct())
    same_word = (F.col("SalesMonth") == F.col("_month")) & (F.col("Scale") == F.col("_scale")) & (F.col("Word") == _word("_scale"))
    met = index.join(probes, same_word)
    held = met.filter(F.col("Mask").bitwiseAND(_mask()) == _mask())
    return held.select("SalesMonth", ROW_HASH.name).distinct()


def not_loaded(rows, fact, possible):
    """Rows that are not copies of published facts. possible: a written table of possible_copies().

    Without possible copies, no fact is read at all. Otherwise the facts of their months are, and
    if they are few, only those with their hashes go on to the comparison: as few, so broadcast, and
    the rows stay where they are. If few rows are left beside the possible copies, as of a batch that
    comes again, what is new is told by what a copy shares alone; as long as that is few as well,
    it is broadcast, and the rows stay where they are too.
    """
    bound = broadcast_rows(rows.sparkSession)
    months = [r.SalesMonth for r in possible.select("SalesMonth").distinct().collect()]
    if not months:
        return rows
    known = fact.filter(F.col("SalesMonth").isin(sorted(months))).select(SAME)
    copies = possible.count()
    if copies <= bound:
        known = F.broadcast(known.join(F.broadcast(possible.select(ROW_HASH.name)), ROW_HASH.name, "left_semi"))
    elif rows.count() - copies <= bound:
        new = written_once(rows.select(SAME).join(known, SAME, "left_anti").distinct())
        if is_small(new):
            return rows.join(F.broadcast(new), SAME, "left_semi")
    return rows.join(known, SAME, "left_anti")

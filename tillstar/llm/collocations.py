"""Phrase collocations from a weighted de Bruijn graph of word sequences.

Texts are lower-cased (A-Z), cut into pieces at `.,;:!?` and line ends, and pieces into words. The
graph's edges are the longest grams: every word occurrence starts one, of ORDER words or as many as
are left of its piece. An edge of fewer words is the correction for a piece's end. An edge's weight
flows through every node it begins with, so the counts of all shorter phrases are sums of edge
weights, and the texts are not read again for them. A node whose whole flow comes in or goes out
over one longer node is inside a unary path; compaction removes it in favour of the longer one.
`paths()` joins the edges of unary paths into phrases longer than ORDER words.

Only phrases of at least `least` occurrences matter, and a phrase has no more than any part of it.
So a first pass counts pairs of neighbouring words by a 64-bit hash and keeps the frequent ones as a
bitmap of 2 ** PLACE_BITS bits; edges are cut short where a pair is not in it. Hashes that meet only
make edges longer, never counts wrong: all counts are of whole words. Neither the bitmap nor
anything else that is broadcast grows with the corpus.

Defined results: null and empty texts have no words; a null language is "und"; repeated rows
count as often as they are there; other columns are ignored. An empty table has no phrases. Texts
are worked through in blocks, so very long ones need no more memory.
"""

import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Window
from pyspark.sql import functions as F

from tillstar.llm.common import written

ORDER = 5
LEAST = 100
TOP = 2_000
# A phrase goes if a longer one around it has at least this percentage of its occurrences.
COVER = 100
PLACE_BITS = 27
BLOCK_BYTES = 4_000_000
NO_LANGUAGE = "und"

_END = re.compile(rb"[\x20\x09.,;:!?\x0A-\x0D]")
_WORD, _BLANK, _BREAK = 0, 1, 2
_KINDS = np.zeros(256, np.uint8)
_KINDS[[0x20, 0x09]] = _BLANK
_KINDS[[*b".,;:!?", 0x0A, 0x0B, 0x0C, 0x0D]] = _BREAK
_MIX = np.uint64(0x9E3779B97F4A7C15)
_BASE = np.uint64(0x100000001B3)


def _mixed(hashes):
    hashes = hashes ^ (hashes >> np.uint64(31))
    hashes = hashes * _MIX
    return hashes ^ (hashes >> np.uint64(29))


def _blocks(text, order):
    """(bytes, own): parts of a text of bounded size. Edges start in the first `own` bytes; what
    follows are the words that the last edges need."""
    data = text.encode().lower()
    ahead = re.compile(rb"(?:[\x20\x09]*[^\x20\x09.,;:!?\x0A-\x0D]+){0,%d}" % (order - 1))
    start = 0
    while start < len(data):
        found = _END.search(data, start + BLOCK_BYTES)
        end = found.start() if found else len(data)
        yield data[start : ahead.match(data, end).end()], end - start
        start = end


class _Words:
    """The words of some blocks, as arrays."""

    def __init__(self, blocks, lang):
        data = np.frombuffer(b"\n".join(b for b, _ in blocks) + b"\n", np.uint8)
        kinds = _KINDS[data]
        inside = kinds == _WORD
        edge = np.diff(inside.view(np.int8), prepend=0)
        starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        # Each word's bytes and one blank.
        keep = inside.copy()
        keep[ends] = True
        self.flat = np.where(inside, data, 32).astype(np.uint8)[keep]
        lengths = ends - starts + 1
        self.at = np.concatenate([[0], np.cumsum(lengths)])
        pieces = np.cumsum(kinds == _BREAK)[starts]
        sizes = np.array([len(b) + 1 for b, _ in blocks])
        first = np.cumsum(sizes) - sizes
        block = np.searchsorted(first, starts, side="right") - 1
        self.own = starts - first[block] < np.array([own for _, own in blocks])[block]
        # Whether a word goes on in the next one.
        self.joined = np.append(pieces[1:] == pieces[:-1], False) if len(pieces) else np.zeros(0, bool)
        self.lang = lang

    def pair_hashes(self):
        """A hash of each word and the next, of the language too."""
        if not len(self.own):
            return np.zeros(0, np.uint64)
        place = np.arange(len(self.flat)) - np.repeat(self.at[:-1], np.diff(self.at))
        powers = np.cumprod(np.full(int(place.max()) + 1, _BASE))
        word = _mixed(np.add.reduceat(self.flat.astype(np.uint64) * powers[place], self.at[:-1]))
        name = self.lang.encode()
        salt = np.uint64(int.from_bytes(name[:8].ljust(8, b"\0"), "little") ^ (len(name) << 56))
        return _mixed(word * _BASE + np.roll(word, -1) + _mixed(np.array([salt]))[0])

    def edges(self, goes_on, order):
        """The longest gram that starts at each own word, as an Arrow array of strings."""
        count = len(self.own)
        ahead, alive = np.ones(count, np.int64), np.ones(count, bool)
        goes_on = np.append(goes_on, np.zeros(order, bool))
        for step in range(order - 1):
            alive &= goes_on[step : step + count]
            ahead += alive
        begin = np.flatnonzero(self.own)
        start, stop = self.at[begin], self.at[begin + ahead[begin]] - 1
        lengths = stop - start
        offsets = np.concatenate([[0], np.cumsum(lengths)])
        source = np.repeat(start - offsets[:-1], lengths) + np.arange(offsets[-1])
        values = self.flat[source]
        return pa.LargeStringArray.from_buffers(
            len(begin), pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(values)
        )


def _by_language(batches, order):
    """_Words of all texts, some of one language at a time, of bounded size."""
    waiting, size = {}, 0
    for batch in batches:
        for text, lang in zip(batch.column(0), batch.column(1), strict=True):
            for block in _blocks(text.as_py(), order):
                waiting.setdefault(lang.as_py(), []).append(block)
                size += len(block[0])
                if size >= BLOCK_BYTES:
                    yield from (_Words(blocks, name) for name, blocks in waiting.items())
                    waiting, size = {}, 0
    yield from (_Words(blocks, name) for name, blocks in waiting.items())


def _texts(df, text, lang):
    return df.select(
        F.col(text).alias("text"), F.coalesce(F.col(lang), F.lit(NO_LANGUAGE)).alias("lang")
    ).filter(F.col("text").isNotNull())


def frequent_pairs(texts, least, order=ORDER):
    """Bitmap of the hashes of word pairs that occur at least so often, and maybe of others."""

    def count(batches):
        for words in _by_language(batches, order):
            pairs = words.pair_hashes()[words.joined & words.own]
            found, n = np.unique(pairs, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(found.view(np.int64)), pa.array(n)], ["pair", "n"])

    counted = texts.mapInArrow(count, "pair bigint, n bigint").groupBy("pair").agg(F.sum("n").alias("n"))
    # Spark numbers the bits of a bitmap from 1.
    place = F.shiftrightunsigned("pair", 64 - PLACE_BITS) + 1
    # Parts of 4 KB, so that what reaches the driver is the bitmap itself.
    parts = (
        counted.filter(F.col("n") >= least)
        .groupBy(F.bitmap_bucket_number(place).alias("part"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("bits"))
        .collect()
    )
    bitmap = np.zeros((1 << PLACE_BITS) // 8, np.uint8)
    for row in parts:
        start = (row.part - 1) * 4096
        bitmap[start : start + 4096] = np.frombuffer(row.bits, np.uint8)
    return bitmap


def edges(texts, bitmap, order=ORDER):
    """(lang, gram, n): the weighted edges of the graph, cut where a pair is not in the bitmap."""
    shared = texts.sparkSession.sparkContext.broadcast(bitmap)

    def emit(batches):
        bits = shared.value
        for words in _by_language(batches, order):
            place = (words.pair_hashes() >> np.uint64(64 - PLACE_BITS)).astype(np.int64)
            known = (bits[place >> 3] >> (place & 7).astype(np.uint8)) & 1
            counted = pc.value_counts(words.edges(words.joined & known.astype(bool), order))
            if len(counted):
                gram = counted.field("values").cast(pa.string())
                lang = pa.array([words.lang] * len(gram), pa.string())
                yield pa.RecordBatch.from_arrays([lang, gram, counted.field("counts")], ["lang", "gram", "n"])

    rows = texts.mapInArrow(emit, "lang string, gram string, n bigint")
    return rows.groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def _part(words, start, length):
    return F.array_join(F.slice(words, start, length), " ")


def flows(graph):
    """(lang, phrase, f) of every phrase: the weights of all edges that begin with it."""
    words = F.split("gram", " ")
    begun = F.transform(F.sequence(F.lit(1), F.size(words)), lambda k: _part(words, F.lit(1), k))
    nodes = graph.select("lang", "n", F.explode(begun).alias("phrase"))
    return nodes.groupBy("lang", "phrase").agg(F.sum("n").alias("f"))


def compact(nodes, cover=COVER):
    """Phrases of two words or more that no longer phrase covers.

    It is enough to look one word further: a phrase occurs at least as often as any longer one
    around it.
    """
    words = F.split("phrase", " ")
    size = F.size(words)
    inner = F.array(_part(words, F.lit(1), size - 1), _part(words, F.lit(2), size - 1))
    around = (
        nodes.filter(size > 2)
        .select("lang", F.explode(inner).alias("phrase"), F.col("f").alias("longer"))
        .groupBy("lang", "phrase")
        .agg(F.max("longer").alias("longer"))
    )
    left = nodes.filter(size > 1).join(around, ["lang", "phrase"], "left")
    covered = F.coalesce(F.lit(100) * F.col("longer") >= F.lit(cover) * F.col("f"), F.lit(False))
    return left.filter(~covered).drop("longer")


def scored(phrases, nodes, totals):
    """Phrases with the parts l and r of the cut that scores lowest, and that score.

    The products are decimals of 38 digits, exact up to 10 ** 17 words a language.
    """
    words = F.split("phrase", " ")
    size = F.size(words)
    cut = phrases.select(
        "lang", "phrase", F.col("f").alias("a"), size.alias("size"),
        F.explode(F.sequence(F.lit(1), size - 1)).alias("k"),
    )
    first = nodes.select("lang", F.col("phrase").alias("first"), F.col("f").alias("l"))
    rest = nodes.select("lang", F.col("phrase").alias("rest"), F.col("f").alias("r"))
    cut = (
        cut.withColumns({"first": _part(words, F.lit(1), F.col("k")), "rest": _part(words, F.col("k") + 1, F.col("size") - F.col("k"))})
        .join(first, ["lang", "first"])
        .join(rest, ["lang", "rest"])
        .join(totals, "lang")
    )
    score = F.expr(
        "(CAST(1000 AS DECIMAL(4,0)) * CAST(a AS DECIMAL(17,0)) * CAST(n AS DECIMAL(17,0)))"
        " div (CAST(l AS DECIMAL(19,0)) * CAST(r AS DECIMAL(19,0)))"
    )
    cut = cut.withColumn("score", score)
    lowest = F.min(F.struct("score", "k", "l", "r")).alias("lowest")
    return cut.groupBy("lang", "phrase", "a", "n").agg(lowest).select("lang", "phrase", "a", "lowest.l", "lowest.r", "n", "lowest.score")


def graph_of(df, text="text", lang="lang", least=LEAST, order=ORDER):
    """The nodes that occur often enough, and the number of words, by language: (nodes, totals)."""
    texts = _texts(df, text, lang)
    graph = written(edges(texts, frequent_pairs(texts, least, order), order), "edges")
    totals = graph.groupBy("lang").agg(F.sum("n").alias("n"))
    return written(flows(graph).filter(F.col("f") >= least), "nodes"), totals


def mine(df, text="text", lang="lang", least=LEAST, order=ORDER, top=TOP, cover=COVER):
    """(lang, rank, phrase, a, l, r, n, score): each language's best collocations.

    By score, then occurrences, then the phrase's bytes; `top` is the length of the report.
    """
    nodes, totals = graph_of(df, text, lang, least, order)
    found = scored(compact(nodes, cover), nodes, totals)
    best = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= top)
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def paths(nodes, order=ORDER):
    """(lang, phrase, f): the frequent edges, those of a unary path joined into one long phrase.

    Two edges belong to one path if the node between them passes the whole weight of one on to the
    other. Places on paths are found by pointer doubling: a path of m edges takes log2(m) joins.
    Edges on a circle of equal weights stay as they are.
    """
    words = F.split("phrase", " ")
    long_edges = nodes.filter(F.size(words) == order).select(
        "lang", "phrase", "f",
        _part(words, F.lit(1), F.lit(order - 1)).alias("tail"),
        _part(words, F.lit(2), F.lit(order - 1)).alias("head"),
    )
    through = nodes.select("lang", F.col("phrase").alias("node"), F.col("f").alias("flow"))
    enters = long_edges.select("lang", F.col("head").alias("node"), F.col("phrase").alias("before"), "f")
    leaves = long_edges.select("lang", F.col("tail").alias("node"), F.col("phrase").alias("phrase"), F.col("f").alias("out"))
    links = (
        through.join(enters.withColumnRenamed("f", "in"), ["lang", "node"])
        .join(leaves, ["lang", "node"])
        .filter((F.col("in") == F.col("flow")) & (F.col("out") == F.col("flow")))
        .select("lang", "phrase", "before")
    )
    # root: the furthest edge before this one found so far; steps: how far that is.
    at = long_edges.select("lang", "phrase", "f").join(links, ["lang", "phrase"], "left").select(
        "lang", "phrase", "f", F.coalesce("before", "phrase").alias("root"),
        F.when(F.col("before").isNull(), 0).otherwise(1).cast("long").alias("steps"),
    )
    at = written(at, "paths")
    # No path is longer than the number of edges; on a circle the doubling ends there.
    for _ in range(at.count().bit_length()):
        jump = at.select("lang", F.col("phrase").alias("root"), F.col("root").alias("further"), F.col("steps").alias("more"))
        if at.join(jump.filter("more > 0"), ["lang", "root"], "left_semi").isEmpty():
            break
        at = at.join(jump, ["lang", "root"]).select(
            "lang", "phrase", "f", F.col("further").alias("root"), (F.col("steps") + F.col("more")).alias("steps")
        )
        at = written(at, "paths")
    roots = at.filter("steps = 0").select("lang", F.col("phrase").alias("root"), F.lit(True).alias("is_root"))
    placed = at.join(roots, ["lang", "root"], "left")
    circle = placed.filter("is_root IS NULL").select("lang", "phrase", "f")
    lasts = F.transform(F.array_sort(F.collect_list(F.struct("steps", F.element_at(words, -1).alias("last")))), lambda x: x["last"])
    joined = (
        placed.filter("is_root")
        .groupBy("lang", "root")
        .agg(lasts.alias("lasts"), F.max("f").alias("f"))
        .select("lang", F.concat_ws(" ", F.split("root", " "), F.slice("lasts", 2, 1 << 30)).alias("phrase"), "f")
    )
    return joined.unionByName(circle)

"""Toxicity by class-conditional Kneser-Ney models.

Two models, of toxic and of ordinary texts, spell words letter by letter. In the context of a word's
letters so far each class takes DISCOUNT off the number of its texts that go on in some way, and
gives what that frees to the distribution of both classes together. That shared one is Kneser-Ney
itself: it backs off to the number of contexts a letter goes on in. So an expression that only a few
toxic texts hold counts as likely in both classes, and an unseen word is judged by how it begins.

A word's log-likelihood ratio is the sum over its letters; up to MARGIN it is taken for the noise of
the counts and for the share of a language in a class. What is beyond, per word of the text, is the
length-normalised difference of the log-likelihoods; a logistic curve over its logarithm, fitted to
at most about FIT_ROWS labelled rows, makes it the score.

Counts are numbers of texts (a text counts a word once, so repeated lines weigh nothing) over all labelled
rows; they are tables, joined and summed by Spark, and so are the models. Scoring needs only the
nodes where the excess may be positive, and those below them; these are broadcast up to
BROADCAST_NODES of them, and beyond that words are looked up by joins.

Defined results: null and empty texts, and texts without letters, have no excess and the least score;
words of more than WORD_CHARS letters count as several; without rows of both classes every score is
0. Of rows that repeat an id all train; an id that is labelled both toxic and not counts in both.
Equal texts have equal scores, whatever the layout. Other columns are carried along.
"""

import math
import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillstar.llm.common import map_rows, sampled, written

DISCOUNT = 3.0
SHARED_DISCOUNT = 0.75
MARGIN = 2.0
WORD_CHARS = 24
FIT_ROWS = 20_000
PREDICT_FROM = 0.5
BROADCAST_NODES = 1_000_000
# Words of 64 bits of the filter of labelled ids, and bits an id sets: a fixed size, however many labels.
FILTER_WORDS, FILTER_BITS = 1 << 18, 4
# Evidence below this, per word, is none.
LEAST_EVIDENCE = 1e-4
# Closes every word; no letter.
END = "$"
BLOCK_CHARS = 1_000_000
KNOWN_WORDS = 200_000

_LETTERS = re.compile(r"[^\W\d_]+")


@dataclass
class Model:
    """nodes: (node, excess) where a word's way through the models may end. slope, level: of the
    logistic curve. nodes is None without both classes."""

    nodes: DataFrame | None
    slope: float
    level: float


def words_of(text):
    """Number of times each word of a text is there, long words in parts, each closed by END."""
    found, data, start = Counter(), text or "", 0
    while start < len(data):
        end = start + BLOCK_CHARS
        while end < len(data) and data[end].isalpha() and end < start + 2 * BLOCK_CHARS:
            end += 1
        found.update(_LETTERS.findall(data[start:end].lower()))
        start = end
    for word in [w for w in found if len(w) > WORD_CHARS]:
        n = found.pop(word)
        for at in range(0, len(word), WORD_CHARS):
            found[word[at : at + WORD_CHARS]] += n
    return {w + END: n for w, n in found.items()}


def word_counts(df):
    """(word, toxic, ordinary): in how many texts of each class a word is, of (text, toxic) rows."""

    def count(batches):
        for batch in batches:
            seen = (Counter(), Counter())
            for text, toxic in zip(batch.column(0), batch.column(1), strict=True):
                seen[toxic.as_py()].update(words_of(text.as_py()).keys())
            words = list(seen[0] | seen[1])
            counts = [pa.array([seen[k][w] for w in words], pa.int64()) for k in (1, 0)]
            yield pa.RecordBatch.from_arrays([pa.array(words, pa.string()), *counts], ["word", "toxic", "ordinary"])

    rows = df.mapInArrow(count, "word string, toxic bigint, ordinary bigint")
    return rows.groupBy("word").agg(F.sum("toxic").alias("toxic"), F.sum("ordinary").alias("ordinary"))


def _beginnings(column, least=0):
    """All first parts of a text, from `least` characters to the whole."""
    return F.transform(F.sequence(F.lit(least), F.char_length(column)), lambda n: F.substring(column, F.lit(1), n))


def tree(counted):
    """(node, toxic, ordinary): the counts of all beginnings of words."""
    nodes = counted.select(F.explode(_beginnings(F.col("word"))).alias("node"), "toxic", "ordinary")
    return nodes.groupBy("node").agg(F.sum("toxic").alias("toxic"), F.sum("ordinary").alias("ordinary"))


def _class_share(n, context, freed, shared):
    """A letter's probability in a class; without its context, the shared one."""
    known = (F.greatest(n - DISCOUNT, F.lit(0.0)) + freed * shared) / context
    return F.when(context > 0, known).otherwise(shared)


def steps_of(nodes):
    """(node, parent, core, step, unseen): what the last letter of a node, in a context that more than
    DISCOUNT toxic texts hold, adds to the log-likelihood ratio; and what an unseen letter adds
    after the parent. core: whether the node is such a context itself.

    In rarer contexts both classes take the shared distribution, so there is nothing to add.
    """
    letter = F.substring("node", -1, 1)
    inner = nodes.filter("node != ''").withColumns({
        "parent": F.expr("left(node, char_length(node) - 1)"), "letter": letter, "both": F.col("toxic") + F.col("ordinary")
    })
    contexts = inner.groupBy("parent").agg(
        F.sum("toxic").alias("in_toxic"), F.sum("ordinary").alias("in_ordinary"),
        F.sum(F.least("toxic", F.lit(DISCOUNT))).alias("freed_toxic"),
        F.sum(F.least("ordinary", F.lit(DISCOUNT))).alias("freed_ordinary"),
        F.count(F.lit(1)).alias("kinds"),
    ).filter(F.col("in_toxic") > DISCOUNT)
    # In how many contexts a letter follows: as many rows as there are letters.
    follows = inner.groupBy("letter").agg(F.count(F.lit(1)).alias("contexts"))
    met = inner.join(contexts, "parent").join(follows, "letter")
    # All pairs of a context and a letter that follows: the nodes themselves.
    back = F.col("contexts") / F.lit(max(1, inner.count()))
    shared = (F.col("both") - SHARED_DISCOUNT + SHARED_DISCOUNT * F.col("kinds") * back) / (F.col("in_toxic") + F.col("in_ordinary"))
    toxic = _class_share(F.col("toxic"), F.col("in_toxic"), F.col("freed_toxic"), shared)
    ordinary = _class_share(F.col("ordinary"), F.col("in_ordinary"), F.col("freed_ordinary"), shared)
    unseen = F.log(F.col("freed_toxic") / F.col("in_toxic")) - F.when(
        F.col("in_ordinary") > 0, F.log(F.col("freed_ordinary") / F.col("in_ordinary"))
    ).otherwise(0.0)
    return met.select(
        "node", "parent", ((F.col("toxic") > DISCOUNT) & (F.col("letter") != END)).alias("core"),
        (F.log(toxic) - F.log(ordinary)).alias("step"), unseen.alias("unseen"),
    )


def ratios(steps):
    """(node, ratio): the log-likelihood ratio of words whose way through the models ends at the node.

    At a core node that is with an unseen letter next. Cold nodes are only there below hot ones,
    to say where a way ends; all others have a ratio of MARGIN at most.
    """
    ways = steps.select("node", "parent", "core", F.explode(_beginnings(F.col("node"), 1)).alias("on_way"))
    added = steps.select(F.col("node").alias("on_way"), "step")
    # Rounded, so that the order of the sums does not show.
    total = ways.join(added, "on_way").groupBy("node", "parent", "core").agg(F.round(F.sum("step"), 9).alias("sum"))
    after = steps.groupBy(F.col("parent").alias("node")).agg(F.first("unseen").alias("unseen"))
    ended = total.join(after, "node", "left").select(
        "node", "parent", (F.col("sum") + F.when(F.col("core"), F.col("unseen")).otherwise(0.0)).alias("ratio"),
        F.col("core"),
    )
    hot = F.col("ratio") > MARGIN
    below = ended.filter(hot & F.col("core")).select(F.col("node").alias("parent"))
    return ended.filter(hot).select("node", "ratio").unionByName(
        ended.filter(~hot).join(below, "parent", "left_semi").select("node", "ratio")
    )


def _finder(nodes):
    """A function from a word to its excess, by the deepest node on its way."""
    known = {}

    def excess(word):
        found = known.get(word)
        if found is None:
            found = 0.0
            for end in range(len(word), 0, -1):
                ratio = nodes.get(word[:end])
                if ratio is not None:
                    found = max(0.0, ratio - MARGIN)
                    break
            if len(known) >= KNOWN_WORDS:
                known.clear()
            known[word] = found
        return found

    return excess


def evidence_of(text, excess):
    """Excess per word of a text."""
    words = words_of(text)
    total = math.fsum(n * excess(w) for w, n in words.items())
    return total / max(1, sum(words.values()))


def with_evidence(df, nodes, text, keep=None, bound=BROADCAST_NODES):
    """Rows with `evidence`."""
    if nodes.count() > bound:
        return _evidence_by_joins(df, nodes, text, keep)
    table = dict(zip(*nodes.toArrow().to_pydict().values(), strict=True))
    shared = df.sparkSession.sparkContext.broadcast(table)

    def make():
        excess = _finder(shared.value)
        return lambda texts: [[evidence_of(t, excess) for t in texts.to_pylist()]]

    return map_rows(df, [F.col(text)], make, {"evidence": "double"}, keep)


def _evidence_by_joins(df, nodes, text, keep):
    """The same for any number of nodes: words of the texts meet the nodes in shuffles.

    Words are summed up to the distinct ones before they are looked up. A word that many texts hold
    is one row a text, which Spark's skewed joins split.
    """
    keep = df.columns if keep is None else keep
    rows = df.select(F.struct(*[F.col(f"`{c}`") for c in keep]).alias("row"), F.col(text).alias("text"))
    rows = written(rows.withColumn("at", F.monotonically_increasing_id()), "texts")

    def make():
        def work(texts):
            found = [words_of(t) for t in texts.to_pylist()]
            return [[list(w) for w in found], [list(w.values()) for w in found]]

        return work

    listed = map_rows(rows, [F.col("text")], make, {"words": "array<string>", "times": "array<bigint>"}, keep=["at"])
    uses = listed.select("row.at", F.explode(F.arrays_zip("words", "times")).alias("use")).select("at", "use.words", "use.times")
    uses = written(uses.withColumnRenamed("words", "word"), "uses")
    ways = uses.select("word").distinct().select("word", F.explode(_beginnings(F.col("word"), 1)).alias("node"))
    met = ways.join(nodes, "node").groupBy("word").agg(F.max_by("ratio", F.char_length("node")).alias("ratio"))
    hits = written(met.filter(F.col("ratio") > MARGIN), "hits")
    found = uses.join(hits, "word", "left").groupBy("at").agg(
        (F.sum(F.col("times") * F.greatest(F.col("ratio") - MARGIN, F.lit(0.0))) / F.sum("times")).alias("evidence")
    )
    return rows.join(found, "at", "left").select("row", F.coalesce("evidence", F.lit(0.0)).alias("evidence"))


def curve(evidence, toxic):
    """Slope and level of a logistic curve over the logarithm of the evidence, by Newton steps.

    Slightly towards a flat curve, so that there is one for separable rows too.
    """
    x = _logarithm(np.asarray(evidence))
    y = np.asarray(toxic, float)
    weight = np.full(len(y), 1 / len(y))
    w, pull = np.zeros(2), np.array([1e-3, 1e-6])
    rows = np.stack([x, np.ones(len(x))], axis=1)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(rows @ w, -30, 30)))
        slope = rows.T @ (weight * (p - y)) + pull * w
        bend = (rows * (weight * p * (1 - p))[:, None]).T @ rows + np.diag(pull)
        w = w - np.clip(np.linalg.solve(bend, slope), -2, 2)
    return float(max(w[0], 0.0)), float(w[1])


def _logarithm(evidence):
    return np.log((evidence + LEAST_EVIDENCE) / LEAST_EVIDENCE)


def _filter_bits():
    """The bits of an id within its word of the filter."""
    place = "xxhash64(doc_id, 1)"
    return F.expr(" | ".join(f"shiftleft(1L, cast(shiftrightunsigned({place}, {6 * i}) & 63 AS int))" for i in range(FILTER_BITS)))


def may_be_marked(docs, marked):
    """Documents without most of those whose id has no mark: a Bloom filter of the marked ids is
    broadcast. More ids than it is made for let more documents through, and lose none."""
    word = F.pmod(F.xxhash64("doc_id"), F.lit(FILTER_WORDS)).alias("_word")
    words = marked.filter("doc_id IS NOT NULL").groupBy(word).agg(F.bit_or(_filter_bits()).alias("_bits"))
    met = docs.withColumn("_word", word).join(F.broadcast(words), "_word")
    return met.filter(F.col("_bits").bitwiseAND(_filter_bits()) == _filter_bits()).select(docs.columns)


def train(docs, labels, text="text", fit_rows=FIT_ROWS):
    """A model from labelled documents."""
    marked = labels.filter(F.col("toxic").isin(0, 1)).select("doc_id", F.col("toxic").cast("int").alias("toxic")).distinct()
    rows = docs.select("doc_id", F.col(text).alias("text"))
    if docs.schema["doc_id"].dataType == marked.schema["doc_id"].dataType:
        # Texts are long, and few have a mark: the others are not shuffled.
        rows = may_be_marked(rows, marked)
    rows = rows.join(marked, "doc_id")
    counted = written(word_counts(rows.select("text", "toxic")), "words")
    nodes = written(tree(counted), "tree")
    table = written(ratios(written(steps_of(nodes), "steps")), "ratios")
    sizes = {r["toxic"]: r["count"] for r in rows.groupBy("toxic").count().collect()}
    if len(sizes) < 2:
        return Model(None, 0.0, 0.0)
    chosen = sampled(rows, fit_rows / sum(sizes.values()), 11, "doc_id", "text")
    found = with_evidence(chosen.select("text", "toxic"), table, "text", keep=["toxic"]).select("row.toxic", "evidence").toArrow()
    pairs = sorted(zip(found["evidence"].to_pylist(), found["toxic"].to_pylist(), strict=True))
    if len({toxic for _, toxic in pairs}) < 2:
        return Model(table, 1.0, -1.0)
    return Model(table, *curve(*zip(*pairs, strict=True)))


def score(df, model, text="text", keep=None, bound=BROADCAST_NODES):
    """Rows with `score`, from 0 to 1, and `evidence`."""
    keep = df.columns if keep is None else keep
    if model.nodes is None:
        rows = df.select(F.struct(*[F.col(f"`{c}`") for c in keep]).alias("row"))
        return rows.withColumns({"score": F.lit(0.0), "evidence": F.lit(0.0)})
    found = with_evidence(df, model.nodes, text, keep, bound)
    x = F.log((F.col("evidence") + LEAST_EVIDENCE) / LEAST_EVIDENCE)
    return found.withColumn("score", 1 / (1 + F.exp(-(F.lit(model.slope) * x + F.lit(model.level)))))

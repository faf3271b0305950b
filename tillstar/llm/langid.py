"""Language identification by language-bitmask n-gram filters.

Training finds the character n-grams of each language and sets, for every n-gram, the bits of its
languages in a bit-sliced Bloom filter: an array of bitmasks for every 64 languages, a bit per
language, so that the AND of the masks at an n-gram's places gives all languages that may contain it. For a text the
set bits are counted per language, the hits expected from false positives are taken off, and the
language with most hits left decides.

Training uses a sample of at most about SAMPLE_ROWS rows of each language, chosen by a hash of the id
and text, so the model is the same whatever the layout; the same rates decide at every size. Prediction reads whole texts. The filter's size does not
grow with the rows: 2 ** PLACE_BITS masks of 8 bytes are broadcast for every 64 languages.

Defined results: a null text, or one without a letter, is "und" with score 0; a text none of whose
n-grams is known gets the language with most training rows, score 0; ties go to the language with
more training rows, then by name. Rows without language or text don't train; without languages every text is "und". Other
columns are carried along. The names of the languages and their row counts are held by the driver.
"""

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from tillstar.llm.common import map_rows, sampled, written

GRAM = 4
PLACE_BITS = 20
HASHES = 3
SAMPLE_ROWS = 2_000
# A language holds an n-gram if its rate there is at least this share of its highest rate.
SHARE_OF_HIGHEST = 0.25
# And if it is in at least this share of the language's sampled rows.
LEAST_RATE = 0.001
PIECE_CHARS = 200_000
MASK_BITS = 64
UNKNOWN = "und"

_MIX = np.uint64(0x9E3779B97F4A7C15)
_FACTORS = np.array([0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD6E8FEB86659FD93], np.uint64)
_letters = None


@dataclass
class Model:
    languages: list
    masks: np.ndarray
    false_rates: np.ndarray
    # The masks of the languages after the first 64, for every 64 an array.
    more: list


def _letter_table():
    """For each code point whether it is a letter, once per worker."""
    global _letters
    if _letters is None:
        _letters = np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)
    return _letters


def has_letter(text):
    return any(map(str.isalpha, text))


def grams(pieces):
    """Hashes of the n-grams of texts and how many each text has; texts are cleaned to words."""
    joined = "\n".join(f" {p} " for p in pieces).lower()
    points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    letter = _letter_table()[points]
    # What is between words becomes one space; so does the start of each text.
    line = points == 10
    keep = letter.copy()
    keep[0] = True
    keep[1:] |= letter[:-1] | line[:-1]
    text_of = np.cumsum(line)[keep]
    chars = np.where(letter, points, 32)[keep].astype(np.uint64)
    hashes = chars[: len(chars) - GRAM + 1].copy() if len(chars) >= GRAM else np.zeros(0, np.uint64)
    for i in range(1, GRAM):
        hashes *= np.uint64(0x100000001B3)
        hashes += chars[i : len(chars) - GRAM + 1 + i]
    inside = text_of[: len(hashes)] == text_of[GRAM - 1 :] if len(hashes) else np.zeros(0, bool)
    hashes = hashes[inside]
    hashes ^= hashes >> np.uint64(29)
    hashes *= _MIX
    hashes ^= hashes >> np.uint64(32)
    return hashes, text_of[: len(inside)][inside]


def places(hashes):
    """The places of n-grams in the filter, one row per hash function."""
    return [((hashes * f) >> np.uint64(64 - PLACE_BITS)).astype(np.int64) for f in _FACTORS[:HASHES]]


def _pieces(texts):
    """Groups of (text number, piece) of bounded size; pieces of long texts are cut at spaces."""
    group, size = [], 0
    for number, text in enumerate(texts):
        text = (text or "").replace("\n", " ")
        start = 0
        while start < len(text):
            end = start + PIECE_CHARS
            if end < len(text):
                space = text.rfind(" ", start + 1, end)
                end = space if space > 0 else end
            group.append((number, text[start:end]))
            size += end - start
            start = end
            if size >= PIECE_CHARS:
                yield group
                group, size = [], 0
    if group:
        yield group


# Stands for the number of rows among the counts of n-grams.
_ROWS = 0


def _gram_counts(batches):
    """Number of rows with each n-gram, and of all rows, by language, as far as this task has seen."""
    for batch in batches:
        texts, langs = batch.column(0).to_pylist(), batch.column(1).to_numpy()
        if not len(langs):
            continue
        found = [np.stack([np.full(len(langs), _ROWS), np.arange(len(langs))], axis=1)]
        for group in _pieces(texts):
            owners = np.array([number for number, _ in group])
            hashes, of = grams([piece for _, piece in group])
            rows = np.stack([hashes.view(np.int64), owners[of]], axis=1)
            found.append(np.unique(rows[rows[:, 0] != _ROWS], axis=0))
        rows = np.unique(np.concatenate(found), axis=0)
        pairs, n = np.unique(np.stack([rows[:, 0], langs[rows[:, 1]]], axis=1), axis=0, return_counts=True)
        yield pa.RecordBatch.from_arrays(
            [pa.array(pairs[:, 0]), pa.array(pairs[:, 1].astype(np.int32)), pa.array(n)], ["gram", "lang", "n"]
        )


def _place_masks(batches):
    for batch in batches:
        at = np.concatenate(places(batch.column(0).to_numpy().view(np.uint64)))
        lang = np.tile(batch.column(1).to_numpy(), HASHES)
        mask = np.left_shift(np.uint64(1), (lang % MASK_BITS).astype(np.uint64)).view(np.int64)
        yield pa.RecordBatch.from_arrays(
            [pa.array(lang // MASK_BITS), pa.array(at), pa.array(mask)], ["part", "place", "mask"]
        )


def train(df, text="text", lang="lang", sample_rows=SAMPLE_ROWS, doc_id="doc_id"):
    """A model from labelled rows; rows without text or language are left out.

    doc_id, if there is such a column, tells rows of one text apart when the sample is drawn.
    """
    key = F.col(doc_id) if doc_id in df.columns else F.lit(None)
    rows = df.select(F.col(text).alias("text"), F.col(lang).alias("lang"), key.cast("string").alias("key"))
    rows = rows.dropna(subset=["text", "lang"])
    sizes = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}
    languages = sorted(sizes, key=lambda x: (-sizes[x], x))
    if not languages:
        return Model([], np.zeros(1 << PLACE_BITS, np.uint64), np.zeros(0), [])
    number = F.create_map(*[F.lit(x) for i, x in enumerate(languages) for x in (x, i)])[F.col("lang")]
    share = F.create_map(*[F.lit(x) for k in languages for x in (k, min(1.0, sample_rows / sizes[k]))])[F.col("lang")]
    drawn = sampled(rows.withColumn("share", share), F.col("share"), 7, "key", "text")
    counted = drawn.select("text", number.alias("lang")).mapInArrow(_gram_counts, "gram bigint, lang int, n bigint")
    # About sample_rows texts a language, so small.
    counted = written(counted.groupBy("gram", "lang").agg(F.sum("n").alias("n")), "grams")
    rows_of = counted.filter(F.col("gram") == _ROWS).select("lang", F.col("n").alias("rows"))
    rated = counted.filter(F.col("gram") != _ROWS).join(rows_of, "lang").withColumn("rate", F.col("n") / F.col("rows"))
    by_gram = rated.groupBy("gram").agg(F.max("rate").alias("highest"), F.collect_list(F.struct("lang", "rate")).alias("found"))
    held = by_gram.select("gram", "highest", F.inline("found")).filter(
        (F.col("rate") >= LEAST_RATE) & (F.col("rate") >= SHARE_OF_HIGHEST * F.col("highest"))
    )
    placed = held.select("gram", "lang").mapInArrow(_place_masks, "part int, place bigint, mask bigint")
    table = placed.groupBy("part", "place").agg(F.bit_or("mask").alias("mask")).toArrow()
    masks = np.zeros((-(-len(languages) // MASK_BITS), 1 << PLACE_BITS), np.uint64)
    masks[table["part"].to_numpy(), table["place"].to_numpy()] = table["mask"].to_numpy().view(np.uint64)
    fill = np.array([
        np.count_nonzero(masks[i // MASK_BITS] >> np.uint64(i % MASK_BITS) & np.uint64(1)) for i in range(len(languages))
    ])
    return Model(languages, masks[0], (fill / masks.shape[1]) ** HASHES, list(masks[1:]))


def _bit_counts(masks, owners, texts, languages):
    """Set bits per text and language."""
    octets = masks.view(np.uint8).reshape(-1, 8)
    counts = np.zeros((texts, 64), np.int64)
    for byte in range((languages + 7) // 8):
        at = np.bincount(owners * 256 + octets[:, byte], minlength=texts * 256).reshape(texts, 256)
        bits = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little")
        counts[:, 8 * byte : 8 * byte + 8] = at @ bits.astype(np.int64)
    return counts[:, :languages]


def predict_texts(model, texts):
    """Language and score of each text."""
    known = len(model.languages)
    hits, total = np.zeros((len(texts), known)), np.zeros(len(texts), np.int64)
    for group in _pieces(texts) if known else ():
        owners = np.array([number for number, _ in group])
        hashes, of = grams([piece for _, piece in group])
        first, *others = places(hashes)
        for part, table in enumerate([model.masks, *model.more]):
            masks = table[first]
            for at in others:
                masks &= table[at]
            start = part * MASK_BITS
            counts = _bit_counts(masks, of, len(group), min(MASK_BITS, known - start))
            np.add.at(hits[:, start : start + MASK_BITS], owners, counts)
        np.add.at(total, owners, np.bincount(of, minlength=len(group)))
    names, scores = [], []
    for text, found, n in zip(texts, hits, total, strict=True):
        if not known or not text or not has_letter(text):
            names.append(UNKNOWN)
            scores.append(0.0)
            continue
        left = np.maximum(0.0, (found - n * model.false_rates) / (1 - model.false_rates)) if n else found
        best = int(np.argmax(left))
        names.append(model.languages[best])
        scores.append(float(min(1.0, left[best] / n)) if n else 0.0)
    return names, scores


def predict(df, model, text="text", keep=None):
    """Rows with `lang_pred` and `score`, the share of n-grams that the language explains."""
    shared = df.sparkSession.sparkContext.broadcast(model)

    def make():
        return lambda texts: predict_texts(shared.value, texts.to_pylist())

    return map_rows(df, [F.col(text)], make, {"lang_pred": "string", "score": "double"}, keep)

"""Cleaning a corpus of documents, stage by stage, into packed training sequences.

Each stage takes (spark, docs, sf_dir), works on all documents its predecessor kept and returns the
columns of documents; the last one returns the packed pieces. Documents that repeat an id, or have
none, are rows like others; what each stage does with null and empty texts, ties and repeats is said
in the module of its operator: null or letterless texts leave in the first stage.
"""

import public_tokenizers
from pyspark.sql import functions as F

from tillstar.llm import langid, packing, pii, quality, simhash
from tillstar.llm.common import held_out, read_table, unpacked, written

# A document stays if its language explains at least this share of its n-grams.
LEAST_LANGUAGE_SCORE = 0.3


def language_id(spark, docs, sf_dir):
    """Keep documents in a known language."""
    model = langid.train(docs.filter(~held_out(F.col("doc_id"))))
    found = langid.predict(docs, model)
    known = (F.col("lang_pred") != langid.UNKNOWN) & (F.col("score") >= LEAST_LANGUAGE_SCORE)
    return unpacked(found.filter(known))


def quality_classifier(spark, docs, sf_dir):
    """Keep documents whose quality score is high enough."""
    labels = read_table(spark, sf_dir, "labels")
    model = quality.train(docs.filter(~held_out(F.col("doc_id"))), labels)
    return unpacked(quality.score(docs, model).filter(F.col("score") >= quality.PREDICT_FROM))


def simhash_dedup(spark, docs, sf_dir):
    """Keep one document of each group of near-duplicates."""
    return simhash.keep_one(docs)


def pii_redaction(spark, docs, sf_dir):
    """Replace personal data by its kind."""
    found = pii.redact(docs)
    changed = {"text": F.col("clean")}
    if "n_chars" in docs.columns:
        changed["n_chars"] = F.length("clean").cast(docs.schema["n_chars"].dataType)
    return found.select(*[changed.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns])


def best_fit_packing(spark, docs, sf_dir):
    """Pack the documents into sequences."""
    return packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("language_id", language_id),
    ("quality_classifier", quality_classifier),
    ("simhash_dedup", simhash_dedup),
    ("pii_redaction", pii_redaction),
    ("best_fit_packing", best_fit_packing),
]
# SQL cannot express the fitted models.
ORACLE_SQL = None


def run(spark, sf_dir):
    """The stages one after another, each written to the shared folder and read again."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)

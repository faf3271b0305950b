"""The registered queries of this subpackage: (session, folder of tables) -> DataFrame."""

import public_tokenizers
from pyspark.sql import functions as F

from tillstar.llm import (
    byte_bpe, collocations, embedding_forest, langid, order_minhash, packing, pii, quality, resampling, simhash,
    toxicity, url_filter, word_bpe,
)
from tillstar.llm.common import held_out, read_table

URL_RULES = [
    ("net", "/", "block"),
    ("example.net", "/en/", "allow"),
    ("example.com", "/de/", "block"),
    ("org", "/fr/", "allow"),
]
# Tokens that a training sequence holds.
TOKEN_LIMIT = 2048


def op1_byte_bpe(spark, sf_dir):
    """Round trip of every document's text through the byte-level vocabulary."""
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    coded = byte_bpe.round_trip(docs, path, public_tokenizers.PATTERN, keep=["doc_id"])
    return coded.select(
        "row.doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(" ", F.col("ids").cast("array<string>")).cast("binary"), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op2_url_filter(spark, sf_dir):
    """Every page's URL judged by four rules."""
    rules = spark.sql(f"SELECT * FROM VALUES {', '.join(map(str, URL_RULES))} AS rules(host, path, verdict)")
    pages = read_table(spark, sf_dir, "pages").select("page_id", "url")
    return url_filter.judge(pages, rules).select("page_id", "host", "path", "rule", "verdict")


def op3_order_minhash(spark, sf_dir):
    """Fingerprints of every document, an edited form of it and the next document."""
    docs = read_table(spark, sf_dir, "documents")
    compared = order_minhash.with_next(docs, edited_as=lambda edited: F.sha2(edited.cast("binary"), 256))
    return compared.withColumnRenamed("edited", "edited_sha256")


def op4_token_counts(spark, sf_dir):
    """Tokens of every document by the word-level vocabulary."""
    docs = read_table(spark, sf_dir, "documents").select(
        "doc_id", "text", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes")
    )
    path = public_tokenizers.path("word_bpe_49k.json")
    counted = word_bpe.count_tokens(docs, path, keep=["doc_id", "n_bytes"])
    return counted.select(
        "row.doc_id", "row.n_bytes", "n_tokens", (F.col("n_tokens") > TOKEN_LIMIT).alias("over_limit")
    )


def op5_packing(spark, sf_dir):
    """All documents packed into sequences of at most 2048 tokens."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"), limit=TOKEN_LIMIT)


def op6_language_id(spark, sf_dir):
    """Language of every document, learned from those not held out."""
    docs = read_table(spark, sf_dir, "documents").select(
        "doc_id", "text", "lang", held_out(F.col("doc_id")).alias("held_out")
    )
    model = langid.train(docs.filter("not held_out"))
    found = langid.predict(docs, model, keep=["doc_id", "held_out"])
    return found.select("row.doc_id", "row.held_out", "lang_pred", "score")


def op7_embedding_forest(spark, sf_dir):
    """Near-duplicate vectors of the whole table."""
    return embedding_forest.near_duplicates(read_table(spark, sf_dir, "embeddings"))


def op8_quality(spark, sf_dir):
    """Quality score of every document, learned from good labels and unlabelled text not held out."""
    docs = read_table(spark, sf_dir, "documents").select(
        "doc_id", "text", held_out(F.col("doc_id")).alias("held_out")
    )
    model = quality.train(docs.filter("not held_out"), read_table(spark, sf_dir, "labels"))
    found = quality.score(docs, model, keep=["doc_id", "held_out"])
    return found.select(
        "row.doc_id", "row.held_out", "score", (F.col("score") >= quality.PREDICT_FROM).cast("int").alias("predicted")
    )


def op9_simhash(spark, sf_dir):
    """Fingerprints of all documents and the groups they link to."""
    grouped = simhash.groups(read_table(spark, sf_dir, "documents"))
    return grouped.select("doc_id", simhash.hex_digits(F.col("fp")).alias("fingerprint"), "component_id")


def op10_pii(spark, sf_dir):
    """Personal data in every document."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    found = pii.detect(docs, keep=["doc_id"])
    base = F.filter("spans", lambda s: s["base"])

    def count(kind):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        "row.doc_id",
        *[count(kind) for kind in pii.BASE_KINDS],
        F.sha2(pii.span_text(base).cast("binary"), 256).alias("base_sha256"),
        pii.span_text(F.col("spans")).alias("spans"),
    )


def op11_collocations(spark, sf_dir):
    """Each language's best collocations over all documents."""
    return collocations.mine(read_table(spark, sf_dir, "documents"))


def op12_resampling(spark, sf_dir):
    """A quarter of the documents, drawn towards the benchmark's distribution."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    found = resampling.resample(docs, read_table(spark, sf_dir, "benchmark"), keep=["doc_id"])
    return found.select(F.col("row.doc_id").cast("bigint").alias("doc_id"), "n_features", "weight", "score", "rank")


def op13_toxicity(spark, sf_dir):
    """Toxicity of every document, learned from the labelled ones not held out."""
    docs = read_table(spark, sf_dir, "documents").select(
        "doc_id", "text", held_out(F.col("doc_id")).alias("held_out")
    )
    model = toxicity.train(docs.filter("not held_out"), read_table(spark, sf_dir, "labels"))
    found = toxicity.score(docs, model, keep=["doc_id", "held_out"])
    return found.select(
        "row.doc_id", "row.held_out", "score", (F.col("score") >= toxicity.PREDICT_FROM).cast("int").alias("predicted")
    )


def registry():
    return {
        "op1_byte_bpe": op1_byte_bpe,
        "op2_url_filter": op2_url_filter,
        "op3_order_minhash": op3_order_minhash,
        "op4_token_counts": op4_token_counts,
        "op5_packing": op5_packing,
        "op6_language_id": op6_language_id,
        "op7_embedding_forest": op7_embedding_forest,
        "op8_quality": op8_quality,
        "op9_simhash": op9_simhash,
        "op10_pii": op10_pii,
        "op11_collocations": op11_collocations,
        "op12_resampling": op12_resampling,
        "op13_toxicity": op13_toxicity,
    }

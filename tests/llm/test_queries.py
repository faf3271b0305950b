"""The registered queries over whole tables, against plain versions of what they compute."""

import base64
import hashlib
import os
import zlib

import duckdb
import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from tests.llm.test_collocations import plain as plain_collocations
from tests.llm.test_embedding_forest import wanted as wanted_links
from tests.llm.test_order_minhash import wanted as wanted_order
from tests.llm.test_pii import plain as plain_spans
from tests.llm.test_resampling import plain as plain_draw
from tests.llm.test_simhash import close_pairs, plain_components, plain_fingerprint
from tests.llm.test_url_filter import plain as plain_verdict
from tillstar.llm import langid, pii, quality, queries, sql
from tillstar.llm.common import held_out

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables here")


def table(name):
    return duckdb.sql(f"SELECT * FROM '{FOLDER}/{name}.parquet'").df()


@pytest.fixture(scope="module")
def texts():
    rows = table("documents")
    return dict(zip(rows.doc_id.tolist(), rows.text.tolist(), strict=True))


@pytest.fixture(scope="module")
def run(spark):
    return lambda name: queries.registry()[name](spark, FOLDER).collect()


def digest(data):
    return hashlib.sha256(data).hexdigest()


def test_op1(run, texts):
    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    for r in run("op1_byte_bpe"):
        ids = library.encode_ordinary(texts[r.doc_id])
        assert (r.n_tokens, r.ids_sha256) == (len(ids), digest(" ".join(map(str, ids)).encode()))
        assert r.decoded_sha256 == digest(texts[r.doc_id].encode())


def test_op2(run):
    urls = table("pages").set_index("page_id").url.to_dict()
    rules = [(*rule,) for rule in queries.URL_RULES]
    found = run("op2_url_filter")
    assert len(found) == len(urls)
    for r in found:
        assert (r.host, r.path, r.rule, r.verdict) == plain_verdict(urls[r.page_id], rules)
    connection = duckdb.connect()
    connection.execute(f"CREATE VIEW pages AS SELECT * FROM '{FOLDER}/pages.parquet'")
    by_sql = connection.execute(sql.oracle_sql()["op2_url_filter"]).fetchall()
    assert sorted(by_sql, key=str) == sorted(map(tuple, found), key=str)


def test_op3(run, texts):
    found = {r.doc_id: r for r in run("op3_order_minhash")}
    assert len(found) == len(texts)
    for key, text, edited, near_edited, near_next in wanted_order(list(texts.items())):
        r = found[key]
        assert (r.n_chars, r.edited_sha256) == (len(text), digest(edited.encode()))
        assert (r.near_edited, r.near_next) == (near_edited, near_next)


def test_op4(run, texts):
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    for r in run("op4_token_counts"):
        n = len(library.encode(texts[r.doc_id], add_special_tokens=False).ids)
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len(texts[r.doc_id].encode()), n, n > 2048)


def check_packed(found, texts):
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    wanted = []
    for doc_id, text in texts.items():
        ids = np.array([*library.encode(text, add_special_tokens=False).ids, 0], "<u4")
        for at in range(0, len(ids), 2048):
            piece = ids[at : at + 2048]
            wanted.append((doc_id, at // 2048, at, len(piece), zlib.crc32(piece.tobytes())))
    assert sorted((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in found) == sorted(wanted)
    ends = {}
    for r in sorted(found, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == ends.get(r.sequence_id, 0)
        ends[r.sequence_id] = r.offset + r.length
    assert max(ends.values()) <= 2048
    assert len(ends) <= 1.01 * -(-sum(w[3] for w in wanted) // 2048) + 1


def test_op5(run, texts):
    check_packed(run("op5_packing"), texts)


def test_op6_learns_from_others_only(run):
    langs = table("documents").set_index("doc_id").lang.to_dict()
    found = run("op6_language_id")
    out = [r for r in found if r.held_out]
    assert len(found) == len(langs)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in found)
    assert np.mean([r.lang_pred == langs[r.doc_id] for r in out]) >= 0.97


def test_op7(run):
    rows = table("embeddings")
    vectors = np.stack([np.asarray(v, np.float64) for v in rows.embedding])
    counts, components = wanted_links(vectors)
    place = {v: i for i, v in enumerate(rows.vec_id.tolist())}
    for r in run("op7_embedding_forest"):
        i = place[r.vec_id]
        assert (r.n_links, r.component_id) == (counts[i], rows.vec_id[components[i]])


def test_op8_ranks_held_out_documents(run):
    labels = table("labels").set_index("doc_id").quality.to_dict()
    out = [(r.score, labels[r.doc_id]) for r in run("op8_quality") if r.held_out and r.doc_id in labels]
    good, bad = ([s for s, label in out if label == x] for x in (1, 0))
    assert np.mean([g > b for g in good for b in bad] or [1]) >= 0.9
    assert np.mean([s >= quality.PREDICT_FROM for s in good]) >= 0.97


def test_op9(run, texts):
    fingerprints = {i: plain_fingerprint(t) for i, t in texts.items()}
    groups = plain_components(set(fingerprints.values()), close_pairs(sorted(set(fingerprints.values()))))
    least = {}
    for i, fp in fingerprints.items():
        least[groups[fp]] = min(i, least.get(groups[fp], i))
    found = {r.doc_id: (r.fingerprint, r.component_id) for r in run("op9_simhash")}
    assert found == {i: (f"{fp:016x}", least[groups[fp]]) for i, fp in fingerprints.items()}


def test_op10(run, texts):
    for r in run("op10_pii"):
        spans = plain_spans(texts[r.doc_id])
        text = ",".join(f"{kind}:{start}:{end}" for kind, start, end in spans)
        assert r.base_sha256 == digest(text.encode())
        assert set(text.split(",")) - {""} <= set(r.spans.split(","))
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(s[0] == k for s in spans) for k in pii.BASE_KINDS]


def test_op11(run):
    rows = table("documents")
    wanted = plain_collocations(zip(rows.text, rows.lang, strict=True))
    assert {tuple(r) for r in run("op11_collocations")} == wanted


def test_op12(run, texts):
    wanted = plain_draw(list(texts.items()), table("benchmark").text.tolist())
    assert sorted((tuple(r) for r in run("op12_resampling")), key=str) == wanted


def test_op13_finds_held_out_toxic_documents(spark):
    """On a table with enough labelled rows for rates of a few percent: sf0.001 holds out 18 ordinary
    documents, one of which is flagged by a model of its few toxic ones."""
    folder = "/root/testdata/sf0.01" if FOLDER.endswith("sf0.001") else FOLDER
    labels = duckdb.sql(f"SELECT * FROM '{folder}/labels.parquet'").df().set_index("doc_id").toxic.to_dict()
    found = queries.op13_toxicity(spark, folder).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in found)
    out = [(r.predicted, labels[r.doc_id]) for r in found if r.held_out and r.doc_id in labels]
    toxic, ordinary = ([p for p, label in out if label == x] for x in (1, 0))
    assert np.mean(ordinary) <= 0.02 and np.mean(toxic) >= 0.7


def test_pipeline(spark, tmp_path):
    """Every stage against the plain version of its decision on the same input."""
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    columns, kept = docs.columns, []
    for name, stage in corpus_pipeline.STAGES:
        before = {r.doc_id: r for r in docs.collect()}
        stage(spark, docs, FOLDER).write.parquet(str(tmp_path / name))
        after = spark.read.parquet(str(tmp_path / name))
        rows = after.collect()
        texts = {i: r.text for i, r in before.items()}
        learning = docs.filter(~held_out(F.col("doc_id")))
        if name == "language_id":
            found = zip(texts, *langid.predict_texts(langid.train(learning), list(texts.values())), strict=True)
            wanted = {i for i, lang, s in found if lang != "und" and s >= corpus_pipeline.LEAST_LANGUAGE_SCORE}
        elif name == "quality_classifier":
            scores = quality.score_texts(quality.train(learning, labels), list(texts.values()))
            wanted = {i for i, s in zip(texts, scores, strict=True) if s >= quality.PREDICT_FROM}
        elif name == "simhash_dedup":
            fps = {i: plain_fingerprint(t) for i, t in texts.items()}
            groups = plain_components(set(fps.values()), close_pairs(sorted(set(fps.values()))))
            wanted = {min(i for i in fps if groups[fps[i]] == g) for g in set(groups.values())}
        elif name == "pii_redaction":
            wanted = set(texts)
            for r in rows:
                clean = pii.redacted(texts[r.doc_id], pii.find_spans(texts[r.doc_id]))
                assert (r.text, r.n_chars) == (clean, len(clean))
        else:
            check_packed(rows, texts)
            break
        assert after.columns == columns
        assert sorted(r.doc_id for r in rows) == sorted(wanted)
        if name != "pii_redaction":
            assert all(r == before[r.doc_id] for r in rows)
        kept.append(len(rows))
        docs = after
    assert len(table("documents")) >= kept[0] > kept[1] > kept[2] == kept[3] > 0
    packed = corpus_pipeline.run(spark, FOLDER)
    assert packed.select("doc_id").distinct().count() == kept[3]

import random
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from tests.llm.conftest import ODD_ROWS
from tillstar.llm import order_minhash as om


def plain(text):
    """The fingerprint by sorting, sketch for sketch."""
    points = om.code_points(text)
    if not len(points):
        return np.zeros(om.SKETCHES, np.uint32)
    kmers = om._kmers(points, min(om.KMER, len(points)))
    seen, hashes = Counter(), []
    for kmer in kmers:
        numbered = kmer + np.uint64(seen[int(kmer)]) * om._BASE
        seen[int(kmer)] += 1
        hashes.append(om._mixed(np.array([numbered]))[0])
    found = []
    for salt, factor in zip(om._SALTS, om._FACTORS, strict=True):
        value = [int((np.uint32(h >> np.uint64(32)) ^ salt) * factor) for h in hashes]
        least = sorted(sorted(range(len(value)), key=lambda i: value[i])[: om.TUPLE])
        mixed = np.array([om.SKETCHES], np.uint64)
        for i in least:
            mixed = om._mixed(mixed * om._BASE + hashes[i])
        found.append(np.uint32(mixed[0] >> np.uint64(32)))
    return np.array(found)


def test_fingerprint_by_sorting():
    rng = random.Random(6)
    with np.errstate(over="ignore"):
        for size in [0, 1, 5, 8, 9, 10, 40, 200]:
            text = "".join(rng.choice("abé😀") for _ in range(size))
            assert om.fingerprint(om.code_points(text)).tolist() == plain(text).tolist()


def likeness(a, b):
    return om.likeness(om.fingerprint(om.code_points(a)), om.fingerprint(om.code_points(b)))


def test_likeness_falls_with_edits_and_order():
    rng = random.Random(7)
    words = ["".join(rng.choice("abcdefghij") for _ in range(6)) for _ in range(400)]
    text = " ".join(words)
    small, large = list(words), list(words)
    small[100:140] = ["".join(rng.choice("klmnopqrst") for _ in range(6)) for _ in range(40)]
    large[100:300] = ["".join(rng.choice("klmnopqrst") for _ in range(6)) for _ in range(200)]
    turned = " ".join(words[200:] + words[:200])
    assert likeness(text, text) == 1.0 == likeness("", "")
    assert 1 > likeness(text, " ".join(small)) > likeness(text, " ".join(large)) > 0
    assert likeness(text, turned) < 0.9


def wanted(rows):
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0)))
    for k, (key, text) in enumerate(order):
        following = order[(k + 1) % len(order)][1]
        edited = om.edited_text(text, following)
        yield key, text, edited, likeness(text, edited), likeness(text, following)


def check(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = om.with_next(docs).collect()
    got = sorted(((r.doc_id, r.n_chars, r.edited, r.near_edited, r.near_next) for r in found), key=str)
    assert got == sorted(((k, len(t), e, a, b) for k, t, e, a, b in wanted(rows)), key=str)


def test_next_over_partitions(spark):
    rng = random.Random(8)
    rows = [(i, "".join(rng.choice("abc ") for _ in range(rng.randint(0, 60)))) for i in range(0, 120, 3)]
    rng.shuffle(rows)
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    parts = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        for n in ("1", "7", "200"):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            check(spark, rows)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
        spark.conf.set("spark.sql.shuffle.partitions", parts)


def test_few_rows(spark):
    check(spark, [(4, "only one row")])
    check(spark, [(4, "first"), (None, "last of all")])
    assert om.edited_text("abcdef", "xy") == "abcxy"


def test_rows(odd, none):
    found = om.with_next(odd).collect()
    assert len(found) == len(ODD_ROWS)
    assert {r.fingerprint for r in found if r.n_chars == 0} == {"00000000" * om.SKETCHES}
    assert om.with_next(none).count() == 0
    plain_rows = om.fingerprints(odd).select("row.text", F.col("fingerprint")).collect()
    assert all(r[1] == om.as_text(om.fingerprint(om.code_points(r[0] or ""))) for r in plain_rows)

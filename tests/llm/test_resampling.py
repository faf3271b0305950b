import hashlib
import math
import re
import zlib

import numpy as np
import pytest

from tests.llm.conftest import ODD_ROWS, ODD_TEXTS
from tillstar.llm import resampling


def features(text):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)
    return len(w), [zlib.crc32(x.encode()) % 10000 for x in w + [f"{a} {b}" for a, b in zip(w, w[1:], strict=False)]]


def plain(rows, target, percent=25, least=20):
    """(doc_id, n_features, weight, score, rank) of all rows, as the query returns them."""
    found = [(i, *features(t)) for i, t in rows]
    s, t = (np.bincount([b for _, fs in x for b in fs], minlength=10000) for x in ([f[1:] for f in found], map(features, target)))
    gains = resampling.gains_of(s, t)
    for b in range(0, 10000, 997):
        assert gains[b] == math.floor(1000 * math.log((t[b] + 1) * (s.sum() + 10000) / ((s[b] + 1) * (t.sum() + 10000))))
    scored = []
    for doc_id, words, fs in found:
        weight = sum(int(gains[b]) for b in fs) // len(fs) if fs else 0
        h = int(hashlib.sha256(f"7:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        scored.append((doc_id, len(fs), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), words))
    able = sorted((x for x in scored if x[4] >= least), key=lambda x: (-x[3], x[0] is None, x[0] or 0, x[1]))
    drawn = len(able) * percent // 100
    ranked = [(*x[:4], i + 1 if i < drawn else None) for i, x in enumerate(able)]
    return sorted(ranked + [(*x[:4], None) for x in scored if x[4] < least], key=str)


def run(df, target, **options):
    found = resampling.resample(df, target, **options)
    return sorted((tuple(r) for r in found.select("row.doc_id", "n_features", "weight", "score", "rank").collect()), key=str)


@pytest.fixture
def target(spark):
    return spark.createDataFrame([("the quick brown fox jumps",), ("lazy dogs sleep the day",), (None,)], "text string")


def text_of(i):
    rng = np.random.default_rng(i)
    words = ["the", "Quick", "brown", "fox", "dog", "42", "été", "x-y", "sleep", "day"]
    return " ".join(rng.choice(words, rng.integers(5, 60)))


def test_against_plain(spark, documents, target, monkeypatch):
    rows = [(i * 7 - 50, text_of(i)) for i in range(120)]
    wanted = plain(rows, [r.text for r in target.collect()])
    assert run(documents(*rows), target) == wanted
    monkeypatch.setattr(resampling, "BLOCK_BYTES", 8)
    assert run(documents(*rows).repartition(5), target) == wanted
    assert sum(r[4] is not None for r in wanted) == sum(features(t)[0] >= 20 for _, t in rows) // 4


def test_odd_rows(documents, odd, none, target):
    # Repeated rows, ids that repeat with other texts, and ids that are missing.
    rows = ODD_ROWS + [(3, text_of(5)), (3, text_of(5)), (3, text_of(6)), (None, text_of(7)), (None, text_of(8))] + [(90 + i, "word " * 30) for i in range(9)]
    frame = documents(*rows, more="row string, score string, rank string, weight string, part string, at string")
    texts = [r.text for r in target.collect()]
    assert run(frame, target) == plain(rows, texts)
    assert len(ODD_TEXTS) < len(rows)
    kept = resampling.resample(frame, target).select("row.rank", "row.score").first()
    assert kept[0].startswith("rank-") and kept[1].startswith("score-")
    assert run(none, target) == []
    assert run(odd, target.limit(0)) == plain(ODD_ROWS, [])


@pytest.mark.parametrize("part_rows, bits", [(4, 2), (7, 5), (1 << 14, 11)])
def test_radix_ranks(spark, part_rows, bits):
    rng = np.random.default_rng(3)
    rows = [(int(a), int(b), int(c)) for a, b, c in zip(rng.integers(0, 5, 90), rng.integers(0, 3000, 90), rng.integers(0, 2, 90), strict=True)]
    frame = spark.createDataFrame(rows + rows[:5], "a bigint, b bigint, c bigint").repartition(3)
    found = sorted(resampling.radix_ranks(frame, ["a", "b", "c"], part_rows, bits).collect(), key=lambda r: r["rank"])
    assert [r["rank"] for r in found] == list(range(1, 96))
    assert [(r.a, r.b, r.c) for r in found] == sorted(rows + rows[:5])


def test_radix_ranks_of_equal_and_no_keys(spark):
    frame = spark.range(10).selectExpr("CAST(0 AS bigint) AS a")
    assert sorted(r["rank"] for r in resampling.radix_ranks(frame, ["a"], 3, 4).collect()) == list(range(1, 11))
    assert resampling.radix_ranks(frame.limit(0), ["a"]).count() == 0


def test_large_keys(spark):
    values = [2**62 + 5, 2**62 + 4, 0, 2**40, 17, 2**62 + 5]
    frame = spark.createDataFrame([(v,) for v in values], "a bigint")
    found = sorted(resampling.radix_ranks(frame, ["a"]).collect(), key=lambda r: r["rank"])
    assert [r.a for r in found] == sorted(values)

import random
import re

import numpy as np
import pyarrow as pa
import pytest
import xxhash

from tests.llm.conftest import ODD_ROWS
from tillstar.llm import simhash
from tillstar.llm.components import connected_components


def plain_fingerprint(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(nodes, pairs):
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in pairs:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def close_pairs(points, bits=4):
    points = [int(p) for p in points]
    return [(a, b) for i, a in enumerate(points) for b in points[:i] if (a ^ b).bit_count() <= bits]


def cloud(seed, centres, each, flips):
    rng = random.Random(seed)
    found = set()
    for _ in range(centres):
        centre = rng.getrandbits(64)
        found |= {centre ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, flips))) for _ in range(each)}
    return np.array(sorted(found), np.uint64)


def test_fingerprint():
    rng = random.Random(5)
    for _ in range(300):
        text = "".join(rng.choice("aB cÉ\t\x85\xa0字\n") for _ in range(rng.randint(0, 60)))
        assert simhash.fingerprint(text) == plain_fingerprint(text), repr(text)


def test_long_text_in_chunks(monkeypatch):
    text = " ".join(str(i % 977) for i in range(3_000))
    whole = simhash.fingerprint(text)
    monkeypatch.setattr(simhash, "CHUNK_WORDS", 50)
    assert simhash.fingerprint(text) == whole == plain_fingerprint(text)


def test_pivots_never_discard_a_link():
    points = cloud(1, 3, 40, 4)
    table = simhash.pivot_table(points, simhash.pivot_points())
    for one in range(len(points)):
        near = simhash._near(points, table, one, np.arange(len(points)), 4)
        assert near.tolist() == np.flatnonzero(np.bitwise_count(points ^ points[one]) <= 4).tolist()


def test_links_of_runs_over_batches():
    points = cloud(2, 4, 60, 5)
    key = (points >> np.uint64(40)).astype(np.int64) % 3
    order = np.argsort(key, kind="stable")
    arrays = [pa.array(key[order]), pa.array(points[order].view(np.int64))]
    table = pa.RecordBatch.from_arrays(arrays, ["key", "fp"])
    batches = [table.slice(i, 7) for i in range(0, len(points), 7)]
    pairs = [
        (a, b) for batch in simhash._links_of_runs(batches, 4)
        for a, b in zip(*(c.to_numpy().view(np.uint64).tolist() for c in batch.columns), strict=True)
    ]
    group = dict(zip(points.tolist(), key.tolist(), strict=True))
    wanted = [(a, b) for a, b in close_pairs(points) if group[a] == group[b]]
    assert plain_components(group, pairs) == plain_components(group, wanted)
    assert len(pairs) < len(wanted)


def signed(points):
    return [(int(p) - (1 << 64) if int(p) >> 63 else int(p),) for p in points]


def test_links_of_all(spark):
    points = cloud(3, 6, 50, 6)
    classes = spark.createDataFrame(signed(points), "fp bigint")
    nodes = [p for (p,) in signed(points)]
    wanted = plain_components(nodes, [(signed([a])[0][0], signed([b])[0][0]) for a, b in close_pairs(points)])
    for run_rows in (simhash.RUN_ROWS, 20):
        found = [(r.a, r.b) for r in simhash.links(classes, run_rows=run_rows).collect()]
        assert plain_components(nodes, found) == wanted


def test_components_of_chains_and_loops(spark):
    links = [(i, i + 1) for i in range(200)] + [(500, 501), (501, 500), (7, 7), (None, 3), (900, 700), (700, 800)]
    found = connected_components(spark.createDataFrame(links, "a bigint, b bigint"))
    wanted = plain_components({n for p in links for n in p if n is not None} - {None}, [p for p in links if None not in p])
    assert {r.node: r.component for r in found.collect()} == wanted
    assert connected_components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def test_rows(odd, none):
    found = simhash.groups(odd).collect()
    assert len(found) == len(ODD_ROWS)
    ids = sorted((r.doc_id is None, r.doc_id or 0) for r in found)
    assert ids == sorted((i is None, i or 0) for i, _ in ODD_ROWS)
    fps = {(i, plain_fingerprint(t)) for i, t in ODD_ROWS}
    assert {(r.doc_id, r.fp % (1 << 64)) for r in found} == fps
    assert all(r.component_id == 0 for r in found if r.fp == 0)
    assert simhash.groups(none).count() == 0


@pytest.mark.parametrize("broadcast_keys", [0, 1_000])
def test_keep_one_by_either_path(documents, broadcast_keys):
    base = " ".join(f"w{i}" for i in range(200))
    rows = [(5, base), (3, base + " end"), (9, base), (7, "something else here"), (7, "something else here"), (2, "alone in this table of texts")]
    docs = documents(*rows, (None, base), more="fp string, row string, best string")
    kept = simhash.keep_one(docs, broadcast_keys=broadcast_keys)
    assert kept.columns == docs.columns
    groups = {r.doc_id: r.component_id for r in simhash.groups(docs).collect() if r.doc_id is not None}
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(groups.values()))


def test_keep_one(documents, none):
    text = "one two three four five six seven eight"
    docs = documents((5, text), (3, text.upper()), (3, text.upper()), (9, "other words are here now"), (None, text), (None, "x"), (None, "x"))
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id or -1, r.text) for r in kept.collect()) == [(-1, "x"), (3, text.upper()), (9, "other words are here now")]
    assert simhash.keep_one(none).count() == 0

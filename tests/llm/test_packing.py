import zlib

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from tests.llm.conftest import ODD_ROWS
from tillstar.llm import packing

PATH = public_tokenizers.path("word_bpe_49k.json")


def check(placed, lengths, limit):
    """Every item once, sequences gapless and within the limit; how many there are."""
    rows = [(r.sequence_id, r.offset, lengths[r.item]) for r in placed]
    assert sorted(r.item for r in placed) == sorted(lengths)
    ends = {}
    for sequence, offset, length in sorted(rows):
        assert offset == ends.get(sequence, 0)
        ends[sequence] = offset + length
    assert max(ends.values(), default=0) <= limit
    return len(ends)


def items(spark, lengths):
    return spark.createDataFrame(list(lengths.items()), "item bigint, length bigint")


def test_best_fit_and_operators_keep_every_item():
    rng = np.random.default_rng(1)
    lengths = rng.integers(1, 100, 300).tolist()
    one, other = packing._first(lengths, 100), packing._first(lengths, 100, rng)
    for child in (one, packing.crossover(one, other, rng), packing.mutate(other, rng)):
        assert sorted(i for m in child.members for i in m) == list(range(300))
        assert all(sum(lengths[i] for i in m) + r == 100 for m, r in zip(child.members, child.room, strict=True))


def test_evolution_beats_best_fit_by_falling_length():
    # Triples that fill a bin exactly, which best fit by falling length does not find.
    rng = np.random.default_rng(4)
    lengths = []
    for _ in range(40):
        a = int(rng.integers(380, 490))
        b = int(rng.integers(250, 1000 - a - 249))
        lengths += [a, b, 1000 - a - b]
    first = len(packing._first(lengths, 1000).members)
    elites = []
    for epoch in range(12):
        elites = packing.evolve(lengths, elites, 1000, np.random.default_rng(epoch), offspring=60)
    assert max(elites[0]) + 1 < first
    assert sorted(i for m in packing._from_numbers(elites[0], lengths, 1000).members for i in m) == list(range(120))


def test_pack(spark):
    rng = np.random.default_rng(2)
    lengths = {i: int(n) for i, n in enumerate(rng.integers(1, 129, 900))}
    placed = packing.pack(items(spark, lengths), limit=128, chunk_items=100).collect()
    assert check(placed, lengths, 128) <= 1.02 * packing.least_bins(list(lengths.values()), 128)


def test_least_bins():
    assert packing.least_bins([], 10) == 0
    assert packing.least_bins([5, 5, 5], 10) == 2
    assert packing.least_bins([6, 6, 6], 10) == 3
    assert packing.least_bins([10, 6, 6, 4, 4, 4], 10) == 4
    assert packing.least_bins([7, 7, 4, 4], 10) == 3
    rng = np.random.default_rng(5)
    for _ in range(200):
        lengths = rng.integers(1, 40, rng.integers(1, 60)).tolist()
        assert -(-sum(lengths) // 40) <= packing.least_bins(lengths, 40) <= len(packing._first(lengths, 40).members)


def test_pack_ties_whole_and_nothing(spark):
    lengths = {i: 64 for i in range(31)} | {i: 128 for i in range(40, 45)}
    assert check(packing.pack(items(spark, lengths), limit=128).collect(), lengths, 128) == 21
    assert packing.pack(items(spark, {1: 5}).limit(0), limit=128).count() == 0


def test_documents(odd, none, spark):
    library = Tokenizer.from_file(PATH)
    wanted = []
    for doc_id, text in ODD_ROWS:
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 0]
        for at in range(0, len(ids), 2048):
            piece = np.array(ids[at : at + 2048], "<u4")
            wanted.append((doc_id or -1, at // 2048, at, len(piece), zlib.crc32(piece.tobytes())))
    found = packing.pack_documents(odd, PATH).collect()
    assert sorted((r.doc_id or -1, r.piece, r.start, r.length, r.ids_crc32) for r in found) == sorted(
        (d or -1, *r) for d, *r in wanted
    )
    assert packing.pack_documents(none, PATH).count() == 0


def test_sequences(spark):
    rows = [(1, 4, b"cd"), (1, 0, b"ab"), (2, 0, b"x")]
    made = packing.sequences(spark.createDataFrame(rows, "sequence_id long, offset long, ids binary"))
    assert {r.sequence_id: bytes(r.ids) for r in made.collect()} == {1: b"abcd", 2: b"x"}

import math
from collections import Counter, defaultdict

import numpy as np
import pytest

from tests.llm.conftest import ODD_ROWS
from tillstar.llm import toxicity

WORDS = ["house", "garden", "river", "walks", "green", "table", "under", "light", "paper", "morning", "idle", "idea"]


def text_of(i, toxic):
    rng = np.random.default_rng(i)
    words = list(rng.choice(WORDS, 40))
    if toxic:
        for at in rng.choice(40, 4, replace=False):
            words[at] = "idiot" + "abcdefgh"[rng.integers(0, 8)] * (i % 3)
    return " ".join(words)


def plain_ratio(texts):
    """The log-likelihood ratio of a word as the module's text defines it, from (text, toxic) rows."""
    n = [Counter(), Counter()]
    for text, toxic in texts:
        for word in toxicity.words_of(text):
            n[toxic].update(word[:k] for k in range(len(word) + 1))
    after = defaultdict(set)
    for node in set(n[0]) | set(n[1]):
        if node:
            after[node[:-1]].add(node[-1])
    follows = Counter(letter for letters in after.values() for letter in letters)

    def probability(k, context, letter):
        both = [n[0][context + letter] + n[1][context + letter], n[0][context] + n[1][context]]
        shared = (both[0] - 0.75 + 0.75 * len(after[context]) * follows[letter] / sum(follows.values())) / both[1]
        if not n[k][context]:
            return shared
        freed = sum(min(n[k][context + x], 3) for x in after[context])
        return (max(n[k][context + letter] - 3, 0) + freed * shared) / n[k][context]

    def ratio(word):
        total = 0.0
        for k in range(len(word)):
            context, letter = word[:k], word[k]
            if n[1][context] <= 3:
                return total
            if letter not in after[context]:
                freed = [sum(min(n[c][context + x], 3) for x in after[context]) for c in (0, 1)]
                unseen = math.log(freed[1] / n[1][context])
                return total + unseen - (math.log(freed[0] / n[0][context]) if n[0][context] else 0)
            total += math.log(probability(1, context, letter)) - math.log(probability(0, context, letter))
        return total

    return ratio


def plain_evidence(text, ratio):
    words = toxicity.words_of(text)
    return sum(n * max(0, ratio(w) - toxicity.MARGIN) for w, n in words.items()) / max(1, sum(words.values()))


def test_texts_without_a_mark_are_not_shuffled(spark):
    docs = spark.createDataFrame([(i, "text") for i in [*range(5000), 7, None]], "doc_id bigint, text string")
    marked = spark.createDataFrame([(i, 1) for i in [*range(0, 5000, 50), 7, 9999, None]], "doc_id bigint, toxic int")
    found = toxicity.may_be_marked(docs, marked)
    ids = [r.doc_id for r in found.select("doc_id").collect()]
    assert {*range(0, 5000, 50), 7} <= set(ids) and ids.count(7) == 2
    assert found.columns == docs.columns and len(ids) < 150


@pytest.fixture(scope="module")
def rows():
    return [(i, text_of(i, i % 4 == 0)) for i in range(160)]


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(120)] + [(None, 1), (3, None)], "doc_id bigint, toxic int")


def test_against_plain_and_by_joins(spark, documents, rows, labels):
    docs = documents(*rows, (200, "idiotzz river"), (201, "idi"), (202, None))
    model = toxicity.train(docs, labels)
    ratio = plain_ratio([(t, int(i % 4 == 0)) for i, t in rows[:120]])
    found = {r[0]: r for r in toxicity.score(docs, model).select("row.doc_id", "row.text", "score", "evidence").collect()}
    assert all(abs(r.evidence - plain_evidence(r.text, ratio)) < 1e-6 for r in found.values())
    assert found[200].evidence > 0.3
    held = [(found[i].score >= 0.5) == (i % 4 == 0) for i in range(120, 160)]
    assert all(held)
    joined = toxicity.score(docs, model, keep=["doc_id"], bound=0).select("row.doc_id", "score").collect()
    assert {r[0]: round(r[1], 9) for r in joined} == {i: round(r.score, 9) for i, r in found.items()}


def test_layout_does_not_matter(spark, documents, rows, labels):
    docs = documents(*rows)
    scores = []
    for layout in (docs.coalesce(1), docs.repartition(7)):
        model = toxicity.train(layout, labels, fit_rows=60)
        scores.append(sorted(tuple(r) for r in toxicity.score(layout, model).select("row.doc_id", "score").collect()))
    assert scores[0] == scores[1]


def test_odd_rows(spark, documents, odd, none, rows, labels):
    model = toxicity.train(documents(*rows, *ODD_ROWS, (4, text_of(4, True)), (1, text_of(4, True))), labels)
    found = toxicity.score(odd, model).select("row.text", "row.score", "score").collect()
    assert len(found) == len(ODD_ROWS) and all(0 <= r[2] < 0.5 and r[1].startswith("score-") for r in found)
    assert toxicity.score(none, model).count() == 0
    long = documents((1, "idiot " * 3 + "river " * 400_000))
    assert 0 < toxicity.score(long, model).first().evidence < 1e-3


def test_words_in_blocks(monkeypatch):
    text = "One two, TWO three 44 " * 5 + "x" * 60
    whole = toxicity.words_of(text)
    assert whole["two$"] == 10 and whole["x" * 24 + "$"] == 2 and whole["x" * 12 + "$"] == 1
    monkeypatch.setattr(toxicity, "BLOCK_CHARS", 100)
    assert toxicity.words_of(text) == whole


def test_one_class_only(spark, documents, rows):
    none_toxic = spark.createDataFrame([(i, 0) for i in range(50)], "doc_id bigint, toxic int")
    model = toxicity.train(documents(*rows), none_toxic)
    assert {r.score for r in toxicity.score(documents(*rows), model).collect()} == {0.0}
    model = toxicity.train(documents(*rows), none_toxic.limit(0))
    assert toxicity.score(documents(*rows), model).filter("score > 0").count() == 0

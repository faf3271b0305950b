import numpy as np

from tests.llm.conftest import ODD_ROWS
from tillstar.llm import quality


def good(i):
    rng = np.random.default_rng(i)
    words = ["".join(rng.choice(list("abcdefgh"), rng.integers(2, 8))) for _ in range(60)]
    return ". ".join(" ".join(words[k : k + 6]).capitalize() for k in range(0, 60, 6)) + "."


def bad(i):
    return " | ".join(w.upper() + "!!" for w in good(i + 5000).split())


def vectors(texts):
    return np.stack([quality.features(t) for t in texts])


def test_risk_and_prior():
    positives = vectors(good(i) for i in range(150))
    unlabelled = vectors([good(i) for i in range(1000, 1140)] + [bad(i) for i in range(60)])
    model = quality.fit(positives, unlabelled)
    assert 0.5 < model.prior < 0.95
    scores = quality.score_texts(model, [good(1), good(7777), bad(9000), bad(9001)])
    assert (scores[:2] > 0.5).all() and (scores[2:] < 0.3).all()


def test_features_of_long_texts_in_pieces(monkeypatch):
    text = (good(3) + "\n") * 40
    whole = quality.features(text)
    monkeypatch.setattr(quality, "PIECE_CHARS", 100)
    assert np.allclose(whole, quality.features(text))


def test_train_and_score(spark, documents, odd, none):
    rows = [(i, good(i)) for i in range(40)] + [(i, bad(i)) for i in range(40, 60)]
    docs = documents(*rows, (1, good(1)), (None, good(2)), (70, None))
    labels = spark.createDataFrame([(i, int(i < 40)) for i in range(60) if i % 3] + [(1, 1), (None, 1)], "doc_id bigint, quality int")
    model = quality.train(docs, labels)
    found = {(r[0], r[1]): r[2] for r in quality.score(docs, model).select("row.doc_id", "row.text", "score").collect()}
    assert found[3, good(3)] > found[45, bad(45)]
    scored = quality.score(odd, model).select("row.score", "score").collect()
    assert len(scored) == len(ODD_ROWS) and all(0 <= r[1] <= 1 and r[0].startswith("score-") for r in scored)
    assert quality.score(none, model).count() == 0


def test_layout_does_not_matter(spark, documents):
    rows = [(i, good(i)) for i in range(60)] + [(i, bad(i)) for i in range(60, 90)] + [(1, bad(500))]
    labels = spark.createDataFrame([(i, int(i < 60)) for i in range(90) if i % 3], "doc_id bigint, quality int")
    docs = documents(*rows)
    scores = []
    for layout in (docs.coalesce(1), docs.repartition(7, "doc_id").sortWithinPartitions("text")):
        model = quality.train(layout, labels, positive_rows=30, unlabelled_rows=40)
        scores.append(quality.score_texts(model, [t for _, t in rows]).tolist())
    assert scores[0] == scores[1]


def test_nothing_to_learn_from(spark, documents):
    docs = documents((1, "a"), (2, "b"))
    labels = spark.createDataFrame([], "doc_id bigint, quality int")
    assert quality.score_texts(quality.train(docs, labels), ["a", ""]).tolist() == [0.5, 0.5]

"""Every stage of the pipeline over odd rows, an empty table and clashing column names."""

from collections import Counter

import numpy as np
import pytest

import corpus_pipeline
from tests.llm.conftest import ODD_ROWS
from tillstar.llm import langid

WORDS = {
    "en": "the house and a garden near this river where people walk every morning with their dogs".split(),
    "fr": "la maison et le jardin près de cette rivière où les gens marchent chaque matin avec leurs chiens".split(),
}
CLASHES = ["row", "score", "lang_pred", "fp", "_id", "clean", "ids", "in0"]
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars int, " + ", ".join(f"{c} string" for c in CLASHES)


def sentence(i, lang):
    rng = np.random.default_rng(i)
    words = rng.choice(WORDS[lang], 60)
    return " ".join(words).capitalize() + f". Mail user{i}@example.org now."


def row(doc_id, text, lang):
    return (doc_id, text, lang, None, None if text is None else len(text), *[f"{c}!" for c in CLASHES])


@pytest.fixture(scope="module")
def docs(spark):
    rows = [row(100 + i, sentence(i, lang), lang) for i in range(40) for lang in (["en", "fr"][i % 2],)]
    rows += [row(i, text, None) for i, text in ODD_ROWS]
    rows += [rows[0], rows[1], row(300, sentence(0, "en"), "en"), row(None, sentence(2, "en"), None)]
    rows += [row(400, sentence(7, "fr") * 2_000, "fr")]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("tables")
    labels = [(100 + i, 1, 0) for i in range(30)] + [(None, 1, None), (3, 0, 1), (7, None, None)]
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(str(path / "labels.parquet"))
    return str(path)


def content(frame):
    return Counter(tuple(r) for r in frame.collect())


def test_odd_rows_through_every_stage(spark, docs, folder, tmp_path):
    for name, stage in corpus_pipeline.STAGES[:-1]:
        stage(spark, docs, folder).write.parquet(str(tmp_path / name))
        after = spark.read.parquet(str(tmp_path / name))
        assert after.columns == docs.columns
        old, new = content(docs), content(after)
        if name == "pii_redaction":
            assert sum(new.values()) == sum(old.values())
            assert not any("@example.org" in r[1] for r in new) and all(r[4] == len(r[1]) for r in new)
        else:
            assert not new - old
        if name == "language_id":
            assert all(langid.has_letter(r[1] or "") for r in new)
            assert {100 + i for i in range(40)} | {300, 400} <= {r[0] for r in new}
            # Repeated rows are judged alike.
            assert all(new[r] == old[r] for r in new)
        if name == "simhash_dedup":
            assert max(new.values()) == 1 and 300 not in {r[0] for r in new}
            assert len({r[1] for r in new}) == sum(new.values())
        docs = after
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, folder).collect()
    assert {r.doc_id for r in packed} == {r[0] for r in content(docs)}
    lengths = Counter()
    for r in packed:
        lengths[r.sequence_id] += r.length
    assert max(lengths.values()) <= 2048


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES)
def test_an_empty_table(spark, docs, folder, name, stage):
    none = stage(spark, docs.limit(0), folder)
    assert none.count() == 0
    if name != corpus_pipeline.STAGES[-1][0]:
        assert none.columns == docs.columns

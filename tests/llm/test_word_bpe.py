import random

import public_tokenizers
import pytest

from tests.llm.conftest import ODD_ROWS
from tillstar.llm import word_bpe

PATH = public_tokenizers.path("word_bpe_49k.json")
LETTERS = [
    *"aA zZé'sSt'llREveÀßİΣΑςÅé字한١²½\x1f\x85\xa0  \n\t1.!<|", "<|endoftext|>", "<|startoftext|>",
    "don't ", "İ", "Å", "ǅ", "Ⱥ", "\x00", "ª", "µ", "ĸ", "ŉ",
]


@pytest.fixture(scope="module")
def words():
    with open(PATH, encoding="utf-8") as file:
        return word_bpe.model(file.read())


def test_whole_tokens_are_proved(words):
    assert len(words.counts.proved) > 30_000
    assert all(len(words.merge(w)) == 1 for w in list(words.counts.proved)[::500])


def test_same_as_the_library(words):
    rng = random.Random(2)
    for _ in range(4_000):
        text = "".join(rng.choice(LETTERS) for _ in range(rng.randint(0, 30)))
        ids = words.library.encode(text, add_special_tokens=False).ids
        assert words.count(text) == len(ids), text
        assert words.ids(text) == word_bpe._packed(ids), text


def test_long_text_in_parts(words, monkeypatch):
    monkeypatch.setattr(word_bpe, "PART_CHARS", 10)
    text = "字母表 déjà " * 50 + "字" * 40
    ids = words.library.encode(text, add_special_tokens=False).ids
    assert words.count(text) == len(ids)
    assert words.ids(text) == word_bpe._packed(ids)


def test_memory_is_bounded(words, monkeypatch):
    monkeypatch.setattr(word_bpe, "REMEMBERED_WORDS", 5)
    for number in range(30):
        words.count(f"zqx{'ab' * number}q")
    assert len(words.counts) <= len(words.counts.proved) + 7


def test_rows(odd, none, words):
    found = word_bpe.count_tokens(odd, PATH)
    assert found.count() == len(ODD_ROWS)
    for row in found.select("row.text", "row.n_tokens", "n_tokens").collect():
        library = words.library.encode(row[0] or "", add_special_tokens=False).ids
        assert row[1].startswith("n_tokens-") and row[2] == len(library)
    assert word_bpe.count_tokens(none, PATH).count() == 0

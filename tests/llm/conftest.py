import pytest


@pytest.fixture
def documents(spark):
    """Documents from (doc_id, text) pairs, with columns whose names the operators use too."""

    def make(*rows, more="ids string, row string, score string, n_tokens string"):
        names = [c.split()[0] for c in more.split(", ")]
        data = [(doc_id, text, *[f"{n}-{i}" for n in names]) for i, (doc_id, text) in enumerate(rows)]
        return spark.createDataFrame(data, f"doc_id bigint, text string, {more}")

    return make


# Null, empty, blank, one letter, repeated rows, ties, characters beyond the basic plane, long runs.
ODD_TEXTS = [
    None, "", " ", "\n", "a", "a", "ABC abc", "été über naïve", "字母表。", "😀 smile", "<|endoftext|> it's",
    "x" * 5_000, " " * 3_000 + "y", "word " * 4_000, "1 2 3", "tab\tand\x0bmore\x85end", "\x00null",
]
ODD_ROWS = [(i, text) for i, text in enumerate(ODD_TEXTS)] + [(3, "\n"), (None, "no id"), (None, None)]


@pytest.fixture
def odd(documents):
    return documents(*ODD_ROWS)


@pytest.fixture
def none(documents, odd):
    return odd.limit(0)

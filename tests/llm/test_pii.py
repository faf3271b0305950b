import random
import re

import pytest

from tests.llm.conftest import ODD_ROWS
from tillstar.llm import pii

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def passes(kind, found):
    digits = re.sub("[^0-9]", "", found)
    if kind == "ip":
        return all(int(part) <= 255 for part in found.split("."))
    if kind == "card":
        doubled = sum(sum(divmod(int(d) * (1 + i % 2), 10)) for i, d in enumerate(digits[::-1]))
        return 14 <= len(digits) <= 19 and doubled % 10 == 0
    return kind == "email" or 10 <= len(digits) <= 15


def plain(text):
    kinds = list(PLAIN)
    found = [
        (m.start(), kinds.index(kind), m.end())
        for kind, pattern in PLAIN.items()
        for m in re.finditer(pattern, text)
        if passes(kind, m.group())
    ]
    return [(kinds[k], start, end) for start, k, end in sorted(found)]


@pytest.mark.parametrize("letters", ["a@.-1 ", "1.2 ", "+1 (2)-.", "123 -4", "a1@b.c+ é"])
def test_base_spans_as_plain_patterns(letters):
    rng = random.Random(3)
    for _ in range(3_000):
        text = "".join(rng.choice(letters) for _ in range(rng.randint(0, 45)))
        assert [s[:3] for s in pii.find_spans(text) if s[4]] == plain(text), text


def test_checksums():
    assert pii.luhn("4111111111111111") and not pii.luhn("4111111111111112")
    assert pii.mod97("GB82WEST12345698765432") and not pii.mod97("GB83WEST12345698765432")


def test_added_spans_need_checks_or_context():
    kinds = [s[0] for s in pii.find_spans("IBAN DE89 3704 0044 0532 0130 00")]
    assert "iban" in kinds
    assert "iban" not in [s[0] for s in pii.find_spans("IBAN DE88 3704 0044 0532 0130 00")]
    assert [s[0] for s in pii.find_spans("ssn 078-05-1120")] == ["ssn"]
    assert pii.find_spans("part 078-05-1120") == []


def test_context_moves_scores_but_base_stays():
    near, far = (pii.find_spans(f"{word} 10.0.0.1")[0] for word in ("server", "version"))
    assert near[3] > pii.ADD_SCORE > far[3] and far[4]


def test_long_runs_are_linear():
    for text in ["1" * 200_000, "a" * 200_000 + "@", "@a.b " * 20_000, "+1(" + "(" * 200_000, "A1" * 50_000]:
        pii.find_spans(text)


def test_rows(documents, odd, none):
    assert pii.detect(odd).filter("size(spans) > 0").count() == 0
    assert pii.detect(odd).count() == len(ODD_ROWS)
    assert pii.detect(none).count() == 0
    docs = documents((1, "é a@b.co and +1 (555) 123-4567"), (1, "é a@b.co and +1 (555) 123-4567"), (2, None))
    clean = [r[0] for r in pii.redact(docs).select("clean").collect()]
    assert clean == ["é <EMAIL> and <PHONE>"] * 2 + [None]
    text = pii.detect(docs).select(pii.span_text(pii.F.col("spans"))).first()[0]
    assert text.startswith("email:2:8,phone:13:30")


def test_overlaps_are_replaced_once():
    assert pii.redacted("abcdef", [("card", 1, 4), ("phone", 2, 5)]) == "a<CARD>f"

"""Personal data in texts: patterns propose spans, validators confirm them, context scores them.

find_spans() returns, per text, spans of kinds email, ip, card and phone (the base kinds) and
iban, ssn and local_phone (the added ones). A pattern proposes a span; octet range, Luhn, digit
count or mod-97 confirm it; words nearby raise or lower its score. Base spans that are confirmed
always stay, whatever their score; added ones need ADD_SCORE. Every pattern is linear in the
text, whatever the text.

Defined results: a null or empty text has no spans; positions are code points, end exclusive; equal
texts have equal spans, and repeated rows repeat; other columns of any name are carried along.
"""

import re

from pyspark.sql import functions as F

from tillstar.llm.common import map_rows

BASE_KINDS = ("email", "ip", "card", "phone")
ADDED_KINDS = ("iban", "ssn", "local_phone")
_ORDER = {kind: i for i, kind in enumerate(BASE_KINDS + ADDED_KINDS)}
ADD_SCORE = 0.5
CONTEXT_BEFORE, CONTEXT_AFTER = 48, 24

SPAN_TYPE = "array<struct<kind:string,start:int,end:int,score:double,base:boolean>>"

_LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A run of digits either starts a match or has none inside, so only its start is tried.
_IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_IBAN = re.compile(
    r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])"
)
_SSN = re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])")
_LOCAL_PHONE = re.compile(
    r"(?<![0-9+])(?:\([0-9]{2,5}\)[ -]?|0[0-9]{1,4}[ /-])[0-9]{3,5}(?:[ -]?[0-9]{2,5}){0,2}(?![0-9])"
)

# First score of a confirmed span, words that raise it and words that lower it.
_SCORES = {"email": 0.9, "ip": 0.6, "card": 0.9, "phone": 0.7, "iban": 0.9, "ssn": 0.4, "local_phone": 0.4}
RAISE, LOWER = 0.2, 0.3
_FOR = {
    "email": r"e-?mail|mail|contact|kontakt|correo|courriel",
    "ip": r"\bip\b|address|host|server|login",
    "card": r"card|credit|visa|karte|carte|tarjeta|payment",
    "phone": r"phone|tel\b|call|fax|mobil|telefon|tel[eé]fono|t[eé]l",
    "iban": r"iban|account|konto|compte|cuenta|bank",
    "ssn": r"ssn|social security|tax",
    "local_phone": r"phone|tel\b|call|fax|mobil|telefon|tel[eé]fono|t[eé]l",
}
_AGAINST = {
    "ip": r"version|release|chapter|section",
    "card": r"order|tracking|serial|isbn|invoice",
    "phone": r"order|serial|isbn|invoice",
    "ssn": r"order|serial|part|model",
    "local_phone": r"order|serial|isbn|invoice",
}
_FOR = {kind: re.compile(words) for kind, words in _FOR.items()}
_AGAINST = {kind: re.compile(words) for kind, words in _AGAINST.items()}


def luhn(digits):
    """Whether the digits pass the Luhn checksum."""
    total = 0
    for place, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + place % 2)
        total += value - 9 * (value > 9)
    return total % 10 == 0


def mod97(iban):
    """Whether an account number's check digits are right."""
    turned = iban[4:] + iban[:4]
    return int("".join(str(int(c, 36)) for c in turned)) % 97 == 1


def _digits(text):
    return "".join(c for c in text if "0" <= c <= "9")


def _emails(text):
    """Leftmost matches of local@domain, found from the domain backwards."""
    free = 0
    for match in _DOMAIN.finditer(text):
        before = text[free : match.start()]
        local = len(before) - len(before.rstrip(_LOCAL))
        if local:
            yield match.start() - local, match.end()
        free = match.end() if local else match.start() + 1


def _confirmed(kind, found):
    if kind == "ip":
        return all(len(part.lstrip("0")) <= 3 and int(part.lstrip("0") or "0") <= 255 for part in found.split("."))
    if kind == "card":
        digits = _digits(found)
        return 14 <= len(digits) <= 19 and luhn(digits)
    if kind == "phone":
        return 10 <= len(_digits(found)) <= 15
    if kind == "iban":
        number = found.replace(" ", "")
        return 15 <= len(number) <= 34 and mod97(number)
    if kind == "ssn":
        return found[:3] not in ("000", "666") and found[0] != "9" and found[4:6] != "00" and found[7:] != "0000"
    return 7 <= len(_digits(found)) <= 13


def _score(kind, text, start, end):
    around = (text[max(0, start - CONTEXT_BEFORE) : start] + "\n" + text[end : end + CONTEXT_AFTER]).lower()
    score = _SCORES[kind]
    if _FOR[kind].search(around):
        score += RAISE
    if kind in _AGAINST and _AGAINST[kind].search(around):
        score -= LOWER
    return round(min(1.0, max(0.0, score)), 3)


_PATTERNS = (
    ("ip", _IP), ("card", _CARD), ("phone", _PHONE),
    ("iban", _IBAN), ("ssn", _SSN), ("local_phone", _LOCAL_PHONE),
)
_ANY_DIGIT = re.compile("[0-9]")


def find_spans(text):
    """Spans of a whole text: (kind, start, end, score, base), by start, then kind."""
    found = []
    if "@" in text:
        found += [("email", start, end) for start, end in _emails(text)]
    if _ANY_DIGIT.search(text):
        for kind, pattern in _PATTERNS:
            if kind == "phone" and "+" not in text:
                continue
            found += [
                (kind, m.start(), m.end()) for m in pattern.finditer(text) if _confirmed(kind, m.group())
            ]
    spans = [(*span, _score(span[0], text, *span[1:]), span[0] in BASE_KINDS) for span in found]
    kept = [s for s in spans if s[4] or s[3] >= ADD_SCORE]
    return sorted(kept, key=lambda s: (s[1], _ORDER[s[0]]))


def redacted(text, spans):
    """The text with each span, or overlapping spans together, replaced by <KIND>."""
    parts, end = [], 0
    for kind, start, stop, *_ in spans:
        if start >= end:
            parts += [text[end:start], f"<{kind.upper()}>"]
        end = max(end, stop)
    return "".join([*parts, text[end:]])


def detect(df, text="text", keep=None):
    """Rows with `spans`."""

    def make():
        return lambda texts: [[[_record(s) for s in find_spans(t or "")] for t in texts.to_pylist()]]

    return map_rows(df, [F.col(text)], make, {"spans": SPAN_TYPE}, keep)


def redact(df, text="text", keep=None):
    """Rows with `clean`, the text without personal data (null stays null)."""

    def make():
        return lambda texts: [[t and redacted(t, find_spans(t)) for t in texts.to_pylist()]]

    return map_rows(df, [F.col(text)], make, {"clean": "string"}, keep)


def _record(span):
    return dict(zip(("kind", "start", "end", "score", "base"), span, strict=True))


def span_text(spans):
    """kind:start:end of each span, joined by commas."""
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))),
        ",",
    )

"""Token counts and ids by a word-level BPE vocabulary, with a shortcut for whole tokens.

A vocabulary string that ends a word is proved, when the vocabulary is loaded, to encode alone as
exactly one token. A text is then lower-cased and cut into pre-tokens by one pattern; those in the
proved set count as one token, only the rest are merged (and remembered, up to a bound). The
pattern works on the characters whose normal form and class were read off the library itself;
stretches with other characters or with special strings go through the library as they are, so
the result is always the library's.

Defined results: a null or empty text has no tokens; rows are handled one by one, so repeated rows
and ids repeat; other columns of any name are carried along untouched.
"""

import json
import re

import numpy as np
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tillstar.llm.common import map_rows

# Characters below this code point are tried for the fast pattern: none of them combines with
# another, so that the normal form goes character by character.
FAST_BELOW = 0x250
# Words remembered by a worker beside the vocabulary.
REMEMBERED_WORDS = 300_000
# Longer texts are given to the library in parts, cut before a space.
PART_CHARS = 50_000

_models = {}


class _Known(dict):
    """What is known of words; others are worked out on first use."""

    def __init__(self, proved, work_out):
        super().__init__(proved)
        self.proved, self.work_out = proved, work_out

    def __missing__(self, word):
        if len(self) > len(self.proved) + REMEMBERED_WORDS:
            self.clear()
            self.update(self.proved)
        value = self[word] = self.work_out(word)
        return value


class WordBpe:
    def __init__(self, content):
        self.library = Tokenizer.from_str(content)
        self.specials = [t["content"] for t in json.loads(content)["added_tokens"]]
        self._bytes = _byte_letters()
        self._read_alphabet()
        self._prove_words()

    def _read_alphabet(self):
        """The characters the fast pattern may see, by the class the library gives them."""
        normal = self.library.normalizer.normalize_str
        cut = self.library.pre_tokenizer.pre_tokenize_str
        kinds = {"letter": [], "digit": [], "space": [], "other": []}
        for c in map(chr, range(1, FAST_BELOW)):
            low = c.lower()
            if len(low) > 1 or ord(low) >= FAST_BELOW or normal(c).strip() not in (low, ""):
                continue
            parts = len(cut(f"b{normal(c)}{normal(c)}b"))
            kinds[{1: "letter", 2: "space", 3: "other", 4: "digit"}[parts]].append(c)
        escaped = {kind: "".join(map(re.escape, found)) for kind, found in kinds.items()}
        self._odd = re.compile(f"[^{''.join(escaped.values())}]")
        self._words = re.compile(
            "'s|'t|'re|'ve|'m|'ll|'d|"
            f"[{escaped['letter']}]+|[{escaped['digit']}]|[{escaped['other']}]+"
        ).findall

    def _prove_words(self):
        whole = {}
        letters = {letter: byte for byte, letter in enumerate(self._bytes)}
        for token, number in self.library.get_vocab(with_added_tokens=False).items():
            word = token.removesuffix("</w>")
            if word and word != token and [t.id for t in self.library.model.tokenize(word)] == [number]:
                try:
                    whole[bytes(letters[c] for c in word).decode()] = number
                except (KeyError, UnicodeDecodeError):
                    continue
        self.counts = _Known(dict.fromkeys(whole, 1), lambda w: len(self.merge(w)))
        self.packed = _Known(
            {word: _packed([number]) for word, number in whole.items()},
            lambda w: _packed(self.merge(w)),
        )

    def merge(self, word):
        """Ids of one pre-token by the vocabulary's merges."""
        letters = "".join([self._bytes[b] for b in word.encode()])
        return [t.id for t in self.library.model.tokenize(letters)]

    def _is_fast(self, text):
        special = any(s in text for s in self.specials)
        return not special and not self._odd.search(text)

    def count(self, text):
        """Number of tokens of the whole text."""
        if self._is_fast(text):
            return sum(map(self.counts.__getitem__, self._words(text.lower())))
        fast, odd = [], []
        for part in text.split(" "):
            (fast if self._is_fast(part) else odd).append(part)
        known = sum(map(self.counts.__getitem__, self._words(" ".join(fast).lower())))
        return known + sum(len(self._encoded(p)) for p in _parts(" ".join(odd)))

    def ids(self, text):
        """Ids of the whole text as little-endian unsigned 32-bit numbers."""
        if self._is_fast(text):
            return b"".join(map(self.packed.__getitem__, self._words(text.lower())))
        return b"".join(_packed(self._encoded(part)) for part in _parts(text))

    def _encoded(self, text):
        return self.library.encode(text, add_special_tokens=False).ids


def _parts(text):
    start = 0
    while len(text) - start > PART_CHARS:
        cut = text.find(" ", start + PART_CHARS)
        if cut < 0:
            break
        yield text[start:cut]
        start = cut
    yield text[start:]


def _packed(ids):
    return np.array(ids, "<u4").tobytes()


def _byte_letters():
    """The letter that stands for each byte: itself if it prints, else the next one from U+0100."""
    printing = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(0x100, 0x200))
    return [chr(b) if b in printing else chr(next(spare)) for b in range(256)]


def shared_model(spark, path):
    """The vocabulary file's content, of bounded size, broadcast."""
    with open(path, encoding="utf-8") as file:
        return spark.sparkContext.broadcast(file.read())


def model(content):
    """The loaded vocabulary, kept for the life of the worker."""
    key = hash(content)
    if key not in _models:
        _models[key] = WordBpe(content)
    return _models[key]


def count_tokens(df, path, text="text", keep=None):
    """Rows with `n_tokens`, the number of tokens of the whole text."""
    content = shared_model(df.sparkSession, path)

    def make():
        count = model(content.value).count
        return lambda texts: [[count(t or "") for t in texts.to_pylist()]]

    return map_rows(df, [F.col(text)], make, {"n_tokens": "bigint"}, keep)

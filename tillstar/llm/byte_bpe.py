"""Byte-level BPE: texts to token ids and back.

encode() adds the ids of each whole text, decode() the bytes of each id list. Ranks come from a
local file of base64 tokens and ranks; its content (a vocabulary, so of bounded size) is read on
the driver and broadcast. Special tokens are not used: their strings are ordinary text.

Defined results: a null or empty text has no ids; null ids decode to no bytes; rows are handled one
by one, so repeated rows and ids repeat; other columns of any name are carried along untouched.
"""

import base64
import re

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import functions as F

from tillstar.llm.common import map_rows

# Longer texts are cut before they reach the library, whose pattern engine gives up on very long
# runs of white space.
PIECE_CHARS = 50_000

# White space as the pattern engine defines it (Unicode's White_Space). Fixed values.
_SPACE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_SPACES = "".join(c for c in map(chr, range(0x3001)) if re.match(f"[{_SPACE}]", c))
# Where a text may be cut without changing a match: before white space that follows something
# else, since no match goes on from there into white space; and before the last of several white
# space characters in front of something else, since the match of the run ends there.
_CUT = re.compile(f"[^{_SPACE}](?=[{_SPACE}])|[{_SPACE}](?=[{_SPACE}][^{_SPACE}])")

_encodings = {}


def safe_pieces(text, limit=PIECE_CHARS):
    """The text in pieces of about `limit` characters whose ids can be put one after another."""
    start = 0
    while len(text) - start > limit:
        cut = _CUT.search(text, start + limit - 1)
        if not cut:
            break
        yield text[start : cut.end()]
        start = cut.end()
    yield text[start:]


def encoding(ranks, pattern):
    """The library's encoding for a rank file's content, kept for the life of the worker."""
    key = hash((ranks, pattern))
    if key not in _encodings:
        pairs = (line.split() for line in ranks.splitlines() if line)
        _encodings[key] = tiktoken.Encoding(
            "ranks",
            pat_str=pattern,
            mergeable_ranks={base64.b64decode(token): int(rank) for token, rank in pairs},
            special_tokens={},
        )
    return _encodings[key]


def encode_text(codec, text, limit=PIECE_CHARS):
    """The ids the library gives for the whole text, also where it would fail."""
    if len(text) <= limit:
        return codec.encode_ordinary(text)
    ids = []
    for piece in safe_pieces(text, limit):
        # A run of white space that ends a piece is one match; a long one skips the pattern.
        body = piece.rstrip(_SPACES)
        if len(piece) - len(body) <= limit:
            body = piece
        ids += codec.encode_ordinary(body)
        if len(body) < len(piece):
            ids += codec._encode_single_piece(piece[len(body) :])
    return ids


def _shared_ranks(spark, path):
    with open(path, "rb") as file:
        return spark.sparkContext.broadcast(file.read())


def _id_lists(codec, texts):
    lists = [encode_text(codec, t or "") for t in texts.to_pylist()]
    ends = np.cumsum([0, *map(len, lists)], dtype=np.int32)
    flat = np.fromiter((i for ids in lists for i in ids), np.int32, int(ends[-1]))
    return lists, pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))


def encode(df, path, pattern, text="text", keep=None):
    """Rows with `ids`, the token ids of the text."""
    ranks = _shared_ranks(df.sparkSession, path)

    def make():
        codec = encoding(ranks.value, pattern)
        return lambda texts: [_id_lists(codec, texts)[1]]

    return map_rows(df, [F.col(text)], make, {"ids": "array<int>"}, keep)


def decode(df, path, pattern, ids="ids", keep=None):
    """Rows with `decoded`, the bytes the ids stand for; they need not be valid UTF-8."""
    ranks = _shared_ranks(df.sparkSession, path)

    def make():
        codec = encoding(ranks.value, pattern)
        return lambda lists: [[codec.decode_bytes(i or []) for i in lists.to_pylist()]]

    return map_rows(df, [F.col(ids)], make, {"decoded": "binary"}, keep)


def round_trip(df, path, pattern, text="text", keep=None):
    """Rows with `ids` and `decoded` in one pass, so that a task needs one Python worker only."""
    ranks = _shared_ranks(df.sparkSession, path)

    def make():
        codec = encoding(ranks.value, pattern)

        def work(texts):
            lists, ids = _id_lists(codec, texts)
            return [ids, [codec.decode_bytes(i) for i in lists]]

        return work

    return map_rows(df, [F.col(text)], make, {"ids": "array<int>", "decoded": "binary"}, keep)

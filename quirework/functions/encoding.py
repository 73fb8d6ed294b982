"""Splitting by a tokenizer's own tokens: sizes are counts of its ids, and pieces end at sentences where one is near.

The tokenizer is a local file whose path is a parameter; it is loaded once in each Python worker. Offsets come with the
ids, so pieces are cut from the text itself and nothing is decoded.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Callable, Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame

from quirework.functions.splitting import opens_sentence, without_fragment

_SENTENCE_END = re.compile(r"[.!?;:][\"')\]]*$")
#: An end is sought so many tokens ahead, and back to this share of the target, LEAST tokens at least.
AHEAD, BACK_SHARE, LEAST = 24, 3, 32


@lru_cache(4)
def load_tokenizer(path: str):
    """The tokenizer of a ``tokenizers`` JSON file; strings of its special tokens are ordinary text."""
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(path)
    t.encode_special_tokens = True
    return t


def spans_of(path: str, text: str) -> list[tuple[int, int]]:
    """Where the tokens of a text stand in it."""
    return load_tokenizer(path).encode(text, add_special_tokens=False).offsets


def ends_sentence(text: str) -> bool:
    return bool(_SENTENCE_END.search(text.rstrip()[-6:]))


def choose_end(text: str, spans: list[tuple[int, int]], start: int, target: int, limit: int) -> int:
    """The token before which a piece from token ``start`` ends: the nearest sentence end ahead, else back, else the target."""
    goal, top = min(start + target, len(spans)), min(start + limit, len(spans))
    least = min(start + max(LEAST, target // BACK_SHARE), top)
    tried = [*range(goal, min(top, goal + AHEAD) + 1), *range(goal, least - 1, -1)]
    return next((e for e in tried if ends_sentence(text[spans[start][0] : spans[e - 1][1]])), goal)


def choose_start(text: str, spans: list[tuple[int, int]], start: int, end: int, overlap: int, cap: int) -> int:
    """The token from which the next piece starts: within ``overlap`` tokens and ``cap`` characters of the end, at a
    sentence if one starts there."""
    stop = spans[end - 1][1]
    first = bisect_left(range(end), True, lo=max(start + 1, end - overlap), key=lambda i: stop - spans[i][0] <= cap)
    return next((i for i in range(first, end) if opens_sentence(text[spans[i][0] : spans[min(end, i + 16) - 1][1]])), first)


def split_encoded(text: str, path: str, target: int, limit: int, overlap: int, cap: int = 30) -> list[str]:
    """Pieces of about ``target`` and at most ``limit`` tokens of the tokenizer at ``path``.

    A broken sentence at the head of a later piece is dropped; a tiny last piece goes to the one before if it fits.
    """
    if target <= 0 or limit < target or overlap >= target:
        raise ValueError("need 0 < target <= limit and overlap < target")
    spans = spans_of(path, text)
    if len(spans) <= limit:
        return [text.strip()] if text.strip() else []
    pieces, at = [], 0
    while at < len(spans):
        end = len(spans) if len(spans) - at <= limit else choose_end(text, spans, at, target, limit)
        raw = text[spans[at][0] : spans[end - 1][1]]
        piece = without_fragment(raw) if pieces else raw.strip()
        pieces += [piece] if piece else []
        if end == len(spans):
            break
        at = choose_start(text, spans, at, end, overlap, cap)
    size = lambda s: len(spans_of(path, s))
    if len(pieces) > 1 and size(pieces[-1]) < max(20, target // 6):
        joined = f"{pieces[-2].rstrip()}\n\n{pieces[-1].lstrip()}"
        pieces[-2:] = [joined] if size(joined) <= limit else pieces[-2:]
    return pieces


def encoded_splitter(path: str, target: int = 420, limit: int = 480, overlap: int = 30, cap: int = 30) -> Callable[[DataFrame], DataFrame]:
    """A function from (row_id, text) to (row_id, piece_no, text, tokens), by the tokenizer at ``path`` on every worker."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = [
                (i, k, p, len(spans_of(path, p)))
                for i, text in zip(b["row_id"], b["text"])
                for k, p in enumerate(split_encoded(text or "", path, target, limit, overlap, cap))
            ]
            yield pd.DataFrame(rows, columns=["row_id", "piece_no", "text", "tokens"])

    return lambda df: df.select("row_id", "text").mapInPandas(run, "row_id long, piece_no int, text string, tokens int")

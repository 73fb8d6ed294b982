"""Cutting oversized texts at natural boundaries, with content-defined landmarks.

Method: a rolling hash over the last LANDMARK_WORDS words marks landmarks. Between a minimum and a maximum size, the
landmark of the least hash that has a natural boundary nearby decides, and the piece ends at that boundary. As landmarks
depend on nearby words only, an edit moves the cuts around it and leaves distant pieces as they were.
Consecutive pieces overlap by a fixed number of tokens.
"""

from __future__ import annotations

import re
import zlib
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quirework.functions.tokens import TOKEN_PY, py_token_count, token_count

LANDMARK_WORDS = 5
#: One word in this many is a landmark, on average.
LANDMARK_EVERY = 16
#: A boundary may lie this many words from its landmark.
SNAP = 24
#: Rank of the boundaries between sentences; landmarks snap to these and better ones.
SENTENCE = 2

#: Boundaries by rank: the end of the pattern's match is where the next piece starts.
BOUNDARIES = (
    (5, re.compile(r"\n[ \t]*(?=(?:#{1,6} |={2,4} |(?:art|articolo|article|artikel|artículo)\.? ?\d))", re.I)),
    (4, re.compile(r"\n[ \t]*\n\s*")),
    (3, re.compile(r"\r?\n[ \t]*(?=(?:[-*•] |\w{1,2}\) |\|))|(?<=[.!?;:|])[ \t]*\r?\n[ \t]*")),
    (2, re.compile(r"(?<=[.!?])[\"»”')]*\s+(?=[^\W\d_a-zà-ÿ]|[«“\"])")),
    (1, re.compile(r"(?<=[;:,])\s+|\n\s*")),
)


@dataclass(frozen=True)
class Limits:
    max_tokens: int = 480
    overlap_tokens: int = 30
    min_share: float = 0.5

    def words(self, tokens: int) -> int:
        """Most matches whose token count is at most ``tokens``."""
        n = (10 * tokens + 4) // 12
        while (12 * (n + 1) + 5) // 10 <= tokens:
            n += 1
        while n > 0 and (12 * n + 5) // 10 > tokens:
            n -= 1
        return n


def cut(text: str | None, limits: Limits = Limits()) -> list[tuple[int, int]]:
    """(start, end) offsets of the pieces of ``text``; the whole text where it is within the limit.

    Every piece has at most ``max_tokens``; each but the first starts with the last
    ``overlap_tokens`` of the one before. Without the overlaps the pieces make up the whole text.
    """
    if not text:
        return []
    if py_token_count(text) <= limits.max_tokens:
        return [(0, len(text))]
    starts, ends = [], []
    for m in TOKEN_PY.finditer(text):
        starts.append(m.start())
        ends.append(m.end())
    n, most, back = len(starts), limits.words(limits.max_tokens), limits.words(limits.overlap_tokens)
    back = max(0, min(back, most - 1))
    rank = [0] * (n + 1)
    for r, pattern in BOUNDARIES:
        for m in pattern.finditer(text):
            i = bisect_left(starts, m.end())
            if i < n and rank[i] < r:
                rank[i] = r
    hashes = [zlib.crc32(text[s:e].casefold().encode()) for s, e in zip(starts, ends)]
    landmarks: list[int] = []
    strength: list[int] = []
    acc, base, mask = 0, 0x01000193, 0xFFFFFFFF
    out = pow(base, LANDMARK_WORDS, 1 << 32)
    for i, h in enumerate(hashes):
        acc = (acc * base + h) & mask
        if i >= LANDMARK_WORDS:
            acc = (acc - hashes[i - LANDMARK_WORDS] * out) & mask
        mixed = (acc * 0x9E3779B1) & mask
        if i >= LANDMARK_WORDS - 1 and mixed >> 16 < 65536 // LANDMARK_EVERY:
            landmarks.append(i + 1)
            strength.append(mixed)
    pieces, at, first = [], 0, True
    while True:
        room = most if first else most - back
        if n - at <= room:
            end = n
        else:
            low = at + max(back + 1 if first else 1, int(room * limits.min_share))
            end = _best_cut(rank, landmarks, strength, low, at + room)
        lead = at if first else at - back
        pieces.append((starts[lead] if lead else 0, starts[end] if end < n else len(text)))
        if end >= n:
            return pieces
        at, first = end, False


def _best_cut(rank: list[int], landmarks: list[int], strength: list[int], low: int, high: int) -> int:
    """Where a piece ends in [low, high]: at the boundary that the strongest landmark snaps to.

    A landmark snaps to a boundary of at least a sentence no more than SNAP words away, to the highest rank and then the
    nearest one (ties go to the earlier). The strongest landmark is the one of the least hash among those that have such
    a boundary. Where none has, the boundary nearest to a landmark is taken (of sentences first, then of any rank, ties
    go to the later); without boundaries the strongest landmark itself; without landmarks the greatest size.
    """
    first, last = bisect_left(landmarks, low), bisect_right(landmarks, high)
    for k in sorted(range(first, last), key=lambda k: (strength[k], k)):
        at = landmarks[k]
        near = [i for i in range(max(low, at - SNAP), min(high, at + SNAP) + 1) if rank[i] >= SENTENCE]
        if near:
            return min(near, key=lambda i: (-rank[i], abs(i - at), i))
    for least in (SENTENCE, 1):
        ends = [i for i in range(low, high + 1) if rank[i] >= least]
        if ends:
            return max(ends, key=lambda i: (-_distance(landmarks, i), i))
    return landmarks[min(range(first, last), key=lambda k: (strength[k], k))] if first < last else high


def _distance(landmarks: list[int], i: int) -> int:
    k = bisect_left(landmarks, i)
    return min((abs(x - i) for x in landmarks[max(0, k - 1) : k + 1]), default=0)


PIECE = "tab string, row_id long, piece_no int, pieces int, heading_path array<string>, text string, token_count int, own_start int, whole int"


def split_texts(rows: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """Pieces of ``rows`` (tab, row_id, text, heading_path).

    One row per piece: its number, the number of pieces, its heading path, text, token count and
    ``own_start``, the offset in its text where the overlap ends, and ``whole``, the tokens of the
    uncut text. Texts within the limit are one piece; null and empty texts are one empty piece.
    Repeated rows are cut alike. Only oversized texts go through Python.
    """
    t = rows.select("tab", "row_id", "text", "heading_path", token_count("text").alias("whole"))
    small = t.where(F.col("whole") <= limits.max_tokens).select(
        "tab", "row_id", F.lit(0).alias("piece_no"), F.lit(1).alias("pieces"), "heading_path",
        F.coalesce("text", F.lit("")).alias("text"), F.col("whole").alias("token_count"), F.lit(0).alias("own_start"), "whole",
    )

    def pieces(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for tab, row_id, text, path, whole in zip(b["tab"], b["row_id"], b["text"], b["heading_path"], b["whole"]):
                spans = cut(text, limits)
                for k, (s, e) in enumerate(spans):
                    own = spans[k - 1][1] - s if k else 0
                    out.append((tab, row_id, k, len(spans), path, text[s:e], py_token_count(text[s:e]), own, whole))
            yield pd.DataFrame(out, columns=[c.split()[0] for c in PIECE.split(", ")])

    return small.unionByName(t.where(F.col("whole") > limits.max_tokens).mapInPandas(pieces, PIECE))


def oversized(rows: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """(tab, row_id) of the rows that had to be cut."""
    return split_texts(rows, limits).where("piece_no = 1").select("tab", "row_id")

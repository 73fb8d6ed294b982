"""Exact splitter: texts into windows of tokens with a capped overlap. One call a text, no state."""

from __future__ import annotations

import re

from quirework.functions.tokens import TOKEN_PY, py_token_count

_END = re.compile(r"[.!?;:]\s+")
_OPENERS = ("Table:", "#", "- ", "* ")


def budget(tokens: int) -> int:
    """Matches that ``tokens`` stand for, at least one."""
    return max(1, 10 * tokens // 12)


def opens_sentence(text: str) -> bool:
    t = text.lstrip()
    return t.startswith(_OPENERS) or t[:1].isupper() or t[:1].isdigit()


def without_fragment(text: str) -> str:
    """A piece without the broken sentence it starts with, if one ends within 220 characters and 24 are left."""
    t = text.strip()
    if not t or opens_sentence(t):
        return t
    m = _END.search(t, 0, 220)
    rest = t[m.end() :].lstrip() if m else ""
    return rest if len(rest) >= 24 else t


def split_tokens(text: str, target: int, limit: int, overlap: int, cap: int = 30, lossless: bool = False) -> list[str]:
    """Pieces of ``text`` of about ``target`` and at most ``limit`` tokens.

    Consecutive pieces share at most ``overlap`` tokens and ``cap`` characters, starting at what looks like a
    sentence where one does. Unless ``lossless``, a broken sentence at the head of a later piece is dropped
    (it stands in the piece before only in part). A tiny last piece goes to the one before if it fits.
    """
    if target <= 0 or limit < target or overlap >= target:
        raise ValueError("need 0 < target <= limit and overlap < target")
    spans = [m.span() for m in TOKEN_PY.finditer(text)]
    n, t = len(spans), budget(target)
    m, o = max(t, budget(limit)), min(budget(overlap), t - 1)
    if n <= m:
        return [text.strip()] if n else []
    pieces, lo = [], 0
    while True:
        hi = n if n - lo <= m else lo + t
        raw = text[spans[lo][0] : spans[hi - 1][1]]
        piece = raw.strip() if lossless or not pieces else without_fragment(raw)
        if piece:
            pieces.append(piece)
        if hi == n:
            break
        near = [i for i in range(max(lo + 1, hi - o), hi) if spans[hi - 1][1] - spans[i][0] <= cap]
        lo = next((i for i in near if opens_sentence(text[spans[i][0] : spans[i][0] + 64])), near[0] if near else hi)
    if len(pieces) > 1 and py_token_count(pieces[-1]) < max(20, t // 6):
        joined = f"{pieces[-2].rstrip()}\n\n{pieces[-1].lstrip()}"
        if py_token_count(joined) <= m:
            pieces[-2:] = [joined]
    return pieces


def shared_edge(left: str, right: str, scan: int = 320) -> int:
    """Length of the longest end of ``left`` that starts ``right``, within ``scan`` characters."""
    tail, head = left[-scan:], right[:scan]
    return next((k for k in range(min(len(tail), len(head)), 0, -1) if tail.endswith(head[:k])), 0)


# --- tables and segments ---------------------------------------------------------------------

HEADER = "Table:"


def is_table(text: str) -> bool:
    return text.lstrip().startswith(HEADER)


def _lines(text: str) -> list[str]:
    return [x for x in map(str.strip, text.splitlines()) if x]


def _prose(lines: list[str]) -> bool:
    return any(len(x.split()) > 12 or x.endswith((".", ";")) for x in lines)


def as_table(text: str) -> str:
    """:func:`quirework.functions.meta.normalize_table` for one text."""
    lines = _lines(text)
    if not lines:
        return ""
    if lines[0].startswith(HEADER):
        payload = lines[0][len(HEADER) :].strip()
        return "\n".join([HEADER, *([payload] if payload else []), *lines[1:]])
    piped = [i for i, x in enumerate(lines) if "|" in x]
    if len(piped) < 2 and text.count("|") < 6:
        return text.strip()
    caption = " | ".join(lines[: piped[0]])
    return "\n".join([HEADER, *([caption] if caption else []), *lines[piped[0] :]])


def table_rows(text: str, limit: int) -> list[str]:
    """A table as pieces of whole rows under a repeated ``Table:`` line; rows over the limit are split themselves."""
    lines = _lines(text)
    if not lines or not lines[0].startswith(HEADER):
        return [text.strip()] if lines else []
    rows = lines[1:]
    if not any("|" in x for x in rows):
        return list(filter(None, ["\n".join(rows) if _prose(rows) else text.strip()]))
    groups: list[list[str]] = [[]]
    for row in rows:
        under = [f"{HEADER}\n{row}"]
        if py_token_count(under[0]) > limit:
            groups += [[p] for p in split_tokens(row, limit, limit, 1) if p] + [[]]
        elif groups[-1] and py_token_count("\n".join([HEADER, *groups[-1], row])) > limit:
            groups.append([row])
        else:
            groups[-1].append(row)
    out = []
    for g in filter(None, groups):
        bare = not any("|" in x for x in g) and _prose(g)
        out.append("\n".join(g if bare else [HEADER, *g]))
    return out or [text.strip()]


def fragments(text: str) -> list[tuple[bool, str]]:
    """(is a table, text) parts of a segment: its ``Table:`` blocks and the prose around them."""
    head, *payloads = text.strip().split(f"{HEADER}\n")
    out = [(False, head.strip())]
    for payload in payloads:
        lines = payload.splitlines()
        body: list[str] = []
        k = 0
        for k, raw in enumerate([*lines, None]):
            line = raw.strip() if raw is not None else None
            if line is None or (body and not line) or (any("|" in x for x in body) and "|" not in line):
                break
            if line:
                body.append(line)
        rest = "\n".join(lines[k:]).strip()
        if body and not any("|" in x for x in body) and _prose(body):
            out.append((False, "\n\n".join(filter(None, ["\n".join(body), rest]))))
            continue
        if body:
            out.append((True, "\n".join([HEADER, *body])))
        out.append((False, rest))
    return [(t, x) for t, x in out if x]


def segment_pieces(text: str, target: int, limit: int, overlap: int, min_chars: int, cap: int = 30) -> list[str]:
    """Pieces of a segment: tables by rows, prose by tokens, never over ``limit``."""
    pairs: list[tuple[bool, str]] = []
    for table, part in fragments(text):
        pieces = table_rows(part, limit) if table else split_tokens(part, target, limit, overlap, cap)
        pairs += [(table or is_table(x), x) for x in map(as_table, pieces) if x]
    if len(pairs) > 1 and not pairs[-1][0] and not pairs[-2][0] and len(pairs[-1][1]) < min_chars:
        joined = f"{pairs[-2][1].rstrip()}\n\n{pairs[-1][1].lstrip()}"
        if py_token_count(joined) <= limit:
            pairs[-2:] = [(False, joined)]
    safe = max(1, min(overlap, target - 1, limit - 1))
    out: list[str] = []
    for _, x in pairs:
        whole = py_token_count(x) <= limit
        out += [x] if whole else [y for y in map(as_table, split_tokens(x, limit, limit, safe, cap)) if y]
    return out


def join_tiny(pieces: list[str], smallest: int, limit: int) -> list[str]:
    """Pieces under ``smallest`` tokens joined to the next, else to the previous one of their kind, if it fits."""
    waiting = [p.strip() for p in pieces if p and p.strip()][::-1]
    out: list[str] = []

    def fits(a: str, b: str) -> str | None:
        joined = f"{a.rstrip()}\n\n{b.lstrip()}"
        return joined if is_table(a) == is_table(b) and py_token_count(joined) <= limit else None

    while waiting:
        piece = waiting.pop()
        if py_token_count(piece) < smallest:
            if waiting and (ahead := fits(piece, waiting[-1])):
                waiting[-1] = ahead
                continue
            if out and (back := fits(out[-1], piece)):
                out[-1] = back
                continue
        out.append(piece)
    return out


def trim_edges(pieces: list[str], overlap: int) -> list[str]:
    """Overlaps over a fifth of the shorter piece cut down to about ``overlap`` tokens."""
    out = pieces[:1]
    for piece in pieces[1:]:
        shared = shared_edge(out[-1], piece)
        extra = shared - 4 * overlap
        if 5 * shared > min(len(out[-1]), len(piece)) and 0 < extra < len(piece):
            piece = piece[extra:].lstrip()
        out.append(piece)
    return out

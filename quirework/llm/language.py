"""Language of each document and of each segment of a mixed one, with a confidence.

Method: cross-parsing entropy. For each language a suffix automaton is built over labelled text. A
unit of text (a sentence, a sheet or a table) is parsed into the longest phrases that occur in that
text; the language that needs the fewest phrases a letter, times the bits of a phrase, wins, and
its lead over the second is the confidence.

The automata are flattened into one transition table in which a failed match already restarts at the
root, so that all units of a batch, in all languages, advance by one array lookup a letter.
The labels used for training are a bounded sample; as some are wrong, units whose words
belong to another label are left out first.
"""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quirework.llm.markup import TRIGGER, parse

LANGUAGES = ("it", "en", "de", "fr", "es")
# Other names of the languages.
NAMES = {
    "it": "it ita italian italiano", "en": "en eng english inglese", "de": "de deu ger german deutsch tedesco",
    "fr": "fr fra fre french français francais francese", "es": "es spa esp spanish español espanol castellano spagnolo",
}
CODES = {name: code for code, names in NAMES.items() for name in names.split()}

#: Bound of the labelled sample: documents of each label, and letters of each language's automaton.
TRAIN_DOCS = 400
TRAIN_LETTERS = 30_000
#: Longer texts are not drawn into the sample.
TRAIN_CHARS = 50_000
#: Units with fewer letters have no say.
MIN_LETTERS = 12
MIN_TABLE_LETTERS = 14
#: A unit's lead has to be this large to bring in a language of its own.
MIN_LEAD = 0.21

_TRIGGER = re.compile(TRIGGER)
_INVISIBLE = "​‌‍⁠﻿"
_MARKS = "-‐\xac\xad"
_QUOTED = re.compile(r"«[^«»]{1,160}»|[“\"][^«»“”\".!?\n]{1,80}[”\"]")
_CUT = re.compile(r"(?<=[^\W\d_])[-‐\xac\xad][ \t]*\r?\n\s*(?=[^\W\d_])")
_HEADING = re.compile(r"(?i)^\s*(?:[“\"]?art(?:icolo|icle|ikel|ículo)?[.;,]?\s*\d|#{1,6}\s|={2,})")
_PARAGRAPH = re.compile(r"\n[ \t]*\n\s*")
_STOP = re.compile(r"[.!?][\"»”')\]]*\s+")
_ENDS = re.compile(r"[.!?;:][\"»”')\]}\s]*$")
#: A text of so many characters counts as a sentence without an end mark, and is no heading.
LONG = 120
_FIELD = re.compile(r"^[^:|;\n]{2,30}:\s*[^|;\n]+$")
_OWN = re.compile(r"(?:^|\n)[ \t]*(?=[-*•][ \t]|\w{1,2}\)[ \t])")
_NOT_LETTER = re.compile(r"[\W\d_]+")
_SKIP = ("comment", "template:", "md:code", "formula", "footnote", "wiki:table", "pre")


def code_column(hint: Column | str) -> Column:
    """Code of the language a hint names, in any case, regional or three-letter form; null for any other."""
    c = F.col(hint) if isinstance(hint, str) else hint
    head = F.regexp_extract(F.lower(F.trim(c)), r"^(\p{L}+)(?:[-_ (].*)?$", 1)
    mapping = F.create_map(*[x for k, v in CODES.items() for x in (F.lit(k), F.lit(v))])
    return F.try_element_at(mapping, head)


def units(text: str | None) -> list[tuple[int, str, str]]:
    """(paragraph, kind, text) of the parts of a text that count: sentences, sheets and tables.

    Titles, headings, lone lines, code, formulas, quoted terms and fragments at the edges are left out.
    """
    if not text:
        return []
    for c in _INVISIBLE:
        if c in text:
            text = text.replace(c, "")
    if _TRIGGER.search(text):
        leaves, found = parse(text)
        if found:
            parts = []
            for path, s, brk in leaves:
                if any(k in path for k in _SKIP) or re.search(r"(?:^|/)h[1-6](?:/|$)", path):
                    parts.append("\n\n" if brk else " ")
                else:
                    parts.append(("\n\n" if brk else "") + s)
            text = "".join(parts)
    if "«" in text or '"' in text or "“" in text:
        text = _QUOTED.sub(" ", text)
    out: list[tuple[int, str, str]] = []
    for k, para in enumerate(_PARAGRAPH.split(text)):
        lines = [x for x in para.split("\n") if x.strip()]
        if lines and _HEADING.match(lines[0]) and len(lines[0]) < LONG:
            lines = lines[1:]
        if not lines:
            continue
        rows = [x for x in lines if "|" in x]
        if rows and len(rows) * 2 >= len(lines) and len(lines) > 1:
            out.append((k, "table", " ".join(x for x in lines if not x.strip().lower().startswith("table:"))))
            continue
        fields = [x for x in _PARTS.split(para) if x.strip()] if ":" in para else ()
        if len(fields) >= 2 and all(_FIELD.match(x.strip()) for x in fields):
            out.append((k, "table", para))
            continue
        body = "\n".join(_wrapped(lines)) if len(lines) > 1 else lines[0]
        if len(lines) > 1 and any(c in body for c in _MARKS):
            body = _CUT.sub("", body)
        for item in _OWN.split(body) if len(lines) > 1 else (body,):
            sentences = _sentences(item.replace("\n", " ").strip())
            for i, s in enumerate(sentences):
                whole = _ENDS.search(s) or i < len(sentences) - 1 or len(s) >= LONG
                if whole or "|" in s:
                    out.append((k, "sentence", s))
    return out


_PARTS = re.compile(r"[|;\n]")


def _sentences(s: str) -> list[str]:
    """Sentences with their end marks; an abbreviated article is no end."""
    out, at = [], 0
    for m in _STOP.finditer(s):
        k = m.start()
        if s[max(0, k - 3) : k].lower() == "art" and not s[max(0, k - 4) : k - 3].isalpha():
            continue
        out.append(s[at : m.end()].rstrip())
        at = m.end()
    if at < len(s):
        out.append(s[at:])
    return out


def _wrapped(lines: list[str]) -> list[str]:
    """The lines without furniture: short lines that end although the next line's first word had room."""
    if len(lines) < 2:
        return lines
    width = max(map(len, lines))
    out = []
    for x, y in zip(lines, lines[1:]):
        room = len(x.rstrip()) + 1 + len(y.split(None, 1)[0]) <= width
        if not (room and len(x) <= 70 and len(x.split()) <= 8 and not _ENDS.search(x)):
            out.append(x)
    out.append(lines[-1])
    return out


def letters(s: str) -> str:
    return _NOT_LETTER.sub(" ", s.casefold()).strip()


# --- automata --------------------------------------------------------------------------------

ALPHABET = " abcdefghijklmnopqrstuvwxyzàáâäæçèéêëìíîïñòóôöœùúûüßÿ\x00"
_OTHER = len(ALPHABET)
_WIDTH = len(ALPHABET) + 1
_CODE = {ord(c): i for i, c in enumerate(ALPHABET)}


def encode(s: str) -> np.ndarray:
    return _LOOKUP[np.frombuffer(s.encode("utf-16-le"), dtype=np.uint16)]


_LOOKUP = np.full(1 << 16, _OTHER, dtype=np.int64)
for _c, _i in _CODE.items():
    _LOOKUP[_c] = _i


def suffix_automaton(text: str) -> list[dict[int, int]]:
    """Transitions of the minimal automaton of all substrings of ``text`` (Blumer et al.)."""
    nxt: list[dict[int, int]] = [{}]
    link, length, last = [-1], [0], 0
    for ch in text:
        c = _CODE.get(ord(ch), _OTHER)
        cur = len(nxt)
        nxt.append({})
        link.append(0)
        length.append(length[last] + 1)
        p = last
        while p >= 0 and c not in nxt[p]:
            nxt[p][c] = cur
            p = link[p]
        if p >= 0:
            q = nxt[p][c]
            if length[q] == length[p] + 1:
                link[cur] = q
            else:
                clone = len(nxt)
                nxt.append(dict(nxt[q]))
                link.append(link[q])
                length.append(length[p] + 1)
                while p >= 0 and nxt[p].get(c) == q:
                    nxt[p][c] = clone
                    p = link[p]
                link[q] = link[cur] = clone
        last = cur
    return nxt


class Parser:
    """Cross-parses many units at once against the text of each language."""

    def __init__(self, texts: dict[str, str]):
        self.names = sorted(texts)
        tables, self.roots, base = [], [], 0
        for name in self.names:
            nxt = suffix_automaton(texts[name])
            size = len(nxt) + 1
            start = base + size - 1  # from here every letter begins a phrase; letters that the text lacks lead back
            table = np.empty((size, _WIDTH), dtype=np.int32)
            restart = np.full(_WIDTH, start, dtype=np.int32)
            for c, t in nxt[0].items():
                restart[c] = base + t
            table[:] = restart << 1 | 1  # a failed match begins a phrase with the letter at hand
            for s, moves in enumerate(nxt):
                for c, t in moves.items():
                    table[s, c] = (base + t) << 1
            tables.append(table)
            self.roots.append(start)
            base += size
        self.table = np.concatenate(tables).ravel() if tables else np.zeros(_WIDTH, dtype=np.int32)
        self.bits = np.array([math.log2(max(2, len(texts[n]))) for n in self.names])[:, None]

    def rates(self, items: list[str]) -> np.ndarray:
        """Bits a letter of each unit (columns) in each language (rows), over all its letters."""
        n = len(items)
        size = np.array([len(s) for s in items], dtype=np.int64)
        order = np.argsort(-size, kind="stable")
        flat = encode("".join(items[i] for i in order)) if n else np.zeros(0, dtype=np.int64)
        lens = size[order]
        start = np.concatenate(([0], np.cumsum(lens)[:-1])) if n else lens
        state = np.repeat(np.array(self.roots, dtype=np.int64)[:, None], n, axis=1)
        phrases = np.zeros((len(self.names), n), dtype=np.int32)
        active = n
        for t in range(int(lens[0]) if n else 0):
            while active and lens[active - 1] <= t:
                active -= 1
            at = state[:, :active] * _WIDTH
            at += flat[start[:active] + t]
            v = self.table[at]
            phrases[:, :active] += v & 1
            state[:, :active] = v >> 1
        out = np.empty((len(self.names), n))
        out[:, order] = phrases * self.bits / np.maximum(lens, 1)
        return out

    def classify(self, items: list[str]) -> list[tuple[str, float]]:
        """(language, lead) of each unit; the lead is the share by which the second needs more."""
        if not items or len(self.names) < 2:
            return [(self.names[0], 0.0)] * len(items) if self.names else []
        r = self.rates(items)
        rank = np.argsort(r, axis=0, kind="stable")
        col = np.arange(len(items))
        best, second = r[rank[0], col], r[rank[1], col]
        lead = 1 - best / np.maximum(second, 1e-9)
        return [(self.names[i], float(x)) for i, x in zip(rank[0], lead)]


def train(rows: DataFrame) -> dict[str, str]:
    """Text of each language from ``rows`` (id, text, label): a bounded, cleaned sample.

    Per label TRAIN_DOCS texts of at most TRAIN_CHARS characters, by the hash of their id. Their distinct units are kept if the words of the
    unit are likelier under its label than under any other, up to TRAIN_LETTERS letters a label.
    """
    labelled = rows.where("label is not null and text is not null").where(F.length("text") <= TRAIN_CHARS)
    sizes = {r.label: r.n for r in labelled.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not sizes:
        return {}
    share = F.lit(0.0)
    for label, n in sizes.items():
        share = F.when(F.col("label") == label, F.lit(min(1.0, 1.5 * TRAIN_DOCS / n + 50 / n))).otherwise(share)
    h = F.xxhash64("id")
    pool = labelled.where(F.pmod(h, F.lit(1_000_003)) < share * 1_000_003)
    w = Window.partitionBy("label").orderBy(h, "id")
    texts = pool.withColumn("k", F.row_number().over(w)).where(F.col("k") <= TRAIN_DOCS).select("label", "text").collect()
    by: dict[str, Counter[str]] = defaultdict(Counter)
    for r in texts:
        for _, _, u in units(r.text):
            u = letters(u)
            if len(u) >= MIN_LETTERS:
                by[r.label][u] += 1
    words = {k: Counter(w for u, n in c.items() for w in u.split() for _ in range(n)) for k, c in by.items()}
    total = {k: sum(c.values()) + 1 for k, c in words.items()}

    def fits(u: str) -> str:
        ws = u.split()
        return max(words, key=lambda k: (sum(math.log((words[k][x] + 0.1) / total[k]) for x in ws), k))

    out = {}
    for k, c in by.items():
        parts, size = [], 0
        for u, _ in sorted(c.items(), key=lambda x: (-x[1], x[0])):
            if size < TRAIN_LETTERS and fits(u) == k:
                parts.append(u)
                size += len(u) + 1
        if parts:
            out[k] = "\x00".join(parts)
    return out


_PARSERS: dict[int, Parser] = {}


def _parser(texts: dict[str, str]) -> Parser:
    key = hash(tuple(sorted(texts.items())))
    if key not in _PARSERS:
        _PARSERS.clear()
        _PARSERS[key] = Parser(texts)
    return _PARSERS[key]


def languages_of(items: list[tuple[int, str, str]], judged: dict[str, tuple[str, float]]) -> list[tuple[int, str, float, int]]:
    """(paragraph, language, confidence, letters) runs of a text's units.

    A unit without a clear lead takes the language of the clear ones of its paragraph, else of the whole
    text; without any, its own best. Units that were not judged (no language is trained) have none.
    """
    said = []
    for k, kind, u in items:
        s = letters(u)
        if s in judged and len(s) >= (MIN_TABLE_LETTERS if kind == "table" else MIN_LETTERS):
            said.append((k, *judged[s], len(s)))
    clear: dict[int | None, Counter[str]] = defaultdict(Counter)
    for k, lang, lead, n in said:
        if lead >= MIN_LEAD:
            clear[k][lang] += n
            clear[None][lang] += n
    out: list[tuple[int, str, float, int]] = []
    for k, lang, lead, n in said:
        if lead < MIN_LEAD:
            votes = clear.get(k) or clear.get(None)
            if votes:
                lang, lead = max(votes.items(), key=lambda x: (x[1], x[0]))[0], 0.0
        if out and out[-1][1] == lang:
            p, _, c, m = out[-1]
            out[-1] = (p, lang, (c * m + lead * n) / (m + n), m + n)
        else:
            out.append((k, lang, lead, n))
    return out


SEGMENTS = "tab string, row_id long, hint string, segments array<struct<paragraph:int,lang:string,confidence:double,letters:int>>"


def segments(rows: DataFrame, texts: dict[str, str]) -> DataFrame:
    """Language runs of ``rows`` (tab, row_id, text, hint); an empty array where nothing has a language."""
    held = rows.sparkSession.sparkContext.broadcast(texts)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        parser = _parser(held.value)
        for b in batches:
            parts = [units(t) for t in b["text"]]
            distinct = list({s for p in parts for _, _, u in p if len(s := letters(u)) >= MIN_LETTERS})
            judged = dict(zip(distinct, parser.classify(distinct)))
            yield pd.DataFrame(
                {
                    "tab": b["tab"].tolist(),
                    "row_id": b["row_id"],
                    "hint": b["hint"].tolist(),
                    "segments": [
                        [{"paragraph": k, "lang": x, "confidence": round(c, 4), "letters": n} for k, x, c, n in languages_of(p, judged)]
                        for p in parts
                    ],
                }
            )

    return rows.select("tab", "row_id", "text", "hint").mapInPandas(run, SEGMENTS)


def identified(rows: DataFrame, texts: dict[str, str]) -> DataFrame:
    """(tab, row_id, hint, lang_code, confidence, letters): each language of each text."""
    return (
        segments(rows, texts)
        .select("tab", "row_id", "hint", F.explode("segments").alias("s"))
        .groupBy("tab", "row_id", "hint", F.col("s.lang").alias("lang_code"))
        .agg(
            F.round(F.sum(F.col("s.confidence") * F.col("s.letters")) / F.sum("s.letters"), 4).alias("confidence"),
            F.sum("s.letters").alias("letters"),
        )
    )


def mislabelled(rows: DataFrame, texts: dict[str, str]) -> DataFrame:
    """(tab, row_id, lang_code): each language of the texts whose hint doesn't name their one language."""
    langs = F.array_distinct(F.transform("segments", lambda s: s["lang"]))
    return (
        segments(rows, texts)
        .select("tab", "row_id", code_column("hint").alias("code"), langs.alias("langs"))
        .where((F.size("langs") > 1) | ((F.size("langs") == 1) & ~F.col("code").eqNullSafe(F.element_at("langs", 1))))
        .select("tab", "row_id", F.explode("langs").alias("lang_code"))
    )

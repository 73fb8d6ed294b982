"""Noise of scanned pages: cut words, misread characters, running headers and page numbers.

Method: skip-gram vectors with negative sampling, learned from the counts of all pairs of neighbouring words; rare words
are linked to the frequent ones that plausible glyph edits lead to; each occurrence of a linked word is then judged in
its own context, by how likely the vectors make the frequent word among its neighbours. Then cut words are joined where
the whole word is known, furniture lines are dropped, and the lines are reflowed into paragraphs.

Word and pair counts are taken per task before the shuffle. Texts are never shuffled to find noise:
a row sends only its unknown words, doubtful cuts and possible header lines.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quirework.runtime import join_groups, materialize

# What a scanner reads -> what is printed.
GLYPHS = (
    ("c", "e"), ("1", "i"), ("1", "l"), ("|", "i"), ("|", "l"), ("†", "t"), ("@", "a"), ("0", "o"), ("5", "s"), ("9", "g"),
    ("8", "b"), ("$", "s"), ("ri", "n"), ("ii", "u"), ("rn", "m"), ("m", "rn"), ("vv", "w"), ("cl", "d"), ("d", "cl"),
)
#: So many of the most frequent words get skip-gram vectors; words beyond are judged by the counts of their pairs.
VOCABULARY = 20_000
DIMENSIONS = 32
#: Negative samples of a pair, drawn from so many words that a batch of pairs shares.
NEGATIVES, SHARED, BATCH = 5, 64, 2_048
#: Rounds in which first the one and then the other side's vectors are learned, and batches of a task in each at least.
EPOCHS, LEAST_BATCHES, PAIRS_A_TASK = 2, 250, 100_000
#: Pairs weigh as their count to this power.
SOFTEN = 0.75
#: So many of the most frequent words are sent to the tasks; rarer ones are looked up by join.
KNOWN_WORDS = 50_000
#: A word is rare beside another that occurs this many times as often.
RATIO = 8
MIN_FREQUENT = 5
#: A neighbour that stands this often counts half.
TRUST = 10.0
#: No single neighbour speaks louder than this for or against a word (log ratio).
LOUDEST = 4.0
#: Least mean log ratio by which the neighbours have to be likelier beside the frequent word than by chance: for words of
#: letters, for those with signs no word has, and where at least half of the word's occurrences are misread so.
MIN_SCORE, MIN_SCORE_ODD, MIN_SCORE_USUAL = 0.0, -1.0, -2.0
#: Without vectors, this share of the neighbours has to stand beside the frequent word elsewhere.
MIN_SHARE = 0.25
#: A word without any known neighbour, with signs no word has, has to be longer than this to be taken for its link.
MIN_ALONE = 4
#: A header returns at least so often; in documents of many rows it also has to look like one.
HEADER_TIMES = 3
#: Entries of a per-task count table before it is passed on.
FLUSH = 400_000

MARKS = "-‐\xac\xad"
_INVISIBLE = "​‌‍⁠﻿"
#: Words of a folded text, in which no underscore is left.
WORD = re.compile(r"[\w|@†$]+")
_LETTERS = re.compile(r"[^\W\d_]")
_ODD = re.compile(r"[\d|@†$]")
CUT = re.compile(rf"(?<=[\w|@†$])[{MARKS}][ \t]*\r?\n")
_CUT_WORD = re.compile(rf"(?<=[\w|@†$])[{MARKS}][ \t]*\r?\n[^\S\n]*\S+")
_NEXT = re.compile(r"[^\S\n]*([\w|@†$]+)")
PAGE = re.compile(
    r"(?i)(?:[-—–\[][ \t]*\d{1,4}[ \t]*[-—–\]]|\d{1,4}(?:[ \t]*/[ \t]*\d{1,4})?|(?:pag\.?|pagina|page|seite|página|p\.)[ \t]*\d{1,4}(?:[ \t]*(?:di|of|von|sur|de|/)[ \t]*\d{1,4})?)"
)
HEADING = re.compile(r"(?i)^(?:art(?:icolo|icle|ikel|ículo)?\.?[ \t]*\d|#|=|§|(?:sezione|section|capo|titolo|part|chapter)[ \t]+[\divx]+)")
_ATTACHED = re.compile(r"^\d{1,4}[ \t]{2,}|[ \t]{2,}\d{1,4}$|[ \t]\d{1,3}$|^\d{1,3}[ \t]")
#: A page number set apart from the line it stands in.
_SET_APART = re.compile(r"^\d{1,4}[ \t]{2,}|[ \t]{2,}\d{1,4}$")
_NOT_HEADER = re.compile(r"^!|!!|[|<>{}\\=`:*_\[\]]|''|[.;,!?]$")


def visible(text: str) -> str:
    for c in _INVISIBLE:
        if c in text:
            text = text.replace(c, "")
    return text


def fold(text: str) -> str:
    return visible(text).casefold().replace("_", " ")


def _first_half(text: str, end: int) -> str:
    """The word that ends at ``end``."""
    start = end
    while start and (text[start - 1].isalnum() or text[start - 1] in "_|@†$"):
        start -= 1
    return text[start:end]


def edits(word: str, most: int = 2) -> set[str]:
    """What ``word`` may stand for: up to ``most`` glyph edits undone."""
    seen, ring = set(), {word}
    for _ in range(most):
        nxt = set()
        for w in ring:
            for read, real in GLYPHS:
                at = w.find(read)
                while at >= 0:
                    nxt.add(w[:at] + real + w[at + len(read) :])
                    at = w.find(read, at + 1)
        ring = {w for w in nxt - seen - {word} if _LETTERS.search(w)}
        seen |= ring
    return seen


def _cut_spans(text: str) -> list[tuple[int, int]]:
    """Where the words stand that are cut at line ends, both halves and what parts them."""
    spans, at = [], 0
    for m in _CUT_WORD.finditer(text):
        spans.append((max(at, m.start() - len(_first_half(text, m.start()))), m.end()))
        at = m.end()
    return spans


def _without_cuts(text: str) -> str:
    """A text without the words cut at its line ends."""
    parts, at = [], 0
    for a, b in _cut_spans(text):
        parts.append(text[at:a])
        at = b
    return " ".join([*parts, text[at:]]) if parts else text


def said_words(text: str) -> list[str]:
    """The folded words of a text in order, numbers as one word, words cut at line ends left out."""
    text = visible(text).replace("_", " ").replace("ß", "ss")
    if "\n" in text:
        text = _without_cuts(text)
    folded = text.casefold()
    # Folding may take a letter apart, and with it a word (that of sharp s doesn't); then words are folded one by one.
    words = WORD.findall(folded) if len(folded) == len(text) else [w.casefold() for w in WORD.findall(text)]
    return ["0" if w.isdigit() else w for w in words]


# --- statistics ------------------------------------------------------------------------------


def statistics(rows: DataFrame) -> DataFrame:
    """(a, b, n): how often word ``a`` stands (``b`` null), and stands one or two words before ``b``.

    Words cut at a line end are left out, numbers count as one word. Counts cover every row.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words: Counter[str] = Counter()
        pairs: Counter[tuple[str, str]] = Counter()

        def out() -> Iterator[pd.DataFrame]:
            rows = [(w, None, n) for w, n in words.items()] + [(a, b, n) for (a, b), n in pairs.items()]
            yield pd.DataFrame(rows, columns=["a", "b", "n"])
            words.clear()
            pairs.clear()

        for batch in batches:
            for text in batch["text"]:
                if not text:
                    continue
                found = said_words(text)
                words.update(found)
                pairs.update(zip(found, found[1:]))
                pairs.update(zip(found, found[2:]))
            if len(pairs) > FLUSH:
                yield from out()
        yield from out()

    return (
        rows.select("text")
        .mapInPandas(run, "a string, b string, n long")
        .groupBy("a", "b")
        .agg(F.sum("n").alias("n"))
    )


def _edit_table(words: DataFrame) -> DataFrame:
    """(word, n, target): the glyph edits of each word; only the vocabulary passes here."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for w, n in zip(b["a"], b["n"]):
                if 3 <= len(w) <= 40 and _LETTERS.search(w):
                    rows += [(w, n, e, bool(_ODD.search(w))) for e in edits(w, 2 if len(w) > 5 else 1)]
            yield pd.DataFrame(rows, columns=["word", "n", "target", "odd"])

    return words.select("a", "n").mapInPandas(run, "word string, n long, target string, odd boolean")


def links(stats: DataFrame) -> DataFrame:
    """(word, n, targets array<struct<target, n, odd>>): rare words and the frequent ones they may stand for.

    A word of letters is rare if the other stands RATIO times as often; one with signs no word has, if as often.
    """
    words = stats.where("b is null").select("a", "n")
    frequent = words.where((F.col("n") >= MIN_FREQUENT) & ~F.regexp_like("a", F.lit(r"[0-9|@†$]"))).select(
        F.col("a").alias("target"), F.col("n").alias("target_n")
    )
    return (
        _edit_table(words)
        .join(frequent, "target")
        .where(F.col("target_n") >= F.when(F.col("odd"), 1.0).otherwise(float(RATIO)) * F.col("n"))
        .groupBy("word", "n")
        .agg(F.collect_set(F.struct("target", F.col("target_n").alias("n"), "odd")).alias("targets"))  # as many as a word has edits
    )


# --- skip-gram vectors -----------------------------------------------------------------------


class Vectors:
    """Skip-gram vectors of the vocabulary: ``v`` of words as centres, ``u`` as neighbours."""

    def __init__(self, words: list[str], v: np.ndarray, u: np.ndarray, trust: np.ndarray):
        self.ids = {w: i for i, w in enumerate(words) if trust[i] > 0}
        self.v, self.u, self.trust = v, u, trust

    def scores(self, targets: list[str], contexts: list[list[str]]) -> np.ndarray:
        """How much likelier the neighbours are beside the target than by chance, mean of logs; NaN if nothing is known.

        Rare neighbours count less.
        """
        t = np.array([self.ids.get(x, -1) for x in targets], np.int64)
        known = [[i for c in ctx if (i := self.ids.get(c)) is not None] for ctx in contexts]
        size = np.array([len(k) for k in known], np.int64)
        flat = np.fromiter((i for k in known for i in k), np.int64, int(size.sum()))
        out = np.full(len(t), np.nan)
        if not len(flat):
            return out
        own = np.repeat(np.arange(len(t)), size)
        dots = np.clip(np.einsum("ij,ij->i", self.v[t[own]], self.u[flat]) + np.log(NEGATIVES), -LOUDEST, LOUDEST)
        sums = np.bincount(own, dots * self.trust[flat], len(t))
        good = (size > 0) & (t >= 0)
        out[good] = sums[good] / size[good]
        return out


def _learn(x: np.ndarray, y: np.ndarray, weight: np.ndarray, noise: np.ndarray, own: np.ndarray, other: np.ndarray, batches: int, seed: int) -> None:
    """One side of skip-gram with negative sampling: ``own`` vectors of ``x`` in place, given those of the other side.

    Steps adapt to each word; the negatives are shared by a batch.
    """
    r = np.random.default_rng(seed)
    grown = np.full(len(own), 1e-3, np.float32)
    upto = np.cumsum(noise / noise.sum())
    batch = min(BATCH, len(x))
    sigmoid = lambda z: 1.0 / (1.0 + np.exp(-np.clip(z, -15, 15)))
    for _ in range(max(1, -(-batches * batch // len(x)))):
        order = r.permutation(len(x))
        for k in range(0, len(x), batch):
            i = order[k : k + batch]
            i = i[np.argsort(x[i], kind="stable")]
            w, u = weight[i][:, None], other[y[i]]
            drawn = other[np.minimum(np.searchsorted(upto, r.random(SHARED)), len(other) - 1)]
            v = own[x[i]]
            near = (1.0 - sigmoid(np.einsum("ij,ij->i", v, u)))[:, None] * w
            far = sigmoid(v @ drawn.T) * w * (NEGATIVES / SHARED)
            rows, first = np.unique(x[i], return_index=True)
            g = np.add.reduceat(near * u - far @ drawn, first, axis=0)
            grown[rows] += np.square(g).mean(axis=1)
            own[rows] += 0.3 * g / np.sqrt(grown[rows])[:, None]


def skip_grams(stats: DataFrame) -> Vectors:
    """Vectors of the VOCABULARY most frequent words that stand twice, from the counts of all their pairs.

    The pairs are dealt by their first word, and both sides are learned by turns: while the neighbours' vectors stand,
    those of the centres don't depend on each other, and the other way round. So each task learns its own words from all
    of their pairs, however many tasks there are; one table of VOCABULARY vectors goes to the tasks and comes back. The
    order of pairs and the samples are fixed, so equal data give equal vectors.
    """
    spark = stats.sparkSession
    top = stats.where("b is null and n > 1").orderBy(F.desc("n"), "a").limit(VOCABULARY).select("a", "n").collect()
    words = [r.a for r in top]
    often = np.array([r.n for r in top], np.float64)
    r = np.random.default_rng(1)
    v, u = (((r.random((len(words), DIMENSIONS)) - 0.5) / DIMENSIONS**0.5).astype(np.float32) for _ in range(2))
    if not words:
        return Vectors(words, v, u, often)
    ids = spark.createDataFrame(list(enumerate(words)), "id int, w string")
    named = lambda c: F.broadcast(ids.select(F.col("id").alias(f"{c}_id"), F.col("w").alias(c)))
    one = stats.where("b is not null").join(named("a"), "a").join(named("b"), "b").select(F.col("a_id").alias("x"), F.col("b_id").alias("y"), "n")
    pairs = one.unionByName(one.select(F.col("y").alias("x"), F.col("x").alias("y"), "n")).groupBy("x", "y").agg(F.pow(F.sum("n"), F.lit(SOFTEN)).alias("w"))
    pairs = materialize(pairs, "word-pairs")
    noise = np.full(len(words), 1e-9)
    for row in pairs.groupBy("x").agg(F.sum("w").alias("w")).collect():
        noise[row.x] = row.w
    dealt = pairs.repartition(max(1, -(-pairs.count() // PAIRS_A_TASK)), "x").sortWithinPartitions("x", "y")
    least = LEAST_BATCHES
    for turn in range(2 * EPOCHS):
        own, other = (v, u) if turn % 2 == 0 else (u, v)
        held = spark.sparkContext.broadcast((own, other, noise))

        def run(batches: Iterator[pd.DataFrame], held=held, turn=turn) -> Iterator[pd.DataFrame]:
            mine = [b for b in batches if len(b)]
            if not mine:
                return
            p = pd.concat(mine)
            own, other, noise = held.value
            rows, x = np.unique(p["x"].to_numpy(), return_inverse=True)
            made = own[rows].copy()
            _learn(x, p["y"].to_numpy(), p["w"].to_numpy().astype(np.float32), noise, made, other, least, turn)
            yield pd.DataFrame({"rows": [rows.astype(np.int32).tobytes()], "made": [made.tobytes()]})

        for m in dealt.mapInPandas(run, "rows binary, made binary").collect():
            own[np.frombuffer(m["rows"], np.int32)] = np.frombuffer(m["made"], np.float32).reshape(-1, DIMENSIONS)
        held.unpersist()
    # a word without pairs has learned nothing
    return Vectors(words, v, u, np.where(noise > 1e-9, often / (often + TRUST), 0.0))


# --- evidence of each row --------------------------------------------------------------------

EVIDENCE = "tab string, row_id long, doc_id string, pos int, kind string, k string, line long, strong boolean, context array<string>"
#: The candidates of a cut are numbered by break and line: this many for each break.
LINES = 1 << 32


def header_key(line: str) -> str:
    """A line without its page number, case and spacing."""
    s = _ATTACHED.sub("", visible(line).strip())
    return " ".join(s.split()).casefold()


class Scanner:
    """Finds in one text what may be noise, given true words and, of all words, those that stand for no other."""

    def __init__(self, known: frozenset[str], silent: frozenset[str]):
        self.known, self.silent = known, silent

    def __call__(self, text: str, title: bool) -> list[tuple[str, str, int, bool, list[str] | None]]:
        out: list[tuple[str, str, int, bool]] = []
        folded = fold(text)
        if "\n" in folded:
            self._lines(text, title, out)
            for m in CUT.finditer(folded):
                self._cut(folded, m, out)
        if title and "\n" not in folded:
            out.append(("title", header_key(text), 0, False))
        found = [(*e, None) for e in out]
        if any(not w.isdigit() for w in set(WORD.findall(folded)) - self.silent):  # few texts have such a word
            words = said_words(text)
            doubtful = [i for i, w in enumerate(words) if w not in self.silent and len(w) > 2 and _LETTERS.search(w)]
            found += [("word", words[i], i, False, words[max(0, i - 2) : i] + words[i + 1 : i + 3]) for i in doubtful]
        return found

    def _cut(self, folded: str, m: re.Match, out: list) -> None:
        """A word cut at a line end: the second half opens one of the next lines, furniture between.

        Unless the halves on both sides of the break make a known word, every whole word they may make is handed
        on ('cut', or 'cut-number' where the second half is a number), numbered by break and line; ``strong`` marks
        the first of letters only.
        """
        first = _first_half(folded, m.start())
        if not _LETTERS.search(first):
            return
        at, doubtful, k = m.end(), True, 0
        while True:
            n = _NEXT.match(folded, at)
            if n:
                whole = first + n.group(1)
                known = whole in self.known
                if known and k == 0:
                    out.append(("hyphen", whole, 0, True))
                    return
                letters = doubtful and n.group(1).isalpha()
                out.append(("cut-number" if n.group(1).isdigit() else "cut", whole, m.start() * LINES + k, letters))
                if known:
                    return
                doubtful = doubtful and not letters
            end = folded.find("\n", at)
            if end < 0:
                break
            at, k = end + 1, k + 1

    def _lines(self, text: str, title: bool, out: list) -> None:
        lines = [x.strip() for x in text.split("\n")]
        page = [0 < len(x) < 30 and bool(PAGE.fullmatch(x)) for x in lines]
        no_case = text == text.lower()
        for i, s in enumerate(lines):
            if page[i]:
                out.append(("page", s, i, True))
            elif 3 < len(s) <= 100 and (no_case or not s[0].islower()) and not _NOT_HEADER.search(s) and not HEADING.match(s) and s[-1] not in MARKS:
                key = header_key(s)
                if len(key) < 4 or not _LETTERS.search(key):
                    continue
                attached = bool(_ATTACHED.search(s))
                last = i == len(lines) - 1
                beside = (i > 0 and page[i - 1]) or (not last and page[i + 1])
                upper = s.upper() == s
                out.append(("title" if title else "numbered" if attached else "line", key, i, bool(_SET_APART.search(s)) or last or beside or upper))


def scan(rows: DataFrame, known: frozenset[str], silent: frozenset[str]) -> DataFrame:
    """Evidence of ``rows`` (tab, row_id, doc_id, pos, title, text)."""
    held = rows.sparkSession.sparkContext.broadcast((known, silent))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        scanner = Scanner(*held.value)
        for b in batches:
            out = []
            for tab, row_id, doc_id, pos, title, text in zip(b["tab"], b["row_id"], b["doc_id"], b["pos"], b["title"], b["text"]):
                if text:
                    out += [(tab, row_id, doc_id, pos, *e) for e in scanner(text, bool(title))]
            yield pd.DataFrame(out, columns=[c.split()[0] for c in EVIDENCE.split(", ")])

    known_pos = F.coalesce("pos", F.lit(-1)).alias("pos")
    return rows.select("tab", "row_id", "doc_id", known_pos, "title", "text").where("text is not null").mapInPandas(run, EVIDENCE)


def headers(evidence: DataFrame, rows: DataFrame) -> DataFrame:
    """(doc_id, k, n): the running headers of each document and their places.

    A header is a line that returns at HEADER_TIMES places or more of one table's reading of a document
    (a place read twice counts once) and is none of its titles. Where it has less than a twentieth of the
    document's rows, half of its places, and three at least, have to look like page breaks: with or beside a page
    number, last in their block, in capitals. Lines that differ from a header only after its first comma or dash
    (its year, say) are headers too.
    """
    places = (
        evidence.where("kind in ('line', 'numbered', 'title')")
        .groupBy("doc_id", "k", "tab", "pos", "line")
        .agg(F.max("strong").alias("strong"), F.max(F.col("kind") == "title").alias("title"))
    )
    lines = places.groupBy("doc_id", "k", "tab").agg(
        F.count(F.lit(1)).alias("n"), F.count_if("strong").alias("strong"), F.max("title").alias("title")
    )
    size = rows.groupBy("doc_id", "tab").agg(F.count(F.lit(1)).alias("rows"))
    often = F.col("n") * 20 >= F.col("rows")
    breaks = (F.col("strong") >= 3) & (F.col("strong") * 2 >= F.col("n"))
    known = (
        lines.join(size, ["doc_id", "tab"])
        .groupBy("doc_id", "k")
        .agg(F.max("title").alias("title"), F.max((F.col("n") >= HEADER_TIMES) & (often | breaks)).alias("returns"), F.sum("n").alias("n"))
        .where("not title")
        .withColumn("stem", F.element_at(F.split("k", " - |, "), 1))
    )
    known = materialize(known, "lines")
    stems = known.where("returns").select("doc_id", "stem").distinct()
    return known.join(stems, ["doc_id", "stem"], "left_semi").select("doc_id", "k", "n")


def judged(occurrences: DataFrame, stats: DataFrame, linked: DataFrame, vectors: Vectors) -> DataFrame:
    """(tab, row_id, line, word, fix): which of the ``occurrences`` (tab, row_id, line, word, context) are misread.

    An occurrence stands for the linked word that its neighbours make likeliest, if they make it likely enough: likelier
    than chance does for a word of letters, a little less for one with signs no word has, still less where at least half
    of the word's occurrences are misread so. Where the vectors know neither word nor neighbours, MIN_SHARE of the
    neighbours have to stand beside that word somewhere. One without any known neighbour follows the word's other
    occurrences; if none of these is misread, it is if it is longer than MIN_ALONE and has signs no word has. Ties go to
    the more frequent word, then to the last in order. The same word may stand for different ones at different places,
    or for itself.
    """
    held = occurrences.sparkSession.sparkContext.broadcast(vectors)
    total = stats.where("b is null").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    cand = join_groups(occurrences, linked, "word", "n", total).select("tab", "row_id", "line", "word", "context", F.explode("targets").alias("t"))
    cand = cand.select("tab", "row_id", "line", "word", "context", "t.target", F.col("t.n").alias("target_n"), "t.odd")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield b.assign(score=held.value.scores(b["target"].tolist(), [list(c) for c in b["context"]]))

    schema = "tab string, row_id long, line long, word string, context array<string>, target string, target_n long, odd boolean, score double"
    at = ["tab", "row_id", "line", "word"]
    scored = materialize(cand.mapInPandas(run, schema).withColumn("score", F.when(~F.isnan("score"), F.col("score"))), "scored")
    pairs = stats.where("b is not null")
    beside = pairs.select(F.col("a").alias("target"), F.col("b").alias("c")).unionByName(pairs.select(F.col("b").alias("target"), F.col("a").alias("c"))).distinct()
    unscored = scored.where("score is null and size(context) > 0").select(*at, "target", "context", F.posexplode("context").alias("i", "c"))
    shares = unscored.join(beside.withColumn("hit", F.lit(1)), ["target", "c"], "left").groupBy(*at, "target").agg((F.count("hit") / F.count(F.lit(1))).alias("share"))
    both = scored.join(shares, [*at, "target"], "left")
    alone = F.col("score").isNull() & (F.coalesce("share", F.lit(0.0)) == 0)
    good = F.coalesce(F.col("score") > F.when(F.col("odd"), MIN_SCORE_ODD).otherwise(MIN_SCORE), F.col("share") >= MIN_SHARE)
    likely = F.struct(F.coalesce("score", "share"), "target_n", "target")
    signs = F.when(F.col("odd") & (F.length("word") > MIN_ALONE), F.struct("target_n", "target"))
    seen = both.groupBy(*at).agg(
        F.max_by(F.when(good, F.col("target")), F.when(good, likely)).alias("fix"), F.max_by(F.struct("target", "score"), likely).alias("next"),
        F.min(alone).alias("alone"), F.max(signs).alias("signs"),
    )
    seen = materialize(seen, "judged")
    fixes = seen.groupBy("word", "fix").agg(F.count(F.lit(1)).alias("n"))
    usual = fixes.groupBy("word").agg(F.max_by("fix", F.when(F.col("fix").isNotNull(), F.struct("n", "fix"))).alias("usual"), F.sum("n").alias("of"), F.max(F.when(F.col("fix").isNotNull(), F.col("n"))).alias("most"))
    rest = join_groups(seen.where("fix is null"), usual, "word", "of", total)
    lone = F.when(F.col("alone"), F.coalesce("usual", "signs.target"))
    again = F.when((F.col("next.target") == F.col("usual")) & (F.col("next.score") > MIN_SCORE_USUAL) & (F.col("most") * 2 >= F.col("of")), F.col("usual"))
    rest = rest.select(*at, F.coalesce(lone, again).alias("fix"))
    return seen.select(*at, "fix").unionByName(rest).where("fix is not null")


class Noise:
    """The noise of a collection: statistics, vectors and evidence, each computed once."""

    def __init__(self, rows: DataFrame):
        self.rows = rows
        self.stats = materialize(statistics(rows), "words")
        self.links = materialize(links(self.stats), "links")
        top = self.stats.where("b is null").orderBy(F.desc("n"), "a").limit(KNOWN_WORDS).select(F.col("a").alias("word"), F.col("n").alias("often"))
        words = top.join(self.links.select("word", F.lit(True).alias("linked")), "word", "left").collect()
        silent = frozenset(r.word for r in words if not r.linked)
        known = frozenset(r.word for r in words if not r.linked and r.often > 1)
        self.evidence = materialize(scan(rows, known, silent), "evidence")
        occurrences = self.evidence.where("kind = 'word'").select("tab", "row_id", "line", F.col("k").alias("word"), "context")
        self.misread = materialize(judged(occurrences, self.stats, self.links, skip_grams(self.stats)), "misread")
        self.doubtful = materialize(self._doubtful(), "cuts")

    def cuts(self) -> DataFrame:
        """(tab, row_id, word, fix): words cut at line ends, and what the word stands for if it is misread as well."""
        sure = self.evidence.where("kind = 'hyphen'").select("tab", "row_id", F.col("k").alias("word"), F.lit(None).cast("string").alias("fix"))
        return sure.unionByName(self.doubtful)

    def _doubtful(self) -> DataFrame:
        """As :meth:`cuts`, of the cuts that have to be looked up in the whole vocabulary.

        Of a cut's candidates the first line counts that makes a true word (one that stands twice and is mostly no misreading)
        or one glyph edits away from it, the most frequent of these; else the first of letters, if it stands anywhere.
        """
        cand = self.evidence.where("kind in ('cut', 'cut-number')")
        words = self.stats.where("b is null").select(F.col("a").alias("target"), "n")
        wrong = self.misread.groupBy(F.col("word").alias("target")).agg(F.count(F.lit(1)).alias("wrong"))
        true = words.where("n > 1").join(wrong, "target", "left").where("coalesce(wrong, 0) * 2 <= n").drop("wrong")

        def edited(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for b in batches:
                yield pd.DataFrame([(k, e) for k in b["k"] for e in edits(k)], columns=["k", "target"])

        open_ = cand.where("kind = 'cut' and length(k) > 3").select("k").distinct().mapInPandas(edited, "k string, target string")
        fixes = open_.join(true, "target").groupBy("k").agg(F.max_by("target", F.struct("n", "target")).alias("fix"))
        own = cand.select("k").distinct().join(words.withColumnRenamed("target", "k"), "k").select("k", F.lit(True).alias("stands"))
        own = own.join(true.select(F.col("target").alias("k"), F.lit(True).alias("true")), "k", "left")
        hit = F.coalesce("true", F.lit(False)) | (F.col("fix").isNotNull() & (F.col("kind") == "cut"))
        found = F.struct(F.col("k").alias("word"), F.when(F.col("true").isNull() & (F.col("kind") == "cut"), F.col("fix")).alias("fix"))
        fallback = F.col("strong") & F.coalesce("stands", F.lit(False))
        return (
            cand.join(own, "k", "left")
            .join(fixes, "k", "left")
            .groupBy("tab", "row_id", F.floor(F.col("line") / LINES))
            .agg(F.min_by(F.when(hit, found), F.when(hit, F.col("line"))).alias("hit"), F.max(F.when(fallback, F.col("k"))).alias("else"))
            .select("tab", "row_id", F.coalesce("hit.word", "else").alias("word"), F.col("hit.fix").alias("fix"))
            .where("word is not null")
        )

    def header_lines(self) -> DataFrame:
        """(tab, row_id, k, numbered) of every row with a header line."""
        name = F.concat_ws("\x00", "doc_id", "k")  # a long document's header may be a tenth of all rows
        lines = self.evidence.where("kind in ('line', 'numbered')").select(
            "tab", "row_id", "k", (F.col("kind") == "numbered").alias("numbered"), name.alias("name")
        )
        heads = headers(self.evidence, self.rows).select(name.alias("name"), "n")
        return join_groups(lines, heads, "name", "n", self.evidence.count()).select("tab", "row_id", "k", "numbered")

    def found(self) -> DataFrame:
        """(tab, row_id, noise), once for each noise in the text of a row."""
        head = materialize(self.header_lines(), "headers")
        as_noise = lambda df, name: df.select("tab", "row_id", F.lit(name).alias("noise"))
        return (
            as_noise(self.misread, "misread")
            .unionByName(as_noise(self.cuts().where("fix is not null"), "misread"))
            .unionByName(as_noise(self.cuts(), "hyphen"))
            .unionByName(as_noise(self.evidence.where("kind = 'page'"), "page_number"))
            .unionByName(as_noise(head.where("numbered"), "page_number"))
            .unionByName(as_noise(head, "header"))
            .distinct()
        )

    def repaired(self) -> DataFrame:
        """(tab, row_id, text): every row's text without noise, in whole paragraphs.

        Exactly what :meth:`found` reports is repaired: misread words at the places judged misread, cut words, header
        and page number lines.
        """
        fixes = self.misread.groupBy("tab", "row_id").agg(F.map_from_entries(F.collect_set(F.struct("line", "fix"))).alias("fixes"))
        heads = self.header_lines().groupBy("tab", "row_id").agg(F.collect_set("k").alias("heads"))
        cut = self.cuts().groupBy("tab", "row_id", "word").agg(F.max("fix").alias("fix"))
        cut = cut.groupBy("tab", "row_id").agg(F.map_from_entries(F.collect_list(F.struct("word", F.coalesce("fix", "word")))).alias("cuts"))
        keyed = self.rows.select("tab", "row_id", "text")
        for part in (fixes, heads, cut):
            keyed = keyed.join(part, ["tab", "row_id"], "left")

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for b in batches:
                texts = [
                    repair(t, dict(f) if f is not None else {}, set(h) if h is not None else set(), dict(c) if c is not None else {})
                    for t, f, h, c in zip(b["text"], b["fixes"], b["heads"], b["cuts"])
                ]
                yield pd.DataFrame({"tab": b["tab"].tolist(), "row_id": b["row_id"], "text": texts})

        return keyed.mapInPandas(run, "tab string, row_id long, text string")


# --- repair ----------------------------------------------------------------------------------

_OWN_LINE = re.compile(r"^\s*(?:$|[-*•>|!#=`{}\\<]|\w{1,2}\) |Table:)|[ \t]\|[ \t]|:\s*\S+$|^[^:\n]{1,30}: |^    ")


_HALF = re.compile(rf"([\w|@†$]+)[{MARKS}][ \t]*$")


def repair(text: str | None, fixes: dict[int, str], heads: set[str], cuts: dict[str, str]) -> str:
    """The text without furniture, its cut words joined, its misread words replaced and its lines reflowed.

    ``fixes`` are by the number of the word in the text (:func:`said_words`), ``cuts`` the whole words that cut ones
    make, and what they stand for. Lines that stand for themselves (tables, fields, lists, headings, code) keep their
    breaks. Signs without width go.
    """
    if not text:
        return ""
    text = visible(text)
    if fixes:
        text = _corrected(text, fixes)
    lines = text.replace("\r\n", "\n").split("\n")
    if len(lines) > 1:
        lines = [x for x in lines if not (PAGE.fullmatch(x.strip()) or (x.strip() and header_key(x) in heads))]
    out: list[str] = []
    for line in lines:
        prev = out[-1] if out else ""
        m = _HALF.search(prev)
        n = _NEXT.match(line)
        whole = fold(m.group(1) + n.group(1)) if m and n else None
        if whole in cuts:
            word = m.group(1) + n.group(1)
            word = word if cuts[whole] == whole else _as_case(word, cuts[whole])
            out[-1] = prev[: m.start(1)] + word + line[n.end() :]
        elif out and prev.strip() and line.strip() and not _OWN_LINE.search(line) and not _OWN_LINE.search(prev) and not HEADING.match(prev):
            out[-1] = prev.rstrip() + " " + line.lstrip()
        else:
            out.append(line.rstrip())
    return re.sub(r"\n{3,}", "\n\n", "\n".join(out)).strip()


def _corrected(text: str, fixes: dict[int, str]) -> str:
    """The text with the words of the given numbers replaced; they are counted as :func:`said_words` does."""
    plain = text.replace("_", " ")
    spans = _cut_spans(plain) if "\n" in plain else []
    parts, at, k, cut = [], 0, 0, 0
    for m in WORD.finditer(plain):
        while cut < len(spans) and spans[cut][1] <= m.start():
            cut += 1
        if cut < len(spans) and spans[cut][0] < m.end():
            continue
        if k in fixes:
            parts += [text[at : m.start()], _as_case(m.group(), fixes[k])]
            at = m.end()
        k += 1
    return "".join([*parts, text[at:]])


def _as_case(word: str, fix: str) -> str:
    letters = [c for c in word if c.isalpha()]
    if len(letters) > 1 and all(c.isupper() for c in letters):
        return fix.upper()
    return fix.capitalize() if letters and word[0].isupper() else fix

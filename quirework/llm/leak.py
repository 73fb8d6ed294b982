"""Held-out evaluation texts in a training corpus: which documents hold which items.

Method: rare n-grams seed the search, Smith-Waterman alignment scores what they join.

1. One pass over the corpus, whatever the number of items: each document is read once, and the stretches around
   n-grams of SEED words that may belong to an item go on as passages. Whether they may is looked up in a bit map of
   fixed greatest size; a hit that is none costs a row and changes nothing.
2. The seeds of an item are its rare n-grams: those that stand at most RARE times in the passages, and, however often
   it stands, the rarer of the two n-grams in every run of RUN words, so that no unbroken run is without a seed.
3. Seeds join passages to items. Each pair is aligned by Smith-Waterman over words: the score finds edited copies, and
   a pair that doesn't align over at least RUN words is dropped. Of the others, the unbroken runs of RUN words or more
   are counted; a document holds an item if they make up SHARE of the item's words.

Only passages are shuffled, never texts. Words and n-grams are compared by 64-bit hashes.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quirework.llm.markup import TRIGGER, plain
from quirework.runtime import join_groups, materialize

#: Words of a seed, and of an unbroken run.
SEED, RUN = 4, 5
#: A document holds an item from this share of the item's words on.
SHARE = 0.4
#: A copy without such runs is reported as edited from this alignment score on (1 is the whole item, word by word).
EDITED = 0.5
#: An n-gram that stands at most so often in the passages is a seed.
RARE = 50
#: Bits of the map for each entry, and the most it may have (16 MB). Beyond, more hits are none; the result is the same.
BITS, MAX_BITS = 64, 1 << 27
#: Words of a batch that are looked up at once.
BATCH_WORDS = 500_000

WORD = re.compile(r"[^\W_]+")
_TRIGGER = re.compile(TRIGGER)
_INVISIBLE = re.compile("[​‌‍⁠﻿]")
_CUT = re.compile(r"[-‐\xac\xad][ \t]*\r?\n\s*")
_FIRST_HALF = re.compile(r"[^\W\d_]+\Z")
_SECOND_HALF = re.compile(r"[^\W\d_]+")
_FURNITURE = re.compile(
    r"(?mi)^[ \t]*(?:[-—–\[][ \t]*\d{1,4}[ \t]*[-—–\]]|\d{1,4}(?:[ \t]*/[ \t]*\d{1,4})?|(?:pag\.?|page|seite|página|p\.)[ \t]*\d{1,4}(?:[ \t]+\w{2,3}[ \t]+\d{1,4})?)[ \t]*\r?$"
)
_NUMBERED = re.compile(r"^\d+\s{2,}|\s{2,}\d+$")


def words_of(text: str | None) -> list[str]:
    return WORD.findall(_INVISIBLE.sub("", text or "").casefold())


# --- hashes and the bit map ------------------------------------------------------------------

_MULTIPLIER, _MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)
#: Words are entered in the map under two other hashes each, as a wrong hit would join two halves.
_AS_WORD = (np.uint64(0xA24BAED4963EE407), np.uint64(0x9FB21C651E98DF25))


class Codes(dict):
    """64-bit codes of words, computed once a word."""

    def __missing__(self, word: str) -> int:
        if len(self) > 1_000_000:
            self.clear()
        code = self[word] = xxhash.xxh64_intdigest(word.encode("utf-8", "surrogatepass"))
        return code

    def of(self, words: list[str]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * _MIX
    return h ^ (h >> np.uint64(29))


def grams(codes: np.ndarray, n: int) -> np.ndarray:
    """Hashes of the runs of ``n`` words, by where they start."""
    if len(codes) < n:
        return np.empty(0, np.uint64)
    size = len(codes) - n + 1
    h = codes[:size].copy()
    for k in range(1, n):
        h = h * _MULTIPLIER + codes[k : k + size]
    return _mixed(h)


class BitMap:
    """A set of hashes that may take others for its own. ``bits`` is a power of two."""

    def __init__(self, words: np.ndarray, bits: int):
        self.words, self.power = words, np.uint64(bits.bit_length() - 1)

    @staticmethod
    def places(h: np.ndarray, power: np.uint64) -> tuple[np.ndarray, np.ndarray]:
        top = h >> (np.uint64(64) - power)
        return top, (h << power) >> (np.uint64(64) - power)

    def __contains__(self, word: int) -> bool:
        return bool(all(self.hits(_mixed(np.array([word], np.uint64) ^ c))[0] for c in _AS_WORD))

    def hits(self, h: np.ndarray) -> np.ndarray:
        a, b = self.places(h, self.power)
        return (self._at(a) & self._at(b)).astype(bool)

    def _at(self, place: np.ndarray) -> np.ndarray:
        return (self.words[place >> np.uint64(6)] >> (place & np.uint64(63))) & np.uint64(1)


def _bit_map(entries: DataFrame, n: int) -> BitMap:
    """The map of ``entries`` (h). It is filled in the tasks; the driver gets its words, at most MAX_BITS bits."""
    bits = 1 << min(MAX_BITS.bit_length() - 1, max(10, (BITS * max(n, 1) - 1).bit_length()))
    power = bits.bit_length() - 1
    h = F.col("h")
    first, second = F.shiftrightunsigned(h, 64 - power), F.shiftrightunsigned(F.shiftleft(h, power), 64 - power)
    place = entries.select(F.explode(F.array(first, second)).alias("p"))
    one = F.expr("shiftleft(1L, cast(p & 63 as int))")
    filled = place.groupBy(F.shiftrightunsigned("p", 6).alias("at")).agg(F.bit_or(one).alias("word")).toPandas()
    words = np.zeros(bits // 64, np.uint64)
    words[filled["at"].to_numpy()] = filled["word"].to_numpy().astype(np.int64).view(np.uint64)
    return BitMap(words, bits)


# --- items and passages ----------------------------------------------------------------------

_signed = lambda h: h.view(np.int64)


def coded_items(items: DataFrame) -> DataFrame:
    """(k, item_id, words, codes, grams): items with their words' codes and the hashes of their n-grams."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        codes = Codes()
        for b in batches:
            rows = []
            for i, text in zip(b["item_id"], b["text"]):
                c = codes.of(words_of(plain(text)))
                if len(c) >= SEED:
                    rows.append((i, len(c), c.tobytes(), _signed(grams(c, SEED))))
            yield pd.DataFrame(rows, columns=["item_id", "words", "codes", "grams"])

    coded = items.select("item_id", "text").where("text is not null").mapInPandas(run, "item_id long, words int, codes binary, grams array<long>")
    return coded.distinct().withColumn("k", F.xxhash64("item_id", "codes"))


def _readings(text: str, known: BitMap, codes: Codes) -> Iterator[list[str]]:
    """Words of a document without tags and page numbers, words cut at line ends made whole.

    Lines that return may be page furniture that interrupts a passage, or a passage that returns: one reading
    leaves them all out, one keeps them all, and one leaves out those that hold no seed.
    """
    if _TRIGGER.search(text):
        text = plain(text)
    text = _INVISIBLE.sub("", text)
    if "\n" not in text:
        yield WORD.findall(text.casefold())
        return

    def join(m: re.Match) -> str:
        """Nothing between two halves of a known word, the break itself elsewhere."""
        a = _FIRST_HALF.search(m.string, m.string.rfind("\n", 0, m.start()) + 1, m.start())
        b = a and _SECOND_HALF.match(m.string, m.end())
        return "" if b and codes[(a.group() + b.group()).casefold()] in known else m.group()

    text = _FURNITURE.sub("", text)
    lines, keys, often = _returning(text)
    seeded = {k for k in often if known.hits(grams(codes.of(WORD.findall(k)), SEED)).any()}
    for left_out in (often, often - seeded if seeded else None, set()) if often else (set(),):
        if left_out is not None:
            kept = "\n".join(x for x, k in zip(lines, keys) if k not in left_out) if left_out else text
            yield WORD.findall(_CUT.sub(join, kept).casefold())


def _returning(text: str) -> tuple[list[str], list[str], set[str]]:
    """Lines, their keys, and the keys of lines that return three times or more, if short and no sentence."""
    lines = text.split("\n")
    keys = [" ".join(_NUMBERED.sub("", x.strip()).casefold().split()) if 3 < len(x) <= 100 and x[-1] not in ".;:,?!" else "" for x in lines]
    count = Counter(keys)
    del count[""]
    return lines, keys, {k for k, n in count.items() if n >= 3}


def _stretches(hits: np.ndarray, margin: int, words: int) -> Iterator[tuple[int, int, np.ndarray]]:
    """(start, end, hits) of the passages of a reading: hits no more than two margins apart, and a margin around."""
    for part in np.split(hits, np.flatnonzero(np.diff(hits) > 2 * margin) + 1):
        yield max(0, int(part[0]) - margin), min(words, int(part[-1]) + SEED + margin), part


def passages(documents: DataFrame, known: BitMap, margin: int) -> DataFrame:
    """(doc_id, codes, hits): stretches of the documents around what may be n-grams of items, ``margin`` words wide."""
    held = documents.sparkSession.sparkContext.broadcast((known.words, 1 << int(known.power)))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bits, codes = BitMap(*held.value), Codes()
        names = ["doc_id", "codes", "hits"]

        def found(read: list[tuple[int, np.ndarray]]) -> pd.DataFrame:
            every = np.concatenate([c for _, c in read])
            h = grams(every, SEED)
            ends = np.cumsum([len(c) for _, c in read])
            at = np.flatnonzero(bits.hits(h))
            own = np.searchsorted(ends, at, "right")
            at, own = (x[at + SEED <= ends[own]] for x in (at, own))  # none over the end of its reading
            rows, seen, last = [], set(), None
            for r in np.unique(own):
                doc_id, c = read[r]
                start = int(ends[r]) - len(c)
                if doc_id != last:
                    seen, last = set(), doc_id
                for a, b, hits in _stretches(at[own == r] - start, margin, len(c)):
                    said = c[a:b].tobytes()
                    if said not in seen:  # readings often agree
                        seen.add(said)
                        rows.append((doc_id, said, np.unique(_signed(h[hits + start]))))
            return pd.DataFrame(rows, columns=names)

        for b in batches:
            read, n = [], 0
            for doc_id, text in zip(b["doc_id"], b["text"]):
                for words in _readings(text, bits, codes) if text else ():
                    if len(words) >= SEED:
                        read.append((doc_id, codes.of(words)))
                        n += len(words)
                if n > BATCH_WORDS:
                    yield found(read)
                    read, n = [], 0
            if read:
                yield found(read)

    return documents.select("doc_id", "text").where("text is not null").mapInPandas(run, "doc_id long, codes binary, hits array<long>")


def smith_waterman(a: list[np.ndarray], b: list[np.ndarray], match: int = 2, mismatch: int = -1, gap: int = -1) -> np.ndarray:
    """Best local alignment scores of pairs of word sequences; a word is a number above 1.

    All pairs go on together, row by row; the gaps within a row come from a running maximum. In whole numbers, so that
    nothing is rounded.
    """
    wide, high = (max(map(len, s), default=0) for s in (a, b))
    x, y = np.zeros((len(a), wide), np.uint64), np.ones((len(b), high), np.uint64)  # what is filled up equals nothing
    for k, (p, q) in enumerate(zip(a, b)):
        x[k, : len(p)], y[k, : len(q)] = p, q
    ramp = np.arange(wide + 1, dtype=np.int32) * np.int32(gap)
    prev, row = np.zeros((len(a), wide + 1), np.int32), np.zeros((len(a), wide + 1), np.int32)
    best = np.zeros((len(a), wide + 1), np.int32)
    for k in range(high):
        gain = np.where(x == y[:, k : k + 1], np.int32(match), np.int32(mismatch))
        np.maximum(prev[:, :-1] + gain, prev[:, 1:] + np.int32(gap), out=row[:, 1:])
        np.maximum(row, 0, out=row)
        row -= ramp
        np.maximum.accumulate(row, axis=1, out=row)
        row += ramp
        np.maximum(best, row, out=best)
        prev, row = row, prev
        row[:, 0] = 0
    return best.max(axis=1)


def seeds(items: DataFrame, hits: DataFrame) -> DataFrame:
    """(gram, k): the rare n-grams of each item, by how many passages hold them (``hits``: gram)."""
    often = hits.groupBy("gram").agg(F.count(F.lit(1)).alias("n"))
    own = items.select("k", F.posexplode("grams").alias("q", "gram")).join(often, "gram", "left")
    w = Window.partitionBy("k").orderBy("q")  # an item's own n-grams
    n = F.coalesce("n", F.lit(0))
    own = own.select("k", "gram", "n", (n <= F.lead(n).over(w)).alias("first"), (n < F.lag(n).over(w)).alias("second"))
    # one that stands nowhere can't join
    return own.where((F.col("n") <= RARE) | (F.col("n").isNotNull() & (F.col("first") | F.col("second")))).select("gram", "k", "n").distinct()


ALIGNED = "item_id long, doc_id long, words int, starts array<int>, aligned int"
#: Words of the passages that are aligned together.
TOGETHER = 30_000


def _align(pairs: DataFrame) -> DataFrame:
    """Alignment score and starts (in the item) of the unbroken runs of RUN words, of each passage and item."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            said = [np.frombuffer(x, np.uint64) for x in b["codes"]]
            item = [np.frombuffer(x, np.uint64) for x in b["item"]]
            starts = [np.flatnonzero(np.isin(grams(y, RUN), grams(x, RUN))).astype(np.int32) for x, y in zip(said, item)]
            scores = np.zeros(len(b), np.int32)
            order = sorted(range(len(b)), key=lambda i: (len(said[i]), len(item[i])))
            while order:
                n = max(1, TOGETHER // len(said[order[-1]]))
                part, order = order[-n:], order[:-n]
                scores[part] = smith_waterman([said[i] for i in part], [item[i] for i in part])
            yield pd.DataFrame({"item_id": b["item_id"], "doc_id": b["doc_id"], "words": [len(y) for y in item], "starts": starts, "aligned": scores})

    return pairs.select("item_id", "doc_id", "codes", "item").mapInPandas(run, ALIGNED)


def overlaps(documents: DataFrame, items: DataFrame) -> DataFrame:
    """(item_id, doc_id, covered, words, share, score) of every pair that a seed joins and RUN aligned words confirm.

    ``share`` is that of the item's words in unbroken runs of RUN words or more, ``score`` the best local alignment
    against that of the whole item. Null and empty texts on either side share nothing, nor do items shorter than SEED
    words. Documents and items repeated under one id count as one, the pair's best.
    """
    own = materialize(coded_items(items), "items")
    head = own.agg(F.coalesce(F.max("words"), F.lit(0)), F.coalesce(F.sum(F.size("grams") + 2 * F.col("words")), F.lit(0))).first()
    held = materialize(passages(documents, _bit_map(_entries(own), int(head[1])), int(head[0])).withColumn("p", F.monotonically_increasing_id()), "passages")
    hits = held.select("p", F.explode("hits").alias("gram"))
    seed = materialize(seeds(own, hits), "seeds")
    total = hits.count()
    pairs = materialize(join_groups(hits, seed, "gram", "n", total).select("p", "k").distinct(), "pairs")
    often = pairs.groupBy("k").agg(F.count(F.lit(1)).alias("n"))
    wanted = own.select("k", "item_id", F.col("codes").alias("item")).join(often, "k")
    aligned = _align(join_groups(pairs.join(held.select("p", "doc_id", "codes"), "p"), wanted, "k", "n", pairs.count()))
    run = F.transform(F.flatten(F.collect_set("starts")), lambda s: F.sequence(s, s + RUN - 1))
    g = aligned.groupBy("item_id", "doc_id", "words").agg(F.size(F.array_distinct(F.flatten(run))).alias("covered"), F.max("aligned").alias("aligned"))
    return (
        g.where(F.col("aligned") >= 2.0 * RUN)
        .withColumn("share", F.col("covered") / F.col("words"))
        .withColumn("score", F.col("aligned") / (2.0 * F.col("words")))
        .groupBy("item_id", "doc_id")
        .agg(F.max_by(F.struct("covered", "words", "share", "score"), F.struct("share", "score", "words")).alias("b"))
        .select("item_id", "doc_id", "b.covered", "b.words", "b.share", "b.score")
    )


def _entries(items: DataFrame) -> DataFrame:
    """(h): what the bit map holds of the items, their n-grams and their words."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for codes, own in zip(b["codes"], b["grams"]):
                words = np.frombuffer(codes, np.uint64)
                yield pd.DataFrame({"h": np.concatenate([np.asarray(own, np.int64), *(_signed(_mixed(words ^ c)) for c in _AS_WORD)])})

    return items.select("codes", "grams").mapInPandas(run, "h long")


def leaked(documents: DataFrame, items: DataFrame, share: float = SHARE) -> DataFrame:
    """(item_id, doc_id): the documents that hold an item, or at least ``share`` of its words in unbroken runs."""
    return overlaps(documents, items).where(F.col("share") >= share - 1e-9).select("item_id", "doc_id")


def by_document(documents: DataFrame, items: DataFrame) -> DataFrame:
    """(doc_id, items, edited, best_share, best_score): each affected document and the items leaked into it.

    ``items`` are those held by the rule of :func:`leaked`, ``edited`` those of which an edited copy aligns with a
    score of EDITED or more though too little of it is unbroken.
    """
    holds = F.col("share") >= SHARE - 1e-9
    listed = lambda c: F.array_sort(F.collect_set(F.when(c, F.col("item_id"))))
    return (
        overlaps(documents, items)
        .where(holds | (F.col("score") >= EDITED))
        .groupBy("doc_id")
        .agg(
            listed(holds).alias("items"),
            listed(~holds).alias("edited"),
            F.round(F.max("share"), 6).alias("best_share"),
            F.round(F.max("score"), 6).alias("best_score"),
        )
    )

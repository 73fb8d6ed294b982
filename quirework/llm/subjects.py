"""Subject areas of each document.

Method: labelling functions under a model that learns how far to trust each. They vote for or against
each subject of a document: the lexicon (a word of its sentences, or two in one sentence), the
address (street names), the section (its title) and the source. Nobody knows their accuracies; they are learned by
expectation maximisation from how they agree and differ over all documents, and a document gets the
subjects of high posterior probability that at least one whole sentence is about.

The lexicon starts from the labelled samples, some of which are wrong or lacking for a language, and is
learned from the collection: sentences vote for a subject of their document, and a word belongs to a
subject if the documents that hold it do, counted over all of them. Words that stand everywhere (and the
names in addresses, which do) thereby fall out. Words spelled alike carry a subject to other languages.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections import Counter, defaultdict
from collections.abc import Iterator
from difflib import SequenceMatcher

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quirework.llm.language import units
from quirework.llm.ocr import WORD, edits, fold
from quirework.runtime import materialize

#: Labelled samples read at most, by order of their ids.
MAX_SAMPLES = 100_000
#: Rounds of learning at most; it ends before when no more than one word in STABLE comes, goes or changes its subject.
ROUNDS = 5
STABLE = 20
#: Weights of a subject's very name in a title, and of a word spelled like it: either settles a document's subject
#: while the lexicon is learned.
NAMED = 3.0
LIKE_NAMED = 2.0
#: A word of the lexicon stands in framed sentences in at least this share of its documents.
FRAMED = 0.5
ANYWHERE = "\x00"
#: So many words are compared with those of known subject in one task.
LIKE_WORDS = 2_000
#: A word belongs to a subject if this share of the documents that hold it (and have a subject) are about it,
PURITY = 0.6
#: if at 1.96 standard errors the share is still this large (four of four documents are just enough),
SURE = 0.5
#: if its odds are this many times those of the subject over all documents,
LIFT = 3.0
#: and if this share of the documents that hold it have a subject at all.
LABELLED = 0.05
POSTERIOR = 0.5

# What streets and squares are called.
STREETS = (
    "via viale piazza piazzale largo corso vicolo street avenue lane square road passage court rue allée place boulevard"
    " calle plaza paseo pasaje avenida straße strasse gasse weg platz allee"
).split()
_STREET = re.compile(rf"\b(?:{'|'.join(STREETS)})\b|(?:straße|strasse|gasse|weg|platz|allee)\b")
_GAP = re.compile(r"[^\w|@†$\n]+")
_NUMBER = re.compile(r"(?m)(?<![^ \n])\d+(?: |$)|^ | $")
_LETTERS = re.compile(r"[^\W\d_]{3,}")

PREPARED = "doc_id long, source string, title string, body string"


def prepared(documents: DataFrame) -> DataFrame:
    """(doc_id, source, title, body): the first line and the sentences of each text, folded, one a line."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            titles, bodies = [], []
            for text in b["text"]:
                text = text or ""
                titles.append(" ".join(_LETTERS.findall(fold(text.lstrip().split("\n", 1)[0]))))
                bodies.append(prepare(text))
            yield pd.DataFrame({"doc_id": b["doc_id"], "source": b["source"].tolist(), "title": titles, "body": bodies})

    return documents.select("doc_id", "source", "text").mapInPandas(run, PREPARED)


def words_only(body: str) -> str:
    """Folded words of each line, parted by single spaces, without numbers."""
    return _NUMBER.sub("", _GAP.sub(" ", fold(body)))


class Lexicon:
    """Subjects of words, and of sentences by their words."""

    def __init__(self, weights: dict[str, tuple[str, float]], known: frozenset[str] = frozenset(), frames: frozenset[str] = frozenset()):
        self.weights, self.known, self.frames = weights, known, frames
        self.memo: dict[str, tuple[str, float, int] | None] = {}

    def sentence(self, s: str) -> tuple[str, float, int] | None:
        """(subject, strength, mentions of it) of a folded sentence, or None. Ties go to the first subject in order."""
        if s in self.memo:
            return self.memo[s]
        votes: dict[str, float] = {}
        words: Counter[str] = Counter()
        said = s.split(" ")
        for w in dict.fromkeys(said):
            hit = self.weights.get(w)
            if hit is None and self.known and len(w) > 4 and w not in self.known:
                hit = next((self.weights[e] for e in sorted(edits(w, 1)) if e in self.weights), None)
            if hit:
                votes[hit[0]] = votes.get(hit[0], 0.0) + hit[1]
                words[hit[0]] += said.count(w)
        best = None
        if votes:
            subject, strength = max(sorted(votes.items()), key=lambda x: x[1])
            best = (subject, strength, words[subject])
        if len(self.memo) > 200_000:
            self.memo.clear()
        self.memo[s] = best
        return best


def seed_words(samples: list[tuple[str | None, str | None]]) -> tuple[dict[str, tuple[str, float]], frozenset[str]]:
    """(seeds, frame words) of the labelled samples.

    Frame words are the longer words that samples of several subjects (four, where there are so many) share: what is said of any subject. A sentence
    with two of them is about some subject, and its other words are seeds if nearly all their samples agree. The
    words of other sentences, which stand beside any subject, are thereby left out.
    """
    texts = [(prepare(t or ""), s) for t, s in samples if s]
    shared: dict[str, Counter[str]] = defaultdict(Counter)
    for body, s in texts:
        for w in set(body.split()):
            shared[w][s] += 1
    several = max(2, min(4, len({s for _, s in texts})))
    frames = frozenset(w for w, c in shared.items() if len(w) > 4 and sum(c.values()) >= 4 and len(c) >= several)
    by: dict[str, Counter[str]] = defaultdict(Counter)
    for body, s in texts:
        for line in body.split("\n"):
            words = line.split()
            if is_framed(words, frames):
                for w in words:
                    if len(w) > 3 and w not in frames:
                        by[w][s] += 1
    out = {}
    for w, c in by.items():
        s, k = max(sorted(c.items()), key=lambda x: x[1])
        if k / sum(c.values()) >= 0.75:
            out[w] = (s, k / (sum(c.values()) + 0.5))
    return out, frames


def is_framed(words: list[str], frames: frozenset[str]) -> bool:
    """Whether a sentence has two frame words; where the samples share none, no sentence is told from another."""
    return not frames or sum(w in frames for w in words) >= 2


def prepare(text: str) -> str:
    """Folded sentences of a text, one a line."""
    return words_only("\n".join([u for _, kind, u in units(text) if kind == "sentence"]))


def decided(votes: dict[str, float]) -> str | None:
    """The subject with the most votes, if they amount to one sentence and to half as many again as any other's."""
    if not votes:
        return None
    ranked = sorted(votes.items(), key=lambda x: (-x[1], x[0]))
    second = ranked[1][1] if len(ranked) > 1 else 0.0
    return ranked[0][0] if ranked[0][1] >= 0.7 and ranked[0][1] >= 1.5 * second else None


def word_subjects(
    docs: DataFrame, lexicon: dict[str, tuple[str, float]], frames: frozenset[str], subjects: list[str], everywhere: bool
) -> DataFrame:
    """(word, subject, n): in how many documents of each subject a word stands in a framed sentence.

    If ``everywhere``, counts over all documents are given under '', and those of any sentence under ANYWHERE.

    A document's subject is the one its title names, else the one its sentences clearly vote for, if any
    (:func:`decided`); title words are counted as ``title:word``.
    Counts are taken per task first, over every document.
    """
    held = docs.sparkSession.sparkContext.broadcast((lexicon, frames))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        lexicon_, frames_ = held.value
        lex = Lexicon(lexicon_)
        framed: dict[str, frozenset[str]] = {}

        def topical(s: str) -> frozenset[str]:
            words = framed.get(s)
            if words is None:
                if len(framed) > 200_000:
                    framed.clear()
                said = s.split(" ")
                words = framed[s] = frozenset(said) - frames_ if is_framed(said, frames_) else frozenset()
            return words

        counts: dict[str, Counter[str]] = {s: Counter() for s in ["", ANYWHERE, *subjects]}

        def out() -> pd.DataFrame:
            rows = [(w, s, k) for s, c in counts.items() for w, k in c.items()]
            for c in counts.values():
                c.clear()
            return pd.DataFrame(rows, columns=["word", "subject", "n"])

        for b in batches:
            for title, body in zip(b["title"], b["body"]):
                votes: Counter[str] = Counter()
                said = [(s, t) for s in body.split("\n") if (t := topical(s))]
                for s, _ in said:
                    hit = lex.sentence(s)
                    if hit:
                        votes[hit[0]] += min(1.0, hit[1])
                names = [x for w in title.split(" ") if (x := lexicon_.get("title:" + w))]
                sure = {s for s, weight in names if weight >= LIKE_NAMED}
                for s, weight in names:
                    votes[s] += weight
                subject = sure.pop() if len(sure) == 1 else decided(votes)
                if not (subject or everywhere):
                    continue
                words = set().union(*(t for _, t in said))
                words.update("title:" + w for w in title.split(" "))
                words.add("*")
                if everywhere:
                    counts[""].update(words)
                    counts[ANYWHERE].update(set(body.replace("\n", " ").split(" ")))
                if subject:
                    counts[subject].update(words)
            if sum(map(len, counts.values())) > 500_000:
                yield out()
        yield out()

    return (
        docs.select("title", "body")
        .mapInPandas(run, "word string, subject string, n long")
        .groupBy("word", "subject")
        .agg(F.sum("n").alias("n"))
    )


def pure_words(counts: DataFrame, everywhere: DataFrame) -> dict[str, tuple[str, float]]:
    """Words of one subject, with their purity as weight."""
    shares = {r.subject: r.n for r in counts.where("word = '*'").collect()}
    shares = {s: n for s, n in shares.items() if s and s != ANYWHERE}
    total = max(1, sum(shares.values()))
    prior = F.create_map(*[x for s, n in shares.items() for x in (F.lit(s), F.lit(n / total))]) if shares else None
    if prior is None:
        return {}
    z2 = F.lit(1.96**2)
    labelled = counts.where((F.col("subject") != "") & (F.col("subject") != ANYWHERE) & (F.col("word") != "*"))
    best = labelled.groupBy("word").agg(
        F.max_by("subject", F.struct("n", "subject")).alias("subject"), F.max("n").alias("k"), F.sum("n").alias("labelled")
    )
    rows = (
        best.join(everywhere, "word")
        .withColumn("purity", F.col("k") / F.col("labelled"))
        .withColumn("prior", F.try_element_at(prior, F.col("subject")))
        .withColumn("sure", (F.col("purity") + z2 / (F.col("labelled") * 2) - 1.96 * F.sqrt(
            F.col("purity") * (1 - F.col("purity")) / F.col("labelled") + z2 / (F.col("labelled") * F.col("labelled") * 4)
        )) / (1 + z2 / F.col("labelled")))
        .where(
            (F.col("purity") >= PURITY)
            & (F.col("sure") >= SURE)
            & (F.col("labelled") / F.col("docs") >= LABELLED)
            & (F.col("docs") >= FRAMED * F.coalesce("any_docs", "docs"))
            & F.regexp_like("word", F.lit(r"^(?:title:)?\p{L}+$"))
            & (F.col("purity") * (1 - F.col("prior")) >= LIFT * F.col("prior") * (1 - F.col("purity")))
            & (F.length(F.regexp_replace("word", "^title:", "")) > 3)
        )
        .select("word", "subject", "purity")
        .collect()
    )
    return {r.word: (r.subject, float(r.purity)) for r in rows}


def plain_letters(w: str) -> str:
    return "".join(c for c in unicodedata.normalize("NFD", w) if not unicodedata.combining(c))


def cognates(lexicon: dict[str, tuple[str, float]], words: list[str]) -> dict[str, tuple[str, float]]:
    """Words spelled nearly like others whose subject is known, with the subject those agree on.

    Subjects are named alike in many languages, so what is known in one carries over to another. A word's own label
    doesn't count; words whose likes disagree get none, unless one is a subject's very name. Words are compared if their first three letters are equal, those
    of titles with those of titles.
    """
    likes: dict[tuple[bool, str], list[tuple[str, str, str]]] = defaultdict(list)
    for w, (s, _) in sorted(lexicon.items()):
        t = plain_letters(w.removeprefix("title:"))
        likes[w.startswith("title:"), t[:3]].append((t, s, w))
    out = {}
    for w in words:
        titled = w.startswith("title:")
        t = plain_letters(w.removeprefix("title:"))
        if len(t) < 5:
            continue
        near, named = set(), set()
        for u, s, own in likes.get((titled, t[:3]), ()):
            if own != w and abs(len(u) - len(t)) <= 4:
                m = SequenceMatcher(None, t, u, autojunk=False)
                if m.quick_ratio() >= 0.75 and m.ratio() >= 0.75:
                    (named if own == "title:" + s else near).add(s)
        agreed = named or near
        if len(agreed) == 1:
            out[w] = (agreed.pop(), LIKE_NAMED if titled else 0.5)
    return out


def likes(words: DataFrame, lexicon: dict[str, tuple[str, float]]) -> dict[str, tuple[str, float]]:
    """:func:`cognates` of every word of ``words`` (word), some words a task."""
    held = words.sparkSession.sparkContext.broadcast(lexicon)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = cognates(held.value, b["word"].tolist())
            yield pd.DataFrame([(w, *x) for w, x in out.items()], columns=["word", "subject", "weight"])

    rows = words.select("word").mapInPandas(run, "word string, subject string, weight double").collect()
    return {r.word: (r.subject, r.weight) for r in rows}


def learn(docs: DataFrame, samples: DataFrame, areas: DataFrame) -> tuple[dict[str, tuple[str, float]], frozenset[str], list[str]]:
    """(lexicon, known words, subjects) learned from the samples and the prepared documents."""
    subjects = sorted({r.subject for r in areas.select("subject").where("subject is not null").collect()})
    drawn = samples.where(F.col("subject").isin(subjects)).orderBy("sample_id").limit(MAX_SAMPLES).collect()
    names = {"title:" + s: (s, NAMED) for s in subjects}
    seeds, frames = seed_words([(r.text, r.subject) for r in drawn])
    lexicon = voters = seeds | names
    for k in range(ROUNDS):
        counts = materialize(word_subjects(docs, voters, frames, subjects, k == 0), "word-subjects")
        if k == 0:
            anywhere = counts.where(F.col("subject") == ANYWHERE).select("word", F.col("n").alias("any_docs"))
            everywhere = counts.where("subject = ''").select("word", F.col("n").alias("docs")).join(anywhere, "word", "left")
            everywhere = materialize(everywhere, "everywhere")
            common = everywhere.where("docs > 2 and length(word) > 4").select("word")
            common = materialize(common.repartition(1 + common.count() // LIKE_WORDS), "common")
        before, lexicon = lexicon, pure_words(counts, everywhere) | names
        # The likes of a word outvote its own label for the next round only: a wrong sample may have set that.
        voters = lexicon | likes(common, lexicon)
        changed = sum(before.get(w, ("",))[0] != s for w, (s, _) in lexicon.items()) + len(before.keys() - lexicon.keys())
        if k > 1 and changed * STABLE <= len(lexicon):
            break
    known = frozenset(r.word for r in anywhere.where("any_docs > 2").select("word").collect())
    return lexicon, known, subjects


VOTES = "doc_id long, source string, subject string, sentences int, words int, address boolean, section boolean"


def votes(docs: DataFrame, lexicon: dict[str, tuple[str, float]], known: frozenset[str], subjects: list[str]) -> DataFrame:
    """One row for each document and subject with any vote: sentences of the lexicon, address and section votes."""
    body = {w: x for w, x in lexicon.items() if not w.startswith("title:")}
    titles = {w[6:]: x[0] for w, x in lexicon.items() if w.startswith("title:")}
    stems = {w[:5]: s for w, s in sorted(titles.items())}
    held = docs.sparkSession.sparkContext.broadcast((body, known, titles, stems))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words, known_, title_words, name_stems = held.value
        lex = Lexicon(words, known_)
        streets: dict[str, set[str]] = {}
        for b in batches:
            out = []
            for doc_id, source, title, text in zip(b["doc_id"], b["source"], b["title"], b["body"]):
                n: Counter[str] = Counter()
                mentions: Counter[str] = Counter()
                address: set[str] = set()
                for s in text.split("\n"):
                    hit = lex.sentence(s)
                    if hit:
                        n[hit[0]] += 1
                        mentions[hit[0]] = max(mentions[hit[0]], hit[2])
                        continue
                    named = streets.get(s)
                    if named is None:
                        if len(streets) > 200_000:
                            streets.clear()
                        named = {name_stems[w[:5]] for w in s.split(" ") if w[:5] in name_stems} if _STREET.search(s) else set()
                        streets[s] = named
                    address |= named
                section = {title_words[w] for w in title.split(" ") if w in title_words}
                for s in sorted({*n, *address, *section}):
                    out.append((doc_id, source, s, n[s], mentions[s], s in address, s in section))
            yield pd.DataFrame(out, columns=[c.split()[0] for c in VOTES.split(", ")])

    return docs.mapInPandas(run, VOTES)


#: ``lexicon``: a sentence has a word of the subject; ``phrase``: one has two.
FUNCTIONS = ("lexicon", "phrase", "address", "section", "source")


def accuracies(patterns: list[tuple[tuple[int, ...], float]], steps: int = 100) -> tuple[float, list[tuple[float, float]]]:
    """Prior and, of each labelling function, (rate of votes where the subject holds, rate where not).

    Expectation maximisation over the counts of vote patterns. The lexicon is taken to be better than chance
    at the start; nothing else is assumed of any function.
    """
    k = len(FUNCTIONS)
    prior, rates = 0.1, [(0.9, 0.05)] * 2 + [(0.5, 0.2)] * (k - 2)
    total = sum(n for _, n in patterns) or 1.0
    for _ in range(steps):
        post = [(p, n, posterior(p, prior, rates)) for p, n in patterns]
        on = sum(n * q for _, n, q in post)
        off = total - on
        prior = min(0.999, max(1e-4, on / total))
        rates = [
            (
                min(0.999, max(0.001, (sum(n * q for p, n, q in post if p[i]) + 0.1) / (on + 0.2))),
                min(0.999, max(0.001, (sum(n * (1 - q) for p, n, q in post if p[i]) + 0.1) / (off + 0.2))),
            )
            for i in range(k)
        ]
    return prior, rates


def posterior(pattern: tuple[int, ...], prior: float, rates: list[tuple[float, float]]) -> float:
    log_odds = math.log(prior / (1 - prior))
    for vote, (a, b) in zip(pattern, rates):
        log_odds += math.log(a / b) if vote else math.log((1 - a) / (1 - b))
    return 1 / (1 + math.exp(-max(-60.0, min(60.0, log_odds))))


def posteriors(documents: DataFrame, samples: DataFrame, areas: DataFrame) -> DataFrame:
    """(doc_id, subject, sentences, posterior) of every pair with any vote.

    Null and empty texts have no votes. Without samples or subjects nothing is found. Samples with a
    null or unknown subject are ignored.
    """
    docs = materialize(prepared(documents), "sentences")
    lexicon, known, subjects = learn(docs, samples, areas)
    v = materialize(votes(docs, lexicon, known, subjects), "votes")
    # A source speaks for a subject if more of its documents than of all are about it.
    totals = docs.groupBy("source").agg(F.count(F.lit(1)).alias("docs"))
    per = v.where("sentences > 0").groupBy("source", "subject").agg(F.count(F.lit(1)).alias("n"))
    all_docs = docs.count() or 1
    overall = per.groupBy("subject").agg((F.sum("n") / all_docs).alias("overall"))
    leaning = (
        per.join(totals, per["source"].eqNullSafe(totals["source"]))
        .select(per["source"], "subject", (F.col("n") / F.col("docs")).alias("share"))
        .join(overall, "subject")
        .where("share > 1.5 * overall")
        .select(F.col("source").alias("src"), F.col("subject").alias("subj"), F.lit(1).alias("leans"))
    )
    on = v["source"].eqNullSafe(leaning["src"]) & (v["subject"] == leaning["subj"])
    flags = v.join(leaning, on, "left").select(
        "doc_id", "subject", "sentences",
        (F.col("sentences") > 0).cast("int").alias("lexicon"), (F.col("words") > 1).cast("int").alias("phrase"), F.col("address").cast("int").alias("address"),
        F.col("section").cast("int").alias("section"), F.coalesce("leans", F.lit(0)).alias("source"),
    )
    seen = [(tuple(int(r[f]) for f in FUNCTIONS), float(r["count"])) for r in flags.groupBy(*FUNCTIONS).count().collect()]
    silent = all_docs * max(1, len(subjects)) - sum(n for _, n in seen)
    prior, rates = accuracies([*seen, ((0,) * len(FUNCTIONS), max(0.0, float(silent)))])
    table = [(*p, posterior(p, prior, rates)) for p, _ in seen]
    schema = ", ".join(f"{f} int" for f in FUNCTIONS) + ", posterior double"
    scored = documents.sparkSession.createDataFrame(table, schema)
    return flags.join(F.broadcast(scored), list(FUNCTIONS)).select("doc_id", "subject", "sentences", "posterior")


def subjects_of(documents: DataFrame, samples: DataFrame, areas: DataFrame) -> DataFrame:
    """(doc_id, subject): subjects of high posterior that a whole sentence of the document is about."""
    return (
        posteriors(documents, samples, areas)
        .where((F.col("posterior") >= POSTERIOR) & (F.col("sentences") > 0))
        .select("doc_id", "subject")
        .distinct()
    )


def composition(documents: DataFrame, samples: DataFrame, areas: DataFrame) -> DataFrame:
    """(subject, docs): documents of each subject."""
    found = subjects_of(documents, samples, areas).groupBy("subject").agg(F.count(F.lit(1)).alias("docs"))
    return areas.select("subject").distinct().join(found, "subject", "left").select("subject", F.coalesce("docs", F.lit(0)).alias("docs"))

"""p9: held-out accuracy on planted subjects, the latent model, and the defined cases."""

import random

from quirework.llm import subjects as S

DOCS, SAMPLES, AREAS = "doc_id long, text string, source string", "sample_id int, text string, subject string", "subject string, gloss string"
WORDS = {
    "music": ["harmony", "counterpoint", "orchestra", "singing", "violin", "organ"],
    "law": ["courts", "contracts", "liability", "procedure", "consumer", "tribunal"],
    "sport": ["rowing", "fencing", "swimming", "volleyball", "training", "referee"],
}
GENERAL = ["Applicants must confirm the request in due time.", "The office publishes the ranking next week.", "The branch at Music Lane is open to visitors from nine.", "An appeal may reach the board within some days."]


def planted(n=300):
    r = random.Random(5)
    docs, truth = [], set()
    for d in range(n):
        mine = r.sample(sorted(WORDS), r.choice((0, 1, 1, 1, 2)))
        body = [r.choice(GENERAL) for _ in range(4)]
        for s in mine:
            truth.add((d, s))
            body += ["The course deals with {} and offers hours on {}.".format(*r.sample(WORDS[s], 2)) for _ in range(3)]
        r.shuffle(body)
        docs.append((d, f"Call for the grant ({mine[0] if mine else 'general'})\n\n" + " ".join(body), r.choice("ab")))
    samples = [(i, "The course deals with {} and offers hours on {}. ".format(*r.sample(WORDS[s], 2)) + r.choice(GENERAL), s) for i, s in enumerate(sorted(WORDS) * 6)]
    samples += [(90, samples[0][1], "sport"), (91, None, "law"), (92, "unlabelled", None), (93, "other", "unknown")]
    return docs, samples, truth


def test_planted_subjects(spark):
    docs, samples, truth = planted()
    areas = spark.createDataFrame([(s, "") for s in WORDS], AREAS)
    df = spark.createDataFrame([(*d, "z") for d in docs], DOCS + ", subject string")
    got = {(r.doc_id, r.subject) for r in S.subjects_of(df, spark.createDataFrame(samples, SAMPLES), areas).collect()}
    assert len(got & truth) / len(truth) > 0.95 and len(got & truth) / len(got) > 0.95
    n = {r.subject: r.docs for r in S.composition(df, spark.createDataFrame(samples, SAMPLES), areas).collect()}
    assert set(n) == set(WORDS) and sum(n.values()) == len(got)


def test_cases(spark):
    areas = spark.createDataFrame([(s, None) for s in WORDS], AREAS)
    none = spark.createDataFrame([], SAMPLES)
    rows = spark.createDataFrame([(1, None, None), (2, "", "a"), (3, "x " * 50_000, "a"), (3, "x", "a")], DOCS)
    assert S.subjects_of(rows, none, areas).count() == 0
    assert S.subjects_of(spark.createDataFrame([], DOCS), none, areas).count() == 0
    assert S.subjects_of(rows, none, spark.createDataFrame([], AREAS)).count() == 0


def test_latent_model_learns_accuracies():
    r = random.Random(1)
    rate = [(0.95, 0.02), (0.9, 0.01), (0.3, 0.3), (0.7, 0.05), (0.5, 0.4)]
    seen = {}
    for _ in range(20_000):
        y = r.random() < 0.2
        p = tuple(int(r.random() < (a if y else b)) for a, b in rate)
        seen[p] = seen.get(p, 0) + 1
    prior, got = S.accuracies([(p, float(n)) for p, n in seen.items()])
    assert abs(prior - 0.2) < 0.02
    assert all(abs(x - y) < 0.05 for a, b in zip(got, rate) for x, y in zip(a, b))


def test_no_word_is_left_out_for_being_rare(spark):
    letters = lambda i: "zq" + "".join(chr(97 + int(c)) for c in f"{i:06d}")
    many = [letters(i) for i in range(55_000)]
    counts = spark.createDataFrame([("*", "law", 500), ("*", "physics", 500), *((w, "law", 10) for w in many)], "word string, subject string, n long")
    everywhere = spark.createDataFrame([(w, 10, 10) for w in many], "word string, docs long, any_docs long")
    assert len(S.pure_words(counts, everywhere)) == len(many)
    docs = spark.createDataFrame([("title", "requested candidates publish " + " ".join([*many, "zzbiologie"]))] * 3, "title string, body string")
    samples = [(k, f"The requested candidates publish {w} and more.", s) for k, (w, s) in enumerate([("biologia", "biology"), ("statute", "law")] * 4)]
    areas = spark.createDataFrame([("biology",), ("law",)], "subject string")
    _, known, _ = S.learn(docs, spark.createDataFrame(samples, "sample_id long, text string, subject string"), areas)
    assert known >= {*many, "zzbiologie"}
    lexicon = {"biologia": ("biology", 0.9)}
    words = spark.createDataFrame([(w,) for w in [*many[:25_000], "biologie"]], "word string").repartition(3)
    assert S.likes(words, lexicon) == S.cognates(lexicon, ["biologie"]) != {}


def test_texts_without_shared_frames(spark):
    """Samples and documents in a style of their own: short notes that have nothing but their subject's words in common."""
    r = random.Random(9)
    nonce = lambda k: ["".join(r.choice("bdglmnrtv") + r.choice("aeiou") for _ in range(4)) for _ in range(k)]
    note = lambda s: " ".join(r.sample(WORDS[s], 3) + nonce(2)).capitalize() + "."
    idle = lambda: " ".join(nonce(5)).capitalize() + "."
    docs, truth = [], set()
    for d in range(300):
        s = r.choice([*sorted(WORDS), None])
        body = [note(s) for _ in range(3)] if s else []
        truth |= {(d, s)} if s else set()
        docs.append((d, "Note\n\n" + " ".join(body + [idle() for _ in range(3)]), "a"))
    samples = [(i, f"{note(s)} {idle()}", s) for i, s in enumerate(sorted(WORDS) * 8)]
    assert not S.seed_words([(t, s) for _, t, s in samples])[1], "no frame words"
    got = {(x.doc_id, x.subject) for x in S.subjects_of(spark.createDataFrame(docs, DOCS), spark.createDataFrame(samples, SAMPLES), spark.createDataFrame([(s, "") for s in WORDS], AREAS)).collect()}
    assert len(got & truth) / len(truth) > 0.9 and len(got & truth) / max(1, len(got)) > 0.9

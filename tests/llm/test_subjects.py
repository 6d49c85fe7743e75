import random

from tamarin.llm import subjects as m

TOPICS = {"music": ["tanbou", "chanté", "gita", "flit", "konsè", "dansè"], "law": ["jij", "lwa", "prizon", "avoka", "kontra", "pwosè"]}
PLAIN = ["kaz", "liv", "pòt", "chimen", "zanmi", "lari", "foto", "klé"]


def sentence(rng, topic=None):
    noun = lambda: rng.choice(TOPICS[topic] if topic else PLAIN)
    return f"{rng.choice(['An', 'Ou', 'Yo'])} ka gadé {noun()} la é {rng.choice(PLAIN)} la épi {noun()} la."


def corpus(seed, n=300):
    rng, docs, want = random.Random(seed), [], {}
    for d in range(n):
        topics = rng.choice(([], ["music"], ["law"], ["music", "law"]))
        parts = [t for t in topics for _ in range(3)] + [None] * 3
        rng.shuffle(parts)
        docs.append((d, " ".join(sentence(rng, t) for t in parts), "x"))
        want[d] = sorted(topics)
    examples = [(t, "gcf", " ".join(sentence(rng, t) for _ in range(3))) for t in TOPICS for _ in range(8)]
    return docs, want, examples


def subjects(spark, docs, examples):
    d = spark.createDataFrame(docs, "doc_id long, text string, subjects string")
    e = spark.createDataFrame(examples, "subject string, lang string, text string")
    return {r["doc_id"]: r["subjects"] for r in m.document_subjects(d, "doc_id", "text", e, "subject", "lang", "text").collect()}


def test_accuracy(spark):
    docs, want, examples = corpus(10)
    got = subjects(spark, docs, examples)
    assert sum(got[d] == want[d] for d in want) >= 0.97 * len(want)


def test_edges(spark):
    docs, _, examples = corpus(11, 40)
    odd = [(900, None, "x"), (901, "", "x"), (902, " . ", "x"), (None, docs[0][1], "x"), (903, "Yo ka gadé kaz la. " * 3000, "x")]
    got = subjects(spark, docs + odd, examples + [(None, "gcf", "x"), ("law", None, "x"), ("law", "gcf", None)])
    assert got[900] == got[901] == got[902] == got[903] == [] and len(got) == 45
    assert subjects(spark, [], examples) == {}
    assert set(map(tuple, subjects(spark, docs, []).values())) == {()}
    assert set(map(tuple, subjects(spark, [(1, None, "x")], examples).values())) == {()}


def test_sentences():
    assert [b" ".join(s) for s in m.sentences("[00:00] An ka gadé. Wi!\nYo <b>ka</b> kouri? ...")] == [b"an ka gade", b"wi", b"yo ka kouri"]

import random

import numpy as np

from tamarin.llm import leakage as m

WORDS = [f"{a}{b}{c}" for a in "bdfgk" for b in "aeiou" for c in "lmnrt"]


def edits_within(doc, item, least, share):
    """Whether some stretch of item words has few enough edits against some stretch of document words."""
    for k in range(len(item) - least + 1):
        for n in range(least, min(2 * least, len(item) - k) + 1):
            row = [0] * (len(doc) + 1)
            for x in item[k : k + n]:
                new = [row[0] + 1]
                for j, y in enumerate(doc, 1):
                    new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
                row = new
            if min(row) * share <= n:
                return True
    return False


def found(spark, docs, items):
    d = spark.createDataFrame(docs, "doc_id long, text string, item_id int")
    i = spark.createDataFrame(items, "item_id long, text string")
    return {tuple(r) for r in m.leaked_items(d, "doc_id", "text", i, "item_id", "text").collect()}


def test_against_brute_force(spark):
    rng = random.Random(9)
    say = lambda n: [rng.choice(WORDS) for _ in range(n)]
    items = [(i, say(rng.randrange(15, 40))) for i in range(8)]
    docs = []
    for d in range(80):
        i, w = rng.choice(items)
        n = rng.randrange(8, min(len(w), 26) + 1)
        k = rng.randrange(len(w) - n + 1)
        part = w[k : k + n]
        for _ in range(rng.randrange(0, n // 6 + 1)):
            at, kind = rng.randrange(len(part) + 1), rng.random()
            part[at : at + (kind < 0.7)] = say(1) if kind > 0.3 else []
        docs.append((d, say(rng.randrange(0, 30)) + part + say(rng.randrange(0, 30)), 0))
    want = {(d, i) for d, t, _ in docs for i, w in items if edits_within(t, w, m.MIN_WORDS, m.ALTERED)}
    rows = [(d, " ".join(t), x) for d, t, x in docs], [(i, " ".join(w)) for i, w in items]
    got = found(spark, *rows)
    # of passages of only twelve words, one of them altered, some are beyond the radius; longer ones hold more windows
    assert got <= want and len(got) >= 0.95 * len(want) and 20 < len(want) < 80


def test_the_radius_matters(spark, monkeypatch):
    """Passages in which every window has an altered word: equal fingerprints find none of them."""
    rng = random.Random(10)
    say = lambda n: [rng.choice(WORDS) for _ in range(n)]
    items = [(i, say(30)) for i in range(6)]
    docs = []
    for d in range(60):
        i, w = rng.choice(items)
        k = rng.randrange(30 - 16)
        part = w[k : k + 16]
        part[5] = part[11] = "x"
        docs.append((d, " ".join(say(9) + part + say(9)), i))
    given = [(i, " ".join(w)) for i, w in items]
    got = found(spark, docs, given)
    assert got <= {(d, i) for d, _, i in docs} and len(got) >= 50
    monkeypatch.setattr(m.Index, "near", lambda self, prints: np.where(np.any([p[:, None] == own for p, own in zip(prints, self.prints)], axis=0)))
    index, hashed = m.Index(given), m._Ids()
    equal = set(m._search(index, [(d, [hashed[x.encode()] for x in t.split()]) for d, t, _ in docs]))
    assert len(equal) < 0.3 * len(got)


def test_all_fingerprints_within_the_radius():
    rng = np.random.default_rng(1)
    index = m.Index([(1, " ".join(WORDS[:100])), (2, " ".join(WORDS[20:])), (3, "short")])
    at = rng.integers(0, len(index.start), 200)
    q, others = index.prints[0][at].copy(), [~p[at] for p in index.prints[1:]]
    for _ in range(m.RADIUS):
        q ^= np.uint64(1) << rng.integers(0, 64, 200).astype(np.uint64)
    left, right = index.near([q, *others])
    got = set(zip(left.tolist(), right.tolist()))
    least = lambda i: np.min([np.bitwise_count(own ^ p[i]) for own, p in zip(index.prints, [q, *others])], axis=0)
    want = {(i, j) for i in range(200) for j in np.flatnonzero(least(i) <= m.RADIUS).tolist()}
    assert got == want and len(got) >= 200


def test_markup_case_and_edges(spark):
    item = "Jou ta la nou té ka montré sé zanmi la on bèl kaz adan mòn la douvan larivyè"
    dirty = "<p>[00:10] JOU TA LA <b>NOU</b> té ka montre se zanmi la [00:20] on bel kaz adan</p> mon la"
    docs = [(1, dirty, 0), (1, dirty, 0), (2, None, 0), (3, "", 0), (4, "nou té ka montré", 0), (None, item, 0), (5, "la " * 60_000 + item, 0)]
    items = [(7, item), (8, None), (9, "court"), (None, item), (7, item)]
    assert found(spark, docs, items) == {(1, 7), (5, 7)}
    assert found(spark, [], items) == set() and found(spark, docs, []) == set()


def test_item_sets_beyond_one_index_are_searched_in_passes(spark, monkeypatch):
    monkeypatch.setattr(m, "ITEM_CHARS", 200)
    texts = [(i, " ".join(WORDS[i : i + 20])) for i in range(0, 100, 20)]
    assert found(spark, [(i, t, 0) for i, t in texts], texts) == {(i, i) for i, _ in texts}

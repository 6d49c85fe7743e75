"""Problem 5: the language of each text and of each one-language stretch of a mixed one, by cross-parsing entropy.

For every language a suffix automaton of labelled text recognises all its sequences of words, another one all pieces of its words. A
text is parsed greedily into the longest phrases that the automata know: stretches of words, and for a word never seen the longest
pieces of words. Phrases are normalised by the logarithm of the labelled text's length, as the cross-parsing estimate of the entropy
asks, so that a language with more text has no advantage; the language that needs the fewest fits best. Each word carries its share
of the phrases it lies in, and a Viterbi pass over the words finds the stretches, a change of language costing ``SWITCH`` phrases.

Labelled text is a bounded sample: ``PER_LANGUAGE`` characters a language, the rows of lowest hash. A language that no table labels
comes in as general text (``tamarin.llm.spanish``). Rows of the corpus that one language explains best, out of the ``OWN_ROWS`` rows
of lowest hash, are then added to their language's text, round by round, so that the automata also know the corpus's vocabulary.
"""

from __future__ import annotations

import gc
import math
import re
import unicodedata
import uuid
from collections.abc import Iterable, Iterator
from itertools import accumulate, chain
from operator import le

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tamarin.llm.words import IGNORABLE

#: Characters of labelled text that an automaton holds at most.
PER_LANGUAGE = 60_000
#: Rows of the corpus looked at for more labelled text.
OWN_ROWS = 4_000
#: Phrases that a change of language inside a text must save.
SWITCH = 2.0
#: Words of a stretch that counts.
STRETCH = 6
#: A row is taken over as labelled text if its best language saves this share of the second's phrases, in each round, and if no
#: change of language in it would save DOUBT phrases.
CLEAR, DOUBT = (0.2, 0.3, 0.4), 1.0
#: Phrases that a word no automaton has seen counts as, and what each of its pieces adds.
UNKNOWN, PIECE = 1.0, 0.25
#: A text with accents in at most one of RARE words is parsed without any.
RARE = 12
#: Words whose costs a worker keeps.
CACHE = 300_000

_WORD = re.compile(r"[^\W_]+'?")


def _accents_off(text: str) -> str:
    return "".join(ch for ch in unicodedata.normalize("NFD", text) if unicodedata.category(ch) != "Mn")


def _words(text: str) -> list[str]:
    t = text.replace("’", "'")
    if not t.isascii():
        t = unicodedata.normalize("NFC", t)
        if nothing := [ch for ch in set(t) if IGNORABLE[ch]]:
            t = t.translate(dict.fromkeys(map(ord, nothing)))
    return _WORD.findall(t)


def tokens(text: str | None) -> list[str]:
    """The words of ``text`` as they are parsed: lower case, composed accents, apostrophes kept at the end of elided words."""
    return list(map(str.lower, _words(text))) if text else []


def capitals(words: list[str]) -> set[str]:
    """Of words in their own case those of two letters or more that start with a capital, lower-cased; none where all words are in
    capitals."""
    found = {w.lower() for w in words if w[0].isupper() and len(w) > 1 and w[1] != "'"}
    return set() if found and all(w.isupper() or not w[0].isalpha() for w in words) else found


class Automaton:
    """All stretches of a sequence, in one pass. A state is the table of its next states."""

    def __init__(self, sequence: Iterable):
        self.start: dict = {}
        link, length = {id(self.start): None}, {id(self.start): 0}
        states = [self.start]  # keeps their ids apart

        def state(known: dict, size: int, up: dict) -> dict:
            states.append(known)
            length[id(known)], link[id(known)] = size, up
            return known

        last = self.start
        for x in sequence:
            cur = state({}, length[id(last)] + 1, self.start)
            p = last
            while p is not None and x not in p:
                p[x] = cur
                p = link[id(p)]
            if p is not None:
                q = p[x]
                if length[id(p)] + 1 == length[id(q)]:
                    link[id(cur)] = q
                else:
                    clone = state(dict(q), length[id(p)] + 1, link[id(q)])
                    while p is not None and p.get(x) is q:
                        p[x] = clone
                        p = link[id(p)]
                    link[id(q)] = link[id(cur)] = clone
            last = cur

    def longest(self, sequence, i: int) -> int:
        """Length of the longest stretch from ``i`` on."""
        s, j, n = self.start, i, len(sequence)
        while j < n and (s := s.get(sequence[j])) is not None:
            j += 1
        return j - i


class Language:
    """The automata of one language's labelled text."""

    def __init__(self, texts: list[list[str]]):
        words = [w for t in texts for w in (*t, "|")]
        self.start = Automaton(words).start
        self.pieces = Automaton(" " + " ".join(dict.fromkeys(words)) + " ")
        self.size = math.log2(2 + sum(map(len, words)))
        self.weight = 1.0

    def unknown(self, word: str) -> float | None:
        """Phrases that a word never seen counts as: the more, the more pieces it takes; None for a word that is known."""
        if word in self.start:
            return None
        w, i, c = f" {word} ", 0, 0
        while i < len(w):
            i += max(1, self.pieces.longest(w, i))
            c += 1
        return (UNKNOWN + PIECE * c) * self.weight

    def phrases(self, words: list[str], unknown: tuple[float | None, ...]) -> list[float]:
        """Each word's share of the phrases; ``unknown`` holds what each word counts as that is not known."""
        if None not in unknown:
            return list(unknown)
        start, weight, out, i, n = self.start, self.weight, list(unknown), 0, len(words)
        while i < n:
            if out[i] is not None:
                if None not in unknown[i:]:
                    break
                i = unknown.index(None, i)
            state, k = start[words[i]], i + 1
            while k < n and words[k] in state:
                state, k = state[words[k]], k + 1
            if k - i == 1:
                out[i] = weight
            else:
                out[i:k] = [weight / (k - i)] * (k - i)
            i = k
        return out


class Parser:
    """The automata of all languages, once with accents and once without."""

    def __init__(self, texts: dict[str, list[str]]):
        self.languages = sorted(texts)
        words = {x: [tokens(t) for t in texts[x]] for x in self.languages}
        self.accented = [Language(words[x]) for x in self.languages]
        self.plain = [Language([[_accents_off(w) for w in t] for t in words[x]]) for x in self.languages]
        most = max((x.size for x in self.accented), default=1.0)
        for a, b in zip(self.accented, self.plain):
            a.weight = b.weight = a.size / most
        self.seen: tuple[dict, dict] = ({}, {})

    def unknown(self, words: list[str], plain: bool) -> list[tuple]:
        """For each word what it counts as in each language that does not know it. Kept for a bounded number of words."""
        seen = self.seen[plain]
        out = list(map(seen.get, words))
        if None in out:
            if len(seen) > CACHE:
                seen.clear()
            use = self.plain if plain else self.accented
            for i, known in enumerate(out):
                if known is None:
                    seen[words[i]] = out[i] = tuple(x.unknown(words[i]) for x in use)
        return out

    def costs(self, words: list[str], names: set[str] = frozenset()) -> list[list[float]]:
        """Phrases per language and word. Names, the words with a capital that no language knows, count nothing."""
        plain = sum(map(str.isascii, words)) * RARE >= len(words) * (RARE - 1)
        unknown = self.unknown(words, plain)
        out = [x.phrases(words, u) for x, u in zip(self.plain if plain else self.accented, zip(*unknown))]
        for name in names:
            for i, w in enumerate(words):
                if w == name and None not in unknown[i]:
                    for own in out:
                        own[i] = 0.0
        return out

    def stretches(self, text: str | None, switch: float = SWITCH) -> list[tuple[str, int, int, float]]:
        """(language, first word, words, confidence) of each stretch. The confidence is the share of the phrases of the second-best
        language that the best saves, from 0 to 1."""
        words = _words(text) if text else []
        return self._stretches(list(map(str.lower, words)), capitals(words), switch) if words else []

    def _stretches(self, words: list[str], names: set[str], switch: float) -> list[tuple[str, int, int, float]]:
        cost = self.costs(words, names)
        k, n = len(cost), len(words)
        sums = list(map(sum, cost))
        x = sums.index(min(sums))
        if k == 1 or sums[x] <= sum(map(min, *cost)) + switch:  # no change of language can save what it costs
            rest = min(sums[:x] + sums[x + 1 :], default=0.0)
            return [(self.languages[x], 0, n, max(0.0, 1 - sums[x] / rest) if rest > 0 else 0.0)]
        # a language that another one beats at every word is on no cheapest path
        live = list(range(k))
        for y in range(k):
            if any(z != y and all(map(le, cost[z], cost[y])) for z in live):
                live.remove(y)
        path = [live[y] for y in _path([cost[y] for y in live], len(live), n, switch)]
        out, a = [], 0
        for b in range(1, n + 1):
            if b == n or path[b] != path[a]:
                own = sum(cost[path[a]][a:b])
                rest = min((sum(c[a:b]) for y, c in enumerate(cost) if y != path[a]), default=0.0)
                out.append((self.languages[path[a]], a, b - a, max(0.0, 1 - own / rest) if rest > 0 else 0.0))
                a = b
        return out


def _path(cost: list[list[float]], k: int, n: int, switch: float) -> list[int]:
    """The cheapest language of every word, a change costing ``switch``."""
    total, back = [c[0] for c in cost], []
    for column in list(zip(*cost))[1:]:
        low = total.index(min(total))
        jump = total[low] + switch
        back.append([x if total[x] <= jump else low for x in range(k)])
        total = [(t if t <= jump else jump) + c for t, c in zip(total, column)]
    path = [total.index(min(total))]
    for step in reversed(back):
        path.append(step[path[-1]])
    return path[::-1]


def _bounded(rows: Iterable[tuple[str, str]]) -> dict[str, list[str]]:
    """The texts per language, in order, whole, until PER_LANGUAGE characters are reached."""
    out: dict[str, list[str]] = {}
    size: dict[str, int] = {}
    for lang, text in rows:
        if size.get(lang, 0) < PER_LANGUAGE:
            out.setdefault(lang, []).append(text)
            size[lang] = size.get(lang, 0) + len(text) + 1
    return out


def labelled_text(labelled: DataFrame, general: list[tuple[str, str]] = (), own: DataFrame | None = None) -> dict[str, list[str]]:
    """Texts per language from ``labelled(lang, text)``, from ``general`` (language, text) for languages it lacks, and from rows of
    ``own(text)`` that one language explains clearly. At most PER_LANGUAGE characters a language and OWN_ROWS rows leave the
    tables, those of lowest hash; all languages are kept. Null and blank texts and null languages are no rows."""
    good = labelled.where("lang is not null and trim(text) <> ''").select("lang", "text").distinct()
    # each text is longer than nothing, so PER_LANGUAGE characters are reached within as many rows: a bound, not a cut
    before = F.sum(F.length("text") + 1).over(Window.partitionBy("lang").orderBy(F.xxhash64("text"), "text").rowsBetween(Window.unboundedPreceding, -1))
    rows = [(r["lang"], r["text"]) for r in good.withColumn("before", F.coalesce(before, F.lit(0))).where(F.col("before") < PER_LANGUAGE).orderBy("lang", "before").collect()]
    mine = []
    if own is not None:
        texts = own.where("trim(text) <> ''").select("text").distinct()
        mine = [r["text"] for r in texts.orderBy(F.xxhash64("text"), "text").limit(OWN_ROWS).collect()]
    return learn(rows, general, mine)


def learn(rows: list[tuple[str, str]], general: Iterable[tuple[str, str]] = (), mine: Iterable[str] = ()) -> dict[str, list[str]]:
    """The driver's part of ``labelled_text``, over bounded rows."""
    known = {lang for lang, _ in rows}
    rows = [*rows, *((lang, text) for lang, text in general if lang not in known)]
    texts = _bounded(rows)
    for clear in CLEAR if mine and len(texts) > 1 else ():
        parser, more = Parser(texts), []
        for text in mine:
            found = parser.stretches(text, DOUBT)
            if len(found) == 1 and found[0][2] >= STRETCH and found[0][3] >= clear:
                more.append((found[0][0], text))
        texts = _bounded([*rows, *more])
    return texts


_WORKER: dict = {}


def language_stretches(df: DataFrame, text: str, texts: dict[str, list[str]]) -> DataFrame:
    """``df`` with ``stretches ARRAY<STRUCT<lang, first, words, confidence>>`` of the whole ``text``. Null and wordless texts have
    none. Other columns pass through; an existing ``stretches`` raises ValueError."""
    if "stretches" in df.columns:
        raise ValueError("column exists already: stretches")
    token = uuid.uuid4().hex
    kinds = {"lang": pa.string(), "first": pa.int32(), "words": pa.int32(), "confidence": pa.float64()}

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if _WORKER.get("token") != token:
            gc.disable()  # many small tables, all kept
            _WORKER.update(token=token, parser=Parser(texts))
            gc.freeze()
            gc.enable()
        parser = _WORKER["parser"]
        for batch in batches:
            found = [parser.stretches(t) for t in batch.column(batch.schema.get_field_index(text)).to_pylist()]
            ends = pa.array([0, *accumulate(map(len, found))], pa.int32())
            columns = list(zip(*chain.from_iterable(found))) or [()] * len(kinds)
            flat = pa.StructArray.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds.values())], list(kinds))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.ListArray.from_arrays(ends, flat)], [*batch.schema.names, "stretches"])

    schema = ", ".join(f"`{c}` {k}" for c, k in df.dtypes) + ", stretches array<struct<lang: string, first: int, words: int, confidence: double>>"
    return df.mapInArrow(run, schema)


def languages_in(stretches: Column) -> Column:
    """The languages that a stretch of at least STRETCH words is in."""
    return F.array_sort(F.array_distinct(F.transform(F.filter(stretches, lambda s: s.words >= STRETCH), lambda s: s.lang)))


def misstated(df: DataFrame, key: str, label: str, says: Column) -> DataFrame:
    """``<key>, lang`` for each language in texts whose label does not state it; ``df`` has ``stretches``. ``says`` is the array of
    languages any one of which the label allows, null where it says nothing."""
    langs = languages_in(F.col("stretches"))
    stated = says.isNotNull() & (F.size(langs) == 1) & F.array_contains(F.coalesce(says, F.array().cast("array<string>")), langs[0])
    return df.where(F.col(key).isNotNull() & ~stated).select(F.col(key), F.explode(langs).alias("lang")).distinct()

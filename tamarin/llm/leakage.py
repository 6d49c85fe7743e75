"""Problem 8: passages of held-out items that stand, wholly or partly and not always cleanly, in a corpus.

SimHash over passage-sized windows. A leaked passage has at least MIN_WORDS words of which one in ALTERED may be altered, so every
window of MIN_WORDS words of every item and of every document gets a 64-bit SimHash, in which a word has the more votes, the fewer
items have it; a window with a word altered differs in some bits. The items' fingerprints are filed under four blocks of 16 bits, each under all values at most NEAR bits
away: any two fingerprints at most RADIUS bits apart agree so far in one block, so looking up a document window's four blocks finds
all within the radius. Candidates are verified: seeds of equal words near the windows' diagonal, the exact weighted similarity of
their word shingles, then the alignment that the definition asks for.

Only the items' index is sent to the tasks, in parts of bounded size; documents are streamed whole, without a shuffle.
"""

from __future__ import annotations

import math
import uuid
from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator
from itertools import chain, combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tamarin.llm.words import plain_words
from tamarin.plans.durable import durable

#: A passage: so many consecutive words of the item, at most one in ALTERED of them altered.
MIN_WORDS, ALTERED = 12, 8
#: Words in a window.
WINDOW = MIN_WORDS
#: Blocks of a fingerprint, and bits a block may differ in: one of the blocks does not differ in more if all differ in RADIUS at most.
BLOCKS, NEAR = 4, 1
RADIUS = BLOCKS * (NEAR + 1) - 1
#: Independent fingerprints of a window; a candidate is within the radius by one of them.
PRINTS = 3
#: Equal words in a row that every passage holds: one of 16 words with two altered may hold no longer stretch.
SEED = 5
#: Characters of item text one index may hold; larger item sets are searched in several passes of the documents, one at a time.
ITEM_CHARS = 400_000
#: Tokens fingerprinted at once, and words kept in a worker's cache.
CHUNK, CACHE = 100_000, 500_000
#: Votes of a word at most: a window's fit into a byte.
MOST_VOTES = 255 // WINDOW
#: Words fingerprinted at once.
BLOCK = 4096
#: Candidates compared at once.
MOST = 1 << 16
#: Words an alignment may shift within one passage.
SHIFT = 3


class _Ids(dict):
    """The 64-bit hash of a word, kept while the cache lasts."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHE:
            self.clear()
        self[word] = out = xxhash.xxh3_64_intdigest(word)
        return out


def fingerprints(ids: np.ndarray, weights: np.ndarray, which: int = 0, size: int = WINDOW) -> np.ndarray:
    """The SimHash, one of the PRINTS, of each stretch of ``size`` words: every word votes with its weight on each bit, and more than
    half sets it."""
    out = []
    if which:
        with np.errstate(over="ignore"):
            ids = (ids ^ (ids >> np.uint64(32))) * np.uint64(0x9E3779B97F4A7C15 + 2 * which)
            ids ^= ids >> np.uint64(29)
    for a in range(0, max(0, len(ids) - size + 1), BLOCK):
        part = slice(a, a + BLOCK + size - 1)
        votes = np.unpackbits(np.ascontiguousarray(ids[part]).view(np.uint8)).reshape(-1, 64) * weights[part, None]
        total = np.cumsum(np.r_[0, weights[part].astype(np.int64)])
        sums, got, step, done = votes, None, 1, 0
        left = size
        while left:
            if left & 1:
                got = sums if got is None else got[: len(sums) - done] + sums[done:]
                done += step
            left >>= 1
            if left:
                sums = sums[:-step] + sums[step:]
                step *= 2
        half = (total[size:] - total[:-size]) // 2
        out.append(np.packbits(got[: len(half)] > half[:, None].astype(np.uint8), axis=1).view(np.uint64).ravel())
    return np.concatenate(out) if out else np.zeros(0, np.uint64)


def windows(sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of texts of these sizes, one after the other: start of each window, and its text."""
    ends = np.cumsum(sizes)
    which = np.repeat(np.arange(len(sizes)), sizes)
    start = np.flatnonzero(np.arange(WINDOW, len(which) + WINDOW) <= ends[which])
    return start, which[start]


#: All differences of a block of up to NEAR bits.
_MASKS = np.array([sum(1 << i for i in c) for k in range(NEAR + 1) for c in combinations(range(16), k)], np.uint16)


class Index:
    """The items' windows under the blocks of their fingerprints."""

    def __init__(self, items: list[tuple[int, str]]):
        hashed = _Ids()
        self.keys, self.words = [], []
        for key, text in items:
            w = plain_words(text)
            if len(w) >= MIN_WORDS:
                self.keys.append(key)
                self.words.append([hashed[x] for x in w])
        sizes = np.array([len(w) for w in self.words], np.int64)
        self.ids = np.fromiter(chain.from_iterable(self.words), np.uint64, int(sizes.sum()))
        self.first = np.cumsum(sizes) - sizes
        self.start, self.owner = windows(sizes)
        seen = Counter(w for x in self.words for w in set(x))
        self.weight = {w: math.log(1 + len(self.words) / n) for w, n in seen.items()}
        self.known = np.sort(np.fromiter(seen, np.uint64, len(seen)))
        self.votes = np.array([min(MOST_VOTES, max(1, round(3 * self.weight[w]))) for w in self.known.tolist()] or [1], np.uint8)
        self.prints = [fingerprints(self.ids, self.voices(self.ids), x)[self.start] for x in range(PRINTS)]
        self.blocks = []
        for x in range(PRINTS):
            for b in range(BLOCKS):
                at = (self._block(self.prints[x], b)[:, None] ^ _MASKS).ravel()
                order = np.argsort(at, kind="stable")
                first = np.searchsorted(at[order], np.arange(65537))
                self.blocks.append((x, b, (order // len(_MASKS)).astype(np.int32), first[:-1].astype(np.int32), np.diff(first).astype(np.int32)))

    def voices(self, ids: np.ndarray) -> np.ndarray:
        """The votes of words: the more, the fewer items have them. Words of no item have one, so that a word put in place of
        another changes little."""
        at = np.minimum(np.searchsorted(self.known, ids), max(0, len(self.known) - 1))
        return np.where(self.known[at] == ids, self.votes[at], 1).astype(np.uint8) if len(self.known) else np.ones(len(ids), np.uint8)

    @staticmethod
    def _block(prints: np.ndarray, b: int) -> np.ndarray:
        return (prints >> np.uint64(16 * b) & np.uint64(0xFFFF)).astype(np.uint16)

    def near(self, prints: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """All (position in ``prints``, window of the index) of which one of the fingerprints is at most RADIUS bits apart."""
        found, n = [np.zeros(0, np.int64)], max(1, len(self.start))
        for x, b, order, first, count in self.blocks:
            at = self._block(prints[x], b)
            some = np.flatnonzero(count[at])
            at = at[some]
            many, own = count[at], prints[x][some]
            until = np.cumsum(many, dtype=np.int64)
            begin = (first[at] - (until - many)).astype(np.int64)
            cuts = [0, *np.searchsorted(until, np.arange(MOST, until[-1] if len(until) else 0, MOST)).tolist(), len(some)]
            for lo, hi in zip(cuts, cuts[1:]):  # as many as stay near the processor
                if hi == lo:
                    continue
                m = many[lo:hi]
                base = int(until[lo] - m[0])
                right = order[np.repeat(begin[lo:hi] + base, m) + np.arange(int(until[hi - 1]) - base)]
                ok = np.flatnonzero(np.bitwise_count(np.repeat(own[lo:hi], m) ^ self.prints[x][right]) <= RADIUS)
                if len(ok):
                    found.append(some[lo + np.searchsorted(until[lo:hi], ok + base, "right")] * n + right[ok])
        both = np.unique(np.concatenate(found))
        return both // n, both % n

    def alike(self, doc: list[int], item: list[int]) -> bool:
        """Whether a document's stretch is similar enough to an item's to hold a passage of it: all its weighted shingles but for the
        heaviest that the altered words of a passage that long may take away. Words of few items weigh more."""
        have, want = Counter(doc), Counter(item)
        missed = sum(self.weight[w] * max(0, n - have[w]) for w, n in want.items())
        return missed <= sum(sorted((self.weight[w] for w in item), reverse=True)[: 2 * MIN_WORDS // ALTERED - 1]) + 1e-9


def _runs(doc: list[int], item: list[int], seeds: list[tuple[int, int]]) -> list[tuple[int, int, int]]:
    """Maximal equal stretches through the seeds: document position, item position, length."""
    out, end = [], {}
    for j, k in sorted(seeds):
        if end.get(j - k, -1) >= j + 1:
            continue
        a, b = j, k
        while a and b and doc[a - 1] == item[b - 1]:
            a, b = a - 1, b - 1
        n = j - a
        while a + n < len(doc) and b + n < len(item) and doc[a + n] == item[b + n]:
            n += 1
        end[j - k] = a + n
        if n:
            out.append((a, b, n))
    return out


def _reach(doc: list[int], item: list[int], j: int, k: int, step: int, edits: int) -> int:
    """Item words passed from (j, k) on in direction ``step`` with at most ``edits`` words added, dropped or replaced."""
    n = 0
    while 0 <= j < len(doc) and 0 <= k < len(item) and doc[j] == item[k]:
        j, k, n = j + step, k + step, n + 1
    if not edits or not 0 <= k < len(item):
        return n
    best = 1 + _reach(doc, item, j, k + step, step, edits - 1)
    if 0 <= j < len(doc):
        best = max(best, 1 + _reach(doc, item, j + step, k + step, step, edits - 1), _reach(doc, item, j + step, k, step, edits - 1))
    return n + best


def leaks(doc: list[int], item: list[int], seeds: list[tuple[int, int]], index: Index) -> bool:
    """Whether ``doc`` holds a passage of ``item`` around the ``seeds``. A passage of 2 * MIN_WORDS words or more holds a shorter one,
    so one of MIN_WORDS with one word altered, or of 2 * ALTERED with two, settles it."""
    for a, b, n in _runs(doc, item, seeds):
        if n >= MIN_WORDS:
            return True
        around = doc[max(0, a - MIN_WORDS - SHIFT) : a + n + MIN_WORDS + SHIFT]
        first, last = max(0, b + n - MIN_WORDS), min(b, len(item) - MIN_WORDS)
        if not any(index.alike(around, item[p : p + MIN_WORDS]) for p in range(first, last + 1)):
            continue
        left = [_reach(doc, item, a - 1, b - 1, -1, e) for e in range(3)]
        right = [_reach(doc, item, a + n, b + n, 1, e) for e in range(3)]
        for e in range(3):
            for f in range(3 - e):
                if n + left[e] + right[f] >= max(MIN_WORDS, (e + f) * ALTERED):
                    return True
    return False


def _seeds(index: Index, ids: np.ndarray, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Where SEED equal words stand in both windows of a candidate: candidate, document position, item position. Words added or
    dropped before them shift the diagonal, by two at most in a window."""
    reach, found = np.arange(WINDOW), []
    for shift in range(-2, 3):
        d = left[:, None] + reach
        i = right[:, None] + reach + shift
        same = (ids[np.minimum(d, len(ids) - 1)] == index.ids[np.clip(i, 0, len(index.ids) - 1)]) & (d < len(ids)) & (i >= 0) & (i < len(index.ids))
        run = same[:, : WINDOW - SEED + 1].copy()
        for k in range(1, SEED):
            run &= same[:, k : k + WINDOW - SEED + 1]
        which = np.flatnonzero(run.any(axis=1))
        at = run[which].argmax(axis=1)
        found.append((which, left[which] + at, right[which] + at + shift))
    return tuple(np.concatenate(x) for x in zip(*found))


def _search(index: Index, docs: list[tuple[int, list[int]]]) -> Iterator[tuple[int, int]]:
    """(document key, item key) of one chunk of documents."""
    sizes = np.array([len(w) for _, w in docs], np.int64)
    ids = np.fromiter(chain.from_iterable(w for _, w in docs), np.uint64, int(sizes.sum()))
    before = np.cumsum(sizes) - sizes
    start, which = windows(sizes)
    voices = index.voices(ids)
    prints = [fingerprints(ids, voices, x)[start] for x in range(PRINTS)]
    if len(short := np.flatnonzero(sizes == MIN_WORDS - 1)):  # a word short of a window, yet it may hold a passage less a word
        at = before[short]
        prints = [np.r_[p, fingerprints(ids, voices, x, MIN_WORDS - 1)[at]] for x, p in enumerate(prints)]
        start, which = np.r_[start, at], np.r_[which, short]
    left, right = index.near(prints)
    which, owner = which[left], index.owner[right]
    cand, d, i = _seeds(index, ids, start[left], index.start[right])
    which, owner = which[cand], owner[cand]
    d, i = d - before[which], i - index.first[owner]
    inside = np.flatnonzero((d >= 0) & (i >= 0) & (d + SEED <= sizes[which]))
    group = which[inside] * len(index.keys) + owner[inside]
    order = np.argsort(group, kind="stable")
    group, inside = group[order], inside[order]
    first = np.flatnonzero(np.r_[True, group[1:] != group[:-1]]) if len(group) else np.zeros(0, np.int64)
    for a, b in zip(first.tolist(), [*first[1:].tolist(), len(group)]):
        doc, item = divmod(int(group[a]), len(index.keys))
        at = inside[a:b]
        seeds = [(j, k) for j, k in set(zip(d[at].tolist(), i[at].tolist())) if k + SEED <= len(index.words[item])]
        if seeds and leaks(docs[doc][1], index.words[item], seeds, index):
            yield docs[doc][0], index.keys[item]


def leaked_items(documents: DataFrame, key: str, text: str, items: DataFrame, item_key: str, item_text: str) -> DataFrame:
    """``<key>, <item_key>`` of every document and item of which it holds a passage; distinct.

    Null, empty and very short texts hold no passage; markup tags and time marks of documents are no words; rows with null keys
    cannot be reported and are left out; repeated rows count once; other columns are ignored. Items of more than ITEM_CHARS
    characters together are searched in as many passes as needed; no item is left out.
    """
    given = items.select(F.col(item_key).alias("i"), F.col(item_text).alias("t")).where("i is not null and t is not null").distinct()
    size = given.agg(F.sum(F.length("t"))).first()[0] or 0
    passes = max(1, math.ceil(size / ITEM_CHARS))
    kinds = dict(documents.dtypes) | {f"item {k}": v for k, v in items.dtypes}
    schema = f"`{key}` {kinds[key]}, `{item_key}` {kinds[f'item {item_key}']}"
    out = None
    for p in range(passes):
        part = given if passes == 1 else given.where(F.pmod(F.xxhash64("i", "t"), F.lit(passes)) == p)
        rows = [(r["i"], r["t"]) for r in part.collect()]
        one = documents.select(key, text).mapInArrow(_searcher(rows, key, item_key), schema)
        if passes > 1:  # done at once, so that the driver and each worker hold one part of the items at a time
            one = durable(one, "leaks")
        out = one if out is None else out.unionByName(one)
    return out.distinct()


#: The latest index of a worker and the words it has hashed.
_WORKER: dict = {}


def _searcher(rows: list[tuple[int, str]], key: str, item_key: str):
    token = uuid.uuid4().hex

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if _WORKER.get("token") != token:
            _WORKER.update(token=token, index=Index(rows), hashed=_Ids())
        index, hashed = _WORKER["index"], _WORKER["hashed"]
        if not len(index.start):
            return
        for batch in batches:
            found: list[tuple[int, int]] = []
            docs: list[tuple[int, list[int]]] = []
            tokens = 0
            for k, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                words = plain_words(t, markup=True)
                if len(words) >= MIN_WORDS - 1 and k is not None:
                    docs.append((k, list(map(hashed.__getitem__, words))))
                    tokens += len(words)
                if tokens > CHUNK:
                    found.extend(_search(index, docs))
                    docs, tokens = [], 0
            if docs:
                found.extend(_search(index, docs))
            if found:
                a, b = zip(*found)
                yield pa.RecordBatch.from_arrays([pa.array(a, batch.schema.field(0).type), pa.array(b)], [key, item_key])

    return run

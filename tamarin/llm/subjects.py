"""Problem 9: the subjects that each document treats.

Term weighting and truncated SVD: documents become tf-idf vectors over the vocabulary, and a randomised subspace iteration gives
each term its vector among the leading singular directions. A sentence is the sum of its term vectors, weighted by idf and by how
unevenly the term spreads over the subjects (one less its normalised entropy), so that words of any subject count little.

Seed centroids, one per subject and language, come from labelled examples. Each round assigns all sentences of the corpus to the
nearest centroid of their language by cosine, then recounts from them the spread of every term and the centroids. The last pass
assigns sentences for good, words of two subjects by the rest of the document, and reports the subjects of enough sentences.

Every word counts: those of the examples and the ``TERMS`` of most documents are terms of their own, all others share ``HASHED``
terms by their hash. All statistics run over all documents. Every pass sums matrices of that size per task, and tasks are as many as
the cluster runs at once, so what is shuffled does not grow with the corpus. Products are sparse: they cost what the texts hold.
"""

from __future__ import annotations

import math
import zlib
from array import array
from collections import Counter
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tamarin.llm.words import plain_sentences, plain_words
from tamarin.plans.durable import durable

#: Words of most documents that are terms of their own, beside those of the examples, and terms that all other words share.
TERMS, HASHED = 8192, 4096
#: Singular directions, passes that find them, rounds of refinement.
RANK, PASSES, ROUNDS = 64, 3, 3
#: Labelled examples used at most, those of lowest hash.
EXAMPLES = 20_000
#: A sentence is assigned in a round if its best cosine is at least NEAR and exceeds the second by CLEAR.
NEAR, CLEAR = 0.5, 0.1
#: Sentences of a subject that a term is taken to have had before any count: at least the first, or the second part of the subject's
#: mean sentences in the language. A sentence treats nothing whose heaviest term weighs less than FLOOR of a typical subject word.
PRIOR, FLOOR = (0.1, 0.003), 0.6
#: A document treats a subject if so large a part of its sentences does.
SHARE = 0.25
#: Words of shared terms that a worker keeps.
CACHE = 500_000
#: Documents a task works on at once.
CHUNK = 200
#: Blocks a summed matrix travels in.
BLOCKS = 64

def sentences(text: str | None) -> list[list[bytes]]:
    """The plain words of each sentence that has any; tags and time marks are no words."""
    return plain_sentences(text)


class Terms(dict):
    """The term of each word: its own, or the one it shares by its hash. Shared ones are kept while the cache lasts."""

    def __init__(self, words: list[str]):
        super().__init__((w.encode(), i) for i, w in enumerate(words))
        self.own, self.more = len(words), 0

    def __missing__(self, word: bytes) -> int:
        term = self.own + zlib.crc32(word) % HASHED
        if self.more < CACHE:
            self[word], self.more = term, self.more + 1
        return term

    def of(self, words: list[bytes]) -> list[int]:
        """The distinct terms of a sentence."""
        return list(set(map(self.__getitem__, words)))


def vocabulary(documents: DataFrame, text: str, always: set[str]) -> tuple[list[str], np.ndarray, int]:
    """The words that are terms of their own, ``always`` among them; the documents that hold each term, own ones first, then shared
    ones, for which the documents of their words are added up; and the number of documents with words."""

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()
        for batch in batches:
            for t in batch.column(0).to_pylist():
                words = plain_words(t, markup=True)
                if words:
                    seen.update(set(words))
                    seen[b""] += 1
            if len(seen) > 500_000:
                yield _counts(seen)
                seen.clear()
        if seen:
            yield _counts(seen)

    spark = documents.sparkSession
    df = durable(documents.select(text).mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")), "word-counts")
    given = F.broadcast(spark.createDataFrame([(w,) for w in sorted(always)], "word string"))  # the words of at most EXAMPLES examples
    rows = {r["word"]: r["n"] for r in df.orderBy(F.desc("n"), "word").limit(TERMS + 1).collect()}
    total = rows.pop("", 0)
    rows |= dict.fromkeys(always, 0) | {r["word"]: r["n"] for r in df.join(given, "word").collect()} | rows
    words = sorted(rows, key=lambda w: (-rows[w], w))
    kept = F.broadcast(spark.createDataFrame([(w,) for w in [*words, ""]], "word string"))  # at most TERMS and the examples' words
    rest = df.join(kept, "word", "left_anti").groupBy((F.crc32(F.col("word").cast("binary")) % HASHED).alias("term")).agg(F.sum("n").alias("n"))
    docs = np.zeros(len(words) + HASHED)
    docs[: len(words)] = [rows[w] for w in words]
    for r in rest.collect():  # at most HASHED
        docs[len(words) + r["term"]] = r["n"]
    return words, docs, total


def _counts(seen: Counter) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([w.decode() for w in seen], pa.string()), pa.array(list(seen.values()), pa.int64())], ["word", "n"])


def _kind(terms: int) -> np.dtype:
    """The smallest numbers that hold all terms and the mark after a sentence, which is the largest of them."""
    return np.dtype(np.uint16 if terms < 0xFFFF else np.uint32)


def coded(documents: DataFrame, key: str, text: str, words: list[str]) -> DataFrame:
    """``key, s BINARY, n_sentences INT``: the distinct terms of every sentence, each sentence ended by a mark."""
    kind = _kind(len(words) + HASHED)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, mark = Terms(words), int(np.iinfo(kind).max)
        for batch in batches:
            out, sizes = [], []
            for t in batch.column(1).to_pylist():
                flat, parts = array(kind.char), sentences(t)
                for s in parts:
                    flat.extend(at.of(s))
                    flat.append(mark)
                out.append(flat.tobytes())
                sizes.append(len(parts))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.binary()), pa.array(sizes, pa.int32())], ["key", "s", "n_sentences"])

    return durable(documents.select(F.col(key).alias("key"), text).mapInArrow(run, f"key {dict(documents.dtypes)[key]}, s binary, n_sentences int"), "coded")


def _summed(docs: DataFrame, shape: tuple[int, ...], add: Callable[[np.ndarray, list], None]) -> np.ndarray:
    """The sum over all documents of what ``add`` puts into a matrix of ``shape``, one matrix a task, summed block by block."""
    size = math.prod(shape)
    edge = -(-size // BLOCKS)

    def part(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(shape)
        for batch in batches:
            for a in range(0, batch.num_rows, CHUNK):
                add(total, batch.column(0).slice(a, CHUNK))
        flat = total.ravel()
        data = [flat[b * edge : (b + 1) * edge].tobytes() for b in range(BLOCKS)]
        yield pa.RecordBatch.from_arrays([pa.array(range(BLOCKS), pa.int32()), pa.array(data, pa.binary())], ["block", "data"])

    def merge(one: pd.DataFrame) -> pd.DataFrame:
        total = sum(np.frombuffer(x, float) for x in one["data"])
        return pd.DataFrame({"block": one["block"].iloc[:1], "data": [total.tobytes()]})

    spark = docs.sparkSession
    parts = docs.select("s").coalesce(2 * spark.sparkContext.defaultParallelism).mapInArrow(part, "block int, data binary")
    rows = parts.groupBy("block").applyInPandas(merge, "block int, data binary").collect()
    return np.concatenate([np.frombuffer(r["data"], float) for r in sorted(rows)] or [np.zeros(size)])[:size].reshape(shape)


def _flat(column: pa.Array, kind: np.dtype) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Terms of a batch, the sentence of each term, the document of each sentence."""
    ends = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    flat = np.frombuffer(data, kind, (ends[-1] - ends[0]) // kind.itemsize, ends[0]) if data is not None and ends[-1] > ends[0] else np.zeros(0, kind)
    mark = flat == np.iinfo(kind).max
    places = np.flatnonzero(mark)
    of = np.searchsorted((ends[1:] - ends[0]) // kind.itemsize, places, "right")
    return flat[~mark].astype(np.int32), np.repeat(np.arange(len(places)), np.diff(places, prepend=-1) - 1), of


def term_vectors(docs: DataFrame, idf: np.ndarray) -> np.ndarray:
    """Each term's unit vector among the RANK leading singular directions of the documents' tf-idf matrix."""
    terms, rank, kind = len(idf), min(RANK, len(idf)), _kind(len(idf))

    def product(basis: np.ndarray) -> np.ndarray:
        def add(total: np.ndarray, column: pa.Array) -> None:
            word, sent, of = _flat(column, kind)
            # term frequencies: the sentences of a document that hold a term
            cell, times = np.unique((of[sent] * terms + word).astype(np.int32 if len(column) * terms < 1 << 31 else np.int64), return_counts=True)
            doc, word = cell // terms, cell % terms
            x = np.log1p(times).astype(np.float32) * idf32[word]
            norm = np.sqrt(np.bincount(doc, x * x, len(column))).astype(np.float32)
            x /= np.maximum(norm[doc], 1e-9)
            y = _added(basis32, word, doc, len(column), x)
            order = np.argsort(word.astype(kind), kind="stable")
            word = word[order]
            new = np.r_[True, word[1:] != word[:-1]] if len(word) else np.zeros(0, bool)
            total[word[new]] += _added(y, doc[order], np.cumsum(new) - 1, int(new.sum()), x[order])

        idf32, basis32 = idf.astype(np.float32), basis.astype(np.float32)
        return _summed(docs, (terms, rank), add)

    q = np.random.default_rng(0).standard_normal((terms, rank))
    for _ in range(PASSES - 1):
        q, _r = np.linalg.qr(product(np.linalg.qr(q)[0]))
    b = q.T @ product(q)
    _, u = np.linalg.eigh((b + b.T) / 2)
    return _unit(q @ u[:, ::-1])


def _unit(a: np.ndarray) -> np.ndarray:
    return a / np.maximum(np.linalg.norm(a, axis=-1, keepdims=True), 1e-9)


@dataclass
class Model:
    """``spread``: terms x languages; ``centroids``: languages x subjects x rank; ``floor``: the weight of its heaviest term below
    which a sentence of a language treats nothing."""

    subjects: list[str]
    vectors: np.ndarray
    idf: np.ndarray
    language: np.ndarray
    spread: np.ndarray
    centroids: np.ndarray
    floor: np.ndarray

    def __post_init__(self) -> None:
        self.vectors = self.vectors.astype(np.float32)
        #: Each term's share in the likeness of a sentence to each language: likenesses add up, so no embedding is needed.
        self.tells = ((self.vectors * self.idf[:, None]) @ self.language.T).astype(np.float32)
        self.weight = (self.spread * self.idf[:, None]).astype(np.float32)
        #: Every term's vector times its weight, one language after the other.
        self.weighted = (self.weight.T[:, :, None] * self.vectors).reshape(-1, self.vectors.shape[1])

    def __reduce__(self):
        """Only the fields are sent to the tasks; what follows from them is made there."""
        return Model, (self.subjects, self.vectors, self.idf.astype(np.float32), self.language, self.spread.astype(np.float32), self.centroids, self.floor)

    def read(self, word: np.ndarray, sent: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of ``n`` sentences: language, cosine with each subject, and whether a term is heavy enough for it to treat one."""
        lang = np.stack([np.bincount(sent, self.tells[word, x], n) for x in range(self.tells.shape[1])], 1).argmax(1)
        spread = self.spread[word, lang[sent]]
        heavy = np.zeros(n, bool)
        heavy[sent[(spread > 0) & (spread >= self.floor[lang[sent]])]] = True
        unit, near = _unit(_added(self.weighted, lang[sent] * len(self.vectors) + word, sent, n)), np.zeros((n, len(self.subjects)), np.float32)
        for x, c in enumerate(_unit(self.centroids).astype(np.float32)):
            near[lang == x] = unit[lang == x] @ c.T
        return lang, near, heavy


def _added(table: np.ndarray, index: np.ndarray, group: np.ndarray, n: int, scale: np.ndarray | None = None) -> np.ndarray:
    """Of each of ``n`` groups the sum of its rows of ``table``, ``scale`` times each; ``group`` ascends. The first members of all
    groups are added, then the second ones, and so on, so that no copy of all rows is made."""
    out = np.zeros((n, table.shape[1]), np.float32)
    if not len(index):
        return out
    start = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
    size = np.diff(np.r_[start, len(group)])
    order = np.argsort(-size, kind="stable")
    start, which = start[order], group[start[order]]
    left = np.searchsorted(-size[order], -np.arange(size.max()), "left")  # groups with more than k members
    sums = np.zeros((len(start), table.shape[1]), np.float32)
    for k, active in enumerate(left):
        at = start[:active] + k
        rows = table[index[at]]
        sums[:active] += rows if scale is None else rows * scale[at, None]
    out[which] = sums
    return out


def _spreads(counts: np.ndarray, mass: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """From terms x subjects x languages sentence counts and subjects x languages totals: the spread weight of each term in each
    language, and the floor of each language, half the weight of its typical subject word."""
    subjects = counts.shape[1]
    mean = mass.mean(0, keepdims=True)
    counts = counts * (mean / (mass + 0.25 * mean + 1))
    prior = np.maximum(PRIOR[0], PRIOR[1] * mass.sum(0) / subjects)
    p = counts + prior
    p /= p.sum(1, keepdims=True)
    weight = 1 + (p * np.log(p)).sum(1) / math.log(max(2, subjects))
    weight[counts.sum(1) == 0] = 0
    main = p.argmax(1)
    floor = np.ones(counts.shape[2])
    for x in range(counts.shape[2]):
        tops = [np.sort(weight[main[:, x] == s, x])[-10:] for s in range(subjects)]
        tops = [t[t > 0] for t in tops if (t > 0).any()]
        floor[x] = FLOOR * float(np.mean([t.mean() for t in tops])) if tops else 1.0
    return weight, floor


def fit(documents: DataFrame, key: str, text: str, examples: list[tuple[str, str, str]]) -> tuple[Model, DataFrame]:
    """The refined model and the coded documents; ``examples`` are (subject, language, text)."""
    parts = [(s, x, sentences(t)) for s, x, t in examples]
    words, df, total = vocabulary(documents, text, {w.decode() for _, _, t in parts for sent in t for w in sent})
    docs, at, terms = coded(documents, key, text, words), Terms(words), range(len(df) if total else 0)
    subjects, langs = sorted({s for s, _, _ in examples}), sorted({x for _, x, _ in examples})
    idf = np.log(1 + total / np.maximum(1, df[: len(terms)]))
    vectors = term_vectors(docs, idf) if len(terms) else np.zeros((0, 1))
    rank, shape = vectors.shape[1], (len(terms), len(subjects), len(langs))

    seeds = [(subjects.index(s), langs.index(x), np.array(at.of(sent))) for s, x, t in parts for sent in t] if total else []
    counts, mass, language = np.zeros(shape), np.zeros(shape[1:]), np.zeros((len(langs), rank))
    for s, x, w in seeds:
        counts[w, s, x] += 1
        mass[s, x] += 1
        language[x] += _unit(idf[w] @ vectors[w])
    spread, floor = _spreads(counts, mass)
    model = Model(subjects, vectors, idf, _unit(language), spread, _seeded(seeds, spread, idf, vectors, shape), floor)
    for _ in range(ROUNDS if len(terms) and seeds else 0):
        cells = shape[0] * shape[1] * shape[2]
        rows = shape[1] * shape[2]

        def add(sums: np.ndarray, column: pa.Array, model: Model = model) -> None:
            word, sent, of = _flat(column, _kind(shape[0]))
            lang, near, heavy = model.read(word, sent, len(of))
            two = np.sort(near, 1)[:, -2:]
            ok = heavy & (two[:, -1] > NEAR) & (two[:, -1] - (two[:, 0] if two.shape[1] > 1 else 0) > CLEAR)
            best = near.argmax(1)
            t = ok[sent]
            sums[:cells] += np.bincount((word[t] * shape[1] + best[sent[t]]) * shape[2] + lang[sent[t]], minlength=cells)
            sums[cells:] += np.bincount(best[ok] * shape[2] + lang[ok], minlength=rows)

        sums = _summed(docs, (cells + rows,), add)
        counts, mass = sums[:cells].reshape(shape), sums[cells:].reshape(shape[1:])
        # the sum of the assigned sentences' embeddings, by terms
        centroids = np.einsum("tsl,tl,tk->lsk", counts, model.weight, model.vectors, optimize=True)
        spread, floor = _spreads(counts, mass)
        centroids += _seeded(seeds, spread, idf, vectors, shape)
        model = Model(subjects, vectors, idf, model.language, spread, centroids, floor)
    return model, docs


def _seeded(seeds: list, spread: np.ndarray, idf: np.ndarray, vectors: np.ndarray, shape: tuple) -> np.ndarray:
    out = np.zeros((shape[2], shape[1], vectors.shape[1]))
    for s, x, w in seeds:
        out[x, s] += (spread[w, x] * idf[w]) @ vectors[w]
    return out


def assign(docs: DataFrame, model: Model) -> DataFrame:
    """``key, n_sentences INT, shares MAP<STRING, DOUBLE>``: the part of its sentences that treat each subject, if any does."""
    kinds = dict(docs.dtypes)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (b.slice(a, CHUNK) for b in batches for a in range(0, b.num_rows, CHUNK)):
            word, sent, of = _flat(batch.column(1), _kind(len(model.vectors)))
            n, k = batch.num_rows, len(model.subjects)
            _, near, heavy = model.read(word, sent, len(of)) if len(of) else (0, np.zeros((0, k)), np.zeros(0, bool))
            top = near.max(1, initial=-1.0)
            alike = heavy[:, None] & (near >= top[:, None] - CLEAR) & (top > 0)[:, None]
            one = alike.sum(1) == 1
            hits = np.zeros((n, k))
            np.add.at(hits, (of[one], alike[one].argmax(1)), 1)
            sure = hits.copy()
            for i in np.flatnonzero(alike.sum(1) > 1):  # by the rest of the document, else the nearest
                rest = np.where(alike[i], sure[of[i]], -1)
                hits[of[i], rest.argmax() if rest.max() > 0 else near[i].argmax()] += 1
            size = np.bincount(of, minlength=n)
            shares = [[(model.subjects[s], float(hits[i, s] / size[i])) for s in np.flatnonzero(hits[i])] for i in range(n)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(size, pa.int32()), pa.array(shares, pa.map_(pa.string(), pa.float64()))], ["key", "n_sentences", "shares"])

    return docs.mapInArrow(run, f"key {kinds['key']}, n_sentences int, shares map<string, double>")


def document_subjects(documents: DataFrame, key: str, text: str, examples: DataFrame, subject: str, lang: str, example_text: str) -> DataFrame:
    """``<key>, n_sentences, shares, subjects ARRAY<STRING>`` of every row of ``documents``; ``subjects`` are those of at least SHARE
    of its sentences.

    Null and wordless texts have no sentence and no subject; repeated rows come out repeated; other columns are left out. Examples
    without subject, language or text are passed over; without any example no document has a subject.
    """
    rows = examples.select(F.col(subject).alias("s"), F.lower(F.trim(F.col(lang))).alias("l"), F.col(example_text).alias("t")).where("s is not null and l is not null and t is not null").distinct()
    given = [(r["s"], r["l"], r["t"]) for r in rows.orderBy(F.xxhash64("s", "l", "t"), "s", "l", "t").limit(EXAMPLES).collect()]
    if given:
        model, docs = fit(documents, key, text, given)
        out = assign(docs, model)
    else:
        out = coded(documents, key, text, []).select("key", "n_sentences", F.create_map().cast("map<string,double>").alias("shares"))
    treated = F.array_sort(F.map_keys(F.map_filter("shares", lambda _, v: v >= SHARE)))
    return out.select(F.col("key").alias(key), "n_sentences", "shares", treated.alias("subjects"))

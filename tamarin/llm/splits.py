"""Problem 3: records of one split that come back, exactly or nearly, in another.

Winnowing over word sequences. Every run of RUN words has a rolling hash; a window slides over the runs and the minimum of each window
is a record's fingerprint. Two records of at most one word in BUDGET differing share a stretch of equal words, and the window is as
wide as that stretch's length allows, so they share a fingerprint for certain. The order that minima are taken in is by how common a
run is, roughly, and then by its hash (weighted minimizers): any order keeps the promise, this one leaves out the runs that everyone
has. How common a run is comes from a sketch of fixed size over all records.

Fingerprints are joined across splits, common ones in slices. A seed counts if it lies near the diagonal and grows to a stretch as long
as the promised one, and if neither record has more words of its own than the budget, by masks of their words. The seeds of a pair are chained: the longest
collinear chain, extended word by word, gives the covered words; the words between are aligned, which gives the exact distance.

Records with the same words form one class before anything is joined; classes are compared, members come back at the end.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tamarin.llm.words import plain_words
from tamarin.plans.durable import durable

#: Words in a fingerprinted run.
RUN = 3
#: At most one word in BUDGET of the longer record differs.
BUDGET = 5
#: Cells of the sketch that counts runs: 65,536 numbers, whatever the tables' size.
SKETCH = 1 << 16
#: A run in one of RARE is common: it comes later in the order, by powers of two.
RARE = 20_000
#: A run's rows are dealt to one slice more for each such share of all runs that it has, from so many rows on.
SLICES, HOT = 1024, 1000
#: Words of a record from which on only a part of them stands in its mask of 128 bits.
MASK = 96
#: Words kept in a worker's cache.
CACHE = 500_000

_B = np.uint64(0x9E3779B97F4A7C15)


class _Ids(dict):
    """The 64-bit hash of a word, kept while the cache lasts."""

    def __missing__(self, word: str) -> int:
        if len(self) >= CACHE:
            self.clear()
        self[word] = out = xxhash.xxh3_64_intdigest(word)
        return out


_IDS = _Ids()


def clean_run(n: int) -> int:
    """Equal words in a row that a record of n words is sure to share with any record within the budget, unless it is its copy."""
    return min(-(-(m - m // BUDGET) // (m // BUDGET + 1)) for m in range(n, n * BUDGET // (BUDGET - 1) + 1))


#: Records of at least LONG words have windows of two runs, as their clean stretches have RUN + 1 words; shorter ones give every run.
LONG = 16


def rolling(ids: np.ndarray, run: int) -> np.ndarray:
    """The rolling (polynomial) hash of every run of ``run`` words, its bits mixed so that its order is arbitrary."""
    n = len(ids) - run + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    with np.errstate(over="ignore"):
        h = np.full(n, run, np.uint64)
        for k in range(run):
            h = h * _B + ids[k : k + n]
        h ^= h >> np.uint64(31)
        h *= np.uint64(0xBF58476D1CE4E5B9)
        h ^= h >> np.uint64(29)
    return h


class Batch:
    """The words of a batch of records, hashed, one after the other."""

    def __init__(self, words: list[list[str]]):
        self.sizes = np.fromiter(map(len, words), np.int64, len(words))
        self.ids = np.fromiter((_IDS[w] for x in words for w in x), np.uint64, int(self.sizes.sum()))
        self.which = np.repeat(np.arange(len(words)), self.sizes)
        self.first = np.cumsum(self.sizes) - self.sizes

    def runs(self, run: int) -> tuple[np.ndarray, np.ndarray]:
        """Of the runs inside records: hash, and place in ``ids``."""
        h = rolling(self.ids, run)
        ok = np.flatnonzero(self.which[: len(h)] == self.which[run - 1 :]) if len(h) else np.zeros(0, np.int64)
        return h[ok], ok

    def beside(self, at: np.ndarray, owner: np.ndarray) -> np.ndarray:
        """A byte of the word at ``at``; 0 where it is another record's."""
        inside = (at >= 0) & (at < len(self.ids))
        at = np.where(inside, at, 0)
        return np.where(inside & (self.which[at] == owner), (self.ids[at] % np.uint64(255)).astype(np.int64) + 1, 0)

    def masks(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of each record a mask with a bit for each of its words, in two halves, and the mask's level: from MASK words on only one
        word in two, from 2 * MASK words on one in four, and so on, sets a bit."""
        level = np.ceil(np.log2(np.maximum(1, (self.sizes + 1) / MASK))).astype(np.uint64)
        word = self.ids >> np.uint64(7)
        some = word & ((np.uint64(1) << level[self.which]) - np.uint64(1)) == 0
        bit = np.where(some, np.uint64(1) << (self.ids & np.uint64(63)), np.uint64(0))
        high = self.ids & np.uint64(64) != 0
        half = lambda x: np.bitwise_or.reduceat(np.where(x, bit, np.uint64(0)), self.first)
        return half(~high), half(high), level.astype(np.int64)


def winnow(h: np.ndarray, which: np.ndarray, long: np.ndarray, level: np.ndarray) -> np.ndarray:
    """Which runs are fingerprints: the minima of every window of two runs of a long record, all of a short one's."""
    order = level[(h & np.uint64(SKETCH - 1)).astype(np.int64)].astype(np.uint64) << np.uint64(56) | h >> np.uint64(8)
    same = which[1:] == which[:-1]
    least = ~long[which]
    least[:-1] |= same & (order[:-1] <= order[1:])
    least[1:] |= same & (order[1:] <= order[:-1])
    return least


def levels(counts: np.ndarray) -> np.ndarray:
    """Of each cell of the sketch, how common its runs are."""
    return np.floor(np.log2(1 + counts * (RARE / max(1, counts.sum())))).astype(np.uint8)


def slices(counts: np.ndarray) -> np.ndarray:
    """Of each cell, the slices that its runs' rows are dealt to."""
    over = np.maximum(0, counts - 2 * counts.mean() - HOT)
    return (1 + np.floor(over * (SLICES / max(1, counts.sum())))).astype(np.int64)


def word_classes(df: DataFrame, key: str, text: str, keep: list[str]) -> DataFrame:
    """``key, keep..., form BINARY, words STRING, n INT``; ``form`` identifies the word sequence, ``words`` is parted by spaces.
    Records without words are left out."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = [plain_words(t) for t in batch.column(batch.num_columns - 1).to_pylist()]
            whole = [b" ".join(w) for w in words]
            out = [pa.array([xxhash.xxh3_128_digest(w) for w in whole], pa.binary()), pa.array([w.decode() for w in whole], pa.string()), pa.array([len(w) for w in words], pa.int32())]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *out], [*batch.schema.names[:-1], "form", "words", "n"])

    kinds = dict(df.dtypes)
    schema = ", ".join(f"`{c}` {kinds[c]}" for c in [key, *keep]) + ", form binary, words string, n int"
    return df.select(key, *keep, text).mapInArrow(run, schema).where("n > 0")


def _counts(classes: DataFrame) -> np.ndarray:
    """The sketch: how many runs of all classes fall into each cell. Each task adds up its own; SKETCH sums reach the driver."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(SKETCH, np.int64)
        for batch in batches:
            h, _ = Batch([w.split(" ") for w in batch.column(0).to_pylist()]).runs(RUN)
            total += np.bincount((h & np.uint64(SKETCH - 1)).astype(np.int64), minlength=SKETCH)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array(total[some], pa.int64())], ["cell", "n"])

    out = np.zeros(SKETCH, np.int64)
    for r in classes.select("words").mapInArrow(run, "cell int, n long").groupBy("cell").agg(F.sum("n").alias("n")).collect():
        out[r["cell"]] = r["n"]
    return out


def _fingerprints(classes: DataFrame, level: np.ndarray, parts: np.ndarray, every: bool) -> DataFrame:
    """The fingerprints of each class: ``gram, id, n, pos, near, low, high``. ``id`` begins the form, ``near`` holds the mask's level and a
    byte of the word before and after the run. Common runs stand in one of their slices, or in each with ``every``. Records of four
    or five words, whose three-word runs one change may all destroy, also give runs of two."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            given = Batch([w.split(" ") for w in batch.column(1).to_pylist()])
            form = np.array([int.from_bytes(x.as_py()[:8], signed=True) for x in batch.column(0)], np.int64)
            h, at = given.runs(RUN)
            ok = winnow(h, given.which[at], given.sizes >= LONG, level)
            h, at = h[ok], at[ok]
            width = np.full(len(h), RUN)
            h2, at2 = given.runs(2)
            if len(few := np.flatnonzero((given.sizes[given.which[at2]] >= BUDGET - 1) & (given.sizes[given.which[at2]] <= BUDGET))):
                h, at, width = np.r_[h, h2[few]], np.r_[at, at2[few]], np.r_[width, np.full(len(few), 2)]
            owner = given.which[at]
            low, high, grade = given.masks()
            near = grade[owner] << 16 | given.beside(at - 1, owner) << 8 | given.beside(at + width, owner)
            many = parts[(h & np.uint64(SKETCH - 1)).astype(np.int64)]
            row = np.repeat(np.arange(len(h)), many) if every else np.arange(len(h))
            part = np.arange(len(row)) - np.repeat(np.cumsum(many) - many, many) if every else (form[owner] & 0xFFFFFFFF) % many
            with np.errstate(over="ignore"):
                gram = h[row] + part.astype(np.uint64) * _B
            pos = (at - given.first[owner])[row]
            owner = owner[row]
            columns = (gram.view(np.int64), form[owner], given.sizes[owner].astype(np.int32), pos.astype(np.int32), near[row].astype(np.int32), low[owner].view(np.int64), high[owner].view(np.int64))
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["gram", "id", "n", "pos", "near", "low", "high"])

    return classes.select("form", "words").mapInArrow(run, "gram long, id long, n int, pos int, near int, low long, high long")


def budget(n: Column, m: Column) -> Column:
    return F.floor(F.greatest(n, m) / BUDGET).cast("int")


def chain(seeds: list[tuple[int, int]], a: list[str], b: list[str]) -> int:
    """Words of ``a`` covered by the longest collinear chain of seeds (positions in both, of runs), each grown as far as words are
    equal. Seeds on one diagonal whose stretches meet are one stretch."""
    spans: list[tuple[int, int, int]] = []
    for i, j in sorted(set(seeds)):
        if any(i - x == j - y and x <= i < x + k for x, y, k in spans):
            continue
        x, y, k = i, j, 0
        while x and y and a[x - 1] == b[y - 1]:
            x, y, k = x - 1, y - 1, k + 1
        while x + k < len(a) and y + k < len(b) and a[x + k] == b[y + k]:
            k += 1
        spans.append((x, y, k))
    best: list[int] = []
    spans.sort()
    for s, (x, y, k) in enumerate(spans):
        # a stretch that begins inside the one before counts for the words beyond it
        best.append(k)
        for t in range(s):
            u, v, m = spans[t]
            over = max(0, u + m - x, v + m - y)
            if u < x and v < y and over < k:
                best[s] = max(best[s], best[t] + k - over)
    return max(best, default=0)


def distance(a: list[str], b: list[str], most: int) -> int:
    """The word edit distance, or ``most + 1`` where it is larger: bands of the table around its diagonal, row by row."""
    while a and b and a[-1] == b[-1]:
        a, b = a[:-1], b[:-1]
    k = 0
    while k < min(len(a), len(b)) and a[k] == b[k]:
        k += 1
    a, b = a[k:], b[k:]
    if abs(len(a) - len(b)) > most:
        return most + 1
    code = {w: i for i, w in enumerate(dict.fromkeys([*a, *b]))}
    x, y = [code[w] for w in a], np.fromiter((code[w] for w in b), np.int64, len(b))
    steps = np.arange(len(b) + 1)
    row = steps.copy()
    for i, w in enumerate(x, 1):
        lo, hi = max(1, i - most), min(len(b), i + most)
        new = np.full(len(b) + 1, most + 1)
        if i <= most:
            new[0] = i
        new[lo : hi + 1] = np.minimum(row[lo : hi + 1] + 1, row[lo - 1 : hi] + (y[lo - 1 : hi] != w))
        new[lo - 1 : hi + 1] = np.minimum.accumulate(new[lo - 1 : hi + 1] - steps[lo - 1 : hi + 1]) + steps[lo - 1 : hi + 1]
        row = np.minimum(new, most + 1)
        if row.min() > most:
            return most + 1
    return int(row[-1])


def _aligned(pairs: DataFrame) -> DataFrame:
    """``eval_form, train_form, seeds, wa, wb`` to ``eval_form, train_form, edits, coverage`` of the pairs within the budget."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep, edits, covered = [], [], []
            for r, (seeds, wa, wb) in enumerate(zip(*(batch.column(c).to_pylist() for c in (2, 3, 4)))):
                a, b = wa.split(" "), wb.split(" ")
                most = max(len(a), len(b)) // BUDGET
                if (d := distance(a, b, most)) <= most:
                    keep.append(r)
                    edits.append(d)
                    covered.append(chain([(s["pa"], s["pb"]) for s in seeds], a, b) / len(a))
            at = pa.array(keep, pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0).take(at), batch.column(1).take(at), pa.array(edits, pa.int32()), pa.array(covered, pa.float64())], ["eval_form", "train_form", "edits", "coverage"])

    return pairs.mapInArrow(run, "eval_form binary, train_form binary, edits int, coverage double")


def class_overlaps(classes: DataFrame) -> DataFrame:
    """Pairs of an eval class and a train class within the budget: ``eval_form, train_form, edits, coverage``. ``classes``: ``form,
    words, n, train BOOLEAN, eval BOOLEAN``, one row per word sequence."""
    counts = _counts(classes)
    level, parts = levels(counts), slices(counts)
    named = lambda df, x: df.select("gram", *(F.col(c).alias(f"{c}_{x}") for c in ("id", "n", "pos", "near", "low", "high")))
    met = named(_fingerprints(classes.where("eval"), level, parts, True), "a").join(named(_fingerprints(classes.where("train"), level, parts, False), "b"), "gram")
    most = budget(F.col("n_a"), F.col("n_b"))
    band = (F.abs(F.col("n_a") - F.col("n_b")) <= most) & (F.abs(F.col("pos_a") - F.col("pos_b")) <= most)
    both = F.col("near_a").bitwiseXOR(F.col("near_b"))  # a byte is 0 where the words are equal
    beside = lambda byte: (both.bitwiseAND(byte) == 0) & (F.col("near_a").bitwiseAND(byte) != 0)
    grows = (F.greatest("n_a", "n_b") < LONG) | beside(0xFF) | beside(0xFF00)
    # each word that only one record has costs an edit
    extra = lambda x, y: F.bit_count(F.col(x).bitwiseAND(F.bitwise_not(F.col(y))))
    lacks = lambda x, y: extra(f"low_{x}", f"low_{y}") + extra(f"high_{x}", f"high_{y}") <= most
    alike = (both >= 1 << 16) | (lacks("a", "b") & lacks("b", "a"))
    seeds = met.where(band & grows & alike)
    # as many seeds a pair as the records have fingerprints
    pairs = seeds.groupBy("id_a", "id_b").agg(F.collect_set(F.struct(F.col("pos_a").alias("pa"), F.col("pos_b").alias("pb"))).alias("seeds"))
    w = classes.select("form", "words", "train", "eval", F.conv(F.hex(F.substring("form", 1, 8)), 16, -10).cast("long").alias("id"))
    e = w.where("eval").select(F.col("id").alias("id_a"), F.col("form").alias("eval_form"), F.col("words").alias("wa"))
    t = w.where("train").select(F.col("id").alias("id_b"), F.col("form").alias("train_form"), F.col("words").alias("wb"))
    close = pairs.join(e, "id_a").join(t, "id_b").where("eval_form <> train_form")
    same = classes.where("eval and train").select(F.col("form").alias("eval_form"), F.col("form").alias("train_form"), F.lit(0).alias("edits"), F.lit(1.0).alias("coverage"))
    return _aligned(close.select("eval_form", "train_form", "seeds", "wa", "wb")).unionByName(same)


def _classes(rows: DataFrame) -> DataFrame:
    return rows.groupBy("form").agg(F.first("words").alias("words"), F.first("n").alias("n"), F.bool_or(F.col("split") == "train").alias("train"), F.bool_or(F.col("split") != "train").alias("eval"))


def split_records(splits: dict[str, DataFrame], key: str, text: str, source: str) -> DataFrame:
    """All records of all splits with their word classes. ``splits`` maps split names, one of them ``train``, to tables. Null and
    wordless texts are no record; a null ``source`` stays null."""
    every = None
    for name, df in splits.items():
        one = df.select(F.col(key).alias("key"), F.lit(name).alias("split"), F.col(source).alias("source"), F.col(text).alias("text"))
        every = one if every is None else every.unionByName(one)
    return durable(word_classes(every, "key", "text", ["split", "source"]), "records")


def overlaps(rows: DataFrame) -> DataFrame:
    """Member pairs from ``split_records``: ``eval_key, eval_split, eval_source, train_key, train_source, edits, coverage``.
    ``coverage`` is the share of the eval record's words that the chain of equal stretches covers."""
    classes = durable(_classes(rows), "classes")
    pairs = class_overlaps(classes)
    e = rows.where("split <> 'train' and key is not null").select(F.col("form").alias("eval_form"), F.col("key").alias("eval_key"), F.col("split").alias("eval_split"), F.col("source").alias("eval_source"))
    t = rows.where("split = 'train' and key is not null").select(F.col("form").alias("train_form"), F.col("key").alias("train_key"), F.col("source").alias("train_source"))
    return pairs.join(e, "eval_form").join(t, "train_form").select("eval_key", "eval_split", "eval_source", "train_key", "train_source", "edits", "coverage").distinct()


def overlap_report(rows: DataFrame) -> DataFrame:
    """Per split and source of the evaluation records: ``split, source, records, leaked, exact, coverage``; ``records`` counts those
    with words, ``leaked`` those with a train record within the budget, ``exact`` those with the same words, ``coverage`` is the mean
    best coverage over all records. Members are not paired: each class carries its best partner."""
    best = class_overlaps(durable(_classes(rows), "classes")).groupBy(F.col("eval_form").alias("form")).agg(F.min("edits").alias("edits"), F.max("coverage").alias("coverage"))
    e = rows.where("split <> 'train' and key is not null").select("key", "split", "source", "form").distinct()
    return e.join(best, "form", "left").groupBy("split", "source").agg(
        F.count("*").alias("records"), F.count("edits").alias("leaked"), F.count_if(F.col("edits") == 0).alias("exact"), F.round(F.avg(F.coalesce("coverage", F.lit(0.0))), 6).alias("coverage")
    )

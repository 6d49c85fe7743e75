"""Problem 6: how much of a text repeats earlier parts of it, and a learned decision list that tells the cases.

A plain word is a repeat if it belongs to a run of three or more words that has already begun earlier in the text, or equals the
word before it. The list decides from four statistics that one pass over the words gives: the share of distinct words, of words
equal to the one before, of the commonest word, and of word pairs seen before. The share of repeats is not among them.

The list is learned by sequential covering from a bounded sample labelled by the definition: each rule, a conjunction of thresholds,
is grown by information gain on two thirds of the sample, pruned on the rest, and its rows are taken away before the next one. Only
rules without an error and with SUPPORT rows enter. The list comes out as an ordered ``CASE WHEN``; what a rule holds for is decided
by it, without another look at the text. Texts that no rule covers are measured exactly.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from operator import eq

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tamarin.llm.words import plain_words

#: Length of a run that counts.
RUN = 3
#: A case: at least MIN_WORDS words, at least SHARE[0] in SHARE[1] of them repeats.
MIN_WORDS, SHARE = 6, (3, 10)
#: Labelled rows the list is learned from, at most: those of the lowest hash.
SAMPLE = 4000

#: Rows of the sample that a rule must cover.
SUPPORT = 25

FEATURES = ("distinct_share", "echo_share", "top_share", "pair_share")


def repeats(words: list[bytes]) -> int:
    """Words that are repeats."""
    n = len(words)
    hit, seen = bytearray(n), set()
    for i in range(n - RUN + 1):
        run = tuple(words[i : i + RUN])
        if run in seen:
            hit[i : i + RUN] = b"\1" * RUN
        else:
            seen.add(run)
    for i in range(1, n):
        if words[i] == words[i - 1]:
            hit[i] = 1
    return sum(hit)


def statistics(words: list[bytes]) -> tuple[float, ...]:
    """The FEATURES of a text's words."""
    n = len(words)
    if not n:
        return 1.0, 0.0, 0.0, 0.0
    counts = Counter(words)
    echo = sum(map(eq, words, words[1:]))
    pairs = len(set(zip(words, words[1:])))
    return len(counts) / n, echo / n, max(counts.values()) / n, 1 - pairs / (n - 1) if n > 1 else 0.0


def _mapped(df: DataFrame, key: str, text: str, columns: str, row: Callable[[list[bytes]], tuple], keep_text: bool) -> DataFrame:
    """``<key>`` [and the text as ``text``] and ``columns``, made of the plain words of each row's whole text."""
    fields = [x.split() for x in columns.split(", ")]
    kinds = [{"int": pa.int32(), "double": pa.float64(), "boolean": pa.bool_()}[k] for _, k in fields]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [row(plain_words(t)) for t in batch.column(1).to_pylist()]
            cols = list(zip(*rows)) or [()] * len(kinds)
            given = batch.columns if keep_text else batch.columns[:1]
            yield pa.RecordBatch.from_arrays([*given, *(pa.array(c, k) for c, k in zip(cols, kinds))], [*(("key", "text")[: len(given)]), *(f for f, _ in fields)])

    one = df.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    kind = dict(one.dtypes)["key"]
    return one.mapInArrow(run, f"`key` {kind}, " + ("text string, " if keep_text else "") + columns)


_STATISTICS = "n_words int, " + ", ".join(f"{f} double" for f in FEATURES)


def text_statistics(df: DataFrame, key: str, text: str) -> DataFrame:
    """``key, text, n_words`` and the FEATURES of every row."""
    return _mapped(df, key, text, _STATISTICS, lambda w: (len(w), *statistics(w)), True)


def repetition(df: DataFrame, key: str, text: str) -> DataFrame:
    """One row per row of ``df``: ``<key>, n_words, repeats, repeat_share`` and the FEATURES of the whole ``text``. Null and blank
    texts have no words and share 0; texts below three words can only echo. Other columns are left out."""
    measure = lambda w: (len(w), r := repeats(w), r / len(w) if w else 0.0, *statistics(w))
    columns = "n_words int, repeats int, repeat_share double, " + ", ".join(f"{f} double" for f in FEATURES)
    return _mapped(df, key, text, columns, measure, False).withColumnRenamed("key", key)


def is_case(n: int, again: int) -> bool:
    return n >= MIN_WORDS and again * SHARE[1] >= n * SHARE[0]


@dataclass(frozen=True)
class Rule:
    """A conjunction of (feature, is upper bound, threshold) that says ``label``."""

    label: str
    conditions: tuple[tuple[str, bool, float], ...]

    def holds(self, row: dict) -> bool:
        return all(row[f] <= t if upper else row[f] >= t for f, upper, t in self.conditions)

    def column(self) -> Column:
        out = F.lit(True)
        for f, upper, t in self.conditions:
            out = out & ((F.col(f) <= t) if upper else (F.col(f) >= t))
        return out


def _gain(p0: int, n0: int, p1: int, n1: int) -> float:
    return p1 * (math.log2(p1 / (p1 + n1)) - math.log2(p0 / (p0 + n0))) if p1 else -1.0


def _grow(rows: list[dict], label: str) -> tuple:
    conditions: list[tuple[str, bool, float]] = []
    while True:
        pos, neg = [r for r in rows if r["label"] == label], [r for r in rows if r["label"] != label]
        if not neg or not pos:
            return tuple(conditions)
        best = (0.0, None)
        for f in FEATURES:
            for upper in (True, False):
                order = sorted({r[f] for r in pos}, reverse=not upper)
                inside = lambda v, t, upper=upper: v <= t if upper else v >= t
                for t in order[:: max(1, len(order) // 64)] + order[-1:]:
                    p1, n1 = sum(inside(r[f], t) for r in pos), sum(inside(r[f], t) for r in neg)
                    if (g := _gain(len(pos), len(neg), p1, n1)) > best[0] + 1e-9:
                        best = (g, (f, upper, t))
        if best[1] is None:
            return tuple(conditions)
        conditions.append(best[1])
        f, upper, t = best[1]
        rows = [r for r in rows if (r[f] <= t if upper else r[f] >= t)]


def _prune(conditions: tuple, rows: list[dict], label: str) -> tuple:
    def worth(c: tuple) -> float:
        hit = [r for r in rows if Rule(label, c).holds(r)]
        p = sum(r["label"] == label for r in hit)
        return (2 * p - len(hit)) / len(hit) if hit else -1.0

    while len(conditions) > 1 and worth(conditions[:-1]) >= worth(conditions):
        conditions = conditions[:-1]
    return conditions


def learn_decision_list(rows: list[dict], labels: tuple[str, ...], support: int = SUPPORT) -> list[Rule]:
    """Sequential covering for ``labels`` in turn; ``rows`` hold the features and ``label``. A label's rules end with the first that
    covers fewer than ``support`` rows or errs. Deterministic for a set of rows."""
    rows = sorted(rows, key=lambda r: tuple(r[f] for f in FEATURES))
    out: list[Rule] = []
    for label in labels:
        left = rows
        while any(r["label"] == label for r in left) and len(out) < 32:
            grow, hold = [r for i, r in enumerate(left) if i % 3], left[::3]
            if not any(r["label"] == label for r in grow):
                grow = left
            if not (c := _prune(_grow(grow, label), hold, label)):
                break
            rule = Rule(label, c)
            hit = [r for r in left if rule.holds(r)]
            if len(hit) < support or any(r["label"] != label for r in hit):
                break
            out.append(rule)
            left = [r for r in left if not rule.holds(r)]
    return out


def decision(rules: list[Rule], default: str = "uncertain") -> Column:
    """The ordered conditional expression of a decision list."""
    out = None
    for r in rules:
        out = F.when(r.column(), r.label) if out is None else out.when(r.column(), r.label)
    return F.lit(default) if out is None else out.otherwise(default)


def fit(df: DataFrame, key: str, text: str) -> list[Rule]:
    """Learn the list from at most ``SAMPLE`` rows of ``df`` of MIN_WORDS words or more, those of the lowest hash of key and text,
    labelled by the definition."""
    rows = df.where(F.col(text).isNotNull()).orderBy(F.xxhash64(key, text), key, text).limit(SAMPLE)
    sample = repetition(rows, key, text).where(F.col("n_words") >= MIN_WORDS).select("n_words", "repeats", *FEATURES).collect()
    return learn_decision_list([{f: r[f] for f in FEATURES} | {"label": "repetitive" if is_case(r["n_words"], r["repeats"]) else "clean"} for r in sample], ("repetitive", "clean"))


def decided(df: DataFrame, key: str, text: str, rules: list[Rule]) -> DataFrame:
    """``key, text, said`` of the rows of MIN_WORDS words or more: "repetitive" and "clean" as the list has it, else "uncertain"."""
    return text_statistics(df, key, text).where(F.col("n_words") >= MIN_WORDS).select("key", "text", decision(rules).alias("said"))


def repetitive(df: DataFrame, key: str, text: str, rules: list[Rule]) -> DataFrame:
    """Distinct keys of the cases among ``df``: what the list calls repetitive, and of what it leaves open those that the definition
    calls so. A null key is no case; null, blank and short texts are none."""
    said = decided(df.where(F.col(key).isNotNull()), key, text, rules).where("said <> 'clean'")
    # a row that the list decides goes on without its text
    left = said.select("key", F.when(F.col("said") == "uncertain", F.col("text")).alias("text"))
    return _mapped(left, "key", "text", "found boolean", lambda w: (not w or is_case(len(w), repeats(w)),), False).where("found").select(F.col("key").alias(key)).distinct()

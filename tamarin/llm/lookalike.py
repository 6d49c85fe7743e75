"""Problem 1: one consistent form of texts that look the same but differ in their characters.

Each text is compatibility-normalised (width, encoding of accents, kinds of space; raised and lowered characters stay, for they
look different), characters that show nothing are deleted, and every token becomes a lattice: each letter position holds all
letters of that shape, of whatever script, that the corpus writes. Viterbi picks the path with the best character bigram scores, learned from
script-pure tokens of all rows, under a penalty for each change of script. The lattice depends on shapes only and its path keeps
one letter for every shape, so two texts get the same form exactly if they look the same.

Which letters have a shape in common is the public table of confusable characters (Unicode Technical Standard 39), as ICU holds it:
letters of other scripts whose skeleton is that of one Latin letter, of the same case where the table joins cases.
"""

from __future__ import annotations

import math
import string
import unicodedata
from collections import Counter
from collections.abc import Iterable, Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: What the table lacks or sees otherwise: two Latin letters of the phonetic alphabet, and the small palochka.
MORE_SHAPES = {"ɑ": "a", "ɡ": "g", "ӏ": "l"}
#: Hyphens that look like the common one, breaking or not.
HYPHENS = "‐‑"
#: Apostrophes, straight, curly and of other blocks.
APOSTROPHES = "'‘’‛ʼʹʻʽ′＇`´"
#: Log-score for each change of script inside a token.
SWITCH = -12.0
#: Tokens kept in a worker's cache; beyond it the cache starts anew.
CACHE = 200_000


def _script(ch: str) -> str:
    """The script of a letter by its Unicode name; marks and apostrophes belong to any."""
    return unicodedata.name(ch, "?").split(" ", 1)[0] if ch.isalpha() else ""


_SHAPES: dict[str, str] = {}


def shapes(spark: SparkSession) -> dict[str, str]:
    """Each letter of a shape with the Latin letter of that shape, the Latin letters themselves among them: some three hundred."""
    if not _SHAPES:
        icu = spark.sparkContext._jvm.com.ibm.icu.text.SpoofChecker.Builder().build()
        skeletons = lambda letters: icu.getSkeleton("\n".join(letters)).split("\n")
        latin: dict[str, list[str]] = {}
        for ch, k in zip(string.ascii_letters, skeletons(string.ascii_letters)):
            latin.setdefault(k, []).append(ch)
        other = [ch for ch in map(chr, range(0x370, 0x20000)) if ch.isalpha() and _script(ch) not in ("LATIN", "CJK", "HANGUL", "?") and not unicodedata.decomposition(ch)]
        found = {ch: ch for ch in string.ascii_letters}
        for ch, k in zip(other, skeletons(other)):
            if own := latin.get(k):
                found[ch] = next((x for x in own if x.isupper() == ch.isupper()), own[0])
        _SHAPES.update(found | MORE_SHAPES)
    return _SHAPES


def _shown(ch: str) -> str:
    """What ``ch`` decomposes to without a visible difference; raised, lowered, circled and fraction forms stay."""
    if ch in APOSTROPHES:
        return "'"
    if ch in HYPHENS:
        return "-"
    kind = unicodedata.category(ch)
    if kind == "Zs":
        return " "
    if kind == "Cf" or ch in "͏ᅟᅠ឴឵ㅤﾠ" or 0xFE00 <= ord(ch) <= 0xFE0F or 0xE0100 <= ord(ch) <= 0xE01EF or 0x180B <= ord(ch) <= 0x180F:
        return ""
    d = unicodedata.decomposition(ch)
    if not d:
        return ch
    tag, parts = ("", d) if d[0] != "<" else d[1:].split("> ", 1)
    if tag in ("super", "sub", "fraction", "circle", "square", "vertical"):
        return ch
    out = "".join(_shown(chr(int(x, 16))) for x in parts.split())
    return ch if tag and out[:1] == " " else out


class _Shown(dict):
    def __missing__(self, code: int) -> str:
        self[code] = out = _shown(chr(code))
        return out


_SHOWN = _Shown()


def shown(text: str) -> str:
    """``text`` compatibility-normalised and decomposed, without the characters that show nothing."""
    if text.isascii():
        return text.replace("`", "'")
    return unicodedata.normalize("NFD", text.translate(_SHOWN))


#: A run of letters with their marks.
TOKEN = regex.compile(r"\p{L}[\p{L}\p{M}]*")


def _symbol(ch: str, shape: dict[str, str]) -> str:
    """A letter of a shape stands for itself, any other for its script, so the bigram table is bounded by the shapes."""
    return ch if ch in shape else _script(ch)[:12] or "'"


def _bigrams(token: str, shape: dict[str, str], to: Counter, times: int) -> None:
    scripts = {_script(ch) for ch in token if ch.isalpha()}
    if len(scripts) == 1:
        s = ["^", *(_symbol(ch, shape) for ch in token), "$"]
        for pair in zip(s, s[1:]):
            to[pair] += times


class Lattice:
    """Finds the best path; ``counts`` are the bigrams of script-pure tokens."""

    def __init__(self, counts: dict[tuple[str, str], int], shape: dict[str, str]):
        self.counts, self.left, self.cache, self.shape = counts, Counter(), {}, shape
        for (a, _), n in counts.items():
            self.left[a] += n
        self.size = 1 + len(self.left)
        self.scores: dict[tuple[str, str], float] = {}
        # the letters of a shape that some token is written with, the Latin one first
        self.cells: dict[str, list[tuple[str, str, str]]] = {}
        for ch, to in sorted(shape.items()):
            if ch == to or ch in self.left:
                self.cells.setdefault(to, []).append((ch, ch, _script(ch)))
        for to, own in self.cells.items():
            own.sort(key=lambda x: (x[0] != to, x[0]))

    def score(self, a: str, b: str) -> float:
        known = self.scores.get((a, b))
        if known is None:
            known = self.scores[a, b] = math.log((self.counts.get((a, b), 0) + 0.05) / (self.left[a] + 0.05 * self.size))
        return known

    def token(self, token: str) -> str:
        out = self.cache.get(token)
        if out is None:
            if len(self.cache) >= CACHE:
                self.cache.clear()
            key = "".join([self.shape.get(ch, ch) for ch in token])
            out = self.cache.get(key)
            self.cache[token] = self.cache[key] = out = self._best(key) if out is None else out
        return out

    def _best(self, key: str) -> str:
        best: list[tuple[float, str, str, str]] = [(0.0, "", "^", "")]  # score, path, last symbol, last script
        for ch in key:
            cells = []
            for x, sym, script in self.cells.get(ch) or [(ch, _symbol(ch, self.shape), _script(ch))]:
                top = max(
                    ((s + self.score(last, sym) + (SWITCH if script and was and script != was else 0.0), p, script or was) for s, p, last, was in best),
                    key=lambda c: c[0],
                )
                cells.append((top[0], top[1] + x, sym, top[2]))
            best = cells
        return max(((s + self.score(last, "$"), p) for s, p, last, _ in best), key=lambda c: c[0])[1]

    def text(self, text: str) -> str:
        out = TOKEN.sub(lambda m: self.token(m[0]), shown(text))
        return out if out.isascii() else unicodedata.normalize("NFC", out)


def bigram_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """Character bigrams of script-pure tokens over all rows: ``a STRING, b STRING, n LONG``; at most the square of the letters
    in ``shapes`` and of the scripts."""
    shape = shapes(df.sparkSession)

    def drain(tokens: Counter, total: Counter) -> None:
        for t, n in tokens.items():
            _bigrams(t, shape, total, n)
        tokens.clear()

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter = Counter()
        tokens: Counter = Counter()
        for batch in batches:
            for column in batch.columns:
                for text in column.to_pylist():
                    if text:
                        tokens.update(TOKEN.findall(shown(text)))
                    if len(tokens) > CACHE:
                        drain(tokens, total)
        drain(tokens, total)
        if total:
            a, b = zip(*total)
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), pa.array(list(total.values()), pa.int64())], ["a", "b", "n"])

    return df.select(*columns).mapInArrow(count, "a string, b string, n long").groupBy("a", "b").agg(F.sum("n").alias("n"))


def canonical_forms(df: DataFrame, columns: list[str]) -> DataFrame:
    """``df`` with ``<column>_canonical`` for each of ``columns``. Null stays null, an empty text empty; other columns pass through
    unchanged, whatever their names (a clashing ``_canonical`` column raises ValueError). An empty table gives an empty table."""
    clash = {f"{c}_canonical" for c in columns} & set(df.columns)
    if clash:
        raise ValueError(f"columns exist already: {sorted(clash)}")
    counts = {(r["a"], r["b"]): r["n"] for r in bigram_counts(df, columns).collect()}
    shape = shapes(df.sparkSession)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattice = Lattice(counts, shape)
        for batch in batches:
            at = [batch.schema.get_field_index(c) for c in columns]
            new = [pa.array([None if t is None else lattice.text(t) for t in batch.column(i).to_pylist()], pa.string()) for i in at]
            yield pa.RecordBatch.from_arrays([*batch.columns, *new], [*batch.schema.names, *(f"{c}_canonical" for c in columns)])

    return df.mapInArrow(run, T.StructType([*df.schema.fields, *(T.StructField(f"{c}_canonical", T.StringType()) for c in columns)]))


def _spellings(df: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """``k, champ, v, h, form``: each key's distinct values with the form they share with all that look the same, and its hash."""
    forms = canonical_forms(df.select(key, *columns), columns)
    cells = F.array(*(F.struct(F.lit(c).alias("champ"), F.col(c).alias("v"), F.col(f"{c}_canonical").alias("form")) for c in columns))
    long = forms.select(F.col(key).alias("k"), F.explode(cells).alias("x")).select("k", "x.champ", "x.v", F.xxhash64("x.form").alias("h"), F.col("x.form").alias("form"))
    return long.where("k is not null and v <> ''").distinct()


def look_alike_classes(df: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """One row per distinct key and value that looks like another one: ``<key>, champ, value, class BIGINT, spellings, members``.
    ``class`` is the hash of the form that all look-alikes share. No pair is made; a class of any size is counted before it meets
    its rows."""
    long = _spellings(df, key, columns)
    per = long.groupBy("champ", "h", "form", "v").agg(F.count("*").alias("n"))
    classes = per.groupBy("champ", "h", "form").agg(F.count("*").alias("spellings"), F.sum("n").alias("members")).where("spellings > 1")
    return long.join(classes, ["champ", "h", "form"]).select(F.col("k").alias(key), "champ", F.col("v").alias("value"), F.col("h").alias("class"), "spellings", "members")


def look_alike_pairs(df: DataFrame, key: str, columns: list[str], group: int = 2000) -> DataFrame:
    """Pairs of different keys whose values in one column look the same but are different strings:
    ``segment_a, segment_b, champ``. Null, empty and null-keyed values are no case; copies of one string make no pair.

    Classes of one spelling go before the join. Each class's rows meet in slices of ``group``, so no task holds a hot class.
    """
    long = _spellings(df, key, columns)
    per = long.groupBy("champ", "h", "form", "v").agg(F.count("*").alias("n"))
    classes = per.groupBy("champ", "h", "form").agg(F.count("*").alias("spellings"), F.sum("n").alias("n")).where("spellings > 1")
    rows = long.join(classes.select("champ", "h", "form", F.ceil(F.col("n") / group).cast("int").alias("slices")), ["champ", "h", "form"])
    left = rows.select("champ", "h", "form", F.col("k").alias("segment_a"), F.col("v").alias("va"), F.pmod(F.xxhash64("k", "v"), F.col("slices")).cast("int").alias("slice"))
    right = rows.select("champ", "h", "form", F.col("k").alias("segment_b"), F.col("v").alias("vb"), F.explode(F.sequence(F.lit(0), F.col("slices") - 1)).alias("slice"))
    return left.join(right, ["champ", "h", "form", "slice"]).where("segment_a < segment_b and va <> vb").select("segment_a", "segment_b", "champ").distinct()

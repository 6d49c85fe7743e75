"""Text columns: normalisation, tokens, alphabet, fingerprints and small scalars. All expressions in the JVM but those marked Arrow."""

from __future__ import annotations

import zlib
from collections.abc import Callable
from hashlib import blake2b

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: All white space that Python's ``\\s`` matches, for Java's and RE2's regular expressions alike.
SPACE = r"[\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
#: The same characters, to be trimmed.
SPACES = "".join(map(chr, (*range(9, 14), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)))
#: Characters replaced one for one by ``normalize_surface``.
SURFACE_FROM, SURFACE_TO = "‘’‛“”–—−   ", "'''\"\"---   "
#: Token: a word with its apostrophes and hyphens, or one other visible character.
TOKEN = r"([\p{L}\p{N}_'’\-]+|[^\p{L}\p{N}_\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}])"
#: Graphemes outside the alphabet and what replaces them, in this order.
ALPHABET_FIXES = (
    ("ç", "s"), ("[êë]", "è"), (r"[âà](?=[\p{L}\p{N}_])", "a"), ("[îï]", "i"), ("[ôö]", "ò"), ("[ûü]", "u"), ("qu", "k"), ("ph", "f"),
    ("[cC]([khKH])", "$1"), ("c(?=[eiéè])", "s"), ("c(?=[aouò])", "k"), ("q(?!u)", "k"), ("x", "ks"),
)
#: Letters outside the alphabet.
OUTSIDE = "cquxêâîôûëïüç"


def _icu(method: str, c: Column) -> Column:
    """A static normaliser of the ICU library that Spark ships, called in the JVM. Spark takes it for non-deterministic, so it must
    not stand inside an aggregate's arguments: select it first."""
    return F.when(c.isNotNull(), F.reflect(F.lit("com.ibm.icu.text.Normalizer"), F.lit(method), F.coalesce(c, F.lit("")), F.lit(False)))


def nfc(c: Column) -> Column:
    """Canonical composition."""
    return _icu("compose", c)


def strip_accents(c: Column) -> Column:
    """Drop combining marks."""
    return nfc(F.regexp_replace(_icu("decompose", c), r"\p{M}", ""))


@F.pandas_udf(T.DoubleType())
def compression_ratio(s: pd.Series) -> pd.Series:
    """UTF-8 bytes per deflated byte; 0 for null and empty texts (Arrow)."""
    return s.map(lambda t: len(b := t.encode()) / max(1, len(zlib.compress(b))) if t else 0.0)


@F.pandas_udf(T.StringType())
def blake2b_hex(s: pd.Series) -> pd.Series:
    """96-bit BLAKE2b as hex (Arrow: Spark has none)."""
    return s.map(lambda t: blake2b(t.encode(), digest_size=12).hexdigest(), na_action="ignore")


def bind(c: Column, f: Callable[[Column], Column]) -> Column:
    """``f(c)`` with ``c`` computed once, however often ``f`` uses it."""
    return F.get(F.transform(F.array(c), f), 0)


def squeeze(c: Column) -> Column:
    """White space runs become one space; none at the ends."""
    return F.trim(F.regexp_replace(c, SPACE + "+", " "))


def strip(c: Column) -> Column:
    """No white space at the ends."""
    return F.btrim(c, F.lit(SPACES))


def normalize_surface(c: Column, lower: bool = False, compose: bool = True) -> Column:
    """Neutral cleaning: composed letters, plain quotes, dashes and spaces, no repeated or detached punctuation. Null gives the
    empty text. One pass, which is not idempotent. ``compose=False`` skips the composition for text known to be composed."""
    t = F.coalesce(c, F.lit(""))
    t = F.replace(F.translate(nfc(t) if compose else t, SURFACE_FROM, SURFACE_TO), F.lit("…"), F.lit("..."))
    t = F.regexp_replace(t, r"([,.;:!?])\1+", "$1")
    t = squeeze(F.regexp_replace(t, SPACE + r"+([,.;:!?%])", "$1"))
    return F.lower(t) if lower else t


def tokens(normal: Column) -> Column:
    """Tokens of a normalised text."""
    return F.regexp_extract_all(normal, F.lit(TOKEN), 1)


def tokenize(c: Column, compose: bool = True) -> Column:
    return tokens(normalize_surface(c, compose=compose))


def detokenize(c: Column) -> Column:
    return normalize_surface(F.array_join(c, " "))


def enforce_alphabet(c: Column, strict: bool = False) -> Column:
    """Replace graphemes outside the alphabet. ``strict`` raises where letters outside it remain."""
    out = c
    for pattern, into in ALPHABET_FIXES:
        out = F.regexp_replace(out, pattern, into)
    if strict:
        out = F.when(F.size(violations(out)) > 0, F.raise_error(F.concat(F.lit("letters outside the alphabet: "), out)).cast("string")).otherwise(out)
    return out


def violations(c: Column) -> Column:
    """Sorted distinct letters outside the alphabet."""
    return F.array_sort(F.array_distinct(F.regexp_extract_all(F.lower(c), F.lit(f"([{OUTSIDE}])"), 1)))


def fix_spacing(c: Column) -> Column:
    """No space before punctuation or around apostrophes."""
    return F.regexp_replace(F.regexp_replace(c, SPACE + r"+([,.;:!?…])", "$1"), SPACE + "*'" + SPACE + "*", "'")


def match_case(model: Column, word: Column) -> Column:
    """``word`` in the case of ``model``: all capitals, first capital, or as it is."""
    has = model != F.lower(model)
    first = F.substring(model, 1, 1)
    return F.when(has & (model == F.upper(model)) & (F.length(model) > 1), F.upper(word)).when((first == F.upper(first)) & (first != F.lower(first)), F.concat(F.upper(F.substring(word, 1, 1)), F.substring(word, 2, 1 << 30))).otherwise(word)


def casing_pattern(model: Column, word: Column) -> Column:
    """All capitals (two letters or more), capitalised, else character by character as in ``model``."""
    letters = F.regexp_replace(model, r"[^\p{L}]", "")
    chars = F.zip_with(F.split(word, ""), F.split(model, ""), lambda w, m: F.when(m.isNotNull() & (m == F.upper(m)) & (m != F.lower(m)), F.upper(w)).otherwise(w))
    rest = F.substring(model, 2, 1 << 30)
    return (
        F.when((F.length(letters) >= 2) & (letters == F.upper(letters)), F.upper(word))
        .when(F.rlike(F.substring(model, 1, 1), F.lit(r"\p{Lu}")) & (rest == F.lower(rest)), F.concat(F.upper(F.substring(word, 1, 1)), F.lower(F.substring(word, 2, 1 << 30))))
        .otherwise(F.array_join(F.filter(chars, lambda x: x.isNotNull()), ""))
    )


def sentences(c: Column) -> Column:
    """Split behind sentence ends; blank parts go."""
    parts = F.split(strip(F.coalesce(c, F.lit(""))), r"(?<=[.!?…])" + SPACE + "+")
    return F.filter(parts, lambda p: strip(p) != "")


def canonical(c: Column) -> Column:
    """Lower case without accents and punctuation, squeezed: equal for variants of one sentence."""
    return squeeze(F.regexp_replace(strip_accents(F.lower(c)), r"[^\p{L}\p{N}_\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]", ""))


def fingerprint(c: Column, native: bool = True) -> Column:
    """Content fingerprint of ``canonical``: MD5, or BLAKE2b where the exact digest is wanted."""
    return F.md5(canonical(c).cast("binary")) if native else blake2b_hex(canonical(c))


def hash_fraction(hex_digest: Column) -> Column:
    """The first 32 bits of a hex digest as a fraction of their maximum."""
    return F.conv(F.substring(hex_digest, 1, 8), 16, 10).cast("double") / 4294967295.0


def split_of(fp: Column, train: float = 0.8, val: float = 0.1) -> Column:
    """The split a fingerprint falls into."""
    u = hash_fraction(fp)
    return F.when(u < train, "train").when(u < train + val, "val").otherwise("test")


def plain_text(c: Column) -> Column:
    """Lower case, punctuation as spaces, accents kept: for comparing annotations."""
    return squeeze(F.regexp_replace(F.lower(F.coalesce(c, F.lit(""))), r"\p{P}", " "))


def word_ngrams(words: Column, most: int) -> Column:
    """All lower-cased n-grams of 1 to ``most`` words."""
    empty = F.array().cast("array<string>")

    def every(low: Column) -> Column:
        one = lambda n: F.when(F.size(low) >= n, F.transform(F.sequence(F.lit(1), F.greatest(F.size(low) - (n - 1), F.lit(1))), lambda i: F.array_join(F.slice(low, i, n), " "))).otherwise(empty)
        return F.flatten(F.array(*(one(n) for n in range(1, most + 1))))

    return bind(F.transform(words, F.lower), every)


def duration_ms(path: Column) -> Column:
    """End less start of ``..._segment_<start>_<end>.mp3``; 0 for other names."""
    p = r"_segment_(\d+)_(\d+)\.mp3$"
    at = lambda g: F.regexp_extract(path, p, g).try_cast("long")
    return F.coalesce(at(2) - at(1), F.lit(0))


def local_name(path: Column) -> Column:
    return F.replace(path, F.lit("/"), F.lit("__"))


def clean_name(c: Column) -> Column:
    """Letters, digits, ``-`` and ``_``, at most 40; ``anonyme`` if nothing is left."""
    return F.coalesce(F.nullif(F.substring(F.regexp_replace(F.coalesce(c, F.lit("")), r"[^\p{L}\p{N}_\-]", ""), 1, 40), F.lit("")), F.lit("anonyme"))


def relative_key(path: Column, root: str) -> Column:
    root = root.rstrip("/") + "/"
    return F.when(F.startswith(path, F.lit(root)), F.substring(path, len(root) + 1, 1 << 30)).otherwise(path)


def iso_time(ms: Column) -> Column:
    """Epoch milliseconds as ISO 8601 UTC, whatever the session's time zone; empty for null and 0."""
    day = 86_400_000
    start = F.timestamp_add("DAY", F.floor(ms / day).cast("int"), F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"))
    t = F.timestamp_add("SECOND", F.floor(F.pmod(ms, F.lit(day)) / 1000).cast("int"), start).cast("string")
    part = F.when(F.pmod(ms, F.lit(1000)) == 0, "").otherwise(F.concat(F.lit("."), F.lpad(F.pmod(ms, F.lit(1000)).cast("string"), 3, "0"), F.lit("000")))
    return F.when(ms.isNull() | (ms == 0), "").otherwise(F.concat(F.replace(t, F.lit(" "), F.lit("T")), part, F.lit("+00:00")))


def percent(c: Column) -> Column:
    return F.format_string("%.1f %%", c * 100)


def duration_label(seconds: Column) -> Column:
    """``2h05m`` from an hour on, else ``5m09s``; whole seconds."""
    s = F.floor(seconds).cast("long")
    return F.when(s >= 3600, F.format_string("%dh%02dm", F.floor(s / 3600), F.floor(s / 60) % 60)).otherwise(F.format_string("%dm%02ds", F.floor(s / 60), s % 60))


#: Accented letters of the suggestion engine and their plain forms.
FOLD_FROM, FOLD_TO = "àáâãäåèéêëìíîïòóôõöùúûüýÿçñœ", "aaaaaaeeeeiiiiooooouuuuyycno"


def fold(c: Column) -> Column:
    """Lower case with accents folded, for dictionary look-up."""
    return F.replace(F.translate(F.lower(c), FOLD_FROM, FOLD_TO), F.lit("ß"), F.lit("ss"))

"""Plain words: maximal runs of letters and digits, with case, accents, punctuation, spacing and invisible characters ignored."""

from __future__ import annotations

import re
import unicodedata

WORD = re.compile(r"[^\W_]+")
TAG = re.compile(r"<[^<>]{0,200}>")
TIME = re.compile(r"(?<!\d)\d{1,3}:\d{2}(?::\d{2})?(?:[.,]\d{1,3})?(?!\d)")


class _Ignorable(dict):
    """Whether a character is a combining mark or shows nothing."""

    def __missing__(self, ch: str) -> bool:
        self[ch] = out = unicodedata.category(ch) in ("Mn", "Me", "Cf")
        return out


IGNORABLE = _Ignorable()


def _folded(text: str) -> str:
    """``text`` without case, marks and invisible characters."""
    text = text.casefold()
    if text.isascii():
        return text
    text = unicodedata.normalize("NFKD", text)
    odd = [ch for ch in set(text) if ch > "\x7f"]
    for ch in [ch for ch in odd if not IGNORABLE[ch] and not ch.isalnum()]:
        text = text.replace(ch, " ")
        odd.remove(ch)
    if all(map(IGNORABLE.__getitem__, odd)):
        return text.encode("ascii", "ignore").decode()
    return text.translate({ord(ch): None for ch in odd if IGNORABLE[ch]})


def _byte(c: int) -> int:
    """The plain form of a Latin-1 character: a letter or digit, 32 for a separator, 0 where it is none of a single byte."""
    x = _folded(chr(c))
    return 32 if not any(map(str.isalnum, x)) else ord(x) if len(x) == 1 and x.isascii() else 0


#: For Latin-1 texts, each byte's plain form, the bytes that show nothing, and those that need the general way.
_PLAIN = bytes(_byte(c) or 32 for c in range(256))
_NOTHING = bytes(c for c in range(256) if IGNORABLE[chr(c)])
_GENERAL = bytes(c for c in range(256) if not _byte(c))


#: Stands between parts of a text that are normalised together.
BREAK = "\x01"
_PLAIN_PARTS = _PLAIN[:1] + BREAK.encode() + _PLAIN[2:]


def _without_markup(text: str) -> str:
    if "<" not in text and ":" not in text:
        return text
    if not text.isascii() and any(IGNORABLE[ch] for ch in set(text)):
        text = "".join(ch for ch in text if not IGNORABLE[ch])
    return TIME.sub(" ", TAG.sub(" ", text))


def _plain_bytes(text: str, table: bytes) -> bytes | None:
    """The text with separators as spaces, or None if words are left that are not ASCII."""
    try:
        raw = text.encode("latin-1")
        if len(raw.translate(None, _GENERAL)) == len(raw):
            return raw.translate(table, _NOTHING)
    except UnicodeEncodeError:
        pass
    text = _folded(text)
    return text.encode().translate(table) if text.isascii() else None


def plain_words(text: str | None, markup: bool = False) -> list[bytes]:
    """The plain words of ``text`` as UTF-8 bytes; with ``markup``, tags and time marks do not count. Null gives no words."""
    if not text:
        return []
    if markup:
        text = _without_markup(text)
    raw = _plain_bytes(text, _PLAIN)
    return [w.encode() for w in WORD.findall(_folded(text))] if raw is None else raw.split()


#: A mark that ends a sentence, before a space or something in brackets.
END = re.compile(r"[.!?…](?=[\s\[<])")


def plain_sentences(text: str | None) -> list[list[bytes]]:
    """``plain_words`` with ``markup`` of each sentence of ``text``; lines and paragraphs end sentences too. Those without words go."""
    if not text:
        return []
    text = text.replace(BREAK, " ").replace("\n", BREAK).replace("</p>", BREAK)
    text = _without_markup(END.sub(BREAK, text))
    raw = _plain_bytes(text, _PLAIN_PARTS)
    if raw is None:
        parts = ([w.encode() for w in WORD.findall(t)] for t in _folded(text).split(BREAK))
    else:
        parts = (t.split() for t in raw.split(b"\x01"))
    return [p for p in parts if p]

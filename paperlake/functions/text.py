"""Normalising full text, and measuring it."""

from __future__ import annotations

import ctypes
import unicodedata
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Letters that print as ligatures, and what they stand for, in the order of replacement.
LIGATURES = {
    "Ꜳ": "AA", "ꜳ": "aa", "Æ": "AE", "æ": "ae", "Ꜵ": "AO", "ꜵ": "ao", "Ꜷ": "AU", "ꜷ": "au", "Ꜹ": "AV", "ꜹ": "av",
    "Ꜻ": "AV", "ꜻ": "av", "Ꜽ": "AY", "ꜽ": "ay", "ﬀ": "ff", "ﬃ": "ffi", "ﬄ": "ffl", "ﬁ": "fi", "ﬂ": "fl", "Œ": "OE",
    "œ": "oe", "Ꝏ": "OO", "ꝏ": "oo", "ﬆ": "st", "ﬅ": "st", "Ꜩ": "TZ", "ꜩ": "tz", "ᵫ": "ue", "Ꝡ": "VY", "ꝡ": "vy",
    "ȸ": "db", "ʣ": "dz", "ʥ": "dʑ", "ʤ": "dʒ", "ʩ": "fŋ", "Ĳ": "IJ", "ĳ": "ij", "ʪ": "ls", "ʫ": "lz", "ɮ": "lʒ",
    "ȹ": "qp", "ʨ": "tɕ", "ʦ": "ts", "ʧ": "tʃ", "ꭐ": "ui", "ꭑ": "ui",
}
# Single characters that have a plain form.
PLAIN = {"\xa0": " ", "\u2018": "'", "\u2019": "'", "\u201c": '"', "\u201d": '"', "\xad": "-", "\u2014": "-", "\xb7": "*"}
#: Letters of one to one and of one to many; the former go in one pass.
MANY = {k: v for k, v in LIGATURES.items() if len(v) > 1}
#: Runs that bad extraction leaves.
JUNK = r"(\(cid:\d+\)|lllll|\.\.\.\.\.|\*\*\*\*\*)"
SPACES = r"(?U)\s+"


def fix_rules(text: Column) -> Column:
    """Ligatures, sharp s inside words, and typographic signs, with built-in functions. Texts that hold none of these
    letters pass one pattern and no more; replacement is literal, one letter after the other."""
    some = F.rlike(text, F.lit("[" + "".join(LIGATURES) + "".join(PLAIN) + "ß]"))
    out = text
    for letter, spelled in MANY.items():
        out = F.replace(out, F.lit(letter), F.lit(spelled))
    out = F.regexp_replace(out, r"(?U)\Bß", "ss")
    return F.when(some, F.translate(out, "".join(PLAIN), "".join(PLAIN.values()))).otherwise(text)


@F.arrow_udf(T.StringType())
def compose(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
    """Compatibility composition (NFKC), which Spark has no function for. Of a batch, which may be 10,000 long texts, only
    some are Python's strings at a time: these take up to four bytes a character. What a batch has used is given back."""
    release = getattr(ctypes.CDLL(None), "malloc_trim", None)  # not in every C library
    for t in texts:
        some = (t.slice(at, 100).to_pylist() for at in range(0, len(t), 100))
        parts = [pa.array([None if x is None else unicodedata.normalize("NFKC", x) for x in p], pa.string()) for p in some]
        t = pa.concat_arrays(parts) if parts else pa.array([], pa.string())
        del parts
        yield t
        del t
        pa.default_memory_pool().release_unused()
        if release:
            release(0)


def fix_unicode(text: Column) -> Column:
    """fix_rules, then NFKC; plain ASCII skips both. Spark sends whole batches to Python whatever a condition around the
    call says, so plain texts go there as nulls."""
    some = F.rlike(text, F.lit(r"[^\x00-\x7f]"))
    return F.when(some, compose(F.when(some, fix_rules(text)))).otherwise(text)


def words(text: Column) -> Column:
    return F.size(F.filter(F.split(text, SPACES), lambda w: w != ""))


def average_word_length(text: Column) -> Column:
    return F.length(text) / (words(text) + 1)


def passes_gate(text: Column, most: float = 45.0) -> Column:
    """Whether extracted text reads like words; an empty text passes."""
    return average_word_length(text) <= most


def without_junk(text: Column) -> Column:
    return F.regexp_replace(text, JUNK, "")


# Fixed value: the banner that runs along a first page, without its white space: identifier, class in brackets, date.
STAMP = r"arXiv:(?:\d{4}\.\d{4,5}|\d{7})(?:[vV]\d+)?\[[a-zA-Z.\-]+\]\d+[a-zA-Z.\-]+\d{2,4}"


def remove_stamp(text: Column, within: int = 1000) -> Column:
    """Removes the banner from the first characters, as it stands or else back to front. What is left of these
    characters is trimmed on both sides of the cut and joined by a space, so a text that began with the banner begins
    with a space.

    White space may stand anywhere in a banner. So it is looked for in the characters without white space, and where it
    begins and ends there, in characters, is counted off again in the text. Only a year whose first two digits stand
    together ends where they do, or digits that follow the banner would be taken for its own.
    """
    head, tail = F.substring(text, 1, within), F.substr(text, F.lit(within + 1))
    squeeze = lambda s: F.regexp_replace(s, SPACES, "")
    strip = lambda s: F.regexp_replace(s, r"(?U)^\s+|\s+$", "")
    first = lambda s, n: F.coalesce(F.regexp_substr(s, F.concat(F.lit(r"(?U)^(?:\s*\S){"), n.cast("string"), F.lit("}"))), F.lit(""))

    def cut(s: Column) -> Column:
        start = F.regexp_instr(squeeze(s), F.lit(STAMP)) - 1
        end = start + F.length(F.regexp_extract(squeeze(s), STAMP, 0))
        upto = F.regexp_replace(first(s, end), r"(?U)([^0-9\s]\s*[0-9]{2,3})\s[0-9\s]*$", "$1")
        return F.concat(strip(first(s, start)), F.lit(" "), strip(F.substr(s, F.length(upto) + 1)))

    back = F.reverse(head)
    has = lambda s: F.rlike(squeeze(s), F.lit(STAMP))
    return F.when(has(head), F.concat(cut(head), tail)).when(has(back), F.concat(F.reverse(cut(back)), tail)).otherwise(text)


def numeric_order(path: Column) -> list[Column]:
    """Sort keys of file names: their numbers without leading zeros, as strings, then the name."""
    return [F.transform(F.regexp_extract_all(path, F.lit(r"\d+"), F.lit(0)), lambda d: F.regexp_replace(d, r"^0+(?=\d)", "")), path]

"""Free-form author lines to names and affiliations."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .tex import decode

# Particles that belong to a surname, suffixes, and words that name a group.
PARTICLES = set("van der de la von del della da mac ter dem di vaziri".split())
SUFFIXES = set("i ii iii iv v sr jr sr. jr.".split())
GROUP = re.compile(r"([a-z0-9\s]+\s+(?:collaboration|group|team))", re.I)


@dataclass
class Author:
    keyname: str
    firstnames: str = ""
    suffix: str = ""
    affiliations: list[str] = field(default_factory=list)


class Scanner:
    """Reads an author line once, character by character, into parts: names, the marks ',' and ':', and notes (outermost
    parentheses with all in them; one that never closes runs to the end). White space counts as one space, 'and' and '&'
    between spaces as a comma, and a junior after a comma belongs to the name before it."""

    def __init__(self, line: str):
        self.parts: list[tuple[str, str]] = []
        self.words: list[str] = []
        word, spaced, depth, opened = "", False, 0, 0
        for i, c in enumerate(line):
            if depth:
                depth += (c == "(") - (c == ")")
                if not depth:
                    self.parts.append(("note", line[opened : i + 1]))
            elif c in "(,:" or c.isspace():
                if c.isspace() and spaced and word in ("and", "&"):
                    self.name()
                    if (self.parts or [None])[-1] != ("mark", ","):
                        self.parts.append(("mark", ","))
                elif word:
                    self.words.append(word)
                word, spaced = "", c.isspace()
                if not spaced:
                    self.name()
                    if c == "(":
                        depth, opened = 1, i
                    elif ("mark", c) != (self.parts or [None])[-1] or c != ",":
                        self.parts.append(("mark", c))
            else:
                word += c
        if word:
            self.words.append(word)
        self.name()
        if depth:
            self.parts.append(("note", line[opened:]))

    def name(self) -> None:
        """Ends the name whose words were read last, if any."""
        text, self.words = " ".join(self.words), []
        if text in ("Jr", "Jr.") and len(self.parts) > 1 and self.parts[-1] == ("mark", ",") and self.parts[-2][0] == "name":
            self.parts.pop()
            self.parts[-1] = ("name", f"{self.parts[-1][1]}, {text}")
        elif text:
            self.parts.append(("name", text))


def split_line(line: str | None) -> list[str]:
    """Names, marks and notes of an author line, in order (see Scanner)."""
    return [" ".join(text.split()) for _, text in Scanner(line).parts] if line else []


def spread(name: str) -> str:
    """A space after every dot that stands before a letter or sign, unless a backslash makes it an accent."""
    out = ""
    for before, c in zip(" " + name, name, strict=False):
        accent = len(out) > 1 and out[-2] == "\\"
        out += " " + c if before == "." and c != " " and not accent else c
    return out


def person(name: str) -> Author:
    """The last word is the surname, with one or two particles before it if a first name is left; a suffix stands last."""
    words = name.split()
    if len(words) < 2:
        return Author(name)
    if len(words) > 2 and words[-1].lower() in SUFFIXES:
        return Author(words[-2], " ".join(words[:-2]), words[-1])
    particles = 0
    while particles < min(2, len(words) - 2) and words[-2 - particles].lower() in PARTICLES:
        particles += 1
    return Author(" ".join(words[-1 - particles :]), " ".join(words[: -1 - particles]))


def listed(note: str) -> dict[str, str]:
    """Affiliations by number, of a note that lists them: ((1) one; (2) another)."""
    if not re.match(r"\(\s*\(", note):
        return {}
    inside = note.rstrip()[1:]
    inside = inside[:-1] if inside.endswith(")") else inside
    found = ((n, rest.strip()) for n, rest in re.findall(r"\((\d+)\)([^(]*)", inside))
    return {n: rest.rstrip("., \t\r\n") for n, rest in found if len(rest) > 1}


def parse(line: str | None, propagate: bool = True) -> list[Author]:
    """Authors of a line. The note right after a name has its affiliation, or numbers of a list that stands in a note of
    its own (numbers that aren't listed are lost). With propagate, authors without affiliation get those of the next one
    that has any; groups at the line's start are authors of their own and get none that way."""
    parts = Scanner(line).parts if line else []
    numbers = {n: a for kind, text in parts if kind == "note" for n, a in listed(text).items()}
    out: list[Author] = []
    waiting: list[Author] = []
    people = False
    for (kind, text), (next_kind, note) in zip(parts, [*parts[1:], ("", "")], strict=False):
        if kind != "name" or re.match(r"et\b\.?\s+al\b", text, re.I):
            continue
        group = None if people else GROUP.search(text)
        if group:
            out.append(Author(group[1]))
            continue
        people = True
        author = person(spread(text))
        said = re.match(r"[^()]*", note[1:])[0].strip() if next_kind == "note" else ""
        if said and not re.sub(r"[\d,\s]", "", said):
            author.affiliations = [numbers[n] for n in said.split(",") if n in numbers]
        elif said:
            author.affiliations = [said]
        out.append(author)
        waiting.append(author)
        if author.affiliations:
            if propagate:
                for a in waiting:
                    a.affiliations = list(author.affiliations)
            waiting = []
    return out


SCHEMA = T.StructType(
    [
        T.StructField("authors", T.ArrayType(T.StructType([T.StructField("keyname", T.StringType()), T.StructField("firstnames", T.StringType()), T.StructField("suffix", T.StringType()), T.StructField("affiliations", T.ArrayType(T.StringType()))]))),
        T.StructField("error", T.StringType()),
    ]
)


@F.pandas_udf(SCHEMA)
def parse_authors(lines: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    """Column form, with TeX decoded: authors, or null and an error. Parentheses nest, which no regular expression
    follows, so this is one Arrow pass. Null and empty lines have no authors."""
    for s in lines:
        rows, errors = [], []
        for line in s:
            try:
                rows.append([{"keyname": decode(a.keyname), "firstnames": decode(a.firstnames), "suffix": decode(a.suffix), "affiliations": [decode(x) for x in a.affiliations]} for a in parse(line)])
                errors.append(None)
            except Exception as e:  # a bad line must not cost the partition; it is kept with its error
                rows.append(None)
                errors.append(f"{type(e).__name__}: {e}")
        yield pd.DataFrame({"authors": rows, "error": errors})


def without_repeats(tokens: Column, mark: str = ",") -> Column:
    """An array of tokens in which no `mark` follows another."""
    return F.filter(tokens, lambda t, i: (i == 0) | (t != mark) | (F.get(tokens, i - 1) != mark))


def author_line(authors: Column) -> Column:
    """`keyname, firstnames; keyname, firstnames` of parsed authors."""
    return F.array_join(F.transform(authors, lambda a: F.array_join(F.filter(F.array(a["keyname"], a["firstnames"]), lambda x: x != ""), ", ")), "; ")

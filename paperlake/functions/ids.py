"""Article identifiers: the patterns that find them in prose, and Column functions that canonicalise them."""

from __future__ import annotations

import os
import re
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Archive names of old-style identifiers, and subject classes that may follow them.
ARCHIVES = (
    "acc-phys adap-org alg-geom ao-sci astro-ph atom-ph bayes-an chao-dyn chem-ph cmp-lg comp-gas cond-mat cs dg-ga "
    "eess econ funct-an gr-qc hep-ex hep-lat hep-ph hep-th math math-ph mtrl-th nlin nucl-ex nucl-th patt-sol physics "
    "plasm-ph q-alg q-bio q-fin quant-ph solv-int stat supr-con"
).split()
CLASSES = (
    "acc-ph ao-ph app-ph atm-clus atom-ph bio-ph chem-ph class-ph comp-ph data-an dis-nn ed-ph flu-dyn gen-ph geo-ph "
    "hist-ph ins-det med-ph mes-hall mtrl-sci optics other plasm-ph pop-ph quant-gas soc-ph soft space-ph stat-mech "
    "str-el supr-con"
).split()

#: Spellings without the hyphen, and what they stand for.
HYPHENS = {name.replace("-", ""): name for name in ARCHIVES + CLASSES if "-" in name}


def _any(names: list[str]) -> str:
    """Alternation of names with and without their hyphens, longest first so that its order is always the same."""
    return "|".join(sorted({*names, *(n.replace("-", "") for n in names)}, key=lambda n: (-len(n), n)))


def patterns(last_year: int = 19) -> dict[str, str]:
    """The patterns by name, in the syntax that Java, RE2 and Python share. Identifiers may be dated 1991 to 20yy, yy
    being last_year (19 unless changed: later ones are then not found)."""
    # The grammar of identifiers in prose and the order of its alternatives, which decide what is found
    tens, ones = divmod(last_year, 10)
    year = "|".join(filter(None, [f"[0-{tens - 1}][0-9]" if tens else "", f"{tens}[0-{ones}]", "9[1-9]"]))
    stamp = rf"(?:{year})(?:0[1-9]|1[0-2])"
    version = r"(?:[vV][1-9]\d*)?"
    archive = rf"(?:{_any(ARCHIVES)})(?:[.][A-Z]{{2}}|(?:{_any(CLASSES)}))?"
    new, old = rf"{stamp}[.]\d{{4,5}}{version}", rf"{archive}/{stamp}\d{{3}}{version}"
    either = f"(?:{old}|{new})"
    url = r"(?i:https?\:\/\/)?(?i:arxiv\.org/)?(?i:abs/|pdf/)"
    named = r"(?i:arxiv\s*[:/\s,.]*\s*)"
    eprint = r"(?i:e-?prints?.{1,3})"
    hinted = rf"(?:{url})?(?:{eprint})?(?:{named}?({old})|{named}(?:{archive}/)?({new}))"
    far = rf"(?:{url}|{eprint}|(?i:{archive})|{named}).*?({either})"
    return {"simple": f"({either})", "strict": f"{named}(?:({old})|({new}))", "flexible": rf"({either})|{hinted}|{far}|[\[\(]\s*({either})\s*[\]\)]"}


PATTERNS = patterns()
#: Java: dots stop at line feeds only, and classes are Unicode's, as in Python.
JAVA = "(?dU)"


def _tree(names: list[str]) -> str:
    """What _any(names) matches, and in the same order of preference, as a tree of shared beginnings. A matcher that goes
    through alternatives one by one so tries a few of them at a place and not all."""

    def of(words: list[str]) -> str:
        branches = []
        for first in dict.fromkeys(w[:1] for w in words if w):
            begin = os.path.commonprefix(some := [w for w in words if w[:1] == first])
            branches.append(re.escape(begin) + of([w[len(begin) :] for w in some]))
        inner = branches[0] if len(branches) == 1 else f"(?:{'|'.join(branches)})" if branches else ""
        # longer names first: one that ends here is what is left when none goes on
        return f"(?:{inner})?" if inner and "" in words else inner

    return of(sorted({*names, *(n.replace("-", "") for n in names)}))


def java(pattern: str) -> str:
    """A pattern as Spark is to run it: the same matches and groups."""
    return JAVA + pattern.replace(_any(ARCHIVES), f"(?=[a-zA-Z]){_tree(ARCHIVES)}").replace(_any(CLASSES), _tree(CLASSES))


def found(text: Column, pattern: str) -> Column:
    """All identifiers in a text, in order. The long pattern runs over the text once, and once over each of the short
    matches to read the groups off it, of which one holds the identifier: these are the same there, because the pattern
    looks at nothing around a match."""
    groups = re.compile(pattern).groups
    whole = F.regexp_extract_all(text, F.lit(java(pattern)), F.lit(0))
    if pattern == PATTERNS["simple"]:  # its group is the match
        return whole
    return F.filter(F.transform(whole, lambda m: F.regexp_replace(m, java(pattern), "".join(f"${g}" for g in range(1, groups + 1)))), lambda x: x != "")


def references(text: Column, pattern: str = PATTERNS["flexible"]) -> Column:
    """Distinct canonical identifiers in a text, sorted. The pattern runs only over lines that hold a plain identifier,
    up to the last one, so a hint after which no identifier follows never makes it search the rest of a line. Each step of
    clean() is a pass of its own, since a step names what it is given several times and would work it out again."""
    upto = F.transform(F.split(text, "\n"), lambda line: F.regexp_extract(line, java("^.*" + PATTERNS["simple"]), 0))
    some = F.flatten(F.transform(F.filter(upto, lambda line: line != ""), lambda line: found(line, pattern)))
    return F.array_sort(F.array_distinct(reduce(F.transform, CLEAN, some)))


def strip_version(name: Column) -> Column:
    return F.get(F.split(name, r"(?U)[vV][1-9]\d*", 2), F.lit(0))


def format_archive(name: Column) -> Column:
    """Old style: the archive without its subject class, and with its hyphen."""
    archive = F.split_part(F.split_part(name, F.lit("/"), F.lit(1)), F.lit("."), F.lit(1))
    table = F.create_map(*[F.lit(x) for pair in sorted(HYPHENS.items()) for x in pair])
    return F.when(F.contains(name, F.lit("/")), F.concat(F.coalesce(F.try_element_at(table, archive), archive), F.lit("/"), F.split_part(name, F.lit("/"), F.lit(2)))).otherwise(name)


def pad_number(name: Column) -> Column:
    """New style: numbers of four digits get a zero if their year and month, read as a number, is over 1500."""
    month, number = F.split_part(name, F.lit("."), F.lit(1)), F.split_part(name, F.lit("."), F.lit(2))
    short = ~F.contains(name, F.lit("/")) & (month.try_cast("int") > 1500) & (F.length(number) < 5)
    return F.when(short, F.concat(month, F.lit(".0"), number)).otherwise(name)


#: The steps to an identifier's canonical form.
CLEAN = (strip_version, format_archive, pad_number)


def clean(name: Column) -> Column:
    return reduce(lambda c, f: f(c), CLEAN, name)


def clean_node(name: Column) -> Column:
    """For the citation graph: no padding."""
    return strip_version(format_archive(name))


def clean_variant(name: Column) -> Column:
    """A spelling of clean() in use that takes everything from the first 'v' on for the version, so that archives with a
    'v' in their name lose what follows it."""
    return reduce(lambda c, f: f(c), (lambda c: F.split_part(c, F.lit("v"), F.lit(1)), format_archive, pad_number), name)


def path_to_id(path: Column) -> Column:
    """Identifier of an article's text file; a version in an old-style file name is dropped."""
    base = F.regexp_replace(F.substring_index(path, "/", -1), r"\.[^./]*$", "")
    return F.when(F.contains(base, F.lit(".")), base).otherwise(F.regexp_replace(strip_version(base), r"^([a-zA-Z\-]+)(\d+)$", "$1/$2"))


def id_to_path(name: Column, root: str = "") -> Column:
    """Where the text of an article is: archive or `arxiv`, year and month, name."""
    new = F.contains(name, F.lit("."))
    archive, number = F.split_part(name, F.lit("/"), F.lit(1)), F.split_part(name, F.lit("/"), F.lit(2))
    return F.when(new, F.concat(F.lit(f"{root}arxiv/"), F.split_part(name, F.lit("."), F.lit(1)), F.lit("/"), name, F.lit(".txt"))).otherwise(F.concat(F.lit(root), archive, F.lit("/"), F.substring(number, 1, 4), F.lit("/"), archive, number, F.lit(".txt")))


def file_to_path(name: Column, root: str = "") -> Column:
    """The same by the name of the article's text file."""
    return id_to_path(path_to_id(name), root)


def id_to_member(name: Column) -> Column:
    """Where the PDF of an article is in its bulk archive."""
    new = F.contains(name, F.lit("."))
    return F.when(new, F.concat(F.split_part(name, F.lit("."), F.lit(1)), F.lit("/"), name, F.lit(".pdf"))).otherwise(F.concat(F.substring(F.split_part(name, F.lit("/"), F.lit(2)), 1, 4), F.lit("/"), F.replace(name, F.lit("/"), F.lit("")), F.lit(".pdf")))


def archive_file(tar: Column, root: str = "tarpdfs/") -> Column:
    return F.concat(F.lit(root), F.substring_index(tar, "/", -1), F.lit(".gz"))


def with_extension(name: Column, extension: str) -> Column:
    return F.concat(F.regexp_replace(name, r"(?<=[^/])\.[^./]*$", ""), F.lit(f".{extension}"))

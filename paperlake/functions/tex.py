"""TeX markup of accents, letters and signs to Unicode."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Accents by their TeX command: the combining mark, and the letters for which the accent is known.
ACCENTS = {
    "'": ("\u0301", "ACEILNORSUYZaceilnorsuyz"),
    '"': ("\u0308", "AEIOUYaeiouy"),
    ".": ("\u0307", "ACEGIOZacegoz"),
    "=": ("\u0304", "AEIOUYaeiouy"),
    "^": ("\u0302", "ACEGHIJOSUWYaceghijosuwy"),
    "`": ("\u0300", "AEIOUaeiou"),
    "~": ("\u0303", "AINOUainou"),
    "H": ("\u030b", "OUou"),
    "c": ("\u0327", "CEGKLNRSTcegklnrst"),
    "k": ("\u0328", "AEIOUaeiou"),
    "r": ("\u030a", "AUau"),
    "u": ("\u0306", "AEGIOUaegiou"),
    "v": ("\u030c", "ACDEGHIKLNORSTUZacdeghiklnorstuz"),
}
# Letters and signs by their TeX command. `upsion` is spelt as it is found in use.
LETTERS = {
    "AA": "Å", "AE": "Æ", "DH": "Ð", "DJ": "Đ", "ETH": "Ð", "L": "Ł", "NG": "Ŋ", "O": "Ø", "oe": "œ", "OE": "Œ",
    "TH": "Þ", "aa": "å", "ae": "æ", "dh": "ð", "dj": "đ", "eth": "ð", "i": "ı", "l": "ł", "ng": "ŋ", "o": "ø",
    "ss": "ß", "th": "þ", "Gamma": "Γ", "Delta": "Δ", "Theta": "Θ", "Lambda": "Λ", "Xi": "Ξ", "Pi": "Π", "Sigma": "Σ",
    "Upsilon": "Υ", "Phi": "Φ", "Psi": "Ψ", "Omega": "Ω", "alpha": "α", "beta": "β", "gamma": "γ", "delta": "δ",
    "epsilon": "ε", "zeta": "ζ", "eta": "η", "theta": "θ", "iota": "ι", "kappa": "κ", "lambda": "λ", "mu": "μ",
    "nu": "ν", "xi": "ξ", "omicron": "ο", "pi": "π", "rho": "ρ", "varsigma": "ς", "sigma": "σ", "tau": "τ",
    "upsion": "υ", "varphi": "φ", "phi": "ϕ", "chi": "χ", "psi": "ψ", "omega": "ω",
}
SIGNS = {"P": "¶", "S": "§", "copyright": "©", "guillemotleft": "«", "guillemotright": "»", "pounds": "£", "dag": "†", "ddag": "‡", "div": "÷", "deg": "°"}

ACCENTED = {command + letter: unicodedata.normalize("NFC", letter + mark) for command, (mark, letters) in ACCENTS.items() for letter in letters}


# A command of letters or of one other character, a brace, or what is between.
_TOKEN = re.compile(r"\\[A-Za-z]+|\\.|[{}]|[^\\{}]+|\\", re.S)
#: Commands that put an accent on what follows: signs take a letter, with or without braces; letters one in braces.
_SIGNS_ABOVE, _LETTERS_ABOVE = set("'`^\"~=."), set("Hckoruv")


class _Reader:
    """Reads tokens once, from left to right; a group in braces is read by a call of its own."""

    def __init__(self, text: str, letters: bool):
        self.tokens, self.at = _TOKEN.findall(text), 0
        self.names = SIGNS | (LETTERS if letters else {})

    def peek(self, ahead: int = 0) -> str:
        return self.tokens[self.at + ahead] if self.at + ahead < len(self.tokens) else ""

    def take(self) -> None:
        """Passes over the first character of the next token."""
        self.tokens[self.at] = self.tokens[self.at][1:]
        self.at += not self.tokens[self.at]

    def group(self) -> tuple[str, bool]:
        """What is in the braces that open here, and whether they close. Braces directly within braces are one pair; those
        around a single letter or sign command go with it."""
        self.at += 1
        if self.peek()[:1] == "\\" and self.peek(1) == "}" and (name := self.peek()[1:]) and (name in self.names or name == "j"):
            self.at += 2
            return self.names.get(name, "j"), True
        inside, whole = self.read(nested=True)
        if not whole:
            return "{" + inside, False
        self.at += 1
        doubled = inside.startswith("{") and inside.find("}") == len(inside) - 1
        return (inside if doubled else "{" + inside + "}"), True

    def read(self, nested: bool = False) -> tuple[str, bool]:
        """The text up to the brace that closes the group read (or the end), and whether that brace is there."""
        out = []
        while self.at < len(self.tokens):
            token = self.peek()
            if token == "}" and nested:
                return "".join(out), True
            if token == "{":
                out.append(self.group()[0])
                continue
            self.at += 1
            out.append(self.command(token) if token[0] == "\\" and len(token) > 1 else token)
        return "".join(out), False

    def command(self, token: str) -> str:
        name, after = token[1:], self.peek()
        if name in self.names and not re.match(r"\w", after[:1].replace("_", " ")):
            return self.names[name] + self.skip()
        if name == "j" and after[:1].isspace():
            self.take()
            return name
        if name in _SIGNS_ABOVE and re.match("[a-zA-Z]", after):
            self.take()
            return self.accent(name, after[0])
        if after == "{" and (name in _SIGNS_ABOVE or name in _LETTERS_ABOVE or name == "t"):
            base = self.group()[0]
            letter = base[1:-1]
            if name == "t":
                return letter if len(letter) == 1 and base[0] == "{" else token + base
            return self.accent(name, letter) if re.fullmatch(r"\{[a-zA-Z]\}", base) else token + base
        return token

    def skip(self) -> str:
        """Passes over what ends a command: {}, a space, or the backslash of an escaped space."""
        if self.peek() == "{" and self.peek(1) == "}":
            self.at += 2
        elif self.peek() == "\\ ":
            self.at += 1
            return " "
        elif self.peek().startswith(" "):
            self.take()
        return ""

    @staticmethod
    def accent(command: str, letter: str) -> str:
        """The letter with its accent; of a pair that is not known, the letters."""
        return ACCENTED.get(command + letter) or (command if command.isalpha() else "") + letter


def decode(text: str | None, letters: bool = True) -> str | None:
    """One string. Commands for letters, signs and accents become characters, doubled braces single ones; whatever is not
    known stays as it is. letters=False leaves letters alone."""
    if not text or "\\" not in text and "{{" not in text:
        return text
    reader, out = _Reader(text, letters), ""
    while reader.at < len(reader.tokens):
        out += reader.read()[0]
    return out


@F.pandas_udf(T.StringType())
def tex_to_utf(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
    """Column form: the replacements look names up and repeat until nothing changes, which no built-in does."""
    for t in texts:
        yield t.map(decode)

"""Spoken English as written text: contractions, fillers, numbers, ordinals, sums of money and percents."""

from __future__ import annotations

import re
import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Number words.
UNITS = "zero one two three four five six seven eight nine".split()
TEENS = "ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen nineteen".split()
TENS = "twenty thirty forty fifty sixty seventy eighty ninety".split()
SCALES = "thousand million billion trillion quadrillion quintillion sextillion septillion octillion nonillion decillion".split()
#: Ordinals that are not the number word with "th", and words for coins and notes with their signs.
ORDINALS = {"first": 1, "second": 2, "third": 3, "fifth": 5, "eighth": 8, "ninth": 9, "twelfth": 12}
MONEY = {"pound": "£", "euro": "€", "dollar": "$", "cent": "¢"}
#: What is left out of speech, and what contractions and titles stand for.
FILLERS = ("hmm", "mm", "mhm", "mmm", "uh", "um")
SPOKEN = (
    (r"\bwon't\b", "will not"), (r"\bcan't\b", "can not"), (r"\blet's\b", "let us"), (r"\bain't\b", "aint"), (r"\by'all\b", "you all"), (r"\bwanna\b", "want to"), (r"\bgotta\b", "got to"), (r"\bgonna\b", "going to"),
    (r"\bi'ma\b", "i am going to"), (r"\bimma\b", "i am going to"), (r"\bwoulda\b", "would have"), (r"\bcoulda\b", "could have"), (r"\bshoulda\b", "should have"), (r"\bma'am\b", "madam"),
    (r"\bmr\b", "mister "), (r"\bmrs\b", "missus "), (r"\bst\b", "saint "), (r"\bdr\b", "doctor "), (r"\bprof\b", "professor "), (r"\bcapt\b", "captain "), (r"\bgov\b", "governor "), (r"\bald\b", "alderman "),
    (r"\bgen\b", "general "), (r"\bsen\b", "senator "), (r"\brep\b", "representative "), (r"\bpres\b", "president "), (r"\brev\b", "reverend "), (r"\bhon\b", "honorable "), (r"\basst\b", "assistant "), (r"\bassoc\b", "associate "),
    (r"\blt\b", "lieutenant "), (r"\bcol\b", "colonel "), (r"\bjr\b", "junior "), (r"\bsr\b", "senior "), (r"\besq\b", "esquire "),
    (r"'d been\b", " had been"), (r"'s been\b", " has been"), (r"'d gone\b", " had gone"), (r"'s gone\b", " has gone"), (r"'d done\b", " had done"), (r"'s got\b", " has got"),
    (r"n't\b", " not"), (r"'re\b", " are"), (r"'s\b", " is"), (r"'d\b", " would"), (r"'ll\b", " will"), (r"'t\b", " not"), (r"'ve\b", " have"), (r"'m\b", " am"),
)

_SMALL = {w: i for i, w in enumerate(UNITS + TEENS)} | {"oh": 0, "o": 0}
_TENS = {w: 20 + 10 * i for i, w in enumerate(TENS)}
_SCALES = {w: 1000 ** (i + 1) for i, w in enumerate(SCALES)}
_LETTERS_KEPT = {"œ": "oe", "Œ": "OE", "ø": "o", "Ø": "O", "æ": "ae", "Æ": "AE", "ß": "ss", "ẞ": "SS", "đ": "d", "Đ": "D", "ð": "d", "Ð": "D", "þ": "th", "Þ": "th", "ł": "l", "Ł": "L"}


def _cardinal(word: str) -> tuple[str, str]:
    """The number word that a word is made of, and what is added to its digits: ``th`` and the like, ``s``, or nothing."""
    known = lambda w: w in _SMALL and w not in ("oh", "o") or w in _TENS or w in _SCALES or w == "hundred"
    if known(word):
        return word, ""
    if word in ORDINALS:
        n = ORDINALS[word]
        return (UNITS + TEENS)[n], {1: "st", 2: "nd", 3: "rd"}.get(n, "th")
    if word.endswith("ieth") and known(word[:-4] + "y"):
        return word[:-4] + "y", "th"
    if word.endswith("th") and known(word[:-2]):
        return word[:-2], "th"
    if word.endswith("ies") and known(word[:-3] + "y"):
        return word[:-3] + "y", "s"
    if word.endswith("s") and known(word[:-1]):
        return word[:-1], "s"
    return ("zero", "") if word in ("oh", "o") else ("", "")


class _Reader:
    """Reads runs of number words; a state is what has been added up so far and which scales are still open."""

    def __init__(self, words: list[str]):
        self.words = words

    def word(self, i: int) -> str:
        return self.words[i] if i < len(self.words) else ""

    def number(self, i: int) -> tuple[int, str, int] | None:
        """Value, ending and the place after a number from ``i`` on: groups under a thousand, each with a smaller scale than the one before."""
        total, group, part, limit, at, ending = 0, None, 100, 10**40, i, ""
        while not ending:
            j = at + 1 if at > i and self.word(at) == "and" and (group is None or part == 100 and group >= 100) else at
            name, end = _cardinal(self.word(j))
            if self.word(j).isdigit() and group is None and j == at and total == 0:
                group, part, at = int(self.word(j)), 0, j + 1
                continue
            if not name or name != self.word(j) and self.word(j) in ("oh", "o") and at > i:
                break
            if name in _SCALES and (at > i or j == at) and _SCALES[name] < limit and (group is not None or at == i):
                limit = _SCALES[name]
                total, group, part = total + (1 if group is None else group) * limit, None, 100
            elif name == "hundred" and (group is None and at == i or group is not None and 0 < group < 100):
                group, part = (1 if group is None else group) * 100, 100
            elif name in _TENS and part == 100 and (group is None or group % 100 == 0) and limit > 100:
                group, part = (group or 0) + _TENS[name], 10
            elif name in _SMALL and ((part == 100 and (group is None or group % 100 == 0)) or (part == 10 and 0 < _SMALL[name] < 10)) and (group is None or _SMALL[name] > 0):
                group, part = (group or 0) + _SMALL[name], 0
            else:
                break
            at, ending = j + 1, end
        if at == i:
            return None
        return total + (group or 0), ending, at

    def run(self, i: int) -> tuple[str, int] | None:
        """Digits of numbers that follow each other, with doubled digits, decimals and halves."""
        digits, at = "", i
        if self.word(i) == "point" and _cardinal(self.word(i + 1))[0] in _SMALL:
            digits = "0"
        while True:
            word = self.word(at)
            if word in ("double", "triple") and _cardinal(self.word(at + 1))[0] in UNITS and not _cardinal(self.word(at + 1))[1]:
                digits += str(_SMALL[_cardinal(self.word(at + 1))[0]]) * (2 if word == "double" else 3)
                at += 2
                continue
            if word == "point" and digits and "." not in digits and _cardinal(self.word(at + 1))[0] in _SMALL:
                digits, at = digits + ".", at + 1
                continue
            found = self.number(at) if not (word in ("oh", "o") and not digits) else None
            if found is None or (digits and word.isdigit()):
                break
            digits, at = digits + str(found[0]) + found[1], found[2]
            if found[1]:
                return digits, at
        if not digits or at == i:
            return None
        if self.words[at : at + 3] == ["and", "a", "half"] and "." not in digits:
            digits, at = digits + ".5", at + 3
        return digits, at

    def text(self) -> str:
        out, i = [], 0
        while i < len(self.words):
            sign = {"minus": "-", "negative": "-", "plus": "+"}.get(self.words[i], "")
            found = self.run(i + 1) if sign else self.run(i)
            if not found:
                out.append(self.words[i])
                i += 1
                continue
            digits, i = found
            unit = self.word(i)
            if unit in ("percent",) or unit == "per" and self.word(i + 1) == "cent":
                digits, i = digits + "%", i + (2 if unit == "per" else 1)
            elif (note := MONEY.get(unit) or MONEY.get(unit.removesuffix("s"))) and digits[-1:].isdigit():
                digits, i = note + digits, i + 1
            out.append(sign + digits)
        return " ".join(out)


def _bare(text: str) -> str:
    """Without marks above letters; other symbols become spaces, but for those of numbers and money."""
    out = []
    for c in unicodedata.normalize("NFKD", text):
        if c in ".%$¢€£'-":
            out.append(c)
        elif c in _LETTERS_KEPT:
            out.append(_LETTERS_KEPT[c])
        elif (kind := unicodedata.category(c)) != "Mn":
            out.append(" " if kind[0] in "MSP" else c)
    return "".join(out)


def numbers_written(text: str) -> str:
    """Number words of a text as digits; ``$2 and ¢7`` becomes ``$2.07``, ``$0.07`` becomes ``¢7``."""
    words = re.sub(r"(?<=[a-z])-(?=[a-z])|(?<![0-9a-z])-(?![0-9])|'", " ", text).split()
    written = _Reader(words).text()
    written = re.sub(r"([€£$])(\d+) (?:and )?¢(\d{1,2})\b", lambda m: f"{m[1]}{m[2]}.{int(m[3]):02d}", written)
    written = re.sub(r"[€£$]0\.(\d{1,2})\b", lambda m: f"¢{int(m[1])}", written)
    return re.sub(r"\b1(s?)\b(?!\.\d|%)", lambda m: "one" + m[1] if not re.search(r"[$€£¢.+-]$", written[: m.start()]) else m[0], written)


def written_english(text: Column, spellings: dict[str, str] | None = None) -> Column:
    """A transcript in a form that two of them can be compared in.

    Marked and bracketed parts and fillers go, contractions are written out, numbers are digits (a lone one is ``one``),
    symbols go but for those of money and percents at numbers.  ``spellings`` maps words to the form that counts.
    """
    s = F.regexp_replace(F.lower(text), r"[<\[][^>\]]*[>\]]|\(([^)]+?)\)", "")
    s = F.regexp_replace(s, rf"\b({'|'.join(FILLERS)})\b", "")
    s = F.regexp_replace(s, r"\s+'", "'")
    for pattern, new in SPOKEN:
        s = F.regexp_replace(s, pattern, new)
    s = F.regexp_replace(F.regexp_replace(s, r"(\d),(\d)", "$1$2"), r"\.(?![0-9])", " ")
    s = F.pandas_udf(lambda x: pd.Series([None if t is None else numbers_written(_bare(t)) for t in x], dtype=object), "string")(s)
    s = F.regexp_replace(s, r"[.$¢€£](?![0-9])|(?<![0-9])%", " ")
    words = F.filter(F.split(s, r"\s+"), lambda w: w != "")
    if spellings:
        known = F.create_map(*[F.lit(x) for pair in spellings.items() for x in pair])
        words = F.transform(words, lambda w: F.coalesce(F.try_element_at(known, w), w))
    return F.array_join(words, " ")

"""Parsers of free replies: choices, numbers, near matches; Arrow-batched where a row has its own pattern."""

from __future__ import annotations

import hashlib
import re
import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

_NUMBER = re.compile(r"-?(?:\d{1,3}(?:,\d{3})+|\d+)(?:\.\d+)?(?:[eE][+-]?\d+)?|-?\.\d+")


def pick_choice(reply: str | None, options: list[str], key: object) -> str:
    """The letter that a reply chooses.

    Tried in turn: ``(A)``, ``A`` between spaces, ``A.``, and for replies of over five words an option's text; of several
    the one that stands last.  Without any the letter follows from a hash of the key, so that a rerun gives the same.
    """
    letters = [chr(65 + i) for i in range(len(options))]
    text = f" {(reply or '').strip().strip(',.!?;:')} "
    for shape in ("({})", " {} ", "{}."):
        at = {x: text.rfind(shape.format(x)) for x in letters if shape.format(x) in text}
        if at:
            return max(at, key=at.get)
    if len(text.split()) > 5:
        at = {x: text.lower().rfind(o.lower()) for x, o in zip(letters, options, strict=True) if o and o.lower() in text.lower()}
        if at:
            return max(at, key=at.get)
    return letters[int(hashlib.md5(str(key).encode()).hexdigest(), 16) % len(letters)] if letters else ""


def choice(reply: Column, options: Column, key: Column) -> Column:
    @F.pandas_udf("string")
    def pick(r: pd.Series, o: pd.Series, k: pd.Series) -> pd.Series:
        return pd.Series([pick_choice(a, list(b), c) for a, b, c in zip(r, o, k, strict=True)])

    return pick(reply, options, key.cast("string"))


def inferred_option(reply: str | None, options: dict[str, str]) -> str | None:
    """The letter if just one stands in the reply as a word, else the one option whose text is in it."""
    words = re.findall(r"[A-Za-z]+|[^\sA-Za-z]+", reply or "")
    named = {w for w in words if w in options and (w != "A" or len(words) <= 5)}
    if len(named) == 1:
        return named.pop()
    inside = [k for k, v in options.items() if v and str(v).lower() in (reply or "").lower()]
    return inside[0] if len(inside) == 1 else None


def numbers_in(text: str | None) -> list[float]:
    """All numbers of a text, with thousands marks and exponents read."""
    return [float(x.replace(",", "")) for x in _NUMBER.findall(text or "")]


def numeric_match(pred: str | None, gold: str | None, tolerance: float = 1e-6) -> bool:
    """Whether the last number of the reply is the gold number; fractions and percents are read, nothing is evaluated."""

    def value(s: str | None) -> float | None:
        s = re.sub(r"\\(?:d|t)?frac\{([^{}]+)\}\{([^{}]+)\}", r"\1/\2", s or "").replace("$", "").strip()
        m = re.search(r"(-?[\d.]+)\s*/\s*(-?[\d.]+)\s*$", s)
        if m and float(m[2]):
            return float(m[1]) / float(m[2])
        found = numbers_in(s)
        return (found[-1] / 100 if s.endswith("%") else found[-1]) if found else None

    p, g = value(pred), value(gold)
    return p is not None and g is not None and abs(p - g) <= tolerance * max(1.0, abs(g))


def damerau(a: str, b: str) -> int:
    """Edit distance with swaps of neighbours."""
    before, row = list(range(len(b) + 1)), list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, before, row = before, row, [i]
        for j, y in enumerate(b, 1):
            d = min(row[-1] + 1, before[j] + 1, before[j - 1] + (x != y))
            if i > 1 and j > 1 and x == b[j - 2] and y == a[i - 2]:
                d = min(d, last[j - 2] + 1)
            row.append(d)
    return row[-1]


def near_match(a: str | None, b: str | None, least: float = 0.9) -> bool:
    """Nearly the same text, without accents, case and articles."""

    def plain(s: str | None) -> str:
        s = unicodedata.normalize("NFKD", s or "").encode("ascii", "ignore").decode().lower()
        return " ".join(w for w in s.split() if w not in ("a", "an", "the"))

    p, q = plain(a), plain(b)
    return not (p or q) or 1 - damerau(p, q) / max(len(p), len(q)) >= least


def scored(fn, pred: Column, ref: Column, kind: str = "double") -> Column:
    """A Python comparison of two texts as a batched column."""

    @F.pandas_udf(kind)
    def run(p: pd.Series, r: pd.Series) -> pd.Series:
        return pd.Series([fn(a, b) for a, b in zip(p, r, strict=True)])

    return run(pred, ref)


#: What may stand before and after a letter that names an option, in the order they are tried.
AFFIXES = (("", "."), ("", ","), ("", ":"), ("", ")"), ("", ")."), ("(", ")"), ("(", ")."), (":", ""), (":", ","), (":", "."), (":", ")"), (":", ")."))


def named_option(reply: Column, options: Column, letters: str = "ABCDE") -> Column:
    """The letter that alone stands in a reply, bare or between one pair of affixes, else of the one option whose text is in it; null for none.

    A bare ``A`` in a reply of more than three words may be an article, so then no bare letter counts.
    """
    words = F.filter(F.split(reply, r"\s+"), lambda w: w != "")
    names = F.array(*[F.lit(x) for x in letters])

    def only(a: str, b: str) -> Column:
        found = F.filter(names, lambda x: F.array_contains(words, F.concat(F.lit(a), x, F.lit(b))))
        return F.when(F.size(found) == 1, F.get(found, 0))

    bare = F.when(~(F.array_contains(words, "A") & (F.size(words) > 3)), only("", ""))
    inside = F.filter(F.transform(options, lambda o, i: F.struct(i.alias("i"), F.contains(F.lower(reply), F.lower(o)).alias("ok"))), lambda x: x["ok"])
    return F.coalesce(bare, *[only(a, b) for a, b in AFFIXES], F.when(F.size(inside) == 1, F.char(65 + F.get(inside, 0)["i"])))


def letter_or_exact(reply: Column, gold: Column) -> Column:
    """Equality, where a gold letter is met by one with brackets or a stop at a reply's beginning."""
    letter = F.regexp_extract(reply, r"^\(?([A-Za-z])\)?", 1)
    return F.when(gold.rlike("^[A-Za-z]$") & (F.length(reply) > 1) & (letter != ""), letter).otherwise(reply) == gold


#: What comes before an answer in a reply, and what is no answer by itself.
BEFORE_ANSWERS = ("could be ", "so ", "is ", "thus ", "therefore ", "final ", "answer ", "result ")
NO_ANSWERS = (":", ",", ".", "!", "?", ";", "'")
_OPEN_NUMBERS = (r"-?\b\d{1,3}(?:,\d{3})+\b", r"-?\d+(?:\.\d+)?[eE][+-]?\d+", r"-?(?:\d+\.\d+|\.\d+|\d+\b)(?![eE][+-]?\d+)(?![,\d])")


def _stripped(s: Column) -> Column:
    return F.regexp_replace(s, r"(?U)^\s+|\s+\z", "")


def comparable(texts: Column) -> Column:
    """``text, number`` of each text: numbers rounded to two places, other texts in lower case, single letters with a space on either side."""
    def one(s: Column) -> Column:
        s = _stripped(s)
        number = F.when(F.regexp_like(F.replace(s, F.lit(",")), F.lit(r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$")), F.round(F.replace(s, F.lit(",")).try_cast("double"), 2))
        as_text = lambda t: F.struct(t.alias("text"), F.lit(None).cast("double").alias("number"))
        low = F.lower(s)
        named = F.when(F.length(s) == 1, F.array(as_text(F.concat(F.lit(" "), low)), as_text(F.concat(low, F.lit(" "))))).otherwise(F.array(as_text(low)))
        return F.when(number.isNotNull(), F.array(F.struct(F.lit(None).cast("string").alias("text"), number.alias("number")))).otherwise(named)

    return F.flatten(F.transform(texts, one))


def open_answers(reply: Column) -> Column:
    """What an open reply may answer, as ``comparable`` gives it: of each line the shortest part behind a word that leads to an answer, and the numbers in these; the whole reply if there is none."""
    text = F.lower(F.regexp_replace(_stripped(reply), r"^\.+|\.+\z", ""))
    lines = F.split(text, "\n")

    marks = F.array(*[F.lit(m) for m in (*BEFORE_ANSWERS, "=")])

    def shortest(line: Column, i: Column) -> Column:
        def step(found: Column, mark: Column) -> Column:
            tail = _stripped(F.call_function("substring_index", line, mark, F.lit(-1)))
            there = F.contains(line, mark) & ((mark != "=") | (i == F.size(lines) - 1))
            return F.when(there & ((found == "") | (F.length(tail) < F.length(found))), tail).otherwise(found)

        return F.aggregate(marks, F.lit(""), step)

    parts = F.filter(F.transform(lines, shortest), lambda s: (s != "") & ~s.isin(*NO_ANSWERS))
    numbers = F.flatten(F.transform(parts, lambda s: F.concat(*[F.regexp_extract_all(s, F.lit(p), 0) for p in _OPEN_NUMBERS])))
    return F.array_distinct(comparable(F.when(F.size(parts) == 0, F.array(text)).otherwise(F.concat(parts, numbers))))


def open_match(reply: Column, golds: Column) -> Column:
    """Whether a part of an open reply holds one of the gold texts, or a number of it is one of the gold numbers."""
    gold = comparable(golds)
    hit = lambda p, g: (F.contains(p["text"], g["text"])) | (p["number"] == g["number"])
    return F.exists(open_answers(reply), lambda p: F.exists(gold, lambda g: F.coalesce(F.when(p["number"].isNotNull(), p["number"] == g["number"]).otherwise(hit(p, g)), F.lit(False))))

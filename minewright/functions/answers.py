"""Answer normalisers and scores of question answering, mostly as native columns; null in gives null out."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from minewright.functions.text import words

#: Contractions without their apostrophes, as answers are written.
CONTRACTIONS = {
    "aint": "ain't", "arent": "aren't", "cant": "can't", "couldve": "could've", "couldnt": "couldn't", "couldn'tve": "couldn't've", "couldnt've": "couldn't've",
    "didnt": "didn't", "doesnt": "doesn't", "dont": "don't", "hadnt": "hadn't", "hadnt've": "hadn't've", "hadn'tve": "hadn't've", "hasnt": "hasn't", "havent": "haven't",
    "hed": "he'd", "hed've": "he'd've", "he'dve": "he'd've", "hes": "he's", "howd": "how'd", "howll": "how'll", "hows": "how's", "Id've": "I'd've", "I'dve": "I'd've",
    "Im": "I'm", "Ive": "I've", "isnt": "isn't", "itd": "it'd", "itd've": "it'd've", "it'dve": "it'd've", "itll": "it'll", "let's": "let's", "maam": "ma'am",
    "mightnt": "mightn't", "mightnt've": "mightn't've", "mightn'tve": "mightn't've", "mightve": "might've", "mustnt": "mustn't", "mustve": "must've", "neednt": "needn't",
    "notve": "not've", "oclock": "o'clock", "oughtnt": "oughtn't", "ow's'at": "'ow's'at", "'ows'at": "'ow's'at", "'ow'sat": "'ow's'at", "shant": "shan't",
    "shed've": "she'd've", "she'dve": "she'd've", "she's": "she's", "shouldve": "should've", "shouldnt": "shouldn't", "shouldnt've": "shouldn't've", "shouldn'tve": "shouldn't've",
    "somebody'd": "somebodyd", "somebodyd've": "somebody'd've", "somebody'dve": "somebody'd've", "somebodyll": "somebody'll", "somebodys": "somebody's",
    "someoned": "someone'd", "someoned've": "someone'd've", "someone'dve": "someone'd've", "someonell": "someone'll", "someones": "someone's",
    "somethingd": "something'd", "somethingd've": "something'd've", "something'dve": "something'd've", "somethingll": "something'll", "thats": "that's",
    "thered": "there'd", "thered've": "there'd've", "there'dve": "there'd've", "therere": "there're", "theres": "there's", "theyd": "they'd", "theyd've": "they'd've",
    "they'dve": "they'd've", "theyll": "they'll", "theyre": "they're", "theyve": "they've", "twas": "'twas", "wasnt": "wasn't", "wed've": "we'd've", "we'dve": "we'd've",
    "weve": "we've", "werent": "weren't", "whatll": "what'll", "whatre": "what're", "whats": "what's", "whatve": "what've", "whens": "when's", "whered": "where'd",
    "wheres": "where's", "whereve": "where've", "whod": "who'd", "whod've": "who'd've", "who'dve": "who'd've", "wholl": "who'll", "whos": "who's", "whove": "who've",
    "whyll": "why'll", "whyre": "why're", "whys": "why's", "wont": "won't", "wouldve": "would've", "wouldnt": "wouldn't", "wouldnt've": "wouldn't've", "wouldn'tve": "wouldn't've",
    "yall": "y'all", "yall'll": "y'all'll", "y'allll": "y'all'll", "yall'd've": "y'all'd've", "y'alld've": "y'all'd've", "y'all'dve": "y'all'd've",
    "youd": "you'd", "youd've": "you'd've", "you'dve": "you'd've", "youll": "you'll", "youre": "you're", "youve": "you've",
}
#: Number words of an answer.
NUMBER_WORDS = {"none": "0", "zero": "0", "one": "1", "two": "2", "three": "3", "four": "4", "five": "5", "six": "6", "seven": "7", "eight": "8", "nine": "9", "ten": "10"}
#: Punctuation that goes, or becomes a space where no space is beside any of its kind.
MARKS = [";", "/", "[", "]", '"', "{", "}", "(", ")", "=", "+", "\\", "_", "-", ">", "<", "@", "`", ",", "?", "!"]
#: How many full stops go; the count that a misplaced flag gives there.
STOPS = 32


def _table(pairs: dict[str, str]) -> Column:
    return F.create_map(*[F.lit(x) for kv in pairs.items() for x in kv])


def mapped_words(s: Column, pairs: dict[str, str]) -> Column:
    """The words of a text, each replaced by what the table has for it."""
    return F.transform(words(s), lambda w: F.coalesce(F.try_element_at(_table(pairs), w), w))


def vqa_answer(s: Column) -> Column:
    """An answer as visual question answering compares it: lower case, without marks and articles, number words as digits, contractions with their apostrophes.

    A mark goes if a space stands before or after any of its kind, and becomes a space otherwise; only the first 32 full
    stops before a character that is no digit go.
    """
    x = F.trim(F.replace(F.translate(F.lower(s), ",?", ""), F.lit("'s"), F.lit(" 's")), F.lit(" \t\n\r\f\x0b"))
    x = F.trim(F.translate(x, "\n\t", "  "))
    out = x
    for p in MARKS:
        beside = F.contains(x, F.lit(p + " ")) | F.contains(x, F.lit(" " + p))
        out = F.replace(out, F.lit(p), F.when(beside, "").otherwise(" "))
    out = F.array_join(F.split(out, r"\.(?![0-9])", STOPS + 1), "")
    kept = F.filter(mapped_words(out, NUMBER_WORDS), lambda w: ~w.isin("a", "an", "the"))
    return F.array_join(F.transform(kept, lambda w: F.coalesce(F.try_element_at(_table(CONTRACTIONS), w), w)), " ")


def detokenize(s: Column) -> Column:
    """Spaces that a tokenizer put before contractions, brackets, quotes and stops go."""
    for old, new in ((" n't", "n't"), (" )", ")"), ("( ", "("), ('" ', '"'), (' "', '"')):
        s = F.replace(s, F.lit(old), F.lit(new))
    return F.regexp_replace(s, r" (['.,])", "$1")


def best_of(score, pred: Column, refs: Column) -> Column:
    """The best score over several references; null without any."""
    return F.array_max(F.transform(refs, lambda r: score(pred, r)))


def multiset_f1(pred: Column, gold: Column) -> Column:
    """F1 of two token arrays as multisets; with an empty side 1 if both are, else 0."""
    count = lambda a, t: F.size(F.filter(a, lambda x: x == t))
    shared = F.transform(F.array_intersect(pred, gold), lambda t: F.least(count(pred, t), count(gold, t)))
    both = F.aggregate(shared, F.lit(0), lambda a, x: a + x)
    empty = (F.size(pred) == 0) | (F.size(gold) == 0)
    return F.when(empty, (F.size(pred) == F.size(gold)).cast("double")).otherwise(2.0 * both / (F.size(pred) + F.size(gold)))


def _plain(s: Column) -> Column:
    return F.replace(F.trim(F.lower(s)), F.lit("\n"), F.lit(" "))


def contains_answer(pred: Column, refs: Column, squeeze: bool = False) -> Column:
    """1 if some reference stands in the reply, without case, or without spaces if asked."""
    shape = (lambda s: F.replace(F.translate(F.trim(s), "\n", " "), F.lit(" "), F.lit(""))) if squeeze else _plain
    return F.exists(refs, lambda r: F.contains(shape(pred), shape(r))).cast("int")


def short_or_near(pred: Column, refs: Column, short: int = 5, least: float = 0.5) -> Column:
    """The best over the references: 1 if one of under ``short`` words is in the reply, else its similarity by edit distance from ``least`` on."""
    p = _plain(pred)

    def one(ref: Column) -> Column:
        r = _plain(ref)
        longest = F.greatest(F.length(p), F.length(r))
        near = F.when(longest == 0, 1.0).otherwise(1 - F.levenshtein(p, r) / longest)
        return F.when(F.size(words(r)) < short, F.contains(p, r).cast("double")).otherwise(F.when(near >= least, near).otherwise(0.0))

    return F.coalesce(F.array_max(F.transform(refs, one)), F.lit(0.0))


def simple_match(pred: Column, gold: Column) -> Column:
    """Equality without spaces, hyphens, line breaks, tabs, full stops and case."""
    bare = lambda s: F.lower(F.translate(s, " -\n\t.", ""))
    return bare(pred) == bare(gold)


def positive_int_match(pred: Column, gold: Column) -> Column:
    """1 or 0 by equality; -1, no score, where neither is positive; 0 where the reply is no integer."""
    p, g = F.trim(pred).try_cast("long"), F.trim(gold).try_cast("long")
    whole = F.regexp_like(F.trim(pred), F.lit("^[+-]?[0-9]+$"))
    return F.when(~whole | p.isNull(), 0).when((p <= 0) & (g <= 0), -1).otherwise((p == g).cast("int"))


def angle_rmse(pred: Column, gold: Column, high: float = 10.0) -> Column:
    """Root mean square difference of angles in degrees, the short way round, as a score that is 0 from ``high`` on."""
    turn = F.transform(F.zip_with(pred, gold, lambda a, b: F.abs(a - b)), lambda d: F.least(d % 360, 360 - d % 360))
    error = F.sqrt(F.aggregate(turn, F.lit(0.0), lambda a, x: a + x * x) / F.size(gold))
    return 1 - F.least(error, F.lit(high)) / high


def key_recall(pred: Column, gold: Column) -> Column:
    """Share of the gold map's keys whose values are right."""
    right = F.size(F.filter(F.map_keys(gold), lambda k: F.try_element_at(pred, k).eqNullSafe(F.try_element_at(gold, k)) & F.map_contains_key(pred, k)))
    return F.when(F.size(gold) == 0, (F.size(pred) == 0).cast("double")).otherwise(right / F.size(gold))


def key_jaccard(pred: Column, gold: Column) -> Column:
    """Mean over the keys of either map of the Jaccard similarity of their lists; a key that one lacks scores 0."""
    keys = F.array_union(F.map_keys(pred), F.map_keys(gold))

    def one(k: Column) -> Column:
        a, b = F.try_element_at(pred, k), F.try_element_at(gold, k)
        union = F.size(F.array_union(a, b))
        return F.when(a.isNull() | b.isNull(), 0.0).when(union == 0, 1.0).otherwise(F.size(F.array_intersect(a, b)) / union)

    return F.when(F.size(keys) == 0, 1.0).otherwise(F.aggregate(F.transform(keys, one), F.lit(0.0), lambda a, x: a + x) / F.size(keys))


def typed_answer(reply: Column, choices: Column, kind: Column, precision: Column) -> Column:
    """A reply as its kind: the text of the choice that a bracketed or bare letter names, or of the choice nearest by edit distance (the first of equals); a whole number; a number rounded to ``precision``."""
    bare = F.trim(reply)
    letter = F.regexp_extract(bare, r"\(([a-zA-Z])\)", 1)
    named = F.when(letter != "", F.upper(letter)).otherwise(bare)
    at = F.array_position(F.transform(choices, lambda c, i: F.char(65 + i)), named)
    nearest = F.array_min(F.transform(choices, lambda c, i: F.struct(F.levenshtein(named, c).alias("d"), i.alias("i"), c.alias("c"))))["c"]
    choice = F.when(at > 0, F.try_element_at(choices, at.cast("int"))).otherwise(nearest)
    number = F.pandas_udf(_typed_number, "string")(kind, bare, precision)
    return F.when(kind == "choice", choice).when(kind.isin("integer", "float"), number).otherwise(reply)


def _typed_number(kind: pd.Series, text: pd.Series, precision: pd.Series) -> pd.Series:
    """Numbers as they are written out: whole ones of any length towards zero, others rounded by their exact value, ties to even; null for what is none."""

    def one(k: str | None, t: str | None, p: int | None) -> str | None:
        try:
            return str(int(float(t))) if k == "integer" else str(round(float(t), int(p))) if k == "float" else None
        except (TypeError, ValueError, OverflowError):
            return None

    return pd.Series([one(*x) for x in zip(kind, text, precision, strict=True)], dtype=object)


def latex_plain(s: Column) -> Column:
    r"""A LaTeX answer in a plain form: ``\frac`` forms as one, no ``\left``, ``\right``, spaces, degrees, percents, text marks or leading ``x=``; a bare ``.5`` gets its zero."""
    for pattern, new in (
        (r"\\!|\\,|\\;|\\ |\s+", ""), (r"\\(t|d)frac", r"\\frac"), (r"\\left|\\right", ""), (r"\^\{?\\circ\}?", ""), (r"\\\$|\$|\\%|%", ""),
        (r"\\(?:text|mathrm|mathbf|textbf)\{([^{}]*)\}", "$1"), (r"\\frac([0-9])([0-9])", r"\\frac{$1}{$2}"), (r"\\sqrt([0-9])", r"\\sqrt{$1}"), (r"^[a-zA-Z]=", ""),
        (r"(^|[^0-9])\.([0-9])", "$10.$2"), (r"^(-?[0-9]+)/([0-9]+)$", r"\\frac{$1}{$2}"), (r"(\.[0-9]*?)0+$", "$1"), (r"\.$", ""),
    ):
        s = F.regexp_replace(s, pattern, new)
    return s


def latex_value(s: Column) -> Column:
    r"""The number that a plain LaTeX answer stands for: digits, or a ``\frac`` of digits; null for anything else."""
    plain = latex_plain(s)
    top, bottom = (F.regexp_extract(plain, r"^(-?)\\frac\{(-?[0-9.]+)\}\{([0-9.]+)\}$", g) for g in (2, 3))
    sign = F.when(F.regexp_extract(plain, r"^(-?)\\frac", 1) == "-", -1.0).otherwise(1.0)
    return F.coalesce(F.translate(plain, ",", "").try_cast("double"), sign * F.try_divide(top.try_cast("double"), bottom.try_cast("double")))


def latex_equal(pred: Column, gold: Column, tolerance: float = 1e-8) -> Column:
    """Equal plain forms, or equal numbers up to a tolerance."""
    p, g = latex_value(pred), latex_value(gold)
    near = F.abs(p - g) <= tolerance * F.greatest(F.lit(1.0), F.abs(g))
    return (latex_plain(pred) == latex_plain(gold)) | F.coalesce(near, F.lit(False))


def number_sets_equal(pred: Column, gold: Column, precision: float = 1e-8) -> Column:
    """Answers of several numbers, parted by commas and in brackets or not: as many, and each gold number within 1.01 times the precision of one of the reply's."""
    def numbers(s: Column) -> Column:
        inner = F.split(F.regexp_replace(s, r"^\s*[\[({]|[\])}]\s*$", ""), ",")
        return F.transform(inner, lambda x: latex_value(F.trim(x)))

    p, g = numbers(pred), numbers(gold)
    there = F.forall(p, lambda x: x.isNotNull()) & F.forall(g, lambda x: x.isNotNull())
    return there & (F.size(p) == F.size(g)) & F.forall(g, lambda x: F.exists(p, lambda y: F.abs(x - y) <= precision * 1.01))


def answer_part(response: Column) -> Column:
    """What stands after the last ``Answer:``, or in the code block there, without quotes around it; the whole without such a mark."""
    after = F.regexp_extract(response, r"(?is)^.*answer\s*:\s*(.*)$", 1)
    text = F.when(F.regexp_like(response, F.lit(r"(?is)answer\s*:")), after).otherwise(response)
    block = F.regexp_extract(text, r"(?s)```[a-zA-Z]*\n?(.*?)```", 1)
    text = F.trim(F.when(block != "", block).otherwise(text), F.lit(" \t\n\r"))
    return F.regexp_replace(text, r"(?s)^([\"'])(.*)\1$", "$2")


def json_part(response: Column, schema: str) -> Column:
    """The outermost braces of a reply read as JSON of a schema; null where there are none or they do not parse."""
    return F.from_json(F.regexp_extract(response, r"(?s)\{.*\}", 0), schema)

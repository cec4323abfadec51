"""Text expressions: answer normalisers, replies, choices, numbers; native columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Python's string.punctuation, as a regular-expression class.
PUNCTUATION = r"[!\"#$%&'()*+,\-./:;<=>?@\[\\\]^_`{|}~]"


def normalize_answer(s: Column) -> Column:
    """Lower case, no punctuation, no articles, single spaces."""
    x = F.regexp_replace(F.lower(s), PUNCTUATION, "")
    x = F.regexp_replace(x, r"(?U)\b(a|an|the)\b", " ")
    return F.trim(F.regexp_replace(x, r"\s+", " "))


def exact_match(pred: Column, ref: Column, ignore_case: bool = False, ignore_punctuation: bool = False, ignore_numbers: bool = False, patterns: tuple[str, ...] = ()) -> Column:
    """Equality after the asked-for removals: patterns, then case, punctuation, digits."""
    for p in patterns:
        pred, ref = F.regexp_replace(pred, p, ""), F.regexp_replace(ref, p, "")
    if ignore_case:
        pred, ref = F.lower(pred), F.lower(ref)
    if ignore_punctuation:
        pred, ref = F.regexp_replace(pred, PUNCTUATION, ""), F.regexp_replace(ref, PUNCTUATION, "")
    if ignore_numbers:
        pred, ref = F.regexp_replace(pred, "[0-9]", ""), F.regexp_replace(ref, "[0-9]", "")
    return pred == ref


def yes_no(reply: Column) -> Column:
    """``yes``, ``no`` or ``other``: by the whole, by one letter, or by the first four characters."""
    r = F.lower(F.trim(reply))
    head = F.substring(r, 1, 4)
    return (
        F.when(r.isin("yes", "no"), r).when(r == "y", "yes").when(r == "n", "no")
        .when(F.contains(head, F.lit("yes")), "yes").when(F.contains(head, F.lit("no")), "no").otherwise("other")
    )


#: Openings of an answer that carry no choice. The last two are strings of two each, as their users have them.
ANSWER_OPENINGS = ["The best answer is", "The correct answer is", "The answer is", "The answer", "The best option isThe correct option is", "Best answer:Best option:"]
#: The same openings one by one, as those who choose among five have them.
OPENINGS_APART = ["The best answer is", "The correct answer is", "The answer is", "The answer", "The best option is", "The correct option is", "Best answer:", "Best option:"]


def choice_letter(reply: Column, letters: str = "ABCD", openings: list[str] = ANSWER_OPENINGS, choices: Column | None = None) -> Column:
    """The first choice letter after the openings; empty for over ten words without one.

    With ``choices`` (``(A) text``) a reply of up to ten words without a letter takes that of the first choice that holds it.
    """
    s = F.trim(reply)
    for opening in openings:
        s = F.replace(s, F.lit(opening), F.lit(""))
    found = F.regexp_extract(s, f"[{letters}]", 0)
    if choices is None:
        return F.coalesce(found, F.lit(""))
    held = F.try_element_at(F.filter(choices, lambda c: F.contains(F.lower(c), F.lower(s))), F.lit(1))
    return F.coalesce(F.when(found != "", found).when(F.size(words(s)) <= 10, F.substring(held, 2, 1)), F.lit(""))


def leading_choice(answer: Column, reply: Column) -> Column:
    """Whether the answer letter stands first, after ``(``, after ``option `` or after ``the answer is ``."""
    a, r = F.lower(F.trim(answer)), F.lower(F.trim(reply))
    first = F.substring(a, 1, 1)
    at = lambda n: F.substring(r, n + 1, 1)
    return F.coalesce(
        (a != "")
        & ((at(0) == first) | (F.startswith(r, F.lit("(")) & (at(1) == first)) | (F.startswith(r, F.lit("option ")) & (at(7) == first)) | (F.startswith(r, F.lit("the answer is ")) & (at(14) == first))),
        F.lit(False),
    )


def number(s: Column) -> Column:
    """A number or a percentage as a double; null if it is neither."""
    t = F.trim(s)
    return F.when(F.endswith(t, F.lit("%")), F.rtrim(F.regexp_replace(t, "%$", "")).try_cast("double") / 100).otherwise(t.try_cast("double"))


def relaxed_match(pred: Column, target: Column, tolerance: float = 0.05) -> Column:
    """Numbers within a relative tolerance, otherwise equal text; a target of zero is compared as text."""
    p, t = number(pred), number(target)
    close = F.abs(p - t) / F.abs(t) <= tolerance
    return F.when(p.isNotNull() & t.isNotNull() & (t != 0), close).otherwise(F.lower(pred) == F.lower(target))


def anls(pred: Column, refs: Column, threshold: float = 0.5) -> Column:
    """One less the least edit distance over the references by the longer raw length; under the threshold 0."""
    squeeze = lambda x: F.lower(F.trim(F.regexp_replace(x, r"\s+", " ")))
    p = squeeze(pred)

    def distance(ref: Column) -> Column:
        longest = F.greatest(F.length(ref), F.length(pred))
        return F.when(longest == 0, F.lit(0.0)).otherwise(F.levenshtein(p, squeeze(ref)) / longest)

    score = 1 - F.array_min(F.transform(refs, distance))
    return F.when(score < threshold, 0.0).otherwise(score)


def two_scores(review: Column) -> Column:
    """The two numbers of a review's first line, or -1 and -1."""
    parts = F.filter(F.split(F.replace(F.trim(F.substring_index(review, "\n", 1)), F.lit(","), F.lit(" ")), " "), lambda x: x != "")
    numbers = F.transform(parts, lambda x: x.try_cast("double"))
    good = (F.size(parts) == 2) & F.forall(numbers, lambda x: x.isNotNull())
    return F.when(good, numbers).otherwise(F.array(F.lit(-1.0), F.lit(-1.0)))


def clean_prompt(s: Column) -> Column:
    """Null becomes a space; ``[title]`` a full stop, other brackets go, and double spaces shrink once."""
    x = F.replace(F.trim(s), F.lit(" [title]"), F.lit(". "))
    x = F.regexp_replace(x, r"\[.*?\]", "")
    return F.coalesce(F.replace(x, F.lit("  "), F.lit(" ")), F.lit(" "))


def words(s: Column) -> Column:
    """White-space separated words, none for an empty string."""
    return F.filter(F.split(F.trim(s), r"\s+"), lambda w: w != "")


def token_set_f1(pred: Column, ref: Column) -> Column:
    """F1 of two word sets; 0 without a common word."""
    a, b = F.array_distinct(words(pred)), F.array_distinct(words(ref))
    both = F.size(F.array_intersect(a, b)).cast("double")
    return F.when(both == 0, 0.0).otherwise(2 * both / (F.size(a) + F.size(b)))


def boxed(s: Column) -> Column:
    r"""Content of the last ``\boxed{...}`` without inner braces, or null."""
    found = F.regexp_extract_all(s, F.lit(r"\\boxed\{([^{}]*)\}"), 1)
    return F.try_element_at(found, F.lit(-1))


def sentence_scores(s: Column) -> Column:
    """All numbers in a text, as text."""
    return F.regexp_extract_all(s, F.lit(r"-?[0-9]+(?:\.[0-9]+)?"), 0)

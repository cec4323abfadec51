"""Time spans and transcripts in replies."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def seconds(clock: Column) -> Column:
    """``HH:MM:SS``, ``MM:SS`` or plain seconds as a double."""
    parts = F.transform(F.split(clock, ":"), lambda x: x.try_cast("double"))
    return F.aggregate(parts, F.lit(0.0), lambda a, x: a * 60 + x)


def time_span(reply: Column) -> Column:
    """``[start, end]`` in order: the first two clocks, else ``a - b`` or ``a to b``, else the first two numbers; null for none."""
    number = r"([0-9]+(?:\.[0-9]+)?)"
    pair = rf"{number}\s*(?:-|–|to|and)\s*{number}"
    clocks = F.regexp_extract_all(reply, F.lit(r"([0-9]{1,2}(?::[0-9]{2}){1,2})"), 1)
    numbers = F.regexp_extract_all(reply, F.lit(number), 1)
    by_pair = F.array(F.regexp_extract(reply, pair, 1).try_cast("double"), F.regexp_extract(reply, pair, 2).try_cast("double"))
    two = lambda a, f: F.array(f(F.try_element_at(a, F.lit(1))), f(F.try_element_at(a, F.lit(2))))
    span = (
        F.when(F.size(clocks) >= 2, two(clocks, seconds)).when(reply.rlike(pair), by_pair)
        .when(F.size(numbers) >= 2, two(numbers, lambda x: x.try_cast("double")))
    )
    return F.when(span.isNotNull(), F.sort_array(span))


#: An example that replies repeat, and words that mark a sentence as one of times.
EXAMPLE = "a specific example is : 20.8 - 30.0 seconds"
TIME_WORDS = ["starts", "ends", "happens in", "start time", "end time", "start", "end", "happen"]


def event_span(reply: Column) -> Column:
    """``[start, end]`` in order as moment retrieval reads it; null for none.

    The first ``a - b`` or ``a to b``; else the first numbers of the first two sentences that speak of times; else the
    first clocks of such sentences.  A sentence ends at ``!``, ``?`` or a line break, and gives one time.
    """
    text = F.replace(F.replace(F.lower(reply), F.lit(EXAMPLE), F.lit("")), F.lit("to"), F.lit("-"))
    pair = r"([0-9]+\.*[0-9]*)\s*-\s*([0-9]+\.*[0-9]*)"
    said = F.filter(F.split(text, r"[!?\n]"), lambda s: F.rlike(s, F.lit("|".join(TIME_WORDS))))

    def firsts(pattern: str) -> Column:
        return F.filter(F.transform(said, lambda s: F.regexp_extract(s, pattern, 1)), lambda x: x != "")

    numbers, clocks = firsts(r"\b([0-9]+\.[0-9]+\b|\b[0-9]+)\b"), firsts(r"\b([0-9]{1,2}:[0-9]{2}:[0-9]{2})\b")
    two = lambda a, f: F.array(f(F.try_element_at(a, F.lit(1))), f(F.try_element_at(a, F.lit(2))))
    as_number = lambda x: F.regexp_replace(x, r"\.$", "").try_cast("double")
    span = (
        F.when(F.rlike(text, F.lit(pair)), F.array(as_number(F.regexp_extract(text, pair, 1)), as_number(F.regexp_extract(text, pair, 2))))
        .when(F.size(numbers) >= 2, two(numbers, as_number)).when(F.size(clocks) >= 2, two(clocks, seconds)))
    return F.when(span.isNotNull(), F.sort_array(span))


def clean_transcript(text: Column) -> Column:
    """No ``<|marks|>``, no space before punctuation, single spaces."""
    t = F.regexp_replace(text, r"<\|[^|]*\|>", " ")
    t = F.regexp_replace(t, r"\s+([,.?!;:])", "$1")
    return F.trim(F.regexp_replace(t, r"\s+", " "))

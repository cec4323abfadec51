"""Response filters: expressions over an array of responses, composed by name."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Filter = Callable[[Column], Column]
FILTERS: dict[str, Callable[..., Filter]] = {}


def response_filter(name: str):
    """Register a maker of filters; a filter takes the responses' array and returns one."""

    def add(make: Callable[..., Filter]) -> Callable[..., Filter]:
        FILTERS[name] = make
        return make

    return add


@response_filter("whitespace")
def whitespace() -> Filter:
    """Takes one leading space off."""
    return lambda r: F.transform(r, lambda x: F.when(F.startswith(x, F.lit(" ")), F.substring(x, F.lit(2), F.length(x))).otherwise(x))


@response_filter("regex")
def regex(pattern: str, group_select: int = 0, fallback: str = "[invalid]", group: int = 1) -> Filter:
    """The chosen match's group, stripped; the fallback where there is no such match."""

    def pick(x: Column) -> Column:
        found = F.regexp_extract_all(x, F.lit(pattern), group)
        at = F.lit(group_select + 1 if group_select >= 0 else group_select)
        return F.coalesce(F.trim(F.try_element_at(found, at)), F.lit(fallback))

    return lambda r: F.transform(r, pick)


@response_filter("regex_groups")
def regex_groups(pattern: str, groups: int, group_select: int = 0, fallback: str = "[invalid]") -> Filter:
    """As ``regex`` for a pattern of several groups: the first of them that is not empty."""

    def pick(x: Column) -> Column:
        at = F.lit(group_select + 1 if group_select >= 0 else group_select)
        found = [F.try_element_at(F.regexp_extract_all(x, F.lit(pattern), g), at) for g in range(1, groups + 1)]
        return F.coalesce(*[F.when(f != "", F.trim(f)) for f in found], F.lit(fallback))

    return lambda r: F.transform(r, pick)


@response_filter("take_first")
def take_first() -> Filter:
    return lambda r: F.slice(r, 1, 1)


@response_filter("take_first_k")
def take_first_k(k: int) -> Filter:
    return lambda r: F.slice(r, 1, k)


@response_filter("majority_vote")
def majority_vote() -> Filter:
    """The most frequent response, the first seen of equals."""

    def vote(r: Column) -> Column:
        counted = F.transform(F.array_distinct(r), lambda x: F.struct(F.size(F.filter(r, lambda y: y == x)).alias("n"), (-F.array_position(r, x)).alias("first"), x.alias("x")))
        return F.when(F.size(r) == 0, r).otherwise(F.array(F.array_max(counted)["x"]))

    return vote


@response_filter("lowercase")
def lowercase() -> Filter:
    return lambda r: F.transform(r, F.lower)


@response_filter("uppercase")
def uppercase() -> Filter:
    return lambda r: F.transform(r, F.upper)


@response_filter("map")
def mapped(table: dict[str, str], default: str | None = None) -> Filter:
    pairs = F.create_map(*[F.lit(x) for kv in table.items() for x in kv]) if table else F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<string>"))
    return lambda r: F.transform(r, lambda x: F.coalesce(F.try_element_at(pairs, x), F.lit(default)))


@response_filter("choice_regex")
def choice_regex(pattern: str, choices: Column, fallback: str = "[invalid]") -> Filter:
    """A letter by the pattern, else the choice whose text stands in the response, else a letter after a colon, as ``(A)``."""
    letters = F.lit("ABCDEFGHIJKLMNOPQRSTUVWXYZ")

    def pick(x: Column) -> Column:
        by_pattern = F.regexp_extract(x, pattern, 1)
        low = F.lower(F.regexp_replace(x, r"[^\w\s]", ""))
        inside = F.transform(choices, lambda c, i: F.when(F.contains(low, F.lower(F.regexp_replace(c, r"[^\w\s]", ""))), F.substring(letters, i + 1, F.lit(1))))
        by_text = F.try_element_at(F.filter(inside, lambda c: c.isNotNull()), F.lit(1))
        by_colon = F.regexp_extract(x, r":\s*([A-Z])\b", 1)
        wrap = lambda c: F.concat(F.lit("("), c, F.lit(")"))
        return F.when(by_pattern != "", wrap(by_pattern)).when(by_text.isNotNull(), wrap(by_text)).when(by_colon != "", wrap(by_colon)).otherwise(fallback)

    return lambda r: F.transform(r, pick)


def ignoring(x: Column, case: bool = False, punctuation: bool = False, patterns: tuple[str, ...] = ()) -> Column:
    """A response without what a match is to ignore: patterns, then case, then all punctuation."""
    for p in patterns:
        x = F.regexp_replace(x, p, "")
    x = F.lower(x) if case else x
    return F.regexp_replace(x, r"\p{P}", "") if punctuation else x


def choice_text(question: Column, responses: Column) -> Column:
    """Of the first response the letter of the choice whose text stands in it first, else the response without punctuation.

    Choices are mined from the question: a capital letter, a full stop, and the rest of the line; letters are given in
    their order there, and the last of equal texts counts.
    """
    mined = F.transform(F.regexp_extract_all(question, F.lit(r"\b([A-Z])\.\s+([^\n]*)"), 2), lambda x: F.trim(x))
    plain = F.trim(F.regexp_replace(F.try_element_at(responses, F.lit(1)), r"(?U)[^\w\s]", ""))
    last = lambda c: F.size(mined) - F.array_position(F.reverse(mined), c)
    met = F.transform(mined, lambda c, i: F.struct(F.instr(plain, c).alias("at"), i.alias("i"), F.char(65 + last(c)).alias("letter")))
    first = F.array_min(F.filter(met, lambda m: m["at"] > 0))
    return F.coalesce(first["letter"], plain)


def ensemble(responses: Column, pipelines: dict[str, list[tuple[str, dict]]]) -> Column:
    """``name -> filtered responses`` of several pipelines, each a list of filters applied in turn."""
    out = []
    for name, steps in pipelines.items():
        r = responses
        for step, args in steps:
            r = FILTERS[step](**args)(r)
        out += [F.lit(name), r]
    return F.create_map(*out)


def filtered(rows: DataFrame, pipelines: dict[str, list[tuple[str, dict]]], column: str = "resps") -> DataFrame:
    return rows.withColumn("filtered_resps", ensemble(F.col(column), pipelines))

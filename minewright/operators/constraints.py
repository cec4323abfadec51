"""Constrained generation: each row brings constraints of a small grammar, evaluated by kind.

A constraint is a key and a value, both parted by ``##``: ``contain##position##times`` with
``sun, moon##2##1`` asks for one of the words, in the second sentence, once in all.  Numbers at
a part's end only tell equal keys apart.  Kinds: ``contain`` (any item), ``contain_only`` (just one of
several lists, as ``[[a, b], [c]]``), with ``position``, ``position_only`` and ``times``; ``length`` (``<40``, ``>3``
words); ``acrostic`` and ``acrostic_alliteration`` (a letter for each line, a space for an empty one).
What needs a dictionary of pronunciations (syllables, rhymes, metres) is left without a score.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from minewright.functions.instructions import bare

KINDS = ("contain", "contain_only", "position", "position_only", "times")


def folded(text: Column) -> Column:
    """Lower-cased words and marks, one space apart, plurals by their endings as singulars."""
    s = F.regexp_replace(F.lower(text), r"(?U)([^\w\s'])", " $1 ")
    for pattern, new in ((r"(?U)\b(\w{2,})ies\b", "$1y"), (r"(?U)\b(\w{2,})ves\b", "$1f"), (r"(?U)\b(\w+(?:ch|sh|x|ss|zz))es\b", "$1"), (r"(?U)\b(\w{2,}[^\Wsui])s\b", "$1")):
        s = F.regexp_replace(s, pattern, new)
    return F.trim(F.regexp_replace(s, r"\s+", " "))


def sentences(text: Column) -> Column:
    return F.filter(F.split(bare(text), r"(?<=[.!?][\"')]{0,2})\s+"), lambda s: s != "")


def _list(text: Column) -> Column:
    inner = F.regexp_replace(F.trim(text), r"^[\[({](.*)[\])}]$", "$1")
    return F.filter(F.transform(F.split(inner, ","), lambda x: F.regexp_replace(F.trim(x), r"^[\"']|[\"']$", "")), lambda x: x != "")


def _occurrences(parts: Column, items: Column) -> Column:
    """``sentence, n`` of each item in each sentence that has it."""
    count = lambda s, item: ((F.length(s) - F.length(F.replace(s, item, F.lit("")))) / F.length(item)).cast("int")
    each = F.transform(items, lambda item: F.transform(parts, lambda s, i: F.struct((i + 1).alias("sentence"), count(s, folded(item)).alias("n"))))
    return F.filter(F.flatten(each), lambda x: x["n"] > 0)


def _contains(reply: Column, want: Column) -> Column:
    parts = F.transform(sentences(F.replace(reply, F.lit("**"), F.lit(""))), folded)
    lists = F.transform(F.regexp_extract_all(want["contain_only"], F.lit(r"\[([^\[\]]*)\]"), 1), _list)
    only = F.filter(F.transform(lists, lambda items: _occurrences(parts, items)), lambda found: F.size(found) > 0)
    plain = _occurrences(parts, _list(want["contain"]))
    one = want["contain_only"].isNotNull()
    found = F.when(one, F.get(only, 0)).otherwise(plain)
    there = F.when(one, F.size(only) == 1).otherwise(F.size(plain) > 0)
    total = F.aggregate(found, F.lit(0), lambda a, x: a + x["n"])
    alone, place, times = (want[k].try_cast("int") for k in ("position_only", "position", "times"))
    at = F.transform(found, lambda x: x["sentence"])
    ok = F.when(times.isNotNull(), total == times).when(place.isNotNull(), F.array_contains(at, place)).otherwise(F.lit(True))
    return there & F.when(alone.isNotNull(), (F.size(found) == 1) & (F.get(at, 0) == alone)).otherwise(ok)


def _length(reply: Column, value: Column) -> Column:
    n, limit = F.regexp_count(reply, F.lit(r"(?U)\b\w+\b")), F.regexp_extract(value, r"^[<>]\s*(\d+)\s*$", 1).try_cast("int")
    return F.when(F.startswith(value, F.lit("<")), n < limit).when(F.startswith(value, F.lit(">")), n > limit)


def _acrostic(reply: Column, value: Column, alliterated: Column) -> Column:
    lines = F.split(F.lower(bare(F.replace(reply, F.lit("**"), F.lit("")))), "\n")
    letters = F.filter(F.split(F.lower(value), ""), lambda c: c != "")

    def fits(line: Column, letter: Column) -> Column:
        line = bare(line)
        words = F.forall(F.split(line, " "), lambda w: F.substring(w, 1, 1) == letter)
        return F.when(letter == " ", line == "").otherwise((line != "") & (F.substring(line, 1, 1) == letter) & (~alliterated | words))

    return (F.size(lines) == F.size(letters)) & F.forall(F.zip_with(lines, letters, fits), lambda x: x)


def constraint_scores(rows: DataFrame, reply: str, key: str, value: str, name: str = "score") -> DataFrame:
    """``rows`` with 1 or 0 in ``name``: whether the reply keeps the row's constraint.  A blank value asks for nothing; a key and a value of other numbers of parts are never kept; a null reply keeps nothing."""
    k, v, r = F.lower(F.col(key)), F.coalesce(F.col(value), F.lit("")), F.coalesce(F.col(reply), F.lit(""))
    names = F.transform(F.split(F.trim(k), "##"), lambda x: F.regexp_replace(F.trim(x), r"\d+$", ""))
    values = F.transform(F.split(F.trim(v), "##"), lambda x: F.trim(F.regexp_replace(F.trim(x), r'^"|"$', "")))
    pairs = F.arrays_zip(names.alias("k"), values.alias("v"))
    part = lambda n: F.get(F.filter(pairs, lambda p: p["k"] == n), 0)["v"]
    want = F.struct(*[part(n).alias(n) for n in KINDS])
    ok = (
        F.when(F.trim(v) == "", F.lit(True)).when(F.contains(k, F.lit("contain")), (F.size(names) == F.size(values)) & _contains(r, want))
        .when(F.contains(k, F.lit("length")), F.coalesce(_length(r, F.trim(v)), F.lit(False))).when(F.contains(k, F.lit("acrostic")), _acrostic(r, v, F.contains(k, F.lit("alliteration")))))
    return rows.withColumn(name, F.when(F.col(reply).isNull(), 0).otherwise(ok.cast("int")))


def constrained_scores(scored: DataFrame, by: list[str], name: str = "score") -> DataFrame:
    """The least score of a reply's constraints, those without one left out."""
    return scored.groupBy(*by).agg(F.min(name).alias(name))

"""Checks of instructions on a reply, as native boolean columns, and their strict and loose readings."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from minewright.functions.text import words

CHECKS: dict[str, Callable[..., Callable[[Column], Column]]] = {}


def check(name: str):
    def add(make):
        CHECKS[name] = make
        return make

    return add


def _relation(count: Column, relation: str, n: int) -> Column:
    return count < n if relation == "less than" else count >= n


@check("number_words")
def number_words(n: int, relation: str = "at least"):
    return lambda r: _relation(F.size(F.regexp_extract_all(r, F.lit(r"\w+"), 0)), relation, n)


@check("number_words_unicode")
def number_words_unicode(n: int, relation: str = "at least"):
    return lambda r: _relation(F.size(F.regexp_extract_all(r, F.lit(r"[\p{L}\p{N}_]+"), 0)), relation, n)


@check("number_sentences")
def number_sentences(n: int, relation: str = "at least"):
    return lambda r: _relation(F.size(F.filter(F.split(r, r"[.!?]+(\s+|$)"), lambda s: F.trim(s) != "")), relation, n)


@check("number_paragraphs")
def number_paragraphs(n: int, mark: str = r"\s?\*\*\*\s?"):
    return lambda r: F.size(F.filter(F.split(r, mark), lambda s: F.trim(s) != "")) == n


@check("number_bullets")
def number_bullets(n: int):
    return lambda r: F.regexp_count(r, F.lit(r"(?m)^\s*(\*[^\*].*|-.*)$")) == n


@check("number_sections")
def number_sections(n: int, mark: str = "Section"):
    return lambda r: F.regexp_count(r, F.lit(rf"\s?{mark}\s?\d+\s?")) >= n


@check("number_placeholders")
def number_placeholders(n: int):
    return lambda r: F.regexp_count(r, F.lit(r"\[.*?\]")) >= n


@check("number_highlights")
def number_highlights(n: int):
    return lambda r: F.regexp_count(r, F.lit(r"\*[^\n\*]+\*")) >= n


@check("keywords_present")
def keywords_present(keywords: list[str]):
    return lambda r: F.forall(F.array(*[F.lit(k.lower()) for k in keywords]), lambda k: F.contains(F.lower(r), k))


@check("keywords_absent")
def keywords_absent(keywords: list[str]):
    return lambda r: ~F.exists(F.array(*[F.lit(k.lower()) for k in keywords]), lambda k: F.array_contains(F.split(F.lower(r), r"\W+"), k))


@check("keyword_frequency")
def keyword_frequency(keyword: str, n: int, relation: str = "at least"):
    return lambda r: _relation(F.regexp_count(F.lower(r), F.lit(keyword.lower())), relation, n)


@check("letter_frequency")
def letter_frequency(letter: str, n: int, relation: str = "at least"):
    return lambda r: _relation(F.length(r) - F.length(F.replace(F.lower(r), F.lit(letter.lower()), F.lit(""))), relation, n)


@check("capital_words")
def capital_words(n: int, relation: str = "at least"):
    return lambda r: _relation(F.size(F.filter(words(r), lambda w: (F.upper(w) == w) & w.rlike("[A-Z]"))), relation, n)


@check("all_capitals")
def all_capitals():
    return lambda r: (F.upper(r) == r) & r.rlike("[A-Z]")


@check("all_lowercase")
def all_lowercase():
    return lambda r: (F.lower(r) == r) & r.rlike("[a-z]")


@check("no_commas")
def no_commas():
    return lambda r: ~F.contains(r, F.lit(","))


@check("json_format")
def json_format():
    body = lambda r: F.regexp_replace(F.trim(r), r"(?is)^```(json)?\s*|\s*```$", "")
    return lambda r: F.try_parse_json(body(r)).isNotNull()


@check("title")
def title():
    return lambda r: r.rlike(r"<<[^\n]*\S[^\n]*>>")


@check("postscript")
def postscript(mark: str = r"p\.\s?s\."):
    return lambda r: F.lower(r).rlike(rf"(?m)\s*{mark}.*$")


@check("end_phrase")
def end_phrase(phrase: str):
    return lambda r: F.endswith(F.lower(F.trim(F.regexp_replace(r, '"$', ""))), F.lit(phrase.strip().lower()))


@check("quotation")
def quotation():
    return lambda r: (F.length(F.trim(r)) > 1) & F.startswith(F.trim(r), F.lit('"')) & F.endswith(F.trim(r), F.lit('"'))


@check("two_responses")
def two_responses():
    parts = lambda r: F.filter(F.transform(F.split(r, r"\*\*\*\*\*\*"), lambda s: F.trim(s)), lambda s: s != "")
    return lambda r: (F.size(parts(r)) == 2) & (F.size(F.array_distinct(parts(r))) == 2)


@check("repeat_prompt")
def repeat_prompt(prompt: str):
    return lambda r: F.startswith(F.lower(F.trim(r)), F.lit(prompt.strip().lower()))


@check("paragraph_first_word")
def paragraph_first_word(n: int, at: int, word: str):
    parts = lambda r: F.filter(F.split(r, "\n\n"), lambda s: F.trim(s) != "")
    first = lambda p: F.lower(F.regexp_extract(F.trim(p), r"^['\"]*([^\s.,?!'\"]+)", 1))
    return lambda r: (F.size(parts(r)) == n) & (first(F.try_element_at(parts(r), F.lit(at))) == word.lower())


@check("constrained_reply")
def constrained_reply(options: list[str]):
    return lambda r: F.exists(F.array(*[F.lit(o) for o in options]), lambda o: F.contains(r, o))


def bare(text: Column) -> Column:
    """The text without white space at its ends."""
    return F.regexp_replace(text, r"(?U)^\s+|\s+\z", "")


def readings(reply: Column) -> list[Column]:
    """The reply, without its first, last, or both lines, each also without asterisks."""
    lines = F.split(reply, "\n")
    n = F.size(lines)
    part = lambda a, k: bare(F.array_join(F.slice(lines, F.lit(a), F.greatest(n - k, F.lit(0))), "\n"))
    plain = [reply, part(2, 1), part(1, 1), part(2, 2)]
    return plain + [F.replace(x, F.lit("*"), F.lit("")) for x in plain]


def followed(reply: Column, checks: list[tuple[str, dict]]) -> Column:
    """``strict`` and ``loose`` arrays with an entry per instruction; loose if any reading follows it, empty replies never do."""
    ask = lambda r, name, args: F.coalesce((F.trim(r) != "") & CHECKS[name](**args)(r), F.lit(False))
    strict = F.array(*[ask(reply, n, a) for n, a in checks])
    loose = []
    for n, a in checks:
        any_ = F.lit(False)
        for r in readings(reply):
            any_ = any_ | ask(r, n, a)
        loose.append(any_)
    return F.struct(strict.alias("strict"), F.array(*loose).alias("loose"))


#: Checks by the name that a row brings: of its reply and of a map of arguments, both columns. Lists come as JSON text.
ROW_CHECKS: dict[str, Callable[[Column, "Arguments"], Column]] = {}


class Arguments:
    """The arguments of a row's check, typed where they are read; one that is missing makes the check null, which counts as not followed."""

    def __init__(self, given: Column, prompt: Column, detected: Column):
        self.given, self.prompt, self.detected = given, prompt, detected

    def text(self, name: str) -> Column:
        return F.try_element_at(self.given, F.lit(name))

    def number(self, name: str) -> Column:
        return self.text(name).try_cast("double")

    def list(self, name: str) -> Column:
        return F.from_json(self.text(name), "array<string>")

    def relation(self, count: Column, threshold: str, relation: str = "relation") -> Column:
        return F.when(self.text(relation) == "less than", count < self.number(threshold)).when(self.text(relation) == "at least", count >= self.number(threshold))


def row_check(name: str):
    def add(make):
        ROW_CHECKS[name] = make
        return make

    return add


_any_case = lambda pattern: F.concat(F.lit("(?iu)"), pattern)
_matches = lambda r, pattern: F.regexp_count(r, pattern if isinstance(pattern, Column) else F.lit(pattern))
_blank = lambda s: bare(s) == ""
_edges = lambda i, n: (i == 0) | (i == n - 1)


def _parts_between(r: Column, mark: str) -> tuple[Column, Column]:
    """The parts that are not blank, and whether none within is."""
    parts = F.split(r, mark)
    n = F.size(parts)
    held = F.filter(parts, lambda s: ~_blank(s))
    return held, ~F.exists(F.transform(parts, lambda s, i: _blank(s) & ~_edges(i, n)), lambda x: x)


row_check("keywords:existence")(lambda r, a: F.forall(a.list("keywords"), lambda k: F.regexp_like(r, _any_case(k))))
row_check("keywords:frequency")(lambda r, a: a.relation(_matches(r, _any_case(a.text("keyword"))), "frequency"))
row_check("keywords:forbidden_words")(lambda r, a: ~F.exists(a.list("forbidden_words"), lambda k: F.regexp_like(r, F.concat(F.lit(r"(?iuU)\b"), k, F.lit(r"\b")))))
row_check("language:response_language")(lambda r, a: F.coalesce(a.detected == a.text("language"), F.lit(True)))
row_check("length_constraints:number_words")(lambda r, a: a.relation(_matches(r, r"(?U)\w+"), "num_words"))
row_check("length_constraints:number_sentences")(lambda r, a: a.relation(F.size(F.filter(F.split(r, r"[.!?]+(\s+|$)"), lambda s: ~_blank(s))), "num_sentences"))
row_check("detectable_content:number_placeholders")(lambda r, a: _matches(r, r"(?d)\[.*?\]") >= a.number("num_placeholders"))
row_check("detectable_format:number_bullet_lists")(lambda r, a: (_matches(r, r"(?dm)^\s*\*[^*].*$") + _matches(r, r"(?dm)^\s*-.*$")) == a.number("num_bullets"))
row_check("detectable_format:multiple_sections")(lambda r, a: _matches(r, F.concat(F.lit(r"\s?"), a.text("section_spliter"), F.lit(r"\s?\d+\s?"))) >= a.number("num_sections"))
row_check("detectable_format:title")(lambda r, a: F.exists(F.regexp_extract_all(r, F.lit(r"<<[^\n]+>>"), 0), lambda t: ~_blank(F.regexp_replace(t, r"^<+|>+$", ""))))
row_check("combination:repeat_prompt")(lambda r, a: F.startswith(F.lower(bare(r)), F.lower(bare(F.coalesce(a.text("prompt_to_repeat"), a.prompt)))))
row_check("startend:end_checker")(lambda r, a: F.endswith(F.lower(F.regexp_replace(bare(r), r'^"+|"+\z', "")), F.lower(bare(a.text("end_phrase")))))
row_check("startend:quotation")(lambda r, a: F.regexp_like(bare(r), F.lit(r'(?s)^".*"\z')))
row_check("change_case:english_capital")(lambda r, a: (F.upper(r) == r) & (F.lower(r) != r) & F.coalesce(a.detected == "en", F.lit(True)))
row_check("change_case:english_lowercase")(lambda r, a: (F.lower(r) == r) & (F.upper(r) != r) & F.coalesce(a.detected == "en", F.lit(True)))
row_check("change_case:capital_word_frequency")(lambda r, a: a.relation(F.size(F.filter(F.regexp_extract_all(r, F.lit(r"(?U)[\w-]+"), 0), lambda w: (F.upper(w) == w) & (F.lower(w) != w))), "capital_frequency", "capital_relation"))
row_check("punctuation:no_comma")(lambda r, a: ~F.contains(r, F.lit(",")))


@row_check("keywords:letter_frequency")
def _letter_frequency(r: Column, a: Arguments) -> Column:
    letter, low = F.lower(a.text("letter")), F.lower(r)
    return a.relation(F.length(low) - F.length(F.replace(low, letter, F.lit(""))), "let_frequency", "let_relation")


@row_check("length_constraints:number_paragraphs")
def _number_paragraphs(r: Column, a: Arguments) -> Column:
    held, whole = _parts_between(r, r"\s?\*\*\*\s?")
    return whole & (F.size(held) == a.number("num_paragraphs"))


@row_check("length_constraints:nth_paragraph_first_word")
def _nth_paragraph_first_word(r: Column, a: Arguments) -> Column:
    """The paragraph is counted among all, blank ones too; their number is of those that are not."""
    parts = F.split(r, "\n\n")
    n, at = F.size(F.filter(parts, lambda s: ~_blank(s))), a.number("nth_paragraph").cast("int")
    asked = bare(F.coalesce(F.try_element_at(parts, at), F.lit("")))
    word = F.regexp_extract(F.regexp_replace(F.regexp_extract(asked, r"^(\S+)", 1), "^'*\"*", ""), "^([^.,?!'\"]*)", 1)
    return (at <= n) & (asked != "") & (n == a.number("num_paragraphs")) & (F.lower(word) == F.lower(a.text("first_word")))


@row_check("detectable_content:postscript")
def _postscript(r: Column, a: Arguments) -> Column:
    mark = a.text("postscript_marker")
    pattern = F.when(mark == "P.P.S", r"p\.\s?p\.\s?s").when(mark == "P.S.", r"p\.\s?s\.").otherwise(F.lower(mark))
    return F.regexp_like(F.lower(r), pattern)


#: The replies that a constrained response has to hold one of.
OPTIONS = ("My answer is yes.", "My answer is no.", "My answer is maybe.")
row_check("detectable_format:constrained_response")(lambda r, a: F.exists(F.array(*[F.lit(o) for o in OPTIONS]), lambda o: F.contains(bare(r), o)))


@row_check("detectable_format:number_highlighted_sections")
def _highlights(r: Column, a: Arguments) -> Column:
    found = lambda pattern: F.size(F.filter(F.regexp_extract_all(r, F.lit(pattern), 0), lambda h: F.regexp_like(h, F.lit(r"[^\s*]"))))
    return found(r"\*[^\n*]*\*") + found(r"\*\*[^\n*]*\*\*") >= a.number("num_highlights")


@row_check("detectable_format:json_format")
def _json_format(r: Column, a: Arguments) -> Column:
    body = bare(F.regexp_replace(F.regexp_replace(bare(r), r"^```(json|Json|JSON)?", ""), r"```\z", ""))
    return F.try_parse_json(body).isNotNull() & (body != "")


@row_check("combination:two_responses")
def _two_responses(r: Column, a: Arguments) -> Column:
    held, whole = _parts_between(r, r"\*\*\*\*\*\*")
    return whole & (F.size(held) == 2) & (bare(F.get(held, 0)) != bare(F.get(held, 1)))

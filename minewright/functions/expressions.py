"""Answers in mathematical notation: a small parser of plain and LaTeX expressions, and their comparison by value.

Nothing is executed: a text becomes a tree of numbers, names, operators and functions, and
the tree is worked out at given values of its names.  Two expressions with names are equal
if they agree at fixed sample points.  Used a row at a time inside Arrow batches.
"""

from __future__ import annotations

import math
import re
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Functions of one argument by name.
FUNCTIONS: dict[str, Callable[[float], float]] = {
    "sin": math.sin, "cos": math.cos, "tan": math.tan, "cot": lambda x: 1 / math.tan(x), "sec": lambda x: 1 / math.cos(x), "csc": lambda x: 1 / math.sin(x),
    "arcsin": math.asin, "arccos": math.acos, "arctan": math.atan, "sinh": math.sinh, "cosh": math.cosh, "tanh": math.tanh,
    "ln": math.log, "log": math.log10, "exp": math.exp, "sqrt": math.sqrt, "abs": abs,
}
#: Marks that say nothing about the number beside them.
_DECORATION = re.compile(r"\\left|\\right|\\!|\\,|\\;|\\:|\\ |\\quad|\\displaystyle|\\limits|\$|\\\$|¥|€|\^\{?\\circ\}?|\\circ|°C|°|\\text\{[^{}]*\}|\\mathrm\{[^{}]*\}|\\mathbf\{[^{}]*\}|\\textbf\{[^{}]*\}|\\mbox\{[^{}]*\}")
_SYNONYMS = (("\\dfrac", "\\frac"), ("\\tfrac", "\\frac"), ("\\cdot", "*"), ("\\times", "*"), ("\\div", "/"), ("×", "*"), ("÷", "/"), ("−", "-"), ("·", "*"), ("\\pi", " pi "), ("π", " pi "), ("\\infty", " inf "), ("∞", " inf "), ("\\%", "%"), ("**", "^"), ("\\{", "{"), ("\\}", "}"), ("\\operatorname", ""))
_TOKEN = re.compile(r"\s*(\d+(?:,\d{3})+(?:\.\d+)?|\d+\.?\d*(?:[eE][+-]?\d+)?|\.\d+|\\[a-zA-Z]+|[a-zA-Z]+(?:_\{?\w+\}?)?|[-+*/^!%()\[\]{}|_])")
#: Points at which expressions with names are compared.
POINTS = (0.7390851332, 1.3247179572, 2.6854520010, 0.5671432904)


class Unreadable(ValueError):
    pass


def plain(text: str) -> str:
    for a, b in _SYNONYMS:
        text = text.replace(a, b)
    return _DECORATION.sub(" ", text).strip()


def _tokens(text: str) -> Iterator[str]:
    at = 0
    text = text.rstrip()
    while at < len(text):
        m = _TOKEN.match(text, at)
        if not m:
            raise Unreadable(text)
        yield m[1]
        at = m.end()


class _Parser:
    """Sums, products (also by standing beside each other), powers, roots, fractions, functions, absolute values, factorials and percents."""

    def __init__(self, text: str, pi: float):
        self.tokens, self.at, self.pi, self.depth = list(_tokens(text)), 0, pi, 0

    def peek(self) -> str | None:
        return self.tokens[self.at] if self.at < len(self.tokens) else None

    def take(self, wanted: str | None = None) -> str:
        token = self.peek()
        if token is None or wanted is not None and token != wanted:
            raise Unreadable(f"{wanted} wanted, {token} found")
        self.at += 1
        return token

    def whole(self):
        tree = self.sum()
        if self.peek() is not None:
            raise Unreadable(self.peek())
        return tree

    def sum(self):
        self.depth += 1
        if self.depth > 200:
            raise Unreadable("too deep")
        tree = self.product()
        while self.peek() in ("+", "-"):
            tree = (self.take(), tree, self.product())
        self.depth -= 1
        return tree

    def product(self):
        tree = self.signed()
        while (token := self.peek()) is not None and token not in "+-)]}|!%^_":
            if token in "*/":
                tree = (self.take(), tree, self.signed())
            else:
                tree = ("*", tree, self.power())
        return tree

    def signed(self):
        if self.peek() in ("+", "-"):
            sign = self.take()
            tree = self.signed()
            return ("-", 0.0, tree) if sign == "-" else tree
        return self.power()

    def power(self):
        tree = self.single()
        while self.peek() in ("!", "%"):
            tree = (self.take(), tree)
        if self.peek() == "^":
            self.take()
            tree = ("^", tree, self.exponent())
        return tree

    def exponent(self):
        if self.peek() in ("+", "-"):
            return ("-", 0.0, self.exponent()) if self.take() == "-" else self.exponent()
        return self.power()

    def group(self):
        """What stands in braces, or a single digit or name."""
        if self.peek() == "{":
            self.take()
            tree = self.sum()
            self.take("}")
            return tree
        token = self.take()
        if token[0].isdigit() and len(token) > 1:  # \frac12
            self.tokens[self.at - 1 : self.at] = [token[0], token[1:]]
            return float(token[0])
        self.at -= 1
        return self.single()

    def single(self):
        token = self.take()
        if token[0].isdigit() or token[0] == ".":
            value = float(token.replace(",", ""))
            return value
        if token in "([{":
            tree = self.sum()
            self.take({"(": ")", "[": "]", "{": "}"}[token])
            return tree
        if token == "|":
            tree = self.sum()
            self.take("|")
            return ("abs", tree)
        name = token.lstrip("\\")
        if token == "\\frac":
            return ("/", self.group(), self.group())
        if name == "sqrt":
            order = 2.0
            if self.peek() == "[":
                self.take()
                order = self.sum()
                self.take("]")
            return ("root", self.group(), order)
        if name in FUNCTIONS:
            base = None
            if name == "log" and self.peek() == "_":
                self.take()
                base = self.group()
            power = None
            if self.peek() == "^":
                self.take()
                power = self.exponent()
            tree = (name, self.group() if self.peek() == "{" else self.power())
            tree = tree if base is None else ("/", ("ln", tree[1]), ("ln", base))
            return tree if power is None else ("^", tree, power)
        if name == "pi":
            return self.pi
        if name == "inf":
            return math.inf
        if token == "e":
            return math.e
        if token[0].isalpha() and len(token) > 1 and "_" not in token and not token.isupper():
            self.tokens[self.at : self.at] = list(token[1:])  # xy is x times y
            return ("name", token[0]) if token[0] != "e" else math.e
        if token[0].isalpha() or token[0] == "\\":
            return ("name", token)
        raise Unreadable(token)


def parse(text: str, pi: float = math.pi):
    return _Parser(plain(text), pi).whole()


def names(tree) -> set[str]:
    if not isinstance(tree, tuple):
        return set()
    return {tree[1]} if tree[0] == "name" else set().union(*map(names, tree[1:]))


def value(tree, known: dict[str, float] | None = None) -> float:
    """The number that a tree stands for; an error where it has none."""
    if not isinstance(tree, tuple):
        return tree
    op, *args = tree
    if op == "name":
        if known is None or args[0] not in known:
            raise Unreadable(args[0])
        return known[args[0]]
    x = [value(a, known) for a in args]
    try:
        if op == "+":
            out = x[0] + x[1]
        elif op == "-":
            out = x[0] - x[1]
        elif op == "*":
            out = x[0] * x[1]
        elif op == "/":
            out = x[0] / x[1]
        elif op == "^":
            out = x[0] ** x[1]
        elif op == "root":
            out = math.copysign(abs(x[0]) ** (1 / x[1]), x[0]) if x[0] >= 0 or x[1] % 2 == 1 else math.nan
        elif op == "%":
            out = x[0] / 100
        elif op == "!":
            out = float(math.factorial(int(x[0]))) if x[0] == int(x[0]) and 0 <= x[0] <= 170 else math.nan
        else:
            out = FUNCTIONS[op](x[0])
    except (ArithmeticError, ValueError) as e:
        raise Unreadable(str(e)) from e
    if isinstance(out, complex) or math.isnan(out):
        raise Unreadable("no real number")
    return out


def _near(a: float, b: float, precision: float) -> bool:
    return a == b or abs(a - b) <= precision * 1.01 * max(1.0, abs(b) if precision < 1e-6 else 1.0)


def _sampled(trees: list, precision: float, agree: Callable[[list[list[float]]], bool]) -> bool:
    """``agree`` on the values of all trees at points where all have one; with fewer than two points they don't."""
    variables = sorted(set().union(*map(names, trees)))
    if not variables:
        return agree([[value(t)] for t in trees])
    rows = []
    for shift in range(len(POINTS)):
        known = {v: POINTS[(i + shift) % len(POINTS)] * (1 + i // len(POINTS)) for i, v in enumerate(variables)}
        try:
            rows.append([value(t, known) for t in trees])
        except Unreadable:
            continue
    return len(rows) >= 2 and agree([list(c) for c in zip(*rows, strict=True)])


def _expressions_equal(p: str, g: str, precision: float) -> bool:
    return _sampled([parse(p), parse(g)], precision, lambda x: all(_near(a, b, precision) for a, b in zip(*x, strict=True)))


def _sides(text: str) -> tuple[str, str] | None:
    parts = re.split(r"(?<![<>!=\\])=(?!=)", text)
    return (parts[0], parts[1]) if len(parts) == 2 else None


def _equations_equal(p: tuple[str, str], g: tuple[str, str], precision: float) -> bool:
    """The differences of both sides are the same but for a factor that is the same at all points."""
    trees = [("-", parse(a), parse(b)) for a, b in (p, g)]

    def agree(x: list[list[float]]) -> bool:
        ratios = [a / b for a, b in zip(*x, strict=True) if b]
        return len(ratios) == len(x[1]) and abs(ratios[0]) > 0 and all(_near(r / ratios[0], 1.0, max(precision, 1e-9)) for r in ratios)

    return names(trees[0]) == names(trees[1]) and _sampled(trees, precision, agree)


_INTERVAL = re.compile(r"^\s*([\[(])\s*(.+?)\s*,\s*(.+?)\s*([\])])\s*$")


def _intervals_equal(p: str, g: str, precision: float) -> bool | None:
    """Unions of intervals part by part; null where one of them is none."""
    parts = [[_INTERVAL.match(x) for x in re.split(r"\\cup|∪", s)] for s in (p, g)]
    if not all(m for side in parts for m in side):
        return None
    if len(parts[0]) != len(parts[1]):
        return False
    return all(a[1] == b[1] and a[4] == b[4] and _expressions_equal(a[2], b[2], precision) and _expressions_equal(a[3], b[3], precision) for a, b in zip(*parts, strict=True))


def _split(text: str) -> list[str]:
    """Parted by commas outside of brackets; a comma between groups of three digits parts nothing."""
    out, depth, start = [], 0, 0
    for i, c in enumerate(text):
        depth += (c in "([{") - (c in ")]}")
        if c == "," and depth <= 0 and not re.match(r"\d{3}(?!\d)", text[i + 1 : i + 5]):
            out.append(text[start:i])
            start = i + 1
    return [x.strip() for x in [*out, text[start:]]]


def _unboxed(text: str) -> str:
    """What the last ``\\boxed{...}`` holds, else the text."""
    at = text.rfind("\\boxed{")
    if at < 0:
        return text
    depth, start = 0, at + 7
    for i in range(start - 1, len(text)):
        depth += (text[i] == "{") - (text[i] == "}")
        if not depth:
            return text[start:i]
    return text[start:]


_SPREAD = re.compile(r"\\pm|±")


def _spread(items: list[str]) -> list[str]:
    return [y for x in items for y in ([_SPREAD.sub("+", x), _SPREAD.sub("-", x)] if _SPREAD.search(x) else [x])]


def answers_equal(pred: str | None, gold: str | None, precision: float = 1e-8) -> bool:
    """Whether an answer is the gold one: the same text, or the same intervals, equation, tuple in order, or numbers and expressions in any order.

    ``\\boxed`` is looked into, ``\\pm`` stands for both values, a leading ``x =`` and ``\\in`` go where the other side has none.
    """
    if pred is None or gold is None:
        return False
    p, g = (_unboxed(x).strip().strip("$").strip().rstrip(".") for x in (pred, gold))
    if re.sub(r"\s+", "", p) == re.sub(r"\s+", "", g):
        return True
    p, g = (re.sub(r"^\s*[a-zA-Z]\s*\\in\b", "", _DECORATION.sub(" ", x.replace("\\{", "{").replace("\\}", "}"))).strip() for x in (p, g))
    try:
        ep, eg = _sides(p), _sides(g)
        if ep and eg and not (len(ep[0].strip()) == 1 and len(eg[0].strip()) == 1 and ep[0].strip() == eg[0].strip()):
            return _equations_equal(ep, eg, precision)
        p, g = (e[1].strip() if e else x for e, x in ((ep, p), (eg, g)))
        if (same := _intervals_equal(p, g, precision)) is not None:
            return same
        if p[:1] == "{" and p[-1:] == "}" and g[:1] == "{":
            p, g = p[1:-1], g[1:-1]
        ps, gs = _spread(_split(p)), _spread(_split(g))
        if len(ps) != len(gs):
            return False
        if len(gs) == 1:
            return _expressions_equal(p, g, precision)
        left = list(ps)
        for x in gs:
            hit = next((y for y in left if answers_equal(y, x, precision)), None)
            if hit is None:
                return False
            left.remove(hit)
        return True
    except (Unreadable, RecursionError):
        return False


#: The number that stands for pi where answers are compared by a share.
ROUGH_PI = 3.14


def _numbers(text: str) -> list[float] | None:
    """The number or the list of numbers behind the last sign of equality; units and currencies go, percents are hundredths."""
    body = re.sub(r"\\\((.*?)\\\)|\\\[(.*?)\\\]", lambda m: m[1] or m[2] or "", text, flags=re.S)
    m = re.search(r"(?:=|≈|\\approx)\s*(.+)", body, flags=re.S)
    body = (m[1] if m else body).strip()
    inner = re.fullmatch(r"[\[(](.*)[\])]", body, flags=re.S)
    items = _split(inner[1]) if inner and "," in inner[1] else [re.sub(r"\s+(?:C|[a-zA-Z]+(?:/[a-zA-Z]+|\^\{?-?\d\}?)*)$", "", body)]
    try:
        return [value(parse(x, pi=ROUGH_PI)) for x in items]
    except (Unreadable, RecursionError):
        return None


def numbers_agree(pred: str | None, gold: str | None, share: float = 0.01) -> bool | None:
    """Whether all numbers of a reply, in order of size, lie within a share of the gold ones; null where either is none."""
    if pred is None or gold is None:
        return None
    p, g = _numbers(_unboxed(pred)), _numbers(_unboxed(gold))
    if p is None or g is None:
        return None
    return len(p) == len(g) and all(y - abs(y) * share <= x <= y + abs(y) * share for x, y in zip(sorted(p), sorted(g), strict=True))


def number_score(pred: str | None, gold: str | None, share: float = 0.01) -> float:
    """1 or 0 by ``numbers_agree``, else by equal texts without spaces, hyphens, full stops and case."""
    agree = numbers_agree(pred, gold, share)
    if agree is None:
        bare = lambda s: re.sub(r"[ \-\n\t.]", "", s).lower()
        agree = pred is not None and gold is not None and bare(pred) == bare(gold)
    return float(agree)


def equal_answers(pred: Column, gold: Column, precision: float = 1e-8) -> Column:
    def run(p: pd.Series, g: pd.Series) -> pd.Series:
        return pd.Series([answers_equal(a, b, precision) for a, b in zip(p, g, strict=True)], dtype=bool)

    return F.pandas_udf(run, "boolean")(pred, gold)


def number_scores(pred: Column, gold: Column, share: float = 0.01) -> Column:
    def run(p: pd.Series, g: pd.Series) -> pd.Series:
        return pd.Series([number_score(a, b, share) for a, b in zip(p, g, strict=True)], dtype="float64")

    return F.pandas_udf(run, "double")(pred, gold)

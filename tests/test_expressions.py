"""Expressions by value, and numbers within a share."""

import math

import pytest

from minewright.functions import expressions as X


@pytest.mark.parametrize("text, want", [
    ("1+2*3", 7), ("-2^2", -4), ("2^{-1}", 0.5), ("2^3^2", 512), ("\\frac{1}{2}+\\frac12", 1), ("\\frac34x" "", None), ("3\\sqrt{2}", 3 * math.sqrt(2)), ("\\sqrt[3]{-8}", -2), ("5!", 120), ("50%", 0.5), ("1,234.5", 1234.5),
    ("2(3+4)", 14), ("|{-3}|", 3), ("\\sin^2(1)+\\cos^{2}(1)", 1), ("\\log_{2}8", 3), ("\\ln e", 1), ("2\\pi", 2 * math.pi), ("1.5e3", 1500), ("", None), ("1/0", None), ("2 +", None), ("import os", None), ("\\left(\\dfrac{1}{3}\\right)", 1 / 3), ("(-8)^{1/3}", None),
    ("10\\text{ cm}", 10), ("((((1))))", 1), ("(" * 5000, None), (".5", 0.5), ("4\\cdot 5\\div 2", 10), ("2\\times10^{3}", 2000),
])
def test_values(text, want):
    try:
        got = X.value(X.parse(text))
    except (X.Unreadable, RecursionError):
        got = None
    assert got == (None if want is None else pytest.approx(want))


@pytest.mark.parametrize("pred, gold, want", [
    ("\\frac{1}{2}", "0.5", True), ("$x = 3$", "3", True), ("\\boxed{\\frac{\\sqrt{3}}{3}}", "\\frac{1}{\\sqrt{3}}", True), ("1;2", "12", False), ("(x+1)^2", "x^2+2x+1", True), ("(x+1)^2", "x^2+x+1", False),
    ("(1,2]", "(1, \\frac{4}{2}]", True), ("(1,2)", "(1,2]", False), ("(-\\infty,1)\\cup(2,3)", "(-\\infty, 1) \\cup (2, 3)", True), ("1,2,3", "3,1,2", True), ("1,2", "1,1", False), ("1,1,2", "1,2,2", False), ("\\pm 2", "2,-2", True), ("2", "\\pm 2", False),
    ("2x+2y=4", "x+y=2", True), ("x+y=3", "x+y=2", False), ("y=2x+1", "2x-y+1=0", True), ("x=1", "y=1", False), ("x \\in [0,1]", "[0,1]", True), ("\\{1,2\\}", "\\{2,1\\}", True), ("60^\\circ", "60", True), ("1,000", "1000", True),
    ("no", "yes", False), (None, "1", False), ("", "", True), ("a\\;b", "ab", True), ("\\sqrt{x^2}", "x", True), ("0.3333", "1/3", False), ("0.33333333333", "1/3", True),
])
def test_answers(pred, gold, want):
    assert X.answers_equal(pred, gold) is want


@pytest.mark.parametrize("pred, gold, want", [
    ("x = 3.02", "3", 1.0), ("3.04", "3", 0.0), ("50%", "0.5", 1.0), ("\\boxed{12 cm}", "12", 1.0), ("$1,200", "1200", 1.0), ("[2, 1]", "[1, 2]", 1.0), ("[1]", "[1, 2]", 0.0), ("3\\pi", "9.42", 1.0), ("about a Dozen.", "about a dozen", 1.0), ("\\(\\frac{7}{2}\\)", "3.5", 1.0),
    (None, "1", 0.0), ("25 °C", "25", 1.0), ("9.8 m/s^2", "9.8", 1.0), ("-3", "-3.02", 1.0), ("nan", "1", 0.0), ("\\sqrt{2}", "1.41", 1.0), ("5 km/h", "5 m", 1.0),
])
def test_numbers(pred, gold, want):
    assert X.number_score(pred, gold) == want

"""Question-answer records from model replies, and back."""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

ITEM = "array<struct<question:string,question_images:array<string>,solution:string,solution_images:array<string>>>"
_QUESTION = re.compile(r"\*\*Question \d+:\*\*")
#: The section marks of a reply, and entries that stand for no image.
SECTIONS = {"**Images:**": "question_images", "**Solution:**": "solution", "**Images in Solution:**": "solution_images"}
PLACEHOLDERS = ["no images available", "not found", "none", "n/a", "[]"]


def parse_reply(text: str | None) -> list[dict]:
    """Items of a reply; a question without an ``**Images:**`` section is none, as the format has it."""
    items = []
    for part in _QUESTION.split(text or "")[1:]:
        found: dict[str, list[str]] = {"question": [], "question_images": [], "solution": [], "solution_images": []}
        section, closed = "question", False
        for line in part.split("\n"):
            mark = line.strip()
            if mark in SECTIONS:
                section = SECTIONS[mark]
                closed = closed or section == "question_images"
                if section == "solution":
                    found["solution"] = []
            elif section.endswith("images"):
                entry = mark.strip("* []")
                if mark.startswith("*") and entry and entry.lower() not in PLACEHOLDERS:
                    found[section].append(entry)
            elif mark:
                found[section].append(line.rstrip() if section == "solution" else mark)
        question = " ".join(found["question"])
        if closed and question and question.lower() != "not found":
            solution = "\n".join(found["solution"]) or "Not found"
            items.append({"question": question, "question_images": found["question_images"], "solution": solution, "solution_images": found["solution_images"]})
    return items


def parse_items(reply: Column) -> Column:
    @F.pandas_udf(ITEM)
    def parse(r: pd.Series) -> pd.Series:
        return pd.Series([parse_reply(x) for x in r])

    return parse(reply)


def _bullets(images: Column) -> Column:
    some = F.array_join(F.transform(images, lambda x: F.concat(F.lit("* ["), x, F.lit("]"))), "\n")
    return F.when(F.size(images) > 0, some).otherwise("* No images available")


def format_items(items: Column) -> Column:
    """The reply that ``parse_items`` reads."""
    one = lambda q, i: F.concat(
        F.lit("**Question "), (i + 1).cast("string"), F.lit(":**\n"), q["question"], F.lit("\n**Images:**\n"), _bullets(q["question_images"]),
        F.lit("\n**Solution:**\n"), q["solution"], F.lit("\n**Images in Solution:**\n"), _bullets(q["solution_images"]))
    return F.array_join(F.transform(items, one), "\n\n")


def _field(reply: Column, name: str) -> Column:
    """What follows a line's prefix, up to a second colon; empty if the line is missing."""
    line = F.try_element_at(F.filter(F.split(reply, "\n"), lambda x: F.startswith(F.trim(x), F.lit(name + ":"))), F.lit(1))
    return F.coalesce(F.trim(F.try_element_at(F.split(line, ":"), F.lit(2))), F.lit(""))


def _chosen(reply: Column, name: str, images: Column) -> Column:
    """Images by the reply's indices: under the size, negative ones from the end; none if any is no integer."""
    raw = F.filter(F.transform(F.split(F.regexp_replace(_field(reply, name), r"[\[\]]", ""), ","), lambda x: F.trim(x)), lambda x: x != "")
    index = F.transform(raw, lambda x: x.try_cast("int"))
    usable = F.filter(index, lambda i: (i < F.size(images)) & (i >= -F.size(images)))
    picked = F.transform(usable, lambda i: F.element_at(images, F.when(i >= 0, i + 1).otherwise(i)))
    return F.when(F.forall(index, lambda i: i.isNotNull()), picked).otherwise(F.array().cast("array<string>"))


def parse_filter_reply(reply: Column, question_images: Column, solution_images: Column) -> Column:
    """Validity and kept images of a checker's reply; without a verdict an item is invalid."""
    return F.struct(
        (F.lower(_field(reply, "QUESTION_VALID")) == "yes").alias("valid"),
        _chosen(reply, "QUESTION_IMAGES", question_images).alias("question_images"),
        _chosen(reply, "SOLUTION_IMAGES", solution_images).alias("solution_images"),
        _field(reply, "ANALYSIS").alias("analysis"),
    )


def parse_alignment(reply: Column) -> Column:
    """First line says yes or not, the second why."""
    lines = F.split(F.trim(reply), "\n")
    return F.struct(F.contains(F.lower(lines[0]), F.lit("yes")).alias("is_aligned"), F.coalesce(F.trim(F.try_element_at(lines, F.lit(2))), F.lit("")).alias("explanation"))

"""Names of files, folders and tasks, prompts and boxes; native columns."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F


def _unquoted(s: Column) -> Column:
    """Percent signs decoded; a text that does not decode stays."""
    return F.coalesce(F.try_url_decode(F.replace(s, F.lit("+"), F.lit("%2B"))), s)


def _clean(s: Column) -> Column:
    out = F.regexp_replace(s, r'[<>:"/\\|?*]', "_")
    return F.when(out == "", "image.jpg").otherwise(out)


def file_name_of_url(url: Column) -> Column:
    """The last part of a URL's path as a file name; without a dot the last earlier part that has one, else with ``.jpg`` added."""
    path = F.regexp_extract(url, r"(?s)^(?:[a-zA-Z][a-zA-Z0-9+.\-]*:)?(?://[^/?#]*)?([^?#;]*)", 1)
    parts = F.split(path, "/")
    name = _clean(_unquoted(F.try_element_at(parts, F.lit(-1))))
    dotted = F.filter(parts, lambda p: F.contains(p, F.lit(".")))
    earlier = F.try_element_at(dotted, F.lit(-1))
    return F.when(F.contains(name, F.lit(".")), name).when(earlier.isNotNull(), _clean(_unquoted(earlier))).otherwise(F.concat(name, F.lit(".jpg")))


def page_folder(path: Column) -> Column:
    """The folder of a page's file: the path without ``.json``."""
    return F.regexp_replace(path, r"\.json$", "")


def safe_name(name: Column) -> Column:
    """A model's name for a file system: runs of reserved characters become two underscores."""
    return F.regexp_replace(name, r'["<>:/|\\?*\[\]]+', "__")


def shortened(s: Column, most: int = 40) -> Column:
    """A long text as its two ends with dots between."""
    half = most // 2
    return F.when(F.length(s) > most, F.concat(F.substring(s, 1, half), F.lit("..."), F.substring(s, F.length(s) - half + 1, F.lit(half)))).otherwise(s)


def path_fits(path: Column, most: int = 255) -> Column:
    return F.length(path) < most


def rendered(template: str, **values: Column) -> Column:
    """A prompt from a template with ``{{ name }}`` places; a name without a value is an error, doubled braces only mark places."""
    out, at = [], 0
    for m in re.finditer(r"\{\{\s*(\w+)\s*\}\}", template):
        if m[1] not in values:
            raise KeyError(f"the template asks for {m[1]!r}")
        out += [F.lit(template[at : m.start()]), F.coalesce(values[m[1]].cast("string"), F.lit(""))]
        at = m.end()
    return F.concat(*out, F.lit(template[at:]))


def normalised_box(x: Column, y: Column, w: Column, h: Column, width: Column, height: Column) -> Column:
    """A box of corner and size as corners, in shares of its image."""
    return F.array(x / width, y / height, (x + w) / width, (y + h) / height)


def sentence_context(label: Column, first: Column, second: Column) -> Column:
    """A question of what comes next: the label, the first part, and the second with a capital."""
    return F.concat(label, F.lit(": "), first, F.lit(" "), F.concat(F.upper(F.substring(second, 1, 1)), F.lower(F.substring(second, F.lit(2), F.length(second)))))


def lettered(question: Column, choices: Column) -> Column:
    """A question with its options on lines of their own, each after its letter."""
    lines = F.transform(choices, lambda c, i: F.concat(F.char(65 + i), F.lit(". "), c))
    return F.concat(question, F.lit("\n"), F.array_join(lines, "\n"))

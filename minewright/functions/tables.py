"""Similarity of tables in markup: trees of rows and cells with spans, whose cells are renamed at the cost of their texts' distance."""

from __future__ import annotations

from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from minewright.functions.edits import edit_distance
from minewright.functions.trees import tree_distance

#: Elements that have no end.
_VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())


class _Reader(HTMLParser):
    """Keeps the first table that lies directly in a body: elements as ``[tag, attributes, children]``, text as strings."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.path: list[list] = []
        self.table: list | None = None

    def handle_starttag(self, tag, attrs):
        node = [tag, dict(attrs), []]
        if tag in ("td", "th", "tr"):  # one ends what is still open of its kind, but not beyond its own table
            inside = next((i for i in range(len(self.path) - 1, -1, -1) if self.path[i][0] == "table"), -1)
            ends = {"td", "th"} if tag != "tr" else {"tr", "td", "th"}
            for i in range(inside + 1, len(self.path)):
                if self.path[i][0] in ends:
                    del self.path[i:]
                    break
        if self.path:
            self.path[-1][2].append(node)
        if tag == "table" and self.table is None and self.path and self.path[-1][0] == "body":
            self.table = node
        if tag not in _VOID:
            self.path.append(node)

    def handle_endtag(self, tag):
        for i in range(len(self.path) - 1, -1, -1):
            if self.path[i][0] == tag:
                del self.path[i:]
                return

    def handle_data(self, data):
        if self.path:
            self.path[-1][2].append(data)


def _elements(node: list) -> int:
    """Elements below a node."""
    return sum(1 + _elements(c) for c in node[2] if isinstance(c, list))


def _tokens(node: list) -> list[str]:
    """A cell's characters, with the tags of what lies in it as one token each."""
    out: list[str] = []
    for c in node[2]:
        if isinstance(c, list):
            out += [f"<{c[0]}>", *_tokens(c), *([] if c[0] == "unk" else [f"</{c[0]}>"])]
        else:
            out += c
    return out


def _span(attrs: dict, name: str) -> int:
    value = (attrs.get(name) or "1").strip()
    return int(value) if value.isdigit() else 1


def _tree(node: list, structure_only: bool) -> tuple:
    tag, attrs, children = node
    if tag == "td":
        return (tag, _span(attrs, "colspan"), _span(attrs, "rowspan"), () if structure_only else tuple(_tokens(node))), []
    return (tag, None, None, ()), [_tree(c, structure_only) for c in children if isinstance(c, list)]


def _rename(a: tuple, b: tuple) -> float:
    if a[:3] != b[:3]:
        return 1.0
    return edit_distance(a[3], b[3]) / max(len(a[3]), len(b[3])) if a[3] or b[3] else 0.0


def table_similarity(pred: str | None, gold: str | None, structure_only: bool = False) -> float:
    """One less the tree edit distance of two tables over the larger one's elements; 0 where either markup has no table in its body."""
    tables = []
    for markup in (pred, gold):
        reader = _Reader()
        reader.feed(markup or "")
        reader.close()
        if reader.table is None:
            return 0.0
        tables.append(reader.table)
    size = max(map(_elements, tables))
    distance = tree_distance(*(_tree(t, structure_only) for t in tables), rename=_rename)
    return 1.0 - distance / size if size else 1.0


def table_scores(pred: Column, gold: Column, structure_only: bool = False) -> Column:
    def score(p: pd.Series, g: pd.Series) -> pd.Series:
        return pd.Series([table_similarity(a, b, structure_only) for a, b in zip(p, g, strict=True)], dtype="float64")

    return F.pandas_udf(score, "double")(pred, gold)


def table_markup(rows: Column) -> Column:
    """Markup of an array of rows, each an array of cell texts."""
    cells = lambda row: F.concat(F.lit("<tr>"), F.array_join(F.transform(row, lambda c: F.concat(F.lit("<td>"), c, F.lit("</td>"))), ""), F.lit("</tr>"))
    return F.concat(F.lit("<html><body><table>"), F.array_join(F.transform(rows, cells), ""), F.lit("</table></body></html>"))


def markdown_table_markup(text: Column) -> Column:
    """Markup of a pipe table: its second line goes, blank cells become a space, a fence around it goes, with letters of its name at either end."""
    bare = F.regexp_replace(F.regexp_replace(text, r"^[`markdown]+|[`markdown]+\z", ""), r"^\s+|\s+\z", "")
    lines = F.split(bare, "\n")
    kept = F.concat(F.slice(lines, 1, 1), F.slice(lines, F.lit(3), F.greatest(F.size(lines), F.lit(1))))
    cells = lambda line: F.split(F.regexp_replace(line, r"^\s+|\s+\z", ""), r"\|")
    inner = lambda line: F.slice(cells(line), F.lit(2), F.greatest(F.size(cells(line)) - 2, F.lit(0)))
    return table_markup(F.transform(kept, lambda line: F.transform(inner(line), lambda c: F.when(c.rlike("^ *$") & (F.length(c) > 0), " ").otherwise(F.trim(c)))))

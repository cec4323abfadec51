"""HTML into ordered text and image nodes, with the standard library's tokenizer in an Arrow-batched function."""

from __future__ import annotations

from html.parser import HTMLParser
from urllib.parse import urljoin

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Elements that hold no content, and the words that mark an element as none.
SKIPPED_TAGS = ["script", "style", "meta", "link", "noscript", "iframe", "header", "footer", "nav", "button", "input"]
NOISE_WORDS = ["navigation", "menu", "sidebar", "footer", "header", "cookie", "ad", "banner", "modal", "popup"]
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())

NODES = "array<struct<pos:int,type:string,content:string>>"


class _Nodes(HTMLParser):
    """Collects nodes of the kept part of a document, in order."""

    def __init__(self, base: str | None, keep_comments: bool):
        super().__init__(convert_charrefs=True)
        self.base, self.keep_comments = base, keep_comments
        self.found: list[tuple[str, str]] = []
        self.open: list[str] = []
        self.skip = 0  # depth of the skipped element in ``open``, 0 for none

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        given = {k: v or "" for k, v in attrs}
        if tag == "base" and self.base is None and given.get("href"):
            self.base = given["href"]
        if tag == "body":
            self.found.clear()
        if tag not in _VOID:
            self.open.append(tag)
        if self.skip:
            return
        classes, ident = given.get("class", "").lower().split(), given.get("id", "").lower()
        if tag in SKIPPED_TAGS or any(c in NOISE_WORDS for c in classes) or any(w in ident for w in NOISE_WORDS):
            if tag not in _VOID:
                self.skip = len(self.open)
        elif tag == "img" and given.get("src"):
            src = given["src"]
            if self.base and not src.startswith(("http://", "https://", "//")):
                src = urljoin(self.base, src)
            self.found.append(("image", f"[Image: {given.get('alt', '')}] Source: {src}"))

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in _VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag: str) -> None:
        if tag in self.open:
            while self.open.pop() != tag:
                pass
            if len(self.open) < self.skip:
                self.skip = 0

    def handle_data(self, data: str) -> None:
        if not self.skip and data.strip():
            self.found.append(("text", data.strip()))

    def handle_comment(self, data: str) -> None:
        if self.keep_comments:
            self.handle_data(data)


def page_nodes(html: str | None, url: str | None, keep_comments: bool) -> list[dict] | None:
    """Nodes of one page with neighbouring texts joined; None for a page without HTML."""
    if not html:
        return None
    parser = _Nodes("/".join(url.split("/")[:3]) if url and "://" in url else None, keep_comments)
    parser.feed(html)
    parser.close()
    merged: list[dict] = []
    for kind, content in parser.found:
        if kind == "text" and merged and merged[-1]["type"] == "text":
            merged[-1]["content"] += " " + content
        else:
            merged.append({"pos": len(merged), "type": kind, "content": content})
    return merged


def nodes(html: Column, url: Column, keep_comments: bool = True) -> Column:
    """Array of ``pos, type, content``; comments count as text where ``keep_comments``."""

    @F.pandas_udf(NODES)
    def parse(h: pd.Series, u: pd.Series) -> pd.Series:
        return pd.Series([page_nodes(a, b, keep_comments) for a, b in zip(h, u, strict=True)])

    return parse(html, url)


def _sources(n: Column) -> Column:
    images = F.filter(n, lambda x: x["type"] == "image")
    return F.transform(images, lambda x: F.regexp_extract(x["content"], r"Source:\s*(\S+)", 1))


def image_links(n: Column) -> Column:
    """Absolute image links in order, repeats kept."""
    return F.filter(_sources(n), lambda s: s.rlike("^(https?:)?//"))


def inline_images(n: Column) -> Column:
    return F.filter(_sources(n), lambda s: F.startswith(s, F.lit("data:image")))


def llm_document(n: Column) -> Column:
    """Nodes as one document for a model: texts as they are, images as elements."""

    def line(x: Column) -> Column:
        alt, src = F.trim(F.regexp_extract(x["content"], r"^\[Image: ([^\]]*)\]", 1)), F.regexp_extract(x["content"], r"Source:\s*(\S+)", 1)
        image = F.concat(F.lit("<image"), F.when(alt != "", F.concat(F.lit(" alt='"), alt, F.lit("'"))).otherwise(""), F.lit(" src='"), src, F.lit("'></image>"))
        return F.when(x["type"] == "text", x["content"]).otherwise(image)

    return F.concat(F.lit("<document>\n"), F.array_join(F.transform(n, line), "\n\n"), F.lit("\n</document>"))

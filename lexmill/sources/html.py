"""HTML of norms and rulings as structs: a standard-library parser in Arrow batches, and JVM tests."""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import vocab
from ..schemas import PARSED_NORM

_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
_NOISE = re.compile(vocab.INTERFACE_NOISE, re.IGNORECASE)
_NUMBER = re.compile(vocab.ARTICLE_NUMBER, re.IGNORECASE)
PAGES = 64


class Node:
    """An element with its attributes and children (nodes or strings)."""

    def __init__(self, tag: str, attrs: dict[str, str], parent: Node | None):
        self.tag, self.attrs, self.parent, self.children = tag, attrs, parent, []

    def walk(self) -> Iterator[Node]:
        stack = [c for c in reversed(self.children) if isinstance(c, Node)]
        while stack:
            node = stack.pop()
            yield node
            stack.extend(c for c in reversed(node.children) if isinstance(c, Node))

    def find_all(self, tag: str, cls: str | None = None, **attrs: str) -> list[Node]:
        """Descendants of a tag, with a class, with attributes that match patterns."""
        return [n for n in self.walk() if n.tag == tag and (cls is None or cls in n.attrs.get("class", "").split()) and all(re.search(p, n.attrs.get(k, "")) for k, p in attrs.items())]

    def find(self, tag: str, cls: str | None = None, **attrs: str) -> Node | None:
        return next(iter(self.find_all(tag, cls, **attrs)), None)

    def strings(self) -> Iterator[str]:
        stack = list(reversed(self.children))
        while stack:
            item = stack.pop()
            if isinstance(item, Node):
                stack.extend(reversed(item.children))
            else:
                yield item

    def text(self) -> str:
        """Stripped strings put together."""
        return "".join(s.strip() for s in self.strings())


class _Tree(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = self.at = Node("", {}, None)

    def handle_starttag(self, tag, attrs):
        node = Node(tag, {k: v or "" for k, v in attrs}, self.at)
        self.at.children.append(node)
        if tag not in _VOID:
            self.at = node

    def handle_startendtag(self, tag, attrs):
        self.at.children.append(Node(tag, {k: v or "" for k, v in attrs}, self.at))

    def handle_endtag(self, tag):
        node = self.at
        while node.parent is not None and node.tag != tag:
            node = node.parent
        if node.parent is not None:
            self.at = node.parent

    def handle_data(self, data):
        self.at.children.append(data)


def parse(html: str | None) -> Node:
    tree = _Tree()
    tree.feed(html or "")
    tree.close()
    return tree.root


def clean(text: str) -> str:
    """As ``functions.text.strip_noise``."""
    text = _NOISE.sub("", text)
    return re.sub(r"\n{3,}", "\n\n", re.sub(r"[ \t]+\n", "\n", text)).strip()


def number_of(text: str) -> str | None:
    m = _NUMBER.search(text)
    return None if not m else f"trans:{m[2]}" if m[1] else m[2] + (m[3] or "").lower()


def _kind(raw: str) -> tuple[str, bool]:
    key = re.sub(r"\s+", " ", raw.lower()).strip()
    found = vocab.AFFECTATIONS.get(key) or next((t for form, t in vocab.AFFECTATIONS.items() if key.startswith(form)), None)
    return found or vocab.UNKNOWN_AFFECTATION, found is not None


def _reference(li: Node) -> dict:
    """Type, linked document and context of one referencing list item."""
    span, link, whole = li.find("span"), li.find("a"), li.text()
    raw, href = span.text() if span else "", link.attrs.get("href", "") if link else ""
    ident, anchor = re.search(r"id=(\d+)", href), re.search(r"#ver_(\d+)", href)
    kind, mapped = _kind(raw)
    opened, closed = whole.find("("), whole.rfind(")")
    context = whole[opened : closed + 1] if opened >= 0 and closed >= 0 else None
    return {"raw": raw, "kind": kind, "mapped": mapped, "text": link.text() if link else "", "id": ident and ident[1], "anchor": anchor and f"ver_{anchor[1]}", "context": context}


def _incoming(root: Node, doc: str, section: str) -> list[dict]:
    box = root.find("div", id=f"^{re.escape(doc)}Resumen{section}$")
    top = box.find("ul", "resumenvigencias") if box else None
    out = []
    for group in [c for c in top.children if isinstance(c, Node) and c.tag == "li"] if top else []:
        bold = group.find("b")
        article = bold.text().rstrip(":") if bold else ""
        for r in map(_reference, group.find_all("li", "referencia")):
            out.append({"article_affected": article, "raw_type": r["raw"], "normalized_type": r["kind"], "mapped": r["mapped"], "source_text": r["text"], "source_suin_id": r["id"], "source_anchor": r["anchor"], "context": r["context"]})
    return out


def _versions(box: Node | None) -> list[dict]:
    out = []
    for v in box.find_all("div", style=r"background-color.*#E0E0E0") if box else []:
        date = v.find("font", color="#336600")
        span = date.text() if date else ""
        out.append({"text": "\n".join(t for t in (p.text() for p in v.find_all("p")) if t and t != span), "date_range": span})
    return out


def _layout(root: Node) -> tuple[list[tuple[str, Node]], dict[str, Node], dict[str, list[Node]], list[tuple[str, Node]]]:
    """One pass: (anchor, text block after it), earlier-version blocks, notes by anchor, outgoing blocks."""
    anchored, waiting, older, notes, outgoing = [], [], {}, {}, []
    for node in root.walk():
        if node.tag == "a" and re.match(r"ver_\d+", node.attrs.get("name", "")):
            waiting.append(node.attrs["name"].replace("ver_", ""))
        elif node.tag == "div" and (ident := node.attrs.get("id", "")):
            if re.search(r"toggle_\d+", ident):
                anchored += [(art, node) for art in waiting]
                waiting = []
            if m := re.search(r"^div(.*)leg_ant$", ident):
                older.setdefault(m[1], node)
            if m := re.search(r"NotasDestino(.*)$", ident):
                notes.setdefault(m[1], []).append(node)
            if m := re.search(r"NotasOrigen(\d+)", ident):
                outgoing.append((m[1], node))
    return anchored, older, notes, outgoing


def _article(art: str, div: Node, strong: Node, number: str, kind: str, meta: dict[str, str]) -> dict:
    em = div.find("em")
    title = em.text() if em else ""
    shown = [p.text() for p in div.find_all("p") if not (p.parent and p.parent.attrs.get("style", "").startswith("display: none"))]
    return {
        "art_id": art,
        "number": strong.text(),
        "number_normalized": number,
        "title": title.rstrip(".") if title and not title[0].isdigit() else None,
        "text": clean("\n\n".join(t for t in shown if t) or div.text()),
        "canonical_id": f"co:{kind}:{meta.get('numero', '').lower()}:{meta.get('anio', '')}:art:{number}",
    }


def _articles(root: Node, meta: dict[str, str]) -> list[dict]:
    """Articles in page order, the first of each number; outgoing references go to the article of their anchor."""
    anchored, older, notes, outgoing = _layout(root)
    kind = vocab.DOCUMENT_TYPES.get(meta.get("tipo", ""), meta.get("tipo", "").lower().replace(" ", "_"))
    out: dict[str, dict] = {}
    by_anchor: dict[str, str] = {}
    for art, div in anchored:
        strong = div.find("strong") if len("".join(div.strings()).strip()) >= 10 else None
        number = number_of(strong.text()) if strong else None
        if number is None:
            continue
        by_anchor[art] = number
        if number not in out:
            listed = [li.text() for d in notes.get(art, []) for li in d.find_all("li", "referencia")]
            out[number] = _article(art, div, strong, number, kind, meta) | {"notes": listed, "previous_versions": _versions(older.get(art)), "affects": {}}
    for art, div in outgoing:
        article = out.get(by_anchor.get(art, ""))
        for r in map(_reference, div.find_all("li", "referencia") if article else []):
            article["affects"].setdefault((r["kind"], r["text"]), {"normalized_type": r["kind"], "raw_type": r["raw"], "mapped": r["mapped"], "target_text": r["text"], "target_suin_id": r["id"], "target_anchor": r["anchor"], "context": r["context"]})
    return [a | {"affects": list(a["affects"].values())} for a in out.values()]


def parse_norm(html: str | None, doc: str) -> dict:
    """Metadata, table of contents, affectations and articles of a norm's page."""
    root = parse(html)
    meta = {s.attrs["field"]: s.text() for s in root.find_all("span") if "field" in s.attrs and s.text() not in ("", "NULL")}
    toc, box = [], root.find("div", id=f"^{re.escape(doc)}cuerpo-toc$")
    for li in box.find_all("li", "vinieta-toc") if box else []:
        link, span = li.find("a"), li.find("span")
        if link is None or span is None or not span.text():
            continue
        classes, href = span.attrs.get("class", "").split(), link.attrs.get("href", "")
        level = "division" if "toctext" in classes else "articulo" if "toctextart" in classes else "unknown"
        toc.append({"level": level, "text": span.text(), "anchor": href.split("#ver_")[-1] if "#ver_" in href else None})
    return {"suin_id": doc, "metadata": meta, "articles": _articles(root, meta), "modifications": _incoming(root, doc, "NotasVigencia"), "jurisprudence": _incoming(root, doc, "AfectacionesJurisp"), "toc": toc}


def parse_norms(pages: DataFrame, doc: str = "suin_id", html: str = "html") -> DataFrame:
    """Parsed norms of (doc, html); a page that cannot be parsed has empty lists and a parse_error."""
    schema = f"{PARSED_NORM}, parse_error STRING"

    def task(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = []
            for ident, page in zip(frame[doc], frame[html]):
                try:
                    rows.append(parse_norm(page, str(ident)) | {"parse_error": None})
                except Exception as e:  # one bad page must not stop the others; its error is kept
                    rows.append({"suin_id": str(ident), "metadata": {}, "articles": [], "modifications": [], "jurisprudence": [], "toc": [], "parse_error": repr(e)})
            yield pd.DataFrame(rows, columns=["suin_id", "metadata", "articles", "modifications", "jurisprudence", "toc", "parse_error"])

    return pages.select(doc, html).mapInPandas(task, schema)


def markdown(html: str | None) -> str:
    """Headings, paragraphs, list items and cells as markdown lines; all text if there are none."""
    root, out = parse(html), []
    for node in root.walk():
        if node.tag in ("script", "style"):
            node.children = []
    for node in root.walk():
        content = re.sub(r"\s+", " ", " ".join(node.strings())).strip() if node.tag in ("h1", "h2", "h3", "h4", "p", "li", "td") else ""
        if content:
            out.append("#" * int(node.tag[1]) + " " + content if node.tag[0] == "h" else content)
    text = "\n\n".join(out) if out else re.sub(r"\s+", " ", " ".join(root.strings())).strip()
    for node in root.walk():
        node.parent = None  # without circles a tree goes at once, not when the collector runs
    return text


def _markdown_all(html: pa.Array) -> pa.Array:
    """A few pages at a time are Python strings."""
    return pa.concat_arrays([pa.array([markdown(x) for x in html.slice(at, PAGES).to_pylist()], pa.string()) for at in range(0, max(len(html), 1), PAGES)])


def html_to_markdown(html: Column) -> Column:
    """``markdown`` of each page, in Arrow batches."""
    return F.arrow_udf(_markdown_all, "string")(html)


def needs_ocr(html: Column) -> Column:
    """A large page with little paragraph text, or scanned images with little text."""
    paragraphs = F.regexp_extract_all(html, F.lit(r"(?is)<p(?:\s[^>]*)?>(.*?)</p>"), 1)
    size = F.aggregate(F.transform(paragraphs, lambda p: F.length(F.trim(F.regexp_replace(p, "(?s)<[^>]*>", "")))), F.lit(0), lambda a, b: a + b)
    images = F.size(F.regexp_extract_all(html, F.lit(r"(?i)<img[^>]*src=[^>]*(?:\.tif|\.jpg|\.png|scan)"), 0))
    return ((F.length(html) > 10_000) & (size < 500)) | ((images > 2) & (size < 1000))

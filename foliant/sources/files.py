"""Texts of files: HTML, EPUB, plain text, and PDF as far as it stores text plainly."""

from __future__ import annotations

import io
import json
import re
import zipfile
import zlib
from collections.abc import Callable, Iterator
from html.parser import HTMLParser
from posixpath import dirname, join, normpath
from urllib.parse import unquote
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foliant.session import ship

SKIPPED = {"script", "style", "head", "template"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
BLOCKS = {"p", "div", "br", "li", "tr", "h1", "h2", "h3", "h4", "h5", "h6", "section", "article", "blockquote", "pre", "table", "ul", "ol"}


class TextNodes(HTMLParser):
    """The text nodes of a document in order, each with its steps: element children count 2, 4, ...; texts 1, 3, ..."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.nodes: list[tuple[str, tuple[int, ...]]] = []
        self._stack: list[list] = [["", 0]]  # name, number of element children so far

    def handle_starttag(self, tag, attrs):
        self._stack[-1][1] += 1
        if tag not in VOID:
            self._stack.append([tag, 0])

    def handle_startendtag(self, tag, attrs):
        self._stack[-1][1] += 1

    def handle_endtag(self, tag):
        for k in range(len(self._stack) - 1, 0, -1):
            if self._stack[k][0] == tag:
                del self._stack[k:]
                return

    def handle_data(self, data):
        if any(name in SKIPPED for name, _ in self._stack):
            return
        steps = tuple(2 * n for _, n in self._stack[:-1]) + (2 * self._stack[-1][1] + 1,)
        if self.nodes and self.nodes[-1][1] == steps:
            self.nodes[-1] = (self.nodes[-1][0] + data, steps)
        else:
            self.nodes.append((data, steps))

    def block(self) -> str:
        return self._stack[-1][0]


def text_nodes(html: str) -> list[tuple[str, tuple[int, ...]]]:
    parser = TextNodes()
    parser.feed(html)
    parser.close()
    return parser.nodes


def html_text(html: str) -> str:
    """Readable text: blocks on lines of their own, blanks collapsed."""
    spaced = re.sub(rf"(?i)<(/?)({'|'.join(sorted(BLOCKS, key=len, reverse=True))})\b", r"\n<\1\2", html)
    text = "".join(t for t, _ in text_nodes(spaced))
    return "\n".join(line for line in (re.sub(r"[ \t\r\f\v]+", " ", x).strip() for x in text.split("\n")) if line)


def cfi_steps(steps: tuple[int, ...], offset: int) -> str:
    return "/".join(["", *map(str, steps)]) + f":{offset}"


def cfi_range(start: tuple[tuple[int, ...], int], end: tuple[tuple[int, ...], int], spine: int = 0) -> str:
    """A range between two places in text nodes: the steps both share, then each one's own."""
    a, b = start[0], end[0]
    k = 0
    while k < min(len(a), len(b)) - 1 and a[k] == b[k]:
        k += 1
    shared = "".join(f"/{s}" for s in a[:k])
    return f"epubcfi(/6/{2 * (spine + 1)}!{shared},{cfi_steps(a[k:], start[1])},{cfi_steps(b[k:], end[1])})"


def locate(html: str, quotation: str) -> tuple[tuple[tuple[int, ...], int], tuple[tuple[int, ...], int]] | None:
    """Where a quotation begins and ends in the text nodes, blanks aside."""
    nodes = text_nodes(html)
    plain, places = [], []
    for n, (t, _) in enumerate(nodes):
        for k, c in enumerate(t):
            for low in c.lower() if not c.isspace() else "":  # a letter may have two in lower case
                plain.append(low)
                places.append((n, k))
    wanted = re.sub(r"\s+", "", quotation).lower()
    at = "".join(plain).find(wanted) if wanted else -1
    if at < 0:
        return None
    (n, k), (m, j) = places[at], places[at + len(wanted) - 1]
    return (nodes[n][1], k), (nodes[m][1], j + 1)


def epub_chapters(content: bytes) -> list[tuple[int, str, str]]:
    """(number, path, HTML) of the chapters in reading order."""
    local = lambda e: e.tag.rsplit("}", 1)[-1]
    with zipfile.ZipFile(io.BytesIO(content)) as book:
        names = set(book.namelist())
        container = ElementTree.fromstring(book.read("META-INF/container.xml"))
        package = next(e.get("full-path") for e in container.iter() if local(e) == "rootfile")
        opf = ElementTree.fromstring(book.read(package))
        paths = {e.get("id"): unquote(e.get("href") or "") for e in opf.iter() if local(e) == "item"}
        out = []
        for ref in (e for e in opf.iter() if local(e) == "itemref"):
            path = normpath(join(dirname(package), paths.get(ref.get("idref"), "")))
            if path in names:
                out.append((len(out), path, book.read(path).decode("utf-8", "replace")))
        return out


_SHOWN = re.compile(rb"\((?:\\.|[^()\\])*\)|<[0-9A-Fa-f\s]+>|T\*|T[dDJj]|'|\"|ET", re.DOTALL)


def pdf_text(content: bytes) -> str:
    """The text that a PDF's streams show in plain encodings; empty where fonts are encoded by themselves."""
    out = []
    for m in re.finditer(rb"stream\r?\n(.*?)\r?\nendstream", content, re.DOTALL):
        data = m.group(1)
        try:
            data = zlib.decompress(data)
        except zlib.error:
            pass
        if b"BT" not in data:
            continue
        for token in _SHOWN.findall(data):
            if token.startswith(b"("):
                raw = re.sub(rb"\\([nrtbf()\\])", lambda e: {b"n": b"\n", b"r": b"", b"t": b"\t", b"b": b"", b"f": b""}.get(e.group(1), e.group(1)), token[1:-1])
                out.append(raw.decode("latin-1"))
            elif token in (b"Td", b"TD", b"T*", b"'", b'"', b"ET"):
                out.append("\n")
    return re.sub(r"\n{2,}", "\n", "".join(out)).strip()


def extract(path: str, content: bytes, most_pages: int | None = None) -> str | None:
    """Text by suffix; None for kinds that hold none. A PDF is read up to ``most_pages``, where that is given."""
    low = path.lower()
    if low.endswith((".html", ".htm", ".xhtml")):
        return html_text(content.decode("utf-8", "replace"))
    if low.endswith(".epub"):
        return "\n\n".join(html_text(html) for _, _, html in epub_chapters(content))
    if low.endswith(".pdf"):
        return "\n".join(pdf_pages(content)[:most_pages])
    if low.endswith((".txt", ".md")):
        return content.decode("utf-8", "replace")
    return None


def markdown(path: str, content: bytes) -> str | None:
    """A file as markdown: HTML and EPUB with their headings, lists and emphasis, other kinds as their text."""
    low = path.lower()
    if low.endswith((".html", ".htm", ".xhtml")):
        return html_markdown(content.decode("utf-8", "replace"))
    if low.endswith(".epub"):
        return "\n\n".join(html_markdown(html) for _, _, html in epub_chapters(content))
    return extract(path, content)


def _binary(spark: SparkSession, folder: str, pattern: str) -> DataFrame:
    ship(spark)
    read = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", "true").load(folder)
    return read.select("path", "length", F.col("modificationTime").alias("modified"), "content")


def parsed(files: DataFrame, parse: Callable[[str, bytes], list[tuple]], columns: str) -> DataFrame:
    """(path, the given columns, error): the rows that ``parse`` gives for each file of (path, content). A file that can't be read
    gives one row with the reason in ``error``."""
    names = [c.split()[0] for c in columns.split(", ")]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for path, content in zip(pdf["path"], pdf["content"]):
                try:
                    rows += [(path, *r, None) for r in parse(path, content)]
                except Exception as e:
                    rows.append((path, *[None] * len(names), f"{type(e).__name__}: {e}"))
            if rows:
                yield pd.DataFrame(rows, columns=["path", *names, "error"])

    return files.select("path", "content").mapInPandas(run, f"path string, {columns}, error string")


def read_texts(spark: SparkSession, folder: str, pattern: str = "*", most_pages: int | None = None) -> DataFrame:
    """(path, length, modified, text, error) of the files below a folder; a file that cannot be read has a null text and says why."""
    files = _binary(spark, folder, pattern)
    texts = parsed(files, lambda path, content: [(extract(path, content, most_pages),)], "text string")
    return files.drop("content").join(texts, "path")


def chapters_of(files: DataFrame) -> DataFrame:
    """(path, chapter, name, text, error) of EPUB files (path, content), a row per chapter."""
    return parsed(files, lambda _, content: [(n, name, html_text(html)) for n, name, html in epub_chapters(content)], "chapter int, name string, text string")


def read_chapters(spark: SparkSession, folder: str) -> DataFrame:
    return chapters_of(_binary(spark, folder, "*.epub"))


def find_in_book(content: bytes, quotation: str, chapter: int | None = None) -> tuple[int, str, str] | None:
    """(chapter from 1, path, selector) of a quotation, in the given chapter first and then in the whole book; the selector is JSON of
    a fragment selector with the range of the place."""
    chapters = epub_chapters(content)
    order = sorted(chapters, key=lambda c: (c[0] + 1 != chapter, c[0]))
    for n, path, html in order:
        found = locate(html, quotation)
        if found:
            selector = {"type": "FragmentSelector", "conformsTo": "http://www.idpf.org/epub/linking/cfi/epub-cfi.html", "value": cfi_range(*found, n)}
            return n + 1, path, json.dumps(selector)
    return None


def html_markdown(html: str) -> str:
    """Headings, list items and emphasis as markdown; the rest as readable text."""
    x = re.sub(r"(?is)<h([1-6])\b[^>]*>(.*?)</h\1>", lambda m: f"\n<p>{'#' * int(m.group(1))} {m.group(2)}</p>\n", html)
    x = re.sub(r"(?is)<li\b[^>]*>", "<li>- ", x)
    x = re.sub(r"(?is)</?(?:b|strong)\b[^>]*>", "**", x)
    x = re.sub(r"(?is)</?(?:i|em)\b[^>]*>", "*", x)
    return html_text(x)


class PdfObjects:
    """The plainly stored objects of a PDF: pages in order, outline and annotations. Objects in compressed streams are not seen."""

    def __init__(self, content: bytes):
        self.objects = {int(m.group(1)): m.group(2) for m in re.finditer(rb"(?<!\d)(\d+) 0 obj(.*?)endobj", content, re.DOTALL)}
        root = next((self.link(b, b"Pages") for b in self.objects.values() if re.search(rb"/Type\s*/Catalog", b)), None)
        self.pages: list[int] = []
        stack, seen = [root] if root else [], set()
        while stack:
            at = stack.pop()
            if at in seen or at not in self.objects:
                continue
            seen.add(at)
            kids = re.search(rb"/Kids\s*\[(.*?)\]", self.objects[at], re.DOTALL)
            if kids:
                stack += [int(x) for x in re.findall(rb"(\d+) 0 R", kids.group(1))][::-1]
            else:
                self.pages.append(at)

    @staticmethod
    def link(body: bytes, name: bytes) -> int | None:
        m = re.search(rb"/" + name + rb"\s+(\d+) 0 R", body)
        return int(m.group(1)) if m else None

    @staticmethod
    def links(body: bytes, name: bytes) -> list[int]:
        m = re.search(rb"/" + name + rb"\s*(?:\[(.*?)\]|(\d+ 0 R))", body, re.DOTALL)
        return [int(x) for x in re.findall(rb"(\d+) 0 R", m.group(1) or m.group(2))] if m else []

    @staticmethod
    def text(body: bytes, name: bytes) -> str | None:
        m = re.search(rb"/" + name + rb"\s*\(((?:\\.|[^\\)])*)\)", body, re.DOTALL)
        return re.sub(rb"\\(.)", rb"\1", m.group(1)).decode("latin-1") if m else None

    def page_of(self, body: bytes) -> int | None:
        m = re.search(rb"/(?:Dest|D)\s*\[\s*(\d+) 0 R", body)
        return self.pages.index(int(m.group(1))) if m and int(m.group(1)) in self.pages else None


def pdf_pages(content: bytes) -> list[str]:
    """The texts of a PDF's pages in order; where its pages are not stored plainly, all it shows as one page."""
    own = PdfObjects(content)
    out = []
    for page in own.pages:
        streams = own.links(own.objects[page], b"Contents")
        out.append("\n".join(x for x in (pdf_text(own.objects.get(n, b"")) for n in streams) if x))
    if any(out):
        return out
    whole = pdf_text(content)
    return [whole] if whole else []


def pdf_outline(content: bytes) -> list[tuple[int, str, int | None]]:
    """(level, title, page from 1) of a PDF's outline, where its objects are stored plainly."""
    own = PdfObjects(content)
    root = next((own.link(b, b"Outlines") for b in own.objects.values() if re.search(rb"/Type\s*/Catalog", b)), None)
    out: list[tuple[int, str, int | None]] = []
    stack = [(own.link(own.objects.get(root, b""), b"First"), 1)] if root else []
    seen: set[int] = set()
    while stack:
        at, level = stack.pop()
        if at is None or at in seen or at not in own.objects:
            continue
        seen.add(at)
        body = own.objects[at]
        page = own.page_of(body)
        out.append((level, own.text(body, b"Title") or "", None if page is None else page + 1))
        stack.append((own.link(body, b"Next"), level))
        stack.append((own.link(body, b"First"), level + 1))
    return out


def pdf_annotations(content: bytes) -> list[tuple[int, str, str | None, list[float]]]:
    """(page from 0, kind, comment, rectangle) of a PDF's annotations in page order; links and pop-ups are none."""
    own = PdfObjects(content)
    out = []
    for n, page in enumerate(own.pages):
        for at in own.links(own.objects[page], b"Annots"):
            body = own.objects.get(at, b"")
            kind = re.search(rb"/Subtype\s*/(\w+)", body)
            rect = re.search(rb"/Rect\s*\[([-\d.\s]+)\]", body)
            if kind and kind.group(1) not in (b"Link", b"Popup"):
                out.append((n, kind.group(1).decode().lower(), own.text(body, b"Contents"), [float(x) for x in rect.group(1).split()] if rect else []))
    return out


def kind_of(content: bytes) -> str | None:
    """``pdf`` or ``epub`` by what a file begins with; None for others."""
    if content[:5] == b"%PDF-":
        return "pdf"
    return "epub" if content[:4] == b"PK\x03\x04" and b"application/epub+zip" in content[:200] else None


def outlines_of(files: DataFrame) -> DataFrame:
    """(path, no, level, title, page, error) of the outlines of PDF files (path, content)."""
    return parsed(files, lambda _, content: [(k, *row) for k, row in enumerate(pdf_outline(content))], "no int, level int, title string, page int")


def annotations_of(files: DataFrame) -> DataFrame:
    """(path, no, page_index, kind, comment, rect, error) of the annotations of PDF files (path, content)."""
    return parsed(files, lambda _, content: [(k, *row) for k, row in enumerate(pdf_annotations(content))], "no int, page_index int, kind string, comment string, rect array<double>")


def read_outlines(spark: SparkSession, folder: str) -> DataFrame:
    return outlines_of(_binary(spark, folder, "*.pdf"))


def read_annotations(spark: SparkSession, folder: str) -> DataFrame:
    return annotations_of(_binary(spark, folder, "*.pdf"))

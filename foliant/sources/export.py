"""Records written as files of their own: small PDF, EPUB, HTML and SQLite files as bytes, made on the executors."""

from __future__ import annotations

import io
import sqlite3
import zipfile
from html import escape


def _pdf_text(text: str) -> bytes:
    return b"(" + text.encode("latin-1").replace(b"\\", b"\\\\").replace(b"(", b"\\(").replace(b")", b"\\)") + b")"


def pdf_bytes(pages: list[str], outline: list[tuple[int, str, int]] = (), annotations: list[tuple[int, str, str, list[float]]] = ()) -> bytes:
    """A PDF of Latin-1 texts, a page each. ``outline``: (level 1 or 2, title, page from 1); ``annotations``: (page from 0, kind, comment, rectangle)."""
    objects: dict[int, bytes] = {}
    first_page = 3
    page_at = [first_page + 2 * n for n in range(len(pages))]
    free = first_page + 2 * len(pages)
    notes: dict[int, list[int]] = {}
    for page, kind, comment, rect in annotations:
        objects[free] = b"<< /Type /Annot /Subtype /%s /Rect [%s] /Contents %s >>" % (kind.capitalize().encode(), " ".join(map(repr, rect)).encode(), _pdf_text(comment))
        notes.setdefault(page, []).append(free)
        free += 1
    for n, text in enumerate(pages):
        marks = b" /Annots [" + b" ".join(b"%d 0 R" % k for k in notes[n]) + b"]" if n in notes else b""
        objects[page_at[n]] = b"<< /Type /Page /Parent 2 0 R /Contents %d 0 R%s >>" % (page_at[n] + 1, marks)
        shown = b"BT /F1 12 Tf 72 720 Td " + _pdf_text(text) + b" Tj ET"
        objects[page_at[n] + 1] = b"<< /Length %d >>\nstream\n%s\nendstream" % (len(shown), shown)
    objects[2] = b"<< /Type /Pages /Count %d /Kids [%s] >>" % (len(pages), b" ".join(b"%d 0 R" % k for k in page_at))
    catalog = b"<< /Type /Catalog /Pages 2 0 R"
    if outline:
        root, free = free, free + 1
        at = [free + k for k in range(len(outline))]
        tops = [k for k, (level, _, _) in enumerate(outline) if level == 1]
        objects[root] = b"<< /Type /Outlines /First %d 0 R >>" % at[0]
        for k, (level, title, page) in enumerate(outline):
            later = [j for j in tops if j > k] if level == 1 else [k + 1] if k + 1 < len(outline) and outline[k + 1][0] == 2 else []
            parts = [b"/Title " + _pdf_text(title), b"/Dest [%d 0 R /Fit]" % page_at[page - 1]]
            parts += [b"/Next %d 0 R" % at[later[0]]] if later else []
            parts += [b"/First %d 0 R" % at[k + 1]] if level == 1 and k + 1 < len(outline) and outline[k + 1][0] == 2 else []
            objects[at[k]] = b"<< " + b" ".join(parts) + b" >>"
        catalog += b" /Outlines %d 0 R" % root
    objects[1] = catalog + b" >>"
    return b"%PDF-1.4\n" + b"\n".join(b"%d 0 obj\n%s\nendobj" % (k, objects[k]) for k in sorted(objects)) + b"\n%%EOF\n"


def html_page(heading: str, paragraphs: list[str]) -> str:
    return f"<html><body><h1>{escape(heading)}</h1>{''.join(f'<p>{escape(p)}</p>' for p in paragraphs)}</body></html>"


def epub_bytes(chapters: list[str]) -> bytes:
    """An EPUB of the given HTML chapters, in their order."""
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as book:
        book.writestr("mimetype", "application/epub+zip")
        book.writestr("META-INF/container.xml", '<container xmlns="urn:oasis:names:tc:opendocument:xmlns:container"><rootfiles><rootfile full-path="book/package.opf"/></rootfiles></container>')
        listed = "".join(f'<item id="c{k}" href="part%20{k}.xhtml"/>' for k in range(len(chapters)))
        spine = "".join(f'<itemref idref="c{k}"/>' for k in range(len(chapters)))
        book.writestr("book/package.opf", f'<package xmlns="http://www.idpf.org/2007/opf"><manifest>{listed}</manifest><spine>{spine}</spine></package>')
        for k, html in enumerate(chapters):
            book.writestr(f"book/part {k}.xhtml", html)
    return out.getvalue()


def sqlite_bytes(table: str, columns: str, rows: list[tuple]) -> bytes:
    """A database with one table, as the bytes of its file."""
    db = sqlite3.connect(":memory:")
    try:
        db.execute(f'CREATE TABLE "{table}" ({columns})')
        db.executemany(f'INSERT INTO "{table}" VALUES ({", ".join("?" * len(columns.split(",")))})', rows)
        db.commit()
        return db.serialize()
    finally:
        db.close()

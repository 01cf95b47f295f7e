"""Text extraction by content type: HTML, DOCX and plain text with the standard library, PDF where pdfplumber is.

One Arrow-batched map over the documents. A document that fails gives its error, and never stops the others.
"""

from __future__ import annotations

import io
import re
import zipfile
from html.parser import HTMLParser
from xml.etree import ElementTree

import pyarrow as pa
from pyspark.sql import DataFrame

SCHEMA = "key string, text string, chars long, error string"
_W = "{http://schemas.openxmlformats.org/wordprocessingml/2006/main}"
_BLOCKS = {"p", "div", "li", "h1", "h2", "h3", "h4", "h5", "h6", "br", "ul", "ol", "table", "section", "article", "title"}
_SKIPPED = {"script", "style", "nav", "head"}


def pipe_row(cells: list[str | None]) -> str | None:
    texts = [(c or "").replace("\n", " ").strip() for c in cells]
    return "| " + " | ".join(texts) + " |" if any(texts) else None


class _Page(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.parts: list[str] = []
        self.skipped = 0
        self.row: list[str] | None = None
        self.cell: list[str] | None = None

    def handle_starttag(self, tag, attrs):
        if tag in _SKIPPED:
            self.skipped += 1
        elif tag == "tr":
            self.row = []
        elif tag in ("td", "th") and self.row is not None:
            self.cell = []
        elif tag in _BLOCKS:
            self.parts.append("\n")

    def handle_endtag(self, tag):
        if tag in _SKIPPED:
            self.skipped = max(0, self.skipped - 1)
        elif tag in ("td", "th") and self.cell is not None:
            self.row.append("".join(self.cell))
            self.cell = None
        elif tag == "tr" and self.row is not None:
            self.parts.append("\n" + (pipe_row(self.row) or "") + "\n")
            self.row = None
        elif tag in _BLOCKS:
            self.parts.append("\n")

    def handle_data(self, data):
        if not self.skipped:
            (self.parts if self.cell is None else self.cell).append(data)


def html_text(content: bytes) -> str:
    page = _Page()
    page.feed(content.decode("utf-8", "replace"))
    page.close()
    lines = (re.sub(r"[ \t]+", " ", x).strip() for x in "".join(page.parts).split("\n"))
    return "\n".join(x for x in lines if x)


def docx_text(content: bytes) -> str:
    """Paragraphs outside tables, then tables as pipe rows."""
    body = ElementTree.fromstring(zipfile.ZipFile(io.BytesIO(content)).read("word/document.xml")).find(f"{_W}body")
    text = lambda node: "".join(t.text or "" for t in node.iter(f"{_W}t"))
    paragraphs = [p for p in (text(x).strip() for x in body.findall(f"{_W}p")) if p]
    rows = [pipe_row([text(c) for c in r.findall(f"{_W}tc")]) for t in body.iter(f"{_W}tbl") for r in t.findall(f"{_W}tr")]
    rows = [r for r in rows if r]
    out = (["--- Document Text ---", *paragraphs] if paragraphs else []) + (["--- Document Tables ---", *rows] if rows else [])
    return "\n".join(out).strip()


def pdf_text(content: bytes) -> str:
    import pdfplumber  # optional; its absence is this document's error

    out = []
    with pdfplumber.open(io.BytesIO(content)) as pdf:
        for n, page in enumerate(pdf.pages, 1):
            rows = [pipe_row(r) for t in page.extract_tables() for r in t]
            rows = [r for r in rows if r]
            if rows:
                out += [f"--- Page {n} Tables ---", *rows]
            out.append(page.extract_text() or "")
    return "\n".join(out).strip()


EXTRACTORS = {
    "text/html": html_text,
    "text/plain": lambda content: content.decode("utf-8", "replace"),
    "application/pdf": pdf_text,
    "application/vnd.openxmlformats-officedocument.wordprocessingml.document": docx_text,
}


def extract_one(content_type: str | None, content: bytes | None) -> tuple[str | None, str | None]:
    """Text and error of one document; exactly one of them is given."""
    try:
        if content_type not in EXTRACTORS:
            raise ValueError(f"unsupported content type {content_type}")
        return EXTRACTORS[content_type](content or b""), None
    except Exception as error:
        return None, f"{type(error).__name__}: {error}"[:300]


def _extractor(batches):
    for whole in batches:
        for at in range(0, whole.num_rows, 64):
            batch = whole.slice(at, 64)
            found = [extract_one(k, c) for k, c in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([t for t, _ in found], pa.string()), pa.array([None if t is None else len(t) for t, _ in found], pa.int64()), pa.array([e for _, e in found], pa.string())],
                names=["key", "text", "chars", "error"],
            )


def extract(documents: DataFrame) -> DataFrame:
    """``documents``: key, content_type, content. Gives key, text, chars, error."""
    from ..workers import ship

    ship(documents.sparkSession)
    return documents.select("key", "content_type", "content").mapInArrow(_extractor, SCHEMA)

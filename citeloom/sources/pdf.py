"""Positioned words of PDF files as a Python data source, where a PDF library is installed.

One partition per file. The footer band is dropped inside the reader if the option ``footer`` is ``drop``.
"""

from __future__ import annotations

from itertools import groupby

from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

WORDS = "doc_id string, pdf_index int, seq int, text string, x0 double, x1 double, top double, bottom double, size double, font string"


def available() -> bool:
    try:
        import pymupdf  # noqa: F401
    except ImportError:
        return False
    return True


class PdfWords(DataSource):
    """``spark.dataSource.register(PdfWords)``, then ``spark.read.format("pdf_words").option("path", ...)``."""

    @classmethod
    def name(cls) -> str:
        return "pdf_words"

    def schema(self) -> str:
        return WORDS

    def reader(self, schema):
        return _Reader(self.options)


class _Reader(DataSourceReader):
    def __init__(self, options):
        self.paths = [p for p in options["path"].split(",") if p]
        self.drop_footer = options.get("footer", "drop") == "drop"

    def partitions(self):
        return [InputPartition(p) for p in self.paths]

    def read(self, partition):
        import pymupdf

        with pymupdf.open(partition.value) as doc:
            for index, page in enumerate(doc):
                limit = page.rect.height - 30 if self.drop_footer else float("inf")
                spans = (s for b in page.get_text("rawdict")["blocks"] for line in b.get("lines", []) for s in line["spans"])
                for seq, word in enumerate(w for s in spans for w in span_words(s) if w[3] <= limit):
                    yield (partition.value, index, seq, *word)


def span_words(span: dict) -> list[tuple]:
    """The words of a span with the exact box of their characters: ``text, x0, x1, top, bottom, size, font``. Blanks and
    characters without a shape (icons come as control characters) part words; the font is what follows the last hyphen."""
    font = span["font"].rpartition("-")[2]
    runs = groupby(span["chars"], key=lambda c: c["c"].isprintable() and not c["c"].isspace())
    out = []
    for shown, chars in runs:
        if shown:
            text, boxes = zip(*((c["c"], c["bbox"]) for c in chars))
            left, top, right, bottom = zip(*boxes)
            out.append(("".join(text), min(left), max(right), min(top), max(bottom), float(span["size"]), font))
    return out

"""Layout spans and texts of PDF files, by the PyMuPDF library where it is installed.

Files are read by Spark as binary rows, so they may lie in any store; the library sees bytes only.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SCHEMA = "doc string, page int, block int, line int, span int, size double, x0 double, text string"


def spans_of_page(tree: dict) -> Iterator[tuple]:
    """``block, line, span, size, x0, text`` of one page's layout tree; what is missing counts as empty."""
    for b, block in enumerate(tree.get("blocks", [])):
        for n, line in enumerate(block.get("lines", [])):
            for s, span in enumerate(line.get("spans", [])):
                yield b, n, s, float(span["size"]), float(line["bbox"][0]), span.get("text", "")


def _opened(content: bytes):
    try:
        import fitz
    except ImportError as e:
        raise RuntimeError("reading PDF files needs the PyMuPDF library") from e
    return fitz.open(stream=content, filetype="pdf")


def _files(spark: SparkSession, path: str) -> DataFrame:
    rows = spark.read.format("binaryFile").option("pathGlobFilter", "*.pdf").load(path)
    return rows.select(F.substring_index("path", "/", -1).alias("doc"), "content")


def _by_page(rows: Callable[[object], Iterator[tuple]], schema: str, opened: Callable[[bytes], object]):
    names = [c.split()[0] for c in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for doc, content in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                with opened(content.as_py()) as file:
                    for number, page in enumerate(file):
                        found = [(doc, number, *r) for r in rows(page)]
                        if found:
                            yield pa.RecordBatch.from_pylist([dict(zip(names, r, strict=True)) for r in found])

    return run


def _cast(df: DataFrame, schema: str) -> DataFrame:
    kinds = [c.split() for c in schema.split(", ")]
    return df.select(*[F.col(n).cast(k) for n, k in kinds])


def pdf_spans(spark: SparkSession, path: str, opened: Callable[[bytes], object] = _opened) -> DataFrame:
    """Layout spans of all PDF files of a folder.  ``opened`` makes pages of a file's bytes."""
    wide = SCHEMA.replace(" int", " bigint")
    return _cast(_files(spark, path).mapInArrow(_by_page(lambda page: spans_of_page(page.get_text("dict")), wide, opened), wide), SCHEMA)


def pdf_texts(spark: SparkSession, path: str, opened: Callable[[bytes], object] = _opened) -> DataFrame:
    """``doc, text``: the plain texts of the pages, one below the other."""
    schema = "doc string, page bigint, text string"
    pages = _files(spark, path).mapInArrow(_by_page(lambda page: iter([(page.get_text(),)]), schema, opened), schema)
    ordered = F.array_sort(F.collect_list(F.struct("page", "text")))
    return pages.groupBy("doc").agg(F.array_join(F.transform(ordered, lambda p: p["text"]), "\n").alias("text"))


def plain_text(spans: DataFrame) -> DataFrame:
    """``doc, text``: all lines of all pages in reading order, one below the other."""
    lines = spans.groupBy("doc", "page", "block", "line").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("span", "text"))), lambda s: s["text"]), "").alias("text"))
    ordered = F.array_sort(F.collect_list(F.struct("page", "block", "line", "text")))
    return lines.groupBy("doc").agg(F.array_join(F.transform(ordered, lambda s: s["text"]), "\n").alias("text"))

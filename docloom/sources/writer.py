"""Writing documents: rows, objects, paragraphs or text to bytes, and files with a receipt."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from docloom.codec import DocumentError, csvtext, docx, pdf_write, xlsx


def text_paragraphs(paragraphs: list[str] | None, content: str | None) -> list[str]:
    """Paragraphs as given, or the lines of content that aren't blank."""
    return list(paragraphs) if paragraphs is not None else [p for p in re.split(r"\r?\n", content or "") if p.strip(xlsx.SPACE)]


def build(form: str, rows=None, data=None, paragraphs=None, content=None, title=None, sheet=None, fonts=(), facts=None) -> bytes:
    """A document's bytes. Tables take rows before data before content; texts take paragraphs before content."""
    if form == "csv":
        if rows is not None or data is not None:
            return csvtext.render(rows if rows is not None else csvtext.object_rows(data)).encode()
        if content is None:
            raise DocumentError("a CSV document needs rows, data or content")
        return content.encode()
    if form == "xlsx":
        if rows is None and data is None:
            raise DocumentError("an XLSX document needs rows or data")
        return xlsx.write_xlsx(rows if rows is not None else csvtext.object_rows(data), sheet)
    if form == "docx":
        return docx.write_docx(text_paragraphs(paragraphs if paragraphs is not None else ["\t".join(map(csvtext.number_text, r)) for r in rows] if rows is not None else None, content), title)
    if form == "pdf":
        return pdf_write.write_pdf(title, text_paragraphs(paragraphs, content) if paragraphs is not None or content is not None else [], rows or [], fonts, facts=facts)
    raise DocumentError("unknown format; supported: pdf, docx, xlsx, csv")


def write_bytes(spark: SparkSession, path: str, data: bytes) -> int:
    """One file through Hadoop's file systems; folders are made, an old file goes."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    out = target.getFileSystem(spark._jsc.hadoopConfiguration()).create(target, True)
    try:
        out.write(bytearray(data))
    finally:
        out.close()
    return len(data)


def write_document(spark: SparkSession, path: str, form: str, **content) -> DataFrame:
    """Writes one document and returns a receipt row: path, format, bytes, items, of PDFs pages, font and characters missing in it, error. Nothing is written on an error."""
    if not path.strip():
        raise ValueError("a path is needed")
    facts: dict = {}
    try:
        data, error = build(form, **content, facts=facts), None
        size = write_bytes(spark, path, data)
    except DocumentError as e:
        size, error = None, str(e)
    items = next((len(content[k]) for k in ("rows", "data", "paragraphs") if content.get(k) is not None), None)
    row = (path, form, size, items, facts.get("pages"), facts.get("font"), facts.get("missing"), error)
    return spark.createDataFrame([row], "path string, format string, bytes bigint, items bigint, pages int, font string, missing int, error string")

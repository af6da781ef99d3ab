"""Reading documents: bounded bytes in, result rows out; failures are values."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docloom.codec import DocumentError, csvtext, docx, pdf_read, xlsx
from docloom.functions.columns import MAX_CHARS, NOTICE, detect_format

MAX_BYTES = 64 << 20
SCHEMA = "path string, format string, content string, total_lines bigint, pages int, truncated boolean, warnings array<string>, error string"


def document_lines(data: bytes, form: str) -> list[str]:
    """Lines of a table document: tab-joined records, or marked sheets."""
    if form == "csv":
        return ["\t".join(r) for r in csvtext.parse_rows(csvtext.decode_bytes(data))]
    return xlsx.sheet_lines(xlsx.read_xlsx(data))


def window(lines: list[str], offset: int, limit: int | None) -> tuple[str, int, bool]:
    start, n = max(0, offset - 1), len(lines)
    end = n if limit is None else min(n, start + limit)
    return "\n".join(lines[start:end]), n, end < n


def read_one(data: bytes, form: str, offset: int = 1, limit: int | None = None, max_chars: int = MAX_CHARS) -> dict:
    """content, total_lines, pages, truncated, warnings, error of one document."""
    out = dict.fromkeys(("content", "total_lines", "pages", "error")) | {"truncated": False, "warnings": []}
    try:
        if form in ("csv", "xlsx"):
            out["content"], out["total_lines"], out["truncated"] = window(document_lines(data, form), offset, limit)
        elif form == "docx":
            out["content"] = docx.read_docx(data)
            out["total_lines"] = out["content"].count("\n") + 1
        elif form == "pdf":
            out["content"], out["pages"], cut = pdf_read.read_pdf(data)
            out["total_lines"] = out["content"].count("\n") + 1
            if cut:
                out["warnings"] = ["the document goes on after the limits"]
        else:
            raise DocumentError("unknown format; supported: pdf, docx, xlsx, csv")
        if len(out["content"]) > max_chars // 2 and len(units := out["content"].encode("utf-16-be", "surrogatepass")) > 2 * max_chars:
            out["content"], out["truncated"] = units[: 2 * max_chars].decode("utf-16-be", "ignore") + NOTICE, True
    except Exception as e:
        out = dict.fromkeys(out) | {"truncated": False, "warnings": [], "error": error_text(e)}
    return out


def error_text(e: Exception) -> str:
    """Whatever a parser meets is an error of the document."""
    return str(e) if isinstance(e, DocumentError) else f"malformed document: {type(e).__name__}: {e}"


def lines_of_document(data: bytes, form: str) -> tuple[list[str], str | None]:
    """All lines of one document, or its error."""
    if form in ("csv", "xlsx"):
        try:
            return document_lines(data, form), None
        except Exception as e:
            return [], error_text(e)
    got = read_one(data, form, max_chars=1 << 31)
    return ([], got["error"]) if got["error"] else (got["content"].split("\n"), None)


def parse_documents(files: DataFrame, form: str = "auto", offset: int = 1, limit: int | None = None, max_bytes: int = MAX_BYTES, mode: str = "PERMISSIVE") -> DataFrame:
    """files (path, length, content) to result rows; FAILFAST raises on the first error."""
    kind = detect_format(F.col("path")) if form == "auto" else F.lit(form)
    # Two branches: the filter on length reaches the scan, so bytes of too long files are never read.
    ready = files.where(F.col("length") <= max_bytes).select("path", kind.alias("format"), "content")
    over = files.where(F.col("length") > max_bytes).select("path", kind.alias("format"), "length")

    def run(batches):
        import pandas as pd

        for batch in batches:
            rows = []
            for path, kind, data in zip(batch["path"], batch["format"], batch["content"]):
                got = read_one(bytes(data), kind, offset, limit)
                if got["error"] and mode == "FAILFAST":
                    raise DocumentError(f"{path}: {got['error']}")
                rows.append({"path": path, "format": kind} | got)
            yield pd.DataFrame(rows, columns=["path", "format", "content", "total_lines", "pages", "truncated", "warnings", "error"], dtype=object)

    error = F.concat(F.lit("the file has "), F.col("length").cast("string"), F.lit(f" bytes, more than {max_bytes}"))
    if mode == "FAILFAST":
        error = F.raise_error(F.concat("path", F.lit(": "), error))
    empty = {"content": "string", "total_lines": "bigint", "pages": "int"}
    over = over.select("path", "format", *[F.lit(None).cast(t).alias(c) for c, t in empty.items()], F.lit(False).alias("truncated"), F.array().cast("array<string>").alias("warnings"), error.cast("string").alias("error"))
    return ready.mapInPandas(run, SCHEMA).unionByName(over)


def read_document(spark: SparkSession, path: str, form: str = "auto", offset: int = 1, limit: int | None = None, max_bytes: int = MAX_BYTES, mode: str = "PERMISSIVE") -> DataFrame:
    """Result rows of one file, a folder or a glob. A file is one row: path, format, content, total_lines, pages, truncated, warnings, error."""
    if not path.strip():
        raise ValueError("a path is needed")
    return parse_documents(spark.read.format("binaryFile").load(path), form, offset, limit, max_bytes, mode)


def read_lines(spark: SparkSession, path: str, form: str = "auto", max_bytes: int = MAX_BYTES, mode: str = "PERMISSIVE") -> DataFrame:
    """Lines of documents: path, line_no, line, error. A document that can't be read is one row with its error; FAILFAST raises it."""
    files = spark.read.format("binaryFile").load(path)
    kind = detect_format(F.col("path")) if form == "auto" else F.lit(form)

    def run(batches):
        import pandas as pd

        for batch in batches:
            for path, kind, data in zip(batch["path"], batch["format"], batch["content"]):
                lines, error = lines_of_document(bytes(data), kind)
                if error and mode == "FAILFAST":
                    raise DocumentError(f"{path}: {error}")
                if error:
                    yield pd.DataFrame([(path, None, None, error)], columns=["path", "line_no", "line", "error"], dtype=object)
                else:
                    yield pd.DataFrame({"path": path, "line_no": range(1, len(lines) + 1), "line": lines, "error": None})

    schema = "path string, line_no bigint, line string, error string"
    read = files.where(F.col("length") <= max_bytes).select("path", kind.alias("format"), "content").mapInPandas(run, schema)
    error = F.concat(F.lit("the file has "), F.col("length").cast("string"), F.lit(f" bytes, more than {max_bytes}"))
    if mode == "FAILFAST":
        error = F.raise_error(F.concat("path", F.lit(": "), error))
    over = files.where(F.col("length") > max_bytes).select("path", F.lit(None).cast("bigint").alias("line_no"), F.lit(None).cast("string").alias("line"), error.cast("string").alias("error"))
    return read.unionByName(over)

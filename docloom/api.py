"""The public surface."""

from docloom.session import ship
from docloom.sources.reader import parse_documents, read_document, read_lines
from docloom.sources.writer import build, write_document
from docloom.streaming.ingest import stream_documents

__all__ = ["build", "parse_documents", "read_document", "read_lines", "ship", "stream_documents", "write_document"]

"""Token counts by offset-mapped attribution: whole documents are encoded once, tokens go to lines by their character spans."""

from __future__ import annotations

import base64
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .bytetext import tidy
from .store import bounded_batches

# Fixed value: how byte-level BPE of this vocabulary cuts a text before it merges bytes.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: White space runs from this length on are cut out beforehand: the pattern's backtracking would overflow in them.
RUN = 1 << 16
_LONG_RUN = re.compile(r"[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]{%d,}" % RUN)
_encoders: dict[str, "Encoder"] = {}


class Encoder:
    """Byte-level BPE from a file of ranks, and the bytes that each token stands for."""

    def __init__(self, ranks: str, pattern: str = PATTERN):
        import tiktoken

        with open(ranks, "rb") as f:
            table = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
        self.bpe = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=table, special_tokens={})
        self.length = np.zeros(max(table.values()) + 1, np.int64)
        self.length[list(table.values())] = list(map(len, table))

    def ids(self, text: str) -> np.ndarray:
        """The tokens of the whole text. A long run of white space is one piece, but for its last character if text follows."""
        parts, at = [], 0
        for run in _LONG_RUN.finditer(text) if len(text) >= RUN else ():
            end = run.end() - (run.end() < len(text))
            parts += [self.bpe.encode_to_numpy(text[at : run.start()], disallowed_special=()), np.array(self.bpe._encode_single_piece(text[run.start() : end]), np.uint32)]
            at = end
        parts.append(self.bpe.encode_to_numpy(text[at:], disallowed_special=()))
        return np.concatenate(parts)

    def starts(self, text: str) -> np.ndarray:
        """The character at which each token of the whole text starts; a token inside a character starts at it."""
        ids = self.ids(text)
        ends = np.cumsum(self.length[ids])
        raw = np.frombuffer(text.encode(), np.uint8)
        char = np.cumsum((raw & 0xC0) != 0x80) - 1
        return char[ends - self.length[ids]]


def line_counts(text: str, starts: np.ndarray) -> np.ndarray:
    """Tokens of each line. A token that crosses a boundary belongs to the line of its first character; a line owns its line end."""
    lines = np.r_[0, np.flatnonzero(np.frombuffer(text.encode("utf-32-le"), np.uint32) == 10) + 1]
    return np.bincount(np.searchsorted(lines, starts, "right") - 1, minlength=len(lines))


def count(docs: DataFrame, ranks: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_tokens, n_sections, line_tokens array<bigint> of each whole text; rows stay one to one.

    A null or empty text has one line without tokens, a text that ends in a line end a last line
    without tokens. Repeated rows and null ids are counted like any other; the strings of special
    tokens are ordinary text; other columns are not read. Empty tables give empty tables.
    """

    bounded_batches(docs.sparkSession)

    @tidy
    def run(batches):
        if ranks not in _encoders:
            _encoders[ranks] = Encoder(ranks)
        encoder = _encoders[ranks]
        for batch in batches:
            rows = []
            for v in batch.column(1):
                text = v.as_py() or ""
                rows.append(line_counts(text, encoder.starts(text)))
            n_tokens, n_lines = [int(r.sum()) for r in rows], list(map(len, rows))
            offsets = pa.array(np.cumsum([0, *n_lines]), pa.int32())
            line_tokens = pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(rows) if rows else [], pa.int64()))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n_tokens, pa.int64()), pa.array(n_lines, pa.int64()), line_tokens], names=["doc_id", "n_tokens", "n_sections", "line_tokens"])

    return docs.select(docs[f"`{id_col}`"].cast("long").alias("doc_id"), docs[f"`{text_col}`"].alias("__text")).mapInArrow(run, "doc_id bigint, n_tokens bigint, n_sections bigint, line_tokens array<bigint>")

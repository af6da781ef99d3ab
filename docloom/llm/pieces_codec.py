"""SentencePiece encoding and decoding through a distinct-chunk table.

In a BPE model with no piece that holds the space marker after another character, no merge can
cross from a character to a following marker. A text is therefore cut before every run of
markers, each distinct chunk is segmented once by the library, and ids are joined back by position.
``PieceTable`` proves the precondition from the vocabulary when it is built.

The table lives in each Python worker and is emptied when it holds ``table_rows`` chunks or TABLE_CHARS
characters: that bounds its memory and changes no result. There is no shuffle.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .bytetext import tidy
from .store import bounded_batches

#: Chunks and characters (of chunks, ids and decoded texts) that a worker's table holds at most between two groups of texts.
TABLE_ROWS, TABLE_CHARS = 150_000, 8_000_000
#: Characters of texts that are encoded together; a longer text stands alone, whole.
GROUP = 1 << 18
#: A text that any normalisation but the space marker would change.
PROBE = " \ufb01\u2460  \uff41\u00a0e\u0301\tA \u3000 "
MARK = "▁"
_CHUNK = re.compile(f"{MARK}+[^{MARK}]*")
_tables: dict[str, "PieceTable"] = {}


class PieceTable:
    """Distinct marked chunk -> its ids in decimal form, and its decoded text where that isn't the chunk with spaces for markers."""

    def __init__(self, model: str, table_rows: int = TABLE_ROWS):
        import sentencepiece

        self.sp = sentencepiece.SentencePieceProcessor(model_file=model)
        crossing = [p for p in map(self.sp.id_to_piece, range(self.sp.get_piece_size())) if MARK in p.lstrip(MARK)]
        if crossing or self.sp.encode("a", out_type=str)[:1] not in ([MARK + "a"], [MARK]):
            raise ValueError("pieces of this model cross space markers, or it adds no marker in front: chunks can't be encoded apart")
        if self.sp.normalize(PROBE) != MARK + PROBE.replace(" ", MARK):
            raise ValueError("this model normalises text beyond the space marker: chunks can't be encoded apart")
        self.mark_id = self.sp.piece_to_id(MARK)
        self.limit, self.chars, self.digits, self.decoded = table_rows, 0, {}, {}

    def learn(self, chunks: list[str]) -> None:
        """Segment chunks that the table lacks, in one call. The library itself puts the first marker in front."""
        ids = self.sp.encode([c[1:] for c in chunks], num_threads=1)
        ids = [x or [self.mark_id] for x in ids]
        for chunk, x, text in zip(chunks, ids, self.sp.decode(ids, num_threads=1)):
            self.digits[chunk] = ",".join(map(str, x))
            self.chars += len(chunk) + len(self.digits[chunk])
            if " " + text != chunk.replace(MARK, " "):
                self.decoded[chunk] = " " + text
                self.chars += len(text)

    def rows(self, texts: list[str]) -> list[tuple[int, str, str]]:
        """For each whole text: number of ids, ids as decimals joined by commas, decoded text."""
        if len(self.digits) > self.limit or self.chars > TABLE_CHARS:
            self.chars = 0
            self.digits.clear()
            self.decoded.clear()
        found = [_CHUNK.findall(MARK + t.replace(" ", MARK)) if t else [] for t in texts]
        digits, decoded = self.digits, self.decoded
        new = set().union(*found).difference(digits)
        if new:
            self.learn(list(new))
        out = []
        for chunks in found:
            joined = ",".join(map(digits.__getitem__, chunks))
            if decoded and not decoded.keys().isdisjoint(chunks):
                text = "".join(decoded.get(c) or c.replace(MARK, " ") for c in chunks)
            else:
                text = "".join(chunks).replace(MARK, " ")
            out.append((joined.count(",") + 1 if joined else 0, joined, text[1:]))
        return out

    def row(self, text: str) -> tuple[int, str, str]:
        return self.rows([text])[0]

    def encode(self, text: str) -> list[int]:
        joined = self.row(text)[1]
        return [int(i) for i in joined.split(",")] if joined else []


def groups(values, size: int = GROUP):
    """Lists of texts (null: empty) of about ``size`` characters; a longer text stands alone, whole."""
    part, total = [], 0
    for v in values:
        v = v.as_py() or ""
        if part and total + len(v) > size:
            yield part
            part, total = [], 0
        part.append(v)
        total += len(v)
    if part:
        yield part


def table_of(model: str, table_rows: int) -> PieceTable:
    key = f"{model}:{table_rows}"
    if key not in _tables:
        _tables[key] = PieceTable(model, table_rows)
    return _tables[key]


def encode_decode(docs: DataFrame, model: str, text_col: str = "text", keep: list[str] | None = None, outputs: tuple[str, ...] = ("n_tokens", "ids", "decoded"), table_rows: int = TABLE_ROWS) -> DataFrame:
    """Encode and decode every whole text (null or empty: no ids, empty text).

    Returns the columns ``keep`` (default: all but those named as an output) and of ``outputs``:
    n_tokens bigint, ids array<int>, decoded string, ids_sha256, decoded_sha256 string. Rows stay
    one to one, repeated rows included; very long texts are encoded whole; an empty table gives an empty one. An output replaces an
    input column of its name.
    """
    bounded_batches(docs.sparkSession)
    kinds = {"n_tokens": "bigint", "ids": "array<int>", "decoded": "string", "ids_sha256": "string", "decoded_sha256": "string"}
    keep = [c for c in (docs.columns if keep is None else keep) if c not in outputs]
    types = dict(zip(docs.columns, (f.dataType.simpleString() for f in docs.schema)))
    schema = ", ".join([f"`{c}` {types[c]}" for c in keep] + [f"`{c}` {kinds[c]}" for c in outputs])
    arrow = {"n_tokens": pa.int64(), "ids": pa.list_(pa.int32()), "decoded": pa.string(), "ids_sha256": pa.string(), "decoded_sha256": pa.string()}

    @tidy
    def run(batches):
        table = table_of(model, table_rows)
        make = {
            "n_tokens": lambda n, d, t: n,
            "ids": lambda n, d, t: np.fromstring(d, np.int32, sep=",") if d else [],
            "decoded": lambda n, d, t: t,
            "ids_sha256": lambda n, d, t: hashlib.sha256(d.encode()).hexdigest(),
            "decoded_sha256": lambda n, d, t: hashlib.sha256(t.encode()).hexdigest(),
        }
        for batch in batches:
            at = batch.schema.get_field_index("__text")
            out = {c: [] for c in outputs}
            for texts in groups(batch.column(at)):
                for got in table.rows(texts):
                    for c in outputs:
                        out[c].append(make[c](*got))
            yield pa.RecordBatch.from_arrays([batch.column(i) for i in range(len(keep))] + [pa.array(out[c], arrow[c]) for c in outputs], names=[*keep, *outputs])

    return docs.select(*[docs[f"`{c}`"] for c in keep], docs[f"`{text_col}`"].alias("__text")).mapInArrow(run, schema)

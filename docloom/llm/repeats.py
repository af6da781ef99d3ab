"""Suffix-array dedup: removes bytes under WIDTH-byte strings that also start in a document with a smaller id.

All suffixes that can share WIDTH bytes share a minimizer: the CORE-byte string with the least hash among
those inside their first WIDTH bytes. Documents are dealt into blocks, once for each of three passes:

1. Blocks list their minimizers by hash bucket; buckets answer which occur in more than one document.
2. Blocks send only the stretches of text whose minimizer is repeated, equal stretches of a block once, compressed.
   A bucket puts its stretches, and then the suffixes at every byte of the distinct ones, in order with the
   hash-compared mergesort of ``suffixes``; neighbours with a common extension of WIDTH bytes are one string,
   of which the least id is known then. Neighbours are verified byte by byte.
   Very frequent minimizers go string by string, by the hash of the whole string, so no bucket gets them all.
3. Blocks mark the covered bytes and cut them out.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bytetext import BASE, U, flat, give_back, mix, pieces, span_hash
from .store import bounded_batches, bytes_of_text, materialize, release
from .suffixes import Suffixes, same_bytes

WIDTH, CORE = 50, 24
REACH = WIDTH - CORE + 1
#: Bytes of text in a block; documents from which on a minimizer counts as very frequent.
BLOCK_BYTES, FREQUENT = 4 << 20, 4096
PIECE = 1 << 18
NO_ID = np.iinfo(np.int64).max


def _least(v: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each run of ``width`` neighbours, by doubling."""
    length = 1
    while 2 * length <= width:
        v = np.minimum(v[:-length], v[length:])
        length *= 2
    return np.minimum(v[: len(v) - (width - length)], v[width - length :]) if length < width else v


def _core_hash(buf: np.ndarray) -> np.ndarray:
    h = buf.astype(np.uint64) + U(1)
    out, done, length, rest = None, 0, 1, CORE
    while rest:
        if rest & 1:
            if out is None:
                out = h
            else:
                m = len(buf) - done - length + 1
                out = out[:m] * U(pow(BASE, length, 1 << 64)) + h[done : done + m]
            done += length
        rest >>= 1
        if rest:
            m = len(buf) - 2 * length + 1
            h = h[:m] * U(pow(BASE, length, 1 << 64)) + h[length : length + m]
            length *= 2
    return mix(out)


def minimizer_runs(buf: np.ndarray, offs: np.ndarray):
    """Runs of neighbouring WIDTH-byte strings of one row with one minimizer: (hash, start, strings, row), piece by piece."""
    for i, j in pieces(offs, PIECE):
        part, o = buf[offs[i] : offs[j]], offs[i : j + 1] - offs[i]
        if len(part) < WIDTH:
            continue
        m = _least(_core_hash(part), REACH)
        end = np.repeat(o[1:], np.diff(o))
        inside = np.arange(WIDTH, WIDTH + len(m)) <= end[: len(m)]
        begins = inside.copy()
        begins[1:] &= (m[1:] != m[:-1]) | ~inside[:-1]
        start = np.flatnonzero(begins)
        if not len(start):
            continue
        # where each run ends: at the next run, or where strings would leave the row
        row = np.searchsorted(o, start, "right") - 1
        count = np.minimum(np.r_[start[1:], len(m)], o[row + 1] - WIDTH + 1) - start
        if count.max() > REACH:  # one hash over and over: cut such runs
            parts = -(-count // REACH)
            lead = np.arange(int(parts.sum())) - np.repeat(np.cumsum(parts) - parts, parts)
            start, row, whole = np.repeat(start, parts) + lead * REACH, np.repeat(row, parts), np.repeat(count, parts)
            count = np.minimum(REACH, whole - lead * REACH)
        yield mix(m[start] * U(0xD6E8FEB86659FD93)), start + offs[i], count, row + i


def _block(table: pa.Table) -> tuple[pa.Table, np.ndarray, np.ndarray, np.ndarray]:
    """A block's rows in an order that every pass finds again, their ids, and its text."""
    ids = table.column("__id").to_numpy()
    order = np.argsort(ids, kind="stable")
    if len(np.unique(ids)) < len(ids):
        values = table.column("__text").to_pylist()
        order = np.array(sorted(range(len(ids)), key=lambda k: (ids[k], values[k])), np.int64)
    table = table.take(pa.array(order))
    buf, offs = flat(table.column("__text"))
    return table, ids[order], buf, offs


def _bucket(key: np.ndarray, n: int) -> np.ndarray:
    return (((key & U(0xFFFFFFFF)) * U(n)) >> U(32)).astype(np.int64)


def _high(key: np.ndarray) -> np.ndarray:
    """The upper 48 bits as 6 bytes each."""
    return np.ascontiguousarray(key).view(np.uint8).reshape(-1, 8)[:, 2:].copy()


def _from_high(raw: bytes) -> np.ndarray:
    out = np.zeros((len(raw) // 6, 8), np.uint8)
    out[:, :6] = np.frombuffer(raw, np.uint8).reshape(-1, 6)
    return out.view(np.uint64)[:, 0]


def _split(bucket: np.ndarray):
    """Ranges of equal values in a sorted array."""
    edge = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]]) if len(bucket) else np.zeros(0, np.int64)
    return zip(edge, np.r_[edge[1:], len(bucket)])


def list_minimizers(table: pa.Table, buckets: int) -> pa.Table:
    """Pass 1, in a block: (bucket, block, keys, docs): distinct minimizers and the rows that hold them, up to 255."""
    block = table.column("__block")[0].as_py()
    _, ids, buf, offs = _block(table)
    runs = list(minimizer_runs(buf, offs))
    key, row = (np.concatenate([r[k] for r in runs]) if runs else np.zeros(0, t) for k, t in ((0, np.uint64), (3, np.int64)))
    order = np.argsort(key, kind="stable")
    key, owner = key[order], ids[row[order]]
    new = np.r_[True, key[1:] != key[:-1]] if len(key) else np.zeros(0, bool)
    other = new.copy()
    other[1:] |= owner[1:] != owner[:-1]
    edge = np.flatnonzero(new)
    docs = np.minimum(np.add.reduceat(other.astype(np.int64), edge), 255).astype(np.uint8) if len(edge) else np.zeros(0, np.uint8)
    key = key[edge]
    bucket = _bucket(key, buckets)
    order = np.argsort(bucket, kind="stable")
    key, docs, bucket = key[order], docs[order], bucket[order]
    rows = [(int(bucket[a]), block, _high(key[a:b]).tobytes(), docs[a:b].tobytes()) for a, b in _split(bucket)]
    return pa.table([pa.array(list(c), t) for c, t in zip(zip(*rows) if rows else [()] * 4, (pa.int32(), pa.int32(), pa.binary(), pa.binary()))], names=["bucket", "block", "keys", "docs"])


def answer_repeated(table: pa.Table, frequent: int) -> pa.Table:
    """Pass 1, in a bucket: (block, keys, often): each block's minimizers that more than one document holds."""
    blocks = table.column("block").to_pylist()
    keys = [_from_high(k.as_py()) for k in table.column("keys")]
    docs = np.concatenate([np.frombuffer(d.as_py(), np.uint8) for d in table.column("docs")]).astype(np.int64)
    place = np.repeat(np.arange(len(blocks)), [len(k) for k in keys])
    key = np.concatenate(keys)
    order = np.argsort(key, kind="stable")
    key, place = key[order], place[order]
    edge = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
    total = np.add.reduceat(docs[order], edge)
    size = np.diff(np.r_[edge, len(key)])
    total = np.repeat(total, size)
    hit = total > 1
    key, place, often = key[hit], place[hit], (total[hit] >= frequent).astype(np.uint8)
    order = np.argsort(place, kind="stable")
    key, place, often = key[order], place[order], often[order]
    rows = []
    for a, b in _split(place):
        rows.append((blocks[place[a]], np.ascontiguousarray(key[a:b]).view(np.uint8).reshape(-1, 8)[:, :6].tobytes(), often[a:b].tobytes()))
    return pa.table([pa.array(list(c), t) for c, t in zip(zip(*rows) if rows else [()] * 3, (pa.int32(), pa.binary(), pa.binary()))], names=["block", "keys", "often"])


_ZSTD = pa.Codec("zstd", compression_level=1)


def _pack(raw: bytes) -> bytes:
    """raw, compressed where that makes it shorter."""
    small = _ZSTD.compress(raw, asbytes=True) if len(raw) > 64 else raw
    return small if len(small) < len(raw) else raw


def _unpack(value: bytes, size: int) -> bytes:
    """The ``size`` bytes that ``_pack`` was given."""
    return value if len(value) == size else _ZSTD.decompress(value, decompressed_size=size, asbytes=True)


def _pack_steps(rising: np.ndarray) -> bytes:
    """Numbers by their differences, which are small where the numbers rise slowly."""
    return _pack(np.diff(rising, prepend=rising.dtype.type(0)).tobytes())


def _unpack_steps(value: bytes, n: int, kind) -> np.ndarray:
    return np.cumsum(np.frombuffer(_unpack(value, n * np.dtype(kind).itemsize), kind), dtype=kind)


SENT = "bucket int, block int, keys binary, ids binary, pos binary, strings binary, text binary"


def _stretch_text(buf, start, length) -> bytes:
    lead = np.cumsum(length) - length
    return buf[np.arange(int(length.sum())) + np.repeat(start - lead, length)].tobytes() if len(start) else b""


def _settle(buf, start, count, owner):
    """Equal stretches of a block: which of them have an equal one with a smaller id, verified byte by byte."""
    length = count + WIDTH - 1
    content = span_hash_pieces(buf, start, length)
    order = np.lexsort((owner, content))
    c = content[order]
    edge = np.flatnonzero(np.r_[True, c[1:] != c[:-1]]) if len(c) else np.zeros(0, np.int64)
    head = np.repeat(order[edge], np.diff(np.r_[edge, len(c)]))
    done = np.zeros(len(start), bool)
    later = owner[order] > owner[head]
    a, b = order[later], head[later]
    same = length[a] == length[b]
    a, b = a[same], b[same]
    done[a] = same_bytes(buf, start[a], start[b], length[a])
    return done, content


def span_hash_pieces(buf, start, length, step: int = 1 << 20):
    """span_hash over a long buffer, piece by piece of it; starts must rise."""
    out = np.zeros(len(start), np.uint64)
    i = 0
    while i < len(start):
        j = max(i + 1, int(np.searchsorted(start, start[i] + step)))
        lo, hi = start[i], int((start[i:j] + length[i:j]).max())
        out[i:j] = span_hash(buf[lo:hi], start[i:j] - lo, start[i:j] - lo + length[i:j])
        i = j
    return out


def send_stretches(table: pa.Table, replies: pa.Table, buckets: int) -> pa.Table:
    """Pass 2, in a block: stretches for the buckets, and under a negative bucket those that the block has settled itself."""
    names = ["bucket", "block", "keys", "ids", "pos", "strings", "text"]
    types = (pa.int32(), pa.int32(), *[pa.binary()] * 5)
    if not table.num_rows or not replies.num_rows:
        return pa.table([pa.array([], t) for t in types], names=names)
    block = table.column("__block")[0].as_py()
    _, ids, buf, offs = _block(table)
    known = np.concatenate([_from_high(k.as_py()) for k in replies.column("keys")])
    often = np.concatenate([np.frombuffer(k.as_py(), np.uint8) for k in replies.column("often")])
    order = np.argsort(known)
    known, often = known[order], often[order]
    got = []
    for key, start, count, row in minimizer_runs(buf, offs):
        high = key >> U(16)
        at = np.minimum(np.searchsorted(known, high), len(known) - 1)
        hit = known[at] == high
        got.append((key[hit], start[hit], count[hit], row[hit], often[at[hit]]))
    key, start, count, row, hot = (np.concatenate([g[k] for g in got]) for k in range(5)) if got else [np.zeros(0, t) for t in (np.uint64, np.int64, np.int64, np.int64, np.uint8)]
    if hot.any():
        many = np.where(hot, count, 1)
        lead = np.arange(int(many.sum())) - np.repeat(np.cumsum(many) - many, many)
        key, hot, row = np.repeat(key, many), np.repeat(hot, many).astype(bool), np.repeat(row, many)
        start, count = np.repeat(start, many) + lead, np.where(hot, 1, np.repeat(count, many))
        key = np.where(hot, mix(span_hash_pieces(buf, start, np.full(len(start), WIDTH))), key)
    owner = ids[row]
    done, _ = _settle(buf, start, count, owner)
    full = ((np.uint64(1) << count.astype(np.uint64)) - U(1)).astype(np.uint32)
    rows = [(-1 - block, block, b"", b"", start[done].astype(np.uint32).tobytes(), full[done].tobytes(), b"")] if done.any() else []
    rest = np.flatnonzero(~done)
    bucket = _bucket(key[rest], buckets)
    order = np.argsort(bucket, kind="stable")
    rest, bucket = rest[order], bucket[order]
    for a, b in _split(bucket):
        r = rest[a:b]
        rows.append((int(bucket[a]), block, key[r].tobytes(), _pack_steps(owner[r]), _pack_steps(start[r].astype(np.uint32)), count[r].astype(np.uint8).tobytes(), _pack(_stretch_text(buf, start[r], count[r] + WIDTH - 1))))
    return pa.table([pa.array(list(c), t) for c, t in zip(zip(*rows) if rows else [()] * 7, types)], names=names)


def least_ids(table: pa.Table) -> pa.Table:
    """Pass 2, in a bucket: (block, pos, strings): which strings of each stretch start in a document with a smaller id."""
    if table.column("bucket")[0].as_py() < 0:
        return table.select(["block", "pos", "strings"])
    column = lambda c, t: [np.frombuffer(x.as_py(), t) for x in table.column(c)]
    blocks = table.column("block").to_pylist()
    keys = column("keys", np.uint64)
    place = np.repeat(np.arange(len(blocks)), [len(k) for k in keys])
    steps = lambda c, t: np.concatenate([_unpack_steps(x.as_py(), len(k), t) for x, k in zip(table.column(c), keys)])
    strings = column("strings", np.uint8)
    key, owner, pos, count = np.concatenate(keys), steps("ids", np.int64), steps("pos", np.uint32), np.concatenate(strings).astype(np.int64)
    size = [int(s.sum(dtype=np.int64)) + len(s) * (WIDTH - 1) for s in strings]
    text = np.frombuffer(b"".join(_unpack(x.as_py(), n) for x, n in zip(table.column("text"), size)), np.uint8)
    del table, strings, steps
    length = count + WIDTH - 1
    # Keys that one document holds alone can't cover anything.
    order = np.argsort(key, kind="stable")
    edge = np.flatnonzero(np.r_[True, key[order][1:] != key[order][:-1]])
    lone = np.minimum.reduceat(owner[order], edge) == np.maximum.reduceat(owner[order], edge)
    keep = np.ones(len(key), bool)
    keep[order] = ~np.repeat(lone, np.diff(np.r_[edge, len(key)]))
    text = text[np.repeat(keep, length)]
    key, owner, pos, count, length, place = (x[keep] for x in (key, owner, pos, count, length, place))
    start = np.cumsum(length) - length
    empty = pa.table([pa.array([], pa.int32()), pa.array([], pa.binary()), pa.array([], pa.binary())], names=["block", "pos", "strings"])
    if not len(key):
        return empty
    suffixes = Suffixes(text)
    order = suffixes.sort(start, length, key)
    a, b = order[:-1], order[1:]
    same = (key[a] == key[b]) & (length[a] == length[b])
    at = np.flatnonzero(same)
    same[at] = suffixes.equal(start[a[at]], start[b[at]], length[a[at]])
    at = np.flatnonzero(same)
    same[at] = same_bytes(text, start[a[at]], start[b[at]], length[a[at]])
    new = np.r_[True, ~same]
    kind = np.empty(len(order), np.int64)
    kind[order] = np.cumsum(new) - 1
    head = order[new]
    least = np.minimum.reduceat(owner[order], np.flatnonzero(new))
    # The suffixes of the distinct stretches in order, and the least id of each string. A first radix step takes
    # the bytes that 8-byte words hold, within the stretches of one minimizer.
    many = count[head]
    first = np.cumsum(many) - many
    at = np.arange(int(many.sum())) + np.repeat(start[head] - first, many)
    word = np.zeros(len(at), np.uint64)
    for k in range(8):
        word = word << U(8) | text[at + k]
    string = suffixes.classes(at, WIDTH, _ranks(np.repeat(key[head], many), word), 8)
    who = np.repeat(least, many)
    order = np.argsort(string, kind="stable")
    edge = np.flatnonzero(np.r_[True, string[order][1:] != string[order][:-1]])
    best = np.empty(len(at), np.int64)
    best[order] = np.repeat(np.minimum.reduceat(who[order], edge), np.diff(np.r_[edge, len(at)]))
    # Back to every stretch: a bit for each covered string.
    lead = np.cumsum(count) - count
    idx = np.arange(int(count.sum())) - np.repeat(lead, count)
    covered = best[idx + np.repeat(first[kind], count)] < np.repeat(owner, count)
    bits = np.bitwise_or.reduceat(covered.astype(np.uint32) << idx.astype(np.uint32), lead)
    hit = np.flatnonzero(bits)
    rows = [(blocks[place[hit[x]]], pos[hit[x:y]].tobytes(), bits[hit[x:y]].tobytes()) for x, y in _split(place[hit])]
    return pa.table([pa.array(list(c), t) for c, t in zip(zip(*rows), (pa.int32(), pa.binary(), pa.binary()))], names=["block", "pos", "strings"]) if rows else empty


def _ranks(high: np.ndarray, low: np.ndarray) -> np.ndarray:
    """Dense ranks of pairs."""
    order = np.lexsort((low, high))
    h, w = high[order], low[order]
    out = np.empty(len(order), np.int64)
    out[order] = np.cumsum(np.r_[False, (h[1:] != h[:-1]) | (w[1:] != w[:-1])])
    return out


def cut(table: pa.Table, replies: pa.Table) -> pa.Table:
    """Pass 3, in a block: the rows with n_bytes, n_removed, n_spans, kept and kept_text."""
    table, _, buf, offs = _block(table)
    step = np.zeros(len(buf) + 1, np.int32)
    for p, s in zip(replies.column("pos"), replies.column("strings")):
        pos, bits = np.frombuffer(p.as_py(), np.uint32).astype(np.int64), np.frombuffer(s.as_py(), np.uint32)
        for k in range(REACH):
            at = pos[(bits >> np.uint32(k)) & np.uint32(1) == 1] + k
            np.add.at(step, at, 1)
            np.add.at(step, at + WIDTH, -1)
    gone = np.cumsum(step[:-1]) > 0
    total = np.zeros(len(buf) + 1, np.int32)
    np.cumsum(gone, out=total[1:])
    begins = gone.copy()
    edge = np.zeros(len(buf) + 1, bool)
    edge[offs] = True
    begins[1:] &= ~gone[:-1] | edge[1:-1]
    spans = np.zeros(len(buf) + 1, np.int32)
    np.cumsum(begins, out=spans[1:])
    count = lambda c: c[offs[1:]] - c[offs[:-1]]
    removed = count(total)
    kept = [buf[a:b].tobytes() if not r else buf[a:b][~gone[a:b]].tobytes() for a, b, r in zip(offs[:-1], offs[1:], removed)]
    keep = [c for c in table.column_names if c not in ("__block", "__id", "__text")]
    made = {"n_bytes": pa.array(np.diff(offs), pa.int64()), "n_removed": pa.array(removed, pa.int64()), "n_spans": pa.array(count(spans), pa.int64()), "kept": pa.array(kept, pa.binary()), "kept_text": pa.array([k.decode("utf-8", "ignore") for k in kept], pa.string())}
    return pa.table([table.column(c) for c in keep] + list(made.values()), names=[*keep, *made])


def _tidy(run):
    """A function of a group's tables, after which freed memory goes back to the system. Its number of arguments is kept."""
    if run.__code__.co_argcount == 1:
        return lambda t: (run(t), give_back())[0]
    return lambda t, r: (run(t, r), give_back())[0]


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Cut every byte under a WIDTH-byte string that also starts in a row with a smaller id out of each text.

    Texts count as UTF-8 bytes, null as empty; strings are judged on the input and never cross rows;
    very long texts are taken whole. Rows with one id are one document: they don't cut each other, nor
    do rows without an id, which come after all others. An empty table gives an empty one. Returns ``keep`` (default: all columns) and n_bytes, n_removed, n_spans (maximal runs),
    kept binary, kept_text (kept without characters that a cut has broken); these replace input columns of their names.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    made = ("n_bytes", "n_removed", "n_spans", "kept", "kept_text")
    keep = [c for c in (docs.columns if keep is None else keep) if c not in made]
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), bytes_of_text(docs, f"`{text_col}`") // BLOCK_BYTES + 1)
    key = F.coalesce(F.col(f"`{id_col}`").cast("long"), F.lit(int(NO_ID)))
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).cast("binary")
    own = [F.pmod(F.xxhash64(key, text), F.lit(n)).cast("int").alias("__block"), key.alias("__id"), text.alias("__text")]
    bare = docs.select(*own)
    buckets = 2 * n
    listed = bare.groupBy("__block").applyInArrow(_tidy(lambda t: list_minimizers(t, buckets)), "bucket int, block int, keys binary, docs binary")
    known = materialize(listed.groupBy("bucket").applyInArrow(_tidy(lambda t: answer_repeated(t, FREQUENT)), "block int, keys binary, often binary"), "repeated")
    sent = bare.groupBy("__block").cogroup(known.groupBy("block")).applyInArrow(_tidy(lambda t, r: send_stretches(t, r, buckets)), SENT)
    found = materialize(sent.groupBy("bucket").applyInArrow(_tidy(lambda t: least_ids(t)), "block int, pos binary, strings binary"), "covered")
    release(known)
    types = dict(zip(docs.columns, (f.dataType.simpleString() for f in docs.schema)))
    schema = ", ".join([f"`{c}` {types[c]}" for c in keep] + ["n_bytes bigint, n_removed bigint, n_spans bigint, kept binary, kept_text string"])
    whole = docs.select(*own, *[docs[f"`{c}`"] for c in keep])
    return whole.groupBy("__block").cogroup(found.groupBy("block")).applyInArrow(_tidy(lambda t, r: cut(t, r)), schema)


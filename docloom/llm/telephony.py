"""Media columns, telephony audio: mu-law and A-law tables, IMA ADPCM blocks across blocks, resampling.

A payload is stored losslessly as 8-bit mu-law samples in a WAVE container at 8 kHz and read back from the
stored bytes. The expanded samples are coded again as A-law and as IMA ADPCM, each in a file of its own that
is read back and expanded too, and stored as PCM at 16 kHz. Features compare the three.
"""

from __future__ import annotations

import hashlib
import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .bytetext import flat, pieces, tidy
from .store import bounded_batches

RATE, UNIT = 8000, 576
#: Bytes of one ADPCM block, and its samples.
BLOCK = 64
PER = 2 * (BLOCK - 4) + 1
#: WAVE forms.
PCM, ALAW, MULAW, ADPCM = 1, 6, 7, 17
# Fixed values of the IMA ADPCM format: index steps; step sizes grow by 1.1 from 7 and are rounded as the format's table is.
INDEX_STEP = np.array([-1, -1, -1, -1, 2, 4, 6, 8] * 2, np.int64)
STEPS = np.array([
    7, 8, 9, 10, 11, 12, 13, 14, 16, 17, 19, 21, 23, 25, 28, 31, 34, 37, 41, 45, 50, 55, 60, 66, 73, 80, 88, 97, 107, 118,
    130, 143, 157, 173, 190, 209, 230, 253, 279, 307, 337, 371, 408, 449, 494, 544, 598, 658, 724, 796, 876, 963, 1060,
    1166, 1282, 1411, 1552, 1707, 1878, 2066, 2272, 2499, 2749, 3024, 3327, 3660, 4026, 4428, 4871, 5358, 5894, 6484, 7132,
    7845, 8630, 9493, 10442, 11487, 12635, 13899, 15289, 16818, 18500, 20350, 22385, 24623, 27086, 29794, 32767,
], np.int64)


def _mu_table() -> np.ndarray:
    u = ~np.arange(256, dtype=np.int64) & 0xFF
    size = (((u & 15) << 3) + 132 << ((u >> 4) & 7)) - 132
    return np.where(u & 128, -size, size).astype(np.int16)


def _a_table() -> np.ndarray:
    a = np.arange(256, dtype=np.int64) ^ 0x55
    exponent, size = (a >> 4) & 7, ((a & 15) << 4) + 8
    size = np.where(exponent > 0, (size + 256) << np.maximum(exponent - 1, 0), size)
    return np.where(a & 128, size, -size).astype(np.int16)


MU_LAW, A_LAW = _mu_table(), _a_table()


def _nearest(samples: np.ndarray, table: np.ndarray) -> np.ndarray:
    """The code of each sample whose value lies nearest; of two, that of the lower value."""
    order = np.argsort(table, kind="stable")
    value = table[order].astype(np.int64)
    at = np.searchsorted((value[1:] + value[:-1]) / 2, samples, "left")
    return order[at].astype(np.uint8)


#: The A-law code of each mu-law code's sample.
MU_TO_A = _nearest(MU_LAW, A_LAW)


def _half_band(reach: int = 16) -> np.ndarray:
    """Taps for the sample half way between two, of ``reach`` samples on either side: a sinc under a Blackman window, in 1/32768."""
    k = np.arange(-reach, reach) + 0.5
    taps = np.sinc(k) * (0.42 + 0.5 * np.cos(np.pi * k / reach) + 0.08 * np.cos(2 * np.pi * k / reach))
    out = np.round(taps / taps.sum() * 32768).astype(np.int64)
    out[[reach - 1, reach]] += (32768 - out.sum()) // 2
    return out


TAPS = _half_band()


def adpcm_decode(blocks: np.ndarray) -> np.ndarray:
    """IMA ADPCM, mono: an (n, bytes) array of blocks to (n, 2 * (bytes - 4) + 1) samples, all blocks step by step together.

    A block starts with its first sample (int16), its step index and a pad byte; an index over 88 counts as 88.
    """
    blocks = np.ascontiguousarray(blocks, np.uint8)
    n, size = blocks.shape
    out = np.empty((2 * (size - 4) + 1, n), np.int16)
    value = blocks[:, :2].copy().view("<i2")[:, 0].astype(np.int64)
    index = np.minimum(blocks[:, 2], 88).astype(np.int64)
    out[0] = value
    nibbles = np.empty((2 * (size - 4), n), np.uint8)
    nibbles[0::2], nibbles[1::2] = (blocks[:, 4:] & 15).T, (blocks[:, 4:] >> 4).T
    for t in range(len(nibbles)):
        code = nibbles[t]
        value += _DELTA[index, code]
        np.clip(value, -32768, 32767, out=value)
        index = _NEXT[index, code]
        out[t + 1] = value
    return out.T


def _delta_table() -> np.ndarray:
    step, code = STEPS[:, None], np.arange(16)[None, :]
    d = (step >> 3) + np.where(code & 4, step, 0) + np.where(code & 2, step >> 1, 0) + np.where(code & 1, step >> 2, 0)
    return np.where(code & 8, -d, d)


_DELTA = _delta_table()
_NEXT = np.clip(np.arange(89)[:, None] + INDEX_STEP[None, :], 0, 88)


def adpcm_blocks(x: np.ndarray) -> np.ndarray:
    """IMA ADPCM of an (n, samples) array, each row a block, all blocks step by step together."""
    x = x.astype(np.int64)
    n, per = x.shape
    value, index = x[:, 0].copy(), np.zeros(n, np.int64)
    out = np.zeros((n, 4 + per // 2), np.uint8)
    out[:, :2] = value.astype("<i2")[:, None].view(np.uint8)
    for t in range(1, per):
        step, diff = STEPS[index], x[:, t] - value
        rest, code = np.abs(diff), np.where(diff < 0, 8, 0)
        for bit, part in ((4, step), (2, step >> 1), (1, step >> 2)):
            hit = rest >= part
            code = code | np.where(hit, bit, 0)
            rest = rest - np.where(hit, part, 0)
        value = np.clip(value + _DELTA[index, code], -32768, 32767)
        index = _NEXT[index, code]
        out[:, 4 + (t - 1) // 2] |= (code << (4 * ((t - 1) % 2))).astype(np.uint8)
    return out


def in_blocks(edges: np.ndarray, per: int = PER) -> tuple[np.ndarray, np.ndarray]:
    """For signals that lie end to end (edges: n+1, none empty): the sample of each place of each block, and each signal's first block (n+1).

    A signal's last block is filled up with its last sample.
    """
    size = np.diff(edges)
    first = np.concatenate([[0], np.cumsum(-(-size // per))])
    signal = np.repeat(np.arange(len(size)), np.diff(first))
    at = edges[signal] + (np.arange(first[-1]) - first[signal]) * per
    return np.minimum(at[:, None] + np.arange(per), edges[signal + 1][:, None] - 1), first


def places(edges: np.ndarray, first: np.ndarray, per: int = PER) -> np.ndarray:
    """Where each sample stands in the blocks of ``in_blocks``, end to end."""
    return np.arange(edges[-1]) + np.repeat(first[:-1] * per - edges[:-1], np.diff(edges))


def resample_double(pcm: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """8 kHz to 16 kHz of signals that lie end to end: even samples are the input's, odd ones half-band low-pass, exact in integers.

    Before and after a signal there is silence; signals don't touch each other.
    """
    reach = len(TAPS) // 2
    room = np.repeat(np.arange(len(edges) - 1), np.diff(edges)) * 2 * reach + np.arange(len(pcm)) + reach
    wide = np.zeros(len(pcm) + 2 * reach * len(edges), np.int64)
    wide[room] = pcm
    between = np.full(len(pcm), 1 << 14, np.int64)
    for k, tap in enumerate(TAPS):
        between += tap * wide[room + (k - reach + 1)]
    out = np.empty(2 * len(pcm), np.int16)
    out[0::2], out[1::2] = pcm, np.clip(between >> 15, -32768, 32767)
    return out


def wave_store(samples: bytes, form: int = MULAW, rate: int = RATE) -> bytes:
    """A mono RIFF/WAVE file of 8-bit mu-law or A-law, 16-bit PCM, or ADPCM blocks of BLOCK bytes."""
    bits, unit, extra = {PCM: (16, 2, b""), ALAW: (8, 1, b""), MULAW: (8, 1, b""), ADPCM: (4, BLOCK, struct.pack("<H", PER))}[form]
    per = PER if form == ADPCM else 1
    fmt = struct.pack("<HHIIHHH", form, 1, rate, rate * unit // per, unit, bits, len(extra)) + extra
    body = b"WAVEfmt " + struct.pack("<I", len(fmt)) + fmt + b"fact" + struct.pack("<II", 4, len(samples) // unit * per) + b"data" + struct.pack("<I", len(samples)) + samples + b"\0" * (len(samples) % 2)
    return b"RIFF" + struct.pack("<I", len(body)) + body


def wave_read(stored: bytes) -> tuple[int, int, bytes]:
    """(form, rate, sample bytes) of a RIFF/WAVE file, chunk by chunk."""
    if stored[:4] != b"RIFF" or stored[8:12] != b"WAVE":
        raise ValueError("not a WAVE file")
    at, form, rate = 12, 0, 0
    while at + 8 <= len(stored):
        name, size = stored[at : at + 4], struct.unpack_from("<I", stored, at + 4)[0]
        if name == b"fmt ":
            form, _, rate = struct.unpack_from("<HHI", stored, at + 8)
        if name == b"data":
            return form, rate, stored[at + 8 : at + 8 + size]
        at += 8 + size + size % 2
    raise ValueError("no data chunk")


def payload_of(raw: bytes) -> bytes:
    """The bytes, padded with 255 up to a positive multiple of UNIT."""
    return raw + b"\xff" * (max(UNIT, -(-len(raw) // UNIT) * UNIT) - len(raw))


KINDS = {
    "media": ("binary", pa.binary()), "alaw": ("binary", pa.binary()), "adpcm": ("binary", pa.binary()), "pcm16k": ("binary", pa.binary()), "n_bytes": ("bigint", pa.int64()),
    "payload_bytes": ("bigint", pa.int64()), "payload_sha256": ("string", pa.string()), "tail_crc32": ("bigint", pa.int64()), "media_bytes": ("bigint", pa.int64()), "media_sha256": ("string", pa.string()), "feature": ("string", pa.string()),
}


def store(docs: DataFrame, text_col: str = "text", keep: list[str] | None = None, outputs: tuple[str, ...] = tuple(KINDS)) -> DataFrame:
    """Store each whole text (UTF-8; null: empty) as a mu-law WAVE file and describe what is read back.

    media: the stored file; alaw, adpcm: its samples as A-law and IMA ADPCM files; pcm16k: a PCM WAVE file
    of them at 16 kHz. The digests are of the payload as read back from media. feature: mean and
    root-mean-square level, mean distance of the A-law and of the ADPCM samples (as read back) from them,
    zero crossings, and the CRC-32 of the resampled samples. Rows stay one to one, repeated ones alike;
    very long texts are stored whole; equal texts give equal values; outputs replace input columns of
    their names; an empty table gives an empty one.
    """
    bounded_batches(docs.sparkSession)
    keep = [c for c in (docs.columns if keep is None else keep) if c not in outputs]
    types = dict(zip(docs.columns, (f.dataType.simpleString() for f in docs.schema)))
    schema = ", ".join([f"`{c}` {types[c]}" for c in keep] + [f"{c} {KINDS[c][0]}" for c in outputs])

    def files(samples: bytes, cuts: np.ndarray, form: int, rate: int = RATE) -> list[bytes]:
        return [wave_store(samples[a:b], form, rate) for a, b in zip(cuts[:-1], cuts[1:])]

    def samples_of(stored: list[bytes]) -> np.ndarray:
        return np.frombuffer(b"".join(wave_read(f)[2] for f in stored), np.uint8)

    @tidy
    def run(batches):
        for batch in batches:
            buf, offs = flat(batch.column(batch.num_columns - 1))
            out = {c: [] for c in outputs}
            for i, j in pieces(offs, 1 << 19):
                media = [wave_store(payload_of(buf[offs[k] : offs[k + 1]].tobytes())) for k in range(i, j)]
                back = [wave_read(f)[2] for f in media]
                whole, edges = np.frombuffer(b"".join(back), np.uint8), np.cumsum([0, *map(len, back)])
                mu = MU_LAW[whole]
                alaw = files(MU_TO_A[whole].tobytes(), edges, ALAW)
                at, first = in_blocks(edges)
                adpcm = files(adpcm_blocks(mu[at]).tobytes(), first * BLOCK, ADPCM)
                pcm16k = files(resample_double(mu, edges).tobytes(), 4 * edges, PCM, 2 * RATE)
                wide = mu.astype(np.int64)
                total = lambda x: np.add.reduceat(x, edges[:-1])  # noqa: E731, B023
                turns = np.zeros(len(whole), np.int64)
                turns[1:] = (mu[1:] < 0) != (mu[:-1] < 0)
                turns[edges[:-1]] = 0
                far_a = total(np.abs(A_LAW[samples_of(alaw)] - wide))
                heard = adpcm_decode(samples_of(adpcm).reshape(-1, BLOCK)).ravel()
                far_b = total(np.abs(heard[places(edges, first)] - wide))
                sums, squares, turns = total(wide), total(wide * wide), total(turns)
                for k, (file, data) in enumerate(zip(media, back)):
                    n = len(data)
                    made = {
                        "media": lambda: file, "alaw": lambda: alaw[k], "adpcm": lambda: adpcm[k], "pcm16k": lambda: pcm16k[k],
                        "n_bytes": lambda: int(offs[i + k + 1] - offs[i + k]), "payload_bytes": lambda: n, "payload_sha256": lambda: hashlib.sha256(data).hexdigest(),
                        "tail_crc32": lambda: zlib.crc32(data[-32:]), "media_bytes": lambda: len(file), "media_sha256": lambda: hashlib.sha256(file).hexdigest(),
                        "feature": lambda: f"mean={sums[k] / n:.3f};rms={(squares[k] / n) ** 0.5:.3f};alaw={far_a[k] / n:.3f};adpcm={far_b[k] / n:.3f};turns={turns[k]};pcm16k={zlib.crc32(wave_read(pcm16k[k])[2]):08x}",
                    }
                    for c in outputs:
                        out[c].append(made[c]())
            yield pa.RecordBatch.from_arrays([batch.column(i) for i in range(len(keep))] + [pa.array(out[c], KINDS[c][1]) for c in outputs], names=[*keep, *outputs])

    return docs.select(*[docs[f"`{c}`"] for c in keep], docs[f"`{text_col}`"].alias("__text")).mapInArrow(run, schema)

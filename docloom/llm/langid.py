"""Language identification: script ranges, per-word scores and a Viterbi pass with a switching penalty.

Training counts words of a bounded sample of each language's labelled rows with Spark, keeps the most
frequent ones of each language, and byte-trigram scores for all others. Prediction runs in Arrow
batches: every word of the whole text gets a score for each language its script allows, and a
Viterbi pass over the words, side by side for all texts of a piece, labels spans of one language.
"""

from __future__ import annotations

import functools
import math
import unicodedata

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .bytetext import LOWER, U, flat, mix, pieces, span_hash, tidy, word_spans, word_table
from .store import bounded_batches

#: Bounds of the model: labelled rows of one language that training reads at most (chosen by a hash of
#: the id), languages, words of one language, and cells of the table of words by languages.
TRAIN_ROWS, LANGUAGES, MODEL_WORDS, MODEL_CELLS = 5_000, 500, 20_000, 8_000_000
#: Bytes of text that are labelled side by side.
PIECE = 1 << 19
SWITCH_PENALTY = 6.0
#: When a text is not accepted: over FOREIGN of its letters in words of scripts that no language uses, or, from
#: LETTERS letters on (shorter texts are no evidence), under SUPPORT of them in words that speak for their label.
FOREIGN, SUPPORT, LETTERS = 0.5, 0.05, 200
UNKNOWN = "und"
#: A word: ASCII letters and any byte of a longer character.
WORD = word_table(lambda b: b >= 128 or 65 <= b <= 90 or 97 <= b <= 122)
TRIGRAMS = 1 << 16
#: Scripts by lead byte of UTF-8: 0 Latin, 1 Greek, 2 Cyrillic, 3 Hebrew, 4 Arabic, 5 Indic and Southeast Asian, 6 kana and marks, 7 Han, 8 Hangul, 9 other.
SCRIPTS = 10
SCRIPT = np.full(256, 9, np.uint8)
SCRIPT[:0xCD] = 0
SCRIPT[0xCD:0xD0] = 1
SCRIPT[0xD0:0xD5] = 2
SCRIPT[0xD5:0xD8] = 3
SCRIPT[0xD8:0xDC] = 4
SCRIPT[0xE0:0xE2] = 5
SCRIPT[0xE2:0xE4] = 6
SCRIPT[0xE4:0xEA] = 7
SCRIPT[0xEA:0xEE] = 8


def _trigrams(buf: np.ndarray) -> np.ndarray:
    """A table index for the three bytes that end at each position."""
    x = LOWER[buf].astype(np.uint64)
    y = x.copy()
    y[1:] |= x[:-1] << U(8)
    y[2:] |= x[:-2] << U(16)
    return (mix(y) >> U(48)).astype(np.int64)


class Model:
    """Per-word and per-trigram log scores, the words and the scripts of each language."""

    def __init__(self, langs: list[str], counts: dict[tuple[str, str], int]):
        self.langs = langs
        index = {x: i for i, x in enumerate(langs)}
        words = sorted({w for _, w in counts})
        table = np.zeros((len(words), len(langs)))
        at = {w: i for i, w in enumerate(words)}
        for (lang, w), n in counts.items():
            table[at[w], index[lang]] += n
        raw = [w.encode() for w in words]
        buf = np.frombuffer(b" ".join(raw) + b" ", np.uint8)
        ends = np.cumsum([len(r) + 1 for r in raw], dtype=np.int64) - 1 if raw else np.zeros(0, np.int64)
        starts = ends - np.array([len(r) for r in raw], np.int64)
        hashes = span_hash(buf, starts, ends)
        order = np.argsort(hashes)
        self.hashes = hashes[order]
        self.scores, self.known = np.zeros(table.shape, np.float32), table[order] > 0
        # Trigrams of the words, with a space on either side, weighted by the root of their counts.
        self.grams = np.zeros((TRIGRAMS, len(langs)), np.float32)
        seen = np.zeros((SCRIPTS, len(langs)))
        if raw and langs:
            score = np.log((table + 0.5) / (table.sum(0) + 1 + 0.5 * len(words)))
            self.scores = (score - score.mean(1, keepdims=True))[order].astype(np.float32)
            grams = np.full((TRIGRAMS, len(langs)), 0.5)
            doc = np.repeat(np.arange(len(raw)), [len(r) + 1 for r in raw])
            np.add.at(grams, _trigrams(buf), np.sqrt(table)[doc])
            gram = np.log(grams / grams.sum(0))
            self.grams = np.clip(gram - gram.mean(1, keepdims=True), -3, 3).astype(np.float32)
            np.add.at(seen, SCRIPT[buf[starts]], table)
        #: Scripts that hold at least 0.02 of a language's words.
        self.used = seen / np.maximum(1, seen.sum(0)) >= 0.02
        self.allowed = self.used.copy()
        self.allowed[~self.used.any(1)] = True

    def word_scores(self, buf, starts, ends) -> tuple[np.ndarray, np.ndarray]:
        """Scores of each word by language, and its row in the model's table, or -1."""
        h = span_hash(LOWER[buf], starts, ends)
        at = np.minimum(np.searchsorted(self.hashes, h), max(0, len(self.hashes) - 1))
        known = self.hashes[at] == h if len(self.hashes) else np.zeros(len(h), bool)
        out = np.zeros((len(h), len(self.langs)), np.float32)
        out[known] = self.scores[at[known]]
        new = np.flatnonzero(~known)
        if len(new):
            length = ends[new] - starts[new]
            first = np.cumsum(length) - length
            idx = np.arange(int(length.sum())) - np.repeat(first - starts[new], length)
            grams = self.grams[_trigrams(buf)[idx]]
            out[new] = np.clip(np.add.reduceat(grams, first, axis=0), -8, 8)
        out[~self.allowed[SCRIPT[buf[starts]]]] = -12.0
        return out, np.where(known, at, -1)

    def supported(self, at: np.ndarray, label: np.ndarray, script: np.ndarray) -> np.ndarray:
        """Whether a word speaks for its label: the language's words hold it, or it is in a script other than Latin that the language uses."""
        own = (at >= 0) & self.known[at, label] if len(self.known) else np.zeros(len(at), bool)
        return own | (script != 0) & self.used[script, label]

    def spans(self, scores: np.ndarray, first: np.ndarray, penalty: float = SWITCH_PENALTY) -> np.ndarray:
        """The best language of each word, row by row; first: each row's first word (n+1)."""
        n_words, n_lang = scores.shape
        counts = np.diff(first)
        order = np.argsort(-counts, kind="stable")
        active = counts[order]
        begin = first[:-1][order]
        label = np.zeros(n_words, np.int16)
        stay = np.ones((n_words, n_lang), bool)
        came = np.zeros(n_words, np.int16)
        longest = int(active[0]) if len(active) else 0
        alive = np.searchsorted(-active, -np.arange(longest), "left")  # rows with more than t words
        v = np.zeros((len(order), n_lang), np.float32)
        for t in range(longest):
            k = alive[t]
            w = begin[:k] + t
            if t:
                best = v[:k].argmax(1)
                other = v[np.arange(k), best] - penalty
                stay[w] = v[:k] >= other[:, None]
                came[w] = best
                np.maximum(v[:k], other[:, None], out=v[:k])
            v[:k] += scores[w]
            v[:k] -= v[:k].max(1, keepdims=True)
        state = v.argmax(1)
        for t in range(longest - 1, -1, -1):
            k = alive[t]
            w = begin[:k] + t
            label[w] = state[:k]
            state[:k] = np.where(stay[w, state[:k]], state[:k], came[w])
        return label


def train(labelled: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", rows: int = TRAIN_ROWS, words: int = MODEL_WORDS) -> Model:
    """Fit on rows whose lang is not null: of each language about ``rows`` of them at most (by a hash of the id) and ``words`` words.

    A rare language keeps all its rows and words, whatever the others weigh. No labelled row at all
    gives a model without languages; more than LANGUAGES languages are an error.
    """
    labelled = labelled.where(F.col(lang_col).isNotNull())
    counted = labelled.groupBy(F.col(lang_col).cast("string").alias("lang")).agg(F.count(F.lit(1)).alias("n")).limit(LANGUAGES + 1).collect()
    if len(counted) > LANGUAGES:
        raise ValueError(f"over {LANGUAGES} languages: is {lang_col} a language?")
    n = {r["lang"]: r["n"] for r in sorted(counted, key=lambda r: r["lang"])}
    if not n:
        return Model([], {})
    words = max(1, min(words, MODEL_CELLS // len(n) ** 2))
    cuts = labelled.sparkSession.createDataFrame([(x, math.ceil(min(1, rows / k) * 1_000_000)) for x, k in n.items()], "lang string, cut int")
    lower = F.translate(F.col(text_col), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    chosen = labelled.select(F.col(lang_col).cast("string").alias("lang"), F.pmod(F.xxhash64(id_col), F.lit(1_000_000)).alias("h"), lower.alias("t")).join(F.broadcast(cuts), "lang").where("h < cut")
    each = chosen.select("lang", F.explode(F.regexp_extract_all("t", F.lit("[a-z\\x{80}-\\x{10FFFF}]+"), F.lit(0))).alias("w"))
    ranked = each.groupBy("lang", "w").agg(F.count(F.lit(1)).alias("n")).withColumn("k", F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "w")))
    return Model(list(n), {(r["lang"], r["w"]): r["n"] for r in ranked.where(F.col("k") <= words).select("lang", "w", "n").collect()})


def predict(docs: DataFrame, model: Model, text_col: str = "text", keep: list[str] | None = None, with_spans: bool = False, penalty: float = SWITCH_PENALTY, with_accepted: bool = False) -> DataFrame:
    """Label whole texts: keep, lang_pred string, score double and, if asked, spans array<struct<lang, first_word, n_words>>
    and accepted boolean, whether the text is in the learned languages (see FOREIGN, SUPPORT, LETTERS; 'und' isn't accepted).

    lang_pred is the language of most letters; score is their share. A null text or one without a
    letter gets 'und' and 0. Ties go to the language that comes first, by code point. Rows stay one
    to one, repeated rows alike; very long texts are labelled whole; an empty table gives an empty
    one, and an input column named like an output is replaced. Without a language all texts get 'und'.
    """
    outputs = {"lang_pred": "string", "score": "double"} | ({"spans": "array<struct<lang:string,first_word:int,n_words:int>>"} if with_spans else {}) | ({"accepted": "boolean"} if with_accepted else {})
    keep = [c for c in (docs.columns if keep is None else keep) if c not in outputs]
    types = dict(zip(docs.columns, (f.dataType.simpleString() for f in docs.schema)))
    schema = ", ".join([f"`{c}` {types[c]}" for c in keep] + [f"{c} {t}" for c, t in outputs.items()])
    bounded_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded by LANGUAGES and MODEL_CELLS
    span_type = pa.list_(pa.struct([("lang", pa.string()), ("first_word", pa.int32()), ("n_words", pa.int32())]))

    @tidy
    def run(batches):
        m = shared.value
        n_lang = max(1, len(m.langs))
        for batch in batches:
            column = batch.column(batch.num_columns - 1)
            _, offs = flat(column)
            order = np.argsort(-np.diff(offs), kind="stable")  # texts of like length are labelled side by side
            buf, offs = flat(column.take(pa.array(order)))
            top, score = np.zeros(len(order), np.int64), np.zeros(len(order))
            good, accepted, spans = np.zeros(len(order), bool), np.zeros(len(order), bool), [[]] * len(order)
            for i, j in pieces(offs, PIECE):
                part, o, own = buf[offs[i] : offs[j]], offs[i : j + 1] - offs[i], order[i:j]
                starts, ends, first = word_spans(part, o, WORD)
                if not m.langs or not len(starts):
                    continue
                upto = np.zeros(len(part) + 1, np.int32)
                lead, script = letters(part)
                upto[lead + 1] = script < SCRIPTS
                np.cumsum(upto, out=upto)
                n = (upto[ends] - upto[starts]).astype(np.int64)
                scores, at = m.word_scores(part, starts, ends)
                scores[n == 0] = 0
                label = m.spans(scores, first, penalty)
                doc = np.repeat(np.arange(j - i), np.diff(first))
                weight = np.bincount(doc * n_lang + label, n, (j - i) * n_lang).reshape(-1, n_lang)
                total = weight.sum(1)
                top[own], good[own] = weight.argmax(1), total > 0
                score[own] = weight.max(1) / np.maximum(1, total)
                if with_accepted:
                    kind = SCRIPT[part[starts]]
                    foreign = np.bincount(doc, n * ~m.used.any(1)[kind], j - i)
                    speaks = np.bincount(doc, n * m.supported(at, label, kind), j - i)
                    accepted[own] = (total > 0) & (foreign <= FOREIGN * total) & ((total < LETTERS) | (speaks >= SUPPORT * total))
                if with_spans:
                    for k in np.flatnonzero(total > 0):
                        row = label[first[k] : first[k + 1]]
                        cuts = np.flatnonzero(np.r_[True, row[1:] != row[:-1], True])
                        spans[own[k]] = [{"lang": m.langs[row[a]], "first_word": int(a), "n_words": int(b - a)} for a, b in zip(cuts[:-1], cuts[1:])]
            made = [pa.array([m.langs[t] if g else UNKNOWN for t, g in zip(top, good)], pa.string()), pa.array(score, pa.float64())]
            made += ([pa.array(spans, span_type)] if with_spans else []) + ([pa.array(accepted, pa.bool_())] if with_accepted else [])
            yield pa.RecordBatch.from_arrays([batch.column(i) for i in range(len(keep))] + made, names=[*keep, *outputs])

    return docs.select(*[docs[f"`{c}`"] for c in keep], docs[f"`{text_col}`"].alias("__text")).mapInArrow(run, schema)


@functools.cache
def _letter_scripts() -> np.ndarray:
    """The script of each code point that is a letter, SCRIPTS for all others. Latin letters count as Latin wherever they stand."""
    out = np.full(0x110000, SCRIPTS, np.uint8)
    for k in range(0x110000):
        if (c := chr(k)).isalpha():
            out[k] = 0 if "LATIN" in unicodedata.name(c, "") else SCRIPT[c.encode()[0]]
    return out


def letters(buf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each character of UTF-8 text starts, and its script, or SCRIPTS if it is no letter."""
    lead = np.flatnonzero((buf & 0xC0) != 0x80)
    point = buf[lead].astype(np.int32)
    wide = np.flatnonzero(point >= 0x80)
    size = 1 + (point[wide] >= 0xE0) + (point[wide] >= 0xF0)
    value = point[wide] & (0x3F >> size)
    for k in (1, 2, 3):
        more = size >= k
        value[more] = value[more] << 6 | (buf[np.minimum(lead[wide[more]] + k, len(buf) - 1)] & 0x3F)
    point[wide] = np.minimum(value, 0x10FFFF)
    return lead, _letter_scripts()[point]


def held_out(id_col: str = "doc_id") -> Column:
    """The fold that training never sees."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 == 0, F.lit(False))

"""License scans: an exact set-similarity (containment) join of text blocks against license templates.

Template tokens are ordered by their document frequency over the whole corpus, rarest first. Blocks are
all windows of a template's number of words over ``threshold``, whatever line ends they span. Windows that
hold ``threshold`` of a template's distinct words hold one of its first ``size - need + 1`` (prefix filter);
the words around such tokens make stretches. A stretch needs ``need`` distinct template tokens (length
filter), and as many from the first on that it shares with the template, in the global order (positional
filter); what is left is counted exactly, window by window. Where findings of several labels meet, the
best stays. The phrases of ``PHRASES`` are found at every place besides.
"""

from __future__ import annotations

import bisect
import math
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bytetext import LOWER, flat, pieces, span_hash, tidy, word_spans, word_table
from .store import bounded_batches

WORD = word_table(lambda b: 48 <= b <= 57 or 65 <= b <= 90 or 97 <= b <= 122 or b >= 128)
THRESHOLD = 0.8
# Phrases whose every place counts, and their labels.
PHRASES = (("gnu general public license", "gpl"), ("apache license", "apache"), ("cc by", "cc-by"), ("mit license", "mit"))
# Paragraphs of well-known licenses and notices, as templates.
TEMPLATES = (
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions"),
    ("mit", "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."),
    ("mit", "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("bsd", "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer."),
    ("bsd", "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."),
    ("bsd", "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."),
    ("bsd", "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."),
    ("apache", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License."),
    ("apache", "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"),
    ("apache", "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License."),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License"),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("gpl", "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details."),
    ("lgpl", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License"),
    ("agpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License"),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at"),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("unlicense", "This is free and unencumbered software released into the public domain."),
    ("unlicense", "Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means."),
    ("zlib", "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software."),
    ("zlib", "Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions"),
    ("boost", "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license"),
    ("epl", "This program and the accompanying materials are made available under the terms of the Eclipse Public License"),
    ("cc0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work"),
    ("cc-by", "This work is licensed under a Creative Commons Attribution License"),
    ("cc-by", "This work is licensed under the Creative Commons Attribution 4.0 International License"),
    ("cc-by-sa", "This work is licensed under the Creative Commons Attribution-ShareAlike 4.0 International License"),
    ("proprietary", "All rights reserved."),
)


def words_of(text: str) -> list[str]:
    """Words as the scan sees them, in plain Python: A-Z lower-cased."""
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text))


class Scanner:
    """Templates over tokens in a global order; frequency: document counts of the template tokens."""

    def __init__(self, frequency: dict[str, int], templates=TEMPLATES, phrases=PHRASES, threshold: float = THRESHOLD):
        self.threshold, self.phrases = threshold, [(p.split(), label) for p, label in phrases]
        self.tokens = sorted(template_tokens(templates, phrases), key=lambda t: (frequency.get(t, 0), t))
        self.ids = {t: i for i, t in enumerate(self.tokens)}
        raw = [t.encode() for t in self.tokens]
        ends = np.cumsum([len(r) for r in raw], dtype=np.int64)
        starts = ends - np.array([len(r) for r in raw], np.int64)
        h = span_hash(np.frombuffer(b"".join(raw), np.uint8), starts, ends)
        order = np.argsort(h)
        self.hashes, self.hash_ids = h[order], order.astype(np.int32)
        self.templates = []  # (label, distinct tokens in order, how many are needed, words of a window)
        self.own = np.zeros((len(templates), len(self.tokens) + 1), bool)  # the last column is that of id -1
        self.starting = self.own.copy()
        for k, (label, text) in enumerate(templates):
            words = words_of(text)
            own = sorted({self.ids[t] for t in words})
            need = math.ceil(threshold * len(own) - 1e-9)
            self.templates.append((label, own, need, math.ceil(len(words) / threshold - 1e-9)))
            self.own[k, own] = True
            self.starting[k, own[: len(own) - need + 1]] = True
        self.in_prefix = self.starting.any(0)
        #: Stretches by the filter that they came to: prefix, length, position, counted.
        self.reached = np.zeros(4, np.int64)

    def token_ids(self, buf, starts, ends) -> np.ndarray:
        """Each word's template token, or -1."""
        h = span_hash(LOWER[buf], starts, ends)
        at = np.minimum(np.searchsorted(self.hashes, h), len(self.hashes) - 1)
        return np.where(self.hashes[at] == h, self.hash_ids[at], -1).astype(np.int32)

    def places(self, ids: np.ndarray, first: np.ndarray) -> list[tuple[np.ndarray, str]]:
        """Words at which each phrase starts, within one row."""
        out = []
        row_end = np.repeat(first[1:], np.diff(first))
        for words, label in self.phrases:
            n = len(words)
            if len(ids) < n:
                out.append((np.zeros(0, np.int64), label))
                continue
            ok = ids[: len(ids) - n + 1] == self.ids[words[0]]
            for k, w in enumerate(words[1:], 1):
                ok &= ids[k : len(ids) - n + 1 + k] == self.ids[w]
            at = np.flatnonzero(ok)
            out.append((at[at + n <= row_end[at]], label))
        return out

    def windows(self, ids: np.ndarray, first: np.ndarray) -> list[tuple[int, int, str, float]]:
        """(word, end, label, containment) of the best window in each run of windows at or over the threshold; first: each row's first word (n+1).

        An occurrence of a template token counts for the windows that it lies in and its predecessor doesn't.
        """
        found = []
        at = np.flatnonzero(self.in_prefix[ids])
        if not len(at):
            return found
        row = np.searchsorted(first, at, "right") - 1
        low, high = first[row], first[row + 1]
        n_tokens = len(self.tokens)
        for k, (label, own, need, width) in enumerate(self.templates):
            ok = self.starting[k][ids[at]]  # prefix: the words around one of the template's first tokens
            if not ok.any():
                continue
            hits = at[ok]
            begin, end = np.maximum(hits - width + 1, low[ok]), np.minimum(hits + width, high[ok])
            fresh = np.r_[True, begin[1:] >= end[:-1]]
            begin, end = begin[fresh], end[np.r_[fresh[1:], True]]
            self.reached[0] += len(begin)
            near, gap = _ranges(begin, end - begin)
            held = ids[near] >= 0
            code = np.unique(gap[held] * n_tokens + ids[near[held]])  # each stretch's distinct tokens in the global order
            of, token = code // n_tokens, code % n_tokens
            size = np.bincount(of, minlength=len(begin))
            shared = np.flatnonzero(self.own[k][token])
            lead = np.full(len(begin), len(code))
            np.minimum.at(lead, of[shared], shared)
            long = size >= need  # length
            placed = long & (np.cumsum(size) - lead >= need)  # position: tokens from the first shared one on
            self.reached[1:3] += long.sum(), placed.sum()
            if not placed.any():
                continue
            begin, end = begin[placed], end[placed]
            near, gap = _ranges(begin, end - begin)
            hold = self.own[k][ids[near]]
            place, gap, limit = near[hold], gap[hold], begin[gap[hold]]
            token = ids[place]
            order = np.lexsort((place, token))
            before = np.full(len(place), -1, np.int64)
            same = token[order[1:]] == token[order[:-1]]
            before[order[1:][same]] = place[order[:-1][same]]
            enter = np.maximum(np.maximum(before + 1, place - width + 1), limit)
            # The gap of one place between stretches keeps their runs apart.
            turn, where = np.unique(np.concatenate([enter, place + 1]) + np.r_[gap, gap], return_inverse=True)
            count = np.cumsum(np.bincount(where, np.repeat([1, -1], len(place)), len(turn))).astype(np.int64)
            enough = count >= need
            run = np.flatnonzero(enough & ~np.r_[False, enough[:-1]])
            self.reached[3] += len(run)
            for a, b in zip(run, np.flatnonzero(~enough & np.r_[False, enough[:-1]])):
                best = a + int(count[a:b].argmax())
                w = int(place[np.searchsorted(place + gap, turn[best + 1] - 1)])
                found.append((w, min(w + width, int(first[np.searchsorted(first, w, "right")])), label, int(count[best]) / len(own)))
        return found


def _ranges(begin: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All numbers of ranges, and the range of each."""
    of = np.repeat(np.arange(len(size)), size)
    return np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size - begin, size), of


def best_by_place(found: list[tuple[int, int, str, float]]) -> list[tuple[int, int, str, float]]:
    """Findings (word, end, label, containment) that meet no better one of another label."""
    found = sorted(found)
    reach = max((e - w for w, e, _, _ in found), default=0)
    starts = [w for w, *_ in found]
    near = lambda w, e: found[bisect.bisect_left(starts, w - reach) : bisect.bisect_left(starts, e)]
    return [(w, e, x, y) for w, e, x, y in found if not any(b > w and z > y and label != x for _, b, label, z in near(w, e))]


def template_tokens(templates=TEMPLATES, phrases=PHRASES) -> list[str]:
    return sorted({t for _, text in templates for t in words_of(text)} | {t for p, _ in phrases for t in p.split()})


def frequencies(docs: DataFrame, text_col: str = "text", templates=TEMPLATES, phrases=PHRASES) -> dict[str, int]:
    """Documents that hold each template token, over all rows; the result has at most one row a token and task."""
    tokens = template_tokens(templates, phrases)

    @tidy
    def run(batches):
        scan = Scanner({}, templates, phrases)
        total = np.zeros(len(scan.tokens), np.int64)
        for batch in batches:
            buf, offs = flat(batch.column(0))
            for i, j in pieces(offs):
                part, o = buf[offs[i] : offs[j]], offs[i : j + 1] - offs[i]
                starts, ends, first = word_spans(part, o, WORD)
                ids = scan.token_ids(part, starts, ends)
                row = np.repeat(np.arange(j - i), np.diff(first))
                hit = ids >= 0
                pair = np.unique(row[hit] * len(scan.tokens) + ids[hit])
                total += np.bincount(pair % len(scan.tokens), minlength=len(scan.tokens))
        yield pa.RecordBatch.from_arrays([pa.array(scan.tokens, pa.string()), pa.array(total)], names=["token", "n"])

    counted = docs.select(docs[f"`{text_col}`"].cast("string").alias("t")).mapInArrow(run, "token string, n bigint").groupBy("token").agg(F.sum("n").alias("n"))
    got = {r["token"]: r["n"] for r in counted.collect()}
    return {t: got.get(t, 0) for t in tokens}


def scan(docs: DataFrame, text_col: str = "text", keep: list[str] | None = None, templates=TEMPLATES, phrases=PHRASES, threshold: float = THRESHOLD, with_spans: bool = False) -> DataFrame:
    """Scan whole texts (null: empty): keep, n_words, n_base, first_word, last_word, base_labels, labels, score.

    n_base, first_word, last_word and base_labels are of the phrases; labels are those of phrases and of
    the templates that windows of the text hold, the best where they meet. score is the largest
    containment, 1 where a phrase stands, else 0. spans (if asked): each finding's first word, label and
    containment. Rows stay one to one, repeated ones alike; very long texts are scanned whole; outputs
    replace input columns of their names; an empty table gives an empty one.
    """
    bounded_batches(docs.sparkSession)
    outputs = {"n_words": "bigint", "n_base": "bigint", "first_word": "bigint", "last_word": "bigint", "base_labels": "string", "labels": "string", "score": "double"} | ({"spans": "array<struct<word:int,label:string,score:double>>"} if with_spans else {})
    keep = [c for c in (docs.columns if keep is None else keep) if c not in outputs]
    types = dict(zip(docs.columns, (f.dataType.simpleString() for f in docs.schema)))
    schema = ", ".join([f"`{c}` {types[c]}" for c in keep] + [f"{c} {t}" for c, t in outputs.items()])
    frequency = frequencies(docs, text_col, templates, phrases)
    arrow = [pa.int64()] * 4 + [pa.string(), pa.string(), pa.float64()] + ([pa.list_(pa.struct([("word", pa.int32()), ("label", pa.string()), ("score", pa.float64())]))] if with_spans else [])

    @tidy
    def run(batches):
        s = Scanner(frequency, templates, phrases, threshold)
        for batch in batches:
            buf, offs = flat(batch.column(batch.num_columns - 1))
            rows = []
            for i, j in pieces(offs):
                part, o = buf[offs[i] : offs[j]], offs[i : j + 1] - offs[i]
                starts, ends, first = word_spans(part, o, WORD)
                ids = s.token_ids(part, starts, ends)
                row = np.repeat(np.arange(j - i), np.diff(first))
                base = [[] for _ in range(j - i)]
                for at, label in s.places(ids, first):
                    for w in at:
                        base[row[w]].append((int(w - first[row[w]]), label, 1.0))
                more = [[] for _ in range(j - i)]
                for w, end, label, score in best_by_place(s.windows(ids, first)):
                    more[row[w]].append((int(w - first[row[w]]), label, score))
                for k in range(j - i):
                    own, at = base[k] + more[k], [w for w, _, _ in base[k]]
                    rows.append((int(first[k + 1] - first[k]), len(at), min(at, default=None), max(at, default=None), ",".join(sorted({x for _, x, _ in base[k]})), ",".join(sorted({x for _, x, _ in own})), max((x for _, _, x in own), default=0.0)) + (([{"word": w, "label": x, "score": y} for w, x, y in sorted(own)],) if with_spans else ()))
            columns = list(zip(*rows)) or [()] * len(arrow)
            yield pa.RecordBatch.from_arrays([batch.column(i) for i in range(len(keep))] + [pa.array(list(c), t) for c, t in zip(columns, arrow)], names=[*keep, *outputs])

    return docs.select(*[docs[f"`{c}`"] for c in keep], docs[f"`{text_col}`"].alias("__text")).mapInArrow(run, schema)


def brute_force(text: str | None) -> dict:
    """The base findings of one text in plain Python, for tests."""
    words = words_of(text or "")
    found = [(i, label) for p, label in PHRASES for i in range(len(words)) if words[i : i + len(p.split())] == p.split()]
    return {"n_words": len(words), "n_base": len(found), "first_word": min((i for i, _ in found), default=None), "last_word": max((i for i, _ in found), default=None), "base_labels": ",".join(sorted({x for _, x in found}))}

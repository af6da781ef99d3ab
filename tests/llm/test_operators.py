"""Operators against brute force, on edge cases: nulls, empty and long texts, ties, repeated rows, clashing columns."""

import hashlib
import math
import re
import zlib

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docloom.llm import htmltext, langid, licenses, mixing, neardup, pieces_codec, queries, repeats, simhash, suffixes, telephony, token_counts

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, n_bytes string, size string, score string"
LONG = " ".join(f"word{k % 977} w{k * k % 463}" for k in range(30_000))
PASSAGE = "this passage of more than fifty bytes stands in several documents, word for word, é ü"
TEXTS = [
    (5, None), (6, ""), (7, " \t\n"), (8, "one"), (9, "one"), (9, "one"), (10, LONG), (11, LONG + " tail"), (12, "a b c d e f g h i j " + PASSAGE + " x"),
    (13, PASSAGE), (13, PASSAGE), (2, "intro " + PASSAGE), (14, "日本語のテキスト " * 30), (15, "the MIT License and the gnu general\npublic license, GNU General Public License"), (16, "aaaa" * 60), (17, "aaaa" * 70), (None, PASSAGE), (18, "All Rights Reserved 123 !?"),
]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(d, t, None if d == 8 else "en", None if d == 9 else f"s{(d or 0) % 3}", 1, "x", "y", "z") for d, t in TEXTS]
    return spark.createDataFrame(rows, SCHEMA)


def rows(df, *columns):
    return sorted((tuple(r[c] for c in columns) for r in df.select(*columns).collect()), key=repr)


def test_fingerprints(spark, docs):
    got = rows(simhash.fingerprints(docs.where("doc_id IS NOT NULL")), "doc_id", "n_chars", "edited_sha256")
    line = sorted(((d, t or "") for d, t in TEXTS if d is not None), key=lambda r: (-r[0], r[1]))
    want = []
    for k, (d, t) in enumerate(line):
        cut, after = len(t) // 3, line[(k + 1) % len(line)][1]
        want.append((d, len(t), hashlib.sha256((t[: len(t) - cut] + after[:cut]).encode()).hexdigest()))
    assert got == sorted(want, key=repr)
    assert simhash.fingerprints(docs).count() == len(TEXTS) and simhash.fingerprints(docs.limit(0)).count() == 0
    same = {r["doc_id"]: (r["lo"], r["hi"]) for r in simhash.fingerprints(docs).collect()}
    assert same[8] == same[9] and same[5] == same[6] == same[7]


def test_fingerprint_votes_by_force(spark, docs):
    import xxhash

    hashed = lambda parts, seed=42: [seed := xxhash.xxh64(p, seed=seed).intdigest() for p in parts][-1] if parts else seed

    def plain(text):
        words = [w.encode() for w in re.findall(r"[^\x20\x09-\x0D]+", text)]
        terms = [hashed(words[k : k + 5]) for k in range(max(1, len(words) - 4))]
        more = [hashed([h.to_bytes(8, "little"), (128).to_bytes(4, "little")]) for h in terms]
        return tuple(sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in each) > len(each)) for each in (terms, more))

    line = sorted(((d, t or "") for d, t in TEXTS if d not in (10, 11, None)), key=lambda r: (-r[0], r[1]))
    got = simhash.fingerprints(docs.where("doc_id NOT IN (10, 11)")).collect()
    unsigned = lambda *longs: tuple(v & (1 << 64) - 1 for v in longs)
    far = lambda a, b: 1 - sum(bin(x ^ y).count("1") for x, y in zip(a, b)) / 128
    want = []
    for k, (d, t) in enumerate(line):
        after = line[(k + 1) % len(line)][1]
        edited = t[: len(t) - len(t) // 3] + after[: len(t) // 3]
        want.append((d, *plain(t), *plain(edited), far(plain(t), plain(edited)), far(plain(t), plain(after))))
    assert sorted((r["doc_id"], *unsigned(r["lo"], r["hi"], r["edited_lo"], r["edited_hi"]), r["near_edited"], r["near_next"]) for r in got) == sorted(want)


@pytest.mark.parametrize("salt", [1000, 3])
def test_hamming_search(spark, monkeypatch, salt):
    from docloom.llm import store

    monkeypatch.setattr(store, "SALT_ROWS", salt)
    rng = np.random.default_rng(1)
    base = [(int(a), int(b)) for a, b in rng.integers(-(2**63), 2**63 - 1, (30, 2))]
    values = list(base)
    for lo, hi in base:
        for flips in (1, 4, 6, 7, 12):
            bits = rng.choice(128, flips, replace=False)
            whole = (lo & (1 << 64) - 1) | (hi & (1 << 64) - 1) << 64
            for b in bits:
                whole ^= 1 << int(b)
            signed = lambda v: v - (1 << 64) if v >> 63 else v
            values.append((signed(whole & (1 << 64) - 1), signed(whole >> 64)))
    df = spark.createDataFrame([(k, *v) for k, v in enumerate(values)], "doc_id bigint, lo bigint, hi bigint")
    got = {r["doc_id"]: r["n_within"] for r in simhash.search(df, F.col("doc_id") % 5 == 0).collect()}
    far = lambda x, y: sum(bin((a ^ b) & (1 << 64) - 1).count("1") for a, b in zip(x, y))
    for k, v in enumerate(values):
        assert got[k] == (sum(far(v, w) <= simhash.RADIUS for w in values) - 1 if k % 5 == 0 else None)


def test_pieces(spark, docs):
    import sentencepiece

    model = queries.tokenizer("piece_bpe_32k.model")
    sp = sentencepiece.SentencePieceProcessor(model_file=model)
    got = rows(pieces_codec.encode_decode(docs, model, keep=["doc_id"], table_rows=50), "doc_id", "n_tokens", "ids", "decoded")
    want = [(d, len(ids := sp.encode(t or "")), ids, sp.decode(ids) if ids else "") for d, t in TEXTS]
    assert got == sorted(want, key=repr)
    table = pieces_codec.PieceTable(model)
    for s in ("  a  b ", "▁x ▁", "a\x00b\r\n", "<s>é</s>", " ", "　"):
        assert table.encode(s) == sp.encode(s) and table.row(s)[2] == sp.decode(sp.encode(s))


def test_token_counts(spark, docs):
    import json

    vocabulary, ranks = queries.tokenizer("byte_bpe_50k.json"), queries.tokenizer("byte_bpe_50k.tiktoken")
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]  # bytes that stand for themselves in the vocabulary
    byte = {chr(b): b for b in own} | {chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in own)}
    tokens = {i: bytes(byte[c] for c in t) for t, i in json.load(open(vocabulary))["model"]["vocab"].items() if t != "<|endoftext|>"}
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(vocabulary)
    t.encode_special_tokens = True
    extra = [(300, "a\n\n\n  b  \n\t c\r\n"), (301, "<|endoftext|>\nx"), (302, "\n"), (303, "é🙂\n日本\u2028z\n\n"), (304, "x \n y\n" * 3000), (305, "a" + " \n" * 600_000 + "b"), (306, " " * 1_200_000)]
    both = docs.select("doc_id", "text", "n_bytes").union(spark.createDataFrame([(d, x, "y") for d, x in extra], "doc_id bigint, text string, n_bytes string"))
    want = []
    for d, text in TEXTS + extra:
        raw, at, line = (text or "").encode(), 0, 0
        lines = [0] * (raw.count(b"\n") + 1)
        for i in t.encode(text or "", add_special_tokens=False).ids:  # a token's line by the bytes before it
            lines[line] += 1
            line += tokens[i].count(b"\n")
            at += len(tokens[i])
        assert at == len(raw)
        want.append((d, sum(lines), len(lines), lines))
    assert rows(token_counts.count(both, ranks), "doc_id", "n_tokens", "n_sections", "line_tokens") == sorted(want, key=repr)
    assert token_counts.count(docs.limit(0), ranks).count() == 0


def plain_adpcm(blocks):
    """Plain decoding, sample by sample, of blocks of one signal."""
    out = []
    for block in blocks:
        value, index = int.from_bytes(bytes(block[:2]), "little", signed=True), int(block[2])
        out.append(value)
        for byte in block[4:]:
            for code in (byte & 15, byte >> 4):
                step = int(telephony.STEPS[index])
                d = (step >> 3) + (step if code & 4 else 0) + (step >> 1 if code & 2 else 0) + (step >> 2 if code & 1 else 0)
                value = max(-32768, min(32767, value - d if code & 8 else value + d))
                index = max(0, min(88, index + int(telephony.INDEX_STEP[code])))
                out.append(value)
    return out


def test_telephony(spark, docs):
    out = telephony.store(docs, keep=["doc_id", "text"])
    assert telephony.store(docs.limit(0)).count() == 0
    for r in out.collect():
        raw = (r["text"] or "").encode()
        payload = raw + b"\xff" * (max(576, -(-len(raw) // 576) * 576) - len(raw))
        assert telephony.wave_read(bytes(r["media"])) == (7, 8000, payload)
        assert (r["n_bytes"], r["payload_bytes"], r["payload_sha256"], r["tail_crc32"]) == (len(raw), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-32:]))
        assert r["media_bytes"] == len(r["media"]) and r["media_sha256"] == hashlib.sha256(r["media"]).hexdigest()
        if len(raw) > 10_000:
            continue
        # Features, sample by sample.
        x, n = [int(telephony.MU_LAW[b]) for b in payload], len(payload)
        form, rate, coded = telephony.wave_read(bytes(r["alaw"]))
        assert (form, rate) == (6, 8000) and all(abs(int(telephony.A_LAW[c]) - v) == min(abs(int(a) - v) for a in telephony.A_LAW) for c, v in zip(coded, x))
        form, _, coded_b = telephony.wave_read(bytes(r["adpcm"]))
        heard = plain_adpcm([coded_b[k : k + 64] for k in range(0, len(coded_b), 64)])
        assert form == 17 and len(heard) == -(-n // 121) * 121
        odd = [max(-32768, min(32767, (sum(int(t) * x[k + j - 15] for j, t in enumerate(telephony.TAPS) if 0 <= k + j - 15 < n) + 16384) >> 15)) for k in range(n)]
        pcm = np.array([v for pair in zip(x, odd) for v in pair], "<i2").tobytes()
        assert telephony.wave_read(bytes(r["pcm16k"])) == (1, 16000, pcm)
        turns = sum((a < 0) != (b < 0) for a, b in zip(x, x[1:]))
        far = lambda y: sum(abs(a - b) for a, b in zip(x, y)) / n
        assert r["feature"] == f"mean={sum(x) / n:.3f};rms={(sum(v * v for v in x) / n) ** 0.5:.3f};alaw={far([int(telephony.A_LAW[c]) for c in coded]):.3f};adpcm={far(heard):.3f};turns={turns};pcm16k={zlib.crc32(pcm):08x}"
    assert telephony.MU_LAW[[0x00, 0x80, 0xFF, 0x7F]].tolist() == [-32124, 32124, 0, 0] and telephony.A_LAW[[0xD5, 0x55, 0xAA, 0x2A]].tolist() == [8, -8, 32256, -32256]


def test_telephony_quality():
    wave = (np.sin(np.arange(2000) / 9) * 9000).astype(np.int16)
    edges = np.array([0, 2000])
    at, first = telephony.in_blocks(edges)
    back = telephony.adpcm_decode(telephony.adpcm_blocks(wave[at])).ravel()[telephony.places(edges, first)]
    assert np.abs(back.astype(int) - wave).mean() < 300
    for hertz in (300, 1000, 3000):  # a tone stays, and its image about 4 kHz is 50 dB down
        tone = np.round(np.sin(2 * np.pi * hertz * np.arange(4000) / 8000) * 20000).astype(np.int16)
        power = np.abs(np.fft.rfft(telephony.resample_double(tone, np.array([0, 4000]))[500:-500] * np.hanning(7000)))
        bins = np.arange(len(power)) * 16000 / 7000
        near = lambda f: power[np.abs(bins - f) < 20].max()
        assert near(8000 - hertz) < near(hertz) / 300


def test_near_duplicates(spark, docs):
    extra = [(100 + k, " ".join(f"t{j}" for j in range(60) if j != k)) for k in range(12)] + [(200, " ".join(f"t{j}" for j in range(30)))]
    both = docs.select("doc_id", "text").union(spark.createDataFrame(extra, "doc_id bigint, text string"))
    texts = [(d, t or "") for d, t in TEXTS + extra]
    for shingle in (2, 5):
        sets = []
        for _, t in texts:
            w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t))
            sets.append({tuple(w[k : k + shingle]) for k in range(len(w) - shingle + 1)} or ({tuple(w)} if w else set()))
        label = {d: d for d, _ in texts if d is not None}
        for _ in range(len(texts)):
            for (d, _), a in zip(texts, sets):
                for (e, _), b in zip(texts, sets):
                    if d is not None and e is not None and a and b and 100 * len(a & b) >= 80 * len(a | b):
                        label[d] = label[e] = min(label[d], label[e])
        want = [(d, len(s), None if d is None else label[d], d is None or label[d] == d) for (d, _), s in zip(texts, sets)]
        assert rows(neardup.near_duplicates(both, shingle=shingle), "doc_id", "n_shingles", "component_id", "kept") == sorted(want, key=repr)
    assert neardup.near_duplicates(both.limit(0)).count() == 0


@pytest.mark.parametrize("tile", [512, 8])
def test_near_duplicates_in_hot_buckets(spark, monkeypatch, tile):
    """Families of texts that share buckets but not all links, with hot keys in tiles and salted joins, against all pairs."""
    from docloom.llm import store

    monkeypatch.setattr(neardup, "LEAST_TILE", tile)
    monkeypatch.setattr(neardup, "BLOCKS", 4)
    monkeypatch.setattr(neardup, "MOST_TILE", 16)
    monkeypatch.setattr(store, "SALT_ROWS", 5)
    rng = np.random.default_rng(8)
    base = [f"w{j}" for j in range(80)]
    texts = [" ".join(w if rng.random() > share else f"x{rng.integers(99)}" for w in base) for share in (0.02, 0.05, 0.08, 0.12) for _ in range(25)]
    texts += [" ".join(base)] * 30
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    sets = [{tuple(t.split()[k : k + 2]) for k in range(len(t.split()) - 1)} for t in texts]
    label = list(range(len(texts)))
    changed = True
    while changed:
        changed = False
        for i, a in enumerate(sets):
            for j in range(i):
                if 100 * len(a & sets[j]) >= 80 * len(a | sets[j]) and label[i] != label[j]:
                    label[i] = label[j] = min(label[i], label[j])
                    changed = True
    assert rows(neardup.near_duplicates(docs, shingle=2), "doc_id", "component_id") == sorted(enumerate(label), key=repr)


def test_sketch_fills_and_estimates():
    rng = np.random.default_rng(2)
    for n in (1, 3, 40, 900):
        a = rng.integers(0, 2**63, n).astype(np.uint64)
        assert (neardup.sketch(a) != neardup.FULL).all()
        b = np.concatenate([a[: n * 4 // 5], rng.integers(0, 2**63, n - n * 4 // 5).astype(np.uint64)])
        j = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
        assert abs((neardup.sketch(a, 1000) == neardup.sketch(b, 1000)).mean() - j) < 0.08


def test_components(spark):
    edges = [(k, k + 1) for k in range(40)] + [(100, 90), (95, 100), (90, 95)] + [(500, 500 + k) for k in range(1, 30)]
    got = dict(rows(neardup.components(spark.createDataFrame(edges, "u bigint, v bigint")), "id", "component"))
    assert got == {k: 0 for k in range(1, 41)} | {95: 90, 100: 90} | {500 + k: 500 for k in range(1, 30)}


def test_licenses(spark, docs):
    got = {(r["doc_id"], r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]) for r in licenses.scan(docs, keep=["doc_id"]).collect()}
    assert got == {(d, *licenses.brute_force(t).values()) for d, t in TEXTS}
    text = "x\nLicensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance\nPermission is hereby granted, free of charge, to any person obtaining a copy\nall rights reserved"
    row = licenses.scan(spark.createDataFrame([(1, text)], "doc_id bigint, text string"), with_spans=True).first()
    assert row["labels"] == "apache,proprietary" and row["score"] == 1.0
    assert licenses.scan(docs.limit(0)).count() == 0
    assert licenses.scan(docs.withColumn("labels", F.lit("x")), keep=["doc_id", "labels"]).columns.count("labels") == 1


def scanned_by_force(text, templates):
    """Labels, score and findings of one text over all its windows and phrases."""
    base = licenses.brute_force(text)
    words, found = licenses.words_of(text), []
    for label, template in templates:
        own, width = set(licenses.words_of(template)), math.ceil(len(licenses.words_of(template)) / 0.8 - 1e-9)
        need = math.ceil(0.8 * len(own) - 1e-9)
        counts = [len(own & set(words[k : k + width])) for k in range(len(words))]
        k = 0
        while k < len(words):
            stop = k
            while stop < len(words) and counts[stop] >= need:
                stop += 1
            if stop > k:
                best = max(counts[k:stop])
                start = max(w for w in range(k, stop) if counts[w] == best and (w == k or counts[w - 1] != best))  # any place of the best does
                found.append((start, min(start + width, len(words)), label, best / len(own)))
            k = max(stop, k + 1)
    best = max([y for *_, y in found] + [1.0 if base["n_base"] else 0.0])
    return set(filter(None, base["base_labels"].split(","))), found, best


LICENSED = {
    "bsd": "Copyright (c) A\n\nRedistribution and use in source and binary forms, with or without\nmodification, are permitted provided that the following conditions\nare met:\n1. x",
    "mit": "# Permission is hereby granted, free of charge, to any person obtaining a copy\n# of this software and associated documentation files (the \"Software\"), to deal",
    "gpl": "  This program is free software: you can redistribute it and/or modify\r\n  it under the terms of the GNU General Public License as published by\r\n  the Free",
    "lgpl": "  This library is free software; you can redistribute it and/or modify\n  it under the terms of the GNU Lesser General Public License",
    "isc": " * Permission to use, copy, modify, and/or distribute this software for any\n * purpose with or without fee is hereby granted, provided that",
    "apache": "// Licensed under the Apache License, Version 2.0 (the \"License\");\n//\n// you may not use this file except in compliance with the License.",
    "zlib": "This software is provided 'as-is', without any express or implied\nwarranty. In no event will the authors be held liable for any\ndamages arising from the use of this software.",
}


def test_licenses_wrapped(spark):
    paragraphs = [licenses.words_of(t) for _, t in licenses.TEMPLATES]
    texts = list(LICENSED.items()) + [(label, "\n".join(licenses.words_of(t))) for label, t in licenses.TEMPLATES]
    whole = " ".join(t for label, t in licenses.TEMPLATES if label == "mit")
    texts += [("split", whole[:60]), ("split", whole[60:110]), ("empty", ""), ("far", "\n".join(" ".join(paragraphs[4]).replace(" and ", " and " + "x " * 9).split()))]
    rng = np.random.default_rng(5)
    for _ in range(150):
        parts = [w for i in rng.integers(0, len(paragraphs), 3) for w in paragraphs[i]]
        parts = [w if rng.random() < 0.9 else "other" for w in parts if rng.random() < 0.95]
        texts.append(("random", "".join(w + ("\n" if rng.random() < 0.2 else " ") for w in parts)))
    df = spark.createDataFrame([(k, t) for k, (_, t) in enumerate(texts)], "doc_id bigint, text string").repartition(2)
    for templates in (licenses.TEMPLATES, (*licenses.TEMPLATES, ("short", "other"))):
        got = {r["doc_id"]: r for r in licenses.scan(df, keep=["doc_id"], templates=templates, with_spans=True).collect()}
        for k, (name, t) in enumerate(texts):
            base, found, score = scanned_by_force(t, templates)
            labels = set(filter(None, got[k]["labels"].split(",")))
            assert round(got[k]["score"], 9) == round(score, 9), (name, t)
            # Where findings meet, the best stays: a label is there if a finding of it meets none that is better, by any choice of best windows.
            sure = {x for _, _, x, y in found if not any(z > y and label != x for _, _, label, z in found)}
            assert base | sure <= labels <= base | {x for _, _, x, _ in found}, (name, t)
            assert name not in LICENSED or name in labels
            assert {s["label"] for s in got[k]["spans"]} == labels
    assert [s["label"] for s in licenses.scan(df.where("doc_id = 0"), with_spans=True).first()["spans"]] == ["bsd"]
    assert licenses.scan(df.where("doc_id = 2")).first()["labels"] == "gpl" and licenses.scan(df.where("doc_id = 3")).first()["labels"] == "lgpl"


def test_license_windows_and_filters():
    """Findings, before the best are chosen, against every window; each filter stops stretches and none that holds a template."""
    rng = np.random.default_rng(9)
    tokens = licenses.template_tokens()
    paragraphs = [licenses.words_of(t) for _, t in licenses.TEMPLATES]
    scanner = licenses.Scanner({t: int(rng.integers(0, 99)) for t in tokens})
    for _ in range(60):
        text = [w for i in rng.integers(0, len(paragraphs), 4) for w in paragraphs[i] if rng.random() < 0.9]
        text += list(rng.choice(tokens + ["other"] * 9 * len(tokens), 900)) + list(rng.choice(tokens, 100))
        ids = np.array([scanner.ids.get(w, -1) for w in text], np.int32)
        got = sorted((label, round(score, 9)) for _, _, label, score in scanner.windows(ids, np.array([0, len(ids)])))
        assert got == sorted((label, round(score, 9)) for _, _, label, score in scanned_by_force(" ".join(text), licenses.TEMPLATES)[1])
    prefix, length, position, counted = scanner.reached
    assert prefix > length > position >= 60 and counted >= 60
    assert licenses.best_by_place([(0, 9, "a", 0.8), (5, 14, "b", 0.9), (20, 29, "a", 0.8), (21, 30, "a", 1.0)]) == [(5, 14, "b", 0.9), (20, 29, "a", 0.8), (21, 30, "a", 1.0)]


def repeats_by_force(texts):
    order = sorted(texts, key=lambda r: (r[0] is None, r[0] or 0))
    seen, out = {}, []
    for d, t in order:
        key = math.inf if d is None else d
        b = (t or "").encode()
        for k in range(len(b) - 49):
            seen[b[k : k + 50]] = min(seen.get(b[k : k + 50], math.inf), key)
    for d, t in texts:
        key = math.inf if d is None else d
        b = (t or "").encode()
        gone = bytearray(len(b))
        for k in range(len(b) - 49):
            if seen[b[k : k + 50]] < key:
                gone[k : k + 50] = b"\1" * 50
        kept = bytes(c for c, g in zip(b, gone) if not g)
        out.append((d, len(b), sum(gone), len(re.findall(b"\x01+", bytes(gone))), kept))
    return sorted(out, key=repr)


@pytest.mark.parametrize("frequent", [4096, 2])
def test_repeats(spark, docs, monkeypatch, frequent):
    monkeypatch.setattr(repeats, "FREQUENT", frequent)
    got = repeats.remove_repeats(docs, keep=["doc_id"])
    got = sorted(((r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], bytes(r["kept"])) for r in got.collect()), key=repr)
    assert got == repeats_by_force(TEXTS)
    assert repeats.remove_repeats(docs.limit(0)).count() == 0


def test_suffix_sort():
    rng = np.random.default_rng(3)
    text = rng.integers(97, 99, 3000).astype(np.uint8)
    start = rng.integers(0, 2900, 700)
    length, group = rng.integers(1, 90, 700), rng.integers(0, 5, 700).astype(np.uint64)
    order = suffixes.Suffixes(text).sort(start, length, group)
    plain = [(int(group[k]), bytes(text[start[k] : start[k] + length[k]])) for k in range(700)]
    assert [plain[k] for k in order] == sorted(plain)


def test_suffix_classes_when_hashes_lie(monkeypatch):
    rng = np.random.default_rng(6)
    text = rng.integers(97, 99, 4000).astype(np.uint8)
    start, group = rng.integers(0, 3900, 900), rng.integers(0, 4, 900)
    plain = [(int(group[k]), bytes(text[start[k] : start[k] + 10])) for k in range(900)]
    want = {(i, j) for i in range(900) for j in range(i) if plain[i] == plain[j]}
    honest = suffixes.Suffixes.equal
    for lie in (False, True):
        if lie:
            monkeypatch.setattr(suffixes.Suffixes, "equal", lambda self, a, b, n: honest(self, a, b, n) | ((a * 7 + b * 13 + n) % 50 == 0))
        got = suffixes.Suffixes(text).classes(start, 10, group)
        assert {(i, j) for i in range(900) for j in range(i) if got[i] == got[j]} == want


def test_language(spark, docs):
    model = langid.train(spark.createDataFrame([(k, x, t) for k in range(30) for x, t in (("en", "the house of the king and his men"), ("fr", "la maison du roi et ses hommes est là"), ("ru", "дом царя и его люди"))], "doc_id bigint, lang string, text string"))
    texts = [(1, "the king and the house"), (2, "la maison est là"), (3, "царь и люди"), (4, None), (5, "123 !?"), (6, "the house of the king and his men " * 3 + "la maison du roi et ses hommes " * 9)]
    got = langid.predict(spark.createDataFrame(texts, "doc_id bigint, text string"), model, with_spans=True)
    got = {r["doc_id"]: r for r in got.collect()}
    assert [got[k]["lang_pred"] for k in range(1, 7)] == ["en", "fr", "ru", "und", "und", "fr"]
    assert [s["lang"] for s in got[6]["spans"]] == ["en", "fr"] and got[4]["score"] == 0
    assert langid.predict(docs, model).count() == len(TEXTS)
    empty = langid.predict(docs, langid.train(docs.where("false")), keep=["doc_id"])
    assert {r["lang_pred"] for r in empty.collect()} == {"und"}
    assert langid.predict(docs.limit(0), model).count() == 0


def test_language_letters_ties_and_rare_languages(spark):
    """Letters count, not bytes; ties go to the first language; a language of one row in 10,000 keeps its words."""
    labelled = spark.range(30_000).selectExpr("id AS doc_id", "IF(id % 2 = 0, 'en', 'ru') AS lang", "IF(id % 2 = 0, concat('the house of the king w', hex(id)), concat('дом царя и его люди ', id)) AS text")
    rare = spark.createDataFrame([(k, "fr", "la maison du roi est là") for k in range(-3, 0)], "doc_id bigint, lang string, text string")
    model = langid.train(labelled.union(rare), rows=500, words=40)
    assert model.langs == ["en", "fr", "ru"] and model.known[:, 1].sum() == 6 and model.known[:, 0].sum() == 40
    text = "the house of the king of the house the king дом царя и его люди"
    script = [langid._letter_scripts()[ord(c)] for c in text]
    texts = [(1, text), (2, "la maison du roi est là"), (3, "the дом"), (4, "12 — “”"), (5, "la maison " * 40_000)]
    got = {r["doc_id"]: r for r in langid.predict(spark.createDataFrame(texts, "doc_id bigint, text string"), model, penalty=0.0).collect()}
    assert got[1]["lang_pred"] == "en" and got[1]["score"] == pytest.approx(script.count(0) / (script.count(0) + script.count(2)))
    assert [got[k]["lang_pred"] for k in (2, 3, 4, 5)] == ["fr", "en", "und", "fr"] and got[3]["score"] == 0.5


def test_language_viterbi_by_force():
    """Spans against every sequence of labels."""
    import itertools

    rng = np.random.default_rng(4)
    model = langid.Model(["a", "b", "c"], {("a", "x"): 1, ("b", "y"): 1, ("c", "z"): 1})
    counts = [0, 1, 5, 6, 3]
    first = np.cumsum([0, *counts])
    scores = rng.normal(0, 2, (int(first[-1]), 3)).astype(np.float32)
    for penalty in (0.0, 1.5, 6.0):
        label = model.spans(scores, first, penalty)
        for i, n in enumerate(counts):
            own = scores[first[i] : first[i + 1]]
            value = lambda path: sum(own[t, s] for t, s in enumerate(path)) - penalty * sum(x != y for x, y in zip(path, path[1:]))  # noqa: E731,B023
            assert value(label[first[i] : first[i + 1]]) == pytest.approx(max(map(value, itertools.product(range(3), repeat=n))), abs=1e-4)


def test_language_held_out(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    out = queries.op8_language(spark, "/root/testdata/sf0.01").join(docs.select("doc_id", "lang"), "doc_id").where("held_out")
    assert out.where("lang = lang_pred").count() >= 0.98 * out.count()


def test_mixing(spark, docs):
    got = mixing.mix(docs)
    con = duckdb.connect()
    con.register("documents", docs.toPandas().astype({"doc_id": "Int64"}))
    want = con.sql(f"SELECT doc_id, size, source_size, target, taken FROM ({queries.ORACLES['op9_mixing']})").fetchall()
    assert rows(got, "doc_id", "size", "source_size", "target", "taken") == sorted(want, key=repr)
    assert mixing.mixed(docs).count() == got.agg(F.sum("copies")).first()[0]
    assert mixing.mix(docs.limit(0)).count() == 0 and max(r["copies"] for r in got.collect()) <= 3


def test_html(spark):
    chain = htmltext.train_default()
    pages = htmltext.labelled_pages(100, 99)
    right = [a == b for source, labels in pages for a, b in zip(chain.labels(htmltext.features(htmltext.leaf_blocks(source))), labels)]
    assert sum(right) >= 0.97 * len(right)
    page = "<html><title>T</title><nav><a href=x>Home</a></nav><div class='cookie notice'>We use cookies.</div><article><h1>A &amp; B</h1><p>First\n  par <b>bold<br><p>Second &eacute; one, of some length.</article><div class=comments><p>Nice one.</p></div><footer>&copy; x</footer><script>var a='<p>no</p>';</script>"
    df = spark.createDataFrame([(1, page, "n"), (2, None, "n"), (3, "", "n")], "page_id bigint, html string, n_chars string")
    got = {r["page_id"]: (r["text"], r["n_chars"]) for r in htmltext.extract(df, chain).collect()}
    text = "A & B\n\nFirst par bold\n\nSecond é one, of some length."
    assert got == {1: (text, len(text)), 2: ("", 0), 3: ("", 0)}
    assert htmltext.extract(df.limit(0), chain).count() == 0 and htmltext.extract(df.union(df), chain).where("page_id = 1").count() == 2


def test_html_other_layouts():
    chain = htmltext.train_default()
    paragraphs = ["A headline of some words", "This is the first paragraph of an article, with a comma in it and a full stop.", "And the second one goes on for a while, as second paragraphs do."]
    h, a, b = paragraphs
    pages = [
        f'<nav><a href=a>Home</a> <a href=b>News</a></nav><article><h1>{h}</h1><p>{a}</p><p>{b}</p></article><h2>3 replies</h2><article class="reply"><p>Anna says:</p><p>I really enjoyed reading this, thanks a lot.</p></article><article class="reply"><p>Not my view at all, but well written.</p></article><footer>&copy; 2020</footer>',
        f"<div><div><a href=x>Home</a> | <a href=y>About</a> | <a href=z>Contact</a></div><div>{h}</div><div>{a}</div><div>{b}</div><div>Copyright 2020 Somebody. All rights reserved.</div></div>",
        f"<table><tr><td><a href=a>Home</a><br><a href=b>Products</a><br><a href=c>Contact</a></td><td><h1>{h}</h1><p>{a}</p><p>{b}</p></td></tr></table>",
    ]
    for page in pages:
        assert htmltext.main_text(f"<html><head><title>{h}</title></head><body>{page}</body></html>", chain) == "\n\n".join(paragraphs)


def test_html_tokens_and_linear_time():
    import time

    plain = lambda page: [x[0] for x in htmltext.leaf_blocks(page)]
    assert plain("a<p title='x > y' q=\"'>\">b</p>c < d<br>e<!-- <p>f --><script>g</p></SCRIPT >h<select><option>i</select>j") == ["a", "b", "c < d ehj"]
    assert plain("a<p title='x > y'>b</p>c < d") == ["a", "b", "c < d"]
    assert plain("a <b title=it's>b</b> c") == ["a b c"] and plain("x <y and z") == ["x <y and z"]
    assert plain("a<!-- b") == ["a"] and plain("a<script>b") == ["a"] and plain("a<select>b") == ["ab"] and plain('<p class="x>a</p><p>b') == ["a", "b"]
    chain = htmltext.train_default()
    for unit in ("<a ", '<a "', '<a <a " >', "<div class=x>", "<div class=x>y</b>", "<i><div><b>", '<a href="', "<select>", "<p>&amp", "</p>", "<b></i>"):
        began = time.perf_counter()
        htmltext.main_text(unit * (1_000_000 // len(unit)), chain)
        assert time.perf_counter() - began < 20, unit


def test_html_viterbi_and_gradients_by_force():
    import itertools

    chain = htmltext.train_default()
    for source, _ in htmltext.labelled_pages(12, 3):
        rows = htmltext.features(htmltext.leaf_blocks(source))[:10]
        assert chain.score(rows, chain.labels(rows)) == pytest.approx(max(chain.score(rows, y) for y in itertools.product((0, 1), repeat=len(rows))))
    pages = [(htmltext.features(htmltext.leaf_blocks(source)), labels) for source, labels in htmltext.labelled_pages(3, 4)]
    names, gradient = htmltext.likelihood(pages, 0.01)
    rng = np.random.default_rng(0)
    w, step = rng.normal(0, 0.3, (len(names), 2)), rng.normal(0, 0.3, (2, 2))
    _, grad, grad_step = gradient(w, step)
    for at in [(k, y) for k in rng.integers(0, len(names), 6) for y in (0, 1)]:
        d = np.zeros_like(w)
        d[at] = 1e-2
        assert grad[at] == pytest.approx((gradient(w + d, step)[0] - gradient(w - d, step)[0]) / 2e-2, abs=2e-3)
    for at in itertools.product((0, 1), repeat=2):
        d = np.zeros_like(step)
        d[at] = 1e-2
        assert grad_step[at] == pytest.approx((gradient(w, step + d)[0] - gradient(w, step - d)[0]) / 2e-2, abs=2e-3)


def test_pipeline(spark, docs, tmp_path):
    import corpus_pipeline as cp

    table = docs.select("doc_id", "text", "lang", "source", "n_chars")
    table.write.parquet(str(tmp_path / "documents.parquet"))
    kept = table
    for name, stage in cp.STAGES:
        out = stage(spark, kept, str(tmp_path))
        if name != "encoded":
            assert out.columns == table.columns
        out.write.parquet(str(tmp_path / name))
        kept = spark.read.parquet(str(tmp_path / name))
    assert kept.where("doc_id IN (5, 6, 7)").count() == 0 and kept.where("doc_id = 2").count() <= 3
    assert isinstance(kept.schema["ids"].dataType, T.ArrayType)
    assert cp.run(spark, str(tmp_path)).count() == kept.count()


def test_pipeline_by_force(spark, tmp_path):
    """Rows of run() against each stage in plain Python (the mix by its SQL)."""
    import sentencepiece

    import corpus_pipeline as cp

    rng = np.random.default_rng(12)
    known = {"en": [f"the{k}ing" for k in "abcdefghijklmnopqrstuvwxyz"], "ru": [f"слово{k}" for k in "абвгдежзийклмнопрст"]}
    texts = [(lang, " ".join(rng.choice(known[lang], 40))) for lang in ("en", "ru") for _ in range(30)]
    shared = texts[3][1][:90]
    texts += [("en", texts[k][1] + " " + texts[k][1][:9]) for k in range(8)]  # near copies
    texts += [("en", texts[5][1])] * 4 + [("en", f"{' '.join(rng.choice(known['en'], 30))} {shared} end{k}") for k in range(6)]
    bad = [None, "", "12 !?", "王の家と彼の男たち", " ".join(f"qx{k}zj" for k in range(60))]
    texts += [(None, t) for t in bad]
    rows = [(k, t, lang, f"s{k % 4}" if k % 9 else None, len(t or "")) for k, (lang, t) in enumerate(texts)]
    order = rng.permutation(len(rows))
    docs = spark.createDataFrame([rows[k] for k in order], "doc_id bigint, text string, lang string, source string, n_chars bigint").repartition(5)
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    # language
    kept = [r for r in rows if r[1] not in bad]
    # near copies, of sets of five words
    sets = [{tuple(w[k : k + 5]) for k in range(len(w) - 4)} or {tuple(w)} for w in (r[1].lower().split() for r in kept)]
    label = list(range(len(kept)))
    for _ in kept:
        for i, a in enumerate(sets):
            for j in range(i):
                if 100 * len(a & sets[j]) >= 80 * len(a | sets[j]):
                    label[i] = label[j] = min(label[i], label[j])
    kept = [r for k, r in enumerate(kept) if label[k] == k]
    assert len(kept) < len(rows) - len(bad) - 8
    # repeated passages
    left = {d: (n, gone, k.decode("utf-8", "ignore")) for d, n, gone, _, k in repeats_by_force([r[:2] for r in kept])}
    kept = [(r[0], left[r[0]][2], *r[2:4], len(left[r[0]][2])) for r in kept if left[r[0]][2] or not left[r[0]][1]]
    assert sum(x[1] > 0 for x in left.values()) >= 5
    # mix
    con = duckdb.connect()
    con.register("documents", spark.createDataFrame(kept, docs.schema).toPandas().astype({"doc_id": "Int64"}))
    taken = {d: n // size if size else 0 for d, n, size in con.sql(f"SELECT doc_id, taken, size FROM ({queries.ORACLES['op9_mixing']})").fetchall()}
    # pieces
    sp = sentencepiece.SentencePieceProcessor(model_file=queries.tokenizer("piece_bpe_32k.model"))
    want = [(d, lang, source, n, len(ids := sp.encode(t)), ids, hashlib.sha256(sp.decode(ids).encode()).hexdigest()) for d, t, lang, source, n in kept for _ in range(taken[d])]
    got = cp.run(spark, str(tmp_path))
    assert rows_of(got, "doc_id", "lang", "source", "n_chars", "n_tokens", "ids", "decoded_sha256") == sorted(want, key=repr)
    # Each stage with an empty table and with columns that operators name their outputs like.
    for _, stage in cp.STAGES:
        assert stage(spark, docs.limit(0), "").count() == 0
    clash = docs.withColumns({c: F.lit(f"own {c}") for c in ("kept", "kept_text", "n_removed", "component_id", "copies", "size", "score", "c0", "items")})
    for name, stage in cp.STAGES[:-1]:
        out = stage(spark, clash, "")
        assert out.columns == clash.columns, name
        assert {tuple(r) for r in out.select(*clash.columns[5:]).distinct().collect()} == {tuple(f"own {c}" for c in clash.columns[5:])}, name


rows_of = rows


def test_pipeline_language(spark):
    import corpus_pipeline as cp

    known = [(k, t, lang) for k in range(40) for lang, t in (("en", "the house of the king and his men"), ("ru", "дом царя и его люди"))]
    new = {
        100: "the king and царь и люди", 101: "“the” — house — … 😀😀😀😀😀😀😀😀 ☃☃☃☃☃☃☃☃☃☃", 102: "ngôi nhà của nhà vua và những người đàn ông ế ở ỡ", 103: "the house of the king 王の家", 104: "царь и люди",
        200: "王の家と彼の男たち", 201: "το σπίτι του βασιλιά and", 202: "123 !?", 203: None, 204: "“” — 😀",
    }
    docs = spark.createDataFrame(known + [(k, t, None) for k, t in new.items()], "doc_id bigint, text string, lang string")
    got = [r["doc_id"] for r in cp.language(spark, docs, "").collect()]
    assert sorted(got) == sorted([k for k, _, _ in known] + [100, 101, 102, 103, 104])
    # Long texts of a language that shares a script with learned ones go, long mixed ones stay.
    long = {300: "ngôi nhà của nhà vua và những người đàn ông ế ở ỡ " * 9, 301: "ngôi nhà của nhà vua và những người " * 9 + " the house of the king" * 3, 302: "the house " * 99}
    more = known + [(k, t, None) for k, t in long.items()]
    clash = spark.createDataFrame([(*r, "s", "p", True) for r in more], "doc_id bigint, text string, lang string, score string, lang_pred string, accepted boolean")
    kept = cp.language(spark, clash, "")
    assert kept.columns == clash.columns and sorted(tuple(r) for r in kept.where("doc_id >= 300").collect()) == [(k, long[k], None, "s", "p", True) for k in (301, 302)]
    assert cp.language(spark, docs.limit(0), "").count() == 0


def test_pipeline_repeated_ids(spark):
    import corpus_pipeline as cp

    def words(k):
        return [f"w{k}x{j}" for j in range(60)]

    a, b, c, d, e = (" ".join(words(k)) for k in range(5))
    near = " ".join(words(0)[:-1] + ["other"])
    rows = [
        (1, a, "s1"), (1, b, "s1"), (1, near, "s1"), (1, a, "s0"), (1, a, "s1"),  # a and near are near copies, a stands thrice
        (2, b, "s2"), (5, near, "s3"), (5, c, "s3"), (7, c, "s4"), (8, d, "s5"), (9, d, "s6"), (None, a, "s7"), (None, a, "s7"), (10, e, "s8"),
    ]
    stays = min((hashlib.sha256(t.encode()).hexdigest(), t) for t in (a, near))[1]
    want = [(1, stays, "s0" if stays == a else "s1"), (1, b, "s1"), (5, c, "s3"), (8, d, "s5"), (None, a, "s7"), (None, a, "s7"), (10, e, "s8")]
    for n, order in ((1, rows), (5, rows[::-1])):
        docs = spark.createDataFrame(order, "doc_id bigint, text string, source string").repartition(n)
        got = [tuple(r) for r in cp.near_copies(spark, docs, "").collect()]
        assert sorted(got, key=repr) == sorted(want, key=repr)
    unique = docs.dropDuplicates(["doc_id"]).where("doc_id IS NOT NULL")
    assert cp.near_copies(spark, unique, "").columns == docs.columns
    assert cp.language(spark, docs.withColumn("lang", F.lit(None).cast("string")), "").count() == 0

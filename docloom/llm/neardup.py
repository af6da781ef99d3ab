"""Near-duplicate classes: fast similarity sketches, banding, exact verification on full sets, components.

A sketch has COORDS coordinates. In round i every shingle of a set falls into one hashed bin with the
value (i, hash); a bin keeps its least value, so early rounds win, and rounds end when all bins are
filled. After COORDS random rounds, round COORDS + j puts every shingle into bin j: no coordinate stays
empty. Equal coordinates estimate the Jaccard similarity with concentration, also for small sets.

Sets that are equal collapse to one node first (the least doc_id). In each band bucket all nodes are
checked against the bucket's least node; only where a bucket still holds several components are
nodes of different components compared with each other, tile by tile, by counts of their shingles in
BINS bins: the sum of the lesser counts is never less than the intersection, so what it rules out is
never linked, and all other pairs are verified on full sets. No group's pairs are all emitted.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bytetext import LOWER, NOT_SPACE, U, flat, mix, pieces, span_hash, tidy, word_spans
from .store import bounded_batches, materialize, release, salted, small

#: Bands of ROWS coordinates: at similarity 0.8 a pair is missed with probability (1 - 0.8**5)**30 < 1e-5.
ROWS, BANDS = 5, 30
COORDS = ROWS * BANDS
SHINGLE, PERCENT = 2, 80
#: Ids up to which texts to be verified are picked by a broadcast; beyond it by a shuffle.
PICKED = 500_000
#: Bins in which shingles are counted.
BINS = 1024
#: Nodes in a block of a bucket: a bucket has BLOCKS blocks, of LEAST_TILE to MOST_TILE nodes where its size allows.
LEAST_TILE, MOST_TILE, BLOCKS = 512, 4096, 64
#: Equal sets of over 1 / HOT of all rows find their node by a broadcast of at most HOT rows.
HOT = 1_000
FULL = np.uint64(0xFFFFFFFFFFFFFFFF)
GOLD = 0x9E3779B97F4A7C15


def sketch(items: np.ndarray, coords: int = COORDS) -> np.ndarray:
    """Fast similarity sketch of a set of distinct 64-bit items (not empty)."""
    bins = np.full(coords, FULL)
    n, done = len(items), 0
    while done < coords:
        rounds = min(coords - done, max(1, math.ceil(coords * (math.log(coords) + 2) / n)))
        seeds = np.arange(done + 1, done + rounds + 1, dtype=np.uint64) * U(GOLD)
        x = mix(items[None, :] + seeds[:, None])
        value = (x & U(0xFFFFFFFF)) | (np.arange(done, done + rounds, dtype=np.uint64) << U(32))[:, None]
        np.minimum.at(bins, (((x >> U(32)) * U(coords)) >> U(32)).ravel().astype(np.int64), value.ravel())
        done += rounds
        if bins.max() != FULL:
            return bins
    for j in np.flatnonzero(bins == FULL):
        bins[j] = (mix(items + U((GOLD * (coords + int(j) + 1)) & (1 << 64) - 1)) & U(0xFFFFFFFF)).min() | (U(coords + int(j)) << U(32))
    return bins


def band_keys(bins: np.ndarray, rows: int = ROWS) -> np.ndarray:
    parts = bins.reshape(-1, rows)
    key = np.arange(len(parts), dtype=np.uint64)
    for c in range(rows):
        key = mix(key * U(GOLD) + parts[:, c])
    return key.view(np.int64)


def shingle_sets(buf: np.ndarray, offs: np.ndarray, shingle: int = SHINGLE):
    """Each row's sorted distinct shingle hashes: words lower-cased in A-Z; fewer words than a shingle make one."""
    for i, j in pieces(offs):
        part, o = LOWER[buf[offs[i] : offs[j]]], offs[i : j + 1] - offs[i]
        starts, ends, first = word_spans(part, o, NOT_SPACE)
        words = span_hash(part, starts, ends)
        joined = words.copy()
        for k in range(1, shingle):
            joined[: len(words) - k] = mix(joined[: len(words) - k] * U(GOLD) + words[k:])
        for r in range(j - i):
            a, b = first[r], first[r + 1]
            if b - a >= shingle:
                yield np.unique(joined[a : b - shingle + 1])
            elif b > a:
                h = words[a : a + 1]
                for k in range(a + 1, b):
                    h = mix(h * U(GOLD) + words[k])
                yield mix(h + U(int(b - a)))
            else:
                yield words[:0]


def _sketched(docs: DataFrame, shingle: int) -> DataFrame:
    @tidy
    def run(batches):
        for batch in batches:
            buf, offs = flat(batch.column(1))
            n, a, b, bands = [], [], [], []
            for s in shingle_sets(buf, offs, shingle):
                n.append(len(s))
                d = hashlib.blake2b(s.tobytes(), digest_size=16).digest()
                a.append(int.from_bytes(d[:8], "little", signed=True))
                b.append(int.from_bytes(d[8:], "little", signed=True))
                bands.append(band_keys(sketch(s)) if len(s) else None)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(bands, pa.list_(pa.int64()))], names=["doc_id", "n", "a", "b", "bands"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id bigint, n bigint, a bigint, b bigint, bands array<bigint>")


def _sets(docs: DataFrame, shingle: int) -> DataFrame:
    @tidy
    def run(batches):
        for batch in batches:
            buf, offs = flat(batch.column(1))
            rows = [s.tobytes() for s in shingle_sets(buf, offs, shingle)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, pa.binary())], names=["id", "items"])

    return docs.select("doc_id", "text").mapInArrow(run, "id bigint, items binary")


def verified(docs: DataFrame, pairs: DataFrame, shingle: int, percent: int) -> DataFrame:
    """Of the pairs (u, v), those whose full sets have 100 * intersection >= percent * union."""
    ids = materialize(pairs.select(F.col("u").alias("id")).union(pairs.select("v")).distinct(), "picked")
    chosen = docs.join(small(ids, PICKED), docs["doc_id"] == ids["id"], "left_semi")
    sets = materialize(_sets(chosen, shingle), "sets")
    repeated = sets.groupBy("id").count().where("count > 1").limit(1).count()
    if repeated:  # an id may have several texts, and rows may be repeated
        sets, found = materialize(sets.distinct(), "sets"), sets
        release(found)
    left = materialize(salted(pairs, sets, "v", "items", "y"), "left")
    both = salted(left, sets, "u", "items", "x").select("u", "v", "x", "y")

    @tidy
    def run(batches):
        for batch in batches:
            keep = []
            for x, y in zip(batch.column(2), batch.column(3)):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                if 100 * min(len(x), len(y)) < percent * max(len(x), len(y)):
                    keep.append(False)
                    continue
                same = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * same >= percent * (len(x) + len(y) - same))
            yield batch.select(["u", "v"]).filter(pa.array(keep, pa.bool_()))

    out = materialize(both.mapInArrow(run, "u bigint, v bigint"), "links")
    release(ids, sets, left)
    return out


def components(edges: DataFrame) -> DataFrame:
    """(id, component) of every id in edges (u, v): its least reachable id. Large-star and small-star rounds."""
    edges = materialize(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v").distinct(), "edges")
    while True:
        # A forest of stars has each child once and no child as a parent.
        seen = edges.select(F.col("u").alias("id"), F.lit(1).alias("c"), F.lit(0).alias("p")).union(edges.select("v", F.lit(0), F.lit(1))).groupBy("id").agg(F.sum("c").alias("c"), F.sum("p").alias("p"))
        if not seen.where("c > 1 OR (c > 0 AND p > 0)").limit(1).count():
            break
        both = edges.union(edges.select("v", "u"))
        least = materialize(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")).select(F.col("u").alias("at"), "m"), "least")
        large = both.join(least, both["u"] == least["at"]).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        large = materialize(large, "large")
        least2 = materialize(large.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("at"), "m"), "least")
        up = large.join(least2, large["u"] == least2["at"])
        fresh = materialize(up.select(F.col("v").alias("u"), F.col("m").alias("v")).union(up.select("u", "m")).where("u <> v").distinct(), "edges")
        release(edges, least, large, least2)
        edges = fresh
    return edges.select(F.col("u").alias("id"), F.col("v").alias("component"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5, percent: int = PERCENT) -> DataFrame:
    """Classes of documents whose shingle sets have 100 * intersection >= percent * union, transitively.

    Returns one row per input row: doc_id, n_shingles, component_id (the least doc_id reachable), kept
    (doc_id = component_id). A text without words, or null, has an empty set and is linked with
    nothing; fewer words than a shingle make one shingle; very long texts are taken whole. Rows with
    one id are one document. A row without an id is linked with nothing: component_id null, kept
    true. Other columns are not read, whatever their names; an empty table gives an empty one.
    """
    docs = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    bounded_batches(docs.sparkSession)
    sketched = materialize(_sketched(docs, shingle), "sketches")
    linkable = (F.col("n") > 0) & F.col("doc_id").isNotNull()
    least = materialize(sketched.where(linkable).groupBy("a", "b").agg(F.min("doc_id").alias("node"), F.count(F.lit(1)).alias("rows")), "nodes")
    most = sketched.count() // HOT
    hot = F.broadcast(least.where(F.col("rows") > most).select("a", "b", F.col("node").alias("hot")))  # fewer than HOT rows
    marked = sketched.join(hot, ["a", "b"], "left")
    cold = marked.where("hot IS NULL").drop("hot").join(least.where(F.col("rows") <= most).select("a", "b", "node"), ["a", "b"], "left")
    member = cold.unionByName(marked.where("hot IS NOT NULL").withColumnRenamed("hot", "node"))
    member = materialize(member.select("doc_id", "n", F.when(linkable, F.col("node")).otherwise(F.col("doc_id")).alias("node"), F.when(linkable & (F.col("doc_id") == F.col("node")), F.col("bands")).alias("bands")), "members")
    release(sketched, least)
    band = member.where("bands IS NOT NULL").select("node", F.explode("bands").alias("key"))
    lead = band.groupBy("key").agg(F.min("node").alias("lead"), F.max("node").alias("last")).where("lead <> last")
    lead = materialize(lead.select(F.col("key").alias("k"), "lead"), "leads")
    shared = materialize(band.join(lead, band["key"] == lead["k"]).select("key", "node", "lead"), "shared")
    star = shared.where("node <> lead").select(F.col("node").alias("u"), F.col("lead").alias("v")).distinct()
    star = materialize(star, "star")
    release(lead)
    links = verified(docs, star, shingle, percent)
    # Ids that stand in several rows with different sets.
    twice = member.where("n > 0").groupBy("doc_id").agg(F.min("node").alias("lo"), F.max("node").alias("hi")).where("lo < hi").select(F.col("doc_id").alias("id"), "lo")
    twice = materialize(twice, "twice")
    own = member.join(twice, member["doc_id"] == twice["id"]).select(F.col("node").alias("u"), F.col("lo").alias("v")).where("u <> v")
    links, found = materialize(links.union(own), "all-links"), links
    release(found, twice)
    part = components(links)
    rest = unresolved(docs, member, shared, part, star, shingle, percent)
    if rest is not None:
        more = verified(docs, rest, shingle, percent)
        part = components(links.union(more))
        release(rest, more)
    release(shared, star, links)
    part = part.select(F.col("id").alias("node_id"), "component")
    out = member.join(part, member["node"] == part["node_id"], "left")
    component = F.coalesce("component", "node")
    return out.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))


def _binned(docs: DataFrame, shingle: int) -> DataFrame:
    """(id, n, bins, over): the size of each set, its counts in BINS bins, 255 at most, and how much they leave out."""
    @tidy
    def run(batches):
        for batch in batches:
            buf, offs = flat(batch.column(1))
            n, bins, over = [], [], []
            for s in shingle_sets(buf, offs, shingle):
                count = np.bincount((mix(s) & U(BINS - 1)).astype(np.int64), minlength=BINS)
                n.append(len(s))
                bins.append(np.minimum(count, 255).astype(np.uint8).tobytes())
                over.append(int(np.maximum(count - 255, 0).sum()))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(bins, pa.binary()), pa.array(over, pa.int64())], names=["id", "n", "bins", "over"])

    return docs.select("doc_id", "text").mapInArrow(run, "id bigint, n bigint, bins binary, over bigint")


def _plausible(table: pa.Table, percent: int) -> pa.Table:
    """Pairs (u, v) of one bucket's tile that lie in different components and aren't ruled out by their counts.

    A pair comes out of the first bucket alone that both share.
    """
    key, x, y = (table.column(c)[0].as_py() for c in ("key", "x", "y"))
    node, comp, block, n, over = (table.column(c).to_numpy() for c in ("node", "c", "block", "n", "over"))
    bins = np.stack([np.frombuffer(b.as_buffer(), np.uint8) for b in table.column("bins")])
    bands = np.stack([np.asarray(b.values) for b in table.column("bands")])
    us, vs = [], []
    for i in range(len(node)):
        if x != y and block[i] != x:
            continue
        rest = np.flatnonzero(comp[i + 1 :] != comp[i]) + i + 1 if x == y else np.flatnonzero((block == y) & (comp != comp[i]))
        rest = rest[100 * np.minimum(n[rest], n[i]) >= percent * np.maximum(n[rest], n[i])]
        same = bands[rest] == bands[i]
        rest = rest[same.any(1) & (bands[i][same.argmax(1)] == key)] if len(rest) else rest
        if not len(rest):
            continue
        most = np.minimum(bins[rest], bins[i]).sum(1, dtype=np.int64) + np.minimum(over[rest], over[i])
        other = node[rest[100 * most >= percent * (n[rest] + n[i] - most)]]
        us.append(np.maximum(other, node[i]))
        vs.append(np.minimum(other, node[i]))
    u, v = (np.concatenate(w) if w else np.zeros(0, np.int64) for w in (us, vs))
    return pa.table({"u": pa.array(u, pa.int64()), "v": pa.array(v, pa.int64())})


def unresolved(docs: DataFrame, member: DataFrame, shared: DataFrame, part: DataFrame, tried: DataFrame, shingle: int, percent: int) -> DataFrame | None:
    """Pairs of nodes that share a bucket but no component, weren't checked yet and may reach the similarity; None if there are none.

    Buckets are worked through in tiles of two blocks, whatever their size.
    """
    held = shared.join(part, shared["node"] == part["id"], "left").select("key", "node", F.coalesce("component", "node").alias("c"))
    held = materialize(held, "held")
    mixed = held.groupBy("key").agg(F.min("c").alias("lo"), F.max("c").alias("hi"), F.count(F.lit(1)).alias("size")).where("lo <> hi AND size > 2")
    mixed = materialize(mixed.select(F.col("key").alias("k"), "size"), "mixed")
    if not mixed.limit(1).count():
        release(held, mixed)
        return None
    tile = F.greatest(F.lit(LEAST_TILE), F.least(F.lit(MOST_TILE), F.col("size") / BLOCKS))
    left = materialize(held.join(mixed, held["key"] == mixed["k"]).select("key", "node", "c", F.ceil(F.col("size") / tile).cast("int").alias("blocks")), "held")
    release(held, mixed)
    ids = materialize(left.select(F.col("node").alias("id")).distinct(), "picked")
    binned = _binned(docs.join(small(ids, PICKED), docs["doc_id"] == ids["id"], "left_semi"), shingle).distinct()
    binned = binned.join(member.where("bands IS NOT NULL").select("doc_id", "bands").distinct(), F.col("id") == F.col("doc_id")).select("id", "n", "bins", "over", "bands")
    binned = materialize(binned, "binned")
    tiles = left.withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")).withColumn("z", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    tiles = tiles.select("key", "node", "c", "block", F.least("block", "z").alias("x"), F.greatest("block", "z").alias("y"))
    tiles = tiles.join(binned, tiles["node"] == binned["id"]).select("key", "x", "y", "block", "node", "c", "n", "bins", "over", "bands")
    pairs = tiles.groupBy("key", "x", "y").applyInArrow(lambda t: _plausible(t, percent), "u bigint, v bigint").distinct()
    pairs = materialize(pairs.join(tried, ["u", "v"], "left_anti"), "rest")
    release(ids, left, binned)
    return pairs if pairs.limit(1).count() else None

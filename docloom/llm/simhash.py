"""Document fingerprints: SimHash by DataFrame functions only, and block tables for Hamming search.

A text's terms are its five-word shingles, one vote a place, so a term weighs as often as it occurs.
Every term's 128 hash bits vote up or down; a bit is set if the ups prevail. Votes are summed two
bits to a long (32 bits for each count), so a text may have 2**31 shingles.

The shuffle deals whole texts out once, by ranges of doc_id: the window that finds the next document,
the votes and the likeness all run on that partitioning.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .store import bytes_of_text, hot_parts, materialize, release, small

WORD = "[^\\x20\\x09-\\x0D]+"
SHINGLE, BITS, LANE = 5, 128, 0x0000000100000001
#: Hamming radius of the search, and blocks of the fingerprint: RADIUS errors leave BLOCKS - RADIUS blocks whole.
RADIUS, BLOCKS = 6, 8
#: Bytes of text that a range of ids should hold, and the most ranges (beyond them ranges grow; results don't change).
RANGE_BYTES, RANGES = 32 << 20, 65_536


def _id_ranges(docs: DataFrame, key: Column, n: int) -> list[int]:
    """At most n - 1 rising bounds that split the ids evenly; only their number grows with the input."""
    step = [(i + 1) / n for i in range(n - 1)]
    got = docs.select(F.percentile_approx(key, step, 4 * n).alias("b")).first()["b"] if step else None
    return sorted(set(got or []))


def _range_of(df: DataFrame, bounds: list[int]) -> DataFrame:
    """Adds __range: how many bounds are at most __key, by binary search in a literal array."""
    df = df.withColumn("__range", F.lit(0))
    if not bounds:
        return df
    wide = F.array(*[F.lit(b).cast("long") for b in bounds]) if len(bounds) <= 64 else F.from_json(F.lit("[" + ",".join(map(str, bounds)) + "]"), "array<bigint>")
    step = 1 << (len(bounds).bit_length() - 1)
    while step:
        at = F.col("__range") + step
        df = df.withColumn("__range", F.when((at <= len(bounds)) & (F.get(wide, at - 1) <= F.col("__key")), at).otherwise(F.col("__range")))
        step >>= 1
    return df


def _next_in_line(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Rows (__range, __rn, __guest, doc_id, text, next): whole texts in descending order of id, in ranges.

    The first row of each range visits the range before it (and the first of all the last) as a guest.
    """
    spark = docs.sparkSession
    key = F.coalesce(F.col(f"`{id_col}`").cast("long"), F.lit(-(1 << 63)))
    rows = docs.select(F.col(f"`{id_col}`").alias("doc_id"), key.alias("__key"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"))
    wanted = max(4 * int(spark.conf.get("spark.sql.shuffle.partitions")), bytes_of_text(docs, text_col) // RANGE_BYTES)
    rows = _range_of(rows, _id_ranges(docs, key, min(RANGES, wanted)))
    tops = rows.groupBy("__range").agg(F.max("__key").alias("top"))
    line = Window.orderBy(F.col("__range").asc())
    everything = Window.partitionBy()
    tops = tops.select("top", F.coalesce(F.lead("__range").over(line), F.min("__range").over(everything)).alias("visits"))
    tops = small(materialize(tops, "tops"), RANGES)
    rows = rows.join(tops, rows["__key"] == tops["top"], "left")
    rows = rows.select("doc_id", "__key", "text", F.explode(F.when(F.col("visits").isNull(), F.array(F.struct("__range", F.lit(False).alias("__guest")))).otherwise(F.array(F.struct("__range", F.lit(False).alias("__guest")), F.struct(F.col("visits").alias("__range"), F.lit(True).alias("__guest"))))).alias("at"))
    rows = rows.select("doc_id", "__key", "text", "at.*")
    order = Window.partitionBy("__range").orderBy(F.col("__guest"), F.col("__key").desc(), F.col("text"))
    return rows.select("__range", "__guest", "doc_id", "text", F.row_number().over(order).alias("__rn"), F.lead("text").over(order).alias("next"))


def votes(texts: DataFrame, keys: list[str], carry: dict[str, Column], text_col: str = "text") -> DataFrame:
    """SimHash of each text: keys, lo, hi (128 bits) and the carried longs. ``keys`` name a text."""
    texts = texts.select(*keys, *[c.alias(n) for n, c in carry.items()], F.regexp_extract_all(F.col(text_col), F.lit(WORD), F.lit(0)).alias("__w"))
    each = texts.select(*keys, *carry, "__w", F.explode_outer(F.sequence(F.lit(0), F.greatest(F.size("__w") - SHINGLE, F.lit(0)))).alias("__i"))
    each = each.select(*keys, *carry, F.xxhash64(*[F.get("__w", F.col("__i") + k) for k in range(SHINGLE)]).alias("__h"))
    each = each.select(*keys, *carry, "__h", F.xxhash64("__h", F.lit(BITS)).alias("__g"))
    sums = [F.sum(F.shiftright(h, k).bitwiseAND(F.lit(LANE))).alias(f"{h}{k}") for h in ("__h", "__g") for k in range(32)]
    counted = each.groupBy(*keys).agg(*sums, F.count(F.lit(1)).alias("__n"), *[F.max(n).alias(n) for n in carry])

    def fingerprint(h: str) -> Column:
        bits = F.lit(0).cast("long")
        for k in range(32):
            low, high = F.col(f"{h}{k}").bitwiseAND(F.lit(0xFFFFFFFF)), F.shiftrightunsigned(F.col(f"{h}{k}"), 32)
            for bit, count in ((k, low), (k + 32, high)):
                bits = bits.bitwiseOR(F.when(count * 2 > F.col("__n"), F.lit(1 << bit if bit < 63 else -(1 << 63)).cast("long")).otherwise(F.lit(0).cast("long")))
        return bits

    return counted.select(*keys, *carry, fingerprint("__h").alias("lo"), fingerprint("__g").alias("hi"))


def likeness(a: tuple[Column, Column], b: tuple[Column, Column]) -> Column:
    """1 - Hamming distance / 128."""
    return 1 - (F.bit_count(a[0].bitwiseXOR(b[0])) + F.bit_count(a[1].bitwiseXOR(b[1]))) / F.lit(float(BITS))


def _hex(*longs: str) -> Column:
    return F.concat(*[F.lpad(F.lower(F.hex(c)), 16, "0") for c in longs])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of every whole text and of its edited text (null: empty).

    Edited: the last floor(n_chars / 3) code points give way to the first as many of the next document
    in descending order of id, the first following the last; rows with one id follow each other by
    text, a null id comes last. Returns per row doc_id, n_chars, edited_sha256, lo, hi,
    edited_lo, edited_hi, near_edited, near_next. A single row is its own next; repeated rows follow each
    other; very long texts are taken whole. Other columns are not read, whatever their names. An empty
    table gives none.
    """
    line = _next_in_line(docs, id_col, text_col)
    n = F.char_length("text")
    cut = F.floor(n / 3).cast("int")
    edited = F.concat(F.expr("left(text, char_length(text) - cast(floor(char_length(text) / 3) as int))"), F.substring(F.coalesce("next", F.lit("")), F.lit(1), cut))
    line = line.select("__range", "__guest", "doc_id", "text", "__rn", edited.alias("edited"), n.cast("long").alias("n_chars"))
    sha = F.sha2(F.col("__t").cast("binary"), 256)
    both = line.select("__range", "__rn", "__guest", "doc_id", "n_chars", F.explode(F.when(F.col("__guest"), F.array(F.struct(F.lit(0).alias("__v"), F.col("text").alias("__t")))).otherwise(F.array(F.struct(F.lit(0).alias("__v"), F.col("text").alias("__t")), F.struct(F.lit(1).alias("__v"), F.col("edited").alias("__t"))))).alias("x")).select("__range", "__rn", "__guest", "doc_id", "n_chars", "x.*")
    both = both.withColumn("__sha", F.when(F.col("__v") == 1, sha))
    carry = {"__guest": F.col("__guest").cast("int"), "doc_id": F.col("doc_id"), "n_chars": F.col("n_chars")} | {f"__s{k}": F.conv(F.substring("__sha", 16 * k + 1, 16), 16, -10).cast("long") for k in range(4)}
    prints = votes(both, ["__range", "__rn", "__v"], carry, "__t")
    first, second = F.col("__v") == 0, F.col("__v") == 1
    per = prints.groupBy("__range", "__rn").agg(
        *[F.max(c).alias(c) for c in ("__guest", "doc_id", "n_chars")], *[F.max(F.when(second, F.col(f"__s{k}"))).alias(f"__s{k}") for k in range(4)],
        *[F.max(F.when(first, F.col(c))).alias(c) for c in ("lo", "hi")], *[F.max(F.when(second, F.col(c))).alias(f"edited_{c}") for c in ("lo", "hi")],
    )
    order = Window.partitionBy("__range").orderBy("__rn")
    per = per.withColumns({f"next_{c}": F.lead(c).over(order) for c in ("lo", "hi")}).where(F.col("__guest") == 0)
    own = (F.col("lo"), F.col("hi"))
    return per.select("doc_id", "n_chars", _hex(*[f"__s{k}" for k in range(4)]).alias("edited_sha256"), "lo", "hi", "edited_lo", "edited_hi", likeness(own, (F.col("edited_lo"), F.col("edited_hi"))).alias("near_edited"), likeness(own, (F.col("next_lo"), F.col("next_hi"))).alias("near_next"))


def _block(i: int, prefix: str = "") -> Column:
    """The i-th 16 bits."""
    return F.shiftrightunsigned(F.col(f"{prefix}{'lo' if i < 4 else 'hi'}"), 16 * (i % 4)).bitwiseAND(F.lit(0xFFFF))


def within(prints: DataFrame, queries: DataFrame, radius: int = RADIUS) -> DataFrame:
    """All (query, fingerprint) pairs within ``radius`` bits, by permuted block tables.

    Both sides have lo, hi; queries are distinct, prints have ``docs``, the number of documents of a
    fingerprint. Every choice of BLOCKS - radius blocks that may stay whole is a table keyed by those
    blocks. A pair comes out of its first table alone, so no pair is repeated and none is sorted out later.
    A hot key's fingerprints are dealt to several tasks, to each of which its queries go.
    """
    if not 0 <= radius < BLOCKS:
        raise ValueError(f"the radius must lie in 0..{BLOCKS - 1}")
    tables = list(combinations(range(BLOCKS), BLOCKS - radius))

    def keyed(df: DataFrame) -> DataFrame:
        keys = [F.struct(F.lit(t).alias("t"), F.xxhash64(*[_block(i) for i in own]).alias("k")) for t, own in enumerate(tables)]
        return df.select("*", F.explode(F.array(*keys)).alias("__k")).select(*df.columns, "__k.t", "__k.k")

    left, right = keyed(queries.select(F.col("lo"), F.col("hi"))), keyed(prints.select("lo", "hi", "docs"))
    hot = hot_parts(right, ["t", "k"], prints.count() * len(tables))
    parts = F.coalesce("__parts", F.lit(1))
    right = right.join(hot, ["t", "k"], "left").withColumn("s", F.pmod(F.xxhash64("lo", "hi"), parts).cast("int"))
    left = left.join(hot, ["t", "k"], "left").withColumn("s", F.explode(F.sequence(F.lit(0), parts - 1)))
    left = left.select(F.col("lo").alias("q_lo"), F.col("hi").alias("q_hi"), F.col("t").alias("q_t"), F.col("k").alias("q_k"), F.col("s").alias("q_s"))
    same = [(_block(i) == _block(i, "q_")) for i in range(BLOCKS)]
    earliest = F.coalesce(*[F.when(F.reduce(F.array(*[same[i] for i in own]), F.lit(True), lambda a, b: a & b), F.lit(t)) for t, own in enumerate(tables)])
    far = F.bit_count(F.col("lo").bitwiseXOR(F.col("q_lo"))) + F.bit_count(F.col("hi").bitwiseXOR(F.col("q_hi")))
    return left.join(right, (F.col("q_t") == F.col("t")) & (F.col("q_k") == F.col("k")) & (F.col("q_s") == F.col("s")) & (far <= radius) & (earliest == F.col("t"))).select("q_lo", "q_hi", "lo", "hi", "docs", far.alias("distance"))


def search(prints: DataFrame, is_query: Column, radius: int = RADIUS) -> DataFrame:
    """prints and n_within: for query rows the number of other rows within ``radius`` bits, else null."""
    distinct = materialize(prints.groupBy("lo", "hi").agg(F.count(F.lit(1)).alias("docs"), F.max(F.coalesce(is_query, F.lit(False))).alias("asked")), "prints")
    found = within(distinct, distinct.where("asked"), radius).groupBy("q_lo", "q_hi").agg((F.sum("docs") - 1).alias("__within"))
    found = materialize(found, "within")
    release(distinct)
    out = prints.join(found, (F.col("lo") == F.col("q_lo")) & (F.col("hi") == F.col("q_hi")) & F.coalesce(is_query, F.lit(False)), "left")
    return out.select(*prints.columns, F.col("__within").alias("n_within"))

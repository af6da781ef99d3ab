"""Mixing sources to target weights by hash-threshold histograms (DataFrame functions only).

Words are summed by source and hash bucket, the bucket in which a source's budget ends is found,
only that bucket is split again (three levels of 1,024), and documents are kept by comparing their
hash with the source's threshold: nothing is sorted but the small histograms. Thresholds are nested:
a larger budget takes a superset of the documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .store import materialize, small

WORD = "[^\\x20\\x09-\\x0D]+"
LEVELS, BITS = 3, 10


def words(text_col: str = "text"):
    return F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD)), F.lit(0)).cast("long")


def targets(sized: DataFrame, weights: tuple[int, ...], limit: int) -> DataFrame:
    """Per source: source_size, target. One row a source, so the ranking window holds sources only."""
    per = sized.groupBy("src").agg(F.sum("size").alias("source_size"))
    everything, by_name = Window.partitionBy(), Window.orderBy(F.col("src").asc_nulls_last())
    per = per.withColumn("w", F.element_at(F.array(*[F.lit(w) for w in weights]), ((F.row_number().over(by_name) - 1) % len(weights) + 1).cast("int")).cast("long"))
    fill = Window.orderBy((F.col("source_size") * limit / F.col("w")).asc(), F.col("src").asc_nulls_last())
    before = fill.rowsBetween(Window.unboundedPreceding, -1)
    per = per.withColumns({
        "left": F.sum("source_size").over(everything) - F.coalesce(F.sum(F.col("source_size") * limit).over(before), F.lit(0)),
        "w_left": F.sum("w").over(everything) - F.coalesce(F.sum("w").over(before), F.lit(0)),
    })
    # Sources by rising limit per weight: each is at its limit if its share of what is left reaches it, the first that isn't sets the level for the rest.
    per = per.withColumn("full", F.col("source_size") * limit * F.col("w_left") <= F.col("left") * F.col("w"))
    level = F.min(F.when(~F.col("full"), F.struct(-F.col("w_left"), F.col("left"), F.col("w_left").alias("over")))).over(everything)
    per = per.withColumn("level", level)
    target = F.when(F.col("full"), (F.col("source_size") * limit).cast("double")).otherwise((F.col("level.left") * F.col("w")).cast("double") / F.col("level.over"))
    return per.select("src", "source_size", target.alias("target"))


def _cell(id_col: str):
    """The upper LEVELS * BITS bits of a hash of the id."""
    h = F.conv(F.substring(F.md5(F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit(""))), 1, 15), 16, 10).cast("long")
    return F.shiftright(h, 60 - LEVELS * BITS)


def plan(sized: DataFrame, weights: tuple[int, ...] = (5, 2, 1), limit: int = 3) -> DataFrame:
    """Per source (src): source_size, target, copies, cut: documents are taken copies times, once more below the cut.

    sized: one row a document with src, size, cell.
    """
    per = materialize(targets(sized, weights, limit), "targets")
    per = per.withColumn("copies", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long"))
    bound = per.select("src", (F.col("target") - F.col("copies") * F.col("source_size")).alias("rest"), F.lit(0).cast("long").alias("prefix"), F.lit(0).cast("long").alias("under"))
    for level in range(1, LEVELS + 1):
        shift = BITS * (LEVELS - level)
        b = small(bound.select(F.col("src").alias("b_src"), "prefix"))
        inside = sized.join(b, sized["src"].eqNullSafe(F.col("b_src")) & (F.shiftright("cell", shift + BITS) == F.col("prefix")), "inner")
        hist = inside.groupBy("src", F.shiftright("cell", shift).alias("at")).agg(F.sum("size").alias("n"))
        running = Window.partitionBy("src").orderBy("at").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        hist = hist.withColumn("upto", F.sum("n").over(running)).withColumnRenamed("src", "h_src")
        met = hist.join(bound, F.col("h_src").eqNullSafe(bound["src"]), "inner").where((F.col("upto") > F.col("rest")) & (F.col("upto") - F.col("n") <= F.col("rest")))
        found = met.select("src", (F.col("rest") - (F.col("upto") - F.col("n"))).alias("rest"), F.col("at").alias("prefix"), F.col("n").alias("under"))
        bound = materialize(found, f"bound{level}")
    # At the last level the whole boundary cell is taken if that lies nearer to the budget.
    cut = bound.select(F.col("src").alias("c_src"), (F.col("prefix") + F.when(F.col("under") - F.col("rest") < F.col("rest"), 1).otherwise(0)).alias("cut"))
    out = per.join(cut, per["src"].eqNullSafe(F.col("c_src")), "left").select("src", "source_size", "target", "copies", F.when(F.col("copies") < limit, F.coalesce("cut", F.lit(0))).otherwise(0).alias("cut"))
    return materialize(out, "plan")


def sizes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """doc_id, src, size, cell of each row, as a table: texts are read once."""
    return materialize(docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{source_col}`").alias("src"), words(f"`{text_col}`").alias("size"), _cell(id_col).alias("cell")), "sizes")


def copies_by(rows: DataFrame, per_source: DataFrame, source, cell) -> DataFrame:
    """rows with __copies, __source_size and __target from their source's plan."""
    p = small(per_source.select(F.col("src").alias("__p"), F.col("source_size").alias("__source_size"), F.col("target").alias("__target"), F.col("copies").alias("__base"), F.col("cut").alias("__cut")))
    out = rows.join(p, source.eqNullSafe(F.col("__p")), "inner")
    return out.withColumn("__copies", (F.col("__base") + F.when(cell < F.col("__cut"), 1).otherwise(0)).cast("long"))


def mix(docs: DataFrame, weights: tuple[int, ...] = (5, 2, 1), limit: int = 3, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """Copies of each document that bring every source to its share of all words.

    Sources in code-point order (null is a source of its own, last) weigh ``weights``, repeating,
    and share 100% of all words; a target stops at ``limit`` times its source's words and the excess
    is shared again. Every document of a source is taken floor(target / words) times, and once more
    if its hash lies under the source's threshold. The hash is of the id, so rows with one id are
    taken alike and reruns agree; a null id hashes as an empty string. Texts without words and null
    texts have size 0 and are copied like their neighbours. Empty tables give empty tables.

    Returns one row per input row: doc_id, source, size, source_size, target, copies, taken.
    """
    sized = sizes(docs, id_col, text_col, source_col)
    out = copies_by(sized, plan(sized, weights, limit), sized["src"], F.col("cell"))
    return out.select("doc_id", F.col("src").alias("source"), "size", F.col("__source_size").alias("source_size"), F.col("__target").alias("target"), F.col("__copies").alias("copies"), (F.col("__copies") * F.col("size")).alias("taken"))


def mixed(docs: DataFrame, weights: tuple[int, ...] = (5, 2, 1), limit: int = 3, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """The mix itself: the rows of docs, each as often as ``mix`` says, with the columns of docs."""
    per_source = plan(sizes(docs, id_col, text_col, source_col), weights, limit)
    out = copies_by(docs, per_source, docs[f"`{source_col}`"], _cell(id_col)).where("__copies > 0")
    return out.select(*[docs[f"`{c}`"] for c in docs.columns], F.explode(F.sequence(F.lit(1), F.col("__copies"))).alias("__copy")).drop("__copy")

"""Relational operators over document contents, as DataFrame transformations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docloom.session import checkpointed


def window_lines(lines: DataFrame, keys: list[str], offset: int = 1, limit: int | None = None, line_no: str = "line_no") -> DataFrame:
    """Lines offset .. offset + limit - 1 of each document (from 1); line numbers are dense per document.

    A filter on line_no, so no sort and no shuffle. A negative limit counts from the end, which needs each document's total.
    """
    start = max(0, offset - 1)
    kept = lines.where(F.col(line_no) > start)
    if limit is None:
        return kept
    if start + limit >= 0 and limit >= 0:
        return kept.where(F.col(line_no) <= start + limit)
    total = F.max(line_no).over(Window.partitionBy(*keys))
    last = start + limit
    return lines.withColumn("__n", total).where((F.col(line_no) > start) & (F.col(line_no) <= (F.col("__n") + last if last < 0 else F.lit(last)))).drop("__n")


def window_summary(lines: DataFrame, keys: list[str], offset: int = 1, limit: int | None = None) -> DataFrame:
    """total_lines and truncated (lines follow the window) of each document."""
    n = F.count(F.lit(1))
    cut = F.lit(False) if limit is None else n > max(0, offset - 1) + limit
    return lines.groupBy(*keys).agg(n.alias("total_lines"), cut.alias("truncated"))


def lines_of(df: DataFrame, text: Column, keys: list[str]) -> DataFrame:
    """One row a line: keys, line_no (from 1), line."""
    return df.select(*keys, F.posexplode(F.split(text, "\n")).alias("__p", "line")).select(*keys, (F.col("__p") + 1).cast("long").alias("line_no"), "line")


def deal_out(df: DataFrame, least: int = 32) -> DataFrame:
    """Rows in equal shares over four tasks a core, ``least`` at any rate: for work that takes long on short rows.

    A file of few bytes is one or two tasks, however many rows it has.
    """
    return df.repartition(max(least, 4 * df.sparkSession.sparkContext.defaultParallelism))


def sheet_union(sheets: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of all sheets as numbered lines, a marker before each; sheets has keys, sheet_ix, sheet_name, row_ix (0, 1, 2, ...), line.

    A sheet without rows is one row with a null row_ix: its marker stands alone.
    """
    sizes = sheets.groupBy(*keys, "sheet_ix", "sheet_name").agg((F.coalesce(F.max("row_ix"), F.lit(-1)) + 2).cast("long").alias("__n"))
    # Line numbers follow from the sizes of the sheets before: only sheets are sorted, no rows.
    before = Window.partitionBy(*keys).orderBy("sheet_ix").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.withColumn("__before", F.coalesce(F.sum("__n").over(before), F.lit(0)))
    marker = sizes.select(*keys, (F.col("__before") + 1).alias("line_no"), F.concat(F.lit("[Sheet: "), "sheet_name", F.lit("]")).alias("line"))
    rows = sheets.where("row_ix >= 0").join(sizes.select(*keys, "sheet_ix", "__before"), [*keys, "sheet_ix"])
    return marker.unionByName(rows.select(*keys, (F.col("__before") + F.col("row_ix") + 2).cast("long").alias("line_no"), "line"))


def dense_grid(cells: DataFrame, keys: list[str], row: str, col: str, value: str) -> DataFrame:
    """Each row from 0 to the last with its full width; absent cells are empty. keys, row_ix, cells."""
    size = cells.groupBy(*keys).agg(F.max(row).alias("__r"), F.max(col).alias("__c"))
    grid = size.select(*keys, "__c", F.explode(F.sequence(F.lit(0).cast("long"), F.col("__r").cast("long"))).alias("row_ix"))
    held = cells.groupBy(*keys, F.col(row).cast("long").alias("row_ix")).agg(F.map_from_entries(F.collect_list(F.struct(F.col(col).cast("long"), F.col(value).cast("string")))).alias("__m"))
    out = grid.join(held, [*keys, "row_ix"], "left")
    wide = F.transform(F.sequence(F.lit(0).cast("long"), F.col("__c").cast("long")), lambda c: F.coalesce(F.try_element_at("__m", c), F.lit("")))
    return out.select(*keys, "row_ix", wide.alias("cells"))


def dictionary_lookup(df: DataFrame, key: str, dictionary: DataFrame, dict_key: str, dict_value: str, out: str) -> DataFrame:
    """A left lookup; what is missing becomes empty. Spark broadcasts the dictionary if it is small."""
    d = dictionary.select(F.col(dict_key).alias("__k"), F.col(dict_value).alias("__v"))
    return df.join(d, df[key] == F.col("__k"), "left").withColumn(out, F.coalesce("__v", F.lit(""))).drop("__k", "__v")


def key_union(objects: DataFrame, order: str, json: str) -> DataFrame:
    """Distinct keys of JSON objects in the order in which they are first seen: pos (from 0), key."""
    keys = objects.select(order, F.posexplode(F.json_object_keys(json)).alias("k_ix", "key"))
    first = keys.groupBy("key").agg(F.min(F.struct(order, "k_ix")).alias("at"))
    return first.select((F.row_number().over(Window.orderBy("at")) - 1).cast("long").alias("pos"), "key")


def project_objects(objects: DataFrame, keys: list[str], json: str, header: list[str]) -> DataFrame:
    """keys and the header's fields of each JSON object; missing ones are empty."""
    return objects.select(*keys, *[F.coalesce(F.get_json_object(json, f"$.{h}"), F.lit("")).alias(h) for h in header])


def column_widths(cells: DataFrame, keys: list[str], array: str, width, most: int, least: int) -> DataFrame:
    """Per column of a table: the widest cell, between least and most."""
    each = cells.select(*keys, F.posexplode(array).alias("col", "cell"))
    return each.groupBy(*keys, "col").agg(F.greatest(F.lit(least), F.least(F.lit(most), F.max(width(F.col("cell"))))).alias("width"))


def best_cover(candidates: DataFrame, keys: list[str], score: str, order: str) -> DataFrame:
    """The candidate of the highest score over zero; ties keep the first."""
    w = Window.partitionBy(*keys).orderBy(F.desc(score), F.asc(order))
    return candidates.where(F.col(score) > 0).withColumn("__rn", F.row_number().over(w)).where("__rn = 1").drop("__rn")


def islands(df: DataFrame, keys: list[str], value: str, span: int = 1 << 20) -> DataFrame:
    """Runs of neighbouring distinct integers: keys, first, last, n; nulls are no integers and in no run.

    Runs are found in ranges of ``span`` values; only those that touch a range's edge, two a range at
    most, are joined with their neighbours.
    """
    base = df.where(F.col(value).isNotNull()).select(*keys, F.col(value).cast("long").alias("v")).distinct()
    part = base.withColumn("__b", F.floor(F.col("v") / span))
    w = Window.partitionBy(*keys, "__b").orderBy("v")
    runs = part.withColumn("__g", F.col("v") - F.row_number().over(w)).groupBy(*keys, "__b", "__g").agg(F.min("v").alias("first"), F.max("v").alias("last"))
    edge = (F.col("first") == F.col("__b") * span) | (F.col("last") == (F.col("__b") + 1) * span - 1)
    w2 = Window.partitionBy(*keys).orderBy("first")
    touching = runs.where(edge).withColumn("__new", F.when(F.lag("last").over(w2) == F.col("first") - 1, 0).otherwise(1)).withColumn("__id", F.sum("__new").over(w2))
    joined = touching.groupBy(*keys, "__id").agg(F.min("first").alias("first"), F.max("last").alias("last"))
    return runs.where(~edge).select(*keys, "first", "last").unionByName(joined.select(*keys, "first", "last")).withColumn("n", F.col("last") - F.col("first") + 1)


def chunks(df: DataFrame, keys: list[str], order: str, size: int = 100) -> DataFrame:
    """Adds chunk: the number of the block of ``size`` rows that a row is in."""
    w = Window.partitionBy(*keys).orderBy(order)
    return df.withColumn("chunk", F.floor((F.row_number().over(w) - 1) / size).cast("long"))


def keep_newest(df: DataFrame, keys: list[str], order: str) -> DataFrame:
    """The row of the highest order for each key."""
    w = Window.partitionBy(*keys).orderBy(F.desc(order))
    return df.withColumn("__rn", F.row_number().over(w)).where("__rn = 1").drop("__rn")


def closure(edges: DataFrame, roots: DataFrame) -> DataFrame:
    """id: all nodes that roots (id) reach over edges (src, dst), roots included; nulls are no nodes.

    Each round follows the edges of the nodes found last to nodes that aren't known yet, so cycles end,
    every edge is followed once and no path is listed. Rounds are written to the checkpoint folder.
    """
    pairs = edges.select(F.col("src").cast("long").alias("src"), F.col("dst").cast("long").alias("dst")).where("src IS NOT NULL AND dst IS NOT NULL AND src <> dst").distinct()
    pairs = checkpointed(pairs)
    found = checkpointed(roots.select(F.col("id").cast("long").alias("id")).where("id IS NOT NULL").distinct())
    last = found
    while not last.isEmpty():
        following = pairs.join(last, pairs["src"] == last["id"], "left_semi").select(F.col("dst").alias("id")).distinct()
        last = checkpointed(following.join(found, "id", "left_anti"))
        found = checkpointed(found.union(last))
    return found


def csv_file(rows: DataFrame, keys: list[str], order: str, record: str) -> DataFrame:
    """One CSV text a group: records in order, joined by CRLF."""
    got = rows.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct(order, record))).alias("__l"))
    return got.select(*keys, F.array_join(F.transform("__l", lambda x: x[record]), "\r\n").alias("content"))


def split_paragraphs(df: DataFrame, keys: list[str], paragraphs: Column) -> DataFrame:
    return df.select(*keys, F.posexplode(paragraphs).alias("__p", "paragraph")).select(*keys, (F.col("__p") + 1).cast("long").alias("para_no"), "paragraph")

"""Line dedup with a log-template tree.

A line goes down a tree of fixed depth: first its number of tokens, then its leading tokens, fields with
digits masked. In a leaf, the places where all lines agree are constant and the others are
variable; if enough places are constant, one of them behind the leading tokens, the whole leaf is one template. Else the
leaf is split: every masked line takes, of the patterns it has with one place hashed out and the one with as many of its rarest
places hashed out as the similarity permits, that which most texts share; if too few do, the line is its own.
What a leaf keeps per place is a minimum and a maximum, so leaves of any size are merged
before they are shuffled. Templates found in several documents recur, and their lines are dropped.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ebbtide.llm.common import stored

BLANK = "[ \\t\\r\\f\\x0B]+"
MASK = "<*>"
#: A token with a digit; tried at the start of a token only, without going back.
FIELD = "(?<![^ \\t\\r\\f\\x0B])[^ \\t\\r\\f\\x0B0-9]*+[0-9][^ \\t\\r\\f\\x0B]*+"
NO_ID = -(2**63)


def _key(id_col: str, text_col: str) -> list[Column]:
    """A row is known by its id and a hash of its text, so that ids needn't be unique."""
    return [F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("_id"), F.xxhash64(F.col(text_col).cast("string")).alias("_th")]


def _hash(*columns: Column | str, seed: int) -> Column:
    return F.xxhash64(F.lit(seed), *columns)


def masked_lines(docs: DataFrame, depth: int, id_col: str, text_col: str) -> DataFrame:
    """Every line that isn't blank: row key, place, number of tokens, leaf, tokens."""
    lines = docs.where(F.col(text_col).isNotNull()).select(*_key(id_col, text_col), F.posexplode(F.split(F.col(text_col).cast("string"), "\n")).alias("pos", "line"))
    trimmed = F.expr("btrim(line, ' \\t\\r\\f\\u000B')")
    # The filter comes before the masking, which Spark would otherwise run once for the filter and once for the rows.
    lines = lines.withColumn("line", trimmed).where("line <> ''")
    masked = F.when(F.col("line").rlike("[0-9]"), F.regexp_replace("line", FIELD, MASK)).otherwise(F.col("line"))
    tokens = lines.withColumn("tokens", F.split(masked, BLANK))
    path = F.slice("tokens", 1, depth)
    return tokens.select("_id", "_th", "pos", F.size("tokens").alias("n"), _hash(F.size("tokens"), path, seed=1).alias("leaf"), "tokens")


def _line_hashes() -> list[Column]:
    return [_hash("tokens", seed=2).alias("l1"), _hash("tokens", seed=3).alias("l2")]


def lines_of(lines: DataFrame, leaves: DataFrame, depth: int) -> DataFrame:
    """leaf, l1, l2, _th, n, hs: lines of some leaves, with hashes of the line and of its tokens behind the leading ones."""
    rest = F.slice("tokens", depth + 1, F.greatest(F.col("n") - depth, F.lit(0)))
    return lines.select("leaf", "_th", "n", "tokens").join(leaves, "leaf").select("leaf", *_line_hashes(), "_th", "n", F.transform(rest, lambda t: F.xxhash64(t)).alias("hs"))


def _split(lines: DataFrame, min_docs: int, depth: int, similarity: float) -> DataFrame:
    """leaf, l1, l2, p1, p2: the masked lines that have a pattern of `min_docs` texts, with their best pattern.

    How common a token is at a place is the number of distinct masked lines of the leaf that have it there, so neither the
    order of lines nor copies matter. A pattern is known by exclusive ors of the hashes of its places.
    """
    kind = ["leaf", "l1", "l2"]
    # at least one place behind the leading tokens stays constant
    room = F.least(F.col("n") - F.ceil(F.col("n") * similarity), F.col("n") - depth - 1).cast("int")
    lines = stored(lines.withColumn("room", room).where("room > 0").select(*kind, "_th", "room", "hs"), "split")
    texts = lines.select(*kind, "_th").distinct()
    cells = lines.groupBy(*kind).agg(F.first("room").alias("room"), F.first("hs").alias("hs")).select(*kind, "room", F.posexplode("hs").alias("place", "h"))
    cells = stored(cells, "cells")
    common = cells.groupBy("leaf", "place", "h").agg(F.count(F.lit(1)).alias("common"))
    own = Window.partitionBy(*kind)
    cells = cells.join(common, ["leaf", "place", "h"]).withColumn("rarest", F.row_number().over(own.orderBy("common", "place")))
    for i in ("1", "2"):
        held, open_ = _hash("leaf", "place", "h", seed=int(i) + 3), _hash("leaf", "place", F.lit(MASK), seed=int(i) + 5)
        cells = cells.withColumn("c" + i, held.bitwiseXOR(open_)).withColumn("all" + i, F.bit_xor(held).over(own))
    cells = stored(cells, "places")
    rarest = lambda i: F.first("all" + i).bitwiseXOR(F.bit_xor(F.when(F.col("rarest") <= F.col("room"), F.col("c" + i)).otherwise(0)))
    found = cells.select(*kind, F.col("all1").bitwiseXOR(F.col("c1")).alias("p1"), F.col("all2").bitwiseXOR(F.col("c2")).alias("p2")).unionByName(
        cells.groupBy(*kind).agg(rarest("1").alias("p1"), rarest("2").alias("p2"))
    ).distinct()
    found = stored(found, "patterns")
    shared = found.join(texts, kind).select("p1", "p2", "_th").distinct().groupBy("p1", "p2").agg(F.count(F.lit(1)).alias("texts")).where(F.col("texts") >= min_docs)
    best = found.join(shared, ["p1", "p2"]).groupBy(*kind).agg(F.max(F.struct("texts", "p1", "p2")).alias("best"))
    return stored(best.select(*kind, "best.p1", "best.p2"), "best")


def drop_recurring_lines(docs: DataFrame, min_docs: int = 4, depth: int = 3, similarity: float = 0.75, id_col: str = "doc_id",
                         text_col: str = "text") -> DataFrame:
    """The documents without lines of recurring templates: all columns, the text changed, with n_lines and n_dropped.

    A template recurs if lines of at least `min_docs` different texts have it: exact copies of a
    document count once. Its first line (smallest id, then place) stays, so that content
    is never lost altogether; every other line of it goes, also within one document.
    Blank lines are no templates. Missing texts stay missing, with 0 lines; an empty text is one
    blank line. Repeated rows (same id and text) get the same result. Rows without an id come before all ids. An empty
    table gives an empty result. Columns named n_lines or n_dropped are replaced; others pass unchanged.
    """
    lines = masked_lines(docs, depth, id_col, text_col)
    keyed = stored(lines.select("_id", "_th", "pos", "n", "leaf", *_line_hashes()), "lines")
    kinds = keyed.groupBy("leaf", "l1", "l2").agg(F.count(F.lit(1)).alias("c"))
    mixed = kinds.groupBy("leaf").agg(F.count(F.lit(1)).alias("kinds"), F.sum("c").alias("c")).where((F.col("kinds") > 1) & (F.col("c") >= min_docs)).select("leaf")
    mixed = stored(mixed, "leaves")
    # The leading tokens are the same in a whole leaf, so only the places behind them are looked at. Stored, as lines are dear to mask.
    held = stored(lines_of(lines, mixed, depth), "mixed")
    places = held.select("leaf", "n", F.posexplode("hs").alias("place", "h")).groupBy("leaf", "n", "place").agg(F.min("h").alias("lo"), F.max("h").alias("hi"))
    constant = places.groupBy("leaf", "n").agg(F.sum((F.col("lo") == F.col("hi")).cast("int")).alias("same"))
    # The leading tokens are the path, so they alone don't make lines alike.
    general = constant.where((F.col("same") > 0) & (F.col("same") + depth >= F.col("n") * similarity)).select("leaf", F.lit(True).alias("general"))
    general = stored(general, "general")
    best = _split(held.join(general, "leaf", "left_anti"), min_docs, depth, similarity)
    template = keyed.join(general, "leaf", "left").join(best, ["leaf", "l1", "l2"], "left").select(
        "_id", "_th", "pos", F.col("p1").isNotNull().alias("shared"),
        F.when(F.col("general"), F.col("leaf")).otherwise(F.coalesce("p1", "l1")).alias("t1"), F.when(F.col("general"), F.lit(0)).otherwise(F.coalesce("p2", "l2")).alias("t2"),
    )
    template = stored(template, "templates")
    per_text = template.groupBy("t1", "t2", "_th").agg(F.min(F.struct("_id", "pos")).alias("first"), F.max("shared").alias("shared"))
    # a shared pattern has its texts, also if some of them take another pattern
    recurring = per_text.groupBy("t1", "t2").agg(F.count(F.lit(1)).alias("texts"), F.min("first").alias("first"), F.max("shared").alias("shared")).where(F.col("shared") | (F.col("texts") >= min_docs))
    gone = template.join(recurring.select("t1", "t2", "first"), ["t1", "t2"]).where(F.struct("_id", "pos") != F.col("first"))
    gone = gone.groupBy("_id", "_th").agg(F.collect_set("pos").alias("_gone"))
    # As one struct, the documents' columns clash with none in use here.
    kept = docs.drop("n_lines", "n_dropped")
    rows = kept.select(F.struct("*").alias("row"), *_key(id_col, text_col))
    text = F.col("row").getField(text_col)
    left = F.array_except(F.sequence(F.lit(0), F.size("parts") - 1), F.col("_gone"))
    cleaned = F.array_join(F.transform(left, lambda i: F.get("parts", i)), "\n")
    changed = {text_col: F.when(F.col("_gone").isNull(), text).otherwise(cleaned)}
    # A column of its own, or the text would be split again for every line that stays.
    return rows.join(gone, ["_id", "_th"], "left").withColumn("parts", F.split(text.cast("string"), "\n")).select(
        *[changed.get(c, F.col("row").getField(c)).alias(c) for c in kept.columns],
        F.when(text.isNull(), 0).otherwise(F.size("parts")).cast("long").alias("n_lines"),
        F.coalesce(F.size("_gone"), F.lit(0)).cast("long").alias("n_dropped"),
    )

"""Mixing sources to target weights: hash-random order within each source, cut by distributed prefix sums.

DataFrame functions only. Sizes are summed for ranges of the hash, so that a window over one row per range gives where each
range starts, and a window within a range gives where each document starts: no window sees a whole source's documents.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from strata.llm.common import n_words, staged, word_array

#: Weights of the sources in order, repeating.
WEIGHTS = (1, 2, 3)
#: No source gives more than so many times its size.
MOST = 3
#: Ranges of the hash within a source, a power of 16.
RANGES = 16**3
#: Hex digits of the hash in use.
DIGITS = 15


def random_key(key: Column) -> Column:
    """A number below 16^15 from the MD5 of the key as text; NULL counts as empty."""
    digits = F.substring(F.md5(F.coalesce(key.cast("string"), F.lit(""))), 1, DIGITS)
    return F.conv(digits, 16, 10).cast("long")


def targets(sources: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """``sources`` (lacks, source, source_size) with ``target``.

    Sources in order of their names, the missing one last, weigh ``weights`` over and over and share the sum of all sizes;
    none gets more than ``most`` times its size, and what is over goes to the others by weight until none is above. That
    level is found in one pass over the sources by size per weight: each is full, or from there on none is.
    """
    place = F.row_number().over(Window.orderBy("lacks", "source")) - 1
    weight = F.element_at(F.array(*map(F.lit, weights)), (place % len(weights) + 1).cast("int")).cast("long")
    full = F.lit(most) * F.col("source_size")
    by_need = Window.orderBy(F.col("full") / F.col("weight"), "lacks", "source")
    before, after = by_need.rowsBetween(Window.unboundedPreceding, -1), by_need.rowsBetween(0, Window.unboundedFollowing)
    every = Window.partitionBy(F.lit(0))
    rest = F.sum("source_size").over(every) - F.coalesce(F.sum("full").over(before), F.lit(0))
    ranked = sources.withColumn("weight", weight).withColumn("full", full)
    levels = ranked.withColumn("level", rest / F.sum("weight").over(after))
    open_ = F.col("full") > F.col("weight") * F.col("level")
    level = F.min(F.when(open_, F.struct(F.col("full") / F.col("weight"), "lacks", "source", "level"))).over(every)["level"]
    share = F.least(F.col("full").cast("double"), F.col("weight") * level)
    return levels.withColumn("target", F.coalesce(share, F.col("full").cast("double"))).select(*sources.columns, "target")


def mix(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: tuple[int, ...] = WEIGHTS,
    most: int = MOST,
    carry: list[str] | None = None,
) -> DataFrame:
    """(row, size, source_size, target, taken): every row's ``carry`` columns (all by default) and the words the mix takes.

    A row's size is its words, those between the six ASCII blanks. A source's documents lie in the order of their hashed ids
    (ties by id and size); whole epochs are taken, then documents from the start until the target, rounded to whole words,
    is reached, the last one in part. Rows may repeat; empty and NULL texts have size zero, NULL is a source of its own, and
    an empty table gives an empty one.
    """
    lacks, source = F.col(source_col).isNull().alias("lacks"), F.coalesce(F.col(source_col), F.lit("")).alias("source")
    key = random_key(F.col(id_col))
    range_ = F.floor(key / (16**DIGITS // RANGES)).cast("int").alias("range")
    row = F.struct(*(carry or docs.columns)).alias("row")
    size = n_words(F.col(text_col)).alias("size")
    rows = docs.select(row, F.col(id_col).alias("id"), size, lacks, source, key.alias("key"), range_)
    if carry is not None and text_col not in carry:
        rows = staged(rows, "sizes")

    ranges = staged(rows.groupBy("lacks", "source", "range").agg(F.sum("size").alias("s")), "ranges")
    sources = ranges.groupBy("lacks", "source").agg(F.sum("s").alias("source_size"))
    shares = staged(targets(sources, weights, most), "targets")
    earlier = Window.partitionBy("lacks", "source").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = ranges.withColumn("offset", F.coalesce(F.sum("s").over(earlier), F.lit(0))).drop("s")
    offsets = offsets.join(shares, ["lacks", "source"])

    within = Window.partitionBy("lacks", "source", "range").orderBy("key", "id", "size")
    within = within.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = rows.withColumn("start", F.sum("size").over(within) - F.col("size"))
    placed = placed.join(offsets, ["lacks", "source", "range"])
    budget, whole = F.round("target").cast("long"), F.col("source_size")
    epochs = F.when(whole > 0, F.floor(budget / whole)).otherwise(0).cast("long")
    left = budget - epochs * whole - F.col("offset") - F.col("start")
    taken = epochs * F.col("size") + F.greatest(F.lit(0), F.least(F.col("size"), left))
    return placed.select("row", "size", "source_size", "target", taken.alias("taken"))


def epochs(mixed: DataFrame, text_col: str = "text", chars_col: str | None = "n_chars") -> DataFrame:
    """The documents of a mix, a row for each time one is taken; what is cut keeps its first words, joined by one space."""
    columns = mixed.schema["row"].dataType.names
    times = F.ceil(F.col("taken") / F.col("size")).cast("int")
    rows = mixed.where("taken > 0").withColumn("time", F.explode(F.sequence(F.lit(1), times)))
    left = F.col("taken") - (F.col("time") - 1) * F.col("size")
    text = F.col("row")[text_col]
    cut = F.array_join(F.slice(word_array(text), 1, left.cast("int")), " ")
    text = F.when(left < F.col("size"), cut).otherwise(text)
    out = rows.select(*[text.alias(c) if c == text_col else F.col("row")[c].alias(c) for c in columns])
    return out.withColumn(chars_col, F.length(text_col).cast("long")) if chars_col in columns else out

"""Near copies among embeddings by collision counting on one-dimensional projections.

Unit vectors are projected onto random lines. On each line a query's window is centred on its own value, and two vectors
collide where one lies in the other's window. Vectors are dealt by the cells of the first lines, ordered grids of window
width, so a query visits the cells its windows reach and collisions on those lines are certain for what it meets there;
on the other lines collisions are counted. Window width and least count follow from the recall asked for at the threshold:
along a random line two unit vectors at distance d differ by a normal number of deviation d. Pairs that reach the count are
verified by their cosine.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.llm.common import staged
from strata.llm.components import connected_components

THRESHOLD = 0.98
#: Lines, and how many of them deal the vectors to cells. More of the latter suit more vectors to a label.
LINES, DEALT = 16, 3
#: Recall at the threshold itself; closer pairs collide more often.
RECALL = 0.99
SEED = 20


def calibrated(threshold: float, lines: int, dealt: int, recall: float) -> tuple[float, int]:
    """Half the window's width, and the least count on the lines that do not deal.

    Half of what may be lost is lost on the dealing lines, all of which must collide, the rest by the count.
    """
    distance = math.sqrt(2 - 2 * threshold)
    half = 0.0
    while _inside(half) ** dealt < 1 - (1 - recall) / 2:
        half += 0.01
    p, rest = _inside(half), lines - dealt
    tail, least = 0.0, rest + 1
    while least and tail < 1 - (1 - recall) / 2:
        least -= 1
        tail += math.comb(rest, least) * p**least * (1 - p) ** (rest - least)
    return half * distance, least


def _inside(deviations: float) -> float:
    return math.erf(deviations / math.sqrt(2))


def _distinct(vectors: DataFrame, id_col: str, vector_col: str, label_col: str) -> DataFrame:
    """Rows (id, node, label, v); ``node`` is a hash of label and vector, NULL where the row links with nothing."""
    single = vectors.schema[vector_col].dataType == T.ArrayType(T.FloatType())
    kind = "array<float>" if single else "array<double>"
    rows = vectors.select(
        F.col(id_col).alias("id"), F.col(label_col).alias("label"), F.col(vector_col).cast(kind).alias("v")
    )
    fine = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("v", lambda x: x != 0)
    fine = F.coalesce(fine & F.col("label").isNotNull(), F.lit(False))
    return rows.select("id", F.when(fine, F.xxhash64("label", "v")).alias("node"), "label", "v")


def _projected(nodes: DataFrame, lines: int, seed: int) -> DataFrame:
    """Adds ``norm`` and ``p``, the unit vector's place on each line.

    Doubles are first divided by a power of two, exactly, so that the largest component lies between a half and one and no
    product of components or norms leaves the range of a double; products of single-precision numbers stay within it.
    """
    double = nodes.schema["v"].dataType == T.ArrayType(T.DoubleType())
    schema = T.StructType(nodes.schema.fields + [T.StructField("norm", T.DoubleType()), T.StructField("p", T.ArrayType(T.FloatType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            norms, places = np.zeros(batch.num_rows), np.zeros((batch.num_rows, lines), np.float32)
            flat, ends = batch.column("v").flatten().to_numpy().astype(np.float64), np.array(batch.column("v").value_lengths())
            begins = np.cumsum(ends) - ends
            if double and len(flat):
                powers = np.frexp(np.maximum.reduceat(np.abs(flat), begins))[1]
                flat = np.ldexp(flat, -np.repeat(powers, ends))
            for dim in np.unique(ends):
                rows = np.flatnonzero(ends == dim)
                v = flat[begins[rows][:, None] + np.arange(dim)]
                top = np.abs(v).max(axis=1, keepdims=True)
                norms[rows] = np.linalg.norm(v / top, axis=1) * top[:, 0]
                unit = v / top / np.linalg.norm(v / top, axis=1, keepdims=True)
                places[rows] = unit @ np.random.default_rng([seed, int(dim)]).standard_normal((int(dim), lines))
            p = pa.ListArray.from_arrays(pa.array(np.arange(0, places.size + 1, lines), pa.int32()), pa.array(places.ravel()))
            columns = dict(zip(batch.schema.names, batch.columns))
            if double:
                offsets = pa.array(np.concatenate([[0], np.cumsum(ends)]), pa.int32())
                columns["v"] = pa.ListArray.from_arrays(offsets, pa.array(flat))
            columns |= {"norm": pa.array(norms), "p": p}
            yield pa.RecordBatch.from_arrays([columns[f.name] for f in schema], names=schema.names)

    return nodes.mapInArrow(run, schema)


def _cell(numbers: list[Column]) -> Column:
    """One key of the cell numbers, each of 10 bits."""
    key = F.lit(0).cast("long")
    for x in numbers:
        key = key * 1024 + (x + 512)
    return key


def _close(a: DataFrame, b: DataFrame, threshold: float, lines: int, dealt: int, recall: float) -> DataFrame:
    """Pairs of different nodes of a and b, as (qa, qb), that collide often enough and pass the threshold."""
    half, least = calibrated(threshold, lines, dealt, recall)
    width = 2 * half
    cut = lambda x: F.floor(x / width).cast("int")
    query = a
    for j in range(dealt):
        reach = F.sequence(cut(F.col("p")[j] - half), cut(F.col("p")[j] + half))
        query = query.withColumn(f"c{j}", F.explode(reach))
    query = query.withColumn("cell", _cell([F.col(f"c{j}") for j in range(dealt)]))
    data = b.withColumn("cell", _cell([cut(F.col("p")[j]) for j in range(dealt)]))
    places = lambda side: [F.col("p")[j].alias(f"{side}{j}") for j in range(lines)]
    sides = []
    for df, side, own in ((query, "a", a.columns), (data, "b", b.columns)):
        whole = F.struct(*[c for c in own if c not in ("p", "label")]).alias(f"q{side}")
        sides.append(df.select("label", F.size("v").alias("dim"), "cell", whole, *places(side)))
    left, right = sides
    hit = lambda j: F.abs(F.col(f"a{j}") - F.col(f"b{j}")) <= half
    count = sum((hit(j).cast("int") for j in range(dealt, lines)), F.lit(0))
    near = reduce(Column.__and__, [hit(j) for j in range(dealt)]) & (count >= least) & (F.col("qa.node") != F.col("qb.node"))
    product = F.zip_with("qa.v", "qb.v", lambda x, y: x.cast("double") * y.cast("double"))
    dot = F.aggregate(product, F.lit(0.0), lambda s, x: s + x)
    cosine = dot / (F.col("qa.norm") * F.col("qb.norm"))
    return left.join(right, ["label", "dim", "cell"]).where(near).where(cosine >= threshold).select("qa", "qb")


def near_duplicates(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    threshold: float = THRESHOLD,
    lines: int = LINES,
    dealt: int = DEALT,
    recall: float = RECALL,
    seed: int = SEED,
) -> DataFrame:
    """(id, n_links, component): for each row the other rows linked with it, and the smallest id reachable by links.

    Rows of equal labels and lengths link at a cosine of ``threshold`` or more, if found; rows with equal labels and vectors
    always do, and are one node. Rows without a label, and vectors that are NULL, empty, zero or hold NULL or non-finite
    components, link with nothing: they are their own component. NULL ids are never the smallest.

    Links are counted where they are found and not written: what leaves the join is one row per node, its count and its
    least neighbour, and then the pairs that those neighbours leave unconnected.
    """
    rows = staged(_distinct(vectors, id_col, vector_col, label_col), "vectors")
    nodes = rows.where("node IS NOT NULL").groupBy("node")
    nodes = nodes.agg(F.count("*").alias("n"), F.min("id").alias("least"), F.first("label").alias("label"), F.first("v").alias("v"))
    nodes = staged(_projected(nodes, lines, seed), "nodes")
    args = (threshold, lines, dealt, recall)

    slim = nodes.select("node", "n", "label", "v", "norm", "p")
    found = _close(slim, slim, *args).groupBy(F.col("qa.node").alias("node"))
    found = found.agg(F.sum("qb.n").alias("links"), F.min("qb.node").alias("next"), F.count("*").alias("k"))
    found = staged(found, "links")
    first = staged(connected_components(found.select(F.col("node").alias("a"), F.col("next").alias("b"))), "components")

    busy = slim.join(found.where("k > 1").select("node"), "node").join(first, "node")
    apart = _close(busy, busy, *args).where("qa.component < qb.component")
    apart = apart.select(F.col("qa.component").alias("a"), F.col("qb.component").alias("b")).distinct()
    whole = connected_components(first.select(F.col("node").alias("a"), F.col("component").alias("b")).union(apart))

    known = nodes.select("node", "n", "least").join(found.select("node", "links"), "node", "left").join(whole, "node", "left")
    known = staged(known.withColumn("component", F.coalesce("component", "node")), "labelled")
    smallest = known.groupBy("component").agg(F.min("least").alias("smallest"))
    known = known.join(smallest, "component").select("node", "n", "links", "smallest")
    out = rows.select("id", "node").join(known, "node", "left")
    links = F.coalesce(F.col("n") - 1 + F.coalesce("links", F.lit(0)), F.lit(0))
    component = F.when(F.col("n").isNull(), F.col("id")).otherwise(F.col("smallest"))
    return out.select("id", links.cast("long").alias("n_links"), component.alias("component"))

"""Hard negatives of anchor vectors by a threshold algorithm over sorted lists.

Vectors become whole numbers and lie in shards of a bounded size. A shard keeps a list for each dimension, sorted by component.
For an anchor, rows are taken from all lists at the same depth, from the large end where the anchor's component is positive and
from the small end where it is negative; each row that appears is scored whole. No row further down scores above the threshold, the
score of the components just met. A shard is done with an anchor once the threshold lies strictly below the last score that
each wanted window keeps (strictly, because equal scores are ordered by id), or below the window where it keeps too few.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from strata.llm.common import staged

#: Components of a shard: 4096 vectors of 64 dimensions.
COMPONENTS = 1 << 18
#: Depth of the first step into the lists; each step doubles it.
FIRST = 32
#: Scaled components reach up to this, exclusively.
LARGEST = 1 << 27


class Lists:
    """The rows of a shard, and for each dimension their numbers and components in ascending order."""

    def __init__(self, vectors: np.ndarray, ids: np.ndarray, rows: np.ndarray, labels: np.ndarray):
        self.ids, self.rows, self.labels = ids, rows, labels
        self.order = np.argsort(vectors.T, axis=1, kind="stable").astype(np.int32)
        self.sorted = np.take_along_axis(vectors.T, self.order, 1)
        self.largest = int(np.abs(vectors).max(initial=0))
        self.whole, self.real = vectors, vectors.astype(np.float64)

    def scores(self, which: np.ndarray, anchor: np.ndarray) -> np.ndarray:
        """Inner products, in floating point where that is exact."""
        if self.largest * int(np.abs(anchor).sum()) < 1 << 53:
            return (self.real[which] @ anchor.astype(np.float64)).astype(np.int64)
        return self.whole[which] @ anchor

    def best(
        self, anchor: np.ndarray, windows: list[tuple[int | None, int | None]], most: int, row: int, label: str | None = None
    ) -> list[list[tuple[int, int]]]:
        """For each window of scores (lowest, highest; None is open) its first ``most`` (id, score), by score and then id.

        The row of the anchor takes no part, nor do rows of its label where one is given.
        """
        n, met = len(self.ids), np.zeros(len(self.ids), bool)
        up, down = np.flatnonzero(anchor > 0), np.flatnonzero(anchor < 0)
        known, values = np.zeros(0, np.int64), np.zeros(0, np.int64)
        depth, end = 0, min(n, FIRST)
        while n:
            if len(up) + len(down) == 0:
                end = n
                new = np.arange(n)
            else:
                before = met.copy()
                met[self.order[up, n - end : n - depth].ravel()] = True
                met[self.order[down, depth:end].ravel()] = True
                new = np.flatnonzero(met & ~before)
            if label is not None:
                new = new[self.labels[new] != label]
            new = new[self.rows[new] != row]
            known = np.concatenate((known, new))
            values = np.concatenate((values, self.scores(new, anchor)))
            if end == n:
                break
            threshold = int(anchor[up] @ self.sorted[up, n - end]) + int(anchor[down] @ self.sorted[down, end - 1])
            if all(threshold < bound for bound in self._bounds(values, windows, most)):
                break
            depth, end = end, min(n, 2 * end)
        found = []
        for lowest, highest in windows:
            inside = np.flatnonzero(_within(values, lowest, highest))
            if len(inside) > most:  # those of the last score that is kept all stay for the order by id
                last = np.partition(values[inside], len(inside) - most)[len(inside) - most]
                inside = inside[values[inside] >= last]
            chosen = inside[np.lexsort((self.ids[known[inside]], -values[inside]))][:most]
            found.append(list(zip(self.ids[known[chosen]].tolist(), values[chosen].tolist())))
        return found

    @staticmethod
    def _bounds(values: np.ndarray, windows: list, most: int) -> Iterator[float]:
        """What the threshold must fall below in each window."""
        for lowest, highest in windows:
            inside = values[_within(values, lowest, highest)]
            if len(inside) >= most:
                yield int(np.partition(inside, len(inside) - most)[len(inside) - most])
            else:
                yield -np.inf if lowest is None else lowest


def _within(values: np.ndarray, lowest: int | None, highest: int | None) -> np.ndarray:
    inside = np.ones(len(values), bool)
    if lowest is not None:
        inside &= values >= lowest
    if highest is not None:
        inside &= values <= highest
    return inside


# --- on tables ---


def whole_numbers(vectors: DataFrame, scale: int, id_col: str, label_col: str, vector_col: str, is_anchor: Column) -> DataFrame:
    """(row, id, label, dims, v, anchor) of the rows that take part; ``row`` tells equal rows apart."""
    fits = F.forall(vector_col, lambda x: F.coalesce(F.abs(x.cast("double") * scale) < LARGEST, F.lit(False)))
    rows = vectors.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & F.col(vector_col).isNotNull() & fits)
    whole = F.transform(vector_col, lambda x: F.floor(x.cast("double") * scale).cast("int"))
    return staged(
        rows.select(
            F.monotonically_increasing_id().alias("row"),
            F.col(id_col).cast("long").alias("id"),
            F.col(label_col).cast("string").alias("label"),
            F.size(vector_col).alias("dims"),
            whole.alias("v"),
            F.coalesce(is_anchor, F.lit(False)).alias("anchor"),
        ),
        "vectors",
    )


def _searched(rows: DataFrame, anchors: DataFrame, by: list[str], function, schema: str) -> DataFrame:
    """``function`` (lists, anchor's row) -> rows, for each anchor and each shard of the rows that agree with it in ``by``.

    A shard's rows come first and are held, a bounded number of components; its anchors follow in a stream.
    """
    shards = F.ceil(F.count("*") * F.greatest(F.max("dims"), F.lit(1)) / COMPONENTS).cast("int").alias("shards")
    counted = staged(rows.groupBy(*by).agg(shards), "shards")
    part = F.pmod(F.xxhash64("row"), F.col("shards")).cast("int")
    every = F.explode(F.sequence(F.lit(0), F.col("shards") - 1))
    columns = ["row", "id", "label", "v"]
    kept = rows.join(counted, by).select(*by, part.alias("part"), *columns, F.lit(0).alias("kind"), F.lit(None).alias("asked"))
    asks = anchors.join(counted, by).select(*by, every.alias("part"), *columns, F.lit(1).alias("kind"), "asked")
    kept = kept.withColumn("asked", F.col("asked").cast(asks.schema["asked"].dataType))
    key = F.concat_ws("/", *by, "part").alias("key")
    both = kept.select(key, *columns, "kind", "asked").union(asks.select(key, *columns, "kind", "asked"))
    # By number, as adaptive execution would merge partitions that are small but take long.
    tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    both = both.repartition(tasks, "key").sortWithinPartitions("key", "kind")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, parts, lists = None, [], None
        for batch in batches:
            keys, kinds = batch.column("key").to_pylist(), batch.column("kind").to_numpy()
            edges = [0, *(i for i in range(1, len(keys)) if keys[i] != keys[i - 1] or kinds[i] != kinds[i - 1]), len(keys)]
            out = []
            for start, end in zip(edges, edges[1:]):
                if start == end:
                    continue
                some = batch.slice(start, end - start)
                if keys[start] != held:
                    held, parts, lists = keys[start], [], None
                if kinds[start] == 0:
                    parts.append(some)
                    continue
                if lists is None:
                    lists = Lists(*_arrays(parts))
                    parts = []
                columns = (some.column(c).to_pylist() for c in ("row", "id", "label", "asked"))
                for v, *rest in zip(_matrix(some), *columns):
                    out += function(lists, v, *rest)
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], names)

    names = [f.split()[0] for f in schema.split(", ")]
    return both.mapInArrow(run, schema)


def _matrix(batch: pa.RecordBatch) -> np.ndarray:
    return batch.column("v").flatten().to_numpy().astype(np.int64).reshape(batch.num_rows, -1)


def _arrays(parts: list[pa.RecordBatch]) -> tuple[np.ndarray, ...]:
    if not parts:
        return np.zeros((0, 0), np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, object)
    columns = [np.concatenate([p.column(c).to_numpy(zero_copy_only=False) for p in parts]) for c in ("id", "row", "label")]
    return np.concatenate([_matrix(p) for p in parts]), *columns


def hard_negatives(
    vectors: DataFrame,
    is_anchor: Column,
    id_col: str = "vec_id",
    label_col: str = "label",
    vector_col: str = "embedding",
    positives: int = 5,
    negatives: int = 10,
    percent: tuple[int, int] = (30, 90),
    scale: int = 256,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) for the anchors among ``vectors``.

    Components become floor(scale * x); a score is an inner product of these. An anchor's positives are its ``positives`` best
    rows of the same label, the anchor left out; for each of them the ``negatives`` best rows of other labels whose score lies from
    ``percent[0]`` to ``percent[1]`` hundredths of the positive's are returned. Equal scores are ordered by id.

    Rows with a NULL id, label or vector take no part, nor do those with a component that is NULL, not finite or 2^27 or more
    after scaling. Vectors of different lengths are not compared. Rows may repeat: each copy is a row, also as an anchor. Anchors
    without positives give no row, those with few give fewer; an empty table gives an empty one. Results are exact. Each anchor
    visits every shard, so the work grows with anchors times rows.
    """
    rows = whole_numbers(vectors, scale, id_col, label_col, vector_col, is_anchor)
    anchors = rows.where("anchor")

    def first(lists: Lists, v, row, id, label, asked):
        return [(row, *pair) for pair in lists.best(v, [(None, None)], positives, row)[0]]

    near = _searched(
        rows, anchors.withColumn("asked", F.lit(None).cast("int")), ["label", "dims"], first, "row long, id long, score long"
    )
    place = F.row_number().over(Window.partitionBy("row").orderBy(F.desc("score"), "id")).alias("place")
    near = near.select("*", place).where(F.col("place") <= positives)
    near = near.groupBy("row").agg(F.sort_array(F.collect_list(F.struct("place", "id", "score"))).alias("asked"))
    anchors = staged(anchors.join(near, "row"), "anchors")
    low, high = percent

    def second(lists: Lists, v, row, id, label, asked):
        windows = {p["score"]: (-(-low * p["score"] // 100), high * p["score"] // 100) for p in asked}
        windows = {score: w for score, w in windows.items() if w[0] <= w[1]}
        found = dict(zip(windows, lists.best(v, list(windows.values()), negatives, row, label) if windows else ()))
        return [
            (row, id, p["place"], p["id"], p["score"], *pair) for p in asked for pair in found.get(p["score"], ())
        ]

    schema = "row long, anchor_id long, place long, positive_id long, positive_score long, negative_id long, negative_score long"
    found = _searched(rows, anchors, ["dims"], second, schema)
    rank = F.row_number().over(Window.partitionBy("row", "place").orderBy(F.desc("negative_score"), "negative_id"))
    found = found.withColumn("rank", rank).where(F.col("rank") <= negatives)
    return found.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")

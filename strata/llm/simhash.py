"""SimHash near duplicates: fingerprints of word shingles, candidates by pigeonhole blocks, verified by Hamming distance."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from itertools import accumulate, combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from strata.llm.common import pieces, settled, staged, texts
from strata.llm.components import connected_components

BITS = 64
SEED = 42
#: Hashes unpacked to bits at a time.
CHUNK = 1 << 15
#: Bands of min-hashes and min-hashes in each: of pairs with a similarity of 0.8 a share of 0.992 has a band in common.
BANDS, ROWS = 16, 6
#: Bits within which any two fingerprints have one of the block keys in common, and the blocks that these are chosen from.
NEAR, BLOCKS = 4, 6
#: Bits of a set's bitmap, the parities of how many of its shingles fall on each: sets differ at least as much as their bitmaps.
PARITIES = 1024
#: Words of 64 bits that a bitmap is folded to where each key of a text carries one; folded ones never differ in more bits.
FOLDS = 4
#: Texts of a block that are each compared with all others before the rounds.
FEW = 64
#: Rounds in which the texts of a band are compared with one of them, before those of different components are all compared.
STARS = 2


def shingles(text: bytes, width: int) -> list[int]:
    """Hashes of ``width``-word shingles as unsigned numbers; a text of fewer words is one shingle, one of none has none."""
    words = text.lower().split()
    if not words:
        return []
    joined = b" ".join(words)
    ends = list(accumulate(map(len, words)))
    ends = [e + i for i, e in enumerate(ends)]
    starts = [0, *(e + 1 for e in ends[:-1])]
    if len(words) <= width:
        return [xxhash.xxh64_intdigest(joined, SEED)]
    digest = xxhash.xxh64_intdigest
    return [digest(joined[s:e], SEED) for s, e in zip(starts, ends[width - 1 :])]


def simhash(hashes) -> int:
    """The bits set in more than half of the hashes, as an unsigned number."""
    ones = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), CHUNK):
        some = np.array(hashes[at : at + CHUNK], "<u8")
        ones += np.unpackbits(some.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])


def fingerprint(text: bytes, width: int) -> int:
    """The SimHash of a text's ``width``-word shingles."""
    return simhash(shingles(text, width))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 4) -> DataFrame:
    """(id, fp): the 64-bit SimHash of each text as a signed long.

    A-Z become a-z, words lie between the six ASCII blanks, a text of fewer than ``width`` words is one shingle; a text
    without words, or NULL, has fingerprint zero. Other columns of ``docs`` are not read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text"):
            fps = np.array([fingerprint(t, width) for t in texts(batch.column("text"))], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(fps)], ["id", "fp"])

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, rows.select("id").schema.add("fp", "long"))


def block_masks(distance: int, blocks: int) -> list[int]:
    """Masks of which two fingerprints within ``distance`` agree on one at least.

    Cut into ``blocks`` parts, such a pair differs in at most ``distance`` of them, so that one choice of the other
    ``blocks - distance`` is equal.
    """
    edges = [BITS * i // blocks for i in range(blocks + 1)]
    parts = [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in zip(edges, edges[1:])]
    masks = [sum(chosen) for chosen in combinations(parts, blocks - distance)]
    return [m - (1 << BITS) if m >> (BITS - 1) else m for m in masks]


def link_fingerprints(counted: DataFrame, distance: int = 4, blocks: int = 6) -> DataFrame:
    """(node, component) of the distinct fingerprints (fp, n) that have another one within ``distance`` bits.

    All pairs of a dense group are never written: within each block the fingerprints first link to the one that most
    documents share, and only blocks that still hold several components are joined, for pairs of different components.
    What is left out so far is implied by the links found, so the components are those of all pairs.
    """
    masks = block_masks(distance, blocks)

    def in_blocks(rows: DataFrame) -> DataFrame:
        keys = F.array(*[F.struct(F.lit(i).alias("t"), F.col("fp").bitwiseAND(F.lit(m)).alias("k")) for i, m in enumerate(masks)])
        return rows.withColumn("block", F.explode(keys)).select("*", "block.t", "block.k").drop("block")

    def apart(a: str, b: str):
        return F.bit_count(F.col(a).bitwiseXOR(F.col(b)))

    keyed = in_blocks(counted)
    heads = keyed.groupBy("t", "k").agg(F.max(F.struct("n", "fp")).alias("head"), F.count("*").alias("m"))
    heads = heads.where("m > 1").select("t", "k", F.col("head.fp").alias("head"))
    stars = keyed.join(heads, ["t", "k"]).where(F.col("fp") != F.col("head")).where(apart("fp", "head") <= distance)
    stars = staged(stars.select(F.col("fp").alias("a"), F.col("head").alias("b")).distinct(), "stars")
    first = staged(connected_components(stars), "components")

    labelled = counted.select("fp").join(first.withColumnRenamed("node", "fp"), "fp", "left")
    keyed = in_blocks(labelled.withColumn("component", F.coalesce("component", "fp")))
    mixed = keyed.groupBy("t", "k").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo < hi")
    keyed = staged(keyed.join(mixed.select("t", "k"), ["t", "k"], "left_semi"), "blocks")
    a = keyed.select("t", "k", F.col("fp").alias("fa"), F.col("component").alias("a"))
    b = keyed.select("t", "k", F.col("fp").alias("fb"), F.col("component").alias("b"))
    close = (F.col("a") < F.col("b")) & (apart("fa", "fb") <= distance)
    rest = a.join(b, (a.t == b.t) & (a.k == b.k) & close).select("a", "b").distinct()
    whole = first.select(F.col("node").alias("a"), F.col("component").alias("b")).union(rest)
    return connected_components(whole)


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 4, distance: int = 4, blocks: int = 6
) -> DataFrame:
    """(id, fp, component): each row's fingerprint and the smallest id reachable over fingerprints within ``distance``.

    Ids may be of any type that has an order, structs too.

    Rows with equal fingerprints are one node. Ids may repeat; a NULL id is never the smallest, and a component of NULL
    ids alone is NULL. NULL and empty texts share fingerprint zero. An empty table gives an empty one.
    """
    prints = staged(fingerprints(docs, id_col, text_col, width), "fingerprints")
    counted = staged(prints.groupBy("fp").agg(F.count("*").alias("n"), F.min("id").alias("least")), "distinct")
    linked = link_fingerprints(counted.select("fp", "n"), distance, blocks).withColumnRenamed("node", "fp")
    labelled = counted.join(linked, "fp", "left").withColumn("component", F.coalesce("component", "fp"))
    named = labelled.groupBy("component").agg(F.min("least").alias("smallest"))
    classes = labelled.join(named, "component").select("fp", F.col("smallest").alias("component"))
    return prints.join(classes, "fp").select("id", "fp", "component")


# --- near copies by the similarity of their shingles ---


def signatures(docs: DataFrame, id_col: str, text_col: str, width: int) -> DataFrame:
    """(id, node, fp, size, keys, bits, grams): a text's set of shingles as one hash, its SimHash, how many they are, a key for
    each choice of fingerprint blocks and each band of min-hashes, a bitmap of ``PARITIES`` bits, and the shingles by 32 bits. NULL counts as empty; texts without words
    have no keys. Rows may repeat."""
    rng = np.random.default_rng(SEED)
    times, plus = rng.integers(0, 1 << 64, (2, BANDS * ROWS, 1), np.uint64)
    times |= np.uint64(1)
    masks = [m & ((1 << BITS) - 1) for m in block_masks(NEAR, BLOCKS)]

    def blocks(fp: int, hashes: np.ndarray) -> list[int]:
        return [fp & m for m in masks] if len(hashes) else []

    def bands(hashes: np.ndarray) -> list[int]:
        least = np.full(BANDS * ROWS, (1 << 64) - 1, np.uint64)
        for at in range(0, len(hashes), 2048):
            np.minimum(least, (hashes[at : at + 2048] * times + plus).min(axis=1), out=least)
        return [xxhash.xxh64_intdigest(band.tobytes(), SEED) for band in least.reshape(BANDS, ROWS)] if len(hashes) else []

    def parities(marks: np.ndarray) -> np.ndarray:
        odd = np.bincount(marks.view(np.uint32) % PARITIES, minlength=PARITIES) & 1
        return np.packbits(odd.astype(np.uint8), bitorder="little").view("<i8")

    schema = pa.schema([("node", pa.int64()), ("fp", pa.int64()), ("size", pa.int32()), ("keys", pa.list_(pa.int64())),
                        ("bits", pa.list_(pa.int64())), ("grams", pa.list_(pa.int32()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text"):
            sets = [np.unique(np.array(shingles(t, width), np.uint64)) for t in texts(batch.column("text"))]
            marks = [np.unique(s.astype(np.uint32)).view(np.int32) for s in sets]
            signed = lambda values: np.array(values, np.uint64).view(np.int64)
            prints = [simhash(s) for s in sets]
            columns = [
                signed([xxhash.xxh64_intdigest(s.tobytes(), SEED) for s in sets]), signed(prints),
                [len(m) for m in marks], [signed(blocks(p, s) + bands(s)) for p, s in zip(prints, sets)], [parities(m) for m in marks], marks,
            ]
            arrays = [pa.array(c, f.type) for c, f in zip(columns, schema)]
            yield pa.RecordBatch.from_arrays([batch.column("id"), *arrays], ["id", *schema.names])

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kinds = T.StructType.fromDDL("node long, fp long, size int, keys array<long>, bits array<long>, grams array<int>")
    return rows.mapInArrow(run, T.StructType([rows.schema["id"], *kinds]))


def similar(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5, similarity: float = 0.8, distance: int = 18
) -> DataFrame:
    """(id, component): the smallest id reachable over texts whose sets of shingles have a Jaccard similarity of ``similarity``.

    Candidates share a choice of fingerprint blocks, as all do whose fingerprints are within ``NEAR`` bits, or else a band of
    min-hashes; those with fingerprints within ``distance`` bits are then verified by their shingles. Equal
    sets are one node. Blocks are dealt with like bands. The texts of a band are first compared with one of them in each of ``STARS`` rounds: with the one that
    shares its bands with most texts, which is close to all copies of one text, then with random ones. Pairs of texts that are
    still of different components are compared only where both have enough shingles that any other text of a mixed band has,
    too, and where the sets' bitmaps differ little enough: shingles of one text alone are in no intersection, and sets differ
    at least as much as their bitmaps. That rules most pairs of a dense group out, and none wrongly.

    Keys of blocks are short, so that in a large table most texts share them with texts that have nothing to do with theirs. A
    text's key goes on only if its block has more than ``FEW`` texts, or one that the text can be similar to by sizes, fingerprints
    and bitmaps; keys of bands go on if two texts have them. No pair that would pass its checks is lost.

    Ids may be structs; NULL and empty texts are one node without keys. An empty table gives an empty one.
    """
    return settled(lambda: _similar(docs, id_col, text_col, width, similarity, distance), "similar")


def _similar(docs: DataFrame, id_col: str, text_col: str, width: int, similarity: float, distance: int) -> DataFrame:
    signed = staged(signatures(docs, id_col, text_col, width), "signatures")
    same = [F.first(c).alias(c) for c in ("fp", "size", "keys", "bits")]
    counted = staged(signed.groupBy("node").agg(F.count("*").alias("n"), F.min("id").alias("least"), *same), "distinct")

    def close(a: str, b: str):
        """Whether a pair can be similar: by sizes exactly, by fingerprints with a rare miss."""
        fits = F.least(a + "size", b + "size") >= F.lit(similarity) * F.greatest(a + "size", b + "size")
        return fits & (F.bit_count(F.col(a + "fp").bitwiseXOR(F.col(b + "fp"))) <= distance)

    def apart(a: str, b: str, words: int):
        return sum(F.bit_count(F.col(a)[i].bitwiseXOR(F.col(b)[i])) for i in range(words))

    def most(a: str, b: str):
        """Shingles that are in one set only, at most, if a pair is similar."""
        return F.lit((1 - similarity) / (1 + similarity)) * (F.col(a + "size") + F.col(b + "size")) + 1e-9

    def verified(pairs: DataFrame) -> DataFrame:
        pairs = staged(pairs.distinct(), "pairs")
        wanted = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
        grams = staged(grams_of.join(wanted, "node", "left_semi"), "grams")
        x = pairs.join(grams.select(F.col("node").alias("a"), F.col("grams").alias("x")), "a")
        x = x.join(grams.select(F.col("node").alias("b"), F.col("grams").alias("y")), "b")
        both = F.size(F.array_intersect("x", "y"))
        return x.where(both >= F.lit(similarity) * (F.size("x") + F.size("y") - both)).select("a", "b")

    def joined(label: DataFrame, pairs: DataFrame) -> DataFrame:
        def components() -> DataFrame:
            edges = label.select(F.col("node").alias("a"), F.col("component").alias("b")).union(verified(pairs))
            return connected_components(edges)

        return settled(components, "components")

    def in_bands(label: DataFrame) -> DataFrame:
        found = counted.join(label, "node")
        return found.select("node", "n", "shared", "component", "fp", "size", F.explode("keys").alias("key"))

    def shared_keys() -> DataFrame:
        """(node, key, c): the keys of a text that another one has, too, and how many have it; of blocks those worth a comparison."""
        blocks = F.lit(len(block_masks(NEAR, BLOCKS)))
        words = [reduce(Column.bitwiseXOR, [F.col("bits")[i] for i in range(j, PARITIES // 64, FOLDS)]) for j in range(FOLDS)]
        fold = F.array(*words).alias("fold")

        def often(keyed: DataFrame) -> DataFrame:
            many = keyed.groupBy("key").agg(F.count("*").alias("c")).where("c > 1")
            return keyed.join(many, "key")

        banded = counted.select("node", F.posexplode("keys").alias("t", "k")).where(F.col("t") >= blocks)
        banded = often(banded.select("node", F.xxhash64("t", "k").alias("key")))
        keyed = counted.select("node", "fp", "size", fold, F.posexplode(F.slice("keys", 1, blocks)).alias("t", "k"))
        keyed = often(keyed.select("node", "fp", "size", "fold", F.xxhash64("t", "k").alias("key")))
        large, small = keyed.where(F.col("c") > FEW), keyed.where(F.col("c") <= FEW)
        x, y = small.alias("x"), small.select("node", "fp", "size", "fold", "key").alias("y")
        other = (F.col("x.key") == F.col("y.key")) & (F.col("x.node") != F.col("y.node"))
        small = x.join(y, other & close("x.", "y.") & (apart("x.fold", "y.fold", FOLDS) <= most("x.", "y.")), "left_semi")
        return reduce(DataFrame.union, [found.select("node", "key", "c") for found in (banded, large, small)])

    label = counted.select("node", F.col("node").alias("component"))
    named_nodes = counted.select("node", "least")
    shared = shared_keys().groupBy("node").agg(F.collect_list("key").alias("keys"), F.sum("c").alias("shared"))
    shared = staged(shared, "shared")
    counted = counted.drop("keys").join(shared, "node")  # the others have no key in common with any text
    grams_of = signed.select("node", "grams").join(shared.select("node"), "node", "left_semi")
    grams_of = staged(grams_of.groupBy("node").agg(F.first("grams").alias("grams")), "candidates")

    for turn in range(STARS):
        order = F.xxhash64("node", F.lit(turn)) if turn else F.struct("shared", "n")
        keyed = in_bands(label)
        head = F.max(F.struct(order, "node", "component", "fp", "size")).alias("head")
        heads = keyed.groupBy("key").agg(head, F.min("component").alias("lo"), F.max("component").alias("hi"))
        near = keyed.join(heads.where("lo < hi").select("key", "head"), "key")
        near = near.where(F.col("component") != F.col("head.component")).select("node", "fp", "size", "head")
        near = near.where(close("", "head.")).select(F.col("node").alias("a"), F.col("head.node").alias("b"))
        label = joined(label, near)

    keyed = in_bands(label)
    mixed = keyed.groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo < hi")
    keyed = staged(keyed.join(mixed.select("key"), "key", "left_semi"), "bands")
    grams = grams_of.join(keyed.select("node").distinct(), "node", "left_semi").select("node", F.explode("grams").alias("gram"))
    owners = grams.groupBy("gram").agg(F.min("node").alias("node"), F.max("node").alias("other")).where("node = other")
    alone = staged(owners.groupBy("node").agg(F.count("*").alias("alone")), "alone")
    keyed = keyed.join(alone, "node", "left").withColumn("common", F.col("size") - F.coalesce("alone", F.lit(0)))
    keyed = keyed.where(F.col("common") >= F.lit(similarity) * F.col("size") - 1e-9)
    keyed = keyed.join(counted.select("node", "bits"), "node")
    a, b = (keyed.select("key", F.struct("component", "node", "fp", "size", "common", "bits").alias(c)) for c in "ab")
    pairs = a.join(b, "key").where(F.col("a.component") < F.col("b.component")).where(close("a.", "b."))
    enough = F.lit(similarity / (1 + similarity)) * (F.col("a.size") + F.col("b.size")) - 1e-9
    pairs = pairs.where(F.least("a.common", "b.common") >= enough)
    pairs = pairs.where(apart("a.bits", "b.bits", PARITIES // 64) <= most("a.", "b."))
    label = joined(label, pairs.select(F.col("a.node").alias("a"), F.col("b.node").alias("b")))

    labelled = named_nodes.join(label, "node")
    named = labelled.groupBy("component").agg(F.min("least").alias("smallest"))
    classes = labelled.join(named, "component").select("node", F.col("smallest").alias("component"))
    return signed.select("id", "node").join(classes, "node").select("id", "component")


def keep_first(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    width: int = 4,
    distance: int = 4,
    blocks: int = 6,
    similarity: float | None = None,
) -> DataFrame:
    """The rows of ``docs`` with the smallest id of their component, with all their columns.

    Components are those of ``similar`` where a similarity is given, else of ``near_duplicates``. NULL ids come last. Rows with equal ids are ordered by a hash of their texts; of rows equal in both one stays.
    """
    key = {"_d": F.coalesce(F.col(id_col).cast("long"), F.lit((1 << 63) - 1)), "_h": F.xxhash64(text_col)}
    keyed = docs.select(F.struct(*[c.alias(n) for n, c in key.items()]).alias("key"), F.col(text_col).alias("text"))
    if similarity is None:
        found = near_duplicates(keyed, "key", "text", width, distance, blocks)
    else:
        found = similar(keyed, "key", "text", width, similarity, distance)
    heads = found.select("component.*").distinct()
    rows = docs.select(F.struct("*").alias("row"), *[c.alias(n) for n, c in key.items()]).join(heads, ["_d", "_h"], "left_semi")
    place = F.row_number().over(Window.partitionBy("_d", "_h").orderBy(F.lit(0)))
    return rows.withColumn("place", place).where("place = 1").select("row.*")

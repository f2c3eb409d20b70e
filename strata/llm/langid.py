"""Language identification: sparse multinomial logistic regression on TF-IDF character n-grams.

N-grams of one to three characters are hashed into a fixed number of buckets. Document frequencies are counted over all
training documents; weights are learnt with the follow-the-regularised-leader update under an elastic-net penalty, from a
bounded sample of each language; a temperature fitted on a part of the sample that the weights have not seen turns their
scores into probabilities.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.llm.common import pieces, texts

BUCKETS = 1 << 15
#: Documents, about, of each language from which weights are learnt, and the part of them for the temperature.
SAMPLE, SET_ASIDE = 500, 5
#: Vectors of document frequencies that reach the driver.
SUMS = 16
#: Bytes of texts, and characters of one text, that are turned to n-grams at a time.
STRETCH = 1 << 20
UNKNOWN = "und"

_FACTORS = np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D, 0x27D4EB2F], np.uint32)
_LETTERS: list[np.ndarray] = []


def _letters() -> np.ndarray:
    if not _LETTERS:
        _LETTERS.append(np.array([chr(c).isalpha() for c in range(0x110000)]))
    return _LETTERS[0]


def grams(found: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(3, n) buckets of the n-grams that start at each character, ``BUCKETS`` where there is none, and each text's start.

    Letters are lower-cased and all else is a blank; the blank before a text counts as its first character. Single letters,
    pairs with a letter, and threes with a letter in the middle are n-grams.
    """
    lowered = [t.decode().lower() for t in found]
    starts = np.cumsum([0, *(len(t) + 1 for t in lowered)])[:-1]
    chars = np.frombuffer(("\n" + "\n".join(lowered) + "\n\n").encode("utf-32-le"), np.uint32)
    letter = _letters()[chars]
    chars = np.where(letter, chars, np.uint32(32))
    n = len(chars) - 2
    a, b, c = chars[:n] * _FACTORS[0], chars[1 : n + 1] * _FACTORS[1], chars[2:] * _FACTORS[2]
    shift = np.uint32(32 - BUCKETS.bit_length() + 1)
    out = np.empty((3, n), np.int32)
    for i, (value, real) in enumerate((
        (a, letter[:n]), (a + b, letter[:n] | letter[1 : n + 1]), (a + b + c, letter[1 : n + 1])
    )):
        mixed = (value ^ value >> np.uint32(15)) * _FACTORS[3] + np.uint32(i * 0x9E3779B1 & 0xFFFFFFFF)
        out[i] = np.where(real, (mixed ^ mixed >> np.uint32(13)) * _FACTORS[2] >> shift, BUCKETS)
    return out[:, : starts[-1] + len(lowered[-1]) + 1] if found else out[:, :0], starts


def stretches(found: list[bytes], size: int = STRETCH) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(number of the first text, buckets, starts) as by :func:`grams`; texts of many characters come in stretches of ``size``.

    The stretches of a text follow each other and together hold its n-grams, so that memory does not grow with the longest text.
    """
    if sum(map(len, found)) <= size:
        if found:
            yield 0, *grams(found)
        return
    for i, text in enumerate(found):
        lowered = text.decode().lower()
        for at in range(0, max(len(lowered), 1), size):
            buckets, starts = grams([lowered[at : at + size + 2].encode()])  # two more characters, for the last n-grams
            yield i, buckets[:, at > 0 : 1 + min(size, len(lowered) - at)], starts


def held_out(key: Column) -> Column:
    """Whether the CRC-32 of the key as text leaves remainder 1 by 3."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit(""))) % 3 == 1


@dataclass
class Ftrl:
    """Follow the regularised leader, one coordinate at a time, for softmax regression on sparse rows."""

    features: int
    classes: int
    rate: float = 0.5
    smooth: float = 1.0
    l1: float = 0.02
    l2: float = 0.02
    z: np.ndarray = field(init=False)
    n: np.ndarray = field(init=False)

    def __post_init__(self):
        self.z = np.zeros((self.features, self.classes))
        self.n = np.zeros((self.features, self.classes))

    def weights(self, rows=slice(None)) -> np.ndarray:
        z = self.z[rows]
        pull = (self.smooth + np.sqrt(self.n[rows])) / self.rate + self.l2
        return np.where(np.abs(z) <= self.l1, 0.0, -(z - np.sign(z) * self.l1) / pull)

    def learn(self, at: np.ndarray, x: np.ndarray, label: int) -> None:
        w = self.weights(at)
        p = softmax(x @ w)
        p[label] -= 1
        g = x[:, None] * p
        step = (np.sqrt(self.n[at] + g * g) - np.sqrt(self.n[at])) / self.rate
        self.z[at] += g - step * w
        self.n[at] += g * g


def softmax(scores: np.ndarray) -> np.ndarray:
    e = np.exp(scores - scores.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


@dataclass
class Model:
    """``table`` holds a row of class weights, times inverse document frequency, for each bucket and one of zeros."""

    classes: list[str]
    table: np.ndarray
    temperature: float
    bias: np.ndarray

    def scores(self, found: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Class scores over the temperature, and the number of n-grams, of each text."""
        summed, total = np.zeros((len(found), len(self.classes))), np.zeros(len(found), np.int64)
        for first, at, starts in stretches(found):
            rows = slice(first, first + len(starts))
            total[rows] += np.add.reduceat((at[1] < BUCKETS).astype(np.int64) + (at[0] < BUCKETS) + (at[2] < BUCKETS), starts)
            summed[rows] += sum(np.add.reduceat(self.table[row], starts, axis=0, dtype=np.float64) for row in at)
        return (summed / np.maximum(total, 1)[:, None] + self.bias) / self.temperature, total


def counted(found: list[bytes]) -> list[tuple[np.ndarray, np.ndarray]]:
    """The buckets of each text's n-grams, and how often each is met."""
    out: list[tuple[np.ndarray, np.ndarray]] = []
    for first, at, starts in stretches(found):
        for i, (a, b) in enumerate(zip(starts, [*starts[1:], at.shape[1]]), first):
            seen, n = np.unique(at[:, a:b], return_counts=True)
            if i < len(out):  # a further stretch of the last text
                seen, place = np.unique(np.concatenate([out[i][0], seen]), return_inverse=True)
                n = np.bincount(place, np.concatenate([out[i][1], n])).astype(np.int64)
                out[i] = seen, n
            else:
                out.append((seen, n))
    return [(u[u < BUCKETS], c[u < BUCKETS]) for u, c in out]


#: Relative frequencies are small; times this they are of the size of counts.
SCALE = 30.0


def _frequencies(train: DataFrame) -> tuple[np.ndarray, int]:
    """Of how many texts each bucket holds an n-gram, and the number of texts. Vectors are summed in tasks, in two rounds."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df = np.zeros(BUCKETS + 2, np.int64)
        for batch in pieces(batches, "text", 1 << 20):
            found = texts(batch.column("text"))
            for seen, _ in counted(found):
                df[seen] += 1
            df[-1] += len(found)
        yield pa.RecordBatch.from_pydict({"v": pa.array([df.tobytes()], pa.binary())})

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df = np.zeros(BUCKETS + 2, np.int64)
        for batch in batches:
            for v in batch.column("v").to_pylist():
                df += np.frombuffer(v, np.int64)
        yield pa.RecordBatch.from_pydict({"v": pa.array([df.tobytes()], pa.binary())})

    parts = train.select("text").mapInArrow(count, "v binary").repartition(SUMS).mapInArrow(add, "v binary").collect()
    df = np.sum([np.frombuffer(r.v, np.int64) for r in parts], axis=0) if parts else np.zeros(BUCKETS + 2, np.int64)
    return df[:BUCKETS], int(df[-1])


def _sample(train: DataFrame, size: int) -> list:
    """(label, mark, buckets, counts) of about ``size`` documents of each language.

    They are chosen by a hash of the key and of the row's number as it is read, so that rows of one key spread like others.
    """
    counts = {r.label: r["count"] for r in train.groupBy("label").count().collect()}
    if not counts:
        return []
    mark = F.pmod(F.xxhash64("key", F.monotonically_increasing_id()), F.lit(1 << 40))
    limits = F.create_map(*[F.lit(x) for k, c in counts.items() for x in (k, min(1 << 40, (size << 40) // c))])
    marked = train.select("label", mark.alias("mark"), "text")
    chosen = marked.where(F.col("mark") < F.element_at(limits, F.col("label")))

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text", 1 << 20):
            rows = counted(texts(batch.column("text")))
            binary = [pa.array([x.astype("<i4").tobytes() for x in side], pa.binary()) for side in zip(*rows)]
            yield pa.RecordBatch.from_arrays([batch.column("label"), batch.column("mark"), *binary], ["label", "mark", "at", "n"])

    return chosen.mapInArrow(features, "label string, mark long, at binary, n binary").collect()


def fit(train: DataFrame, sample: int = SAMPLE, epochs: int = 4) -> Model | None:
    """A model of (key, label, text); rows without a label or text are left out. None where nothing is left to learn from."""
    train = train.dropna(subset=["label", "text"])
    df, total = _frequencies(train)
    rows = sorted(_sample(train, sample), key=lambda r: (r.mark, r.label, bytes(r.at)))
    classes = sorted({r.label for r in rows})
    if not classes:
        return None
    idf = np.log((1 + total) / (1 + df)) + 1
    data = []
    for r in rows:
        at, n = np.frombuffer(r.at, "<i4"), np.frombuffer(r.n, "<i4")
        if len(at):
            data.append((np.append(at, BUCKETS), np.append(SCALE * n / n.sum() * idf[at], 1.0), classes.index(r.label)))
    model = Ftrl(BUCKETS + 1, len(classes))
    learn, check = [d for i, d in enumerate(data) if i % SET_ASIDE], data[::SET_ASIDE]
    for _ in range(epochs):
        for at, x, label in learn or check:
            model.learn(at, x, label)
    w = model.weights()
    scores = np.array([x @ w[at] for at, x, _ in check]) if check else np.zeros((0, len(classes)))
    temperature = fit_temperature(scores, np.array([label for *_, label in check], int))
    table = np.vstack([SCALE * idf[:, None] * w[:BUCKETS], np.zeros((1, len(classes)))]).astype(np.float32)
    return Model(classes, table, temperature, w[BUCKETS])


def fit_temperature(scores: np.ndarray, labels: np.ndarray) -> float:
    """The divisor of the scores for which the labels are likeliest, between 1/20 and 20."""
    if not len(labels):
        return 1.0
    tries = np.exp(np.linspace(-3, 3, 121))
    loss = [-np.log(np.maximum(softmax(scores / t)[np.arange(len(labels)), labels], 1e-300)).mean() for t in tries]
    return float(tries[int(np.argmin(loss))])


def predict(docs: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, lang_pred, score): the likeliest language of every whole text and its calibrated probability.

    ``und`` with score 0 for NULL, for texts without a letter, and where there is no model. Only texts are read.
    """
    shipped = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    schema = T.StructType([rows.schema["id"], T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shipped.value
        for batch in pieces(batches, "text", 1 << 20):
            if model is None:
                lang, score = [UNKNOWN] * batch.num_rows, np.zeros(batch.num_rows)
            else:
                scores, total = model.scores(texts(batch.column("text")))
                p = softmax(scores)
                best = p.argmax(axis=1)
                lang = [model.classes[i] if n else UNKNOWN for i, n in zip(best, total)]
                score = np.where(total > 0, p[np.arange(len(p)), best], 0.0)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(lang, pa.string()), pa.array(score, pa.float64())], ["id", "lang_pred", "score"]
            )

    return rows.mapInArrow(run, schema)

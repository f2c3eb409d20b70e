"""Toxicity: a linear-chain conditional random field tags toxic words, and its marginals make a score per document.

Documents are labelled, words are not. Features of a word are the word and its beginnings. Those that are far more frequent
in toxic documents than in others are taken one by one, each time the one that explains most documents not yet explained
by ``WORDS`` words; words with such a feature count as labelled toxic in toxic documents, all others as clean. The field has a
weight for each of these features, one for every word, and one for each step between states; chains are sentences, of at
most ``CHAIN`` words. Forward-backward marginals of a half and more tag words; their sum and the largest marginal go through a
logistic function fitted to the labels of the documents.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.llm.common import WORD, pieces, texts

#: Toxic documents, about, from which the model is learnt, and how many times as many others.
SAMPLE, OTHERS = 800, 3
#: Words in a chain, and lengths of word beginnings that are features.
CHAIN, BEGINNINGS = 64, (3, 4, 5, 6)
#: A feature must be so many times more frequent in toxic documents than in others; documents are lost to it if they are not
#: toxic, each one as so many that it explains. Features that are less sure explain what the surer ones leave.
SURE, LESS_SURE = (20.0, 10.0), (5.0, 2.0)
#: A feature must explain this share of the toxic documents, and so many words explain a document.
WORDS = 4
SHARE = 0.01
#: Distinct words whose features a Python worker keeps.
KEPT = 300_000

_EDGES = re.compile(r"^\W+|\W+$")
_WORD = re.compile(WORD)
_ENDS = (".", "!", "?")


@lru_cache(maxsize=100_000)
def features(word: str) -> tuple[str, ...]:
    """The lower-cased word without marks at its ends, and its beginnings; none where nothing is left."""
    bare = word.lower()
    if not bare.isalnum():
        bare = _EDGES.sub("", bare)
    return (f"={bare}", *[bare[:k] for k in BEGINNINGS if len(bare) > k]) if bare else ()


def chains(words: list[str]) -> list[tuple[int, int]]:
    """Sentences as ranges of words: up to a word that ends with a full stop or the like, and at most ``CHAIN`` words."""
    out, start = [], 0
    for i, w in enumerate(words, 1):
        if w.endswith(_ENDS) or i - start == CHAIN:
            out.append((start, i))
            start = i
    return out + [(start, len(words))] if start < len(words) else out


# --- the field ---


def forward_backward(scores: np.ndarray, lengths: np.ndarray, steps: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Marginals of the toxic state (n, L), expected steps (n, 2, 2) and log normalisers of n chains.

    ``scores`` (n, L) are the toxic state's, the clean state's being 0; ``steps`` (2, 2) are scores of neighbouring states.
    """
    n, width = scores.shape
    top = np.maximum(scores, 0)
    emit = np.stack([np.exp(-top), np.exp(scores - top)], axis=-1)
    move = np.exp(steps)
    ahead = np.zeros((n, width, 2))
    scale = np.ones((n, width))
    for t in range(width):
        a = emit[:, t] if t == 0 else (ahead[:, t - 1] @ move) * emit[:, t]
        scale[:, t] = a.sum(axis=1)
        ahead[:, t] = a / scale[:, t, None]
    inside = np.arange(width) < lengths[:, None]
    back = np.ones((n, 2))
    p, pairs = np.zeros((n, width)), np.zeros((n, 2, 2))
    for t in range(width - 1, -1, -1):
        here = ahead[:, t] * back
        p[:, t] = np.where(inside[:, t], here[:, 1] / here.sum(axis=1), 0)
        if t:
            pull = emit[:, t] * back / scale[:, t, None]
            step = ahead[:, t - 1, :, None] * move * pull[:, None, :]
            pairs += np.where(inside[:, t, None, None], step, 0)
            back = np.where(inside[:, t, None], pull @ move.T, 1.0)
    return p, pairs, np.where(inside, np.log(scale) + top, 0).sum(axis=1)


@dataclass
class Field:
    """Weights of features, of every word, and of steps."""

    weights: dict[str, float]
    bias: float
    steps: np.ndarray

    def score(self, word: str) -> float:
        return self.bias + sum(self.weights.get(f, 0.0) for f in features(word))


def fit_field(sentences: list[tuple[list[str], list[int]]], names: list[str], rounds: int = 150, l2: float = 0.5) -> Field:
    """The field that makes the words' labels likeliest, by gradient steps with momentum, under a quadratic penalty.

    Sentences without a feature in use differ by length alone, so one of each length stands for all.
    """
    number = {name: i for i, name in enumerate(names)}
    rows, labels, times = [], [], []
    plain: Counter = Counter()
    known: dict[str, list[int]] = {}
    for words, marks in sentences:
        for w in words:
            if w not in known:
                known[w] = [number[f] for f in features(w) if f in number]
        if any(map(known.__getitem__, words)):
            rows.append([known[w] for w in words])
            labels.append(marks)
            times.append(1.0)
        else:
            plain[len(words)] += 1
    for length, count in sorted(plain.items()):
        rows.append([[]] * length)
        labels.append([0] * length)
        times.append(float(count))
    if not rows:
        return Field({}, -5.0, np.zeros((2, 2)))
    lengths, times = np.array([len(r) for r in rows]), np.array(times)
    width = int(lengths.max())
    y = np.zeros((len(rows), width))
    for i, marks in enumerate(labels):
        y[i, : len(marks)] = marks
    at = np.array([(i, t, f) for i, r in enumerate(rows) for t, fs in enumerate(r) for f in fs], int).reshape(-1, 3)
    inside = np.arange(width) < lengths[:, None]
    both = inside[:, 1:]
    seen = np.zeros((2, 2))
    for a in (0, 1):
        for b in (0, 1):
            seen[a, b] = (times[:, None] * (both & (y[:, :-1] == a) & (y[:, 1:] == b))).sum()
    w = np.zeros(len(names) + 5)
    mean, square = np.zeros_like(w), np.zeros_like(w)
    for step in range(1, rounds + 1):
        scores = np.full((len(rows), width), w[-5])
        np.add.at(scores, (at[:, 0], at[:, 1]), w[at[:, 2]])
        p, pairs, _ = forward_backward(scores, lengths, w[-4:].reshape(2, 2))
        off = times[:, None] * np.where(inside, p - y, 0)
        g = np.append(np.bincount(at[:, 2], off[at[:, 0], at[:, 1]], len(names)), off.sum())
        g = np.append(g, (times[:, None, None] * pairs).sum(axis=0) - seen) + l2 * w
        mean, square = 0.9 * mean + 0.1 * g, 0.99 * square + 0.01 * g * g
        w -= 0.2 * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.99**step)) + 1e-8)
    return Field(dict(zip(names, w[: len(names)].tolist())), float(w[-5]), w[-4:].reshape(2, 2))


# --- documents ---


@dataclass
class Model:
    field: Field
    logistic: np.ndarray  # of one, the log of one plus the tagged mass, and the largest marginal

    def tag(self, words: list[str], score) -> tuple[list[int], list[float]]:
        """Words tagged as toxic, and their marginals; ``score`` gives a word's."""
        values = np.array([score(w) for w in words])
        found = [(a, b) for a, b in chains(words) if (values[a:b] != self.field.bias).any()]
        if not found:
            return [], []
        lengths = np.array([b - a for a, b in found])
        scores = np.full((len(found), int(lengths.max())), self.field.bias)
        for i, (a, b) in enumerate(found):
            scores[i, : b - a] = values[a:b]
        p, _, _ = forward_backward(scores, lengths, self.field.steps)
        at, marginal = [], []
        for i, (a, b) in enumerate(found):
            for t in np.flatnonzero(p[i, : b - a] >= 0.5).tolist():
                at.append(a + t)
                marginal.append(float(p[i, t]))
        return at, marginal

    def probability(self, marginals: list[float]) -> float:
        return float(1 / (1 + np.exp(-self.logistic @ document(marginals))))


def document(marginals: list[float]) -> np.ndarray:
    return np.array([1.0, np.log1p(sum(marginals)), max(marginals, default=0.0)])


def fit_logistic(x: np.ndarray, y: np.ndarray, times: np.ndarray, l2: float = 1.0) -> np.ndarray:
    """Weighted logistic regression by Newton's steps, with a penalty on all but the constant."""
    w = np.zeros(x.shape[1])
    ridge = np.diag([1e-6] + [l2] * (x.shape[1] - 1))
    for _ in range(50):
        p = 1 / (1 + np.exp(-x @ w))
        g = x.T @ (times * (p - y)) + ridge @ w
        h = (x * (times * p * (1 - p))[:, None]).T @ x + ridge
        w -= np.clip(np.linalg.solve(h, g), -2, 2)
    return w


def _sample(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, size: int):
    """Texts and labels of about ``size`` toxic documents and ``OTHERS`` times as many others, chosen by a hash of the id, and
    the labels' counts. Of rows with one id the least text is taken."""
    known = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("y")).dropna()
    known = known.groupBy("id").agg((F.max("y") > 0).cast("int").alias("y"))
    counts = {r.y: r["count"] for r in known.groupBy("y").count().collect()}
    if not counts:
        return [], counts
    wanted = {1: size, 0: OTHERS * size}
    limits = F.create_map(*[F.lit(x) for y, c in counts.items() for x in (y, min(1 << 40, (wanted[y] << 40) // c))])
    chosen = known.where(F.pmod(F.xxhash64("id", F.lit("toxic")), F.lit(1 << 40)) < F.element_at(limits, F.col("y")))
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).dropna()
    rows = rows.join(F.broadcast(chosen), "id")  # (1 + OTHERS) * size rows, about, of two numbers
    rows = rows.groupBy("id").agg(F.min("text").alias("text"), F.first("y").alias("y"))
    return sorted((r.text, r.y) for r in rows.select("text", "y").toLocalIterator()), counts


def telling_features(toxic: list[list[str]], clean: list[list[str]]) -> set[str]:
    """Features that tell toxic texts, chosen for what they explain beyond those chosen before.

    Copies of a text share its chance words, too, but once a few words explain them these are no longer asked for.
    """
    count: dict[bool, Counter] = {True: Counter(), False: Counter()}
    for kind, group in ((True, toxic), (False, clean)):
        for words in group:
            count[kind].update({f for w in set(words) for f in features(w)})
    least = max(2.0, SHARE * len(toxic))
    share = len(toxic) / max(len(clean), 1)
    times = {f: c / (share * (count[False][f] + 0.5)) for f, c in count[True].items() if c >= least}
    chosen: set[str] = set()
    hits = [0] * len(toxic)
    explained: list[set] = [set() for _ in toxic]
    for ratio, loss in (SURE, LESS_SURE):
        usable = {f for f, x in times.items() if x >= ratio}
        # the words of each text that is not explained yet, with their usable features
        left = {}
        for i, words in enumerate(toxic):
            if hits[i] < WORDS:
                left[i] = {w: fs for w in set(words) - explained[i] if (fs := usable.intersection(features(w)))}
        while left:
            gain = Counter(f for words in left.values() for f in set().union(*words.values()))
            worth = lambda f: (gain[f] - loss * share * count[False][f], len(f), f)  # noqa: E731, B023
            best = max(gain, key=worth, default=None)
            if best is None or worth(best)[0] < least:
                break
            chosen.add(best)
            for i, words in list(left.items()):
                found = {w for w, fs in words.items() if best in fs}
                hits[i] += len(found)
                explained[i] |= found
                left[i] = {w: fs for w, fs in words.items() if w not in found}
                if hits[i] >= WORDS:
                    del left[i]
    return chosen


def fit(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", sample: int = SAMPLE
) -> Model | None:
    """A model of the documents that ``labels`` (id, label) marks; ids with several labels are toxic if one is.

    None where no document of each label is found. Equal texts count once.
    """
    rows, counts = _sample(docs, labels, id_col, text_col, label_col, sample)
    rows = sorted(dict(rows).items())
    toxic = sum(y for _, y in rows)
    if not toxic or toxic == len(rows):
        return None
    one: dict[str, str] = {}  # of equal words
    split = [([one.setdefault(w, w) for w in _WORD.findall(t)], y) for t, y in rows]
    del one
    clean = len(rows) - toxic
    strong = telling_features([ws for ws, y in split if y], [ws for ws, y in split if not y])
    names = sorted(strong)
    sentences = []
    for words, y in split:
        marks = [int(not strong.isdisjoint(features(w))) for w in words] if y else [0] * len(words)
        sentences += [(words[a:b], marks[a:b]) for a, b in chains(words)]
    model = Model(fit_field(sentences, names), np.zeros(3))
    known: dict[str, float] = {}
    score = lambda w: known[w] if w in known else known.setdefault(w, model.field.score(w))
    x = np.array([document(model.tag(words, score)[1]) for words, _ in split])
    y = np.array([y for _, y in split], float)
    weight = np.where(y == 1, counts[1] / toxic, counts[0] / clean)
    model.logistic = fit_logistic(x, y, weight)
    return model


def score(docs: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, score, spans): the probability that a whole text is toxic, and its tagged spans.

    A span (start, end) counts characters of the text and takes neighbouring tagged words together. Texts without a tagged
    word, NULL and empty ones get the least score; without a model every score is 0. Only texts are read.
    """
    shipped = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    span = T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))
    schema = T.StructType([rows.schema["id"], T.StructField("score", T.DoubleType()), T.StructField("spans", span)])
    spans_arrow = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shipped.value
        values: dict[bytes, float] = {}
        least = model.probability([]) if model else 0.0
        for batch in pieces(batches, "text", 2 << 20):
            found = texts(batch.column("text"))
            words = [t.split() for t in found]
            scores, spans = [least] * len(found), [[] for _ in found]
            if model:
                seen = set().union(*words)
                if len(values) + len(seen) > KEPT:
                    values = {}
                for w in seen:
                    if w not in values:
                        values[w] = model.field.score(w.decode())
                marked = {w for w in seen if values[w] != model.field.bias}
                for i, ws in enumerate(words):
                    if marked and not marked.isdisjoint(ws):
                        known = {w.decode(): values[w] for w in ws}
                        at, p = model.tag([w.decode() for w in ws], known.__getitem__)
                        scores[i], spans[i] = model.probability(p), _spans(found[i].decode(), at)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(scores, pa.float64()), pa.array(spans, spans_arrow)], ["id", "score", "spans"]
            )

    return rows.mapInArrow(run, schema)


def _spans(text: str, at: list[int]) -> list[dict]:
    """Character ranges of the words with these numbers, neighbours as one."""
    tagged, out, last = set(at), [], -2
    for i, word in enumerate(_WORD.finditer(text)):
        if i in tagged:
            if i == last + 1:
                out[-1]["end"] = word.end()
            else:
                out.append({"start": word.start(), "end": word.end()})
            last = i
    return out

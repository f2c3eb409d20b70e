"""Quality rules as a short-circuit cascade, ordered by what a sample says of each rule's cost and rejections.

Every rule is a comparison of facts about a text. Facts are computed for many texts at a time, and only for those that no
earlier rule has rejected; rules that share facts share their cost. The verdict does not depend on the order.
"""

from __future__ import annotations

import time
from collections import defaultdict
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.llm.common import pieces, texts

#: Rows, about, on which costs and rejections are estimated.
SAMPLE = 2000
SYMBOLS = b"#*$%&|<>"

_BLANK = np.zeros(256, bool)
_BLANK[[32, 9, 10, 11, 12, 13]] = True
_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(SYMBOLS)] = True
_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True
_LOWER = np.zeros(256, bool)
_LOWER[97:123] = True
_STARTS = np.ones(256, bool)  # bytes that begin a code point
_STARTS[128:192] = False


class Facts:
    """Facts about some texts, each computed when it is first asked for."""

    def __init__(self, found: list[bytes]):
        self.found, self.known = found, {}

    def __getitem__(self, name: str) -> np.ndarray:
        if name not in self.known:
            self.known |= FACTS[name](self)
        return self.known[name]

    def only(self, rows: np.ndarray) -> Facts:
        """The facts of some of the texts."""
        if len(rows) == len(self.found):
            return self
        less = Facts([self.found[i] for i in rows])
        less.known = {k: v[rows] for k, v in self.known.items()}
        return less

    def _bytes(self) -> tuple[np.ndarray, np.ndarray]:
        """All texts after one another, each with a line break behind it, and where each starts."""
        starts = np.cumsum([0, *(len(t) + 1 for t in self.found)])[:-1]
        return np.frombuffer(b"\n".join(self.found) + b"\n", np.uint8), starts

    def letters(self) -> dict:
        if not self.found:
            return {k: np.zeros(0, np.int64) for k in ("n_words", "word_chars", "n_symbols", "n_upper", "n_lower")}
        flat, starts = self._bytes()
        blank = _BLANK[flat]
        begins = ~blank & np.concatenate([[True], blank[:-1]])
        total = lambda flags: np.add.reduceat(flags, starts, dtype=np.int64)
        return {
            "n_words": total(begins), "word_chars": total(_STARTS[flat] & ~blank), "n_symbols": total(_SYMBOL[flat]),
            "n_upper": total(_UPPER[flat]), "n_lower": total(_LOWER[flat]),
        }

    def lines(self) -> dict:
        counts, again = [], []
        for t in self.found:
            full = [line for line in t.split(b"\n") if line.strip()]
            counts.append(len(full))
            again.append(len(full) - len(set(full)))
        return {"n_lines": np.array(counts, np.int64), "n_dup_lines": np.array(again, np.int64)}

    def repeats(self) -> dict:
        ids: defaultdict = defaultdict()
        ids.default_factory = ids.__len__
        words = [t.split() for t in self.found]
        counts = np.array([len(ws) for ws in words], np.int64)
        at = np.fromiter((ids[w] for ws in words for w in ws), np.int64, int(counts.sum()))
        doc = np.repeat(np.arange(len(words)), counts)
        out = np.zeros(len(words), np.int64)
        if len(at) > 2:
            bits, wide = max(1, (len(ids) - 1).bit_length()), max(1, (len(words) - 1).bit_length())
            inside = doc[:-2] == doc[2:]
            a, b, c, d = at[:-2][inside], at[1:-1][inside], at[2:][inside], doc[:-2][inside]
            if 3 * bits + wide <= 63:
                key = ((d << bits | a) << bits | b) << bits | c
            else:
                key = np.unique(a << 32 | b, return_inverse=True)[1] << 31 | c
                key = np.unique(key, return_inverse=True)[1] << 31 | d
            _, same, times = np.unique(key, return_inverse=True, return_counts=True)
            covered = np.zeros(len(at), bool)
            first = np.flatnonzero(inside)[times[same] > 1]
            for shift in range(3):
                covered[first + shift] = True
            out += np.bincount(doc[covered], minlength=len(words))
        return {"n_repeat_words": out}


FACTS: dict[str, Callable[[Facts], dict]] = (
    dict.fromkeys(("n_words", "word_chars", "n_symbols", "n_upper", "n_lower"), Facts.letters)
    | dict.fromkeys(("n_lines", "n_dup_lines"), Facts.lines)
    | {"n_repeat_words": Facts.repeats}
)


@dataclass(frozen=True)
class Rule:
    """Rejects the texts for which ``fails`` is true."""

    name: str
    fails: Callable[[Facts], np.ndarray]


#: The base rules, whose numbers are given.
BASE = (
    Rule("few_words", lambda f: f["n_words"] < 50),
    Rule("repeated_words", lambda f: 100 * f["n_repeat_words"] > 50 * f["n_words"]),
)
RULES = (
    *BASE,
    Rule("symbols", lambda f: 10 * f["n_symbols"] > f["n_words"]),
    Rule("repeated_lines", lambda f: 5 * f["n_dup_lines"] > 2 * f["n_lines"]),
    Rule("short_words", lambda f: 10 * f["word_chars"] < 25 * f["n_words"]),
    Rule("long_words", lambda f: f["word_chars"] > 12 * f["n_words"]),
    Rule("capitals", lambda f: f["n_upper"] > f["n_lower"]),
)


def cascade(facts: Facts, rules: tuple[Rule, ...]) -> np.ndarray:
    """The numbers of the texts that pass all rules; each rule sees only what the earlier ones let through."""
    kept = np.arange(len(facts.found))
    for rule in rules:
        passed = np.flatnonzero(~rule.fails(facts))
        kept, facts = kept[passed], facts.only(passed)
    return kept


def estimate(docs: DataFrame, text_col: str = "text", rules: tuple[Rule, ...] = RULES, sample: int = SAMPLE) -> DataFrame:
    """(rule, rows, rejected, seconds) on about ``sample`` rows, each rule alone."""
    rows = docs.select(F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    count = rows.count()
    rows = rows.sample(min(1.0, sample / count), seed=7) if count else rows

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text", 2 << 20):
            found, out = texts(batch.column("text")), []
            for rule in rules:
                begun = time.perf_counter()
                rejected = int(rule.fails(Facts(found)).sum())
                out.append({"rule": rule.name, "rows": len(found), "rejected": rejected, "seconds": time.perf_counter() - begun})
            yield pa.RecordBatch.from_pylist(out, schema=_ESTIMATES)

    every = rows.mapInArrow(run, "rule string, rows long, rejected long, seconds double")
    return every.groupBy("rule").agg(*[F.sum(c).alias(c) for c in ("rows", "rejected", "seconds")])


_ESTIMATES = pa.schema([("rule", pa.string()), ("rows", pa.int64()), ("rejected", pa.int64()), ("seconds", pa.float64())])


def ordered(docs: DataFrame, text_col: str = "text", rules: tuple[Rule, ...] = RULES, sample: int = SAMPLE) -> tuple[Rule, ...]:
    """The rules by rejections per second on a sample, best first; in the given order where the sample is empty."""
    worth = {r.rule: r.rejected / max(r.seconds, 1e-9) for r in estimate(docs, text_col, rules, sample).collect()}
    return tuple(sorted(rules, key=lambda r: -worth.get(r.name, 0.0)))


def judge(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    rules: tuple[Rule, ...] = RULES,
    report: tuple[str, ...] = (),
    sample: int = SAMPLE,
) -> DataFrame:
    """(id, kept) and the facts in ``report``, which are computed for every text.

    Each row is judged by itself; NULL counts as an empty text, which has no words. Other columns are not read.
    """
    order = ordered(docs, text_col, rules, sample)
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    schema = T.StructType(rows.schema.fields[:1] + [T.StructField(n, T.LongType()) for n in report])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text", 2 << 20):
            facts = Facts(texts(batch.column("text")))
            told = [pa.array(facts[name]) for name in report]
            kept = np.zeros(batch.num_rows, bool)
            kept[cascade(facts, order)] = True
            yield pa.RecordBatch.from_arrays([batch.column("id"), *told, pa.array(kept)], ["id", *report, "kept"])

    return rows.mapInArrow(run, schema.add("kept", T.BooleanType()))


def keep_good(docs: DataFrame, text_col: str = "text", rules: tuple[Rule, ...] = RULES, sample: int = SAMPLE) -> DataFrame:
    """The rows of ``docs`` that pass all rules, with all their columns."""
    order = ordered(docs, text_col, rules, sample)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, text_col, 2 << 20):
            yield batch.take(pa.array(cascade(Facts(texts(batch.column(text_col))), order)))

    return docs.mapInArrow(run, docs.schema)

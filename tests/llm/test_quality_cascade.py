import random
import re
from collections import Counter

import pytest

from strata.llm import quality

WORD = re.compile(r"[^\x20\x09-\x0D]+")
REPORT = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def plain(text):
    text = text or ""
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    grams = Counter(zip(words, words[1:], words[2:]))
    covered = {i + j for i in range(len(words) - 2) if grams[tuple(words[i : i + 3])] > 1 for j in range(3)}
    upper, lower = len(re.findall("[A-Z]", text)), len(re.findall("[a-z]", text))
    facts = (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered))
    n, chars, symbols, dup, rep = facts
    bad = n < 50 or 2 * rep > n or 10 * symbols > n or 5 * dup > 2 * len(lines)
    return (*facts, not (bad or 10 * chars < 25 * n or chars > 12 * n or upper > lower))


def made_up():
    rng = random.Random(9)
    out = [None, "", " \n", "a", "é" * 5, "x " * 70_000, "\n".join(["one line of it"] * 30 + ["another"]), "Word, " * 3]
    for _ in range(300):
        letters = rng.choice(["abcdef", "ABCDEf", "abé#|", "a"])
        blanks = rng.choice([" ", " \n", " \t\n\x0b", "  \n\n"])
        words = ["".join(rng.choices(letters, k=rng.randint(1, 9))) for _ in range(rng.randint(1, 60))]
        out.append("".join(rng.choice(words) + rng.choice(blanks) for _ in range(rng.randint(0, 160))))
    return out


def test_facts_and_verdicts(spark):
    found = made_up()
    df = spark.createDataFrame([(i, t, True) for i, t in enumerate(found)], "doc_id long, text string, kept boolean")
    got = {r.id: tuple(r)[1:] for r in quality.judge(df, report=REPORT).collect()}
    assert got == {i: plain(t) for i, t in enumerate(found)}
    assert {r.doc_id for r in quality.keep_good(df).collect()} == {i for i, t in enumerate(found) if plain(t)[-1]}
    assert quality.judge(df.limit(0)).count() == quality.keep_good(df.limit(0)).count() == 0


def test_repeated_rows_and_null_ids_stay(spark):
    text = " ".join(f"word{i}" for i in range(60))
    df = spark.createDataFrame([(1, text), (1, text), (None, text)], "doc_id long, text string")
    assert sorted(r.kept for r in quality.judge(df).collect()) == [True] * 3 and quality.keep_good(df).count() == 3


def test_the_order_changes_cost_only():
    found = [(t or "").encode() for t in made_up()]
    want = quality.cascade(quality.Facts(found), quality.RULES).tolist()
    for seed in range(5):
        rules = random.Random(seed).sample(quality.RULES, len(quality.RULES))
        assert quality.cascade(quality.Facts(found), tuple(rules)).tolist() == want
    asked = []
    spy = quality.Rule("spy", lambda f: asked.append(len(f.found)) or f["n_words"] < 0)
    quality.cascade(quality.Facts(found), (quality.BASE[0], spy))
    assert asked == [sum(len(t.split()) >= 50 for t in found)]


def test_large_vocabularies_count_alike():
    words = [f"{i}" for i in range(140_000)]
    found = [" ".join(words).encode(), (" ".join(words[:9]) + " " + " ".join(words[:5])).encode()]
    many = found + [b"a b c a b c"] * 9000
    assert quality.Facts(many)["n_repeat_words"].tolist() == [0, 10] + [6] * 9000


def test_order_follows_rejections_per_second(spark):
    df = spark.createDataFrame([("few words",)] * 50, "text string")
    assert quality.ordered(df)[0].name in ("few_words", "repeated_words", "symbols", "short_words", "capitals")
    assert quality.ordered(df)[0].name == "few_words"
    assert {r.rule: r.rejected for r in quality.estimate(df).collect()}["few_words"] == 50


@pytest.mark.parametrize("text, want", [("a b c a b c", 6), ("a a a a", 4), ("a b c d", 0), ("a b", 0)])
def test_repeated_words(text, want):
    assert quality.Facts([text.encode()])["n_repeat_words"].tolist() == [want]

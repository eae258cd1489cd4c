"""Collocations against plain counters."""

import random
import re
from collections import Counter

import pytest

from fieldmart.llm import collocations


def plain(rows, best=2000):
    f, n = {}, Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", text):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for k in (1, 2, 3):
                for i in range(len(words) - k + 1):
                    f.setdefault(lang, Counter())[tuple(words[i : i + k])] += 1
    out = []
    for lang, c in f.items():
        kept = []
        for phrase, a in c.items():
            if len(phrase) == 1 or a < 10:
                continue
            if any(100 * b >= 50 * a and len(q) > len(phrase) and any(q[i : i + len(phrase)] == phrase for i in range(2)) for q, b in c.items() if len(q) == 3 and b >= 10):
                continue
            cuts = [(1000000 * a * a // (c[phrase[:k]] * c[phrase[k:]]), k) for k in range(1, len(phrase))]
            score, k = min(cuts)
            kept.append((-score, -a, " ".join(phrase).encode(), c[phrase[:k]], c[phrase[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(kept)[:best], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, n[lang], -score))
    return sorted(out)


@pytest.fixture
def rows():
    rng = random.Random(5)
    words = ["New", "york", "city", "hall", "é", "of", "the", "the", "the", "x#y"]
    made = [("".join(rng.choice(words) + rng.choice([" ", " ", " ", "\t ", ". ", ",", "\n"]) for _ in range(rng.randrange(60))), rng.choice(["en", "en", "fr", None, "und"])) for _ in range(150)]
    return [*made, (None, "en"), ("", None), ("!!", "xx"), ("a b " * 700, "en"), ("new york city " * 40, "fr")]


@pytest.mark.parametrize("hot", [4096, 20])
def test_equals_plain_counters(spark, rows, monkeypatch, hot):
    """With no split stripe but those of the small table, and with split ones, in few buckets."""
    monkeypatch.setattr(collocations, "HOT", hot)
    monkeypatch.setattr(collocations, "BUCKETS", 3)
    df = spark.createDataFrame([(t, lang, 1, i % 3, "c") for i, (t, lang) in enumerate(rows)], "text string, lang string, n int, w1 int, part string").repartition(5)
    for best in (2000, 4):
        got = collocations.collocations(df, best).collect()
        assert sorted(tuple(r) for r in got) == plain(rows, best) and got


def test_scores_are_exact_beyond_64_bits(spark):
    df = spark.createDataFrame([(999_999_999_999, 999_999_999_999, 1_000_000_000_001)], "a long, l long, r long")
    assert df.select(collocations._exact("a", "l", "r")).first()[0] == 1000000 * 999_999_999_999**2 // (999_999_999_999 * 1_000_000_000_001)


def test_empty_and_rare(spark):
    assert collocations.collocations(spark.createDataFrame([], "text string, lang string")).count() == 0
    assert collocations.collocations(spark.createDataFrame([("a b c " * 3, "en")], "text string, lang string")).count() == 0

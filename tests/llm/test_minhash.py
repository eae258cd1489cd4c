"""Bottom-k sketches against all pairs."""

import random
from math import comb

import numpy as np

from fieldmart.llm import minhash


def plain(texts):
    """n_shingles and component_id of (doc_id, text) with distinct ids, by comparing all pairs."""
    sets = []
    for _, t in texts:
        w = (t or "").lower().split()
        sets.append({tuple(w[i : i + 3]) for i in range(len(w) - 2)} if len(w) > 2 else ({tuple(w)} if w else set()))
    root = list(range(len(texts)))
    find = lambda i: i if root[i] == i else find(root[i])
    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a and b and 100 * len(a & b) >= 85 * len(a | b):
                root[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(texts):
        least[find(i)] = min(d, least.get(find(i), d))
    return [(d, len(sets[i]), least[find(i)], d == least[find(i)]) for i, (d, _) in enumerate(texts)]


def run(spark, texts):
    df = spark.createDataFrame([(d, t, 1, "x") for d, t in texts], "doc_id long, text string, n int, list string").repartition(3)
    return sorted(tuple(r) for r in minhash.clusters(df).collect())


def edited(rng, words, n):
    out = list(words)
    for _ in range(n):
        i = rng.randrange(len(out))
        match rng.randrange(3):
            case 0:
                out[i] = f"e{rng.randrange(10**9)}"
            case 1:
                out.insert(i, f"e{rng.randrange(10**9)}")
            case _:
                del out[i]
    return out


def test_equals_all_pairs(spark):
    """Sets below and above the sketch, around the threshold, with groups, chains, short and empty texts."""
    rng = random.Random(3)
    texts = ["", None, " \t", "one", "One", "one two", "two one", "one two three"]
    for size in (4, 30, 120, 250, 262, 350, 900):
        for _ in range(3):
            base = [f"w{rng.randrange(10**6)}" for _ in range(size)]
            chain = base
            for k in range(6):
                texts.append(" ".join(edited(rng, base, rng.randrange(max(2, size // 12)))))
                chain = edited(rng, chain, size // 40 + k % 2)
                texts.append(" ".join(chain))
    ids = rng.sample(range(10**6), len(texts))
    rows = list(zip(ids, texts))
    assert run(spark, rows) == sorted(plain(rows))


def test_lists_of_unlike_sets(spark):
    """A hundred documents hold one long passage without being alike, each with a copy; and thirty pairs lie around one text, few of them alike."""
    rng = random.Random(4)
    words = lambda n: [f"w{rng.randrange(10**9)}" for _ in range(n)]
    shared, base, texts = words(240), words(300), []
    for _ in range(100):
        own = [*shared, *words(120)]
        texts += [" ".join(own), " ".join([*own, "more"])]
    for _ in range(30):
        own = edited(rng, base, 20)
        texts += [" ".join(own), " ".join(edited(rng, own, 1))]
    rows = list(enumerate(texts))
    assert run(spark, rows) == sorted(plain(rows))


def test_rows_without_or_with_repeated_ids(spark):
    t = " ".join(f"w{i}" for i in range(40))
    rows = [(5, t), (5, t), (None, t), (7, t + " x"), (None, None), (None, "alone is this"), (None, "alone is this"), (9, None)]
    got = spark.createDataFrame(rows, "doc_id long, text string")
    key = lambda r: tuple(-1 if x is None else x for x in r)
    out = sorted(key(r) for r in minhash.clusters(got).collect())
    assert out == sorted([(5, 38, 5, True), (5, 38, 5, True), (-1, 38, 5, False), (7, 39, 5, False), (-1, 0, -1, True), (-1, 1, -1, True), (-1, 1, -1, True), (9, 0, 9, True)])
    assert minhash.clusters(got.limit(0)).count() == 0


def test_needed_values():
    """A pair at the threshold falls below the bound once in 10^9 times, and the bound is the largest such one."""
    below = lambda m: sum(comb(256, x) * 0.85**x * 0.15 ** (256 - x) for x in range(m))
    assert below(minhash.needed()) <= 1e-9 < below(minhash.needed() + 1)


def test_least_shared():
    for n in range(1, 310):
        got = int(minhash.least_shared(np.array([n]))[0])
        assert 1 <= got <= min(n, minhash.KEPT)
        for m in range(-(-85 * n // 100), 100 * n // 85 + 1):
            if max(n, m) <= minhash.KEPT:
                assert got <= min(x for x in range(min(n, m) + 1) if 185 * x >= 85 * (n + m))


def test_variants_around_one_text(spark, monkeypatch):
    """Variants of one text that share enough of their sketches to meet, but none enough to link: they are not compared with one another."""
    rng = random.Random(5)
    base = [f"w{rng.randrange(10**9)}" for _ in range(400)]
    texts = []
    for _ in range(60):
        own = list(base)
        for i in rng.sample(range(0, 400, 5), 26):
            own[i] = f"e{rng.randrange(10**9)}"
        texts.append(" ".join(own))
    compared, estimated = [], minhash.estimated
    monkeypatch.setattr(minhash, "estimated", lambda pairs, known: compared.append(pairs.count()) or estimated(pairs, known))
    rows = list(enumerate(texts))
    assert run(spark, rows) == sorted(plain(rows))
    # all pairs are 1770
    assert sum(compared) < 300

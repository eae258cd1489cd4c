"""The pipeline's stages, each on what its predecessor kept, against brute force; and the classifier against a plain one."""

import collections
import itertools
import math
import re

import numpy as np
import pyarrow as pa
import pytest

from fieldmart.llm import mixing, toxicity

FOLDER = "/root/testdata/sf0.001"
LOWER = {ord(a): a.lower() for a in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}


def alnum(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def spaced(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))


def plain_ftrl(examples, epochs=8, alpha=0.5, beta=1.0, l1=0.5, l2=0.01):
    """FTRL-proximal coordinate by coordinate, as published."""
    z, n = collections.defaultdict(float), collections.defaultdict(float)

    def weight(i):
        return 0.0 if abs(z[i]) <= l1 else -(z[i] - math.copysign(l1, z[i])) / ((beta + math.sqrt(n[i])) / alpha + l2)

    for _ in range(epochs):
        for found, label in examples:
            coordinates = [*found, "bias"]
            weights = {i: weight(i) for i in coordinates}
            p = 1 / (1 + math.exp(-max(-35, min(35, sum(weights.values())))))
            for i in coordinates:
                g = p - label
                sigma = (math.sqrt(n[i] + g * g) - math.sqrt(n[i])) / alpha
                z[i] += g - sigma * weights[i]
                n[i] += g * g
    return {i: weight(i) for i in z if weight(i)}


def test_fit_equals_a_plain_ftrl():
    rng = np.random.default_rng(5)
    examples = [(np.unique(rng.integers(0, 60, 12)), int(rng.random() < 0.4)) for _ in range(80)]
    at, weights, bias = toxicity.fit(examples)
    expected = plain_ftrl([(x.tolist(), y) for x, y in examples])
    assert bias == pytest.approx(expected.pop("bias", 0.0))
    assert dict(zip(at.tolist(), weights.tolist(), strict=True)) == pytest.approx(expected)


def test_batches_for_python_are_bounded(spark):
    """By rows alone 1,000 texts of 30 KB would be one batch of 30 MB."""
    import corpus_pipeline
    from fieldmart.llm.common import BATCH_BYTES

    docs = spark.range(1000).selectExpr("id AS doc_id", "repeat('word ', 6000) AS text").coalesce(1)
    corpus_pipeline.near_copies(spark, docs.limit(0), FOLDER)

    def sizes(batches):
        for batch in batches:
            yield pa.record_batch([pa.array([batch.nbytes])], ["n"])

    found = [r.n for r in docs.mapInArrow(sizes, "n long").collect()]
    assert sum(found) >= 30_000_000 and max(found) <= BATCH_BYTES + 100_000


def test_stages_against_brute_force(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    items = [alnum(r.text) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "n-gram Jaccard join", "substring dedup", "benchmark decontamination", "mixing sources to target weights"]
    stages, before = [f for _, f in corpus_pipeline.STAGES], docs
    kept = []
    for i, stage in enumerate(stages):
        out = stage(spark, before, FOLDER)
        assert i == 4 or out.columns == docs.columns
        kept.append((before.collect(), out.collect()))
        before = spark.createDataFrame(kept[-1][1], out.schema)
    # rejected: exactly what the classifier's report predicts toxic
    bad = {r.doc_id for r in toxicity.report(docs, labels).filter("predicted = 1").collect()}
    assert {r.doc_id for r in kept[0][1]} == {r.doc_id for r in kept[0][0]} - bad
    # one of each component
    sets = {r.doc_id: {tuple(w[i : i + 5]) for i in range(len(w) - 4)} or ({tuple(w)} if w else set()) for r in kept[1][0] for w in [spaced(r.text)]}
    root = {i: i for i in sets}
    for a, b in itertools.combinations(sorted(sets), 2):
        if sets[a] and root[a] != root[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
            low, high = sorted((root[a], root[b]))
            root = {k: low if v == high else v for k, v in root.items()}
    assert sorted(r.doc_id for r in kept[1][1]) == sorted(set(root.values()))
    # no run of 50 words in two documents, nothing cut from a document that shares none, and only words go
    left = {r.doc_id: alnum(r.text) for r in kept[2][1]}
    runs = collections.Counter(run for w in left.values() for run in {tuple(w[s : s + 50]) for s in range(len(w) - 49)})
    assert max(runs.values(), default=0) <= 1
    grams = collections.defaultdict(set)
    for r in kept[2][0]:
        w = alnum(r.text)
        for s in range(len(w) - 19):
            grams[tuple(w[s : s + 20])].add(r.doc_id)
    sharing = {d for holders in grams.values() if len(holders) > 1 for d in holders}
    assert all(left[r.doc_id] == alnum(r.text) for r in kept[2][0] if r.doc_id not in sharing)
    # documents that hold a window of an item go, all others stay
    windows = {tuple(w[s : s + 10]) for w in items for s in range(max(len(w) - 9, 1)) if w}
    sizes = {len(w) for w in windows}
    holds = lambda w: any(tuple(w[s : s + n]) in windows for n in sizes for s in range(len(w) - n + 1))
    assert {r.doc_id for r in kept[3][1]} == {r.doc_id for r in kept[3][0] if not holds(alnum(r.text))}
    # what the mix takes of each source is its target
    by, total = collections.Counter(), sum(len(spaced(r.text)) for r in kept[4][0])
    for r in kept[4][1]:
        by[r.source] += r.taken
        assert 0 < r.taken <= 2 * r.size
    goals = {r.source: r.target for r in kept[4][1]}
    assert by == {s: math.floor(t) for s, t in goals.items()} and sum(goals.values()) <= 1.5 * total + 1e-6
    mixed = mixing.mix(spark.createDataFrame(kept[3][1], docs.schema)).filter("taken > 0")
    assert {tuple(r) for r in mixed.collect()} == {tuple(r[c] for c in mixed.columns) for r in kept[4][1]}
    # with the text that the stages left, and all other columns
    texts = {r.doc_id: (r.text, r.lang, r.n_chars) for r in kept[3][1]}
    assert all((r.text, r.lang, r.n_chars) == texts[r.doc_id] for r in kept[4][1])

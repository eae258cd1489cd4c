"""Nulls, empty tables, repeated rows and clashing names in the stages, and what the operators leave or take."""

import random

import pytest

from fieldmart.llm import chat, decontaminate, jaccard, mixing, passages, toxicity

CLASHING = "doc_id long, text string, lang string, source string, n_chars long, bad_id long, _k1 string, _rep int, row string, key int, t1 long, place int, cuts string"


@pytest.fixture(scope="module")
def odd(spark):
    rng = random.Random(11)
    words = lambda n: " ".join(f"w{rng.randrange(10**6)}" for _ in range(n))
    long, other = words(80), words(70)
    texts = [(1, long), (1, long), (1, other), (None, long), (None, None), (None, ""), (2, None), (3, ""), (3, ""), (4, long + " tail"), (5, words(60)), (6, other), (None, other + " x")]
    return spark.createDataFrame([(i, t, "en", None, len(t or ""), 7, "k", 1, "r", 2, 3, 4, "c") for i, t in texts], CLASHING)


def test_stages_keep_columns_and_take_nulls_and_empty_tables(spark, odd):
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    items = spark.createDataFrame([(1, "one two three")], "item_id long, text string")
    for stage in (lambda d: toxicity.clean(d, labels), jaccard.clean, passages.clean, lambda d: decontaminate.clean(d, items)):
        out = stage(odd)
        assert out.columns == odd.columns and out.count() > 0
        assert stage(odd.limit(0)).count() == 0
    assert mixing.mix(odd).count() == 13 and mixing.mix(odd.limit(0)).count() == 0


def test_jaccard_clean_marks_texts_not_ids(odd):
    """Id 1 stands for the copies of its first text and of its second; wordless rows all stay."""
    kept = sorted((r.doc_id or 0, (r.text or "")[-6:]) for r in jaccard.clean(odd).collect())
    assert len([k for k in kept if not k[1]]) == 5
    assert [k[0] for k in kept if k[1]] == [1, 1, 5]


def test_passages_clean_keeps_one_of_repeated_rows(odd):
    out = passages.clean(odd).collect()
    texts = [r.text for r in out if r.text]
    assert len(texts) == len(set(texts)) and len([r for r in out if not r.text]) == 5


def test_decontamination_counts_every_row(spark, odd):
    items = spark.createDataFrame([(9, odd.filter("doc_id = 5").first().text)], "item_id long, text string")
    rows = decontaminate.contamination(odd, items).collect()
    assert len(rows) == 13 and [(r.doc_id, r.n_hit, r.items) for r in rows if r.n_hit] == [(5, 60, ["9"])]
    assert sorted(r.doc_id or 0 for r in decontaminate.clean(odd, items).collect()) == sorted(r.doc_id or 0 for r in odd.collect() if r.doc_id != 5)


def test_a_bucket_of_many_unlike_sets(spark):
    """Three hundred documents share one passage without being alike; each has a copy with a word more."""
    rng = random.Random(12)
    words = lambda n: [f"w{rng.randrange(10**9)}" for _ in range(n)]
    shared, texts = words(40), []
    for _ in range(300):
        own = [*shared, *words(16)]
        texts += [" ".join(own), " ".join([*own, "more"])]
    rows = jaccard.clusters(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    assert sorted((r.doc_id, r.component_id) for r in rows) == [(i, i - i % 2) for i in range(600)]


def test_large_sets_are_pruned_without_loss(spark):
    """Sets of thousands of n-grams around the threshold, with bitmaps of different lengths."""
    rng = random.Random(13)
    words = lambda n: [f"w{rng.randrange(10**9)}" for _ in range(n)]
    base = words(2100)
    texts = [base, [*base, *words(600)], [*base, *words(800)], [*base[:1000], *words(1100)], base[:1590], base[:1500]]
    sets = [{tuple(t[i : i + 5]) for i in range(len(t) - 4)} for t in texts]
    root = list(range(len(texts)))
    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if 100 * len(a & b) >= 75 * len(a | b):
                low, high = sorted((root[i], root[j]))
                root = [low if r == high else r for r in root]
    got = jaccard.clusters(spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id long, text string"))
    assert [r.component_id for r in sorted(got.collect(), key=lambda r: r.doc_id)] == root


def test_mixing_by_a_given_score(spark):
    """Documents with a higher score are taken first, with small scores too."""
    rows = [(i, "a b c d e f g h i j", "s0" if i < 400 else "s1", 0.01 if i % 2 else 0.0001) for i in range(1200)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, mark double")
    from pyspark.sql import functions as F

    got = {r.doc_id: r.taken for r in mixing.mix(df, F.col("mark")).collect()}
    assert len(got) == 1200 and sum(got[i] for i in got if i % 2) > sum(got[i] for i in got if not i % 2)


def test_chat_of_more_turns_than_a_part(spark):
    turns = [(1, i, "user", f"t{i}") for i in range(1500)] + [(2, i, "user", f"t{i}") for i in range(1100)]
    rows = chat.collapse(spark.createDataFrame(turns, "conv_id long, turn long, role string, text string")).orderBy("part").collect()
    assert [(r.conv_id, r.part, r.n_turns, r.n_copies) for r in rows] == [(1, 0, 1500, 1), (1, 1, 1500, 1)]
    assert "".join(r.text for r in rows) == "".join(f"<|user|>\nt{i}<|end|>\n" for i in range(1500))

"""Every operator on a small table with nulls, empty and long texts, ties, repeated rows and columns with clashing names."""

import collections
import itertools
import math
import random
import re
import zlib

import numpy as np
import pytest

from pyspark.sql import functions as F

from fieldmart.llm.common import shared_dir
from fieldmart.llm import chat, decontaminate, jaccard, licenses, mixing, passages, quality, registry, scoring, toxicity, warc
from fieldmart.llm.text import ALNUM, SPACED, chunks, hash_of

LOWER = {ord(a): a.lower() for a in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, n int, group string"


def alnum(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def spaced(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))


def make():
    rng = random.Random(7)
    word = lambda: "".join(rng.choice(["ta", "no", "ri", "élu", "kem", "sos"]) for _ in range(rng.randint(1, 4)))
    body = lambda n: [word() for _ in range(n)]
    shared, item = body(60), body(14)
    texts = [" ".join(body(rng.randint(1, 200))) for _ in range(40)]
    near = body(120)
    for i in range(8):
        edited = list(near)
        edited[5 + 13 * i] = "changed"
        texts.append(" ".join(edited))
    texts += [" ".join([*body(30), *shared, *body(20)]) for _ in range(5)]
    texts += [" ".join([*body(9), *item, *body(9)]), " ".join(item[2:12]), "Some words. All rights reserved", "CC BY text", "released under the MIT license", "one two", "one two", "", None, "  \n ", "One\none\none\n\nOne " + "rep rep rep " * 30, "x" * 30000, " ".join(body(4000))]
    rows = [(i, t, "en", None if i % 11 == 0 else f"s{i % 3}", len(t or ""), 0.5, 1, "g") for i, t in enumerate(texts)]
    return [*rows, rows[3], rows[3]], " ".join(item)


ROWS, ITEM = make()


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, SCHEMA).repartition(3).cache()


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(r[0], int(r[0] % 2), int("changed" in (r[1] or ""))) for r in ROWS if r[0] % 4], "doc_id long, quality int, toxic int")


def test_words_and_hashes():
    import pyarrow as pa

    texts = [r[1] for r in ROWS]
    for kind, cut in ((ALNUM, alnum), (SPACED, spaced)):
        got = []
        for chunk in chunks(pa.array(texts), 1000):
            words = chunk.words(kind)
            assert all(int(h) == hash_of(words.word(i)) for i, h in enumerate(words.hashes()[:50]))
            got += [[words.word(i) for i in range(a, b)] for a, b in itertools.pairwise(words.first)]
        assert got == [cut(t) for t in texts]


def test_scoring(docs):
    rows = scoring.scores(docs).collect()
    assert len(rows) == len(ROWS)
    held = lambda i: zlib.crc32(str(i).encode()) % 7 == 2
    counts = collections.Counter(w for r in ROWS if not held(r[0]) for w in [*spaced(r[1]), None])
    n, v, texts = sum(counts.values()), len(counts), {r[0]: r[1] for r in ROWS}
    for r in rows:
        tokens = [*spaced(texts[r.doc_id]), None]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held(r.doc_id), len(tokens), sum(counts[t] > 0 for t in tokens), n)
        assert r.base_score == pytest.approx(sum(math.log10((counts[t] + 1) / (n + v + 1)) for t in tokens))
        assert r.score < 0 and (r.bits_per_byte is None) == (not texts[r.doc_id])
    assert scoring.scores(docs.limit(0)).count() == 0


def test_huffman_codes_are_a_prefix_code():
    lengths, nodes, bits = scoring.huffman(np.arange(257))
    assert sum(2.0 ** -int(x) for x in lengths) == pytest.approx(1)
    assert len({tuple(b[:x]) for b, x in zip(bits.tolist(), lengths, strict=True)}) == 257


def test_toxicity(spark, docs, labels):
    rows = toxicity.report(docs, labels).collect()
    assert len(rows) == len(ROWS) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in rows)
    assert toxicity.report(docs, labels.limit(0)).filter("predicted = 1").count() == 0
    assert toxicity.clean(docs, labels).columns == docs.columns
    assert toxicity.report(docs.limit(0), labels).count() == 0


def test_toxicity_held_out():
    rng = np.random.default_rng(0)
    data = [(np.unique(rng.integers(10, 5000, 40)), 0) for _ in range(400)] + [(np.unique(np.append(rng.integers(10, 5000, 40), 3)), 1) for _ in range(80)]
    at, w, bias = toxicity.fit(data)
    weights = dict(zip(at.tolist(), w.tolist(), strict=True))
    score = lambda x: bias + sum(weights.get(i, 0) for i in x.tolist())
    assert min(score(x) for x, y in data if y) > max(score(x) for x, y in data if not y)


def test_licenses(docs):
    rows = licenses.scan(docs).collect()
    texts = {r[0]: alnum(r[1]) for r in ROWS}
    for r in rows:
        w, places, found = texts[r.doc_id], [], set()
        for phrase, label in licenses.PHRASES.items():
            p = phrase.split()
            at = [i for i in range(len(w)) if w[i : i + len(p)] == p]
            places += at
            found |= {label} if at else set()
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == (len(w), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(found)))
        assert found <= set(r.labels.split(",")) | {""} and 0 <= r.score <= 1
    assert "mit" in {r.labels for r in rows}
    assert licenses.scan(docs.limit(0)).count() == 0


def test_licenses_of_files_with_several_notices(spark):
    """All notices in one text, every two of them, and all with a word changed where a fifth may differ."""
    notices, rng = {k: t for k, (t, _) in licenses.TEMPLATES.items()}, random.Random(2)
    texts = [(set(notices), " filler words ".join(notices.values()))]
    texts += [({a, b}, f"{notices[a]} filler words {notices[b]}") for a, b in itertools.combinations(notices, 2)]
    for _ in range(20):
        changed = []
        for t, mandatory in licenses.TEMPLATES.values():
            w = t.split()
            at = [i for i in range(len(w)) if all(m in " ".join([*w[:i], "x", *w[i + 1 :]]) for m in mandatory)]
            if at and len(w) >= 5:  # a tag or a bare name must stand as it is
                w[rng.choice(at)] = "x"
            changed.append(" ".join(w))
        texts.append((set(notices), " filler words ".join(changed)))
    df = spark.createDataFrame([(i, t) for i, (_, t) in enumerate(texts)], "doc_id long, text string")
    for r in licenses.scan(df).collect():
        assert texts[r.doc_id][0] <= set(r.labels.split(","))


@pytest.mark.parametrize(
    ("text", "gets", "not_"),
    [
        ("this work is licensed under the GNU General Public License version 2", {"gpl-2.0", "gpl"}, {"gpl-3.0", "gpl-3.0-header"}),
        ("this work is licensed under the GNU General Public License version 3", {"gpl-3.0", "gpl"}, {"gpl-2.0"}),
        ("This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.", {"gpl-3.0-header"}, {"gpl-2.0-header", "lgpl-3.0", "agpl-3.0"}),
        ("under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 2.1 of the License", {"lgpl-2.1"}, {"gpl-2.0-header", "lgpl-3.0"}),
        ("Licensed under the Apache License, Version 2.0", {"apache-2.0", "apache-2.0-name"}, set()),
        ("Apache License, Version 2.0", {"apache-2.0-name"}, set()),
        ("Licensed under the Apache License, Version 2.1", set(), {"apache-2.0", "apache-2.0-name"}),
        ("the contents of this file are subject to the Mozilla Public License version 1.1", {"mpl-1.1"}, {"mpl-2.0"}),
        ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 1.1", set(), {"mpl-2.0"}),
        ("This work is licensed under a Creative Commons Attribution 3.0 Unported License", {"cc-by-3.0"}, {"cc-by-4.0"}),
        ("Permission to use, copy, modify, and distribute this software for any purpose with or without fee is hereby granted", {"isc-first"}, {"isc", "0bsd"}),
        ("// SPDX-License-Identifier: Apache-2.0", {"tag:apache-2-0"}, {"tag:mit"}),
        ("SPDX-License-Identifier: GPL-3.0-or-later", {"tag:gpl-3-0"}, {"tag:gpl-2-0", "tag:lgpl-3-0"}),
        ("this public work is free and the software is under license version 2 of the year", set(), set(licenses.TEMPLATES)),
    ],
)
def test_names_and_versions_of_licences(spark, text, gets, not_):
    row = licenses.scan(spark.createDataFrame([(1, "some words. " + text + " and more words")], "doc_id long, text string")).first()
    got = set(row.labels.split(",")) - {""}
    assert gets <= got and not got & not_


def test_field_gradient_is_that_of_all_labellings():
    """Sums over all labellings of two short documents, step by step as the fit takes them."""
    masks, labels, rate, l2 = [np.array([1, 3, 5, 2]), np.array([4, 1])], np.array([1, 0]), 0.5, 1e-3
    weights, pairs = np.zeros(len(quality.FEATURES)), np.zeros((2, 2))
    for step in range(3):
        gained, both, total = np.zeros_like(weights), np.zeros((2, 2)), 0.0
        for m, label in zip(masks, labels, strict=True):
            x = ((m[:, None] >> np.arange(len(weights))) & 1).astype(float)
            every = list(itertools.product((0, 1), repeat=len(m)))
            score = np.array([sum((2 * y - 1) * (x[i] @ weights) / 2 for i, y in enumerate(ys)) + sum(pairs[a, b] for a, b in itertools.pairwise(ys)) for ys in every])
            chance = np.exp(score - score.max())
            chance /= chance.sum()
            content = np.array([sum(p for p, ys in zip(chance, every, strict=True) if ys[i]) for i in range(len(m))])
            gained += ((label - content)[:, None] * x).sum(0)
            for a, b in itertools.product((0, 1), repeat=2):
                found = sum(p * sum((u, v) == (a, b) for u, v in itertools.pairwise(ys)) for p, ys in zip(chance, every, strict=True))
                both[a, b] += (len(m) - 1) * (a == b == label) - found
            total += len(m)
        speed = rate * 20 / (1 + step / 20)
        weights, pairs = weights + speed * (gained / total - l2 * weights), pairs + speed * 0.1 * (both / total - l2 * pairs)
        got = quality.fit(masks, labels, steps=step + 1)
        assert np.allclose(got[0], weights) and np.allclose(got[1], pairs)


def test_field_is_fitted_on_a_bounded_sample_though_ids_repeat(spark):
    line = "Some content of a line with words."
    docs = spark.createDataFrame([(i % 3, f"{line}\n{line} {i}") for i in range(60)], "doc_id long, text string")
    labels = spark.createDataFrame([(0, 1), (1, 0), (2, 1)], "doc_id long, quality int")
    assert all(np.isfinite(x).all() for x in quality.train(docs, labels, sample=25))
    kept = {r.doc_id: (r.content_share, r.kept) for r in quality.judge(docs, quality.PRIOR, share=0.0).collect()}
    assert all(share >= 0 and not k for share, k in kept.values())  # under fifty words


def test_quality(docs, labels):
    rows, texts = quality.report(docs, labels).collect(), {r[0]: r[1] or "" for r in ROWS}
    assert len(rows) == len(ROWS)
    for r in rows:
        text = texts[r.doc_id]
        w = re.findall(r"[^\x20\x09-\x0D]+", text)
        c = collections.Counter(zip(w, w[1:], w[2:], strict=False))
        covered = {j for i in range(len(w) - 2) if c[tuple(w[i : i + 3])] > 1 for j in range(i, i + 3)}
        lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered))
        assert r.base_failed == (len(w) < 50 or 100 * len(covered) > 50 * len(w)) and not (r.kept and r.base_failed)
    assert quality.report(docs.limit(0), labels).count() == 0


def test_viterbi_against_all_labellings():
    rng = np.random.default_rng(1)
    weights, pairs = rng.normal(size=len(quality.FEATURES)), rng.normal(size=(2, 2))
    lines = np.array([0, 4, 5, 11])
    mask = rng.integers(0, 1 << len(quality.FEATURES), 11)
    got = quality.viterbi(mask, lines, weights, pairs)
    gain = quality._bits(mask) @ weights
    total = lambda own, y: sum(g * (y_ - 0.5) for g, y_ in zip(own, y, strict=True)) + sum(pairs[a, b] for a, b in itertools.pairwise(y))
    for a, b in itertools.pairwise(lines):
        best = max(itertools.product((0, 1), repeat=b - a), key=lambda y: total(gain[a:b], y))
        assert tuple(got[a:b]) == best


def test_mixing(docs):
    rows = mixing.mix(docs).collect()
    assert len(rows) == len(ROWS)
    assert sorted(map(str, rows)) == sorted(map(str, mixing.mix(docs.repartition(5)).collect()))
    by = collections.defaultdict(list)
    for r in rows:
        assert r.taken <= 2 * r.size
        by[r.source].append(r)
    total = sum(r.size for r in rows)
    assert sum(rs[0].target for rs in by.values()) == pytest.approx(1.5 * total)
    for rs in by.values():
        assert rs[0].source_size == sum(r.size for r in rs) and rs[0].target <= 2 * rs[0].source_size + 1e-6
        assert sum(r.taken for r in rs) == math.floor(rs[0].target)
    assert mixing.mix(docs.limit(0)).count() == 0


def test_warc(spark):
    pages = spark.createDataFrame([(1, "u", "<a>", 1), (2, "u", "<a>", 1), (3, None, None, 1), (4, "v", "", 1), (5, "w\nx", "é\r\n\r\nWARC/1.1", 1), (2, "u", "<a>", 1)], "page_id long, url string, html string, digest int")
    rows = {(r.page_id, r.payload_digest): r for r in warc.archive(pages).collect()}
    kind = {k[0]: (r.record_type, r.refers_to, r.payload_bytes) for k, r in rows.items()}
    assert kind == {1: ("revisit", 2, 3), 2: ("response", None, 3), 3: ("revisit", 4, 0), 4: ("response", None, 0), 5: ("response", None, 14)}
    assert next(bytes(r.payload) for r in rows.values() if r.page_id == 5) == "é\r\n\r\nWARC/1.1".encode()
    assert warc.report(pages).count() == 6 and warc.report(pages.limit(0)).count() == 0
    # archives that end after every record give the same
    rolled = warc.archive(pages, roll=1).select("page_id", "record_type", "refers_to", "payload_bytes").collect()
    assert {r.page_id: tuple(r)[1:] for r in rolled} == kind and len(rolled) == 6
    with_null = warc.report(spark.createDataFrame([(None, "u", "x"), (1, "u", "y")], "page_id long, url string, html string"))
    assert sorted((r.page_id or 0, r.record_type) for r in with_null.collect()) == [(0, "response"), (1, "response")]
    shared = warc.report(spark.createDataFrame([(None, "u", "x"), (None, "v", "x"), (1, "u", "x"), (2, "u", "x"), (None, "u", "y"), (None, "w", "y")], "page_id long, url string, html string"))
    assert sorted((r.page_id or 0, r.record_type, r.refers_to or 0) for r in shared.collect()) == [(0, "response", 0), (0, "response", 0), (0, "revisit", 2), (0, "revisit", 2), (1, "revisit", 2), (2, "response", 0)]


def test_archives_have_tasks_and_attempts_of_their_own(spark):
    listed = spark.createDataFrame([(f"/a/pages-{i:06d}-{i:08d}-000000.warc.gz",) for i in range(64)], "path string")
    sizes = warc._each_path(listed).groupBy(F.spark_partition_id()).count().collect()
    assert max(r["count"] for r in sizes) <= 2 and len(sizes) > 48
    rows = warc.classified(spark.createDataFrame([(i, "u", f"x{i}") for i in range(4)], "page_id long, url string, html string"))
    folder = shared_dir(spark, "warc")
    names = [{r.path for r in warc.write_monolithic(rows, folder).collect()} for _ in range(2)]
    assert not names[0] & names[1]


def test_compact_windows_against_brute_force():
    rng = np.random.default_rng(1)
    for _ in range(40):
        least = int(rng.integers(1, 20))
        begin = np.concatenate([[0], np.cumsum(rng.integers(0, 90, 4))])
        v = rng.integers(0, 2**63, begin[-1]).astype(np.uint64) >> np.uint64(24) << np.uint64(24)
        expected = []
        for lo, hi in itertools.pairwise(begin.tolist()):
            for c in range(lo, hi):
                left = next((i + 1 for i in range(c - 1, lo - 1, -1) if v[i] < v[c]), lo)
                right = next((i - 1 for i in range(c + 1, hi) if v[i] < v[c]), hi - 1)
                expected += [(c, left, right)] if right - left + 1 >= least else []
        assert list(zip(*(x.tolist() for x in passages.compact_windows(v, begin, least)), strict=True)) == expected


def test_passages(docs):
    rows, words = passages.report(docs).collect(), {r[0]: alnum(r[1]) for r in ROWS}
    runs = collections.defaultdict(set)
    for i, w in words.items():
        for s in range(len(w) - 49):
            runs[tuple(w[s : s + 50])].add(i)
    covered = collections.defaultdict(set)
    for r in rows:
        covered[r.doc_id] |= set(range(r.start, r.end))
        a, b = words[r.doc_id][r.start : r.end], words[r.source_id][r.source_start : r.source_end]
        x, y = ({tuple(z[i : i + 5]) for i in range(len(z) - 4)} for z in (a, b))
        assert 100 * len(x & y) >= 75 * len(x | y) and min(len(a), len(b)) >= 50
    for i, w in words.items():
        for s in range(len(w) - 49):
            if len(runs[tuple(w[s : s + 50])]) > 1:
                assert set(range(s, s + 50)) <= covered[i]
    assert passages.report(docs.limit(0)).count() == 0


def test_passages_exact_repeats_where_windows_settle_elsewhere(spark):
    """Every place of every run of 50 words that several texts hold: a text that holds a bucket's shingles twice, and a chain of repeats."""
    rng = random.Random(3)
    body = lambda n: [f"w{rng.randrange(10**9)}" for _ in range(n)]
    texts = []
    for _ in range(60):
        line = body(40)
        shared = [*body(5), *line, *body(5)]
        texts += [[*body(200), *line, *body(400), *shared, *body(200)], [*body(200), *shared, *body(200)]]
        u, v, w = body(20), body(40), body(20)
        texts += [[*body(200), *u, *v, *body(200)], [*body(200), *u, *v, *w, *body(200)], [*body(200), *v, *w, *body(200)]]
        u, v = body(60), body(20)
        texts += [[*u, *v], [*body(30), *u, *body(5), *u], [*v, *body(9), *u]]
    texts += [["again"] * 400, [*body(9), *["again"] * 300], [*texts[0], *["to", "and", "fro"] * 90], [*["to", "and", "fro"] * 40, *body(9)]]
    df = spark.createDataFrame(list(enumerate(" ".join(t) for t in texts)), "doc_id long, text string")
    runs = collections.defaultdict(set)
    for i, w in enumerate(texts):
        for s in range(len(w) - 49):
            runs[tuple(w[s : s + 50])].add(i)
    covered = collections.defaultdict(set)
    for r in passages.report(df).collect():
        a, b = texts[r.doc_id][r.start : r.end], texts[r.source_id][r.source_start : r.source_end]
        x, y = ({tuple(z[i : i + 5]) for i in range(len(z) - 4)} for z in (a, b))
        assert 100 * len(x & y) >= 75 * len(x | y) and min(len(a), len(b)) >= 50
        covered[r.doc_id] |= set(range(r.start, r.end))
    missing = [(i, s) for i, w in enumerate(texts) for s in range(len(w) - 49) if len(runs[tuple(w[s : s + 50])]) > 1 and not set(range(s, s + 50)) <= covered[i]]
    assert not missing


def test_passages_near_repeats_in_groups_of_unlike_ones(spark):
    """Recall of near passages without an equal run of 50 words: pairs that all hold one phrase, and variants of one passage, alike to it only."""
    rng = random.Random(5)
    body = lambda n: [f"w{rng.randrange(10**9)}" for _ in range(n)]
    phrase, base, passages_ = body(48), body(60), []
    for _ in range(60):
        own, i = [*body(6), *phrase, *body(6)], rng.randrange(11, 49)
        passages_ += [own, [*own[:i], "changed", *own[i + 1 :]]]
    passages_ += [base, *[[*base[:i], f"other{i}", *base[i + 1 :]] for i in range(11, 49)]]
    texts = [[*body(150), *p, *body(150)] for p in passages_]
    df = spark.createDataFrame(list(enumerate(" ".join(t) for t in texts)), "doc_id long, text string")
    sets = [{tuple(p[i : i + 5]) for i in range(56)} for p in passages_]
    like = {i for i, x in enumerate(sets) if any(i != j and 100 * len(x & y) >= 75 * len(x | y) for j, y in enumerate(sets))}
    found = {i for r in passages.report(df).collect() if r.doc_id != r.source_id and r.end > 155 and r.start < 205 for i in (r.doc_id, r.source_id)}
    assert len(like) == len(texts) and len(found & like) >= 0.95 * len(like), len(found & like) / len(like)


def test_passages_clean(docs):
    out = passages.clean(docs)
    assert out.columns == docs.columns
    left = {r.doc_id: alnum(r.text) for r in out.collect()}
    runs = collections.Counter(run for w in left.values() for run in {tuple(w[s : s + 50]) for s in range(len(w) - 49)})
    assert max(runs.values(), default=0) == 1
    assert {r[0] for r in ROWS if len(alnum(r[1])) < 50} <= set(left)


def test_decontamination(spark, docs):
    items = [(1, ITEM), (10, ITEM), (2, "one two"), (3, None), (4, "!!"), (2, "one two")]
    rows = decontaminate.contamination(docs, spark.createDataFrame(items, "item_id long, text string")).collect()
    assert len(rows) == len(ROWS)
    texts = {r[0]: alnum(r[1]) for r in ROWS}
    for r in rows:
        w, hit, found = texts[r.doc_id], set(), set()
        for i, t in items:
            own = alnum(t)
            k = min(10, len(own))
            spans = {tuple(own[s : s + k]) for s in range(len(own) - k + 1)} if k else set()
            at = [s for s in range(len(w) - k + 1) if k and tuple(w[s : s + k]) in spans]
            hit |= {j for s in at for j in range(s, s + k)}
            found |= {str(i)} if at else set()
        assert (r.n_words, r.n_hit, r.items) == (len(w), len(hit), sorted(found))
    clean = decontaminate.clean(docs, spark.createDataFrame(items, "item_id long, text string"))
    assert clean.columns == docs.columns and {r.doc_id for r in clean.collect()} == {r.doc_id for r in rows if not r.n_hit}
    assert decontaminate.report(docs, spark.createDataFrame([], "item_id long, text string")).filter("contaminated").count() == 0


def test_chat(spark):
    turns = [(1, 0, "user", "hi"), (2, 0, "user", "hi"), (2, 1, "bot", "yes"), (3, 0, "user", "hi"), (3, 5, "bot", "yes"), (4, 0, "user", "hi"), (4, 1, "bot", "no"), (4, 1, "bot", "no"), (5, 0, None, None), (None, 0, "user", "x"), (6, None, "user", "x")]
    df = spark.createDataFrame([(*t, "extra") for t in turns], "conv_id long, turn long, role string, text string, at string")
    for part in (1024, 1):
        rows = collections.defaultdict(list)
        for r in chat.collapse(df, part).collect():
            rows[r.conv_id, r.n_turns, r.n_copies].append((r.part, r.text))
        got = {k: "".join(t for _, t in sorted(v)) for k, v in rows.items()}
        assert got == {(2, 2, 2): "<|user|>\nhi<|end|>\n<|bot|>\nyes<|end|>\n", (4, 2, 1): "<|user|>\nhi<|end|>\n<|bot|>\nno<|end|>\n", (5, 1, 1): "<||>\n<|end|>\n"}
    assert chat.collapse(df.limit(0)).count() == 0


def test_jaccard(docs):
    rows = jaccard.clusters(docs).collect()
    sets = {}
    for r in ROWS:
        w = spaced(r[1])
        sets[r[0]] = {tuple(w[i : i + 5]) for i in range(len(w) - 4)} or ({tuple(w)} if w else set())
    root = {i: i for i in sets}
    for _ in sets:
        for a, b in itertools.combinations(sorted(sets), 2):
            if sets[a] and root[a] != root[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                low, high = sorted((root[a], root[b]))
                root = {k: low if v == high else v for k, v in root.items()}
        break
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in rows) == sorted((r[0], len(sets[r[0]]), root[r[0]]) for r in ROWS)
    assert max(collections.Counter(root.values()).values()) >= 8
    kept = jaccard.clean(docs)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == sorted(set(root.values()))
    assert jaccard.clusters(docs.limit(0)).count() == 0


def test_pipeline(spark):
    import corpus_pipeline

    folder = "/root/testdata/sf0.001"
    out = corpus_pipeline.run(spark, folder)
    assert out.count() > 50 and len(corpus_pipeline.STAGES) == 5
    assert set(registry.ORACLE_SQL) <= set(registry.QUERIES)


def test_alike_sorts_the_shingles_of_a_pair_once(monkeypatch):
    """However many passages two texts share, their shingles are sorted once; likeness is as counted with Python's sets."""
    import numpy as np

    from fieldmart.llm import passages

    rng, calls, unique = np.random.default_rng(6), [], np.unique
    fresh = lambda n: rng.integers(0, 1 << 62, n)
    parts = [fresh(60) for _ in range(4)]
    a = np.concatenate([x for p in parts for x in (p, fresh(90))])
    b = np.concatenate([x for p in parts[::-1] for x in (fresh(70), p)])
    monkeypatch.setattr(np, "unique", lambda *x, **y: calls.append(1) or unique(*x, **y))
    found = passages.alike(a, b, 46)
    assert len(calls) == 1 and len(found) == 4
    for a0, a1, b0, b1 in found:
        x, y = set(a[a0:a1].tolist()), set(b[b0:b1].tolist())
        assert 100 * len(x & y) >= 75 * len(x | y)


def test_packed_rows_meet_as_plain_ones():
    """Rows packed by part and unpacked again: those of buckets that several texts have, each once, with their bucket's least."""
    import pyarrow as pa

    from fieldmart.llm import passages

    rng, parts = np.random.default_rng(7), 5
    keys = rng.integers(-9, 9, (40, 2)) * 3
    owner = rng.integers(0, 40, 3000)
    bucket = passages.mixed(rng.integers(0, 900, 3000).astype(np.uint64))
    at = rng.integers(0, 3, 3000)
    ints = np.stack([at, at * 300 + 1, at + 70000], 1)
    blocks = [passages._blocks(parts, keys, bucket[s], owner[s], ints[s]) for s in (slice(0, 1700), slice(1700, 3000))]
    plain = collections.defaultdict(set)
    for b, k, x in zip(bucket.view(np.int64).tolist(), keys[owner].tolist(), ints.tolist(), strict=True):
        plain[b].add((*k, *x))
    expected = {(b, *x, *min(xs)) for b, xs in plain.items() if len({x[:2] for x in xs}) > 1 for x in xs}
    got = []
    for part in range(parts):
        mine = [b.filter(pa.compute.equal(b.column("part"), part)) for b in blocks]
        rows, least = passages._met_again(iter(mine), 3)
        got += list(zip(*rows.tolist(), *rows[1:, least].tolist(), strict=True))
    assert len(got) == len(set(got)) and set(got) == expected
    rows, least = passages._met_again(iter([b.slice(0, 0) for b in blocks]), 3)
    assert rows.shape == (6, 0) and not len(least)


def test_passages_unpack_only_what_meets(spark):
    """The windows of texts are made in one stage, and unlike texts give no row beyond their blocks."""
    from fieldmart.llm import passages

    rng = random.Random(8)
    texts = [" ".join(f"w{rng.randrange(10**9)}" for _ in range(300)) for _ in range(20)]
    df = spark.createDataFrame(list(enumerate([*texts, texts[0] + " more"])), "doc_id long, text string")
    got = passages.shared_windows(passages._texts(df), 46)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 2 and plan.count("Exchange") == 1
    assert {tuple(r.c) for r in got.collect()} == {tuple(r) for r in passages._texts(df).filter("doc_id in (0, 20)").select("k1", "k2").collect()}

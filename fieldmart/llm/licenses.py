"""Licence scans with a positional index of rare words.

Templates are indexed by word: every word of a licence notice has postings (template, position). Of the licence words
that a file holds, the ones rarest in the corpus are looked up, and the rarest of each template, so many that a notice
can't stand in the file without enough of them; postings that agree on the position of the notice's
beginning vote for it; a place with enough votes is compared word by word, and its mandatory phrases must stand there.
Fixed phrases are found everywhere and give labels of their own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .text import ALNUM, chunks, hash_of

#: Phrases that give a label wherever their words stand one after the other.
PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}
#: Notices in their public wording, and the phrases that must be there. Names and versions are mandatory: notices of two versions differ in little else.
TEMPLATES = {
    "0bsd": ("permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted the software is provided as is", ("permission to use copy modify", "granted the software is provided")),
    "agpl-3.0": ("under the terms of the gnu affero general public license as published by the free software foundation either version 3 of the license", ("gnu affero general public license", "version 3 of the license")),
    "apache-2.0": ("licensed under the apache license version 2 0", ("apache license version 2 0",)),
    "apache-2.0-name": ("apache license version 2 0", ("apache license version 2 0",)),
    "bsd": ("redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met", ("redistribution and use", "conditions are met")),
    "cc-by-3.0": ("this work is licensed under a creative commons attribution 3 0 unported license", ("creative commons attribution 3 0",)),
    "cc-by-4.0": ("this work is licensed under a creative commons attribution 4 0 international license", ("creative commons attribution 4 0",)),
    "cc-by-sa-4.0": ("this work is licensed under a creative commons attribution sharealike 4 0 international license", ("creative commons attribution sharealike 4 0",)),
    "cc0-1.0": ("to the extent possible under law the author has dedicated all copyright and related and neighboring rights to this software to the public domain worldwide", ("dedicated all copyright", "public domain worldwide")),
    "epl-2.0": ("made available under the terms of the eclipse public license 2 0", ("eclipse public license 2 0",)),
    "gpl-2.0": ("this work is licensed under the gnu general public license version 2", ("gnu general public license version 2",)),
    "gpl-2.0-header": ("under the terms of the gnu general public license as published by the free software foundation either version 2 of the license", ("gnu general public license", "version 2 of the license")),
    "gpl-3.0": ("this work is licensed under the gnu general public license version 3", ("gnu general public license version 3",)),
    "gpl-3.0-header": ("under the terms of the gnu general public license as published by the free software foundation either version 3 of the license", ("gnu general public license", "version 3 of the license")),
    "isc": ("permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", ("permission to use copy modify and or distribute", "with or without fee")),
    "isc-first": ("permission to use copy modify and distribute this software for any purpose with or without fee is hereby granted", ("permission to use copy modify and distribute", "with or without fee")),
    "lgpl-2.1": ("under the terms of the gnu lesser general public license as published by the free software foundation either version 2 1 of the license", ("gnu lesser general public license", "version 2 1 of the license")),
    "lgpl-3.0": ("under the terms of the gnu lesser general public license as published by the free software foundation either version 3 of the license", ("gnu lesser general public license", "version 3 of the license")),
    "mit": ("released under the mit license", ("the mit license",)),
    "mit-grant": ("permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files", ("permission is hereby granted", "free of charge")),
    "mpl-1.1": ("the contents of this file are subject to the mozilla public license version 1 1", ("mozilla public license version 1 1",)),
    "mpl-2.0": ("this source code form is subject to the terms of the mozilla public license v 2 0", ("mozilla public license v 2 0",)),
    "unlicense": ("this is free and unencumbered software released into the public domain", ("free and unencumbered software",)),
}
#: Identifiers of a tag in a file's head, in words; the tag must stand as it is.
TAGS = ("0bsd", "agpl 3 0", "apache 2 0", "bsd 2 clause", "bsd 3 clause", "cc by 4 0", "cc0 1 0", "epl 2 0", "gpl 2 0", "gpl 3 0", "isc", "lgpl 2 1", "lgpl 3 0", "mit", "mpl 1 1", "mpl 2 0", "unlicense")
TEMPLATES |= {f"tag:{t.replace(' ', '-')}": (f"spdx license identifier {t}", (f"spdx license identifier {t}",)) for t in TAGS}
#: How many of a file's rarest licence words are looked up, votes that a place needs, share of words that must agree.
RAREST, VOTES, SHARE = 6, 2, 0.8


def _vocabulary() -> list[str]:
    return sorted({w for text, _ in TEMPLATES.values() for w in text.split()} | {w for p in PHRASES for w in p.split()})


def _lookup(hashes: np.ndarray, known: np.ndarray, order: np.ndarray, small: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of known words and their numbers. small: which values the low bits of known hashes have."""
    maybe = np.flatnonzero(small[(hashes & np.uint64(0xFFFF)).astype(np.int64)])
    at = np.minimum(np.searchsorted(known, hashes[maybe]), len(known) - 1)
    hit = known[at] == hashes[maybe]
    return maybe[hit], order[at[hit]]


def _index() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    hashes = np.array([hash_of(w) for w in _vocabulary()], np.uint64)
    order = np.argsort(hashes)
    small = np.zeros(1 << 16, bool)
    small[(hashes & np.uint64(0xFFFF)).astype(np.int64)] = True
    return hashes[order], order, small


def frequencies(docs: DataFrame) -> dict[str, int]:
    """How many documents hold each word of the licence vocabulary; all documents count, and "" has their number."""
    names = _vocabulary()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, total, n = _index(), np.zeros(len(names), np.int64), 0
        for batch in batches:
            n += batch.num_rows
            for chunk in chunks(batch.column("text")):
                words = chunk.words(ALNUM)
                at, which = _lookup(words.hashes(), *index)
                pairs = np.unique(words.docs()[at] * len(names) + which)
                total += np.bincount(pairs % len(names), minlength=len(names))
        yield pa.record_batch([pa.array([*names, ""]), pa.array([*total, n], pa.int64())], ["word", "n"])

    # one row for each word of the templates
    rows = docs.select(F.col("text").cast("string").alias("text")).mapInArrow(count, "word string, n long")
    return {r.word: r.n for r in rows.groupBy("word").agg(F.sum("n").alias("n")).collect()}


class Scanner:
    """Finds phrases and notices in the numbered licence words of one document."""

    def __init__(self, found_in: dict[str, int]):
        names = _vocabulary()
        number = {w: i for i, w in enumerate(names)}
        self.rarity = np.argsort(np.argsort([found_in.get(w, 0) for w in names], kind="stable"), kind="stable")
        self.templates = {name: [number[w] for w in text.split()] for name, (text, _) in TEMPLATES.items()}
        self.mandatory = {name: [[number[w] for w in p.split()] for p in phrases] for name, (_, phrases) in TEMPLATES.items()}
        self.postings: dict[int, list[tuple[str, int]]] = {}
        for name, ids in self.templates.items():
            for place, i in enumerate(ids):
                self.postings.setdefault(i, []).append((name, place))
        #: Postings of each template's rarest words: more places, by VOTES, than may differ.
        self.always: dict[int, list[tuple[str, int]]] = {}
        for name, ids in self.templates.items():
            covered, enough = 0, len(ids) - int(np.ceil(SHARE * len(ids) - 1e-9)) + VOTES
            for i in sorted(set(ids), key=lambda i: self.rarity[i]):
                if covered < enough:
                    self.always.setdefault(i, []).extend((name, place) for place, j in enumerate(ids) if j == i)
                    covered += ids.count(i)
        self.phrases = {tuple(number[w] for w in p.split()): label for p, label in PHRASES.items()}

    def notices(self, at: np.ndarray, which: np.ndarray) -> tuple[set[str], float]:
        """Labels of verified notices, and the largest share of a notice's words that agree at one place."""
        present = np.unique(which)
        rare = set(present[np.argsort(self.rarity[present])][:RAREST].tolist())
        votes: dict[tuple[str, int], int] = {}
        chosen = np.flatnonzero(np.isin(which, [*rare, *self.always]))
        for p, i in zip(at[chosen].tolist(), which[chosen].tolist(), strict=True):
            for name, place in self.postings[i] if i in rare and i in self.postings else self.always.get(i, ()):
                votes[name, p - place] = votes.get((name, p - place), 0) + 1
        places = [k for k, v in votes.items() if v >= VOTES]
        if not places:
            return set(), 0.0
        here, labels, best = dict(zip(at.tolist(), which.tolist(), strict=True)), set(), 0.0
        for name, begin in places:
            ids = self.templates[name]
            share = sum(here.get(begin + j) == i for j, i in enumerate(ids)) / len(ids)
            best = max(best, share)
            span = [here.get(begin + j) for j in range(len(ids))]
            if share >= SHARE and all(any(span[j : j + len(m)] == m for j in range(len(span))) for m in self.mandatory[name]):
                labels.add(name)
        return labels, best


SCHEMA = "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double"


def scan(docs: DataFrame) -> DataFrame:
    """One row for each row of docs, see SCHEMA. Words count from 0; score is 1 where a fixed phrase stands, else the
    largest share of a notice's words found in place. Null, empty and wordless texts have no places, labels '' and score 0.
    Repeated rows and ids are scanned each by its own text; of places and rarities that tie all count; an empty table gives no
    rows; further columns are ignored.
    """
    found_in = frequencies(docs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, scanner = _index(), Scanner(found_in)
        for batch in batches:
            for chunk in chunks(batch.column("text")):
                words = chunk.words(ALNUM)
                n = chunk.hi - chunk.lo
                at, which = _lookup(words.hashes(), *index)
                number = np.full(len(words.start) + 8, -1)
                number[at] = which
                # a phrase is in one document if its first and last word are
                owner = np.concatenate([words.docs(), np.full(8, -1)])
                places, labels = [], [set() for _ in range(n)]
                for ids, label in scanner.phrases.items():
                    begin = at[which == ids[0]]
                    for j, i in enumerate(ids):
                        begin = begin[(number[begin + j] == i) & (owner[begin + j] == owner[begin])]
                    places.append(begin)
                    for d in np.unique(owner[begin]).tolist():
                        labels[d].add(label)
                begins = np.sort(np.concatenate(places))
                base = [",".join(sorted(x)) for x in labels]
                bounds = np.searchsorted(begins, words.first)
                first = [int(begins[a] - words.first[d]) if b > a else None for d, (a, b) in enumerate(zip(bounds[:-1], bounds[1:], strict=True))]
                last = [int(begins[b - 1] - words.first[d]) if b > a else None for d, (a, b) in enumerate(zip(bounds[:-1], bounds[1:], strict=True))]
                score = np.array([1.0 if x else 0.0 for x in labels])
                own = np.searchsorted(at, words.first)
                for d in np.flatnonzero(np.diff(own) >= VOTES).tolist():
                    more, share = scanner.notices(at[own[d] : own[d + 1]], which[own[d] : own[d + 1]])
                    labels[d] |= more
                    score[d] = max(score[d], share)
                yield pa.record_batch(
                    [batch.column("doc_id").slice(chunk.lo, n), pa.array(words.counts, pa.int64()), pa.array(np.diff(bounds), pa.int64()), pa.array(first, pa.int64()), pa.array(last, pa.int64()), pa.array(base), pa.array([",".join(sorted(x)) for x in labels]), pa.array(score)],
                    ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"],
                )

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, SCHEMA)

"""The mixed model against a coder that goes bit by bit, and what a probability has to be."""

import math
import random

import numpy as np
import pyarrow as pa
import pytest

from fieldmart.llm import scoring
from fieldmart.llm.text import SPACED, chunks

U32 = (1 << 32) - 1


def fill(texts):
    counts = np.bincount(np.frombuffer("".join(texts).lower().encode(), np.uint8), minlength=257)
    counts[scoring.END] = len(texts)
    coder, seen = scoring.Coder(counts), np.zeros(2 * scoring.SLOTS, np.int32)
    for chunk in chunks(pa.array(texts)):
        scoring.count_bits(coder, scoring.pieces(chunk.words(SPACED)), seen)
    return coder, scoring.logits(seen[::2], seen[1::2]), seen


def costs(coder, table, texts):
    return np.concatenate([scoring.text_costs(coder, table, scoring.pieces(c.words(SPACED)), c.hi - c.lo) for c in chunks(pa.array(texts))])


def one_by_one(coder, table, text, bits=None):
    """Cost of a text in nats: every bit with the weights that all earlier stretches have left. bits gets each one's."""
    bits = [] if bits is None else bits
    cells = {}
    pending, bounds, done, stretch = [], scoring.stretches(1 << 20), 0, 0
    one = scoring.pieces(next(iter(chunks(pa.array([text])))).words(SPACED))
    coded, before = coder.coded(one), scoring._before(one)
    for j, w in enumerate(one.which.tolist()):
        now = int(np.searchsorted(bounds, done, "right")) - 1
        if now != stretch:
            moved = {}
            for cell, x, error in pending:
                g, n = moved.setdefault(cell, [np.zeros(3), 0])
                moved[cell] = [g + error * x, n + 1]
            for cell, (g, n) in moved.items():
                weights, seen = cells[cell]
                seen += scoring.CURVATURE * n
                cells[cell] = [weights + g / seen, seen]
            pending, stretch = [], now
        for part in range(coded.part[w], coded.part[w + 1]):
            cell = None
            for bit in range(coded.part_first[part], coded.part_first[part + 1]):
                slots = [int(s[bit]) for s in coded.slots] + [int(scoring._third(coded.key[bit : bit + 1], before[j : j + 1])[0])]
                x = np.array([float(table[s]) for s in slots]) * scoring.LOGIT
                if cell is None:
                    cell = (int(coded.depth[part]), int(x[1] != 0) + 2 * int(x[2] != 0))
                    cells.setdefault(cell, [np.array(scoring.FIRST[cell[1]]), scoring.FIRM])
                z = min(14.0, max(-14.0, float(cells[cell][0] @ x)))
                p = 1 / (1 + math.exp(-z))
                y = int(coded.bit[bit])
                bits.append(-math.log(p if y else 1 - p))
                pending.append((cell, x, y - p))
                done += 1
    return sum(bits)


TRAIN = ["the cat sat on the mat", "the dog sat on the log\n\nand the cat ran", "A word, another word.", "", "  spaced   out "] * 3


def test_costs_equal_those_of_a_coder_bit_by_bit():
    coder, table, _ = fill(TRAIN)
    rng = random.Random(1)
    texts = [*TRAIN[:5], "unseen words ~ é", " ".join(rng.choice(["the", "cat", "sat", "zebra", "log\n"]) for _ in range(400))]
    for got, text in zip(costs(coder, table, texts), texts, strict=True):
        assert got == pytest.approx(one_by_one(coder, table, text), rel=1e-4)


def test_a_text_costs_the_same_alone_and_among_others():
    coder, table, _ = fill(TRAIN)
    texts = ["the cat", "the dog sat on the mat " * 50, "", "log"]
    assert np.allclose(costs(coder, table, texts), [costs(coder, table, [t])[0] for t in texts], rtol=1e-5)


def test_probabilities_of_what_may_follow_sum_to_one():
    coder, table, _ = fill(["ab", "ba", "a b", "b", "abba ab"] * 40)
    for prefix in ("", "a", "ab ", "ab abb"):
        before = sum(int(coder.lengths[b]) for b in prefix.encode())
        total = 0.0
        for after in [bytes([b]) for b in range(128) if not 0x41 <= b <= 0x5A] + [b""]:
            bits = []
            one_by_one(coder, table, prefix + after.decode(), bits)
            total += math.exp(-sum(bits[before : before + int(coder.lengths[after[0] if after else scoring.END])]))
        # what is missing went to bytes that no text has alone: parts of longer characters, A-Z
        assert 0.9 < total <= 1 + 1e-9


def test_an_unseen_random_word_pays_for_its_letters():
    rng = random.Random(2)
    coder, table, _ = fill([" ".join(rng.choice(["alpha", "beta", "gamma", "0a1b2c", "9f8e7d", "345678"]) for _ in range(300)) for _ in range(20)])
    junk = "".join(rng.choice("0123456789abcdef") for _ in range(2000))
    assert costs(coder, table, [junk])[0] / math.log(2) > 4 * 2000
    known = " ".join(["alpha beta gamma"] * 100)
    assert costs(coder, table, [known])[0] / math.log(2) / len(known) < 1


def test_weights_are_refined_within_a_text():
    """What comes again and again in one text gets cheaper than its first part, though the tables stay as they are."""
    rng = random.Random(3)
    coder, table, _ = fill([" ".join(rng.choice(["alpha", "beta", "gamma", "delta"]) for _ in range(200)) for _ in range(10)])
    part = " ".join("alpha" for _ in range(100)) + " "
    once, many = costs(coder, table, [part, part * 20])
    assert many < 19 * once

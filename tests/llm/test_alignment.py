"""Token alignment against loops over bytes, with the vocabularies' own libraries."""

import hashlib
from collections import Counter

import pytest

public_tokenizers = pytest.importorskip("public_tokenizers")

from fieldmart.llm import alignment  # noqa: E402

TEXTS = ["Hello world, it's 12 o'clock.\n\n  twice  ", None, "", "a", " ", "naïve café — ünïcödé 漢字仮名 🙂🙂", "it holds ▁ itself", "<|endoftext|> and <s> </s> <0x0A>", "\t\ttabs\r\nand\x00nul", "Hello world, it's 12 o'clock.\n\n  twice  ", "x" * 3000, "one two three " * 400, "'ll 've don't  nbsp em"]


def plain(texts):
    """The report by plain loops; A by its own file and library."""
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    alphabet = alignment.byte_alphabet()
    rows, total = [], Counter()
    for text in texts:
        want = (" " + text).encode() if text else b""
        sides = []
        if text:
            e = a.encode(" " + text, add_special_tokens=False)
            sides.append([(i, bytes(alphabet[c] for c in t)) for i, t in zip(e.ids, e.tokens)])
            sides.append([(i, bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode()) for i in b.encode(text)])
        if not text or any(b"".join(t for _, t in s) != want for s in sides):
            rows.append((0, 0, 0, [], ""))
            continue
        ends = []
        for s in sides:
            at, out = 0, []
            for i, t in s:
                at += len(t)
                out.append((at, i))
            ends.append(out)
        links = [(i, j) for p, i in ends[0] for q, j in ends[1] if p == q] if len(text) < 2000 else [(i, dict(ends[1])[p]) for p, i in ends[0] if p in dict(ends[1])]
        cuts = sorted({p for p, _ in ends[0]} & {p for p, _ in ends[1]})
        groups = [[[str(i) for p, i in s if low < p <= high] for s in ends] for low, high in zip([0, *cuts[:-1]], cuts)]
        rows.append((len(ends[0]), len(ends[1]), len(cuts), links, hashlib.sha256(";".join("|".join(",".join(x) for x in g) for g in groups).encode()).hexdigest()))
        total.update(links)
    best = Counter()
    for (_, j), n in total.items():
        best[j] = max(best[j], n)
    return [(na, nb, g, len(links), sum(total[x] == best[x[1]] for x in links), sum(total[x] for x in links), sha) for na, nb, g, links, sha in rows]


@pytest.mark.parametrize("top", [alignment.TOP, 7, 0])
def test_report_equals_plain_loops(spark, top):
    """With all pairs looked up, with most joined, and with all joined."""
    df = spark.createDataFrame([(i if i != 4 else None, t, "x", 5) for i, t in enumerate(TEXTS)], "doc_id long, text string, row string, pair int")
    got = alignment.report(df.repartition(3), top=top).collect()
    assert got[0].__fields__ == list(alignment.REPORT)
    key = lambda r: tuple(-1 if x is None else x for x in r)
    assert sorted(map(key, got)) == sorted(key((i if i != 4 else None, *r)) for i, r in enumerate(plain(TEXTS)))


def test_empty_table(spark):
    assert alignment.report(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_overlaps_are_all_pairs_that_share_a_byte():
    va, vb = alignment._loaded(public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))
    x = alignment.align([t for t in TEXTS if t is None or len(t) < 200], va, vb)
    ia, ib = alignment.overlaps(x.a, x.b)
    plain_pairs = {(i, j) for i in range(len(x.a.ids)) for j in range(len(x.b.ids)) if max(x.a.start[i], x.b.start[j]) < min(x.a.end[i], x.b.end[j])}
    assert len(ia) == len(plain_pairs) and set(zip(ia.tolist(), ib.tolist())) == plain_pairs

"""Benchmark decontamination by winnowing, in DataFrame functions only.

Both sides keep, of every window of ``window`` consecutive words, the k-gram with the least hash. Two texts that share
a whole window keep the same k-gram of it, so that a join on the kept hashes misses no shared window. The hits are
then extended word by word against the item's own words, which also removes collisions of hashes. Only the texts that
have hits are shuffled for that.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import alnum_words, documents_only, maybe_in, stored

WINDOW = 10
KGRAM = 5
#: A fingerprint is one long: 40 bits of hash above 24 bits of position. Later positions of longer texts wrap around
#: and are all tried when hits are extended.
POSITION_BITS = 24
POSITIONS = 1 << POSITION_BITS


def _span(last: Column) -> Column:
    """0..last, empty below 0."""
    return F.when(last >= 0, F.sequence(F.lit(0), last)).otherwise(F.array().cast("array<int>"))


def with_fingerprints(df: DataFrame, window: int, k: int) -> DataFrame:
    """Adds ``kept``, the winnowed fingerprints of the column ``words``: the least of each window, leftmost if equal."""
    gram = lambda i: F.shiftleft(F.xxhash64(F.slice("words", i + 1, k)), POSITION_BITS).bitwiseOR((i % POSITIONS).cast("long"))
    df = df.withColumn("grams", F.transform(_span(F.size("words") - k), gram))
    width = window - k + 1
    if width == 1:
        return df.withColumnRenamed("grams", "kept")
    least = F.transform(_span(F.size("grams") - width), lambda i: F.array_min(F.slice("grams", i + 1, width)))
    return df.withColumn("kept", F.array_distinct(least)).drop("grams")


def item_postings(benchmark: DataFrame, window: int = WINDOW, k: int = KGRAM) -> DataFrame:
    """Kept fingerprints of the items: k, hash, item_id, context (the words that a window around it can reach), at, width.

    An item with fewer words than a window is one window and one k-gram of its own length.
    """
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), alnum_words(F.col("text").cast("string")).alias("words"))
    items = items.filter(F.size("words") > 0).distinct()
    full = with_fingerprints(items, window, k).withColumn("print", F.explode_outer("kept")).filter("print is not null")
    at = F.col("print").bitwiseAND(F.lit(POSITIONS - 1)).cast("int")
    begin = F.greatest(at - (window - k), F.lit(0))
    full = full.select(
        F.lit(k).alias("k"), F.shiftright("print", POSITION_BITS).alias("hash"), "item_id",
        F.slice("words", begin + 1, at - begin + window).alias("context"), (at - begin).alias("at"), F.lit(window).alias("width"),
    )
    n = F.size("words")
    whole = F.shiftright(F.shiftleft(F.xxhash64(F.slice("words", 1, n)), POSITION_BITS), POSITION_BITS)
    short = items.filter(n < window).select(n.alias("k"), whole.alias("hash"), "item_id", F.col("words").alias("context"), F.lit(0).alias("at"), n.alias("width"))
    return full.unionByName(short)


#: Stands in the list of a document's fingerprints for the document itself.
DOCUMENT = -(1 << 63)


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, k: int = KGRAM) -> DataFrame:
    """One row for each row of docs: doc_id, text_key, n_words, n_hit, n_items, items (sorted as strings).

    Null or empty texts and texts without words have no hits. Rows that repeat a doc_id are judged by their own text.
    Items with the same id count once; items with no words count never, and neither does an item's null id among the
    items. An empty benchmark contaminates nothing; an empty docs table gives no rows. Further columns of docs are ignored.
    """
    postings = stored(item_postings(benchmark, window, k), "postings")
    # at most window lengths; the benchmark alone is read
    kinds = [(window, k)] + [(r.k, r.k) for r in postings.filter(F.col("width") < window).select("k").distinct().collect()]
    base = documents_only(docs).select("doc_id", "text", F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_key"))
    position = F.col("print").bitwiseAND(F.lit(POSITIONS - 1)).cast("int")
    candidate = F.when(F.col("item").isNotNull(), F.struct(position.alias("position"), *[F.col(f"item.{x}").alias(x) for x in ("item_id", "context", "at", "width")]))
    found = None
    for width, size in kinds:
        prints = with_fingerprints(base.withColumn("words", alnum_words(F.col("text"))).drop("text"), width, size)
        n_words = F.size("words").cast("long").alias("n_words")
        # the first kind brings a row for the document itself; the outer form, as the filter that Spark infers from a plain explode would be pushed below and repeat all the work
        every = F.concat(F.array(F.lit(DOCUMENT).cast("long")), "kept") if found is None else F.col("kept")
        prints = prints.select("doc_id", "text_key", n_words, F.explode_outer(every).alias("print")).filter("print is not null")
        # no fingerprint's hash is that of a document, and documents are spread
        nobody = F.xxhash64("doc_id", "text_key").bitwiseOR(F.lit(1 << 62)).bitwiseAND(F.lit((1 << 63) - 1))
        prints = prints.withColumn("hash", F.when(F.col("print") == DOCUMENT, nobody).otherwise(F.shiftright("print", POSITION_BITS)))
        items = postings.filter((F.col("k") == size) & (F.col("width") == width)).select("hash", F.struct("item_id", "context", "at", "width").alias("item"))
        met = prints.join(items, "hash", "left").filter((F.col("print") == DOCUMENT) | F.col("item").isNotNull())
        met = met.select("doc_id", "text_key", "n_words", (F.col("print") == DOCUMENT).cast("long").alias("rows"), F.when(F.col("print") != DOCUMENT, candidate).alias("c"))
        found = met if found is None else found.unionByName(met)
    by_doc = found.groupBy("doc_id", "text_key").agg(F.max("n_words").alias("n_words"), F.sum("rows").alias("rows"), F.collect_set("c").alias("candidates"))
    by_doc = stored(by_doc, "found")
    hit = by_doc.filter(F.size("candidates") > 0)
    # a text in several documents is extended for each of them: they meet by text and id
    texts = maybe_in(base, "text_key", hit.select("text_key")).dropDuplicates(["doc_id", "text_key"])
    joined = hit.select(F.col("doc_id").alias("c_id"), F.col("text_key").alias("c_key"), "candidates").join(texts, F.col("doc_id").eqNullSafe(F.col("c_id")) & (F.col("text_key") == F.col("c_key")))
    joined = joined.select("doc_id", "text_key", "candidates", alnum_words(F.col("text")).alias("words"))

    def extended(c: Column) -> Column:
        begins = F.transform(F.sequence(c["position"], F.greatest(F.size("words") - 1, c["position"]), F.lit(POSITIONS)), lambda p: p - c["at"])
        same = lambda b, u: (b + u >= 0) & (F.slice("words", F.greatest(b + u, F.lit(0)) + 1, c["width"]) == F.slice(c["context"], u + 1, c["width"]))
        tried = F.transform(begins, lambda b: F.transform(F.filter(_span(F.size(c["context"]) - c["width"]), lambda u: same(b, u)), lambda u: b + u))
        return F.transform(F.flatten(tried), lambda s: F.struct(s.alias("start"), (s + c["width"]).alias("end"), c["item_id"].alias("item_id")))

    joined = joined.select(F.col("doc_id").alias("c_id"), F.col("text_key").alias("c_key"), F.flatten(F.transform("candidates", extended)).alias("hits"))
    spans = F.array_sort(F.array_distinct(F.transform("hits", lambda h: F.struct(h["start"].alias("start"), h["end"].alias("end")))))
    step = lambda acc, s: F.struct(F.greatest(acc["end"], s["end"]).alias("end"), (acc["n"] + F.greatest(s["end"] - F.greatest(s["start"], acc["end"]), F.lit(0))).alias("n"))
    n_hit = F.aggregate(spans, F.struct(F.lit(0).alias("end"), F.lit(0).alias("n")), step, lambda acc: acc["n"].cast("long"))
    items = F.array_sort(F.array_distinct(F.transform("hits", lambda h: h["item_id"].cast("string"))))
    joined = joined.select("c_id", "c_key", n_hit.alias("n_hit"), F.filter(items, lambda x: x.isNotNull()).alias("items"))
    out = by_doc.drop("candidates").join(joined, F.col("doc_id").eqNullSafe(F.col("c_id")) & (F.col("text_key") == F.col("c_key")), "left")
    items = F.coalesce("items", F.array().cast("array<string>"))
    out = out.select("doc_id", "text_key", "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"), F.size(items).cast("long").alias("n_items"), items.alias("items"), "rows")
    # one row again for each row of docs
    return out.withColumn("_", F.explode_outer(F.sequence(F.lit(1), F.col("rows")))).drop("_", "rows")


def report(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The digest of ``contamination`` that op8 returns."""
    found = contamination(docs, benchmark)
    digest = F.sha2(F.array_join("items", ","), 256)
    return found.select("doc_id", "n_words", "n_hit", "n_items", digest.alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """docs without the documents that hold a window of any item; all columns stay, whatever their names.

    Rows go by id and text, so that of a repeated id only the texts that hold a window go. Null and empty texts stay.
    """
    dirty = contamination(docs, benchmark).filter("n_hit > 0").select(F.col("doc_id").alias("id"), F.col("text_key").alias("key")).distinct()
    keyed = docs.select(F.struct(*docs.columns).alias("row"), docs["doc_id"].cast("long").alias("doc_id"), F.xxhash64(F.coalesce(docs["text"].cast("string"), F.lit(""))).alias("text_key"))
    return keyed.join(dirty, F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("text_key") == F.col("key")), "left_anti").select("row.*")

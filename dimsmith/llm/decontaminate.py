"""Benchmark passages in documents: SimHash of item-sized windows, a multi-index, exact confirmation.

Texts are lower-case words (runs of letters and digits). An item of n words is looked for in
windows of n words. A window can be similar to an item only where it shares shingles with one, so
windows are laid where a document's shingle meets a benchmark shingle: at the place the item would
start, if enough shingles agree on that place (``support``). Equal windows are then one row.

Each window and item has a 64-bit SimHash of its words, cut into ``BLOCKS`` blocks. Fingerprints
within ``RADIUS`` bits differ in some block by at most ``RADIUS // BLOCKS`` = 3 bits; windows are
posted under all block values that differ in at most one bit and items in at most two, so every
pair within the radius meets. Pairs that meet and lie within the radius are confirmed by weighted
Jaccard similarity over shingles of ``SHINGLE`` words (sum of least counts by sum of greatest).

Only built-in expressions. The benchmark's shingles are broadcast up to ``BROADCAST`` rows, else
joined by a shuffle. Null and empty texts contain nothing. An item of fewer than five words is one
shingle; items without words are never found. Repeated rows and items count once each by their id.
"""

from __future__ import annotations

from collections.abc import Callable
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dimsmith.llm.common import narrowed, once

SHINGLE = 5
LEAST = 0.8
BITS, BLOCKS, RADIUS = 64, 4, 15
#: Benchmark shingles (a hash, a length and an offset: under 64 bytes each) that go to every executor at once.
BROADCAST = 1_000_000


def words(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda w: w != "")


def shingle(of: Column, at: Column, width: int) -> Column:
    return F.xxhash64(F.slice(of, at, F.lit(width)))


def fingerprint(of: Column) -> Column:
    """SimHash of an array of words; a word counts as often as it occurs."""
    hashes = F.transform(of, lambda w: F.xxhash64(w))
    bit = lambda h, b: F.getbit(h, b).cast("int")
    ones = lambda b: F.aggregate(hashes, F.lit(0), lambda n, h: n + bit(h, b))
    masks = F.array(*[F.struct(F.lit(b).alias("b"), F.lit((1 << b) - (1 << BITS if b == BITS - 1 else 0)).cast("long").alias("mask")) for b in range(BITS)])
    set_ = F.transform(masks, lambda m: F.when(2 * ones(m["b"]) > F.size(of), m["mask"]).otherwise(F.lit(0).cast("long")))
    return F.aggregate(set_, F.lit(0).cast("long"), lambda all_, m: all_.bitwiseOR(m))


def block_values(print_: Column, flips: int) -> Column:
    """array<struct<block, value>>: each block's value and all that differ from it in at most ``flips`` bits."""
    size = BITS // BLOCKS
    masks = F.array(*[F.lit(sum(1 << b for b in chosen)) for k in range(flips + 1) for chosen in combinations(range(size), k)])
    blocks = F.array(*[F.struct(F.lit(b).alias("block"), F.shiftrightunsigned(print_, b * size).bitwiseAND(F.lit((1 << size) - 1)).cast("int").alias("value")) for b in range(BLOCKS)])
    return F.flatten(F.transform(blocks, lambda x: F.transform(masks, lambda m: F.struct(x["block"].alias("block"), x["value"].bitwiseXOR(m).alias("value")))))


def support(shingles: Column) -> Column:
    """Shingles that must agree on a window's place, at least.

    A similarity of 0.8 leaves out at most a ninth of an item's shingles. Each inserted or missing
    word costs four or more, so there are at most shingles / 36 + 2 places that the rest agree on,
    and the best of them has no fewer than this.
    """
    return F.greatest(F.lit(1), F.floor(30 * shingles / (shingles + 72)))


def items_of(benchmark: DataFrame, item_id: str, text: str) -> DataFrame:
    """(item_id, content): the words of each item that has any."""
    rows = once(narrowed(benchmark, item_id, text), "words", words(F.col(text))).where(F.size("words") > 0)
    return rows.select(F.col(item_id).alias("item_id"), F.array_join("words", " ").alias("content")).distinct()


def windows(documents: DataFrame, contents: DataFrame, id_column: str, text: str, settle: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """(id, text_hash, start, content): windows of the documents that may be similar to an item."""
    sized = once(contents, "words", F.split("content", " ")).withColumn("n", F.size("words"))
    found = None
    for width in range(1, SHINGLE + 1):
        own = sized.where(F.col("n") >= SHINGLE if width == SHINGLE else F.col("n") == width)
        seeds = own.select("n", "words", F.explode(F.sequence(F.lit(1), F.col("n") - width + 1)).alias("at"))
        seeds = settle(seeds.select(shingle(F.col("words"), F.col("at"), width).alias("seed"), F.col("n").alias("length"), (F.col("at") - 1).alias("offset")).distinct())
        count = seeds.count()
        if not count:
            continue
        if count <= BROADCAST:
            seeds = F.broadcast(seeds)
        low = once(narrowed(documents, id_column, text), "words", words(F.col(text)))
        each = low.withColumn("text_hash", F.xxhash64(text)).select(id_column, "text_hash", "words", F.size("words").alias("n")).where(F.col("n") >= width)
        each = each.select("*", F.explode_outer(F.sequence(F.lit(1), F.col("n") - width + 1)).alias("at"))
        if count <= BROADCAST:
            hits = each.join(seeds, shingle(F.col("words"), F.col("at"), width) == F.col("seed"))
        else:  # only hashes and places meet the benchmark; the words come back to what has met
            places = each.select(id_column, "text_hash", "at", shingle(F.col("words"), F.col("at"), width).alias("own"))
            met = places.join(seeds, F.col("own") == F.col("seed")).select(F.col(id_column).alias("its_id"), F.col("text_hash").alias("its_hash"), "at", "length", "offset")
            texts = low.withColumn("text_hash", F.xxhash64(text)).select(id_column, "text_hash", "words", F.size("words").alias("n"))
            hits = texts.join(met, F.col(id_column).eqNullSafe(F.col("its_id")) & (F.col("text_hash") == F.col("its_hash")))
        length = F.least("length", "n")
        start = F.greatest(F.lit(1), F.least(F.col("at") - F.col("offset"), F.col("n") - length + 1))
        laid = hits.select(F.col(id_column).alias("doc_id"), "text_hash", "length", start.alias("start"), F.array_join(F.slice("words", start, length), " ").alias("content"))
        laid = laid.groupBy("doc_id", "text_hash", "length", "start").agg(F.count("*").alias("agree"), F.min("content").alias("content"))
        laid = laid.where(F.col("agree") >= support(F.col("length") - (width - 1))).select("doc_id", "text_hash", "start", "content")
        found = laid if found is None else found.unionByName(laid)
    return found


def similar(left: DataFrame, right: DataFrame) -> DataFrame:
    """(content, item, similarity): pairs of distinct contents within the radius, confirmed on shingles."""
    printed = lambda df: once(once(df, "words", F.split("content", " ")), "print", fingerprint(F.col("words")))
    ours = printed(left).select("content", F.col("print").alias("print_a"), F.explode(block_values(F.col("print"), 1)).alias("k")).select("content", "print_a", "k.*")
    theirs = printed(right).select(F.col("content").alias("item"), F.col("print").alias("print_b"), F.explode(block_values(F.col("print"), 2)).alias("k")).select("item", "print_b", F.col("k.block").alias("block_b"), F.col("k.value").alias("value_b"))
    met = ours.join(theirs, (F.col("block") == F.col("block_b")) & (F.col("value") == F.col("value_b")) & (F.bit_count(F.col("print_a").bitwiseXOR(F.col("print_b"))) <= RADIUS))
    pairs = met.select("content", "item").distinct()

    def counted(df: DataFrame, name: str) -> DataFrame:
        split = once(df.select(F.col(name)).distinct(), "words", F.split(name, " ")).withColumn("width", F.least(F.lit(SHINGLE), F.size("words")))
        each = split.select(name, "width", "words", F.explode(F.sequence(F.lit(1), F.size("words") - F.col("width") + 1)).alias("at"))
        return each.groupBy(F.col(name).alias(f"{name}_of"), F.array_join(F.slice("words", F.col("at"), F.col("width")), " ").alias(f"shingle_{name}")).agg(F.count("*").alias(f"n_{name}"))

    shingles = lambda name: F.greatest(F.lit(1), F.size(F.split(name, " ")) - (SHINGLE - 1))
    a, b = counted(pairs, "content"), counted(pairs, "item")
    shared = pairs.join(a, F.col("content") == F.col("content_of")).join(b, (F.col("item") == F.col("item_of")) & (F.col("shingle_content") == F.col("shingle_item")))
    both = shared.groupBy("content", "item").agg(F.sum(F.least("n_content", "n_item")).alias("both"))
    return both.withColumn("similarity", F.col("both") / (shingles("content") + shingles("item") - F.col("both"))).where(F.col("similarity") >= LEAST).drop("both")


def matches(documents: DataFrame, benchmark: DataFrame, settle: Callable[[DataFrame], DataFrame], id_column: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """(doc_id, text_hash, item_id, similarity, start, n_words): for each document and item the most similar window.

    ``settle`` writes the benchmark's words and the windows once.
    """
    items = settle(items_of(benchmark, item_id, item_text))
    contents = items.select("content").distinct()
    laid = windows(documents, contents, id_column, text, settle)
    if laid is None:
        kind = documents.schema[id_column].dataType.simpleString()
        return documents.sparkSession.createDataFrame([], f"doc_id {kind}, text_hash long, item_id {items.schema['item_id'].dataType.simpleString()}, similarity double, start int, n_words int")
    laid = settle(laid)
    pairs = settle(similar(laid.select("content").distinct(), contents))
    best = F.struct((-F.col("similarity")).alias("minus"), F.col("start").alias("start"), F.size(F.split("content", " ")).alias("n_words"))
    hits = laid.join(pairs.withColumnRenamed("content", "its"), F.col("content") == F.col("its")).groupBy("doc_id", "text_hash", "item").agg(F.min(best).alias("best"))
    named = hits.join(items.withColumnRenamed("content", "its"), F.col("item") == F.col("its"))
    return named.select("doc_id", "text_hash", "item_id", F.round(-F.col("best.minus"), 6).alias("similarity"), F.col("best.start").alias("start"), F.col("best.n_words").alias("n_words"))


def clean(documents: DataFrame, benchmark: DataFrame, settle: Callable[[DataFrame], DataFrame], id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents without any benchmark passage."""
    found = settle(matches(documents, benchmark, settle, id_column, text).select(F.col("doc_id").alias("its_id"), F.col("text_hash").alias("its_hash")).distinct())
    return documents.join(found, F.col(id_column).eqNullSafe(F.col("its_id")) & (F.xxhash64(text) == F.col("its_hash")), "left_anti")

"""Benchmark decontamination by spaced seeds.

A fixed mask picks some of ten successive words; two texts share a seed where the picked words
agree, whatever stands at the ignored places. All positions of both sides are hashed under two
masks and joined; around each hit the two texts are laid over each other, and the hit counts if
a window of 13 words has at most two different ones. Whichever two of its 13 words differ, one
mask at one place in the window looks at none of them, so no such window is missed.

Words are lower-cased runs of letters and digits, so case, punctuation and ornaments between
words do not hide a copy. The benchmark is broadcast in blocks of about BLOCK_WORDS positions,
however large it or one of its items is: a position goes with the few words that its windows may
have, and each block is one scan of the documents and one round of the same plan.

Only built-in expressions run here. Defined results: null or empty texts on either side match
nothing; benchmark items of fewer than 13 words hold no window and match nothing; a document
without id is one with the others without id and the same text; repeated rows give one result
line; empty tables give an empty result; extra columns are ignored.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.store import materialise, needs

#: The places of ten that each mask compares.
MASKS = ((0, 1, 2, 4, 7, 9), (0, 3, 4, 5, 8, 9))
SPAN = 10
#: Documents are hashed at every STRIDE-th word, benchmark items at every word.
STRIDE = 1
WINDOW = 13
#: Equal words that a window needs.
MIN_EQUAL = 11
#: Benchmark positions broadcast at once; each is a row of at most REACH words for each mask, or
#: some 500 bytes on every executor, whatever the length of its item.
BLOCK_WORDS = 300_000
#: Words that the windows around one seed may have.
REACH = 2 * WINDOW - SPAN
#: Texts are cut into pieces of so many window starts, which every probe carries along.
PIECE = 64


def plain_words(text: Column) -> Column:
    """Lower-cased runs of letters and digits."""
    return F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), "[^\\p{L}\\p{N}]+"), "")


def _seeds(hashes: str, step: int) -> Column:
    """Seed hashes at positions 0, step, 2 step ... as an array, the masks of a position together.

    Lambdas read `hashes` as a finished column. Under a position the masks follow in order.
    """
    last = F.size(hashes) - SPAN

    def at(p: Column) -> Column:
        return F.array(*[F.xxhash64(F.lit(k), *[F.get(hashes, p + i) for i in mask])
                         for k, mask in enumerate(MASKS)])

    return F.when(last >= 0, F.flatten(F.transform(
        F.sequence(F.lit(0), F.greatest(last, F.lit(0)), F.lit(step)), at)))


def _hashed(texts: DataFrame, *keep: str) -> DataFrame:
    words = texts.select(*keep, plain_words(F.col("text")).alias("_words"))
    return words.select(*keep, F.transform("_words", lambda w: F.xxhash64(w)).alias("_h"))


def _pieces(hashed: DataFrame, *keep: str) -> DataFrame:
    """Every text in pieces of the windows that start in PIECE words: each window is in just one.

    Each step on a piece is a projection or an outer explode of its own: a filter above, or the
    filter that an inner explode implies, would have the steps below it done twice.
    """
    starts = F.sequence(F.lit(0), F.greatest(F.size("_h") - 1, F.lit(0)), F.lit(PIECE))
    return hashed.select(*keep, F.posexplode_outer(F.transform(
        starts, lambda s: F.slice("_h", s + 1, PIECE + WINDOW - 1))).alias("_piece", "_h"))


def _targets(benchmark: DataFrame) -> DataFrame:
    """_block (a hash), item_id, _seed, _item, _to: the words around every seed, and its place there."""
    items = _hashed(benchmark, "item_id").filter(F.size("_h") >= WINDOW).distinct()
    seeded = _pieces(items, "item_id").select("item_id", "_piece", "_h", _seeds("_h", 1).alias("_seeds"))
    each = seeded.select("item_id", "_piece", "_h", F.posexplode_outer("_seeds").alias("_j", "_seed"))
    at = F.expr(f"_j div {len(MASKS)}").cast("int")
    first = F.greatest(at - (WINDOW - SPAN), F.lit(0))
    around = F.slice("_h", first + 1, at - first + WINDOW)
    return each.filter(F.col("_seed").isNotNull()).select(
        F.xxhash64("item_id", "_piece", "_j", "_h").alias("_block"), "item_id", "_seed",
        around.alias("_item"), (at - first).alias("_to"))


def _equal_at(shift: int) -> Column:
    """Equal words of document and item in the window that starts `shift` before the hit."""
    at, to = F.col("_at") - shift, F.col("_to") - shift
    inside = (at >= 0) & (to >= 0) & (at + WINDOW <= F.size("_h")) & (to + WINDOW <= F.size("_item"))
    pairs = F.zip_with(F.slice("_h", at + 1, WINDOW), F.slice("_item", to + 1, WINDOW),
                       lambda a, b: (a == b).cast("int"))
    return F.when(inside, F.aggregate(pairs, F.lit(0), lambda a, x: a + x)).otherwise(F.lit(0))


def benchmark_overlaps(docs: DataFrame, benchmark: DataFrame,
                       block_words: int = BLOCK_WORDS) -> DataFrame:
    """doc_id, text_key, item_id, doc_word, equal_words: one row per document and item it shares.

    text_key: a hash of the text, which tells apart documents with one id or none. doc_word: the
    first word (from 0, of the plain words) of the document's first such window. equal_words: the
    most equal words in a window.
    """
    docs, benchmark = needs(docs, "doc_id", "text"), needs(benchmark, "item_id", "text")
    targets = materialise(_targets(benchmark), "benchmark")
    blocks = max(1, -(-targets.count() // (block_words * len(MASKS))))
    hashed = _hashed(docs.select("doc_id", "text", F.xxhash64("text").alias("text_key")),
                     "doc_id", "text_key")
    pieces = _pieces(hashed, "doc_id", "text_key")
    seeded = pieces.select("doc_id", "text_key", "_piece", "_h", _seeds("_h", STRIDE).alias("_seeds"))
    probes = seeded.select("doc_id", "text_key", "_piece", "_h",
                           F.posexplode_outer("_seeds").alias("_i", "_seed"))
    found = []
    for block in range(blocks):
        part = targets.filter(F.pmod("_block", F.lit(blocks)) == block).drop("_block")
        hits = probes.join(F.broadcast(part), "_seed").select(
            "doc_id", "text_key", "_piece", "item_id", "_h", "_item",
            (F.expr(f"_i div {len(MASKS)}") * STRIDE).cast("int").alias("_at"), "_to")
        around = F.array(*[F.struct(_equal_at(s).alias("n"), (F.col("_at") - s).alias("at"))
                           for s in range(WINDOW - SPAN + 1)])
        # Exploded before it is filtered, or the test would become part of the join.
        found.append(hits.select("doc_id", "text_key", "_piece", "item_id",
                                 F.explode_outer(around).alias("_window"))
                     .filter(F.col("_window.n") >= MIN_EQUAL))
    every = reduce(DataFrame.unionAll, found)
    return every.groupBy("doc_id", "text_key", "item_id").agg(
        F.min(F.col("_piece") * PIECE + F.col("_window.at")).cast("long").alias("doc_word"),
        F.max("_window.n").cast("long").alias("equal_words"))


def clean_documents(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of docs that share no passage with the benchmark, in the columns of docs."""
    leaks = materialise(benchmark_overlaps(docs, benchmark).select("doc_id", "text_key").distinct(),
                        "leaks").withColumnsRenamed({"doc_id": "_id", "text_key": "_key"})
    same = docs["doc_id"].eqNullSafe(leaks["_id"]) & (F.xxhash64(docs["text"]) == leaks["_key"])
    return docs.join(leaks, same, "left_anti")

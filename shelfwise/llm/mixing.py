"""Mixing sources to target weights, cut at each source's exact budget.

Every document gets a hash-random key. Within its source documents are ordered by that key, the
words before each one come from distributed prefix sums, and a source gives whole epochs of
itself and then the documents before its cut; the document at the cut gives the words still due.

Only built-in expressions run here. Defined results: null text has size 0 and gives nothing; a
null source is a source of its own, after all others; repeated rows follow each other in the
order and each has its own share; an empty table gives an empty result; extra columns pass
through `mixed_documents`. The number of sources is taken to be small against the number of
documents: the sources' table is ranked as one window.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from shelfwise.llm.store import (hash60, materialise, n_words, needs, numbered, running_sum, stored,
                                 words, wrapped)

#: Weights of the sources by rank, over and over.
WEIGHTS = (5, 2, 1)
#: Words of the mix in percent of the words of the corpus.
SHARE_PERCENT = 150
#: A source, and so a document, is used so many times at most.
MAX_EPOCHS = 2
SEED = "mix-1"


def source_targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS,
                   share: int = SHARE_PERCENT, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """source, n_docs, source_size, target of every source; from rows of source and size.

    Sources share the total by weight; none gets more than max_epochs times its size, and what is
    left is shared by weight among the others. Raising the level L of `least(L * weight, cap)`
    caps the sources in the order of cap / weight, so L follows from two running sums.
    """
    rank = F.row_number().over(W.orderBy(F.col("source").asc_nulls_last()))
    per_rank = F.array(*[F.lit(w).cast("long") for w in weights])
    sources = sizes.groupBy("source").agg(F.count(F.lit(1)).alias("n_docs"),
                                          F.sum("size").alias("source_size")) \
        .withColumn("_rank", rank) \
        .withColumn("_weight", F.get(per_rank, (F.col("_rank") - 1) % len(weights))) \
        .withColumn("_cap", F.col("source_size") * max_epochs) \
        .withColumn("_level", F.col("_cap").cast("double") / F.col("_weight"))
    order = W.orderBy("_level", "_rank")
    before = order.rowsBetween(W.unboundedPreceding, -1)
    after = order.rowsBetween(0, W.unboundedFollowing)
    every = W.partitionBy()
    total = F.sum("source_size").over(every).cast("double") * share / 100
    left = total - F.coalesce(F.sum("_cap").over(before), F.lit(0)).cast("double")
    levels = sources.withColumn("_reached", left / F.sum("_weight").over(after).cast("double"))
    final = F.min(F.when(F.col("_reached") <= F.col("_level"),
                         F.struct("_level", "_rank", "_reached"))).over(every)
    level = final["_reached"]
    return levels.select(
        "source", "n_docs", "source_size",
        F.when(F.col("_level") < level, F.col("_cap").cast("double"))
        .otherwise(F.least(level * F.col("_weight"), F.col("_cap").cast("double")))
        .alias("target"))


def mix_key(seed: str = SEED):
    """The hash-random key of a document, from its id and text."""
    return hash60(F.lit(seed), F.col("doc_id").cast("string"),
                  F.md5(F.coalesce(F.col("text"), F.lit(""))))


def mix(docs: DataFrame, source: str = "source", weights: Sequence[int] = WEIGHTS,
        share: int = SHARE_PERCENT, max_epochs: int = MAX_EPOCHS, seed: str = SEED) -> DataFrame:
    """doc_id, source, key, size, source_size, target, epochs, before, taken of every document.

    taken: words the mix takes of a document, repeats counted. epochs: how often the whole
    document is taken at least. before: words ahead of it in an epoch.
    """
    needs(docs, "doc_id", "text", source)
    sized = materialise(docs.select(
        "doc_id", F.col(f"`{source}`").alias("source"), mix_key(seed).alias("key"),
        n_words("text").alias("size")), "mix-sizes")
    targets = source_targets(sized, weights, share, max_epochs).alias("t")
    # The sources' table is small, and Spark broadcasts it when it is; a hot source is split.
    rows = sized.alias("d").join(targets, F.col("d.source").eqNullSafe(F.col("t.source")), "left") \
        .select("d.doc_id", "d.source", "d.key", "d.size", "t.n_docs", "t.source_size", "t.target")
    placed = running_sum(rows, ["source"], "key", "size", ["size", "doc_id"], "n_docs", "before")
    budget = F.floor(F.col("target") + 0.5).cast("long")
    epochs = F.when(F.col("source_size") > 0, F.expr("floor(target + 0.5) div source_size")) \
        .otherwise(F.lit(0)).cast("long")
    rest = budget - F.col("epochs") * F.col("source_size")
    extra = F.greatest(F.lit(0).cast("long"), F.least(F.col("size"), rest - F.col("before")))
    return placed.withColumn("epochs", epochs).select(
        "doc_id", "source", "key", "size", "source_size", "target", "epochs", "before",
        (F.col("epochs") * F.col("size") + extra).cast("long").alias("taken"))


def mixed_documents(docs: DataFrame, mixture: DataFrame, source: str = "source",
                    seed: str = SEED) -> DataFrame:
    """The rows of docs as the mixture (of the same docs and seed) takes them.

    Only the key at which each source is cut is joined to the texts, so these are not shuffled.
    A document taken twice comes twice. The document at the cut comes with the words that were
    due: its first words joined by one space, n_chars (if there) counted anew. Where rows repeat
    at the cut (one id or none, and one text), the words of their key are dealt out by their
    places in the files: some rows come whole, one is cut, the others do not come. Documents
    without words are not taken.
    """
    extra = F.col("taken") - F.col("epochs") * F.col("size")
    per_key = mixture.groupBy("source", "key").agg(
        F.max("epochs").alias("epochs"), F.sum(extra).alias("due"), F.sum("size").alias("all"),
        F.count(F.lit(1)).alias("n"))
    cuts = materialise(per_key.groupBy(F.col("source").alias("_source")).agg(
        F.max("epochs").alias("_epochs"),
        F.min(F.when(F.col("due") < F.col("all"), F.struct("key", "due", "n"))).alias("_cut")), "cuts")
    keys = [F.col(f"`{source}`").alias("_from"), mix_key(seed).alias("_key"),
            n_words("text").alias("_size")]
    same_source = F.col("_from").eqNullSafe(F.col("_source"))
    at_cut = F.col("_key") == F.col("_cut.key")
    due = F.col("_cut.due")
    if cuts.filter("_cut.n > 1").isEmpty():
        keyed = docs.select(wrapped(docs), *keys)
    else:
        docs = stored(docs)
        order = hash60(F.col("_row").cast("string")).alias("_order")
        keyed = numbered(docs, wrapped(docs), *keys).withColumn("_order", order)
        tied = materialise(keyed.join(cuts, same_source & at_cut & (F.col("_cut.n") > 1)).select(
            "_source", "_order", "_row", "_size", "_cut.due", "_cut.n"), "tied")
        placed = running_sum(tied, ["_source"], "_order", "_size", ["_row"], "n", "_before")
        left = F.greatest(F.lit(0).cast("long"), F.col("due") - F.col("_before"))
        ties = placed.filter(left < F.col("_size")).groupBy(F.col("_source").alias("_of")).agg(
            F.min(F.struct("_order", "_row", left.alias("due"))).alias("_tie"))
        cuts = materialise(cuts.join(ties, F.col("_source").eqNullSafe(F.col("_of")), "left")
                           .drop("_of"), "cuts")
        ahead = F.struct("_order", "_row")
        tie = F.struct("_tie._order", "_tie._row")
        due = F.when(F.col("_tie").isNull(), due).when(ahead < tie, F.col("_size")) \
            .when(ahead == tie, F.col("_tie.due")).otherwise(F.lit(0))
    joined = keyed.join(cuts, same_source)
    last = F.when(F.col("_cut").isNull() | (F.col("_key") < F.col("_cut.key")), F.col("_size")) \
        .when(at_cut, due).otherwise(F.lit(0))
    takes = F.filter(F.concat(F.array_repeat(F.col("_size"), F.col("_epochs").cast("int")),
                              F.array(last.cast("long"))), lambda n: n > 0)
    each = joined.select("doc", "_size", F.explode(takes).alias("_take"))
    cut = F.col("_take") < F.col("_size")
    short = F.array_join(F.slice(words("doc.text"), 1, F.col("_take").cast("int")), " ")
    new = {"text": F.when(cut, short).otherwise(F.col("doc.text"))}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.when(cut, F.length(short).cast(docs.schema["n_chars"].dataType)) \
            .otherwise(F.col("doc.n_chars"))
    return each.select(*[new.get(c, F.col(f"doc.`{c}`")).alias(c) for c in docs.columns])

"""Quality rules per document and verdicts per host.

A document fails on its own when it is too short or repeats itself too much; much markup and
repeated lines are failures of further rules, which say nothing about one document but do about
a host. The failures of each rule are added up by host, each host's rate is shrunk towards that
of all hosts with a beta prior fitted to the hosts themselves, and documents of hosts with a rate
that is high and far above that of all hosts go too, whatever they look like alone. What chance
does to the rates of small hosts is taken out of the prior, so a host seen twice can hardly be
condemned by two failures; a host seen a million times stands for itself.

Only built-in expressions run here. Windows of three words are compared by 64-bit hashes.

Defined results: null text counts as empty and fails (no words); null hosts form a host of their
own; repeated rows are judged and counted one by one; an empty table gives an empty result;
other columns pass through `host_quality` untouched, and names starting with `_` are scratch
names only inside `document_rules`, which reads nothing but the text and what the caller names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.store import SEPARATORS, materialise, needs, words

MIN_WORDS = 50
#: Percent of the words that may lie in repeated windows of three words.
MAX_REPEAT_PERCENT = 50
#: More symbols in percent of the words, and repeated lines in percent of the words, are failures.
MAX_SYMBOL_PERCENT = 20
MAX_DUP_LINE_PERCENT = 5
#: A host loses all its documents if its shrunk rate of some failure, less so many of its standard
#: deviations, exceeds this...
CAUTION = 2.0
MAX_HOST_RATE = 0.3
#: ... and so many times the rate of all hosts.
MAX_HOST_RATIO = 2.0
#: Pseudo-documents of the prior where hosts differ no more than by chance.
MAX_PRIOR = 1e6
#: The rules whose failures are counted by host.
RULES = ("short", "repeats", "symbols", "dup_lines")
SYMBOLS = "#*$%&|<>"
_ALL = 2**31 - 1


def host_of_url(url: Column) -> Column:
    """The host of a web address in lower case; null where there is none."""
    return F.lower(F.try_parse_url(url, F.lit("HOST")))


def document_rules(docs: DataFrame, keep: list[str], text: str = "text",
                   min_words: int = MIN_WORDS, max_repeat: int = MAX_REPEAT_PERCENT) -> DataFrame:
    """The columns `keep` and n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    base_failed of every document."""
    body = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    base = docs.select(*[F.col(f"`{c}`").alias(f"keep.{c}") for c in keep], body.alias("_text"))
    kept = [f"`keep.{c}`" for c in keep]
    lines = F.filter(F.split("_text", "\n"), lambda x: x.rlike("[^\\x20\\x09-\\x0D]"))
    counted = base.select(
        *kept, F.transform(words("_text"), lambda x: F.xxhash64(x)).alias("_h"),
        F.length(F.translate("_text", SEPARATORS, "")).cast("long").alias("word_chars"),
        (F.length("_text") - F.length(F.translate("_text", SYMBOLS, ""))).cast("long")
        .alias("n_symbols"),
        lines.alias("_lines"))
    # Each step is a projection of its own: lambdas then read a finished array, not its recipe.
    hashed = counted.select(
        *kept, F.size("_h").cast("long").alias("n_words"), "word_chars", "n_symbols",
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.transform(F.slice("_h", 1, F.greatest(F.size("_h") - 2, F.lit(0))),
                    lambda x, i: F.xxhash64(x, F.get("_h", i + 1), F.get("_h", i + 2)))
        .alias("_w"))
    numbers = ["n_words", "word_chars", "n_symbols", "n_dup_lines"]
    pairs = F.transform("_w", lambda x, i: F.struct(x.alias("h"), i.alias("p")))
    ordered = hashed.select(
        *kept, *numbers,
        F.when(F.size(F.array_distinct("_w")) < F.size("_w"), F.sort_array(pairs)).alias("_s"))
    again = F.filter("_s", lambda x, i: (x["h"] == F.get("_s", i - 1)["h"])
                     | (x["h"] == F.get("_s", i + 1)["h"]))
    repeated = ordered.select(
        *kept, *numbers, F.sort_array(F.transform(again, lambda x: x["p"])).alias("_p"))
    covered = F.aggregate(
        F.transform("_p", lambda p, i: F.least(F.lit(3), F.coalesce(F.get("_p", i + 1) - p,
                                                                    F.lit(3)))),
        F.lit(0).cast("long"), lambda a, x: a + x)
    done = repeated.select(*kept, *numbers,
                           F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words"))
    failed = (F.col("n_words") < min_words) \
        | (100 * F.col("n_repeat_words") > max_repeat * F.col("n_words"))
    return done.select(*[F.col(k).alias(c) for k, c in zip(kept, keep, strict=True)],
                       *numbers, "n_repeat_words", failed.alias("base_failed"))


def rule_failures(min_words: int = MIN_WORDS, max_repeat: int = MAX_REPEAT_PERCENT
                  ) -> dict[str, Column]:
    """Whether a document with the numbers of `document_rules` fails each rule."""
    n = F.col("n_words")
    return {"short": n < min_words, "repeats": 100 * F.col("n_repeat_words") > max_repeat * n,
            "symbols": 100 * F.col("n_symbols") > MAX_SYMBOL_PERCENT * n,
            "dup_lines": 100 * F.col("n_dup_lines") > MAX_DUP_LINE_PERCENT * n}


def _prior(hosts: DataFrame, rules: list[str]) -> DataFrame:
    """One row: <rule>_m, <rule>_k, mean and strength of the beta prior of each rule's rate.

    For hosts of n documents with a share p of failures, m is the share of all documents. The sum
    of n (p - m)^2 is what sampling alone makes of it, (hosts - 1) m (1 - m), plus what the hosts
    themselves differ by; the latter gives their correlation rho, and the strength 1 / rho - 1.
    """
    n = F.col("documents").cast("double")
    all_n, all_n2 = F.sum(n).alias("n"), F.sum(n * n).alias("n2")
    sums = [F.sum(F.col(r).cast("double")).alias(f"{r}_f") for r in rules]
    squares = [F.sum(F.col(r).cast("double") * F.col(r) / n).alias(f"{r}_q") for r in rules]
    one = hosts.agg(F.count(F.lit(1)).alias("h"), all_n, all_n2, *sums, *squares)
    columns = []
    for r in rules:
        m = F.coalesce(F.try_divide(F.col(f"{r}_f"), F.col("n")), F.lit(0.0))
        chance = (F.col("h") - 1) * m * (1 - m)
        spread = F.col(f"{r}_q") - F.col("n") * m * m  # the sum of n (p - m)^2
        room = m * (1 - m) * (F.col("n") - F.try_divide(F.col("n2"), F.col("n"))) - chance
        rho = F.coalesce(F.when(room > 0, F.least((spread - chance) / room, F.lit(1.0))), F.lit(0.0))
        k = F.when(rho > 0, F.least(1 / rho - 1, F.lit(MAX_PRIOR))).otherwise(F.lit(MAX_PRIOR))
        columns += [m.alias(f"{r}_m"), k.alias(f"{r}_k")]
    return one.select(*columns)


def host_verdicts(judged: DataFrame, host: str, failures: dict[str, Column] | None = None,
                  max_rate: float = MAX_HOST_RATE, max_ratio: float = MAX_HOST_RATIO) -> DataFrame:
    """host, documents, <rule>_rate (posterior means) and host_ok, a row for each host.

    Hosts are counted map-side first, so a hot host costs no task more than one row per
    partition.
    """
    failures = failures or rule_failures()
    rules = list(failures)
    hosts = judged.groupBy(F.col(f"`{host}`").alias("host")).agg(
        F.count(F.lit(1)).alias("documents"),
        *[F.count_if(c).alias(r) for r, c in failures.items()])

    def rate(r: str) -> Column:
        m, k = F.col(f"{r}_m"), F.col(f"{r}_k")
        return (F.col(r) + m * k) / (F.col("documents") + k)

    # One row joins every host; the aggregate has no keys, so this is no growing product.
    both = hosts.join(F.broadcast(_prior(hosts, rules)))
    bad = F.lit(False)
    for r in rules:
        spread = F.sqrt(rate(r) * (1 - rate(r)) / (F.col("documents") + F.col(f"{r}_k") + 1))
        sure = rate(r) - CAUTION * spread
        bad = bad | ((sure > max_rate) & (sure > max_ratio * F.col(f"{r}_m")))
    return both.select("host", "documents", *[rate(r).alias(f"{r}_rate") for r in rules],
                       (~bad).alias("host_ok"))


def host_quality(docs: DataFrame, keep: list[str], host: str = "source", text: str = "text",
                 max_rate: float = MAX_HOST_RATE, max_ratio: float = MAX_HOST_RATIO) -> DataFrame:
    """document_rules of every row, its host's shrunk failure rates, and whether it is kept."""
    needs(docs, text, host, *keep)
    columns = list(dict.fromkeys([*keep, host]))
    judged = materialise(document_rules(docs, columns, text), "quality")
    hosts = host_verdicts(judged, host, max_rate=max_rate, max_ratio=max_ratio)
    same = judged[f"`{host}`"].eqNullSafe(hosts["host"])
    rates = [f"{r}_rate" for r in RULES]
    return judged.join(hosts.select("host", *rates, "host_ok"), same, "left").select(
        *[judged[f"`{c}`"] for c in judged.columns], *rates,
        (~F.col("base_failed") & F.col("host_ok")).alias("kept"))

"""Personal data by patterns bootstrapped from seed entities.

Seeds are the spans that fixed rules find (addresses, numbers that pass their checks). The two
words to the left of a seed form a lexical pattern. Every pattern extracts instances: words with
digits or an @ that follow it, digit groups in a row as one, seeds or not. Patterns and instances
form a graph which Spark scores in rounds: a pattern is as good as the instances it extracts, and
an unknown instance as good as the best pattern that was sure of it before. Patterns that end up
sure, with enough different seeds or instances found before, then name the unknown instances
behind them as personal data too.

A text is read once, in Arrow batches; only spans and the words around them leave that scan.

Defined results: null text counts as empty and has no spans; null ids are kept; repeated rows
each get their spans (seeds are counted as different words, so copies do not make a pattern
surer); an empty table gives an empty result; extra columns are ignored. Positions count code
points, the end is exclusive.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from itertools import count

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.store import materialise, needs, workers_import

#: The kinds in their order at one position, and their patterns.
KINDS = ("email", "ip", "card", "phone")
# An address is found from its @: what may stand before it, and what must follow. A run of digits
# is tried once, from its first one.
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]++(\.[0-9]++)(\.[0-9]++)(\.[0-9]++)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_MARK = re.compile(r"[0-9@]")
_INSIDE = re.compile(r"\w")
_LETTER = re.compile(r"[^\W\d_]|@")
#: Kind of the spans that patterns add.
LEARNED = "learned"
#: A word that ends with one of these ends a run of digit groups.
STOPS = ",;:.!?"
MIN_CONFIDENCE = 0.8
#: Different seeds, or instances found in earlier rounds, behind a pattern before it may name unknown words.
MIN_SEEDS = 5
#: Patterns and instances of more characters are known by a hash.
LONG_NAME = 120


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        n = int(d) * (2 if k % 2 else 1)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost addresses; the characters before an @ are looked at once."""
    at, done = text.find("@"), 0
    while at >= 0:
        low = at
        while low > done and text[low - 1] in LOCAL:
            low -= 1
        m = DOMAIN.match(text, at) if low < at else None
        done = m.end() if m else at + 1
        if m:
            yield low, done
        at = text.find("@", done)


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, rank of the kind, end) by start, then kind."""
    spans = [(s, 0, e) for s, e in _emails(text)] if "@" in text else []
    if _DIGIT.search(text):
        for m in IP.finditer(text):
            parts = [p.lstrip("0") or "0" for p in m.group().split(".")]
            if all(len(p) <= 3 and int(p) <= 255 for p in parts):
                spans.append((m.start(), 1, m.end()))
        for m in CARD.finditer(text):
            digits = re.sub("[^0-9]", "", m.group())
            if 12 <= len(digits) <= 19 and luhn(digits):
                spans.append((m.start(), 2, m.end()))
        if "+" in text:
            for m in PHONE.finditer(text):
                if 9 <= len(re.sub("[^0-9]", "", m.group())) <= 15:
                    spans.append((m.start(), 3, m.end()))
    return sorted(spans)


def _bare(text: str, low: int, high: int, also: str = "") -> tuple[int, int]:
    """The bounds without the signs at either end; letters, digits, _ and `also` are none."""
    def sign(c: str) -> bool:
        return not (c.isalnum() or c == "_" or c in also)

    while low < high and sign(text[low]):
        low += 1
    while low < high and sign(text[high - 1]):
        high -= 1
    return low, high


def _pattern(text: str, start: int) -> str | None:
    """The two words to the left, bare and in lower case; None if there are no two."""
    words, high = [], start
    while high > 0 and len(words) < 2:
        while high > 0 and text[high - 1].isspace():
            high -= 1
        low = high
        while low > 0 and not text[low - 1].isspace():
            low -= 1
        a, b = _bare(text, low, high)
        if a < b:
            words.insert(0, text[a:b])
        high = low
    return _name(" ".join(words).lower()) if len(words) == 2 else None


def _unknown(text: str, spans: list[tuple[int, int, int]]) -> Iterator[tuple[int, int]]:
    """Words with digits or an @ that touch no span, without the signs around them.

    Words of digits and signs in a row on one line, up to a word that ends with a stop, are one.
    """
    after, k, reach, run = 0, 0, 0, None
    for d in _MARK.finditer(text):
        if d.start() < after:
            continue
        low = d.start()
        while low > after and not text[low - 1].isspace():
            low -= 1
        high = d.end()
        while high < len(text) and not text[high].isspace():
            high += 1
        gap, after = text[after:low], high
        low, high = _bare(text, low, high, "@")
        while k < len(spans) and spans[k][0] < high:
            reach = max(reach, spans[k][2])
            k += 1
        if run and (reach > low or _LETTER.search(text, low, high) or not gap.isspace()
                    or "\n" in gap or "\r" in gap):
            yield run
            run = None
        if reach > low or not _INSIDE.search(text, low, high):
            continue
        if _LETTER.search(text, low, high):
            yield low, high
        else:
            run = (run[0] if run else low, high)
            if text[after - 1] in STOPS:
                yield run
                run = None
    if run:
        yield run


def _name(text: str) -> str:
    """An instance or pattern as the graph knows it: a long one by a hash."""
    return text if len(text) <= LONG_NAME else hashlib.sha256(text.encode()).hexdigest()


SPANS = "array<struct<start:bigint,rank:int,end:bigint>>"
SEEN = "array<struct<pattern:string,instance:string,seed:boolean,start:bigint,end:bigint>>"


def extract(docs: DataFrame) -> DataFrame:
    """doc_id, spans (of the fixed rules), seen (patterns with what follows them) of every row."""
    rows = needs(docs, "doc_id", "text")
    workers_import(docs.sparkSession)
    kinds = rows.schema["doc_id"].dataType.simpleString()

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        span = pa.list_(pa.struct([("start", pa.int64()), ("rank", pa.int32()),
                                   ("end", pa.int64())]))
        item = pa.list_(pa.struct([("pattern", pa.string()), ("instance", pa.string()),
                                   ("seed", pa.bool_()), ("start", pa.int64()),
                                   ("end", pa.int64())]))
        for batch in batches:
            spans, seen = [], []
            for value in batch.column(1):
                text = value.as_py() or ""
                found = base_spans(text)
                spans.append([{"start": s, "rank": k, "end": e} for s, k, e in found])
                ends = [(s, e, True) for s, _, e in found]
                if _MARK.search(text):
                    ends += [(s, e, False) for s, e in _unknown(text, found)]
                around = [(_pattern(text, s), _name(text[s:e]), seed, s, e) for s, e, seed in ends]
                seen.append([{"pattern": p, "instance": w, "seed": seed, "start": s, "end": e}
                             for p, w, seed, s, e in around if p])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(spans, span), pa.array(seen, item)],
                names=["doc_id", "spans", "seen"])

    return rows.mapInArrow(read, f"doc_id {kinds}, spans {SPANS}, seen {SEEN}")


def sure_patterns(edges: DataFrame, rounds: int | None = None,
                  min_confidence: float = MIN_CONFIDENCE, min_seeds: int = MIN_SEEDS) -> DataFrame:
    """Patterns to trust, from rows of pattern, instance, seed; rounds go on until none is new.

    All groups are sums and maxima, combined before the shuffle. An unknown instance behind a
    pattern that became sure counts in the next rounds as much as that pattern's confidence, and
    as one of the seeds, for the patterns that are not sure yet: no evidence goes in a circle.
    """
    graph = edges.groupBy("pattern", "instance").agg(F.max("seed").alias("seed"))
    seeds = F.sum(F.col("seed").cast("int")).alias("seeds")
    # Fewer instances than seeds needed, known or not, can never do.
    sizes = materialise(graph.groupBy("pattern").agg(seeds, F.count(F.lit(1)).alias("n"))
                        .filter(F.col("n") >= min_seeds), "patterns")
    graph = materialise(graph.filter(~F.col("seed")).join(sizes, "pattern", "left_semi")
                        .select("pattern", "instance"), "instances")
    scored = sizes.select("*", F.col("seeds").cast("double").alias("score"))
    sure = known = None
    for k in count():
        new = scored.withColumn("confidence", F.col("score") / (F.col("n") + 1)).filter(
            (F.col("confidence") >= min_confidence) & (F.col("seeds") >= min_seeds)) \
            .select("pattern", "confidence")
        new = materialise(new if sure is None else new.join(sure, "pattern", "left_anti"), "sure")
        sure = new if sure is None else sure.unionAll(new)
        if k + 1 == rounds or new.isEmpty():
            break
        found = graph.join(new, "pattern").select("instance", "confidence")
        known = materialise((found if known is None else found.unionAll(known)).groupBy("instance")
                            .agg(F.max("confidence").alias("confidence")), "promoted")
        more = graph.join(known, "instance").groupBy("pattern").agg(
            F.sum("confidence").alias("_more"), F.count(F.lit(1)).alias("_known"))
        scored = sizes.join(more, "pattern", "left").select(
            "pattern", (F.col("seeds") + F.coalesce("_known", F.lit(0))).alias("seeds"), "n",
            (F.col("seeds") + F.coalesce("_more", F.lit(0.0))).alias("score"))
    return sure.select("pattern")


def find_personal(docs: DataFrame) -> DataFrame:
    """doc_id, spans (start, rank, end; rank len(KINDS) is LEARNED) of every row."""
    read = materialise(extract(docs).withColumn("_row", F.monotonically_increasing_id()), "personal")
    seen = read.filter(F.size("seen") > 0).select("_row", F.explode("seen").alias("e")) \
        .select("_row", "e.*")
    trusted = sure_patterns(seen.select("pattern", "instance", "seed"))
    more = seen.filter(~F.col("seed")).join(trusted, "pattern", "left_semi").groupBy("_row").agg(
        F.collect_set(F.struct("start", F.lit(len(KINDS)).alias("rank"), "end")).alias("_more"))
    return read.join(more.withColumnRenamed("_row", "_id"), F.col("_row") == F.col("_id"), "left") \
        .select("doc_id", F.sort_array(F.concat(
            "spans", F.coalesce("_more", F.array().cast(SPANS)))).alias("spans"))


def digest(found: DataFrame) -> DataFrame:
    """doc_id, n_<kind>, base_sha256, spans: text forms of the spans."""
    names = F.array(*[F.lit(k) for k in (*KINDS, LEARNED)])

    def text(chosen: Column) -> Column:
        return F.array_join(F.transform(chosen, lambda s: F.concat_ws(
            ":", F.get(names, s["rank"]), s["start"].cast("string"), s["end"].cast("string"))), ",")

    def number(rank: int) -> Column:
        return F.size(F.filter("spans", lambda s: s["rank"] == rank)).cast("long")

    base = F.filter("spans", lambda s: s["rank"] < len(KINDS))
    return found.select("doc_id", *[number(k).alias(f"n_{n}") for k, n in enumerate(KINDS)],
                        F.sha2(text(base), 256).alias("base_sha256"),
                        text(F.col("spans")).alias("spans"))

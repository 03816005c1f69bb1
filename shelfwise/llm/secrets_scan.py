"""Secret scans over a ledger of blobs.

Every text is a blob, named by its SHA-256. The ledger holds which blob was scanned under which
version of the rules, with what was found. A scan takes the versions of all documents, looks up
which (blob, rules) pairs the ledger lacks, scans one copy of each of those, appends them, and
joins the findings of all blobs back to every document that holds them. A new commit of a file,
a fork or an exact copy costs nothing but the lookup; a new version of the rules costs one scan
of every blob.

Only built-in expressions run here: a text split at a rule's matches has as many pieces as it has
matches and one more, and their lengths give the positions.

Defined results: null text counts as the empty blob, which holds nothing; repeated rows each get
their findings; null ids are kept; an empty table leaves the ledger as it is and gives an empty
result; extra columns are ignored. Positions count code points, the end is exclusive.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.llm.store import needs
from shelfwise.session import shared_dir


@dataclass(frozen=True)
class Rule:
    """Leftmost matches of `pattern`, of which those stay whose group has min_length characters."""

    kind: str
    pattern: str
    group: int
    min_length: int
    #: A cheap test that every text with a match passes.
    hint: str


#: Fixed values. The order is the order of kinds at one position; those after the first three are
#: this scan's own and never replace a span of the others.
RULES = (
    Rule("assign", r"((?i:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?"
         r"([A-Za-z0-9+/_.=-]+)", 2, 6, r"(?i)(?:passw|secret|token|api_?key)"),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 20, "AKIA"),
    Rule("hex", r"[0-9a-f]{24,}", 0, 24, r"[0-9a-f]{24}"),
    Rule("pem", r"-----BEGIN (?:[A-Z]+ )?PRIVATE KEY-----", 0, 1, "PRIVATE KEY-----"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}", 0, 1,
         r"\.eyJ"),
)
VERSION = "1"
SPAN = "struct<kind:string,rank:int,start:int,end:int>"


STEPS = "array<struct<long:int,part:int,gap:int>>"


def rule_steps(text: Column, rule: Rule) -> Column:
    """STEPS: length, length of the group, and distance from the match before, of each match."""
    pattern = F.lit(rule.pattern)
    whole = F.regexp_extract_all(text, pattern, F.lit(0))
    part = whole if rule.group == 0 else F.regexp_extract_all(text, pattern, F.lit(rule.group))
    gaps = F.split(text, rule.pattern)
    steps = F.zip_with(F.zip_with(whole, part, lambda a, b: F.struct(
        F.length(a).alias("long"), F.length(b).alias("part"))), F.slice(gaps, 1, F.size(whole)),
        lambda m, gap: F.struct(m["long"].alias("long"), m["part"].alias("part"),
                                F.length(gap).alias("gap")))
    return F.when(text.rlike(rule.hint), steps).otherwise(F.array().cast(STEPS))


def in_chunks(steps: Column) -> Column:
    """The steps cut into about as many chunks as a chunk has steps.

    Positions are running sums, and a running sum that grows an array copies it at every step:
    in one go that is the square of the matches, in chunks and over chunks it is not.
    """
    size = F.ceil(F.sqrt(F.size(steps).cast("double"))).cast("int")
    starts = F.when(F.size(steps) > 0, F.sequence(F.lit(0), size - 1)) \
        .otherwise(F.array().cast("array<int>"))
    return F.transform(starts, lambda k: F.slice(steps, k * size + 1, size))


def chunk_starts(chunks: Column) -> Column:
    """Where in the text each chunk begins."""
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("starts"))

    def add(acc: Column, chunk: Column) -> Column:
        length = F.aggregate(chunk, F.lit(0), lambda a, m: a + m["gap"] + m["long"])
        return F.struct((acc["at"] + length).alias("at"),
                        F.concat(acc["starts"], F.array(acc["at"])).alias("starts"))

    return F.aggregate(chunks, start, add, lambda acc: acc["starts"])


def chunk_spans(chunks: Column, starts: Column, rule: Rule, rank: int) -> Column:
    """array<SPAN> of the matches whose group is long enough."""
    def spans(chunk: Column, first: Column) -> Column:
        start = F.struct(first.alias("at"), F.array().cast(f"array<{SPAN}>").alias("spans"))

        def add(acc: Column, m: Column) -> Column:
            low = acc["at"] + m["gap"]
            high = low + m["long"]
            span = F.struct(F.lit(rule.kind).alias("kind"), F.lit(rank).alias("rank"),
                            low.alias("start"), high.alias("end"))
            more = F.when(m["part"] >= rule.min_length, F.concat(acc["spans"], F.array(span))) \
                .otherwise(acc["spans"])
            return F.struct(high.alias("at"), more.alias("spans"))

        return F.aggregate(chunk, start, add, lambda acc: acc["spans"])

    return F.flatten(F.zip_with(chunks, starts, spans))


def scan_blobs(blobs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """blob, spans (array of kind, rank, start, end by start, then rank) of texts (blob, text)."""
    # Each step is a projection of its own: lambdas then read a finished array, not its recipe.
    n = range(len(rules))
    steps = blobs.select("blob", *[rule_steps(F.col("text"), rules[k]).alias(f"_s{k}") for k in n])
    chunks = steps.select("blob", *[in_chunks(F.col(f"_s{k}")).alias(f"_c{k}") for k in n])
    placed = chunks.select("*", *[chunk_starts(F.col(f"_c{k}")).alias(f"_a{k}") for k in n])
    each = placed.select("blob", *[chunk_spans(F.col(f"_c{k}"), F.col(f"_a{k}"), rules[k], k)
                                   .alias(f"_{k}") for k in n])
    key = F.transform(F.concat(*[F.col(f"_{k}") for k in range(len(rules))]),
                      lambda s: F.struct(s["start"].alias("start"), s["rank"].alias("rank"),
                                         s["end"].alias("end"), s["kind"].alias("kind")))
    return each.select("blob", F.sort_array(key).alias("spans"))


def blob_id(text: Column) -> Column:
    return F.sha2(F.coalesce(text, F.lit("")), 256)


LEDGER = "blob string, rules string, spans array<struct<start:int,rank:int,end:int,kind:string>>"


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    """All entries; an empty ledger where nothing was written yet."""
    try:
        return spark.read.schema(LEDGER).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], LEDGER)


def scan_new_blobs(docs: DataFrame, ledger: str, rules: tuple[Rule, ...] = RULES,
                   version: str = VERSION) -> None:
    """Scan the blobs of docs that the ledger lacks under this version, and append them.

    One copy of a blob is picked before the shuffle already, so thousands of copies send one text
    from each partition. A run that dies halfway has appended nothing: Spark commits the files at
    the end, and a blob scanned twice by two runs has the same findings twice, read once.
    """
    spark = docs.sparkSession
    known = read_ledger(spark, ledger).filter(F.col("rules") == version).select("blob")
    versions = needs(docs, "text").filter(F.col("text") != "") \
        .select(blob_id(F.col("text")).alias("blob"), "text")
    unseen = versions.join(known, "blob", "left_anti") if not known.isEmpty() else versions
    one_each = unseen.groupBy("blob").agg(F.first("text").alias("text"))
    scan_blobs(one_each, rules).select("blob", F.lit(version).alias("rules"), "spans") \
        .write.mode("append").parquet(ledger)


def findings(docs: DataFrame, ledger: str, keep: list[str], version: str = VERSION) -> DataFrame:
    """The columns `keep`, blob, and spans (null if none) of every document, from the ledger."""
    spark = docs.sparkSession
    hits = read_ledger(spark, ledger).filter((F.col("rules") == version) & (F.size("spans") > 0)) \
        .groupBy("blob").agg(F.first("spans").alias("spans"))
    paths = docs.select(*[F.col(f"`{c}`") for c in keep], blob_id(F.col("text")).alias("_blob"))
    return paths.join(hits, paths["_blob"] == hits["blob"], "left") \
        .select(*[F.col(f"`{c}`") for c in keep], F.col("_blob").alias("blob"), "spans")


def scan_secrets(docs: DataFrame, ledger: str | None = None, keep: list[str] | None = None,
                 rules: tuple[Rule, ...] = RULES, version: str = VERSION) -> DataFrame:
    """Bring the ledger up to date with docs and return the findings of all of them."""
    path = ledger or shared_dir(docs.sparkSession, "llm-ledger")
    scan_new_blobs(docs, path, rules, version)
    return findings(docs, path, keep or ["doc_id"], version)


def digest(found: DataFrame, kinds: tuple[str, ...] = ("assign", "access", "hex")) -> DataFrame:
    """doc_id, n_<kind> of the base kinds, base_sha256, spans: text forms of the findings."""
    spans = F.coalesce("spans", F.array().cast(
        "array<struct<start:int,rank:int,end:int,kind:string>>"))
    said = found.select("doc_id", spans.alias("spans"))

    def text(chosen: Column) -> Column:
        return F.array_join(F.transform(chosen, lambda s: F.concat_ws(
            ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    def number(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")

    base = F.filter("spans", lambda s: s["kind"].isin(*kinds))
    return said.select(
        "doc_id", *[number(k).alias(f"n_{k}") for k in kinds],
        F.sha2(text(base), 256).alias("base_sha256"), text(F.col("spans")).alias("spans"))

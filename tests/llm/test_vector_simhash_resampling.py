"""Vector codes, SimHash and resampling against plain computations; odd rows and empty tables."""

import hashlib
import math
import random
import zlib
from collections import Counter
from fractions import Fraction

import numpy as np
import plain
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from shelfwise.llm import resampling, simhash, store, vector_codes
from shelfwise.llm.grams import windows

SF = "/root/testdata/sf0.001"
NAN, INF = float("nan"), float("inf")
VECTOR_SCHEMA = ("vec_id long, embedding array<float>, label int, id string, vector string, "
                 "code string, slot long, n string")


# --- vector codes ------------------------------------------------------------------------------
def coded(rows, parts=16, entries=64, rounds=2):
    """[(id, code, error, label)], codebooks digest: exact, one vector after the other."""
    kept = [(i, v, lab) for i, v, lab in rows
            if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    longest = max((len(v) for _, v, _ in kept), default=0)
    width = -(-longest // parts)
    ints = [[math.floor(Fraction(x) * 256) for x in v] + [0] * (parts * width - len(v))
            for _, v, _ in kept]
    last = float("inf")
    ids = sorted({last if i is None else i for i, _, _ in kept})[:entries]
    first = [min(v for v, (j, _, _) in zip(ints, kept) if (last if j is None else j) == i)
             for i in ids]
    books = [[v[p * width:(p + 1) * width] for v in first] for p in range(parts)]

    def nearest(p, v):
        far = [sum((a - b) ** 2 for a, b in zip(e, v[p * width:(p + 1) * width])) for e in books[p]]
        return far.index(min(far)), min(far)

    for _ in range(rounds):
        near = [[nearest(p, v)[0] for p in range(parts)] for v in ints]
        for p in range(parts):
            for e in range(len(first)):
                mine = [v[p * width:(p + 1) * width] for v, c in zip(ints, near) if c[p] == e]
                if mine:
                    books[p][e] = [sum(x) // len(mine) for x in zip(*mine)]
    out = []
    for (i, _, lab), v in zip(kept, ints):
        found = [nearest(p, v) for p in range(parts)]
        out.append((i, "".join(f"{e:02x}" for e, _ in found), sum(d for _, d in found), lab))
    flat = [x for book in books for e in book for x in e]
    return out, hashlib.sha256(",".join(map(str, flat)).encode()).hexdigest()


def vectors(spark, rows):
    return spark.createDataFrame([(*r, "i", "v", "c", 5, "n") for r in rows], VECTOR_SCHEMA)


def check_codes(df, rows):
    got = vector_codes.encode(df).collect()
    want, digest = coded(rows)
    of_label = Counter()
    for _, _, error, lab in want:
        of_label[lab] += error
    assert sorted(map(str, [(r.vec_id, r.code, r.error, r.label, r.label_error) for r in got])) == \
        sorted(map(str, [(*w, of_label[w[3]]) for w in want]))
    assert {r.codebooks_sha256 for r in got} == ({digest} if want else set())


def test_codes_of_odd_vectors(spark):
    random.seed(5)
    rows = [(k, [random.gauss(0, 0.2) for _ in range(32)], k % 3 or None) for k in range(90)]
    rows = [(i, np.float32(v).tolist(), lab) for i, v, lab in rows]
    rows += [(200, None, 1), (201, [], 1), (202, [0.5] * 30, 1), (203, [0.1, None] * 16, 2),
             (204, [NAN] * 32, 2), (205, [INF] * 32, None), (206, [-INF] * 32, 1),
             (None, np.float32([0.3] * 32).tolist(), None), (None, [0.25] * 32, 4),
             (207, [0.0] * 32, 1), (208, [-0.0] * 32, 1)]
    rows += [rows[0], rows[0], rows[7], (5, [0.125] * 32, 9)]
    check_codes(vectors(spark, rows).repartition(3), rows)


def test_codes_with_few_ids_ties_and_large_components(spark):
    rows = [(2, [1.0, 3.0] * 8, 1), (1, [3.0, 1.0] * 8, 1), (7, [2.0] * 16, None),
            (8, [1e9, -1e9] * 8, 2), (9, [2.0 ** 42] * 16, 2)]
    check_codes(vectors(spark, rows), rows)
    huge = vector_codes.encode(vectors(spark, [*rows, (10, [3e38, -3e38] * 8, 2)])).collect()
    assert len(huge) == 6 and max(r.error for r in huge) <= 2 ** 63 - 1


def test_codes_of_nothing(spark):
    assert vector_codes.encode(vectors(spark, [])).collect() == []
    assert vector_codes.encode(vectors(spark, [(1, None, 1), (2, [NAN], 2)])).collect() == []
    assert [r.code for r in vector_codes.encode(vectors(spark, [(1, [], 1)])).collect()] == ["00" * 16]


def test_a_label_of_many_vectors_is_summed_whole(spark):
    df = spark.range(3000).select(
        F.col("id").alias("vec_id"), F.transform(F.sequence(F.lit(1), F.lit(16)), lambda k:
            F.sin(k * F.col("id")).cast("float")).alias("embedding"),
        F.when(F.col("id") % 3 > 0, F.lit(1)).alias("label"))
    got = vector_codes.encode(df)
    per = got.groupBy("label").agg(F.sum("error").alias("s"), F.max("label_error").alias("m"),
                                   F.min("label_error").alias("l")).collect()
    assert all(r.s == r.m == r.l for r in per) and len(per) == 2


# --- fingerprints ------------------------------------------------------------------------------
def fingerprint(text):
    ws = plain.words((text or "").translate(plain.LOWER))
    grams = [" ".join(ws[i:i + 3]) for i in range(len(ws) - 2)] or ([" ".join(ws)] if ws else [])
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def linked(rows, radius=2):
    """component_id of each (doc_id, fingerprint) row, by comparing all pairs."""
    parent = list(range(len(rows)))

    def top(k):
        while parent[k] != k:
            k = parent[k]
        return k

    for a in range(len(rows)):
        for b in range(a):
            if (rows[a][1] ^ rows[b][1]).bit_count() <= radius:
                parent[top(a)] = top(b)
    low = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            low[top(k)] = min(low.get(top(k), i), i)
    return [low.get(top(k)) for k in range(len(rows))]


TEXTS = [None, "", " \t\n", "word", "WORD", "two words", "Two\twords\x0b", "a b c d", "a\xa0b c d é",
         "Ünï CÖDÉ text with Ä", "the cat sat on the mat " * 3, "x" * 40_000,
         " ".join(f"w{i % 977}" for i in range(60_000)),
         " ".join(f"w{i % 977}" for i in range(60_000)) + " tail"]


def text_frame(spark, rows):
    return spark.createDataFrame([(*r, "h", 1, "o", "r") for r in rows],
                                 "doc_id long, text string, fp string, n long, component string, "
                                 "`rank` string")


@pytest.fixture(scope="module")
def texts(spark):
    real = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet")
            .select("doc_id", "text").collect()]
    rows = [(1000 + k, t) for k, t in enumerate(TEXTS)] + real
    return rows + [rows[3], rows[3], (None, "word"), (None, None), (1003, "other text here with words"),
                   (-4, real[5][1]), (None, "a lone text without an id, seen once")]


def test_fingerprints_and_components(spark, texts):
    got = simhash.near_duplicates(text_frame(spark, texts).repartition(4)).collect()
    marks = [(i, fingerprint(t)) for i, t in texts]
    want = [(i, f"{fp:016x}", c) for (i, fp), c in zip(marks, linked(marks))]
    assert sorted(map(str, [tuple(r) for r in got])) == sorted(map(str, want))


def test_no_documents_no_fingerprints(spark):
    got = simhash.near_duplicates(text_frame(spark, []))
    assert got.columns == ["doc_id", "fingerprint", "component_id"] and got.collect() == []


@pytest.mark.parametrize("radius", [1, 2, 3])
def test_masks_cover_every_choice_of_places(radius):
    from itertools import combinations

    masks = simhash.covering_masks(radius)
    assert len(masks) == 2 ** (radius + 1) - 1
    kinds = len(masks)  # places alike in all masks repeat after that many
    for n in range(1, radius + 1):
        for places in combinations(range(min(64, 2 * kinds + 1)), n):
            flips = sum(1 << p for p in places)
            assert any(m & flips == 0 for m in masks)


@pytest.mark.parametrize("radius", [1, 2])
@pytest.mark.parametrize("bucket", [1, 3, 64])
def test_links_give_the_components_of_all_pairs(spark, radius, bucket):
    """Chains and clusters, through small buckets and through midpoints alone."""
    from shelfwise.llm.components import components

    rng = random.Random(radius)
    seen = {0, 2 ** 64 - 1, 1 << 63}
    for _ in range(12):
        at = rng.getrandbits(64)
        for _ in range(25):
            seen.add(at)
            for _ in range(rng.choice([1, 1, 2, 2, 3])):
                at ^= 1 << rng.randrange(64)
    rows = [(k, fp) for k, fp in enumerate(sorted(seen))]
    signed = {fp - (1 << 64) if fp >> 63 else fp: k for k, fp in rows}
    distinct = spark.createDataFrame([(s,) for s in signed], "fp long").repartition(3)
    links = simhash.near_links(distinct, radius, bucket)
    for r in links.collect():
        assert ((r.a ^ r.b) & (2 ** 64 - 1)).bit_count() <= 2
    found = {signed[r.node]: signed[r.component] for r in components(links).collect()}
    want = linked(rows, radius)
    groups = {}
    for k, c in enumerate(want):
        groups.setdefault(c, []).append(found.get(k, k))
    assert all(len(set(g)) == 1 for g in groups.values())
    assert len({g[0] for g in groups.values()}) == len(groups)


def test_a_crowded_bucket_gives_rows_in_proportion(spark):
    """4,000 fingerprints that share all bits that some table keeps."""
    ignored = [i for i in range(64) if not simhash.covering_masks()[0] >> i & 1]
    rng = random.Random(3)
    some = {sum(1 << i for i in ignored if rng.random() < 0.5) for _ in range(4000)}
    distinct = spark.createDataFrame([(x - (1 << 64) if x >> 63 else x,) for x in some], "fp long")
    assert simhash.near_links(distinct).count() < 40 * len(some)


# --- windows and tables ------------------------------------------------------------------------
@pytest.mark.parametrize("piece", [1, 7, 50, 1 << 20])
def test_runs_of_words_across_windows(piece):
    table = resampling.TABLE
    rows = ["one two three four", "", "  ", "a", "B-c d_e 9", "x" * 120 + " y z",
            " ".join(map(str, range(60))), "é ü ß ñ"]
    for n in (1, 2, 3):
        got = []
        for w in windows([r.encode() for r in rows], table, n - 1, piece):
            found = [(int(o), w.text[a:b].decode()) for a, b, o in
                     zip(*(x.tolist() for x in w.runs(n)))]
            got += found
        want = []
        for k, r in enumerate(rows):
            ws = r.encode().translate(table).decode().split()
            want += [(k, " ".join(ws[i:i + n])) for i in range(len(ws) - n + 1)]
        assert sorted(got) == sorted(want)


@pytest.mark.parametrize("orders", [(1, 2), (1,), (2, 3)])
@pytest.mark.parametrize("collide", [False, True])
def test_slots_tell_ngrams_apart(orders, collide):
    """Also where all keys of words collide; bytes tell them apart, however long."""
    rng = random.Random(1)
    some = ["a", "b", "ab", "abcdefgh", "abcdefgi", "abcdefghi", "x" * 63 + "y", "x" * 64,
            "x" * 64 + "y", "x" * 64 + "z", "q" * 200, "q" * 199 + "r", "é", "ñandú", "e9"]
    texts = [" ".join(rng.choice(some) for _ in range(rng.randrange(60))) for _ in range(12)]
    digest = (lambda w: 2 ** 64 - 3) if collide else xxhash.xxh64_intdigest
    got, n_words = Counter(), Counter()
    for owner, found in resampling.interned([t.encode() for t in texts], orders, 10_000, digest):
        n_words.update(owner.tolist())
        for bucket, slots, of in found:
            got.update((d, int(b)) for d, b in zip(of.tolist(), bucket[slots].tolist()))
    want = Counter()
    for d, t in enumerate(texts):
        ws = t.split()
        want.update((d, zlib.crc32(" ".join(ws[i:i + n]).encode()) % 10_000)
                    for n in orders for i in range(len(ws) - n + 1))
    assert got == want
    assert n_words == Counter({d: len(t.split()) for d, t in enumerate(texts) if t})


# --- resampling --------------------------------------------------------------------------------
def resampled(rows, target):
    """[(doc_id, n_features, weight, score, rank)] by plain counting."""
    import re

    def features(text):
        ws = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(plain.LOWER))
        grams = ws + [f"{a} {b}" for a, b in zip(ws, ws[1:])]
        return len(ws), [zlib.crc32(g.encode()) % 10_000 for g in grams]

    docs = [(i, *features(t)) for i, t in rows]
    s = Counter(b for _, _, f in docs for b in f)
    t = Counter(b for text in target for b in features(text)[1])
    big_s, big_t = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log(float(t[b] + 1) * float(big_s + 10_000)
                                       / (float(s[b] + 1) * float(big_t + 10_000))))
            for b in range(10_000)]
    out = []
    for i, n, f in docs:
        weight = sum(gain[b] for b in f) // len(f) if f else 0
        h = int(hashlib.sha256(f"7:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([n, i, len(f), weight, score])
    able = sorted((r for r in out if r[0] >= 20),
                  key=lambda r: (-r[4], r[1] is None, r[1] or 0, r[2]))
    k = 25 * len(able) // 100
    ranked = [(*r[1:], n + 1 if n < k else None) for n, r in enumerate(able)]
    return ranked + [(*r[1:], None) for r in out if r[0] < 20]


@pytest.mark.parametrize("target", [["the cat sat on the mat, ünï cödé", None, ""], []])
def test_resampling(spark, texts, target):
    aims = spark.createDataFrame([(k, t) for k, t in enumerate(target)], "item_id long, text string")
    got = resampling.resample(text_frame(spark, texts).repartition(4), aims)
    want = resampled(texts, target)
    rows = got.select("doc_id", "n_features", "weight", "score", "rank").collect()
    assert sorted(str(tuple(r)) for r in rows) == sorted(map(str, want))


def test_resampling_of_nothing(spark):
    aims = spark.createDataFrame([(1, "some text")], "item_id long, text string")
    assert resampling.resample(text_frame(spark, []), aims).collect() == []


def test_equal_rows_get_ranks_of_their_own(spark):
    """Rows alike in everything, without an id, are ranked over several files."""
    text = " ".join(f"w{i}" for i in range(30))
    rows = spark.range(2000).select(F.lit(None).cast("long").alias("doc_id"), F.lit(text).alias("text"))
    aims = spark.createDataFrame([(1, text)], "item_id long, text string")
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = resampling.resample(rows, aims).collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
    assert sorted(r.rank for r in got if r["rank"] is not None) == list(range(1, 501))


def test_resampling_sends_texts_to_python_in_short_batches(spark, monkeypatch):
    """Both passes; not 10,000 texts or Spark's 64 MB at once, and settings are as before."""
    text = "some words " * 10_000
    docs = spark.range(0, 300, 1, 1).select(F.col("id").alias("doc_id"), F.lit(text).alias("text"))
    before = spark.conf.get(store.BATCH_BYTES)

    def counted(orders, buckets):
        def run(batches):
            for k, batch in enumerate(batches):
                yield pa.RecordBatch.from_arrays([pa.array([k]), pa.array([batch.nbytes])], ["bucket", "n"])
        return run

    def weighed(gain, orders, schema):
        def run(batches):
            for batch in batches:
                same = pa.array([batch.nbytes] * batch.num_rows)
                yield pa.RecordBatch.from_arrays([batch.column(0), same, same, same], schema=schema)
        return run
    monkeypatch.setattr(resampling, "_bucket_counts", counted)
    monkeypatch.setattr(resampling, "_weights", weighed)
    sizes = resampling.bucket_counts(docs)
    assert sizes.sum() > 30 << 20 and sizes.max() < 8 << 20
    assert max(r.n_words for r in resampling.resample(docs, docs.limit(1)).collect()) < 8 << 20
    assert spark.conf.get(store.BATCH_BYTES) == before

"""Places where operators once did less than the whole job."""

import random
from collections import Counter
from itertools import combinations

import plain
import pytest
from pyspark.sql import functions as F

from shelfwise.llm import components as components_module
from shelfwise.llm import decontamination, jaccard, mixing, personal, store

ITEM = [f"item{i}" for i in range(13)]


def _changed(at):
    return " ".join("new" if i in at else w for i, w in enumerate(ITEM))


def test_every_pair_of_changed_words_leaves_a_probe():
    places = range(0, decontamination.WINDOW - decontamination.SPAN + 1)
    probes = [{p + i for i in mask} for mask in decontamination.MASKS for p in places]
    assert decontamination.STRIDE == 1
    for pair in combinations(range(decontamination.WINDOW), 2):
        assert any(not probe & set(pair) for probe in probes), pair


def test_two_changed_words_of_13_never_hide_a_copy(spark):
    rows = [(f"{ahead} {a} {b}", "ahead " * ahead + _changed((a, b)) + " behind")
            for ahead in (0, 1, 63, 64) for a, b in combinations(range(13), 2)]
    rows += [("three", _changed((1, 5, 9)))]
    docs = spark.createDataFrame(rows, "doc_id string, text string")
    bench = spark.createDataFrame([(1, " ".join(ITEM))], "item_id long, text string")
    got = decontamination.benchmark_overlaps(docs, bench).collect()
    assert {(r.doc_id, r.doc_word, r.equal_words) for r in got} \
        == {(d, int(d.split()[0]), 11) for d, _ in rows if d != "three"}
    assert {d for d, t in rows if plain.overlaps(t, " ".join(ITEM))} == {r.doc_id for r in got}


@pytest.mark.parametrize("share", [33, 150, 171])
def test_mixed_rows_repeated_at_the_cut(spark, tmp_path, share):
    """Each source comes with the words of its mixture, also where all of its rows are one."""
    rows = [(i, s, t) for s, i, t, n in [
        ("a", 1, "one two three four five six seven", 1000), ("b", None, "some words of b", 77),
        ("b", 5, "others", 3), (None, None, "no source at all", 10)] for _ in range(n)]
    rows += [(k, "c", f"text {k} of c") for k in range(50)] + [(None, "a", None), (None, "b", "")]
    path = str(tmp_path / "documents.parquet")
    spark.createDataFrame(rows, "doc_id long, source string, text string").repartition(5) \
        .write.parquet(path)
    files = spark.read.parquet(path)
    for docs in (files, files.unionAll(files)):
        mixture = mixing.mix(docs, share=share)
        got = Counter((r.source, len(plain.words(r.text)))
                      for r in mixing.mixed_documents(docs, mixture).collect())
        want = Counter()
        for r in mixture.collect():
            want[r.source, r.size] += r.epochs
            want[r.source, r.taken - r.epochs * r.size] += 1
        assert got == Counter({k: n for k, n in want.items() if n and k[1]})


def test_row_numbers_do_not_depend_on_the_scan(spark, tmp_path):
    path = str(tmp_path / "documents.parquet")
    spark.range(5000).selectExpr("id doc_id", "repeat(cast(id as string), 200) text") \
        .repartition(3).write.option("parquet.block.size", 64 * 1024).parquet(path)
    setting = "spark.sql.files.maxPartitionBytes"
    before, seen, parts = spark.conf.get(setting), [], set()
    try:
        for size in ("128m", "50k"):
            spark.conf.set(setting, size)
            docs = store.stored(spark.read.parquet(path))
            rows = store.numbered(docs, "doc_id")
            parts.add(rows.select(F.spark_partition_id()).distinct().count())
            seen.append(sorted(map(tuple, rows.collect())))
    finally:
        spark.conf.set(setting, before)
    assert len(parts) == 2 and seen[0] == seen[1]
    assert len({row for _, row in seen[0]}) == 5000


def test_similar_documents_whatever_cut_each_scan_has(spark, tmp_path, monkeypatch):
    """As if executors came and went: every scan is cut into partitions of another size."""
    texts = [" ".join(f"t{k // 3}w{i}x{k % 3 if i > 55 else 0}" for i in range(60)) for k in range(600)]
    texts += texts[100:400]
    path, setting = str(tmp_path / "documents.parquet"), "spark.sql.files.maxPartitionBytes"
    spark.createDataFrame([((k * 7919) % 10_007, t) for k, t in enumerate(texts)],
                          "doc_id long, text string").repartition(2) \
        .write.option("parquet.block.size", 16 * 1024).parquet(path)
    docs = spark.read.parquet(path)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    before, sizes = spark.conf.get(setting), ["128m", "20k", "7k"]
    write = jaccard.materialise

    def recut():
        spark.conf.set(setting, sizes[0])
        sizes.append(sizes.pop(0))

    def elsewhere(df, purpose):
        recut()
        return write(df, purpose)

    monkeypatch.setattr(jaccard, "materialise", elsewhere)
    try:
        recut()
        found = jaccard.similar_documents(docs)
        got = sorted((r.doc_id, r.n_shingles, r.component_id) for r in found.collect())
        left = jaccard.one_of_each(docs)
        recut()
        ids = sorted(r.doc_id for r in left.collect())
    finally:
        spark.conf.set(setting, before)
    want = plain.components(rows)
    assert got == sorted((d, *w) for (d, _), w in zip(rows, want))
    assert ids == sorted({c for _, c in want})


def _learned(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = personal.digest(personal.find_personal(docs)).collect()
    texts = dict(rows)
    spans = [(r.doc_id, s.split(":")) for r in found for s in r.spans.split(",")]
    return {(d, texts[d][int(s[1]):int(s[2])]) for d, s in spans if s[0] == "learned"}


def test_unknown_instances_are_no_evidence_for_their_own_pattern(spark):
    """As many plain numbers as seeds behind a pattern, then few enough of them."""
    rows = [(i, f"the code is +1 702 555 {1000 + i} here") for i in range(20)]
    rows += [(100 + i, f"the code is {5_000_000 + 37 * i} here") for i in range(20)]
    assert _learned(spark, rows) == set()
    assert _learned(spark, rows[:22]) == {(100, "5000000"), (101, "5000037")}


def test_found_identifiers_lead_to_further_patterns(spark):
    rows = [(i, f"please call me at +1 702 555 {1000 + i} or write") for i in range(400)]
    rows += [(500 + i, f"then call me at 70255{500 + i} and later") for i in range(20)]
    rows += [(600 + i, f"my other line 70255{500 + i} works too") for i in range(20)]
    rows += [(700, "my other line 9911223 works too"), (800, "the page number 9911223 is torn")]
    got = _learned(spark, rows)
    assert got == {(d, t) for d, text in rows if 500 <= d <= 700
                   for t in text.split() if t.isdigit()}


def test_instances_are_whole_identifiers(spark):
    rows = [(i, f"please call me at +1 702 555 {1000 + i} or write") for i in range(60)]
    ends = ["702 555 9999", "(702) 555-9998", "4111 1111 1111 1112", "1234", "@some_name", "AB12 CD34",
            "702 555 9997. 20 people", "702 555 9996\n12 more"]
    rows += [(100 + k, f"now call me at {e} today") for k, e in enumerate(ends)]
    assert _learned(spark, rows) == {
        (100, "702 555 9999"), (101, "702) 555-9998"), (102, "4111 1111 1111 1112"), (103, "1234"),
        (104, "@some_name"), (105, "AB12"), (106, "702 555 9997"), (107, "702 555 9996")}


def test_runs_keep_off_the_spans_of_rules():
    text = "at 10.0.0.1 55 a@b.org 66 77 x@ _ 1_2 @ 88"
    found = list(personal._unknown(text, personal.base_spans(text)))
    assert [text[s:e] for s, e in found] == ["55", "66 77", "x@", "1_2", "88"]


def _windows(a, b):
    """The first window of a that some window of b is like, and the most equal words; or None."""
    counts = [(i, sum(map(str.__eq__, a[i:i + 13], b[j:j + 13])))
              for i in range(len(a) - 12) for j in range(len(b) - 12)]
    like = [c for c in counts if c[1] >= 11]
    return (min(i for i, _ in like), max(n for _, n in like)) if like else None


def test_long_items_are_broadcast_by_their_seeds(spark, monkeypatch):
    """No row carries more than the words around its seed, and blocks share one long item."""
    words = [f"b{i}" for i in range(1500)]
    bench = spark.createDataFrame([(1, " ".join(words)), (1, " ".join(words)), (2, " ".join(words[:40]))],
                                  "item_id long, text string")
    rows = [(k, " ".join(["x"] * (k % 70) + words[k:k + 13])) for k in (0, 27, 28, 63, 64, 65, 130, 1487)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    sent = []
    monkeypatch.setattr(decontamination.F, "broadcast",
                        lambda df, whole=F.broadcast: sent.append(df) or whole(df))
    got = decontamination.benchmark_overlaps(docs, bench, 150).collect()
    want = [(k, i, *found) for k, t in rows for i, item in ((1, words), (2, words[:40]))
            if (found := _windows(t.split(), item))]
    assert sorted((r.doc_id, r.item_id, r.doc_word, r.equal_words) for r in got) == sorted(want)
    sizes = [df.select("_item").agg(F.count("_item"), F.max(F.size("_item"))).first() for df in sent]
    assert len(sizes) > 5 and max(n for n, _ in sizes) < 2 * 300
    assert max(w for _, w in sizes) <= 16


def test_the_second_search_goes_over_components(spark, tmp_path, monkeypatch):
    """Links found late join components found before; equal and near rows are not gone over again,
    and a search writes its links and a table a round."""
    rng = random.Random(1)
    base = [f"w{k}" for k in range(150)]
    # Each with five of seven changes: unlike the original, like those that share four.
    copies = [[f"x{k}" if k in {10 + 18 * j for j in five} else w for k, w in enumerate(base)]
              for five in combinations(range(7), 5)]
    texts = [" ".join(t) for t in [*[base] * 3, *copies]]
    rows = list(enumerate(texts))
    rng.shuffle(rows)
    path = str(tmp_path / "d")
    spark.createDataFrame(rows, "doc_id long, text string").repartition(3).write.parquet(path)
    searches, tables = [], []
    real, write = jaccard.components, components_module.materialise

    def search(links):
        searches.append([(r.a, r.b) for r in links.collect()])
        return real(links)

    def written(df, purpose):
        tables.append(purpose)
        return write(df, purpose)
    monkeypatch.setattr(jaccard, "components", search)
    monkeypatch.setattr(components_module, "materialise", written)
    got = jaccard.similar_documents(spark.read.parquet(path)).collect()
    assert {(r.doc_id, r.component_id) for r in got} \
        == {(d, c) for (d, _), (_, c) in zip(rows, plain.components(rows))}
    first, second = searches
    into = {}
    for a, b in first:
        into.setdefault(a, a), into.setdefault(b, b)
    for _ in into:
        for a, b in first:
            into[a] = into[b] = min(into[a], into[b])
    assert second and not set(first) & set(second)
    assert all(into.get(a, a) == a and into.get(b, b) == b and a != b for a, b in second)
    assert tables[0] == "edges" and tables.count("edges") == 2 and set(tables[1:]) <= {"edges", "labels"}
    assert tables.count("labels") <= 8

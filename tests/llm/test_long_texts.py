"""Operators whose work once grew with the square of a text, and bounded samples."""

import math
import random
import re
import time

import pytest

from shelfwise.llm import personal, secrets_scan, toxicity

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
MB = 1 << 20


@pytest.mark.parametrize("text", [
    "1" * MB, "a" * MB + "@", "a" * MB + "@b", "a@" * (MB // 2), "1." * (MB // 2),
    "+1" + "(" * MB, "! " * (MB // 2) + "x y 5", "!" * MB + "a 5 !" + "!" * MB, "5 " * (MB // 2),
    "a b 1-" * (MB // 6)], ids=lambda t: t[:8])
def test_long_runs_take_seconds(text):
    start = time.process_time()
    spans = personal.base_spans(text)
    for s, e in list(personal._unknown(text, spans)):
        personal._pattern(text, s)
    assert time.process_time() - start < 20


def test_spans_are_those_of_the_plain_patterns():
    rng = random.Random(8)
    for _ in range(4000):
        text = "".join(rng.choice("ab1.9@-+% ,é") for _ in range(rng.randrange(40)))
        spans = personal.base_spans(text)
        assert [(s, e) for s, k, e in spans if k == 0] == [m.span() for m in EMAIL.finditer(text)]
        want = [m.span() for m in IP.finditer(text)
                if all(int(p) <= 255 for p in m.group().split("."))]
        assert [(s, e) for s, k, e in spans if k == 1] == want


def test_patterns_reach_over_long_words_and_signs():
    word = "w" * 500
    assert personal._pattern(f"call {word} 5", 6 + len(word)) == personal._name(f"call {word}")
    far = "call  me" + " - " * 300 + "5"
    assert personal._pattern(far, len(far) - 1) == "call me"
    assert personal._pattern("one 5", 4) is None


def test_rounds_go_on_until_nothing_is_new(spark):
    """Each pattern is sure only through what the one before it found: five rounds."""
    rows = [("p0", f"x{i}", True) for i in range(20)]
    for k in range(5):
        rows += [(f"p{k}", f"y{k}-{i}", False) for i in range(3)]
        rows += [(f"p{k + 1}", f"y{k}-{i}", False) for i in range(3)]
        rows += [(f"p{k + 1}", f"x{i}", True) for i in range(2)] + [
            (f"p{k + 1}", f"s{k}-{i}", True) for i in range(14 if k < 4 else 20)]
    rows += [("never", f"n{i}", False) for i in range(30)]
    edges = spark.createDataFrame(rows, "pattern string, instance string, seed boolean")
    got = {r[0] for r in personal.sure_patterns(edges, min_seeds=5).collect()}
    first = {r[0] for r in personal.sure_patterns(edges, rounds=1, min_seeds=5).collect()}
    assert first <= got == {f"p{k}" for k in range(6)}


def test_a_hundred_thousand_secrets_in_a_text(spark):
    one = "token=abcdef{:06d} "
    many = "".join(one.format(i) for i in range(100_000))
    docs = spark.createDataFrame([(1, many), (2, "x " + one.format(7)), (3, "nothing"), (4, None),
                                  (5, one.format(1) * 10 + "AKIA" + "Q" * 20)],
                                 "doc_id long, text string")
    start = time.time()
    got = {r.doc_id: r.spans for r in secrets_scan.scan_secrets(docs).collect()}
    assert time.time() - start < 60
    assert [(s.start, s.end) for s in got[1]] == [(19 * i, 19 * i + 18) for i in range(100_000)]
    assert [(s.start, s.end) for s in got[2]] == [(2, 20)] and not got[3] and not got[4]
    assert [(s.kind, s.start) for s in got[5]] == [("assign", 19 * i) for i in range(10)] + [
        ("access", 190)]


def test_the_ledger_scans_only_what_it_has_not_seen(spark, tmp_path, monkeypatch):
    """Three deliveries of overlapping versions, then new rules."""
    ledger = str(tmp_path / "ledger")
    scanned = []
    real = secrets_scan.scan_blobs

    def counting(blobs, rules):
        scanned.append(sorted(r[0] for r in blobs.select("text").collect()))
        return real(blobs, rules)

    monkeypatch.setattr(secrets_scan, "scan_blobs", counting)
    for texts in (["a token=abcdef1", "b"], ["b", "c token=abcdef2", "c token=abcdef2"], ["b"]):
        docs = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "doc_id long, text string")
        found = {r.doc_id: r.spans for r in secrets_scan.scan_secrets(docs, ledger).collect()}
        assert [bool(found[k]) for k in range(len(texts))] == ["token" in t for t in texts]
    assert scanned == [["a token=abcdef1", "b"], ["c token=abcdef2"], []]
    secrets_scan.scan_secrets(docs, ledger, version="2").collect()
    assert scanned[-1] == ["b"]


def test_an_id_that_many_rows_repeat_brings_one_text(spark):
    rows = [(k, f"text number {k} " + ("vile slur" if k % 2 else "kind word")) for k in range(60)]
    rows += [(1, "a vile slur again")] * 500
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(k, k % 2) for k in range(60)], "doc_id long, toxic int")
    seen = []
    real = toxicity.Model

    class Counted(real):
        def __init__(self, texts, *args):
            seen.append(len(texts))
            super().__init__(texts, *args)

    toxicity.Model = Counted
    try:
        assert toxicity.train(docs, labels) is not None
    finally:
        toxicity.Model = real
    assert seen[0] <= 60


def test_ratios_of_grams_are_those_of_plain_counts():
    texts = ["abc abd", "abc xyz", "xyz xyw", "qrs xyw", "abc", "xyz"]
    toxic = [1, 1, 0, 0, 1, 0]
    import numpy as np
    model = toxicity.Model(texts * 3, np.array(toxic * 3), 0.5)
    from shelfwise.llm.samples import gram_codes
    has = [set(gram_codes(t, toxicity.ORDERS).tolist()) for t in texts * 3]
    for code in model.grams.tolist():
        p = sum(code in g for g, t in zip(has, toxic * 3) if t)
        n = sum(code in g for g, t in zip(has, toxic * 3) if not t)
        assert (p + 0.5) / 10 != (n + 0.5) / 10  # only grams that tell the labels apart
    place = model.places()
    assert model.score("abc abd", place) > 0.5 > model.score("xyz xyw", place)


def test_the_kernel_is_the_count_of_shared_grams():
    from shelfwise.llm import language
    from shelfwise.llm.samples import Presence, gram_codes
    texts = ["the cat sat", "a dog ran", "der hund lief", "die katze", "le chat", "un chien"]
    model = language.Model(texts, ["en", "en", "de", "de", "fr", "fr"], landmarks=1)
    sets = [set(gram_codes(t, language.ORDERS).tolist()) for t in texts]
    some = [*texts, "the dog und le chat", "", "zzz"]
    got = model.kernel(some, Presence(model.vocabulary, language.ORDERS))
    marks = [sets[2], sets[0], sets[4]]  # the first text of de, en and fr
    for row, text in zip(got, some):
        own = set(gram_codes(text, language.ORDERS).tolist())
        want = [len(own & m) / math.sqrt(max(1, len(own)) * len(m)) for m in marks]
        assert all(abs(g - w) < 1e-5 for g, w in zip(row.tolist(), want))

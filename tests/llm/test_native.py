"""The two operators that run on DataFrame functions only."""

import random

import pytest

from prospectra.llm import pii, quality
from pyspark.sql import functions as F

from . import brute

ODD = [
    None, "", " ", "\n\n", "one", "a b", "a b c a b c a b c", "x\x0by\x0cz w\tq\r\n", "  lead and trail \n", "line one\nline one\n \nline two\n",
    "mail a@b.c@d.e and a@b.c-x_y@d.e, x.y%z+1@ex-1.co.uk. end@nodot", "1.2.3.4.5.6.7.8 999.1.1.1 0001.2.3.004 1.2.3 256.1.1.1.1",
    "4111 1111 1111 1111 4111-1111-1111-1112 00000000000000 41894974608795", "+1 (234) 567-8901 + 12 +12345 +49.30.1234567-8 +1234567890123456",
    "é4111111111111111é +12345678901é", "1" * 5000, "a" * 5000 + "@", "1 " * 3000, "+1" + " " * 3000, "a@b.co " * 700, "🙂 a@b.co 🙂 +1 2345678901",
]


def noise(rng):
    bits = ["a@b.co", "1.2.3.4", "+1 234 567 8901", "4111 1111 1111 1111", " ", "\n", "the", "of", "THE!!", ".", "-", "@", "+", "9", "é", "word", "x.y", "300."]
    return "".join(rng.choice(bits) for _ in range(rng.randrange(60)))


@pytest.fixture(scope="module")
def odd(spark):
    rng = random.Random(5)
    return spark.createDataFrame(list(enumerate(ODD + ODD[:3] + [noise(rng) for _ in range(400)])), "doc_id long, text string").withColumn("kept", F.lit("mine"))


def test_base_spans(spark, odd):
    out = pii.sanitise(odd.repartition(4)).collect()
    assert len(out) == odd.count() and "kept" in out[0]
    for r in out:
        counts, _, joined = brute.pii(r.text)
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == counts, r.text
        assert ",".join(f"{s.kind}:{s.start}:{s.stop}" for s in r.base_spans) == joined


def test_disclosing_terms(spark, odd):
    """Terms, their spans, clean texts and op7's own columns against the plain version."""
    rng = random.Random(8)
    common = [f"word{c}" for c in "abcdefghijklmnopqrst"]
    line = lambda n: " ".join(rng.choice(common) for _ in range(n))
    rows = [line(30) for _ in range(300)]
    rows += [f"{line(4)} Secretname {rng.choice(common)} anna@mail.example {line(20)}" for _ in range(6)]
    rows += [f"{line(5)} Öffentlich u{i}@mail.example {line(20)} öffentlich" for i in range(30)]
    rows += [f"{line(3)} copied Rareword beside same@mail.example {line(2)}"] * 5
    rows += [f"office@mail.example {line(20)} Lateword other@mail.example", "1.2.3.4 onlyhere " + line(30) + " ONLYHERE"] + [r.text or "" for r in odd.limit(40).collect()]
    df = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string").withColumn("kept", F.lit("mine")).repartition(4)
    want = brute.sanitised(rows)
    got = {r.doc_id: r for r in pii.sanitise(df).collect()}
    assert len(got) == len(rows)
    for i, (spans, clean) in enumerate(want):
        assert [(s.start, s.stop, s.kind) for s in got[i].term_spans] == spans and got[i].n_term == len(spans), rows[i]
        assert got[i].clean_text == clean and got[i].kept == "mine"
    assert all("ecretname" not in got[i].clean_text and "[TERM]" not in got[i].clean_text for i in range(300, 306))  # six of six: removed
    assert all("ffentlich" in got[i].clean_text for i in range(306, 336))  # beside thirty different values
    assert "[TERM] [TERM] [TERM] [EMAIL]" in got[336].clean_text  # five copies count once
    assert got[342].clean_text.endswith("[TERM]") and got[3].clean_text == rows[3]


def test_query_columns(spark):
    from prospectra.llm import queries

    sf_dir = "/root/testdata/sf0.001"
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    order = [*brute.KINDS, "term", "drop"]
    terms = dict(zip(docs, brute.sanitised(list(docs.values())), strict=True))
    found = queries.op7_information_sanitisation(spark, sf_dir).collect()
    assert len(found) == len(docs)
    for r in found:
        counts, digest, _ = brute.pii(docs[r.doc_id])
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == counts and r.base_sha256 == digest
        spans = sorted([(a, order.index(k), b, k) for a, _, b, k, _ in brute.base_spans(docs[r.doc_id])] + [(a, order.index(k), b, "term") for a, b, k in terms[r.doc_id][0]])
        assert r.spans == ",".join(f"{k}:{a}:{b}" for a, _, b, k in spans)
    assert sum(r.n_term for r in found) > 0


def test_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert pii.sanitise(none).count() == 0
    assert quality.judge(quality.measure(none)).count() == 0


def test_measures(spark, odd):
    for r in quality.judge(quality.measure(odd)).collect():
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == brute.quality(r.text), r.text


def test_weak_supervision_beats_single_rules(spark):
    good = " ".join(f"some words{i} here." for i in range(60))
    bad = " ".join("THE!! OF### AND%%%" for _ in range(60)) + "".join(f" w{i}!" for i in range(200))
    rows = [(i, good + f" tail{i}") for i in range(80)] + [(100 + i, bad + f" T{i}") for i in range(20)]
    kept = {r.doc_id: r.kept for r in quality.judge(quality.measure(spark.createDataFrame(rows, "doc_id long, text string"))).collect()}
    assert all(kept[i] for i in range(80)) and not any(kept[100 + i] for i in range(20))

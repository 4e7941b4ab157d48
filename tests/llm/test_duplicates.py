"""Near-duplicates, repeated passages and the pipeline against plain versions."""

import math
import random
import re
from hashlib import md5

import pytest

from prospectra.llm import near_duplicates, sentence_spans
from pyspark.sql import functions as F

from . import brute


def near_docs():
    rng = random.Random(7)
    words = [f"w{i}" for i in range(300)]
    base = [rng.choice(words) for _ in range(120)]
    out = [None, "", " \n", "one", "One", "ONE two", "one two", "a b c", "A B C"]
    for _ in range(60):  # a chain of copies, each a few words from another
        copy = base[:]
        for _ in range(rng.randrange(5)):
            copy[rng.randrange(len(copy))] = rng.choice(words)
        out += [" ".join(copy)] * rng.choice([1, 1, 1, 3])
        if rng.random() < 0.3:
            base = copy
    out += [" ".join(rng.choice(words) for _ in range(rng.randrange(1, 200))) for _ in range(60)]
    passage = " ".join(rng.choice(words) for _ in range(60))
    out += [passage + " " + " ".join(rng.choice(words) for _ in range(30)) for _ in range(40)]
    return out + ["x " * 5000, "x " * 5000 + "y"]


@pytest.mark.parametrize("k, percent", [(3, 85), (5, 80)])
def test_components(spark, k, percent):
    docs = list(enumerate(near_docs(), 100))
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumnRenamed("doc_id", "doc_id").repartition(6)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_duplicates.near_duplicates(df, k, percent).collect()}
    assert got == brute.near_components(docs, k, percent)
    kept = {r.doc_id for r in near_duplicates.keep_one_of_each(df, k, percent).collect()}
    assert kept == {d for d, (_, c) in got.items() if c == d}


def test_repeated_and_missing_ids(spark):
    rows = [(5, "a b c d e"), (5, "a b c d e"), (3, "a b c d e"), (None, "a b c d e"), (None, "else where now"), (5, "q r s"), (8, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS class_id", "2 AS n_shingles")
    got = sorted(((r.doc_id, r.component_id, r.kept) for r in near_duplicates.near_duplicates(df, 3, 85).collect()), key=str)
    assert got == sorted([(5, 3, False), (5, 3, False), (3, 3, True), (None, 3, False), (None, None, True), (5, 5, True), (8, 8, True)], key=str)
    assert near_duplicates.near_duplicates(df.limit(0), 3, 85).count() == 0


def test_components_of_a_path(spark):
    n = 40
    rng = random.Random(1)
    names = rng.sample(range(1000), n)
    edges = spark.createDataFrame([(names[i], names[i + 1]) for i in range(n - 1)], "a long, b long")
    assert {r.label for r in near_duplicates.components(edges).collect()} == {min(names)}


def test_bands():
    for t in (0.8, 0.85, 0.9):
        rows, bands = near_duplicates.bands_for(t)
        assert (1 - t**rows) ** bands <= 1e-8 and bands <= 48


def plain_pieces(text):
    """Sentences, long ones cut behind chosen words; written apart from the operator."""
    letter = sentence_spans.DENSE
    out = []
    for sentence in re.split(f"(?<=\n)|(?<=[.!?][ \t])|(?<=[。！？])", text):
        words = len(sentence.strip(" \t\r\n").split(" ")) + len(re.findall(f"[{letter}]", sentence))
        if words <= 16:
            out.append(sentence)
            continue
        piece = ""
        for token in re.findall(f"[ \t\r\n]*(?:[{letter}]|[^ \t\r\n{letter}]+)[ \t\r\n]*|[ \t\r\n]+", sentence):
            piece += token
            if md5(token.strip(" \t\r\n").encode()).hexdigest()[0] in "012":
                out.append(piece)
                piece = ""
        out.append(piece)
    return [x for x in out if x]


def brute_spans(docs, span=3, words=12):
    """{(id, text): new text} for distinct rows."""
    cut, first, runs = {}, {}, []
    for key in sorted(set(docs), key=lambda r: (r[0] is not None, r[0])):
        pieces = plain_pieces(key[1] or "")
        filled = [(i, p.strip(" \t\r\n")) for i, p in enumerate(pieces) if p.strip(" \t\r\n")]
        cut[key] = (pieces, filled)
        for j in range(len(filled)):
            e, weigh = j, 0
            while e < len(filled) and (e < j + span or weigh < words):
                weigh += len(filled[e][1].split(" ")) + len(re.findall(f"[{sentence_spans.DENSE}]", filled[e][1]))
                e += 1
            if e < j + span or weigh < words:
                continue
            run = tuple(s for _, s in filled[j:e])
            if run in first:
                runs.append((key, filled[j][0], filled[e - 1][0]))
            else:
                first[run] = (key, j)
    gone = {}
    for key, a, b in runs:
        gone.setdefault(key, set()).update(range(a, b + 1))
    return {key: key[1] if key not in gone else "".join(p for i, p in enumerate(cut[key][0]) if i not in gone[key]) for key in cut}


def test_repeated_spans(spark):
    rng = random.Random(9)
    sentence = lambda: " ".join(rng.choice("abcdefgh") for _ in range(rng.randrange(1, 8))) + rng.choice([". ", "! ", "?\n", "\n", " . "])
    passage = "This whole passage stands here as it is, in many other places too. It has many words in every one of its clauses! Does it repeat itself now and then? It does so here and there, over and over and over again. "
    docs = [(i, "".join(sentence() for _ in range(rng.randrange(12)))) for i in range(80)]
    docs += [(100 + i, f"own {i} start. " + passage + f"own {i} end.") for i in range(10)] + [(200, None), (201, ""), (202, "\n\n"), (203, "a. a. a. a. a. a.")]
    df = spark.createDataFrame(docs + docs[:4], "doc_id long, text string").selectExpr("*", "'x' AS n_removed", "'y' AS j").repartition(5)
    want = brute_spans(docs)
    rows = sentence_spans.remove_repeated_spans(df).collect()
    assert len(rows) == len(docs) + 4
    by_id = dict(docs)
    for r in rows:
        assert r.text == want[(r.doc_id, by_id[r.doc_id])] and r.j == "y"
    assert {r.doc_id: r.text for r in rows}[105] == "own 5 start. own 5 end."
    assert sentence_spans.remove_repeated_spans(df.limit(0)).count() == 0


def brute_quality(docs):
    from prospectra.llm import quality

    votes = {}
    for d, t in docs:
        n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, failed = brute.quality(t)
        have = dict(n_words=n_words, word_chars=word_chars, n_symbols=n_symbols, n_dup_lines=n_dup_lines, n_repeat_words=n_repeat_words)
        have |= dict(n_lines=sum(bool(brute.WORD.search(x)) for x in t.split("\n")), n_capitals=len(re.findall("[A-ZÀ-ÖØ-Þ]", t)), n_marks=len(re.findall("[.!?]", t)))
        rule = lambda sql: eval(re.sub(r"(\w+) BETWEEN (.+?) AND (.+)", r"(\2) <= \1 <= (\3)", sql).replace(" OR ", " or ").replace("D *", " *"), {}, have)
        votes[d] = (tuple(-1 if rule(bad) else 1 if rule(good) else 0 for bad, good in quality.RULES.values()), failed)
    counts = {}
    for v, _ in votes.values():
        counts[v] = counts.get(v, 0) + 1
    post = {v: 1 / (1 + math.exp(2 * v.count(-1) - 2)) for v in counts}
    for _ in range(quality.ITERATIONS):
        rate = lambda first, hit, share: min(0.99, max(0.01, (2 * first + sum(n * share(v) for v, n in counts.items() if hit(v))) / (2 + sum(n * share(v) for v, n in counts.items() if v[r]))))
        rates = []
        for r in range(len(quality.RULES)):
            g = rate(quality.FIRST_GOOD, lambda v: v[r] == 1, lambda v: post[v])
            b = rate(quality.FIRST_BAD, lambda v: v[r] == -1, lambda v: 1 - post[v])
            rates.append((g, max(b, 1 - g)))
        prior = min(0.95, max(0.05, (1 + sum(n * post[v] for v, n in counts.items())) / (2 + sum(counts.values()))))
        post = {v: 1 / (1 + math.exp(-(math.log(prior / (1 - prior)) + sum(math.log(g / (1 - b)) if x == 1 else math.log((1 - g) / b) if x else 0 for x, (g, b) in zip(v, rates))))) for v in counts}
    return [(d, t) for d, t in docs if not votes[d][1] and post[votes[d][0]] >= 0.25]


def test_pipeline(spark):
    import corpus_pipeline
    import public_tokenizers
    from tokenizers import Tokenizer

    sf_dir = "/root/testdata/sf0.001"
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    docs = brute_quality(docs)
    docs = [(d, t) for (d, t), (_, (_, c)) in zip(docs, brute.near_components(docs, 5, 80).items(), strict=True) if c == d]
    docs = [(d, t) for (d, _), t in brute_spans(docs).items()]
    clean = {d: c for (d, _), (_, c) in zip(docs, brute.sanitised([t for _, t in docs]), strict=True)}
    tokenizer = Tokenizer.from_file(public_tokenizers.path(corpus_pipeline.TOKENIZER))
    want = {d: [*tokenizer.encode(t, add_special_tokens=False).ids, 0] for d, t in clean.items()}
    got = {}
    for r in corpus_pipeline.run(spark, sf_dir).collect():
        got.setdefault(r.doc_id, []).append((r.start, r.length, r.ids_crc32))
    assert got.keys() == want.keys() and len(got) > 100
    for d, pieces in got.items():
        assert sorted(pieces) == [(s, n, brute.crc(want[d][s : s + n])) for s, n, _ in sorted(pieces)]
        assert sum(n for _, n, _ in pieces) == len(want[d])


def test_passages_without_sentences(spark):
    """Repeated passages of over 50 words whose sentences are short, endless or of a script without spaces."""
    rng = random.Random(4)
    shout = "".join(f"SHOUT{i}!! " for i in range(70))
    han = "".join(chr(rng.randrange(0x4E00, 0x9F00)) for _ in range(90))
    flow = " ".join(f"flow{i}" for i in range(60))
    own = lambda i: " ".join(f"own{i}x{k}" for k in range(8))
    docs = [(n * 10 + i, f"{own(n * 10 + i)} {p} {own(n * 10 + i)} end") for n, p in enumerate([shout, han, flow]) for i in range(3)]
    docs += [(100, " ".join(f"alone{i}" for i in range(90))), (101, "Yes. No. Fine."), (102, "Yes. No. Fine."), (103, None), (104, "")]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    got = {r.doc_id: (r.text, r.n_removed) for r in sentence_spans.remove_repeated_spans(df).collect()}
    assert {d: t for d, (t, _) in got.items()} == {d: t for (d, _), t in brute_spans(docs).items()}
    for d, t in docs:
        if d >= 100 or d % 10 == 0:
            assert got[d] == (t, 0)
        else:
            # words that the two own texts say twice may go as well; of the passage its ragged ends may stay
            assert got[d][1] > 0 and len(re.findall("SHOUT|[一-鿿]|flow", got[d][0])) <= 20


def test_stages_handle_odd_rows(spark):
    """Null and empty texts, repeated rows, an empty table, and columns named like the operators' results."""
    import corpus_pipeline

    good = " ".join(f"some words{i} stand{i} here{i}." for i in range(60))
    rows = [(1, good), (1, good), (2, None), (3, ""), (4, good + " write to a@b.co soon."), (None, good.replace("some", "other")), (5, "short")]
    names = ["kept", "votes", "posterior", "n_words", "n_email", "clean_text", "_key", "_text", "n_removed", "n_term", "class_id", "label", "id"]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({n: F.lit(f"own {n}") for n in names}).withColumn("n_chars", F.length("text"))
    sizes = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, "")
        assert out.schema.simpleString() == docs.schema.simpleString(), name
        got = out.collect()
        sizes[name] = len(got)
        assert all(r[n] == f"own {n}" for r in got for n in names), name
        assert all(r.n_chars == (None if r.text is None else len(r.text)) for r in got)
        assert stage(spark, docs.limit(0), "").count() == 0
    assert sizes == {"quality rules": 4, "near-duplicates": 5, "substring dedup": 7, "personal data": 7}
    assert corpus_pipeline.packing_stage(spark, docs, "").select("doc_id").distinct().count() == 6
    assert corpus_pipeline.packing_stage(spark, docs.limit(0), "").count() == 0

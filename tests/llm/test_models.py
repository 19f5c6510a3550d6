"""Language, quality and toxicity models against plain versions and held-out labels."""

from __future__ import annotations

import itertools
import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from common import LONG, ODD, documents
from pyspark.sql import functions as F

from qualityforge.llm import crf_quality, kn_language, queries, toxicity
from qualityforge.llm import kernel as K

BASE = "/root/testdata/sf0.01"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def slice_of(texts):
    (s,) = K.slices(pa.array(texts, pa.string()))
    return s


# Quality


def counts_plain(text):
    text = text or ""
    words = WORD.findall(text)
    lines = [line for line in text.split("\n") if WORD.search(line)]
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    times = Counter(windows)
    covered = {j for i, w in enumerate(windows) if times[w] > 1 for j in range(i, i + 5)}
    return (
        len(words),
        sum(map(len, words)),
        sum(c in "#*$%&|<>" for c in text),
        len(lines) - len(set(lines)),
        len(covered),
    )


def random_text(rng):
    alphabet = ["a", "b", "é", "漢", "#", "|", " ", " ", "  ", "\n", "\t", "\r\n", "\x0b", "\x1f", " ", "one two three four five six "]
    return "".join(rng.choice(alphabet) for _ in range(rng.randrange(0, 60)))


def test_counts_equal_plain_counts():
    rng = random.Random(1)
    texts = [None, "", " ", "\n", LONG] + [random_text(rng) for _ in range(300)]
    got = []
    for s in K.slices(pa.array(texts, pa.string()), 3000):
        counts, _ = crf_quality.analyse(s)
        got += list(zip(*(counts[c].tolist() for c in crf_quality.COUNTS)))
    assert got == [counts_plain(t) for t in texts]


def chain(rng, sizes):
    doc = np.repeat(np.arange(len(sizes)), sizes)
    model = crf_quality.Model(rng.normal(size=crf_quality.FEATURES), float(rng.normal()), rng.normal(size=(2, 2)))
    return model, crf_quality.Lines(doc, np.ones(len(doc)), rng.normal(size=(len(doc), crf_quality.FEATURES)))


def path_score(model, features, path):
    total = model.start * path[0]
    total += sum((features[i] @ model.emission) * y for i, y in enumerate(path))
    return total + sum(model.change[a, b] for a, b in zip(path, path[1:]))


def test_viterbi_and_marginals_equal_all_paths():
    model, lines = chain(np.random.default_rng(2), [1, 4, 0, 6, 3])
    found = crf_quality.viterbi(model, lines)
    content, pairs, _ = crf_quality._expected(model, lines.features, crf_quality._Chains(lines.doc))
    every = np.zeros((2, 2))
    for d in np.unique(lines.doc):
        at = np.flatnonzero(lines.doc == d)
        paths = list(itertools.product((0, 1), repeat=len(at)))
        scores = np.array([path_score(model, lines.features[at], p) for p in paths])
        assert found[at].astype(int).tolist() == list(paths[scores.argmax()])
        weight = np.exp(scores - scores.max()) / np.exp(scores - scores.max()).sum()
        np.testing.assert_allclose(content[at], weight @ np.array(paths), atol=1e-9)
        for p, w in zip(paths, weight):
            for a, b in zip(p, p[1:]):
                every[a, b] += w
    np.testing.assert_allclose(pairs, every, atol=1e-9)


def test_quality_keeps_good_and_drops_bad_documents(spark):
    docs, labels = spark.read.parquet(f"{BASE}/documents.parquet"), spark.read.parquet(f"{BASE}/labels.parquet")
    judged = queries.quality_rules(spark, BASE).join(labels, "doc_id").filter("not base_failed")
    share = {r.quality: r.share for r in judged.groupBy("quality").agg(F.avg(F.col("kept").cast("int")).alias("share")).collect()}
    assert share[1] > 0.99 and share[0] < 0.2
    model = crf_quality.train(docs, labels)
    kept = crf_quality.keep_good(docs, model)
    assert kept.schema == docs.schema
    assert kept.count() == crf_quality.judge(docs, model).filter("kept").count()


def test_quality_with_odd_rows(spark):
    labels = spark.createDataFrame([(5, 1), (6, 0), (7, None), (None, 1)], "doc_id bigint, quality int")
    docs = documents(spark, ODD)
    got = crf_quality.judge(docs, crf_quality.train(docs, labels)).collect()
    assert len(got) == len(ODD)
    want = Counter((i, *counts_plain(t)) for i, t in ODD)
    assert Counter((r.doc_id, *(r[c] for c in crf_quality.COUNTS)) for r in got) == want
    none = documents(spark, [])
    assert crf_quality.judge(none, crf_quality.train(none, labels)).count() == 0


# Languages


def kneser_ney(counts):
    """Interpolated Kneser-Ney over 4-grams and openings, by definition."""
    tables = {kn_language.ORDER: {g: c for g, c in counts.items() if len(g) == kn_language.ORDER}}
    for n in range(kn_language.ORDER - 1, 0, -1):
        table = defaultdict(int)
        for g in tables[n + 1]:
            table[g[1:]] += 1
        if n > 1:
            table.update({g: c for g, c in counts.items() if len(g) == n})
        tables[n] = dict(table)

    def prob(g):
        if not g:
            return kn_language._UNKNOWN
        table = tables[len(g)]
        ones, twos = (sum(c == k for c in table.values()) for k in (1, 2))
        discount = ones / (ones + 2 * twos) if ones and twos else 0.75
        same = [c for h, c in table.items() if h[:-1] == g[:-1]]
        if not same:
            return prob(g[1:])
        return max(table.get(g, 0) - discount, 0) / sum(same) + discount * len(same) / sum(same) * prob(g[1:])

    return prob


def test_models_equal_the_definition():
    words = {"en": Counter({b"the": 9, b"then": 4, b"he": 5, b"hen,": 1, b"not7then": 2}), "fr": Counter({"été".encode(): 6, b"le": 8, b"ete": 1, b"tele": 3})}
    rows, plain = {}, {}
    for lang, bag in words.items():
        rows[lang] = kn_language.count_grams(list(bag), np.array(list(bag.values())))
        grams = Counter()
        for w, c in bag.items():
            for run in kn_language.letter_runs(w):
                marked = "\x01" + run + "\x02"
                for end in range(1, len(marked)):
                    for n in range(2, kn_language.ORDER + 1):
                        if end + 1 >= n and (n == kn_language.ORDER or end + 1 == n):
                            grams[marked[end + 1 - n : end + 1]] += c
        plain[lang] = kneser_ney(grams)
    model = kn_language.build(rows)
    tests = [b"the", b"hen", "tété".encode(), b"xyz", b"The,then!", b"123", b""]
    got = kn_language.word_scores(model, tests)
    for i, w in enumerate(tests):
        total = {lang: 0.0 for lang in model.langs}
        size = 0
        for run in kn_language.letter_runs(w):
            marked = "\x01" + run + "\x02"
            for end in range(1, len(marked)):
                size += 1
                for lang in total:
                    total[lang] += math.log(plain[lang](marked[max(0, end + 1 - kn_language.ORDER) : end + 1]))
        np.testing.assert_allclose(got[i], [total[lang] for lang in model.langs] + [size], rtol=1e-4)


def test_held_out_languages_are_found(spark):
    docs = spark.read.parquet(f"{BASE}/documents.parquet").select("doc_id", "lang")
    got = queries.language_id(spark, BASE).join(docs, "doc_id").filter("held_out")
    right, n = got.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int")), F.count("*")).first()
    assert n > 100 and right > 0.98
    assert got.filter("score < 0 or score > 1").count() == 0


def test_languages_with_odd_rows(spark):
    docs = documents(spark, ODD + [(20 + i, "die Katze und der Hund") for i in range(5)])
    docs = docs.withColumn("lang", F.when(F.col("doc_id") >= 20, "de").otherwise(F.col("lang")))
    everything = F.lit(True)
    model = kn_language.train(docs, "doc_id", "text", "lang", everything, everything)
    got = [(r.doc_id, r.lang_pred) for r in kn_language.predict(docs, model).collect()]
    assert len(got) == len(ODD) + 5
    assert {i: p for i, p in got if i in (1, 2, 3)} == {1: "und", 2: "und", 3: "und"}
    assert all(p == "de" for i, p in got if i and i >= 20) and all(p in ("de", "en", "und") for _, p in got)
    none = documents(spark, [])
    empty = kn_language.train(none, "doc_id", "text", "lang", everything, everything)
    assert kn_language.predict(none, empty).count() == 0
    assert {r.lang_pred for r in kn_language.predict(docs, empty).collect()} == {"und"}


def test_a_rare_language_keeps_all_its_ngrams_beside_a_hot_one(spark, monkeypatch):
    monkeypatch.setattr(kn_language, "MAX_GRAMS", 20, raising=False)
    hot = [(i, "the cat and the dog then went home again") for i in range(60)]
    docs = documents(spark, hot + [(100, "zwölf boxkämpfer jagen viktor")])
    docs = docs.withColumn("lang", F.when(F.col("doc_id") >= 100, "de").otherwise(F.col("lang")))
    model = kn_language.train(docs, "doc_id", "text", "lang", F.lit(True), F.lit(True))
    bags = {"en": Counter(w.encode() for _, t in hot for w in t.split()), "de": Counter(w.encode() for w in "zwölf boxkämpfer jagen viktor".split())}
    want = kn_language.build({k: kn_language.count_grams(list(b), np.array(list(b.values()))) for k, b in bags.items()})
    assert model.langs == want.langs == ["de", "en"]
    for a, b in zip(model.keys + model.logp + model.backoff, want.keys + want.logp + want.backoff):
        np.testing.assert_array_equal(a, b)
    assert {r.lang_pred for r in kn_language.predict(docs.filter("doc_id = 100"), model).collect()} == {"de"}


def test_language_scores_are_calibrated_on_every_row(spark, monkeypatch):
    """By the same fit in numpy; quantiles of this many rows are exact."""
    seen = []
    monkeypatch.setattr(kn_language, "calibrated", lambda model, probe: seen.append(probe.count() if hasattr(probe, "count") and hasattr(probe, "sparkSession") else len(probe)) or model)
    docs = documents(spark, [(i, "the cat" if i % 2 else "die Katze") for i in range(2100)])
    docs = docs.withColumn("lang", F.when(F.col("doc_id") % 2 == 1, "en").otherwise("de"))
    kn_language.train(docs, "doc_id", "text", "lang", F.lit(True), F.lit(True))
    assert seen == [2100]
    monkeypatch.undo()
    rng = np.random.default_rng(5)
    x, best = rng.gamma(2.0, 2.0, 2501), rng.integers(0, 3, 2501)
    right, entropy = rng.random(2501) < 1 / (1 + np.exp(2 - x)), rng.normal(2, 0.3, 2501)
    right[best == 2] = False
    probe = spark.createDataFrame([(i, *r) for i, r in enumerate(zip(best.tolist(), entropy.tolist(), x.tolist(), right.tolist()))], "key long, best long, entropy double, evidence double, right boolean")
    model = kn_language.Model(["a", "b", "c"], [], [], [], [], limit=np.full(3, np.inf))
    kn_language.calibrated(model, probe)
    scale, y = np.median(x), np.where(right, (right.sum() + 1) / (right.sum() + 2), 1 / ((~right).sum() + 2))
    design, theta = np.column_stack([x / scale, np.ones(len(x))]), np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-design @ theta))
        theta -= np.linalg.solve(design.T @ (design * (p * (1 - p))[:, None]) + 1e-3 * np.eye(2), design.T @ (p - y) + 1e-3 * theta)
    np.testing.assert_allclose([model.slope, model.level], [theta[0] / scale, theta[1]], rtol=1e-9)
    np.testing.assert_allclose(model.limit[:2], [1.1 * np.quantile(entropy[right & (best == k)], 0.995) for k in (0, 1)], rtol=1e-12)
    assert np.isinf(model.limit[2])


# Toxicity


def toxic_texts(rng, n):
    plain = ["river", "stone", "window", "garden", "market", "people", "morning", "winter", "silver", "letter"]
    texts, flags = [], []
    for i in range(n):
        words = [rng.choice(plain) + rng.choice(["", "s", "ing", "ed"]) for _ in range(rng.randrange(5, 200))]
        if i % 3 == 0:
            for _ in range(3):
                words.insert(rng.randrange(len(words)), rng.choice(["scoundrel", "dimwit", "blockhead"]))
        texts.append(" ".join(words).encode())
        flags.append(i % 3 == 0)
    return texts, np.array(flags)


def scores_of(model, texts):
    (s,) = K.slices(pa.array(texts, pa.large_binary()), 1 << 30)
    words = K.split_words(s.data, s.offsets)
    logits = toxicity.word_logits(model.grams, [words.text(i) for i in range(len(words.starts))])
    window, _, _, doc = toxicity.window_logits(logits, words.first, model.bias)
    return np.array([window[doc == d].max() for d in range(len(texts))])


def test_unseen_misspellings_score_high():
    rng = random.Random(5)
    texts, toxic = toxic_texts(rng, 400)
    model = toxicity.fit(texts, toxic)
    again, flags = toxic_texts(rng, 200)
    found = scores_of(model, again) > 0
    assert (found == flags).mean() > 0.97
    clean = b"river stones window gardening people winter " * 3
    spelled = [clean + w for w in (b"scoundrell scoundreel", b"dimwitt dimwits", b"bloockhead blockheads")]
    assert (scores_of(model, spelled) > scores_of(model, [clean])[0] + 1).all()


@pytest.mark.parametrize("size", [1, 64, 65, 70, 76, 77, 500])
def test_pieces_of_a_run_hold_every_ngram(size):
    run = bytes(random.Random(size).choice(b"abcdefgh.,!") for _ in range(size))
    (s,) = K.slices(pa.array([b"one", run + b" two", b""], pa.large_binary()))
    words = toxicity.in_pieces(K.split_words(s.data, s.offsets))
    parts = [words.text(i) for i in range(words.first[1], words.first[2] - 1)]
    assert words.text(0) == b"one" and words.text(words.first[2] - 1) == b"two" and words.first[3] == words.first[2]
    assert (len(parts) == 1) == (size <= 64) and len(set(words.hashes.tolist())) == len({words.text(i) for i in range(len(words.starts))})
    kept = [toxicity._wrapped(p) for p in parts]
    bare = run.strip(b".,;:!?()\"'")
    assert all(any(bare[i : i + n] in k for k in kept) for n in toxicity.GRAMS for i in range(len(bare) - n + 1))


@pytest.mark.parametrize("joint", ["\u00a0", "\u3000", "-", "/", "."])
def test_toxic_words_late_in_an_unbroken_run_score_high(spark, joint):
    texts, toxic = toxic_texts(random.Random(5), 400)
    model = toxicity.fit(texts, toxic)
    clean = ["river", "stones", "window", "gardening", "people", "winter"] * 8
    late = clean[:40] + ["scoundrel", "dimwit", "blockhead"] + clean[40:]
    han = "".join(chr(0x4E00 + i) for i in range(60))
    docs = documents(spark, [(1, joint.join(clean)), (2, joint.join(late)), (3, han), (4, han + "scoundreldimwitblockhead")])
    got = {r.doc_id: r.score for r in toxicity.score(docs, model).collect()}
    assert got[2] > got[1] + 0.2 and got[4] > got[3] + 0.2
    # Learned from such runs too.
    again = toxicity.fit([joint.join(t.decode().split()).encode() for t in texts], toxic)
    got = {r.doc_id: r.score for r in toxicity.score(docs, again).collect()}
    assert got[2] > 0.5 > got[1]


def test_windows_cover_every_word_once_or_twice():
    first = np.array([0, 0, 1, 40, 104, 170, 1000])
    begin, size, doc = toxicity.windows(first, 64)
    for d in range(len(first) - 1):
        covered = {w for b, n, e in zip(begin, size, doc) if e == d for w in range(b, b + n)}
        assert covered == set(range(first[d], first[d + 1]))
    assert (size <= 64).all() and (size > 0).all()


def test_training_never_sees_held_out_labels(spark):
    docs = spark.read.parquet(f"{BASE}/documents.parquet")
    labels = spark.read.parquet(f"{BASE}/labels.parquet")
    part = queries.fold("doc_id", 3)
    flipped = labels.withColumn("toxic", F.when(part == 1, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    one, two = (toxicity.train(docs, frame.filter(part != 1)) for frame in (labels, flipped))
    assert np.array_equal(one.grams, two.grams) and one.bias == two.bias


def test_toxicity_with_odd_rows(spark):
    labels = spark.createDataFrame([(5, 1), (7, 0), (9, None), (None, 1)], "doc_id bigint, toxic int")
    docs = documents(spark, ODD)
    got = toxicity.score(docs, toxicity.train(docs, labels)).collect()
    assert len(got) == len(ODD) and all(0 <= r.score <= 1 for r in got)
    assert max(r.score for r in got if r.doc_id in (1, 2, 3)) < 0.7
    none = documents(spark, [])
    assert toxicity.score(none, toxicity.train(none, labels)).count() == 0


@pytest.mark.parametrize("texts", [[], [b""], [b"", b""]])
def test_training_without_words(texts):
    model = toxicity.fit(texts, np.array([i % 2 == 0 for i in range(len(texts))], bool))
    assert np.isfinite(model.bias)

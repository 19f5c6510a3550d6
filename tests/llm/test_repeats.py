"""Repeated passages against counting every window, and the run-length index against plain matches."""

from __future__ import annotations

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from common import ODD, documents
from hypothesis import given, settings
from hypothesis import strategies as st

from qualityforge.llm import queries, repeats, runindex


def longest_matches(strings):
    places = [(a, b) for a, s in enumerate(strings) for b in range(len(s))]
    out = []
    for i, s in enumerate(strings):
        for j in range(len(s)):
            best = 0
            for a, b in places:
                if (a, b) != (i, j):
                    k = 0
                    while j + k < len(s) and b + k < len(strings[a]) and s[j + k] == strings[a][b + k]:
                        k += 1
                    best = max(best, k)
            out.append(best)
        out.append(0)
    return out


PIECES = st.lists(st.binary(max_size=30) | st.text(alphabet="ab", max_size=30).map(str.encode), min_size=1, max_size=5)


@settings(max_examples=150, deadline=None)
@given(PIECES, st.integers(1, 25))
def test_matching_statistics_equal_all_comparisons(pieces, least):
    # Repetitive on purpose: every string also stands in a longer one.
    strings = [*pieces, b"".join(pieces)[:40]]
    want = longest_matches(strings)
    index = runindex.build(strings)
    assert runindex.matching_statistics(index).tolist() == want
    rough = runindex.matching_statistics(index, least).tolist()
    assert [v if v >= least else 0 for v in rough] == [v if v >= least else 0 for v in want]


def test_the_index_is_the_transform_in_runs():
    rng = random.Random(5)
    base = bytes(rng.choice(b"acgt") for _ in range(60))
    strings = [base, base[10:50], base * 3, b"", base[:59] + b"\xff"]
    index = runindex.build(strings)
    joined = [(s[i:], k, i) for k, s in enumerate(strings) for i in range(len(s) + 1)]
    rows = sorted(joined, key=lambda r: ([c + 1 for c in r[0]] + [0], r[1]))
    before = [strings[k][i - 1] + 1 if i else 0 for _, k, i in rows]
    assert np.repeat(index.symbols, index.lengths).tolist() == before
    first = np.cumsum(index.lengths) - index.lengths
    at = [int(index.starts[k]) + i for _, k, i in rows]
    assert index.heads.tolist() == [at[f] for f in first] and index.tails.tolist() == [at[f + n - 1] for f, n in zip(first, index.lengths)]
    assert len(index.symbols) < len(rows) / 2


def plain(rows, length):
    """(key, n_bytes, n_removed, spans, kept) by counting every window."""
    texts = [(k, (t or "").encode()) for k, t in rows]
    seen = Counter(b[i : i + length] for _, b in texts for i in range(len(b) - length + 1))
    out = []
    for k, b in texts:
        gone = bytearray(len(b))
        for p in range(len(b) - length + 1):
            if seen[b[p : p + length]] > 1:
                gone[p : p + length] = b"\1" * length
        starts = [p for p in range(len(b)) if gone[p] and not (p and gone[p - 1])]
        ends = [p + 1 for p in range(len(b)) if gone[p] and not (p + 1 < len(b) and gone[p + 1])]
        out.append((k, len(b), sum(gone), list(zip(starts, ends)), bytes(c for c, g in zip(b, gone) if not g)))
    return sorted(out, key=repr)


def rows_of(frame):
    return sorted([(r[0], r.n_bytes, r.n_removed, [(s.begin, s.end) for s in r.spans], bytes(r.kept)) for r in frame.collect()], key=repr)


def mutated(rng, n):
    """Texts that share passages, near copies, periods and whole copies."""
    word = lambda: "".join(rng.choice("abcdeé漢") for _ in range(rng.randrange(1, 7)))
    base = [" ".join(word() for _ in range(rng.randrange(1, 50))) for _ in range(6)]
    out = []
    for _ in range(n):
        kind = rng.random()
        text = rng.choice(base)
        if kind < 0.3:
            at = rng.randrange(len(text) + 1)
            text = text[:at] + rng.choice(["", "x", word()]) + text[at + 1 :]
        elif kind < 0.5:
            text = word() + text[rng.randrange(len(text)) :] + rng.choice(base)[:30]
        elif kind < 0.6:
            text = rng.choice(["a", "ab", "abc "]) * rng.randrange(40)
        elif kind < 0.8:
            text = " ".join(word() for _ in range(30))
        out.append(text)
    return out


@pytest.mark.parametrize(("length", "anchor", "index", "hot"), [(20, 8, 400, 10**6), (20, 20, 400, 10**6), (12, 5, 10**6, 200), (30, 1, 2000, 0)])
def test_spans_equal_counting_every_window(spark, length, anchor, index, hot):
    rows = list(enumerate(mutated(random.Random(length), 120)))
    frame = documents(spark, rows).repartition(3)
    got = repeats.remove_repeats(frame, length=length, anchor=anchor, slab=2000, index=index, hot=hot)
    assert rows_of(got) == plain(rows, length)


def test_odd_rows_and_a_text_of_one_period(spark):
    got = repeats.remove_repeats(documents(spark, ODD))
    assert got.columns == ["doc_id", "n_bytes", "n_removed", "spans", "kept"]
    found = rows_of(got)
    long = {r[0]: r for r in found}[7]
    assert long[2] == long[1] == 540_000 and long[3] == [(0, 540_000)]
    # Without the long texts, by counting.
    short = [r for r in ODD if r[0] not in (7, 8)]
    assert [r for r in found if r[0] not in (7, 8)] == plain(short, 200)
    assert repeats.remove_repeats(documents(spark, [])).count() == 0
    assert rows_of(repeats.remove_repeats(documents(spark, [(1, None), (2, "a")]))) == plain([(1, None), (2, "a")], 200)


def test_copies_with_most_of_all_rows(spark):
    rng = random.Random(8)
    text = "".join(rng.choice("abcdefgh ") for _ in range(900))
    rows = [(i, text if i % 2 else text[: i * 9] + "#" + text[i * 9 :] if i % 3 else f"{i} " * 200) for i in range(90)]
    got = repeats.remove_repeats(documents(spark, rows).repartition(5), slab=10_000, hot=3000)
    assert rows_of(got) == plain(rows, 200)


def test_texts_are_not_shuffled(spark):
    texts = repeats.write_slabs(documents(spark, [(i, "abc " * 100) for i in range(40)]), "doc_id", "text", 200, 100, slab=1000)
    spans = repeats.repeated_windows(texts, 200)
    placed = repeats._with_slabs(texts.select("slab", "idx", "key", "text"), spans, repeats._removed, "key bigint, n_bytes bigint")
    plan = placed._jdf.queryExecution().executedPlan().toString()
    # The spans go to the slabs; the slabs stay where they are.
    assert plan.count("Exchange hashpartitioning(slab") == 1 and "Bucketed: true" in plan


def test_the_query_equals_counting_every_window(spark):
    base = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{base}/documents.parquet").collect()]
    want = {(k, n, m, len(s), hashlib.sha256(kept).hexdigest()) for k, n, m, s, kept in plain(rows, 200)}
    got = {tuple(r) for r in queries.QUERIES["op11_repeated_passages"](spark, base).collect()}
    assert got == want and any(r[2] for r in got)

"""The pipeline, stage by stage, against plain versions on a small corpus."""

from __future__ import annotations

from collections import Counter

import pytest
from common import ODD, documents
from test_dedup import ASCII, jaccard_plain
from test_models import counts_plain

import corpus_pipeline
from qualityforge.llm import queries
from qualityforge.llm.staging import staged

BASE = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    """Every stage's input and output, as ``run`` makes them."""
    docs, out = queries.table(spark, BASE, "documents"), []
    for name, stage in corpus_pipeline.STAGES:
        after = staged(stage(spark, docs, BASE), f"test-{name}")
        out.append((docs, after))
        docs = after
    return out


def rows_of(frame):
    return Counter(map(tuple, frame.collect()))


def test_all_but_the_last_return_documents(stages):
    columns = stages[0][0].columns
    assert all(after.columns == columns for _, after in stages[:-1])
    assert stages[-1][1].columns == ["doc_id", "piece", "start", "n_tokens", "bin_id", "offset"]


def test_quality_drops_what_fails_and_keeps_good_documents(spark, stages):
    before, after = stages[0]
    kept = {r.doc_id for r in after.collect()}
    for r in before.collect():
        words, _, _, _, repeated = counts_plain(r.text)
        if words < 10 or 100 * repeated > 20 * words:
            assert r.doc_id not in kept
    assert not rows_of(after) - rows_of(before)
    labels = queries.table(spark, BASE, "labels").collect()
    good = [r.doc_id for r in labels if r.quality == 1]
    failing = {r.doc_id for r in before.collect() if (w := counts_plain(r.text))[0] < 10 or 100 * w[4] > 20 * w[0]}
    assert sum(i in kept or i in failing for i in good) >= 0.98 * len(good)


def test_exact_copies_leave_the_largest_id(stages):
    before, after = stages[1]
    last = {}
    for r in before.collect():
        text = (r.text or "").translate(ASCII)
        last[text] = max(last.get(text, r.doc_id), r.doc_id)
    assert sorted(r.doc_id for r in after.collect()) == sorted(last.values())


def test_near_copies_leave_the_smallest_id(stages):
    before, after = stages[2]
    rows = [(r.doc_id, r.text) for r in before.collect()]
    want = sorted(i for i, (_, top) in jaccard_plain(rows).items() if i == top)
    assert sorted(r.doc_id for r in after.collect()) == want


def test_near_stage_takes_five_words_at_eighty_percent(spark):
    """Pairs between that and the thresholds of op3 alone."""
    rows = []
    for pair in range(4):
        words = [f"p{pair}w{i}" for i in range(200 if pair % 2 else 100)]
        other = [f"new{w}" if (90 <= i < 105 if pair % 2 else i in (30, 60 + pair)) else w for i, w in enumerate(words)]
        rows += [(10 * pair, " ".join(words)), (10 * pair + 1, " ".join(other))]
    want = sorted(i for i, (_, top) in jaccard_plain(rows, 5, 80).items() if i == top)
    assert want != sorted(i for i, (_, top) in jaccard_plain(rows).items() if i == top)
    got = dict(corpus_pipeline.STAGES)["ngram_jaccard_join"](spark, documents(spark, rows), BASE)
    assert sorted(r.doc_id for r in got.collect()) == want


def test_mixing_repeats_as_planned(spark, stages):
    before, after = stages[3]
    plan = queries.mixing.mix_sources(queries.corpus_sizes(before), queries.CORPUS_MIX).collect()
    want = Counter({r.doc_id: r.full_epochs + (r.last_tokens > 0) for r in plan if r.used_tokens})
    assert Counter(r.doc_id for r in after.collect()) == want
    assert set(rows_of(after)) <= set(rows_of(before))


def test_packing_holds_every_token(stages):
    before, after = stages[4]
    want = Counter()
    for r in before.collect():
        want[r.doc_id] += counts_plain(r.text)[0]
    got = Counter()
    for r in after.collect():
        got[r.doc_id] += r.n_tokens
    assert got == want


def test_run_gives_the_last_stage(spark, stages):
    assert rows_of(corpus_pipeline.run(spark, BASE)) == rows_of(stages[-1][1])


def test_stages_take_odd_and_empty_documents(spark):
    for rows in (ODD, []):
        docs = documents(spark, rows)
        for name, stage in corpus_pipeline.STAGES:
            docs = staged(stage(spark, docs, BASE), f"test-odd-{name}")
        assert docs.count() >= 0

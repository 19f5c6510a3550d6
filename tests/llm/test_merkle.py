"""The manifest against a plain tree, row by row."""

from __future__ import annotations

import hashlib
import random
import zlib

import pytest
from common import ODD, documents
from pyspark.sql import functions as F

from qualityforge.llm import merkle, queries


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def climb(nodes):
    """Root, and for each node the (left, right) texts of its runs from below."""
    paths, at, level = [[] for _ in nodes], list(range(len(nodes))), nodes
    while len(level) > 1:
        for k, i in enumerate(at):
            run = i - i % 3
            paths[k].append(("".join(level[run:i]), "".join(level[i + 1 : run + 3])))
            at[k] = i // 3
        level = [h(*level[i : i + 3]) for i in range(0, len(level), 3)]
    return level[0], paths


def plain(rows):
    """``rows`` are (key, source, leaf, claimed)."""
    groups = {}
    for r in rows:
        groups.setdefault(r[1], []).append(r)
    order = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    lower = {}
    for s in order:
        groups[s].sort(key=lambda r: (r[0] is not None, r[0] or 0, r[2], r[3]))
        lower[s] = climb([r[2] for r in groups[s]])
    root, tops = climb([lower[s][0] for s in order])
    out = []
    for s, over in zip(order, tops):
        subroot, paths = lower[s]
        for (key, _, leaf, claimed), path in zip(groups[s], paths):
            node = claimed
            for left, right in path + over:
                node = h(left, node, right)
            out.append((key, leaf, subroot, root, h(*[x + y for x, y in path + over]), node, node == root))
    return out


COLUMNS = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]


def ordered(rows):
    return sorted(map(tuple, rows), key=repr)


@pytest.mark.parametrize("depth", [1, 2, 6])
def test_any_size_of_source(spark, depth):
    sizes = [1, 2, 3, 4, 5, 7, 9, 10, 13, 18, 19, 26, 27, 28, 40, 55, 82]
    rows = [(f"s{n}", i) for n in sizes for i in range(n)]
    rows = [(k, None if s == "s4" else "" if s == "s5" else s, h(s, str(i)), h(s, str(i), "x" * (k % 2))) for k, (s, i) in enumerate(rows)]
    random.Random(3).shuffle(rows)
    frame = spark.createDataFrame([(*r, 1, "x", 2, "y") for r in rows], "doc_id bigint, source string, l string, c string, pos int, grp string, block int, members string")
    got = merkle.manifest(frame.repartition(5), "doc_id", "source", F.col("l"), F.col("c"), depth=depth)
    assert got.columns == COLUMNS
    assert ordered(got.collect()) == ordered(plain(rows))


def test_a_source_with_most_rows_and_other_fanouts(spark):
    rows = [(i, "hot" if i % 3 else f"s{i % 50}", h(str(i)), h(str(i))) for i in range(700)]
    frame = spark.createDataFrame(rows, "doc_id bigint, source string, l string, c string")
    got = merkle.manifest(frame, "doc_id", "source", F.col("l"), depth=1)
    assert ordered(got.collect()) == ordered(plain(rows)) and got.filter("not verified").count() == 0
    assert merkle.manifest(frame, "doc_id", "source", F.col("l"), depth=1, fanout=4).filter("verified").count() == 700


def test_repeated_and_null_keys(spark):
    rows = [(i % 4 or None, "a", h(str(i % 8)), h(str(i % 8))) for i in range(60)] + [(7, "a", h("same"), h("same"))] * 40
    frame = spark.createDataFrame(rows, "doc_id bigint, source string, l string, c string")
    assert ordered(merkle.manifest(frame, "doc_id", "source", F.col("l"), depth=1).collect()) == ordered(plain(rows))


def field(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def test_odd_documents(spark, tmp_path):
    documents(spark, ODD).write.parquet(str(tmp_path / "documents.parquet"))
    got = queries.QUERIES["op13_merkle_manifest"](spark, str(tmp_path)).collect()
    rows = []
    for r in documents(spark, ODD).collect():
        one = [field(v) for v in (r.doc_id, r.source, r.lang, r.n_chars)]
        bare = r.text and r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 2 == 0
        rows.append((r.doc_id, r.source, h(*one, field(r.text)), h(*one, field(r.text.replace("\n", "") if bare else r.text))))
    assert ordered(got) == ordered(plain(rows))
    assert {r.verified for r in got} == {True, False}


def test_an_empty_table(spark):
    got = merkle.manifest(documents(spark, []), "doc_id", "source", merkle.leaf_of(F.col("text")))
    assert got.columns == COLUMNS and got.count() == 0

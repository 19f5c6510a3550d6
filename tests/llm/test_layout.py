"""Token files, packing, mixing and URL rules against plain Python."""

from __future__ import annotations

import itertools
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from common import ODD, documents
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from qualityforge.llm import mixing, packing, simple8b, url_rules
from qualityforge.llm.queries import URL_RULES

PATH = public_tokenizers.path("word_bpe_49k.json")


# Token ids


@settings(max_examples=150, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 3), st.integers(0, 60_000), st.integers(0, 2**64 - 1)), max_size=900))
def test_any_ids_come_back(ids):
    ids = np.array(ids, np.uint64)
    words, blocks, escapes = simple8b.pack(ids)
    assert np.array_equal(simple8b.unpack(words, blocks, escapes, len(ids)), ids)
    assert len(escapes) == (ids >= 2**60).sum()


def test_words_hold_as_many_ids_as_the_width_allows():
    words, blocks, _ = simple8b.pack(np.ones(240, np.uint64))
    assert len(words) == 4 and len(blocks) == 1
    words, _, _ = simple8b.pack(np.full(8, 2**15 - 1, np.uint64))
    assert len(words) == 2


def plain_tokens(rows):
    from tokenizers import Tokenizer

    encoder = Tokenizer.from_file(PATH)
    out, start = [], 0
    for i, text in sorted(rows, key=lambda r: (r[0] is not None, r[0])):
        ids = encoder.encode(text or "", add_special_tokens=False).ids + [2]
        out.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


TEXTS = [
    "don't stop, I'll go; they've won't 's",
    "ELEVEN é É Ǆ İstanbul ß ẞ Ω Å e\u0301 \u0301",
    "a-b_c d*** (x) \"q\" --- 100% 3.14 漢字かな 😀👍🏽",
    "nbsp\u00a0inside\u2003wide \u200bzero \x00 nul <|endoftext|> end</w>",
    "\ufeffbom and \u00ad soft",
] + ["word" * 500]


def test_token_files_equal_the_tokenizer(spark):
    rows = [r for r in ODD if r[0] not in (5, None)] + [(100 + i, t) for i, t in enumerate(TEXTS)]
    got = simple8b.token_table(documents(spark, rows).repartition(6), PATH, 2).select("doc_id", "start", "n_tokens", "ids_crc32").collect()
    assert sorted(tuple(r) for r in got) == plain_tokens(rows)


def test_token_files_with_repeated_and_null_keys(spark):
    got = simple8b.token_table(documents(spark, ODD), PATH, 2).collect()
    want = Counter((i, n, c) for i, _, n, c in plain_tokens(ODD))
    assert Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in got) == want
    ordered = sorted(got, key=lambda r: r.start)
    assert [r.start for r in ordered] == list(itertools.accumulate([0] + [r.n_tokens for r in ordered[:-1]]))
    assert simple8b.token_table(documents(spark, []), PATH, 2).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(max_size=60), max_size=8))
def test_any_text_is_encoded_like_the_whole(texts):
    import pyarrow as pa

    from qualityforge.llm import kernel as K

    tokenizer = simple8b._tokenizer(PATH)
    for s in K.slices(pa.array(texts, pa.string())):
        ids, sizes = tokenizer.encode(s)
        parts = np.split(ids, np.cumsum(sizes)[:-1])
        assert [p.tolist() for p in parts] == [e.ids for e in tokenizer.encoder.encode_batch(texts[s.first : s.last], add_special_tokens=False)]


# Packing


def best_fit(sizes, sources, clusters, capacity):
    """The same rule by trying every bin."""
    bins, out, rests = [], [], []
    for d, n in enumerate(sizes):
        for piece in range(n // capacity):
            out.append((d, piece, len(bins), 0))
            bins.append((capacity, set(), set()))
        if n % capacity:
            rests.append((-(n % capacity), d, n // capacity))
    loads = {}
    for n, d, piece in sorted(rests):
        fits = [
            (capacity - load, order, b)
            for b, (load, order, src, clu) in loads.items()
            if load - n <= capacity and sources[d] not in src and (clusters[d] < 0 or clusters[d] not in clu)
        ]
        left = min((f[0] for f in fits), default=None)
        if left is None:
            b, load, src, clu = len(bins), 0, set(), set()
            bins.append(None)
        else:
            tight = [f for f in fits if f[0] == left]
            b = tight[0][2]
            load, _, src, clu = loads[b]
        out.append((d, piece, left, -n))
        loads[b] = (load - n, 0, src | {sources[d]}, clu | ({clusters[d]} if clusters[d] >= 0 else set()))
    return out


@pytest.mark.parametrize("seed", range(6))
def test_each_piece_goes_to_the_tightest_compatible_bin(seed):
    rng = random.Random(seed)
    n = 120
    sizes = [rng.choice([rng.randrange(1, 40), rng.randrange(1, 300)]) for _ in range(n)]
    sources, clusters = [rng.randrange(5) for _ in range(n)], [rng.choice([-1, rng.randrange(8)]) for _ in range(n)]
    got = packing.pack_shard(sizes, sources, clusters, 100)
    held = defaultdict(list)
    for d, piece, start, size, b, offset in got:
        open_bins = {x: sum(p[1] for p in held[x]) for x in held}
        if size < 100:
            tight = [
                100 - load
                for x, load in open_bins.items()
                if load + size <= 100 and all(sources[d] != sources[e] and (clusters[d] < 0 or clusters[d] != clusters[e]) for e, _ in held[x])
            ]
            assert offset == (100 - min(tight) if tight else 0)
            assert (b in open_bins) == bool(tight)
        assert offset == open_bins.get(b, 0) and offset + size <= 100 and start == piece * 100
        held[b].append((d, size))
    packed = Counter()
    for d, _, _, size, _, _ in got:
        packed[d] += size
    assert packed == Counter(dict(enumerate(sizes)))


def test_packing_keeps_every_token_and_no_conflicts(spark):
    rng = random.Random(9)
    rows = [(i, f"src{0 if rng.random() < 0.4 else rng.randrange(6)}", f"c{rng.randrange(150)}", rng.choice([0, rng.randrange(1, 900), 2048, 5000])) for i in range(400)]
    rows += [(7, "src0", None, 30), (None, None, None, 12), (None, "src1", "c1", None)]
    docs = spark.createDataFrame([(*r, 1) for r in rows], "doc_id bigint, source string, cluster string, n_tokens bigint, _shard int")
    got = packing.pack_documents(docs, shard_docs=60).collect()
    assert sum(r.n_tokens for r in got) == sum(r[3] or 0 for r in rows)
    assert sum(r.bin_id is None for r in got) == sum(not r[3] for r in rows)
    bins = defaultdict(list)
    for r in got:
        if r.bin_id is not None:
            bins[r.bin_id].append(r)
    by_id = defaultdict(list)
    for r in rows:
        by_id[r[0]].append(r)
    for own in bins.values():
        own.sort(key=lambda r: r.offset)
        assert [r.offset for r in own] == list(itertools.accumulate([0] + [r.n_tokens for r in own[:-1]]))
        assert sum(r.n_tokens for r in own) <= packing.CAPACITY
        sure = [by_id[r.doc_id][0] for r in own if len(by_id[r.doc_id]) == 1]
        assert len({s[1] for s in sure}) == len(sure) == len({s[2] for s in sure})
    assert packing.pack_documents(docs.limit(0)).count() == 0


def test_no_key_fills_a_shard(spark):
    rows = [(None, f"s{i % 9}", f"c{i}", 5) for i in range(3000)] + [(7, f"s{i % 9}", f"d{i}", 9) for i in range(3000)] + [(i, "s", f"e{i}", 3) for i in range(100, 3100)]
    docs = spark.createDataFrame(rows, "doc_id bigint, source string, cluster string, n_tokens bigint").repartition(6)
    named = docs.selectExpr("doc_id as _key", "source as _source", "cluster as _cluster", "n_tokens")
    sizes = [r["count"] for r in packing.dealt(named, 300).groupBy("_shard").count().collect()]
    assert sum(sizes) == 9000 and len(sizes) == 30 and max(sizes) < 450
    got = packing.pack_documents(docs, capacity=64, shard_docs=300)
    assert sorted((r.doc_id or 0, r.n_tokens) for r in got.collect()) == sorted((k or 0, n) for k, _, _, n in rows)


# Mixing


def test_shortages_go_to_siblings_before_ancestors(spark):
    leaves = [("a", "x", "s1", 10), ("a", "x", "s2", 100), ("a", "y", "s3", 5), ("b", "z", "s4", 1000), ("b", "z", "s5", 1000)]
    frame = spark.createDataFrame(leaves, "domain string, lang string, source string, tokens bigint")
    mix = mixing.Mix(("domain", "lang", "source"), {"domain": {"a": 1, "b": 1}}, epochs=1, parts=200, of=2115)
    got = {r.source: r.budget for r in mixing.budgets(frame, mix).collect()}
    # a and b get 100 each; y can give 5 of its 50, so x gives 95: s1 its 10, s2 the rest.
    assert got == {"s1": 10, "s2": 85, "s3": 5, "s4": 50, "s5": 50}
    mix = mixing.Mix(mix.levels, mix.weights, epochs=1, parts=400, of=2115)
    got = {r.source: r.budget for r in mixing.budgets(frame, mix).collect()}
    # Domain a is empty after 115 of its 200: the rest moves to b.
    assert got == {"s1": 10, "s2": 100, "s3": 5, "s4": 143, "s5": 142}


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_budgets_use_all_that_fits(spark, seed):
    rng = random.Random(seed)
    leaves = [(f"d{rng.randrange(3)}", f"l{rng.randrange(3)}", f"s{i}", rng.choice([0, rng.randrange(1, 50), rng.randrange(10**6)])) for i in range(25)]
    frame = spark.createDataFrame(leaves, "domain string, lang string, source string, tokens bigint")
    weights = {"domain": {"d0": 5, "d1": 2}, "source": {f"s{i}": 1 + i % 4 for i in range(25)}}
    for parts, of in ((1, 3), (1, 1), (9, 1)):
        mix = mixing.Mix(("domain", "lang", "source"), weights, epochs=2, parts=parts, of=of)
        got = mixing.budgets(frame, mix).collect()
        total = sum(t for *_, t in leaves)
        assert sum(r.budget for r in got) == min(total * parts // of, 2 * total)
        assert all(0 <= r.budget <= 2 * r.tokens for r in got)


def test_mixing_with_odd_rows(spark):
    rows = [(1, None, "en", 5), (2, "s", None, 7), (None, "s", "en", 3), (3, "s", "en", 0), (3, "s", "en", 9), (4, "t", "en", None)]
    docs = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id bigint, source string, lang string, n_tokens bigint, budget int, rest string")
    mix = mixing.Mix(("lang", "source"), {}, epochs=3, parts=2)
    got = mixing.mix_sources(docs, mix).collect()
    assert len(got) == len(rows) and sum(r.used_tokens for r in got) == 48
    assert mixing.mix_sources(docs.limit(0), mix).count() == 0
    mixed = mixing.mixed_rows(docs, docs, mix)
    assert mixed.columns == docs.columns
    with pytest.raises(ValueError):
        mixing.Mix(("lang",), {"lang": {"en": 0}})


# URLs


def url_plain(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    end = min([rest.index(c) for c in "/?#" if c in rest], default=len(rest))
    host, rest = rest[:end], rest[end:]
    stop = min([rest.index(c) for c in "?#" if c in rest], default=len(rest))
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), rest[:stop]


def rule_plain(host, path):
    fits = [(len(h + p), h + p, v) for h, p, v in URL_RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fits)[1:] if fits else (None, None)


URLS = [
    None, "", "no scheme.net/", "http://", "HTTP://A.NET", "http://a.NET/", "http://net/x", "http://xnet/", "https://Example.net/en/1?q=http://b.net/",
    "https://sub.example.net/de/", "http://example.com/de/x", "http://notexample.com/de/", "http://a.org/fr/", "http://a.org/fr", "http://a.org?x=/fr/",
    "x://y://z.net/p#q", "http://user@h.net:80/p;v?k=1&K2=2#f", "http://ÄÖ.net/ü", "://net/", "http://..net//", "http://spam-farm.com/en/17/23",
]


def test_hosts_paths_and_given_rules(spark):
    pages = spark.createDataFrame([(i, u, "x", 1) for i, u in enumerate(URLS)] + [(0, None, "y", 2)], "page_id bigint, url string, rule string, tokens int")
    labels = spark.createDataFrame([], "page_id bigint, block boolean")
    got = url_rules.judge_urls(pages, URL_RULES, labels).collect()
    assert len(got) == len(URLS) + 1
    for r in got:
        host, path = url_plain(URLS[r.page_id])
        rule, verdict = rule_plain(host, path)
        assert (r.host, r.path, r.rule, r.verdict) == (host, path, rule, verdict or "allow")
    assert url_rules.judge_urls(pages.limit(0), URL_RULES, labels).count() == 0


def test_mined_rules_equal_all_token_sets(spark):
    rng = random.Random(6)
    pages, labels = [], []
    for i in range(400):
        host = rng.choice(["win-big.example.com", "shop.example.com", "news.example.org", "win-news.example.org"])
        url = f"http://{host}/{rng.choice(['en', 'fr'])}/{rng.randrange(10**6)}{rng.choice(['', '?utm=1', '?page=2&x=y'])}"
        pages.append((i, url))
        if i % 2:
            bad = "win-big" in url or ("fr" in url and "utm" in url)
            labels.append((i, bad if rng.random() < 0.95 else not bad))
    frame = spark.createDataFrame(pages, "page_id bigint, url string")
    known = spark.createDataFrame(labels + [(1, None), (None, True)], "page_id bigint, block boolean")
    got = {r.page_id: r for r in url_rules.judge_urls(frame, (), known, min_count=12, min_share=0.01).collect()}
    tokens = {r.page_id: frozenset(r.t) for r in frame.select("page_id", url_rules.tokens_of("url").alias("t")).collect()}
    assert max(map(len, tokens.values())) <= 12
    flags = dict(labels)
    times, bad = Counter(), Counter()
    for i, flag in flags.items():
        for k in range(1, len(tokens[i]) + 1):
            for part in itertools.combinations(sorted(tokens[i]), k):
                times[part] += 1
                bad[part] += flag
    rules = {p for p in times if bad[p] >= max(12, 0.01 * len(flags)) and bad[p] >= 0.8 * times[p]}
    assert rules
    for i, own in tokens.items():
        fired = sum(own.issuperset(p) for p in rules)
        assert (got[i].n_rules, got[i].verdict) == (fired, "block" if fired else "allow")
    blocked = {u.split("/")[2] for i, u in pages if got[i].verdict == "block"}
    assert "win-big.example.com" in blocked


def test_main_path_of_native_operators_runs_no_python(spark):
    docs = spark.createDataFrame([(1, "a", "en", 5), (2, "b", "fr", 6)], "doc_id bigint, source string, lang string, n_tokens bigint")
    pages = spark.createDataFrame([(1, "http://a.net/x")], "page_id bigint, url string")
    labels = spark.createDataFrame([(1, True)], "page_id bigint, block boolean")
    for frame in (mixing.mix_sources(docs, mixing.Mix(("lang", "source"), {})), url_rules.judge_urls(pages, URL_RULES, labels)):
        plan = frame._jdf.queryExecution().executedPlan().toString()
        assert not any(word in plan for word in ("Python", "Pandas", "Arrow")), plan
    assert F is not None

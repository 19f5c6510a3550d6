"""N-gram Jaccard join with grouped prefixes.

A document's set is its distinct word n-grams. Tokens are ordered by a corpus
frequency sketch, rare first, then by hash; the order steers the work and never
the result. Two sets can only reach the threshold if their prefixes in that order
share a token, so

1. equal sets collapse into a class, and classes with the same prefix and size
   into a group, which stands in the inverted index once;
2. group pairs sharing a token are filtered by size, position and 512-bit parity
   signatures of what follows it, whose differing bits never exceed the differing tokens;
   a pair comes out where it first meets, since a posting knows the tokens before it;
3. the pairs are expanded to their members, filtered by signatures of the whole sets,
   and verified on whole texts.

The wanted result is the components of all links, so links inside a component
already found need no proof. Step 2 and 3 run twice: first every group against
the most central group of its token and size band, then all remaining pairs, which lie
in different components. A token held by one big group of near copies
hence costs its length, not its square, and no link between components is missed.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from qualityforge import runtime
from qualityforge.llm import kernel as K
from qualityforge.llm.components import components, joined
from qualityforge.llm.staging import staged

WORDS = 4
PERCENT = 85
# The frequency sketch has 2 ** bits counters, in chunks of that many.
_BITS = (16, 24)
_CHUNK = 1 << 14
_LANES = 1024
# Posted tokens a posting remembers, by which most later meetings of a pair are told from its first.
_BEFORE = 2
# Tokens of a lower frequency class have fewer than 2 ** 19.5 documents.
_HOT_CLASS = 39
# Bits of a set's signature: the parity of the tokens that hash to each.
_SIGNATURE = 512


def shingles(s: K.Slice, k: int, order: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingles of all documents, ascending within each: (tokens, document, sizes).

    With ``order`` (a frequency class per sketch counter) the class stands in the
    six leading bits of a token.
    """
    words = K.split_words(K.LOWER[s.data], s.offsets)
    tokens, at = K.window_hashes(words.hashes, words.first, k)
    doc = words.doc_of()[at]
    n = np.diff(words.first)
    short = np.flatnonzero((n > 0) & (n < k))
    if len(short):
        whole = [np.bitwise_xor.reduce(K.mix(words.hashes[words.first[d] : words.first[d + 1]] * K._STEP[: n[d]] + np.uint64(n[d]))) for d in short]
        tokens, doc = np.concatenate([tokens, np.array(whole, np.uint64)]), np.concatenate([doc, short])
    if order is not None:
        kind = order[(tokens & np.uint64(len(order) - 1)).astype(np.int64)].astype(np.uint64)
        tokens = (tokens >> np.uint64(6)) | (kind << np.uint64(58))
    by = np.argsort(tokens)
    wide = np.uint16 if len(n) < 1 << 16 else np.int64
    by = by[np.argsort(doc[by].astype(wide), kind="stable")]
    tokens, doc = tokens[by], doc[by]
    fresh = np.ones(len(tokens), bool)
    fresh[1:] = (tokens[1:] != tokens[:-1]) | (doc[1:] != doc[:-1])
    tokens, doc = tokens[fresh], doc[fresh]
    return tokens, doc, np.bincount(doc, minlength=len(n))


def _count(batches, k: int, bits: int):
    from pyspark import TaskContext

    counts = np.zeros(1 << bits, np.int64)
    for batch in batches:
        for s in K.slices(batch.column("text")):
            tokens, _, _ = shingles(s, k)
            counts += np.bincount((tokens & np.uint64((1 << bits) - 1)).astype(np.int64), minlength=1 << bits)
    lane = TaskContext.get().partitionId() % _LANES
    chunks = counts.astype("<u4").reshape(-1, min(_CHUNK, 1 << bits))
    yield pa.RecordBatch.from_arrays(
        [pa.array([lane] * len(chunks), pa.int32()), pa.array(range(len(chunks)), pa.int32()), pa.array([c.tobytes() for c in chunks], pa.binary())],
        names=["lane", "chunk", "counts"],
    )


def _add(part: pd.DataFrame) -> pd.DataFrame:
    total = sum(np.frombuffer(c, "<u4").astype(np.uint64) for c in part["counts"])
    total = np.minimum(total, 0xFFFFFFFF).astype("<u4")
    return pd.DataFrame({"lane": [int(part["lane"].iloc[0])], "chunk": [int(part["chunk"].iloc[0])], "counts": [total.tobytes()]})


def frequency_classes(rows: DataFrame, k: int) -> np.ndarray:
    """Half-octave classes of document counts per hash bucket, over all rows. At most 2 ** 24 bytes."""
    bits = min(_BITS[1], max(_BITS[0], (4 * rows.count()).bit_length()))
    schema = "lane int, chunk int, counts binary"
    parts = rows.select("text").mapInArrow(K.task(_count, k, bits), schema)
    summed = parts.groupBy("lane", "chunk").applyInPandas(_add, schema).groupBy("chunk").applyInPandas(_add, schema)
    found = sorted(summed.select("chunk", "counts").collect())
    if not found:
        return np.zeros(1 << bits, np.uint8)
    counts = np.concatenate([np.frombuffer(r["counts"], "<u4") for r in found])
    return np.minimum(63, 2 * np.log2(counts + 1.0)).astype(np.uint8)


def _prefixes(batches, k: int, percent: int, order):
    for batch in batches:
        for s in K.slices(batch.column("text")):
            tokens, doc, sizes = shingles(s, k, order.value)
            begin = np.cumsum(sizes) - sizes
            take = np.where(sizes > 0, sizes - (percent * sizes + 99) // 100 + 1, 0)
            some = np.flatnonzero(sizes)
            digests = []
            for salt in (1, 2):
                total = np.zeros(len(sizes), np.uint64)
                total[some] = np.add.reduceat(K.mix(tokens ^ np.uint64(salt * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)), begin[some]) if len(some) else 0
                digests.append(total.view(np.int64))
            prefix = K.ragged(tokens, begin, take)
            odd = np.bincount(doc * _SIGNATURE + (tokens & np.uint64(_SIGNATURE - 1)).astype(np.int64), minlength=len(sizes) * _SIGNATURE) & 1
            signature = np.packbits(odd.astype(np.uint8), bitorder="little").view(np.int64)
            per = _SIGNATURE // 64
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("key").slice(s.first, s.last - s.first),
                    pa.array(sizes.astype(np.int64)),
                    *(pa.array(d) for d in digests),
                    pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(take)]), pa.int32()), pa.array(prefix.view(np.int64))),
                    pa.ListArray.from_arrays(pa.array(np.arange(0, len(signature) + 1, per), pa.int32()), pa.array(signature)),
                ],
                names=["key", "n", "d1", "d2", "prefix", "signature"],
            )


def _verify(batches, k: int, percent: int):
    for batch in batches:
        near = []
        sides = [_sets(batch.column(c), k) for c in ("text_a", "text_b")]
        for x, y in zip(*sides):
            common = len(np.intersect1d(x, y, assume_unique=True))
            near.append(100 * common >= percent * (len(x) + len(y) - common) and common > 0)
        yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(near, pa.bool_())], names=["a", "b", "near"])


def _sets(texts, k: int):
    for s in K.slices(texts):
        tokens, _, sizes = shingles(s, k)
        yield from np.split(tokens, np.cumsum(sizes)[:-1])


def _close(percent: int, n1: Column, n2: Column) -> Column:
    return 100 * F.least(n1, n2) >= percent * F.greatest(n1, n2)


def _enough(percent: int, common: Column, n1: Column, n2: Column) -> Column:
    """Whether sets of these sizes can reach the threshold with so many tokens in common."""
    return (100 + percent) * common >= percent * (n1 + n2)


def _alike(percent: int, s1: Column, s2: Column, n1: Column, n2: Column, t1: Column | None = None, t2: Column | None = None) -> Column:
    """Whether signatures allow the threshold: they differ in at most as many bits as the sets in tokens.

    If all common tokens lie in parts of the sets, ``t1`` and ``t2`` are the sizes of these parts and the signatures theirs.
    """
    differing = sum((F.bit_count(s1[i].bitwiseXOR(s2[i])) for i in range(_SIGNATURE // 64)), F.lit(0))
    t1, t2 = n1 if t1 is None else t1, n2 if t2 is None else t2
    return _enough(percent, F.floor((t1 + t2 - differing) / 2), n1, n2)


def _without(signature: Column, tokens: Column) -> Column:
    """The signature of a set after some of its tokens are taken out."""

    def word(bits: Column, w: Column) -> Column:
        inside = F.filter(tokens, lambda t: F.shiftrightunsigned(t, 6).bitwiseAND(F.lit(_SIGNATURE // 64 - 1)) == w)
        return F.aggregate(inside, bits, lambda acc, t: acc.bitwiseXOR(F.call_function("shiftleft", F.lit(1).cast("bigint"), t.bitwiseAND(F.lit(63)).cast("int"))))

    return F.transform(signature, word)


def _tail() -> Column:
    """Tokens of the shorter tail from a shared token on, of postings p and q."""
    return F.least(F.col("p.n") - F.col("p.pos"), F.col("q.n") - F.col("q.pos"))


class PrefixJoin:
    """The tables of one join. ``docs`` needs the key and the text only."""

    def __init__(self, docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = WORDS, percent: int = PERCENT):
        self.words, self.percent = words, percent
        spark = docs.sparkSession
        self.rows = docs.select(F.col(key).cast("bigint").alias("key"), F.col(text).cast("string").alias("text"))
        order = spark.sparkContext.broadcast(frequency_classes(self.rows, words))
        schema = "key bigint, n bigint, d1 bigint, d2 bigint, prefix array<bigint>, signature array<bigint>"
        self.sets = staged(self.rows.mapInArrow(K.task(_prefixes, words, percent, order), schema), "join-sets")
        grouping = F.xxhash64("n", "prefix")
        known = self.sets.filter("n > 0 and key is not null").select("key", "n", "d1", "d2", grouping.alias("g"), F.hash("prefix").alias("g2"))
        self.classes = known.groupBy("n", "d1", "d2", "g", "g2").agg(F.min("key").alias("class"))
        groups = self.classes.groupBy("n", "g", "g2").agg(F.min("class").alias("group"))
        self.members = staged(self.classes.join(groups, ["n", "g", "g2"]).select("group", "class", "n", "d1", "d2"), "join-members")
        # Each group posts its prefix once, through the document that names it.
        posted = self.sets.join(self.members.filter("group = class").select("group", "n", "d1", "d2"), ["n", "d1", "d2"]).filter("key = group")
        postings = posted.select("group", "n", F.posexplode("prefix").alias("pos", "token")).select("group", "n", "token", "pos")
        self.postings = self._shared(postings)

    def _shared(self, postings: DataFrame) -> DataFrame:
        """Postings (group, n, pos, token) that can lead to a partner, with ``own``, ``most`` and the tokens ``before``.

        A token that no other group posts leads nowhere; a group posts a token once, so
        a count tells. The frequency class bounds the rows of most tokens, which are
        counted where they meet; hot ones are counted before they are shuffled. Two groups that qualify
        have their first common token in both prefixes, so neither can have more in
        common with any other than what follows its first posted token: ``most``.
        Groups that fall short by that go. ``own`` counts the tokens of the prefix that
        no other group posts.
        """
        hot = F.shiftrightunsigned("token", 58) >= _HOT_CLASS
        cold = postings.filter(~hot).withColumn("_held", F.count(F.lit(1)).over(W.partitionBy("token"))).filter("_held > 1").drop("_held")
        often = postings.filter(hot)
        held = often.groupBy("token").agg(F.count(F.lit(1)).alias("_held")).filter("_held > 1").select("token")
        rows = cold.unionByName(often.join(held, "token", "left_semi"))
        own = W.partitionBy("group").orderBy("pos")
        rows = rows.withColumn("before", F.collect_list("token").over(own.rowsBetween(-_BEFORE, -1)))
        rows = rows.withColumn("most", F.col("n") - F.first("pos").over(own))
        prefix = F.col("n") - F.floor((self.percent * F.col("n") + 99) / 100) + 1
        rows = rows.withColumn("own", prefix - F.count(F.lit(1)).over(W.partitionBy("group")))
        return staged(rows.filter(100 * F.col("most") >= self.percent * F.col("n")), "join-postings")

    def _verified(self, pairs: DataFrame) -> DataFrame:
        """Pairs (a, b) of classes whose texts reach the threshold, among those whose signatures allow it."""
        marks = self.sets.join(self.members.select("class", "n", "d1", "d2"), ["n", "d1", "d2"]).filter("key = class")
        marks = marks.select("class", "n", "signature").dropDuplicates(["class", "n"])
        pairs = pairs.join(marks.select(F.col("class").alias("a"), F.col("n").alias("na"), F.col("signature").alias("sa")), "a")
        pairs = pairs.join(marks.select(F.col("class").alias("b"), F.col("n").alias("nb"), F.col("signature").alias("sb")), "b")
        alike = _alike(self.percent, F.col("sa"), F.col("sb"), F.col("na"), F.col("nb"))
        pairs = staged(pairs.filter(alike).select("a", "b").distinct(), "join-pairs")
        texts = self.rows.filter("key is not null")
        ends = pairs.select(F.col("a").alias("key")).union(pairs.select("b")).distinct()
        needed = texts.join(ends, "key", "left_semi")
        joined = pairs.join(needed.select(F.col("key").alias("a"), F.col("text").alias("text_a")), "a")
        joined = joined.join(needed.select(F.col("key").alias("b"), F.col("text").alias("text_b")), "b")
        checked = joined.select("a", "b", "text_a", "text_b").mapInArrow(K.task(_verify, self.words, self.percent), "a bigint, b bigint, near boolean")
        return staged(checked.filter("near").select("a", "b"), "join-links")

    def _near_first(self) -> DataFrame:
        """Pairs of classes: members with their group's first, groups with the most central of their token and size band."""
        band = F.floor(F.log(F.col("n").cast("double")) / np.log(100 / self.percent))
        rows = self.postings.withColumn("band", band)
        # The group with fewest tokens of its own is likeliest to be near the others.
        central = F.struct("own", "group")
        firsts = rows.groupBy("token", "band").agg(F.min_by(F.struct("group", "n", "most"), central).alias("first"))
        met = rows.join(firsts, ["token", "band"]).filter("group <> first.group")
        common = F.least(F.col("most"), F.col("first.most"))
        met = met.filter(_enough(self.percent, common, F.col("n"), F.col("first.n")))
        met = met.select(F.col("first.group").alias("a"), F.col("group").alias("b"))
        inside = self.members.filter("group <> class").filter(self._may_differ()).select(F.col("group").alias("a"), F.col("class").alias("b"))
        return met.union(inside).distinct()

    def _may_differ(self) -> Column:
        """Whether different sets of one size can reach the threshold at all."""
        return 100 * (F.col("n") - 1) >= self.percent * (F.col("n") + 1)

    def _across(self, labels: DataFrame) -> DataFrame:
        """All remaining candidate pairs of classes, which lie in different components."""
        found = labels.select(F.col("id").alias("class"), "component")
        members = self.members.join(found, "class", "left")
        members = staged(members.select("group", "class", "n", F.coalesce("component", "class").alias("component")), "join-placed")
        held = members.select("group", "component").distinct()
        rows = self.postings.join(held, "group")
        kinds = rows.groupBy("token", "component").agg(F.count(F.lit(1)).alias("k"))
        main = kinds.groupBy("token").agg(F.max_by("component", F.struct("k", "component")).alias("main"), F.count(F.lit(1)).alias("m")).filter("m > 1")
        rows = rows.join(main.drop("m"), "token")
        rows = staged(self._with_tails(rows), "join-rest")
        # A pair across components has an end outside the token's main one.
        p, q = rows.filter("component <> main").alias("p"), rows.alias("q")
        # A token shared before this one has brought the pair already, or refuted it.
        fresh = ~F.arrays_overlap("p.before", "q.before")
        n1, n2 = F.col("p.n"), F.col("q.n")
        apart = (F.col("p.component") != F.col("q.component")) & ((F.col("q.component") == F.col("q.main")) | (F.col("p.group") < F.col("q.group")))
        # At the first token that two groups share, all they have in common is still to come.
        tails = _alike(self.percent, F.col("p.signature"), F.col("q.signature"), n1, n2, n1 - F.col("p.pos"), n2 - F.col("q.pos"))
        reach = _close(self.percent, n1, n2) & _enough(self.percent, _tail(), n1, n2) & F.coalesce(tails, F.lit(True))
        met = p.join(q, (F.col("p.token") == F.col("q.token")) & apart & fresh & reach)
        pairs = self._bounded(met)
        one = members.select(F.col("group").alias("a"), F.col("class").alias("x"), F.col("component").alias("cx"))
        two = members.select(F.col("group").alias("b"), F.col("class").alias("y"), F.col("component").alias("cy"))
        expanded = pairs.join(one, "a").join(two, "b").filter("cx <> cy").select("x", "y")
        mixed = members.groupBy("group").agg(F.min("component").alias("low"), F.max("component").alias("high")).filter("low <> high").select("group")
        within = members.filter(self._may_differ()).join(mixed, "group", "left_semi")
        inner = within.alias("p").join(within.alias("q"), "group").filter("p.component <> q.component").selectExpr("p.class as x", "q.class as y")
        every = expanded.union(inner).select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).filter("a <> b")
        return every.distinct()

    def _with_tails(self, rows: DataFrame) -> DataFrame:
        """Postings with the ``signature`` of their group's tokens from the posted one on; null if the group has several sets."""
        rows = staged(rows, "join-bridges")
        held = runtime.checked_broadcast(rows.select(F.col("group").alias("key")).distinct())
        marks = self.sets.select("key", "prefix", "signature").join(held, "key", "left_semi")
        several = self.members.filter("group <> class").select(F.col("group").alias("key")).distinct()
        marks = marks.join(several, "key", "left_anti").withColumnRenamed("key", "group")
        return rows.join(marks, "group", "left").withColumn("signature", _without(F.col("signature"), F.slice("prefix", F.lit(1), F.col("pos")))).drop("prefix")

    def _bounded(self, met: DataFrame) -> DataFrame:
        """Group pairs (a, b) from their first shared prefix tokens, by size and position.

        Before the first shared token nothing is shared, so the shorter tail from
        there bounds the rest.
        """
        flip = F.col("p.group") > F.col("q.group")
        pairs = met.select(
            F.least("p.group", "q.group").alias("a"),
            F.greatest("p.group", "q.group").alias("b"),
            F.when(flip, F.col("q.n")).otherwise(F.col("p.n")).alias("na"),
            F.when(flip, F.col("p.n")).otherwise(F.col("q.n")).alias("nb"),
            _tail().alias("tail"),
        )
        bounds = pairs.groupBy("a", "b", "na", "nb").agg(F.max("tail").alias("first"))
        common = F.least("first", F.when(F.col("na") == F.col("nb"), F.col("na") - 1))
        return bounds.filter(_enough(self.percent, common, F.col("na"), F.col("nb"))).select("a", "b")

    def result(self) -> DataFrame:
        first = self._verified(self._near_first())
        labels = components(first)
        second = self._verified(self._across(labels))
        if not second.isEmpty():
            labels = joined(labels, second)
        named = self.members.join(labels.withColumnRenamed("id", "class"), "class", "left")
        named = named.select("n", "d1", "d2", F.coalesce("component", "class").alias("component_id"))
        rows = self.sets.select("key", "n", "d1", "d2").join(named, ["n", "d1", "d2"], "left")
        own = F.when(F.col("key").isNull(), F.lit(None)).when(F.col("n") == 0, F.col("key")).otherwise(F.col("component_id"))
        return rows.select("key", F.col("n").alias("n_shingles"), own.cast("bigint").alias("component_id"))


def _merged_by_key(named: DataFrame, key: str) -> DataFrame:
    """(key, n_shingles, component_id) from components of rows whose keys repeat.

    ``named`` has a row's key, its set size and the ``component`` of its text, named after
    one of the rows. All texts of a key lie in one component, and it is named after its
    smallest key.
    """
    held = named.filter("key is not null and component is not null").select("key", "component").distinct()
    first = held.groupBy("key").agg(F.min("component").alias("first"))
    links = held.join(first, "key").filter("component <> first").select(F.col("component").alias("a"), F.col("first").alias("b"))
    merged = components(links).select(F.col("id").alias("component"), F.col("component").alias("into"))
    held = held.join(merged, "component", "left").withColumn("component", F.coalesce("into", "component"))
    smallest = held.groupBy("component").agg(F.min("key").alias("component_id"))
    of_key = staged(held.select("key", "component").distinct().join(smallest, "component").select("key", "component_id"), "join-keys")
    rows = named.select("key", "n_shingles").join(of_key, "key", "left")
    # A key without any words names itself.
    return rows.select(F.col("key").alias(key), "n_shingles", F.coalesce("component_id", "key").alias("component_id"))


def jaccard_components(docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """(key, n_shingles, component_id) of every row: the smallest key reachable by links.

    Two documents link when 100 * |A and B| >= percent * |A or B|. Texts are
    compared after lower-casing A-Z; a text of fewer than ``words`` words is one
    shingle, without words it is empty and linked with nothing. Null text counts
    as empty; a null key links with nothing and has no component. Rows that
    repeat a key are one node, linked through any of their texts. Other columns
    are not read; an empty table gives no rows.
    """
    keyed = docs.select(F.col(key).cast("bigint").alias("key"), F.col(text).cast("string").alias("text"))
    again = keyed.filter("key is not null").groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    if again.isEmpty():
        return PrefixJoin(keyed, "key", "text", words, percent).result().withColumnRenamed("key", key)
    # A key names several rows: rows are joined under numbers of their own, then by key.
    rows = staged(keyed.withColumn("row", F.when(F.col("key").isNotNull(), F.monotonically_increasing_id())), "join-rows")
    found = PrefixJoin(rows, "row", "text", words, percent).result().withColumnRenamed("key", "row")
    found = staged(found, "join-found")
    named = found.filter("row is not null").join(rows.select("row", "key"), "row")
    # A text without words is in no component.
    named = named.select("key", "n_shingles", F.when(F.col("n_shingles") > 0, F.col("component_id")).alias("component"))
    keyless = found.filter("row is null").select(F.lit(None).cast("bigint").alias(key), "n_shingles", F.lit(None).cast("bigint").alias("component_id"))
    return _merged_by_key(named, key).unionByName(keyless)


def keep_first(docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """One document of every component, the one with the smallest key, with its columns unchanged.

    Rows with a null key stay. Column names that start with ``_near_`` are taken.
    """
    found = jaccard_components(docs, key, text, words, percent)
    lost = staged(found.filter(F.col(key) != F.col("component_id")).select(F.col(key).alias("_near_key")).distinct(), "join-lost")
    return docs.join(runtime.checked_broadcast(lost), F.col(key) == F.col("_near_key"), "left_anti")

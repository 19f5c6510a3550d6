"""Language ID with interpolated Kneser-Ney character models, one per language.

A word's letter runs are read as ``^letters$``; the models predict each letter
and the end from up to three symbols before. Spark counts the 4-grams of all
training documents per language; counts of lower orders are continuation counts
(distinct left neighbours), or plain counts right after ``^``. The models of all
languages share sorted arrays of n-gram hashes, each row holding the smoothed
log-probability in every language, so one binary search serves them all.

A text gets the language with the lowest cross-entropy per symbol. Its score is
the calibrated chance of being right, from the gap to the second language; a text
whose cross-entropy is beyond what its language's own documents show is flagged
as rejected and scores at most one half.

Limits: symbols beyond U+FFFF count as U+FFFD. Every n-gram of every language is
kept, so the model on the driver and the workers grows with the distinct n-grams.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from qualityforge.llm import kernel as K
from qualityforge.llm.staging import staged
from qualityforge.llm.wordcache import WordCache

ORDER = 4
# Steps of the calibration's fit at most, each one aggregation.
_STEPS = 50
# Distinct words a counting task holds before it hands on its counts.
_HELD = 300_000
_UNKNOWN = 1e-5
_BEGIN, _END = 1, 2
_LETTERS = regex.compile(r"\p{L}+")


def letter_runs(word: bytes) -> list[str]:
    return _LETTERS.findall(word.decode("utf-8", "replace").lower())


def symbols(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Code units of all ``^run$`` one after another, and the word each belongs to."""
    marked, owner = [], []
    for i, word in enumerate(words):
        for run in letter_runs(word):
            marked.append(f"\x01{run}\x02")
            owner.append(i)
    units = np.frombuffer("".join(marked).encode("utf-32-le"), np.uint32).astype(np.uint64)
    units = np.where(units > 0xFFFF, np.uint64(0xFFFD), units)
    return units, np.repeat(np.array(owner, np.int64), [len(m) for m in marked])


def grams(units: np.ndarray, n: int) -> np.ndarray:
    """At every symbol the ``n`` units that end there, 16 bits each; 0 where a run is shorter."""
    begin = np.maximum.accumulate(np.where(units == _BEGIN, np.arange(len(units)), 0))
    room = np.arange(len(units)) - begin
    out = np.zeros(len(units), np.uint64)
    for j in range(min(n, len(units))):
        out[j:] |= units[: len(units) - j] << np.uint64(16 * j)
    out[room < n - 1] = 0
    # The opening mark itself is given, never predicted.
    out[units == _BEGIN] = 0
    return out


def count_grams(words: list[bytes], counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """4-grams, and the shorter n-grams that open a run, with their counts."""
    units, owner = symbols(words)
    found, weight = [], []
    for n in range(2, ORDER + 1):
        g = grams(units, n)
        use = g != 0
        if n < ORDER:
            use &= (g >> np.uint64(16 * (n - 1))) == _BEGIN
        found.append(g[use])
        weight.append(counts[owner[use]])
    ids, place = np.unique(np.concatenate(found), return_inverse=True)
    return ids, np.bincount(place, np.concatenate(weight), len(ids)).astype(np.int64)


def _count(batches):
    held: dict[str, dict[bytes, int]] = {}

    def hand_on():
        for lang, bag in held.items():
            ids, n = count_grams(list(bag), np.fromiter(bag.values(), np.int64, len(bag)))
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(ids), pa.string()), pa.array(ids.astype(np.int64)), pa.array(n)], names=["lang", "gram", "n"])
        held.clear()

    for batch in batches:
        langs = batch.column("lang").to_pylist()
        for s in K.slices(batch.column("text")):
            words = K.split_words(s.data, s.offsets)
            doc = words.doc_of()
            here = np.array(langs[s.first : s.last], object)
            for lang in set(here):
                mine = np.flatnonzero((here == lang)[doc])
                _, one, n = np.unique(words.hashes[mine], return_index=True, return_counts=True)
                bag = held.setdefault(lang, {})
                for i, c in zip(mine[one].tolist(), n.tolist()):
                    word = words.text(i)
                    bag[word] = bag.get(word, 0) + c
            if sum(map(len, held.values())) > _HELD:
                yield from hand_on()
    yield from hand_on()


@dataclass
class Model:
    """``keys[n]``, ``logp[n]``: hashes of the n-grams of order n+1 and their log-probabilities by
    language; ``contexts[n]``, ``backoff[n]``: the same for contexts of n symbols."""

    langs: list[str]
    keys: list[np.ndarray]
    logp: list[np.ndarray]
    contexts: list[np.ndarray]
    backoff: list[np.ndarray]
    slope: float = 10.0
    level: float = 0.0
    limit: np.ndarray | None = None


def _tables(ids: np.ndarray, counts: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """N-grams and counts of order 1 to ORDER of one language, from its 4-grams and openings."""
    width = sum((ids >= np.uint64(1) << np.uint64(16 * k)).astype(int) for k in range(ORDER))
    out = [(ids[width == ORDER], counts[width == ORDER])]
    for n in range(ORDER - 1, 0, -1):
        above = out[0][0]
        kinds, left = np.unique(above & np.uint64((1 << (16 * n)) - 1), return_counts=True)
        opening = (width == n) & (n > 1)
        g, c = np.concatenate([kinds, ids[opening]]), np.concatenate([left, counts[opening]])
        order = np.argsort(g)
        out.insert(0, (g[order], c[order]))
    return out


def build(rows: dict[str, tuple[np.ndarray, np.ndarray]]) -> Model:
    """Models from (n-grams, counts) per language."""
    langs = sorted(rows)
    tables = [_tables(*rows[lang]) for lang in langs]
    keys, logp, contexts, backoff = [], [], [], []
    below_ids = below = None
    for n in range(1, ORDER + 1):
        ids = np.unique(np.concatenate([t[n - 1][0] for t in tables]))
        heads = np.unique(ids >> np.uint64(16))
        p, gamma = np.zeros((len(ids), len(langs))), np.ones((len(heads), len(langs)))
        head = np.searchsorted(heads, ids >> np.uint64(16))
        lower = below[np.searchsorted(below_ids, ids & np.uint64((1 << (16 * (n - 1))) - 1))] if n > 1 else np.full(p.shape, _UNKNOWN)
        for k, t in enumerate(tables):
            g, c = t[n - 1]
            if len(g):
                ones, twos = (c == 1).sum(), (c == 2).sum()
                discount = ones / (ones + 2 * twos) if ones and twos else 0.75
                at = np.searchsorted(ids, g)
                total = np.bincount(head[at], c, len(heads))
                kinds = np.bincount(head[at], minlength=len(heads))
                gamma[:, k] = np.where(total > 0, discount * kinds / np.maximum(total, 1), 1.0)
                p[at, k] = np.maximum(c - discount, 0) / total[head[at]]
        p += gamma[head] * lower
        below_ids, below = ids, p
        for values, into, table, where in ((p, logp, ids, keys), (gamma, backoff, heads, contexts)):
            order = np.argsort(K.mix(table))
            where.append(K.mix(table)[order])
            into.append(np.log(values[order]).astype(np.float32))
    return Model(langs, keys, logp, contexts, backoff)


def _find(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(keys):
        return np.zeros(len(wanted), np.int64), np.zeros(len(wanted), bool)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return at, keys[at] == wanted


def word_scores(model: Model, words: list[bytes]) -> np.ndarray:
    """Per word the sum of log-probabilities in every language, then the number of symbols."""
    units, owner = symbols(words)
    wide = len(model.langs)
    total = np.zeros((len(units), wide), np.float32)
    open_ = units != _BEGIN
    left = np.flatnonzero(open_)
    for n in range(ORDER, 0, -1):
        g = grams(units, n)[left]
        fits = g != 0
        at, hit = _find(model.keys[n - 1], K.mix(g))
        hit &= fits
        total[left[hit]] += model.logp[n - 1][at[hit]]
        miss = ~hit
        back, known = _find(model.contexts[n - 1], K.mix(g >> np.uint64(16)))
        known &= miss & fits
        total[left[known]] += model.backoff[n - 1][back[known]]
        left = left[miss]
    total[left] += np.float32(np.log(_UNKNOWN))
    out = np.zeros((len(words), wide + 1))
    for k in range(wide):
        out[:, k] = np.bincount(owner, total[:, k], len(words))
    out[:, wide] = np.bincount(owner[open_], minlength=len(words))
    return out


def _entropies(batch, cache):
    """Slices with cross-entropies by language and number of symbols per document."""
    for s in K.slices(batch.column("text")):
        words = K.split_words(s.data, s.offsets)
        values = np.concatenate([np.zeros((1, cache.wide + 1)), np.cumsum(cache.values(words), axis=0)])
        sums = values[words.first[1:]] - values[words.first[:-1]]
        size = np.rint(sums[:, -1])
        yield s, -sums[:, :-1] / np.maximum(size, 1)[:, None], size


def _cache(model: Model) -> WordCache:
    cache = WordCache.shared("kn", model, lambda words: word_scores(model, words))
    cache.wide = len(model.langs)
    return cache


def _gap(entropy: np.ndarray) -> np.ndarray:
    """How much worse the second language is; large where there is none."""
    if entropy.shape[1] < 2:
        return np.full(len(entropy), 10.0)
    two = np.partition(entropy, 1, axis=1)
    return two[:, 1] - two[:, 0]


def _evidence(entropy: np.ndarray, size: np.ndarray) -> np.ndarray:
    return _gap(entropy) * np.sqrt(size)


def _probe(batches, shared):
    cache = _cache(shared.value)
    for batch in batches:
        langs = batch.column("lang").to_pylist()
        for s, entropy, size in _entropies(batch, cache):
            best = entropy.argmin(1)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("key").slice(s.first, s.last - s.first),
                    pa.array(best.astype(np.int64)),
                    pa.array(entropy.min(1)),
                    pa.array(_evidence(entropy, size)),
                    pa.array([shared.value.langs[b] == lang for b, lang in zip(best, langs[s.first : s.last])]),
                ],
                names=["key", "best", "entropy", "evidence", "right"],
            )


def _predict(batches, shared):
    model = shared.value
    cache = _cache(model)
    for batch in batches:
        valid = np.asarray(batch.column("text").is_valid())
        for s, entropy, size in _entropies(batch, cache):
            best = entropy.argmin(1)
            strange = entropy.min(1) > model.limit[best]
            score = 1 / (1 + np.exp(-np.clip(model.slope * _evidence(entropy, size) + model.level, -500, 500)))
            score = np.where(strange, np.minimum(score, 0.5), score)
            none = (size == 0) | ~valid[s.first : s.last]
            names = np.where(none, "und", np.array(model.langs, object)[best])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("key").slice(s.first, s.last - s.first),
                    pa.array(names, pa.string()),
                    pa.array(np.where(none, 0.0, score)),
                    pa.array(np.where(none, 0.0, entropy.min(1))),
                    pa.array(strange | none),
                ],
                names=["key", "lang_pred", "score", "cross_entropy", "rejected"],
            )


def train(docs: DataFrame, key: str, text: str, lang: str, learn: Column, calibrate: Column) -> Model:
    """Count the rows of ``docs`` for which ``learn`` holds and a language is given; calibrate
    on all of those for which ``calibrate`` holds."""
    spark = docs.sparkSession
    rows = docs.filter(F.col(lang).isNotNull())
    named = [F.col(key).cast("bigint").alias("key"), F.col(text).cast("string").alias("text"), F.col(lang).cast("string").alias("lang")]
    counted = rows.filter(learn).select(*named[1:]).mapInArrow(K.task(_count), "lang string, gram bigint, n bigint")
    table = counted.groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    found = table.toPandas().sort_values(["lang", "gram"])
    if not len(found):
        return Model([], [], [], [], [])
    model = build({name: (part["gram"].to_numpy(np.int64).astype(np.uint64), part["n"].to_numpy(np.int64)) for name, part in found.groupby("lang")})
    model.limit = np.full(len(model.langs), np.inf)
    shared = spark.sparkContext.broadcast(model)
    probe = rows.filter(calibrate).select(*named).mapInArrow(K.task(_probe, shared), "key bigint, best bigint, entropy double, evidence double, right boolean")
    return calibrated(model, staged(probe, "kn-probe"))


def calibrated(model: Model, probe: DataFrame) -> Model:
    """Fit the score to (evidence, right) by smoothed logistic regression, and each
    language's limit to the highest cross-entropy of its own documents plus a tenth.

    All rows take part; the driver receives sums, and quantiles whose rank is within 1/10,000.
    """
    kinds = probe.groupBy("best").agg(F.count(F.lit(1)).alias("n"), F.count_if("right").alias("right")).collect()
    if not kinds:
        return model
    n, right = sum(r["n"] for r in kinds), sum(r["right"] for r in kinds)
    high, low = (right + 1) / (right + 2), 1 / (n - right + 2)
    own = {r["best"]: r["right"] for r in kinds if r["right"] >= 20}
    mine = lambda k: F.when(F.col("right") & (F.col("best") == k), F.col("entropy"))
    ends = [_around(F.col("evidence"), n, 0.5), *[_around(mine(k), m, 0.995) for k, m in own.items()]]
    mid, *most = [_between(e, m, q) for e, m, q in zip(probe.agg(*ends).first(), (n, *own.values()), (0.5, *[0.995] * len(own)))]
    scale = max(mid, 1e-9)
    x, y = F.col("evidence") / scale, F.when(F.col("right"), high).otherwise(low)
    theta = np.zeros(2)
    for _ in range(_STEPS):
        at = F.greatest(F.lit(-30.0), F.least(F.lit(30.0), x * float(theta[0]) + float(theta[1])))
        fitted = probe.select(x.alias("x"), y.alias("y"), (1 / (1 + F.exp(-at))).alias("p"))
        w, off = F.expr("p * (1 - p)"), F.expr("p - y")
        sums = fitted.agg(*[F.sum(c) for c in (w * F.col("x") * F.col("x"), w * F.col("x"), w, off * F.col("x"), off)]).first()
        hessian = np.array([[sums[0], sums[1]], [sums[1], sums[2]]]) + 1e-3 * np.eye(2)
        step = np.linalg.solve(hessian, np.array(sums[3:]) + 1e-3 * theta)
        theta -= step
        if np.abs(step).max() < 1e-10:
            break
    # The order of summing shows in the last digits only.
    model.slope, model.level = (float(f"{v:.12g}") for v in (max(0.0, theta[0] / scale), theta[1]))
    for k, top in zip(own, most):
        model.limit[k] = 1.1 * top
    return model


def _around(value: Column, n: int, q: float) -> Column:
    """The two of ``n`` values between which their ``q`` quantile lies."""
    at = q * (n - 1)
    return F.percentile_approx(value, [(int(at) + 0.5) / n, (int(np.ceil(at)) + 0.5) / n], 10000)


def _between(ends: list[float], n: int, q: float) -> float:
    return ends[0] + (ends[1] - ends[0]) * (q * (n - 1) % 1)


def predict(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, lang_pred, score, cross_entropy, rejected) for every row.

    Null texts and texts without a letter are ``und`` with score 0; so is every
    text for a model that has learned no language. Rows that
    repeat a key are judged one by one. Other columns are not read; an empty
    table gives no rows. No shuffle; the broadcast model holds all 4-grams of
    the training rows and their shorter parts.
    """
    rows = docs.select(F.col(key).cast("bigint").alias("key"), F.col(text).cast("string").alias("text"))
    if not model.langs:
        unknown = rows.selectExpr("key", "'und' as lang_pred", "0D as score", "0D as cross_entropy", "true as rejected")
        return unknown.withColumnRenamed("key", key)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    schema = "key bigint, lang_pred string, score double, cross_entropy double, rejected boolean"
    return rows.mapInArrow(K.task(_predict, shared), schema).withColumnRenamed("key", key)

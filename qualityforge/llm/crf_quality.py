"""Quality rules: counts of a text, then a linear-chain CRF over its lines.

The counts (words, symbols, repeated lines and windows) fail a text at once. Any
other text is judged by its lines: Viterbi decoding marks each line with a word
as content or boilerplate, and the share of words on content lines decides.

The CRF is trained in numpy on a bounded sample of labelled documents. Labels are
given by document, so a per-line classifier is fitted first; in documents of low
quality the lines that it takes for content stay content. Transition and
emission weights are then fitted together by conditional likelihood.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from qualityforge.llm import kernel as K

WINDOW = 5
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
CONTENT_SHARE = 0.5
# Labelled documents per class that the CRF is fitted on.
TRAIN_DOCS = 2000

_SYMBOL = np.zeros(256, bool)
_SYMBOL[np.frombuffer(b"#*$%&|<>", np.uint8)] = True
_DIGIT = np.zeros(256, bool)
_DIGIT[48:58] = True
_CLOSING = np.zeros(256, bool)
_CLOSING[np.frombuffer(b".!?:;,)\"'", np.uint8)] = True

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
FEATURES = 9


@dataclass
class Model:
    """Log-odds of content: by feature, of starting, and by change of label."""

    emission: np.ndarray
    start: float
    change: np.ndarray


@dataclass
class Lines:
    """Lines with a word: their document, number of words and features."""

    doc: np.ndarray
    words: np.ndarray
    features: np.ndarray


def analyse(s: K.Slice) -> tuple[dict[str, np.ndarray], Lines]:
    """Counts of every document of a slice, and its lines."""
    data, offsets = s.data, s.offsets
    words = K.split_words(data, offsets)
    docs = len(offsets) - 1
    solid = ~K.SPACE[data]
    letters = solid & ((data & 0xC0) != 0x80)
    symbols = _SYMBOL[data]

    breaks = np.flatnonzero(data == 10)
    begin = np.sort(np.concatenate([offsets[:-1], breaks + 1]))
    end = np.sort(np.concatenate([breaks, offsets[1:]]))
    doc = np.repeat(np.arange(docs), s.per_doc(data == 10) + 1)
    first_word = np.searchsorted(words.starts, begin)
    n_words = np.searchsorted(words.starts, end) - first_word
    hashes = K.runs_hash(data[data != 10], end - begin)
    full = np.flatnonzero(n_words)
    begin, end, doc, first_word, n_words, hashes = (x[full] for x in (begin, end, doc, first_word, n_words, hashes))

    in_doc = K.mix(hashes + K.mix(doc + 1))
    order = np.argsort(in_doc, kind="stable")
    again = np.zeros(len(full), bool)
    again[order[1:]] = in_doc[order[1:]] == in_doc[order[:-1]]

    repeated = repeated_words(words)
    counts = {
        "n_words": np.diff(words.first),
        "word_chars": s.per_doc(letters),
        "n_symbols": s.per_doc(symbols),
        "n_dup_lines": np.bincount(doc[again], minlength=docs),
        "n_repeat_words": K.count_between(repeated, words.first),
    }
    return counts, Lines(doc, n_words, _features(data, begin, end, first_word, n_words, letters, symbols, again, repeated))


def repeated_words(words: K.Words) -> np.ndarray:
    """Flags words inside a window that its document holds twice or more."""
    hashes, at = K.window_hashes(words.hashes, words.first, WINDOW)
    key = K.mix(hashes + K.mix(words.doc_of()[at] + 1))
    order = np.argsort(key)
    same = key[order[1:]] == key[order[:-1]]
    twice = np.zeros(len(at), bool)
    twice[order[1:]] = same
    twice[order[:-1]] |= same
    step = np.zeros(len(words.hashes) + 1, np.int64)
    step[at[twice]] += 1
    step[at[twice] + WINDOW] -= 1
    return np.cumsum(step)[:-1] > 0


def _features(data, begin, end, first_word, n_words, letters, symbols, again, repeated) -> np.ndarray:
    def between(flags, a, b):
        total = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
        return total[b] - total[a]

    if not len(begin):
        return np.zeros((0, FEATURES))
    chars = np.maximum(between(letters, begin, end), 1)
    # The last byte of the last word may be followed by blanks: the line's own end is close enough.
    closing = _CLOSING[data[end - 1]]
    return np.column_stack(
        [
            np.ones(len(begin)),
            np.log1p(n_words) / 5,
            np.log(chars / n_words) / 2,
            np.minimum(1, 10 * between(symbols, begin, end) / chars),
            np.minimum(1, 5 * between(_DIGIT[data], begin, end) / chars),
            between(repeated, first_word, first_word + n_words) / n_words,
            again,
            closing,
            n_words < 4,
        ]
    ).astype(float)


def base_failed(counts: dict[str, np.ndarray]) -> np.ndarray:
    return (counts["n_words"] < MIN_WORDS) | (100 * counts["n_repeat_words"] > MAX_REPEAT_PERCENT * counts["n_words"])


class _Chains:
    """Sequences of lines stepped side by side: at step t those with a line t."""

    def __init__(self, doc: np.ndarray):
        _, begin, size = np.unique(doc, return_index=True, return_counts=True)
        order = np.argsort(-size, kind="stable")
        self.begin, self.size = begin[order], size[order]
        alive = np.searchsorted(-self.size, -np.arange(1, (size.max() if len(size) else 0) + 1), "right")
        self.steps = [self.begin[:n] + t for t, n in enumerate(alive)]


def viterbi(model: Model, lines: Lines) -> np.ndarray:
    """True for the lines that the best labelling calls content."""
    score = lines.features @ model.emission
    chains = _Chains(lines.doc)
    stay, enter, leave = model.change[1, 1], model.change[0, 1], model.change[1, 0]
    rest = model.change[0, 0]
    margin = np.zeros(len(score))
    from_one = np.zeros((2, len(score)), bool)
    for t, at in enumerate(chains.steps):
        if not t:
            margin[at] = score[at] + model.start
            continue
        m = margin[at - 1]
        from_one[1, at] = m + stay > enter
        from_one[0, at] = m + leave > rest
        margin[at] = score[at] + np.maximum(m + stay, enter) - np.maximum(m + leave, rest)
    content = np.zeros(len(score), bool)
    ends = chains.begin + chains.size - 1
    content[ends] = margin[ends] > 0
    for at in reversed(chains.steps[1:]):
        content[at - 1] = np.where(content[at], from_one[1, at], from_one[0, at])
    return content


def _expected(model: Model, features: np.ndarray, chains: _Chains) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Marginals of content by line, expected label pairs, and of the first lines."""
    n = len(features)
    one = features @ model.emission
    forward, backward = np.zeros((n, 2)), np.zeros((n, 2))
    for t, at in enumerate(chains.steps):
        if not t:
            forward[at, 1] = one[at] + model.start
            continue
        before = forward[at - 1]
        for y in (0, 1):
            forward[at, y] = np.logaddexp(before[:, 0] + model.change[0, y], before[:, 1] + model.change[1, y]) + one[at] * y
    pairs = np.zeros((2, 2))
    for at in reversed(chains.steps[1:]):
        ahead = backward[at] + np.stack([np.zeros(len(at)), one[at]], 1)
        for y in (0, 1):
            backward[at - 1, y] = np.logaddexp(ahead[:, 0] + model.change[y, 0], ahead[:, 1] + model.change[y, 1])
        joint = forward[at - 1][:, :, None] + model.change + ahead[:, None, :]
        joint = np.exp(joint - joint.max((1, 2), keepdims=True))
        pairs += (joint / joint.sum((1, 2), keepdims=True)).sum(0)
    both = forward + backward
    content = 1 / (1 + np.exp(np.clip(both[:, 0] - both[:, 1], -500, 500)))
    return content, pairs, content[chains.begin]


def fit(lines: Lines, good: np.ndarray, rounds: int = 200, rate: float = 0.1, ridge: float = 1e-3) -> Model:
    """Train on lines of documents, ``good`` telling each line's document label.

    Without lines of both kinds every line is content.
    """
    if not len(good) or good.all() or not good.any():
        return Model(np.zeros(FEATURES), 1.0, np.zeros((2, 2)))
    x, weight = lines.features, np.where(good, 0.5 / good.sum(), 0.5 / (~good).sum())
    plain = np.zeros(FEATURES)
    for grad in _adam(plain, rounds, rate):
        p = 1 / (1 + np.exp(-(x @ plain)))
        grad[:] = x.T @ (weight * (p - good)) + ridge * plain
    label = (good | (x @ plain > 0)).astype(float)

    chains = _Chains(lines.doc)
    seen = np.zeros((2, 2))
    for at in chains.steps[1:]:
        np.add.at(seen, (label[at - 1].astype(int), label[at].astype(int)), 1)
    theta = np.concatenate([plain, np.zeros(5)])
    n = len(label)
    for grad in _adam(theta, rounds, rate / 2):
        model = _model(theta)
        content, pairs, start = _expected(model, x, chains)
        grad[:FEATURES] = x.T @ (content - label) / n
        grad[FEATURES] = (start - label[chains.begin]).sum() / n
        grad[FEATURES + 1 :] = ((pairs - seen) / n).ravel()
        grad += ridge * theta
    return _model(theta)


def _model(theta: np.ndarray) -> Model:
    return Model(theta[:FEATURES], float(theta[FEATURES]), theta[FEATURES + 1 :].reshape(2, 2))


def _adam(theta: np.ndarray, rounds: int, rate: float):
    """Yield a gradient to fill, then step ``theta`` in place."""
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    for i in range(1, rounds + 1):
        grad = np.zeros_like(theta)
        yield grad
        m += 0.1 * (grad - m)
        v += 0.01 * (grad * grad - v)
        theta -= rate * (m / (1 - 0.9**i)) / (np.sqrt(v / (1 - 0.99**i)) + 1e-8)


def _line_rows(batches):
    for batch in batches:
        for s in K.slices(batch.column("text")):
            _, lines = analyse(s)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("key").slice(s.first, s.last - s.first).take(pa.array(lines.doc)),
                    batch.column("good").slice(s.first, s.last - s.first).take(pa.array(lines.doc)),
                    pa.array(list(lines.features), pa.list_(pa.float64())),
                ],
                names=["key", "good", "features"],
            )


def train(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", good: str = "quality", per_class: int = TRAIN_DOCS) -> Model:
    """Fit on at most ``per_class`` labelled documents of each class (the first by hash of the key)."""
    rows = labels.select(F.col(key).alias("key"), (F.col(good) == 1).alias("good")).filter("key is not null and good is not null").distinct()
    chosen = None
    for flag in (True, False):
        part = rows.filter(F.col("good") == flag).orderBy(F.md5(F.col("key").cast("string")), "key").limit(per_class)
        chosen = part if chosen is None else chosen.unionByName(part)
    # At most 2 * per_class rows of (key, flag).
    sample = docs.select(F.col(key).alias("key"), F.col(text).alias("text")).join(F.broadcast(chosen), "key")
    found = sample.mapInArrow(K.task(_line_rows), "key bigint, good boolean, features array<double>").toPandas()
    found = found.sort_values("key", kind="stable")
    features = np.array(found["features"].tolist()) if len(found) else np.zeros((0, FEATURES))
    return fit(Lines(found["key"].to_numpy(), np.ones(len(found)), features), found["good"].to_numpy(bool))


def _judge(batches, model: Model, share: float):
    for batch in batches:
        for s in K.slices(batch.column("text")):
            counts, lines = analyse(s)
            docs = s.last - s.first
            content = viterbi(model, lines)
            on_content = np.bincount(lines.doc[content], lines.words[content], docs)
            portion = on_content / np.maximum(counts["n_words"], 1)
            failed = base_failed(counts)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("key").slice(s.first, docs),
                    *(pa.array(counts[c].astype(np.int64)) for c in COUNTS),
                    pa.array(failed),
                    pa.array(portion),
                    pa.array(~failed & (portion >= share)),
                ],
                names=["key", *COUNTS, "base_failed", "content_share", "kept"],
            )


def judge(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text", share: float = CONTENT_SHARE) -> DataFrame:
    """Counts, base_failed, content_share and kept for every row.

    Null text counts as empty; texts without a word fail. Rows that repeat a key
    are judged one by one; a null key stays null. Other columns are not read; an
    empty table gives no rows. No shuffle.
    """
    columns = ", ".join(f"{c} bigint" for c in COUNTS)
    rows = docs.select(F.col(key).cast("bigint").alias("key"), F.col(text).cast("string").alias("text"))
    out = rows.mapInArrow(K.task(_judge, model, share), f"key bigint, {columns}, base_failed boolean, content_share double, kept boolean")
    return out.withColumnRenamed("key", key)


def _keep(batches, model: Model, share: float, text: int):
    for batch in batches:
        kept = []
        for s in K.slices(batch.column(text)):
            counts, lines = analyse(s)
            content = viterbi(model, lines)
            on_content = np.bincount(lines.doc[content], lines.words[content], s.last - s.first)
            kept.append(~base_failed(counts) & (on_content / np.maximum(counts["n_words"], 1) >= share))
        yield batch.filter(pa.array(np.concatenate(kept) if kept else np.zeros(0, bool)))


def keep_good(docs: DataFrame, model: Model, text: str = "text", share: float = CONTENT_SHARE) -> DataFrame:
    """The rows that ``judge`` keeps, with all their columns, without a shuffle."""
    at = docs.columns.index(text)
    return docs.mapInArrow(K.task(_keep, model, share, at), docs.schema)

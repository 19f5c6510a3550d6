"""Toxicity: subword-bag embeddings averaged into a linear softmax.

A word's vector is the mean of the embeddings of its character n-grams (hashed
into a fixed table) and of the whole word, so misspellings never seen still share
vectors. The words of a window are averaged and a linear softmax gives the class;
a text scores as its most toxic window, so length does not dilute it. Embeddings
and softmax are trained together in numpy: every round takes each labelled
text's currently highest window and follows the gradient of the log loss.

With two classes only the difference of the softmax rows matters, so a text's
score needs one number per distinct word. Those numbers are computed once per
word and worker and averaged over all windows of whole texts.

A run longer than any word (scripts without blanks, joined words) is read as
overlapping pieces of a word's size, each of which counts as a word.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from qualityforge.llm import kernel as K
from qualityforge.llm.wordcache import WordCache

BUCKETS = 1 << 17
DIM = 16
GRAMS = (3, 4, 5, 6)
WINDOW = 64
# Labelled documents per class that the model is fitted on.
TRAIN_DOCS = 2000
ROUNDS = 200
# An n-gram takes part if the classes differ in it by so many standard errors, lest rare words learn single labels.
TELLING = 4.0
RATE = 2.0
DECAY = 0.001
# Longer runs are no words: they are read in pieces of PIECE bytes that overlap by all but one byte of the longest n-gram.
WORD_BYTES = 64
PIECE = 16
OVERLAP = max(GRAMS) - 1


@dataclass
class Model:
    """``grams[i]`` is the logit that n-gram bucket ``i`` speaks for, ``bias`` the window's own."""

    grams: np.ndarray
    bias: float


@dataclass
class Pieces(K.Words):
    """Words and pieces of long runs; ``cut`` is 1 where a run goes on before the piece, plus 2 where it goes on after it."""

    cut: np.ndarray

    def text(self, i: int) -> bytes:
        """The bytes, with a blank (which no word holds) where the run goes on."""
        return b" " * (self.cut[i] & 1) + super().text(i) + b" " * (self.cut[i] >> 1)


def in_pieces(words: K.Words) -> Pieces:
    """``words`` with every run longer than ``WORD_BYTES`` as consecutive overlapping pieces."""
    size, step = words.ends - words.starts, PIECE - OVERLAP
    many = np.where(size > WORD_BYTES, -(-(size - OVERLAP) // step), 1)
    run = np.repeat(np.arange(len(size)), many)
    place = np.arange(len(run)) - np.repeat(np.cumsum(many) - many, many)
    starts, ends, hashes = words.starts[run] + place * step, words.ends[run], words.hashes[run]
    part = np.flatnonzero(many[run] > 1)
    ends[part] = np.minimum(ends[part], starts[part] + PIECE)
    cut = (place > 0) + 2 * (place < many[run] - 1)
    length = ends[part] - starts[part]
    hashes[part] = K.mix(K.runs_hash(K.ragged(words.data, starts[part], length), length) + cut[part].astype(np.uint64))
    return Pieces(words.data, starts, ends, hashes, np.concatenate([[0], np.cumsum(many)])[words.first], cut)


def _wrapped(word: bytes) -> bytes:
    """Lower-cased without marks at its ends, which are marked unless they are cuts."""
    bare = word.lower().strip(b".,;:!?()\"'")
    return (b"" if bare[:1] == b" " else b"<") + bare + (b"" if bare[-1:] == b" " else b">")


def word_grams(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Concatenated buckets of all words, and how many each word has.

    Vectorised over bytes: words are padded into a matrix, and the hash of every
    n-gram is a product-sum of its bytes.
    """
    wrapped = [_wrapped(w) for w in words]
    size = np.array([len(w) for w in wrapped], np.int64)
    if not len(size):
        return np.zeros(0, np.int64), size
    data = np.frombuffer(b"".join(wrapped), np.uint8)
    begin = np.cumsum(size) - size
    owner = np.repeat(np.arange(len(size)), size)
    left = np.repeat(begin + size, size) - np.arange(len(data))
    ids, owners = [K.runs_hash(data, size) % np.uint64(BUCKETS)], [np.arange(len(size))]
    value = K.mix(data.astype(np.uint64) + np.uint64(1))
    for n in GRAMS:
        at = np.flatnonzero(left >= n)
        total = np.full(len(at), n, np.uint64)
        for j in range(n):
            total = total * np.uint64(0x9E3779B97F4A7C15) + value[at + j]
        ids.append(K.mix(total) % np.uint64(BUCKETS))
        owners.append(owner[at])
    owners = np.concatenate(owners)
    order = np.argsort(owners, kind="stable")
    return np.concatenate(ids)[order].astype(np.int64), np.bincount(owners, minlength=len(size))


def _grams_in_parts(words: list[bytes], part: int = 20_000) -> tuple[np.ndarray, np.ndarray]:
    found = [word_grams(words[i : i + part]) for i in range(0, len(words), part)]
    return np.concatenate([ids.astype(np.int32) for ids, _ in found]), np.concatenate([size for _, size in found])


def _vocabulary(texts: list[bytes]) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """Distinct words, each word's place among them, and the index of every text's first word."""
    hashes, many, held = [], [], {}
    for s in K.slices(pa.array(texts, pa.large_binary())):
        words = in_pieces(K.split_words(s.data, s.offsets))
        distinct, one, _ = K.unique_words(words)
        for h, i in zip(distinct.tolist(), one.tolist()):
            if h not in held:
                held[h] = words.text(i)
        hashes.append(words.hashes)
        many.append(np.diff(words.first))
    distinct, place = np.unique(np.concatenate(hashes), return_inverse=True)
    return [held[h] for h in distinct.tolist()], place.astype(np.int32), np.concatenate([[0], np.cumsum(np.concatenate(many))])


def word_logits(model_grams: np.ndarray, words: list[bytes]) -> np.ndarray:
    if not words:
        return np.zeros(0)
    ids, size = _grams_in_parts(words)
    return np.add.reduceat(model_grams[ids], np.cumsum(size) - size) / size


def windows(first: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Begin and size of every text's windows (half a width apart), and its text's index."""
    step = max(1, width // 2)
    n = np.diff(first)
    many = np.where(n > 0, np.maximum(1, -(-(n - step) // step)), 0)
    doc = np.repeat(np.arange(len(n)), many)
    place = np.arange(len(doc)) - np.repeat(np.cumsum(many) - many, many)
    begin = first[doc] + place * step
    return begin, np.minimum(width, first[doc + 1] - begin), doc


def window_logits(per_word: np.ndarray, first: np.ndarray, bias: float) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    begin, size, doc = windows(first, WINDOW)
    total = np.concatenate([[0.0], np.cumsum(per_word)])
    # A short text counts as one padded to the window with words that say nothing.
    return (total[begin + size] - total[begin]) / WINDOW + bias, begin, size, doc


def _telling(ids: np.ndarray, size: np.ndarray, place: np.ndarray, first: np.ndarray, toxic: np.ndarray) -> np.ndarray:
    """Buckets whose share of toxic and of other texts differs by at least ``TELLING`` standard errors."""
    seen = np.zeros((2, BUCKETS))
    begin = np.cumsum(size) - size
    for d in range(len(toxic)):
        own = np.unique(place[first[d] : first[d + 1]])
        seen[int(toxic[d]), np.unique(K.ragged(ids, begin[own], size[own]))] += 1
    many = np.array([(~toxic).sum(), toxic.sum()])
    pooled = seen.sum(0) / many.sum()
    error = np.sqrt(pooled * (1 - pooled) * (1 / many).sum())
    return np.abs(seen[1] / many[1] - seen[0] / many[0]) >= np.maximum(TELLING * error, 1e-12)


def fit(texts: list[bytes], toxic: np.ndarray, rounds: int = ROUNDS, seed: int = 5) -> Model:
    """Train on whole texts. Without texts of both kinds every window gets their common class."""
    if not len(texts) or toxic.all() or not toxic.any():
        return Model(np.zeros(BUCKETS), 4.0 if len(texts) and toxic.all() else -4.0)
    vocabulary, place, first = _vocabulary(texts)
    if not len(place):
        return Model(np.zeros(BUCKETS), 0.0)
    ids, size = _grams_in_parts(vocabulary)
    telling = _telling(ids, size, place, first, toxic)
    # Only telling n-grams move; a word's mean still counts all it has.
    moving = np.flatnonzero(telling[ids])
    word = np.searchsorted(np.cumsum(size), moving, "right")
    ids = ids[moving]
    part = 1 / size[word]
    rng = np.random.default_rng(seed)
    grams = rng.normal(0, 0.1, (BUCKETS, DIM)) * telling[:, None]
    row, bias = rng.normal(0, 0.1, DIM), 0.0
    speed, row_speed, bias_speed = np.full((BUCKETS, 1), 1e-8), 1e-8, 1e-8
    balance = np.where(toxic, 0.5 / toxic.sum(), 0.5 / (~toxic).sum())
    begin, width, doc = windows(first, WINDOW)
    text, head = np.unique(doc, return_index=True)
    for _ in range(rounds):
        logit_of = np.bincount(word, (grams @ row)[ids] * part, len(size))
        total = np.concatenate([[0.0], np.cumsum(logit_of[place])])
        logits = (total[begin + width] - total[begin]) / WINDOW + bias
        best = np.maximum.reduceat(logits, head)
        # The first of a text's highest windows.
        hits = np.flatnonzero(logits == np.repeat(best, np.diff(np.append(head, len(doc)))))
        top = hits[np.unique(doc[hits], return_index=True)[1]]
        error = (1 / (1 + np.exp(-best)) - toxic[text]) * balance[text]
        # Each n-gram's share of the error, through its window and its word.
        used = K.ragged(place, begin[top], width[top])
        per_word = np.bincount(used, np.repeat(error / WINDOW, width[top]), len(size))
        share = np.bincount(ids, per_word[word] * part, BUCKETS)
        grad_row, grad = grams.T @ share, share[:, None] * row
        speed += (grad**2).mean(1, keepdims=True)
        row_speed += (grad_row**2).mean()
        bias_speed += error.sum() ** 2
        grams -= RATE * grad / np.sqrt(speed) + DECAY * grams
        row -= 0.1 * grad_row / np.sqrt(row_speed)
        bias -= 0.2 * error.sum() / np.sqrt(bias_speed)
    return Model(grams @ row, bias)


def train(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", flag: str = "toxic", per_class: int = TRAIN_DOCS) -> Model:
    """Fit on at most ``per_class`` labelled documents of each class (the first by hash of the key)."""
    rows = labels.select(F.col(key).alias("key"), (F.col(flag) == 1).alias("toxic")).filter("key is not null and toxic is not null").distinct()
    chosen = None
    for wanted in (True, False):
        part = rows.filter(F.col("toxic") == wanted).orderBy(F.md5(F.col("key").cast("string")), "key").limit(per_class)
        chosen = part if chosen is None else chosen.unionByName(part)
    sample = docs.select(F.col(key).alias("key"), F.encode(F.coalesce(F.col(text), F.lit("")), "UTF-8").alias("text"))
    # At most 2 * per_class rows; their texts are the bounded training sample.
    found = sample.join(F.broadcast(chosen), "key").toPandas().sort_values("key", kind="stable")
    return fit([bytes(t) for t in found["text"]], found["toxic"].to_numpy(bool))


def _score(batches, model_grams, bias: float):
    cache = WordCache.shared("toxicity", model_grams.value, lambda words: word_logits(model_grams.value, words))
    for batch in batches:
        for s in K.slices(batch.column("text")):
            words = in_pieces(K.split_words(s.data, s.offsets))
            logits, _, _, doc = window_logits(cache.values(words), words.first, bias)
            best = np.full(s.last - s.first, -np.inf)
            np.maximum.at(best, doc, logits)
            best[np.isinf(best)] = min(bias, -4.0)
            yield pa.RecordBatch.from_arrays(
                [batch.column("key").slice(s.first, s.last - s.first), pa.array(1 / (1 + np.exp(-np.clip(best, -500, 500))))],
                names=["key", "score"],
            )


def score(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, score between 0 and 1) for every row; higher is more likely toxic.

    Null text counts as empty; a text without words scores low. Rows that repeat
    a key are scored one by one. Other columns are not read; an empty table gives
    no rows. No shuffle; the broadcast model has a fixed size (1 MB).
    """
    rows = docs.select(F.col(key).cast("bigint").alias("key"), F.col(text).cast("string").alias("text"))
    shared = docs.sparkSession.sparkContext.broadcast(model.grams)
    return rows.mapInArrow(K.task(_score, shared, model.bias), "key bigint, score double").withColumnRenamed("key", key)

"""Document quality from a linear-chain conditional random field over lines.

Every line of a text is good or bad. A line's features are shares of kinds of characters, its length and
its repetition within the text, in steps, for the line itself and its two neighbours. The field has a
weight for each feature and for each pair of labels in sequence. It is fitted by maximum likelihood on a
bounded sample of labelled documents, whose lines take the document's label. A text's score is the
mean probability that its lines are good, by the forward-backward algorithm, weighted by their lengths.

Features of a batch of texts are sums over its bytes; the recursions advance all its texts by one line
at a time. A text of very many lines is read in segments and its recursions advance in blocks, so memory is
some forty bytes a line.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Most documents of each label that are fitted, and most bytes of a document among them.
SAMPLE, SAMPLE_BYTES = 1500, 20_000

ROUNDS, RATE, PENALTY = 150, 0.2, 1e-4

#: Bytes that are turned into features at once; a longer text, or one of more than MANY lines, is read in
#: segments, of whose lines a few numbers each are kept.
BLOCK, MANY, SEGMENT = 1 << 20, 1 << 13, 1 << 15

# Kinds of bytes.
OTHER, UPPER, LOWER, DIGIT, BLANK, STOP, PIPE, MARK, SHOUT, HIGH, TAIL = range(11)


def _kinds() -> np.ndarray:
    kinds = np.full(256, OTHER, np.uint8)
    for kind, chars in (
        (UPPER, "ABCDEFGHIJKLMNOPQRSTUVWXYZ"),
        (LOWER, "abcdefghijklmnopqrstuvwxyz"),
        (DIGIT, "0123456789"),
        (BLANK, " \t\r\x0b\x0c"),
        (STOP, ".,;:'\"()-"),
        (PIPE, "|<>{}[]\\/"),
        (MARK, "*$&%#@^~=+_"),
        (SHOUT, "!?"),
    ):
        kinds[list(chars.encode())] = kind
    kinds[0xC0:] = HIGH
    kinds[0x80:0xC0] = TAIL
    return kinds


KINDS = _kinds()

#: Bounds of the steps of each share of a line's characters.
STEPS = {
    UPPER: (0.02, 0.1, 0.3, 0.6),
    LOWER: (0.2, 0.5, 0.7),
    DIGIT: (0.001, 0.05, 0.2),
    BLANK: (0.05, 0.1, 0.15, 0.22, 0.3),
    STOP: (0.005, 0.02, 0.06),
    PIPE: (0.001, 0.02, 0.06),
    MARK: (0.001, 0.03, 0.1),
    SHOUT: (0.001, 0.03, 0.1),
    HIGH: (0.001, 0.05, 0.2),
}
LENGTHS = (1, 10, 40, 100, 250, 600, 2000)
#: Bounds of the steps of the share of a line's words that repeat the one or two words before them.
ECHOES = (0.01, 0.1, 0.3, 0.6)
OWN = sum(len(s) + 1 for s in STEPS.values()) + len(LENGTHS) + 1 + len(ECHOES) + 1 + 5
FEATURES = 3 * OWN + 3


@dataclass
class Lines:
    """The lines of some texts: features, lengths in characters (at least 1), and first line of each text."""

    features: np.ndarray
    lengths: np.ndarray
    starts: np.ndarray


def _one_hot(values: np.ndarray, bounds: tuple[float, ...]) -> np.ndarray:
    return np.searchsorted(bounds, values, side="right")[:, None] == np.arange(len(bounds) + 1)


def _words(joined: np.ndarray, kinds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places and hashes of all words, whatever their marks and case; used as features only."""
    place = np.arange(len(joined), dtype=np.int32)
    inside = (kinds != BLANK) & (joined != 10)
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    starts = np.flatnonzero(first)
    if not len(starts):
        return starts, np.zeros(0, np.uint64)
    since = (place - np.maximum.accumulate(np.where(inside, np.int32(-1), place))).astype(np.uint64)
    lowered = np.where(kinds == UPPER, joined + np.uint8(32), joined)
    hashed = (lowered + np.uint64(1)) * (since * np.uint64(0x9E3779B97F4A7C15) + np.uint64(0xD1B54A32D192ED03))
    hashed ^= hashed >> np.uint64(29)
    hashed *= inside & (kinds != STOP)
    return starts, np.add.reduceat(hashed, starts) * np.uint64(0xBF58476D1CE4E5B9)


@dataclass
class Own:
    """What lines tell by themselves: features but the last, which says that a line is repeated in its text;
    a hash of the words, lengths in characters, and whether a line is empty."""

    features: np.ndarray
    token: np.ndarray
    lengths: np.ndarray
    empty: np.ndarray


def own_of(joined: np.ndarray) -> Own:
    """The lines of some bytes that end with a line break."""
    ends = np.flatnonzero(joined == 10)
    n = len(ends)
    begins = np.concatenate(([0], ends[:-1] + 1))
    kinds = KINDS[joined]
    size = ends - begins
    kinds_of_lines = np.repeat(np.arange(n, dtype=np.int32) * 11, size + 1) + kinds
    counts = np.bincount(kinds_of_lines, minlength=11 * n).reshape(n, 11)
    chars = size - counts[:, TAIL]
    lengths = np.maximum(1, chars)
    parts = [_one_hot(counts[:, k] / lengths, STEPS[k]) for k in STEPS]
    parts.append(_one_hot(chars, LENGTHS))
    place, word = _words(joined, kinds)
    line = np.searchsorted(begins, place, side="right") - 1
    echo = np.zeros(len(word), bool)
    for k in (1, 2):
        echo[k:] |= (word[k:] == word[:-k]) & (line[k:] == line[:-k])
    words = np.bincount(line, minlength=n)
    parts.append(_one_hot(np.bincount(line, echo, n) / np.maximum(1, words), ECHOES))
    empty = size == 0
    first, last = kinds[begins], kinds[np.maximum(begins, ends - 1)]
    # Lines with the same words in order are repeated.
    rank = (np.arange(len(word)) - np.repeat(np.cumsum(words) - words, words)).astype(np.uint64)
    placed = (word ^ (word >> np.uint64(32))) * (rank * np.uint64(0x9E3779B97F4A7C15) + np.uint64(0xD1B54A32D192ED03))
    token = np.zeros(n, np.uint64)
    some = np.flatnonzero(words)
    if len(some):
        token[some] = np.add.reduceat(placed, (np.cumsum(words) - words)[some])
    parts.append(np.stack([empty, (first == UPPER) & ~empty, (last == STOP) & ~empty, (last == SHOUT) & ~empty, np.zeros(n, bool)], 1))
    return Own(np.concatenate(parts, 1).astype(np.float32), token, lengths, empty)


def _repeated(token: np.ndarray, owner: np.ndarray, empty: np.ndarray) -> np.ndarray:
    """Which lines that are not empty have the words of another line of their text."""
    some = np.flatnonzero(~empty)
    token, owner = token[some], owner[some]
    order = np.lexsort((token, owner))
    same = (owner[order][1:] == owner[order][:-1]) & (token[order][1:] == token[order][:-1])
    out = np.zeros(len(empty), bool)
    out[some[order[1:][same]]] = True
    out[some[order[:-1][same]]] = True
    return out


def lines_of(texts: list[bytes]) -> Lines:
    """Features of all lines; an empty text is one empty line."""
    joined = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
    found = own_of(joined)
    own, n = found.features, len(found.token)
    text_ends = np.cumsum([len(t) + 1 for t in texts]) - 1
    lines_upto = np.searchsorted(np.flatnonzero(joined == 10), text_ends, side="right")
    starts = np.concatenate(([0], lines_upto[:-1]))
    owner = np.repeat(np.arange(len(texts)), np.diff(np.append(starts, n)))
    # Empty lines have no words, so that a line of marks alone is repeated by another such line only.
    own[:, -1] = _repeated(found.token, owner, found.empty)
    ahead, behind = np.zeros_like(own), np.zeros_like(own)
    ahead[:-1], behind[1:] = own[1:], own[:-1]
    is_first = np.zeros(n, bool)
    is_first[starts] = True
    is_last = np.append(is_first[1:], True)
    ahead[is_last] = 0
    behind[is_first] = 0
    edges = np.stack([np.ones(n), is_first, is_last], 1).astype(np.float32)
    return Lines(np.concatenate((own, ahead, behind, edges), 1), found.lengths.astype(float), starts)


@dataclass
class Field:
    """Weights of the features for the label good, of the pairs of labels, and the share of good documents."""

    weights: np.ndarray
    pairs: np.ndarray
    prior: float


def _marginals(scores: np.ndarray, starts: np.ndarray, pairs: np.ndarray, with_pairs: bool = False):
    """Probability of good for each line, and the expected counts of pairs if asked for.

    ``scores`` is the log-odds of good by the features alone. Texts advance together, longest first.
    """
    n = len(scores)
    count = np.diff(np.append(starts, n))
    order = np.argsort(-count, kind="stable")
    first, count = starts[order], count[order]
    emit = np.stack([-scores / 2, scores / 2], 1)
    emit = np.exp(emit - emit.max(1, keepdims=True))
    step = np.exp(pairs - pairs.max())
    ahead, back = np.empty((n, 2)), np.ones((n, 2))
    longest = int(count[0]) if len(count) else 0
    live = np.searchsorted(-count, -np.arange(longest), side="left")
    for t in range(longest):
        at = first[: live[t]] + t
        value = emit[at] if t == 0 else (ahead[at - 1] @ step) * emit[at]
        ahead[at] = value / value.sum(1, keepdims=True)
    for t in range(longest - 2, -1, -1):
        at = first[: live[t + 1]] + t
        value = (emit[at + 1] * back[at + 1]) @ step.T
        back[at] = value / value.sum(1, keepdims=True)
    both = ahead * back
    good = both[:, 1] / both.sum(1)
    if not with_pairs:
        return good, None
    inner = np.ones(n, bool)
    inner[starts] = False
    at = np.flatnonzero(inner)
    joint = ahead[at - 1][:, :, None] * step[None] * (emit[at] * back[at])[:, None, :]
    joint /= joint.sum((1, 2), keepdims=True)
    return good, joint.sum(0)


def _chain_marginals(scores: np.ndarray, pairs: np.ndarray) -> np.ndarray:
    """Probability of good for each line of one long text, as `_marginals` gives it.

    The text is cut to as many blocks as each has lines. A block's steps multiply to one step, over which
    messages go from block to block; then all blocks advance together, each from the message it got.
    """
    n = len(scores)
    width = max(1, math.isqrt(n))
    blocks = -(-n // width)
    padded = np.zeros(blocks * width, np.float32)
    padded[:n] = scores
    step = np.exp(pairs - pairs.max())

    def emit(t: int) -> np.ndarray:
        own = padded[t::width].astype(float)
        value = np.stack([-own / 2, own / 2], 1)
        return np.exp(value - value.max(1, keepdims=True))

    def unit(x: np.ndarray, axes: tuple[int, ...]) -> np.ndarray:
        return x / x.sum(axes, keepdims=True)

    # Each block's whole step: from the label before its first line to that of its last.
    whole = np.broadcast_to(np.eye(2), (blocks, 2, 2))
    for t in range(width):
        whole = unit(whole @ step * emit(t)[:, None, :], (1, 2))
    into = np.empty((blocks, 2))
    message = np.ones(2)
    for k in range(blocks):
        into[k] = message
        # The first line of all has no label before it.
        message = unit(message @ whole[k], (0,)) if k else None
        if k == 0:
            message = emit(0)[0]
            for t in range(1, width):
                message = unit(message @ step * emit(t)[0], (0,))
    good = np.empty(blocks * width, np.float32)
    ahead = into
    for t in range(width):
        value = ahead @ step * emit(t)
        if t == 0:
            value[0] = emit(0)[0]
        ahead = unit(value, (1,))
        good[t::width] = ahead[:, 1]
    # Back: the last block ends with the text; padding behind it takes no part.
    last = n - (blocks - 1) * width
    back_into = np.ones((blocks, 2))
    message = np.ones(2)
    for k in range(blocks - 1, 0, -1):
        if k == blocks - 1:
            for t in range(last - 1, -1, -1):
                message = unit(step @ (emit(t)[k] * message), (0,))
        else:
            message = unit(whole[k] @ message, (0,))
        back_into[k - 1] = message
    back = back_into
    for t in range(width - 1, -1, -1):
        if t >= last:  # beyond the end of the last block
            held = back[-1].copy()
        both = good[t::width].astype(float)
        yes, no = both * back[:, 1], (1 - both) * back[:, 0]
        good[t::width] = yes / (yes + no)
        back = unit((emit(t) * back) @ step.T, (1,))
        if t >= last:
            back[-1] = held
    return good[:n].astype(float)


def _score_long(text: bytes, field: Field) -> float:
    """The quality of one text, whose lines are read in blocks; of a line only a few numbers are kept."""
    by = [field.weights[k * OWN : (k + 1) * OWN] for k in range(3)]
    n = text.count(b"\n") + 1
    mid, ahead, behind = (np.empty(n, np.float32) for _ in by)
    token, lengths, empty = np.empty(n, np.uint64), np.empty(n, np.int32), np.empty(n, bool)
    at = line = 0
    while at <= len(text):
        end = min(at + SEGMENT, len(text))
        if end < len(text):
            cut = text.rfind(b"\n", at, end)
            cut = text.find(b"\n", end) if cut < at else cut
            end = len(text) if cut < 0 else cut
        found = own_of(np.frombuffer(text[at:end] + b"\n", np.uint8))
        here = slice(line, line + len(found.token))
        for part, w in zip((mid, ahead, behind), by):
            part[here] = found.features @ w
        token[here], lengths[here], empty[here] = found.token, found.lengths, found.empty
        at, line = end + 1, here.stop
    again = _repeated(token, np.zeros(len(token), np.int8), empty)
    for part, w in zip((mid, ahead, behind), by):
        part += again * w[-1]
    edges = field.weights[3 * OWN :]
    scores = mid + edges[0]
    scores[:-1] += ahead[1:]
    scores[1:] += behind[:-1]
    scores[0] += edges[1]
    scores[-1] += edges[2]
    del mid, ahead, behind, token, empty
    return float((_chain_marginals(scores, field.pairs) * lengths).sum() / lengths.sum())


def train(lines: Lines, labels: np.ndarray) -> Field:
    """Maximum likelihood with a small penalty; every line has its document's label, every document the
    same weight per line."""
    n = len(lines.features)
    of = np.repeat(labels, np.diff(np.append(lines.starts, n))).astype(float)
    inner = np.ones(n, bool)
    inner[lines.starts] = False
    at = np.flatnonzero(inner)
    seen = np.zeros((2, 2))
    np.add.at(seen, (of[at - 1].astype(int), of[at].astype(int)), 1)
    w, pairs = np.zeros(lines.features.shape[1]), np.zeros((2, 2))
    w2, pairs2 = np.full_like(w, 1e-8), np.full_like(pairs, 1e-8)
    for _ in range(ROUNDS):
        good, joint = _marginals(lines.features @ w.astype(np.float32), lines.starts, pairs, True)
        step = lines.features.T @ ((of - good) / n).astype(np.float32) - PENALTY * w
        step_pairs = (seen - joint) / n - 10 * PENALTY * pairs
        w2 += step**2
        pairs2 += step_pairs**2
        w += RATE * step / np.sqrt(w2)
        pairs += RATE * step_pairs / np.sqrt(pairs2)
    return Field(w.astype(np.float32), pairs, float(labels.mean()))


def sample(docs: DataFrame, labels: DataFrame, key: str = "doc_id") -> DataFrame:
    """(text, label) of at most ``SAMPLE`` documents of each label, by a hash of the key, none beyond
    ``SAMPLE_BYTES``. Keys alone are drawn; the few texts are then read by a broadcast of them."""
    known = labels.where("label IS NOT NULL").select(F.col(key).alias("__key"), F.col("label").cast("int").alias("label"))
    sizes = docs.select(F.col(key).alias("__key"), F.octet_length("text").alias("bytes"))
    rows = sizes.where(F.col("bytes").between(1, SAMPLE_BYTES)).join(known, "__key").withColumn("draw", F.xxhash64("__key"))
    picked = [rows.where(F.col("label") == v).orderBy("draw", "__key").limit(SAMPLE) for v in (0, 1)]
    drawn = picked[0].unionByName(picked[1]).select("__key", "label")
    texts = docs.where(F.octet_length("text").between(1, SAMPLE_BYTES)).select(F.col(key).alias("__key"), F.col("text").cast("binary").alias("text"))
    return texts.join(F.broadcast(drawn), "__key").orderBy(F.xxhash64("__key"), "text").limit(2 * SAMPLE)


def fit(docs: DataFrame, labels: DataFrame, key: str = "doc_id") -> Field:
    """The field fitted on a sample of ``docs`` (key, text) with ``labels`` (key, label of 0 or 1).

    The share of good documents, which an empty text is scored by, is that of the sample; it is even
    unless a label has few documents. Without both labels nothing else is known.
    """
    rows = sample(docs, labels, key).select("text", "label").toArrow()
    labels_, texts = rows["label"].to_numpy().astype(float), rows["text"].to_pylist()
    if len(set(labels_.tolist())) < 2:
        return Field(np.zeros(FEATURES, np.float32), np.zeros((2, 2)), float(labels_.mean()) if len(labels_) else 0.5)
    parts = [lines_of(part) for part in _batches(texts)]
    before = np.cumsum([0, *[len(p.lengths) for p in parts]])
    return train(
        Lines(
            np.concatenate([p.features for p in parts]),
            np.concatenate([p.lengths for p in parts]),
            np.concatenate([p.starts + n for p, n in zip(parts, before)]),
        ),
        labels_,
    )


def _batches(texts: list[bytes]) -> Iterator[list[bytes]]:
    part, size, lines = [], 0, 0
    for text in texts:
        part.append(text)
        size += len(text) + 1
        lines += text.count(b"\n")
        if size >= BLOCK or lines >= 8 * MANY:
            yield part
            part, size, lines = [], 0, 0
    if part:
        yield part


def score(texts: list[bytes | None], field: Field) -> np.ndarray:
    """Quality of each text from 0 to 1."""
    texts = [t or b"" for t in texts]
    out = np.zeros(len(texts))
    long = np.array([len(t) > BLOCK or t.count(b"\n") > MANY for t in texts], bool)
    for i in np.flatnonzero(long):
        out[i] = _score_long(texts[i], field)
    short = np.flatnonzero(~long)
    at = 0
    for part in _batches([texts[i] for i in short]):
        lines = lines_of(part)
        good, _ = _marginals(lines.features @ field.weights, lines.starts, field.pairs)
        weight = np.add.reduceat(lines.lengths, lines.starts)
        value = np.add.reduceat(good * lines.lengths, lines.starts) / weight
        out[short[at : at + len(part)]] = np.where([len(t) > 0 for t in part], value, field.prior)
        at += len(part)
    return np.clip(out, 0, 1)


def scorer(spark: SparkSession, field: Field):
    """A function of a binary column of texts; the broadcast holds a few hundred numbers."""
    shared = spark.sparkContext.broadcast(field)

    @F.pandas_udf("double")
    def quality(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series(score(texts.tolist(), shared.value))

    return quality


def with_quality(docs: DataFrame, field: Field, text: str = "text", out: str = "score") -> DataFrame:
    """Adds the quality of each whole text, from 0 to 1; higher is better.

    A null or empty text gets the share of good documents in the sample. Rows that repeat are scored
    alike, and an empty table gives no rows. All columns are kept; ``out`` names the new one.
    """
    kept = [F.col(c) for c in docs.columns if c != out]
    return docs.select(*kept, scorer(docs.sparkSession, field)(F.col(text).cast("binary")).alias(out))

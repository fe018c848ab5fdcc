"""Toxicity of texts by a bidirectional gated recurrent network with attention pooling, in numpy.

A text is read as words, runs of letters lower-cased in A-Z, in windows of 32 words that begin every 16
words. The input of a word is its own vector, if the sample held it in several documents, and the summed
vectors of its characters, each once with both neighbours and once with up to five before it in the word.
Two gated recurrent layers read a window forwards and backwards; attention over their states pools it into one vector, and that into
a score. A text is as toxic as its most toxic window.

The network is fitted to a bounded sample of labelled documents by Adam. As labels mark whole texts, each
step goes back through the highest window of a document, and for clean ones one more. Scoring reads
all overlapping windows of every whole text in one pass without a shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.common import PrefixHash
from strata.llm.quality import sample
from strata.llm.term_audit import pointers

#: Words of a window, words between the beginnings of two, and most bytes of a word: longer runs are cut.
WINDOW, STRIDE, LONGEST = 32, 16, 64

#: Sizes of word and character vectors, of each direction's state, and of the attention.
WIDTH, HIDDEN, ATTENTION = 8, 8, 8

#: Kinds of characters with their neighbours, and with up to BEFORE bytes of the word before them.
AROUND, LEADING, BEFORE = 1 << 12, 1 << 15, 7

#: Most words with a vector of their own, and fewest documents of the sample that hold such a word, at
#: least one in RARE of them.
VOCABULARY, LEAST, RARE = 10_000, 3, 200

ROUNDS, BATCH, RATE, PENALTY, DROPPED = 6, 64, 0.005, 1e-5, 0.2

#: Fewest steps of the fit, which a small sample takes in more rounds.
STEPS = 200

#: Documents added to both sides of the odds of a word.
SMOOTHING = 5

#: Bytes read at once; a longer text is read in pieces that share a window.
BLOCK = 1 << 20

NEIGHBOURS = np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D], np.uint32)


@dataclass
class Words:
    """The words of some texts: numbers in the vocabulary, two kinds of each character, and where a word's begin."""

    known: np.ndarray
    chars: np.ndarray
    begins: np.ndarray
    owner: np.ndarray


@dataclass
class Network:
    """Weights by name, and the sorted hashes of the words that have vectors; word 0 is any other."""

    weights: dict[str, np.ndarray]
    words: np.ndarray

    def read(self, texts: list[bytes]) -> Words:
        known, chars, begins, owner = tokens(texts)
        return Words(self.numbers(known), chars, begins, owner)

    def numbers(self, hashes: np.ndarray) -> np.ndarray:
        if not len(self.words):
            return np.zeros(len(hashes), np.int64)
        at = np.minimum(np.searchsorted(self.words, hashes), len(self.words) - 1)
        return np.where(self.words[at] == hashes, at + 1, 0)


def tokens(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hash of each word, two kinds of each of its characters in a row, where each word's begin, and its text."""
    raw = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
    ends = np.cumsum([len(t) + 1 for t in texts])
    letters, starts, sizes, owner = pointers(raw, ends)
    pieces = -(-sizes // LONGEST)
    if len(pieces) and pieces.max() > 1:
        nth = np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        starts, sizes, owner = (np.repeat(x, pieces) for x in (starts, sizes, owner))
        starts = starts + nth * LONGEST
        sizes = np.minimum(sizes - nth * LONGEST, LONGEST)
    prefixes = PrefixHash(letters)
    where = np.flatnonzero(letters)
    word = np.repeat(np.arange(len(starts)), sizes)
    inside = where - starts[word]
    reach = np.minimum(inside, BEFORE)
    leading = prefixes.of(where - reach, reach + 1) + (inside <= BEFORE).astype(np.uint64)
    leading = (leading * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - (LEADING.bit_length() - 1))
    # Neighbours beyond a word, or beyond a piece of a long run, count as none.
    near = np.concatenate(([0], letters, [0])).astype(np.uint32)
    before = np.where(inside > 0, near[where], 0).astype(np.uint32)
    behind = np.where(inside < sizes[word] - 1, near[where + 2], 0).astype(np.uint32)
    mixed = before * NEIGHBOURS[0] + near[where + 1] * NEIGHBOURS[1] + behind * NEIGHBOURS[2]
    mixed ^= mixed >> np.uint32(15)
    around = (mixed * np.uint32(0x27D4EB2F)) >> np.uint32(32 - (AROUND.bit_length() - 1))
    kinds = np.stack([around.astype(np.int64), leading.astype(np.int64) + AROUND], 1).ravel()
    return prefixes.of(starts, sizes), kinds, 2 * (np.cumsum(sizes) - sizes), owner


def windows(owner: np.ndarray, texts: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of the words of every window, -1 behind the end of a short text, and the text of each window."""
    size = np.bincount(owner, minlength=texts)
    first = np.cumsum(size) - size
    count = np.where(size > 0, 1 + -(-np.maximum(size - WINDOW, 0) // STRIDE), 0)
    of = np.repeat(np.arange(texts), count)
    nth = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
    # The last window ends with the text.
    start = np.minimum(nth * STRIDE, np.maximum(size[of] - WINDOW, 0))
    place = start[:, None] + np.arange(WINDOW)
    return np.where(place < size[of][:, None], place + first[of][:, None], -1), of


def fresh(words: int, seed: int = 11) -> dict[str, np.ndarray]:
    rng = np.random.default_rng(seed)

    def random(*shape: int) -> np.ndarray:
        return (rng.standard_normal(shape) / np.sqrt(shape[0])).astype(np.float32)

    weights = {
        "word": (rng.standard_normal((words + 1, WIDTH)) * 0.05).astype(np.float32),
        "char": (rng.standard_normal((AROUND + LEADING, WIDTH)) * 0.02).astype(np.float32),
        "attend": random(2 * HIDDEN, ATTENTION),
        "attend_bias": np.zeros(ATTENTION, np.float32),
        "focus": random(ATTENTION),
        "out": random(2 * HIDDEN),
        "out_bias": np.zeros(1, np.float32),
    }
    weights["word"][0] = 0
    for way in ("ahead", "back"):
        weights[f"{way}_in"] = random(2 * WIDTH, 3 * HIDDEN)
        weights[f"{way}_bias"] = np.zeros(3 * HIDDEN, np.float32)
        weights[f"{way}_state"] = random(HIDDEN, 3 * HIDDEN)
    return weights


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


def inputs(words: Words, weights: dict[str, np.ndarray]) -> np.ndarray:
    """The vector of every word, and one of zeros at the end, for places behind a text."""
    out = np.zeros((len(words.known) + 1, 2 * WIDTH), np.float32)
    if len(words.known):
        out[:-1, :WIDTH] = weights["word"][words.known]
        sums = np.add.reduceat(weights["char"][words.chars], words.begins, axis=0)
        out[:-1, WIDTH:] = sums / np.sqrt(np.diff(np.append(words.begins, len(words.chars))))[:, None]
    return out


def _gates(x: np.ndarray, h: np.ndarray, state: np.ndarray) -> tuple[np.ndarray, ...]:
    """Update, reset, candidate, the state's part of the candidate, and the new state."""
    by = h @ state
    both = _sigmoid(x[:, : 2 * HIDDEN] + by[:, : 2 * HIDDEN])
    update, reset = both[:, :HIDDEN], both[:, HIDDEN:]
    part = by[:, 2 * HIDDEN :]
    candidate = np.tanh(x[:, 2 * HIDDEN :] + reset * part)
    return update, reset, candidate, part, candidate + update * (h - candidate)


def forward(places: np.ndarray, vectors: np.ndarray, weights: dict[str, np.ndarray], trace: list | None = None) -> np.ndarray:
    """The logit of each window; ``trace`` gets what going back needs."""
    many = len(places)
    states = np.zeros((WINDOW, many, 2 * HIDDEN), np.float32)
    steps = {}
    for way, begin in (("ahead", 0), ("back", HIDDEN)):
        given = vectors @ weights[f"{way}_in"] + weights[f"{way}_bias"]
        h = np.zeros((many, HIDDEN), np.float32)
        order = range(WINDOW) if way == "ahead" else range(WINDOW - 1, -1, -1)
        for t in order:
            before = h
            *gates, h = _gates(given[places[:, t]], h, weights[f"{way}_state"])
            states[t, :, begin : begin + HIDDEN] = h
            if trace is not None:
                steps[way, t] = (before, *gates)
    tuned = np.tanh(states @ weights["attend"] + weights["attend_bias"])
    focus = tuned @ weights["focus"] - 1e4 * (places.T < 0)
    share = np.exp(focus - focus.max(0))
    share /= share.sum(0)
    pooled = np.einsum("tb,tbh->bh", share, states)
    if trace is not None:
        trace += [states, steps, tuned, share, pooled]
    return pooled @ weights["out"] + weights["out_bias"][0]


def backward(error: np.ndarray, places: np.ndarray, vectors: np.ndarray, words: Words, weights: dict[str, np.ndarray], trace: list) -> dict[str, np.ndarray]:
    """Gradients of all weights from those of the logits."""
    states, steps, tuned, share, pooled = trace
    grads = {"out": pooled.T @ error, "out_bias": error.sum(keepdims=True)}
    d_pooled = error[:, None] * weights["out"]
    d_share = np.einsum("bh,tbh->tb", d_pooled, states)
    d_focus = share * (d_share - (share * d_share).sum(0))
    grads["focus"] = np.einsum("tb,tba->a", d_focus, tuned)
    d_tuned = d_focus[:, :, None] * weights["focus"] * (1 - tuned * tuned)
    grads["attend"] = np.einsum("tbh,tba->ha", states, d_tuned)
    grads["attend_bias"] = d_tuned.sum((0, 1))
    d_states = share[:, :, None] * d_pooled + d_tuned @ weights["attend"].T
    d_vectors = np.zeros_like(vectors)
    for way, begin in (("ahead", 0), ("back", HIDDEN)):
        state = weights[f"{way}_state"]
        d_given = np.zeros((len(vectors), 3 * HIDDEN), np.float32)
        d_state = np.zeros_like(state)
        d_h = np.zeros((len(places), HIDDEN), np.float32)
        order = range(WINDOW - 1, -1, -1) if way == "ahead" else range(WINDOW)
        for t in order:
            before, update, reset, candidate, part = steps[way, t]
            d_h = d_h + d_states[t, :, begin : begin + HIDDEN]
            d_candidate = d_h * (1 - update) * (1 - candidate * candidate)
            d_update = d_h * (before - candidate) * update * (1 - update)
            d_reset = d_candidate * part * reset * (1 - reset)
            d_x = np.hstack([d_update, d_reset, d_candidate])
            d_by = np.hstack([d_update, d_reset, d_candidate * reset])
            np.add.at(d_given, places[:, t], d_x)
            d_state += before.T @ d_by
            d_h = d_h * update + d_by @ state.T
        grads[f"{way}_state"] = d_state
        grads[f"{way}_bias"] = d_given.sum(0)
        grads[f"{way}_in"] = vectors.T @ d_given
        d_vectors += d_given @ weights[f"{way}_in"].T
    grads["word"], grads["char"] = np.zeros_like(weights["word"]), np.zeros_like(weights["char"])
    used = np.flatnonzero(np.bincount(places[places >= 0], minlength=len(words.known)))
    np.add.at(grads["word"], words.known[used], d_vectors[used, :WIDTH])
    sizes = np.diff(np.append(words.begins, len(words.chars)))[used]
    at = np.repeat(words.begins[used], sizes) + np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    np.add.at(grads["char"], words.chars[at], np.repeat(d_vectors[used, WIDTH:] / np.sqrt(sizes)[:, None], sizes, axis=0))
    return grads


def log_odds(toxic: np.ndarray, clean: np.ndarray, labels: np.ndarray) -> np.ndarray:
    """Smoothed log-odds of label 1, halved and at most 2 either way, of what so many documents of each label hold."""
    odds = np.log((toxic + SMOOTHING) / (labels.sum() + SMOOTHING)) - np.log((clean + SMOOTHING) / ((1 - labels).sum() + SMOOTHING))
    return np.clip(odds / 2, -2, 2)


def vocabulary(hashes: list[np.ndarray], labels: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of most documents, in order, and the log-odds of each."""
    once = [np.unique(h) for h in hashes]
    found, at = np.unique(np.concatenate(once), return_inverse=True)
    label = np.repeat(labels, [len(h) for h in once]).astype(bool)
    toxic, clean = (np.bincount(at[of], minlength=len(found)) for of in (label, ~label))
    often = np.flatnonzero(toxic + clean >= max(LEAST, len(labels) // RARE))
    often = np.sort(often[np.argsort(-(toxic + clean)[often], kind="stable")[:VOCABULARY]])
    return found[often], log_odds(toxic[often], clean[often], labels)


def train(texts: list[bytes], labels: np.ndarray, rounds: int = ROUNDS, seed: int = 5) -> Network:
    """The network of some texts with labels of 0 or 1. Words and characters start from log-odds in one component."""
    read = [tokens([t]) for t in texts]
    words, odds = vocabulary([r[0] for r in read], labels)
    network = Network(fresh(len(words)), words)
    weights = network.weights
    weights["word"][1:, 0] = odds
    held = np.zeros((2, AROUND + LEADING))
    for r, label in zip(read, labels):
        held[int(label), np.unique(r[1])] += 1
    weights["char"][:, 0] = log_odds(held[1], held[0], labels)
    docs = [Words(network.numbers(h), c, b, o) for h, c, b, o in read]
    full = np.array([i for i, d in enumerate(docs) if len(d.known)])
    rng = np.random.default_rng(seed)
    balance = np.where(labels == 1, 0.5 / max(labels.sum(), 1), 0.5 / max((1 - labels).sum(), 1)) * len(labels)
    mean = {k: np.zeros_like(w) for k, w in weights.items()}
    square = {k: np.zeros_like(w) for k, w in weights.items()}
    step = 0
    rounds = max(rounds, -(-STEPS * BATCH // max(1, len(full))))
    for turn in range(rounds):
        rng.shuffle(full)
        for at in range(0, len(full), BATCH):
            step += 1
            chosen = full[at : at + BATCH]
            batch = joined([docs[i] for i in chosen])
            batch.known = np.where(rng.random(len(batch.known)) < DROPPED, 0, batch.known)
            places, of = windows(batch.owner, len(chosen))
            vectors = inputs(batch, weights)
            logits = forward(places, vectors, weights)
            top = _highest(logits, of)
            extra = rng.integers(0, len(of), len(chosen))
            extra = extra[labels[chosen[of[extra]]] == 0]
            picked = np.unique(np.concatenate([top, extra]))
            trace: list = []
            logits = forward(places[picked], vectors, weights, trace)
            which = chosen[of[picked]]
            error = ((_sigmoid(logits) - labels[which]) * balance[which] / len(picked)).astype(np.float32)
            grads = backward(error, places[picked], vectors, batch, weights, trace)
            rate = RATE * (1 - turn / rounds)
            for k, w in weights.items():
                g = grads[k] + PENALTY * w
                mean[k] += 0.1 * (g - mean[k])
                square[k] += 0.01 * (g * g - square[k])
                w -= rate * (mean[k] / (1 - 0.9**step)) / (np.sqrt(square[k] / (1 - 0.99**step)) + 1e-6)
    return network


def joined(docs: list[Words]) -> Words:
    chars = np.cumsum([0, *[len(d.chars) for d in docs]])
    return Words(
        np.concatenate([d.known for d in docs]),
        np.concatenate([d.chars for d in docs]),
        np.concatenate([d.begins + n for d, n in zip(docs, chars)]),
        np.repeat(np.arange(len(docs)), [len(d.known) for d in docs]),
    )


def _highest(logits: np.ndarray, of: np.ndarray) -> np.ndarray:
    """The window of the highest logit of each text that has windows."""
    order = np.lexsort((-logits, of))
    first = np.ones(len(order), bool)
    first[1:] = np.diff(of[order]) != 0
    return order[first]


def fit(docs: DataFrame, labels: DataFrame, key: str = "doc_id") -> Network:
    """The network fitted on a sample of ``docs`` (key, text) with ``labels`` (key, label of 0 or 1).

    The sample is that of `quality.sample`: at most ``quality.SAMPLE`` documents of each label, by a hash of
    the key, none of more than ``quality.SAMPLE_BYTES``. Without both labels every text with words scores 0.5.
    """
    rows = sample(docs, labels, key).select("text", "label").toArrow()
    marks, texts = rows["label"].to_numpy().astype(float), rows["text"].to_pylist()
    if len(set(marks.tolist())) < 2:
        network = Network(fresh(0), np.zeros(0, np.uint64))
        network.weights["out"][:] = 0
        return network
    return train(texts, marks)


def _pieces(text: bytes) -> list[bytes]:
    """A long text in pieces of whole windows, each beginning with the last window of the one before."""
    out, at, size = [], 0, BLOCK
    while len(text) - at > size:
        letters, starts, sizes, _ = pointers(np.frombuffer(text[at : at + size], np.uint8), np.array([size]))
        pieces = -(-sizes // LONGEST)
        whole = int(pieces[:-1].sum()) + max(0, int(pieces[-1]) - 1) if len(pieces) else 0  # the last may go on
        last = (whole - WINDOW) // STRIDE * STRIDE
        if last < STRIDE:
            size *= 2  # too few words to get on
            continue
        before = np.cumsum(pieces) - pieces

        def place(word: int) -> tuple[int, int]:
            run = int(np.searchsorted(before, word, side="right")) - 1
            begin = int(starts[run] + (word - before[run]) * LONGEST)
            return begin, min(begin + LONGEST, int(starts[run] + sizes[run]))

        # Up to the end of its last window, whose beginning begins the next piece.
        out.append(text[at : at + place(last + WINDOW - 1)[1]])
        at += place(last)[0]
        size = BLOCK
    return [*out, text[at:]]


def score(texts: list[bytes | None], network: Network) -> np.ndarray:
    """Toxicity of each text from 0 to 1, that of its highest window; 0 without words."""
    out = np.zeros(len(texts))
    part: list[bytes] = []
    owners: list[int] = []

    def add() -> None:
        words = network.read(part)
        if not len(words.known):
            return
        places, of = windows(words.owner, len(part))
        logits = forward(places, inputs(words, network.weights), network.weights)
        np.maximum.at(out, np.array(owners)[of], _sigmoid(logits.astype(np.float64)))

    held = 0
    for i, text in enumerate(texts):
        for piece in _pieces(text or b""):
            part.append(piece)
            owners.append(i)
            held += len(piece)
            if held >= BLOCK:
                add()
                part.clear(), owners.clear()
                held = 0
    if part:
        add()
    # Matrix products of another batch may differ in the last bits.
    return np.round(out, 5)


def scorer(spark: SparkSession, network: Network):
    """A function of a binary column of texts; the broadcast holds at most ``VOCABULARY`` words' vectors."""
    shared = spark.sparkContext.broadcast(network)

    @F.pandas_udf("double")
    def toxicity(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series(score(texts.tolist(), shared.value))

    return toxicity


def with_toxicity(docs: DataFrame, network: Network, text: str = "text", out: str = "score") -> DataFrame:
    """Adds the toxicity of each whole text, from 0 to 1; higher is more toxic.

    A null or empty text, or one without letters, gets 0. Rows that repeat are scored alike, and an empty
    table gives no rows. All columns are kept; ``out`` names the new one, in place of one of that name.
    """
    kept = [F.col(c) for c in docs.columns if c != out]
    return docs.select(*kept, scorer(docs.sparkSession, network)(F.col(text).cast("binary")).alias(out))

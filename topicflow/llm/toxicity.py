"""Toxicity: a bidirectional gated recurrent network with attention pooling over character and word inputs.

Each step of the network is a word. Its input is the word's own vector, if it is in the vocabulary, beside the sum
of the vectors of its character 3-, 5- and 7-grams (with the word's borders). Two gated recurrent layers read a window of
``WINDOW`` words from both ends; an attention layer weighs their states, and the pooled state gives the window's log
odds. Softsign, x / (1 + |x|), stands for the hyperbolic tangent throughout: numpy computes it several times faster.
All overlapping windows of a text are scored, one every ``STRIDE`` words and one at its end; a logistic layer over their
greatest, upper and mean values and their sum gives the text's score.

All is trained in numpy on the driver, on at most ``max_rows`` labelled texts of at most ``max_chars`` characters (those
with the smallest hashes of their ids, half of them of each label as far as there are, one text for each id and label);
these bounds are parameters and don't depend on the data. A third of them is kept apart for the last layer. Scores cover
the whole texts of all rows, in one pass without a shuffle; each distinct word of a run of texts (about 1 MB) has its
input worked out once.

Defined results: a null text is an empty one; a text without words has one empty window and a score; equal texts
score alike, up to single-precision sums; label rows without id or label are passed over, different labels of a text all
count; without any label, every score is 0.5; with labels of one kind, all scores are one constant; an empty table gives
no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from topicflow.llm.common import Words, finish, free_name, utf8_column

MAX_ROWS, MAX_CHARS, THRESHOLD = 3000, 10_000, 0.7
WINDOW, STRIDE = 24, 16
WORDS, GRAMS, SIZES, SEEN, DROPPED = 1024, 4096, (3, 5, 7), 6, 0.3
WORD_DIM, GRAM_DIM, HIDDEN, ATTENTION = 6, 10, 8, 8
EPOCHS, PER_TEXT, BATCH, RATE, DECAY = 6, 4, 256, 0.006, 0.02
_BLOCK, _RUN_BYTES = 2048, 1 << 20
_FACTOR = np.uint64(0x9E3779B97F4A7C15)

Weights = dict[str, np.ndarray]


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


def _soft(x: np.ndarray) -> np.ndarray:
    return x / (1 + np.abs(x))


def _slope(value: np.ndarray) -> np.ndarray:
    """The derivative of ``_soft`` where it has this value."""
    return np.square(1 - np.abs(value))


def _ranges(first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """first[0], first[0] + 1, ... size[0] of them, then those of first[1], ..."""
    return np.arange(int(size.sum())) + np.repeat(first - (np.cumsum(size) - size), size)


def grams_of(words: Words, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the character n-grams of chosen words, and for each the number of its word."""
    size = words.end[which] - words.start[which]
    flat = np.full(int(size.sum()) + 2 * len(which), 32, np.uint8)
    owner = np.repeat(np.arange(len(which)), size)
    flat[np.arange(len(owner)) + 2 * owner + 1] = words.data[_ranges(words.start[which], size)]
    word = np.repeat(np.arange(len(which)), size + 2)
    letters = flat.astype(np.uint64) + np.uint64(1)
    grams, owners, value = [], [], np.zeros(len(flat), np.uint64)
    for n in range(1, max(SIZES) + 1):
        value = value[: len(flat) - n + 1] * _FACTOR + letters[n - 1:]
        if n in SIZES and len(value):
            inside = word[n - 1:] == word[: len(value)]
            grams.append(finish(value[inside] + np.uint64(n)))
            owners.append(word[: len(value)][inside])
    return np.concatenate([np.empty(0, np.int64), *grams]), np.concatenate([np.empty(0, np.int64), *owners])


def windows_of(first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text, first word and number of words of all windows; text i has the words first[i] to first[i + 1] - 1."""
    n = np.diff(first)
    count = 1 + np.maximum(-(-(n - WINDOW) // STRIDE), 0)
    text = np.repeat(np.arange(len(n)), count)
    place = _ranges(np.zeros(len(n), np.int64), count) * STRIDE
    return text, first[:-1][text] + np.minimum(place, np.maximum(n - WINDOW, 0)[text]), np.minimum(n, WINDOW)[text]


@dataclass
class Vocabulary:
    """Hashes and their numbers, found through a table by their low bits; one of two with equal bits isn't found."""

    hashes: np.ndarray
    slots: np.ndarray

    @classmethod
    def of(cls, hashes: np.ndarray) -> Vocabulary:
        slots = np.full(1 << max(4, 5 + len(hashes).bit_length()), -1, np.int32)
        slots[hashes & (len(slots) - 1)] = np.arange(len(hashes))
        return cls(np.append(hashes, -1), slots)

    def numbers(self, hashes: np.ndarray) -> np.ndarray:
        """-1 for those that aren't in it."""
        at = np.take(self.slots, hashes & (len(self.slots) - 1))
        return np.where(np.take(self.hashes, at) == hashes, at, -1)


@dataclass
class Inputs:
    """Rows of the vector tables for distinct words: their own (-1: none) and those of their n-grams."""

    word: np.ndarray
    gram: np.ndarray
    owner: np.ndarray

    @classmethod
    def of(cls, words: Words, which: np.ndarray, known_words: Vocabulary, known_grams: Vocabulary) -> Inputs:
        grams, owner = grams_of(words, which)
        gram = known_grams.numbers(grams)
        turn = np.flatnonzero(gram >= 0)
        turn = turn[np.argsort(owner[turn], kind="stable")]
        return cls(known_words.numbers(words.hash[which]), gram[turn], owner[turn])

    def chosen(self, rows: np.ndarray) -> Inputs:
        first, last = np.searchsorted(self.owner, rows), np.searchsorted(self.owner, rows, "right")
        at = _ranges(first, last - first)
        return Inputs(self.word[rows], self.gram[at], np.repeat(np.arange(len(rows)), last - first))

    def thinned(self, rng: np.random.Generator) -> Inputs:
        """Without a random part of the words and n-grams, so that none is relied on alone."""
        keep = rng.random(len(self.gram)) >= DROPPED
        return Inputs(np.where(rng.random(len(self.word)) < DROPPED, -1, self.word), self.gram[keep], self.owner[keep])

    def vectors(self, w: Weights) -> np.ndarray:
        """One row for each word, and one of zeros behind them for places without a word."""
        out = np.zeros((len(self.word) + 1, WORD_DIM + GRAM_DIM), np.float32)
        some = np.flatnonzero(self.word >= 0)
        out[some, :WORD_DIM] = w["words"][self.word[some]]
        if len(self.gram):
            new = np.flatnonzero(np.diff(self.owner, prepend=-1))
            out[self.owner[new], WORD_DIM:] = np.add.reduceat(w["grams"][self.gram], new)
        return out


def _new_weights(rng: np.random.Generator, words: np.ndarray, grams: np.ndarray) -> Weights:
    """Random weights; the first number of each word and n-gram is the log odds it has by itself."""
    def draw(*shape: int, scale: float) -> np.ndarray:
        return rng.normal(0, scale, shape).astype(np.float32)

    w = {"words": draw(len(words), WORD_DIM, scale=0.05), "grams": draw(len(grams), GRAM_DIM, scale=0.05)}
    w["words"][:, 0], w["grams"][:, 0] = 0.3 * words, 0.1 * grams
    for side in "fb":
        w["x" + side] = draw(WORD_DIM + GRAM_DIM, 3 * HIDDEN, scale=0.4)
        w["h" + side] = draw(HIDDEN, 3 * HIDDEN, scale=0.3)
        w["c" + side] = np.zeros(3 * HIDDEN, np.float32)
    return w | {"a": draw(2 * HIDDEN, ATTENTION, scale=0.4), "u": draw(ATTENTION, scale=0.4),
                "o": draw(2 * HIDDEN, scale=0.4), "c": np.zeros(1, np.float32)}


def _recur(w: Weights, side: str, vectors: np.ndarray, index: np.ndarray, live: np.ndarray | None, keep: bool):
    """States after each step (steps x windows x HIDDEN) of one direction, and what its gradient needs.

    ``live``: 0 where a step has no word (the state stays), None if all have one."""
    given = vectors @ w["x" + side] + w["c" + side]
    x_gates, x_new = np.ascontiguousarray(given[:, : 2 * HIDDEN]), np.ascontiguousarray(given[:, 2 * HIDDEN:])
    h_gates, h_new = np.ascontiguousarray(w["h" + side][:, : 2 * HIDDEN]), np.ascontiguousarray(w["h" + side][:, 2 * HIDDEN:])
    steps, n = index.shape
    out, h, kept = np.empty((steps, n, HIDDEN), np.float32), np.zeros((n, HIDDEN), np.float32), []
    for t in range(steps) if side == "f" else range(steps - 1, -1, -1):
        gates = np.take(x_gates, index[t], axis=0)
        gates += h @ h_gates
        gates = 0.5 + 0.5 * _soft(gates)
        z, r = gates[:, :HIDDEN], gates[:, HIDDEN:]
        u = h @ h_new
        new = np.take(x_new, index[t], axis=0)
        new += r * u
        new = _soft(new)
        if live is not None:
            z = 1 - (1 - z) * live[t][:, None]
        if keep:
            kept.append((t, h, z, r, u, new, gates))
        h = h - new
        h *= z
        h += new
        out[t] = h
    return out, kept


def _attend(w: Weights, states: np.ndarray, live: np.ndarray | None):
    hidden = _soft(states @ w["a"])
    weight = hidden @ w["u"]
    if live is not None:
        weight = np.where(live > 0, weight, -30)
    weight = np.exp(weight - weight.max(axis=0))
    weight /= weight.sum(axis=0)
    return hidden, weight, np.einsum("tn,tnh->nh", weight, states)


def log_odds(w: Weights, vectors: np.ndarray, index: np.ndarray, live: np.ndarray | None = None) -> np.ndarray:
    """Of windows given as rows of ``vectors`` (steps x windows)."""
    states = np.concatenate([_recur(w, side, vectors, index, live, False)[0] for side in "fb"], axis=2)
    return _attend(w, states, live)[2] @ w["o"] + w["c"][0]


def gradients(w: Weights, inputs: Inputs, index: np.ndarray, live: np.ndarray, y: np.ndarray, share: np.ndarray) -> Weights:
    """Of the mean logistic loss of windows with labels ``y``, weighted by ``share``."""
    vectors = inputs.vectors(w)
    ran = {side: _recur(w, side, vectors, index, live, True) for side in "fb"}
    states = np.concatenate([ran["f"][0], ran["b"][0]], axis=2)
    hidden, weight, pooled = _attend(w, states, live)
    g = {k: np.zeros_like(v) for k, v in w.items()}
    d = ((_sigmoid(pooled @ w["o"] + w["c"][0]) - y) * share / share.sum()).astype(np.float32)
    g["o"], g["c"] = pooled.T @ d, d.sum(keepdims=True)
    d_pooled = d[:, None] * w["o"]
    d_weight = np.einsum("tnh,nh->tn", states, d_pooled)
    d_weight = weight * (d_weight - (weight * d_weight).sum(axis=0))
    g["u"] = np.einsum("tna,tn->a", hidden, d_weight)
    d_hidden = d_weight[:, :, None] * w["u"] * _slope(hidden)
    g["a"] = np.einsum("tnh,tna->ha", states, d_hidden)
    d_states = weight[:, :, None] * d_pooled + d_hidden @ w["a"].T
    d_vectors = np.zeros_like(vectors)
    for side, part in (("f", slice(None, HIDDEN)), ("b", slice(HIDDEN, None))):
        d_given, dh = np.zeros((len(vectors), 3 * HIDDEN), np.float32), 0
        for t, h, z, r, u, new, gates in reversed(ran[side][1]):
            slope = 0.5 * _slope(2 * gates - 1)
            dh = dh + d_states[t][:, part]
            d_new = dh * (1 - z) * _slope(new)
            d_z = dh * (h - new) * live[t][:, None] * slope[:, :HIDDEN]
            d_r = d_new * u * slope[:, HIDDEN:]
            np.add.at(d_given, index[t], np.concatenate([d_z, d_r, d_new], axis=1))
            d_u = np.concatenate([d_z, d_r, d_new * r], axis=1)
            g["h" + side] += h.T @ d_u
            dh = dh * z + d_u @ w["h" + side].T
        g["x" + side], g["c" + side] = vectors.T @ d_given, d_given.sum(axis=0)
        d_vectors += d_given @ w["x" + side].T
    some = np.flatnonzero(inputs.word >= 0)
    np.add.at(g["words"], inputs.word[some], d_vectors[some, :WORD_DIM])
    np.add.at(g["grams"], inputs.gram, d_vectors[inputs.owner, WORD_DIM:])
    return g


def _laid_out(first: np.ndarray, size: np.ndarray, number: np.ndarray, blank: int) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of the words of windows (steps x windows) and whether there is one; ``blank`` where there is none."""
    step = np.arange(WINDOW)[:, None]
    live = step < size
    place = np.where(live, first + step, 0)
    found = number[place] if len(number) else np.full(place.shape, blank)
    return np.where(live, found, blank), live.astype(np.float32)


def summary(scores: np.ndarray, text: np.ndarray, n: int) -> np.ndarray:
    """Per text: greatest log odds of its windows, mean of the three greatest, mean, and sum of what speaks for it."""
    new = np.searchsorted(text, np.arange(n))
    count = np.diff(np.append(new, len(text)))
    turn = np.lexsort((-scores, text))
    place = np.arange(len(text)) - new[text]
    upper = np.bincount(text[place < 3], scores[turn][place < 3], n) / np.minimum(count, 3)
    mean = np.bincount(text, scores, n) / count
    return np.column_stack([scores[turn][new], upper, mean, np.tanh(np.bincount(text, scores, n) / 8), np.log(count)])


def _logistic(x: np.ndarray, y: np.ndarray, share: np.ndarray, ridge: float = 0.02) -> np.ndarray:
    """Weights (the last one constant) by Newton steps."""
    x = np.column_stack([x, np.ones(len(x))])
    b = np.zeros(x.shape[1])
    for _ in range(30):
        p = _sigmoid(x @ b)
        pull = ridge * np.append(b[:-1], 0)
        curve = (x * (share * np.maximum(p * (1 - p), 1e-6))[:, None]).T @ x + (ridge + 1e-9) * np.eye(len(b))
        b = b - np.linalg.solve(curve, x.T @ (share * (p - y)) + pull)
    return b


@dataclass
class Model:
    """A fitted network; ``weights`` is None when all scores are ``constant``."""

    constant: float
    words: Vocabulary | None = None
    grams: Vocabulary | None = None
    weights: Weights | None = None
    final: np.ndarray | None = None
    middle: np.ndarray | None = None
    spread: np.ndarray | None = None

    def window_scores(self, words: Words) -> tuple[np.ndarray, np.ndarray]:
        """The text and the log odds of all windows."""
        _, which, number = np.unique(words.hash, return_index=True, return_inverse=True)
        vectors = Inputs.of(words, which, self.words, self.grams).vectors(self.weights)
        text, first, size = windows_of(words.first)
        out = np.empty(len(text))
        for group, full in ((size == WINDOW, True), (size < WINDOW, False)):
            at = np.flatnonzero(group)
            for a in range(0, len(at), _BLOCK):
                own = at[a: a + _BLOCK]
                index, live = _laid_out(first[own], size[own], number, len(which))
                out[own] = log_odds(self.weights, vectors, index, None if full else live)
        return text, out

    def scores(self, raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        n = len(offsets) - 1
        if self.weights is None or not n:
            return np.full(n, self.constant)
        text, found = self.window_scores(Words(raw, offsets))
        x = (summary(found, text, n) - self.middle) / self.spread
        return _sigmoid(x @ self.final[:-1] + self.final[-1])


def _odds(total: np.ndarray, toxic: np.ndarray) -> np.ndarray:
    """Log odds of things seen ``total`` times, ``toxic`` of them in toxic texts; and how sure they are."""
    clean = total - toxic
    odds = np.log((toxic + 1) / (toxic.sum() + 2)) - np.log((clean + 1) / (clean.sum() + 2))
    return odds, np.abs(odds) / np.sqrt(1 / (toxic + 1) + 1 / (clean + 1))


def fit(texts: list[str], y: np.ndarray, share: np.ndarray | None = None, seed: int = 12) -> Model:
    """On texts with labels 0 and 1; ``share`` weighs them."""
    if not len(y):
        return Model(0.5)
    if y.min() == y.max():
        return Model(float((y.sum() + 1) / (len(y) + 2)))
    rng = np.random.default_rng(seed)
    share = np.ones(len(y)) if share is None else share
    apart = np.zeros(len(y), bool)  # texts of both labels that the last layer is fitted on
    for label in (0, 1):
        own = rng.permutation(np.flatnonzero(y == label))
        apart[own[: len(own) // 3]] = len(own) > 2
    raw = [t.encode() for t in texts]
    offsets = np.cumsum([0, *map(len, raw)])
    words = Words(np.frombuffer(b"".join(raw), np.uint8), offsets)
    hashes, which, number = np.unique(words.hash, return_index=True, return_inverse=True)
    owner = np.repeat(np.arange(len(y)), np.diff(words.first))
    pairs = np.unique((owner * max(1, len(hashes)) + number)[~apart[owner]])  # a word counts once for each text
    doc, word = pairs // max(1, len(hashes)), pairs % max(1, len(hashes))
    total, toxic = np.bincount(word, minlength=len(hashes)), np.bincount(word, y[doc], len(hashes))
    odds, sure = _odds(total, toxic)
    best = np.sort(np.argsort(-np.where(total >= SEEN, sure, 0), kind="stable")[:WORDS])
    grams, source = grams_of(words, which)
    known, gram = np.unique(grams, return_inverse=True)
    gram_total = np.bincount(gram, total[source], len(known))
    gram_odds, gram_sure = _odds(gram_total, np.bincount(gram, toxic[source], len(known)))
    best_grams = np.sort(np.argsort(-np.where(gram_total >= SEEN, gram_sure, 0), kind="stable")[:GRAMS])
    model = Model(0.5, Vocabulary.of(hashes[best]), Vocabulary.of(known[best_grams]),
                  _new_weights(rng, odds[best], gram_odds[best_grams]))
    inputs = Inputs.of(words, which, model.words, model.grams)

    text, first, size = windows_of(words.first)
    begin = np.searchsorted(text, np.arange(len(y)))
    count = np.diff(np.append(begin, len(text)))
    even = np.where(y > 0, 0.5 / (share * y).sum(), 0.5 / (share * (1 - y)).sum()) * share * len(y)
    weights = model.weights
    moved, square, step = ({k: np.zeros_like(v) for k, v in weights.items()} for _ in range(2)), None, 0
    moved, square = moved
    rounds = EPOCHS * -(-int((~apart).sum()) * PER_TEXT // BATCH)
    for _ in range(EPOCHS):
        chosen = (begin[:, None] + rng.integers(0, 1 << 31, (len(y), PER_TEXT)) % count[:, None])[~apart].reshape(-1)
        chosen = rng.permutation(chosen)
        for a in range(0, len(chosen), BATCH):
            own = chosen[a: a + BATCH]
            index, live = _laid_out(first[own], size[own], number, len(hashes))
            rows, compact = np.unique(index, return_inverse=True)
            rows = rows[rows < len(hashes)]
            g = gradients(weights, inputs.chosen(rows).thinned(rng), compact.reshape(index.shape), live, y[text[own]], even[text[own]])
            step += 1
            rate = RATE * min(1, step / 20) * (1 - 0.9 * step / rounds)
            for k, v in g.items():
                moved[k] += 0.1 * (v - moved[k])
                square[k] += 0.01 * (v * v - square[k])
                weights[k] -= rate * (moved[k] / (1 - 0.9**step)) / (np.sqrt(square[k] / (1 - 0.99**step)) + 1e-6)
                weights[k] -= np.float32(rate * DECAY) * weights[k]
    if len(set(y[apart])) < 2:
        apart[:] = True
    text, found = model.window_scores(words)
    x = summary(found, text, len(y))[apart]
    model.middle, model.spread = x.mean(axis=0), x.std(axis=0) + 1e-6
    model.final = _logistic((x - model.middle) / model.spread, y[apart], share[apart])
    return model


def held_out(id_col: str) -> Column:
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
          max_rows: int = MAX_ROWS, max_chars: int = MAX_CHARS) -> Model:
    """Fit on at most ``max_rows`` labelled rows that are not held out, of texts of at most ``max_chars`` characters.

    Rows of the rarer label are kept as far as ``max_rows / 2`` go, those of the other fill the rest; each label's rows
    count as much as all its labels do, so that scores are chances among all labelled texts."""
    known = labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & ~held_out(id_col)) \
        .select(F.col(id_col).alias("id"), (F.col(label_col) > 0).cast("int").alias("y")).distinct()
    totals = {r.y: r.n for r in known.groupBy("y").agg(F.count("*").alias("n")).collect()}
    rarer = min(totals, key=totals.get, default=0)
    part = {rarer: min(totals.get(rarer, 0), max_rows // 2)}
    part[1 - rarer] = max_rows - part[rarer]
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    short = docs.select(F.col(id_col).alias("id"), text.alias("text")).where(F.length("text") <= max_chars)
    rows = []
    for y, n in sorted(part.items()):
        ids = known.where(F.col("y") == y).orderBy(F.xxhash64("id"), "id").limit(n)
        own = F.struct(F.xxhash64("text").alias("hash"), "text")
        rows += short.join(F.broadcast(ids), "id").groupBy("id", "y").agg(F.min(own).alias("first")) \
            .select("id", "y", "first.text").orderBy("id").collect()
    y = np.array([r.y for r in rows], float)
    share = np.array([totals[r.y] for r in rows], float) / np.maximum(1, np.where(y > 0, y.sum(), (1 - y).sum()))
    return fit([r.text for r in rows], y, share)


def score(docs: DataFrame, model: Model, text_col: str = "text", into: str = "score") -> DataFrame:
    """``docs`` with the score of each whole text in the column ``into`` (in place of one of that name)."""
    body = free_name([*docs.columns, into], "body")
    docs = docs.withColumn(body, F.col(f"`{text_col}`").cast("string"))
    docs = docs.select(*[F.col(f"`{c}`") for c in docs.columns if c.lower() != into.lower()])
    sent = docs.sparkSession.sparkContext.broadcast(model)
    schema = T.StructType([*docs.drop(body).schema.fields, T.StructField(into, T.DoubleType())])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, offsets = utf8_column(batch.column(body))
            found, a = [np.empty(0)], 0
            while a < batch.num_rows:  # about 1 MB of text at a time, or one longer text
                b = max(a + 1, int(np.searchsorted(offsets, offsets[a] + _RUN_BYTES, "right")) - 1)
                found.append(sent.value.scores(raw[offsets[a]: offsets[b]], offsets[a: b + 1] - offsets[a]))
                a = b
            own = batch.drop_columns([body])
            yield pa.RecordBatch.from_arrays([*own.columns, pa.array(np.concatenate(found))], schema.names)

    return docs.mapInArrow(add, schema)

"""Quality classifier: a sparse ensemble of conjunctive rules over text statistics.

Small trees are grown on samples of the labelled rows; every path from a root to a node is a rule, a conjunction
of bounds on statistics. A lasso logistic fit weighs the rules, most of them with zero, and the rest is compiled
into one Spark column expression. Statistics come from whole texts, in one pass over the documents; nothing is
shuffled but the distinct rows of the fit. The fit runs on the driver, on the statistics of at most ``max_rows``
distinct labels (those with the smallest hashes of their ids) and at most twice as many rows: that bound is a
parameter and doesn't depend on the data; scores cover all rows. Rows of one id, label and statistics are one row
of the fit, each chosen label with a document has one, and what else there is under repeated ids comes in the
order of a hash of the row, so that no id crowds out the others.

Defined results: a null text is an empty one, and is scored; repeated rows score alike; label rows without id or
label are passed over, different labels of a document all count; without any label, every score is 1 (nothing
is known against any text); with labels of one kind, all scores are one constant; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from topicflow.llm.common import Words, free_name, materialize, utf8_column

MAX_ROWS = 20_000
THRESHOLD = 0.7
TREES, DEPTH, BINS, PENALTY, ROUNDS = 16, 3, 32, 0.001, 600

STATISTICS = ["log_words", "word_bytes", "upper", "digits", "symbols", "bars", "bangs", "stops", "lines",
              "non_ascii", "repeats", "top"]


def _classes() -> np.ndarray:
    """Numbers of the byte classes: other, upper, lower, digit, symbol, bar, bang, stop, line, non-ASCII."""
    kind = np.zeros(256, np.int64)
    for i, chars in enumerate((b"", b"", b"0123456789", b"#$%&*<>{}[]\\^~`@=+_/", b"|", b"!", b".,;:?", b"\n"), 1):
        kind[list(chars)] = i
    kind[65:91], kind[97:123], kind[128:] = 1, 2, 9
    return kind


_KIND = _classes()


def statistics(raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """A row of :data:`STATISTICS` for each text."""
    n = len(offsets) - 1
    doc = np.repeat(np.arange(n), np.diff(offsets))
    count = np.bincount(doc * 10 + _KIND[raw], minlength=10 * n).reshape(n, 10).astype(float)
    words = Words(raw, offsets)
    n_words = np.diff(words.first)
    owner = np.repeat(np.arange(n), n_words)
    size = np.bincount(owner, words.end - words.start, n)
    same = (words.hash[1:] == words.hash[:-1]) & (owner[1:] == owner[:-1])
    repeats = np.bincount(owner[1:], same, n)
    turn = np.lexsort((words.hash, owner))
    h, o = words.hash[turn], owner[turn]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (o[1:] != o[:-1])
    at = np.flatnonzero(new)
    top = np.zeros(n)
    np.maximum.at(top, o[at], np.diff(np.append(at, len(h))))  # how often the most frequent word occurs
    per_word, letters = np.maximum(n_words, 1), np.maximum(count[:, 1] + count[:, 2], 1)
    return np.column_stack([
        np.log1p(n_words), size / per_word, count[:, 1] / letters, count[:, 3] / per_word, count[:, 4] / per_word,
        count[:, 5] / per_word, count[:, 6] / per_word, count[:, 7] / per_word, count[:, 8] / per_word,
        count[:, 9] / np.maximum(np.diff(offsets), 1), repeats / per_word, top / per_word])


def with_statistics(docs: DataFrame, text_col: str, into: str) -> DataFrame:
    """``docs`` with a struct column of the statistics."""
    kind = T.StructType([T.StructField(s, T.DoubleType()) for s in STATISTICS])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, offsets = utf8_column(batch.column(text_col))
            found, a = [], 0
            while a < batch.num_rows:  # about 1 MB of text at a time
                b = max(a + 1, int(np.searchsorted(offsets, offsets[a] + (1 << 20), "right")) - 1)
                found.append(statistics(raw[offsets[a]: offsets[b]], offsets[a: b + 1] - offsets[a]))
                a = b
            values = np.concatenate(found) if found else np.empty((0, len(STATISTICS)))
            column = pa.StructArray.from_arrays([pa.array(x) for x in values.T.copy()], STATISTICS)
            yield batch.append_column(into, column)

    return docs.mapInArrow(add, T.StructType([*docs.schema.fields, T.StructField(into, kind)]))


Rule = tuple[tuple[int, bool, float], ...]  # (statistic, whether above, bound) of each condition


def _grow(x: np.ndarray, bins: np.ndarray, edges: list[np.ndarray], y: np.ndarray, rows: np.ndarray, path: Rule, depth: int,
          rng: np.random.Generator, rules: set[Rule]) -> None:
    if not depth or len(rows) < 10 or y[rows].min() == y[rows].max():
        return
    best = None
    for k in rng.permutation(x.shape[1])[: x.shape[1] // 2]:
        total = np.bincount(bins[rows, k], minlength=len(edges[k]) + 1).cumsum()[:-1]
        ones = np.bincount(bins[rows, k], y[rows], len(edges[k]) + 1).cumsum()[:-1]
        left, right = np.maximum(total, 1), np.maximum(len(rows) - total, 1)
        impurity = ones * (total - ones) / left + (y[rows].sum() - ones) * (len(rows) - total - y[rows].sum() + ones) / right
        impurity = np.where((total >= 5) & (len(rows) - total >= 5), impurity, np.inf)
        if len(impurity) and (best is None or impurity.min() < best[0]):
            best = (impurity.min(), k, int(impurity.argmin()))
    if best is None or not np.isfinite(best[0]):
        return
    _, k, cut = best
    above = bins[rows, k] > cut
    for side in (False, True):
        rule = (*path, (int(k), side, float(edges[k][cut])))
        rules.add(tuple(sorted(rule)))
        _grow(x, bins, edges, y, rows[above == side], rule, depth - 1, rng, rules)


def _edges(values: np.ndarray) -> np.ndarray:
    """Bounds to try: quantiles, and even steps for what lies between groups of values."""
    low, high = np.quantile(values, [0.01, 0.99])
    return np.unique(np.concatenate([
        np.quantile(values, np.linspace(0, 1, BINS + 1)[1:-1]), np.linspace(low, high, BINS + 1)[1:-1]]))


def tree_rules(x: np.ndarray, y: np.ndarray, trees: int = TREES, depth: int = DEPTH) -> list[Rule]:
    """The paths of trees, each grown on a random half of the rows, with a random half of the statistics at each node."""
    rng, rules = np.random.default_rng(4), set()
    edges = [_edges(x[:, k]) for k in range(x.shape[1])]
    bins = np.column_stack([np.searchsorted(e, x[:, k], "left") for k, e in enumerate(edges)])
    for _ in range(trees):
        rows = np.sort(rng.permutation(len(x))[: max(20, len(x) // 2)])
        _grow(x, bins, edges, y, rows, (), depth, rng, rules)
    return sorted(rules)


def _holds(rule: Rule, x: np.ndarray) -> np.ndarray:
    held = np.ones(len(x), bool)
    for k, above, bound in rule:
        held &= (x[:, k] > bound) == above
    return held


def lasso(x: np.ndarray, y: np.ndarray, penalty: float = PENALTY, rounds: int = ROUNDS) -> tuple[float, np.ndarray]:
    """Intercept (not penalised) and weights of the logistic fit, by accelerated proximal gradient steps."""
    n = len(x)
    full = np.column_stack([np.ones(n), x])
    v = np.ones(full.shape[1])
    for _ in range(30):
        v = full.T @ (full @ v)
        top = np.linalg.norm(v)
        v /= top
    rate = 4 * n / top
    weight = np.zeros(full.shape[1])
    ahead, t = weight, 1.0
    for _ in range(rounds):
        chance = 1 / (1 + np.exp(-np.clip(full @ ahead, -30, 30)))
        moved = ahead - rate * (full.T @ (chance - y)) / n
        moved[1:] = np.sign(moved[1:]) * np.maximum(np.abs(moved[1:]) - rate * penalty, 0)
        later = (1 + np.sqrt(1 + 4 * t * t)) / 2
        ahead, weight, t = moved + (t - 1) / later * (moved - weight), moved, later
    return float(weight[0]), weight[1:]


@dataclass
class RuleModel:
    intercept: float
    rules: list[tuple[Rule, float]]

    def score(self, statistics_col: str) -> Column:
        """The model as a Spark expression over the struct column of statistics."""
        total = F.lit(self.intercept)
        for rule, weight in self.rules:
            held = F.lit(True)
            for k, above, bound in rule:
                value = F.col(f"`{statistics_col}`.{STATISTICS[k]}")
                held = held & ((value > bound) if above else (value <= bound))
            total = total + F.when(held, weight).otherwise(0.0)
        return 1 / (1 + F.exp(-total))


def fit(x: np.ndarray, y: np.ndarray) -> RuleModel:
    if not len(y):
        return RuleModel(float("inf"), [])
    if y.min() == y.max():
        return RuleModel(float(np.log((y.sum() + 1) / (len(y) - y.sum() + 1))), [])
    rules = tree_rules(x, y)
    held = np.column_stack([_holds(r, x) for r in rules]).astype(float) if rules else np.empty((len(x), 0))
    _, first = np.unique(held, axis=1, return_index=True)  # rules that hold for the same rows are one
    rules, held = [rules[i] for i in sorted(first)], held[:, sorted(first)]
    intercept, weights = lasso(held, y.astype(float))
    return RuleModel(intercept, [(r, float(w)) for r, w in zip(rules, weights) if w])


def held_out(id_col: str) -> Column:
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
          max_rows: int = MAX_ROWS) -> RuleModel:
    """Fit on documents with labels that are not held out, at most ``max_rows`` distinct labels and
    ``2 * max_rows`` distinct rows."""
    chosen = labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & ~held_out(id_col)) \
        .select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("y")).distinct() \
        .orderBy(F.xxhash64("id"), "id", "y").limit(max_rows)
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    every = materialize(with_statistics(texts.join(F.broadcast(chosen), "id").select("id", "y", "text"), "text", "s")
                        .select("id", "y", "s").distinct())
    first = every.groupBy("id", "y").agg(F.min("s").alias("s")).withColumn("later", F.lit(False))
    rows = every.join(F.broadcast(first), ["id", "y", "s"], "left") \
        .orderBy(F.coalesce("later", F.lit(True)), F.xxhash64("id", "y", "s"), "id", "y", "s") \
        .limit(2 * max_rows).select("y", "s.*").toPandas()
    return fit(rows[STATISTICS].to_numpy(float), (rows["y"].to_numpy() > 0).astype(float))


def score(docs: DataFrame, model: RuleModel, text_col: str = "text", into: str = "score") -> DataFrame:
    """``docs`` with the model's score."""
    stats = free_name(docs.columns, "statistics")
    return with_statistics(docs, text_col, stats).withColumn(into, model.score(stats)).drop(stats)

"""Quality classifier by Bradley-Terry pairwise ranking.

A text is described by shares and averages of its characters, words and lines. Each number is cut into bins at quantiles of all
training texts; a bin is one feature. From preference pairs (a text of label 1 is preferred to one of label 0) the ranking learns
weights by the logistic loss of feature differences, with a penalty on their squares. Every training text meets every one of the
other label: what a text adds to the slope depends on its own level and on how the levels of the other label are spread, so a step
needs their counts in narrow cells and one sum over the texts. A quantile of the training scores, at the share of label 0, becomes the
threshold: the score is the logistic function of the distance to it, moved so that the threshold lies at CUT. The driver and the tasks
hold counts by cell and matrices of the features' number, whatever the size of the table.
"""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsewatch.llm.common import Words, pick, pieces, remainder, staged

BINS, PENALTY, CUT = 12, 1e-3, 0.3
#: Quantiles are told apart to 9 binary digits; levels are counted in cells of 1 / CELLS up to FAR, curvature in GROUPS of levels.
DIGITS, CELLS, FAR, GROUPS = 43, 64, 64, 64
#: Parts of a level that are counted exactly; rounds at most; partial sums that reach the driver.
FINE, ROUNDS, PARTS = 1 << 20, 60, 8
#: Byte classes whose share of the text is a feature.
CLASSES = {"upper": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", "lower": b"abcdefghijklmnopqrstuvwxyz", "digit": b"0123456789", "space": b" \t\r\x0b\x0c",
           "line": b"\n", "stop": b".?", "comma": b",;:", "shout": b"!", "symbol": b"#*$%&|<>", "bracket": b"()[]{}", "quote": b"\"'`", "rest": b"-_/\\+=@~^"}
NAMES = [*CLASSES, "other", "words", "word_length", "distinct", "repeated", "capital", "short", "lettered", "stopped", "ends", "line_words", "equal_lines"]


def features(texts: pa.Array) -> np.ndarray:
    """One row of numbers for each text; a null or empty text gives zeros."""
    table = np.full(256, len(CLASSES), np.int64)
    for k, members in enumerate(CLASSES.values()):
        table[list(members)] = k
    out = np.zeros((len(texts), len(NAMES)))
    words = Words(texts, lower=False)
    value = words.values.to_pylist()
    about = np.array([(len(w), w[0].isupper(), len(w) == 1, any(c.isalpha() for c in w), w[-1] in ".?!,;:") for w in value], float).reshape(-1, 5)
    per_word = about[words.ids]
    for k, text in enumerate(texts.to_pylist()):
        if not text:
            continue
        raw = np.frombuffer(text.encode(), np.uint8)
        out[k, :len(CLASSES) + 1] = np.bincount(table[raw], minlength=len(CLASSES) + 1) / len(raw)
        i, j = words.ends[k], words.ends[k + 1]
        if i == j:
            continue
        ids, n = words.ids[i:j], j - i
        lines = text.split("\n")
        rest = out[k, len(CLASSES) + 1:]
        rest[0] = np.log(n)
        mean = per_word[i:j].mean(0)
        rest[1], rest[4], rest[5], rest[6], rest[7] = mean[0], mean[1], mean[2], mean[3], mean[4]
        rest[2] = len(np.unique(ids)) / n ** 0.8
        rest[3] = np.count_nonzero(ids[1:] == ids[:-1]) / n
        rest[8] = sum(x[-1:] in (".", "?", "!") for x in lines) / len(lines)
        rest[9] = np.log(n / len(lines))
        rest[10] = 1 - len(set(lines)) / len(lines)
    return out


def _describe(keep: list[str]):
    def run(batches):
        for batch in pieces(batches, 1000):
            x = features(batch.column("text"))
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1) * len(NAMES), pa.int32()), pa.array(x.ravel()))
            yield batch.select(keep).append_column("features", lists)
    return run


class Ranking:
    """Bins, weights and threshold."""

    def __init__(self, edges: list[np.ndarray]):
        self.edges = edges
        self.weights, self.cut = np.zeros(sum(len(e) + 1 for e in edges)), 0.0

    def bins(self, x: np.ndarray) -> np.ndarray:
        """For every text and number the index of the feature that is on."""
        at, out = 0, np.zeros(x.shape, np.int64)
        for k, edge in enumerate(self.edges):
            out[:, k] = at + np.searchsorted(edge, x[:, k], side="right")
            at += len(edge) + 1
        return out

    def level(self, z: np.ndarray) -> np.ndarray:
        return self.weights[z].sum(1)

    def scores(self, x: np.ndarray) -> np.ndarray:
        if not self.edges:
            return np.full(len(x), 0.5)
        far = self.level(self.bins(x)) - self.cut + np.log(CUT / (1 - CUT))
        return 1 / (1 + np.exp(-np.clip(far, -500, 500)))


def pairwise_weights(better: np.ndarray, worse: np.ndarray, size: int) -> np.ndarray:
    """Weights that minimise the mean logistic loss of (better - worse) plus the penalty, by Newton steps: the plain form of
    ``learn_weights`` for pairs that are given one by one."""
    w = np.zeros(size)
    for _ in range(25):
        p = 1 / (1 + np.exp(np.clip(w[better].sum(1) - w[worse].sum(1), -500, 500)))
        gradient, curve = PENALTY * w, np.diag(np.full(size, PENALTY))
        for start in range(0, len(better), 5000):
            span = slice(start, start + 5000)
            d = np.zeros((len(better[span]), size))
            row = np.arange(len(d))[:, None]
            np.add.at(d, (row, better[span]), 1)
            np.add.at(d, (row, worse[span]), -1)
            gradient -= d.T @ p[span] / len(better)
            curve += (d * (p[span] * (1 - p[span]))[:, None]).T @ d / len(better)
        step = np.linalg.solve(curve, gradient)
        w -= step
        if np.abs(step).max() < 1e-6:
            break
    return w


def _ordered(x: np.ndarray) -> np.ndarray:
    """Whole numbers in the order of doubles, of their leading binary digits."""
    bits = (x + 0.0).view(np.int64)
    return np.where(bits < 0, bits ^ np.int64(0x7FFFFFFFFFFFFFFF), bits) >> np.int64(DIGITS)


def _least(cells: np.ndarray) -> np.ndarray:
    """The least double of each cell of ``_ordered``."""
    bits = cells.astype(np.int64) << np.int64(DIGITS)
    return np.where(bits < 0, bits ^ np.int64(0x7FFFFFFFFFFFFFFF), bits).view(np.float64)


def _numbers(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    return batch.column("features").flatten().to_numpy().reshape(-1, len(NAMES)), batch.column("quality").to_numpy()


def _value_counts(batches):
    for batch in batches:
        x, _ = _numbers(batch)
        for k in range(len(NAMES)):
            cell, n = np.unique(_ordered(np.ascontiguousarray(x[:, k])), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(cell), k, np.int32)), pa.array(cell), pa.array(n.astype(np.int64))], names=["k", "cell", "n"])


def learned_edges(train: DataFrame) -> list[np.ndarray]:
    """Cuts of every number at quantiles of all training texts, down to the cell that holds them."""
    counted = train.mapInArrow(_value_counts, "k int, cell long, n long").groupBy("k", "cell").agg(F.sum("n").alias("n")).toPandas()
    edges = []
    for _, own in counted.sort_values(["k", "cell"]).groupby("k"):
        upto = np.cumsum(own["n"].to_numpy())
        at = np.searchsorted(upto, np.arange(1, BINS) / BINS * (upto[-1] - 1), side="right")
        edges.append(np.unique(_least(own["cell"].to_numpy()[at])))
    return edges


def _level_counts(model: Ranking):
    def run(batches):
        for batch in batches:
            x, label = _numbers(batch)
            level = model.level(model.bins(x))
            cell = np.floor(np.clip(level, -FAR, FAR) * CELLS).astype(np.int64)
            both, place, n = np.unique(np.stack([label, cell], 1), axis=0, return_inverse=True, return_counts=True)
            total = np.zeros(len(both), np.int64)
            np.add.at(total, place.ravel(), np.rint(level * FINE).astype(np.int64))
            yield pa.RecordBatch.from_arrays([pa.array(both[:, 0].astype(np.int32)), pa.array(both[:, 1]), pa.array(n.astype(np.int64)), pa.array(total)],
                                             names=["quality", "cell", "n", "total"])
    return run


class Levels:
    """How the levels of both labels are spread: numbers and mean levels by cell."""

    def __init__(self, train: DataFrame, model: Ranking):
        rows = train.mapInArrow(_level_counts(model), "quality int, cell long, n long, total long").groupBy("quality", "cell").agg(
            F.sum("n").alias("n"), F.sum("total").alias("total")).toPandas().sort_values(["quality", "cell"])
        self.cell = [rows["cell"].to_numpy()[rows["quality"].to_numpy() == q] for q in (0, 1)]
        self.n = [rows["n"].to_numpy(float)[rows["quality"].to_numpy() == q] for q in (0, 1)]
        self.mean = [rows["total"].to_numpy()[rows["quality"].to_numpy() == q] / FINE / n for q, n in zip((0, 1), self.n)]
        self.pairs = self.n[0].sum() * self.n[1].sum()
        self.low, self.high = min(map(np.min, self.mean)), max(map(np.max, self.mean))

    def loss(self) -> float:
        """Mean logistic loss of all pairs."""
        return sum(n * (self.n[0] * np.logaddexp(0, self.mean[0] - m)).sum() for n, m in zip(self.n[1], self.mean[1])) / self.pairs

    def slopes(self) -> tuple[np.ndarray, list[np.ndarray]]:
        """Levels, and for a text of either label at such a level the sum of the chances that its pairs are the wrong way round."""
        at = np.arange(np.floor(self.low * CELLS) - 1, np.ceil(self.high * CELLS) + 2) / CELLS
        wrong = [np.array([(n * 1 / (1 + np.exp(np.clip(sign * (s - m), -500, 500)))).sum() for s in at]) for n, m, sign in (
            (self.n[1], self.mean[1], -1), (self.n[0], self.mean[0], 1))]
        return at, wrong

    def groups(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Bounds of the groups of levels, and how much pairs of two groups bend the loss; numbers of both labels by group."""
        bounds = np.linspace(self.low, self.high + 1e-9, GROUPS + 1)
        middle = (bounds[1:] + bounds[:-1]) / 2
        p = 1 / (1 + np.exp(np.clip(middle[:, None] - middle, -500, 500)))
        sizes = np.array([np.bincount(_group(m, bounds), n, GROUPS) for m, n in zip(self.mean, self.n)])
        return bounds, p * (1 - p), sizes


def _group(level: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    return np.clip(np.searchsorted(bounds, level, side="right") - 1, 0, GROUPS - 1)


def _moments(model: Ranking, at: np.ndarray, wrong: list[np.ndarray], bounds: np.ndarray, bend: list[np.ndarray]):
    """Sums over a task's texts: slope, curvature of texts with themselves, and texts by label and group."""
    size = len(model.weights)

    def run(batches):
        slope, own, each = np.zeros(size), np.zeros((size, size)), np.zeros((2, GROUPS, size))
        for batch in itertools.chain.from_iterable(pieces([b], 2000) for b in batches):
            x, label = _numbers(batch)
            z = model.bins(x)
            level = model.level(z)
            group = _group(level, bounds)
            on = np.zeros((len(z), size))
            on[np.arange(len(z))[:, None], z] = 1
            good = label == 1
            slope += on.T @ np.where(good, -np.interp(level, at, wrong[1]), np.interp(level, at, wrong[0]))
            own += on.T @ (on * np.where(good, bend[1][group], bend[0][group])[:, None])
            np.add.at(each, (label, group), on)
        yield pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId()], pa.int32()), pa.array(
            [np.concatenate([slope, own.ravel(), each.ravel()]).tobytes()], pa.binary())], names=["task", "sums"])
    return run


def _added(table: pa.Table) -> pa.Table:
    table = table.sort_by("task")
    total = sum(np.frombuffer(x.as_py()) for x in table.column("sums"))
    return pa.table({"task": table.column("task")[:1], "sums": pa.array([total.tobytes()], pa.binary())})


def learn_weights(train: DataFrame, model: Ranking) -> Levels:
    """Weights that minimise the mean loss of all pairs of a good and a bad text plus the penalty; gives the levels in the end.

    Newton steps; a step that does not lower the loss is halved.
    """
    size, before, step = len(model.weights), None, None
    for _ in range(ROUNDS):
        levels = Levels(train, model)
        loss = levels.loss() + PENALTY / 2 * (model.weights ** 2).sum()
        if before and loss > before[0] + 1e-12:
            step = step / 2
            model.weights = before[1] - step
            continue
        if before and np.abs(step).max() < 1e-5:
            break
        at, wrong = levels.slopes()
        bounds, curve, sizes = levels.groups()
        bend = [curve @ sizes[1], curve @ sizes[0]]
        parts = train.mapInArrow(_moments(model, at, wrong, bounds, bend), "task int, sums binary").withColumn("part", F.col("task") % PARTS)
        parts = parts.groupBy("part").applyInArrow(lambda t: _added(t.drop_columns(["part"])), "task int, sums binary").toPandas()
        total = sum(np.frombuffer(x) for x in parts.sort_values("task")["sums"])
        slope, own, each = total[:size], total[size:size + size * size].reshape(size, size), total[size + size * size:].reshape(2, GROUPS, size)
        across = each[1].T @ curve @ each[0]
        step = np.linalg.solve((own - across - across.T) / levels.pairs + PENALTY * np.eye(size), slope / levels.pairs + PENALTY * model.weights)
        before = (loss, model.weights)
        model.weights = model.weights - step
    return levels


def _fine_counts(model: Ranking, cell: int):
    def run(batches):
        for batch in batches:
            level = model.level(model.bins(_numbers(batch)[0]))
            level = level[np.floor(np.clip(level, -FAR, FAR) * CELLS) == cell]
            value, n = np.unique(np.floor(level * FINE).astype(np.int64), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(value), pa.array(n.astype(np.int64))], names=["value", "n"])
    return run


def threshold(train: DataFrame, model: Ranking, levels: Levels) -> float:
    """Level of the text that stands, by level, where the number of texts of label 0 says; to one part in FINE."""
    bad = levels.n[0].sum()
    cells, place = np.unique(np.concatenate(levels.cell), return_inverse=True)
    upto = np.cumsum(np.bincount(place, np.concatenate(levels.n)))
    i = int(np.searchsorted(upto, bad))
    fine = train.mapInArrow(_fine_counts(model, int(cells[i])), "value long, n long").groupBy("value").agg(F.sum("n").alias("n")).toPandas().sort_values("value")
    inside = np.searchsorted(np.cumsum(fine["n"].to_numpy()), bad - (upto[i - 1] if i else 0))
    return float(fine["value"].to_numpy()[min(inside, len(fine) - 1)] / FINE)


def fit(described: DataFrame, labels: DataFrame) -> Ranking:
    """Ranking from all described texts (doc_id, features) of the training part that have labels 0 or 1."""
    known = labels.where("doc_id is not null and quality in (0, 1)").groupBy("doc_id").agg(F.max("quality").cast("int").alias("quality"))
    train = staged(described.join(known, "doc_id").groupBy("doc_id").agg(
        F.any_value("quality").alias("quality"), F.min("features").alias("features")).select("quality", "features"))
    model = Ranking(learned_edges(train))
    if train.select("quality").distinct().count() == 2:
        model.cut = threshold(train, model, learn_weights(train, model))
    return model


def _score(model: Ranking):
    def run(batches):
        for batch in batches:
            x = batch.column("features").flatten().to_numpy().reshape(-1, len(NAMES))
            yield batch.drop_columns(["features"]).append_column("score", pa.array(model.scores(x)))
    return run


def quality_scores(docs: DataFrame, labels: DataFrame, mod: int = 5, held: int = 0) -> DataFrame:
    """(doc_id, held_out, score, predicted) of all texts; predicted is 1 if score >= CUT.

    Learns from rows whose crc32(doc_id as text) modulo ``mod`` is not ``held``. Only ``labels.quality`` 0 and 1 are used; of repeated
    labels of one id the larger counts, of repeated texts one. A null text is an empty one. Equal texts get equal scores. Without
    both labels in the training part all scores are equal. A null id counts as empty text for the split and has no label. Extra columns
    do not matter; an empty table gives an empty result.
    """
    docs = pick(docs, "doc_id", "text").withColumn("held_out", remainder(F.col("doc_id"), mod) == held)
    labels = pick(labels, "doc_id", "quality").where(remainder(F.col("doc_id"), mod) != held)
    id_type = docs.schema["doc_id"].dataType.simpleString()
    described = staged(docs.mapInArrow(_describe(["doc_id", "held_out"]), f"doc_id {id_type}, held_out boolean, features array<double>"))
    model = fit(described.where("not held_out"), labels)
    return (described.mapInArrow(_score(model), f"doc_id {id_type}, held_out boolean, score double")
            .withColumn("predicted", F.when(F.col("score") >= CUT, 1).otherwise(0)))

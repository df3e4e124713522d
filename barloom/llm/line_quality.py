"""Quality of documents from a chain of line labels.

A linear-chain conditional random field labels each line good or bad. A line's features describe it and its two neighbours; a
transition score ties neighbouring labels together. It is trained on documents whose label all their lines take over, from a
sample with a fixed bound (``Sampling``). The forward-backward marginals of a document's lines, weighted by their length, give one number,
which a fitted logistic curve turns into the score.

Scoring reads the text alone. All documents of a batch go through the recursion together, line by line.

Defined results. A null text counts as empty: one empty line. Documents of any length are scored whole. Rows of the labels with a null label or
identifier teach nothing; of several labels of one identifier the smallest counts. Without any usable label the score is
0.5. Repeated rows score alike; an empty table gives an empty table. Extra columns are carried along unless they have the name of an output
column: that raises an error.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barloom.llm.common import map_batches, strings


@dataclass(frozen=True)
class Sampling:
    """Bound of the training sample: documents, and lines of one of them (documents with more lines teach nothing)."""

    documents: int = 4000
    lines: int = 400


@dataclass(frozen=True)
class Model:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray  # per feature, then the bias: score of good over bad
    switch: np.ndarray  # 2 x 2: score of label j after label i; 0 bad, 1 good
    curve: tuple[float, float]


#: Classes of bytes that are counted per line.
_CLASSES = {
    "lower": b"abcdefghijklmnopqrstuvwxyz",
    "upper": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    "digit": b"0123456789",
    "space": b" \t\r\x0b\x0c",
    "stop": b".",
    "comma": b",;:",
    "shout": b"!?",
    "bar": b"|",
    "symbol": b"#$%&*+<=>@^_~\\/`{}[]",
    "quote": b"'\"()-",
    "high": bytes(range(128, 256)),
}
_TABLE = np.zeros((256, len(_CLASSES)), np.uint8)
for _i, _members in enumerate(_CLASSES.values()):
    _TABLE[list(_members), _i] = 1
OWN = len(_CLASSES) + 9
FEATURES = 3 * OWN + 3


def line_features(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Features of each line (with those of its neighbours), and the length of each line."""
    lines = text.split("\n")
    data = np.frombuffer(text.encode() + b"\n", np.uint8)
    ends = np.flatnonzero(data == 10)
    starts = np.append(0, ends[:-1] + 1)
    counts = np.add.reduceat(_TABLE[data].astype(np.int32), starts, axis=0).astype(np.float64)
    size = (ends - starts).astype(np.float64)
    per = 1.0 / np.maximum(size, 1)
    own = np.empty((len(lines), OWN))
    own[:, : len(_CLASSES)] = counts * per[:, None]
    words = [line.split() for line in lines]
    n_words = np.array([len(w) for w in words], np.float64)
    different = np.array([len(set(w)) for w in words], np.float64)
    at = len(_CLASSES)
    own[:, at] = np.log1p(size)
    own[:, at + 1] = np.log1p(n_words)
    own[:, at + 2] = size / np.maximum(n_words, 1)
    own[:, at + 3] = different / np.maximum(n_words, 1)
    own[:, at + 4] = size == 0
    own[:, at + 5] = [line[-1:] in (".", "!", "?") for line in lines]
    own[:, at + 6] = [line[:1].isupper() for line in lines]
    own[:, at + 7] = [max(map(len, w), default=0) for w in words]
    own[:, at + 8] = [sum(len(x) <= 3 for x in w) for w in words] / np.maximum(n_words, 1)
    out = np.zeros((len(lines), FEATURES))
    out[:, :OWN] = own
    out[1:, OWN : 2 * OWN] = own[:-1]
    out[:-1, 2 * OWN : 3 * OWN] = own[1:]
    out[0, 3 * OWN] = 1
    out[-1, 3 * OWN + 1] = 1
    out[1:, 3 * OWN + 2] = [a == b for a, b in zip(lines, lines[1:])]
    return out, size + 1


def marginals(good: np.ndarray, lengths: np.ndarray, switch: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Forward-backward over documents side by side.

    ``good``: documents x lines, score of good over bad. Returns the probability of good per line, that of each pair of
    neighbouring labels summed over each document (documents x 2 x 2), and the log of the normaliser.
    """
    n, steps = good.shape
    score = np.stack([np.zeros_like(good), good], axis=2)
    forward = np.empty((steps, n, 2))
    backward = np.zeros((steps, n, 2))
    forward[0] = score[:, 0]
    for t in range(1, steps):
        came = np.logaddexp(forward[t - 1][:, :1] + switch[0], forward[t - 1][:, 1:] + switch[1]) + score[:, t]
        forward[t] = np.where((t < lengths)[:, None], came, forward[t - 1])
    total = np.logaddexp(forward[-1][:, 0], forward[-1][:, 1])
    pairs = np.zeros((n, 2, 2))
    for t in range(steps - 2, -1, -1):
        inside = (t + 1 < lengths)[:, None]
        onward = score[:, t + 1] + backward[t + 1]
        goes = np.logaddexp(switch[:, 0] + onward[:, :1], switch[:, 1] + onward[:, 1:])
        backward[t] = np.where(inside, goes, 0.0)
        joint = forward[t][:, :, None] + switch[None] + onward[:, None, :] - total[:, None, None]
        pairs += np.where(inside[:, :, None], np.exp(np.minimum(joint, 0.0)), 0.0)
    logit = (forward + backward)[:, :, 1] - (forward + backward)[:, :, 0]
    return (1.0 / (1.0 + np.exp(-np.clip(logit, -50, 50)))).T, pairs, total


def _side_by_side(sizes: list[int], most: int = 200_000) -> list[np.ndarray]:
    """Groups of documents of similar length, of at most so many padded lines (a longer document is a group of its own)."""
    order = np.argsort(sizes, kind="stable")
    groups, begin = [], 0
    for i in range(1, len(order) + 1):
        if i == len(order) or (i - begin + 1) * sizes[order[i]] > most or sizes[order[i]] > 2 * sizes[order[begin]] + 4:
            groups.append(order[begin:i])
            begin = i
    return groups


def _pad(rows: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    lengths = np.array([len(r) for r in rows])
    out = np.zeros((len(rows), lengths.max(), *rows[0].shape[1:]))
    for i, r in enumerate(rows):
        out[i, : len(r)] = r
    return out, lengths


def fit(features: list[np.ndarray], weights: list[np.ndarray], labels: np.ndarray, steps: int = 150, ridge: float = 1e-3) -> Model:
    """Train on documents given by their line features, line lengths and labels; every document counts the same."""
    if not len(labels):
        return Model(np.zeros(FEATURES), np.ones(FEATURES), np.zeros(FEATURES + 1), np.zeros((2, 2)), (0.0, 0.0))
    flat = np.concatenate(features)
    mean, scale = flat.mean(axis=0), flat.std(axis=0)
    scale[scale < 1e-6] = 1.0
    ready = [_standard(f, mean, scale) for f in features]
    batches = []
    for group in _side_by_side([len(f) for f in ready]):
        padded, lengths = _pad([ready[i] for i in group])
        batches.append((padded, lengths, labels[group].astype(np.float64)))
    theta = np.zeros(FEATURES + 1 + 4)
    balance = {1: 0.5 / max((labels == 1).mean(), 1e-3), 0: 0.5 / max((labels == 0).mean(), 1e-3)}
    first, second = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, steps + 1):
        w, switch = theta[: FEATURES + 1], theta[FEATURES + 1 :].reshape(2, 2)
        slope = ridge * theta
        for padded, lengths, label in batches:
            good, pairs, _ = marginals(padded @ w, lengths, switch)
            share = np.where(label == 1, balance[1], balance[0]) / lengths / len(labels)
            inside = np.arange(padded.shape[1])[None] < lengths[:, None]
            rest = np.where(inside, label[:, None] - good, 0.0) * share[:, None]
            slope[: FEATURES + 1] -= np.einsum("nt,ntf->f", rest, padded)
            seen = np.zeros((len(label), 2, 2))
            at = label.astype(int)
            seen[np.arange(len(label)), at, at] = lengths - 1
            slope[FEATURES + 1 :] -= ((seen - pairs) * share[:, None, None]).sum(axis=0).ravel()
        first = 0.9 * first + 0.1 * slope
        second = 0.99 * second + 0.01 * slope**2
        theta -= 0.1 * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-9)
    model = Model(mean, scale, theta[: FEATURES + 1], theta[FEATURES + 1 :].reshape(2, 2), (1.0, 0.0))
    raw = np.clip(_raw(model, features, weights), 1e-6, 1 - 1e-6)
    return Model(mean, scale, model.weights, model.switch, _curve(np.log(raw / (1 - raw)), labels))


def _standard(f: np.ndarray, mean: np.ndarray, scale: np.ndarray) -> np.ndarray:
    return np.concatenate([np.clip((f - mean) / scale, -4, 4), np.ones((len(f), 1))], axis=1)


def _curve(x: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """Slope and offset of a logistic curve, by Newton's method with a little smoothing of the labels."""
    n1 = labels.sum()
    target = np.where(labels == 1, (n1 + 1) / (n1 + 2), 1 / (len(labels) - n1 + 2))
    a, b = 0.5, 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * x + b, -50, 50)))
        spread = np.maximum(p * (1 - p), 1e-6)
        slope = np.array([((p - target) * x).sum() + 1e-3 * a, (p - target).sum()])
        bend = np.array([[(spread * x * x).sum() + 1e-3, (spread * x).sum()], [(spread * x).sum(), spread.sum()]])
        change = np.clip(np.linalg.solve(bend + 1e-6 * np.eye(2), slope), -2, 2)
        a, b = a - change[0], b - change[1]
        if np.abs(change).max() < 1e-8:
            break
    return float(max(a, 0.0)), float(b)


def _raw(model: Model, features: list[np.ndarray], weights: list[np.ndarray]) -> np.ndarray:
    """Length-weighted mean probability of good lines."""
    out = np.empty(len(features))
    scores = [_standard(f, model.mean, model.scale) @ model.weights for f in features]
    for group in _side_by_side([len(f) for f in features]):
        padded, lengths = _pad([scores[i] for i in group])
        weight, _ = _pad([weights[i] for i in group])
        good, _, _ = marginals(padded, lengths, model.switch)
        out[group] = (good * weight).sum(axis=1) / weight.sum(axis=1)
    return out


def score_texts(model: Model, texts: list[str]) -> np.ndarray:
    pairs = [line_features(text) for text in texts]
    raw = np.clip(_raw(model, [f for f, _ in pairs], [w for _, w in pairs]), 1e-6, 1 - 1e-6)
    a, b = model.curve
    return 1 / (1 + np.exp(-np.clip(a * np.log(raw / (1 - raw)) + b, -50, 50)))


def train(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "quality", sampling: Sampling = Sampling()) -> Model:
    """Fit on the labelled documents with the smallest hashes of their identifiers."""
    known = labels.where(F.col(label).isin(0, 1) & F.col(doc_id).isNotNull())
    known = known.groupBy(F.col(doc_id).alias("known_id")).agg(F.min(label).cast("int").alias("known"))
    known = known.orderBy(F.xxhash64("known_id"), "known_id").limit(sampling.documents)
    # At most ``sampling.documents`` rows: small enough to send to every task.
    found = docs.join(F.broadcast(known), F.col(doc_id) == F.col("known_id")).select("known_id", "known", F.col(text).alias("text"))
    schema = "known_id string, known int, n_lines int, features binary, sizes binary"
    most = sampling.lines

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = []
        for key, known_, value in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strings(batch.column(2))):
            if value.count("\n") < most:
                f, w = line_features(value)
                rows.append((str(key), known_, len(f), f.astype(np.float32).tobytes(), w.tobytes()))
        kinds = [pa.string(), pa.int32(), pa.int32(), pa.binary(), pa.binary()]
        columns = list(zip(*rows)) or [[]] * 5
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["known_id", "known", "n_lines", "features", "sizes"])

    # Several rows of one identifier are one example.
    sample = map_batches(found, run, schema).groupBy("known_id").agg(F.min(F.struct("known", "n_lines", "features", "sizes")).alias("x"))
    rows = sorted(sample.select("known_id", "x.*").collect(), key=lambda r: r["known_id"])
    features = [np.frombuffer(r["features"], np.float32).reshape(r["n_lines"], FEATURES).astype(np.float64) for r in rows]
    return fit(features, [np.frombuffer(r["sizes"], np.float64) for r in rows], np.array([r["known"] for r in rows], np.int64))


def score(docs: DataFrame, model: Model, text: str = "text", out: str = "score") -> DataFrame:
    """Add the probability that a document is good."""
    if any(c.lower() == out.lower() for c in docs.columns):
        raise ValueError(f"the table already has a column {out}")
    schema = T.StructType([*docs.schema.fields, T.StructField(out, T.DoubleType(), False)])
    names, place = schema.names, docs.columns.index(text)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = strings(batch.column(place))
        scores = np.concatenate([score_texts(model, texts[i : i + 1000]) for i in range(0, len(texts), 1000)])
        return pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores)], names=names)

    return map_batches(docs, run, schema)

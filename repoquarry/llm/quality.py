"""Quality classifier: random-indexing word vectors, pooled over a text, before a two-layer network.

Tokens are runs of letters (all characters beyond ASCII are letters), of digits, or of other signs between
blanks. A token's index vector is a few signs at random places, fixed by the seed and the token's slot, a
hash with SLOTS values; its context vector is the sum of the index vectors found within REACH places around
it in the training texts. The token's vector is both at unit length, added; a text's is the mean over its
tokens, with the logarithm of their number. A network of one hidden layer, trained with numpy, maps it to a
logit, and a temperature found on labelled rows that it was not trained on calibrates the probability.

The model is fitted on at most about ``most`` labelled rows, chosen by a hash of their ids; with fewer, on
all. Its size does not depend on the input. Every text is scored, in the task that reads it. Labels without
id or value take no part; of several labels of one id the lowest counts. Null and empty texts have the zero
vector. Where no label can be learnt from or all are equal, the score is the smoothed share of ones.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from repoquarry.llm.common import SLICE, Rolling, batch_of, slices, utf8, with_fields
from repoquarry.session import materialize, ship_package

SLOTS, WIDTH, SIGNS, REACH, HIDDEN, SEED = 1 << 15, 48, 6, 2, 32, 17
MOST_ROWS = 20_000
THRESHOLD = 0.7
_PART = 1 << 17  # tokens gathered at once

_KIND = np.full(256, 3, np.uint8)
_KIND[0x30:0x3A] = 2
_KIND[0x41:0x5B] = _KIND[0x61:0x7B] = _KIND[0x80:] = 1
_KIND[[0x20, *range(0x09, 0x0E)]] = 0


def token_slots(batch: pa.RecordBatch, text: str) -> tuple[np.ndarray, np.ndarray]:
    """Slots of all tokens, and where each row's begin and end."""
    data, at = utf8(batch.column(text))
    kind = np.concatenate([[0], _KIND[data], [0]]).astype(np.int8)
    change = kind[1:] != kind[:-1]
    edge = at[1:-1][(at[1:-1] > 0) & (at[1:-1] < len(data))]
    change[edge] = True  # tokens end with their text
    bounds = np.flatnonzero(change)
    starts, ends = bounds[:-1], bounds[1:]
    token = kind[starts + 1] > 0 if len(starts) else np.zeros(0, bool)
    starts, ends = starts[token], ends[token]
    slots = np.zeros(len(starts), np.int64)
    cuts = np.searchsorted(starts, np.arange(0, len(data) + SLICE, SLICE))
    for a, b in zip(cuts, cuts[1:], strict=False):  # a long text is hashed part by part
        if a < b:
            low = starts[a]
            hashes = Rolling(data[low : ends[b - 1]]).of(starts[a:b] - low, ends[a:b] - low)
            slots[a:b] = (hashes >> np.uint64(49)).astype(np.int64)
    return slots, np.searchsorted(starts, at)


def index_vectors() -> np.ndarray:
    rng = np.random.default_rng(SEED)
    out = np.zeros((SLOTS, WIDTH), np.float32)
    place = rng.integers(0, WIDTH, (SLOTS, SIGNS))
    sign = rng.choice(np.array([-1.0, 1.0], np.float32), (SLOTS, SIGNS))
    np.add.at(out, (np.arange(SLOTS)[:, None], place), sign)
    return out


def _unit(x: np.ndarray) -> np.ndarray:
    size = np.linalg.norm(x, axis=1, keepdims=True)
    return x / np.where(size > 0, size, 1)


def _sums_by_slot(total: np.ndarray, slots: np.ndarray, around: np.ndarray, index: np.ndarray) -> None:
    for a in range(0, len(slots), _PART):
        own, other = slots[a : a + _PART], around[a : a + _PART]
        order = np.argsort(own, kind="stable")
        own = own[order]
        first = np.flatnonzero(np.append(True, own[1:] != own[:-1]))
        total[own[first]] += np.add.reduceat(index[other[order]], first, axis=0)


def context_sums(texts: DataFrame, text: str) -> np.ndarray:
    """Context vectors of all slots: each task sends its sums, a matrix of fixed size."""

    def run(batches):
        index, total = index_vectors(), np.zeros((SLOTS, WIDTH), np.float32)
        for whole in batches:
            for batch in slices(whole, text, SLICE):
                slots, at = token_slots(batch, text)
                row = np.repeat(np.arange(batch.num_rows), np.diff(at))
                for reach in range(1, REACH + 1):
                    near = np.flatnonzero(row[reach:] == row[:-reach])
                    _sums_by_slot(total, slots[near], slots[near + reach], index)
                    _sums_by_slot(total, slots[near + reach], slots[near], index)
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["sums"])

    total = np.zeros((SLOTS, WIDTH), np.float64)
    for row in texts.select(text).coalesce(8).mapInArrow(run, "sums binary").collect():
        total += np.frombuffer(row["sums"], np.float32).reshape(SLOTS, WIDTH)
    return total


def pooled(batch: pa.RecordBatch, text: str, vectors: np.ndarray) -> np.ndarray:
    """One row of WIDTH + 1 numbers for each text."""
    slots, at = token_slots(batch, text)
    out = np.zeros((batch.num_rows, WIDTH + 1))
    count = np.diff(at)
    row = np.repeat(np.arange(batch.num_rows), count)
    for a in range(0, len(slots), _PART):
        rows = row[a : a + _PART]
        first = np.flatnonzero(np.append(True, rows[1:] != rows[:-1]))
        out[rows[first], :WIDTH] += np.add.reduceat(vectors[slots[a : a + _PART]], first, axis=0, dtype=np.float64)
    out[:, :WIDTH] /= np.maximum(count, 1)[:, None]
    out[:, WIDTH] = np.log1p(count)
    return out


@dataclass
class Network:
    """Probability = sigmoid(logit / temperature)."""

    mean: np.ndarray
    scale: np.ndarray
    weights: tuple[np.ndarray, ...]
    temperature: float
    constant: float | None = None

    def logits(self, x: np.ndarray) -> np.ndarray:
        w1, b1, w2, b2 = self.weights
        return np.tanh((x - self.mean) / self.scale @ w1 + b1) @ w2 + b2

    def __call__(self, x: np.ndarray) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(x), self.constant)
        return 1 / (1 + np.exp(-np.clip(self.logits(x) / self.temperature, -500, 500)))


def train(x: np.ndarray, y: np.ndarray, calibrate: np.ndarray, steps: int = 400) -> Network:
    """Fit on the rows outside ``calibrate``, then the temperature on those inside it."""
    fit = ~calibrate
    if not len(y) or len(np.unique(y[fit])) < 2:
        return Network(np.zeros(0), np.zeros(0), (), 1.0, float((y.sum() + 1) / (len(y) + 2)))
    mean, scale = x[fit].mean(0), x[fit].std(0) + 1e-6
    z, t = (x[fit] - mean) / scale, y[fit].astype(float)
    rng = np.random.default_rng(SEED)
    p = [rng.normal(0, x.shape[1] ** -0.5, (x.shape[1], HIDDEN)), np.zeros(HIDDEN), rng.normal(0, HIDDEN**-0.5, HIDDEN), np.zeros(1)]
    m, v = [np.zeros_like(a) for a in p], [np.zeros_like(a) for a in p]
    for step in range(1, steps + 1):
        h = np.tanh(z @ p[0] + p[1])
        d = (1 / (1 + np.exp(-np.clip(h @ p[2] + p[3], -500, 500))) - t) / len(t)
        back = np.outer(d, p[2]) * (1 - h * h)
        grads = [z.T @ back + 1e-4 * p[0], back.sum(0), h.T @ d + 1e-4 * p[2], np.array([d.sum()])]
        for i, g in enumerate(grads):
            m[i] = 0.9 * m[i] + 0.1 * g
            v[i] = 0.999 * v[i] + 0.001 * g * g
            p[i] -= 0.02 * (m[i] / (1 - 0.9**step)) / (np.sqrt(v[i] / (1 - 0.999**step)) + 1e-8)
    net = Network(mean, scale, tuple(p), 1.0)
    if calibrate.any():
        logit, t = net.logits(x[calibrate]), y[calibrate]
        sign = np.where(t == 1, 1, -1)
        heat = np.geomspace(0.25, 8, 61)
        loss = [np.logaddexp(0, -sign * logit / h).mean() for h in heat]
        net.temperature = float(heat[int(np.argmin(loss))])
    return net


def fit(docs: DataFrame, labels: DataFrame, doc_id: str, text: str, label: str, most: int = MOST_ROWS) -> tuple[np.ndarray, Network]:
    """(vectors of all slots, network) from the documents that have one of these labels."""
    ship_package(docs.sparkSession)
    known = labels.where(F.col(doc_id).isNotNull() & F.col(label).isNotNull())
    known = known.groupBy(F.col(doc_id).cast("long").alias("_id")).agg((F.min(label) > 0).cast("int").alias("_label"))
    count = known.count()
    lot = F.pmod(F.xxhash64(F.lit(SEED), "_id"), F.lit(1 << 30))
    if count > most:
        known = known.where(lot < int((1 << 30) * most / count))
    # at most about ``most`` rows of an id and a label: small enough for every executor
    rows = docs.select(F.col(doc_id).cast("long").alias("_id"), F.col(text).cast("string").alias("_text"))
    chosen, _ = materialize(rows.join(F.broadcast(known), "_id"), "labelled")
    own = index_vectors()
    vectors = (_unit(own) + _unit(context_sums(chosen, "_text"))).astype(np.float32)
    held = chosen.sparkSession.sparkContext.broadcast(vectors)

    def run(batches):
        for whole in batches:
            for batch in slices(whole, "_text", SLICE):
                x = pooled(batch, "_text", held.value)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("_id"), batch.column("_label"), pa.array([v.tobytes() for v in x], pa.binary())], ["_id", "_label", "x"]
                )

    pooled_rows = chosen.mapInArrow(run, "_id bigint, _label int, x binary").select("_id", "_label", "x", (lot % 5 == 0).alias("c"))
    got = sorted((r["_id"], r["x"], r["_label"], r["c"]) for r in pooled_rows.collect())
    x = np.array([np.frombuffer(r[1]) for r in got]).reshape(-1, WIDTH + 1)
    y = np.array([r[2] for r in got], np.int64)
    return vectors, train(x, y, np.array([r[3] for r in got], bool))


def score_quality(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "quality", most: int = MOST_ROWS, threshold: float = THRESHOLD, keep_text: bool = True) -> DataFrame:
    """Documents with score, the probability of label 1, and predicted, whether it reaches the threshold."""
    vectors, network = fit(docs, labels, doc_id, text, label, most)
    held = docs.sparkSession.sparkContext.broadcast((vectors, network))
    schema = with_fields(docs.schema, ("score", "double"), ("predicted", "int"), drop=() if keep_text else (text,))

    def run(batches):
        vectors, network = held.value
        for whole in batches:
            for batch in slices(whole, text, SLICE):
                score = network(pooled(batch, text, vectors))
                yield batch_of(batch, schema, {"score": pa.array(score), "predicted": pa.array((score >= threshold).astype(np.int32))})

    return docs.mapInArrow(run, schema)

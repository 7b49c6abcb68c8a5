"""Language ID by a bidirectional gated recurrent network over bytes.

Every byte of a text is a position: texts are cut into windows of ``WINDOW`` bytes, one recurrent pass runs over each
from either side, and both states label the position with a distribution over languages. A document's distribution is
the mean over all its positions. Windows of many documents are stepped together as one matrix.

The network is trained in NumPy by backpropagation through time on a bounded sample: at most ``train_docs`` documents
of each label (those of least hash of their id) with ``train_windows`` windows from all over each text; this bound is
the only one. Prediction reads every byte of every text.

Defined results: ``und`` with score 0 for a null text, one without a letter, and where no label was learned; a null id
counts as one that may be learned from; rows with equal ids are judged each by its own text; other columns are ignored.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .words import map_blocks

WINDOW = 64
STATE = 8
TRAIN_DOCS = 250
TRAIN_WINDOWS = 24
STEPS = 300
BATCH = 384
RATE = 0.02
UNKNOWN = "und"
#: Windows stepped together when predicting.
_TOGETHER = 4096
_LETTER = re.compile(r"[^\W\d_]")


def _sigmoid(x: np.ndarray) -> np.ndarray:
    x *= 0.5
    np.tanh(x, out=x)
    x += 1
    x *= 0.5
    return x


class Direction:
    """One gated recurrent layer: input table (3 states x 256 bytes, biases included) and recurrent weights."""

    def __init__(self, rng: np.random.Generator, state: int):
        self.table = rng.normal(0, 0.3, (3 * state, 256)).astype(np.float32)
        self.weights = rng.normal(0, 1 / np.sqrt(state), (3 * state, state)).astype(np.float32)

    def states(self, steps: np.ndarray, keep: list | None = None):
        """States after each row of ``steps`` (bytes of all windows at one place); ``keep`` gets what training needs."""
        size = self.weights.shape[1]
        h = np.zeros((size, steps.shape[1]), np.float32)
        for row in steps:
            own, back = self.table[:, row], self.weights @ h
            own[:2 * size] += back[:2 * size]
            gates = _sigmoid(own[:2 * size])
            z, r = gates[:size], gates[size:]
            new = np.tanh(own[2 * size:] + r * back[2 * size:])
            if keep is not None:
                keep.append((row, h, z.copy(), r.copy(), new, back[2 * size:].copy()))
            h = new + z * (h - new)
            yield h

    def gradient(self, kept: list, by_state: list) -> tuple[np.ndarray, np.ndarray]:
        """Gradients of table and weights by backpropagation through time, given those of each state."""
        size = self.weights.shape[1]
        table, weights = np.zeros_like(self.table), np.zeros_like(self.weights)
        ahead = np.zeros_like(by_state[0])
        for (row, h, z, r, new, back), own in zip(reversed(kept), reversed(by_state)):
            d = own + ahead
            d_new = d * (1 - z) * (1 - new * new)
            d_z = d * (h - new) * z * (1 - z)
            d_r = d_new * back * r * (1 - r)
            np.add.at(table.T, row, np.concatenate([d_z, d_r, d_new]).T)
            d_back = np.concatenate([d_z, d_r, d_new * r])
            weights += d_back @ h.T
            ahead = d * z + self.weights.T @ d_back
        return table, weights


class ByteNet:
    """Both directions and the labels of positions."""

    def __init__(self, labels: list[str], seed: int = 11, state: int = STATE):
        rng = np.random.default_rng(seed)
        self.labels = labels
        self.ahead, self.behind = Direction(rng, state), Direction(rng, state)
        self.out = rng.normal(0, 0.3, (2, len(labels), state)).astype(np.float32)
        self.bias = np.zeros((len(labels), 1), np.float32)

    def positions(self, windows: np.ndarray, kept: tuple[list, list] | None = None,
                  states: tuple[list, list] | None = None) -> np.ndarray:
        """Distribution over labels of each position: places x labels x windows."""
        steps = np.ascontiguousarray(windows.T)
        n = len(steps)
        logits = np.empty((n, len(self.labels), steps.shape[1]), np.float32)
        for t, h in enumerate(self.ahead.states(steps, kept and kept[0])):
            np.matmul(self.out[0], h, out=logits[t])
            if states:
                states[0].append(h)
        for t, h in enumerate(self.behind.states(steps[::-1], kept and kept[1])):
            logits[n - 1 - t] += self.out[1] @ h
            if states:
                states[1].append(h)
        logits += self.bias
        logits -= logits.max(axis=1, keepdims=True)
        np.exp(logits, out=logits)
        logits /= logits.sum(axis=1, keepdims=True)
        return logits

    def train(self, windows: np.ndarray, lengths: np.ndarray, target: np.ndarray, steps: int = STEPS, seed: int = 5) -> None:
        rng = np.random.default_rng(seed)
        params = [self.ahead.table, self.ahead.weights, self.behind.table, self.behind.weights, self.out, self.bias]
        first, second = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
        # Each label is drawn equally often, so a rare language is learned as well as a common one.
        by_label = [np.flatnonzero(target == k) for k in range(len(self.labels))]
        for step in range(1, steps + 1):
            chosen = np.concatenate([rng.choice(own, max(1, BATCH // len(by_label))) for own in by_label])
            kept, states = ([], []), ([], [])
            d = self.positions(windows[chosen], kept, states)
            d[:, target[chosen], np.arange(len(chosen))] -= 1
            d *= (np.arange(WINDOW)[:, None] < lengths[chosen])[:, None, :]
            d /= max(1, int(lengths[chosen].sum()))
            back = d[::-1]
            grads = [
                *self.ahead.gradient(kept[0], [self.out[0].T @ x for x in d]),
                *self.behind.gradient(kept[1], [self.out[1].T @ x for x in back]),
                np.stack([sum(x @ h.T for x, h in zip(d, states[0])), sum(x @ h.T for x, h in zip(back, states[1]))]),
                d.sum(axis=(0, 2))[:, None]]
            rate = RATE * min(1.0, 2 * (1 - (step - 1) / steps))
            for p, g, m, v in zip(params, grads, first, second):
                m += 0.1 * (g - m)
                v += 0.01 * (g * g - v)
                p -= rate * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.99 ** step)) + 1e-7)

    def documents(self, texts: list[bytes]) -> np.ndarray:
        """Mean distribution over all positions of each text."""
        pooled = np.zeros((len(texts), len(self.labels)))
        windows, lengths, owner = cut(texts)
        for a in range(0, len(windows), _TOGETHER):
            part = self.positions(windows[a:a + _TOGETHER])
            part *= (np.arange(WINDOW)[:, None] < lengths[a:a + _TOGETHER])[:, None, :]
            np.add.at(pooled, owner[a:a + _TOGETHER], part.sum(axis=0).T)
        return pooled / np.maximum(pooled.sum(axis=1, keepdims=True), 1e-30)


def cut(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Windows of all texts, padded with zeros, their lengths, and the text each is from."""
    sizes = np.array([len(t) for t in texts], np.int64)
    counts = -(-sizes // WINDOW)
    body = np.zeros(int(counts.sum()) * WINDOW, np.uint8)
    starts = (np.cumsum(counts) - counts) * WINDOW
    for start, text in zip(starts.tolist(), texts):
        body[start:start + len(text)] = np.frombuffer(text, np.uint8)
    owner = np.repeat(np.arange(len(texts)), counts)
    place = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
    return body.reshape(-1, WINDOW), np.minimum(sizes[owner] - place * WINDOW, WINDOW), owner


def held_out(id_col: Column) -> Column:
    return F.coalesce(F.pmod(F.crc32(id_col.cast("string")), F.lit(4)) == 2, F.lit(False))


def _sampled(windows: int):
    def work(block: pa.RecordBatch) -> dict | None:
        out: dict[str, list] = {"lang": [], "order": [], "window": []}
        for lang, order, text in zip(*(block.column(c).to_pylist() for c in ("lang", "order", "text"))):
            body = text.encode()
            # Evenly over the whole text.
            for at in np.linspace(0, max(0, len(body) - WINDOW), min(windows, -(-len(body) // WINDOW))).astype(int):
                for name, value in zip(out, (lang, order, body[at:at + WINDOW])):
                    out[name].append(value)
        return out if out["lang"] else None

    return work


def learn(df: DataFrame, train_docs: int = TRAIN_DOCS, train_windows: int = TRAIN_WINDOWS, steps: int = STEPS) -> ByteNet | None:
    """Train on (doc_id, text, lang) rows that are not held out; None where no text has a label."""
    named = df.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & (F.col("text") != "") & ~held_out(F.col("doc_id")))
    named = named.select(F.coalesce(F.xxhash64("doc_id"), F.lit(0)).alias("order"), "lang", "text")
    counts = named.groupBy("lang").count()
    # Rows above the share that holds twice the bound never reach the ranking.
    likely = named.join(F.broadcast(counts), "lang").where(
        F.pmod("order", F.lit(1 << 30)) <= F.lit(float(1 << 30)) * (2.0 * train_docs + 50) / F.col("count"))
    ranked = likely.withColumn("rank", F.row_number().over(
        Window.partitionBy("lang").orderBy(F.pmod("order", F.lit(1 << 30)), "order", "text")))
    sample = map_blocks(ranked.where(F.col("rank") <= train_docs), _sampled(train_windows),
                        "lang string, order long, window binary").toArrow().sort_by([("lang", "ascending"), ("order", "ascending"), ("window", "ascending")])
    if not sample.num_rows:
        return None
    labels = sorted(set(sample["lang"].to_pylist()))
    net = ByteNet(labels)
    windows, lengths, _ = cut(sample["window"].to_pylist())
    at = {label: i for i, label in enumerate(labels)}
    net.train(windows, lengths, np.array([at[x] for x in sample["lang"].to_pylist()]), steps)
    return net


def identify(df: DataFrame, net: ByteNet | None = None, id_col: str = "doc_id", text_col: str = "text",
             lang_col: str = "lang") -> DataFrame:
    """One row per row of ``df``: doc_id, held_out, lang_pred, score."""
    docs = df.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"),
                     F.col(f"`{lang_col}`").cast("string").alias("lang"))
    shared = df.sparkSession.sparkContext.broadcast(net or learn(docs))

    def work(block: pa.RecordBatch) -> dict:
        net, texts = shared.value, block.column("text").to_pylist()
        names, scores = [UNKNOWN] * len(texts), [0.0] * len(texts)
        known = [i for i, t in enumerate(texts) if net is not None and t and _LETTER.search(t)]
        if known:
            pooled = net.documents([texts[i].encode() for i in known])
            for i, k, p in zip(known, pooled.argmax(axis=1).tolist(), pooled.max(axis=1).tolist()):
                names[i], scores[i] = net.labels[k], min(1.0, p)
        return {"doc_id": block.column("doc_id"), "held_out": block.column("held_out"), "lang_pred": names, "score": scores}

    rows = docs.select("doc_id", "text", held_out(F.col("doc_id")).alias("held_out"))
    return map_blocks(rows, work, "doc_id long, held_out boolean, lang_pred string, score double", limit=1 << 20)

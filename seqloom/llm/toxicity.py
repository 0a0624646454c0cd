"""Operator 4, toxicity: a bidirectional gated recurrent network with attention, in numpy.

A word enters as its own vector, if it was frequent enough in training, plus the mean vector of its
character n-grams. Two gated recurrences, one per direction, read a window of words; attention pools
their states into one logit. A document is read as all its overlapping windows, one from every word
on, and its score is that of its worst window. Training knows documents, not windows: each document's
loss reaches its windows in proportion to how likely each is the one; it takes every `STRIDE`th window.

The network is fitted on the driver, on at most `most_toxic` and `most_clean` labelled documents of
at most `most_words` words, chosen by a hash; these bounds also bound the model, which goes to all
tasks as one broadcast. Scoring reads every text whole, next to its key, without a shuffle; a task
holds one Arrow batch and the states of `chunk` windows.

Defined results: null, blank and wordless texts have the score of a window without words; without
labelled documents of both kinds all scores are the share of toxic labels; repeated rows repeat; a
null key is neither held out nor learned from.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import DoubleType, StructField, StructType

from seqloom.llm.common import held_out, narrow, table, trains

FOLDS = 4
THRESHOLD = 0.3
WINDOW, STRIDE = 8, 4
MOST_TOXIC, MOST_CLEAN, MOST_WORDS = 1200, 2400, 3000
SIZE, STATE, ATTENTION = 16, 8, 8
GRAMS, GRAM_BITS = (3, 4, 5), 15
FREQUENT = 3
EPOCHS, BATCH, RATE = 6, 32, 0.01
_WORDS = re.compile(r"[^\W_]+")
_KNOWN_TYPES = 200_000

Parameters = dict[str, np.ndarray]


def words_of(text: str | None) -> list[str]:
    return _WORDS.findall((text or "").lower())


def gram_rows(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the character n-grams of all words, ends marked, and where each word's begin."""
    data = [b"<" + w.encode() + b">" for w in words]
    lengths = np.array([len(d) for d in data], dtype=np.int64)
    letters = np.frombuffer(b"".join(data), dtype=np.uint8).astype(np.uint32)
    owner = np.repeat(np.arange(len(words)), lengths)
    ends = np.repeat(np.cumsum(lengths), lengths)
    owners, buckets = [], []
    for size in GRAMS:
        at = np.flatnonzero(np.arange(len(letters)) + size <= ends)
        mixed = np.full(len(at), size, dtype=np.uint32)
        for k in range(size):
            mixed = (mixed ^ letters[at + k]) * np.uint32(0x01000193)
        mixed ^= mixed >> np.uint32(15)
        owners.append(owner[at])
        buckets.append((mixed * np.uint32(0x2C1B3C6D)) >> np.uint32(32 - GRAM_BITS))
    owners, buckets = np.concatenate(owners), np.concatenate(buckets).astype(np.int64)
    order = np.argsort(owners, kind="stable")
    return buckets[order], np.searchsorted(owners[order], np.arange(len(words)))


def windows_of(numbers: np.ndarray, window: int = WINDOW, stride: int = STRIDE) -> np.ndarray:
    """Overlapping windows, one per row, -1 behind the last word; one empty window for no words."""
    count = max(1, -(-(len(numbers) - window) // stride) + 1)
    padded = np.full((count - 1) * stride + window, -1, dtype=np.int64)
    padded[: len(numbers)] = numbers
    return np.lib.stride_tricks.sliding_window_view(padded, window)[::stride]


def start(vocabulary: int, seed: int = 1) -> Parameters:
    draw = np.random.default_rng(seed)

    def normal(*shape: int, scale: float) -> np.ndarray:
        return (draw.standard_normal(shape) * scale).astype(np.float32)

    made = {"word": normal(vocabulary, SIZE, scale=0.05), "gram": normal(1 << GRAM_BITS, SIZE, scale=0.3)}
    made["word"][0] = 0  # words too rare to have a vector of their own
    for way in ("f", "b"):
        made[f"in_{way}"] = normal(SIZE, 3 * STATE, scale=SIZE**-0.5)
        made[f"bias_{way}"] = np.zeros(3 * STATE, dtype=np.float32)
        made[f"state_{way}"] = normal(STATE, 3 * STATE, scale=STATE**-0.5)
    made["attend"] = normal(2 * STATE, ATTENTION, scale=(2 * STATE) ** -0.5)
    made["query"] = normal(ATTENTION, scale=1.0)
    made["out"] = normal(2 * STATE, scale=0.5)
    made["out_bias"] = np.full(1, -1.0, dtype=np.float32)
    return made


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


def _squash(x: np.ndarray, out: np.ndarray | None = None) -> np.ndarray:
    """x / (1 + |x|), between -1 and 1: the bend of the network, a quarter of the time of tanh."""
    below = np.abs(x)
    below += 1
    return np.divide(x, below, out=out)


def _squash_slope(y: np.ndarray) -> np.ndarray:
    return (1 - np.abs(y)) ** 2


def _gate(x: np.ndarray) -> np.ndarray:
    return 0.5 * _squash(x) + 0.5


def _gate_slope(y: np.ndarray) -> np.ndarray:
    return 0.5 * _squash_slope(2 * y - 1)


def type_vectors(p: Parameters, own: np.ndarray, buckets: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """The input of each different word: its own vector and the mean of its n-grams'."""
    sizes = np.diff(np.append(begins, len(buckets)))
    return p["word"][own] + np.add.reduceat(p["gram"][buckets], begins, axis=0) / sizes[:, None].astype(np.float32)


def gates(p: Parameters, vectors: np.ndarray) -> dict[str, np.ndarray]:
    """What each different word feeds to the gates of both directions; the last row is no word."""
    rows = {way: vectors @ p[f"in_{way}"] + p[f"bias_{way}"] for way in ("f", "b")}
    return {way: np.vstack([r, np.zeros((1, r.shape[1]), dtype=np.float32)]) for way, r in rows.items()}


def _recur(state_weights: np.ndarray, fed: np.ndarray, windows: np.ndarray, steps: list[int], tape: list | None) -> np.ndarray:
    """States of one direction, (steps, windows, STATE)."""
    state = np.zeros((len(windows), STATE), dtype=np.float32)
    states = np.empty((windows.shape[1], len(windows), STATE), dtype=np.float32)
    for t in steps:
        here = fed[windows[:, t]]
        sent = state @ state_weights
        both = _gate(here[:, : 2 * STATE] + sent[:, : 2 * STATE])
        z, r = both[:, :STATE], both[:, STATE:]
        new = _squash(here[:, 2 * STATE :] + r * sent[:, 2 * STATE :])
        word = (windows[:, t] >= 0)[:, None]
        after = np.where(word, new + z * (state - new), state)
        if tape is not None:
            tape.append((t, state, z, r, new, sent[:, 2 * STATE :], word))
        state = states[t] = after
    return states


def forward(p: Parameters, fed: dict[str, np.ndarray], windows: np.ndarray, tape: dict | None = None) -> np.ndarray:
    """One logit per window."""
    order = list(range(windows.shape[1]))
    kept = {"f": [], "b": []} if tape is not None else {"f": None, "b": None}
    states = np.concatenate(
        [
            _recur(p["state_f"], fed["f"], windows, order, kept["f"]),
            _recur(p["state_b"], fed["b"], windows, order[::-1], kept["b"]),
        ],
        axis=2,
    )
    hidden = _squash(states @ p["attend"])
    marks = hidden @ p["query"]
    marks = np.where(windows.T >= 0, marks, np.float32(-1e9))
    shares = np.exp(marks - marks.max(axis=0))
    shares /= shares.sum(axis=0)
    pooled = np.einsum("tb,tbh->bh", shares, states)
    pooled[windows[:, 0] < 0] = 0
    if tape is not None:
        tape.update(kept=kept, states=states, hidden=hidden, shares=shares, pooled=pooled)
    return pooled @ p["out"] + p["out_bias"][0]


def every_window(p: Parameters, fed: dict[str, np.ndarray], numbers: np.ndarray, window: int) -> np.ndarray:
    """One logit per window of a row of words, as `forward` gives for all windows without padding.

    Windows are columns, so that what they read at one step is a slice of the row.
    """
    count = len(numbers) - window + 1
    states = np.empty((window, 2 * STATE, count), dtype=np.float32)
    for way, part, steps in (("f", slice(0, STATE), range(window)), ("b", slice(STATE, None), range(window - 1, -1, -1))):
        inputs, weights = np.ascontiguousarray(fed[way][numbers].T), np.ascontiguousarray(p[f"state_{way}"].T)
        state = np.zeros((STATE, count), dtype=np.float32)
        for t in steps:
            here, sent = inputs[:, t : t + count], weights @ state
            both = sent[: 2 * STATE]
            both += here[: 2 * STATE]
            _squash(both, out=both)
            both *= 0.5
            both += 0.5
            new = sent[2 * STATE :]
            new *= both[STATE:]
            new += here[2 * STATE :]
            _squash(new, out=new)
            after = np.subtract(state, new, out=states[t, part])
            after *= both[:STATE]
            after += new
            state = after
    hidden = np.ascontiguousarray(p["attend"].T) @ states
    marks = p["query"] @ _squash(hidden, out=hidden)
    marks -= marks.max(axis=0)
    np.exp(marks, out=marks)
    return (marks * (p["out"] @ states)).sum(axis=0) / marks.sum(axis=0) + p["out_bias"][0]


def _sum_rows(rows: np.ndarray, keys: np.ndarray, size: int) -> np.ndarray:
    """Rows added up by key."""
    total = np.zeros((size, rows.shape[1]), dtype=np.float32)
    if len(keys):
        order = np.argsort(keys, kind="stable")
        found, first = np.unique(keys[order], return_index=True)
        total[found] = np.add.reduceat(rows[order], first, axis=0)
    return total


def backward(p: Parameters, tape: dict, windows: np.ndarray, slope: np.ndarray) -> tuple[Parameters, dict[str, np.ndarray]]:
    """Gradients of the network, and of what each different word feeds, for slopes of the logits."""
    shares, states, hidden = tape["shares"], tape["states"], tape["hidden"]
    slope = slope.astype(np.float32)
    grad = {"out": tape["pooled"].T @ slope, "out_bias": slope.sum(keepdims=True)}
    d_pooled = slope[:, None] * p["out"]
    d_pooled[windows[:, 0] < 0] = 0
    d_shares = np.einsum("bh,tbh->tb", d_pooled, states)
    d_states = shares[:, :, None] * d_pooled
    d_marks = shares * (d_shares - (shares * d_shares).sum(axis=0))
    grad["query"] = np.einsum("tb,tbk->k", d_marks, hidden)
    d_hidden = d_marks[:, :, None] * p["query"] * _squash_slope(hidden)
    grad["attend"] = np.einsum("tbh,tbk->hk", states, d_hidden)
    d_states += d_hidden @ p["attend"].T
    fed = {}
    types = int(windows.max(initial=-1)) + 1
    for way, part in (("f", slice(0, STATE)), ("b", slice(STATE, 2 * STATE))):
        weights = p[f"state_{way}"]
        grad[f"state_{way}"] = np.zeros_like(weights)
        carried = np.zeros((len(windows), STATE), dtype=np.float32)
        d_fed = np.empty((windows.shape[1], len(windows), 3 * STATE), dtype=np.float32)
        for t, before, z, r, new, sent, word in reversed(tape["kept"][way]):
            d = carried + d_states[t, :, part]
            d_word = np.where(word, d, 0)
            d_new = d_word * (1 - z) * _squash_slope(new)
            d_z = d_word * (before - new) * _gate_slope(z)
            d_r = d_new * sent * _gate_slope(r)
            d_fed[t] = np.concatenate([d_z, d_r, d_new], axis=1)
            d_sent = np.concatenate([d_z, d_r, d_new * r], axis=1)
            grad[f"state_{way}"] += before.T @ d_sent
            carried = d - d_word + d_word * z + d_sent @ weights.T
        there = windows.T.ravel() >= 0
        fed[way] = _sum_rows(d_fed.reshape(-1, 3 * STATE)[there], windows.T.ravel()[there], types)
    return grad, fed


class Trainer:
    """Adam over documents, each a bag of windows."""

    def __init__(self, texts: list[list[str]], labels: np.ndarray, seed: int = 1):
        self.texts, self.labels, self.seed = texts, labels, seed
        counts = Counter(w for words in texts for w in words)
        frequent = sorted(w for w, n in counts.items() if n >= FREQUENT)
        self.own = {w: n + 1 for n, w in enumerate(frequent)}
        self.p = start(len(frequent) + 1, seed)
        self.moments = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in self.p.items()}
        self.steps = 0

    def batch(self, chosen: np.ndarray) -> None:
        seen: dict[str, int] = {}
        bags = [np.array([seen.setdefault(w, len(seen)) for w in self.texts[n]], dtype=np.int64) for n in chosen]
        parts = [windows_of(bag) for bag in bags]
        windows, bag_of = np.concatenate(parts), np.repeat(np.arange(len(parts)), [len(w) for w in parts])
        types = list(seen) or ["-"]
        own = np.array([self.own.get(w, 0) for w in types])
        buckets, begins = gram_rows(types)
        vectors, tape = type_vectors(self.p, own, buckets, begins), {}
        logits = forward(self.p, gates(self.p, vectors), windows, tape)
        first = np.searchsorted(bag_of, np.arange(len(parts)))
        shares = np.exp(logits - np.maximum.reduceat(logits, first)[bag_of])
        shares /= np.add.reduceat(shares, first)[bag_of]
        error = _sigmoid(np.add.reduceat(shares * logits, first)) - self.labels[chosen]
        grad, fed = backward(self.p, tape, windows, shares * error[bag_of] / len(parts))
        d_vectors = np.zeros_like(vectors)
        for way, rows in fed.items():
            grad[f"in_{way}"] = vectors[: len(rows)].T @ rows
            grad[f"bias_{way}"] = rows.sum(axis=0)
            d_vectors[: len(rows)] += rows @ self.p[f"in_{way}"].T
        sizes = np.diff(np.append(begins, len(buckets)))
        grad["gram"] = _sum_rows(np.repeat(d_vectors / sizes[:, None].astype(np.float32), sizes, axis=0), buckets, 1 << GRAM_BITS)
        grad["word"] = _sum_rows(d_vectors[own > 0], own[own > 0], len(self.p["word"]))
        self.step(grad)

    def step(self, grad: Parameters) -> None:
        self.steps += 1
        for name, g in grad.items():
            mean, square = self.moments[name]
            mean += 0.1 * (g - mean)
            square += 0.001 * (g * g - square)
            scale = RATE * np.sqrt(1 - 0.999**self.steps) / (1 - 0.9**self.steps)
            self.p[name] -= scale * mean / (np.sqrt(square) + 1e-8)

    def fit(self, epochs: int = EPOCHS) -> None:
        draw = np.random.default_rng(self.seed)
        for _ in range(epochs):
            order = draw.permutation(len(self.texts))
            for first in range(0, len(order), BATCH):
                self.batch(order[first : first + BATCH])


def scorer(p: Parameters, own: dict[str, int], scale: float, shift: float, chunk: int = 2048, window: int = WINDOW) -> Callable[[list[str | None]], np.ndarray]:
    """A function from texts to their scores; it keeps what known words feed to the gates."""
    seen: dict[str, int] = {}
    fed = {way: np.zeros((0, 3 * STATE), dtype=np.float32) for way in ("f", "b")}

    def numbers_of(words: list[list[str]]) -> list[np.ndarray]:
        nonlocal fed
        if len(seen) > _KNOWN_TYPES:
            seen.clear()
            fed = {way: rows[:0] for way, rows in fed.items()}
        known = len(seen)
        found = [np.array([seen.setdefault(w, len(seen)) for w in some], dtype=np.int64) for some in words]
        if len(seen) > known:
            new = list(seen)[known:]
            rows = gates(p, type_vectors(p, np.array([own.get(w, 0) for w in new]), *gram_rows(new)))
            fed = {way: np.concatenate([fed[way][:known], rows[way]]) for way in fed}
        elif not len(fed["f"]):
            fed = {way: np.zeros((1, 3 * STATE), dtype=np.float32) for way in fed}
        return found

    def score(texts: list[str | None]) -> np.ndarray:
        parts = numbers_of([words_of(t) for t in texts])
        sizes = np.array([len(numbers) for numbers in parts], dtype=np.int64)
        worst = np.empty(len(parts))
        short, full = np.flatnonzero(sizes < window), np.flatnonzero(sizes >= window)
        if len(short):
            worst[short] = forward(p, fed, np.concatenate([windows_of(parts[n], window, 1) for n in short]))
        if len(full):
            row, ends = np.concatenate([parts[n] for n in full]), np.cumsum(sizes[full])
            pieces = [every_window(p, fed, row[n : n + chunk + window - 1], window) for n in range(0, len(row) - window + 1, chunk)]
            logits = np.concatenate(pieces)
            across = np.arange(len(logits)) + window > np.repeat(ends, sizes[full])[: len(logits)]
            logits[across] = -np.inf
            worst[full] = np.maximum.reduceat(logits, ends - sizes[full])
        return 1 / (1 + np.exp(-(scale * worst + shift)))

    return score


def calibrate(logits: np.ndarray, labels: np.ndarray, weights: np.ndarray) -> tuple[float, float]:
    """Slope and offset that make weighted labels likeliest; smoothed targets keep them finite."""
    up, down = (weights * labels).sum(), (weights * (1 - labels)).sum()
    target = np.where(labels == 1, (up + 1) / (up + 2), 1 / (down + 2))
    theta = np.array([1.0, 0.0])
    inputs = np.stack([logits, np.ones_like(logits)], axis=1)
    for _ in range(50):
        chance = 1 / (1 + np.exp(-np.clip(inputs @ theta, -30, 30)))
        slope = inputs.T @ (weights * (chance - target)) + 1e-3 * theta
        curve = (inputs * (weights * chance * (1 - chance))[:, None]).T @ inputs + 1e-3 * np.eye(2)
        theta = theta - np.clip(np.linalg.solve(curve, slope), -1, 1)
    return (float(theta[0]), float(theta[1])) if theta[0] > 0 else (1.0, 0.0)


def training_sample(
    docs: DataFrame, labels: DataFrame, learn: Column, most_toxic: int, most_clean: int, most_words: int
) -> tuple[list[tuple[str, int]], float]:
    """(text, label) of at most so many documents, chosen by a hash of the key, and the toxic share of all labels."""
    known = labels.where(learn).where("toxic is not null").select("doc_id", F.col("toxic").cast("int").alias("toxic"))
    share = known.agg(F.avg("toxic")).first()[0] or 0.0
    drawn = F.xxhash64(F.col("doc_id"), F.lit("sample"))
    some = [
        known.where(F.col("toxic") == kind).orderBy(drawn, "doc_id").limit(most)
        for kind, most in ((1, most_toxic), (0, most_clean))
    ]
    # at most most_toxic + most_clean rows of two numbers
    texts = docs.join(F.broadcast(some[0].union(some[1])), "doc_id").where(F.size(F.split("text", r"\s+")) <= most_words)
    rows = texts.select("doc_id", "text", "toxic").collect()
    return [(r.text, r.toxic) for r in sorted(rows, key=lambda r: (r.doc_id, r.text))], float(share)


def train(
    docs: DataFrame,
    labels: DataFrame,
    learn: Column,
    most_toxic: int = MOST_TOXIC,
    most_clean: int = MOST_CLEAN,
    most_words: int = MOST_WORDS,
    epochs: int = EPOCHS,
) -> tuple[Parameters, dict[str, int], float, float]:
    """Network, numbers of words with their own vector, and slope and offset of the final logit."""
    sample, share = training_sample(docs, labels, learn, most_toxic, most_clean, most_words)
    marks = np.array([label for _, label in sample], dtype=np.float32)
    if len(set(marks.tolist())) < 2:
        chance = min(max(share, 1e-6), 1 - 1e-6)
        return start(1), {}, 0.0, float(np.log(chance / (1 - chance)))
    trainer = Trainer([words_of(text) for text, _ in sample], marks)
    trainer.fit(epochs)
    score = scorer(trainer.p, trainer.own, 1.0, 0.0)
    chances = np.clip(np.concatenate([score([t for t, _ in sample[n : n + 256]]) for n in range(0, len(sample), 256)]), 1e-9, 1 - 1e-9)
    toxic = marks.mean()
    weights = np.where(marks == 1, share / toxic, (1 - share) / (1 - toxic))
    scale, shift = calibrate(np.log(chances / (1 - chances)), marks, weights)
    return trainer.p, trainer.own, scale, shift


def score_documents(
    docs: DataFrame, model: tuple[Parameters, dict[str, int], float, float], rows: int = 512
) -> DataFrame:
    """doc_id, score of `docs` (`doc_id`, `text`), `rows` texts at a time."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    schema = StructType([docs.schema["doc_id"], StructField("score", DoubleType())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        arrow, score = to_arrow_schema(schema), scorer(*shared.value)
        for batch in batches:
            for first in range(0, batch.num_rows, rows):
                part = batch.slice(first, rows)
                scores = pa.array(score(part.column("text").to_pylist()), pa.float64())
                yield pa.RecordBatch.from_arrays([part.column("doc_id").cast(arrow[0].type), scores], schema=arrow)

    return docs.select("doc_id", "text").mapInArrow(run, schema)


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = narrow(table(spark, sf_dir, "documents"))
    labels = table(spark, sf_dir, "labels")
    model = train(docs, labels, trains(F.col("doc_id"), FOLDS))
    return score_documents(docs, model).select(
        "doc_id",
        held_out(F.col("doc_id"), FOLDS).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )

"""Language identification by a bidirectional gated recurrent network over bytes.

The network reads a text's bytes, lower-cased, in both directions, its state running on across words,
labels every position with probabilities of the languages, and a document's probabilities are the mean
over all positions of its whole text. Texts of more than STEPS bytes are read in pieces of so many that
begin and end RUN_IN bytes early and late; the bytes of that run-in set the state and are not counted, so
each position has at least so much of its surroundings before it is labelled. Pieces of many texts are
read at once; a batch holds at most GROUP pieces, whatever the texts' number and length.

It is trained in numpy by backpropagation through time with Adam, on pieces of STEPS_TRAINED bytes: at
most PIECES, evenly spaced, of each of at most DOCS labelled documents of each language (those with the
least hash of id and text), and of at most SAMPLE documents in all, dealt evenly over the languages: the
bound on what is gathered. Batches draw languages evenly. The seed is fixed.

Defined cases: null texts and texts without a letter (Unicode category L) are `und` with score 0, as is
every text if nothing can be learned; rows without a language are not learned from; rows that repeat id
and text are learned from once; ties go to the first name; repeated rows get equal results (scores have
five decimals); an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from palaver.llm.common import id_remainder, stored, table
from palaver.shipping import ship

UNKNOWN = "und"
HIDDEN = 14
STEPS = 256
RUN_IN = 16
GROUP = 4096
DOCS = 300
SAMPLE = 60_000
PIECES = 8
STEPS_TRAINED = 64
DEALS = 256
ROUNDS = 400
BATCH = 96


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-x))


def has_letter(text: str) -> bool:
    return any(map(str.isalpha, text))


def pieces_of(data: bytes) -> list[tuple[bytes, int, int]]:
    """Pieces with their run-in, and from where to where in each its positions count."""
    if len(data) <= STEPS + RUN_IN:
        return [(data, 0, len(data))] if data else []
    out = []
    for at in range(0, len(data), STEPS):
        begin = max(at - RUN_IN, 0)
        out.append((data[begin : at + STEPS + RUN_IN], at - begin, min(at + STEPS, len(data)) - begin))
    return out


def padded(pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Byte numbers (positions x pieces) and which of them are there."""
    lengths = np.array([len(p) for p in pieces])
    ids = np.zeros((len(pieces), max(int(lengths.max()), 1)), np.int64)
    inside = np.arange(ids.shape[1]) < lengths[:, None]
    ids[inside] = np.frombuffer(b"".join(pieces), np.uint8)
    return np.ascontiguousarray(ids.T), np.ascontiguousarray(inside.T)


class Network:
    """Weights: for each direction the bytes' inputs to the gates (256 x 3H), the recurrent ones, a bias; then the output layer."""

    def __init__(self, classes: int, hidden: int = HIDDEN, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.h = hidden
        self.p = {}
        for d in "fb":
            self.p[d + "x"] = rng.normal(0, 0.3, (256, 3 * hidden)).astype(np.float32)
            self.p[d + "u"] = rng.normal(0, hidden**-0.5, (hidden, 3 * hidden)).astype(np.float32)
            self.p[d + "c"] = np.zeros(3 * hidden, np.float32)
        self.p["o"] = rng.normal(0, 0.1, (2 * hidden, classes)).astype(np.float32)
        self.p["ob"] = np.zeros(classes, np.float32)

    def _forward(self, d: str, ids: np.ndarray, inside: np.ndarray, trace: list | None = None) -> np.ndarray:
        """States of one direction, after each position (positions x pieces x H); behind a piece's end the state is zero
        for the one that comes from there, and not read for the other."""
        steps, n = ids.shape
        u, gates, H = self.p[d + "u"], self.p[d + "x"] + self.p[d + "c"], self.h
        both, last = np.ascontiguousarray(u[:, : 2 * H]), np.ascontiguousarray(u[:, 2 * H :])
        h, out = np.zeros((n, H), u.dtype), np.empty((steps, n, H), u.dtype)
        whole = inside.all(axis=1)
        for t in range(steps) if d == "f" else range(steps - 1, -1, -1):
            x = gates.take(ids[t], axis=0)
            zr = h @ both
            zr += x[:, : 2 * H]
            zr = sigmoid(zr)
            z, r = zr[:, :H], zr[:, H:]
            s = (r * h) @ last
            s += x[:, 2 * H :]
            np.tanh(s, out=s)
            new = h + z * (s - h)
            if d == "b" and not whole[t]:
                new *= inside[t][:, None]
            if trace is not None:
                trace.append((t, h, z, r, s))
            h = out[t] = new
        return out

    def _output(self, ids: np.ndarray, inside: np.ndarray, traces: dict | None = None) -> tuple[np.ndarray, np.ndarray]:
        states = np.concatenate([self._forward(d, ids, inside, traces[d] if traces else None) for d in "fb"], axis=2)
        e = states @ self.p["o"] + self.p["ob"]
        e -= e.max(axis=2, keepdims=True)
        np.exp(e, out=e)
        e /= e.sum(axis=2, keepdims=True)
        return states, e

    def labels(self, ids: np.ndarray, inside: np.ndarray) -> np.ndarray:
        """Probabilities of the classes at each position (positions x pieces x classes)."""
        return self._output(ids, inside)[1]

    def gradients(self, ids: np.ndarray, inside: np.ndarray, target: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Mean cross-entropy over positions, and its gradient by backpropagation through time."""
        H, traces = self.h, {"f": [], "b": []}
        states, prob = self._output(ids, inside, traces)
        count, rows = inside.sum(), np.arange(ids.shape[1])
        loss = -(np.log(prob[:, rows, target] + 1e-9) * inside).sum() / count
        delta = prob.copy()
        delta[:, rows, target] -= 1
        delta *= inside[:, :, None] / count
        g = {k: np.zeros_like(v) for k, v in self.p.items()}
        g["o"] = states.reshape(-1, 2 * H).T @ delta.reshape(-1, delta.shape[2])
        g["ob"] = delta.sum(axis=(0, 1))
        into = (delta @ self.p["o"].T).astype(self.p["o"].dtype)
        for d, at in (("f", 0), ("b", H)):
            u, back = self.p[d + "u"], np.zeros((ids.shape[1], H), self.p["o"].dtype)
            whole = np.empty((*ids.shape, 3 * H), u.dtype)
            for t, h, z, r, s in reversed(traces[d]):
                dh = into[t, :, at : at + H] + back
                if d == "b":
                    dh = dh * inside[t][:, None]
                ds = dh * z * (1 - s * s)
                drh = ds @ u[:, 2 * H :].T
                dzr = np.concatenate([dh * (s - h) * z * (1 - z), drh * h * r * (1 - r)], axis=1)
                back = dh * (1 - z) + drh * r + dzr @ u[:, : 2 * H].T
                g[d + "u"][:, : 2 * H] += h.T @ dzr
                g[d + "u"][:, 2 * H :] += (r * h).T @ ds
                whole[t, :, : 2 * H], whole[t, :, 2 * H :] = dzr, ds
            flat, byte = whole.reshape(-1, 3 * H), ids.ravel()
            g[d + "x"] = np.stack([np.bincount(byte, flat[:, k], 256) for k in range(3 * H)], axis=1).astype(u.dtype)
            g[d + "c"] = flat.sum(axis=0)
        return float(loss), g

    def fit(self, pieces: list[bytes], target: np.ndarray, rounds: int = ROUNDS, rate: float = 0.01, seed: int = 11) -> None:
        """Adam over batches that hold the classes evenly."""
        rng = np.random.default_rng(seed)
        by_class = [np.flatnonzero(target == c) for c in np.unique(target)]
        mean, square = ({k: np.zeros_like(v) for k, v in self.p.items()} for _ in range(2))
        for i in range(1, rounds + 1):
            pick = np.concatenate([rng.choice(own, -(-BATCH // len(by_class))) for own in by_class])
            ids, inside = padded([pieces[j] for j in pick])
            _, g = self.gradients(ids, inside, target[pick])
            step = rate * min(1.0, 2 * (1 - i / (rounds + 1)))
            for k, v in g.items():
                mean[k] = 0.9 * mean[k] + 0.1 * v
                square[k] = 0.99 * square[k] + 0.01 * v * v
                self.p[k] -= (step * (mean[k] / (1 - 0.9**i)) / (np.sqrt(square[k] / (1 - 0.99**i)) + 1e-8)).astype(np.float32)


def piece_sums(net: Network, pieces: list[tuple[bytes, int, int]]) -> np.ndarray:
    """For each piece the sum of its counted positions' probabilities."""
    order = sorted(range(len(pieces)), key=lambda i: len(pieces[i][0]))
    out = np.zeros((len(pieces), len(net.p["ob"])), np.float64)
    for at in range(0, len(order), 1024):
        own = order[at : at + 1024]
        ids, inside = padded([pieces[i][0] for i in own])
        begin, end = (np.array([pieces[i][k] for i in own]) for k in (1, 2))
        place = np.arange(len(ids))[:, None]
        counts = ((place >= begin) & (place < end)).astype(np.float32)
        out[own] = np.einsum("tnc,tn->nc", net.labels(ids, inside), counts)
    return out


def pooled(net: Network, texts: Iterable[str | None], n: int) -> np.ndarray:
    """Mean probabilities over the positions of each of n texts; zeros where there is none."""
    whole, lengths = np.zeros((n, len(net.p["ob"]))), np.ones(n)
    group: list[tuple[bytes, int, int]] = []
    owner: list[int] = []

    def flush():
        if group:
            np.add.at(whole, owner, piece_sums(net, group))
            group.clear()
            owner.clear()

    for i, text in enumerate(texts):
        data = (text or "").lower().encode("utf-8", "surrogatepass")
        lengths[i] = max(len(data), 1)
        for piece in pieces_of(data):
            group.append(piece)
            owner.append(i)
            if len(group) >= GROUP:
                flush()
    flush()
    return whole / lengths[:, None]


def train(df: DataFrame, mod: int = 5, held: int = 0, docs: int = DOCS, rounds: int = ROUNDS, sample: int = SAMPLE) -> tuple[list[str], Network | None]:
    """Languages, in order, and the network; None if there is nothing to learn from."""
    ship(df.sparkSession)
    known = df.where(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}") & (id_remainder(F.col("doc_id"), mod) != held))
    known = known.select("doc_id", F.xxhash64("text").alias("d"), "lang", "text")
    order = [F.xxhash64("doc_id", "d"), "doc_id"]
    # Narrow rows only: each task keeps `docs` of a language, then each of DEALS groups of tasks, then the language.
    chosen = known.select("doc_id", "d", "lang").withColumn("deal", F.spark_partition_id() % DEALS)
    for key in (["lang", "deal"], ["lang"]):
        chosen = chosen.withColumn("n", F.row_number().over(Window.partitionBy(*key).orderBy(*order))).where(F.col("n") <= docs)
    chosen = stored(chosen.orderBy("n", "lang").limit(sample).select("doc_id", "d", "lang").distinct())
    key = ["doc_id", "d", "lang"]

    def gather(batches):
        for batch in batches:
            langs, cuts = [], []
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                data = text.lower().encode("utf-8", "surrogatepass")
                room = max(len(data) - STEPS_TRAINED, 0)
                places = sorted({i * room // (PIECES - 1) for i in range(PIECES)}) if room else [0]
                langs += [lang] * len(places)
                cuts += [data[at : at + STEPS_TRAINED] for at in places]
            yield pa.RecordBatch.from_arrays([pa.array(langs, pa.string()), pa.array(cuts, pa.binary())], ["lang", "piece"])

    once = known.join(F.broadcast(chosen), key).groupBy(*key).agg(F.first("text").alias("text"))  # equal hashes of equal ids: one text
    rows = once.select("lang", "text").mapInArrow(gather, "lang string, piece binary").collect()  # at most sample * PIECES
    pairs = sorted((r[0], bytes(r[1])) for r in rows)
    if not pairs:
        return [], None
    names = sorted({lang for lang, _ in pairs})
    net = Network(len(names))
    net.fit([p for _, p in pairs], np.array([names.index(lang) for lang, _ in pairs]), rounds)
    return names, net


def predicted(df: DataFrame, names: list[str], net: Network | None, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Columns `keep`, lang_pred and score (the document's probability of it)."""
    ship(df.sparkSession)
    model = df.sparkSession.sparkContext.broadcast((names, net))
    schema = T.StructType([df.schema[c] for c in keep] + [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])

    def run(batches):
        names, net = model.value
        for batch in batches:
            known: list[bool] = []

            def texts(column=batch.column(len(keep)), known=known):
                for t in column:
                    text = t.as_py()
                    known.append(bool(text) and has_letter(text))
                    yield text if known[-1] else None

            if net is None:
                known, prob = [False] * batch.num_rows, np.zeros((batch.num_rows, 1))
            else:
                prob = pooled(net, texts(), batch.num_rows).round(5)
            best = prob.argmax(axis=1)
            pred = [names[b] if k else UNKNOWN for b, k in zip(best, known, strict=True)]
            score = [float(min(p[b], 1.0)) if k else 0.0 for p, b, k in zip(prob, best, known, strict=True)]
            yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in range(len(keep))), pa.array(pred, pa.string()), pa.array(score, pa.float64())], schema.fieldNames())

    return df.select(*keep, text).mapInArrow(run, schema)


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    out = predicted(docs, *train(docs))
    return out.select("doc_id", (id_remainder(F.col("doc_id"), 5) == 0).alias("held_out"), "lang_pred", "score")

"""Toxicity scores of texts whose disguises are undone first.

The noisy channel: a writer disguises a word by look-alike signs (1d10t), by marks or blanks between its
letters (i.d.i.o.t, i d i o t) or by repeating letters (idiooot). A token with such signs becomes a
lattice, at each place the letters that may stand behind the sign, with the channel's cost; the Viterbi
path under a character language model (trigrams, trained on the words of the labelled texts) is the restored word.
Where marks or blanks stand between letters, the parts between them are read as well, and every word
with counts that stands anywhere in the restored letters (of four letters or more, unless all letters
are spaced out). Tokens are decoded whole, whatever their length.
Tokens without such signs have one path, themselves. Tokens are then scored, as written and restored,
by features of words (the word, and its beginnings of four to seven letters): how often texts that
contain the feature are labelled toxic, shrunk towards zero by SHRINK texts. A logistic regression over
the text's three strongest tokens and its length makes the score; it is fitted on the same texts, each
text's own label taken out of the counts of its features.

Trained on all labelled documents that are not held out: counts are summed over all of them, and each step
of Newton's method sums over all of them. Labels, language, source and id are not features. All features that
are toxic often enough, and all letter trigrams, make the model, which is broadcast; it grows with the
vocabulary of the toxic texts. Up to IN_HAND texts the driver makes the steps, beyond that the executors do,
with sums in whole numbers, which no order of the rows changes.

Defined cases: null and empty texts have no feature and score as such; a document with several labels is toxic
if one says so; null labels are ignored; of rows that share an id one text, that of the least hash, is learned
from; of equally good restorations the greatest string counts; without labels all scores are 0; repeated rows
score alike; an empty table gives an empty result; other columns, of either table, are not read.
"""

from __future__ import annotations

import heapq
import math
import re
from collections import Counter
from collections.abc import Callable
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from palaver.llm.common import id_remainder, join_sized, small_enough, stored, table
from palaver.shipping import ship

#: Labelled texts up to which the regression's rows (a few numbers each) go to the driver.
IN_HAND = 20_000
#: Labels that may be broadcast.
NARROW_ROWS = 500_000
#: Fixed value: units of a whole number in the sums of the regression.
UNITS = 1 << 30
SHRINK = 3
LEAST_TOXIC, LEAST_SHARE = 3, 0.4
THRESHOLD = 0.7
BEGINNINGS = range(4, 8)
#: Signs and the letters that they stand for.
LOOKALIKES = {"0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "€": "e", "£": "l", "(": "c", "%": "x"}
BETWEEN = ".-_*~'"
SPACED = re.compile(r"(?<![^\W_])[^\W_](?:[ .\-_*~][^\W_]){2,}(?![^\W_])")
RUN = re.compile(r"([^\W\d_])\1\1")
EDGE = re.compile(r"^[\W_]+|[\W_]+$")
INNER = re.compile(r"[^\W\d_][\d@$!|+€£(%.\-_*~]|[\d@$!|+€£(%.\-_*~][^\W\d_]")
MARK = re.compile(r"[ .\-_*~']")
SIGN_COST, MARK_COST, RUN_COST, KEEP_COST = -1.0, -0.5, -0.7, -6.0
MEMO = 300_000


class Channel:
    """A character trigram model and the decoder over it."""

    def __init__(self, trigrams: dict[str, int]):
        self.tri = trigrams
        self.bi: Counter = Counter()
        for t, n in trigrams.items():
            self.bi[t[:2]] += n
        self.alphabet = max(len({c for t in trigrams for c in t}), 30)

    def log_p(self, before: str, letter: str) -> float:
        return math.log((self.tri.get(before + letter, 0) + 0.05) / (self.bi.get(before, 0) + 0.05 * self.alphabet))

    def lattice(self, token: str) -> list[list[tuple[str, float]]]:
        """For each place of the token what may stand behind it, with its log cost."""
        out, i = [], 0
        while i < len(token):
            c, j = token[i], i
            while j < len(token) and token[j] == c:
                j += 1
            letters = c if c.isalpha() else LOOKALIKES.get(c, "")
            options = [(x, 0.0 if c.isalpha() else SIGN_COST) for x in letters]
            if j - i >= 3:
                options += [(x + x, cost + RUN_COST) for x, cost in options]
                i = j
            else:
                i += 1
            if c in BETWEEN or c == " ":
                options.append(("", MARK_COST))
            elif not c.isalpha():
                options.append((c, KEEP_COST))
            out.append(options)
        return out

    def decode(self, token: str) -> str:
        """The best path: the restored word."""
        # A path is kept as its last emission and the path before it, so that time is linear in the length.
        beam: dict[str, tuple[float, tuple | None]] = {"^^": (0.0, None)}
        for options in self.lattice(token):
            then: dict[str, tuple[float, tuple | None]] = {}
            for state, (score, path) in beam.items():
                for emit, cost in options:
                    s, now = state, score + cost
                    for letter in emit:
                        now += self.log_p(s, letter)
                        s = s[1] + letter
                    if s not in then or now > then[s][0]:
                        then[s] = (now, (path, emit) if emit else path)
            beam = then
        ends = {state: score + self.log_p(state, "$") for state, (score, _) in beam.items()}
        top = max(ends.values())
        return max(_written(beam[state][1]) for state, score in ends.items() if score == top)


def _written(path: tuple | None) -> str:
    out = []
    while path:
        path, emit = path
        out.append(emit)
    return "".join(reversed(out))


def disguised(token: str) -> bool:
    return bool(INNER.search(token) or RUN.search(token))


def features(word: str) -> list[str]:
    return ["=" + word, *(word[:k] for k in BEGINNINGS if len(word) >= k)] if word.isalpha() else []


def tokens(text: str) -> set[str]:
    """Different tokens of a text, lower-cased, and those made of its spaced-out letters."""
    low = text.lower()
    return {*low.split(), *(m[0] for m in SPACED.finditer(low))}


class Model:
    """counts: feature -> (toxic, clean) texts; coefficients: of `described`'s values, empty before the fit."""

    def __init__(self, counts: dict[str, tuple[int, int]], trigrams: dict[str, int], coefficients: tuple[float, ...] = ()):
        self.counts, self.channel, self.coefficients = counts, Channel(trigrams), coefficients
        self.longest = max((len(f) - 1 for f in counts if f[0] == "="), default=0)
        self.memo: dict[str, tuple[tuple[int, int], ...]] = {}

    def restored(self, token: str) -> list[str]:
        """The readings of a token: as written and, if it is disguised, undone."""
        bare = EDGE.sub("", token)
        inner = token.strip("\"'.,;:?") if not bare.isalpha() else bare
        out = [bare]
        if bare and (SPACED.fullmatch(inner) or disguised(inner)):
            for x in dict.fromkeys((inner, bare)):
                out += [self.channel.decode(x)] if x else []
            if MARK.search(inner):
                out += [self.channel.decode(x) for x in MARK.split(inner) if len(x) > 1]
                out += self.inside(out[1], 1 if SPACED.fullmatch(inner) else BEGINNINGS[0])
        return out

    def inside(self, letters: str, least: int) -> list[str]:
        """The words with counts of their own that stand at any place of the letters."""
        ends = range(least, self.longest + 1)
        return [letters[i : i + k] for i in range(len(letters)) for k in ends if i + k <= len(letters) and "=" + letters[i : i + k] in self.counts]

    def known(self, token: str) -> tuple[tuple[int, int], ...]:
        """The counts of the token's features."""
        if token not in self.memo:
            if len(self.memo) >= MEMO:
                self.memo.clear()
            self.memo[token] = tuple({self.counts[f] for word in self.restored(token) for f in features(word) if f in self.counts})
        return self.memo[token]

    def weight(self, token: str, label: int | None = None) -> float:
        """The share of toxic texts of the token's strongest feature; label: of the text that is to be left out."""
        t_out, out = (0, 0) if label is None else (label, 1)
        return max((max(0.0, (t - t_out) / (t + c - out + SHRINK)) for t, c in self.known(token)), default=0.0)

    def described(self, text: str | None, label: int | None = None) -> tuple[float, ...]:
        own = tokens(text or "")
        a, b, c = (heapq.nlargest(3, (self.weight(t, label) for t in own)) + [0.0] * 3)[:3]
        return (1.0, a, b, c, a * b, b * c, math.log1p(len(own)) / 5, -math.log1p(-a), -math.log1p(-a) - math.log1p(-b))

    def score(self, text: str | None) -> float:
        if not self.coefficients:
            return 0.0
        return 1 / (1 + math.exp(-max(-50.0, min(50.0, sum(x * w for x, w in zip(self.described(text), self.coefficients, strict=True))))))


def newton(sums: Callable[[np.ndarray], tuple[np.ndarray, np.ndarray]], width: int, ridge: float = 0.1) -> tuple[float, ...]:
    """Coefficients by Newton's method; sums: curvature and slope of the likelihood over all rows at given coefficients."""
    w = np.zeros(width)
    for _ in range(30):
        curvature, slope = sums(w)
        step = np.linalg.solve(curvature + ridge * np.eye(width), slope - ridge * w)
        w += step
        if np.abs(step).max() < 1e-6:
            break
    return tuple(map(float, w))


def logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, ...]:
    """Coefficients from rows in hand."""

    def sums(w):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        return (x * (p * (1 - p))[:, None]).T @ x, x.T @ (y - p)

    return newton(sums, x.shape[1])


def logistic_over(rows: DataFrame, names: list[str]) -> tuple[float, ...]:
    """Coefficients from a table of columns `names`, y and n (how many such rows); no row leaves the executors."""
    ship(rows.sparkSession)
    width = len(names)
    upper = [(i, j) for i in range(width) for j in range(i, width)]
    parts = [f"s{k}" for k in range(len(upper) + width)]

    def sums(w):
        def run(batches):
            for batch in batches:
                if not batch.num_rows:
                    continue
                x = [batch.column(k).to_numpy() for k in range(width)]
                y, n = batch.column(width).to_numpy(), batch.column(width + 1).to_numpy()
                # Column by column, so that a row's numbers do not depend on the batch that it is in.
                z = np.zeros(batch.num_rows)
                for k in range(width):
                    z += x[k] * w[k]
                p = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
                both, out = p * (1 - p), []
                for terms in [*(both * (x[i] * x[j]) for i, j in upper), *(x[i] * (y - p) for i in range(width))]:
                    units = np.rint(terms * UNITS).astype(np.int64)
                    high, low = int(((units >> 20) * n).sum()), int(((units & 0xFFFFF) * n).sum())
                    out.append(pa.array([Decimal((high << 20) + low)], pa.decimal128(38, 0)))
                yield pa.RecordBatch.from_arrays(out, parts)

        totals = rows.mapInArrow(run, ", ".join(f"{c} decimal(38,0)" for c in parts)).agg(*[F.sum(c) for c in parts]).first()
        values = [int(t) / UNITS for t in totals]
        curvature = np.zeros((width, width))
        for (i, j), v in zip(upper, values):
            curvature[i, j] = curvature[j, i] = v
        return curvature, np.array(values[len(upper) :])

    return newton(sums, width)


def _count(batches):
    """Feature counts by label and letter trigrams of labelled texts, of each slice of a batch."""
    for batch in batches:
        for at in range(0, batch.num_rows, 2000):
            part = batch.slice(at, 2000)
            by_label: tuple[Counter, Counter] = (Counter(), Counter())
            words: Counter = Counter()
            made: dict[str, list[str]] = {}
            for text, label in zip(part.column(0), part.column(1).to_pylist(), strict=True):
                own = {EDGE.sub("", t) for t in set((text.as_py() or "").lower().split())}
                for w in own:
                    if w not in made:
                        made[w] = features(w)
                words.update(own)
                by_label[label].update({f for w in own for f in made[w]})
            tri: Counter = Counter()
            for w, n in words.items():
                if w.isalpha():
                    s = f"^^{w}$"
                    for i in range(len(s) - 2):
                        tri[s[i : i + 3]] += n
            clean, toxic = by_label
            found = list(clean.keys() | toxic.keys())
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([*found, *(f"\t{t}" for t in tri)], pa.string()),
                    pa.array([*(toxic[f] for f in found), *tri.values()], pa.int64()),
                    pa.array([clean[f] for f in found] + [0] * len(tri), pa.int64()),
                ],
                ["feature", "toxic", "clean"],
            )


def train(documents: DataFrame, labels: DataFrame, mod: int = 3, held: int = 1, sample: int | None = None) -> Model:
    """A model from all labelled documents whose id's remainder is not `held`; sample: from so many of them only."""
    ship(documents.sparkSession)
    known = labels.where(F.col("toxic").isNotNull() & (id_remainder(F.col("doc_id"), mod) != held)).groupBy("doc_id").agg(F.max(F.col("toxic").cast("int")).alias("label"))
    chosen = stored(known if sample is None else known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample))
    # One text of each id; they are stored once and read by all that follows.
    texts = documents.select("doc_id", "text").where(id_remainder(F.col("doc_id"), mod) != held)
    texts = join_sized(texts, chosen, "doc_id", "inner", NARROW_ROWS).groupBy("doc_id")
    texts = stored(texts.agg(F.min(F.struct(F.xxhash64("text").alias("d"), "text")).alias("t"), F.max("label").alias("label")).select("t.text", "label"))
    counts = stored(texts.mapInArrow(_count, "feature string, toxic long, clean long").groupBy("feature").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean")))
    share = F.col("toxic") / (F.col("toxic") + F.col("clean") + SHRINK)
    strong = counts.where(~F.col("feature").startswith("\t") & (F.col("toxic") >= LEAST_TOXIC) & (share >= LEAST_SHARE)).collect()
    tri = counts.where(F.col("feature").startswith("\t")).select(F.substring("feature", 2, 3).alias("t"), "toxic").collect()
    found, trigrams = {r[0]: (r[1], r[2]) for r in strong}, {r[0]: r[1] for r in tri}
    parts = documents.sparkSession.sparkContext.broadcast((found, trigrams))
    names = [f"x{i}" for i in range(len(Model({}, {}).described("")))]

    def describe(batches):
        own = Model(*parts.value)
        for batch in batches:
            rows = [(*own.described(t, y), float(y)) for t, y in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.float64()) for c in zip(*rows, strict=True)], [*names, "y"]) if rows else batch.slice(0, 0)

    rows = stored(texts.mapInArrow(describe, ", ".join(f"{n} double" for n in [*names, "y"])))
    if not small_enough(rows, IN_HAND):
        return Model(found, trigrams, logistic_over(stored(rows.groupBy(*names, "y").agg(F.count("*").alias("n"))), names))
    data = np.array(rows.collect())
    if not len(data):
        return Model({}, {})
    data = data[np.lexsort(data.T)]
    return Model(found, trigrams, logistic(data[:, :-1], data[:, -1]))


def scored(df: DataFrame, model: Model, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Columns `keep`, score and predicted."""
    ship(df.sparkSession)
    parts = df.sparkSession.sparkContext.broadcast((model.counts, model.channel.tri, model.coefficients))
    schema = T.StructType([df.schema[c] for c in keep] + [T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())])

    def run(batches):
        own = Model(*parts.value)
        for batch in batches:
            column = batch.column(len(keep))
            scores = [own.score(column[i].as_py()) for i in range(batch.num_rows)]
            yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in range(len(keep))), pa.array(scores, pa.float64()), pa.array([int(s >= THRESHOLD) for s in scores], pa.int32())], schema.fieldNames())

    return df.select(*keep, text).mapInArrow(run, schema)


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    out = scored(docs, train(docs, table(spark, sf_dir, "labels")))
    return out.select("doc_id", (id_remainder(F.col("doc_id"), 3) == 1).alias("held_out"), "score", "predicted")

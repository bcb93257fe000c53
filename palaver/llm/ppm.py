"""Language-model scores by prediction by partial matching over bytes.

A text is read as its words, A-Z lower-cased, with one blank between them and one line end after them.
The byte-context trie of order ORDER is trained on the documents that are not held out, and held as
counts of (context, next byte) over the whole corpus, dealt over the cluster. The probability of a byte:
the longest context that was seen gives count / (sum + distinct) to a byte that it has, else the escape,
distinct / (sum + distinct), and the next shorter context goes on; bytes that a longer context offered
are excluded from its sums. Below order 0 the bytes never seen share the rest equally.

Texts are dealt over blocks. Each block lists the contexts and words that occur in it; their counts are
summed over the corpus, and only the log probabilities that a block lists are sent back to it. So neither
texts nor the trie are ever in one place, and what moves is the blocks' distinct contexts, not their bytes.

The probabilities are made order by order, from 0 up, in tables of (context and byte of that order). A row
needs the sums over its context, which has 256 rows at most, and the row of the byte in the next shorter
context; rows are dealt by that context, of which 65,536 rows at most meet. So no key grows with the
corpus, and Spark's sorts, which can spill, hold what is in hand. Orders 0 and 1 have 65,536 rows at most
and are broadcast to the next.

The base score takes words as they are, by counts with one added. Words are known by 63 bits of a hash; two
of a billion different words share one with a probability of one in twenty.

Defined cases: a null or empty text is a line end alone (one token); without training documents every
byte has probability 1/256 and base scores are zero; long texts are read whole, in groups of CHUNK bytes;
repeated rows each count, come to one block and get the same scores; a null doc_id is not held out; an
empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from palaver.llm.common import drop_stored, id_remainder, n_blocks, stored, table
from palaver.shipping import ship

ORDER = 5
START = b"\n" * ORDER
END_WORD = b""
CHUNK = 1 << 20
#: A gram's key is below TOTAL, a word's is negative; the corpus's sums stand at the two keys from TOTAL on.
TOTAL = 1 << 60
COUNTS = "key long, block int, n long"
ALL_KEYS = "spark.sql.requireAllClusterKeysForCoPartition"


def word_keys(words: list[bytes]) -> np.ndarray:
    """63 bits of each word's hash under the sign bit."""
    h = np.array(list(map(xxhash.xxh64_intdigest, words)), np.uint64)
    return ((h >> np.uint64(1)) | np.uint64(1 << 63)).view(np.int64)


def grams(data: bytes) -> np.ndarray:
    """For every byte after the first ORDER: it and the ORDER bytes before it, as one number, oldest highest."""
    x = np.frombuffer(data, np.uint8).astype(np.int64)
    n = len(x) - ORDER
    key = x[:n].copy()
    for i in range(1, ORDER + 1):
        key <<= 8
        key |= x[i : i + n]
    return key


def _chunks(texts):
    """Groups of (row, coded bytes) of about CHUNK bytes."""
    group, size = [], 0
    for i, coded in texts:
        group.append((i, coded))
        size += len(coded)
        if size >= CHUNK:
            yield group
            group, size = [], 0
    if group:
        yield group


def _coded(texts: pa.ChunkedArray):
    for i, t in enumerate(texts):
        words = (t.as_py() or "").encode("utf-8", "surrogatepass").lower().split()
        yield i, words


def _inside(group) -> tuple[np.ndarray, np.ndarray]:
    """Grams of a group's texts, without those that reach over a text's end, and where each text's begin."""
    data = b"".join(START + coded for _, coded in group)
    lengths = np.array([len(coded) for _, coded in group])
    key = grams(data)
    begins = np.concatenate(([0], np.cumsum(lengths + ORDER)[:-1]))
    at = np.cumsum(lengths) - lengths
    return key[np.repeat(begins - at, lengths) + np.arange(lengths.sum())], at


def _add(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    if not parts:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    key, n = (np.concatenate(x) for x in zip(*parts, strict=True))
    order = np.argsort(key)
    key, n = key[order], n[order]
    first = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
    return key[first], np.add.reduceat(n, first)


def block_counts(docs: pa.Table) -> pa.Table:
    """Contexts and words of a block with their counts in its training documents (0: only in held-out ones)."""
    train = docs.column("__train").to_numpy()
    seen: dict[bool, list[np.ndarray]] = {True: [], False: []}
    lines = 0

    def coded():
        for i, ws in _coded(docs.column("__text")):
            seen[bool(train[i])].append(word_keys(ws))
            yield i, b" ".join(ws) + b"\n"

    parts, words = [], []
    for group in _chunks(coded()):
        for learn in (True, False):
            own = [g for g in group if bool(train[g[0]]) == learn]
            lines += len(own) * learn
            for into, keys in ((parts, _inside(own)[0] if own else None), (words, np.concatenate(seen[learn]) if seen[learn] else None)):
                if keys is not None:
                    key, n = np.unique(keys, return_counts=True)
                    into.append((key, n if learn else np.zeros(len(n), np.int64)))
            seen[learn].clear()
        if len(parts) > 8:
            parts, words = [_add(parts)], [_add(words)]
    words.append((word_keys([END_WORD]), np.array([lines])))
    (key, n), (word, times) = _add(parts), _add(words)
    keys, counts = np.concatenate((key, word, [TOTAL, TOTAL + 1])), np.concatenate((n, times, [0, 0]))
    return pa.table({"key": keys, "block": np.full(len(keys), docs.column("block")[0].as_py(), np.int32), "n": counts})


def log_probabilities(grams_: DataFrame, parts: int) -> DataFrame:
    """key, value: log10 of the probability of each gram's last byte, from counts c of the grams (key) of order ORDER.

    Row of order k, by key (k bytes of context and the byte): c, its count; n and q, sum and number of bytes
    seen in the context; e, the log probability that orders below k give the byte when the bytes seen in the
    context are excluded.
    """
    counts = {ORDER: grams_.select("key", "c")}
    for k in range(ORDER - 1, -1, -1):
        low = counts[k + 1].groupBy(F.col("key").bitwiseAND((1 << 8 * (k + 1)) - 1).alias("key")).agg(F.sum("c").alias("c"))
        counts[k] = stored(low)
    made = [counts[k] for k in range(ORDER)]
    every = Window.partitionBy(F.lit(0))  # 256 rows at most
    seen = (F.col("c") > 0).cast("long")
    now = counts[0].withColumns({"n": F.sum("c").over(every), "q": F.sum(seen).over(every)})
    now = now.withColumn("e", -F.log10(F.greatest(F.lit(256) - F.col("q"), F.lit(1))))
    spark = grams_.sparkSession
    before = spark.conf.get(ALL_KEYS)
    spark.conf.set(ALL_KEYS, "false")  # rows dealt by the shorter context serve the join and the window
    try:
        for k in range(1, ORDER + 1):
            tail, middle = F.col("key").bitwiseAND(0xFF), F.shiftright("key", 8).bitwiseAND((1 << 8 * (k - 1)) - 1)
            rows = counts[k].select("key", "c", middle.alias("middle"), tail.alias("s"), F.shiftright("key", 8 * k).alias("first"))
            under = now.select(F.shiftright("key", 8).alias("middle"), F.col("key").bitwiseAND(0xFF).alias("s"), *[F.col(x).alias(f"{x}2") for x in "cnqe"])
            if k > 2:
                both = rows.repartition(parts, "middle").join(under, ["middle", "s"])
            else:
                both = rows.join(F.broadcast(under), ["middle", "s"])
            own = Window.partitionBy("middle", "first")
            sums = {"n": F.sum("c").over(own), "q": F.sum(seen).over(own), "x": F.sum(F.when(F.col("c") > 0, F.col("c2")).otherwise(0)).over(own)}
            left_n, left_q = F.col("n2") - F.col("x"), F.col("q2") - F.col("q")
            there = F.when(F.col("c2") > 0, F.log10(F.col("c2") / (left_n + left_q))).otherwise(F.log10(left_q / (left_n + left_q)) + F.col("e2"))
            now = both.withColumns(sums).select("key", "c", "n", "q", F.when((F.col("n2") > 0) & (left_q > 0), there).otherwise(F.col("e2")).alias("e"))
            if k < ORDER:
                now = stored(now)
                made.append(now)
        found = F.when(F.col("c") > 0, F.log10(F.col("c") / (F.col("n") + F.col("q"))))
        found = found.when(F.col("n") > 0, F.log10(F.col("q") / (F.col("n") + F.col("q"))) + F.col("e")).otherwise(F.col("e"))
        values = stored(now.select("key", found.alias("value")))
    finally:
        spark.conf.set(ALL_KEYS, before)
    for df in made:
        drop_stored(df)
    return values


def block_scores(keep: list[str]):
    def run(docs: pa.Table, model: pa.Table) -> pa.Table:
        key, value = (model.column(c).to_numpy() for c in ("key", "value"))
        own = lambda use: pd.Series(value[use], pd.Index(key[use]))
        gram, word, total = own((key >= 0) & (key < TOTAL)), own(key < 0), own(key >= TOTAL)
        n_all, v_all = (float(total.get(TOTAL + i, 0.0)) for i in (0, 1))
        score = np.zeros(docs.num_rows)
        base, known, tokens = (np.zeros(docs.num_rows, t) for t in (np.float64, np.int64, np.int64))
        logs, least = gram.to_numpy(), np.log10(1 / (n_all + v_all + 1))
        word_logs = np.log10((word.to_numpy() + 1) / (n_all + v_all + 1))

        def coded():
            for i, ws in _coded(docs.column("__text")):
                at = word.index.get_indexer(word_keys([*ws, END_WORD]))
                hit = at >= 0
                tokens[i], known[i] = len(at), hit.sum()
                base[i] = word_logs[at[hit]].sum() + least * (len(at) - known[i])
                yield i, b" ".join(ws) + b"\n"

        for group in _chunks(coded()):
            keys, at = _inside(group)
            score[[i for i, _ in group]] = np.add.reduceat(logs[gram.index.get_indexer(keys)], at)
        made = {k: docs.column(k) for k in keep}
        made["held_out"] = pa.array(~docs.column("__train").to_numpy(zero_copy_only=False).astype(bool))
        made["n_tokens"] = pa.array(tokens)
        made["n_known"] = pa.array(known)
        made["train_tokens"] = pa.array(np.full(docs.num_rows, int(n_all)), pa.int64())
        made["base_score"] = pa.array(base)
        made["score"] = pa.array(score)
        return pa.table(made)

    return lambda docs, model: run(docs, model) if docs.num_rows else pa.table({**{k: docs.column(k) for k in keep}, "held_out": pa.array([], pa.bool_()), **{k: pa.array([], pa.int64()) for k in ("n_tokens", "n_known", "train_tokens")}, **{k: pa.array([], pa.float64()) for k in ("base_score", "score")}})


def scores(df: DataFrame, mod: int = 7, held: int = 2, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Columns `keep`, held_out, n_tokens, n_known, train_tokens, base_score, score (log10)."""
    ship(df.sparkSession)
    blocks = n_blocks(df, "text")
    deal = max(blocks, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    text = F.coalesce(F.col("text"), F.lit(""))
    own = [F.col(c).alias(f"__keep_{i}") for i, c in enumerate(keep)]
    block = F.pmod(F.xxhash64("doc_id", F.xxhash64(text)), F.lit(blocks)).cast("int")
    docs = df.select(*own, text.alias("__text"), (id_remainder(F.col("doc_id"), mod) != held).alias("__train"), block.alias("block")).repartition(deal, "block")
    counts = stored(docs.groupBy("block").applyInArrow(block_counts, COUNTS))
    sums = stored(counts.groupBy("key").agg(F.sum("n").alias("c")))

    gram = sums.where((F.col("key") >= 0) & (F.col("key") < TOTAL))
    probabilities = log_probabilities(gram, deal)

    word = sums.where((F.col("key") < 0) & (F.col("c") > 0))
    totals = word.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("n"), F.count("*").alias("v"))
    total = totals.select(F.explode(F.array(*[F.struct(F.lit(TOTAL + i).alias("key"), F.col(c).cast("double").alias("value")) for i, c in enumerate(("n", "v"))])).alias("t")).select("t.*")
    words = stored(word.select("key", F.col("c").cast("double").alias("value")).unionByName(total))
    drop_stored(sums)
    values = probabilities.unionByName(words)
    model = counts.select("key", "block").join(values, "key").select("block", "key", "value")

    kept = [f"__keep_{i}" for i in range(len(keep))]
    fields = [T.StructField(c, df.schema[k].dataType) for c, k in zip(kept, keep, strict=True)]
    fields += [T.StructField("held_out", T.BooleanType())] + [T.StructField(c, T.LongType()) for c in ("n_tokens", "n_known", "train_tokens")] + [T.StructField(c, T.DoubleType()) for c in ("base_score", "score")]
    return docs.groupBy("block").cogroup(model.groupBy("block")).applyInArrow(block_scores(kept), T.StructType(fields)).withColumnsRenamed(dict(zip(kept, keep, strict=True)))


def op4_ppm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scores(table(spark, sf_dir, "documents"))

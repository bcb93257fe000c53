"""Byte-level BPE with the tiktoken library and a local rank file.

Long texts are cut first at places where the splitting pattern must begin a new match, so that the
pieces' ids, put together, are those of the whole text, and memory follows the piece, not the text.
Decoding joins the tokens' raw bytes; it never goes through text.

Defined cases: a null text counts as empty (no ids); an empty table gives an empty result; rows are
independent, so repeated rows and ties change nothing; other columns are ignored by `encode` unless
asked for by `keep`.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from palaver.shipping import ship

PIECE_CHARS = 1 << 16
#: White space runs from this length on go to the merge loop directly: the pattern engine would backtrack over them.
LONG_SPACE = 2048
#: After a letter or digit, before a blank, a mark or the other of the two, no match of the pattern goes on.
SAFE = regex.compile(r"(?<=[\p{L}\p{N}])(?=[ \n\p{P}])|(?<=\p{L})(?=\p{N})|(?<=\p{N})(?=\p{L})")
SPACES = regex.compile(r"\p{White_Space}{%d,}" % LONG_SPACE)
_made: dict[str, object] = {}


def read_ranks(path: str) -> bytes:
    with open(path, "rb") as f:
        return f.read()


def encoding(ranks: bytes, pattern: str):
    """The tiktoken encoding of a rank file's content; one per Python worker."""
    import tiktoken

    key = hashlib.sha256(ranks + pattern.encode()).hexdigest()
    if key not in _made:
        table = {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in ranks.splitlines() if line)}
        _made[key] = tiktoken.Encoding(f"ranks-{key[:8]}", pat_str=pattern, mergeable_ranks=table, special_tokens={})
    return _made[key]


def pieces(text: str, size: int = PIECE_CHARS) -> Iterator[str]:
    """The text in pieces of about `size` characters, cut at safe boundaries only."""
    at = 0
    while len(text) - at > size:
        cut = SAFE.search(text, at + size)
        if not cut:
            break
        yield text[at : cut.start()]
        at = cut.start()
    yield text[at:] if at else text


def piece_ids(enc, piece: str) -> Iterator[np.ndarray]:
    """Ids of one piece. A very long run of white space is one match (all but its last character when text
    follows), and so its bytes go to the merge loop as they are."""
    at = 0
    if len(piece) >= LONG_SPACE:
        for run in SPACES.finditer(piece):
            end = run.end() - (run.end() < len(piece))
            if run.start() > at:
                yield _ids(enc, piece[at : run.start()])
            yield np.asarray(enc._core_bpe.encode_single_piece(piece[run.start() : end].encode()), np.uint32)
            at = end
    if at < len(piece):
        yield _ids(enc, piece[at:])


def _ids(enc, text: str) -> np.ndarray:
    return np.asarray(enc.encode_to_numpy(text, disallowed_special=()), np.uint32)


def ids_of(enc, text: str) -> Iterator[np.ndarray]:
    for piece in pieces(text):
        yield from piece_ids(enc, piece)


def raw_decode(enc, ids: np.ndarray) -> bytes:
    """The tokens' bytes, joined."""
    return enc.decode_bytes(ids.tolist())


def encode(df: DataFrame, ranks_path: str, pattern: str, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Columns `keep`, then n_tokens, ids (array of int, as many as tokens)."""
    ship(df.sparkSession)
    ranks = df.sparkSession.sparkContext.broadcast(read_ranks(ranks_path))
    schema = T.StructType([df.schema[c] for c in keep] + [T.StructField("n_tokens", T.LongType()), T.StructField("ids", T.ArrayType(T.IntegerType(), False))])

    def run(batches):
        enc = encoding(ranks.value, pattern)
        for batch in batches:
            for i in range(batch.num_rows):  # one text at a time: a batch's ids may be far larger than its texts
                ids = np.concatenate([*ids_of(enc, batch.column(len(keep))[i].as_py() or ""), np.empty(0, np.uint32)])
                cols = [batch.column(k).slice(i, 1) for k in range(len(keep))]
                yield _batch([*cols, pa.array([ids.size], pa.int64()), pa.array([ids.astype(np.int32)], pa.list_(pa.int32()))], schema)

    return df.select(*keep, text).mapInArrow(run, schema)


def decode(df: DataFrame, ranks_path: str, pattern: str, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Columns `keep` and `bytes`: the raw bytes of the column `ids`, null as no ids."""
    ship(df.sparkSession)
    ranks = df.sparkSession.sparkContext.broadcast(read_ranks(ranks_path))
    schema = T.StructType([df.schema[c] for c in keep] + [T.StructField("bytes", T.BinaryType())])

    def run(batches):
        enc = encoding(ranks.value, pattern)
        for batch in batches:
            for i in range(batch.num_rows):
                data = enc.decode_bytes(batch.column(len(keep))[i].as_py() or [])
                yield _batch([*(batch.column(k).slice(i, 1) for k in range(len(keep))), pa.array([data], pa.binary())], schema)

    return df.select(*keep, "ids").mapInArrow(run, schema)


def round_trip(df: DataFrame, ranks_path: str, pattern: str, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Encode every text, decode the ids, and return `keep`, n_tokens, ids_sha256, decoded_sha256.

    Both digests are taken piece by piece, so that no more than one piece's ids are held at a time.
    """
    ship(df.sparkSession)
    ranks = df.sparkSession.sparkContext.broadcast(read_ranks(ranks_path))
    digests = [T.StructField("n_tokens", T.LongType()), T.StructField("ids_sha256", T.StringType()), T.StructField("decoded_sha256", T.StringType())]
    schema = T.StructType([df.schema[c] for c in keep] + digests)

    def run(batches):
        enc = encoding(ranks.value, pattern)
        for batch in batches:
            counts, coded, decoded = [], [], []
            column = batch.column(len(keep))
            for i in range(batch.num_rows):
                n, a, b = 0, hashlib.sha256(), hashlib.sha256()
                for ids in ids_of(enc, column[i].as_py() or ""):
                    n += ids.size
                    a.update(ids.astype("<u4", copy=False).tobytes())
                    b.update(raw_decode(enc, ids))
                counts.append(n)
                coded.append(a.hexdigest())
                decoded.append(b.hexdigest())
            yield _batch([*(batch.column(k) for k in range(len(keep))), pa.array(counts, pa.int64()), pa.array(coded, pa.string()), pa.array(decoded, pa.string())], schema)

    return df.select(*keep, text).mapInArrow(run, schema)


def _batch(columns: list[pa.Array], schema: T.StructType) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(columns, schema.fieldNames())

"""Token ids, masks and token types of texts by a tokenizer file: cut to a length and filled up to it."""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from palaver.shipping import ship

UTTERANCE_TOKENS, CONVERSATION_TOKENS = 128, 512


def loaded(path: str, length: int, pad: str | None = None, begin: str | None = None, end: str | None = None):
    """The tokenizer of a JSON file, set to `length` ids a text.

    begin and end are special tokens that stand around each text and count for the length; pad fills short
    texts up (default: `end`, or else the id 0).
    """
    from tokenizers import Tokenizer
    from tokenizers.processors import TemplateProcessing

    t = Tokenizer.from_file(path)
    special = [x for x in (begin, end, pad) if x]
    known = {x: t.token_to_id(x) for x in special}
    if None in known.values():
        raise ValueError(f"no such token: {[x for x, i in known.items() if i is None]}")
    if begin or end:
        around = " ".join(x for x in (begin, "$A", end) if x)
        t.post_processor = TemplateProcessing(single=around, special_tokens=[(x, known[x]) for x in {begin, end} if x])
    t.enable_truncation(length)
    filler = pad or end
    t.enable_padding(length=length, pad_id=known[filler] if filler else 0, pad_token=filler or "")
    return t


def batch(path: str, length: int, **special) -> Callable:
    """Texts -> (ids, masks, types) of a batch, as a step before a model; the tokenizer is loaded at the first batch."""
    held: list = []

    def step(texts):
        if not held:
            held.append(loaded(path, length, **special))
        found = held[0].encode_batch([x if x is not None else "" for x in texts])
        return [e.ids for e in found], [e.attention_mask for e in found], [e.type_ids for e in found]

    return step


def tokenised(df: DataFrame, text: str, path: str, length: int = UTTERANCE_TOKENS, keep: tuple[str, ...] = (), **special) -> DataFrame:
    """Columns `keep`, input_ids, attention_mask and token_type_ids, arrays of `length` numbers; a null text is empty.

    path must be readable on every executor.
    """
    ship(df.sparkSession)
    names = ["input_ids", "attention_mask", "token_type_ids"]
    schema = T.StructType([df.schema[c] for c in keep] + [T.StructField(n, T.ArrayType(T.IntegerType())) for n in names])

    def run(batches):
        step = batch(path, length, **special)
        for rows in batches:
            for at in range(0, rows.num_rows, 1000):
                part = rows.slice(at, 1000)
                made = step(part.column(len(keep)).to_pylist())
                yield pa.RecordBatch.from_arrays([*(part.column(k) for k in range(len(keep))), *(pa.array(m, pa.list_(pa.int32())) for m in made)], schema.fieldNames())

    return df.select(*keep, text).mapInArrow(run, schema)

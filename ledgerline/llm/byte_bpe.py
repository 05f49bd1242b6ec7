"""Byte-level BPE encoding and decoding with the tiktoken library and a local rank file.

Long texts are cut at places where the library's own split pattern always
begins a new match, so the pieces can be encoded one after another with bounded
memory and the ids are those of the whole text. Decoding concatenates the bytes
of the tokens; an id need not end at a character boundary.
"""

from __future__ import annotations

import base64
import functools
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.llm.common import SLICE_BYTES, arrow_map, flat, lists, own_prefix, slices, text_of

#: Characters after which a long text is cut at the next safe boundary.
CHUNK_CHARS = 1 << 16

# No match of the split pattern holds white space after something else, nor
# letters beside digits, nor ASCII punctuation after a letter or digit: a new match begins at each of these.
_BOUNDARY = re.compile(r"(?<=\S)(?=[ \t\r\n])|(?<=[A-Za-z])(?=[0-9])|(?<=[0-9])(?=[A-Za-z])"
                       r"|(?<=[A-Za-z0-9])(?=[!-/:-@\[-`{-~])")


def pieces(text: str, size: int = CHUNK_CHARS) -> Iterator[str]:
    """``text`` in order, cut at the first safe boundary after every ``size`` characters."""
    at = 0
    while len(text) - at > size:
        m = _BOUNDARY.search(text, at + size)
        if m is None:
            break
        yield text[at:m.start()]
        at = m.start()
    yield text[at:]


@functools.lru_cache(maxsize=4)
def encoding(ranks_path: str, pattern: str) -> tiktoken.Encoding:
    with open(ranks_path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return tiktoken.Encoding("local", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


@functools.lru_cache(maxsize=4)
def token_bytes(ranks_path: str) -> dict[int, bytes]:
    with open(ranks_path, "rb") as lines:
        return {int(rank): base64.b64decode(token) for token, rank in map(bytes.split, lines)}


def encode_text(enc: tiktoken.Encoding, text: str) -> np.ndarray:
    parts = [enc.encode_to_numpy(p, disallowed_special=()) for p in pieces(text)]
    return parts[0] if len(parts) == 1 else np.concatenate(parts)


def encode(docs: DataFrame, ranks_path: str, pattern: str, text_col: str = "text", out_col: str = "ids") -> DataFrame:
    """``docs`` plus ``out_col``: the token ids (array of int) of each whole text, without special tokens.

    A null or empty text gives an empty array; bytes that are not UTF-8 are read as
    the replacement character. An input column named ``out_col`` is replaced; all
    other columns, null ids and repeated rows pass through as they are. Rows are
    independent, so no shuffle is made and a lost task is simply run again.
    """
    kept = docs.drop(out_col)
    schema = T.StructType([*kept.schema.fields, T.StructField(out_col, T.ArrayType(T.IntegerType(), False), False)])
    text_at = len(kept.columns)

    def run(batches):
        enc = encoding(ranks_path, pattern)
        for batch in batches:
            data, offsets = flat(batch.column(text_at))
            for i, j in slices(offsets, 2 * SLICE_BYTES):
                ids = [encode_text(enc, bytes(data[offsets[d]:offsets[d + 1]]).decode("utf-8", "replace"))
                       for d in range(i, j)]
                ends = np.concatenate([[0], np.cumsum([len(x) for x in ids])])
                column = lists(pa.array(np.concatenate(ids).astype(np.int32)), ends)
                part = batch.slice(i, j - i)
                yield pa.RecordBatch.from_arrays([*part.columns[:text_at], column], names=schema.names)

    return arrow_map(kept.withColumn(f"{own_prefix(kept)}text", text_of(text_col).cast("binary")), run, schema)


def decode(tokens: DataFrame, ranks_path: str, ids_col: str = "ids", out_col: str = "decoded") -> DataFrame:
    """``tokens`` plus ``out_col``: the raw bytes (binary) that the ids stand for; a null array gives no bytes."""
    kept = tokens.drop(out_col)
    schema = T.StructType([*kept.schema.fields, T.StructField(out_col, T.BinaryType(), False)])
    ids_at = kept.columns.index(ids_col)

    def run(batches):
        table = token_bytes(ranks_path)
        for batch in batches:
            for i in range(0, batch.num_rows, 500):
                part = batch.slice(i, 500)
                values = [b"".join([table[t] for t in row.values.to_numpy(zero_copy_only=False).tolist()])
                          if row.is_valid else b"" for row in part.column(ids_at)]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(values, pa.binary())], names=schema.names)

    return arrow_map(kept, run, schema)


def digests(docs: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): n_tokens, and SHA-256 of the ids as text and of the decoded bytes."""
    coded = decode(encode(docs.select("doc_id", "text"), ranks_path, pattern).drop("text"), ranks_path)
    return coded.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))


def checked(docs: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """Per row of ``docs``: doc_id, ids, n_tokens and whether decoding gave the text's bytes back (true for UTF-8).

    One pass over the texts, with the same definitions as :func:`encode` and :func:`decode`.
    """

    def run(batches):
        enc, table = encoding(ranks_path, pattern), token_bytes(ranks_path)
        for batch in batches:
            data, offsets = flat(batch.column(1))
            for i, j in slices(offsets):
                ids, exact = [], []
                for d in range(i, j):
                    raw = bytes(data[offsets[d]:offsets[d + 1]])
                    ids.append(encode_text(enc, raw.decode("utf-8", "replace")))
                    exact.append(b"".join([table[t] for t in ids[-1].tolist()]) == raw)
                counts = np.array([len(x) for x in ids])
                column = lists(pa.array(np.concatenate(ids).astype(np.int32)), np.concatenate([[0], np.cumsum(counts)]))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(i, j - i), column, pa.array(counts, pa.int64()), pa.array(exact)],
                    names=["doc_id", "ids", "n_tokens", "exact"])

    return arrow_map(docs.select("doc_id", text_of("text").cast("binary")), run,
                     "doc_id long, ids array<int>, n_tokens long, exact boolean")

"""Token ids in flat binary files with 64-bit document offsets, read back through memory maps.

Layout of a folder: every part ``k`` has ``k.tokens`` (unsigned little-endian
ids, document after document, two bytes each if the vocabulary fits, else four), ``k.offsets``
(n + 1 unsigned 64-bit positions in ids, from 0) and ``k.docs`` (n signed 64-bit document
ids). The manifest, a small table with one row a part, holds the part's order, its
number of documents and ids, the bytes of an id, how many of its first documents have a null
id, and its base: the ids in all parts before it, by a prefix sum over the manifest.

Parts hold ranges of ascending document ids (nulls first), so the folder reads
as one long array. A part is written under a temporary name and then renamed;
a task that runs twice writes the same bytes. The folder must be on storage that
all machines mount as files, because memory maps need files.
"""

from __future__ import annotations

import functools
import os
import uuid
import zlib
from urllib.parse import unquote, urlparse

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from ledgerline.llm.common import arrow_map, flat, slices, stored, texts
from ledgerline.llm.words import span_hashes, word_spans
from ledgerline.plans.materialize import new_location

MANIFEST = "part string, first_id long, n_docs long, n_tokens long, n_null long, id_bytes int"

#: Words whose ids a worker remembers at most; then it starts anew.
REMEMBERED = 2_000_000


def local_folder(location: str) -> str:
    """The file path behind ``location``; an error for stores that machines do not mount as files."""
    u = urlparse(location)
    if u.scheme not in ("", "file"):
        raise ValueError(f"memory-mapped token files need a mounted folder, not {location}")
    return unquote(u.path)


@functools.lru_cache(maxsize=4)
def tokenizer(path: str) -> Tokenizer:
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs a task a core
    return Tokenizer.from_file(path)


def _ids_of(t: Tokenizer, strings: list[str]) -> tuple[np.ndarray, np.ndarray]:
    ids, counts = [np.zeros(0, np.uint32)], []
    for i in range(0, len(strings), 2000):
        coded = [e.ids for e in t.encode_batch_fast(strings[i:i + 2000], add_special_tokens=False)]
        counts += map(len, coded)
        ids.append(np.fromiter((x for own in coded for x in own), np.uint32, sum(map(len, coded))))
    return np.concatenate(ids), np.array(counts, np.int64)


class Known:
    """Ids of the words that a worker has met, by hash; a second hash tells whether two words share the first."""

    def __init__(self):
        self.key = self.again = np.zeros(0, np.uint64)
        self.begin = self.count = np.zeros(0, np.int64)
        self.ids = np.zeros(0, np.uint32)

    def find(self, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.searchsorted(self.key, key)
        inside = np.minimum(at, max(0, len(self.key) - 1))
        return at, (self.key[inside] == key) if len(self.key) else np.zeros(len(key), bool)

    def add(self, at: np.ndarray, key: np.ndarray, again: np.ndarray, ids: np.ndarray, counts: np.ndarray) -> None:
        begin = len(self.ids) + np.cumsum(counts) - counts
        self.key, self.again = np.insert(self.key, at, key), np.insert(self.again, at, again)
        self.begin, self.count = np.insert(self.begin, at, begin), np.insert(self.count, at, counts)
        self.ids = np.concatenate([self.ids, ids])


@functools.lru_cache(maxsize=2)
def known_words(path: str) -> Known:
    return Known()


def encode_column(t: Tokenizer, known: Known, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The ids of all texts of a column, text after text, and how many each has.

    The tokenizer drops white space and never joins words across it, so a word is encoded when it is
    first met and its ids are put in place of every occurrence. Two hashes decide which
    words are the same; should they disagree, the column is encoded text by text.
    """
    starts, ends, firsts = word_spans(data, offsets)
    keys, again = (span_hashes(data, starts, lower=False, base=b) for b in (0x9E3779B97F4A7C15, 0xA0761D6478BD642F))
    key, first, which = np.unique(keys, return_index=True, return_inverse=True)
    if len(known.key) + len(key) > REMEMBERED:
        known.__init__()
    at, have = known.find(key)
    if (again != again[first][which]).any() or (known.again[at[have]] != again[first][have]).any():
        return _ids_of(t, [bytes(data[a:b]).decode("utf-8", "replace") for a, b in zip(offsets[:-1], offsets[1:])])
    raw, new = data.tobytes(), first[~have]
    ids, counts = _ids_of(t, [raw[a:b].decode("utf-8", "replace") for a, b in zip(starts[new], ends[new])])
    known.add(at[~have], key[~have], again[new], ids, counts)
    at, _ = known.find(key)
    n = known.count[at][which]
    upto = np.concatenate([[0], np.cumsum(n)])
    out = known.ids[np.arange(upto[-1]) + np.repeat(known.begin[at][which] - upto[:-1], n)]
    return out, upto[firsts[1:]] - upto[firsts[:-1]]


def write(docs: DataFrame, tokenizer_path: str, end_id: int, location: str,
          id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode every whole text, append ``end_id`` to each, write the files; the manifest with bases.

    Texts are encoded as the library does without being asked for more: no token is added, and a special token's
    own string in a text is that token. Null texts count as empty (only the end id). Documents are ordered by id, then
    text; null ids come first; repeated rows are written as often as they occur. An
    empty table gives an empty manifest and no file.
    """
    folder = local_folder(location)

    def run(batches):
        t, known = tokenizer(tokenizer_path), known_words(tokenizer_path)
        kind = "<u2" if max(t.get_vocab_size(), end_id + 1) <= 1 << 16 else "<u4"
        part = f"{TaskContext.get().partitionId():06d}"
        tag, own, n_docs, n_tokens, n_null, first_id = f".{uuid.uuid4().hex}", {}, 0, 0, 0, None
        for batch in batches:
            if not own:
                os.makedirs(folder, exist_ok=True)
                own = {k: open(f"{folder}/{part}.{k}{tag}", "wb") for k in ("tokens", "offsets", "docs")}
                own["offsets"].write(np.zeros(1, "<u8").tobytes())
            ids = batch.column(0)
            data, offsets = flat(batch.column(1))
            for i, j in slices(offsets, 4 << 20):
                tokens, counts = encode_column(t, known, data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i])
                with_end = counts + 1
                ends = np.cumsum(with_end)
                out = np.empty(int(ends[-1]), kind)
                last = np.zeros(len(out), bool)
                last[ends - 1] = True
                out[last], out[~last] = end_id, tokens
                out.tofile(own["tokens"])
                (ends + n_tokens).astype("<u8").tofile(own["offsets"])
                n_tokens += len(out)
            n_docs, n_null = n_docs + len(ids), n_null + ids.null_count
            values = ids.fill_null(0).to_numpy(zero_copy_only=False).astype("<i8")
            values.tofile(own["docs"])
            first_id = (ids[0].as_py() if n_docs == len(ids) else first_id) if len(ids) else first_id
        for k, f in own.items():
            f.flush()
            os.fsync(f.fileno())
            f.close()
            os.replace(f.name, f"{folder}/{part}.{k}")
        if own:
            yield pa.RecordBatch.from_pydict({"part": [part], "first_id": pa.array([first_id], pa.int64()),
                                              "n_docs": [n_docs], "n_tokens": [n_tokens], "n_null": [n_null],
                                              "id_bytes": pa.array([int(kind[2])], pa.int32())})

    rows = texts(docs, id_col, text_col).withColumn("__h", F.xxhash64("text"))
    ordered = rows.repartitionByRange("doc_id", "__h").sortWithinPartitions("doc_id", "__h", "text")
    parts = stored(arrow_map(ordered.select("doc_id", "text"), run, MANIFEST), "token-manifest")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row a part
    return parts.withColumn("base", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)).cast("long"))


def read(manifest: DataFrame, location: str) -> DataFrame:
    """Per document of the files, through memory maps: doc_id, start, n_tokens, ids_crc32 (unsigned)."""
    folder = local_folder(location)

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                if not row["n_docs"]:
                    continue
                tokens = np.memmap(f"{folder}/{row['part']}.tokens", f"<u{row['id_bytes']}", "r")
                offsets = np.memmap(f"{folder}/{row['part']}.offsets", "<u8", "r")
                ids = np.memmap(f"{folder}/{row['part']}.docs", "<i8", "r")
                for i in range(0, row["n_docs"], 10_000):
                    at = np.asarray(offsets[i:i + 10_001]).astype(np.int64)
                    own = np.asarray(ids[i:i + 10_000])
                    null = np.arange(i, i + len(own)) < row["n_null"]
                    yield pa.RecordBatch.from_pydict({
                        "doc_id": pa.array(own, mask=null), "start": pa.array(at[:-1] + row["base"]),
                        "n_tokens": pa.array(np.diff(at)),
                        "ids_crc32": pa.array([zlib.crc32(tokens[a:b].astype("<u4")) for a, b in zip(at[:-1], at[1:])], pa.int64())})

    return arrow_map(manifest.repartition("part"), run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def roundtrip(spark: SparkSession, docs: DataFrame, tokenizer_path: str, end_id: int = 2) -> DataFrame:
    """Write ``docs`` to a new folder beside the session's stored tables and read the files back."""
    location = new_location(spark, "token-files")
    return read(write(docs, tokenizer_path, end_id, location), location)

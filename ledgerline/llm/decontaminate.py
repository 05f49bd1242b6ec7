"""Benchmark decontamination: short test items found inside long documents.

Size-partitioned MinHash containment search. Items are partitioned by the size
of their shingle set (powers of two). An item's sketch is the bottom-k of its
min-wise hashes, k depending on the partition alone: with u the largest size of
the partition and t the containment asked for, k = floor((1 - t) u) + 1. A
document that holds at least t of the item misses at most (1 - t) u of its
shingles, hence holds one of any k of them: no contained item can be overlooked,
however long the document, while an unrelated document rarely holds one.
Documents are hashed whole, once; a bitmap of fixed size over all sketch values
drops nearly all their shingles where they are read. Candidates are then verified
by exact containment of the word shingles themselves.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import arrow_map, flat, lists, longs, own_prefix, slices, stored, texts
from ledgerline.llm.words import shingle_set, shingles, span_hashes, word_list, word_spans

#: Bits of the fixed-size filter over sketch values (one MiB, whatever the size of the benchmark).
FILTER_BITS = 1 << 23


def sketch_size(size: int, percent: int) -> int:
    """Smallest values kept of an item of ``size`` shingles: enough for every size in its partition."""
    largest = (1 << size.bit_length()) - 1
    return largest * (100 - percent) // 100 + 1


def _sketches(items: DataFrame, n: int, percent: int) -> DataFrame:
    """(item_id, item_key, text, width, value): sketch values; ``width`` words a shingle (fewer in shorter items)."""

    def run(batches):
        for batch in batches:
            for item_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                column = pa.array([text], pa.binary())
                data, offsets = flat(column)
                starts, _, firsts = word_spans(data, offsets)
                if not len(starts):
                    continue
                values = np.unique(shingles(span_hashes(data, starts), firsts, n)[0])
                values = values[:sketch_size(len(values), percent)]
                yield pa.RecordBatch.from_pydict({
                    "item_id": pa.array([item_id] * len(values), pa.int64()), "text": [text] * len(values),
                    "width": pa.array([min(n, len(starts))] * len(values), pa.int32()), "value": longs(values)})

    return arrow_map(items, run, "item_id long, text binary, width int, value long")


def _filter(sketch: DataFrame) -> bytes:
    """The bitmap of sketch values: at most FILTER_BITS / 64 rows of one long reach the driver."""
    bit = F.pmod("value", F.lit(FILTER_BITS))
    words = sketch.groupBy((bit / 64).cast("long").alias("w")).agg(
        F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(bit, F.lit(64)).cast("int"))).alias("bits"))
    bitmap = np.zeros(FILTER_BITS // 64, np.int64)
    for w, bits in words.toLocalIterator():
        bitmap[w] = bits
    return bitmap.tobytes()


def _hits(docs: DataFrame, bitmap: bytes, widths: list[int], n: int) -> DataFrame:
    """(doc_id, text, values): documents with shingles that pass the filter, and these."""
    shared = docs.sparkSession.sparkContext.broadcast(bitmap)

    def run(batches):
        bits = np.unpackbits(np.frombuffer(shared.value, np.uint8), bitorder="little").view(bool)
        for batch in batches:
            data, offsets = flat(batch.column(1))
            for i, j in slices(offsets):
                own = data[offsets[i]:offsets[j]]
                starts, _, firsts = word_spans(own, offsets[i:j + 1] - offsets[i])
                hashes, found, owner = span_hashes(own, starts), [], []
                for width in widths:
                    count = np.diff(firsts)
                    if width < n:  # short items: every run of so many words
                        values, at = _runs(hashes, firsts, width)
                    else:
                        values, at = shingles(hashes, firsts, n)
                        count = np.where(count >= n, count - n + 1, 0)
                        values, at = _only(values, at, count)
                    keep = np.flatnonzero(bits[(values & np.uint64(FILTER_BITS - 1)).astype(np.int64)])
                    found.append(values[keep])
                    owner.append(np.searchsorted(at, keep, "right") - 1)
                owner, values = np.concatenate(owner), np.concatenate(found)
                if len(owner):
                    pairs = np.unique(np.rec.fromarrays([owner, values], names="d,v"))
                    which, firsts = np.unique(pairs.d, return_index=True)
                    ends = np.concatenate([firsts, [len(pairs)]])
                    part = batch.slice(i, j - i).take(pa.array(which))
                    yield pa.RecordBatch.from_arrays([*part.columns, lists(longs(pairs.v), ends)],
                                                     names=["doc_id", "text", "values"])

    return arrow_map(docs, run, "doc_id long, text binary, values array<long>")


def _only(values: np.ndarray, at: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Without the whole-sequence hashes of texts shorter than a shingle: those are asked for by their width."""
    keep = np.repeat(count > 0, np.diff(at))
    return values[keep], np.concatenate([[0], np.cumsum(count)])


def _runs(hashes: np.ndarray, firsts: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``width`` words, each as the whole sequence of a text of so many words."""
    count = np.maximum(np.diff(firsts) - width + 1, 0)
    at = np.concatenate([[0], np.cumsum(count)])
    index = np.arange(at[-1]) + np.repeat(firsts[:-1] - at[:-1], count)
    run = hashes[(index[:, None] + np.arange(width)).ravel()]
    return shingles(run, np.arange(0, len(run) + 1, width), width + 1)[0], at


def _verify(pairs: DataFrame, n: int, percent: int) -> DataFrame:
    """Exact containment of each (document, item) pair; pairs of the threshold and more stay."""

    def run(batches):
        for batch in batches:
            out = {"doc_id": [], "text_key": [], "item_id": [], "n_shared": [], "n_item": []}
            last, words = None, []
            for doc_id, key, text, item_id, item in zip(*(batch.column(i) for i in range(5))):
                text = text.as_py()
                if text != last:
                    last, words = text, word_list(text)
                want = shingle_set(item.as_py(), n)
                width = len(next(iter(want)))
                have = set(zip(*(words[i:] for i in range(width))))
                shared = len(want & have)
                if 100 * shared >= percent * len(want):
                    for k, v in zip(out, (doc_id.as_py(), key.as_py(), item_id.as_py(), shared, len(want))):
                        out[k].append(v)
            yield pa.RecordBatch.from_pydict({k: pa.array(v, pa.int64()) for k, v in out.items()})

    return arrow_map(pairs.select("doc_id", "text_key", "text", "item_id", "item"), run,
                     "doc_id long, text_key long, item_id long, n_shared long, n_item long")


def contained_items(docs: DataFrame, items: DataFrame, n: int = 5, percent: int = 80,
                    id_col: str = "doc_id", text_col: str = "text",
                    item_id_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """(doc_id, text_key, item_id, n_shared, n_item): documents that hold ``percent`` % of an item's shingles.

    A shingle is ``n`` words; an item of fewer words is one shingle of all its
    words, found as a run of words anywhere. Items or documents that are null, empty or without
    words match nothing. Repeated rows give their pair once; a null id is reported
    as null; ``text_key`` (xxhash64 of the text) tells documents of one id apart. Other
    columns are not read. Empty tables give an empty result.
    """
    spark = docs.sparkSession
    sketch = stored(_sketches(texts(items, item_id_col, item_text_col).distinct(), n, percent)
                    .withColumnRenamed("doc_id", "item_id"), "sketches")
    widths = sorted(r.width for r in sketch.select("width").distinct().collect())  # at most n values
    if not widths:
        return spark.createDataFrame([], "doc_id long, text_key long, item_id long, n_shared long, n_item long")
    hits = stored(_hits(texts(docs, id_col, text_col), _filter(sketch), widths, n)
                  .withColumn("text_key", F.xxhash64("text")), "hits")
    found = (hits.select("doc_id", "text_key", F.explode("values").alias("value"))
             .join(sketch.select("item_id", "value", F.xxhash64("text").alias("item_key")), "value")
             .select("doc_id", "text_key", "item_id", "item_key").distinct())
    found = stored(found, "candidates")
    doc_texts = hits.select("doc_id", "text_key", "text").dropDuplicates(["doc_id", "text_key"]).alias("d")
    item_texts = sketch.select("item_id", F.col("text").alias("item"), F.xxhash64("text").alias("item_key")) \
        .dropDuplicates(["item_id", "item_key"]).alias("i")
    c = found.alias("c")
    pairs = (c.join(item_texts, F.col("c.item_id").eqNullSafe(F.col("i.item_id"))
                    & (F.col("c.item_key") == F.col("i.item_key")))
             .join(doc_texts, F.col("c.doc_id").eqNullSafe(F.col("d.doc_id"))
                   & (F.col("c.text_key") == F.col("d.text_key")))
             .select("c.doc_id", "c.text_key", "d.text", "c.item_id", "i.item"))
    return _verify(pairs, n, percent)


def clean(docs: DataFrame, items: DataFrame, n: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` without the documents that hold a benchmark item; rows and columns are otherwise unchanged."""
    p = own_prefix(docs)
    bad = contained_items(docs, items, n, percent).select(
        F.col("doc_id").alias(f"{p}id"), F.col("text_key").alias(f"{p}key"))
    key = F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary"))
    return docs.join(bad.distinct(), F.col("doc_id").eqNullSafe(F.col(f"{p}id")) & (key == F.col(f"{p}key")), "left_anti")

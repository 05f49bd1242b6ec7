"""Exact removal of repeated strings by blockwise suffix sorting with a difference cover.

A string of WIDTH bytes that starts at two places is found by sorting suffixes and
comparing neighbours. The suffixes of a corpus are not sorted at once but in
buckets. A suffix's bucket is the smallest hash among the GRAM-byte strings of its
first WIDTH bytes (leftmost on ties): it depends on these bytes alone, so equal
strings meet in one bucket, and neighbouring suffixes mostly share it, so a bucket
needs one short context for about eighty suffixes instead of a copy of each.

1. Every document is read once into its anchors: bucket, place, range of
   suffixes, and a hash of the context they need (their bytes). Only anchors are shuffled.
2. Buckets with one anchor are done. Contexts that occur twice in a bucket are repeated
   in whole, which counting settles; one of each goes on, to be compared with other contexts.
3. The contexts of the remaining buckets are cut from the texts and sorted block by block, a
   block being whole buckets up to a fixed size. First the suffixes at the positions of a
   difference cover are ranked, by their first PERIOD bytes and then by doubling over
   steps of PERIOD (which stay inside the cover). Then all suffixes of the block are sorted
   by their first PERIOD bytes, and ties are resolved by the ranks of the cover positions that both reach
   at the same distance. Neighbours that agree in WIDTH bytes are repeated.
4. A bucket with very many contexts is split by context hash into pieces of bounded size;
   strings found in one piece are counted against those of the others by a
   128-bit hash.
5. The repeated ranges of each document are merged and cut out.

Positions within a block are counted from the anchor, so equal strings have the same
residue modulo PERIOD and any two suffixes of a tie reach a common cover position.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.llm.common import arrow_map, binary, flat, longs, own_prefix, slices, stored, text_of, texts
from ledgerline.llm.words import mix, powers

WIDTH = 200
GRAM = 32
REACH = WIDTH - GRAM + 1
PERIOD = 64
#: Bytes of context sorted as one block, and contexts of a bucket above which it is split.
BLOCK_BYTES = 1 << 20
SPLIT = 2048

_CHUNK = 1 << 20  # bytes hashed at once; places inside a chunk take 20 bits of a sort key
_OTHER_BASE = 0xC2B2AE3D27D4EB4F


def difference_cover(period: int) -> np.ndarray:
    """Residues such that every difference modulo ``period`` is one between two of them."""
    step = int(np.ceil(np.sqrt(period)))
    return np.unique(np.concatenate([np.arange(step), np.arange(0, period, step)]))


COVER = difference_cover(PERIOD)
_IN_COVER = np.isin(np.arange(PERIOD), COVER)
#: For each residue, the steps to the next cover position.
_STEP = np.array([next(d for d in range(PERIOD) if _IN_COVER[(r + d) % PERIOD]) for r in range(PERIOD)])


def _prefix_sums(data: np.ndarray, base: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    p, q = powers(len(data) + 1, base) if base else powers(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * p[:-1], out=sums[1:])
    return sums, q


def _span_hash(sums: np.ndarray, q: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    return mix((sums[ends] - sums[starts]) * q[starts])


def anchors(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
    """(row, bucket, context hash, first, anchor, last): runs of suffixes that share an anchor.

    ``first`` to ``last`` are the starts of the suffixes, ``anchor`` the place of their bucket's
    string, all counted from the start of the row.
    """
    n = len(data)
    if (np.diff(offsets) < WIDTH).all():
        return (np.zeros(0, np.int64),) + (np.zeros(0, np.uint64),) * 2 + (np.zeros(0, np.int64),) * 3
    sums, q = _prefix_sums(data)
    grams = mix((sums[GRAM:] - sums[:-GRAM]) * q[:n - GRAM + 1])
    low = (grams & ~np.uint64(_CHUNK - 1)) | np.arange(len(grams), dtype=np.uint64)
    span = 1
    while 2 * span <= REACH:
        low = np.minimum(low[:-span], low[span:])
        span *= 2
    if span < REACH:
        low = np.minimum(low[:len(low) - (REACH - span)], low[REACH - span:])
    place = (low & np.uint64(_CHUNK - 1)).astype(np.int64)
    count = np.maximum(np.diff(offsets) - WIDTH + 1, 0)
    begins = np.cumsum(count) - count
    row = np.repeat(np.arange(len(count)), count)
    start = np.arange(len(row)) + np.repeat(offsets[:-1] - begins, count)
    own = place[start]
    new = np.ones(len(own), bool)
    new[1:] = (own[1:] != own[:-1]) | (row[1:] != row[:-1])
    head = np.flatnonzero(new)
    tail = np.concatenate([head[1:], [len(own)]]) - 1
    first, last, at, which = start[head], start[tail], own[head], row[head]
    context = mix(_span_hash(sums, q, first, last + WIDTH) + np.uint64(GRAM) * (at - first).astype(np.uint64))
    base = offsets[which]
    return which, grams[at], context, first - base, at - base, last - base


def _chunked(data: np.ndarray, offsets: np.ndarray):
    """``anchors`` of all rows; a row longer than a chunk is read in overlapping chunks."""
    for i, j in slices(offsets, _CHUNK):
        own, at = data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i]
        if len(own) <= _CHUNK:
            yield i, anchors(own, at)
            continue
        for c in range(0, len(own) - WIDTH + 1, _CHUNK - WIDTH + 1):
            part = own[c:c + _CHUNK]
            row, bucket, context, first, place, last = anchors(part, np.array([0, len(part)]))
            yield i, (row, bucket, context, first + c, place + c, last + c)


def _read_anchors(docs: DataFrame) -> DataFrame:
    """(doc_id, text_key, bucket, context, first, shape): shape holds anchor - first and last - first."""

    def run(batches):
        for batch in batches:
            data, offsets = flat(batch.column(1))
            for i, (row, bucket, context, first, place, last) in _chunked(data, offsets):
                if len(row):
                    at = pa.array(row + i)
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0).take(at), batch.column(2).take(at), longs(bucket), longs(context),
                         pa.array(first), pa.array(((place - first) << 16 | (last - first)).astype(np.int32))],
                        names=["doc_id", "text_key", "bucket", "context", "first", "shape"])

    return arrow_map(docs, run, "doc_id long, text_key long, bucket long, context long, first long, shape int")


def _contexts(docs: DataFrame) -> DataFrame:
    """The bytes of the contexts asked for: (bucket, piece, pieces, doc_id, text_key, first, shape, bytes)."""
    fields = ["bucket", "piece", "pieces", "first", "shape"]

    def run(batches):
        for batch in batches:
            data, offsets = flat(batch.column(1))
            asked = batch.column(3)
            counts = np.diff(asked.offsets.to_numpy()) if len(asked) else np.zeros(0, np.int64)
            asked = asked.flatten()
            parts = dict(zip(fields, asked.flatten()))
            row = np.repeat(np.arange(len(counts)), counts)
            for i in range(0, len(row), 20_000):
                s = slice(i, i + 20_000)
                first = parts["first"].to_numpy(zero_copy_only=False)[s]
                begin = offsets[row[s]] + first
                end = begin + (parts["shape"].to_numpy(zero_copy_only=False)[s] & 0xFFFF) + WIDTH
                take = pa.array(row[s])
                yield pa.RecordBatch.from_arrays(
                    [parts[f].slice(i, 20_000) for f in fields] + [batch.column(0).take(take), batch.column(2).take(take),
                                                                  binary(data, begin, end)],
                    names=[*fields, "doc_id", "text_key", "bytes"])

    return arrow_map(docs, run, "bucket long, piece int, pieces int, first long, shape int, doc_id long, text_key long,"
                                " bytes binary")


def _ranks(positions: np.ndarray, block: np.ndarray) -> np.ndarray:
    """Dense ranks of the PERIOD-byte strings at ``positions``."""
    view = np.lib.stride_tricks.sliding_window_view(block, PERIOD)[positions]
    strings = np.ascontiguousarray(view).view(f"S{PERIOD}").ravel()
    order = np.argsort(strings, kind="stable")
    new = np.zeros(len(order), np.int64)
    if len(order):
        new[1:] = (strings[order[1:]] != strings[order[:-1]])
    out = np.empty(len(order), np.int64)
    out[order] = np.cumsum(new)
    return out


def sort_block(block: np.ndarray, begins: np.ndarray, ends: np.ndarray, places: np.ndarray, counts: np.ndarray
               ) -> tuple[np.ndarray, np.ndarray]:
    """(order, same): the block's suffixes sorted, and whether each agrees with the one before in WIDTH bytes.

    Context ``i`` is ``block[begins[i]:ends[i]]``; its suffixes start at ``begins[i] + k`` for
    k < ``counts[i]`` and are numbered context after context; ``places[i]`` is its anchor.
    """
    block = np.concatenate([block, np.zeros(WIDTH + 8 * PERIOD, np.uint8)])
    which = np.repeat(np.arange(len(counts)), counts)
    start = np.arange(len(which)) + np.repeat(begins - (np.cumsum(counts) - counts), counts)
    residue = (start - places[which]) % PERIOD

    lengths = ends - begins
    where = np.repeat(np.arange(len(lengths)), lengths)
    every = np.arange(len(where)) + np.repeat(begins - (np.cumsum(lengths) - lengths), lengths)
    sampled = _IN_COVER[(every - places[where]) % PERIOD]
    cover, cover_end = every[sampled], ends[where[sampled]]
    index = np.full(len(block), -1, np.int64)
    index[cover] = np.arange(len(cover))

    both = _ranks(np.concatenate([cover, start]), block)
    rank, prefix = both[:len(cover)], both[len(cover):]
    depth = PERIOD
    while depth < WIDTH:
        ahead = cover + depth
        inside = ahead < cover_end
        after = np.where(inside, rank[index[np.where(inside, ahead, cover)]] + 1, 0)
        rank = np.unique(rank << 32 | after, return_inverse=True)[1]
        depth *= 2
    tie = rank[index[start + _STEP[residue]]]
    order = np.lexsort((tie, residue, prefix))

    one, two = order[:-1], order[1:]
    near = np.flatnonzero((prefix[one] == prefix[two]) & (residue[one] == residue[two]))
    same = np.zeros(len(order), bool)
    for i in range(0, len(near), 50_000):
        k = near[i:i + 50_000]
        a, b = start[order[k]], start[order[k + 1]]
        equal = np.ones(len(k), bool)
        for d in range(PERIOD, WIDTH, 8):
            left = np.flatnonzero(equal)
            for e in range(d, min(d + 8, WIDTH)):
                equal[left] &= block[a[left] + e] == block[b[left] + e]
        same[k + 1] = equal
    return order, same


_FOUND = "doc_id long, text_key long, first long, last long, pieces int, w1 long, w2 long, alone boolean"


def _sort_buckets(contexts: DataFrame) -> DataFrame:
    """Repeated ranges (first to last start); of split buckets also a row for each distinct string (w1 not null)."""
    keys = ["bucket", "piece"]
    rows = contexts.repartition(*keys).sortWithinPartitions(*keys)
    names = rows.columns

    def solve(table: pa.Table):
        table = table.combine_chunks()
        col = {n: table.column(n).chunk(0) if table.column(n).num_chunks else table.column(n).combine_chunks()
               for n in names}
        block, offsets = flat(col["bytes"])
        begins, ends = offsets[:-1], offsets[1:]
        shape = col["shape"].to_numpy(zero_copy_only=False).astype(np.int64)
        counts, places = (shape & 0xFFFF) + 1, begins + (shape >> 16)
        order, same = sort_block(block, begins, ends, places, counts)
        repeated = np.zeros(len(order), bool)
        repeated[order] = same | np.concatenate([same[1:], [False]])
        which = np.repeat(np.arange(len(counts)), counts)
        inside = np.arange(len(which)) - np.repeat(np.cumsum(counts) - counts, counts)
        first = col["first"].to_numpy(zero_copy_only=False)
        start = first[which] + inside

        edge = repeated & np.concatenate([[True], ~(repeated[:-1] & (which[:-1] == which[1:]))])
        stop = repeated & np.concatenate([~(repeated[1:] & (which[:-1] == which[1:])), [True]])
        a, b = np.flatnonzero(edge), np.flatnonzero(stop)
        yield rows_of(col, which[a], start[a], start[b], None)

        split = col["pieces"].to_numpy(zero_copy_only=False)[which[order]] > 1
        one = order[split & ~same]  # the first of every distinct string
        if len(one):
            at = begins[which[one]] + inside[one]
            hashes = [_span_hash(*_prefix_sums(block, base), at, at + WIDTH) for base in (None, _OTHER_BASE)]
            yield rows_of(col, which[one], start[one], start[one], (*hashes, ~repeated[one]))

    def rows_of(col, which, first, last, strings):
        take, none = pa.array(which), pa.nulls(len(which), pa.int64())
        w1, w2, alone = (longs(strings[0]), longs(strings[1]), pa.array(strings[2])) if strings else (
            none, none, pa.nulls(len(which), pa.bool_()))
        return pa.RecordBatch.from_arrays(
            [col["doc_id"].take(take), col["text_key"].take(take), pa.array(first), pa.array(last),
             col["pieces"].take(take), w1, w2, alone],
            names=["doc_id", "text_key", "first", "last", "pieces", "w1", "w2", "alone"])

    def run(batches):
        held, size = [], 0
        for batch in batches:
            while batch.num_rows:
                # up to the row that fills the block, and then to the end of its bucket piece
                _, offsets = flat(batch.column(names.index("bytes")))
                key = [batch.column(names.index(k)).to_numpy(zero_copy_only=False) for k in keys]
                change = np.flatnonzero((key[0][1:] != key[0][:-1]) | (key[1][1:] != key[1][:-1])) + 1
                if held:
                    old = held[-1]
                    if any(old.column(names.index(k))[-1].as_py() != batch.column(names.index(k))[0].as_py() for k in keys):
                        change = np.concatenate([[0], change])
                full = change[size + offsets[change] >= BLOCK_BYTES]
                if not len(full):
                    held.append(batch)
                    size += int(offsets[-1])
                    break
                if full[0]:
                    held.append(batch.slice(0, int(full[0])))
                yield from solve(pa.Table.from_batches(held))
                batch, held, size = batch.slice(int(full[0])), [], 0
        if held:
            yield from solve(pa.Table.from_batches(held))

    return arrow_map(rows, run, _FOUND)


def repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text_key, first, last): ranges of starts of WIDTH-byte strings that also start anywhere else.

    Matches never cross documents and may overlap, also within one document. A document is told by
    its id and ``text_key`` (xxhash64 of its bytes); rows that repeat both are separate
    documents with equal ranges. Null ids are ids like others; null, empty and short texts have no range.
    Ranges of one document may touch or overlap. Other columns are not read.
    """
    keyed = texts(docs, id_col, text_col).withColumn("text_key", F.xxhash64("text"))
    every = stored(_read_anchors(keyed), "anchors")
    # stored before the join, so that both its sides are plain shuffles, whose hot buckets Spark can split
    shared = stored(every.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("bucket"),
                    "shared-buckets")
    kept = stored(every.join(shared, "bucket", "left_semi").withColumn(
        "tag", F.xxhash64("doc_id", "text_key", "first", "shape")), "shared-anchors")
    contexts = kept.groupBy("bucket", "context").agg(F.count(F.lit(1)).alias("n"), F.min("tag").alias("pick"))
    contexts = stored(contexts, "context-counts")
    several = stored(contexts.groupBy("bucket").agg(F.count(F.lit(1)).alias("kinds")).where("kinds > 1"), "mixed-buckets")
    # what sorting must see: one of each context of buckets with several
    sorted_ = contexts.join(several, "bucket").withColumn("pieces", F.ceil(F.col("kinds") / SPLIT).cast("int"))
    marked = kept.join(contexts.where("n > 1").select("bucket", "context"), ["bucket", "context"], "left_semi")
    whole = marked.select("doc_id", "text_key", "first", (F.col("first") + F.col("shape").bitwiseAND(0xFFFF)).alias("last"))
    asked = kept.join(sorted_.select("bucket", "context", "pick", "pieces"), ["bucket", "context"]).where("tag = pick")
    asked = asked.select("doc_id", "text_key", F.struct(
        "bucket", F.pmod("context", "pieces").cast("int").alias("piece"), "pieces", "first", "shape").alias("ask"))
    per_doc = asked.groupBy("doc_id", "text_key").agg(F.collect_list("ask").alias("asks")).select(
        F.col("doc_id").alias("__id"), F.col("text_key").alias("__key"), "asks")
    cut = keyed.join(per_doc, F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("text_key") == F.col("__key")))
    cut = cut.select("doc_id", "text", "text_key", "asks")
    found = stored(_sort_buckets(_contexts(cut)), "sorted")
    between = stored(found.where("w1 is not null").groupBy("w1", "w2").agg(F.count(F.lit(1)).alias("n")).where("n > 1"),
                     "split-repeats")
    crossed = found.where("alone").join(between, ["w1", "w2"], "left_semi")
    cols = ["doc_id", "text_key", "first", "last"]
    return stored(whole.unionAll(found.where("w1 is null").select(*cols)).unionAll(crossed.select(*cols)), "ranges")


def cut_out(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` plus ``spans`` (array of start and end, in bytes, merged, in order) and ``kept`` (binary).

    ``kept`` are the bytes outside the spans. Input columns of these names are replaced; all other
    columns and every row stay. A null text counts as empty: no span, no bytes.
    """
    p = own_prefix(docs)
    ranges = repeats(docs, id_col, text_col).groupBy("doc_id", "text_key").agg(
        F.collect_list(F.struct("first", "last")).alias(f"{p}ranges")).select(
        F.col("doc_id").alias(f"{p}id"), F.col("text_key").alias(f"{p}k"), f"{p}ranges")
    own = docs.drop("spans", "kept")
    body = own.withColumn(f"{p}text", text_of(text_col).cast("binary"))
    body = body.withColumn(f"{p}key", F.xxhash64(f"{p}text"))
    same = F.col(id_col).cast("long").eqNullSafe(F.col(f"{p}id")) & (F.col(f"{p}key") == F.col(f"{p}k"))
    joined = body.join(ranges, same, "left").select(*[F.col(f"`{c}`") for c in own.columns], f"{p}text", f"{p}ranges")
    span = T.StructType([T.StructField("start", T.LongType(), False), T.StructField("end", T.LongType(), False)])
    schema = T.StructType([*own.schema.fields, T.StructField("spans", T.ArrayType(span, False), False),
                           T.StructField("kept", T.BinaryType(), False)])
    n = len(own.columns)

    def run(batches):
        for batch in batches:
            for i in range(0, batch.num_rows, 1000):
                part = batch.slice(i, 1000)
                data, offsets = flat(part.column(n))
                lists, spans, kept = part.column(n + 1), [], []
                for d in range(part.num_rows):
                    text = data[offsets[d]:offsets[d + 1]].tobytes()
                    merged = []
                    if lists[d].is_valid:
                        first, last = (x.to_numpy(zero_copy_only=False) for x in lists[d].values.flatten())
                        order = np.argsort(first, kind="stable")
                        first, end = first[order], np.maximum.accumulate(last[order] + WIDTH)
                        new = np.flatnonzero(np.concatenate([[True], first[1:] > end[:-1]]))
                        merged = list(zip(first[new].tolist(), end[np.concatenate([new[1:] - 1, [len(end) - 1]])].tolist()))
                    at, rest = 0, []
                    for a, b in merged:
                        rest.append(text[at:a])
                        at = b
                    kept.append(b"".join([*rest, text[at:]]))
                    spans.append([{"start": a, "end": b} for a, b in merged])
                kind = pa.list_(pa.field("element", pa.struct([pa.field("start", pa.int64(), False),
                                                               pa.field("end", pa.int64(), False)]), False))
                yield pa.RecordBatch.from_arrays([*part.columns[:n], pa.array(spans, kind), pa.array(kept, pa.binary())],
                                                 names=schema.names)

    return arrow_map(joined, run, schema)


def digests(docs: DataFrame) -> DataFrame:
    """Per row of ``docs``: doc_id, n_bytes, n_removed, n_spans and the SHA-256 of the bytes kept."""
    out = cut_out(docs.select("doc_id", "text"))
    size = F.octet_length(text_of("text")).cast("long")
    return out.select("doc_id", size.alias("n_bytes"), (size - F.octet_length("kept")).cast("long").alias("n_removed"),
                      F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def clean(docs: DataFrame) -> DataFrame:
    """``docs`` with repeated strings cut out of ``text`` and, if there, ``n_chars`` counted anew.

    Where a cut has split a character, the replacement character stands for the rest of it; a
    null text stays null. Columns and rows are otherwise unchanged.
    """
    p = own_prefix(docs)
    named = docs.withColumnsRenamed({c: f"{p}{c}" for c in ("spans", "kept")})  # the caller's own, if any
    out = cut_out(named)
    out = out.withColumn("text", F.when(F.col("text").isNotNull(), F.make_valid_utf8(F.col("kept").cast("string"))))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))
    return out.drop("spans", "kept").withColumnsRenamed({f"{p}{c}": c for c in ("spans", "kept")}).select(*docs.columns)

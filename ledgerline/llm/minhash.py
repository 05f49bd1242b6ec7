"""MinHash near-duplicate groups with b-bit signatures.

1. Documents with equal shingle sets form a class; one member stands for it.
2. A class's set is min-hashed. Bands of minima give the buckets that propose
   candidates; of every minimum only the low bits are kept, packed into longs.
3. Buckets are cut into pieces of bounded size. Matching bit fields estimate the similarity
   of a piece's members, corrected for chance collisions, and a spanning forest of the
   likeliest pairs is proposed: at most one pair a member, mostly the same ones in every band.
4. The pairs are confirmed on the full shingle sets, and components are built.
5. In a bucket whose members are still in several components, the members outside its largest
   component (the few) are compared with all others, each pair in the first bucket it shares. The bucket is cut
   into pieces and only the few are copied to every piece. A bucket with more than FEW of them is
   cut up by the members' later bands instead: only those that share a second band meet, and so on until the
   few are few enough. Either way the rows grow with the members and not with their square.
   Pairs estimated far below the threshold, and those whose parity sketches show too many unshared
   shingles, are dropped. Of the others the likeliest of each of the few with each other component is confirmed first, the
   components are built again, and then all pairs that are still apart are confirmed.
6. Cutting up parts pairs that share no later band, or only crowded ones. So all members of the buckets that were cut up are
   compared once more, by their rarest shingles: of two sets at the threshold, the rarest ones of each (a fifth of the set
   and one more at 80 %) have one in common, whatever is common in the texts. Members of different components that share one
   meet, however many they are; their pairs are confirmed with those of step 5. A link between two different texts is
   therefore lost only if no band proposes it or the estimate is off by more than SIGMAS
   standard errors, and it matters only if nothing else joins the two.

With 48 bands of 6 rows a pair at the threshold 0.8 shares no band with probability 5e-7; it shares 12.6 on
average. At 0.85 it is 2e-10.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import arrow_map, flat, lists, longs, own_prefix, slices, stored, text_of, texts
from ledgerline.llm.graph import components
from ledgerline.llm.words import mix, shingle_set, shingles, span_hashes, word_spans

BANDS, ROWS, BITS = 48, 6, 2
PER_LONG = 64 // BITS
SIGNATURE_LONGS = BANDS * ROWS // PER_LONG
#: Bits of the parity sketch of a set.
PARITY_BITS = 1024
#: Estimates this many standard errors under the threshold are dropped.
SIGMAS = 5.0
#: Members of a bucket that are compared with each other at once, members of a piece that the few of a bucket are
#: compared with, and how many members outside its largest component a bucket has at most without being cut up.
PIECE, WIDE, FEW = 256, 1024, 256
#: Counters that tell rare shingles from common ones; shingles that share a counter count together.
COUNTERS = 1 << 18
_LOW = np.uint64((1 << BITS) - 1)
_ODD = int("01" * PER_LONG, 2)


def _functions() -> tuple[np.ndarray, np.ndarray]:
    """Fixed multipliers (odd) and offsets of the min-wise hashes, from a counter."""
    seeds = mix(np.arange(1, 2 * BANDS * ROWS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    a, b = (seeds >> np.uint64(32)).astype(np.uint32).reshape(2, -1)
    return a | np.uint32(1), b


def minima(hashes: np.ndarray, firsts: np.ndarray) -> np.ndarray:
    """(texts, BANDS * ROWS) minima of non-empty sets; ``firsts`` starts each text's hashes."""
    x = (hashes >> np.uint64(32)).astype(np.uint32)
    a, b = _functions()
    out = np.empty((len(firsts), BANDS * ROWS), np.uint32)
    buffer = np.empty(len(x), np.uint32)
    for k in range(BANDS * ROWS):
        np.multiply(x, a[k], out=buffer)
        buffer += b[k]
        out[:, k] = np.minimum.reduceat(buffer, firsts)
    return out


def parities(hashes: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
    """(n, PARITY_BITS / 64): of each set the parity of its hashes in every residue class.

    Two sketches differ in at most as many bits as their sets have unshared members.
    """
    odd = np.bincount(owner * PARITY_BITS + (hashes & np.uint64(PARITY_BITS - 1)).astype(np.int64),
                      minlength=n * PARITY_BITS).reshape(n, PARITY_BITS) & 1
    return np.packbits(odd.astype(np.uint8), axis=1, bitorder="little").view(np.uint64)


def signatures(docs: DataFrame, n: int) -> DataFrame:
    """(doc_id, text_key, k1, k2, n_shingles, bands, sig, parity) of texts; no shingle: empty arrays."""

    def run(batches):
        for batch in batches:
            data, offsets = flat(batch.column(1))
            for i, j in slices(offsets):
                own = data[offsets[i]:offsets[j]]
                starts, _, words = word_spans(own, offsets[i:j + 1] - offsets[i])
                hashes, at = shingles(span_hashes(own, starts), words, n)
                sets = [np.unique(hashes[a:b]) for a, b in zip(at[:-1], at[1:])]
                size = np.array([len(s) for s in sets], np.int64)
                full = np.flatnonzero(size)
                k1, k2 = np.zeros(len(size), np.uint64), np.zeros(len(size), np.uint64)
                bands, sig = np.zeros((0, BANDS), np.uint64), np.zeros((0, SIGNATURE_LONGS), np.uint64)
                parity = np.zeros((0, PARITY_BITS // 64), np.uint64)
                if len(full):
                    flat_sets = np.concatenate([sets[d] for d in full])
                    firsts = np.concatenate([[0], np.cumsum(size[full])[:-1]])
                    k1[full] = np.add.reduceat(mix(flat_sets), firsts)
                    k2[full] = np.add.reduceat(mix(flat_sets ^ np.uint64(0xA5A5A5A5A5A5A5A5)), firsts)
                    parity = parities(flat_sets, np.repeat(np.arange(len(full)), size[full]), len(full))
                    m = minima(flat_sets, firsts)
                    wide = mix(m.astype(np.uint64) + (np.arange(BANDS * ROWS, dtype=np.uint64) << np.uint64(32)))
                    bands = mix(wide.reshape(-1, BANDS, ROWS).sum(2, dtype=np.uint64))
                    fields = (wide & _LOW).reshape(-1, SIGNATURE_LONGS, PER_LONG)
                    sig = (fields << (np.arange(PER_LONG, dtype=np.uint64) * np.uint64(BITS))).sum(2, dtype=np.uint64)
                part, has = batch.slice(i, j - i), np.concatenate([[0], np.cumsum(size > 0)])
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(2), longs(k1), longs(k2), pa.array(size),
                     lists(longs(bands.ravel()), has * BANDS), lists(longs(sig.ravel()), has * SIGNATURE_LONGS),
                     lists(longs(parity.ravel()), has * (PARITY_BITS // 64))],
                    names=["doc_id", "text_key", "k1", "k2", "n_shingles", "bands", "sig", "parity"])

    return arrow_map(docs, run, "doc_id long, text_key long, k1 long, k2 long, n_shingles long,"
                     " bands array<long>, sig array<long>, parity array<long>")


def estimate(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Similarity from packed signatures: the share of equal fields, less what chance makes equal."""
    x = a ^ b
    unequal = np.bitwise_count((x | (x >> np.uint64(1))) & np.uint64(_ODD)).sum(-1, dtype=np.int64)
    chance = 2.0 ** -BITS
    return (1 - unequal / float(BANDS * ROWS) - chance) / (1 - chance)


def possible(n_a: np.ndarray, n_b: np.ndarray, parity_a: np.ndarray, parity_b: np.ndarray, percent: int) -> np.ndarray:
    """False only for pairs that cannot reach the threshold, for sure."""
    unshared = np.bitwise_count(parity_a ^ parity_b).sum(-1, dtype=np.int64)
    return unshared * (100 + percent) <= (n_a + n_b) * (100 - percent)


def floor_of(percent: int, sigmas: float = SIGMAS) -> float:
    """The estimate that a pair at the threshold reaches within ``sigmas`` standard errors."""
    j, chance = percent / 100, 2.0 ** -BITS
    equal = j + (1 - j) * chance
    return j - sigmas * (equal * (1 - equal) / (BANDS * ROWS)) ** 0.5 / (1 - chance)


def _class_texts(wanted: DataFrame, classes: DataFrame, docs: DataFrame) -> DataFrame:
    """(cid, text): a text of each of the classes ``wanted`` (cid)."""
    names = classes.join(wanted, "cid").select("cid", F.col("doc_id").alias("__id"), F.col("text_key").alias("__key"))
    return stored(docs.join(names, F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("text_key") == F.col("__key")))
                  .select("cid", "text").dropDuplicates(["cid"]), "class-texts")


def _confirm(pairs: DataFrame, classes: DataFrame, docs: DataFrame, n: int, percent: int) -> DataFrame:
    """The (a, b) of ``pairs`` whose full shingle sets reach the threshold."""
    own = _class_texts(pairs.select("a").unionAll(pairs.select("b")).distinct().withColumnRenamed("a", "cid"), classes, docs)
    both = (pairs.select("a", "b").join(own.select(F.col("cid").alias("a"), F.col("text").alias("text_a")), "a")
            .join(own.select(F.col("cid").alias("b"), F.col("text").alias("text_b")), "b"))

    def run(batches):
        for batch in batches:
            a_ids, b_ids, last, have = [], [], None, set()
            for a, b, text_a, text_b in zip(*(batch.column(k) for k in range(4))):
                text_b = text_b.as_py()
                if text_b != last:
                    last, have = text_b, shingle_set(text_b, n)
                other = shingle_set(text_a.as_py(), n)
                shared = len(have & other)
                if 100 * shared >= percent * (len(have) + len(other) - shared):
                    a_ids.append(a.as_py())
                    b_ids.append(b.as_py())
            yield pa.RecordBatch.from_pydict({"a": pa.array(a_ids, pa.int64()), "b": pa.array(b_ids, pa.int64())})

    return arrow_map(both.select("a", "b", "text_a", "text_b"), run, "a long, b long")


def groups(docs: DataFrame, n: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text_key, n_shingles, component_id, kept) of every row of ``docs``.

    Documents are linked if their sets of distinct ``n``-word shingles reach ``percent`` %
    Jaccard similarity; component_id is the smallest doc_id reachable by links, itself
    included, and kept says that it is the document's own. A text with fewer words is one
    shingle; null texts and texts without words have an empty set and are linked with
    nothing. Repeated rows share a component; a row with a null id belongs to its
    component, but can neither name it nor be kept unless all its ids are null (then
    component_id is null and kept is true). Other columns are not read; an empty table
    gives an empty result.
    """
    keyed = texts(docs, id_col, text_col).withColumn("text_key", F.xxhash64("text"))
    rows = stored(signatures(keyed, n).withColumn("rid", F.monotonically_increasing_id()), "signatures")
    classes = rows.where("n_shingles > 0").groupBy("k1", "k2").agg(
        F.min("rid").alias("cid"), F.min("doc_id").alias("low"))
    members = stored(classes, "classes")
    reps = stored(rows.join(members.select(F.col("cid").alias("rid")), "rid")
                  .select(F.col("rid").alias("cid"), "doc_id", "text_key", "n_shingles", "bands", "sig", "parity"),
                  "class-signatures")
    edges = _links(reps, keyed, n, percent)
    comp = components(edges)
    named = stored(members.join(comp.withColumnRenamed("node", "cid"), "cid", "left")
                   .withColumn("root", F.coalesce("root", "cid")), "named")
    lows = stored(named.groupBy("root").agg(F.min("low").alias("component")), "components")
    per_class = named.join(lows, "root").select("k1", "k2", "component")
    empty = rows.where("n_shingles = 0").withColumn("component", F.col("doc_id"))
    linked = rows.where("n_shingles > 0").join(per_class, ["k1", "k2"])
    cols = ["doc_id", "text_key", "n_shingles", F.col("component").alias("component_id"),
            F.col("doc_id").eqNullSafe(F.col("component")).alias("kept")]
    return linked.select(*cols).unionAll(empty.select(*cols))


def _forests(members: DataFrame, percent: int) -> DataFrame:
    """(a, b): of each bucket piece a spanning forest of its likeliest pairs, at most one pair a member."""
    low, keys = floor_of(percent, 2.0), ["band", "piece"]
    rows = members.select("band", _piece(PIECE).alias("piece"), "cid", "n_shingles", "sig", "parity")
    rows = rows.repartition(*keys).sortWithinPartitions(*keys)

    def solve(batch: pa.RecordBatch):
        band, piece, cid, size = (batch.column(k).to_numpy() for k in range(4))
        sig = batch.column(4).flatten().to_numpy().view(np.uint64).reshape(-1, SIGNATURE_LONGS)
        parity = batch.column(5).flatten().to_numpy().view(np.uint64).reshape(len(sig), -1)
        new = np.flatnonzero(np.concatenate([[True], (band[1:] != band[:-1]) | (piece[1:] != piece[:-1])]))
        a, b = [], []
        for i, j in zip(new, np.append(new[1:], len(band))):
            near = np.zeros(j - i) - 1.0  # the best estimate of a pair into the tree
            mate, open_ = np.zeros(j - i, np.int64), np.ones(j - i, bool)
            at = 0
            for _ in range(j - i - 1):
                open_[at] = False
                x = sig[i:j] ^ sig[i + at]
                unequal = np.bitwise_count((x | (x >> np.uint64(1))) & np.uint64(_ODD)).sum(1)
                value = 1 - unequal / (BANDS * ROWS) / (1 - 2.0 ** -BITS)
                unshared = np.bitwise_count(parity[i:j] ^ parity[i + at]).sum(1, dtype=np.int64)
                value[unshared * (100 + percent) > (size[i:j] + size[i + at]) * (100 - percent)] = -1.0
                better = value > near
                near[better], mate[better] = value[better], at
                at = int(np.where(open_, near, -2.0).argmax())
                if near[at] >= low:
                    a.append(cid[i + at])
                    b.append(cid[i + mate[at]])
        a, b = np.array(a, np.int64), np.array(b, np.int64)
        return pa.RecordBatch.from_pydict({"a": np.maximum(a, b), "b": np.minimum(a, b)})

    def run(batches):
        held = None
        for batch in batches:
            table = pa.Table.from_batches([held, batch] if held is not None else [batch]).combine_chunks()
            batch = table.to_batches()[0] if table.num_rows else batch
            band, piece = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            if not len(band):
                continue
            last = int(np.flatnonzero((band != band[-1]) | (piece != piece[-1]))[-1]) + 1 if (
                (band[0] != band[-1]) | (piece[0] != piece[-1])) else 0
            if last:
                yield solve(batch.slice(0, last))
            held = batch.slice(last)
        if held is not None and held.num_rows:
            yield solve(held)

    return arrow_map(rows, run, "a long, b long").distinct()


def _links(reps: DataFrame, docs: DataFrame, n: int, percent: int) -> DataFrame:
    """Confirmed links between classes, enough to join all that belong together."""
    bands = reps.select("cid", F.posexplode("bands").alias("number", "band"))
    buckets = stored(bands.groupBy("band").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "buckets")
    members = stored(bands.join(buckets, "band"), "members")
    forests = _forests(members.join(reps.select("cid", "n_shingles", "sig", "parity"), "cid"), percent)
    links = stored(_confirm(stored(forests, "pairs"), reps, docs, n, percent), "links")
    comp = components(links).withColumnRenamed("node", "cid")
    rooted = stored(members.join(comp, "cid", "left")
                    .withColumn("root", F.coalesce("root", "cid")), "rooted")
    keys = stored(_open_keys(rooted.select("cid", "root", F.col("band").alias("key"))), "open-buckets")
    likely = _across(rooted, reps, percent, keys)
    crowds = keys.where(F.col("few") > FEW).select(F.col("key").alias("band"))
    if not crowds.isEmpty():
        crowded = stored(rooted.join(crowds, "band").select("cid", "root").distinct(), "crowded")
        likely = likely.unionAll(_across_rare(crowded, reps, docs, n, percent))
    likely = stored(likely, "pairs")
    # one link joins two components: first the likeliest pair of each of the few with each other component
    best = stored(likely.groupBy("few", "other").agg(F.max(F.struct("value", "a", "b")).alias("top"))
                  .select("top.a", "top.b").distinct(), "pairs")
    links = stored(links.unionAll(_confirm(best, reps, docs, n, percent)), "links")
    comp = components(links)
    tops = [comp.select(F.col("node").alias(k), F.col("root").alias(f"root_{k}")) for k in "ab"]
    apart = F.coalesce("root_a", "a") != F.coalesce("root_b", "b")
    rest = likely.select("a", "b").distinct().join(best, ["a", "b"], "left_anti").join(tops[0], "a", "left").join(tops[1], "b", "left")
    last = stored(rest.where(apart).select("a", "b"), "pairs")
    return stored(links.unionAll(_confirm(last, reps, docs, n, percent)), "links")


def _piece(size: int) -> Column:
    """The piece of its bucket that a member belongs to; a bucket of ``n`` members has ceil(n / size)."""
    return F.pmod(F.xxhash64("cid"), F.ceil(F.col("n") / size)).cast("int")


def _across(rooted: DataFrame, reps: DataFrame, percent: int, keys: DataFrame | None = None) -> DataFrame:
    """Likely pairs of different components that share a bucket, from (cid, number, band, root) of all members.

    ``keys`` are the open buckets, if known. Pairs that share crowded buckets only are left to :func:`_across_rare`.
    """
    level = rooted.select("cid", "root", "number", F.col("band").alias("key"), F.array("band").alias("path"))
    pairs = None
    while True:
        keys = keys if keys is not None else stored(_open_keys(level), "open-buckets")
        here = level.join(keys, "key")
        found = _meet(here.where(F.col("few") <= FEW), reps, percent)
        pairs = found if pairs is None else pairs.unionAll(found)
        if keys.where(F.col("few") > FEW).isEmpty():
            return pairs
        level, keys = stored(_cut_up(here.where(F.col("few") > FEW), reps), "cut-buckets"), None


def _open_keys(level: DataFrame) -> DataFrame:
    """(key, n, major, few): buckets with several components, their largest one and how many members are outside it."""
    per_root = level.groupBy("key", "root").agg(F.count(F.lit(1)).alias("m"))
    per_key = per_root.groupBy("key").agg(F.sum("m").alias("n"), F.max(F.struct("m", "root")).alias("top"))
    return per_key.select("key", "n", F.col("top.root").alias("major"), (F.col("n") - F.col("top.m")).alias("few")) \
        .where("few > 0")


def _cut_up(crowded: DataFrame, reps: DataFrame) -> DataFrame:
    """Members of crowded buckets in the buckets that a later band makes of theirs; one row a later band."""
    later = crowded.where(F.col("number") < BANDS - 1).join(reps.select("cid", "bands"), "cid").select(
        "cid", "root", "key", "path", "bands", F.explode(F.sequence(F.col("number") + 1, F.lit(BANDS - 1))).alias("number"))
    band = F.get("bands", F.col("number"))
    return later.select("cid", "root", "number", F.xxhash64("key", band).alias("key"),
                        F.concat("path", F.array(band)).alias("path"))


def _shingle_sets(batch: pa.RecordBatch, n: int):
    """(row, hashes of its distinct shingles) of the texts of a batch (cid, text)."""
    data, offsets = flat(batch.column(1))
    for i, j in slices(offsets):
        own = data[offsets[i]:offsets[j]]
        starts, _, words = word_spans(own, offsets[i:j + 1] - offsets[i])
        hashes, at = shingles(span_hashes(own, starts), words, n)
        for row, (a, b) in enumerate(zip(at[:-1], at[1:]), i):
            yield row, np.unique(hashes[a:b])


def _rarest(own: DataFrame, n: int, percent: int) -> DataFrame:
    """(cid, key): of each text (cid, text) its rarest shingles, so many that two texts at the threshold share one.

    Sets that reach the threshold have ``percent`` % of either in common at least, so that not all of these can be among
    the others of a set. Any order common to all texts would do; with the rarest first, few texts share one.
    """
    def count(batches):
        total = np.zeros(COUNTERS, np.int64)
        for batch in batches:
            for _, hashes in _shingle_sets(batch, n):
                np.add.at(total, (hashes % np.uint64(COUNTERS)).astype(np.int64), 1)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"at": pa.array(at), "n": pa.array(total[at])})

    counted = arrow_map(own, count, "at long, n long").groupBy("at").agg(F.sum("n").alias("n")).toArrow()
    total = np.zeros(COUNTERS, np.int64)  # of fixed size, whatever the texts
    total[counted["at"].to_numpy()] = counted["n"].to_numpy()

    def pick(batches):
        for batch in batches:
            rows, keys = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)]
            for row, hashes in _shingle_sets(batch, n):
                often = total[(hashes % np.uint64(COUNTERS)).astype(np.int64)]
                first = np.lexsort((hashes, often))[:len(hashes) - (percent * len(hashes) + 99) // 100 + 1]
                first = first[often[first] > 1]  # the others are in no other text
                rows.append(np.full(len(first), row))
                keys.append(hashes[first])
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(np.concatenate(rows))), longs(np.concatenate(keys))],
                                             names=["cid", "key"])

    return arrow_map(own, pick, "cid long, key long")


def _across_rare(crowded: DataFrame, reps: DataFrame, docs: DataFrame, n: int, percent: int) -> DataFrame:
    """Likely pairs of different components among all of ``crowded`` (cid, root), by the rarest shingles that they share."""
    rare = _rarest(_class_texts(crowded.select("cid"), reps, docs), n, percent)
    level = stored(rare.join(crowded, "cid").select("cid", "root", "key", F.lit(0).alias("number"),
                                                    F.array().cast("array<bigint>").alias("path")), "rare-shingles")
    keys = stored(_open_keys(level), "open-shingles")
    return _meet(level.join(keys, "key"), reps, percent).distinct()


def _members(here: DataFrame, reps: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The few of every bucket, once a piece of it, and all its members, each in its own piece, once a chunk of the few."""
    sets = reps.select("cid", "n_shingles", "sig", "parity", "bands")
    # bands before the last one that they meet in, without those that they are known to share
    before = F.array_except(F.slice("bands", F.lit(1), F.col("number")), F.col("path"))
    rows = here.join(sets, "cid").select("key", "cid", "root", "n", "few", (F.col("root") != F.col("major")).alias("is_few"),
                                         "n_shingles", "sig", "parity", before.alias("before"))
    pieces = F.explode(F.sequence(F.lit(0), F.ceil(F.col("n") / WIDE).cast("int") - 1))
    chunks = F.ceil(F.col("few") / WIDE).cast("int")
    few = rows.where("is_few").withColumn("piece", pieces).withColumn("chunk", F.pmod(F.xxhash64("cid"), chunks).cast("int"))
    all_ = rows.withColumn("piece", _piece(WIDE)).withColumn("chunk", F.explode(F.sequence(F.lit(0), chunks - 1)))
    return few.drop("n", "few"), all_.drop("n", "few")


def _meet(here: DataFrame, reps: DataFrame, percent: int) -> DataFrame:
    """Likely pairs of different components in one bucket, each pair in the first bucket it shares.

    (a, b, few, other, value): ``few`` is the one of the two outside the largest component, ``other`` the component of
    its mate, ``value`` the estimated similarity.
    """
    few, all_ = _members(here, reps)
    keys, low = ["key", "piece", "chunk"], floor_of(percent)
    rows = few.withColumn("copy", F.lit(True)).unionByName(all_.withColumn("copy", F.lit(False))).select(
        *keys, "copy", "cid", "root", "is_few", "n_shingles", "sig", "parity", "before")
    rows = rows.repartition(*keys).sortWithinPartitions(*keys)

    def solve(batch: pa.RecordBatch, starts: np.ndarray):
        copy, is_few = (batch.column(k).to_numpy(zero_copy_only=False) for k in (3, 6))
        cid, root, size = (batch.column(k).to_numpy() for k in (4, 5, 7))
        sig, parity = (batch.column(k).flatten().to_numpy().view(np.uint64).reshape(len(cid), -1) for k in (8, 9))
        before, at = batch.column(10).flatten().to_numpy(), batch.column(10).value_lengths().to_numpy()
        at = np.concatenate([[0], np.cumsum(at)])
        pairs = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))]
        for i, j in zip(starts[:-1], starts[1:]):
            one, two = i + np.flatnonzero(copy[i:j]), i + np.flatnonzero(~copy[i:j])
            if not len(one) or not len(two):
                continue
            step = max(1, (1 << 15) // len(two))
            for k in range(0, len(one), step):
                x = one[k:k + step, None]
                # two of the few meet in the pieces of both
                x, y = np.nonzero((root[x] != root[two]) & (~is_few[two] | (cid[x] < cid[two])))
                x, y = one[k + x], two[y]
                may = possible(size[x], size[y], parity[x], parity[y], percent)
                x, y = x[may], y[may]
                value = estimate(sig[x], sig[y])
                may = value >= low
                pairs.append((x[may], y[may], value[may]))
        x, y, value = (np.concatenate(c) for c in zip(*pairs))
        new = np.array([not len(before[at[p]:at[p + 1]]) or not np.isin(before[at[p]:at[p + 1]], before[at[q]:at[q + 1]]).any()
                        for p, q in zip(x, y)], bool)
        x, y, value = x[new], y[new], value[new]
        return pa.RecordBatch.from_pydict({"a": np.maximum(cid[x], cid[y]), "b": np.minimum(cid[x], cid[y]),
                                           "few": cid[x], "other": root[y], "value": value})

    def run(batches):
        held = None
        for batch in batches:
            table = pa.Table.from_batches([held, batch] if held is not None else [batch]).combine_chunks()
            if not table.num_rows:
                continue
            batch = table.to_batches()[0]
            key = [batch.column(k).to_numpy() for k in range(3)]
            cuts = np.flatnonzero(np.any([k[1:] != k[:-1] for k in key], axis=0)) + 1
            if len(cuts):
                yield solve(batch.slice(0, cuts[-1]), np.concatenate([[0], cuts]))
            held = batch.slice(cuts[-1]) if len(cuts) else batch
        if held is not None:
            yield solve(held, np.array([0, held.num_rows]))

    return arrow_map(rows, run, "a long, b long, few long, other long, value double")


def keep_one(docs: DataFrame, n: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` with one row of each near-duplicate group: the one with the smallest doc_id.

    Rows that repeat an id and text are one document and stay as often as they occur. Rows with null or empty text
    all stay, as do rows with a null id unless their group has other ids. An empty table gives an empty one.
    """
    p = own_prefix(docs)
    out = groups(docs, n, percent).where("kept").select(
        F.col("doc_id").alias(f"{p}id"), F.col("text_key").alias(f"{p}key")).distinct()
    key = F.xxhash64(text_of("text").cast("binary"))
    return docs.join(out, F.col("doc_id").eqNullSafe(F.col(f"{p}id")) & (key == F.col(f"{p}key")), "left_semi")

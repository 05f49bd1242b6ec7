"""CSV records of many files at once, also of files that are cut into splits inside a quoted field.

Files are read as lines, which Spark splits anywhere. A record is a run of lines that starts outside quotes and ends
outside quotes. Whether a split starts inside a quoted field follows from the splits before it:

1. Every split of a file with several splits is read once for either case, inside and outside quotes at its start, and
   gives the state at its end for both. Chained over the splits of a file these give the true state at
   each start; only the splits that start inside a quoted field are kept (as one number each).
2. Every split is read again and cut into records with that state. A record that a split ends in is given as its lines, and
   so are the lines before a split's first record; both are joined afterwards, at most two pieces a split.

Fields follow the usual rules: a quote opens a quoted field only at the start of a field, doubled quotes inside are one,
a comma or line end inside belongs to the field. Lines without any quote are split in one vectorised step.
"""

from __future__ import annotations

import csv
import re
import sys

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.plans.materialize import new_location, write_table
from ledgerline.plans.workers import arrow_map

RECORDS = "file long, block long, pos long, fields array<string>"
#: Whole records, records that the split ends in, lines that go on with a record of an earlier split.
WHOLE, OPEN, REST = 0, 1, 2

# From the start of a field: closed fields, then one that is quoted and not closed.
_STAYS_OPEN = re.compile(r'(?>(?:"(?:[^"]|"")*+"(?!")[^,]*+|[^",][^,]*+|),)*+"(?:[^"]|"")*+\Z', re.S)
# The rest of a quoted field, with what follows its quote up to the comma.
_CLOSES = re.compile(r'(?:[^"]|"")*+"(?!")[^,]*+', re.S)


def ends_inside(line: str, inside: bool) -> bool:
    """Whether a quoted field is open at the end of ``line``; ``inside`` tells whether one is at its start."""
    at = 0
    if inside:
        closed = _CLOSES.match(line)
        if not closed:
            return True
        at = closed.end()
        if at == len(line):
            return False
        at += 1  # the comma
    return bool(_STAYS_OPEN.match(line, at))


def file_id(path: Column) -> Column:
    """A number for a file's path."""
    return F.xxhash64(path)


def lines(files: DataFrame) -> DataFrame:
    """(file, block, of_many, split, line) of a text scan, latin-1 bytes read as characters."""
    meta = F.col("_metadata")
    return files.select(
        file_id(meta["file_path"]).alias("file"), meta["file_block_start"].alias("block"),
        (meta["file_block_length"] < meta["file_size"]).alias("of_many"),
        F.xxhash64(meta["file_path"], meta["file_block_start"]).alias("split"),
        F.decode(F.col("value").cast("binary"), "ISO-8859-1").alias("line"))


def _runs(split: np.ndarray):
    """(first, last + 1) of the rows of each split in a batch."""
    cuts = np.flatnonzero(np.diff(split)) + 1
    return zip([0, *cuts.tolist()], [*cuts.tolist(), len(split)])


def _states(batches):
    """For each split met: the state at its end if it starts outside quotes, and if it starts inside."""
    now, place, state = None, None, [False, True]

    def told():
        return pa.RecordBatch.from_pydict({
            "file": pa.array([place[0]], pa.int64()), "block": pa.array([place[1]], pa.int64()),
            "split": pa.array([now], pa.int64()), "from_out": pa.array([state[0]]), "from_in": pa.array([state[1]])})

    for batch in batches:
        split, line = batch.column("split").to_numpy(), batch.column("line")
        quote = pc.match_substring(line, '"').to_numpy(zero_copy_only=False)
        for i, j in _runs(split) if len(split) else ():
            if split[i] != now:
                if now is not None:
                    yield told()
                now, place, state = int(split[i]), (batch.column("file")[i].as_py(), batch.column("block")[i].as_py()), [False, True]
            for text in line.slice(i, j - i).filter(pa.array(quote[i:j])).to_pylist():
                state = [ends_inside(text, state[0])] * 2 if state[0] == state[1] else [ends_inside(text, s) for s in state]
    if now is not None:
        yield told()


def starts_inside(many: DataFrame) -> list[int]:
    """The splits (as hashes) that start inside a quoted field, from the lines of files with several splits."""
    ends = arrow_map(many, _states, "file long, block long, split long, from_out boolean, from_in boolean")
    chain = ends.groupBy("file").agg(F.array_sort(F.collect_list(F.struct("block", "split", "from_out", "from_in"))).alias("all"))
    start = F.struct(F.lit(False).alias("inside"), F.array().cast("array<bigint>").alias("found"))
    walked = F.aggregate("all", start, lambda acc, x: F.struct(
        F.when(acc["inside"], x["from_in"]).otherwise(x["from_out"]).alias("inside"),
        F.when(acc["inside"], F.concat(acc["found"], F.array(x["split"]))).otherwise(acc["found"]).alias("found")))
    return [r.split for r in chain.select(F.explode(walked["found"]).alias("split")).collect()]


def parsed(record: str) -> list[str]:
    csv.field_size_limit(sys.maxsize)
    return next(csv.reader([record]), [])


def _strings(rows: list) -> pa.Array:
    return pa.array(rows, pa.list_(pa.string()))


def _cutter(inside: frozenset):
    """Lines to records: whole ones with their fields, pieces of others as text."""

    def run(batches):
        now, place, pos, open_, kind = None, None, 0, None, WHOLE

        def piece():
            return pa.RecordBatch.from_arrays(
                [pa.array([place[0]], pa.int64()), pa.array([place[1]], pa.int64()),
                 pa.array([pos if kind == OPEN else -1], pa.int64()), _strings([None]),
                 pa.array([kind], pa.int32()), pa.array(["\n".join(open_)], pa.string())],
                names=["file", "block", "pos", "fields", "kind", "raw"])

        for batch in batches:
            if not batch.num_rows:
                continue
            split, line = batch.column("split").to_numpy(), batch.column("line")
            quote = np.flatnonzero(pc.match_substring(line, '"').to_numpy(zero_copy_only=False))
            quoting = dict(zip(quote.tolist(), line.take(pa.array(quote)).to_pylist()))
            blank = pc.equal(pc.utf8_length(pc.ascii_trim_whitespace(line)), 0).to_numpy(zero_copy_only=False)
            plain, plain_pos = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
            quoted, quoted_at, quoted_pos, pieces = [], [], [], []
            for i, j in _runs(split):
                if split[i] != now:
                    if open_ is not None:
                        pieces.append(piece())
                    now, place, pos = split[i], (batch.column("file")[i].as_py(), batch.column("block")[i].as_py()), 0
                    open_, kind = ([], REST) if int(now) in inside else (None, WHOLE)
                k = i
                for q in [*quote[(quote >= i) & (quote < j)].tolist(), j]:
                    if k == q:
                        pass
                    elif open_ is None:  # lines without a quote up to here are records
                        own = np.arange(k, q)[~blank[k:q]]
                        plain.append(own)
                        plain_pos.append(np.arange(pos, pos + len(own)))
                        pos += len(own)
                    else:
                        open_ += line.slice(k, q - k).to_pylist()
                    k = q
                    if q == j:
                        break
                    text, k = quoting[q], q + 1
                    if open_ is None:
                        if ends_inside(text, False):
                            open_, kind = [text], OPEN
                        else:
                            quoted.append(parsed(text))
                            quoted_at.append(q)
                            quoted_pos.append(pos)
                            pos += 1
                    else:
                        open_.append(text)
                        if not ends_inside(text, True):
                            if kind == REST:
                                pieces.append(piece())
                            else:
                                quoted.append(parsed("\n".join(open_)))
                                quoted_at.append(q)
                                quoted_pos.append(pos)
                                pos += 1
                            open_, kind = None, WHOLE
            own = np.concatenate(plain)
            at = np.concatenate([own, np.array(quoted_at, np.int64)])
            if len(at):
                order = np.argsort(at)
                fields = pa.concat_arrays([pc.split_pattern(line.take(pa.array(own)), ","), _strings(quoted)])
                where, n = pa.array(at[order]), len(at)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("file").take(where), batch.column("block").take(where),
                     pa.array(np.concatenate([*plain_pos, np.array(quoted_pos, np.int64)])[order]), fields.take(pa.array(order)),
                     pa.array(np.full(n, WHOLE, np.int32)), pa.nulls(n, pa.string())],
                    names=["file", "block", "pos", "fields", "kind", "raw"])
            yield from pieces
        if open_ is not None:
            yield piece()

    return run


def whole_records(landed: DataFrame) -> DataFrame:
    """Records that lie in one split, in file order within a partition."""
    return landed.where(F.col("kind") == WHOLE).select("file", "block", "pos", "fields")


def joined_records(landed: DataFrame) -> DataFrame:
    """Records from their pieces: each starts in one split and goes on at the start of those after it."""
    pieces = landed.where(F.col("kind") != WHOLE)
    place = Window.partitionBy("file").orderBy("block", F.col("kind").desc())
    numbered = pieces.withColumn("number", F.sum((F.col("kind") == OPEN).cast("int")).over(place))
    lines_of = F.transform(F.array_sort(F.collect_list(F.struct("block", "raw"))), lambda x: x["raw"])
    own = numbered.groupBy("file", "number").agg(
        F.min(F.when(F.col("kind") == OPEN, F.struct("block", "pos"))).alias("at"), F.array_join(lines_of, "\n").alias("record"))

    def run(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], _strings([parsed(r) for r in batch.column(3).to_pylist()])],
                                             names=["file", "block", "pos", "fields"])

    return arrow_map(own.select("file", "at.block", "at.pos", "record"), run, RECORDS)


def land(files: DataFrame) -> DataFrame:
    """All records of a text scan, headers included, stored in the shared folder: whole ones and pieces.

    ``block`` is where the split begins that a record starts in and ``pos`` its number among that split's
    records: in this order they are a file's records. Blank lines are no records; a quoted field that is never
    closed ends with its file.
    """
    read = lines(files)
    inside = frozenset(starts_inside(read.where("of_many").select("file", "block", "split", "line")))
    cut = arrow_map(read.select("file", "block", "split", "line"), _cutter(inside), RECORDS + ", kind int, raw string")
    return write_table(cut, new_location(files.sparkSession, "csv-records"), compression="zstd")

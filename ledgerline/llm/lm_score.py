"""Cross-entropy difference: how much better a target model predicts a document than a background model.

Both models are bigram models over one shared vocabulary, all words of all documents. The target model counts the target
documents, the background model all others; neither counts the document that it scores. They are matched in size:
the counts of the larger one are scaled down to as many words as the smaller one has, so that both weigh alike
against the same smoothing. With c the scaled counts,

    P(w | h) = (c(h, w) + K p(w)) / (c(h) + K),   p(w) = (c(w) + 1) / (N + V - 1)

V counts the words, the start of a text and one unknown word, N the words of the model's documents. A document's score is
the mean over its words of -log P_target + log P_background: the lower, the more it is like the target.

The counts grow with the corpus and are gathered nowhere. Documents are dealt into blocks; a block sends its distinct
keys (words and bigrams, as 64-bit hashes) with their counts up a tree: every node of the tree adds up what some ``FAN``
nodes below it send for its range of keys, and cuts the sums into as many smaller ranges. At the top a node has a
narrow range of all blocks, which is what the sums need, and the answers go back the same way, each in the order of the keys
that were sent. A block so exchanges messages with ``FAN`` nodes a level and not with every other block: messages grow
with the text, and up to ``FAN`` blocks one level is enough. c(h) is how often h occurs less how often it ends
a text. A hot word is one key a block.

Blocks are dealt by document id, so that target ids meet their documents. Rows without an id, and ids that more than
``HOT`` rows repeat, are dealt by id and text instead, after equal rows were made one with their number.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import arrow_pairs, flat, ship, slices, stored, texts
from ledgerline.llm.words import mix, span_hashes, word_spans

#: Weight of the word frequencies against the bigram counts.
K = 10.0
#: Bytes of text a block has on average, nodes that a node exchanges messages with a level at most, rows of a usual id.
BLOCK, FAN, HOT = 8 << 20, 256, 1000
_SLICE = 4 << 20
_START, _STEP = (np.uint64(x) for x in (0x8CB92BA72F3D8DD6, 0xD6E8FEB86659FD93))


def _keys(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Keys of all words, of all words with the word before and of the start of every text with words; and each
    text's first word (n + 1 values).

    Keys of words are odd, all others even.
    """
    starts, _, firsts = word_spans(data, offsets)
    words = span_hashes(data, starts)
    begin = firsts[:-1][np.diff(firsts) > 0]
    before = np.empty_like(words)
    before[1:] = words[:-1]
    before[begin] = _START
    pairs = mix(before * _STEP + words) & ~np.uint64(1)
    return np.concatenate([words | np.uint64(1), pairs, np.full(len(begin), _START)]), firsts


def _packed(values: np.ndarray) -> bytes:
    """Counts in as few bytes each as the largest needs, compressed; the first byte tells how many."""
    own = values.astype(np.min_scalar_type(int(values.max(initial=0))))
    return bytes([own.itemsize]) + pa.compress(own.tobytes(), codec="zstd", asbytes=True) if len(own) else b""


def _unpacked(raw: bytes, n: int) -> np.ndarray:
    if not n:
        return np.zeros(0, np.int64)
    own = pa.decompress(raw[1:], raw[0] * n, codec="zstd", asbytes=True)
    return np.frombuffer(own, f"u{raw[0]}").astype(np.int64)


def _gaps(keys: np.ndarray) -> bytes:
    """Sorted keys as the gaps between them, in as few bytes each as the largest after the first needs."""
    if not len(keys):
        return b""
    gaps = np.diff(keys)
    width = max(1, -(-int(gaps.max(initial=0)).bit_length() // 8))
    return keys[:1].tobytes() + gaps.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].tobytes()


def _from_gaps(raw: bytes, n: int) -> np.ndarray:
    if not n:
        return np.zeros(0, np.uint64)
    steps = np.zeros((n, 8), np.uint8)
    steps[0] = np.frombuffer(raw[:8], np.uint8)
    if n > 1:
        width = (len(raw) - 8) // (n - 1)
        steps[1:, :width] = np.frombuffer(raw, np.uint8, offset=8).reshape(n - 1, width)
    return np.cumsum(steps.view("<u8").ravel(), dtype=np.uint64)


#: Counts of a key: in background and target documents, and for a word how often it ends one.
_COUNTS = ("b", "t", "b_last", "t_last")
_MESSAGE = "up long, span long, child long, size long, keys binary, " + ", ".join(f"{c} binary" for c in _COUNTS)
_ANSWER = "up long, span long, part long, size long, totals array<long>, " + ", ".join(f"{c} binary" for c in _COUNTS)
_DOCS = "block long, doc_id long, text binary, copies long, hot_target boolean"


def _pieces(table: pa.Table, targets: np.ndarray):
    """(rows, bytes, offsets, is a target) of bounded runs of rows of a block."""
    table = table.combine_chunks()
    ids, column = table["doc_id"].chunk(0), table["text"].chunk(0)
    hot = table["hot_target"].chunk(0).fill_null(False).to_numpy(zero_copy_only=False)
    target = hot | (ids.is_valid().to_numpy(zero_copy_only=False) & np.isin(ids.fill_null(0).to_numpy(), targets))
    data, offsets = flat(column)
    for i, j in slices(offsets, _SLICE):
        yield table.slice(i, j - i), data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i], target[i:j]


def _cut(distinct: np.ndarray, sums: list[np.ndarray], node: int, span: int, fan: int, spans: int) -> pa.Table:
    """A node's sums as messages to the nodes above, one for each of ``fan`` parts of its range.

    ``spans`` ranges of equal width make up all keys on the level above.
    """
    own = [span * fan + k for k in range(fan)]
    cuts = [0, *np.searchsorted(distinct, np.array([(k << 64) // spans for k in own[1:]], np.uint64)).tolist(), len(distinct)]
    parts = [slice(a, b) for a, b in zip(cuts[:-1], cuts[1:])]
    return pa.table({"up": pa.array([node // fan] * fan, pa.int64()), "span": pa.array(own, pa.int64()),
                     "child": pa.array([node] * fan, pa.int64()),
                     "size": pa.array([x.stop - x.start for x in parts], pa.int64()),
                     "keys": pa.array([_gaps(distinct[x]) for x in parts], pa.binary()),
                     **{c: pa.array([_packed(v[x]) for x in parts], pa.binary()) for c, v in zip(_COUNTS, sums)}})


def _sender(fan: int):
    """A block's distinct keys and their counts, as messages to the first level."""

    def send(docs: pa.Table, wanted: pa.Table) -> pa.Table:
        targets = wanted["doc_id"].combine_chunks().to_numpy(zero_copy_only=False).astype(np.int64)
        keys, counts = [np.zeros(0, np.uint64)], [np.zeros((4, 0))]
        for rows, data, offsets, target in _pieces(docs, targets) if len(docs) else ():
            own, firsts = _keys(data, offsets)
            distinct, at = np.unique(own, return_inverse=True)
            n, copies = np.diff(firsts), rows["copies"].to_numpy().astype(float)
            full, size = n > 0, len(distinct)
            last, in_t, in_b = at[firsts[1:][full] - 1], copies * target, copies * ~target
            keys.append(distinct)
            of = [np.concatenate([np.repeat(x, n), np.repeat(x, n), x[full]]) for x in (in_b, in_t)]
            counts.append(np.stack([*(np.bincount(at, x, size) for x in of),
                                    *(np.bincount(last, x[full], size) for x in (in_b, in_t))]))
        distinct, at = np.unique(np.concatenate(keys), return_inverse=True)
        sums = [np.bincount(at, c, len(distinct)).astype(np.int64) for c in np.concatenate(counts, 1)]
        return _cut(distinct, sums, docs["block"][0].as_py() if len(docs) else 0, 0, fan, fan).slice(0, fan if len(docs) else 0)

    return send


def _gathered(messages: pa.Table) -> tuple[np.ndarray, list[np.ndarray], np.ndarray, list[int]]:
    """All distinct keys of some messages, their sums, the place of each key sent and the messages' sizes."""
    sizes = messages["size"].to_pylist()
    keys = np.concatenate([_from_gaps(raw, n) for raw, n in zip(messages["keys"].to_pylist(), sizes)])
    distinct, at = np.unique(keys, return_inverse=True)
    sums = [np.bincount(at, np.concatenate(list(map(_unpacked, messages[c].to_pylist(), sizes))), len(distinct)).astype(np.int64)
            for c in _COUNTS]
    return distinct, sums, at, sizes


def _answers(messages: pa.Table, counts: list[np.ndarray], at: np.ndarray, sizes: list[int], totals: list[int],
             fan: int) -> pa.Table:
    """To every child that sent a message, the counts of its keys in the order in which they were sent."""
    own = np.split(at, np.cumsum(sizes)[:-1])
    span = messages["span"][0].as_py()
    return pa.table({"up": messages["child"], "span": pa.array([span // fan] * len(own), pa.int64()),
                     "part": pa.array([span % fan] * len(own), pa.int64()), "size": messages["size"],
                     "totals": pa.array([totals] * len(own), pa.list_(pa.int64())),
                     **{c: pa.array([_packed(v[x]) for x in own], pa.binary()) for c, v in zip(_COUNTS, counts)}})


def _merger(fan: int, spans: int):
    """A node's sums, as messages to the next level."""

    def merge(messages: pa.Table) -> pa.Table:
        distinct, sums, _, _ = _gathered(messages)
        return _cut(distinct, sums, messages["up"][0].as_py(), messages["span"][0].as_py(), fan, spans)

    return merge


def _top(fan: int):
    """At the top a node's sums are those of all blocks."""

    def answer(messages: pa.Table) -> pa.Table:
        distinct, sums, at, sizes = _gathered(messages)
        word = distinct & np.uint64(1) == 1
        totals = [int(word.sum()), int(sums[0][word].sum()), int(sums[1][word].sum())]
        return _answers(messages, sums, at, sizes, totals, fan)

    return answer


def _returned(answers: pa.Table) -> tuple[list[np.ndarray], list[int]]:
    """The counts of a node's keys, from the parts of its range in order, and the totals of all parts."""
    answers = answers.sort_by("part")
    sizes = answers["size"].to_pylist()
    counts = [np.concatenate([np.zeros(0, np.int64), *map(_unpacked, answers[c].to_pylist(), sizes)]) for c in _COUNTS]
    return counts, np.array(answers["totals"].to_pylist(), np.int64).reshape(-1, 3).sum(0).tolist()


def _passer(fan: int):
    """Answers from above, handed on to the children."""

    def hand_on(messages: pa.Table, answers: pa.Table) -> pa.Table:
        _, _, at, sizes = _gathered(messages)
        counts, totals = _returned(answers)
        return _answers(messages, counts, at, sizes, totals, fan)

    return hand_on


def _times(owner: np.ndarray, what: np.ndarray) -> np.ndarray:
    """For each token how often its document holds the same thing."""
    code = owner * (int(what.max(initial=0)) + 1) + what
    _, at, n = np.unique(code, return_inverse=True, return_counts=True)
    return n[at]


def _scorer():
    """Losses of a block's documents from the answers of the first level."""

    def losses(docs: pa.Table, both: pa.Table) -> pa.Table:
        answers = both.filter(both["part"].is_valid())
        targets = both["doc_id"].drop_null().to_numpy()
        counts, (words, n_b, n_t) = _returned(answers)
        counts = dict(zip(_COUNTS, counts))
        even = float(min(n_b, n_t))
        # the same distinct keys in the same order as they were sent
        parts = [(rows, target, *_keys(data, offsets)) for rows, data, offsets, target in _pieces(docs, targets)]
        distinct = np.unique(np.concatenate([np.zeros(0, np.uint64), *(np.unique(own) for *_, own, _ in parts)]))
        start = np.searchsorted(distinct, _START)
        out = []
        for rows, target, own, firsts in parts:
            n = np.diff(firsts)
            full = np.flatnonzero(n)
            mine, at = np.unique(own, return_inverse=True)
            at = np.searchsorted(distinct, mine)[at]
            word, pair = at[:firsts[-1]], at[firsts[-1]:2 * firsts[-1]]
            owner = np.repeat(np.arange(len(n)), n)
            own_word, own_pair = _times(owner, word), _times(owner, pair)
            first, final = firsts[full], firsts[full + 1] - 1
            # how often the document holds the word before with another one after it
            last_word = np.empty(len(n), np.int64)
            last_word[full] = word[final]
            followed = own_word - (word == last_word[owner])
            both_losses = []
            for seen, last, total, inside in (("t", "t_last", n_t, target), ("b", "b_last", n_b, ~target)):
                loss = np.zeros(len(n))
                if len(full):
                    mask = inside[owner]
                    before = (counts[seen][word] - counts[last][word] - followed * mask)[:-1]
                    history = np.empty(len(word))
                    history[1:] = before
                    history[first] = counts[seen][start] - inside[full]
                    scale = even / total if even else 1.0
                    single = (scale * (counts[seen][word] - own_word * mask) + 1) / (
                        scale * (total - n[owner] * mask) + words + 1)
                    logs = np.log((scale * (counts[seen][pair] - own_pair * mask) + K * single) / (scale * history + K))
                    loss[full] = -np.add.reduceat(logs, first) / n[full]
                both_losses.append(loss)
            out.append(pa.table([rows["doc_id"], rows["copies"], pa.array(n, pa.int64()), *map(pa.array, both_losses),
                                 pa.array(both_losses[0] - both_losses[1])],
                                names=["doc_id", "copies", "n_tokens", "target_loss", "background_loss", "score"]))
        return pa.concat_tables(out)

    return losses


def levels(blocks: int) -> tuple[int, int]:
    """How many levels the tree over ``blocks`` blocks has, and how many nodes a node exchanges messages with a level."""
    count = 1
    while FAN ** count < blocks:
        count += 1
    fan = max(1, round(blocks ** (1 / count)))
    return count, fan if fan ** count >= blocks else fan + 1


def _dealt(docs: DataFrame, target: DataFrame, blocks: int) -> tuple[DataFrame, DataFrame]:
    """Documents and target ids by block."""
    rows = docs.where("doc_id is not null").groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > HOT)
    hot = stored(rows.select("doc_id").join(target.withColumn("hot_target", F.lit(True)), "doc_id", "left")
                 .withColumn("hot", F.lit(True)), "hot-ids")
    marked = docs.join(hot, "doc_id", "left")
    usual = marked.where("doc_id is not null and hot is null").select(
        F.pmod(F.xxhash64("doc_id"), F.lit(blocks)).alias("block"), "doc_id", "text", F.lit(1).cast("long").alias("copies"),
        F.lit(False).alias("hot_target"))
    crowd = marked.where("doc_id is null or hot").groupBy("doc_id", "text", "hot_target").agg(F.count(F.lit(1)).alias("copies"))
    crowd = crowd.select(F.pmod(F.xxhash64("doc_id", "text"), F.lit(blocks)).alias("block"), "doc_id", "text", "copies",
                         F.coalesce("hot_target", F.lit(False)).alias("hot_target"))
    wanted = target.select(F.pmod(F.xxhash64("doc_id"), F.lit(blocks)).alias("block"), "doc_id")
    return usual.unionAll(crowd), wanted


def score(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_tokens, target_loss, background_loss, score) of every row of ``docs``.

    ``target`` has an ``id_col`` column: rows of ``docs`` with one of these ids are the target documents
    (null ids never are; repeated target ids count once, repeated documents as often as they occur, and a
    document's copies count when it is scored). Losses are means over the words in nats; a null text or one without
    words has 0 tokens, losses and score 0. A model without documents is uniform. Other columns are not read; an
    empty table gives an empty result.
    """
    own = texts(docs, id_col, text_col)
    ship(docs.sparkSession)
    blocks = max(1, -(-(own.agg(F.sum(F.length("text"))).first()[0] or 0) // BLOCK))
    wanted = target.select(F.col(id_col).cast("long").alias("doc_id")).where("doc_id is not null").distinct()
    rows, wanted = _dealt(own, wanted, blocks)
    count, fan = levels(blocks)
    sent = [rows.groupBy("block").cogroup(wanted.groupBy("block")).applyInArrow(_sender(fan), _MESSAGE)]
    for level in range(1, count):
        sent[-1] = stored(sent[-1], "messages")  # read again on the way back
        sent.append(sent[-1].groupBy("up", "span").applyInArrow(_merger(fan, fan ** (level + 1)), _MESSAGE))
    answers = sent.pop().groupBy("up", "span").applyInArrow(_top(fan), _ANSWER)
    while sent:
        answers = arrow_pairs(sent.pop(), answers, ["up", "span"], _passer(fan), _ANSWER)
    both = answers.withColumn("block", F.col("up")).withColumn("doc_id", F.lit(None).cast("long")).unionByName(
        wanted, allowMissingColumns=True)
    scored = arrow_pairs(rows, both, ["block"], _scorer(), "doc_id long, copies long, n_tokens long, target_loss double,"
                         " background_loss double, score double")
    return scored.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), "copies"))).drop("copy", "copies")


def score_sql() -> str:
    """DuckDB SQL for the scores of ``documents`` against those labelled quality 1, rounded to 6 digits."""
    def log_p(m: str, own: str) -> str:
        """log P of a token by model ``m``; ``own`` is 1 where the token's document is one of the model's."""
        scale = f"(CASE WHEN least(n_t, n_b) > 0 THEN least(n_t, n_b)::DOUBLE / n_{m} ELSE 1 END)"
        single = f"({scale} * (w_{m} - {own} * own_w) + 1) / ({scale} * (n_{m} - {own} * n) + v - 1)"
        return (f"ln(({scale} * (p_{m} - {own} * own_p) + {K} * {single})"
                f" / ({scale} * (h_{m} - {own} * own_h) + {K}))")
    both = "count(*) FILTER (NOT tgt) AS {0}_b, count(*) FILTER (tgt) AS {0}_t"
    return f"""
WITH src AS (SELECT row_number() OVER () AS rid, doc_id,
                    coalesce(doc_id IN (SELECT doc_id FROM labels WHERE quality = 1 AND doc_id IS NOT NULL), false) AS tgt,
                    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                                 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws
             FROM documents),
tok AS (SELECT rid, tgt, len(ws) AS n, unnest(ws) AS w, unnest(list_concat([' '], ws[:-2])) AS h
        FROM src WHERE len(ws) > 0),
pairs AS (SELECT h, w, {both.format("p")} FROM tok GROUP BY h, w),
words AS (SELECT w, {both.format("w")} FROM tok GROUP BY w),
hist AS (SELECT h, {both.format("h")} FROM tok GROUP BY h),
tot AS (SELECT {both.format("n")}, count(DISTINCT w) + 2 AS v FROM tok),
own_p AS (SELECT rid, h, w, count(*) AS own_p FROM tok GROUP BY rid, h, w),
own_w AS (SELECT rid, w, count(*) AS own_w FROM tok GROUP BY rid, w),
own_h AS (SELECT rid, h, count(*) AS own_h FROM tok GROUP BY rid, h),
loss AS (SELECT rid, -avg({log_p("t", "tgt::INT")}) AS t, -avg({log_p("b", "(NOT tgt)::INT")}) AS b
         FROM tok JOIN pairs USING (h, w) JOIN words USING (w) JOIN hist USING (h) JOIN own_p USING (rid, h, w)
         JOIN own_w USING (rid, w) JOIN own_h USING (rid, h), (SELECT n_b, n_t, v FROM tot) GROUP BY rid)
SELECT doc_id, len(ws)::BIGINT AS n_tokens, round(coalesce(t, 0), 6) + 0.0 AS target_loss,
       round(coalesce(b, 0), 6) + 0.0 AS background_loss, round(coalesce(t - b, 0), 6) + 0.0 AS score
FROM src LEFT JOIN loss USING (rid)
"""

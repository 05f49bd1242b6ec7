"""Operators on texts against plain versions, with nulls, empty, repeated and long texts and clashing columns."""

import hashlib
import math
import os
import random
import struct
import sys
import textwrap
import zlib

import duckdb
import numpy as np
import public_tokenizers
import pytest
import xxhash
from tokenizers import Tokenizer

sys.path.insert(0, os.path.dirname(__file__))

import brute  # noqa: E402
from ledgerline.llm import byte_bpe, decontaminate, licences, lm_score, minhash, registry, shards, suffix_dedup  # noqa: E402
from ledgerline.llm import token_files  # noqa: E402

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def texts():
    return brute.prose()


@pytest.fixture(scope="module")
def docs(spark, texts):
    return brute.frame(spark, texts)


@pytest.fixture(scope="module")
def empty(spark):
    return brute.frame(spark, ["x"]).where("false")


def test_pieces_never_change_the_ids():
    enc = byte_bpe.encoding(RANKS, public_tokenizers.PATTERN)
    r = random.Random(2)
    for _ in range(300):
        text = "".join(r.choice(["a", "'s", " ", "  ", "\n", "7", "é", "!", "\t", "I'll", " ", "\x1c", "ß9"]) for _ in range(80))
        cut = list(byte_bpe.pieces(text, 5))
        assert "".join(cut) == text
        assert [i for p in cut for i in enc.encode_ordinary(p)] == enc.encode_ordinary(text)


def test_byte_bpe(docs, texts, empty):
    enc = byte_bpe.encoding(RANKS, public_tokenizers.PATTERN)
    got = {r.doc_id: r for r in byte_bpe.digests(docs, RANKS, public_tokenizers.PATTERN).collect()}
    for i, t in enumerate(texts):
        ids = enc.encode_ordinary(t or "")
        assert got[i].n_tokens == len(ids)
        assert got[i].ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert got[i].decoded_sha256 == hashlib.sha256((t or "").encode()).hexdigest()
    coded = byte_bpe.encode(docs, RANKS, public_tokenizers.PATTERN)
    assert coded.columns == docs.columns and dict(coded.dtypes)["ids"] == "array<int>"
    assert byte_bpe.digests(empty, RANKS, public_tokenizers.PATTERN).count() == 0


def test_token_files(spark, texts, empty):
    t = Tokenizer.from_file(registry.WORD_TOKENIZER)
    special = ["<|endoftext|>", "a <|startoftext|>b<|endoftext|> c<|endoftext|><|endoftext|>", "<|ENDOFTEXT|> x", "<|endof text|>",
               " <|startoftext|> \n", "e\u0301t\u00e9 <|endoftext|>\u0301 end", "word " * 60_000]
    texts = [*texts, *special]
    assert t.encode(special[0], add_special_tokens=False).ids == [t.token_to_id("<|endoftext|>")]
    docs = brute.frame(spark, texts)
    got = {r.doc_id: r for r in token_files.roundtrip(spark, docs, registry.WORD_TOKENIZER).collect()}
    start = 0
    for i, text in enumerate(texts):
        ids = np.array(t.encode(text or "", add_special_tokens=False).ids + [2], "<u4")
        assert (got[i].start, got[i].n_tokens, got[i].ids_crc32) == (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)
    assert token_files.roundtrip(spark, empty, registry.WORD_TOKENIZER).count() == 0
    # null ids come first, and rows that repeat id and text are written as often as they occur
    null = brute.frame(spark, ["b", "a b", None, "a b", "a b", "a b", ""], [None, 5, None, 5, 5, 4, -1])
    rows = sorted((r.start, r.n_tokens, r.doc_id, r.ids_crc32) for r in token_files.roundtrip(spark, null, registry.WORD_TOKENIZER).collect())
    assert [r[2] for r in rows] == [None, None, -1, 4, 5, 5, 5]
    crc = {text: zlib.crc32(np.array(t.encode(text, add_special_tokens=False).ids + [2], "<u4").tobytes()) for text in ("", "b", "a b")}
    assert [r[3] for r in rows[2:]] == [crc[""]] + [crc["a b"]] * 4 and {r[3] for r in rows[:2]} == {crc[""], crc["b"]}
    assert [r[0] for r in rows[1:]] == np.cumsum([r[1] for r in rows])[:-1].tolist()
    with pytest.raises(ValueError):
        token_files.local_folder("hdfs://host/folder")


@pytest.mark.parametrize("split", [2048, 8])
def test_suffix_array_dedup(docs, texts, empty, split, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "SPLIT", split)
    want = brute.without_repeats([(t or "").encode() for t in texts])
    got = {r.doc_id: tuple(r)[1:] for r in suffix_dedup.digests(docs).collect()}
    assert got == {i: (*w[:3], hashlib.sha256(w[3]).hexdigest()) for i, w in enumerate(want)}
    assert suffix_dedup.digests(empty).count() == 0
    if split == 2048:
        out = suffix_dedup.clean(docs)
        assert out.columns == docs.columns
        kept = {r.doc_id: r.text for r in out.collect()}
        assert all(kept[i] == (None if t is None else w[3].decode("utf-8", "replace")) for i, (t, w) in enumerate(zip(texts, want)))


def test_difference_cover():
    for period in (7, 16, 64, 100):
        cover = suffix_dedup.difference_cover(period)
        assert {(int(a) - int(b)) % period for a in cover for b in cover} == set(range(period))


def test_long_text_in_chunks(spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "_CHUNK", 1 << 20)
    r = random.Random(3)
    long = " ".join(r.choice("abcdefgh") * r.randint(1, 6) for _ in range(400_000))
    texts = [long, "x" + long[1_000_000:1_200_000] + "y"]
    got = {r.doc_id: r.n_removed for r in suffix_dedup.digests(brute.frame(spark, texts)).collect()}
    assert got[1] >= 200_000 and got[0] >= 200_000


@pytest.mark.parametrize("n", [4, 5])
def test_minhash_groups(docs, texts, empty, n):
    sizes, top = brute.near_groups(texts, n)
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in minhash.groups(docs, n=n).collect()}
    assert got == {i: (sizes[i], top[i], top[i] == i) for i in range(len(texts))}
    if n == 5:
        assert {r.doc_id for r in minhash.keep_one(docs).collect()} == {i for i, c in enumerate(top) if c == i}
        assert minhash.groups(empty).count() == 0


def test_decontamination(spark, docs, texts, empty):
    words = (texts[0] + " " + texts[1] + " " + texts[2]).split()
    items = [None, "", "zzz none of it", " ".join(words[3:20]), " ".join(words[40:52] + ["q"]), texts[-1], "A B",
             " ".join(words[5:8]).upper(), " ".join(words[3:20])]
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    want = brute.contained(texts, items)
    assert len(want) > 5
    got = decontaminate.contained_items(docs, bench).collect()
    assert {(r.doc_id, r.item_id) for r in got} == want and len(got) == len(want)
    assert {r.doc_id for r in decontaminate.clean(docs, bench).collect()} == set(range(len(texts))) - {d for d, _ in want}
    assert decontaminate.contained_items(empty, bench).count() == 0
    assert decontaminate.contained_items(docs, bench.where("false")).count() == 0


def plain_shard(key, node, path=""):
    """A shard number from published hash values: xxHash64 of the id, then of the child's path."""
    if not node.children:
        return node.shard
    alive = [c for c in node.children if c.weight > 0]
    if len(alive) == 1:
        return plain_shard(key, alive[0], f"{path}/{alive[0].name}")
    seed = 42 if key is None else xxhash.xxh64_intdigest(struct.pack("<q", key), 42)

    def draw(c):
        u = ((xxhash.xxh64_intdigest(f"{path}/{c.name}".encode(), seed) >> 12) + 0.5) / 2.0 ** 52
        return -math.log(u) / c.weight
    best = min(alive, key=draw)
    return plain_shard(key, best, f"{path}/{best.name}")


def test_shards_are_those_of_a_plain_descent(spark):
    ids = [*range(300), -5, 2**62, None, None, 7, 7]
    docs = brute.frame(spark, ["a", None, "ñ" * 70_000] * 102, ids)
    uneven = shards.Node("root", (
        shards.Node("r", (shards.Node("k", tuple(shards.Node(f"s{i}", shard=i, own_weight=w) for i, w in enumerate((1.0, 5.0, 0.0)))),
                          shards.Node("l", (shards.Node("s", shard=3, own_weight=2.5),)))),
        shards.Node("q", (shards.Node("k", (shards.Node("s", shard=4),)),))))
    for root in (registry.SHARD_TREE, uneven):
        more = shards.grown(root)
        rows = shards.assign(docs, root).collect()
        assert len(rows) == len(ids)
        assert all((r.shard, r.grown_shard) == (plain_shard(r.doc_id, root), plain_shard(r.doc_id, more)) for r in rows)
        for s in {r.shard for r in rows}:
            own = sorted(r.slot for r in rows if r.shard == s)
            assert own == list(range(len(own)))


def test_shards(spark, docs, texts, empty):
    rows = shards.assign(docs, registry.SHARD_TREE).collect()
    assert len(rows) == len(texts)
    for r in rows:
        raw = (texts[r.doc_id] or "").encode()
        assert (r.size, r.text_crc32) == (len(raw) + 8, zlib.crc32(raw))
        assert r.grown_shard in (r.shard, 24)
    for s in {r.shard for r in rows}:
        own = sorted(r.slot for r in rows if r.shard == s)
        assert own == list(range(len(own)))
    assert shards.assign(empty, registry.SHARD_TREE).count() == 0
    ids = spark.range(60_000).selectExpr("id AS doc_id", "'t' AS text")
    many = shards.assign(ids, registry.SHARD_TREE).groupBy("shard").count().collect()
    assert len(many) == 24 and all(2200 < r["count"] < 2800 for r in many)
    moved = shards.assign(ids, registry.SHARD_TREE).where("grown_shard = 24").count()
    assert 2000 < moved < 2800
    # a heavier rack takes rows only from elsewhere into its own subtree
    rack = shards.Node("rack0", tuple(shards.Node(c.name, shard=c.shard, own_weight=2.0)
                                      for c in registry.SHARD_TREE.children[0].children[0].children))
    region = shards.Node("region0", (rack, *registry.SHARD_TREE.children[0].children[1:]))
    heavier = shards.Node("root", (region, *registry.SHARD_TREE.children[1:]))
    before = {r.doc_id: r.shard for r in shards.assign(ids, registry.SHARD_TREE).collect()}
    after = {r.doc_id: r.shard for r in shards.assign(ids, heavier).collect()}
    assert all(after[i] < 12 for i in before if after[i] != before[i])


def by_sql(rows, good):
    """Scores of (doc_id, text) rows by the registered SQL."""
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", rows)
    con.execute("CREATE TABLE labels (doc_id BIGINT, quality INTEGER)")
    con.executemany("INSERT INTO labels VALUES (?, ?)", [(i, 1) for i in good] + [(1, 0), (None, 0)])
    return sorted(con.execute(lm_score.score_sql()).fetchall(), key=repr)


def rounded(df):
    return sorted(((r.doc_id, r.n_tokens, *(round(x, 6) + 0.0 for x in r[2:])) for r in df.collect()), key=repr)


def same_scores(got, want):
    assert [r[:2] for r in got] == [r[:2] for r in want]
    assert all(np.allclose(a[2:], b[2:], atol=2e-6) for a, b in zip(got, want))


@pytest.mark.parametrize("block, fan", [(8 << 20, 256), (600, 256), (600, 3)])
def test_language_model_scores(spark, texts, empty, monkeypatch, block, fan):
    monkeypatch.setattr(lm_score, "BLOCK", block)
    monkeypatch.setattr(lm_score, "FAN", fan)
    monkeypatch.setattr(lm_score, "HOT", 3)
    monkeypatch.setattr(lm_score, "_SLICE", 1500)
    # ids that many rows repeat, with equal texts and others, targets or not; rows without an id
    extra = [(900, t) for t in [texts[0], texts[0], texts[1], texts[2], None]] + [(901, texts[3])] * 6
    extra += [(None, texts[0])] * 4 + [(None, None), (902, "only once said"), (903, "only once said"), (5, texts[7])]
    rows = [*enumerate(texts), *extra]
    docs = brute.frame(spark, [t for _, t in rows], [i for i, _ in rows])
    for good in ([0, 5, 5, 900, 12], []):
        target = spark.createDataFrame([(i,) for i in [*good, None]], "doc_id long")
        same_scores(rounded(lm_score.score(docs, target)), by_sql(rows, good))
    assert lm_score.score(empty, target).count() == 0


def test_language_model_leaves_the_document_out(spark):
    """A text that occurs once does not know itself; one that occurs twice knows its copy."""
    rows = [(i, " ".join(f"w{(7 * i + 13 * k) % 97}" for k in range(40))) for i in range(30)]
    rows += [(100, "aa bb cc dd ee ff gg"), (101, "hh ii jj kk ll mm nn"), (102, "hh ii jj kk ll mm nn")]
    docs = brute.frame(spark, [t for _, t in rows], [i for i, _ in rows])
    got = {r.doc_id: r for r in lm_score.score(docs, spark.range(15).toDF("doc_id")).collect()}
    assert got[101].background_loss == got[102].background_loss < got[100].background_loss - 0.5


def test_language_model_messages_follow_the_text(spark, monkeypatch):
    """The number of messages a block is bounded by the fan and grows only with the depth of the tree."""
    seen = {}
    for blocks in (14, 1400):
        monkeypatch.setattr(lm_score, "BLOCK", 64)
        monkeypatch.setattr(lm_score, "FAN", 8)
        text = " ".join(f"w{i % 11}" for i in range(4))
        docs = spark.range(blocks * 64 // len(text)).selectExpr("id AS doc_id", f"'{text}' AS text")
        counts = []
        real = lm_score.stored
        monkeypatch.setattr(lm_score, "stored", lambda df, name: (out := real(df, name), name == "messages" and counts.append(out.count()))[0])
        lm_score.score(docs, docs.where("doc_id % 3 = 0")).count()
        monkeypatch.setattr(lm_score, "stored", real)
        n, fan = lm_score.levels(blocks)
        assert fan <= 8 and fan ** n >= blocks and len(counts) == n - 1
        seen[blocks] = max(counts) / blocks
    assert max(seen.values()) <= 8 and seen[1400] <= 2 * seen[14]


def test_licences(spark, empty):
    s = licences.SENTENCES
    texts = [None, "", "Nothing here.", "Text.\nReleased under the MIT License.", "foo |\nLICENSED under   the Apache License, version 2.0.",
             s[10].replace(" subject", "\nsubject") + "\n\n" + s[11].replace("permission", "\npermission"),
             " ".join([s[15], s[16], s[17], s[18]]), " ".join([s[16], s[15], s[17]]), "All rights reserved. " + s[5]]
    docs = brute.frame(spark, texts)
    got = {r.doc_id: r.licenses for r in licences.report(docs).collect()}
    assert [got[i] for i in range(len(texts))] == [
        "", "", "", "MIT", "Apache-2.0", "MIT", "BSD-2-Clause,BSD-3-Clause", "", "CC-BY-NC-4.0,all-rights-reserved"]
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", list(enumerate(texts)))
    assert sorted(con.execute(licences.report_sql()).fetchall()) == sorted(map(tuple, licences.report(docs).collect()))
    assert licences.report(empty).count() == 0
    assert "Python" not in licences.report(docs)._jdf.queryExecution().executedPlan().toString()


def test_every_licence_rule_fires_on_its_wrapped_notice(spark):
    s = licences.SENTENCES
    for i, (name, rule) in enumerate(licences.RULES):
        notice = "\n\n".join(textwrap.fill(s[k], 60) for k in rule)
        whole = f"Some Heading\n\nCopyright (c) 2020 X\n\n{notice}\n\nTHE SOFTWARE IS PROVIDED AS IS.\n"
        lines = "Some Heading\n" + "\n".join(s[k] for k in rule)
        got = licences.report(brute.frame(spark, [whole, lines])).collect()
        assert all(name in r.licenses.split(",") for r in got), (i, name)
        assert {r.sentence_ids for r in got if r.doc_id == 1} == {",".join(map(str, rule))}
    # half a sentence, or its pieces with something between them, is no sentence
    half = s[19].split(": ")
    got = licences.report(brute.frame(spark, [half[0] + ":", half[0] + ": no. " + half[1], "2.0."])).collect()
    assert [(r.n_sentences, r.licenses) for r in got] == [(0, "")] * 3


def test_rows_that_repeat_id_and_text_count_one_by_one(spark, texts):
    """Repeated rows, null ids and a very long text: every row has its result."""
    long = " ".join(f"w{i}" for i in range(60_000)) + ". Released under the MIT License."
    item = " ".join(texts[0].split()[:12])
    own = [texts[0], texts[0], texts[0], texts[1], None, None, "", long, texts[2], "All rights reserved.", "All rights reserved."]
    ids = [4, 4, None, None, None, None, 5, 6, 6, 7, 7]
    docs = brute.frame(spark, own, ids)
    as_rows = lambda rows: sorted((tuple(r) for r in rows), key=repr)
    cut = brute.without_repeats([(t or "").encode() for t in own])
    got = suffix_dedup.digests(docs).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect()
    assert as_rows(got) == as_rows((i, *w[:3], hashlib.sha256(w[3]).hexdigest()) for i, w in zip(ids, cut))
    enc = byte_bpe.encoding(RANKS, public_tokenizers.PATTERN)
    coded = [enc.encode_ordinary(t or "") for t in own]
    got = byte_bpe.digests(docs, RANKS, public_tokenizers.PATTERN).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256").collect()
    assert as_rows(got) == as_rows((i, len(c), hashlib.sha256(" ".join(map(str, c)).encode()).hexdigest(),
                                    hashlib.sha256((t or "").encode()).hexdigest()) for i, t, c in zip(ids, own, coded))
    bench = spark.createDataFrame([(1, item), (1, item), (None, item), (2, "w100 w101 w102 w103 w104 w105 w106")], "item_id long, text string")
    got = decontaminate.contained_items(docs, bench).collect()
    assert {(r.doc_id, r.item_id) for r in got} == {(4, 1), (None, 1), (4, None), (None, None), (6, 2)}
    assert sorted((x.doc_id, x.text or "") for x in decontaminate.clean(docs, bench).where("doc_id is not null").collect()) == sorted(
        [(5, ""), (6, texts[2]), (7, "All rights reserved."), (7, "All rights reserved.")])
    got = licences.report(docs).select("doc_id", "licenses").collect()
    assert as_rows(got) == as_rows((i, "MIT" if t == long else "all-rights-reserved" if t and t.startswith("All") else "")
                                   for i, t in zip(ids, own))

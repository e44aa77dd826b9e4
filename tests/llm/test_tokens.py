"""Token ids, binary store (3), packing (5), sharding (6)."""

from collections import Counter, defaultdict

import numpy as np
import plain
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from topicflow.llm import packing, queries, sharding, token_store
from topicflow.llm.tokens import Encoder, encoder, tokenizer_json

BYTE, WORD = (public_tokenizers.path(f"{n}.json") for n in ("byte_bpe_50k", "word_bpe_49k"))


def ids_of(path, texts):
    t = Tokenizer.from_file(path)
    t.encode_special_tokens = True
    return [e.ids for e in t.encode_batch([x or "" for x in texts], add_special_tokens=False)]


pieces = st.sampled_from(["a", "The", "don't", "élève", "42", "!!", "<|endoftext|>", "́x", "\U0001f600", "\x1c", " ", " ", "\x85"])
gaps = st.sampled_from([" ", "  ", "\n", " \n", "\n ", "\t", "", "  ", "  ", "\x1c ", "　 "])


@settings(max_examples=150, deadline=None)
@given(st.lists(st.lists(st.tuples(gaps, pieces, gaps), max_size=8).map(lambda x: "".join("".join(y) for y in x)), max_size=5))
def test_ids_equal_those_of_whole_texts(texts):
    for path in (BYTE, WORD):
        own = encoder(tokenizer_json(path), 7)
        got = [ids[a:b].tolist() for _, ids, off in own.documents(pa.array(texts, pa.string())) for a, b in zip(off, off[1:])]
        assert got == [x + [7] for x in ids_of(path, texts)]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.lists(st.tuples(gaps, pieces, gaps), max_size=8).map(lambda x: "".join("".join(y) for y in x)), max_size=5))
def test_ids_equal_those_of_an_unmodified_tokenizer(texts):
    for path in (BYTE, WORD):
        own = encoder(tokenizer_json(path), 7, special_tokens=True)
        got = [ids[a:b].tolist() for _, ids, off in own.documents(pa.array(texts, pa.string())) for a, b in zip(off, off[1:])]
        assert got == [e.ids + [7] for e in Tokenizer.from_file(path).encode_batch(texts, add_special_tokens=False)]


def test_pieces_met_before_are_not_encoded_again(monkeypatch):
    own, asked = Encoder(tokenizer_json(BYTE), 7), []
    real = own._encode
    monkeypatch.setattr(own, "_encode", lambda pieces, spaced: asked.append(len(pieces)) or real(pieces, spaced))
    words = [f"w{i}" for i in range(400_000)]
    text = "x " + " ".join(words)

    def ids(texts):
        return [found[a:b].tolist() for _, found, off in own.documents(pa.array(texts)) for a, b in zip(off, off[1:])]

    first = ids([text])
    asked.clear()
    assert ids([text]) == first and sum(asked) == 0
    texts = ["x w399999 w0, new w399999", "", "w7 w0"]  # a batch much smaller than what is kept
    assert ids(texts) == [x + [7] for x in ids_of(BYTE, texts)]
    assert first == [x + [7] for x in ids_of(BYTE, [text])]


@pytest.mark.parametrize("longest, every", [(9, 7), (16, 256), (20, 64), (33, 5)])
def test_codes_stand_one_after_the_other(longest, every):
    ids = np.minimum(np.random.default_rng(longest).zipf(1.2, 1003), 400).astype(np.uint32)
    lengths = token_store.code_lengths(np.bincount(ids).astype(np.int64) ** (longest // 8), longest)
    lengths[-1] = longest if longest == 33 else lengths[-1]  # one id alone takes more than half of 64 bits
    codes = token_store.canonical_codes(lengths)
    payload, points = token_store.encode(ids, codes, lengths, every)
    bits = "".join(f"{codes[i]:0{lengths[i]}b}" for i in ids)
    assert "".join(f"{x:08b}" for x in payload) == bits.ljust(len(payload) * 8, "0") and len(payload) == -(-len(bits) // 8)
    assert points.tolist() == [int(lengths[ids[:k]].sum()) for k in range(0, len(ids), every)]


def test_queries_take_special_tokens_as_the_library_does(spark, scratch):
    folder, text = scratch("special"), "x <|endoftext|> y <|startoftext|>z"
    spark.createDataFrame([(1, text), (2, "later")], "doc_id long, text string").write.parquet(f"{folder}/documents.parquet")
    plain_ids = [Tokenizer.from_file(p).encode(text, add_special_tokens=False).ids for p in (BYTE, WORD)]
    assert plain_ids != [ids_of(p, [text])[0] for p in (BYTE, WORD)]
    stored = {r.doc_id: r for r in queries.op3_token_store(spark, folder).collect()}
    assert (stored[1].n_tokens, stored[1].ids_crc32) == (len(plain_ids[0]) + 1, plain.crc([*plain_ids[0], 2]))
    assert stored[2].start == len(plain_ids[0]) + 1
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for packed in (queries.op5_best_fit_packing(spark, folder), corpus_pipeline.pack_sequences(spark, docs, folder)):
        found, = packed.where("doc_id = 1").collect()
        assert (found.length, found.ids_crc32) == (len(plain_ids[1]) + 1, plain.crc([*plain_ids[1], 0]))


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 400), min_size=1, max_size=3000), st.integers(9, 16))
def test_huffman_round_trip(ids, longest):
    ids = np.array(ids, np.uint32)
    lengths = token_store.code_lengths(np.bincount(ids), longest)
    assert lengths.max() <= longest and (0.5 ** lengths[lengths > 0]).sum() <= 1
    payload, points = token_store.encode(ids, token_store.canonical_codes(lengths), lengths, every=64)
    n = max(1, int(lengths.max()))
    assert (token_store.decode(payload, points, len(ids), token_store.decode_table(lengths, n), n, every=64) == ids).all()


def test_code_lengths_are_the_best():
    import heapq
    counts = np.random.default_rng(2).zipf(1.5, 300).astype(np.int64)
    heap, cost = counts.tolist(), 0
    heapq.heapify(heap)
    while len(heap) > 1:
        both = heapq.heappop(heap) + heapq.heappop(heap)
        cost += both
        heapq.heappush(heap, both)
    assert (token_store.code_lengths(counts, 40) * counts).sum() == cost
    assert (token_store.code_lengths(counts, 9) * counts).sum() >= cost


def test_store_of_awkward_rows(spark, tables, scratch):
    path = scratch("store")
    token_store.write(tables[0], path, BYTE, end_id=2, block_tokens=500)
    rows, found, want = plain.awkward(), defaultdict(list), defaultdict(list)
    for r in token_store.read(spark, path).collect():
        found[r.doc].append((r.n_tokens, r.ids_crc32, np.frombuffer(r.ids, "<u4").tolist(), r.start))
    for r, ids in zip(rows, ids_of(BYTE, [r[1] for r in rows])):
        want[r[0]].append((len(ids) + 1, plain.crc([*ids, 2]), [*ids, 2]))
    assert {k: sorted(x[:3] for x in v) for k, v in found.items()} == {k: sorted(v) for k, v in want.items()}
    start = 0
    for _, own in sorted(found.items(), key=lambda x: (x[0] is not None, x[0] or 0)):
        for n, _, _, at in sorted(own, key=lambda x: x[3]):
            assert at == start
            start += n


def test_store_of_an_empty_table(spark, tables, scratch):
    path = scratch("none")
    token_store.write(tables[1], path, BYTE, end_id=2)
    assert token_store.read(spark, path).count() == 0


def test_packing_of_awkward_rows(tables):
    rows = plain.awkward()
    cut = packing.token_pieces(tables[0], WORD, capacity=512, with_ids=True)
    got = packing.pack(cut, capacity=512).collect()
    want = Counter()
    for r, ids in zip(rows, ids_of(WORD, [r[1] for r in rows])):
        ids = [*ids, 0]
        want.update((r[0], a // 512, a, len(ids[a: a + 512]), plain.crc(ids[a: a + 512])) for a in range(0, len(ids), 512))
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == want
    check_sequences(got, 512)
    whole = packing.packed_sequences(packing.pack(cut, capacity=512))
    assert whole.agg(F.sum("length")).first()[0] == sum(r.length for r in got)
    assert all(len(r.ids) == 4 * r.length for r in whole.collect())
    assert packing.pack(packing.token_pieces(tables[1], WORD)).count() == 0


def check_sequences(rows, capacity):
    sequences = defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append((r.offset, r.length))
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    assert len(sequences) == plain.best_fit_decreasing([r.length for r in rows], capacity)


def test_packing_equals_pieces_one_by_one(spark):
    rng = np.random.default_rng(8)
    lengths = np.concatenate([rng.integers(1, 101, 3000), np.full(1500, 37), np.full(40, 100)])
    rows = spark.createDataFrame([(i, int(n)) for i, n in enumerate(lengths)], "id long, length long").repartition(7)
    got = packing.pack(rows, capacity=100).collect()
    assert sorted((r.id, r.length) for r in got) == sorted((i, int(n)) for i, n in enumerate(lengths))
    check_sequences(got, 100)


@settings(max_examples=80, deadline=None)
@given(st.dictionaries(st.integers(1, 20), st.integers(1, 30), max_size=12))
def test_plan_equals_pieces_one_by_one(counts):
    rows = packing.plan(counts, 20)
    n = plain.best_fit_decreasing([k for k, c in counts.items() for _ in range(c)], 20)
    sequences = set()
    for i, (length, rank, first, each, _) in enumerate(rows.tolist()):
        end = rows[i + 1][1] if i + 1 < len(rows) and rows[i + 1][0] == length else counts[length]
        sequences |= {first + j // each for j in range(end - rank)}
    assert len(sequences) == n


def test_packing_refuses_bad_lengths(spark):
    for bad in (0, 101, None):
        with pytest.raises(ValueError):
            packing.pack(spark.createDataFrame([(1, bad)], "id long, length long"), capacity=100)


@pytest.mark.parametrize("limit", [1, 60, 500, 10**9])
def test_shards_fit(spark, limit):
    rows = [(i, 10 + i % 7) for i in range(200)] + [(7, 20)] * 150 + [(None, 5)] * 30 + [(1000, 400), (1001, None)]
    docs = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, size int, key string, g int")
    got = sharding.assign_shards(docs, "doc_id", F.col("size"), limit)
    assert got.columns == [*docs.columns, "shard", "n_bytes", "shard_bytes"]
    found = got.collect()
    assert Counter((r.doc_id, r.size) for r in found) == Counter(rows)
    size, names = Counter(), Counter(r.shard for r in found)
    for r in found:
        size[r.shard] += r.n_bytes
    names_ = sorted(names)
    for r in found:
        assert r.shard_bytes == size[r.shard] and (size[r.shard] <= limit or names[r.shard] == 1)
    assert all(not b.startswith(a) for a, b in zip(names_, names_[1:]))
    above = Counter()  # only buckets above the limit were split
    for r in found:
        for d in range(len(r.shard)):
            above[r.shard[:d]] += r.n_bytes
    assert all(n > limit for n in above.values())


def test_written_shards_hold_whole_rows_within_the_limit(spark, sf, scratch):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    docs = docs.unionByName(docs.where("doc_id = 3")).withColumn("tags", F.array(F.lit("a"), "lang"))
    path, limit = f"{scratch('shards')}/out", 50_000
    manifest = sharding.write_shards(docs, path, "doc_id", limit).collect()
    assert all(r.n_bytes <= limit or r.n_rows == 1 for r in manifest) and len(manifest) > 5
    back = spark.read.parquet(path)
    assert back.drop("shard").columns == docs.columns
    assert plain.rows_of(back.drop("shard")) == plain.rows_of(docs)
    assert sum(r.n_rows for r in manifest) == docs.count()
    whole = back.agg(F.sum(F.octet_length("text"))).first()[0]
    assert sum(r.n_bytes for r in manifest) > whole
    empty = f"{scratch('shards')}/out"
    assert sharding.write_shards(docs.limit(0), empty, "doc_id", limit).count() == 0


def test_shards_of_an_empty_table(tables):
    docs = tables[1].drop("key")
    assert sharding.assign_shards(docs, "doc_id", F.octet_length("text")).count() == 0
    plan = sharding.assign_shards(tables[0].select("doc_id", "text"), "doc_id", F.octet_length("text"))
    assert "Python" not in plan._jdf.queryExecution().toString()

import zlib

import numpy as np
import pyarrow as pa
import pytest

from retailpulse.llm.queries import REGISTRY
from retailpulse.llm.token_file import (_gathered, crc_joined, decode_blocks, encode_blocks, read_documents,
                                        read_token_file, write_token_file)
from retailpulse.llm.tokens import Encoder, default_tokenizer
from retailpulse.session import scratch_path

SF = "/root/testdata/sf0.001"


def test_blocks_round_trip():
    rng = np.random.default_rng(0)
    for _ in range(8):
        blocks = [rng.integers(0, int(rng.integers(1, 65536)), int(rng.integers(1, 700))) for _ in range(30)]
        blocks += [np.zeros(2000, int), np.arange(2000) % 7, np.array([65535]), np.full(300, 50256)]
        coded = encode_blocks(blocks)
        assert all(np.array_equal(a, b) for a, b in zip(blocks, decode_blocks(coded)))
        # any block alone, in any order
        assert np.array_equal(decode_blocks(coded[5:6])[0], blocks[5])
        assert np.array_equal(decode_blocks(coded[::-1])[3], blocks[::-1][3])
    assert len(coded[30]) < 100 and len(coded[31]) < 400
    assert encode_blocks([]) == decode_blocks([]) == []


def test_damage_is_found_or_harmless():
    ids = np.random.default_rng(1).integers(0, 50000, 200)
    data, found = encode_blocks([ids])[0], 0
    for at in range(len(data)):
        bad = bytearray(data)
        bad[at] ^= 4
        if at in range(4, 8):
            bad[at] = data[at] ^ (1 if at == 4 else 0)
        try:
            assert np.array_equal(decode_blocks([bytes(bad)])[0], ids)
        except ValueError:
            found += 1
    assert found > 0.9 * len(data) - 12
    with pytest.raises(ValueError):
        decode_blocks([b"XXXX" + data[4:]])


def test_checksums_join():
    rng = np.random.default_rng(2)
    for n in (0, 1, 4, 1000, 16384):
        a, b = rng.bytes(37), rng.bytes(n)
        assert crc_joined(zlib.crc32(a), zlib.crc32(b), n) == zlib.crc32(a + b)


def test_query_equals_tokenizer(spark, texts):
    enc, start = Encoder(default_tokenizer()).tokenizer, 0
    rows = {r["doc_id"]: r for r in REGISTRY["op9_token_file"](spark, SF).collect()}
    assert len(rows) == len(texts)
    for doc in sorted(texts):
        ids = np.array([*enc.encode(texts[doc], add_special_tokens=False).ids, 0], dtype="<u4")
        r = rows[doc]
        assert (r["start"], r["n_tokens"], r["ids_crc32"]) == (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)


def test_ranges_and_cut_documents(spark, documents, texts, monkeypatch):
    monkeypatch.setattr("retailpulse.llm.multiset.MOST_BYTES", 20_000)
    path = scratch_path(spark, "ids")
    write_token_file(documents, path, block=100)
    assert spark.read.parquet(path).select("part").distinct().count() > 5
    whole = {r["doc_id"]: (r["start"], r["ids_crc32"]) for r in REGISTRY["op9_token_file"](spark, SF).collect()}
    assert {r["doc_id"]: (r["start"], r["ids_crc32"]) for r in read_documents(spark, path).collect()} == whole
    pieces = {}
    for r in read_token_file(spark, path).orderBy("block").collect():
        pieces[r["doc_id"]] = pieces.get(r["doc_id"], b"") + r["token_ids"]
    assert {i: zlib.crc32(p) for i, p in pieces.items()} == {i: c for i, (_, c) in whole.items()}


def test_null_ids_come_after_all_ranges(spark, awkward, monkeypatch):
    monkeypatch.setattr("retailpulse.llm.multiset.MOST_BYTES", 3000)
    path = scratch_path(spark, "ids")
    write_token_file(awkward, path)
    assert spark.read.parquet(path).select("part").distinct().count() > 3
    rows = read_documents(spark, path).orderBy("start").collect()
    assert [r["doc_id"] for r in rows] == [0, 1, 1, *range(2, 10), None, None]
    at = 0
    for r in rows:
        assert r["start"] == at
        at += r["n_tokens"]


def test_frequent_ids_spread_over_ranges(spark, monkeypatch):
    """A third of the rows has no id, another third is one row repeated."""
    monkeypatch.setattr("retailpulse.llm.multiset.MOST_BYTES", 10_000)
    rows = [((None, 7, k)[k % 3], "the same" if k % 3 == 1 else f"text {k}") for k in range(300)]
    path = scratch_path(spark, "ids")
    write_token_file(spark.createDataFrame(rows, "doc_id long, text string"), path)
    parts = {}
    for r in spark.read.parquet(path).select("part", "doc_ids").collect():
        for i in set(r["doc_ids"]):
            parts.setdefault(i, set()).add(r["part"])
    assert len(parts[None]) > 2 and len(parts[7]) > 2
    found = read_documents(spark, path).orderBy("start").collect()
    ids = [r["doc_id"] for r in found]
    assert ids == sorted((i for i, _ in rows), key=lambda i: (i is None, i or 0))
    at = 0
    for r in found:
        assert r["start"] == at
        at += r["n_tokens"]


def test_awkward_rows(spark, awkward, no_documents):
    path = scratch_path(spark, "ids")
    write_token_file(awkward, path)
    rows = read_documents(spark, path).orderBy("start").collect()
    assert [r["doc_id"] for r in rows] == [0, 1, 1, *range(2, 10), None, None]
    at = 0
    for r in rows:
        assert r["start"] == at
        at += r["n_tokens"]
    assert {r["n_tokens"] for r in rows if r["doc_id"] in (2, 3)} == {1}
    empty = scratch_path(spark, "ids")
    write_token_file(no_documents, empty)
    assert read_documents(spark, empty).count() == 0


def test_few_blocks_of_a_batch_are_coded_with_those_of_others(monkeypatch):
    """A step of the coder costs as much for few blocks as for many: Arrow batches do not bound it."""
    monkeypatch.setattr("retailpulse.llm.token_file.LANES", 64)
    rows = pa.table({"block": range(3 * 64 + 10), "data": [b"x" * k for k in range(3 * 64 + 10)]})
    for size in (1, 7, 64, 100, 1000):
        found = list(_gathered(iter(rows.to_batches(max_chunksize=size))))
        assert [len(t) for t in found] == [64, 64, 64 + 10]
        assert pa.concat_tables(found).equals(rows)
    assert list(_gathered(iter([]))) == []


def test_many_blocks_of_one_task(spark, documents, texts, monkeypatch):
    monkeypatch.setattr("retailpulse.llm.token_file.LANES", 16)
    path = scratch_path(spark, "ids")
    write_token_file(documents, path, block=64)
    assert spark.read.parquet(path).groupBy("part").count().agg({"count": "max"}).first()[0] > 5 * 16
    tokens = Encoder(default_tokenizer()).tokenizer
    found = {}
    for r in read_token_file(spark, path).orderBy("part", "doc", "block").collect():
        found[r["doc_id"]] = found.get(r["doc_id"], b"") + r["token_ids"]
    for doc in texts:
        ids = np.array([*tokens.encode(texts[doc], add_special_tokens=False).ids, 0], dtype="<u4")
        assert found[doc] == ids.tobytes()


def test_lanes_short_of_range_and_carries():
    """Ids that no context guesses take most of the range; sure guesses that fail, carries."""
    rng = np.random.default_rng(4)
    blocks = [rng.integers(32768, 65536, 3000) for _ in range(40)]
    blocks += [np.where(rng.random(3000) < p, rng.integers(0, 65536, 3000), 65535 - k % 3)
               for k, p in enumerate(np.linspace(0, .3, 40))]
    coded = encode_blocks(blocks)
    assert all(np.array_equal(a, b) for a, b in zip(blocks, decode_blocks(coded)))
    assert max(map(len, coded)) < 3000 * 2.6

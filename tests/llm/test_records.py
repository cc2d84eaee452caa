import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tickloom.llm import records, tokens
from tickloom.session import scratch_path, written

PATH = tokens.public_tokenizer("word_bpe_49k.json")
DOCS = [
    (5, "The cat sat.", "a"), (None, "no id", "b"), (3, None, "c"), (3, "", "d"), (9, "again and again " * 3000, "e"),
    (5, "The cat sat.", "f"), (-2, "café 12", "g"),
]


@pytest.fixture(scope="module")
def stored(spark):
    docs = spark.createDataFrame(DOCS, "doc_id long, text string, ids string")
    folder = scratch_path(spark, "records")
    return written(records.write_records(docs, folder, PATH, shards=3), "manifest")


def expected():
    tool = tokens.Encoder(PATH).tokenizer
    order = sorted(DOCS, key=lambda d: (d[0] is not None, d[0] or 0))
    return [(i, tool.encode(t or "", add_special_tokens=False).ids + [2]) for i, t, _ in order]


def test_round_trip(stored):
    found = records.with_starts(records.read_records(stored), stored).orderBy("start").collect()
    got = [(r.doc_id, np.frombuffer(r.ids, "<u4").tolist()) for r in found]
    assert sorted(map(str, got)) == sorted(map(str, expected()))
    assert [d for d, _ in got] == [d for d, _ in expected()]  # ascending, the null first
    at = 0
    for r in found:
        assert r.start == at and r.n_tokens == len(r.ids) // 4
        at += r.n_tokens
    assert sum(r.tokens for r in stored.collect()) == at


def test_checksum_of_ids_in_spark(stored):
    for r in records.read_records(stored).withColumn("crc", F.crc32("ids")).collect():
        assert r.crc == zlib.crc32(r.ids)


def test_shuffled_reading_finds_every_record(stored):
    plain = records.read_records(stored).collect()
    first, second = (records.read_shuffled(stored, seed, tasks=1).collect() for seed in (1, 2))
    assert sorted(map(str, first)) == sorted(map(str, second)) == sorted(map(str, plain))
    assert first != second and first == records.read_shuffled(stored, 1, tasks=1).collect()


def test_damage_is_found(spark, stored):
    shard = max(stored.collect(), key=lambda r: r.bytes)
    where, path = records.file_system(shard.path)
    with where.open_input_stream(path) as f:
        data = bytearray(f.read())
    for k in (3, 40, len(data) - 1):
        hurt = bytearray(data)
        hurt[k] ^= 1
        with where.open_output_stream(path + ".hurt") as f:
            f.write(bytes(hurt))
        one = spark.createDataFrame([(0, shard.path + ".hurt", shard.records)], "shard int, path string, records long")
        with pytest.raises(Exception, match="damaged|records"):
            records.read_records(one, tasks=1).collect()


def test_wide_ids_and_masks():
    payload = records.frame(None, np.array([70000, 1], np.uint32), wide=True)[12:-4]
    assert records.parse(payload) == (None, np.array([70000, 1], "<u4").tobytes())
    assert records.masked(b"") == records.MASK_PLUS and records.masked(b"a") != zlib.crc32(b"a")


def test_no_documents(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    manifest = written(records.write_records(none, scratch_path(spark, "records"), PATH), "manifest")
    assert manifest.count() == 0 and records.read_records(manifest).count() == 0

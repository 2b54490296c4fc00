import hashlib
import tarfile
import zlib

import pytest
from pyspark.sql import functions as F
from hypothesis import given, settings, strategies as st

from tallyloom.llm import media

from .helpers import awkward, empty


@settings(max_examples=200, deadline=None)
@given(st.binary(max_size=2000))
def test_round_trip(raw):
    data = media.payload(raw)
    assert len(data) % media.WIDTH == 0 and data.startswith(raw) and set(data[len(raw) :]) <= {32} and len(data) >= media.WIDTH
    assert len(data) - len(raw) < media.WIDTH or not raw
    stored = media.encode(data)
    assert media.decode(stored) == data
    assert media.size(stored[: media.HEADER]) == (media.WIDTH, len(data) // media.WIDTH)


def test_damage_is_found():
    stored = bytearray(media.encode(media.payload(b"x" * 500)))
    stored[len(stored) // 2] ^= 1
    with pytest.raises(ValueError, match="damaged"):
        media.decode(bytes(stored))


def check(rows, texts):
    for r in rows:
        raw = (texts[r.doc_id] or "").encode()
        data = media.payload(raw)
        assert (r.n_bytes, r.payload_bytes) == (len(raw), len(data))
        assert r.payload_sha256 == hashlib.sha256(data).hexdigest()
        assert r.tail_crc32 == zlib.crc32(data[-16:])
        assert r.width * r.height == r.payload_bytes
        assert r.feature == feature(data)


def feature(data):
    """Mean, deviation and counts of eight bins of 32 values, one byte at a time."""
    mean = sum(data) / len(data)
    spread = max(0.0, sum(x * x for x in data) / len(data) - mean * mean) ** 0.5
    bins = [0] * 8
    for x in data:
        bins[x // 32] += 1
    return f"{mean:.4f};{spread:.4f};" + ",".join(map(str, bins))


def test_store_is_content_addressed(spark, tmp_path):
    texts = {i: None if i == 7 else f"text {i % 20} " * (i % 20 * 40) for i in range(60)}
    docs = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string").repartition(3)
    folder = f"file://{tmp_path}/media"
    index = media.store(docs, folder).persist()
    assert index.select("digest", "shard", "offset", "length").distinct().count() == index.select("digest").distinct().count() == len({(t or "").rstrip(" ") for t in texts.values()})
    for r in index.collect():  # plain tar readers find the members
        with tarfile.open(tmp_path / "media" / r.shard) as tar:
            member = tar.getmember(f"{r.digest}.png")
            assert (member.offset_data, member.size) == (r.offset, r.length)
            assert hashlib.sha256(tar.extractfile(member).read()).hexdigest() == r.digest
    heads = {r.digest: (r.width, r.height) for r in media.read(index, folder).collect()}
    assert heads.keys() == {r.digest for r in index.collect()}


def test_columns(spark):
    texts = {i: f"véry {i % 9}" * (i * 31) for i in range(40)} | {100: None, 101: "", 102: "a", 103: "a "}
    rows = media.media_columns(spark.createDataFrame(list(texts.items()), "doc_id bigint, text string")).collect()
    assert len(rows) == len(texts)
    check(rows, texts)
    by = {r.doc_id: r for r in rows}
    assert by[100].digest == by[101].digest and by[102].digest == by[103].digest and by[102].n_bytes != by[103].n_bytes


def test_common_payloads_are_not_joined_by_shuffle(spark, monkeypatch):
    texts = {i: "the same" if i % 3 else f"own {i}" for i in range(90)}
    monkeypatch.setattr(media, "HOT", 10)
    docs = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string").repartition(4)
    rows = media.media_columns(docs).collect()
    assert len(rows) == 90 and len({(r.digest, r.shard, r.offset) for r in rows}) == 31
    check(rows, texts)


def test_awkward_rows(spark):
    docs = awkward(spark)
    rows = media.media_columns(docs.withColumn("digest", F.lit("other"))).collect()
    assert len(rows) == docs.count()
    check(rows, {r.doc_id: r.text for r in docs.collect()})
    assert media.media_columns(empty(spark)).count() == 0

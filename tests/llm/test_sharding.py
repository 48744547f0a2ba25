import heapq
import zlib

from wattgrid.llm import sharding
from wattgrid.llm.queries import op2_sharding

from .helpers import DOCS, ODD, empty_frame, odd_frame


def check(rows, shards):
    """rows: (text, size, crc, shard, slot)."""
    homes = {}
    for text, size, crc, shard, _ in rows:
        assert 0 <= shard < shards
        assert size == (0 if text is None else len(text.encode())) + 8
        assert crc == (None if text is None else zlib.crc32(text.encode()))
        assert homes.setdefault(text, shard) == shard
    for s in range(shards):
        slots = sorted(r[4] for r in rows if r[3] == s)
        assert slots == list(range(len(slots)))


def test_query_matches_plain_scheduling(spark):
    docs = spark.read.parquet(f"{DOCS}/documents.parquet").select("doc_id", "text")
    got = docs.join(op2_sharding(spark, DOCS), "doc_id").collect()
    assert len(got) == docs.count()
    check([(r["text"], r["size"], r["text_crc32"], r["shard"], r["slot"]) for r in got], 24)
    assert {r["law"] for r in got} == {"bytes"} and all(r["grown_shard"] is None for r in got)
    loads = [sum(r["size"] for r in got if r["shard"] == s) for s in range(24)]
    groups = {}
    for r in got:
        groups[r["text"]] = groups.get(r["text"], 0) + r["size"]
    plain = [(0, s) for s in range(24)]
    for size in sorted(groups.values(), reverse=True):
        load, s = heapq.heappop(plain)
        heapq.heappush(plain, (load + size, s))
    assert max(loads) <= 1.001 * max(x for x, _ in plain)


def test_small_groups_go_in_bundles(spark):
    rows = [(i, f"text {i % 700} " + "y" * (i % 700 % 37)) for i in range(1400)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = df.join(sharding.shard_rows(df, shards=4, large=2, width=8, rows_per_block=100), "doc_id").collect()
    check([(r["text"], r["size"], r["text_crc32"], r["shard"], r["slot"]) for r in got], 4)
    loads = [sum(r["size"] for r in got if r["shard"] == s) for s in range(4)]
    assert max(loads) < 1.05 * min(loads)


def test_longest_first():
    placed = sharding.longest_first([(5, "a"), (4, "b"), (3, "c"), (3, "d"), (3, "e")], 2)
    assert placed == {"a": 0, "b": 1, "c": 1, "d": 0, "e": 1}


def test_odd_rows_and_empty_table(spark):
    got = sharding.shard_rows(odd_frame(spark), shards=3).collect()
    assert len(got) == len(ODD)
    for s in range(3):
        slots = sorted(r["slot"] for r in got if r["shard"] == s)
        assert slots == list(range(len(slots)))
    assert len({r["shard"] for r in got if r["text_crc32"] is None}) == 1
    assert sharding.shard_rows(empty_frame(spark), shards=3).count() == 0

import hashlib
import math
import zlib
from collections import Counter, defaultdict

from tablewright.llm.sharding import shard_rows
from tests.llm.support import hard_documents, plan_of, table


def plain_jump(key, n):
    at = shard = jump = 0
    while at < n:
        shard, jump = at, jump + 1
        draw = int(hashlib.md5(f"{key}:{jump}".encode()).hexdigest()[:8], 16) + 1
        at = math.floor((at + 1) / (draw / 2.0**32))
    return shard


def test_against_plain_walk(spark):
    rows = [*hard_documents(), (None, "null id"), (None, None), (3, "again"), (3, "again")]
    got = shard_rows(table(spark, rows), n_shards=7).collect()
    found = Counter((r.doc_id, r.size, r.text_crc32, r.shard, r.grown_shard, r.law) for r in got)
    expected = Counter()
    for key, text in rows:
        name, data = "null" if key is None else key, (text or "").encode()
        expected[(key, len(data) + 16, zlib.crc32(data), plain_jump(name, 7), plain_jump(name, 8), "key")] += 1
    assert found == expected
    slots = defaultdict(list)
    for r in got:
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_even_and_stable(spark):
    docs = spark.range(20_000).selectExpr("id AS doc_id", "'x' AS text")
    got = shard_rows(docs, block_rows=50).collect()
    counts = Counter(r.shard for r in got)
    assert sorted(counts) == list(range(40)) and max(counts.values()) < 620 and min(counts.values()) > 400
    moved = [r for r in got if r.grown_shard != r.shard]
    assert all(r.grown_shard == 40 for r in moved)
    assert abs(len(moved) - 20_000 / 41) < 120
    slots = defaultdict(list)
    for r in got:
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_no_python_and_no_rows(spark):
    empty = shard_rows(table(spark, []))
    assert "Python" not in plan_of(empty) and "Arrow" not in plan_of(empty)
    assert empty.collect() == []

import random
import zlib
from collections import Counter, defaultdict

import numpy as np

from tidecast.llm import sharding
from tidecast.llm.queries import QUERIES


def checked(rows, docs, shards=16):
    """All contract columns against the documents; returns the shards of each text and the loads."""
    want = Counter((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in docs)
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in rows) == want
    assert all(r.law == "bytes" and r.grown_shard is None and 0 <= r.shard < shards for r in rows)
    slots = defaultdict(list)
    for r in rows:
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    loads = np.zeros((shards, 2))
    places = defaultdict(set)
    for r in rows:
        loads[r.shard] += r.size, 1
        places[r.size, r.text_crc32].add(r.shard)
    return places, loads


def plain_place(vectors, bins):
    """The placing rule, one vector and one bin at a time."""
    total = [sum(v[d] for v in vectors) or 1.0 for d in range(3)]
    share = [[v[d] / total[d] for d in range(3)] for v in vectors]
    left = [[1.0 / bins] * 3 for _ in range(bins)]
    out = [None] * len(vectors)
    for i in sorted(range(len(vectors)), key=lambda i: -max(share[i])):
        product = [sum(left[b][d] * share[i][d] for d in range(3)) for b in range(bins)]
        out[i] = max(range(bins), key=lambda b: (product[b], -b))
        for d in range(3):
            left[out[i]][d] -= share[i][d]
    return out


def test_placing_rule():
    rng = random.Random(5)
    for bins in (1, 3, 16):
        vectors = [[rng.randint(1, 900), rng.randint(1, 90), rng.randint(1, 9)] for _ in range(120)]
        assert sharding.place(np.array(vectors, dtype=np.float64), bins).tolist() == plain_place(vectors, bins)
    assert sharding.place(np.zeros((0, 3)), 4).tolist() == []


def test_query(spark, table):
    sf = "/root/testdata/sf0.01"
    docs = [(r["doc_id"], r["text"]) for r in table("documents", sf)]
    df = QUERIES["op13_sharding"](spark, sf)
    assert dict(df.dtypes) == {
        "doc_id": "bigint", "size": "bigint", "text_crc32": "bigint", "law": "string", "shard": "int", "slot": "bigint", "grown_shard": "int",
    }
    places, loads = checked(df.collect(), docs)
    assert all(len(p) == 1 for p in places.values())
    assert (loads.max(axis=0) < 1.05 * loads.mean(axis=0)).all() and (loads.min(axis=0) > 0.95 * loads.mean(axis=0)).all()


def test_levels_of_blocks_balance_as_one(make_docs):
    rng = random.Random(3)
    docs = [(i, "x " * rng.choice([1, 5, 40, 300])) for i in range(3000)]
    docs = [(i, f"{i % 2500} {t}") for i, t in docs]
    rows = sharding.shard_rows(make_docs(docs), shards=4, block_items=300, bundles=40).collect()
    places, loads = checked(rows, docs, 4)
    assert all(len(p) == 1 for p in places.values())
    assert (loads.max(axis=0) < 1.01 * loads.mean(axis=0)).all()


def test_oversize_group_is_split_and_others_stay_whole(make_docs):
    docs = [(i, "the same") for i in range(1000)] + [(None, "the same")] * 500
    docs += [(5000 + i, f"other text {i % 900} of some length") for i in range(1800)]
    rows = sharding.shard_rows(make_docs(docs), shards=8).collect()
    places, loads = checked(rows, docs, 8)
    assert (loads.max(axis=0) < 1.03 * loads.mean(axis=0)).all() and (loads.min(axis=0) > 0.97 * loads.mean(axis=0)).all()
    hot = len("the same") + 1, zlib.crc32(b"the same")
    assert len(places.pop(hot)) == 8
    assert all(len(p) == 1 for p in places.values())


def test_cases(make_docs):
    docs = [(1, None), (2, ""), (None, None), (None, "é"), (3, "w" * 400_000), (3, "w" * 400_000), (3, "again")]
    places, _ = checked(sharding.shard_rows(make_docs(docs)).collect(), docs)
    empty = make_docs(docs).where("false")
    assert sharding.shard_rows(empty).count() == 0
    assert sharding.sharded(empty).count() == 0


def test_rows_and_files(spark, make_docs, tmp_path):
    docs = make_docs([(i, f"text {i % 40}") for i in range(200)])
    clash = docs.withColumnRenamed("block", "shard").withColumnRenamed("row", "item")
    sharding.write_shards(clash, str(tmp_path / "out"), shards=4)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert sorted(r.doc_id for r in back.collect()) == list(range(200))
    assert set(back.columns) == set(clash.columns)
    assert sorted(r.shard for r in back.select("shard").distinct().collect()) == [0, 1, 2, 3]
    assert back.groupBy("text").agg({"shard": "max"}).count() == back.select("text", "shard").distinct().count()

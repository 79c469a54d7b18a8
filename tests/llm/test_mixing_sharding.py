import math
import zlib
from collections import Counter

from quillon.llm import mixing, queries, sharding

SF = "/root/testdata/sf0.001"


def test_targets_fill_up_to_the_cap(spark):
    rows = [("a", 10, 1.0), ("b", 1000, 2.0), ("c", 1000, 3.0), (None, 0, 1.0), ("d", 0, 2.0)]
    found = {r.source: r for r in mixing.targets(spark.createDataFrame(rows, "source string, source_size long, weight double")).collect()}
    assert found["a"].target == 30 and found["a"].rate == 3.0
    assert math.isclose(sum(r.target for r in found.values()), 2010)
    assert math.isclose(found["b"].target / found["c"].target, 2 / 3) and found["d"].rate == 0


def test_weights_cycle_in_code_point_order(spark):
    rows = [(None, 1), ("b", 1), ("é", 1), ("B", 1), ("", 1)]
    found = mixing.cycled_weights(spark.createDataFrame(rows, "source string, source_size long"))
    assert {r.source: r.weight for r in found.collect()} == {"": 1, "B": 2, "b": 3, "é": 1, None: 2}


def test_mixed_rows_follow_the_rates(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").selectExpr("*", "1 AS row", "2 AS copies", "3 AS rate")
    counted = {r.doc_id: r for r in mixing.repetitions(docs).collect()}
    mixed = mixing.mix(docs)
    assert mixed.columns == docs.columns
    assert Counter(r.doc_id for r in mixed.collect()) == {d: r.copies for d, r in counted.items() if r.copies}
    assert all(math.floor(r.target / r.source_size) <= r.copies <= 3 for r in counted.values())


def test_mixing_edge_rows(spark):
    schema = "doc_id long, text string, source string"
    rows = [(1, None, "a"), (None, "x y", None), (2, "", "a"), (3, "w " * 40_000, "a"), (3, "w " * 40_000, "a")]
    found = mixing.repetitions(spark.createDataFrame(rows, schema)).collect()
    assert sorted(r.size for r in found) == [0, 0, 2, 40_000, 40_000]
    assert len({r.copies for r in found if r.doc_id == 3}) == 1
    assert mixing.mix(spark.createDataFrame([], schema)).count() == 0


def by_hand(rows, shards=40, seed=42):
    """rows: (doc_id, size, crc, source)"""
    import hashlib

    groups = {}
    for d, n, crc, source in rows:
        key = ":".join([str(seed), "null" if d is None else str(d), str(crc)])
        groups.setdefault("" if source is None else "s" + source, []).append((hashlib.md5(key.encode()).hexdigest(), d, crc, n))
    order = []
    for source, members in groups.items():
        for i, m in enumerate(sorted(members, key=lambda m: (m[0], m[1] is not None, m[1]))):
            order.append(((2 * i + 1) / (2 * len(members)), source.encode(), m))
    order.sort(key=lambda o: (o[0], o[1], o[2][0]))
    out, slots = [], Counter()
    for place, (_, _, (_, d, crc, n)) in enumerate(order):
        shard = place * shards // len(order)
        out.append((d, n, crc, shard, slots[shard]))
        slots[shard] += 1
    return sorted(out, key=str), slots


def test_sharding_query_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    rows = [(r.doc_id, len(r.text.encode()) + 16, zlib.crc32(r.text.encode()), r.source) for r in docs]
    expected, slots = by_hand(rows)
    found = queries.QUERIES["op7_sharding"](spark, SF).collect()
    assert sorted(((r.doc_id, r.size, r.text_crc32, r.shard, r.slot) for r in found), key=str) == expected
    assert max(slots.values()) - min(slots.values()) <= 1 and {r.law for r in found} == {"rows"}


def test_sharding_edge_rows(spark):
    schema = "doc_id long, text string, source string, shard int, row int"
    rows = [(None, None, None, 1, 1), (1, "", "a", 1, 1), (1, "", "a", 1, 1), (2, "é" * 50_000, None, 1, 1)]
    found = sharding.shard_rows(spark.createDataFrame(rows, schema), 3).collect()
    assert sorted(r.size for r in found) == [16, 16, 16, 100_016]
    assert sorted(Counter(r.shard for r in found).values()) == [1, 1, 2]
    assert sharding.shard_rows(spark.createDataFrame([], schema), 3).count() == 0


def test_sharded_documents_keep_every_copy(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(50)
    twice = docs.unionByName(docs).unionByName(docs.limit(7))
    found = sharding.sharded(twice, 4)
    assert found.columns == [*docs.columns, "shard", "slot"]
    rows = found.collect()
    assert Counter(r.doc_id for r in rows) == Counter(r.doc_id for r in twice.collect())
    assert len({(r.shard, r.slot) for r in rows}) == len(rows)

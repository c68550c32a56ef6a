"""Exact sizes, gapless slots, and uniformity of the shuffle."""

import zlib
from collections import Counter

import numpy as np

from turnwise.llm import queries, sharding


def test_matrix_sums():
    cells, blocks = np.array([5, 0, 17, 8]), np.array([10, 3, 0, 17])
    rows = np.array([sharding.matrix_row(cells, blocks, i, 3) for i in range(4)])
    assert rows.sum(axis=1).tolist() == cells.tolist() and rows.sum(axis=0).tolist() == blocks.tolist()


def test_matrix_is_hypergeometric():
    """Mean and variance of an entry, over seeds."""
    cells, blocks = np.array([30, 50, 20]), np.array([40, 60])
    got = np.array([sharding.matrix_row(cells, blocks, 1, s)[0] for s in range(4000)])
    assert abs(got.mean() - 50 * 0.4) < 0.2
    assert abs(got.var() - 50 * 0.4 * 0.6 * 50 / 99) < 0.5


def test_large_populations(monkeypatch):
    """The sampler for large populations against the library's, at a size both can do."""
    small = np.random.default_rng(1).hypergeometric(600, 400, 300, 20000)
    monkeypatch.setattr(sharding, "SMALL_POPULATION", 10)
    rng = np.random.default_rng(2)
    large = np.array([sharding._hypergeometric(600, 400, 300, rng) for _ in range(20000)])
    assert abs(small.mean() - large.mean()) < 0.3 and abs(small.var() / large.var() - 1) < 0.06
    assert sharding.split_counts(np.array([3 * 10**9, 10**9]), 10**9, rng).sum() == 10**9


def check(rows, n, shards):
    by_shard = Counter(r.shard for r in rows)
    assert len(rows) == n and all(by_shard[s] == n // shards + (s < n % shards) for s in range(shards))
    for s in by_shard:
        assert sorted(r.slot for r in rows if r.shard == s) == list(range(by_shard[s]))


def test_blocks(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(1000).selectExpr("id", "cast(null as string) shard").repartition(5).write.parquet(path)
    table = spark.read.parquet(path)
    rows = sharding.shuffle_to_shards(table, 7, block_rows=20).collect()
    check(rows, 1000, 7)
    assert sorted(r.id for r in rows) == list(range(1000))
    again = sharding.shuffle_to_shards(table, 7, block_rows=20).collect()
    assert sorted(rows) == sorted(again)
    check(sharding.shuffle_to_shards(table.limit(0), 7).collect(), 0, 7)


def test_uniform(spark, tmp_path):
    """Where a row lands does not depend on where it came from."""
    path = str(tmp_path / "t")
    spark.range(8).repartitionByRange(3, "id").write.parquet(path)
    table = spark.read.parquet(path)
    seen = np.zeros((8, 4))
    for seed in range(40):
        for r in sharding.shuffle_to_shards(table, 4, seed=seed).collect():
            seen[r.id, r.shard] += 1
    assert (seen.sum(axis=0) == 80).all()
    assert ((seen - 10) ** 2 / 10).sum() < 55  # 21 degrees of freedom


def test_query(spark, sf):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = queries.QUERIES["op1_sharding"](spark, sf).collect()
    check(rows, len(docs), 40)
    for r in rows:
        raw = (docs[r.doc_id] or "").encode()
        assert (r.size, r.text_crc32, r.law, r.grown_shard) == (len(raw) + 16, zlib.crc32(raw), "rows", None)


def test_nulls(spark):
    docs = spark.createDataFrame([(None, None), (1, ""), (1, ""), (2, "é")], "doc_id bigint, text string")
    rows = sharding.shard_table(docs, 2).collect()
    check(rows, 4, 2)
    assert sorted(r.size for r in rows) == [16, 16, 16, 18]


def test_deal_does_not_depend_on_how_the_rows_are_split(spark, tmp_path):
    """The scan is planned with other splits between the count and the deal, as after a lost executor."""
    path = str(tmp_path / "t")
    spark.range(20000).repartition(5).write.parquet(path)
    name, old = "spark.sql.files.maxPartitionBytes", spark.conf.get("spark.sql.files.maxPartitionBytes")
    dealt = sharding.shuffle_to_shards(spark.read.parquet(path), 7, block_rows=500)
    want = sorted(dealt.collect())
    try:
        spark.conf.set(name, "4096")
        spark.conf.set("spark.sql.files.openCostInBytes", "0")
        again = sharding.shuffle_to_shards(spark.read.parquet(path), 7, block_rows=500)
        rows = again.collect()
        spark.conf.set(name, "100")
        # The written cells are read in many more splits than they were counted in.
        more = again.union(again.limit(0)).collect()
    finally:
        spark.conf.set(name, old)
        spark.conf.unset("spark.sql.files.openCostInBytes")
    for got in (want, rows, more):
        check(got, 20000, 7)
        assert sorted(r.id for r in got) == list(range(20000))
    assert sorted(rows) == sorted(more)

import duckdb

from tillwise.llm import sharding
from tillwise.llm.queries import shard_sql


def run(docs, limit, **kw):
    return sorted(map(tuple, sharding.extendible_shards(docs, limit, **kw).collect()), key=repr)


def test_against_sql(spark, docs, docs_rows):
    import pandas as pd
    distinct = [r for r in docs_rows if r[0] != 3]  # rows equal in key and content are told apart by neither
    documents = pd.DataFrame(distinct, columns=["doc_id", "text", "lang", "source", "n_chars"])  # noqa: F841
    documents["doc_id"] = documents["doc_id"].astype("Int64")
    frame = spark.createDataFrame(distinct, docs.schema)
    con = duckdb.connect()
    con.register("documents", documents)
    for limit in (500, 3000, 10 ** 9):
        for first in (None, 1):  # one round, and several
            want = sorted([tuple(r) for r in con.sql(shard_sql(limit)).fetchall()], key=repr)
            assert run(frame, limit, first_depth=first) == want


def test_limits_and_odd_rows(spark, docs, empty_docs, clashing):
    rows = sharding.extendible_shards(docs, 2000).collect()
    assert len(rows) == docs.count()
    sizes = {}
    for r in rows:
        sizes[r["shard"]] = sizes.get(r["shard"], 0) + r["bytes"]
    for r in rows:
        assert sizes[r["shard"]] == r["shard_bytes"] and r["oversize"] == (r["shard_bytes"] > 2000)
        assert not r["oversize"] or r["shard_rows"] == 1 and r["bytes"] > 2000
    shards = sorted(sizes)
    assert not any(b.startswith(a) for a, b in zip(shards, shards[1:]))  # no shard within another
    same = spark.createDataFrame([(1, "x" * 100)] * 30, "doc_id long, text string")
    assert all(r["oversize"] and r["shard_rows"] == 30 for r in sharding.extendible_shards(same, 1000).collect())
    one_key = spark.createDataFrame([(1, f"{i:05}" * 20) for i in range(30)], "doc_id long, text string")
    assert all(r["shard_bytes"] <= 1000 for r in sharding.extendible_shards(one_key, 1000).collect())
    assert sharding.extendible_shards(empty_docs, 10).count() == 0
    assert run(clashing, 2000) == run(docs, 2000)


def test_written_shards(spark, docs, docs_rows, tmp_path):
    import pytest
    from pyspark.sql import functions as F
    rows = docs.withColumn("__address", F.lit("x"))
    shards = sharding.extendible_shards(rows, 3000)
    sharding.write_shards(rows, 3000, str(tmp_path / "out"))
    back = spark.read.option("mergeSchema", True).parquet(str(tmp_path / "out"))
    assert sorted(map(repr, back.select("doc_id", "text", "__address").collect())) == sorted(map(repr, rows.select("doc_id", "text", "__address").collect()))
    assert back.select("shard").distinct().count() == shards.select("shard").distinct().count()
    with pytest.raises(ValueError):
        sharding.write_shards(docs.withColumn("Shard", F.lit(1)), 3000, str(tmp_path / "no"))

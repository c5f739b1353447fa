from pathlib import Path

from pyspark.sql import functions as F

from lectern.operators import enrichment as enr
from lectern.sources import cache_table

AT = "2024-01-{:02d} 00:00:00"


def responses(spark, data, columns):
    df = spark.createDataFrame(data, ", ".join(f"{c} string" for c in columns))
    return df.withColumns({c: F.to_timestamp(c) for c in columns if c.endswith("_at")})


def files(path):
    return {str(f.relative_to(path)) for f in Path(path).rglob("*.parquet")}


def test_only_touched_buckets_change(spark, tmp_path):
    stored = ("cache_key", "fetched_at", "response_json", "expires_at")
    cache = responses(spark, [(f"k{i}", AT.format(1), f"old {i}", AT.format(10 + i % 3)) for i in range(40)], stored)
    path = str(tmp_path / "cache")
    cache_table.create(cache.unionByName(responses(spark, [(None, None, "no key", None)], stored)), path, 8)
    rows = lambda df: sorted(tuple(str(v) for v in r) for r in df.select(*stored).collect())
    assert rows(cache_table.read(spark, path)) == rows(cache)
    before = files(path)
    fresh = responses(spark, [("k3", AT.format(2), "older", ), ("k3", AT.format(5), "new"), ("new key", AT.format(6), "x"), (None, AT.format(6), "y")], stored[:3])
    touched = cache_table.upsert(fresh, path, 8)
    want = enr.cache_upsert(cache, fresh.where("cache_key is not null"))
    assert 1 <= len(touched) <= 2 and rows(cache_table.read(spark, path)) == rows(want)
    same = lambda names: {f for f in names if int(f.split("/")[0].split("=")[1]) not in touched}
    assert same(before) == same(files(path)) and not (before - same(before)) & files(path)
    now = F.to_timestamp(F.lit(AT.format(11)))
    assert cache_table.expire(spark, path, now)
    assert rows(cache_table.read(spark, path)) == rows(enr.cache_expire(want, now))
    cache_table.expire(spark, path, F.to_timestamp(F.lit("2025-01-01 00:00:00")))
    assert cache_table.read(spark, path).count() == 0
    assert cache_table.expire(spark, path, now) == [] and cache_table.upsert(fresh.limit(0), path, 8) == []
    cache_table.upsert(fresh, path, 8)
    assert sorted(r[0] for r in cache_table.read(spark, path).collect()) == ["k3", "new key"]

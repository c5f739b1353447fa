import gzip

import pytest
from pyspark.sql import functions as F

from lectern.operators import quality
from lectern.sources import readers, writers


def test_jsonl(spark, tmp_path):
    path = tmp_path / "a.json.gz"
    with gzip.open(path, "wt") as file:
        file.write('{"id":"1","n":[{"k":"v"}]}\n\n{"id":"2"}\n')
    rows = readers.read_jsonl(spark, str(path), "id string, n array<struct<k:string>>", 3)
    assert sorted(r["id"] for r in rows.collect()) == ["1", "2"] and rows.rdd.getNumPartitions() == 3
    with gzip.open(path, "at") as file:
        file.write("{broken\n")
    with pytest.raises(Exception):
        readers.read_jsonl(spark, str(path), "id string").collect()


def test_csv_readers(spark, tmp_path):
    good = tmp_path / "i.csv"
    good.write_text("rating,user_id,book_id,is_read,is_reviewed,extra\n5,1,2,1,0,x\n")
    rows = readers.read_interactions(spark, str(good))
    assert rows.dtypes == [("user_id", "bigint"), ("book_id", "bigint"), ("is_read", "tinyint"), ("rating", "tinyint"), ("is_reviewed", "tinyint")]
    assert tuple(rows.first()) == (1, 2, 1, 5, 0)
    (tmp_path / "short.csv").write_text("user_id,book_id\n1,2\n")
    with pytest.raises(ValueError, match="is_read"):
        readers.read_interactions(spark, str(tmp_path / "short.csv"))
    good.write_text("rating,user_id,book_id,is_read,is_reviewed\nfive,1,2,1,0\n")
    with pytest.raises(Exception):
        readers.read_interactions(spark, str(good)).collect()
    (tmp_path / "m.csv").write_text(f"book_id_csv,book_id\n0,{2**53 + 1}\nx,{2**63 - 1}\n12d,7.9\n")
    assert [tuple(r) for r in readers.read_id_map(spark, str(tmp_path / "m.csv")).collect()] == [(0, 2**53 + 1), (None, 2**63 - 1), (None, 7)]


def test_library_export(spark, tmp_path):
    path = tmp_path / "lib.csv"
    path.write_text(' Title ,Author,Exclusive Shelf,My Review\n"A, ""b""",,read,"two\nlines"\n')
    row = readers.read_library_export(spark, str(path)).first()
    assert row["Title"] == 'A, "b"' and row["Author"] == "" and row["My Review"] == "two\nlines" and row["ISBN13"] == "" and len(row) == 23
    path.write_text("Title,Author\na,b\n")
    with pytest.raises(ValueError, match="Exclusive Shelf"):
        readers.read_library_export(spark, str(path))


def test_policies_and_counts(spark, tmp_path):
    path = str(tmp_path / "t")
    writers.write_parquet(spark.range(5), path)
    with pytest.raises(Exception):
        writers.write_parquet(spark.range(1), path)
    writers.write_parquet(spark.range(1), path, policy="skip")
    assert writers.verify_row_count(spark, path, 5) == 5
    writers.write_parquet(spark.range(2), path, "gzip", "overwrite")
    with pytest.raises(RuntimeError):
        writers.verify_row_count(spark, path, 5)
    with pytest.raises(ValueError):
        writers.write_parquet(spark.range(2), path, "lzma")
    with pytest.raises(ValueError):
        writers.output_policy("append")


def test_partitioned(spark, tmp_path):
    path = str(tmp_path / "p")
    rows = spark.range(100).withColumn("user_bucket", F.when(F.col("id") < 70, 0).otherwise(F.col("id") % 4))
    # tiny partitions would be merged again
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    writers.write_partitioned(rows, path, files_per_bucket=3)
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    back = spark.read.parquet(path)
    assert back.count() == 100 and {r[0] for r in back.select("user_bucket").distinct().collect()} == {0, 1, 2, 3}
    assert len(list((tmp_path / "p" / "user_bucket=0").glob("*.parquet"))) > 1


def test_formats_and_tables(spark, tmp_path):
    rows = spark.createDataFrame([(1, 'q"x', [1, 2]), (2, None, None)], "a int, b string, c array<int>")
    paths = writers.write_multi_format(rows, str(tmp_path), "out")
    assert readers.read_table(spark, paths["parquet"]).count() == 2
    flat = spark.read.option("header", True).option("escape", '"').csv(paths["csv"]).orderBy("a").collect()
    assert (flat[0]["b"], flat[0]["c"]) == ('q"x', "[1,2]")
    assert spark.read.json(paths["json"]).count() == 2
    with pytest.raises(ValueError):
        readers.read_table(spark, "x.orc")


def test_types(spark):
    raw = spark.createDataFrame([("7", "x", "4.5", "True", ["a"]), ("1e2", None, "", "no", None)], "book_id string, num_pages string, average_rating string, is_ebook string, tags array<string>")
    first, second = readers.normalize_types(raw).collect()
    assert tuple(first) == (7, None, 4.5, True, '["a"]') and tuple(second) == (100, None, None, None, None)
    aligned = readers.align_schema(raw, {"book_id": "int", "new": "string"})
    assert [tuple(r) for r in aligned.collect()] == [(7, None), (None, None)]


def test_inventory_and_fingerprint(spark, tmp_path):
    path = str(tmp_path / "d")
    rows = spark.range(50).withColumn("x", F.col("id") * 2)
    rows.write.parquet(path)
    got = {r["source"]: r for r in writers.source_inventory(spark, {"d": path, "gone": str(tmp_path / "no")}).collect()}
    assert got["d"]["status"] == "FOUND" and got["d"]["bytes"] > 0 and got["gone"]["status"] == "MISSING" and got["gone"]["files"] == 0
    assert all(len(r["sha256"]) == 64 for r in writers.file_digests(spark, path).collect())
    one, two = (writers.content_fingerprint(r).first() for r in (rows, rows.orderBy(F.col("id").desc())))
    assert one == two and writers.content_fingerprint(rows.withColumn("x", F.lit(1))).first() != one


def test_digests_of_long_files_by_ranges(spark, tmp_path):
    import hashlib

    bodies = {"a": b"x" * 10, "b": bytes(range(256)) * 41, "d": b"y" * 1000}
    for name, body in bodies.items():
        (tmp_path / name).write_bytes(body)
    got = {r["path"].rpartition("/")[2]: r for r in writers.file_digests(spark, str(tmp_path), range_bytes=1000).collect()}
    own = lambda b: hashlib.sha256(b).hexdigest()
    for name, body in bodies.items():
        parts = [own(body[i:i + 1000]) for i in range(0, len(body), 1000)]
        assert got[name]["sha256"] == (own(body) if len(body) <= 1000 else own("".join(parts).encode())) and got[name]["length"] == len(body)


def test_ranges_of_files_over_two_gigabytes(spark):
    files = spark.createDataFrame([("f", 5 << 30), ("g", 1), ("h", 0)], "path string, length long")
    cut = sorted(tuple(r) for r in writers.byte_ranges(files, 1 << 30).collect())
    assert cut[:5] == [("f", 5 << 30, i, i << 30, (i + 1) << 30) for i in range(5)] and cut[5:] == [("g", 1, 0, 0, 1), ("h", 0, 0, 0, 0)]


def test_observed_writes(spark, tmp_path):
    seen = writers.write_observed(spark.range(100), str(tmp_path / "o"), F.max("id").alias("top"))
    assert seen == {"rows": 100, "top": 99}
    assert writers.write_verified(spark.range(7), str(tmp_path / "v")) == 7
    assert writers.write_verified(spark.range(0), str(tmp_path / "e")) == 0


def test_metrics_and_markdown(spark):
    measured = spark.range(4).agg(F.count("*").alias("rows"), F.max("id").alias("top"))
    assert {tuple(r) for r in writers.run_metrics("s", measured).collect()} == {("s", "rows", 4.0, None), ("s", "top", 3.0, None)}
    shares = spark.createDataFrame([("shelf", "read", 3), ("shelf", None, 1)], "column string, value string, rows bigint")
    told = {tuple(r)[1:] for r in writers.run_metrics("s", measured, {"top": 5, "policy": "skip"}, 1.5, shares).collect()}
    assert told >= {("setting.top", 5.0, "5"), ("setting.policy", None, "skip"), ("seconds", 1.5, None), ("shelf.read", 3.0, None), ("shelf.", 1.0, None)}
    told = spark.createDataFrame([(1, 2, "T", None, " ", 0.5, "Why.")], "user_id int, rank int, title string, primary_author string, primary_genre string, recommendation_score double, explanation string")
    assert writers.markdown_report(told).first()["markdown"] == "## 2. T\n\n**Author:** Unknown author\n**Model:** recommendation score 0.500\n\nWhy.\n"


def test_gates(spark):
    table = spark.createDataFrame([(1, 0.5), (2, None)], "book_id int, wilson_score double")
    bad = spark.createDataFrame([(3, 1.5)], table.schema)
    assert quality.q_wilson_range(table).first()["passed"] and not quality.q_wilson_range(bad).first()["passed"]
    assert quality.q_rows(table, table).first()["passed"] and not quality.q_rows(table, bad).first()["passed"]
    assert quality.q_docs_vectors(table, table).first()["passed"] and not quality.q_docs_vectors(table, bad).first()["passed"]
    assert quality.q_nonempty(table).first()["passed"] and not quality.q_nonempty(table.limit(0)).first()["passed"]
    quality.require(quality.q_nonempty(table))
    with pytest.raises(RuntimeError):
        quality.require(quality.q_nonempty(table.limit(0)))
    near = spark.createDataFrame([(1, 1, 1, 0.99)], "query_id int, book_id int, rank int, similarity double")
    assert not quality.q_self_neighbour(near).first()["passed"]

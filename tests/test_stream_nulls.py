from workload import store_queries


def test_rows_without_seq_reach_the_stream(spark, tmp_path):
    rows = spark.createDataFrame([(1, "a"), (2, "b"), (None, "c"), (3, "d")], "seq long, url string")
    output = str(tmp_path / "out")

    def job(stream):
        return stream.writeStream.format("parquet").option("path", output).option("checkpointLocation", str(tmp_path / "checkpoint"))

    store_queries._in_parts(rows, str(tmp_path / "in"), job)
    assert sorted(r.url for r in spark.read.parquet(output).collect()) == ["a", "b", "c", "d"]

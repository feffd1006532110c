from holdwright.streaming import monitor


def test_stream_equals_batch(spark, sf, tmp_path):
    e = spark.read.parquet(f"{sf}/events.parquet").selectExpr("cast(user_id as string) as key", "event_type as accession", "ts as at")
    parts = e.orderBy("at").collect()
    schema, src = e.schema, str(tmp_path / "in")
    for k in range(3):
        spark.createDataFrame(parts[k * len(parts) // 3 : (k + 1) * len(parts) // 3], schema).coalesce(1).write.mode("append").parquet(src)
        q = monitor.changes_stream(spark.readStream.schema(schema).parquet(src)).writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
        q.awaitTermination()
    key = lambda d: sorted((r.key, r.accession, r.previous, r["at"]) for r in d.collect())
    want = key(monitor.changes_batch(e))
    assert key(spark.read.parquet(str(tmp_path / "out"))) == want and want


def test_refresh_gets_changed_keys(spark, tmp_path):
    src, seen = str(tmp_path / "in"), []
    rows = [("a", "1", 1), ("a", "2", 2), ("b", "1", 1)]
    df = spark.createDataFrame(rows, "key string, accession string, t long").selectExpr("key", "accession", "timestamp_seconds(t) as at")
    df.coalesce(1).write.parquet(src)
    q = monitor.refresh(spark.readStream.schema(df.schema).parquet(src), lambda keys, i: seen.extend(r.key for r in keys.collect()), str(tmp_path / "cp"))
    q.processAllAvailable()
    q.stop()
    assert seen == ["a"]

from harborline.streaming import drops


def test_windows_over_a_stream(spark, tmp_path):
    path = str(tmp_path / "in")
    rows = [(1, "2024-01-01 00:10:00", "view", 1.5), (2, "2024-01-01 00:50:00", "view", 2.0),
        (3, "2024-01-01 05:00:00", "click", 1.0)]
    spark.createDataFrame(rows, "event_id int, t string, event_type string, value double").selectExpr("event_id",
        "timestamp(t) ts", "event_type", "value").write.parquet(path)
    stream = spark.readStream.schema("event_id int, ts timestamp, event_type string, value double").parquet(path)
    q = drops.event_windows(stream).writeStream.outputMode("complete").format("memory").queryName("win").start()
    q.processAllAvailable()
    q.stop()
    got = {(str(r.window_start), r.event_type): (r.n, r.total_value) for r in spark.table("win").collect()}
    assert got == {("2024-01-01 00:00:00", "view"): (2, 3.5), ("2024-01-01 05:00:00", "click"): (1, 1.0)}


def test_folder_watch(spark, tmp_path):
    drop = tmp_path / "drop"
    drop.mkdir()
    (drop / "a.csv").write_text("k,v\nx,1\ny,2\n")
    seen = []
    for name in ("b.csv", None):
        q = drops.watch_folder(spark, str(drop), "k string, v int", lambda df, i: seen.append(df.count()),
            str(tmp_path / "ck"))
        q.awaitTermination()
        if name:
            (drop / name).write_text("k,v\nz,3\n")
    assert seen == [2, 1]

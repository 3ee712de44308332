"""A table kept current from a stream of changes."""

from waymark.streaming.changes import keep_table


def test_last_change_of_a_key_wins(spark, tmp_path):
    schema = "k int, v string, at int"
    source, state = str(tmp_path / "in"), str(tmp_path / "state")
    for number, rows in enumerate([[(1, "a", 1), (1, "b", 2), (2, "c", 1)], [(2, "d", 3), (3, "e", 1)]]):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(schema).parquet(source)
        query = keep_table(stream, state, ["k"], "at", str(tmp_path / "checkpoint"))
        query.processAllAvailable()
        query.stop()
        got = {r["k"]: r["v"] for r in spark.read.parquet(f"{state}/version={number}").collect()}
        assert got == [{1: "b", 2: "c"}, {1: "b", 2: "d", 3: "e"}][number]

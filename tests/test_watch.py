from datetime import datetime, timedelta

from corpusloom.streaming import stages

START = datetime(2024, 1, 1)


def at(s):
    return START + timedelta(seconds=s)


def test_states_of_runs(spark, tmp_path):
    schema = "run string, at timestamp, kind string"
    batches = [
        [("a", 0, "log"), ("b", 0, "log"), ("c", 5, "log"), ("d", 40, "exit"), ("a", 90, "log"), ("d", 10, "log")],
        [("b", 350, "done"), ("c", 200, "log")],
        [("a", 400, "log"), ("b", 401, "log"), ("e", 600, "log"), ("d", 120, "log")],  # the last one is late
    ]
    for k, rows in enumerate(batches):
        spark.createDataFrame([(r, at(s), kind) for r, s, kind in rows], schema).write.parquet(f"{tmp_path}/in/{k}")
        stages.watch(spark.readStream.schema(schema).parquet(f"{tmp_path}/in/*"), f"{tmp_path}/out", f"{tmp_path}/check", 100)
    got = {}
    for r in spark.read.parquet(f"{tmp_path}/out").orderBy("run", "at").collect():
        got.setdefault(r.run, []).append((int((r.at - START).total_seconds()), r.state))
    assert got == {
        "a": [(0, "running"), (190, "stalled"), (400, "running"), (500, "stalled")],
        "b": [(0, "running"), (100, "stalled"), (350, "finished")],
        "c": [(5, "running"), (105, "stalled"), (200, "running"), (300, "stalled")],
        "d": [(10, "running"), (40, "gone")],
        "e": [(600, "running")],
    }

from datetime import date


from helpers import as_set
from dailybars import schemas
from dailybars.sources.landed import cast_bars
from dailybars.streaming.landing import landed_stream, load_new_files


def land(spark, path, rows, files=1):
    frame = spark.createDataFrame(rows, schemas.LANDED)
    frame.repartition(files).write.mode("append").parquet(path)
    return frame


def bar(symbol, day, close):
    return (day, 1.0, 2.0, 0.5, close, 10.0, symbol)


def run(spark, store, landing, checkpoint, **more):
    stream = landed_stream(spark, landing, max_files_per_batch=more.pop("files", None))
    query = load_new_files(store, stream, checkpoint, **more)
    query.awaitTermination()
    return query


def test_stream_equals_batch(spark, store, tmp_path):
    landing, checkpoint = str(tmp_path / "landing"), str(tmp_path / "checkpoint")
    first = land(spark, landing, [bar(s, f"2024-01-{d:02d}", 1.0) for s in "AB" for d in range(1, 9)], 3)
    run(spark, store, landing, checkpoint)
    second = land(spark, landing, [bar("A", "2024-01-08", 9.0), bar("C", "2024-02-01", 3.0)])
    run(spark, store, landing, checkpoint)
    got = as_set(store.read("raw_bars"))
    batch = cast_bars(first).join(cast_bars(second), schemas.KEY, "left_anti").unionByName(cast_bars(second))
    assert got == as_set(batch.select(*schemas.BAR_COLUMNS))
    files = set(store.read("raw_bars").inputFiles())
    run(spark, store, landing, checkpoint)  # nothing new
    assert set(store.read("raw_bars").inputFiles()) == files


def test_small_batches_give_the_same(spark, store, tmp_path):
    landing = str(tmp_path / "landing")
    rows = [bar(s, f"2024-01-{d:02d}", float(d)) for s in "AB" for d in range(1, 5)]
    land(spark, landing, rows, 4)
    query = run(spark, store, landing, str(tmp_path / "checkpoint"), files=1)
    assert len([p for p in query.recentProgress if p["numInputRows"]]) > 1
    assert {(r.symbol, r.dt.day, r.close) for r in store.read("raw_bars").collect()} == {
        (s, d, float(d)) for s in "AB" for d in range(1, 5)
    }


def test_batch_that_is_run_again_changes_nothing(spark, store, tmp_path):
    landing = str(tmp_path / "landing")
    land(spark, landing, [bar("A", "2024-01-01", 1.0), bar("B", "2024-01-01", 2.0)])
    run(spark, store, landing, str(tmp_path / "one"))
    before = as_set(store.read("raw_bars"))
    run(spark, store, landing, str(tmp_path / "two"))  # a lost checkpoint: all files are new again
    assert as_set(store.read("raw_bars")) == before


def test_limits_of_a_run(spark, store, tmp_path):
    landing = str(tmp_path / "landing")
    land(spark, landing, [bar(s, d, 1.0) for s in "AB" for d in ("2024-01-01", "2024-01-02")])
    run(spark, store, landing, str(tmp_path / "c"), symbols=["A"], start=date(2024, 1, 2))
    assert {(r.symbol, r.dt.day) for r in store.read("raw_bars").collect()} == {("A", 2)}


def test_an_older_row_in_a_later_batch_changes_nothing(spark, store, tmp_path):
    landing, checkpoint = str(tmp_path / "landing"), str(tmp_path / "checkpoint")
    schema = schemas.schema(**{f.name: f.dataType.simpleString() for f in schemas.LANDED}, revision="bigint")

    def deliver(*rows):
        frame = spark.createDataFrame([(*bar(s, day, close), revision) for s, day, close, revision in rows], schema)
        frame.coalesce(1).write.mode("append").parquet(landing)
        load_new_files(store, landed_stream(spark, landing, schema=schema), checkpoint, revision="revision").awaitTermination()
        return {(r.symbol, r.dt.day): r.close for r in store.read("raw_bars").collect()}

    deliver(("A", "2024-01-01", 1.0, 5), ("B", "2024-01-01", 2.0, None))
    got = deliver(("A", "2024-01-01", 9.0, 4), ("A", "2024-01-02", 3.0, 4), ("B", "2024-01-01", 7.0, 1))
    assert got == {("A", 1): 1.0, ("A", 2): 3.0, ("B", 1): 7.0}
    got = deliver(("A", "2024-01-01", 6.0, 5), ("A", "2024-01-02", 8.0, None))
    assert got == {("A", 1): 6.0, ("A", 2): 3.0, ("B", 1): 7.0}

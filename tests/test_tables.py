from datetime import date

import pytest
from pyspark.sql import functions as F

from helpers import as_set
from dailybars import schemas
from dailybars.operators.merge import latest_per_key, merge_rows, without
from dailybars.sources.materialize import materialize
from dailybars.sources.tables import DuplicateKeys, MissingKeys, OtherLocation, TableStore

JAN, FEB = date(2024, 1, 5), date(2024, 2, 5)


def closes(frame):
    return {(r.symbol, r.dt, r.close) for r in frame.collect()}


def test_upsert_updates_inserts_and_keeps(store, make_bars):
    store.upsert("raw_bars", make_bars([("A", JAN, 1.0), ("A", FEB, 2.0), ("B", FEB, 3.0)]))
    n = store.upsert("raw_bars", make_bars([("A", FEB, 20.0), ("C", FEB, 4.0)]))
    assert n == 2
    expected = {("A", JAN, 1.0), ("A", FEB, 20.0), ("B", FEB, 3.0), ("C", FEB, 4.0)}
    assert closes(store.read("raw_bars")) == expected
    store.upsert("raw_bars", make_bars([("A", FEB, 20.0), ("C", FEB, 4.0)]))
    assert closes(store.read("raw_bars")) == expected


def test_matched_row_takes_null_values(store, make_bars):
    store.upsert("raw_bars", make_bars([("A", JAN, 1.0)]))
    store.upsert("raw_bars", make_bars([("A", JAN, None, None, None, None, None)]))
    assert as_set(store.read("raw_bars")) == {("A", JAN, None, None, None, None, None)}


def test_two_rows_for_a_key_are_refused(store, make_bars):
    store.upsert("raw_bars", make_bars([("A", JAN, 1.0)]))
    with pytest.raises(DuplicateKeys, match="'B'"):
        store.upsert("raw_bars", make_bars([("B", JAN, 1.0), ("B", JAN, 2.0)]))
    assert closes(store.read("raw_bars")) == {("A", JAN, 1.0)}


def test_last_of_two_rows_wins_on_request(store, make_bars):
    rows = make_bars([("B", JAN, 1.0), ("B", JAN, 2.0), ("B", FEB, 5.0)]).withColumn(
        "seen", F.col("close") * -1
    )
    assert store.upsert("raw_bars", rows, order_by="seen") == 3
    assert closes(store.read("raw_bars")) == {("B", JAN, 1.0), ("B", FEB, 5.0)}


def test_latest_row_is_taken_whole(spark):
    rows = spark.createDataFrame(
        [("A", 1, None, 9), ("A", 2, 5, None), ("B", 1, 7, 7)], "k string, o int, x int, y int"
    )
    assert as_set(latest_per_key(rows, "o", ["k"])) == {("A", 2, 5, None), ("B", 1, 7, 7)}


def test_row_without_key_is_refused(store, make_bars, spark):
    rows = spark.createDataFrame([(None, JAN, 1.0, 1.0, 1.0, 1.0, 1)], schemas.RAW_BARS)
    with pytest.raises(MissingKeys):
        store.upsert("raw_bars", rows)
    assert not store.exists("raw_bars")


def test_failing_load_changes_nothing(store, make_bars):
    store.upsert("raw_bars", make_bars([("A", JAN, 1.0)]))
    broken = make_bars([("A", JAN, 2.0), ("B", JAN, 1.0)]).withColumn(
        "close", F.when(F.col("symbol") == "B", F.raise_error(F.lit("boom"))).otherwise(F.col("close"))
    )
    with pytest.raises(Exception, match="boom"):
        store.upsert("raw_bars", broken)
    assert closes(store.read("raw_bars")) == {("A", JAN, 1.0)}


def test_odd_symbols_stay_as_they_are(store, make_bars):
    store.upsert("raw_bars", make_bars([("BRK.B", JAN, 1.0), ("007", JAN, 2.0), ("a/b=c", JAN, 3.0)]))
    frame = store.read("raw_bars")
    assert frame.schema == schemas.RAW_BARS
    assert {r.symbol for r in frame.collect()} == {"BRK.B", "007", "a/b=c"}


def test_ensure_creates_empty_and_leaves_the_rest(store, make_bars):
    store.ensure()
    assert store.read("raw_bars").schema == schemas.RAW_BARS
    assert store.read("final").count() == 0
    store.upsert("raw_bars", make_bars([("A", JAN, 1.0)]))
    store.ensure()
    assert store.read("raw_bars").count() == 1


def test_limits_leave_other_months_unopened(store, make_bars):
    store.upsert("raw_bars", make_bars([("A", JAN, 1.0), ("A", FEB, 2.0), ("A", date(2024, 3, 1), 3.0)]))
    rows = store.read("raw_bars", since=date(2024, 2, 1), until=date(2024, 2, 29))
    assert closes(rows) == {("A", FEB, 2.0)}
    assert all("month=2024-02" in path for path in rows.inputFiles())
    assert store.read("raw_bars", since=date(2024, 2, 6)).count() == 1


def test_delete_can_empty_a_month(store, make_bars):
    store.upsert("raw_bars", make_bars([("A", JAN, 1.0), ("A", FEB, 2.0)]))
    store.delete("raw_bars", F.col("dt") >= F.lit(FEB))
    assert closes(store.read("raw_bars")) == {("A", JAN, 1.0)}
    assert store.months("raw_bars") == {"2024-01"}
    store.delete("raw_bars", F.col("dt") >= F.lit(FEB))
    assert closes(store.read("raw_bars")) == {("A", JAN, 1.0)}


def test_delete_keeps_rows_of_unknown_truth(spark):
    rows = spark.createDataFrame([(1,), (None,)], "x int")
    assert as_set(without(rows, F.col("x") > 0)) == {(None,)}


def test_rewrite_outside_the_months_read_is_refused(store, make_bars):
    store.upsert("raw_bars", make_bars([("A", JAN, 1.0), ("A", FEB, 2.0)]))
    with pytest.raises(ValueError, match="2024-01"):
        store.rewrite_from("raw_bars", FEB, lambda rows: rows.unionByName(make_bars([("B", JAN, 1.0)])))
    assert store.read("raw_bars").count() == 2


def test_overwrite_from_the_table_itself(store, make_bars):
    store.upsert("raw_bars", make_bars([("A", JAN, 1.0), ("A", FEB, 2.0)]))
    store.overwrite("raw_bars", store.read("raw_bars").where(F.col("dt") == F.lit(FEB)))
    assert closes(store.read("raw_bars")) == {("A", FEB, 2.0)}


def test_views_answer_sql(store, make_bars, spark):
    store.upsert("raw_bars", make_bars([("A", JAN, 1.0)]))
    store.register_views(["raw_bars"])
    assert spark.sql("SELECT close FROM raw_bars WHERE symbol = 'A'").first()[0] == 1.0


def test_kinds_of_materialization(store, make_bars, spark):
    bars = make_bars([("A", JAN, 1.0)])
    assert materialize(bars, "x", "inline") is bars
    materialize(bars, "kept_as_view", "view")
    assert spark.table("kept_as_view").count() == 1
    assert closes(materialize(bars, "raw_bars", "table", store)) == {("A", JAN, 1.0)}
    with pytest.raises(ValueError):
        materialize(bars, "x", "cube")


def test_merge_is_update_or_insert(make_bars):
    merged = merge_rows(make_bars([("A", JAN, 1.0), ("B", JAN, 2.0)]), make_bars([("B", JAN, 9.0), ("C", JAN, 3.0)]))
    assert closes(merged) == {("A", JAN, 1.0), ("B", JAN, 9.0), ("C", JAN, 3.0)}


def test_rows_are_evaluated_once(spark, store):
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    rows = spark.range(200).selectExpr(
        "concat('S', id % 5) AS symbol", "date_add(DATE '2024-01-01', CAST(id AS INT)) AS dt",
        "1.0D AS open", "1.0D AS high", "1.0D AS low", "1.0D AS close", "id AS volume",
    )
    store.overwrite("raw_bars", rows.mapInArrow(counted, schemas.RAW_BARS))
    assert seen.value == 200
    assert store.read("raw_bars").count() == 200
    assert all(len(paths) == 1 for paths in files_by_month(store).values())


def files_by_month(store):
    out = {}
    for path in store.read("raw_bars").inputFiles():
        out.setdefault(path.split("month=")[1].split("/")[0], []).append(path)
    return out


def test_ties_in_the_order_are_refused(store, make_bars):
    rows = make_bars([("B", JAN, 1.0), ("B", JAN, 2.0)]).withColumn("seen", F.lit(1))
    with pytest.raises(DuplicateKeys, match="'B'"):
        store.upsert("raw_bars", rows, order_by="seen")
    older = make_bars([("B", JAN, 1.0), ("B", JAN, 2.0), ("B", JAN, 3.0)])
    older = older.withColumn("seen", F.when(F.col("close") < 3, 1).otherwise(2))
    assert store.upsert("raw_bars", older, order_by="seen") == 3
    assert closes(store.read("raw_bars")) == {("B", JAN, 3.0)}


def test_untouched_months_are_not_rewritten(store, make_bars):
    store.upsert("raw_bars", make_bars([("A", JAN, 1.0), ("A", FEB, 2.0)]))
    before = files_by_month(store)
    store.upsert("raw_bars", make_bars([("B", FEB, 2.0)]))
    after = files_by_month(store)
    assert after["2024-01"] == before["2024-01"]
    assert after["2024-02"] != before["2024-02"]


def test_replacing_symbols_leaves_other_months_alone(store, spark):
    def final(symbol, day):
        return spark.createDataFrame([(symbol, day, *[1.0] * 4, 1, "RAW", None, None, None, None)], schemas.FINAL)

    store.overwrite("final", final("A", JAN).unionByName(final("B", JAN)).unionByName(final("C", FEB)))
    before = store.read("final", since=FEB).inputFiles()
    store.replace_symbols("final", ("A", "B"), final("A", date(2024, 3, 5)))
    assert store.months("final") == {"2024-02", "2024-03"}
    assert set(before) < set(store.read("final").inputFiles())
    assert {(r.symbol, r.dt) for r in store.read("final").collect()} == {("A", date(2024, 3, 5)), ("C", FEB)}


def test_any_reader_of_the_catalog_or_the_folders_sees_the_rows(store, make_bars, spark):
    store.upsert("raw_bars", make_bars([("A", JAN, 1.0), ("A", FEB, 2.0)]))
    store.upsert("raw_bars", make_bars([("A", FEB, 3.0)]))
    want = {("A", JAN, 1.0), ("A", FEB, 3.0)}
    assert closes(spark.sql(f"SELECT * FROM {store.full_name('raw_bars')}")) == want
    assert closes(spark.read.parquet(store.folder("raw_bars"))) == want
    assert closes(spark.newSession().table(store.full_name("raw_bars"))) == want
    store.delete("raw_bars", F.col("dt") == F.lit(FEB))
    assert closes(spark.read.parquet(store.folder("raw_bars"))) == {("A", JAN, 1.0)}


def test_tables_are_found_again_without_their_catalog(store, make_bars, spark):
    store.upsert("raw_bars", make_bars([("A", JAN, 1.0), ("A", FEB, 2.0)]))
    store.overwrite("models", spark.createDataFrame([("A", *[None] * 19)], schemas.MODELS))
    spark.sql(f"DROP DATABASE {store.schema_name('raw_bars')} CASCADE")
    again = TableStore(spark, store.root)
    assert closes(again.read("raw_bars")) == {("A", JAN, 1.0), ("A", FEB, 2.0)}
    assert again.read("models").count() == 1
    assert not again.exists("final")


def test_a_name_with_files_elsewhere_is_refused(store, spark, tmp_path, make_bars):
    store.upsert("raw_bars", make_bars([("A", JAN, 1.0)]))
    other = TableStore(spark, str(tmp_path / "other"), {"raw_bars": store.schema_name("raw_bars")})
    with pytest.raises(OtherLocation):
        other.read("raw_bars")


def interrupted(store, monkeypatch, change):
    """A change whose insert dies after the rows are staged."""

    def dies(*_):
        raise RuntimeError("driver lost")

    with monkeypatch.context() as patch:
        patch.setattr(TableStore, "_insert", dies)
        with pytest.raises(RuntimeError):
            change()


def test_an_interrupted_change_is_finished_first(store, make_bars, monkeypatch):
    store.upsert("raw_bars", make_bars([("A", JAN, 1.0), ("A", FEB, 2.0), ("B", FEB, 2.0)]))
    interrupted(store, monkeypatch, lambda: store.upsert("raw_bars", make_bars([("A", JAN, 5.0), ("A", FEB, 5.0)])))
    # The swap had got as far as losing a month.
    store._remove(f"{store.folder('raw_bars')}/month=2024-02")
    assert store.upsert("raw_bars", make_bars([("C", JAN, 7.0)])) == 1
    want = {("A", JAN, 5.0), ("A", FEB, 5.0), ("B", FEB, 2.0), ("C", JAN, 7.0)}
    assert closes(store.read("raw_bars")) == want
    assert not store.repair("raw_bars")


def test_an_interrupted_delete_is_repaired(store, make_bars, monkeypatch):
    store.upsert("raw_bars", make_bars([("A", JAN, 1.0), ("A", FEB, 2.0)]))
    interrupted(store, monkeypatch, lambda: store.delete("raw_bars", F.col("dt") == F.lit(FEB)))
    assert closes(store.read("raw_bars")) == {("A", JAN, 1.0), ("A", FEB, 2.0)}
    assert store.repair("raw_bars")
    assert closes(store.read("raw_bars")) == {("A", JAN, 1.0)} and store.months("raw_bars") == {"2024-01"}


def test_unfinished_staging_is_no_change(store, make_bars):
    store.upsert("raw_bars", make_bars([("A", JAN, 1.0)]))
    make_bars([("A", JAN, 9.0)]).write.parquet(store._staging("raw_bars"))
    store._remove(f"{store._staging('raw_bars')}/_SUCCESS")
    assert not store.repair("raw_bars")
    store.upsert("raw_bars", make_bars([("B", JAN, 2.0)]))
    assert closes(store.read("raw_bars")) == {("A", JAN, 1.0), ("B", JAN, 2.0)}


def test_rerun_after_a_crash_gives_the_same(store, make_bars, monkeypatch):
    first = make_bars([("A", JAN, 1.0), ("A", FEB, 2.0)])
    second = make_bars([("A", FEB, 3.0), ("B", JAN, 4.0)])
    store.upsert("raw_bars", first)
    interrupted(store, monkeypatch, lambda: store.upsert("raw_bars", second))
    store.upsert("raw_bars", second)
    assert closes(store.read("raw_bars")) == {("A", JAN, 1.0), ("A", FEB, 3.0), ("B", JAN, 4.0)}


def test_session_setting_is_as_before(store, make_bars, spark):
    store.upsert("raw_bars", make_bars([("A", JAN, 1.0)]))
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode").lower() == "static"


def test_kept_results_can_be_removed(store, make_bars):
    one, two = store.keep(make_bars([("A", JAN, 1.0)])), store.keep(make_bars([]))
    assert (one.count(), two.count()) == (1, 0)
    with store.kept(make_bars([("A", JAN, 1.0)])) as rows:
        folder = rows.inputFiles()[0].rsplit("/", 1)[0]
        assert rows.count() == 1
    assert not store._there(folder)
    store.clear_kept()
    assert not store._there(f"{store.root}/_kept")

import dataclasses
import datetime as dt
import pathlib

import pytest
from pyspark.sql import functions as F

from vintora.params import FINAL_STATES
from vintora.plans import build, nightly, quality
from vintora.plans.book import Book
from vintora.sources import contracts, intake, load, rejects
from vintora.sources.parts import PartedTable
from vintora.sources.schemas import STAGING, conform, schema_of
from vintora.streaming import jobs
from vintora.streaming.jobs import Mutable


def t(day, hour=0):
    return dt.datetime(2024, 1, day, hour)


def test_every_schema_parses(spark):
    assert all(len(schema_of(name)) for name in STAGING)


def test_conform_casts_fills_and_drops(spark):
    df = spark.createDataFrame([("7", "oops", 1)], "ruta STRING, extra STRING, pais INT")
    out = conform(df, "route_mapping").first()
    assert out.asDict() == {"ruta": "7", "equipo": None, "oficina": None, "region": None,
                            "pais": "1"}
    texts = spark.createDataFrame([("x", "1.5"), ("9", "no")], "id_cliente STRING, p STRING")
    assert [r["id_cliente"] for r in conform(texts, "service_profile").collect()] == [None, 9]


def test_flatten_one_level(spark):
    df = spark.sql("SELECT 1 AS id, named_struct('a', 1, 'b', named_struct('c', 2)) AS s,"
                   " array(1, 2) AS list")
    assert load.flatten(df).first().asDict() == {"id": 1, "s_a": 1, "s_b": '{"c":2}',
                                                 "list": "[1,2]"}


def test_contract_rejects_missing_columns(spark, tmp_path):
    path = tmp_path / "a.csv"
    path.write_text("Id cliente,other\n1,x\n")
    with pytest.raises(load.BrokenContract, match="missing columns"):
        load.read_contract(spark, str(path), {"Id cliente": "id", "profile": "p"})


def test_ordered_header(spark, tmp_path):
    path = tmp_path / "b.csv"
    path.write_text("id,Ruta,ruta\n1,nan,R1\n2, 0 ,R2\n")
    rows = load.read_ordered(spark, str(path), ["id", "Ruta", "ruta"], ["id", "first", "second"],
                             "id", ["id"]).orderBy("id").collect()
    assert [tuple(r) for r in rows] == [(1.0, None, "R1"), (2.0, None, "R2")]
    path.write_text("id,v\n1,0\n2,nan\n3,7\n")
    rows = load.read_ordered(spark, str(path), ["id", "v"], ["id", "v"], "id", ["v"]).collect()
    assert [(r["id"], r["v"] == 0, r["v"]) for r in rows if r["id"] != "2"] == [
        ("1", True, 0.0), ("3", False, 7.0)]
    path.write_text("id,v\nx1,0\n")
    with pytest.raises(load.BrokenContract, match="no number"):
        load.read_ordered(spark, str(path), ["id", "v"], ["id", "v"], "id", ["id"])
    with pytest.raises(load.BrokenContract, match="header"):
        load.read_ordered(spark, str(path), ["id", "ruta", "Ruta"], ["a", "b", "c"], "a", [])
    path.write_text("id,v\n1,x\n1,y\n")
    with pytest.raises(load.BrokenContract, match="repeated"):
        load.read_ordered(spark, str(path), ["id", "v"], ["id", "v"], "id", [])


def test_replace_is_all_or_nothing(spark, tmp_path):
    table = load.VersionedTable(spark, str(tmp_path / "t"))
    assert not table.exists()
    table.replace(spark.range(5))
    reader = table.read()
    with pytest.raises(load.EmptyLoad):
        table.replace(spark.range(0))
    assert table.read().count() == 5
    # A version without its marker is a load that died half way.
    spark.range(99).write.parquet(str(tmp_path / "t" / "v7"))
    assert table.read().count() == 5
    table.replace(table.read().filter("id < 2"))
    assert table.read().count() == 2 and reader.count() == 5

    def refuse(df):
        raise ValueError(df.count())
    with pytest.raises(ValueError, match="3"):
        table.replace(spark.range(3), check=refuse)
    assert table.read().count() == 2
    for n in range(4, 8):
        table.replace(spark.range(n), keep=2)
    assert len(table.versions()) == 2 and table.read().count() == 7


def test_window_replace(spark):
    schema = "k STRING, at TIMESTAMP_NTZ, s STRING, v INT"
    current = spark.createDataFrame(
        [("a", t(1), "done", 1), ("b", t(1), None, 1), ("c", t(9), "done", 1), (" ", t(1), "x", 1)],
        schema)
    cutoff = F.lit(t(5)).cast("timestamp_ntz")
    refresh = load.refresh_keys(current, "k", "s", ("done",), "at", cutoff)
    assert [r["k"] for r in refresh.collect()] == ["b"]
    source = spark.createDataFrame(
        [("a", t(1), "done", 2), ("b", t(1), "done", 2), ("c", t(9), "done", 2)], schema)
    incoming = load.window_or_keys(source, "at", cutoff, "k", refresh)
    after = load.window_replace(current, incoming, "at", cutoff, "k", refresh)
    assert sorted((r["k"], r["v"]) for r in after.collect()) == [
        (" ", 1), ("a", 1), ("b", 2), ("c", 2)]


@pytest.mark.parametrize("full, windowed, last, mode", [
    (True, True, t(30), "full"), (False, False, t(30), "full"), (False, True, None, "full"),
    (False, True, t(1), "full"), (False, True, t(2), "window")])
def test_load_mode(full, windowed, last, mode):
    assert load.load_mode(full, windowed, last, t(31), 30) == mode


def test_run_log_is_idempotent(spark):
    log = spark.createDataFrame([(t(1), "a", 1)], "started_at TIMESTAMP_NTZ, table_name STRING, n INT")
    new = spark.createDataFrame([(t(1), "a", 9), (t(2), "a", 2)], log.schema)
    once = load.append_new(log, new, ["started_at", "table_name"])
    twice = load.append_new(once, new, ["started_at", "table_name"])
    assert sorted(r["n"] for r in twice.collect()) == [1, 2]


# -- quality ---------------------------------------------------------------

def test_missing_tables_do_not_stop_the_checks(spark, book):
    out = {r["check_name"]: r["result"] for r in quality.run_checks(
        quality.row_checks(book.terms), {"order_lines": book.lines}, spark).collect()}
    assert len(out) == 9
    assert out["repeated_approval"] == "NOT_APPLICABLE" and out["blank_sales_order"] == "ALERT"


def test_gate_names_critical_sources(spark):
    status = spark.createDataFrame([("a", "CRIT"), ("b", "OK"), ("c", "CRIT")],
                                   "source STRING, source_lamp STRING")
    assert sorted(quality.blocked(status, ["a", "b"])) == ["a"]


def test_new_alerts(spark):
    history = spark.createDataFrame(
        [(1, "x", "WARN", 1, "ALERT"), (2, "x", "WARN", 2, "ALERT"), (2, "y", "CRIT", 3, "ALERT"),
         (2, "z", "CRIT", 0, "OK")],
        "run_at INT, check_name STRING, severity STRING, rows INT, result STRING")
    assert [r["check_name"] for r in quality.new_alerts(history).collect()] == ["y"]


def test_rebuild_and_identities(spark, book, tmp_path):
    fresh = Book(book.source, book.terms)
    log = build.rebuild(fresh, str(tmp_path))
    assert [r["table_name"] for r in log] == list(build.TABLES) and all(
        r["rows"] or r["table_name"] in build.MAY_BE_EMPTY for r in log)
    names = build.publish(fresh)
    assert len(names) == len(build.VIEWS)
    results = quality.identities(build.identity_pairs(fresh))
    assert quality.broken(results) == [] and results.filter("gap <> 0").count() == 0
    with pytest.raises(KeyError, match="unknown tables"):
        build.rebuild(fresh, str(tmp_path), ["nope"])
    again = Book(book.source, book.terms)
    assert [r["table_name"] for r in build.rebuild(again, str(tmp_path), ["vintage"])] == ["vintage"]


def test_one_bad_view_does_not_stop_the_others(book):
    with pytest.raises(RuntimeError, match="bad"):
        build.publish(book, {"bad": lambda b: b.missing, "cohort_cac": build.VIEWS["cohort_cac"]})
    assert book.source.spark.catalog.tableExists("pub_cohort_cac")


def test_night_stops_on_a_critical_source(spark, book, tmp_path):
    status = spark.createDataFrame([("credit_order", "CRIT"), ("customers", "CRIT")],
                                   "source STRING, source_lamp STRING")
    night = nightly.run(book, str(tmp_path), status)
    assert night.stopped_by == ["credit_order"] and night.exit_code == 1 and not night.log


def test_contest_file(spark, tmp_path):
    path = tmp_path / "c.csv"
    path.write_text(",".join(contracts.CONTEST_HEADER) + "\n 12,2500.5,A,R1,O1,SV1\n", "utf-8")
    row = contracts.read_contest(spark, str(path)).first()
    assert (row["netsuite_id"], row["netsuite_id_num"], row["linea_nueva"], row["ruta_preventa"],
            row["supervisor"]) == ("12", 12, 2500.5, "R1", "SV1")


def test_clean_combination(spark):
    df = spark.createDataFrame([("['a b'&'c']",)], "x STRING")
    assert df.select(contracts.clean_combination("x")).first()[0] == "ab & c"


def test_loads_are_logged_one_by_one(spark, book, tmp_path):
    staging = intake.Staging(spark, str(tmp_path))
    sources = {"credit_order": book.source.credit_order,
               "payment_report": book.source.payment_report.limit(0)}
    with pytest.raises(load.EmptyLoad):
        intake.load_all(staging, sources, book.terms)
    assert [r["table_name"] for r in staging.log().collect()] == ["credit_order"]


def test_unmeasurable_identity_counts_as_broken(spark):
    rows = spark.range(3)

    def missing():
        raise AttributeError("no such table")
    results = quality.identities([("a", rows, rows, 1, 0, "CRIT"), ("b", rows, missing, 1, 0, "CRIT"),
                                  ("c", rows, missing, 1, 0, "WARN")])
    assert quality.broken(results) == ["b"]


def lag_run(spark, tables, folder, log, rows):
    spark.createDataFrame(rows, "s STRING, at TIMESTAMP_NTZ").write.mode("append").parquet(folder)
    for query in jobs.lag_streams(jobs.read_stream(spark, folder, "s STRING, at TIMESTAMP_NTZ"),
                                  tables, log, "s", "at", "2 hours"):
        query.awaitTermination()
    return {(r["source"], r["hour"].hour): (r["rows"], r["last_at"], r["late_rows"], r["lamp"])
            for r in jobs.lag_status(tables, t(3)).collect()}


def test_lag_by_source_and_hour_counts_late_rows(spark, tmp_path):
    folder, log = str(tmp_path / "in"), str(tmp_path / "log")
    tables = jobs.LagTables.at(spark, str(tmp_path / "out"))
    got = lag_run(spark, tables, folder, log, [("a", t(1, 8)), ("a", t(1, 8)), ("b", t(1, 12)), (None, t(1, 9))])
    assert got == {("a", 8): (2, t(1, 8), 0, "WARN"), ("b", 12): (1, t(1, 12), 0, "WARN"),
                   ("", 9): (1, t(1, 9), 0, "WARN")}
    # The watermark stands at 10: an event of 8 is late, one of 11 still counts.
    got = lag_run(spark, tables, folder, log, [("a", t(1, 8)), ("a", t(1, 11)), ("b", t(1, 12)), ("c", t(2, 23))])
    assert got == {("a", 8): (2, t(1, 8), 1, "WARN"), ("a", 11): (1, t(1, 11), 1, "WARN"),
                   ("b", 12): (2, t(1, 12), 0, "WARN"), ("c", 23): (1, t(2, 23), 0, "OK"),
                   ("", 9): (1, t(1, 9), 0, "WARN")}


def test_repeated_lag_batch_changes_nothing(spark, tmp_path):
    table = jobs.LagTables.at(spark, str(tmp_path)).hours
    rows = spark.createDataFrame([("a", t(1, 8), 2, t(1, 8)), ("a", t(2, 8), 5, t(2, 8))], table.schema)
    for _ in range(2):
        table.merge(rows, ["source", "hour"])
    assert table.read().count() == 2 and table.parts() == ["2024-01-01", "2024-01-02"]


def test_empty_window_keeps_the_table(spark, book, tmp_path):
    staging = intake.Staging(spark, str(tmp_path))
    lines = book.source.credit_order
    terms = book.terms
    intake.load_all(staging, {"credit_order": lines}, terms)
    before = staging.credit_order.count()
    with pytest.raises(load.EmptyLoad):
        intake.load_all(staging, {"credit_order": lines.limit(0)}, terms)
    assert staging.credit_order.count() == before
    with pytest.raises(KeyError):
        intake.load_all(staging, {}, terms, only=["nope"])


def test_partitioned_version_keeps_types(spark, tmp_path):
    table = load.VersionedTable(spark, str(tmp_path / "p"))
    df = spark.createDataFrame([("2001-08", 1), ("2001-09", 2)], "month STRING, v INT")
    table.replace(df, by="month")
    assert table.read().schema["month"].dataType.simpleString() == "string"
    assert sorted(map(tuple, table.read().select("month", "v").collect())) == [
        ("2001-08", 1), ("2001-09", 2)]
    one = table.read().filter("month = '2001-08'")
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(month" in plan and one.count() == 1


# -- rejects ---------------------------------------------------------------

def test_rejected_lines_and_reasons(spark, tmp_path):
    path = tmp_path / "p.csv"
    path.write_text("n,Id cliente,transactionalProfile\n0,1,a\n1,x,b\n2,,c\n3,4\n4,5,d,e,f\n5, 6 , g \n6,y,\n")
    done = contracts.check(spark, "service_profile", str(path))
    assert sorted(tuple(r) for r in done.rows.collect()) == [(1, "a"), (6, "g")]
    assert done.counts == {"rows": 7, "rejected": 5, "in id_cliente": 3, "in transactional_profile": 1}
    found = sorted((r["column"], r["value"] or "", r["reason"]) for r in done.problems.collect())
    assert found == [("", "3,4", "wrong number of fields"), ("", "4,5,d,e,f", "wrong number of fields"),
                     ("id_cliente", "", "is missing"), ("id_cliente", "x", "is no bigint"),
                     ("id_cliente", "y", "is no bigint"), ("transactional_profile", "", "is missing")]
    plan = {r["column"]: (r["type"], r["filled"], r["rejected"]) for r in rejects.dry_run(done).collect()}
    assert plan == {"id_cliente": ("bigint", 2, 3), "transactional_profile": ("string", 2, 1)}
    path.write_text("Id cliente\n1\n")
    with pytest.raises(load.BrokenContract, match="missing columns"):
        contracts.check(spark, "service_profile", str(path))


def test_unread_values_are_counted_per_load(spark, book, tmp_path):
    staging = intake.Staging(spark, str(tmp_path))
    rows = spark.createDataFrame([("1", "a"), ("x", "b"), (" ", "c"), (None, "d"), ("y", "e")],
                                 "id_cliente STRING, transactional_profile STRING")
    for _ in range(2):
        intake.load_all(staging, {"service_profile": rows}, book.terms)
        assert [tuple(r)[1:] for r in staging.rejected().collect()] == [("service_profile", "id_cliente", 2)]
    assert sorted(r[0] or 0 for r in staging.service_profile.select("id_cliente").collect()) == [0, 0, 0, 0, 1]


def test_probes_read_footers_only(spark, book, tmp_path):
    staging = intake.Staging(spark, str(tmp_path))
    intake.load_all(staging, {"credit_order": book.source.credit_order,
                              "service_profile": book.source.service_profile}, book.terms)
    before = spark.conf.get("spark.sql.sources.useV1SourceList")
    for name, at in (("credit_order", "createdAt"), ("service_profile", None)):
        df = staging.probe(name, at)
        plan = df._jdf.queryExecution().toString()
        assert "PushedAggregation: [COUNT(*)" in plan
        row, table = df.first(), getattr(staging, name)
        assert row["rows"] == table.count()
        assert at is None or row["last"] == table.agg(F.max(at)).first()[0]
    assert spark.conf.get("spark.sql.sources.useV1SourceList") == before


# -- tables in parts -------------------------------------------------------

def files(path):
    return {p.parent.name: p.name for p in pathlib.Path(path).rglob("*.parquet")}


def test_only_touched_parts_are_written(spark, tmp_path):
    table = PartedTable(spark, str(tmp_path / "t"), "k STRING, at TIMESTAMP_NTZ", F.col("at"))
    month = [dt.datetime(2024, m, 5) for m in range(1, 5)]
    table.replace(spark.createDataFrame(
        [(f"k{i}", at) for i, at in enumerate(month)] + [("none", None)], table.schema))
    before = files(tmp_path)
    assert table.parts() == ["2024-01", "2024-02", "2024-03", "2024-04", "none"]
    # The new rows are made of the part that they replace; one part loses its last row.
    table.write(table.read(["2024-02"]).unionByName(
        spark.createDataFrame([("new", month[1])], table.schema)), {"2024-02", "2024-03"})
    after = files(tmp_path)
    assert {n for n in before if before[n] != after.get(n)} == {"part_=2024-02", "part_=2024-03"}
    assert sorted(r["k"] for r in table.read().collect()) == ["k0", "k1", "k3", "new", "none"]
    table.merge(spark.createDataFrame([("k0", month[0]), ("late", month[0])], table.schema), ["k"])
    assert sorted(r["k"] for r in table.read().collect()) == ["k0", "k1", "k3", "late", "new", "none"]
    assert files(tmp_path)["part_=2024-04"] == before["part_=2024-04"]


def test_windowed_load_leaves_other_months_alone(spark, book, tmp_path):
    staging = intake.Staging(spark, str(tmp_path))
    lines = book.source.credit_order
    intake.load_all(staging, {"credit_order": lines}, book.terms)
    before = files(tmp_path / "credit_order")
    terms = dataclasses.replace(book.terms, now=book.terms.now + dt.timedelta(days=1))
    changed = lines.withColumn("sku", F.lit("changed")) if "sku" in lines.columns else lines
    entry = intake.load_all(staging, {"credit_order": changed}, terms)[0]
    assert entry[2] == "window" and 0 < entry[3] < lines.count()
    assert sorted((r["table_name"], r["mode"]) for r in staging.log().collect()) == [
        ("credit_order", "full"), ("credit_order", "window")]
    after = files(tmp_path / "credit_order")
    months = {n for n in after if after[n] != before.get(n)}
    edge = (terms.now - dt.timedelta(days=terms.mutable_days)).strftime("part_=%Y-%m")
    assert months and set(after) == set(before)
    # Older months only where a row could still change.
    stored = staging.table("credit_order")
    older = stored.read().filter(~F.coalesce(F.col("orderStatus").isin(*FINAL_STATES), F.lit(False)))
    assert months <= {f"part_={m}" for m in stored.touched(older)} | {n for n in after if n >= edge}
    assert len(months) < len(after) / 2
    assert staging.credit_order.count() == lines.count()


# -- changing rows ---------------------------------------------------------

RULE = Mutable("id", "at", "changed", "status", ("done",), days=5)
SCHEMA = "id STRING, at TIMESTAMP_NTZ, changed TIMESTAMP_NTZ, status STRING"


def state(table):
    return sorted((r["id"], r["status"], r["changed"].day) for r in table.read().collect())


def test_closed_rows_are_frozen_and_open_rows_change(spark, tmp_path):
    table = jobs.changing_table(spark, str(tmp_path), SCHEMA, RULE)
    jobs.apply_changes(table, RULE, spark.createDataFrame(
        [("old", t(1), t(1), "done"), ("slow", t(1), t(1), "open"), ("new", t(20), t(20), "done")],
        SCHEMA), 0)
    batch = spark.createDataFrame(
        [("old", t(1), t(21), "reopened"), ("slow", t(1), t(21), "done"),
         ("new", t(20), t(22), "open"), ("never", t(2), t(21), "done"),
         ("new", t(20), t(19), "stale"), ("newest", t(30), t(30), "open"), ("other", t(16), t(21), "done")],
        SCHEMA)
    # The closed row keeps its state; an old key that was never loaded stays out.
    expected = [("new", "open", 22), ("newest", "open", 30), ("old", "done", 1), ("other", "done", 21),
                ("slow", "done", 21)]
    for _ in range(2):
        # Repeated, as after a failure: the clock is that of the batches before.
        jobs.apply_changes(table, RULE, batch, 1)
        assert state(table) == expected
    jobs.apply_changes(table, RULE, spark.createDataFrame([], SCHEMA), 2)
    assert state(table) == expected


def test_half_written_batch_is_completed(spark, tmp_path):
    """The first attempt has written its newest month only; the second must not count that month
    when it decides which rows are inside the window."""
    table = jobs.changing_table(spark, str(tmp_path), SCHEMA, RULE)
    rows = [("a", dt.datetime(2024, 1, 30), dt.datetime(2024, 1, 30), "open"),
            ("b", dt.datetime(2024, 1, 31), dt.datetime(2024, 1, 31), "done"),
            ("c", dt.datetime(2024, 2, 20), dt.datetime(2024, 2, 20), "open")]
    jobs.apply_changes(table, RULE, spark.createDataFrame(rows[:1], SCHEMA), 0)
    jobs.apply_changes(table, RULE, spark.createDataFrame(rows[2:], SCHEMA), 1)
    jobs.apply_changes(table, RULE, spark.createDataFrame(rows[1:], SCHEMA), 1)
    assert [r[0] for r in state(table)] == ["a", "b", "c"]


def test_changes_sent_twice_are_taken_once(spark, tmp_path):
    folder, log = str(tmp_path / "in"), str(tmp_path / "log")
    table = jobs.changing_table(spark, str(tmp_path / "out"), SCHEMA, RULE)
    for n in range(3):
        # Every file repeats the first one.
        spark.createDataFrame([("k0", t(1), t(1), "open"), (f"k{n}", t(n + 1), t(n + 1), "open")],
                              SCHEMA).coalesce(1).write.mode("append").parquet(folder)
        query = jobs.upsert_stream(jobs.read_stream(spark, folder, SCHEMA, files_per_batch=1), table,
                                   RULE, log)
        query.awaitTermination()
        duplicates = [p["stateOperators"][0]["customMetrics"].get("numDroppedDuplicateRows", 0)
                      for p in query.recentProgress if p["stateOperators"]]
        assert sum(duplicates) == 1
    assert state(table) == [("k0", "open", 1), ("k1", "open", 2), ("k2", "open", 3)]

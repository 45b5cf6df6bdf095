import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemark.catalogue.tables import row_type
from tidemark.plans import copy as copy_module
from tidemark.plans.copy import BackfillJobs
from tidemark.plans.joblog import JOB_SCHEMA, active_jobs, audit_transitions, job_progress, job_states, list_jobs
from tidemark.plans.reports import progress, unmapped_report
from tidemark.sinks.staging import compact, current_rows, read_replica
from tidemark.sources.mapping import Mapping

RULES = Mapping.from_dicts([
    {"source_table": "items", "dest_table": "things", "remap": {"id": "{id}", "v": "{v}"}},
    {"source_table": "items", "dest_table": "audit", "remap": {"id": "{id}"}}])
SCHEMAS = {"things": row_type("id BIGINT NOT NULL, v STRING, ver BIGINT NOT NULL"),
           "audit": row_type("id BIGINT NOT NULL, ver BIGINT NOT NULL")}


def log_of(spark, events):
    rows = []
    for no, (job, status, extra) in enumerate(events):
        event = {"job_id": job, "event_no": no, "source_table": f"t{job % 2}", "dest_table": "d",
                 "status": status, "inserted_at": dt.datetime(2024, 1, 1) + dt.timedelta(hours=job), **extra}
        rows.append(tuple(event.get(f.name) for f in JOB_SCHEMA.fields))
    return spark.createDataFrame(rows, JOB_SCHEMA)


def test_states_and_active_jobs(spark):
    log = log_of(spark, [(1, "pending", {}), (2, "pending", {}), (1, "running", {}), (3, "pending", {}),
                         (3, "running", {}), (3, "failed", {}), (5, "pending", {}), (5, "paused", {})])
    assert {r["job_id"]: r["status"] for r in job_states(log).collect()} == {
        1: "running", 2: "pending", 3: "failed", 5: "paused"}
    assert {r["source_table"]: r["job_id"] for r in active_jobs(log).collect()} == {"t1": 5, "t0": 2}
    assert [r["job_id"] for r in list_jobs(log).collect()] == [5, 3, 2, 1]
    assert [r["job_id"] for r in list_jobs(log, "failed").collect()] == [3]
    assert [r["job_id"] for r in list_jobs(log, ["running", "paused"]).collect()] == [5, 1]


@pytest.mark.parametrize("hot_rows", [0, 2, 2**20])
def test_audit(spark, hot_rows):
    log = log_of(spark, [
        (1, "pending", {}), (1, "running", {}), (1, "running", {}), (1, "completed", {}), (1, "running", {}),
        (2, "running", {}), (2, "paused", {}), (2, "pending", {}), (2, "paused", {}), (2, "running", {}),
        (3, "pending", {}), (3, "odd", {}), (3, "running", {}), (3, "failed", {"dest_table": None}),
        (4, "pending", {}), (4, "completed", {}), (4, "paused", {}), (4, None, {})])
    got = [(r["job_id"], r["event_no"], r["problem"]) for r in
           audit_transitions(log, hot_rows=hot_rows).orderBy("event_no").collect()]
    assert got == [(1, 4, "bad_transition"), (2, 5, "bad_start"), (3, 11, "unknown_status"),
                   (3, 13, "missing_table"), (4, 15, "bad_transition"), (4, 17, "unknown_status")]


def test_job_progress(spark):
    log = log_of(spark, [(1, "running", {"total_rows": 150000, "processed_rows": 45000})])
    assert job_progress(log).first()["progress_percent"] == 30.0


def test_reports(spark):
    changes = spark.createDataFrame([("items", 1), ("x", 2), ("x", 9), (None, 4)], "source_table STRING, seq BIGINT")
    got = {r["source_table"]: (r["rows"], r["last_seq"]) for r in unmapped_report(changes, RULES).collect()}
    assert got == {"x": (2, 9), None: (1, 4)}
    done = progress({"a": spark.range(8), "b": spark.range(0), "c": spark.range(4)},
                    {"a": spark.createDataFrame([(1,), (1,), (2,), (77,)], "k BIGINT"), "b": spark.range(2)})
    assert {r["source_table"]: (r["total_rows"], r["processed_rows"], r["progress_percent"])
            for r in done.collect()} == {"a": (8, 2, 25.0), "b": (0, 0, 100.0), "c": (4, 0, 0.0)}


@pytest.fixture
def job_run(spark, tmp_path):
    jobs = BackfillJobs(spark, str(tmp_path / "log"), RULES)
    return jobs, {"replica_dir": str(tmp_path / "replica"), "schemas": SCHEMAS}


def ids(spark, run, dest="things"):
    return sorted(r["id"] for r in read_replica(spark, run["replica_dir"], dest, SCHEMAS[dest]).collect())


def items(spark, n):
    return spark.range(n).withColumn("v", F.concat(F.lit("v"), F.col("id")))


def test_a_job_in_steps(spark, job_run):
    jobs, run = job_run
    source = items(spark, 23)
    job = jobs.start("items", source, "id", batch_size=5)
    assert (job["status"], job["total_rows"], job["last_processed_id"]) == ("pending", 23, 23)
    assert jobs.start("items", source, "id")["job_id"] == job["job_id"]
    job = jobs.copy_pages(job["job_id"], source, max_pages=2, **run)
    assert (job["status"], job["processed_rows"], job["last_processed_id"]) == ("running", 10, 13)
    assert ids(spark, run) == list(range(13, 23)) == ids(spark, run, "audit")
    jobs.pause(job["job_id"])
    job = jobs.copy_pages(job["job_id"], source, **run)
    assert (job["status"], job["processed_rows"]) == ("paused", 10)
    job = jobs.start("items", source, "id")
    assert (job["job_id"], job["status"]) == (1, "pending")
    job = jobs.copy_pages(1, source, **run)
    assert (job["status"], job["processed_rows"], job["last_processed_id"]) == ("completed", 23, 0)
    assert ids(spark, run) == list(range(23))
    before = jobs.log().count()
    assert jobs.copy_pages(1, source, **run)["status"] == "completed" and jobs.log().count() == before
    assert jobs.start("items", source, "id")["job_id"] == 2
    assert audit_transitions(jobs.log()).count() == 0


def test_exact_multiple_and_empty_table(spark, job_run):
    jobs, run = job_run
    job = jobs.start("items", items(spark, 10), "id", batch_size=5)
    job = jobs.copy_pages(job["job_id"], items(spark, 10), max_pages=1, **run)
    assert (job["status"], job["processed_rows"]) == ("running", 5)
    job = jobs.copy_pages(job["job_id"], items(spark, 10), max_pages=1, **run)
    assert (job["status"], job["processed_rows"], job["last_processed_id"]) == ("completed", 10, 0)
    job = jobs.start("items", items(spark, 0), "id")
    assert job["last_processed_id"] is None
    job = jobs.copy_pages(job["job_id"], items(spark, 0), **run)
    assert (job["status"], job["processed_rows"]) == ("completed", 0)


def test_rows_that_come_or_go_after_planning(spark, job_run):
    jobs, run = job_run
    source = items(spark, 30).withColumn("id", F.col("id") + 10)
    job = jobs.start("items", source, "id", batch_size=5)
    jobs.copy_pages(job["job_id"], source, max_pages=2, **run)
    later = source.filter("id < 20 OR id > 24").unionByName(items(spark, 3))
    steps = 0
    while jobs.get(job["job_id"])["status"] != "completed":
        job, steps = jobs.copy_pages(job["job_id"], later, max_pages=1, **run), steps + 1
    assert steps == 4 and ids(spark, run) == [0, 1, 2] + list(range(10, 20)) + list(range(25, 40))
    assert job["processed_rows"] == 28


def test_many_tables_and_listing(spark, job_run):
    jobs, run = job_run
    with pytest.raises(LookupError, match="others"):
        jobs.start_tables({"items": (items(spark, 4), "id"), "others": (spark.range(1), "id")})
    (job,) = jobs.start_tables({"items": (items(spark, 4), "id")}, batch_size=3)
    jobs.copy_pages(job["job_id"], items(spark, 4), max_pages=1, **run)
    (row,) = jobs.jobs().collect()
    assert (row["job_id"], row["status"], row["progress_percent"]) == (1, "running", 75.0)
    assert jobs.jobs("completed").count() == 0


@pytest.mark.parametrize("same_step", [True, False])
def test_a_crash_before_the_log_write_loses_nothing(spark, job_run, monkeypatch, same_step):
    jobs, run = job_run
    source = items(spark, 12)
    job = jobs.start("items", source, "id", batch_size=4)
    real = copy_module.drain
    with monkeypatch.context() as patch:
        def crash(*args, **options):
            real(*args, **options)
            raise KeyboardInterrupt
        patch.setattr(copy_module, "drain", crash)
        with pytest.raises(KeyboardInterrupt):
            jobs.copy_pages(job["job_id"], source, max_pages=1, **run)
    if same_step:
        jobs.copy_pages(job["job_id"], source, max_pages=1, **run)
        assert ids(spark, run) == [8, 9, 10, 11]
    job = jobs.copy_pages(job["job_id"], source, **run)
    assert job["status"] == "completed" and set(ids(spark, run)) == set(range(12))
    assert current_rows(spark, run["replica_dir"], "things", SCHEMAS["things"], ["id"]).count() == 12


def test_every_step_is_logged(spark, job_run):
    jobs, run = job_run
    source = items(spark, 23)
    job = jobs.start("items", source, "id", batch_size=5)
    jobs.copy_pages(job["job_id"], source, pages_per_step=2, **run)
    steps = [(r["processed_rows"], r["last_processed_id"], r["status"]) for r in jobs.log().orderBy("event_no").collect()]
    assert steps == [(0, 23, "pending"), (0, 23, "running"), (10, 13, "running"), (20, 3, "running"), (23, 0, "completed")]


def test_two_log_folders_and_a_second_backfill_lose_nothing(spark, tmp_path):
    run = {"replica_dir": str(tmp_path / "replica"), "schemas": SCHEMAS}
    for name, value in (("log", "old"), ("log", "newer"), ("other", "newest")):
        jobs = BackfillJobs(spark, str(tmp_path / name), RULES)
        source = items(spark, 5).withColumn("v", F.lit(value))
        jobs.copy_pages(jobs.start("items", source, "id")["job_id"], source, **run)
        state = current_rows(spark, run["replica_dir"], "things", SCHEMAS["things"], ["id"])
        assert [r["v"] for r in state.collect()] == [value] * 5
        compact(spark, run["replica_dir"], "things", SCHEMAS["things"], ["id"])


def test_starting_all_tables_finds_keys(spark, job_run):
    jobs, run = job_run
    (job,) = jobs.start_all({"items": items(spark, 8).select(F.lit(1).alias("k"), "id", "v"), "x": spark.range(1)})
    assert (job["source_table"], job["primary_key"]) == ("items", "id")
    with pytest.raises(LookupError, match="items"):
        jobs.start_all({"items": spark.range(4).select(F.lit(1).alias("k"))})


def test_a_failed_run(spark, job_run):
    jobs, run = job_run
    source = items(spark, 6).withColumn("id", F.col("id") * 2)
    job = jobs.start("items", source, "id", batch_size=4)
    broken = source.withColumn("v", F.raise_error(F.lit("broken source")))
    with pytest.raises(Exception, match="broken source"):
        jobs.copy_pages(job["job_id"], broken, **run)
    job = jobs.get(job["job_id"])
    assert job["status"] == "failed" and "broken source" in job["error_message"]
    assert jobs.copy_pages(job["job_id"], source, **run)["status"] == "failed"
    with pytest.raises(ValueError):
        jobs.resume(job["job_id"])
    jobs.resume(job["job_id"], from_failed=True)
    assert jobs.copy_pages(job["job_id"], source, **run)["status"] == "completed"
    assert ids(spark, run) == [0, 2, 4, 6, 8, 10]


def test_ordering_by_another_column_with_ties_and_nulls(spark, job_run):
    jobs, run = job_run
    source = items(spark, 20).withColumn(
        "day", F.when(F.col("id") > 1, F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") / 6).cast("int"))))
    job = jobs.start("items", source, "id", ordering_column="day", batch_size=4)
    steps = 0
    while job["status"] in ("pending", "running"):
        job, steps = jobs.copy_pages(job["job_id"], source, max_pages=1, **run), steps + 1
    assert job["processed_rows"] == 18 and ids(spark, run) == list(range(2, 20))
    assert steps > 2 and job["cursor"] == "2024-01-01" and job["last_processed_id"] is None


def test_unknown_tables_and_jobs(spark, job_run):
    jobs, run = job_run
    with pytest.raises(LookupError, match="items"):
        jobs.start("others", spark.range(1), "id")
    with pytest.raises(LookupError):
        jobs.pause(5)
    with pytest.raises(LookupError):
        jobs.copy_pages(5, spark.range(1), **run)


def counted_drains(monkeypatch):
    calls, real = [], copy_module.drain

    def drain(*args, **options):
        calls.append(1)
        return real(*args, **options)
    monkeypatch.setattr(copy_module, "drain", drain)
    return calls


def log_steps(jobs):
    return [(r["processed_rows"], r["last_processed_id"], r["status"])
            for r in jobs.log().orderBy("event_no").collect()][2:]


def test_many_small_steps_are_few_rounds(spark, job_run, monkeypatch):
    jobs, run = job_run
    source = items(spark, 123)
    jobs.start("items", source, "id", batch_size=2)
    calls = counted_drains(monkeypatch)
    later = source.filter("id NOT BETWEEN 40 AND 49 AND id != 50")  # gone after planning
    jobs.copy_pages(1, later.limit(0).unionByName(source), max_pages=3, pages_per_step=2, **run)
    job = jobs.copy_pages(1, later, pages_per_step=2, **run)
    borders = [119, 117, *range(113, 0, -4)]
    want = [sum(1 for i in range(low, 123) if not 40 <= i <= 50) for low in borders]
    steps = [*zip(want, borders), (112, 0)]
    assert log_steps(jobs) == [(n, low, "completed" if low == 0 else "running") for n, low in steps]
    assert len(calls) <= 8 and (job["status"], job["cursor"]) == ("completed", "0")
    assert ids(spark, run) == [i for i in range(123) if not 40 <= i <= 50] == ids(spark, run, "audit")
    rows = read_replica(spark, run["replica_dir"], "things", SCHEMAS["things"])
    assert rows.select("load_batch").distinct().count() == len({n for n, _ in steps})
    assert audit_transitions(jobs.log()).count() == 0


def test_a_bad_step_among_many_fails_alone(spark, job_run):
    jobs, run = job_run
    source = items(spark, 40)
    jobs.start("items", source, "id", batch_size=2)
    broken = source.withColumn("v", F.when(F.col("id") == 15, F.raise_error(F.lit("bad row"))).otherwise(F.col("v")))
    with pytest.raises(Exception, match="bad row"):
        jobs.copy_pages(1, broken, pages_per_step=1, **run)
    assert log_steps(jobs) == [(n, 40 - n, "running") for n in range(2, 25, 2)] + [(24, 16, "failed")]
    assert ids(spark, run) == list(range(16, 40))
    jobs.resume(1, from_failed=True)
    assert jobs.copy_pages(1, source, pages_per_step=1, **run)["processed_rows"] == 40
    assert ids(spark, run) == list(range(40))


def test_a_crash_after_a_round_of_steps_copies_no_row_twice(spark, job_run, monkeypatch):
    jobs, run = job_run
    source = items(spark, 20)
    jobs.start("items", source, "id", batch_size=2)
    real, calls = copy_module.drain, []
    with monkeypatch.context() as patch:
        def crash(*args, **options):
            real(*args, **options)
            calls.append(1)
            if len(calls) == 3:
                raise KeyboardInterrupt
        patch.setattr(copy_module, "drain", crash)
        with pytest.raises(KeyboardInterrupt):
            jobs.copy_pages(1, source, pages_per_step=1, **run)
    assert jobs.get(1)["processed_rows"] == 10
    assert jobs.copy_pages(1, source, pages_per_step=1, **run)["processed_rows"] == 20
    assert ids(spark, run) == list(range(20))


@pytest.mark.parametrize("dtype, values", [
    ("STRING", ["", '"a, b"', "a", "a\n", "z", "\ue000", chr(0x1F600)]), ("DOUBLE", [-1.5, 0.0, 0.1, 1e300, float("nan")]),
    ("DATE", ["1900-01-01", "2024-01-01", "2024-01-02"]), ("DECIMAL(9,2)", ["-1.10", "0.00", "7.25"]),
    ("TIMESTAMP_NTZ", ["2024-01-01 00:00:00", "2024-01-01 00:00:00.000001"]), ("INT", [-5, 0, 7])])
def test_steps_of_values_of_any_type(spark, dtype, values):
    rows = spark.createDataFrame([(k, str(v)) for k, v in enumerate(values)], "k INT, v STRING") \
        .withColumn("v", F.col("v").cast(dtype))
    texts = [r["t"] for r in rows.orderBy("k").select(F.col("v").cast("string").alias("t")).collect()]
    got = copy_module._with_step(rows, "v", texts[:0:-1]).orderBy("k").collect()
    assert [r[copy_module.STEP] for r in got] == list(range(len(values)))[::-1]


def test_steps_over_ties_are_those_of_one_by_one(spark, job_run):
    jobs, run = job_run
    source = items(spark, 18).withColumn("o", F.expr("CASE WHEN id < 12 THEN id / 5 ELSE 9 END"))
    seen = []
    for at_once in (1, None):
        job = jobs.start("items", source, "id", ordering_column="o", batch_size=2)
        job_id = job["job_id"]
        while job["status"] in ("pending", "running"):
            job = jobs.copy_pages(job_id, source, max_pages=at_once, pages_per_step=1, **run)
        seen.append([(r["processed_rows"], r["cursor"], r["status"])
                     for r in jobs.log().filter(F.col("job_id") == job_id).orderBy("event_no").collect()])
    assert seen[0] == seen[1] and seen[0][-1] == (18, "0.0", "completed") and seen[0][2] == (6, "9.0", "running")

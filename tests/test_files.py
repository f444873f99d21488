import gzip
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tallygauge import compliance, on, pairs, size
from tallygauge.plans import batch
from tallygauge.plans.batch import Job, run
from tallygauge.sources.files import first_lines, json_schemas, read_files, struct_of
from tallygauge.sources.listing import bucket_of, list_files, relative_name
from tallygauge.sources.manifest import read_manifest
from tallygauge.sources.manifest import compact_manifest
from tallygauge.sources.metric_table import compact_metrics, read_failures, read_metrics, read_results
from tallygauge.sources.tables import commit_tables, committed, compact_tables, latest_rows, read_rows, write_rows


@pytest.fixture
def job(tmp_path):
    (tmp_path / "in").mkdir()
    spec = (
        size()
        + on("Completeness", "press")
        + compliance("p400", "press = 400")
        + on("CountDistinct", "press")
        + on("Mean", "id")
        + pairs("MutualInformation", "id", "press")
    )
    return Job(
        location=str(tmp_path / "in"),
        metrics=spec,
        manifest_path=str(tmp_path / "manifest"),
        metrics_path=str(tmp_path / "metrics"),
        export_path=str(tmp_path / "out"),
    )


def put(job, name, text):
    from pathlib import Path

    path = Path(job.location) / name
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text)


def states(spark, job):
    return {r.file_name: r.processed for r in read_manifest(spark, job.manifest_path).collect()}


def test_whole_job_over_unlike_files(spark, values, reasons, job, tmp_path):
    put(job, "nulls.csv", "id,press\n1,400\n2,\n3,x\n")
    put(job, "b,c.csv", "id,press\n1,400\n")
    put(job, "a+b [1] 100%.csv", "id,press\n1,7\n2,400\n")
    put(job, "empty.csv", "id,press\n")
    put(job, "deep/drift.csv", "press,id\n400,1\n5,2\n")
    put(job, "other.csv", "id\n1\n")
    assert run(spark, job) == 6

    found = values(read_metrics(spark, job.metrics_path), "file_name")
    assert found[("nulls.csv", "*", "Size")] == 3
    assert found[("nulls.csv", "press", "Completeness")] == pytest.approx(2 / 3)
    assert found[("nulls.csv", "p400", "Compliance")] == pytest.approx(1 / 3)
    assert found[("b,c.csv", "press", "CountDistinct")] == 1
    assert found[("a+b [1] 100%.csv", "p400", "Compliance")] == 0.5
    assert found[("deep/drift.csv", "p400", "Compliance")] == 0.5
    assert found[("empty.csv", "*", "Size")] == 0
    assert found[("empty.csv", "press", "CountDistinct")] == 0
    assert found[("other.csv", "*", "Size")] == 1
    failed = reasons(read_failures(spark, job.metrics_path), "file_name")
    assert failed[("empty.csv", "press", "Completeness")] == "empty"
    assert failed[("other.csv", "press", "Completeness")] == "unknown column press"
    assert failed[("nulls.csv", "id", "Mean")] == "column id is string, not numeric"

    keyed = read_metrics(spark, job.metrics_path).where("file_name = 'b,c.csv' and name = 'MutualInformation'")
    row = keyed.collect()[0]
    assert (row.instance, row.bucket_file_name, row.col_metricName) == (
        "id,press",
        "in-b,c.csv",
        "id,press-MutualInformation",
    )
    assert set(states(spark, job).values()) == {"Y"}

    exported = spark.read.option("header", True).csv(job.export_path)
    assert exported.columns == ["entity", "instance", "name", "value", "bucket_name", "file_name"]
    assert exported.count() == len(found)
    assert exported.where("file_name = 'deep/drift.csv' and name = 'Size'").first().value == "2.0"


def test_processed_files_stay_processed_and_new_ones_are_added(spark, values, job):
    put(job, "one.csv", "id,press\n1,400\n")
    assert run(spark, job) == 1
    assert run(spark, job) == 0
    put(job, "two.csv", "id,press\n1,400\n2,400\n")
    assert run(spark, job) == 1
    found = values(read_metrics(spark, job.metrics_path), "file_name")
    assert found[("one.csv", "*", "Size")] == 1
    assert found[("two.csv", "*", "Size")] == 2
    assert states(spark, job) == {"one.csv": "Y", "two.csv": "Y"}


def test_a_run_that_fails_leaves_its_files_pending(spark, values, job, monkeypatch):
    put(job, "one.csv", "id,press\n1,400\n")

    def broken(*args):
        raise RuntimeError("disk full")

    with monkeypatch.context() as patch:
        patch.setattr(batch, "export_csv", broken)
        with pytest.raises(RuntimeError):
            run(spark, job)
    assert states(spark, job) == {"one.csv": "N"}
    assert run(spark, job) == 1
    rows = read_metrics(spark, job.metrics_path).where("name = 'Size'").collect()
    assert [r.value for r in rows] == [1.0]
    assert states(spark, job) == {"one.csv": "Y"}


def test_rounds_bound_the_files_read_together(spark, values, job):
    for i in range(5):
        put(job, f"f{i}.csv", "id,press\n" + "1,2\n" * i)
    job.files_per_round = 2
    assert run(spark, job) == 5
    found = values(read_metrics(spark, job.metrics_path), "file_name")
    assert [found[(f"f{i}.csv", "*", "Size")] for i in range(5)] == [0, 1, 2, 3, 4]


def test_typed_csv_and_numeric_coercion(spark, values, job):
    put(job, "t.csv", "id,press\n1,400\n2,500\n")
    job.schema = "id int, press double"
    run(spark, job)
    assert values(read_metrics(spark, job.metrics_path))[("id", "Mean")] == 1.5
    job.schema, job.coerce_numeric = None, True
    put(job, "u.csv", "id,press\n4,400\nx,500\n")
    run(spark, job)
    found = values(read_metrics(spark, job.metrics_path), "file_name")
    assert found[("u.csv", "id", "Mean")] == 4


def test_a_schema_that_does_not_fit_the_header_is_an_error(spark, tmp_path):
    (tmp_path / "x.csv").write_text("press,id\n400,1\n")
    with pytest.raises(Exception, match="CSV header|header"):
        read_files(spark, str(tmp_path), "csv", "id int, press int").collect()


def test_json_files_of_unlike_types(spark, values, reasons, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.json").write_text('{"x":1,"s":{"k":1}}\n{"x":2.5,"t":[1]}\n')
    (tmp_path / "in" / "b.json").write_text('{"x":"q"}\n')
    (tmp_path / "in" / "c.json").write_text('{"x":7,"odd name":true}\n')
    job = Job(
        str(tmp_path / "in"),
        size() + on("Mean", "x") + on("CountDistinct", "x,s") + on("Completeness", "odd name"),
        str(tmp_path / "manifest"),
        str(tmp_path / "metrics"),
        file_format="json",
    )
    assert run(spark, job) == 3
    found = values(read_metrics(spark, job.metrics_path), "file_name")
    failed = reasons(read_failures(spark, job.metrics_path), "file_name")
    assert found[("a.json", "x", "Mean")] == 1.75
    assert found[("a.json", "s", "CountDistinct")] == 1
    assert failed[("b.json", "x", "Mean")] == "column x is string, not numeric"
    assert failed[("b.json", "s", "CountDistinct")] == "unknown column s"
    assert found[("c.json", "x", "Mean")] == 7
    assert found[("c.json", "odd name", "Completeness")] == 1


def test_parquet_files(spark, values, tmp_path):
    spark.range(10).selectExpr("id", "id % 3 as k").coalesce(1).write.parquet(str(tmp_path / "in"))
    job = Job(
        str(tmp_path / "in"),
        size() + on("Sum", "id") + on("CountDistinct", "k"),
        str(tmp_path / "manifest"),
        str(tmp_path / "metrics"),
        file_format="parquet",
    )
    run(spark, job)
    found = values(read_metrics(spark, job.metrics_path))
    assert found == {("*", "Size"): 10, ("id", "Sum"): 45, ("k", "CountDistinct"): 3}


def test_listing_reads_no_content(spark, tmp_path):
    (tmp_path / "d").mkdir()
    (tmp_path / "d" / "x y.csv").write_text("a\n1\n")
    (tmp_path / "z.txt").write_text("hello")
    listed = list_files(spark, str(tmp_path), pattern="*.csv")
    assert [(r.file_name, r.processed, r.length) for r in listed.collect()] == [("d/x y.csv", "N", 4)]
    plan = list_files(spark, str(tmp_path))._jdf.queryExecution().executedPlan().toString()
    assert "content:binary" not in plan and "length:bigint" in plan


def test_names_of_locations():
    assert bucket_of("s3a://bucket/") == "bucket"
    assert bucket_of("/data/in") == "in"
    assert relative_name("s3a://bucket/a/b%20c.csv", "s3a://bucket") == "a/b c.csv"
    assert relative_name("hdfs://nn:8020/data/in/a.csv", "/data/in") == "a.csv"
    assert relative_name("hdfs://nn:8020/data/in/a.csv", "hdfs://nn:8020/data/in/") == "a.csv"
    assert relative_name("file:/data/in/a+b.csv", "file:///data/in") == "a+b.csv"


def test_first_lines_of_large_and_small_files(spark, tmp_path):
    (tmp_path / "big.csv").write_text("h1,h2\n" + "1,2\n" * 400_000)
    (tmp_path / "small.csv").write_text("only")
    (tmp_path / "none.csv").write_text("")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    found = first_lines(spark, [str(p) for p in tmp_path.iterdir()])
    assert {relative_name(k, str(tmp_path)): v for k, v in found.items()} == {
        "big.csv": "h1,h2",
        "small.csv": "only",
    }
    assert spark.conf.get("spark.sql.files.maxPartitionBytes") == before


def test_json_schema_covers_all_lines(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"x":1}\n{"x":1.5,"y":null}\n{"x":2,"z":{"q":"t"}}\nnot json\n')
    (schema,) = json_schemas(spark, [str(tmp_path / "a.json")]).values()
    assert struct_of("OBJECT<VOID: VOID, d: DECIMAL(2,1)>") == "STRUCT<VOID: STRING, d: DOUBLE>"
    assert "x: DOUBLE" in schema and "z: STRUCT<q: STRING>" in schema
    data = read_files(spark, str(tmp_path), "json", schema)
    assert data.agg(F.sum("x")).first()[0] == 4.5


def test_compaction_keeps_the_latest_rows(spark, values, job, tmp_path):
    put(job, "one.csv", "id,press\n1,400\n")
    run(spark, job)
    put(job, "two.csv", "id,press\n1,400\n")
    run(spark, job)
    before, files = values(read_metrics(spark, job.metrics_path), "file_name"), states(spark, job)
    compact_metrics(spark, job.metrics_path)
    compact_manifest(spark, job.manifest_path)
    assert values(read_metrics(spark, job.metrics_path), "file_name") == before
    assert states(spark, job) == files == {"one.csv": "Y", "two.csv": "Y"}
    assert len(committed(spark, job.metrics_path)) == len(committed(spark, job.manifest_path)) == 1
    put(job, "two.csv", "id,press\n1,400\n2,400\n")
    assert run(spark, job) == 1
    assert values(read_metrics(spark, job.metrics_path), "file_name")[("two.csv", "*", "Size")] == 2


def test_many_layouts_take_several_queries(spark, values, job, monkeypatch):
    monkeypatch.setattr(batch, "GROUPS_PER_QUERY", 2)
    job.options = {"comment": "#"}  # an option that leaves headers to the reader
    for i in range(5):
        put(job, f"f{i}.csv", f"id,press,x{i}\n1,400,0\n")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    assert run(spark, job) == 5
    found = values(read_metrics(spark, job.metrics_path), "file_name")
    assert [found[(f"f{i}.csv", "p400", "Compliance")] for i in range(5)] == [1] * 5
    assert spark.conf.get("spark.sql.shuffle.partitions") == before


def test_shuffles_grow_with_the_input():
    assert batch.shuffle_partitions(10 << 20, 8) == 8
    assert batch.shuffle_partitions(1 << 40, 200) == 8192
    assert batch.shuffle_partitions(100 << 40, 200) == 819_200
    assert batch.shuffle_partitions(1 << 40, 50_000) == 50_000


def test_files_that_are_gone_or_not_asked_for_are_passed_over(spark, values, job):
    from pathlib import Path

    from tallygauge.sources.manifest import register

    put(job, "gone.csv", "id,press\n1,400\n")
    put(job, "one.csv", "id,press\n1,400\n")
    register(spark, job.manifest_path, list_files(spark, job.location, job.bucket))
    (Path(job.location) / "gone.csv").unlink()
    put(job, "notes.txt", "not a table")
    job.pattern = "*.csv"
    assert run(spark, job) == 1
    assert states(spark, job) == {"gone.csv": "N", "one.csv": "Y"}


def test_every_file_is_listed(spark, values, reasons, job):
    put(job, "ok.csv", "id,press\n1,400\n")
    put(job, "deep/zero.csv", "")
    put(job, "_under.csv", "id,press\n1,400\n")
    put(job, ".dot.csv", "id,press\n1,400\n")
    listed = {r.file_name: r.length for r in list_files(spark, job.location).collect()}
    assert listed == {"ok.csv": 15, "deep/zero.csv": 0, "_under.csv": 15, ".dot.csv": 15}
    assert {r.file_name for r in list_files(spark, job.location, pattern="[o_]*.{csv,txt}").collect()} == {"ok.csv", "_under.csv"}
    assert run(spark, job) == 2
    assert states(spark, job) == {"ok.csv": "Y", "deep/zero.csv": "Y", "_under.csv": "N", ".dot.csv": "N"}
    found = values(read_metrics(spark, job.metrics_path), "file_name")
    assert found[("deep/zero.csv", "*", "Size")] == found[("deep/zero.csv", "press", "CountDistinct")] == 0
    why = reasons(read_failures(spark, job.metrics_path), "file_name")
    assert why[("deep/zero.csv", "press", "Completeness")] == "empty"
    assert why[("_under.csv", "*", "Size")].startswith("cannot be read")


def test_one_bad_file_stops_no_other(spark, values, reasons, job):
    from pathlib import Path

    for i in range(5):
        put(job, f"ok{i}.csv", "id,press\n1,400\n")
    (Path(job.location) / "bad.csv.gz").write_bytes(b"not compressed at all")
    assert run(spark, job) == 5
    assert states(spark, job) == {**{f"ok{i}.csv": "Y" for i in range(5)}, "bad.csv.gz": "N"}
    why = reasons(read_failures(spark, job.metrics_path), "file_name")
    assert why[("bad.csv.gz", "*", "Size")].startswith("cannot be read")
    assert run(spark, job) == 0


def test_a_changed_file_is_measured_again(spark, values, job):
    put(job, "a.csv", "id,press\n1,400\n")
    put(job, "b.csv", "id,press\n1,400\n")
    assert run(spark, job) == 2
    put(job, "a.csv", "id,press\n1,400\n2,400\n")
    assert run(spark, job) == 1
    assert values(read_metrics(spark, job.metrics_path), "file_name")[("a.csv", "*", "Size")] == 2
    assert run(spark, job) == 0


def test_rounds_are_bounded_by_bytes(spark, job):
    for i in range(5):
        put(job, f"f{i}.csv", "id,press\n1,400\n")
    job.bytes_per_round = 20
    assert run(spark, job) == 5
    assert set(states(spark, job).values()) == {"Y"}


def test_a_listing_can_be_given(spark, values, job):
    put(job, "a.csv", "id,press\n1,400\n")
    put(job, "b.csv", "id,press\n1,400\n")
    job.listing = list_files(spark, job.location, job.bucket).where("file_name = 'b.csv'")
    assert run(spark, job) == 1
    assert states(spark, job) == {"b.csv": "Y"}


def test_parquet_files_of_unlike_schema(spark, values, reasons, job):
    job.file_format, job.export_path, job.pattern = "parquet", None, "*.parquet"
    spark.range(3).selectExpr("id", "id AS press").write.parquet(f"{job.location}/a")
    spark.range(2).write.parquet(f"{job.location}/b")
    spark.range(2).selectExpr("id", "'x' AS press").write.parquet(f"{job.location}/c")
    run(spark, job)
    found = values(read_metrics(spark, job.metrics_path), "file_name")
    sizes = {}
    for (name, _, metric), value in found.items():
        if metric == "Size":
            sizes[name[0]] = sizes.get(name[0], 0) + value
    assert sizes == {"a": 3, "b": 2, "c": 2}
    why = reasons(read_failures(spark, job.metrics_path), "file_name")
    assert {v for k, v in why.items() if k[0][0] == "b" and k[1] == "press"} == {"unknown column press"}
    assert {v for k, v in found.items() if k[0][0] == "c" and k[2] == "Completeness"} == {1.0}


def test_csv_without_header_needs_no_discovery(spark, values, job, monkeypatch):
    monkeypatch.setattr(batch.files_source, "first_lines", None)
    put(job, "a.csv", "1,400\n2,7\n")
    put(job, "b.csv", "3,400\n")
    job.options, job.metrics, job.export_path = {"header": False}, size() + on("Completeness", "_c1"), None
    assert run(spark, job) == 2
    assert values(read_metrics(spark, job.metrics_path), "file_name")[("a.csv", "_c1", "Completeness")] == 1


def test_commits(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = lambda n: spark.createDataFrame([(n, "x")], "n bigint, version string")
    assert read_rows(spark, path, rows(1).schema).count() == 0
    # Two writers that both begin with batch 0, one of them replaying its batch.
    assert write_rows(rows(1), path, "a", 0).version == 1
    assert write_rows(rows(2), path, "b", 0).version == 2
    assert write_rows(rows(3), path, "a", 0) is None
    assert write_rows(rows(4), path, "a", 1).version == 3
    # Rows without a commit, and a commit that is not whole, are not there.
    rows(9).write.parquet(f"{path}/rows/__write=lost")
    (tmp_path / "t" / "_commits" / "000000000099").write_text('{"tables"')
    found = {(r.n, r.version, r["__version"]) for r in read_rows(spark, path).collect()}
    assert found == {(1, "x", 1), (2, "x", 2), (4, "x", 3)}
    assert write_rows(rows(5), path).version == 100
    with pytest.raises(ValueError, match="__version"):
        write_rows(rows(1).withColumn("__version", F.lit(1)), path)


def test_compaction_stands_before_what_came_meanwhile(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = lambda n: spark.createDataFrame([(1, n)], "k bigint, n bigint")
    write_rows(rows(1), path, "w", 0)
    write_rows(rows(2), path, "w", 1)
    old = committed(spark, path)
    write_rows(rows(3), path, "w", 2)
    commit_tables(path, {"rows": rows(2)}, replaced=old)
    assert [(r.n, r["__version"]) for r in read_rows(spark, path).orderBy("__version").collect()] == [(2, 2), (3, 3)]
    assert write_rows(rows(9), path, "w", 1) is None


def test_compaction_leaves_what_is_being_written(spark, tmp_path):
    path, unfinished = str(tmp_path / "t"), tmp_path / "t" / "_commits" / "000000000002"
    rows = lambda k, n: spark.createDataFrame([(k, n)], "k bigint, n bigint")
    write_rows(rows(1, 1), path)
    write_rows(rows(1, 2), path)
    whole = unfinished.read_text()
    unfinished.with_name(f".{unfinished.name}.crc").unlink()
    unfinished.write_text(whole[:-1])
    write_rows(rows(2, 3), path)
    compact_tables(spark, path, {"rows": lambda r: latest_rows(r, ["k"])})
    unfinished.write_text(whole)
    assert {tuple(r) for r in latest_rows(read_rows(spark, path), ["k"]).collect()} == {(1, 2), (2, 3)}
    compact_tables(spark, path, {"rows": lambda r: latest_rows(r, ["k"])})
    assert len(committed(spark, path)) == 1
    assert {(r.k, r.n) for r in read_rows(spark, path).collect()} == {(1, 2), (2, 3)}


def sizes(spark, job):
    rows = read_results(spark, job.metrics_path).where("name = 'Size'").collect()
    return {r.file_name: (r.value, r.reason) for r in rows}


@pytest.mark.parametrize("step", ["export_path", "metrics_path", "manifest_path"])
def test_a_failing_store_is_no_unreadable_file(spark, job, tmp_path, step):
    for i in range(4):
        put(job, f"f{i}.csv", "id,press\n1,400\n")
    assert run(spark, job) == 4
    good = sizes(spark, job)
    assert set(good.values()) == {(1.0, None)}
    for i in range(4):
        put(job, f"f{i}.csv", "id,press\n1,400\n2,7\n")
    kept = getattr(job, step)
    (tmp_path / "blocked").write_text("no folder")
    setattr(job, step, str(tmp_path / "blocked" / "below"))
    with pytest.raises(Exception):
        run(spark, job)
    setattr(job, step, kept)
    assert all(reason is None for _, reason in sizes(spark, job).values())
    assert run(spark, job) == 4
    assert set(sizes(spark, job).values()) == {(2.0, None)}


def test_a_file_that_turns_bad_keeps_its_metrics(spark, job):
    put(job, "good.csv", "id,press\n1,400\n")
    path = Path(job.location) / "a.csv.gz"
    path.write_bytes(gzip.compress(b"id,press\n1,400\n2,7\n"))
    assert run(spark, job) == 2
    path.write_bytes(b"not compressed at all")
    assert run(spark, job) == 0
    assert sizes(spark, job) == {"good.csv": (1.0, None), "a.csv.gz": (2.0, None)}
    assert states(spark, job)["a.csv.gz"] == "N"


def test_a_run_compacts_its_tables(spark, job, monkeypatch):
    monkeypatch.setattr(batch, "MOST_COMMITS", 3)
    for i in range(4):
        put(job, f"f{i}.csv", "id,press\n" + "1,400\n" * (i + 1))
        assert run(spark, job) == 1
    assert len(committed(spark, job.manifest_path)) <= 3
    assert sizes(spark, job) == {f"f{i}.csv": (i + 1.0, None) for i in range(4)}
    assert run(spark, job) == 0


@pytest.mark.parametrize("file_format", ["csv", "json"])
def test_unlike_files_are_one_table(spark, job, tmp_path, file_format):
    job.file_format, job.coerce_numeric = file_format, True
    job.metrics = (
        size()
        + on("Completeness", "press,id")
        + on("DataType", "press")
        + on("Mean", "id")
        + on("Entropy", "press")
        + compliance("p400,both", "press = 400, coalesce(id, press) > 1")
    )
    if file_format == "csv":
        put(job, "a.csv", "id,press,x\n1,400,0\n2,\n")
        put(job, "b.csv", 'press,"id"\n"7,5",1\n')
        put(job, "c.csv", "id\n1\nid\n")
        put(job, "d.csv", "y,press\n1,400\n")
    else:
        put(job, "a.json", '{"id": 1, "press": 400, "x": 0}\n{"id": 2}\n')
        put(job, "b.json", '{"press": 7, "id": 1}\n')
        put(job, "c.json", '{"id": 1}\n{"id": 5}\n')
        put(job, "d.json", '{"press": 400, "y": {"z": 1}}\n')
        put(job, "e.json", '{"press": "text", "id": 3}\n')

    def measured(files, name):
        own = Job(**{**job.__dict__, "metrics_path": str(tmp_path / f"m-{name}"), "manifest_path": str(tmp_path / f"l-{name}")})
        own.export_path, own.listing = None, list_files(spark, job.location, job.bucket).where(F.col("file_name").isin(files))
        run(spark, own)
        found = read_results(spark, own.metrics_path)
        return {(r.file_name, r.instance, r.name): (r.value, r.reason) for r in found.collect()}

    files = [r.file_name for r in list_files(spark, job.location).collect()]
    assert len(batch.groups_of(spark, job, files)) == (1 if file_format == "csv" else 2)
    alone = {k: v for f in files for k, v in measured([f], f).items()}
    assert measured(files, "all") == alone
    assert alone[(f"c.{file_format}", "press", "DataType")] == (None, "unknown column press")

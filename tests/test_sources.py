"""Scans, exports, versioned layers and schema operations."""

import datetime as dt
import gzip
import hashlib
import zlib
from pathlib import Path

import pytest
from conftest import CUSTOMERS, at, rows
from pyspark.sql import functions as F

from terrace.operators.conform import conformed, empty, field, missing_required, relaxed, varchar, with_defaults
from terrace.plans.oplog import RunLog
from terrace.schemas import DATE, INT, LINEAGE_COLUMNS, SOURCE_BY_NAME, TEXT, raw_schema, typed_schema
from terrace.session import written
from terrace.sources import files
from terrace.sources.layers import Layers
from pyspark.sql.types import StructType


def put(folder, name, text):
    path = Path(folder) / name
    path.write_bytes(text.encode("utf-8"))
    return str(path)


def test_scan_by_name(spark, folder):
    path = put(folder, "c.csv", "﻿a,b,c\r\n1,\"x, y\",\r\n2,,z\r\n3\r\n")
    keep = files.scan_by_name(spark, path, ["c", "a", "b", "gone"], keep_blank=True)
    assert rows(keep, "a", "b", "c", "gone") == [("1", "x, y", "", ""), ("2", "", "z", ""), ("3", None, None, "")]
    nulls = files.scan_by_name(spark, path, ["a", "b", "c"])
    assert rows(nulls, "a", "b", "c") == [("1", "x, y", None), ("2", None, "z"), ("3", None, None)]


def test_scan_refuses_a_file_with_another_header(spark, folder):
    put(folder, "1.csv", "a,b\n1,2\n")
    put(folder, "2.csv", "b,a\n1,2\n")
    with pytest.raises(Exception):
        files.scan_by_name(spark, folder, ["a", "b"]).collect()


def test_scan_by_position_ignores_names(spark, folder):
    path = put(folder, "c.csv", "x,y\n1,2\n")
    schema = StructType([field("a", TEXT), field("b", TEXT)])
    assert rows(files.scan_by_position(spark, path, schema), "a", "b") == [("1", "2")]


def test_typed_scan(spark, folder):
    path = put(folder, "c.csv", "a;b\n1;2024-01-02\nx;2024-02-30\n")
    schema = StructType([field("a", INT), field("b", DATE)])
    with pytest.raises(Exception):
        files.scan_typed(spark, path, schema, separator=";").collect()
    kept = files.scan_typed(spark, path, schema, separator=";", tolerate=True)
    assert rows(kept.select("a", "b", files.MALFORMED)) == [(None, None, "x;2024-02-30"), (1, dt.date(2024, 1, 2), None)]


def test_lineage(spark, folder):
    path = put(folder, "c.csv", CUSTOMERS)
    columns = list(SOURCE_BY_NAME["crm_cust_info"].columns)
    staged = written(files.with_lineage(files.scan_by_name(spark, path, columns), columns, "b1", at(1)), "t")
    got = files.with_row_numbers(staged).orderBy("source_row_number").collect()
    assert [r.source_row_number for r in got] == list(range(1, 8))
    assert got[0].source_file.endswith("/c.csv") and {r.batch_id for r in got} == {"b1"}
    payload = "\x1f".join(["12", "AW2", "Bob", "Ng, Jr", "M", "M", "2024-02-30"])
    assert bytes(got[1].row_hash) == hashlib.sha256(payload.encode()).digest()
    assert set(LINEAGE_COLUMNS) <= set(got[0].asDict())


def test_row_numbers_over_many_splits(spark, folder):
    """Files cut into small splits still number every row in file order."""
    for name, n in (("a", 5000), ("b", 1), ("c", 1234)):
        put(folder, f"{name}.csv", "n\n" + "".join(f"{i}\n" for i in range(1, n + 1)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1000")
    try:
        staged = written(files.scan_by_name(spark, folder, ["n"]), "t")
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert staged.select("source_file", "_block").distinct().count() > 20
    numbered = files.with_row_numbers(staged)
    assert numbered.count() == 6235
    assert numbered.filter("source_row_number <> cast(n as bigint)").count() == 0


def test_export_keeps_blanks_and_uses_crlf(spark, folder):
    df = spark.createDataFrame([(" a ", None), ("b,c", "")], "x string, y string").coalesce(1)
    files.export_csv(df, folder + "/out")
    text = next(Path(folder, "out").glob("*.csv")).read_bytes().decode()
    assert text.splitlines(keepends=True)[0] == "x,y\r\n" and text.count("\r\n") == 3 and " a ," in text
    back = files.scan_by_name(spark, folder + "/out", ["x", "y"], keep_blank=True)
    assert rows(back, "x", "y") == [(" a ", ""), ("b,c", "")]


def test_gzipped_export_takes_the_fastest_level(spark, folder):
    words = [(" ".join(hashlib.md5(str(k * j).encode()).hexdigest()[:3] for j in range(12)),) for k in range(4000)]
    files.export_csv(spark.createDataFrame(words, "x string").coalesce(1), folder + "/out", "gzip")
    packed = next(Path(folder, "out").glob("*.csv.gz")).read_bytes()
    plain = gzip.decompress(packed)
    assert len(packed) > (len(zlib.compress(plain, 6)) + len(zlib.compress(plain, 1))) / 2
    assert sorted(plain.decode().split("\r\n")) == sorted(["x", "", *(w for w, in words)])


def test_file_facts(spark, folder):
    put(folder, "a.csv", "12345")
    put(folder, "b.csv", "n\n")
    facts = files.file_facts(spark, folder + "/*.csv")
    assert [(f.source_file.split("/")[-1], f.file_size_bytes) for f in facts.orderBy("source_file").collect()] == [
        ("a.csv", 5), ("b.csv", 2)
    ]
    assert facts.filter("file_modified_at is null").count() == 0


def test_layers_switch_together(spark, folder):
    layers = Layers(spark, folder)
    one, two = spark.range(1), spark.range(2)
    assert layers.tables() == [] and not layers.exists("gold", "a")
    layers.publish({("gold", "a"): layers.write("gold", "a", one), ("gold", "b"): layers.write("gold", "b", one)}, at(1))
    other = Layers(spark, folder)
    assert other.tables("gold") == [("gold", "a"), ("gold", "b")]
    layers.write("gold", "a", two)
    assert Layers(spark, folder).read("gold", "a").count() == 1
    layers.replace("gold", "a", two, at(2))
    assert other.read("gold", "a").count() == 1
    other.refresh()
    assert other.read("gold", "a").count() == 2 and other.read("gold", "b").count() == 1
    with pytest.raises(KeyError):
        layers.read("gold", "c")


def test_rows_may_come_from_the_table_being_replaced(spark, folder):
    layers = Layers(spark, folder)
    layers.replace("silver", "t", spark.range(3), at(1))
    layers.replace("silver", "t", layers.read("silver", "t").filter("id > 0"), at(2))
    assert rows(layers.read("silver", "t")) == [(1,), (2,)]


def test_catalog_tables(spark, folder):
    layers = Layers(spark, folder)
    layers.create_databases(("silver",))
    layers.create_databases(("silver",))
    layers.replace("silver", "numbers", spark.range(3), at(1))
    layers.register("silver")
    layers.define_view_in("silver", "large", "SELECT id FROM silver.numbers WHERE id > 1")
    assert (spark.table("silver.numbers").count(), spark.table("silver.large").count()) == (3, 1)
    layers.replace("silver", "numbers", spark.range(5), at(2))  # views follow what is published
    assert (spark.table("silver.numbers").count(), spark.table("silver.large").count()) == (5, 3)
    layers.publish({("silver", "numbers"): [layers.write("silver", "numbers", spark.range(k)) for k in (2, 4)]}, at(3))
    assert spark.table("silver.numbers").count() == 6 == layers.read("silver", "numbers").count()
    layers.replace("silver", "numbers", spark.range(5), at(4))
    spark.sql("DROP DATABASE silver CASCADE")
    assert layers.read("silver", "numbers").count() == 5


def test_conformed(spark):
    schema = StructType([field("n", INT, False), varchar("s", 3), field("d", DATE), field("new", INT)])
    df = spark.createDataFrame([("7", "abc", "2024-01-02", 1), (None, None, None, 2)], "n string, s string, d string, extra int")
    got = conformed(df, schema)
    assert got.columns == ["n", "s", "d", "new"]
    assert rows(got) == [(None, None, None, None), (7, "abc", dt.date(2024, 1, 2), None)]
    for bad in (("7", "abcd", "2024-01-02"), ("x", "a", "2024-01-02"), ("7", "a", "no")):
        with pytest.raises(Exception, match="longer than 3|CAST_INVALID_INPUT"):
            conformed(spark.createDataFrame([bad], "n string, s string, d string"), schema).collect()
    assert got.filter(missing_required(schema)).count() == 1


def test_relaxed_and_empty(spark):
    schema = raw_schema(SOURCE_BY_NAME["erp_loc_a101"])
    assert not schema["batch_id"].nullable and not schema["row_hash"].nullable
    loose = relaxed(schema, ["batch_id"])
    assert loose["batch_id"].nullable and not loose["row_hash"].nullable
    assert loose["CID"].metadata == schema["CID"].metadata
    assert empty(spark, schema).columns == schema.names
    assert typed_schema(SOURCE_BY_NAME["crm_prd_info"])["prd_start_dt"].dataType.typeName() == "timestamp"


def test_a_table_keeps_its_schema(spark, folder):
    layers = Layers(spark, folder)
    with pytest.raises(ValueError):
        layers.relax("bronze", "t", ["b"], at(1))
    layers.recreate({("bronze", "t"): StructType([field("k", INT, False), field("b", TEXT, False)])}, at(1))
    layers.insert("bronze", "t", spark.createDataFrame([(1, "x")], "k int, b string"), at(2))
    files_before = layers.paths("bronze", "t")
    with pytest.raises(Exception, match="required column"):
        layers.insert("bronze", "t", spark.createDataFrame([(2,)], "k int"), at(3))
    layers.relax("bronze", "t", ["b"], at(4))
    layers.add_columns("bronze", "t", [field("d", DATE)], at(5))
    assert layers.paths("bronze", "t") == files_before
    layers.insert("bronze", "t", spark.createDataFrame([(2,)], "k int"), at(6))
    other = Layers(spark, folder)
    assert rows(other.read("bronze", "t"), "k", "b", "d") == [(1, "x", None), (2, None, None)]
    assert [f.nullable for f in other.schema("bronze", "t")] == [False, True, True]
    layers.replace("bronze", "t", spark.range(1), at(7))
    assert rows(layers.read("bronze", "t"), "id") == [(0,)]


def test_a_run_is_ended_by_another_process(spark, folder):
    first, second = (RunLog(spark, folder, clock=lambda d=d: at(d)) for d in (1, 2))
    job = first.start_job("load")
    task = first.start_task(job, "a")
    assert second.unfinished("load") == job and second.unfinished("other") is None
    second.finish_task(task, "Success", "done", rows_read=3)
    assert second.succeeded(job) == {"a"}
    second.finish_job(job, "Success", "done")
    assert rows(first.job_runs(), "pl_status", "duration_sec", "started_at") == [("Success", 86400, at(1).replace(tzinfo=None))]
    assert first.unfinished("load") is None
    with pytest.raises(KeyError):
        second.finish_job("nobody", "Success", "")


def test_defaults_fill_only_absent_columns(spark):
    df = with_defaults(spark.range(2), {"id": 9, "at": F.lit("x"), "n": 1})
    assert rows(df) == [(0, "x", 1), (1, "x", 1)]


def test_run_log_checks_its_values(spark, folder):
    log = RunLog(spark, folder, clock=lambda: at(1))
    assert log.read("alerts").count() == 0
    job = log.start_job("j")
    assert log.job_runs().first().pl_status == "Running"
    with pytest.raises(ValueError):
        log.finish_job(job, "Done", "")
    with pytest.raises(ValueError):
        log.alert(job, "Bad", "s", "m")
    with pytest.raises(ValueError):
        log.alert(job, "Info", None, "m")
    log.finish_job(job, "Success", "ok")
    assert rows(log.job_runs(), "pl_status", "duration_sec") == [("Success", 0)]
    assert log.read("job_runs").count() == 2


def test_quoted_fields(spark, folder):
    path = Path(folder) / "quoted.csv"
    path.write_text('k,name,cost\n1,"Helmet 12"" red, big",5\n2,"two\nlines",6\n3,short\n4,plain,7,extra\n')
    got = files.scan_by_name(spark, str(path), ["k", "name", "cost"], keep_blank=True, multiline=True)
    assert rows(got, "k", "name", "cost", "wrong_width")[:2] == [("1", 'Helmet 12" red, big', "5", False), ("2", "two\nlines", "6", False)]
    assert rows(got.filter("wrong_width"), "k") == [("3",), ("4",)]
    out = folder + "/out"
    files.export_csv(got.filter("k < 3").select("k", "name", "cost"), out)
    assert rows(files.scan_by_name(spark, out, ["k", "name"], multiline=True), "k", "name") == [("1", 'Helmet 12" red, big'), ("2", "two\nlines")]


def test_empty_files_are_listed(spark, folder):
    (Path(folder) / "a.csv").write_text("k\n1\n")
    (Path(folder) / "b.csv").write_text("")
    got = [(r.source_file.rsplit("/", 1)[1], r.file_size_bytes) for r in files.file_facts(spark, folder).collect()]
    assert sorted(got) == [("a.csv", 4), ("b.csv", 0)]
    (Path(folder) / "deep er" / "still").mkdir(parents=True)
    (Path(folder) / "deep er" / "c d.csv").write_text("")
    (Path(folder) / "deep er" / "still" / "e.csv").write_text("k\n")
    got = files.file_facts(spark, folder, recursive=True)
    assert sorted((r.source_file.rsplit("/", 1)[1], r.file_size_bytes) for r in got.collect()) == [("a.csv", 4), ("b.csv", 0), ("c%20d.csv", 0), ("e.csv", 2)]
    assert got.filter("file_modified_at < current_timestamp() - interval 1 hour or file_modified_at is null").count() == 0


def test_ids_of_log_rows(spark, folder):
    log = RunLog(spark, folder, lambda: at(1))
    counts = spark.range(6).selectExpr("'gold' AS layer_name", "concat('t', id) AS table_name", "id AS row_count")
    stamped = log._stamped("table_row_counts", counts)
    key = stamped.columns[0]
    first = rows(stamped.orderBy("table_name"), key)
    assert first == rows(stamped.repartition(3).orderBy("table_name"), key) and len(set(first)) == 6
    assert all([len(part) for part in value.split("-")] == [8, 4, 4, 4, 12] for (value,) in first)
    assert not set(first) & set(rows(log._stamped("table_row_counts", counts), key))


def test_upsert_that_redelivers_all_or_most_rows_equals_upsert(spark, folder):
    from terrace.operators.upsert import upsert
    from terrace.sources import buckets

    held = spark.createDataFrame([("a", 1, "x"), ("b", 2, "y"), ("c", 3, None)], "k string, n int, v string")
    cases = {
        "into nothing": (held.limit(0), [("a", 1, "x"), ("b", 2, None)]),
        "all": (held, [("a", 9, "z"), ("b", 8, None), ("c", 7, "w"), ("d", 6, "q")]),
        "most": (held, [("a", 9, "z"), ("c", 7, "w")]),
        "no key": (held.unionByName(spark.createDataFrame([(None, 5, "n")], held.schema)), [("a", 9, "z"), ("d", 1, "e")]),
        "key twice": (held.unionByName(held.where("k = 'a'")), [("a", 9, "z")]),
    }
    for label, (target, new) in cases.items():
        incoming = spark.createDataFrame(new, held.schema)
        got = buckets._merged(target, target.count(), incoming, len(new), ["k"], {})
        assert sorted(map(str, got.collect())) == sorted(map(str, upsert(target, incoming, ["k"]).collect())), label


def test_upsert_of_a_full_delivery_shuffles_keys_only(spark):
    from terrace.sources import buckets

    held = spark.range(50).selectExpr("cast(id as string) as k", "repeat('x', 50) as wide")
    plan = buckets._merged(held, 50, held, 50, ["k"], {})._jdf.queryExecution().optimizedPlan().toString()
    assert "FullOuter" not in plan


def test_weight_of_row_numbers_beyond_a_long(spark, folder):
    from terrace.registry.loading import ENTRIES

    big = 1 << 62
    rows = [(big + i, 1, 1, 1, 1.0) for i in range(4)]
    spark.createDataFrame(rows, "l_orderkey bigint, l_linenumber int, l_partkey bigint, l_suppkey bigint, l_extendedprice double").write.parquet(folder + "/lineitem.parquet")
    got = ENTRIES["file_row_numbers"][0](spark, folder).first()
    exact = sum((i + 1) * (big + i) for i in range(4))
    assert (got.row_count, got.numbers, got.highest) == (4, 4, 4)
    assert got.weight == (exact + (1 << 63)) % (1 << 64) - (1 << 63)

from __future__ import annotations

import json
from datetime import datetime

import pytest
from helpers import plan_of, rows
from pyspark.sql import functions as F
from pyspark.sql import types as T

from entitylake.operators import paging
from entitylake.schemas import COUNTS_REPORT, NEXT_LINK, VALUE
from entitylake.sources import csvfiles, pages, snapshots, tables
from entitylake.streaming import arrivals


@pytest.fixture(scope="module")
def things(spark):
    return spark.range(25).select(
        "id",
        F.when(F.col("id") % 2 == 0, F.concat(F.lit('q"\n,é'), F.col("id"))).alias("name"),
        F.expr("timestamp_ntz'2024-01-01 00:00:00.000001' + make_dt_interval(0, 0, 0, id)").alias("at"),
        F.struct(F.col("id").cast("double").alias("x"), F.lit(None).cast("int").alias("y")).alias("nested"),
        F.array(F.lit(0.1).cast("float"), F.lit(None).cast("float")).alias("list"),
        F.lit("Active").alias("state@Display.FormattedValue"),
    )


@pytest.fixture(scope="module")
def others(spark):
    return spark.range(3).select(F.col("id").alias("code"), F.lit(True).alias("ok"))


def save(path, things, others):
    pages.write_pages(
        [paging.all_pages(things, "things", "id", 10), paging.all_pages(others, "others", "code", 10)], path
    )


def test_lake_roundtrip(spark, things, others, tmp_path):
    path = str(tmp_path / "lake")
    save(path, things, others)
    found = pages.read_pages(spark, path, things.schema, "things")
    assert rows(paging.records_of(found.filter("status = 'ok'"))) == rows(things)
    assert sorted(r[NEXT_LINK] or "" for r in found.collect()) == ["", "things?page=2", "things?page=3"]
    assert "PartitionFilters: [isnotnull(entity" in plan_of(found)
    assert rows(paging.records_of(pages.read_pages(spark, path, others.schema, "others"))) == rows(others)


def test_lines_keep_null_fields(spark, things, others, tmp_path):
    path = str(tmp_path / "lake")
    save(path, things, others)
    texts = pages.json_records(pages.read_pages(spark, path, entity="things")).collect()
    assert len(texts) == 25
    first = next(json.loads(r["record"]) for r in texts if json.loads(r["record"])["id"] == 1)
    assert first["name"] is None and first["nested"] == {"x": 1.0, "y": None}


def test_rerun_replaces_only_what_it_writes(spark, things, others, tmp_path):
    path = str(tmp_path / "lake")
    save(path, things, others)
    pages.write_pages(paging.all_pages(things.filter("id < 5"), "things", "id", 10), path)
    assert pages.read_pages(spark, path, things.schema, "things").count() == 1
    assert pages.read_pages(spark, path, others.schema, "others").count() == 1


def test_empty_entity(spark, things, tmp_path):
    nothing = things.filter("id < 0")
    path = str(tmp_path / "lake")
    pages.write_pages(paging.all_pages(nothing, "things", "id"), path)
    (page,) = pages.read_pages(spark, path, things.schema).collect()
    assert page[VALUE] == [] and page[NEXT_LINK] is None
    records = tmp_path / "records"
    pages.write_records({"none": nothing, "some": things}, str(records))
    assert not (records / "entity=none").exists() and (records / "entity=some").is_dir()
    assert rows(pages.read_records(spark, str(records), things.schema, "some")) == rows(things)


RECORD = T.StructType().add("id", T.IntegerType()).add("name", T.StringType())


def page_file(folder, name, document, indent=2):
    folder.mkdir(parents=True, exist_ok=True)
    text = document if isinstance(document, str) else json.dumps(document, indent=indent)
    (folder / name).write_text(text)


def test_one_file_per_page(spark, tmp_path):
    one = {"value": [{"id": 1, "name": "a"}, {"id": 2}], "@odata.nextLink": "u?page=2"}
    page_file(tmp_path / "account", "account_extract_page_1.json", one)
    page_file(tmp_path / "account", "account_extract_page_2.json", {"value": []}, None)
    page_file(tmp_path / "my lead", "my lead_page_10.json", {"value": [{"id": 3}]})
    page_file(tmp_path / "bad", "bad_page_1.json", {"error": {"code": "0x1", "message": "no"}})
    page_file(tmp_path / "bad", "bad_page_2.json", '{"value": [')
    found = pages.read_page_files(spark, str(tmp_path), RECORD)
    got = {(r["entity"], r["page_number"]): r for r in found.collect()}
    assert {key: r["status"] for key, r in got.items()} == {
        ("account", 1): "ok", ("account", 2): "ok", ("my lead", 10): "ok", ("bad", 1): "error", ("bad", 2): "corrupt",
    }
    assert got["account", 1][NEXT_LINK] == "u?page=2"
    assert got["bad", 1]["error"]["message"] == "no"
    records = paging.unpage(found).select("entity", "page_number", "position", "id", "name")
    assert rows(records) == [("account", 1, 0, 1, "a"), ("account", 1, 1, 2, None), ("my lead", 10, 0, 3, None)]
    assert pages.read_page_files(spark, str(tmp_path), RECORD, "account").count() == 2


def test_csv(spark, tmp_path):
    made = [("1", "a", 'say "hi", or\nnot', " padded ", 3), ("2", None, "x", "", 0)]
    df = spark.createDataFrame(made, COUNTS_REPORT)
    csvfiles.write_csv(df, str(tmp_path / "c"))
    back = csvfiles.read_csv(spark, str(tmp_path / "c"), COUNTS_REPORT)
    assert rows(back) == [("1", "a", 'say "hi", or\nnot', " padded ", 3), ("2", None, "x", None, 0)]


def test_collections(spark, tmp_path):
    spark.range(2).write.parquet(str(tmp_path / "a.parquet"))
    found = tables.read_collections(spark, str(tmp_path), ["a", "b"])
    assert list(found) == ["a"] and tables.scan_many(found).columns == ["entity", "id"]


STATE = {
    "last_updated": "2023-05-01 10:11:12.123456",
    "endpoints": {"account": "accounts"},
    "record_counts": {"account": {"record_count": 5, "last_updated": "x"}},
    "entities": {"account": {"LogicalName": "account"}},
}


def test_environments(spark, tmp_path):
    document = {"u1": STATE, "u2": {**STATE, "last_updated": "2023-05-01 10:11:12"}, "u3": {"last_updated": "None"}}
    page_file(tmp_path, "good.json", document)
    page_file(tmp_path, "bad.json", '{"u9": {')
    page_file(tmp_path, "empty.json", "")
    found = snapshots.read_environments(spark, str(tmp_path))
    assert sorted(r["base_url"] for r in found.collect()) == ["u1", "u2", "u3"]
    one = snapshots.environment(found, "u1").first()
    assert one["last_updated"] == datetime(2023, 5, 1, 10, 11, 12, 123456)
    assert one["record_counts"]["account"]["record_count"] == 5
    assert one["entities"]["account"]["LogicalName"] == "account"
    assert snapshots.environment(found, "u2").first()["last_updated"] == datetime(2023, 5, 1, 10, 11, 12)
    assert snapshots.environment(found, "u3").first()["last_updated"] is None
    assert snapshots.environment(found, "u4").count() == 0
    snapshots.write_environments(found, str(tmp_path / "again"))
    again = snapshots.read_environments(spark, str(tmp_path / "again"), whole_files=False)
    assert again.count() == 3 and snapshots.environment(again, "u1").first()["endpoints"] == {"account": "accounts"}


def test_snapshot_versions(spark, tmp_path):
    schema = "base_url string, entity string, record_count bigint, last_updated string"
    one, two = str(tmp_path / "v1"), str(tmp_path / "v2")
    time = "2023-05-01 10:11:12.000000"
    snapshots.write_snapshot(spark.createDataFrame([("u", "a", 1, time), ("w", "a", 2, time)], schema), one)
    newer = spark.createDataFrame([("u", "b", 3, "2024-05-01 10:11:12")], schema)
    snapshots.write_snapshot(newer, two, current=one)
    loaded = snapshots.read_snapshot(spark, two, newer.schema)
    assert rows(loaded.select("base_url", "entity", "record_count")) == [("u", "b", 3), ("w", "a", 2)]
    assert snapshots.read_snapshot(spark, two, newer.schema, "u").first()["last_updated"] == datetime(2024, 5, 1, 10, 11, 12)
    with pytest.raises(ValueError, match="new path"):
        snapshots.write_snapshot(newer, two, current=two + "/")


def test_streams_take_every_page_once(spark, things, others, tmp_path):
    lake, out, mark = (str(tmp_path / name) for name in ("lake", "out", "mark"))
    pages.write_pages(paging.all_pages(things.filter("id < 12"), "things", "id", 5), lake)
    stream = arrivals.page_stream(spark, lake, things.schema, files_per_trigger=1)
    arrivals.finish(arrivals.append_records(stream, out, mark), 60)
    assert spark.read.parquet(out).count() == 12
    arrivals.finish(arrivals.append_records(stream, out, mark), 60)
    assert spark.read.parquet(out).count() == 12
    more = paging.all_pages(things.filter("id >= 12"), "things", "id", 5).withColumn("page_number", F.col("page_number") + 3)
    for _ in range(2):  # the second time under other names
        pages.page_lines(more).write.mode("append").partitionBy("entity").text(lake)
        arrivals.finish(arrivals.append_records(stream, out, mark), 60)
        assert rows(spark.read.parquet(out).drop("entity", "page_number", "position")) == rows(things)


def test_pages_that_land_again_count_once(spark, tmp_path):
    """In one batch, in a later one, after a restart, and after a cut-off copy of the page."""
    out, counts = str(tmp_path / "out"), str(tmp_path / "counts")
    lake = tmp_path / "lake"
    record = T.StructType.fromDDL("id bigint")

    def land(name, *lines):
        (lake / "entity=x").mkdir(parents=True, exist_ok=True)
        (lake / "entity=x" / name).write_text("\n".join(lines) + "\n")

    def run():
        stream = arrivals.page_stream(spark, str(lake), record, files_per_trigger=1)
        arrivals.finish(arrivals.append_records(stream, out, str(tmp_path / "m1")), 60)
        arrivals.finish(arrivals.write_progress(stream, counts, str(tmp_path / "m2")), 60)
        records = spark.read.parquet(out)
        return rows(records.select("page_number", "id")), rows(arrivals.latest_progress(spark, counts))

    one, two, three = ('{"page_number":%d,"value":[{"id":%d}]}' % (n, 10 * n) for n in (1, 2, 3))
    land("a.json", one, one, three[:-3])
    land("b.json", one, two)
    assert run() == ([(1, 10), (2, 20)], [("x", 2, 2)])
    land("c.json", two, three)
    land("d.json", three, three)
    assert run() == ([(1, 10), (2, 20), (3, 30)], [("x", 3, 3)])
    land("e.json", one)
    assert run() == ([(1, 10), (2, 20), (3, 30)], [("x", 3, 3)])


def test_pages_by_files_alone(spark, things, tmp_path):
    lake, out, mark = (str(tmp_path / name) for name in ("lake", "out", "mark"))
    made = pages.page_lines(paging.all_pages(things.filter("id < 5"), "things", "id", 5))
    for _ in range(2):
        made.write.mode("append").partitionBy("entity").text(lake)
    stream = arrivals.page_stream(spark, lake, things.schema)
    kept = arrivals.once_per_page(stream, remembered=None)
    assert "dropDuplicates" not in str(kept._jdf.queryExecution().logical())
    arrivals.finish(arrivals.append_records(stream, out, mark, remembered=None), 60)
    assert spark.read.parquet(out).count() == 10


def test_progress(spark, things, others, tmp_path):
    lake, out, mark = (str(tmp_path / name) for name in ("lake", "out", "mark"))
    save(lake, things, others)
    stream = arrivals.page_stream(spark, lake, files_per_trigger=1)
    arrivals.finish(arrivals.write_progress(stream, out, mark), 60)
    assert rows(arrivals.latest_progress(spark, out)) == [("others", 1, 3), ("things", 3, 25)]


def test_stream_of_page_files(spark, tmp_path):
    out, mark = (str(tmp_path / name) for name in ("out", "mark"))
    folder = tmp_path / "in" / "account"
    page_file(folder, "account_page_1.json", {"value": [{"id": 1}, {"id": 2}], "@odata.nextLink": "x"})
    stream = arrivals.page_stream(spark, str(tmp_path / "in"), RECORD, file_per_page=True)
    arrivals.finish(arrivals.append_records(stream, out, mark), 60)
    page_file(folder, "account_page_2.json", {"value": [{"id": 3}]})
    page_file(folder, "account_page_3.json", {"value": []})
    arrivals.finish(arrivals.append_records(stream, out, mark), 60)
    records = spark.read.parquet(out).select("entity", "page_number", "position", "id")
    assert rows(records) == [("account", 1, 0, 1), ("account", 1, 1, 2), ("account", 2, 0, 3)]


def test_malformed_lines_give_no_records(spark, tmp_path):
    folder = tmp_path / "r" / "entity=x"
    folder.mkdir(parents=True)
    (folder / "a.json").write_text('{"id":1}\n{"id":\n{"id":"no"}\n{"id":2}\n')
    schema = T.StructType.fromDDL("id bigint")
    found = pages.read_records(spark, str(tmp_path / "r"), schema, "x")
    assert rows(found) == [(1,), (2,)]
    assert pages.load_records(spark, str(tmp_path / "r"), schema, "x").filter("status = 'corrupt'").count() == 2
    with pytest.raises(Exception, match="corrupt"):
        pages.read_records(spark, str(tmp_path / "r"), schema, "x", strict=True).collect()


def test_damaged_pages_are_set_aside(spark, tmp_path):
    folder = tmp_path / "p" / "entity=x"
    folder.mkdir(parents=True)
    lines = [
        '{"page_number":1,"value":[{"id":1},{"id":2}]}', '{"page_number":2,"value":[{"id":3}', '{"page_number":3,"error":{"code":"E"}}',
        '{"page_number":4,"value":[{"id":"no"}]}', '{"page_number":5,"value":[{"id":9}]}',
    ]
    (folder / "a.json").write_text("\n".join(lines))
    saved = pages.read_pages(spark, str(tmp_path / "p"), T.StructType.fromDDL("id bigint"), "x")
    assert rows(paging.records_of(saved)) == [(1,), (2,), (9,)]
    aside = pages.set_aside(saved).collect()
    assert sorted(r["status"] for r in aside) == ["corrupt", "corrupt", "error"]
    assert {r["text"] for r in aside} == {lines[1], lines[3], None}
    with pytest.raises(Exception, match="page"):
        paging.records_of(saved, strict=True).collect()
    plain = pages.read_pages(spark, str(tmp_path / "p"))
    # without a record schema a field cannot be wrong
    assert pages.json_records(plain).count() == 4


def test_environments_are_upserted_as_wholes(spark, tmp_path):
    schema = "base_url string, entity string, record_count bigint, last_updated string"
    one, two = str(tmp_path / "1"), str(tmp_path / "2")
    old = spark.createDataFrame([("u", f"e{i}", i, "t") for i in range(25)] + [("w", "a", 1, "t")], schema)
    documents = snapshots.count_documents(old, max_entries=10)
    assert sorted((r["base_url"], len(r["record_counts"])) for r in documents.collect()) == [("u", 5), ("u", 10), ("u", 10), ("w", 1)]
    snapshots.write_environments(documents, one)
    new = spark.createDataFrame([("u", "z", 7, "t"), ("v", "y", 8, "t")], schema)
    snapshots.upsert_environments(snapshots.count_documents(new), two, one)
    found = snapshots.read_environments(spark, two, whole_files=False).select("base_url", F.map_keys("record_counts"))
    assert rows(found) == [("u", ["z"]), ("v", ["y"]), ("w", ["a"])]
    with pytest.raises(ValueError):
        snapshots.upsert_environments(documents, one, one)


def test_one_environment_reads_its_directory_only(spark, tmp_path):
    schema = "base_url string, entity string, record_count bigint, last_updated string"
    df = spark.createDataFrame([("u", "a", 1, "2023-05-01 10:11:12"), ("w", "a", 2, None)], schema)
    snapshots.write_snapshot(df, str(tmp_path / "s"))
    found = snapshots.read_snapshot(spark, str(tmp_path / "s"), df.schema, "u")
    assert found.count() == 1 and "PartitionFilters: [isnotnull(base_url" in plan_of(found)


def test_escaped_csv_keeps_line_breaks(spark, tmp_path):
    texts = ["a\nb", "c\\n", "\\", 'q"\r\n"x, y', " ", "\\s\n\\r", None]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, t string")
    csvfiles.write_csv(df, str(tmp_path / "c"), escaped=True)
    assert rows(csvfiles.read_csv(spark, str(tmp_path / "c"), df.schema, escaped=True)) == rows(df)
    assert spark.read.text(str(tmp_path / "c")).count() >= len(texts) + 1

"""Ingest of JSON files and the sinks, on files written here."""

import gzip
import json
import random
import tracemalloc

import pytest
from conftest import ts, values
from pyspark.sql import functions as F

from tributary.sources.ingest import (
    load_stations,
    read_landing_lines,
    read_records,
    to_landing,
)
from tributary.sources import json_stream, scratch
from tributary.sources.scratch import scratch_dir
from tributary.sources.sinks import append, full_refresh

RECORDS = [
    {"fecha": "2024-01-01 00:00:00 PYST", "nivel": 1.5, "ph": None, "nota": "x"},
    {"fecha": None, "nivel": 2, "ph": 7.0},
]


def write(path, payload):
    text = payload if isinstance(payload, str) else json.dumps(payload)
    if path.suffix == ".gz":
        with gzip.open(path, "wt", encoding="utf-8") as file:
            file.write(text)
    else:
        path.write_text(text, encoding="utf-8")
    return str(path)


@pytest.mark.parametrize("name", ["r.json", "r.json.gz"])
@pytest.mark.parametrize(
    "payload, rows",
    [(RECORDS, 2), ({"results": RECORDS}, 2), (RECORDS[0], 1), ([], 0), ({"results": []}, 0)],
    ids=["list", "envelope", "single", "empty list", "empty envelope"],
)
def test_layouts_of_whole_files(spark, tmp_path, name, payload, rows):
    path = write(tmp_path / name, payload)
    whole = to_landing(read_records(spark, path, whole_files=True), "s")
    lines = to_landing(read_records(spark, path), "s")
    assert whole.count() == lines.count() == rows
    assert values(whole, "raw_payload") == values(lines, "raw_payload")


@pytest.mark.parametrize("whole_files", [True, False])
def test_a_record_may_have_a_field_like_the_envelope(spark, tmp_path, whole_files):
    inner = {"fecha": "2024-01-01", "results": [{"fecha": "2024-01-02"}]}
    path = write(tmp_path / "r.json", [inner])
    landing = to_landing(read_records(spark, path, whole_files), "s")
    assert values(landing, "measurement_ts") == [("2024-01-01",)]


def test_layouts_line_by_line(spark, tmp_path):
    lines = [RECORDS, {"results": RECORDS}, RECORDS[0]]
    path = write(tmp_path / "lines.json", "\n".join(json.dumps(line) for line in lines))
    assert read_records(spark, path).count() == 5


def test_payload_keeps_the_whole_record(spark, tmp_path):
    path = write(tmp_path / "r.json", RECORDS)
    landing = to_landing(read_records(spark, path, whole_files=True), "s", F.lit(ts("2024-06-01")))
    rows = {row.measurement_ts: row for row in landing.collect()}
    kept = rows["2024-01-01 00:00:00 PYST"]
    assert json.loads(kept.raw_payload) == RECORDS[0]
    assert json.loads(rows[None].raw_payload) == RECORDS[1]
    assert (kept.station_name, kept.extracted_at) == ("s", ts("2024-06-01"))


def test_one_load_time_for_all_rows(spark, tmp_path):
    path = write(tmp_path / "r.json", RECORDS)
    landing = to_landing(read_records(spark, path, whole_files=True), "s")
    assert landing.select("extracted_at").distinct().count() == 1


def cut(text, fragments=1):
    """The text as it comes from the reader: pieces without the cuts between them."""
    parts = text.split(json_stream.CUT)
    return (json_stream.CUT.join(parts[at : at + fragments]) for at in range(0, len(parts), fragments))


@pytest.mark.parametrize("fragments", [1, 2, 7, 1000])
def test_records_are_cut_out_of_pieces(fragments):
    choose = random.Random(3)
    strings = ["", "a,b", ',"', "\\", '[{"', "é\n", "]}", "x" * 50]
    value = lambda deep: choose.choice([
        1, -2.5e3, None, True, choose.choice(strings),
        *([[value(deep - 1) for _ in range(3)], {choose.choice(strings): value(deep - 1), "k": [], "e": {}}] if deep else []),
    ])
    for _ in range(200):
        rows = [{f"f{n}": value(3) for n in range(choose.randint(0, 4))} for _ in range(choose.randint(0, 6))]
        indent = choose.choice([None, 1])
        for payload, expected in (
            (rows, rows), ({"n": [1, 2], "results": rows, "next": None}, rows), ({"a": rows}, [{"a": rows}]),
        ):
            text = json.dumps(payload, indent=indent) + choose.choice(["", "\n "])
            found = [json.loads(record) for record in json_stream.records(cut(text, fragments))]
            assert found == expected
            if text.rstrip()[-1] in "]}":
                whole = text.rstrip()
                with pytest.raises(ValueError, match="malformed|not an object"):
                    list(json_stream.records(cut(whole[: choose.randint(1, len(whole) - 1)], fragments)))
                with pytest.raises(ValueError, match="malformed"):
                    list(json_stream.records(cut(whole + choose.choice(["]", ",", "{}"]), fragments)))


def test_a_large_array_is_read_in_bounded_memory():
    record = json.dumps({"fecha": "2024-01-01", "nota": "x" * 300, "valores": [1, 2, 3]})

    def pieces():
        yield "["
        body = record.removeprefix("{")
        for _ in range(299):
            yield "{".join([body + ","] * 1000)
        yield "{".join([body + ","] * 999)
        yield body + "]"

    tracemalloc.start()
    count = sum(1 for _ in json_stream.records(pieces()))
    _, peak = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert count == 300_000 and peak < 8 << 20  # of more than 100 MB


@pytest.mark.parametrize("envelope", [False, True])
def test_an_array_file_beyond_a_variant_value(spark, tmp_path, database, envelope):
    path = tmp_path / "s.json.gz"
    record = json.dumps({"fecha": "2024-01-01 00:00:00 PYST", "nivel": 1.5, "nota": "x{ y" * 10, "a": "a" * 10_000})
    with gzip.open(path, "wt", compresslevel=1) as file:
        file.write('{"next": null, "results": [' if envelope else "[")
        for n in range(150):
            file.write((", " if n else "") + ",\n".join([record] * 100))
        file.write("]}" if envelope else "]")
    assert load_stations(spark, {"s": str(path)}, database, whole_files=True).first().rows == 15_000
    # A file that ends too early fails its station, whether the archive or the JSON is cut.
    whole = path.read_bytes()
    path.write_bytes(whole[: len(whole) // 2])
    short = write(tmp_path / "t.json.gz", "[" + record)
    outcome = load_stations(spark, {"s": str(path), "t": short}, database, whole_files=True)
    assert [row.status for row in outcome.collect()] == ["failed", "failed"]
    assert "malformed JSON" in outcome.where("station = 't'").first().error
    assert spark.table(f"{database}.hidro_estacion_s").count() == 15_000


def test_files_read_in_parts_keep_their_order(spark, tmp_path):
    """Several files, cut into parts of a few kilobytes each by the reader."""
    expected = []
    for name, count in (("a.json", 3000), ("b.json.gz", 500), ("c.json", 1), ("d.json", 2000)):
        rows = [{"fecha": f"{name} {n}", "lista": [n, {"k": "},{"}]} for n in range(count)]
        write(tmp_path / name, json.dumps(rows, indent=1))
        expected += [row["fecha"] for row in rows]
    size = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(size)
    spark.conf.set(size, "8k")
    try:
        landing = to_landing(read_records(spark, str(tmp_path), whole_files=True), "s")
        assert landing.rdd.getNumPartitions() > 1
        assert sorted(row.measurement_ts for row in landing.collect()) == sorted(expected)
    finally:
        spark.conf.set(size, before)


def test_landing_lines(spark, tmp_path):
    line = {
        "station_name": "s", "measurement_ts": "2024-01-01", "raw_payload": RECORDS[0],
        "extracted_at": "2024-06-01T06:00:00.123456",
    }
    path = write(tmp_path / "l.ndjson", json.dumps(line) + "\n")
    row = read_landing_lines(spark, path).first()
    assert json.loads(row.raw_payload) == RECORDS[0]
    assert row.extracted_at == ts("2024-06-01 06:00:00.123456")
    with pytest.raises(Exception, match="MALFORMED"):
        read_landing_lines(spark, write(tmp_path / "bad.ndjson", "{oops\n")).collect()


@pytest.mark.parametrize("options", [{"whole_files": True}, {"whole_files": False}])
def test_other_ways_to_load_a_station(spark, tmp_path, database, options):
    path = write(tmp_path / "s.json", RECORDS)
    outcome = load_stations(spark, {"s": path}, database, **options).first()
    assert (outcome.status, outcome.rows) == ("ok", 2)
    assert spark.table(f"{database}.hidro_estacion_s").where("raw_payload like '%nivel%'").count() == 2


def test_every_station_has_an_outcome(spark, tmp_path, database):
    paths = {
        "good": write(tmp_path / "good.json.gz", RECORDS),
        "gone": str(tmp_path / "gone.json"),
        "broken": write(tmp_path / "broken.json", "[{oops"),
        "last": write(tmp_path / "last.json", {"results": RECORDS[:1]}),
    }
    got = load_stations(spark, paths, database)
    assert values(got, "station", "status", "rows") == [
        ("broken", "failed", None), ("gone", "failed", None), ("good", "ok", 2), ("last", "ok", 1),
    ]
    assert got.where("status = 'failed' and error is null").count() == 0
    assert spark.table(f"{database}.hidro_estacion_good").count() == 2
    assert not spark.catalog.tableExists(f"{database}.hidro_estacion_gone")


@pytest.mark.parametrize("payload", ["null", "[1, 2]", '[{"fecha": "2024-01-01"}, null]', "7"])
def test_what_is_no_record_fails_the_load(spark, tmp_path, database, payload):
    path = write(tmp_path / "s.json", payload)
    outcome = load_stations(spark, {"s": path}, database).first()
    assert outcome.status == "failed" and "not an object" in outcome.error


@pytest.mark.parametrize("payload", [{"results": None}, {"results": {"fecha": "x"}}, {"results": 3}])
def test_an_envelope_without_a_list_fails_and_keeps_the_table(spark, tmp_path, database, payload):
    path = tmp_path / "s.json"
    for content, status in ((RECORDS, "ok"), (payload, "failed")):
        write(path, content)
        outcome = load_stations(spark, {"s": str(path)}, database).first()
        assert outcome.status == status
    assert "results is not a list" in outcome.error
    assert spark.table(f"{database}.hidro_estacion_s").count() == 2


def test_files_over_several_lines_name_the_remedy(spark, tmp_path, database):
    path = write(tmp_path / "s.json", json.dumps(RECORDS, indent=1))
    assert "whole_files" in load_stations(spark, {"s": path}, database).first().error
    assert load_stations(spark, {"s": path}, database, whole_files=True).first().rows == 2


def test_empty_file_has_no_rows(spark, tmp_path, database):
    path = write(tmp_path / "s.json", "")
    outcome = load_stations(spark, {"s": path}, database).first()
    assert (outcome.status, outcome.rows) == ("ok", 0)


def test_failed_or_empty_load_keeps_the_table(spark, tmp_path, database):
    path = tmp_path / "s.json"
    for payload, status, rows in [
        (RECORDS, "ok", 2), ("[{oops", "failed", None), ([], "ok", 0), (RECORDS[:1], "ok", 1),
    ]:
        write(path, payload)
        outcome = load_stations(spark, {"s": str(path)}, database).first()
        assert (outcome.status, outcome.rows) == (status, rows)
        kept = spark.table(f"{database}.hidro_estacion_s").count()
        assert kept == (1 if rows == 1 else 2)


def test_full_refresh_and_append(spark, database):
    table = f"{database}.t"
    assert full_refresh(spark.range(5), table) == 5
    append(spark.range(2), table)
    append(spark.range(2), table)
    assert spark.table(table).count() == 9
    assert full_refresh(spark.range(3).withColumnRenamed("id", "other"), table) == 3
    assert spark.table(table).columns == ["other"]
    assert full_refresh(spark.range(0), table, keep_if_empty=True) == 0
    assert spark.table(table).count() == 3
    assert full_refresh(spark.range(0), table) == 0
    assert spark.table(table).count() == 0


def test_rows_before_stay_readable_for_one_refresh(spark, database):
    table = f"{database}.t"
    full_refresh(spark.range(5), table)
    before = spark.table(table)
    full_refresh(spark.range(3), table)
    assert before.count() == 5 and spark.table(table).count() == 3
    with pytest.raises(Exception, match="oops"):
        full_refresh(spark.range(2).select(F.raise_error(F.lit("oops")).cast("long").alias("id")), table)
    assert spark.table(table).count() == 3


def test_scratch_is_in_the_warehouse_without_a_shared_folder(spark, monkeypatch):
    monkeypatch.setattr(scratch, "SETTING", "spark.no.such.setting")
    warehouse = spark.conf.get("spark.sql.warehouse.dir").removeprefix("file:")
    assert scratch_dir(spark, "x").removeprefix("file:").startswith(f"{warehouse}/_scratch/x-")


def test_scratch_is_under_the_shared_folder(spark):
    shared = spark.conf.get("spark.checkpoint.dir")
    first, second = scratch_dir(spark, "x"), scratch_dir(spark, "x")
    assert first.startswith(shared) and first != second

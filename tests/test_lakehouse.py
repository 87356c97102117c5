import json
from datetime import datetime, timedelta, timezone
from pathlib import Path

import pytest
from pyspark.sql.types import StringType, StructField

from stayspark.plans.lakehouse import Lakehouse
from stayspark.plans.store import TableStore
from stayspark.sources import manifest as control
from stayspark.streaming import bronze as streams
from tests.test_operators import GOOD

NOW = datetime(2026, 6, 5, tzinfo=timezone.utc)


def batch(folder: Path, files: dict[str, list[str]], counts: dict[str, int] | None = None, name: str = "b") -> str:
    folder.mkdir(parents=True)
    for f, lines in files.items():
        (folder / f).write_text("".join(line + "\n" for line in lines))
    doc = {"status": "complete", "batch_id": name, "airflow_dag_id": "d", "airflow_run_id": "r", "airflow_try_number": 1, "stays": [{"output_file": f, "publishable_records": (counts or {}).get(f, len(lines))} for f, lines in files.items()]}
    (folder / control.MANIFEST).write_text(json.dumps(doc))
    return str(folder / control.MANIFEST)


def line(**more) -> str:
    return json.dumps({**GOOD, **more})


def house(spark, tmp_path) -> Lakehouse:
    return Lakehouse.at(spark, f"{tmp_path}/lake", clock=lambda: NOW)


def test_clean_batch_then_again(spark, tmp_path):
    lake = house(spark, tmp_path)
    path = batch(tmp_path / "in", {"a.jsonl": [line(hotel_name=f"H{k}") for k in range(3)] + [line(hotel_name="H0")]})
    first = lake.run(path)
    assert first["bronze"] == {"input_records": 4, "output_records": 3, "quarantined_records": 0, "skipped_files": 0}
    assert first["silver"]["output_records"] == 3
    assert first["gold"]["gold_entity_daily"] == 3
    again = lake.run(path)
    assert again["bronze"] == {"input_records": 0, "output_records": 0, "quarantined_records": 0, "skipped_files": 1}
    assert again["silver"]["output_records"] == 0
    assert lake.store.read("history").count() == 3
    assert {(r["layer"], r["status"]) for r in lake.store.read("audit").collect()} == {("bronze", "success"), ("silver", "success"), ("gold", "success")}
    row = lake.store.read("history").first()
    assert (row["batch_id"], row["airflow_try_number"], row["source_file_path"]) == ("b", 1, str(tmp_path / "in/a.jsonl"))


def test_malformed_lines_are_quarantined(spark, tmp_path):
    lake = house(spark, tmp_path)
    path = batch(tmp_path / "in", {"a.jsonl": [line(hotel_name=f"H{k}") for k in range(18)] + ['{"a": ', ""]})
    out = lake.run(path)
    assert out["bronze"]["quarantined_records"] == 2
    assert lake.store.read("bronze").count() == 18
    assert {(r["quarantine_layer"], r["failure_reason"]) for r in lake.store.read("quarantine").collect()} == {("bronze", "malformed_json")}


def test_too_many_malformed_or_wrong_counts_load_nothing(spark, tmp_path):
    lake = house(spark, tmp_path)
    lake.setup()
    with pytest.raises(ValueError, match="too many"):
        lake.bronze(batch(tmp_path / "x", {"a.jsonl": [line(hotel_name=f"H{k}") for k in range(8)] + ["x", "y"]}, name="x"))
    assert lake.store.read("quarantine").count() == 2
    with pytest.raises(ValueError, match="differ"):
        lake.bronze(batch(tmp_path / "y", {"a.jsonl": [line()] * 3, "b.jsonl": [line(hotel_name="B")]}, {"a.jsonl": 4}, name="y"))
    assert lake.store.read("bronze").count() == 0
    assert {(r["batch_id"], r["status"]) for r in lake.store.read("ledger").collect()} == {("x", "failed"), ("y", "failed")}
    assert {(r["batch_id"], r["status"]) for r in lake.store.read("audit").collect()} == {("x", "failed"), ("y", "failed")}


def test_invalid_rows_are_quarantined_with_reasons(spark, tmp_path):
    lake = house(spark, tmp_path)
    rows = [line(hotel_name=f"H{k}") for k in range(19)] + [line(price_value="free", check_out="2026-06-01")]
    assert lake.run(batch(tmp_path / "in", {"a.jsonl": rows}))["silver"] == {"input_records": 20, "output_records": 19, "quarantined_records": 1}
    bad = lake.store.read("quarantine").first()
    assert bad["failure_reason"] == "invalid_price_value;check_out_not_after_check_in"
    assert bad["quarantine_layer"] == "silver"


def test_types_drift_and_lines_stay_whole(spark, tmp_path):
    lake = house(spark, tmp_path)
    raw = line(price_value=1250.5, rating_text=8, extra={"k": 1}, hotel_name={"n": 1})
    lake.run(batch(tmp_path / "in", {"a.jsonl": [raw]}))
    row = lake.store.read("bronze").first()
    assert (row["price_value"], row["rating_text"], row["hotel_name"], row["raw_record_json"]) == ("1250.5", "8", '{"n":1}', raw)


def test_store(spark, tmp_path):
    store = TableStore(spark, f"{tmp_path}/s")
    store.create("t", "k long, v string")
    df = lambda *rows: spark.createDataFrame(list(rows), "k long, v string")
    assert store.insert_only("t", df((1, "a"), (1, "a"), (2, "b")), ["k"]) == 2
    assert store.insert_only("t", df((2, "z"), (3, "c")), ["k"]) == 1
    assert store.insert_only("t", df((2, "z")), ["k"]) == 0
    store.upsert("t", df((2, "B"), (4, "d")), ["k"])
    rows = lambda: sorted(map(tuple, store.read("t").collect()))
    assert rows() == [(1, "a"), (2, "B"), (3, "c"), (4, "d")]
    with pytest.raises(ValueError, match="several"):
        store.upsert("t", df((1, "x"), (1, "y")), ["k"])
    assert store.add_columns("t", [StructField("w", StringType())]) == ["w"]
    assert store.read("t").where("w is not null").count() == 0
    assert store.rename_column("t", "v", "u")
    assert not store.rename_column("t", "v", "u")
    assert store.read("t").columns == ["k", "u", "w"]
    # A crash between writing and publishing leaves the old version.
    store._write("t", spark.createDataFrame([(9, "9", "9")], "k long, u string, w string"))
    assert store.read("t").count() == 4
    assert store.vacuum("t") >= 1
    assert store.read("t").count() == 4
    with pytest.raises(ValueError, match="missing"):
        store.require("t", "gone")


def test_manifest_checks(tmp_path):
    good = {"status": "complete", "batch_id": "b", "airflow_dag_id": "d", "airflow_run_id": "r", "airflow_try_number": 1, "stays": [{"output_file": "a.jsonl", "publishable_records": 2}]}
    assert control.declared_counts(good, "/v/run_manifest.json") == {"/v/a.jsonl": 2}
    for change in ({"status": "running"}, {"batch_id": " "}, {"airflow_try_number": 0}, {"stays": []}, {"stays": [{"output_file": "../x.jsonl", "publishable_records": 1}]}, {"stays": [{"output_file": "x.json", "publishable_records": 1}]}, {"stays": [{"output_file": "x.jsonl", "publishable_records": "3"}]}, {"stays": good["stays"] * 2}):
        with pytest.raises(ValueError, match="."):
            control.declared_counts({**good, **change}, "/v/run_manifest.json")
    for path in ("v/run_manifest.json", "/v/../run_manifest.json", "/w/run_manifest.json", "/v/x.json"):
        with pytest.raises(ValueError, match="manifest"):
            control.safe_manifest_path(path, "/v")


def test_run_lifecycle_and_retention(tmp_path):
    run = control.Run(tmp_path, "dag a", "run/1", 1, NOW, [])
    assert "dag_id=dag%20a" in str(run.folder)
    (run.folder / "a.jsonl").write_text("{}\n")
    run.add_stay("a.jsonl", 2, 1)
    pointer = run.complete(NOW)
    assert control.validate_local(pointer)["stays"][0]["discarded_records"] == 1
    with pytest.raises(FileExistsError):
        control.Run(tmp_path, "dag a", "run/1", 1, NOW, [])
    later = NOW + timedelta(days=20)
    assert control.clean_up(tmp_path, later) == []
    receipt = control.land(run.folder, tmp_path / "landed")
    assert [f["local_file"] for f in receipt["files"]] == ["a.jsonl", control.MANIFEST]
    assert control.clean_up(tmp_path / "dag_id=dag%20a", later, current="dag a__run/1") == []
    assert control.clean_up(tmp_path / "dag_id=dag%20a", NOW + timedelta(days=3)) == []
    assert control.clean_up(tmp_path / "dag_id=dag%20a", later) == [run.folder]
    assert not run.folder.exists()


def test_stream_into_store_is_idempotent(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in/a.jsonl").write_text(line() + "\n" + line() + "\nbroken\n")
    store = TableStore(spark, f"{tmp_path}/s")
    parsed = streams.parsed(streams.read_lines(spark, f"{tmp_path}/in"))
    store.create("t", parsed.schema)
    for _ in range(2):
        streams.into_store(parsed, store, "t", ["record_id"], f"{tmp_path}/c").awaitTermination()
    assert sorted(r["is_object"] for r in store.read("t").collect()) == [False, True]
    (tmp_path / "in/b.jsonl").write_text(line(hotel_name="B") + "\n")
    streams.into_store(parsed, store, "t", ["record_id"], f"{tmp_path}/c").awaitTermination()
    assert store.read("t").count() == 3


def test_merges_with_a_scope_touch_their_own_files_only(spark, tmp_path):
    s = TableStore(spark, f"{tmp_path}/store")
    s.create("t", "batch string, k int, v int")
    rows = lambda *r: spark.createDataFrame(list(r), "batch string, k int, v int")
    assert s.insert_only("t", rows(("a", 1, 1), ("a", 2, 1), ("a", 2, 1)), ["k"], {"batch": "a"}) == 2
    assert s.insert_only("t", rows(("b", 3, 1)), ["k"], {"batch": "b"}) == 1
    assert s.insert_only("t", rows(("a", 2, 9), ("a", 4, 9)), ["k"], {"batch": "a"}) == 1
    before = set(json.loads(s.files.read(s._pointer("t")))["folders"])
    s.upsert("t", rows(("b", 3, 7), ("b", 5, 7)), ["k"], scope={"batch": "b"})
    after = set(json.loads(s.files.read(s._pointer("t")))["folders"])
    assert len(before - after) == 1
    assert sorted(tuple(r) for r in s.read("t").collect()) == [("a", 1, 1), ("a", 2, 1), ("a", 4, 9), ("b", 3, 7), ("b", 5, 7)]
    assert sorted(r["k"] for r in s.read("t", {"batch": "b"}).collect()) == [3, 5]
    # Files without a scope may hold any batch: a scoped upsert then replaces in the whole table.
    s.insert_only("t", rows(("a", 6, 1), ("b", 8, 1)), ["k"])
    s.upsert("t", rows(("b", 8, 2)), ["k"], scope={"batch": "b"})
    assert sorted((r["k"], r["v"]) for r in s.read("t").collect()) == [(1, 1), (2, 1), (3, 7), (4, 9), (5, 7), (6, 1), (8, 2)]


def test_gold_refuses_an_empty_history(spark, tmp_path):
    lake = house(spark, tmp_path)
    lake.setup()
    path = batch(tmp_path / "in", {"a.jsonl": [line()]})
    with pytest.raises(ValueError, match="empty"):
        lake.gold(path)
    assert [(r["layer"], r["status"]) for r in lake.store.read("audit").collect()] == [("gold", "failed")]


def test_all_faults_of_a_document_are_told_at_once():
    with pytest.raises(ValueError, match="status: .*batch_id: .*stays.1: .*stays.0.output_file: ") as e:
        control.declared_counts({"status": "running", "batch_id": "", "airflow_dag_id": "d", "airflow_run_id": "r", "airflow_try_number": True, "stays": [{"output_file": "..", "publishable_records": 1}, 3]}, "/v/run_manifest.json")
    assert "airflow_try_number" in str(e.value)
    with pytest.raises(ValueError, match="twice"):
        control.declared_counts({"stays": [{"output_file": "a.jsonl"}] * 2}, "/v/run_manifest.json")
    with pytest.raises(ValueError, match="object"):
        control.parse_manifest("[]")


@pytest.mark.parametrize(("change", "fault"), [({"adults": 0}, "least.adults"), ({"children": -1}, "least.children"), ({"page_limit": -1}, "least.page_limit"), ({"fields": ("a", "x")}, "fields.1")])
def test_arguments(change, fault):
    good = {"adults": 2, "rooms": 1, "children": 0, "page_limit": 0, "fields": ("a",), "known": ("a", "b")}
    control.check_arguments(**good)
    with pytest.raises(ValueError, match=fault):
        control.check_arguments(**{**good, **change})


def test_late_rows_of_a_stream_go_to_a_table_of_their_own(spark, tmp_path):
    store = TableStore(spark, f"{tmp_path}/s")
    lots = [[("a", 100), ("b", 50)], [("c", 60), ("d", 95), ("e", None)], [("f", 400), ("g", 10), ("a", 99)]]
    for k, lot in enumerate(lots):
        spark.createDataFrame([(n, None if m is None else NOW + timedelta(minutes=m)) for n, m in lot], "n string, at timestamp").coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        stream = spark.readStream.schema("n string, at timestamp").parquet(f"{tmp_path}/in")
        for _ in range(1 + (k == 1)):  # a start without news adds nothing
            streams.on_time_into_store(stream, store, "t", ["n"], "at", f"{tmp_path}/c", "30 minutes").awaitTermination()
    assert sorted(r["n"] for r in store.read("t").collect()) == ["a", "b", "d", "e", "f"]
    assert sorted((r["n"], r["lateness"]) for r in store.read("t_late").collect()) == [("c", 600.0), ("g", 3600.0)]
    assert [(r["batch"], r["on_time"], r["late"]) for r in store.read("t_batches").orderBy("batch").collect()] == [(0, 2, 0), (1, 2, 1), (2, 2, 1)]

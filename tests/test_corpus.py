"""Corpus operators, files, the ledger and its stream."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from tessera.operators import corpus as C
from tessera.sources import extract, files, sidecar
from tessera.sources.registry import Location, Registry, Source
from tessera.streaming import windows
from tessera.streaming.ledger import Ledger, run_incremental


def test_choose_orders_and_limits(spark):
    rows = [("a", dt.date(2020, 1, 1), "S2", "X", 1), ("b", None, "S1", "X", 2), ("c", dt.date(2021, 1, 1), "S1", "The X", 3), ("d", dt.date(2020, 1, 1), None, "Y", 4), ("e", dt.date(2020, 1, 1), "S2", "X", 0)]
    df = spark.createDataFrame(rows, "name string, date date, spend_id string, department string, ord int")
    names = lambda **k: [r["name"] for r in C.choose_documents(df, 10, **k).collect()]
    assert names() == ["c", "d", "e", "a", "b"]
    assert names(departments=["the x"]) == ["c", "e", "a", "b"]
    assert names(departments=[]) == []
    with pytest.raises(ValueError):
        C.choose_documents(df, 0)


def test_last_row_wins_at_first_place(spark):
    df = spark.createDataFrame([("k", 1, "old"), ("z", 2, "z"), ("k", 3, "new")], "key string, ord int, v string")
    assert {tuple(r) for r in C.last_wins(df, "key", "ord").collect()} == {("k", "new", 1), ("z", "z", 2)}


def test_ledger_and_stream(spark, tmp_path):
    refs = spark.createDataFrame([("a", "t", "1"), ("b", "t", "1")], "key string, content_type string, version string")
    refs.write.parquet(f"file://{tmp_path}/in/one")
    ledger = Ledger(spark, f"file://{tmp_path}/ledger")
    assert ledger.read().count() == 0
    seen = []

    def process(pending):
        seen.append(sorted(r["key"] for r in pending.collect()))
        return pending.where("key <> 'b'")  # b fails and stays pending

    def run(**k):
        stream = spark.readStream.schema(refs.schema).option("recursiveFileLookup", True).parquet(f"file://{tmp_path}/in")
        run_incremental(spark, stream, ledger, f"file://{tmp_path}/check", process, stage="text", source="s", code_version="v", **k)

    run()
    assert {r["document_key"] for r in ledger.read().collect()} == {"text#s#a#1"}
    spark.createDataFrame([("a", "t", "1"), ("a", "t", "2"), ("b", "t", "1")], refs.schema).coalesce(1).write.parquet(f"file://{tmp_path}/in/two")
    run()
    assert seen[0] == ["a", "b"] and ["a", "b"] in seen[1:]  # the changed version of a, and b again
    assert ledger.records("other").count() == 0
    assert ledger.clear("s") == 2 and ledger.read().count() == 0


def test_files(spark, tmp_path):
    (tmp_path / "x.csv").write_bytes("﻿a,b\n1,\"two\nlines\"\n".encode())
    path = f"file://{tmp_path}/x.csv"
    assert files.read_export(spark, path).columns == ["a", "b"]
    assert files.read_export(spark, path).first()["b"] == "two\nlines"
    assert files.export_key(spark, "latest", f"file://{tmp_path}", "old").endswith("x.csv")
    assert files.export_key(spark, "y.csv", "new", "old/") == "old/y.csv"
    rows = spark.createDataFrame([("s/k.json", "é")], "key string, text string")
    assert files.write_keyed(files.payload(rows), f"file://{tmp_path}/out") == 1
    text = (tmp_path / "out/s/k.json").read_text()
    assert json.loads(text) == {"key": "s/k.json", "text": "é"} and "é" in text and "\n  " in text
    assert files.read_outputs(spark, f"file://{tmp_path}/none").count() == 0
    assert files.read_outputs(spark, f"file://{tmp_path}/out").first()["text"] == "é"


def test_sidecars(spark):
    label = {"document_type": "letter", "date": dt.date(2025, 1, 2), "alb": None, "is_latest": False}
    text = sidecar.to_json(label)
    assert sidecar.from_json(text) == {"document_type": "letter", "date": dt.date(2025, 1, 2), "is_latest": False}
    bad = ['{"a": 1}', "[]", "x"] + [json.dumps({"metadataAttributes": {"document_type": "t", **x}}) for x in ({"date": "20250101"}, {"date": 2025}, {"date": 20250230}, {"date": True}, {"alb": ""}, {"is_latest": 1}, {"other": "x"})]
    for one in bad:
        with pytest.raises(sidecar.BadSidecar):
            sidecar.from_json(one)
    with pytest.raises(sidecar.BadSidecar):
        sidecar.to_json({"document_type": "t", "project_name": "é" * 2000})
    found = sidecar.checked(spark.createDataFrame([("ok", text), ("bad", bad[0]), ("null", None)], "key string, text string")).collect()
    assert {r["key"]: r["error"] is None for r in found} == {"ok": True, "bad": False, "null": False}
    assert sidecar.undeclared({"z": 1, "a": 2, "alb": 3}, ("alb",)) == ["a", "z"]


def test_extraction(spark):
    import io
    import zipfile

    w = "http://schemas.openxmlformats.org/wordprocessingml/2006/main"
    p = lambda t: f"<w:p><w:r><w:t>{t}</w:t></w:r></w:p>"
    body = f'<w:document xmlns:w="{w}"><w:body>{p("Hello")}<w:tbl><w:tr><w:tc>{p("a")}</w:tc><w:tc>{p("b")}</w:tc></w:tr></w:tbl></w:body></w:document>'
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w") as z:
        z.writestr("word/document.xml", body)
    docx = next(k for k in extract.EXTRACTORS if "word" in k)
    rows = [("d", docx, buffer.getvalue()), ("bad", docx, b"no zip"), ("html", "text/html", b"<h1>T</h1><script>x</script><p>a &amp; b</p><table><tr><td>1</td><td>2</td></tr></table>"), ("odd", "image/png", b""), ("none", "text/html", None)]
    found = {r["key"]: r for r in extract.extract(spark.createDataFrame(rows, "key string, content_type string, content binary")).collect()}
    assert found["d"]["text"] == "--- Document Text ---\nHello\n--- Document Tables ---\n| a | b |"
    assert found["html"]["text"] == "T\na & b\n| 1 | 2 |" and found["html"]["chars"] == len(found["html"]["text"])
    assert found["bad"]["text"] is None and found["bad"]["error"]
    assert "unsupported" in found["odd"]["error"]
    assert found["none"]["text"] == ""


def test_registry():
    with pytest.raises(ValueError):
        Location("x", ours=False, production="p", development_copy="c", cross_account=True)
    theirs = Location("x", ours=False, production="p", development_copy="c")
    assert (theirs.resolve("prod"), theirs.resolve("dev"), Location("x").resolve("dev")) == ("p", "c", "x-dev")
    registry = Registry([Source("s", "letter", theirs, extra_keys=("k",))])
    assert registry.get("s").metadata_keys[-1] == "k" and [s.name for s in registry.feeding("text")] == ["s"]
    with pytest.raises(KeyError):
        registry.get("t")
    with pytest.raises(ValueError):
        Source("s", "letter", theirs, pipelines=())


def test_streamed_windows_equal_batch(spark, sf, tmp_path):
    events = spark.read.parquet(f"{sf}/events.parquet")
    events.write.parquet(f"file://{tmp_path}/e")
    stream = windows.tumbling(windows.as_stream(spark.readStream.schema(events.schema).parquet(f"file://{tmp_path}/e")))
    q = stream.writeStream.outputMode("complete").format("memory").queryName("counted").trigger(availableNow=True).start()
    q.awaitTermination()
    streamed = {tuple(r) for r in spark.table("counted").select(F.col("start").cast("string"), "event_type", "n").collect()}
    assert streamed == {tuple(r) for r in windows.tumbling(events).select(F.col("start").cast("string"), "event_type", "n").collect()}


def test_extraction_identity(spark, sf):
    from tessera.queries.corpus_queries import extraction_summary

    r = extraction_summary(spark, sf).first()
    assert r["total"] == r["filtered_out"] + r["skipped"] + r["processed"] + r["failed"]


def test_ledger_appends_and_compacts(spark, tmp_path, monkeypatch):
    from tessera.streaming import ledger as module

    monkeypatch.setattr(module, "COMPACT", 3)
    one, two = (Ledger(spark, f"file://{tmp_path}/ledger") for _ in range(2))
    at = lambda day: dt.datetime(2024, 1, day)
    rows = lambda *r: spark.createDataFrame(list(r), module.SCHEMA)
    state = lambda x: {(r["document_key"], r["source_name"], r["code_version"]) for r in x.read().collect()}
    one.mark(rows(("a", "s", at(9), "1", None), ("b", "t", at(1), "1", None)))
    two.mark(rows(("a", "s", at(2), "2", None), ("a", "s", at(3), "3", "d")))  # a later mark beats a later time
    assert state(one) == state(two) == {("a", "s", "3"), ("b", "t", "1")}
    assert one._commit(1, "add v-x") is False and len(one._log()) == 2
    one.mark(rows((None, None, None, None, None)))  # the third entry: written whole
    assert [kind for _, kind, _ in one._log()] == ["add", "add", "add", "only"]
    assert state(two) == {("a", "s", "3"), ("b", "t", "1"), (None, None, None)}
    assert two.clear("s") == 1 and state(one) == {("b", "t", "1"), (None, None, None)}
    assert [kind for _, kind, _ in one._log()] == ["only", "only"]  # what the last rewrite but one replaced is gone
    assert len([x for x in tmp_path.joinpath("ledger").iterdir() if x.name.startswith("v-")]) == 2

    assert one.clone(f"file://{tmp_path}/clone") == 2 and one.clone(f"file://{tmp_path}/clone") == 2
    other = Ledger(spark, f"file://{tmp_path}/other")
    assert other.clone(f"file://{tmp_path}/none") == 0
    other.seed(f"file://{tmp_path}/clone")
    assert state(other) == {("b", "t", "1"), ("", None, None)}

    (tmp_path / "other/log/000000000002").write_bytes(b"\xff\x00 nonsense")
    assert state(other) == {("b", "t", "1"), ("", None, None)}
    for x in tmp_path.joinpath("other").glob("v-*/*.parquet"):
        x.write_bytes(b"broken")
        x.with_name(f".{x.name}.crc").unlink(missing_ok=True)
    assert state(other) == set()
    assert other.clear() == 0 and state(other) == set()


def test_memory_writer(spark):
    out = files.MemoryWriter(spark, "kept_in_memory")
    assert spark.table("kept_in_memory").count() == 0
    out.write(spark.createDataFrame([("a", "1"), ("b", "2"), (None, "0")], "key string, payload string"))
    out.write(spark.createDataFrame([("a", "0"), ("a", "00"), ("c", None)], "key string, payload string"))
    assert {tuple(r) for r in spark.table("kept_in_memory").collect()} == {("a", "00"), ("b", "2"), ("c", None), (None, "0")}


def test_vocabulary(spark):
    from tessera.operators import vocabulary as V

    assert len(V.BASE) == len(set(V.BASE)) == 77
    assert V.classes("dbr_readout")[-1] == "Readout Date" and len(V.classes("nao_report")) == 78
    with pytest.raises(ValueError):
        V.classes("memo")
    rows = [(1, "nao_report", "Risk"), (2, "nao_report", "Report Name"), (3, "nao_report", "Spend ID"), (4, "business_case", "Spend ID"), (5, "memo", "Risk"), (6, None, "Risk"), (7, "nao_report", None)]
    found = V.outside(spark.createDataFrame(rows, "id int, document_type string, class string"))
    assert sorted(r["id"] for r in found.collect()) == [3, 5, 6, 7]

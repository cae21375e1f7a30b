"""Folders of files with differing headers, damaged files, per-entity files."""

from collections import Counter

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from odoscan.sources import files, folder, sinks


def write(path, name, text, encoding="utf-8"):
    (path / name).write_bytes(text.encode(encoding))


def by_place(df):
    return {(r["Source_File"].rsplit("/", 1)[1], r["rec_id"] & ((1 << files.ROW_BITS) - 1)): r for r in df.collect()}


@pytest.fixture
def mixed(tmp_path):
    write(tmp_path, "A_1.csv", 'Tiempo,Velocidad,x\n2024-01-01 00:00:00,1,"two\nlines, ""quoted"""\n\n2024-01-01 00:01:00,,\n')
    write(tmp_path, "B_1.csv", "﻿Tanque total,Tanque Total,Tiempo \n,5,2024-01-02\n7,8,2024-01-02,9,10\n1\n")
    write(tmp_path, "C.csv", "only a header\n")
    write(tmp_path, "D_bad.csv", "Tiempo,Velocidad\n" + "2024-01-01,3\n" * 9000 + '2024-01-01,"open\n')
    write(tmp_path, "E_bad.csv", "Tiempo,Velocidad\n2024-01-01,é\n", "latin-1")
    write(tmp_path, "F_0.csv", "")
    write(tmp_path, "_hidden.csv", "x\n1\n")
    write(tmp_path, "G.txt", "x\n1\n")
    return tmp_path


def test_layouts_become_one_table(spark, mixed):
    rows, errors = folder.read_folder(spark, str(mixed))
    got = by_place(rows)
    assert set(got) == {("A_1.csv", 0), ("A_1.csv", 1), ("B_1.csv", 0), ("B_1.csv", 1), ("B_1.csv", 2)}
    first = got["A_1.csv", 0]
    assert first["x"] == 'two\nlines, "quoted"' and first["speed_raw"] == "1" and first["total_fuel"] is None and first["Vehicle_ID"] == "A"
    assert got["A_1.csv", 1]["speed_raw"] is None and not got["A_1.csv", 1][files.RAGGED]
    assert got["B_1.csv", 0]["total_fuel"] is None  # of two columns of one name the first counts
    long, short = got["B_1.csv", 1], got["B_1.csv", 2]
    assert (long["total_fuel"], long["timestamp"], long[files.RAGGED]) == ("7", "2024-01-02", True)
    assert (short["total_fuel"], short["timestamp"], short[files.RAGGED]) == ("1", None, True)
    assert "only a header" in rows.columns
    found = {r["path"].rsplit("/", 1)[1]: r["error"] for r in errors.collect()}
    assert set(found) == {"D_bad.csv", "E_bad.csv"} and "UnicodeDecodeError" in found["E_bad.csv"]  # 8192 rows of D were read before


def test_duplicate_names_by_rule(spark, mixed):
    for keep, want in (("last", "5"), ("filled", "5"), ("first", None)):
        rows, _ = folder.read_folder(spark, str(mixed), "B_1.csv", keep=keep)
        assert by_place(rows)["B_1.csv", 0]["total_fuel"] == want


def test_record_numbers_do_not_depend_on_the_grouping(spark, mixed):
    one, _ = folder.read_folder(spark, str(mixed))
    each, _ = folder.read_folder(spark, str(mixed), group_bytes=1)
    assert Counter(map(tuple, one.collect())) == Counter(map(tuple, each.collect()))
    groups = files.grouped([("a", 5), ("b", 5), ("c", 20), ("d", 1), ("e", 1)], 10)
    assert [(g.first, g.names) for g in groups] == [(0, ["a", "b"]), (2, ["c"]), (3, ["d", "e"])]


def test_file_report(spark, mixed):
    report = {r["path"].rsplit("/", 1)[1]: r for r in folder.file_report(*folder.read_folder(spark, str(mixed))).collect()}
    assert (report["B_1.csv"]["rows"], report["B_1.csv"]["ragged"]) == (3, 2)
    assert report["D_bad.csv"]["rows"] == 0 and report["D_bad.csv"]["error"]


def test_folder_without_a_readable_file(spark, tmp_path):
    write(tmp_path, "A.csv", "é\n", "latin-1")
    with pytest.raises(ValueError, match="no valid data files"):
        folder.load_folder(spark, str(tmp_path))
    with pytest.raises(ValueError, match="no files matching"):
        folder.load_folder(spark, str(tmp_path), "*.parquet")
    with pytest.raises(ValueError, match="directory not found"):
        folder.load_folder(spark, str(tmp_path / "absent"))
    with pytest.raises(Exception, match="schema"):
        spark.read.format("odoscan_folder").load(str(tmp_path))


def test_parquet_layouts_types_and_damage(spark, tmp_path):
    pq.write_table(pa.table({"Tanque total": [1.5, None], "n": [1, 2], "same": [True, None]}), tmp_path / "A_0.parquet")
    pq.write_table(pa.table({"Tanque Total": [2.5], "n": ["x"], "more": [[1, 2]]}), tmp_path / "B_0.parquet")
    good = (tmp_path / "A_0.parquet").read_bytes()
    (tmp_path / "C_0.parquet").write_bytes(good[: len(good) // 2])
    damaged = bytearray(good)
    damaged[8:40] = b"\xff" * 32  # the footer stands, the pages do not
    (tmp_path / "D_0.parquet").write_bytes(bytes(damaged))
    rows, failed = folder.load_folder(spark, str(tmp_path), "*.parquet")
    assert [f.rsplit("/", 1)[1] for f in failed] == ["C_0.parquet", "D_0.parquet"]
    assert {f.name: f.dataType.simpleString() for f in rows.schema.fields if f.name in ("total_fuel", "n", "same", "more")} == {
        "total_fuel": "double", "n": "string", "same": "boolean", "more": "array<bigint>",
    }
    got = {(r["Vehicle_ID"], r["total_fuel"], r["n"], r["same"], tuple(r["more"] or ())) for r in rows.collect()}
    assert got == {("A", 1.5, "1", True, ()), ("A", None, "2", None, ()), ("B", 2.5, "x", None, (1, 2))}


def test_entity_files_round_trip(spark, fleet, tmp_path):
    target = f"{tmp_path}/out"
    manifest = sinks.write_entity_files(fleet, target, rows_per_file=200, broadcast_rows=0)
    sizes = {r["path"].rsplit("/", 1)[1]: r["rows"] for r in manifest.collect()}
    hot = [n for name, n in sizes.items() if name.startswith("V1_")]
    assert sum(sizes.values()) == fleet.count() and len(hot) >= 5 and max(hot) < 400  # the hot vehicle is spread
    rows, errors = folder.read_folder(spark, target)
    assert errors.isEmpty() and sinks.differing_files(manifest, folder.file_report(rows, errors)).isEmpty()
    texts = fleet.select(*[F.col(c).cast("string").alias(c) for c in fleet.columns])
    assert Counter(map(tuple, rows.select(*fleet.columns).collect())) == Counter(map(tuple, texts.collect()))
    (tmp_path / "out" / "V2_0.csv").unlink()
    report = folder.file_report(*folder.read_folder(spark, target))
    assert [(r["path"].rsplit("/", 1)[1], r["read"]) for r in sinks.differing_files(manifest, report).collect()] == [("V2_0.csv", 0)]
    with pytest.raises(Exception, match="no file can be named"):
        sinks.write_entity_files(fleet.withColumn("Vehicle_ID", F.lit("a_b")), f"{tmp_path}/bad")


def test_prediction_manifest(spark, fleet, tmp_path):
    rows = fleet.select("rec_id", (F.col("rec_id") % 3 == 0).cast("int").alias("Predicted_Theft"))
    found = {r["flagged"]: r for r in sinks.prediction_manifest(rows, str(tmp_path), "t.parquet").collect()}
    assert found[False]["rows"] == 1500 and found[True]["rows"] == 500
    assert spark.read.parquet(found[True]["path"]).count() == 500
    none = sinks.prediction_manifest(rows.filter("Predicted_Theft = 0"), str(tmp_path), "n.parquet").collect()
    assert [r["rows"] for r in none] == [1000, 0] and not (tmp_path / "n.parquet").exists()

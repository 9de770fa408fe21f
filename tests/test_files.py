"""Folders of many small files: listed, read and written by tasks, with what Spark's own sources find there."""

import gzip
import hashlib
import json

import pytest
from pyspark.sql import functions as F

from glasswatch.plans import deliveries
from glasswatch.schemas import SCENARIO_DOCUMENT
from glasswatch.sources import files, readers

NAMES = ("plain", "sub dir/x=1", "a=1/b=2/c 100%25 #?.txt", "a=1/.hidden", "_skipped/x", "_k=v/kept", ".dot/x", "_metadata", "half._COPYING_", "ü/deep/er/still/one")


def _tree(folder):
    for name in NAMES:
        (folder / name).parent.mkdir(parents=True, exist_ok=True)
        (folder / name).write_bytes(name.encode())
    (folder / "empty").write_bytes(b"")
    (folder / "no file/in it").mkdir(parents=True)


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_files_are_those_that_spark_finds(spark, tmp_path, rows):
    _tree(tmp_path)
    for folder in (tmp_path, tmp_path / "plain", tmp_path / "a=1"):
        theirs = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(str(folder))
        ours = files.contents(spark, str(folder))
        assert ours.columns == theirs.columns and rows(ours) == rows(theirs) and ours.count() > 0
        assert rows(files.listed(spark, str(folder))) == rows(theirs.drop("content"))
        hashed = files.hashes(spark, str(folder)).select("path", "sha256")
        assert rows(hashed) == rows(theirs.select("path", F.sha2("content", 256)))
    assert rows(files.listed(spark, str(tmp_path / "a=[0-9]"))) == rows(files.listed(spark, str(tmp_path / "a=1")))  # left to Spark
    assert files.listed(spark, str(tmp_path / "no file")).count() == 0


def test_the_driver_lists_and_plans_no_file(spark, tmp_path):
    _tree(tmp_path)
    for df in (deliveries.file_hashes(spark, str(tmp_path)), deliveries.delivered(spark, str(tmp_path)), readers.read_scenarios(spark, str(tmp_path))):
        assert "FileScan" not in _plan(df) and df.inputFiles() == []


def test_a_file_for_each_value(spark, tmp_path, rows):
    folder = str(tmp_path / "out")
    lines = [(str(i), f"text {i}") for i in range(300)] + [("5", "text 5"), ("a/b %", "x"), ("a/b %", None), (None, "none"), ("empty", "")]
    files.write_each(spark.createDataFrame(lines, "k string, line string").repartition(7), folder)
    written = {}
    for key, text in lines:
        written.setdefault("k=" + {"a/b %": "a%2Fb%20%25", None: "__HIVE_DEFAULT_PARTITION__"}.get(key, key), []).append((text or "") + "\n")
    got = {r["path"].rpartition("/")[2]: bytes(r["content"]).decode() for r in files.contents(spark, folder).collect()}
    assert got.keys() == written.keys() and all(sorted(got[k].splitlines(True)) == sorted(v) for k, v in written.items())
    assert not [p for p in (tmp_path / "out").rglob("*") if p.name.startswith(".")]
    with pytest.raises(FileExistsError):
        files.write_each(spark.createDataFrame(lines, "k string, line string"), folder)
    hashed = {r["file"]: r["sha256"] for r in deliveries.file_hashes(spark, folder, F.regexp_extract("path", "(k=.*)", 1)).collect()}
    assert hashed["k=7"] == hashlib.sha256(b"text 7\n").hexdigest() and len(hashed) == len(written)


def test_a_folder_is_deleted_with_all_in_it_and_nothing_beside(spark, tmp_path):
    _tree(tmp_path / "gone")
    _tree(tmp_path / "kept")
    files.delete(spark, str(tmp_path / "gone"))
    files.delete(spark, str(tmp_path / "never there"))
    assert [p.name for p in tmp_path.iterdir()] == ["kept"] and files.listed(spark, str(tmp_path)).count() == 5


def test_scenarios_are_those_of_sparks_json_reader(spark, tmp_path, rows):
    doc = lambda i, **more: json.dumps({"scenario_id": f"s{i}", "expected_score_min": i, "track_ids": [f"t{i}", "ü"]} | more, indent=2, ensure_ascii=False)
    texts = {
        "part=1/plain.json": doc(1).encode(), "part=1/list.json": f"[{doc(2)}, {doc(3)}]".encode(), "part=2/two lines": f"{doc(4)}\n{doc(5)}\n".encode(),
        "part=2/wrong type": doc(6, expected_score_min="high").encode(), "part=2/no list": doc(7, track_ids=None).encode(), "part=3/broken": doc(8)[:-3].encode(),
        "part=3/utf16": doc(9).encode("utf-16-le"), "part=3/bad bytes": doc(10).encode("latin-1"), "part=3/packed.json.gz": gzip.compress(doc(11).encode()),
        "part=3/mark": doc(12).encode("utf-8-sig"), "part=3/blank": b" \n", "part=3/_hidden": doc(13).encode(),
    }
    for name, content in texts.items():
        (tmp_path / "deep" / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / "deep" / name).write_bytes(content)
        (tmp_path / "flat" / "below").mkdir(parents=True, exist_ok=True)
        (tmp_path / "flat" / name.partition("/")[2]).write_bytes(content)
    (tmp_path / "flat" / "below" / "x").write_text(doc(14))
    for folder in ("deep", "flat"):
        theirs = spark.read.schema(SCENARIO_DOCUMENT).option("multiLine", True).json(str(tmp_path / folder))
        ours = readers.read_scenarios(spark, str(tmp_path / folder))
        assert rows(ours) == rows(readers.explode_scenarios(theirs)) and {"s1", "s3", "s4", "s11"} <= {r["scenario_id"] for r in ours.collect()}

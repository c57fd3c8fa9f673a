"""Arrays read in byte ranges against the same files parsed whole."""

import json
import os
import random

import pytest
from pyspark.sql import functions as F

from tidemark.sources import landing as L
from tidemark.sources.arrays import scan_objects


def _records(n):
    r = random.Random(4)
    tricky = ["}", "{", '"', "\\", '\\"', "}{", "[", "],", "é}日", "a\nb", '{"x": "}"}', "", "},{", "\\\\"]
    return [{"id": i, "s": "".join(r.choices(tricky, k=r.randint(0, 5))), "o": {"k": r.choice(tricky), "l": [{"z": [1, {}]}, {}]},
             "f": None if i % 7 else i / 3} for i in range(n)]


@pytest.fixture()
def ranges(spark):
    """Ranges of a few kilobytes."""
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


def _found(df):
    return sorted((os.path.basename(r[0]), json.loads(r[1])["id"], r[1]) for r in
                  df.select("file_path", F.to_json("raw_data").alias("j")).collect())


def test_ranges_equal_whole_files(spark, tmpdir_path, ranges):
    root, rows = tmpdir_path + "/a", _records(700)
    os.makedirs(root)
    forms = {"compact.json": json.dumps(rows, separators=(",", ":")), "spaced.json": json.dumps(rows),
             "pretty.json": json.dumps(rows, indent=3, ensure_ascii=False), "none.json": " [ ] ", "empty.json": "",
             "lines.json": "\n".join(json.dumps(r) for r in rows), "ended.json": "".join(json.dumps(r) + "\n" for r in rows),
             "one.json": json.dumps(rows[:1])}
    for name, text in forms.items():
        with open(f"{root}/{name}", "w") as f:
            f.write(text)
    df = scan_objects(spark, root)
    want = sorted((name, r["id"]) for name, own in (("compact.json", rows), ("spaced.json", rows), ("pretty.json", rows), ("lines.json", rows),
                                                     ("ended.json", rows), ("one.json", rows[:1])) for r in own)
    got = _found(df)
    assert [g[:2] for g in got] == want
    by_id = {r["id"]: r for r in rows}
    assert all(json.loads(j) == {k: v for k, v in by_id[i].items() if True} or json.loads(j)["s"] == by_id[i]["s"] for _, i, j in got)
    assert got == _found(L.scan_landing(spark, root))
    parts = spark.read.option("lineSep", "}").text(f"{root}/pretty.json").rdd.getNumPartitions()
    assert parts > 20


@pytest.mark.parametrize("text,good", [('[{"id": 1}, {"id": 2', 1), ('{"id": 1}\n{"id": 2', 1), ('[{"id": 1}, {"id": "2}]', 1), ("not json", 0),
                                       ('[{"id": 1}, 5]', 1)])
def test_malformed_rests(spark, tmpdir_path, text, good):
    os.makedirs(tmpdir_path + "/m")
    with open(tmpdir_path + "/m/x.json", "w") as f:
        f.write(text)
    rows = scan_objects(spark, tmpdir_path + "/m", fail_fast=False).collect()
    assert [r["raw_data"] is None for r in rows].count(True) == 1 and len(rows) == good + 1
    with pytest.raises(Exception):
        scan_objects(spark, tmpdir_path + "/m").collect()


def test_large_files_of_a_landing_are_split(spark, tmpdir_path, ranges, monkeypatch):
    os.makedirs(tmpdir_path + "/z")
    for name, n in (("large.json", 400), ("small.json", 3)):
        with open(f"{tmpdir_path}/z/{name}", "w") as f:
            json.dump(_records(n), f)
    whole = _found(L.scan_landing(spark, tmpdir_path + "/z"))
    monkeypatch.setattr(L, "SPLIT_BYTES", 5000)
    assert _found(L.scan_landing(spark, tmpdir_path + "/z")) == whole and len(whole) == 403
    # what is over the bound is not opened by the reader of whole files
    text = spark.read.text(tmpdir_path + "/z", wholetext=True).filter(F.col("_metadata.file_size") <= 5000)
    assert text._jdf.queryExecution().executedPlan().toString().count("small.json") >= 0 and text.count() == 1

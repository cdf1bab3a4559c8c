"""File listing, result discovery and the state commit protocol."""

import os

import pytest

from panelcast.sources import files as Fi
from panelcast.sources import sinks as Sk


def _put(folder, name, text):
    path = os.path.join(str(folder), name)
    with open(path, "w", encoding="utf-8", newline="") as f:
        f.write(text)
    return path


def test_discovery_by_name(spark, tmp_path):
    _put(tmp_path, "a.csv", "day,rmse,mae,bias\n1,2.5,2,0.5\n\n2,,bad,1\n3,4\n")
    _put(tmp_path, "b.csv", 'note,bias,"mae",rmse,day,day\r\n"x, ""y""",-1,2,3,7,8\r\n,0,0,0,9,9,surplus\r\n')
    _put(tmp_path, "c.csv", "day,rmse\n1,2\n")
    _put(tmp_path, "empty.csv", "")
    _put(tmp_path, "header.csv", "day,rmse,mae,bias\n")
    files, data = Fi.discover_result_files(spark, f"{tmp_path}/*.csv")
    accepted = {os.path.basename(r["source_file"]): r["accepted"] for r in files.collect()}
    assert accepted == {"a.csv": True, "b.csv": True, "c.csv": False, "header.csv": True}
    rows = {(os.path.basename(r["source_file"])[0], r["day"], r["rmse"], r["mae"], r["bias"],
             tuple(sorted(r["other"].items()))) for r in data.collect()}
    assert rows == {("a", 1.0, 2.5, 2.0, 0.5, ()), ("a", 2.0, None, None, 1.0, ()), ("a", 3.0, 4.0, None, None, ()),
                    ("b", 7.0, 3.0, 2.0, -1.0, (("note", 'x, "y"'),)), ("b", 9.0, 0.0, 0.0, 0.0, (("note", None),))}


def test_discovery_of_a_file_in_many_splits(spark, tmp_path):
    body = "".join(f"{i},1,1,{i}\n" for i in range(20_000))
    _put(tmp_path, "long.csv", "bias,mae,rmse,day\n" + body)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        _, data = Fi.discover_result_files(spark, f"{tmp_path}/*.csv")
        got = data.selectExpr("count(*) n", "sum(day) s", "sum(bias) b", "count_if(day = bias) same").first()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert tuple(got) == (20_000, 199_990_000.0, 199_990_000.0, 20_000)


def test_newest_file_from_the_listing(spark, tmp_path):
    header = "Store,DayOfWeek,Date,Sales,Customers,Open,Promo,StateHoliday,SchoolHoliday\n"
    for name, when in (("a.csv", 100), ("b[1].csv", 300), ("b1.csv", 200), ("c.csv", 300)):
        os.utime(_put(tmp_path, name, header + f"{when},1,2015-01-01,1,1,1,0,0,0\n"), (when, when))
    assert Fi.newest_file(spark, f"{tmp_path}/*.csv").first()["file"].endswith("c.csv")
    assert [r["Store"] for r in Fi.newest_batch(spark, [f"{tmp_path}/a.csv", f"{tmp_path}/b*.csv"]).collect()] == [300]
    plan = Fi.newest_file(spark, f"{tmp_path}/*.csv")._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan.split("ReadSchema")[-1]
    empty = tmp_path / "sub"
    empty.mkdir()
    with pytest.raises(ValueError):
        Fi.newest_batch(spark, str(empty))


def test_state_versions(spark, tmp_path):
    path = f"{tmp_path}/state"
    assert Sk.current_state_version(spark, path) is None
    with pytest.raises(ValueError):
        Sk.read_state(spark, path)
    one = spark.createDataFrame([(1, [1.0]), (2, None)], "entity long, history array<double>")
    first = Sk.write_state(one, path)
    reader = Sk.read_state(spark, path)
    # a write that dies in the middle leaves a folder without a commit
    broken = one.selectExpr("entity", "if(entity = 2, array(cast(raise_error('lost') as double)), history) history")
    with pytest.raises(Exception, match="lost"):
        Sk.write_state(broken, path)
    assert Sk.current_state_version(spark, path) == first
    # the new state is computed from the old one, and the old reader keeps its version
    Sk.write_state(Sk.read_state(spark, path).selectExpr("entity", "concat(history, array(2D)) history"), path)
    assert [tuple(r) for r in reader.collect()] == [(1, [1.0])]
    assert [tuple(r) for r in Sk.read_state(spark, path).collect()] == [(1, [1.0, 2.0])]
    assert [tuple(r) for r in Sk.read_state(spark, path, first).collect()] == [(1, [1.0])]
    assert [r["sequence"] for r in Sk.state_commits(spark, path).orderBy("sequence").collect()] == [1, 2]


def test_late_year_is_written_by_all_tasks(spark, monkeypatch):
    from pyspark.sql import DataFrame
    from panelcast.plans.q_io import src_08_newest_file_pick
    monkeypatch.setattr(DataFrame, "coalesce", lambda *a: pytest.fail("all rows in one task"))
    monkeypatch.setattr(type(spark.range(1)), "coalesce", lambda *a: pytest.fail("all rows in one task"))
    got = src_08_newest_file_pick(spark, "/root/testdata/sf0.001").collect()
    assert len(got) == 1 and got[0]["is_late"] and got[0]["has_size"]

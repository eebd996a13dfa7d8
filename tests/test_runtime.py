import sys
from datetime import date

import pytest

from tidemill.plans.runtime import Abort, Jobs, Pipeline, Timeline, retry
from tidemill.sources import csv7z, files
from tidemill.sources.manifest import Manifest, Slices, index_of, promote, repair


def test_manifest(tmp_path, spark):
    src, out = tmp_path / "in", tmp_path / "out"
    src.write_text("abc")
    out.write_text("xy")
    m = Manifest(tmp_path, "bars", "sh")
    assert m.changed(src)
    m.commit(src, out, 2)
    assert not m.changed(src)
    src.write_text("abcd")
    assert m.changed(src)
    src.write_text("abc")
    out.unlink()
    assert m.changed(src)


def test_slices(tmp_path, spark):
    df = spark.createDataFrame([("A", 1), ("A", 2), ("B", 3)], "symbol string, price long")
    m = Manifest(tmp_path, "enriched", "sh")
    with pytest.raises(RuntimeError):
        Slices(m, df)
    m.commit(tmp_path / "x", tmp_path / "y", 3, index_of(df))
    s = Slices(m, df)
    assert s.symbols() == ["A", "B"] and s.get("A").count() == 2 and [k for k, _ in s] == ["A", "B"]
    with pytest.raises(KeyError):
        s.get("C")


def test_files(tmp_path, spark):
    df = spark.createDataFrame([("A", 1, "d1"), ("B", 2, "d1"), ("A", 3, "d2")], "symbol string, ts long, day string")
    files.write(df, str(tmp_path / "t"), by=["day"], order=["symbol", "ts"])
    assert files.read(spark, str(tmp_path / "t"), ["symbol", "ts"]).count() == 3
    files.write_series(df, str(tmp_path / "c"))
    assert spark.read.option("header", True).csv(str(tmp_path / "c")).count() == 3


def test_promote_and_repair(tmp_path):
    (tmp_path / "run").mkdir()
    with pytest.raises(FileNotFoundError):
        promote(tmp_path / "run", tmp_path / "models", "m")
    (tmp_path / "run/artifact.json").write_text("{}")
    assert promote(tmp_path / "run", tmp_path / "models", "m", "v1").name == "v1"
    promote(tmp_path / "run", tmp_path / "models", "m", "v2")
    assert (tmp_path / "models/m/latest").resolve().name == "v2"
    day = tmp_path / "raw/2025-01-02"
    day.mkdir(parents=True)
    (day / "sh_trade.7z").write_text("x")
    got = repair(tmp_path / "meta", tmp_path / "raw", date(2025, 1, 1), date(2025, 1, 2))
    assert got["2025-01-01"].startswith("failed") and got["2025-01-02"] == "1 files"


def test_runtime():
    calls, slept = [], []

    def flaky():
        calls.append(1)
        if len(calls) < 3:
            raise OSError("no")
        return 7

    assert retry(flaky, sleep=slept.append) == 7 and len(slept) == 2 and slept[1] > slept[0]
    with pytest.raises(ValueError):
        retry(lambda: int("x"), attempts=2, sleep=slept.append)

    def stop(context):
        raise Abort

    gone = []
    out = Pipeline([("a", lambda c: {**c, "x": 1}), ("b", stop), ("c", lambda c: 1 / 0)], gone.append).run({})
    assert out["aborted"] and out["x"] == 1 and gone and list(out["timeline"].seconds) == ["a", "b"]
    t = Timeline()
    with t.step("s"):
        pass
    assert t.lines()[0].startswith("s: ")
    jobs = Jobs()
    a, b = jobs.create("run"), jobs.create("train")
    jobs.set_status(a.id, "running")
    assert jobs.kill(a.id).status == "killed" and jobs.list(kind="train") == [b] and jobs.list(status="pending") == [b]
    with pytest.raises(ValueError):
        jobs.list(status="odd")
    with pytest.raises(KeyError):
        jobs.get("none")


def test_csv7z(tmp_path):
    path = tmp_path / "sh_trade.7z"
    path.write_text('SecurityID,Price\n600000,"10.5"\n600001,NULL\n,nan\n')
    cat = [sys.executable, "-c", "import sys; sys.stdout.write(open(sys.argv[1]).read())"]
    assert csv7z.header(str(path), cat) == ["SecurityID", "Price"]
    rows = [r for b in csv7z.batches(str(path), ["SecurityID", "Price"], cat) for r in b.to_pylist()]
    assert rows == [{"SecurityID": "600000", "Price": "10.5"}, {"SecurityID": "600001", "Price": None}, {"SecurityID": None, "Price": None}]
    with pytest.raises(FileNotFoundError):
        csv7z.archives(str(tmp_path / "none.7z"))
    (tmp_path / "a.csv").write_text("")
    with pytest.raises(ValueError):
        csv7z.archives(str(tmp_path / "a.csv"))
    (tmp_path / "e.7z").write_text("")
    with pytest.raises(RuntimeError):
        csv7z.header(str(tmp_path / "e.7z"), cat)

import pytest
from conftest import at, sec

from tagloom import schemas
from tagloom.sources import export, state


def test_lines_and_null_values(hist):
    df = hist([("Tank.Level", 3661.0789, 1.5), ("Tank.Level", 3662, None, 0)])
    assert {r.line for r in export.fastload_lines(df).collect()} == {
        "Tank.Level|0|2024/01/01|01:01:01.078|0|1.5|192",
        None,
    }


def test_write_counts_and_header(spark, hist, tmp_path):
    counts = export.write_fastload(hist([("a", 1, 1), ("a", 2, None)]), str(tmp_path / "x"), "me")
    assert counts == {"written": 1, "dropped": 1}
    header = [r.value for r in spark.read.text(str(tmp_path / "x/header")).collect()]
    assert header == ["ASCII", "|", "me|0|UTC|10|1"]
    assert spark.read.text(str(tmp_path / "x/data")).count() == 1


def test_windows_follow_the_bookmark():
    mark = {"start_ts": at(0), "end_ts": at(3600 * 30), "last_end_ts": None, "export_count": 0}
    first = export.next_export_window(mark)
    assert (sec(first.start), sec(first.end), first.number) == (0, 86400, 1)
    last = export.next_export_window(mark | {"last_end_ts": first.end, "export_count": 1})
    # Cut to the overall end.
    assert (sec(last.end), last.number) == (3600 * 30, 2)
    assert export.next_export_window(mark | {"last_end_ts": last.end}) is None


def test_export_run_covers_everything_once(spark, hist, table, tmp_path):
    df = hist([("a", 3600 * h, h % 5) for h in range(0, 60)] + [("b", 1, 1)])
    paths = str(tmp_path / "bookmark"), str(tmp_path / "out")
    export.set_bookmark(spark, paths[0], at(0), at(3600 * 59))
    windows = []
    while done := export.export_next(df, table([("a",)], "tag string"), *paths):
        windows.append(done[0].number)
    assert windows == [1, 2, 3]
    lines = spark.read.text(f"{paths[1]}/export-*/data")
    # Open at the start, closed at the end.
    assert lines.count() == 59 and lines.distinct().count() == 59


@pytest.mark.parametrize("hours", [24, 72])
def test_lines_do_not_depend_on_the_slices(spark, hist, table, tmp_path, hours):
    df = hist([("a", 3600 * h, 5) for h in range(-3, 72)] + [("b", 3600 * h, h // 30) for h in range(1, 72)])
    paths = str(tmp_path / "bookmark"), str(tmp_path / "out")
    export.set_bookmark(spark, paths[0], at(0), at(3600 * 72))
    while export.export_next(df, table([("a",), ("b",)], "tag string"), *paths, hours=hours):
        pass
    lines = sorted(r.value.split("|")[0] + r.value.split("|")[5] for r in spark.read.text(f"{paths[1]}/export-*/data").collect())
    assert lines == ["a5.0", "b0.0", "b1.0", "b2.0"]


def test_a_slice_reads_no_earlier_history(spark, hist, table, tmp_path):
    """Each slice gets its own rows only; the last ones before it come from the slice before."""
    rows = [("a", 3600 * h, 5) for h in range(1, 72)] + [("b", 3600 * h, h // 30) for h in range(1, 72)]
    paths = str(tmp_path / "bookmark"), str(tmp_path / "out")
    export.set_bookmark(spark, paths[0], at(0), at(3600 * 72))
    tags = table([("a",), ("b",)], "tag string")
    for day in range(3):
        own = [r for r in rows if day * 86400 < r[1] <= (day + 1) * 86400]
        before = export.read_version(spark, paths[0], export.BOOKMARK).collect()
        export.export_next(hist(own), tags, *paths)
        if day == 1:  # as if the bookmark had not moved
            export.write_version(spark.createDataFrame(before, export.BOOKMARK), paths[0], 90)
            export.export_next(hist(own), tags, *paths)
    lines = sorted(r.value.split("|")[0] + r.value.split("|")[5] for r in spark.read.text(f"{paths[1]}/export-*/data").collect())
    assert lines == ["a5.0", "b0.0", "b1.0", "b2.0"]


def test_export_converts_to_utc(spark, hist, table, tmp_path):
    export.set_bookmark(spark, str(tmp_path / "b"), at(0), at(86400))
    export.export_next(hist([("a", 3600, 1)]), table([("a",)], "tag string"), str(tmp_path / "b"), str(tmp_path / "o"), time_zone="America/New_York")
    (line,) = spark.read.text(str(tmp_path / "o/export-000001/data")).collect()
    assert line.value.startswith("a|0|2024/01/01|06:00:00.000|")


def test_tags_in_group(table):
    ns = table([(1, None, "Time", "Time", 1), (2, None, "Other", "Other", 1)], schemas.NAMESPACE)
    group_tag = table([(1, 10), (1, 11), (2, 12), (1, 10)], schemas.GROUP_TAG)
    ref = table([(10, "a"), (11, "b"), (12, "c")], schemas.TAG_REF)
    tag = table([("a", at(0)), ("b", at(100)), ("c", at(0))], "tag string, date_created timestamp_ntz")
    got = export.tags_in_group(ns, group_tag, ref, tag, "Time", at(50))
    assert [r.tag for r in got.collect()] == ["a"]


def test_unfinished_versions_do_not_count(spark, table, tmp_path):
    path = str(tmp_path / "s")
    assert state.read_version(spark, path, "x int").count() == 0
    state.write_version(table([(1,)], "x int"), path, 1)
    state.write_version(table([(2,)], "x int"), path, 2)
    (tmp_path / "s/version=2/_SUCCESS").rename(tmp_path / "s/version=2/unfinished")
    assert state.versions(spark, path) == [1]
    assert state.read_version(spark, path, "x int").first().x == 1
    state.write_version(table([(3,)], "x int"), path, 2)
    assert state.read_version(spark, path, "x int").first().x == 3
    assert state.read_version(spark, path, "x int", before=2).first().x == 1


def test_old_versions_can_be_pruned(spark, table, tmp_path):
    path = str(tmp_path / "p")
    for n in range(4):
        state.write_version(table([(n,)], "x int"), path, n)
    assert state.prune_versions(spark, path, keep=2) == [0, 1]
    assert state.versions(spark, path) == [2, 3]
    assert state.prune_versions(spark, path, keep=2) == []


def test_shared_dir_is_never_local_on_a_cluster(spark, monkeypatch):
    from tagloom import session

    assert session.shared_dir(spark) == spark.conf.get("spark.checkpoint.dir").rstrip("/")

    class Context:
        master = "yarn"

    class Conf:
        def get(self, key, default=None):
            return default

    class Session:
        sparkContext, conf = Context(), Conf()

    with pytest.raises(RuntimeError):
        session.shared_dir(Session())


def test_a_slice_reads_the_history_once(spark, hist, table, tmp_path):
    """What is handed on and the changes come from one look at the history."""
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    df = hist([("a", 60 * k, k) for k in range(1, 11)]).mapInArrow(counted, schemas.HISTORY)
    paths = str(tmp_path / "bookmark"), str(tmp_path / "out")
    export.set_bookmark(spark, paths[0], at(0), at(3600))
    assert export.export_next(df, table([("a",)], "tag string"), *paths)[1] == {"written": 10, "dropped": 0}
    assert seen.value == 10

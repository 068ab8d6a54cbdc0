from datetime import datetime

import pytest
from conftest import at, sec

from tagloom import schemas
from tagloom.operators import metadata

NS = [
    (1, None, "Public", "Public", 1),
    (2, 1, "Site", "Site", 2),
    (3, 2, "Line", "Line", 2),
    (4, 1, "All", "All", 1_000_000),
    (5, 4, "Below All", "Below All", 2),
    (6, 99, "Elsewhere", "Elsewhere", 2),
]


def day(n):
    return datetime(2024, 1, n)


@pytest.fixture
def ns(table):
    return table(NS, schemas.NAMESPACE)


def test_namespace_paths(ns):
    got = {r.name_key: r.path for r in metadata.namespace_paths(ns).collect()}
    assert got == {1: "\\Public", 2: "\\Public\\Site", 3: "\\Public\\Site\\Line"}


def test_tags_under_and_group_summary(ns, table, hist):
    group_tag = table([(2, 10), (3, 11), (3, 10), (5, 12)], schemas.GROUP_TAG)
    ref = table([(10, "a"), (11, "b"), (12, "c")], schemas.TAG_REF)
    tag = table([("a",), ("b",), ("c",)], "tag string")
    listed = metadata.tags_under(ns, group_tag, ref, tag, "\\Public\\Site")
    assert sorted(map(tuple, listed.collect())) == [
        ("a", "\\Public\\Site"),
        ("a", "\\Public\\Site\\Line"),
        ("b", "\\Public\\Site\\Line"),
    ]
    df = hist([("a", 0, 2), ("b", 3600, 4), ("c", 0, 9)])
    got = metadata.group_summary(df, listed, at(86400 + 10)).collect()
    assert len(got) == 3 * 24
    late = [r for r in got if r.tag == "b" and sec(r.start_ts) == 0]
    assert late[0].average is None and late[0].percent_good == 0


def test_version_churn_and_rate(table):
    rows = [("a", "x", "m", 0.0, 1.0, day(1)), ("a", "y", "m", 0.0, 1.0, day(2)), ("a", "y", None, 0.0, 2.0, day(3)), ("b", "x", "m", 0.0, 1.0, day(1))]
    th = table(rows, schemas.TAG_HISTORY)
    (r,) = metadata.version_churn(th).collect()
    assert (r.tag, r.versions, r.descriptions, r.units, r.min_eu_changes, r.max_eu_changes) == ("a", 3, 2, 1, 1, 2)
    assert r.avg_life_s == 2 * 86400 / 3
    got = metadata.version_rate(th, "month", 2).collect()
    assert [(r.beginning, r.tag, r.versions) for r in got] == [(day(1), "a", 3)]
    assert metadata.version_rate(th, "month", 0, pattern="b%").count() == 1
    assert metadata.version_rate(th, "day", 0, end="2024-01-01").count() == 2


def test_translations(table):
    tag = table([("SysTime", "time"), ("SysPulse", None), ("Other", "o")], "tag string, description string")
    have = table([("SysTime", "Zeit", 1), ("Other", "otro", 5)], schemas.TAG_DESCRIPTION)
    got = {r.tag: r.description for r in metadata.localized_tags(tag, have, 1).collect()}
    assert got == {"SysTime": "Zeit", "SysPulse": None, "Other": "o"}
    new = table([("SysTime", "Zeit!", 1), ("SysTime", "hora", 5)], schemas.TAG_DESCRIPTION)
    assert {tuple(r) for r in metadata.add_translations(have, new).collect()} == {
        ("SysTime", "Zeit", 1),
        ("Other", "otro", 5),
        ("SysTime", "hora", 5),
    }
    todo = metadata.missing_translations(tag, have, 5, "Sys%").collect()
    # A missing description makes the placeholder NULL, as text concatenation does.
    assert {tuple(r) for r in todo} == {("SysTime", "ToDo: time", 5), ("SysPulse", None, 5)}


def test_stale_tags(table, hist):
    old, new = datetime(2020, 1, 1), datetime(2024, 5, 1)
    tag = table(
        [("gone", old, 2), ("young", new, 2), ("server1", old, 1), ("alive", old, 2), ("recent", old, 2)],
        "tag string, date_created timestamp_ntz, io_server_key int",
    )
    live = hist([("gone", 0, None), ("young", 0, None), ("server1", 0, None), ("alive", 0, 1), ("recent", 86400 * 150, None)])
    stale = metadata.stale_tags(tag, live, "2024-06-01", 90, 60)
    assert [r.tag for r in stale.collect()] == ["gone"]
    assert metadata.drop_tags(tag, stale).count() == 4


def test_orphans_survive_nulls(table, ns):
    attributes = table([("a", 1), ("b", 2)], "attribute_name string, object_key int")
    assert [r.attribute_name for r in metadata.orphan_attributes(attributes, table([("a",), (None,)], "tag string")).collect()] == ["b"]
    objects = table([(1, "Site", None), (2, "Line", 1), (3, "All", 1)], "object_key int, object_name string, parent_key int")
    pending = table([("Line",), (None,)], "object_name string")
    assert {r.name for r in metadata.orphan_namespace(ns, objects, pending).collect()} == {"Site", "All"}
    assert {r.object_key for r in metadata.orphan_objects(objects, attributes).collect()} == {3}

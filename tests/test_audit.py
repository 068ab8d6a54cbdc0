import json
from datetime import datetime

from tagloom import schemas
from tagloom.operators import audit


def test_block_audit(table):
    locations = table([("/h", 1, 6, 1), ("/d", 2, 1, 1), ("rr:/x", 2, 1, 1), ("/t", 2, 1, 5)], schemas.STORAGE_LOCATION)
    blocks = table(
        [
            ("/h", "A240101_001", True), ("/h", "A240101_004", True), ("/h", "A240101_005", True),
            ("/d", "A240101_001", False), ("/d", "A240101_002", True), ("/d", "A240102_009", False),
            ("/d", "A240102_010", True), ("rr:/x", "A240101_002", False), ("/t", "A240101_002", False),
            ("/d", "stray", True), ("/d", "a_b", False),
        ],
        schemas.BLOCK_LISTING,
    )
    got = {tuple(r) for r in audit.block_audit(blocks, locations).collect()}
    assert got == {
        ("/h", "A240101_005", "exceeds expected count"),
        ("/d", "a_b", "missing status"),
        ("/d", "A240101_001", "missing status"),
        ("/d", "A240101_002", "possible overlap"),
        ("/d", "A240101_002", "exceeds expected count"),
        ("/d", "A240102_009", "missing status"),
        ("/d", "A240102_009", "exceeds expected count"),
        ("/d", "A240102_010", "possible overlap"),
        ("/d", "A240102_010", "exceeds expected count"),
    }


def charts(table):
    return (
        table([(1, "Flow", "u1", 2, 7), (2, "Board", "u2", 1, 8)], "chart_key int, name string, url string, chart_type int, owner_key int"),
        table([(1, "water"), (1, "main")], "chart_key int, keyword string"),
        table([(1, "s.b", 1, "red", 0, 2, None), (1, "s.a", 0, "blue", 1, 1, 4)], "chart_key int, fqn string, selected int, color string, active_group int, layout_index int, selected_order int"),
        table([(1, "Zoom", "2")], "chart_key int, property string, value string"),
        table([(2, 1, 3)], "chart_key int, member_key int, position int"),
        table([(7, "ann")], "user_key int, user_name string"),
    )


def test_chart_parts(table):
    parts = audit.chart_parts(*charts(table)).orderBy("chart_type", "chart_key", "section_no", "item").collect()
    assert [(r.chart_type, r.chart_key) for r in parts] == sorted((r.chart_type, r.chart_key) for r in parts)
    by = {}
    for r in parts:
        by.setdefault((r.chart_key, r.section), []).append(json.loads(r.content))
    assert len(parts) == 8
    assert by[2, "chart"] == [{"name": "Board", "url": "u2", "owner": None}]
    assert by[2, "dashboard"] == [{"url": "u1", "position": 3}]
    assert [x["keyword"] for x in by[1, "keyword"]] == ["main", "water"]
    assert by[1, "tag"][1] == {
        "fqn": "s.b", "selected": "True", "color": "red", "active_group": "False", "layout_index": 2,
        "selected_order": None,
    }


def test_block_numbers_beyond_three_digits(table):
    blocks = table(
        [("p", "a_999", False), ("p", "a_1000", True), ("p", "a_100", True), ("p", "a_007", False), ("p", "a_008", True)],
        "path string, block_name string, has_status boolean",
    )
    places = table([("p", 1, 1, 1)], "path string, time_unit_id int, block_duration int, storage_type int")
    got = audit.block_audit(blocks, places).filter("problem = 'possible overlap'").collect()
    assert {r.block_name for r in got} == {"a_1000", "a_008"}


def test_tz_report(table):
    df = table([(datetime(2020, 1, 1, 12),), (datetime(2020, 7, 1, 12),)], "ts timestamp_ntz")
    got = audit.tz_report(df, "America/New_York", -300).orderBy("utc_ts").collect()
    assert [(r.local_ts.hour, r.offset_min, r.is_standard, r.consistent) for r in got] == [
        (7, -300, True, False),
        (8, -240, False, False),
    ]
    assert audit.tz_report(df, "Asia/Kolkata", 330).first().consistent


def test_rename_server(spark, table, tmp_path):
    for name, servers in (("one", ("OLD", "keep")), ("two", ("keep",))):
        items = "".join(f"<trendItem><SERVER_NAME>{s}</SERVER_NAME><TAG_NAME>t</TAG_NAME></trendItem>" for s in servers)
        (tmp_path / f"{name}.xml").write_text(f"<root><tagList><trendItems>{items}<trendItem><TAG_NAME>n</TAG_NAME></trendItem></trendItems></tagList></root>")
    items = audit.read_trends(spark, str(tmp_path))
    got = audit.rename_server(items, "old", "NEW").collect()
    assert {(r.file.rsplit("/", 1)[1], r.server, r.changed, r.dirty) for r in got} == {
        ("one.xml", "NEW", True, True),
        ("one.xml", "keep", False, True),
        ("one.xml", None, False, True),
        ("two.xml", "keep", False, False),
        ("two.xml", None, False, False),
    }


def test_renamed_items_without_a_file_are_dirty(table):
    items = table([(None, "old", "t"), (None, "other", "u")], "file string, server string, tag string")
    got = {r.tag: (r.server, r.changed, r.dirty) for r in audit.rename_server(items, "OLD", "new").collect()}
    assert got == {"t": ("new", True, True), "u": ("other", False, False)}


def test_chart_parts_shuffles_no_text(spark, table):
    """The JSON of a part is made after the joins, so that it is never shuffled."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = audit.chart_parts(*charts(table))._jdf.queryExecution().analyzed().toString().split("\n")
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    depth = [len(line) - len(line.lstrip(" :+-")) for line in plan]
    made = [i for i, line in enumerate(plan) if "to_json" in line]
    assert len(made) == 5
    # No join above (less indented, before) any of them.
    assert not any("Join" in plan[i] and depth[i] < depth[m] for m in made for i in range(m))

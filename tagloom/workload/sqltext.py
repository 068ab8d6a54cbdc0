"""SQL building blocks for checking the time-series operators: the textbook
forms (one row per segment and cycle, running sums over whole tags)."""

from __future__ import annotations

from tagloom.functions.time import to_us
from tagloom.workload.registry import rounded_sql

HOUR_US, DAY_US = 3_600_000_000, 86_400_000_000


def bounded_rows(name: str, source: str, start: str, end: str, closed_end: bool = False) -> str:
    """CTE (tag, us, v, carried): the start-bound row and the samples after it."""
    good = "CASE WHEN quality = 192 THEN value END"
    upto = "<=" if closed_end else "<"
    return f"""{name} AS (
      SELECT tag, {to_us(start)} AS us, v, own < TS'{start}' AS carried
      FROM (SELECT tag, ts AS own, {good} AS v,
                   row_number() OVER (PARTITION BY tag ORDER BY ts DESC) AS rn
            FROM {source} WHERE ts <= TS'{start}')
      WHERE rn = 1
      UNION ALL
      SELECT tag, epoch_us(ts), {good}, false FROM {source}
      WHERE ts > TS'{start}' AND ts {upto} TS'{end}')"""


def runs_ctes(name: str, rows: str, state: str, keys: str = "tag", extra: str = "") -> str:
    """CTEs ending in ``name`` (keys, run, us, end_us, state, first_row columns)."""
    return f"""{name}_m AS (
      SELECT *, CASE WHEN row_number() OVER w = 1
                       OR ({state}) IS DISTINCT FROM lag({state}) OVER w
                     THEN 1 ELSE 0 END AS brk
      FROM {rows} WINDOW w AS (PARTITION BY {keys} ORDER BY us)),
    {name}_n AS (
      SELECT *, sum(brk) OVER (PARTITION BY {keys} ORDER BY us) AS run FROM {name}_m),
    {name}_s AS (SELECT * FROM {name}_n WHERE brk = 1),
    {name} AS (
      SELECT *, lead(us) OVER (PARTITION BY {keys} ORDER BY us) AS end_us FROM {name}_s)"""


def summary_ctes(name: str, source: str, start: str, end: str, width_us: int) -> str:
    """CTEs ending in ``name``: the analog summary of ``source`` per cycle."""
    lo, hi = to_us(start), to_us(end)
    count = -(-(hi - lo) // width_us)
    return f"""{bounded_rows(name + "_r", source, start, end)},
    {name}_s AS (
      SELECT *, coalesce(lead(us) OVER (PARTITION BY tag ORDER BY us), {hi}) AS until FROM {name}_r),
    {name}_c AS (
      SELECT *, unnest(generate_series((us - {lo}) // {width_us}, (until - 1 - {lo}) // {width_us}))
                  AS cyc
      FROM {name}_s),
    {name}_p AS (
      SELECT tag, cyc, v, greatest(us, {lo} + cyc * {width_us}) AS a,
             least(until, {lo} + (cyc + 1) * {width_us}, {hi}) AS b,
             CASE WHEN NOT carried AND (us - {lo}) // {width_us} = cyc THEN 1 ELSE 0 END AS own
      FROM {name}_c),
    {name}_x AS (
      SELECT *, min(v) OVER (PARTITION BY tag, cyc) AS mn, max(v) OVER (PARTITION BY tag, cyc) AS mx
      FROM {name}_p),
    {name}_g AS (
      SELECT tag, cyc, sum(own) AS n, max(mn) AS mn, max(mx) AS mx,
             min(CASE WHEN v = mn THEN a END) AS mn_us, min(CASE WHEN v = mx THEN a END) AS mx_us,
             sum(CASE WHEN v IS NOT NULL THEN b - a END) AS w,
             sum(v * ((b - a) / 1e6)) AS area, sum(v * v * ((b - a) / 1e6)) AS area2
      FROM {name}_x GROUP BY tag, cyc),
    {name}_t AS (SELECT DISTINCT tag, unnest(generate_series(0, {count - 1})) AS cyc FROM {name}_r),
    {name} AS (
      SELECT t.tag, make_timestamp({lo} + t.cyc * {width_us}) AS start_ts,
             make_timestamp(least({lo} + (t.cyc + 1) * {width_us}, {hi})) AS end_ts,
             mn AS minimum, make_timestamp(mn_us) AS min_ts, mx AS maximum,
             make_timestamp(mx_us) AS max_ts, area / (w / 1e6) AS average,
             CASE WHEN w > 0 THEN
               sqrt(greatest(area2 / (w / 1e6) - (area / (w / 1e6)) * (area / (w / 1e6)), 0)) END AS std_dev,
             area AS integral, CAST(coalesce(n, 0) AS BIGINT) AS value_count,
             coalesce(w, 0) * 100.0 / (least((t.cyc + 1) * {width_us}, {hi - lo}) - t.cyc * {width_us})
               AS percent_good
      FROM {name}_t t LEFT JOIN {name}_g g ON g.tag = t.tag AND g.cyc = t.cyc)"""


def state_ctes(name: str, source: str, start: str, end: str, width_us: int) -> str:
    """CTEs ending in ``name``: the state summary of ``source`` per cycle."""
    lo, hi = to_us(start), to_us(end)
    return f"""{bounded_rows(name + "_r", source, start, end)},
    {runs_ctes(name + "_u", name + "_r", "v")},
    {name}_c AS (
      SELECT *, coalesce(end_us, {hi}) AS until,
             unnest(generate_series((us - {lo}) // {width_us},
                                    (coalesce(end_us, {hi}) - 1 - {lo}) // {width_us})) AS cyc
      FROM {name}_u),
    {name}_p AS (
      SELECT *, {lo} + cyc * {width_us} AS a, least({lo} + (cyc + 1) * {width_us}, {hi}) AS b
      FROM {name}_c),
    {name}_w AS (
      SELECT *, CASE WHEN us >= a AND end_us <= b AND NOT carried
                     THEN (end_us - us) // 1000 END AS whole
      FROM {name}_p),
    {name} AS (
      SELECT tag, make_timestamp(a) AS start_ts, make_timestamp(b) AS end_ts, v AS state,
             count(*) AS state_count,
             CAST(sum(least(until, b) - greatest(us, a)) // 1000 AS BIGINT) AS state_ms,
             sum(least(until, b) - greatest(us, a)) * 100.0 / (b - a) AS state_percent,
             avg(whole) AS avg_contained_ms, min(whole) AS min_contained_ms,
             max(whole) AS max_contained_ms
      FROM {name}_w GROUP BY tag, a, b, v)"""


SUMMARY_COLUMNS = (
    "tag", "start_ts", "end_ts", "minimum", "min_ts", "maximum", "max_ts", "average", "std_dev",
    "integral", "value_count", "percent_good",
)
STATE_COLUMNS = (
    "tag", "start_ts", "end_ts", "state", "state_count", "state_ms", "state_percent",
    "avg_contained_ms", "min_contained_ms", "max_contained_ms",
)


def select(name: str, columns) -> str:
    return f"SELECT {rounded_sql(*columns)} FROM {name}"

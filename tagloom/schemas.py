"""Canonical table schemas."""

from __future__ import annotations

# OPC quality of a good sample (fixed value).
GOOD = 192

HISTORY = "tag string, ts timestamp_ntz, value double, quality int"
TAG = (
    "tag string, description string, tag_type int, acquisition_type int, "
    "io_server_key int, raw_type int, created_by string, date_created timestamp_ntz"
)
TAG_HISTORY = (
    "tag string, description string, unit string, min_eu double, max_eu double, "
    "date_created timestamp_ntz"
)
NAMESPACE = "name_key int, parent_key int, name string, original_name string, type int"
GROUP_TAG = "name_key int, domain_tag_key bigint"
TAG_REF = "domain_tag_key bigint, tag string"
TAG_DESCRIPTION = "tag string, local_desc string, lang_id int"
SESSIONS = (
    "node string, user_name string, application string, mac string, ip string, "
    "database string, host_process string, conn_id string, pid int, "
    "first_ts timestamp_ntz, last_ts timestamp_ntz, cpu bigint, io bigint, mem bigint"
)
USAGE_ACTIVE = (
    "node string, user_name string, conn_id string, pid int, mac string, ip string, "
    "last_ts timestamp_ntz, first_ts timestamp_ntz, application string, "
    "cpu bigint, mem bigint, io bigint"
)
USAGE_SUMMARY = (
    "usage_type string, name string, first_ts timestamp_ntz, last_ts timestamp_ntz, "
    "active_days int, usage bigint"
)
REPLICATION_ENTITY = "entity_key bigint, source_tag string, group_key int, server_key int"
REPLICATION_GROUP = "group_key int, name string, type_key int, server_key int, schedule_key int"
REPLICATION_SERVER = "server_key int, name string"
REPLICATION_SCHEDULE = "schedule_key int, period int, unit string"
SYNC_QUEUE = (
    "entity_key bigint, source_tag string, server_key int, request_version int, "
    "mod_start_utc timestamp_ntz, mod_end_utc timestamp_ntz, "
    "earliest_exec_utc timestamp_ntz, execute_state int"
)
HISTORY_BLOCK = "from_ts timestamp_ntz, to_ts timestamp_ntz, tz_offset_min int"
ANNOTATION = "content string, user_key int, date_created timestamp_ntz, tag string"
USER = "user_key int, user_name string"
BLOCK_LISTING = "path string, block_name string, has_status boolean"
STORAGE_LOCATION = "path string, time_unit_id int, block_duration int, storage_type int"
BOOKMARK = (
    "start_ts timestamp_ntz, end_ts timestamp_ntz, last_end_ts timestamp_ntz, "
    "export_count bigint, group_name string"
)
TREND_ITEM = "file string, server string, tag string"

"""Stored schemas, enumerations and column orders."""

from __future__ import annotations

# Message as stored: polymorphic parts are VARIANT, filter keys are plain columns.
MSG_DDL = (
    "array<struct<role:string,content:variant,sender:string,tool_calls:variant,"
    "tool_call_id:string,tool_name:string,is_internal_tool:boolean,internal_tool_type:string,"
    "refusal:string,annotations:variant,audio:variant,function_call:variant>>"
)
TRANSFERS_DDL = "array<struct<from_agent:string,to_agent:string,reason:string,timestamp:string>>"

RECORD_DDL = (
    "namespace string, agent string, session_id string, "
    f"msg {MSG_DDL}, "
    "input_tokens bigint, output_tokens bigint, process_tokens bigint, memory_tokens bigint, "
    "total_tokens bigint, "
    f"transfers {TRANSFERS_DDL}, inserted_at timestamp, user_id string, user_whatsapp string, "
    "external_user_id string, external_user_name string, external_user_channel string, "
    "source string, model string"
)
LOG_DDL = (
    "namespace string, level string, message string, timestamp timestamp, "
    "resource_id string, custom_object variant"
)

# The export column orders.
RECORD_EXPORT_COLUMNS = (
    "id", "namespace", "agent", "session_id", "inserted_at", "created_at", "input_tokens",
    "output_tokens", "process_tokens", "memory_tokens", "total_tokens", "external_user_id",
    "external_user_name", "external_user_channel", "msg", "transfers",
)
LOG_EXPORT_COLUMNS = (
    "id", "namespace", "level", "message", "resource_id", "timestamp", "created_at", "custom_object",
)
LEVELS = ("debug", "info", "warn", "error")
CHANNELS = ("whatsapp", "web", "telegram", "slack", "email", "teams", "sms", "voice", "other")
# Requests a token may make per minute, by bucket.
QUOTAS = {"traces": 600, "traces_batch": 60, "bulk_upload": 60, "sessions": 600, "query": 60, "rules": 60}

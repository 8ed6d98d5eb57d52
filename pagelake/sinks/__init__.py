"""Writers: JSON lines per kind, appends to typed tables, rejects, JDBC."""

from pagelake.sinks.tables import (
    append_table, create_tables, write_jdbc, write_jsonl, write_rejects,
)

__all__ = ["append_table", "create_tables", "write_jdbc", "write_jsonl", "write_rejects"]

from vaultline.sinks.files import (
    append_stream,
    children,
    clustered,
    exists,
    interleaved,
    overwrite,
    remove,
    replace_partitions,
    settle,
    write_clustered,
    write_interleaved,
    write_json,
)
from vaultline.sinks.tables import create_tagged, create_view, register_tagged, switch_table, table_tags

__all__ = [
    "append_stream",
    "children",
    "clustered",
    "create_tagged",
    "create_view",
    "exists",
    "interleaved",
    "overwrite",
    "register_tagged",
    "remove",
    "replace_partitions",
    "settle",
    "switch_table",
    "table_tags",
    "write_clustered",
    "write_interleaved",
    "write_json",
]

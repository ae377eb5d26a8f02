"""Table writers and file-layout jobs."""

from tidewell.sinks.layout import compact, retain, write_partitioned, zorder, zorder_cuts
from tidewell.sinks.tables import append, overwrite, overwrite_partitions

__all__ = [
    "append",
    "compact",
    "overwrite",
    "overwrite_partitions",
    "retain",
    "write_partitioned",
    "zorder",
    "zorder_cuts",
]

from opsflow.sources.scans import (
    NamedQueries,
    append,
    canonicalize,
    drop_rollups,
    join_sources,
    safe_cast,
    scan,
    scan_json,
    scan_report,
)

__all__ = [
    "NamedQueries", "append", "canonicalize", "drop_rollups", "join_sources",
    "safe_cast", "scan", "scan_json", "scan_report",
]

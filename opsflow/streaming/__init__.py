from opsflow.streaming.jobs import (
    activity_windows,
    compact,
    current_state,
    dedupe_stream,
    file_stream,
    fold_windows,
    session_counts,
    sync_stream,
    unseen,
    window_state,
)
from opsflow.streaming.state import (
    ChangeLog,
    first_seen,
    fold_sessions,
    load_checked,
    rejected,
    session_state,
    sync_buckets,
)

__all__ = [
    "ChangeLog", "first_seen", "fold_sessions", "load_checked", "rejected", "session_state", "sync_buckets",
    "activity_windows", "compact", "current_state", "dedupe_stream", "file_stream",
    "fold_windows", "session_counts", "sync_stream", "unseen", "window_state",
]

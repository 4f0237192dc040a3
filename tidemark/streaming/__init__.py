from .corrected import CompactedLog, corrected_top_n, write_corrected_top_n
from .sinks import ranked_sink, read_latest, running_top_n, running_unique_sink, upsert_log
from .sliding import sliding_counts

__all__ = [
    "CompactedLog",
    "corrected_top_n",
    "ranked_sink",
    "read_latest",
    "running_top_n",
    "running_unique_sink",
    "sliding_counts",
    "upsert_log",
    "write_corrected_top_n",
]

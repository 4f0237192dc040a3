from .connectors import load_properties, publish_lines, read_csv, read_lines, sink_options, source_options
from .parsing import exclude_static_assets, parse_access_log, parse_delimited
from .tables import load_table, utc_timestamps, zoneless_timestamps

__all__ = [
    "exclude_static_assets",
    "load_properties",
    "load_table",
    "parse_access_log",
    "parse_delimited",
    "publish_lines",
    "read_csv",
    "read_lines",
    "sink_options",
    "source_options",
    "utc_timestamps",
    "zoneless_timestamps",
]

from weir.functions.json import decode_json, encode_json, encode_json_bytes
from weir.functions.time import EVENT_TIME_FORMAT, format_event_time, parse_timestamp

__all__ = [
    "EVENT_TIME_FORMAT",
    "decode_json",
    "encode_json",
    "encode_json_bytes",
    "format_event_time",
    "parse_timestamp",
]

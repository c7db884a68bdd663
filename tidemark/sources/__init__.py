"""Sources and sinks."""

from tidemark.sources.messages import decode_json, decode_raw, encode_json, encode_raw, split_undecoded
from tidemark.sources.tables import Table, read, read_back, write

__all__ = [
    "Table",
    "decode_json",
    "decode_raw",
    "encode_json",
    "encode_raw",
    "read",
    "read_back",
    "split_undecoded",
    "write",
]

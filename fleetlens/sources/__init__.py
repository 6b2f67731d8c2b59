"""Topics, message coding and files."""

from .files import read_csv, read_json_array, write_csv, write_json
from .messages import decode, encode, to_messages
from .topics import FileTopic, KafkaTopic

__all__ = ["FileTopic", "KafkaTopic", "decode", "encode", "read_csv",
           "read_json_array", "to_messages", "write_csv", "write_json"]

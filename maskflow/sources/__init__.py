"""Where records come from: Kafka topics and files, decoded by a declared schema."""

from .decode import decode_json, flag_malformed, with_reasons
from .readers import read_files, read_kafka, read_lookup

__all__ = ["decode_json", "flag_malformed", "read_files", "read_kafka", "read_lookup", "with_reasons"]

"""Column functions: decoding, encoding and display."""

from eventguard.functions.decode import decode, decode_raw, event_time
from eventguard.functions.display import feed_item, pass_rate, rupiah
from eventguard.functions.encode import encode, payload

__all__ = ["decode", "decode_raw", "encode", "event_time", "feed_item", "pass_rate", "payload", "rupiah"]

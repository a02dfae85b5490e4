from auctionflow.functions.time import epoch_ms, event_time, from_event_time, ms_interval  # noqa: F401
from auctionflow.functions.hashing import portable_hash  # noqa: F401

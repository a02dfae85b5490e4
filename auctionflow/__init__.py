"""auctionflow: auction-event analytics (persons, auctions, bids) on PySpark.

Every operator takes and returns DataFrames.  Event times are BIGINT epoch
milliseconds in all public schemas; timestamps are derived only where Spark's
window / watermark machinery needs them.
"""

__version__ = "0.1.0"

"""basketgraph: retail graph analytics on Spark DataFrames and Structured Streaming.

Invoice lines, price observations and customer feedback become typed node and
edge tables; recommendations are computed by counting multi-hop paths over
those tables with joins and aggregations, never by enumerating paths on the
driver.
"""

__version__ = "0.1.0"

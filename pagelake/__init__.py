"""pagelake: Spark jobs over landed social-media JSON pages.

Pages that a fetcher has already landed (one row per HTTP response body plus
its request context) are turned into typed tables, filtered, linked,
de-duplicated, sliced into work shares and audited, in batch or in
Structured Streaming.  Everything is DataFrame / built-in-function work.
"""

__version__ = "0.1.0"

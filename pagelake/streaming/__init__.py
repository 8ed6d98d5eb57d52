"""Structured Streaming forms of the batch operators."""

from pagelake.streaming.streams import (
    run_to_end, stream_error_streak, stream_extract, stream_max_id, stream_new_commenters,
    stream_profile_error_streak, stream_take_until,
)

__all__ = ["run_to_end", "stream_error_streak", "stream_extract", "stream_max_id",
           "stream_new_commenters", "stream_profile_error_streak", "stream_take_until"]

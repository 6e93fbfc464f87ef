"""Structured Streaming queries: log forwarding, event parsing, real-time suggestions."""

from tasteflow.streaming.event_time import on_time_events
from tasteflow.streaming.logs import filter_rating_logs, rating_events_from_logs, start_event_parser, start_log_forwarder
from tasteflow.streaming.recommender import RealtimeRecommender
from tasteflow.streaming.sink import append_lists, newest_lists

__all__ = [
    "RealtimeRecommender", "append_lists", "filter_rating_logs", "newest_lists", "on_time_events", "rating_events_from_logs",
    "start_event_parser", "start_log_forwarder",
]

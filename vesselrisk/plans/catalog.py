"""Imports every query module so the registry is complete."""

from __future__ import annotations

from . import causal_queries, eval_queries, backtest_queries, fusion_queries, graph_queries, label_queries, monitor_queries, news_queries, quality_queries, reader_queries, score_queries, stream_queries, track_queries  # noqa: F401

FLAGSHIP = "watchlist"

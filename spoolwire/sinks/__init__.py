"""Sinks: publishing to topics."""

from spoolwire.sinks.topic import PRODUCER_SETTINGS, PublishResult, publish

__all__ = ["PRODUCER_SETTINGS", "PublishResult", "publish"]

"""Composed jobs: CSV to topic, topic to typed records, and the registered query catalog."""

from spoolwire.plans.consume import consume_topic
from spoolwire.plans.upload import upload_csv

__all__ = ["consume_topic", "upload_csv"]

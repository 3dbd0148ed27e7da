"""Check for the streaming event cleaner."""

from __future__ import annotations

import uuid

from featuremart.catalog import register
from featuremart.catalog.common import STANDIN_CTES, with_ctes
from featuremart.session import shared_dir
from featuremart.sources.stream_standins import event_stream
from featuremart.streaming.events import read_clean_events, start_clean_events


@register(
    "stream_clean_events",
    with_ctes(
        STANDIN_CTES,
        """dedup AS (
  SELECT event_id, session_id, "timestamp", event_type, product_id FROM (
    SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY "timestamp") AS rn FROM src_events)
  WHERE rn = 1
)""",
        select="SELECT * FROM dedup WHERE product_id IS NOT NULL",
    ),
)
def stream_clean_events(spark, sf_dir):
    base = f"{shared_dir(spark)}/featuremart-streams/{uuid.uuid4().hex}"
    q = start_clean_events(spark, event_stream(spark, sf_dir), f"{base}/out", f"{base}/checkpoint")
    q.awaitTermination()
    return read_clean_events(spark, f"{base}/out")

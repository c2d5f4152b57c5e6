"""The publish job: take raw rows, shape them into messages, write them to a topic."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame

from ledgerlark.operators.sampling import HashOrder, shuffled, take
from ledgerlark.sources.messages import publish, to_envelope, transaction_payload, with_ordinal


def publish_rows(raw: DataFrame, config: Mapping, limit: int | None = None, seed: int = 42,
                 index: str | None = None, topic: str | None = None) -> DataFrame:
    """Publish all raw rows in random order, or a uniform sample of ``limit`` of them.

    Returns the published envelope.
    """
    order = HashOrder("ordinal", seed)
    rows = with_ordinal(raw)
    rows = shuffled(rows, order) if limit is None else take(rows, limit, order)
    envelope = to_envelope(transaction_payload(rows, index))
    publish(envelope, config, topic)
    return envelope

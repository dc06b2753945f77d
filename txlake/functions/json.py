"""Envelope JSON construction."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def envelope_json(object_id: Column, object_type: Column, sent_dttm: Column,
                  payload: Column) -> Column:
    """One envelope as compact JSON text; ``payload`` is a struct column.

    Null payload fields are left out of the text (``to_json`` default), and
    read back as null by ``from_json``.
    """
    return F.to_json(
        F.struct(
            object_id.alias("object_id"),
            object_type.alias("object_type"),
            sent_dttm.alias("sent_dttm"),
            payload.alias("payload"),
        )
    )

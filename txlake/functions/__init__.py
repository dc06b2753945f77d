"""Column expressions. All are JVM-side built-ins: no Python UDFs."""

from txlake.functions.ids import uuid5, uuid5_from_parts
from txlake.functions.status import status_rank
from txlake.functions.time import (
    format_event_time,
    parse_event_time,
)
from txlake.functions.json import envelope_json

__all__ = [
    "uuid5",
    "uuid5_from_parts",
    "status_rank",
    "format_event_time",
    "parse_event_time",
    "envelope_json",
]

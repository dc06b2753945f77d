"""Deterministic name-based UUIDs (RFC 4122 version 5) as Spark expressions.

``uuid5(name)`` equals Python's ``uuid.uuid5(namespace, name)``: SHA-1 over the
16 namespace bytes followed by the UTF-8 name, first 16 bytes kept, version
nibble set to 5 and the variant bits to ``10``. Everything is a built-in
expression, so it runs inside whole-stage codegen on the executors.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from txlake.schemas import UUID_NAMESPACE


def uuid5(name: Column, namespace: str = UUID_NAMESPACE) -> Column:
    """UUIDv5 text of a string column (null name -> null id).

    Built only from null-propagating expressions (no ``CASE``), so the
    repeated digest is one common subexpression, hashed once per row.
    """
    ns_hex = namespace.replace("-", "").lower()
    digest = F.sha1(F.concat(F.unhex(F.lit(ns_hex)), F.encode(name, "UTF-8")))
    # byte 8 of the id keeps its low 6 bits and gets the variant bits 10
    variant = F.lower(
        F.hex(
            (F.conv(F.substring(digest, 17, 1), 16, 10).cast("int")
             .bitwiseAND(F.lit(3)))
            .bitwiseOR(F.lit(8))
        )
    )
    return F.concat(
        F.substring(digest, 1, 8), F.lit("-"),
        F.substring(digest, 9, 4), F.lit("-5"),
        F.substring(digest, 14, 3), F.lit("-"),
        variant, F.substring(digest, 18, 3), F.lit("-"),
        F.substring(digest, 21, 12),
    )


def uuid5_from_parts(*parts: Column, namespace: str = UUID_NAMESPACE,
                     sep: str = "") -> Column:
    """UUIDv5 of the parts' text joined by ``sep``.

    The default ``sep=""`` reproduces the upstream id, where (41, 470) and
    (414, 70) with the same date collide; pass a separator to avoid that.
    Any null part gives a null id.
    """
    texts: list[Column] = []
    for i, p in enumerate(parts):
        if i and sep:
            texts.append(F.lit(sep))
        texts.append(p.cast("string"))
    # concat (unlike concat_ws) is null when any part is null
    return uuid5(F.concat(*texts), namespace)

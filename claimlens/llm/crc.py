"""The unsigned crc32 of a text as a DuckDB expression, for SQL that checks queries; Spark has its own function."""

from __future__ import annotations


def _table() -> list[int]:
    out = []
    for c in range(256):
        for _ in range(8):
            c = (c >> 1) ^ (0xEDB88320 if c & 1 else 0)
        out.append(c)
    return out


def crc32_sql(text: str) -> str:
    """text: a SQL expression of code points below U+0800; null gives null."""
    codes = f"list_transform(range(1, length({text}) + 1), lambda i: unicode(substr({text}, i, 1)))"
    octets = f"flatten(list_transform({codes}, lambda c: CASE WHEN c < 128 THEN [c::bigint] ELSE [(192 + (c >> 6))::bigint, (128 + (c & 63))::bigint] END))"
    step = f"lambda s, b: xor({_table()}[(xor(s, b) & 255) + 1], s >> 8)"
    return f"xor(list_reduce({octets}, {step}, 4294967295::bigint), 4294967295)"

"""CRC-32 (the polynomial of zlib's) as DuckDB SQL, for queries that hash text."""

from __future__ import annotations


def table() -> list[int]:
    out = []
    for b in range(256):
        for _ in range(8):
            b = b >> 1 ^ (0xEDB88320 if b & 1 else 0)
        out.append(b)
    return out


def crc32_sql(text: str) -> str:
    """Unsigned CRC-32 of the UTF-8 bytes of a SQL expression of type VARCHAR."""
    steps = f"list_transform(range(length(hex({text})) // 2), lambda i: ('0x' || substr(hex({text}), 2 * i + 1, 2))::UBIGINT)"
    each = f"lambda c, b: xor(c >> 8, {table()}[((xor(c, b) & 255) + 1)::BIGINT]::UBIGINT)"
    return f"xor(list_reduce(list_prepend(4294967295::UBIGINT, {steps}), {each}), 4294967295::UBIGINT)::BIGINT"

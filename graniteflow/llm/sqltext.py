"""DuckDB expressions that several SQL twins share."""

from __future__ import annotations


def sql_crc32(text: str) -> str:
    """CRC-32 of an ASCII text, bit by bit with the reversed polynomial; null for null."""
    codes = f"list_transform(range(1, length({text}) + 1), lambda i: ascii(({text})[i])::BIGINT)"
    bits = "list_reduce(list_prepend(xor(a, b), range(8)), lambda c, d: xor(c >> 1, 3988292384 * (c & 1)))"
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, {codes}), lambda a, b: {bits}), 4294967295)"


def sql_leaf(*columns: str) -> str:
    """Digest of a row: ``-`` for null, else byte count, colon and text of each column."""
    part = lambda c: f"coalesce(strlen(({c})::VARCHAR) || ':' || ({c})::VARCHAR, '-')"
    return f"sha256({' || '.join(part(c) for c in columns)})"

"""Pieces of DuckDB SQL shared by the twins of the queries."""

from __future__ import annotations

#: Table ``crc(t)``: the CRC-32 (reflected, polynomial 0xEDB88320) of each byte value.
CRC_TABLE = """
crc AS (SELECT list(v ORDER BY i) AS t FROM (
  SELECT i, list_reduce(list_prepend(i::UBIGINT, [0, 1, 2, 3, 4, 5, 6, 7]::UBIGINT[]),
    lambda c, n: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS v FROM range(256) r(i)))
"""


def crc32(text: str) -> str:
    """CRC-32 of a text of code points below 2048, as UTF-8; wants ``crc`` in scope."""
    utf8 = (f"flatten(list_transform(string_split({text}, ''), lambda ch: CASE WHEN unicode(ch) < 128 THEN [unicode(ch)]"
            " ELSE [192 | (unicode(ch) >> 6), 128 | (unicode(ch) & 63)] END))")
    return (f"xor(list_reduce(list_prepend(4294967295::UBIGINT, {utf8}::UBIGINT[]), "
            "lambda c, b: xor(c >> 8, crc.t[(xor(c, b) & 255)::INT + 1])), 4294967295)")

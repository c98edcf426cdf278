"""CRC-32 of many byte runs at once.

The checksum is linear: that of A followed by B is that of A, carried over as many zero bytes as B has,
xor that of B.  So a run costs a table look-up a byte, and a run of words only those of its words.
"""

from __future__ import annotations

import zlib

import numpy as np

POLYNOMIAL = 0xEDB88320
#: longer runs are summed one by one
SHORT = 64


def _byte_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = (table >> 1) ^ np.where(table & 1, np.uint32(POLYNOMIAL), np.uint32(0))
    return table


TABLE = _byte_table()


def _apply(tables: np.ndarray, x: np.ndarray) -> np.ndarray:
    return tables[0][x & 255] ^ tables[1][(x >> 8) & 255] ^ tables[2][(x >> 16) & 255] ^ tables[3][x >> 24]


def _zero_tables() -> list[np.ndarray]:
    """Operators that carry a checksum over 1, 2, 4, ... zero bytes, as four tables by byte of the checksum."""
    unit = np.arange(256, dtype=np.uint32)
    first = np.stack([unit << np.uint32(8 * b) for b in range(4)])
    tables = [(first >> 8) ^ TABLE[first & 255]]
    for _ in range(31):
        tables.append(np.stack([_apply(tables[-1], row) for row in tables[-1]]))
    return tables


ZEROS = _zero_tables()


def carry(crc: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Checksums, each carried over its own number of zero bytes."""
    out = crc.copy()
    for k in range(int(n.max(initial=0)).bit_length()):
        at = np.flatnonzero((n >> k) & 1)
        out[at] = _apply(ZEROS[k], out[at])
    return out


def joined(first: np.ndarray, second: np.ndarray, second_len: np.ndarray) -> np.ndarray:
    """Checksums of runs A followed by B, of those of A and B and the length of B."""
    return carry(first, second_len) ^ second


def crc32(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Checksum of each run of bytes."""
    lengths = ends - starts
    out = np.full(len(starts), 0xFFFFFFFF, np.uint32)
    at = np.flatnonzero((lengths > 0) & (lengths <= SHORT))
    j = 0
    while len(at):
        out[at] = (out[at] >> 8) ^ TABLE[(out[at] ^ buf[starts[at] + j]) & 255]
        j += 1
        at = at[lengths[at] > j]
    out ^= np.uint32(0xFFFFFFFF)
    for i in np.flatnonzero(lengths > SHORT):
        out[i] = zlib.crc32(buf[starts[i] : ends[i]])
    return out


#: DuckDB SQL: macros and tables by which any text's checksum is a sum (xor) over its bytes.  `crc_step`
#: holds what each byte adds at its distance from the end; a text's own length adds the rest.
def sql(texts: str, key: str, text: str) -> str:
    """CTEs (to follow WITH RECURSIVE) that end in `crc_of({key}, crc)`: a row for each row of table `texts`."""
    return f"""
crc_bits(b, k, v) AS (SELECT b::BIGINT, 0, b::BIGINT FROM range(256) t(b)
  UNION ALL SELECT b, k + 1, CASE WHEN v & 1 = 1 THEN xor(v >> 1, {POLYNOMIAL}::BIGINT) ELSE v >> 1 END FROM crc_bits WHERE k < 8),
crc_table AS (SELECT list(v ORDER BY b) AS t FROM crc_bits WHERE k = 8),
crc_bytes AS (SELECT {key}, hex(encode({text})) AS h, octet_length(encode({text})) AS n FROM {texts}),
crc_most AS (SELECT coalesce(max(n), 0) AS most FROM crc_bytes),
crc_step(d, b, v) AS (SELECT 0, b - 1, t[b] FROM crc_table, range(1, 257) r(b)
  UNION ALL SELECT d + 1, b, xor(v >> 8, t[(v & 255) + 1]) FROM crc_step, crc_table, crc_most WHERE d + 1 < most),
crc_start(n, v) AS (SELECT 0, 4294967295::BIGINT
  UNION ALL SELECT n + 1, xor(v >> 8, t[(v & 255) + 1]) FROM crc_start, crc_table, crc_most WHERE n < most),
crc_each AS (SELECT {key}, n, unnest(range(n)) AS i, h FROM crc_bytes),
crc_sum AS (
  SELECT {key}, bit_xor(s.v) AS v FROM (SELECT {key}, n - 1 - i AS d, ('0x' || substr(h, 2 * i + 1, 2))::BIGINT AS b FROM crc_each) e
  JOIN crc_step s ON s.d = e.d AND s.b = e.b GROUP BY {key}),
crc_of AS (SELECT t.{key}, xor(xor(coalesce(s.v, 0), a.v), 4294967295::BIGINT)::BIGINT AS crc FROM crc_bytes t JOIN crc_start a ON a.n = t.n LEFT JOIN crc_sum s ON s.{key} = t.{key})"""

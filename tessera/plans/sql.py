"""DuckDB-dialect fragments mirroring ``tessera.functions.text`` for the oracle SQL.

The character classes are the same strings as on the Spark side; only the call
shapes differ (``'g'`` flag, ``\\1`` back-references).
"""

from __future__ import annotations

from tessera.functions.text import WORD, WS


def strip(x: str) -> str:
    return f"regexp_replace({x}, '^{WS}+|{WS}+$', '', 'g')"


def collapse(x: str) -> str:
    return f"regexp_replace({x}, '{WS}+', ' ', 'g')"


def validate(x: str, lo: int = 3, hi: int | None = 200) -> str:
    fits = f">= {lo}" if hi is None else f"BETWEEN {lo} AND {hi}"
    return f"coalesce(length({strip(x)}) {fits} AND regexp_matches({x}, '[a-zA-Z]'), false)"


def clean(x: str) -> str:
    t = f"regexp_replace({collapse(strip(x))}, '^[''\"](.*)[''\"]$', '\\1')"
    first = f"substr({t}, 1, 1)"
    return f"(CASE WHEN lower({first}) = {first} AND upper({first}) <> {first} THEN upper({first}) ELSE {first} END || substr({t}, 2))"


def key(x: str) -> str:
    return f"lower({strip(x)})"


def slug(x: str) -> str:
    return f"regexp_replace(regexp_replace(lower({x}), '[^a-z0-9]+', '-', 'g'), '^-+|-+$', '', 'g')"


def placeholders(x: str) -> str:
    return f"list_distinct(regexp_extract_all({x}, '\\{{\\{{({WORD}+)\\}}\\}}', 1))"


def repeat_blocks(x: str) -> str:
    return f"list_distinct(regexp_extract_all({x}, '<!--{WS}*REPEAT:({WORD}+){WS}*-->', 1))"


def md5_order(seed: str, x: str) -> str:
    return f"md5('{seed}' || '|' || {x})"

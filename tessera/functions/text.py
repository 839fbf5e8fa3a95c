"""Text rules as Column expressions (JVM-side, whole-stage codegen friendly).

Python's ``str.strip()`` / ``\\s`` and ``\\w`` are Unicode-aware while Java's
defaults are ASCII, so every rule below spells its character classes out.
The same class strings are accepted by RE2, which keeps the DuckDB oracle SQL
textually identical.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The whitespace set of Python's str.strip()/\s, and its \w.
WS = r"[\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
WORD = r"[\p{L}\p{N}_]"
# The same 29 code points as a plain character set (for btrim), built from the
# ranges above: \t-\r, \x1c-\x20, 0x85, 0xa0, 0x1680, 0x2000-0x200a, 0x2028,
# 0x2029, 0x202f, 0x205f, 0x3000.
_WS_RANGES = [(0x09, 0x0D), (0x1C, 0x20), (0x85, 0x85), (0xA0, 0xA0), (0x1680, 0x1680), (0x2000, 0x200A),
              (0x2028, 0x2029), (0x202F, 0x202F), (0x205F, 0x205F), (0x3000, 0x3000)]
WS_CHARS = "".join(chr(c) for lo, hi in _WS_RANGES for c in range(lo, hi + 1))


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def py_strip(x) -> Column:
    """``s.strip()`` with Python's whitespace set (Spark ``trim`` only drops U+0020).
    A character-set trim from both ends: no regex scan over the whole text."""
    return F.btrim(_c(x), F.lit(WS_CHARS))


_WS_NOT_SPACE = WS_CHARS.replace(" ", "")


def collapse_ws(x) -> Column:
    """``re.sub(r'\\s+', ' ', s)``: every whitespace code point becomes a space
    (a per-character ``translate``), then runs of spaces collapse. Same result as
    one regex over the 29-point class, at about half the cost."""
    return F.regexp_replace(F.translate(_c(x), _WS_NOT_SPACE, " " * len(_WS_NOT_SPACE)), " {2,}", " ")


def has_ascii_letter(x) -> Column:
    return _c(x).rlike("[a-zA-Z]")


def validate_text(x, min_len: int = 3, max_len: int | None = 200) -> Column:
    """String whose stripped length is in [min_len, max_len] and that has an
    ASCII letter; ``max_len=None`` sets no ceiling. Length is taken before whitespace collapse. Null -> false."""
    n = F.length(py_strip(x))
    fits = n >= min_len if max_len is None else n.between(min_len, max_len)
    return F.coalesce(fits & has_ascii_letter(x), F.lit(False))


def unquote_once(x) -> Column:
    """Drop one leading and one trailing quote of either kind (may be mismatched)."""
    return F.regexp_replace(_c(x), r"""^['"](.*)['"]$""", "$1")


def upper_first(x) -> Column:
    """Upper-case the first character only when it is lower-case (``islower``):
    a character equal to its lower case but not to its upper case. Titlecase
    letters such as U+01C5 are left alone, as in Python."""
    c = _c(x)
    first = F.substring(c, 1, 1)
    is_lower = (F.lower(first) == first) & (F.upper(first) != first)
    return F.concat(F.when(is_lower, F.upper(first)).otherwise(first), F.substring(c, 2, 2147483647))


def clean_text(x) -> Column:
    """Strip -> collapse whitespace -> drop one quote at each end -> upper-case first char."""
    return upper_first(unquote_once(collapse_ws(py_strip(x))))


def dedup_key(x) -> Column:
    """``text.strip().lower()``."""
    return F.lower(py_strip(x))


def slugify(x) -> Column:
    """B1: lower, runs of non [a-z0-9] -> '-', strip '-'."""
    return F.regexp_replace(F.regexp_replace(F.lower(_c(x)), "[^a-z0-9]+", "-"), "^-+|-+$", "")


def strip_code_fences(x, final_strip: bool = True) -> Column:
    """Strip; only when it starts with a fence drop the opening fence line and a
    closing ``\\n```\\`` at the very end; strip again (template/effect form)."""
    t = py_strip(x)
    unfenced = F.regexp_replace(F.regexp_replace(t, "^```[a-zA-Z]*\n", ""), "\n```$", "")
    out = F.when(t.startswith("```"), unfenced).otherwise(t)
    return py_strip(out) if final_strip else out


def placeholders(x) -> Column:
    """Distinct ``{{word}}`` names (no inner spaces)."""
    return F.array_distinct(F.regexp_extract_all(_c(x), F.lit(r"\{\{(" + WORD + r"+)\}\}"), 1))


def repeat_blocks(x) -> Column:
    """Distinct names of ``<!-- REPEAT:name -->`` markers (any inner whitespace)."""
    return F.array_distinct(
        F.regexp_extract_all(_c(x), F.lit(r"<!--" + WS + r"*REPEAT:(" + WORD + r"+)" + WS + r"*-->"), 1)
    )


CODE_BLOCK = r"(?s)```(" + WORD + r"*)\n(.*?)```"


def code_blocks(x) -> Column:
    """``array<struct<language, code>>`` of fenced spans; language defaults to 'text'."""
    c = _c(x)
    langs = F.regexp_extract_all(c, F.lit(CODE_BLOCK), 1)
    codes = F.regexp_extract_all(c, F.lit(CODE_BLOCK), 2)
    return F.zip_with(
        langs,
        codes,
        lambda lang, code: F.struct(
            F.when(lang == "", F.lit("text")).otherwise(lang).alias("language"),
            py_strip(code).alias("code"),
        ),
    )


def code_explanation(x) -> Column:
    """Text with every fenced span removed, stripped."""
    return py_strip(F.regexp_replace(_c(x), CODE_BLOCK, ""))


def chat_message(x) -> Column:
    """struct(content, finish_reason) of the first choice of a chat response; a response without a reason says
    ``unknown``; without a choice, or where it is no JSON, the content is null."""
    c = F.col(x) if isinstance(x, str) else x
    reason = F.coalesce(F.get_json_object(c, "$.choices[0].finish_reason"), F.lit("unknown"))
    return F.struct(F.get_json_object(c, "$.choices[0].message.content").alias("content"), reason.alias("finish_reason"))


def split_reasoning(x) -> Column:
    """struct(reasoning, answer) for closed / unclosed / absent ``<think>``."""
    c = _c(x)
    closed = c.rlike(r"(?s)<think>.*?</think>")
    inside = F.regexp_extract(c, r"(?s)<think>(.*?)</think>(.*)", 1)
    after = F.regexp_extract(c, r"(?s)<think>(.*?)</think>(.*)", 2)
    # text after the first '<think>'
    open_rest = F.substring(c, F.instr(c, "<think>") + 7, 2147483647)
    return (
        F.when(closed, F.struct(py_strip(inside).alias("reasoning"), py_strip(after).alias("answer")))
        .when(c.contains("<think>"), F.struct(py_strip(open_rest).alias("reasoning"), F.lit("").alias("answer")))
        .otherwise(F.struct(F.lit("").alias("reasoning"), py_strip(c).alias("answer")))
    )


def head_preview(x, n: int = 200) -> Column:
    """First n chars plus '...' when longer."""
    c = _c(x)
    return F.when(F.length(c) > n, F.concat(F.substring(c, 1, n), F.lit("..."))).otherwise(c)


def tail_preview(x, n: int = 200) -> Column:
    """B26: '...' plus last n chars, only when longer (else null)."""
    c = _c(x)
    return F.when(F.length(c) > n, F.concat(F.lit("..."), F.substring(c, -n, n)))


def strip_paired_quotes(x) -> Column:
    """When length >= 2 and the same quote opens and closes, drop one layer and strip."""
    c = _c(x)
    first = F.substring(c, 1, 1)
    last = F.substring(c, -1, 1)
    cond = (F.length(c) >= 2) & (first == last) & first.isin('"', "'")
    inner = F.regexp_replace(c, r"(?s)^.(.*).$", "$1")
    return F.when(cond, py_strip(inner)).otherwise(c)


def strip_quote_chars(x) -> Column:
    """``s.strip('"\\'')`` — any run of either quote at both ends."""
    return F.btrim(_c(x), F.lit("\"'"))

"""Request routing and action tagging as Column expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from tessera.functions import text as T
from tessera.functions.fmt import fmt

# The website hard-rule phrases, in order.
WEBSITE_KEYWORDS = [
    "website", "web site", "webpage", "web page", "landing page",
    "build me a site", "build a site", "my site", "homepage",
    "create a website", "make a website", "website for", "site for my",
]

# Dangerous shell patterns and their reasons, in match order.
DANGEROUS_PATTERNS = [
    (r"\brm\s+-rf\s+/\S*", "rm -rf on an absolute path"),
    (r"\brm\s+-rf\s+\*", "rm -rf with wildcard"),
    (r"\brm\s+-rf\s+~", "rm -rf on home directory shorthand"),
    (r"\bgit\s+push\s+.*--force\b", "force push"),
    (r"\bgit\s+push\s+.*-f\b", "force push (short flag)"),
    (r"\bgit\s+reset\s+--hard\b", "git reset --hard"),
    (r"\bgit\s+clean\s+-[a-z]*f[a-z]*d\b", "git clean force+directories"),
    (r":\(\)\s*\{.*\};\s*:", "fork bomb pattern"),
    (r"\bmkfs\b", "filesystem format command"),
    (r"\bdd\s+.*of=/dev/", "dd writing directly to a device"),
    (r"\bchmod\s+-R\s+777\b", "recursive chmod 777"),
]

# Model aliases and per-model answer budgets (default 300).
MODEL_ALIAS = {"direct": "router"}
MAX_TOKENS = {"router": 300, "terminal": 100, "coder": 1500}
DEFAULT_MAX_TOKENS = 300
CATEGORY_MODEL = {"terminal": "terminal", "code": "coder", "direct": "direct"}
# Confirmation tiers and the action preview format.
TIER_DANGEROUS, TIER_DEFAULT = "strict", "confirm"
PREVIEW = "Run shell command: {command}"


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


# White space of Python's str patterns, as an explicit class that Java and RE2 read alike.
PY_SPACE = r"\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"


def python_pattern(pattern: str) -> str:
    """A Python pattern's ``\\s``, ``\\S`` and ``.`` outside classes, written so that every engine reads
    them as Python does: Unicode white space, and any character but a line feed."""
    out, i, inside = [], 0, False
    while i < len(pattern):
        two, one = pattern[i : i + 2], pattern[i]
        if two in (r"\s", r"\S"):
            body = PY_SPACE
            out.append(body if inside else f"[{'^' if two == chr(92) + 'S' else ''}{body}]")
            i += 2
        elif one == "\\":
            out.append(two)
            i += 2
        else:
            inside = one == "[" or inside and one != "]"
            out.append(r"[^\n]" if one == "." and not inside else one)
            i += 1
    return "".join(out)


def keyword_hit(x, keywords: Sequence[str] = WEBSITE_KEYWORDS) -> Column:
    """The lower-cased request contains any phrase."""
    low = F.lower(_c(x))
    return F.exists(F.array(*[F.lit(k) for k in keywords]), lambda k: F.instr(low, k) > 0)


def danger_reason(cmd) -> Column:
    """Reason of the first matching pattern, null when none matches."""
    c = _c(cmd)
    out = None
    for pat, reason in DANGEROUS_PATTERNS:
        out = F.when(c.rlike(python_pattern(pat)), F.lit(reason)) if out is None else out.when(c.rlike(python_pattern(pat)), F.lit(reason))
    return out


def confirm_level(reason: Column) -> Column:
    """Dangerous -> 'strict', else 'confirm'."""
    return F.when(reason.isNotNull(), F.lit(TIER_DANGEROUS)).otherwise(F.lit(TIER_DEFAULT))


def preview(cmd) -> Column:
    """``Run shell command: {command}`` (missing command -> '')."""
    return fmt(PREVIEW, command=F.coalesce(_c(cmd), F.lit("")))


def draft_command(answer) -> Column:
    """B27 applied to a stripped model answer."""
    return T.strip_paired_quotes(T.py_strip(answer))


def model_for(category) -> Column:
    """Category -> model name, with the direct -> router alias."""
    c = _c(category)
    m = F.create_map(*[x for k, v in CATEGORY_MODEL.items() for x in (F.lit(k), F.lit(v))])[c]
    alias = F.create_map(*[x for k, v in MODEL_ALIAS.items() for x in (F.lit(k), F.lit(v))])
    return F.coalesce(alias[m], m)


def max_tokens(model) -> Column:
    """Per-model budget, default 300."""
    b = F.create_map(*[x for k, v in MAX_TOKENS.items() for x in (F.lit(k), F.lit(v))])
    return F.coalesce(b[_c(model)], F.lit(DEFAULT_MAX_TOKENS)).cast("long")

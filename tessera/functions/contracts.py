"""Document contracts as Column expressions: B13 template, B14 effect, B16/B17
business data, B35 strict review flag, B37 missing artefact files.

Each validator returns the message of the *first* failing rule (null = valid),
built as one ordered ``coalesce(when(...), ...)``; sets in messages are sorted.
Meta JSON stays a string column: key presence comes from
``json_object_keys`` (absent != null) and strict types from VARIANT.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tessera.functions import text as T
from tessera.functions.fmt import fmt

REPEATING_SCHEMA = "map<string, struct<container_marker: string, fields: array<string>>>"
PLACEHOLDERS_SCHEMA = f"struct<scalar: array<string>, repeating: {REPEATING_SCHEMA}>"

# Fixed values (must equal the reference's rules and messages), in rule order.
TEMPLATE_REQUIRED = ["id", "level", "category", "subcategory", "placeholders"]
END_MARKERS = ["<!-- END:{block} -->", "<!--END:{block}-->"]
# Own message: meta is not an object, or its placeholders are not one.
MSG_BAD_META = "Meta is not a valid object"
MSG_TOP_KEYS = "Missing required top-level keys (meta/html/css)"
MSG_MISSING_FIELD = "meta.json missing required field: {field}"
MSG_UNDECLARED = "Placeholders used but not declared in meta: {names}"
MSG_UNUSED = "Scalar placeholders declared but never used: {names}"
MSG_NO_BLOCK = "Declared repeating block '{block}' not found in html"
MSG_NO_END = "Repeating block '{block}' missing matching END marker"
MSG_MISSING_FILES = "Missing index.html or style.css"
EFFECT_REQUIRED = ["id", "type", "trigger", "name", "category", "css_class", "requires_js", "requires_shared_js"]
EFFECT_CLASS_PREFIX = "fx-"
SCROLL_HELPER_ID = "scroll-reveal-observer-v1"
CSS_REDUCED_MOTION = "prefers-reduced-motion"
CSS_IN_VIEW = "fx-in-view"
CSS_SCROLL_TARGET = "fx-scroll-target"
CSS_KEYFRAMES = "@keyframes"
CSS_HOVER = ":hover"
MSG_TRIGGER = "trigger mismatch: expected '{expected}', got '{got}'"
MSG_PREFIX = "css_class must start with 'fx-', got: {css_class}"
MSG_CLASS_NOT_IN_CSS = "css_class '{css_class}' declared in meta but not found in css"
MSG_REDUCED_MOTION = "Missing required @media (prefers-reduced-motion: reduce) block"
MSG_SCROLL_JS = "onscroll effect must have requires_js: true"
MSG_SCROLL_SHARED = "onscroll effect must set requires_shared_js to 'scroll-reveal-observer-v1'"
MSG_SCROLL_IN_VIEW = "onscroll effect css must reference fx-in-view state"
MSG_SCROLL_TARGET = "onscroll effect css must reference fx-scroll-target class"
MSG_NO_JS = "{trigger} effect must have requires_js: false"
MSG_NO_SHARED = "{trigger} effect must have requires_shared_js: null"
MSG_KEYFRAMES = "onload effect should use a @keyframes animation"
MSG_HOVER = "hover effect css must include a :hover selector"
HEX_COLOR = r"^#([0-9a-fA-F]{3}|[0-9a-fA-F]{6})$"


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def py_set(arr: Column) -> Column:
    """Python-style set text ``{'a', 'b'}`` (sorted, so it is deterministic)."""
    return F.concat(F.lit("{"), F.array_join(F.transform(F.array_sort(arr), lambda e: F.concat(F.lit("'"), e, F.lit("'"))), ", "), F.lit("}"))


def meta_keys(meta) -> Column:
    return F.json_object_keys(_c(meta))


def missing_field(meta, fields) -> Column:
    """Message for the first required field absent from the meta object."""
    keys = meta_keys(meta)
    out = None
    for f in fields:
        cond = ~F.array_contains(keys, f)
        msg = fmt(MSG_MISSING_FIELD, field=f)
        out = F.when(cond, msg) if out is None else out.when(cond, msg)
    return out


def placeholders_struct(meta) -> Column:
    return F.from_json(F.get_json_object(_c(meta), "$.placeholders"), PLACEHOLDERS_SCHEMA)


def template_error(meta, html, css) -> Column:
    """B13 (review form): meta an object whose placeholders are one -> required fields -> undeclared used -> unused scalar ->
    per declared block (declaration order): block absent, then END absent."""
    meta, html, css = _c(meta), _c(html), _c(css)
    ph = placeholders_struct(meta)
    scalar = F.coalesce(ph["scalar"], F.array().cast("array<string>"))
    rep = F.coalesce(ph["repeating"], F.create_map().cast(REPEATING_SCHEMA))
    rep_fields = F.flatten(F.transform(F.map_values(rep), lambda b: F.coalesce(b["fields"], F.array().cast("array<string>"))))
    declared = F.array_union(scalar, rep_fields)
    used = F.array_union(T.placeholders(html), T.placeholders(css))
    undeclared = F.array_except(used, declared)
    unused = F.array_except(F.array_distinct(scalar), used)
    blocks = T.repeat_blocks(html)

    def end_ok(b):
        found = [html.contains(fmt(m, block=b)) for m in END_MARKERS]
        return found[0] | found[1]

    # get(): null (not an error under ANSI) when no block fails
    bad_block = F.get(F.filter(F.map_keys(rep), lambda b: ~F.array_contains(blocks, b) | ~end_ok(b)), 0)
    block_msg = F.when(~F.array_contains(blocks, bad_block), fmt(MSG_NO_BLOCK, block=bad_block)).otherwise(
        fmt(MSG_NO_END, block=bad_block)
    )
    spec = F.get_json_object(meta, "$.placeholders")
    broken = meta.isNotNull() & (F.json_object_keys(meta).isNull() | F.coalesce(~T.py_strip(spec).startswith("{"), F.lit(False)))
    return F.coalesce(
        F.when(broken, F.lit(MSG_BAD_META)),
        missing_field(meta, TEMPLATE_REQUIRED),
        F.when(F.size(undeclared) > 0, fmt(MSG_UNDECLARED, names=py_set(undeclared))),
        F.when(F.size(unused) > 0, fmt(MSG_UNUSED, names=py_set(unused))),
        F.when(bad_block.isNotNull(), block_msg),
    )


def json_type(meta, path: str) -> Column:
    """VARIANT type name of a JSON path (BOOLEAN, STRING, VOID for JSON null, null if absent)."""
    return F.schema_of_variant(F.expr(f"variant_get(try_parse_json({_name(meta)}), '{path}', 'variant')"))


def _name(x) -> str:
    if isinstance(x, str):
        return f"`{x}`"
    raise TypeError("pass the meta column by name")


def effect_error(meta: str, css: str, trigger: str) -> Column:
    """Meta an object -> keys -> trigger -> fx- prefix -> class in css -> reduced motion ->
    onscroll/js rules (strict JSON booleans) -> @keyframes (onload) -> :hover (hover). A rule that meets a null
    (no css, a null class) is not met."""
    m, c, t = F.col(meta), F.col(css), F.col(trigger)
    got_trigger = F.get_json_object(m, "$.trigger")
    css_class = F.get_json_object(m, "$.css_class")
    js_type = json_type(meta, "$.requires_js")
    js_val = F.get_json_object(m, "$.requires_js")
    shared_type = json_type(meta, "$.requires_shared_js")
    shared_val = F.get_json_object(m, "$.requires_shared_js")
    is_true = (js_type == "BOOLEAN") & (js_val == "true")
    is_false = (js_type == "BOOLEAN") & (js_val == "false")
    onscroll = F.coalesce(t == "onscroll", F.lit(False))
    shown = F.coalesce(css_class, F.lit("None"))
    unless = lambda rule, message: F.when(F.coalesce(~rule, F.lit(True)), message)
    where = lambda kind, rule, message: F.when(kind & F.coalesce(~rule, F.lit(True)), message)
    return F.coalesce(
        F.when(m.isNotNull() & F.json_object_keys(m).isNull(), F.lit(MSG_BAD_META)),
        missing_field(m, EFFECT_REQUIRED),
        F.when(~got_trigger.eqNullSafe(t), fmt(MSG_TRIGGER, expected=t, got=F.coalesce(got_trigger, F.lit("None")))),
        unless(css_class.startswith(EFFECT_CLASS_PREFIX), fmt(MSG_PREFIX, css_class=shown)),
        unless(c.contains(css_class), fmt(MSG_CLASS_NOT_IN_CSS, css_class=shown)),
        unless(c.contains(CSS_REDUCED_MOTION), F.lit(MSG_REDUCED_MOTION)),
        where(onscroll, is_true, F.lit(MSG_SCROLL_JS)),
        where(onscroll, (shared_type == "STRING") & shared_val.eqNullSafe(F.lit(SCROLL_HELPER_ID)), F.lit(MSG_SCROLL_SHARED)),
        where(onscroll, c.contains(CSS_IN_VIEW), F.lit(MSG_SCROLL_IN_VIEW)),
        where(onscroll, c.contains(CSS_SCROLL_TARGET), F.lit(MSG_SCROLL_TARGET)),
        where(~onscroll, is_false, fmt(MSG_NO_JS, trigger=t)),
        where(~onscroll, shared_type == "VOID", fmt(MSG_NO_SHARED, trigger=t)),
        where(t == "onload", c.contains(CSS_KEYFRAMES), F.lit(MSG_KEYFRAMES)),
        where(t == "hover", c.contains(CSS_HOVER), F.lit(MSG_HOVER)),
    )


def strictly_reviewed(meta: str) -> Column:
    """``reviewed is True`` — JSON true only; "true", 1 and null do not pass."""
    return F.coalesce((json_type(meta, "$.reviewed") == "BOOLEAN") & (F.get_json_object(F.col(meta), "$.reviewed") == "true"), F.lit(False))


def files_missing(html, css) -> Column:
    """Meta present but html or css absent."""
    return _c(html).isNull() | _c(css).isNull()


def hex_color(x) -> Column:
    """B17."""
    return F.coalesce(_c(x).rlike(HEX_COLOR), F.lit(False))

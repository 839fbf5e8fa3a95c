"""Template rendering as Column expressions.

Business data is two map columns: ``scalars MAP<STRING,STRING>`` and
``blocks MAP<STRING, ARRAY<MAP<STRING,STRING>>>``. Replacement is literal
(``replace``), never a regex replacement, so ``$1`` or ``\\1`` in values survive.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tessera.functions import contracts as K
from tessera.functions.fmt import fmt
from tessera.functions.text import WS

# Default business data used when a request carries none.
DEFAULT_FIELDS = {
    "business_name": "Riverside Bakery",
    "shop_name": "Riverside Bakery",
    "tagline": "Fresh bread, baked every morning",
    "shop_tagline": "Fresh bread, baked every morning",
    "about_text": "A small family bakery serving the neighborhood since 2015.",
    "maker_name": "Sarah Miller",
    "maker_story": "Baking has been my passion for 15 years.",
    "phone_number": "555-0100",
    "contact_email": "hello@riversidebakery.com",
    "address": "88 River Street",
    "hours_text": "Tue-Sun 7am-4pm",
    "primary_color": "#8b5a2b",
    "accent_color": "#d2a679",
    "map_embed_url": "https://maps.example.com/embed",
    "instagram_handle": "@riversidebakery",
}
DEFAULT_COLOR = "#8b5a2b"
PLEASE_FILL = "Please fill: {field}"
DEFAULT_ITEM_FIELDS = {
    "item_name": "Sourdough Loaf",
    "product_name": "Sourdough Loaf",
    "item_description": "Naturally leavened",
    "product_description": "Naturally leavened",
    "item_price": "$7",
    "price": "$7",
}
# The earlier default data, where it differs, and its sample items by block (others: one item, all fields unknown).
DEFAULT_FIELDS_V1 = {
    **DEFAULT_FIELDS,
    "maker_story": "Baking has been my passion for 15 years. I started Riverside Bakery to share my love of sourdough with the community.",
    "twitter_handle": "@riversidebakery",
    "facebook_handle": "riversidebakery",
    "business_type": "bakery",
    "year_founded": "2015",
}
DEFAULT_ITEMS_V1 = {
    "menu_items": [
        {"item_name": "Sourdough Loaf", "product_name": "Sourdough Loaf", "item_description": "Naturally leavened, 24hr ferment",
         "product_description": "Naturally leavened, 24hr ferment", "item_price": "$7", "price": "$7"},
        {"item_name": "Cinnamon Roll", "product_name": "Cinnamon Roll", "item_description": "Fresh baked, glazed",
         "product_description": "Fresh baked, glazed", "item_price": "$4", "price": "$4"},
    ],
    "team_members": [{"name": "Sarah Miller", "role": "Head Baker"}, {"name": "James Chen", "role": "Pastry Chef"}],
}
DEFAULT_ITEMS_V1["products"] = DEFAULT_ITEMS_V1["menu_items"]


# Business-data problem formats and their separator.
MSG_MISSING_SCALAR = "Missing: {field}"
MSG_BAD_COLOR = "Bad color: {field}"
MSG_MISSING_BLOCK = "Missing/empty repeating block: {block}"
PROBLEM_SEPARATOR = "; "
COLOR_FIELD_MARK = "color"


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def _join_problems(parts: list[Column]) -> Column:
    flat = F.flatten(F.array(*parts))
    return F.when(F.size(flat) > 0, F.array_join(flat, PROBLEM_SEPARATOR))


def business_data_problems(scalar_fields, block_names, scalars, blocks) -> Column:
    """Every problem, joined by '; ' (null when none): missing scalar; a field
    whose name contains 'color' with a non-hex value; missing or empty block."""
    sc, bl = _c(scalars), _c(blocks)
    scalar_p = F.filter(
        F.transform(
            _c(scalar_fields),
            lambda f: F.when(~F.map_contains_key(sc, f), fmt(MSG_MISSING_SCALAR, field=f)).when(
                F.lower(f).contains(COLOR_FIELD_MARK) & ~K.hex_color(sc[f]), fmt(MSG_BAD_COLOR, field=f)
            ),
        ),
        lambda x: x.isNotNull(),
    )
    block_p = F.filter(
        F.transform(
            _c(block_names),
            lambda b: F.when(
                ~F.map_contains_key(bl, b) | (F.coalesce(F.size(bl[b]), F.lit(0)) <= 0),
                fmt(MSG_MISSING_BLOCK, block=b),
            ),
        ),
        lambda x: x.isNotNull(),
    )
    return _join_problems([scalar_p, block_p])


def patch_scalars(text, scalar_fields, scalars) -> Column:
    """Replace ``{{f}}`` for each declared field present, sequentially in
    declared order (a value containing a later ``{{g}}`` is itself replaced)."""
    sc = _c(scalars)
    return F.aggregate(
        _c(scalar_fields),
        _c(text),
        lambda acc, f: F.when(F.map_contains_key(sc, f), F.replace(acc, F.concat(F.lit("{{"), f, F.lit("}}")), sc[f])).otherwise(acc),
    )


def block_pattern(name: Column) -> Column:
    return F.concat(
        F.lit(f"(?s)<!--{WS}*REPEAT:"), name, F.lit(f"{WS}*-->(.*?)<!--{WS}*END:"), name, F.lit(f"{WS}*-->")
    )


def expand_block(html, name, items, fields) -> Column:
    """The first REPEAT..END span of ``name`` (non-greedy, dot-all) becomes its
    body once per item, filling only the fields each item has; no span -> unchanged."""
    h = _c(html)
    pat = block_pattern(_c(name))
    # the pattern depends on the block name, so call the SQL function directly
    whole = F.call_function("regexp_extract", h, pat, F.lit(0))
    body = F.call_function("regexp_extract", h, pat, F.lit(1))
    fl = _c(fields)

    def fill(item):
        return F.aggregate(
            fl,
            body,
            lambda acc, f: F.when(F.map_contains_key(item, f), F.replace(acc, F.concat(F.lit("{{"), f, F.lit("}}")), item[f])).otherwise(acc),
        )

    expanded = F.array_join(F.transform(F.coalesce(_c(items), F.array().cast("array<map<string,string>>")), fill), "")
    pos = F.instr(h, whole)
    return F.when(
        whole != "",
        F.concat(h.substr(F.lit(1), pos - 1), expanded, h.substr(pos + F.length(whole), F.lit(2147483647))),
    ).otherwise(h)


def default_scalars(scalar_fields) -> Column:
    """Known field -> constant; name containing 'color' -> default hex; else 'Please fill: f'."""
    known = F.create_map(*[x for k, v in DEFAULT_FIELDS.items() for x in (F.lit(k), F.lit(v))])
    fl = _c(scalar_fields)
    vals = F.transform(
        fl,
        lambda f: F.coalesce(known[f], F.when(F.lower(f).contains(COLOR_FIELD_MARK), F.lit(DEFAULT_COLOR)), fmt(PLEASE_FILL, field=f)),
    )
    return F.map_from_arrays(fl, vals)


def default_item(fields) -> Column:
    """One sample item for a block."""
    known = F.create_map(*[x for k, v in DEFAULT_ITEM_FIELDS.items() for x in (F.lit(k), F.lit(v))])
    fl = _c(fields)
    return F.map_from_arrays(fl, F.transform(fl, lambda f: F.coalesce(known[f], fmt(PLEASE_FILL, field=f))))


def default_blocks(repeating) -> Column:
    """Every declared block with one sample item."""
    rep = _c(repeating)
    fields = lambda b: F.coalesce(b["fields"], F.array().cast("array<string>"))
    return F.transform_values(rep, lambda _, b: F.array(default_item(F.array_distinct(fields(b)))))


def _known_v1(fields: Column, known: dict[str, str]) -> Column:
    names = F.create_map(*[x for k, v in known.items() for x in (F.lit(k), F.lit(v))]) if known else F.create_map().cast("map<string,string>")
    unknown = lambda f: F.concat(F.lit("{{ "), f, F.lit(" }}"))
    return F.map_from_arrays(fields, F.transform(fields, lambda f: F.coalesce(F.try_element_at(names, f), unknown(f))))


def default_scalars_v1(scalar_fields) -> Column:
    """B20, earlier form: known field -> constant, any other -> ``{{ f }}``, which no later patch of ``{{f}}`` meets."""
    return _known_v1(_c(scalar_fields), DEFAULT_FIELDS_V1)


def default_items_v1(block, fields) -> Column:
    """B20, earlier form: two sample items for menus, products and teams, else one whose fields are all ``{{ f }}``."""
    b, fl = _c(block), _c(fields)
    items = None
    for name, samples in DEFAULT_ITEMS_V1.items():
        rows = F.array(*[_known_v1(fl, sample) for sample in samples])
        items = F.when(b == name, rows) if items is None else items.when(b == name, rows)
    return items.otherwise(F.array(_known_v1(fl, {})))


def map_text(m) -> Column:
    """Deterministic text of a string map: ``k=v`` sorted by key, joined by ';'."""
    mm = _c(m)
    return F.array_join(F.transform(F.array_sort(F.map_keys(mm)), lambda k: F.concat(k, F.lit("="), mm[k])), ";")

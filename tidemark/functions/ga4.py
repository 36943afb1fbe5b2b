"""Expressions over the item text of raw events: ``[{item_id=…, item_params=[{key=…, value={…}}]}, …]``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import col, pin

# One item of the usual depth, item > parameter > value; possessive, so it never backtracks.
ITEM_PATTERN = r"\{(?:[^{}]++|\{(?:[^{}]++|\{[^{}]*+\})*+\})*+\}"

# Fixed values of the event format: a text value ends before a key that starts like one of these.
KEY_STARTS = (
    "item_", "price_", "quantity", "coupon", "affiliation", "location", "promotion", "creative", "item_params",
)
VALUE_TYPES = ("double_value", "float_value", "int_value", "string_value")
NULL_TOKENS = ("(not set)", "null", "")
BACKFILL_NULL_TOKENS = (*NULL_TOKENS, "None")

TEXT_FIELDS = ("item_id", "item_name", "item_list_id", "item_list_name")
NUMBER_FIELDS = ("price_in_usd", "price", "quantity", "item_revenue_in_usd", "item_revenue")

_NEXT_KEY = r"(?s)(?<=.)\s*(?:" + "|".join(KEY_STARTS) + ").*$"


def _after(name: str, value: str) -> str:
    """Pattern for ``name=value`` with nothing of a longer name before it; starts with plain text."""
    return f"{name}=(?<![A-Za-z0-9_]{name}=){value}"


def _split_by_depth(items: Column) -> Column:
    """Texts between an outermost brace and the one that closes it, at any depth of nesting."""
    tokens = F.regexp_extract_all(items, F.lit(r"[{}]|[^{}]+"), F.lit(0))
    nothing = F.struct(F.lit(0).alias("depth"), F.lit("").alias("text"), F.array().cast("array<string>").alias("done"))

    def read(state, token):
        step = F.when(token == "{", 1).when((token == "}") & (state["depth"] > 0), -1).otherwise(0)
        depth = state["depth"] + step
        text = F.when((state["depth"] > 0) | (depth > 0), F.concat(state["text"], token)).otherwise("")
        closed = (depth == 0) & (state["depth"] > 0)
        return F.struct(
            depth.alias("depth"),
            F.when(closed, "").otherwise(text).alias("text"),
            F.when(closed, F.concat(state["done"], F.array(text))).otherwise(state["done"]).alias("done"),
        )

    return F.aggregate(tokens, nothing, read, lambda state: state["done"])


def split_items(items) -> Column:
    """Item texts of the array text; empty for NULL and ``[]``.

    Where the usual pattern leaves braces over, items are nested deeper, and are cut by counting depth.
    """
    text = col(items)
    usual = F.regexp_extract_all(text, F.lit(ITEM_PATTERN), F.lit(0))
    deeper = F.regexp_replace(text, ITEM_PATTERN, "").rlike("[{}]")
    return F.coalesce(F.when(deeper, _split_by_depth(text)).otherwise(usual), F.array().cast("array<string>"))


def _known(value: Column, null_tokens=NULL_TOKENS) -> Column:
    text = F.trim(value)
    return F.when(~text.isin(*null_tokens), text)


def _raw_text(item, name: str) -> Column:
    return F.regexp_extract(col(item), _after(name, "([^,}]+)"), 1)


def _cut_text(raw, null_tokens=NULL_TOKENS) -> Column:
    """A raw text value up to the next key it may have run into."""
    return _known(F.regexp_replace(col(raw), _NEXT_KEY, ""), null_tokens)


def text_field(item, name: str, null_tokens=NULL_TOKENS) -> Column:
    return _cut_text(_raw_text(item, name), null_tokens)


def extract_field(item, name: str) -> Column:
    """A field for the backfill, where ``None`` is a null token too."""
    return text_field(item, name, BACKFILL_NULL_TOKENS)


def item_field(item, name: str) -> Column:
    """The same of an item of either form: item text or a JSON object."""
    listed = col(item).rlike(r'^\s*\{\s*"')
    value = _known(F.get_json_object(col(item), f"$.{name}"), BACKFILL_NULL_TOKENS)
    return F.when(listed, value).otherwise(extract_field(item, name))


def _raw_number(item, name: str) -> Column:
    """Digits and dots after ``name=``; a sign is not part of the format."""
    return F.regexp_extract(col(item), _after(name, "([0-9.]+)"), 1)


def param_body(item, key: str) -> Column:
    """The text between the braces of a parameter's value."""
    return F.regexp_extract(col(item), rf"key={key},\s*value=\{{([^}}]*)", 1)


def _typed_value(body, kind: str) -> Column:
    # A thousands group such as $1,200.50 belongs to the value.
    value = r"(-?\$?\d{1,3}(?:,\d{3})+(?:\.\d+)?|[^,}]+)"
    text = col(body)
    return F.when(text.contains(f"{kind}="), F.regexp_extract(text, f"{kind}={value}", 1))


def plain_number(text) -> Column:
    """Number text without currency sign and thousands commas; NULL when it is no number."""
    clean = F.trim(F.regexp_replace(col(text), r"[$,]", ""))
    return F.when(clean.rlike(r"^-?[0-9.]+$"), clean)


def parse_items(df: DataFrame, item: str, params: dict) -> DataFrame:
    """Adds ``item``, a struct of all fields of the item text as texts."""
    names = list(params.values())
    df = pin(
        df,
        "raw",
        F.struct(
            *[_raw_text(item, f).alias(f) for f in TEXT_FIELDS],
            *[_raw_number(item, f).alias(f) for f in NUMBER_FIELDS],
            *[param_body(item, key).alias(name) for key, name in params.items()],
        ),
    )
    typed = [_typed_value(f"raw.{n}", k).alias(f"{n}_{k}") for n in names for k in VALUE_TYPES]
    df = pin(df, "typed", F.struct(*typed))
    # The first of the double, float, int and string values that is set.
    values = {n: F.coalesce(*[_known(F.col(f"typed.{n}_{k}")) for k in VALUE_TYPES]) for n in names}
    as_text = ("discounts", "is_in_stock")
    return pin(
        df,
        "item",
        F.struct(
            *[_cut_text(f"raw.{f}").alias(f) for f in TEXT_FIELDS],
            *[_known(F.col(f"raw.{f}")).alias(f) for f in NUMBER_FIELDS],
            *[(v if n in as_text else plain_number(v)).alias(n) for n, v in values.items()],
        ),
    ).drop("raw", "typed")


def split_discounts(codes, pattern: str) -> Column:
    """Struct of ``campaigns`` (pipe-joined, NULL if none) and ``experiment_variant`` (last match)."""
    text = F.when(col(codes) != "", col(codes))
    parts = F.split(text, r"\|")
    variants = F.filter(parts, lambda c: c.contains(pattern))
    campaigns = F.filter(parts, lambda c: ~c.contains(pattern))
    return F.struct(
        F.when(F.size(campaigns) > 0, F.array_join(campaigns, "|")).alias("campaigns"),
        F.try_element_at(variants, F.lit(-1)).alias("experiment_variant"),
    )


def json_text(text: Column) -> Column:
    """A string as JSON literal content, ASCII only, with lower-case ``\\uxxxx`` escapes."""
    wrapped = F.to_json(F.struct(text.alias("v")), {"writeNonAsciiCharacterAsCodePoint": "true"})
    body = F.substring(wrapped, F.lit(7), F.length(wrapped) - 8)
    # Lower the hex digits of real escapes only: pairs of backslashes are text and step aside. The mark is a control
    # character, which the JSON text has only as an escape.
    parts = F.split(F.replace(body, F.lit("\\\\"), F.lit("\x01")), r"\\u(?=[0-9A-F]{4})")
    lowered = F.transform(
        parts,
        lambda p, i: F.when(i == 0, p).otherwise(
            F.concat(F.lower(F.substring(p, 1, 4)), F.substring(p, F.lit(5), F.length(p)))
        ),
    )
    escaped = F.replace(F.array_join(lowered, "\\u"), F.lit("\x7f"), F.lit("\\u007f"))
    escaped = F.replace(escaped, F.lit("\x01"), F.lit("\\\\"))
    return F.when(text.rlike(r'^[ !#-\[\]-~]*$'), text).otherwise(escaped)


def event_id(micros, user, name, product) -> Column:
    """SHA-256 of the sorted-key JSON of event name, product, time in ns and user; NULL if that time fits no bigint."""

    def part(value, default):
        return json_text(F.coalesce(col(value).cast("string"), F.lit(default)))

    body = F.concat(
        F.lit('{"evt": "'), part(name, "None"),
        F.lit('", "pid": "'), part(product, ""),
        F.lit('", "ts": "'), F.try_multiply(col(micros), F.lit(1000)).cast("string"),
        F.lit('", "uid": "'), part(user, "None"),
        F.lit('"}'),
    )
    return F.sha2(body, 256)

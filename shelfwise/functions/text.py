"""Column expressions for titles, tokens, paths and slugs (all JVM-side)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Catch-all slugs, empty-token marker, confidence tiers, template placeholders.
CATCH_ALL_SLUGS = ("other", "miscellaneous")
EMPTY_TOKEN = "__empty__"
FRACTION_MARK = "{FRAC}"
NUMBER_MARK = "{NUM}"

# Unicode white space plus the ASCII separators 1C-1F.
WS = r"[\x1c-\x1f\p{IsWhite_Space}]"


def strip(s: Column) -> Column:
    """Trim Unicode white space at both ends."""
    return F.regexp_replace(s, rf"^{WS}+|{WS}+$", "")


def squeeze(s: Column) -> Column:
    """Collapse runs of white space to one blank and trim."""
    return F.trim(F.regexp_replace(s, rf"{WS}+", " "))


def normalize_title(s: Column) -> Column:
    return squeeze(F.lower(F.coalesce(s, F.lit(""))))


def first_token(norm: Column) -> Column:
    return F.coalesce(F.nullif(F.regexp_extract(norm, "[a-z0-9]+", 0), F.lit("")), F.lit(EMPTY_TOKEN))


def length_band(norm: Column) -> Column:
    return F.floor(F.length(norm) / 8).cast("long")


def letter_tokens(s: Column) -> Column:
    """ASCII letter runs in order, casing kept."""
    return F.regexp_extract_all(F.coalesce(s, F.lit("")), F.lit("[A-Za-z]+"), F.lit(0))


def lower_tokens(s: Column) -> Column:
    """ASCII letter runs in order, lower-cased after splitting."""
    return F.transform(letter_tokens(s), F.lower)


def token_set(s: Column) -> Column:
    return F.array_distinct(lower_tokens(s))


def keyword_set(s: Column, min_len: int = 4) -> Column:
    return F.array_distinct(F.filter(lower_tokens(s), lambda w: F.length(w) >= min_len))


def taxonomy_tokens(s: Column) -> Column:
    """Runs of Unicode letters of a slug or label, lower-cased, underscores split."""
    flat = F.lower(F.replace(F.coalesce(s, F.lit("")), F.lit("_"), F.lit(" ")))
    return F.regexp_extract_all(flat, F.lit(r"\p{L}+"), F.lit(0))


def combined_text(title: Column, subtitle: Column) -> Column:
    return strip(F.concat(F.coalesce(title, F.lit("")), F.lit(" "), F.coalesce(subtitle, F.lit(""))))


#: Fixed value: longest attribute value that counts as one.
LONGEST_VALUE = 120


def title_template(title: Column) -> Column:
    """Replace fractions, decimals, bare decimals and integers by placeholders."""
    t = F.coalesce(title, F.lit(""))
    t = F.regexp_replace(t, rf"(?U)\b\d+{WS}*/{WS}*\d+\b", FRACTION_MARK)
    t = F.regexp_replace(t, r"(?U)\b\d+\.\d+\b", NUMBER_MARK)
    t = F.regexp_replace(t, r"(?U)(?<![.\d])\.\d+\b", NUMBER_MARK)
    t = F.regexp_replace(t, r"(?U)\b\d+\b", NUMBER_MARK)
    return squeeze(t)


def normalize_value(raw: Column, hint: Column, longest: int = LONGEST_VALUE) -> Column:
    """Clean a captured value by its hint; null when nothing plausible is left."""
    v = strip(raw)
    inches = strip(F.regexp_replace(v, r'(?iU)"|(?<!\w)in\.?(?!\w)|inches?', ""))
    feet = strip(F.regexp_replace(v, r"(?iU)['`]|(?<!\w)ft\.?(?!\w)|feet?", ""))
    out = (
        F.when(hint == "measurement_inches", inches)
        .when(hint == "measurement_feet", feet)
        .when(hint == "text_lower", strip(F.lower(v)))
        .otherwise(v)
    )
    return F.when(plausible(out, longest), out)


def plausible(v: Column, longest: int = LONGEST_VALUE) -> Column:
    """A value of at least one and at most ``longest`` characters."""
    return F.coalesce(F.length(v).between(1, longest), F.lit(False))


def common_prefix(a: Column, b: Column) -> Column:
    """Longest common prefix by code point; of a set it equals that of its min and max."""
    chars_a = F.regexp_extract_all(a, F.lit("(?s)."), F.lit(0))
    chars_b = F.regexp_extract_all(b, F.lit("(?s)."), F.lit(0))
    same = F.zip_with(chars_a, chars_b, lambda x, y: x.eqNullSafe(y))
    cut = F.array_position(same, False)
    return F.when(cut == 0, a).otherwise(F.substring(a, F.lit(1), (cut - 1).cast("int")))


def pair_low(a: Column, b: Column) -> Column:
    return F.least(F.lower(a), F.lower(b))


def pair_high(a: Column, b: Column) -> Column:
    return F.greatest(F.lower(a), F.lower(b))


def path_segments(path: Column) -> Column:
    return F.split(F.regexp_replace(path, "^/+|/+$", ""), "/")


def leaf_slug(path: Column) -> Column:
    return F.element_at(path_segments(path), -1)


def master_slug(path: Column) -> Column:
    return F.get(F.split(path, "/"), F.lit(0))


def parent_path(path: Column) -> Column:
    """First two segments, null for a one-segment path."""
    parts = F.split(path, "/")
    return F.when(F.size(parts) >= 2, F.concat_ws("/", F.slice(parts, 1, 2)))


def ancestors(path: Column) -> Column:
    """Proper ancestor paths, shortest first."""
    parts = F.split(path, "/")
    n = F.size(parts)
    return F.when(n < 2, F.array().cast("array<string>")).otherwise(
        F.transform(F.sequence(F.lit(1), F.greatest(n - 1, F.lit(1))), lambda k: F.concat_ws("/", F.slice(parts, F.lit(1), k)))
    )


def is_strict_prefix(shorter: Column, longer: Column) -> Column:
    return F.startswith(longer, F.concat(shorter, F.lit("/")))


def slugify(name: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(F.lower(strip(name)), "[^a-z0-9]+", "_"), "^_+|_+$", "")


def is_catch_all(slug: Column) -> Column:
    return F.coalesce(slug.isin(*CATCH_ALL_SLUGS), F.lit(False))


def rule_confidence(n_a: Column, n_b: Column) -> Column:
    """1.0 both words unique to one parent, 0.85 one of them, 0.7 none, null without parents."""
    return (
        F.when((n_a == 1) & (n_b == 1), F.lit(1.0))
        .when((n_a == 1) | (n_b == 1), F.lit(0.85))
        .when((n_a > 0) & (n_b > 0), F.lit(0.7))
    )


# Decision sources and their precedence (highest wins).
SOURCE_GROUP = "manual_similar_title_1_6"
SOURCE_PAIR = "manual_bigram_1_3"
SOURCE_MODEL = "llm_1_4"
SOURCE_RULE = "rule"


def source_tier(source: Column) -> Column:
    return (
        F.when(source == SOURCE_GROUP, 4).when(source == SOURCE_PAIR, 3).when(source == SOURCE_MODEL, 2).otherwise(1)
    )


def rule_method(path: Column) -> Column:
    return F.when(F.contains(path, F.lit("/")), "cascading_bigram").otherwise("t1_bigram")


def group_label(n: Column) -> Column:
    return F.format_string("g_%06d", n)


def run_label(ts: Column, env: Column) -> Column:
    """yyyyMMdd_HHmmss plus -prod / -dev when the environment is one of these."""
    e = F.lower(F.trim(F.coalesce(env, F.lit(""))))
    return F.concat(F.date_format(ts, "yyyyMMdd_HHmmss"), F.when(e.isin("prod", "dev"), F.concat(F.lit("-"), e)).otherwise(""))


def json_or_fenced(text: Column) -> Column:
    """Model text to VARIANT: plain JSON, else the first fenced block, else null."""
    fenced = F.regexp_extract(text, r"(?s)```(?:\s*(?i:json))?(.*?)(?:```|$)", 1)
    return F.coalesce(F.try_parse_json(strip(text)), F.try_parse_json(strip(fenced)))

"""Text expressions used while cleaning raw event records."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Texts that stand for "no value" and the default category.
NULL_TEXTS = ("", "nan", "<NA>")
UNCATEGORIZED = "Uncategorized"
UNKNOWN_ZONE = "UNKNOWN"
TRUE_TEXTS = ("true", "1", "yes", "y")
# White space of any script, cheaper for the regex engine than its Unicode mode.
WHITE_SPACE = r"[\s\x1c-\x1f\u0085\u00a0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]+"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def clean_text(c: Column | str) -> Column:
    """Trim, squeeze inner whitespace to one space, turn null-like texts into null."""
    text = F.trim(F.regexp_replace(_col(c), WHITE_SPACE, " "))
    for nothing in NULL_TEXTS:
        text = F.nullif(text, F.lit(nothing))
    return text


def upper_key(c: Column | str) -> Column:
    """Upper-cased, trimmed join key."""
    return F.upper(F.trim(_col(c)))


def title_case(c: Column | str) -> Column:
    """Capitalise every run of letters, so ``no/assault`` becomes ``No/Assault``.

    ``initcap`` alone only starts words at spaces; the split into runs is done
    only for texts where a letter follows some other symbol.
    """
    runs = F.regexp_extract_all(_col(c), F.lit(r"(\p{L}+|\P{L}+)"), F.lit(1))
    inner_start = _col(c).rlike(r"[^\p{L}\s]\p{L}")
    return F.when(inner_start, F.array_join(F.transform(runs, F.initcap), "")).otherwise(F.initcap(_col(c)))


def category_text(*candidates: Column | str) -> Column:
    """First present candidate with hyphens spaced and white space squeezed."""
    text = F.regexp_replace(F.coalesce(*[_col(c) for c in candidates]), r"\s*-\s*", " - ")
    return F.regexp_replace(text, r"\s+", " ")


def category_title(text: Column | str) -> Column:
    """Title case of a category text; the default category when there is none."""
    return F.coalesce(F.nullif(title_case(text), F.lit("")), F.lit(UNCATEGORIZED))


def normalize_category(*candidates: Column | str) -> Column:
    """Normalized category of the first present candidate as one expression."""
    return category_title(category_text(*candidates))


def to_number(c: Column | str) -> Column:
    """Double from text with thousands commas; null when it is no number."""
    number = F.regexp_replace(F.trim(_col(c)), ",", "").try_cast("double")
    return nan_to_null(number)


def nan_to_null(c: Column | str) -> Column:
    """Null for not-a-number; ``nullif`` evaluates its argument once."""
    return F.nullif(_col(c), F.lit(float("nan")))


def to_bool(c: Column | str) -> Column:
    """True for the texts true, 1, yes and y in any case, else false."""
    return F.coalesce(F.lower(_col(c).cast("string")).isin(*TRUE_TEXTS), F.lit(False))


def quality_flag(event_time: Column, zone: Column, category: Column) -> Column:
    """Semicolon-joined list of missing parts, or ``ok``.

    ``zone`` must be the zone *before* its default is filled in, else a missing
    zone could never be seen.
    """
    reasons = F.concat_ws(
        ";",
        F.when(event_time.isNull(), "missing_datetime"),
        F.when(zone.isNull(), "missing_zone"),
        F.when(category == UNCATEGORIZED, "missing_category"),
    )
    return F.coalesce(F.nullif(reasons, F.lit("")), F.lit("ok"))


def completeness(*columns: Column | str) -> Column:
    """How many of the given columns hold a value."""
    return reduce(lambda a, b: a + b, [_col(c).isNotNull().cast("int") for c in columns])


def fingerprint(*columns: Column | str) -> Column:
    """64-bit hash over the columns in order; null counts as its own value."""
    return F.xxhash64(*[F.coalesce(_col(c).cast("string"), F.lit("<NA>")) for c in columns])


def sha_key(*columns: Column | str) -> Column:
    """SHA-256 fallback key over the columns joined with ``-``."""
    return F.sha2(F.concat_ws("-", *[F.coalesce(_col(c).cast("string"), F.lit("")) for c in columns]), 256)


def uri_host(c: Column | str) -> Column:
    """Host of a URI without credentials, port or path; ``unknown-host`` if there is none."""
    host = F.lower(F.try_parse_url(_col(c), F.lit("HOST")))
    host = F.regexp_replace(F.regexp_replace(host, r"^.*@", ""), r":\d+$", "")
    return F.coalesce(F.nullif(host, F.lit("")), F.lit("unknown-host"))


def human_size(c: Column | str) -> Column:
    """Bytes as ``1.50 KB``: the largest of B, KB, MB, GB, TB that keeps the figure below 1024."""
    size = _col(c).cast("double")
    label = F.concat(F.format_number(size / 1024.0**4, 2), F.lit(" TB"))
    for power, unit in ((3, "GB"), (2, "MB"), (1, "KB"), (0, "B")):
        text = F.concat(F.format_number(size / 1024.0**power, 2), F.lit(f" {unit}"))
        label = F.when(size < 1024.0 ** (power + 1), text).otherwise(label)
    return label


def compact_count(c: Column | str) -> Column:
    """Count as ``1.25M``, ``12.3K`` or ``1,234`` style text; ``Unavailable`` for null."""
    n = _col(c).cast("double")
    return (
        F.when(n.isNull() | F.isnan(n), "Unavailable")
        .when(F.abs(n) >= 1e6, F.concat(F.format_string("%.2f", n / 1e6), F.lit("M")))
        .when(F.abs(n) >= 1e3, F.concat(F.format_string("%.1f", n / 1e3), F.lit("K")))
        .otherwise(F.format_number(n.cast("long"), 0))
    )


def integer_text(c: Column | str) -> Column:
    n = _col(c).cast("double")
    return F.when(n.isNull() | F.isnan(n), "Unavailable").otherwise(F.format_number(n.cast("long"), 0))


def percent_text(c: Column | str, digits: int = 2) -> Column:
    p = _col(c).cast("double")
    return F.when(p.isNull() | F.isnan(p), "Unavailable").otherwise(
        F.format_string(f"%.{digits}f%%", p * 100)
    )


def report_value(text: Column | str, label: str) -> Column:
    """Value behind ``- label: `value` `` in one line of a text report, else null."""
    pattern = r"^- \Q" + label + r"\E:\s+`?([^`\n]+)`?"
    return F.nullif(F.trim(F.regexp_extract(_col(text), pattern, 1)), F.lit(""))


def report_int(text: Column | str, label: str) -> Column:
    return F.regexp_replace(report_value(text, label), ",", "").try_cast("long")


def report_percent(text: Column | str, label: str) -> Column:
    return F.regexp_replace(report_value(text, label), "%", "").try_cast("double") / 100

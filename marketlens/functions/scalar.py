"""Column expressions: parsing, cleaning, binning, rounding. No Python code runs per row."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def blank_to_null(c: Column | str) -> Column:
    """Empty or whitespace-only text becomes null."""
    c = _col(c)
    return F.when(F.trim(c) != "", c)


def number(c: Column | str) -> Column:
    """Lenient cast to double: what cannot be read, and NaN, becomes null."""
    return F.nanvl(_col(c).try_cast("double"), F.lit(None).cast("double"))


def integer(c: Column | str) -> Column:
    """Lenient cast of an identifier to long."""
    return _col(c).try_cast("bigint")


def round_half_even(c: Column | str, digits: int) -> Column:
    """Scale, round half to even, scale back: the floating-point rounding of numpy."""
    scale = F.lit(10.0**digits)
    return F.rint(_col(c) * scale) / scale


def clean_price(c: Column | str) -> Column:
    """`$1,234.50` -> 1234.5; zero, negative and unreadable prices become null."""
    value = number(F.trim(F.translate(_col(c).cast("string"), "$€£,", "")))
    return F.when(value > 0, value)


def parse_money(c: Column | str) -> Column:
    """Strip `$` and `,` only, and keep zero and negative amounts (used by the checks)."""
    return number(F.trim(F.translate(_col(c).cast("string"), "$,", "")))


def parse_percent(c: Column | str) -> Column:
    """`97%` -> 97.0, otherwise null."""
    return number(F.trim(F.replace(_col(c).cast("string"), F.lit("%"), F.lit(""))))


def flag_from_tf(c: Column | str) -> Column:
    """`t` / `f` -> boolean, otherwise null."""
    c = _col(c)
    return F.when(c == "t", F.lit(True)).when(c == "f", F.lit(False))


def _truth(c: Column | str) -> Column:
    """Any of true/1/1.0/t and false/0/0.0/f, in text or typed form, as a boolean; otherwise null."""
    text = F.lower(_col(c).cast("string"))
    return F.when(text.isin("true", "1", "1.0", "t"), F.lit(True)).when(
        text.isin("false", "0", "0.0", "f"), F.lit(False)
    )


def flag_or_false(c: Column | str) -> Column:
    return F.coalesce(_truth(c), F.lit(False))


def flag_to_tf(c: Column | str) -> Column:
    return F.when(_truth(c), F.lit("t")).when(~_truth(c), F.lit("f"))


def flag_to_int(c: Column | str) -> Column:
    return flag_or_false(c).cast("int")


def parse_date(c: Column | str) -> Column:
    """Lenient date; unreadable text becomes null."""
    return F.to_date(_col(c).try_cast("timestamp"))


def map_category(
    c: Column | str, mapping: dict[str, str], default: str = "Other", keep_null: bool = False
) -> Column:
    """Look a value up in a literal map; unknown values get `default`."""
    c = _col(c)
    table = F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv])
    # A null key never matches, so the lookup alone sends null to the default.
    mapped = F.coalesce(F.try_element_at(table, F.coalesce(F.trim(c) if keep_null else c, F.lit(""))), F.lit(default))
    return F.when(c.isNotNull(), mapped) if keep_null else mapped


def title_case(c: Column | str) -> Column:
    """Trim, then capitalise every run of letters (also after `-` and other signs)."""
    runs = F.regexp_extract_all(F.lower(F.trim(_col(c))), F.lit(r"(\p{L}+|\P{L}+)"), F.lit(1))
    return F.array_join(F.transform(runs, F.initcap), "")


def title_case_or_null(c: Column | str) -> Column:
    """Title case, with the literal text `nan` read as missing."""
    return F.nullif(title_case(c), F.lit("Nan"))


def clip(c: Column | str, lower: float | None = None, upper: float | None = None) -> Column:
    """Clamp to a range; null stays null (least/greatest alone would skip it)."""
    value = _col(c)
    out = value
    if lower is not None:
        out = F.greatest(out, F.lit(lower))
    if upper is not None:
        out = F.least(out, F.lit(upper))
    return F.when(value.isNotNull(), out)


def right_closed_bin(c: Column | str, edges: Sequence[float], labels: Sequence[str]) -> Column:
    """Label of the interval (edge[i], edge[i+1]] that holds the value; outside -> null."""
    value = _col(c)
    out = F.when(value <= edges[0], F.lit(None).cast("string"))
    for label, upper in zip(labels, edges[1:]):
        out = out.when(value.isNotNull() if upper == float("inf") else value <= upper, F.lit(label))
    return out


def calendar_parts(c: Column | str) -> dict[str, Column]:
    """Month, names, weekend flag, quarter and year of a date."""
    d = _col(c)
    return {
        "month": F.month(d),
        "month_name": F.date_format(d, "MMMM"),
        "day_of_week": F.date_format(d, "EEEE"),
        "is_weekend": F.weekday(d) >= 5,
        "quarter": F.quarter(d),
        "year": F.year(d),
    }


def in_box(lat: Column | str, lon: Column | str, box: tuple[float, float, float, float]) -> Column:
    """Both coordinates inside the inclusive box; false when one is missing."""
    inside = _col(lat).between(box[0], box[1]) & _col(lon).between(box[2], box[3])
    return F.coalesce(inside, F.lit(False))


def ratio(numerator: Column | str, denominator: Column | str) -> Column:
    """Division that gives null for a zero or missing denominator."""
    return F.try_divide(_col(numerator).cast("double"), _col(denominator).cast("double"))


def effect_label(
    c: Column | str, bounds: Sequence[float], labels: Sequence[str] = ("Negligible", "Small", "Medium", "Large")
) -> Column:
    """Name of the effect-size band (left-closed); missing effects stay null."""
    value = _col(c)
    out = F.when(value.isNull(), F.lit(None).cast("string"))
    for label, upper in zip(labels, bounds):
        out = out.when(value < upper, F.lit(label))
    return out.otherwise(F.lit(labels[-1]))

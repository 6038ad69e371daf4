"""Numbers and ranks as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_NUMBER = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"
TIE = 1e-12


def missing(value: Column) -> Column:
    """True for null, blank and NaN cells."""
    return value.isNull() | (F.trim(value.cast("string")) == "") | (F.lower(F.trim(value.cast("string"))) == "nan")


def to_number(text: Column) -> Column:
    """A double, or null: thousands commas dropped, no suffixes, nothing infinite."""
    plain = F.regexp_replace(F.trim(text.cast("string")), ",", "")
    value = F.when(plain.rlike(_NUMBER), plain.try_cast("double"))
    return F.when(F.abs(value) < float("inf"), value)


def rank_number(display: Column) -> Column:
    """The first run of digits: "=42" 42, "601-800" 601, "1,201+" 1201, no digits null."""
    run = F.regexp_extract(display, r"\d[\d,]*", 0)
    return F.when(run != "", F.regexp_replace(run, ",", "").try_cast("long"))


def rank_display(display: Column) -> Column:
    """Integers with thousands separators, other text trimmed, a dash for missing."""
    number = to_number(display)
    whole = number.isNotNull() & (number == F.floor(number))
    return F.when(missing(display), F.lit("—")).when(whole, F.format_number(number.cast("long"), 0)).otherwise(F.trim(display))


#: What publishers write for "no rank", in lower case.
UNRANKED = ("", "-", "n/a", "na", "not ranked")


def is_ranked(display: Column) -> Column:
    return F.coalesce(~F.lower(F.trim(display)).isin(*UNRANKED), F.lit(False))


def row_rank(*displays: Column, tied: Column | None = None) -> tuple[Column, Column]:
    """(rank, display) of the first column with a rank; a dash without any.  ``tied`` marks the first one's rank as shared."""
    shown = [rank_display(d) for d in displays]
    if tied is not None:
        shown[0] = F.when(F.lower(F.trim(tied.cast("string"))).isin("1", "true", "yes"), F.concat(F.lit("="), shown[0])).otherwise(shown[0])
    row = F.coalesce(*[F.when(rank_number(d).isNotNull(), F.struct(rank_number(d).alias("rank"), s.alias("display"))) for d, s in zip(displays, shown)])
    return row["rank"], F.coalesce(row["display"], F.lit("—"))


def compact(value: Column) -> Column:
    """1.2K, 3.4M, 5B: one decimal at most, none if it is zero; halves go up."""
    def scaled(size: float, unit: str) -> Column:
        tenths = F.floor(value * 10 / F.lit(size) + 0.5) / 10
        number = F.regexp_replace(F.format_string("%.1f", tenths), r"\.0$", "")
        return F.concat(number, F.lit(unit))

    return F.when(F.abs(value) >= 999.95e6, scaled(1e9, "B")).when(F.abs(value) >= 999.95e3, scaled(1e6, "M")).when(F.abs(value) >= 999.95, scaled(1e3, "K")).otherwise(scaled(1.0, ""))


def on_scale(value: Column, least: Column, most: Column, log: bool = False) -> Column:
    """A place from 0 to 1 on a linear or logarithmic axis; 0.5 on an axis without length."""
    x, a, b = (F.log10(v) for v in (value, least, most)) if log else (value, least, most)
    return F.when(b == a, F.lit(0.5)).otherwise((x - a) / (b - a))


def half_even(value: Column, digits: int) -> Column:
    """Rounded half to even; what lies within ``TIE`` of a half in scaled space counts as a half."""
    scaled = value * F.lit(10.0**digits)
    floor = F.floor(scaled).cast("double")
    rest = scaled - floor
    even = F.when(F.pmod(floor, F.lit(2.0)) == 0, floor).otherwise(floor + 1)
    rounded = F.when(F.abs(rest - 0.5) <= TIE, even).otherwise(F.floor(scaled + 0.5).cast("double"))
    return rounded / F.lit(10.0**digits)


def percentile_score(rank: Column, field: Column) -> Column:
    """100 for the first, 0 for the last of a field of at least two; never below 0."""
    return F.greatest(F.lit(0.0), F.lit(100.0) * (F.lit(1.0) - (rank - 1) / (F.greatest(field, F.lit(2)) - 1)))


def percent_change(new: Column, old: Column) -> Column:
    """Signed change in percent; null on a zero base."""
    return F.when(old != 0, (new - old) / old * 100.0)


def growth_rate(last: Column, first: Column, years: int) -> Column:
    """Compound yearly growth in percent; null on a base that is not positive."""
    return F.when((first > 0) & (last >= 0), (F.pow(last / first, F.lit(1.0 / years)) - 1.0) * 100.0)


def share_number(text: Column) -> Column:
    """Shares as publishers print them: commas, a Unicode minus, percent signs; n/a is null."""
    return to_number(F.translate(text, "−%", "-"))


def rank_band(rank: Column, cuts: tuple[int, ...] = (10, 50, 100)) -> Column:
    """top-10, top-50, ..., else ranked, or missing."""
    band = F.when(rank.isNull(), "missing")
    for cut in cuts:
        band = band.when(rank <= cut, f"top-{cut}")
    return band.otherwise("ranked")


def retry_delay(attempt: Column, base: float, cap: float = 30.0) -> Column:
    """Exponential delay in seconds, capped."""
    return F.least(F.lit(cap), F.lit(base) * F.pow(F.lit(2.0), attempt))


def academic_year(text: Column) -> Column:
    """The first year of "2024-25" or "2024/2025" if the second follows it, else null."""
    first = F.regexp_extract(text, r"^\s*(\d{4})\s*[-/–]\s*(\d{2}|\d{4})\s*$", 1)
    second = F.regexp_extract(text, r"^\s*(\d{4})\s*[-/–]\s*(\d{2}|\d{4})\s*$", 2)
    start = F.when(first != "", first.try_cast("int"))
    end = F.when(F.length(second) == 2, F.pmod(start + 1, F.lit(100)) == second.try_cast("int")).when(F.length(second) == 4, start + 1 == second.try_cast("int"))
    return F.when(end, start)

"""Texts: HTML escaping and popups, percent encoding, dates of reviews, number formats."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .dynamic import blank_to_null, strip


def html_escape(s: Column) -> Column:
    for a, b in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#x27;")):
        s = F.replace(s, F.lit(a), F.lit(b))
    return s


def fixed(c: Column, digits: int, grouped: bool = False) -> Column:
    """A number with that many digits, thousands apart where asked; halves go up."""
    return F.format_string(f"%{',' if grouped else ''}.{digits}f", c)


def percent_encode(s: Column) -> Column:
    """Everything but letters, digits and ``-._~``."""
    s = F.url_encode(s)
    for a, b in (("+", "%20"), ("*", "%2A"), ("%7E", "~")):
        s = F.replace(s, F.lit(a), F.lit(b))
    return s


#: The styles of popups.
_OPEN = "<div style='font-family:Arial,sans-serif; font-size:12px; line-height:1.35;'><table>"
_CLOSE = "</table></div>"
_HEAD = "text-align:left; padding:2px 8px 2px 0;"


def popup_row(label: str, value: Column, nowrap: bool = False) -> Column:
    """A row, or null where there is no value."""
    style = _HEAD + (" white-space:nowrap;" if nowrap else "")
    return F.concat(F.lit(f"<tr><th style='{style}'>{label}</th><td style='padding:2px 0;'>"), html_escape(value), F.lit("</td></tr>"))


def popup(rows: list[Column]) -> Column:
    """Rows without a value are left out."""
    return F.concat(F.lit(_OPEN), F.array_join(F.filter(F.array(*rows), lambda r: r.isNotNull()), ""), F.lit(_CLOSE))


def coordinates(lat: Column, lng: Column) -> Column:
    return F.concat(fixed(lat, 6), F.lit(", "), fixed(lng, 6))


def place_popup(lat: Column, lng: Column, fields: list[tuple[str, Column]], reviews: list[Column]) -> Column:
    rows = [popup_row(k, blank_to_null(v.cast("string")), True) for k, v in fields]
    rows.append(popup_row("Coordinates", coordinates(lat, lng), True))
    rows += [popup_row(f"Review {i}", blank_to_null(r), True) for i, r in enumerate(reviews, 1)]
    return popup(rows)


def circle_popup(lat: Column, lng: Column, radius: Column, collected: Column, density: Column | None = None) -> Column:
    status = F.when(collected, "Collected").otherwise("Not collected")
    rows = [popup_row("Status", status), popup_row("Radius (m)", fixed(radius.cast("double"), 2 if density is None else 0))]
    if density is not None:
        rows.append(popup_row("Population density", F.concat(F.coalesce(fixed(density, 2, True), F.lit("N/A")), F.lit(" people/km^2"))))
    return popup([*rows, popup_row("Center", coordinates(lat, lng))])


#: ISO forms with a date; a bare year or month isn't one.
_ISO = r"^\d{4}-\d{2}-\d{2}([T ]\d{2}(:\d{2}(:\d{2}([.,]\d{1,9})?)?)?)?([+-]\d{2}:?\d{2}|Z)?$"


def instant(s: Column) -> Column:
    """Point in time of a timestamp text; one without an offset counts as UTC; null if it isn't one."""
    t = F.regexp_replace(strip(s), r"Z$", "+00:00")
    return F.when(strip(s).rlike(_ISO), F.try_to_timestamp(F.replace(t, F.lit(" "), F.lit("T"))))


def earliest_date(times: Column) -> Column:
    """Date of the earliest instant, as its own text has it; without any, the least raw text's date part; else empty."""
    own = F.transform(F.filter(times, lambda t: strip(t) != ""), lambda t: strip(t))
    pairs = F.filter(F.transform(own, lambda t: F.struct(instant(t).alias("at"), F.substring(t, 1, 10).alias("date"))), lambda p: p["at"].isNotNull())
    raw = F.array_min(own)
    rest = F.when(raw.contains("T"), F.substring_index(raw, "T", 1)).otherwise(F.substring(raw, 1, 10))
    return F.coalesce(F.array_min(pairs)["date"], rest, F.lit(""))

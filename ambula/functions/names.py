"""Names, labels and texts of the lookup surface. All are Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def normalize(name: Column) -> Column:
    """Lower case; runs of other than letters and digits become one space; no space at the ends."""
    return F.trim(F.regexp_replace(F.lower(name), r"[^\p{IsAlphabetic}\p{N}]+", " "))


def similar(a: Column, b: Column) -> Column:
    """Of normalised names: both non-empty, and one is the other or its beginning."""
    return F.coalesce((a != "") & (b != "") & (F.startswith(a, b) | F.startswith(b, a)), F.lit(False))


def site_label(name: Column, type_name: Column, pid: Column, k: Column) -> Column:
    base = F.coalesce(name, F.concat(type_name, F.lit(" #"), pid.cast("string")))
    return F.when(k > 1, F.concat(base, F.lit(" (×"), k.cast("string"), F.lit(")"))).otherwise(base)


def walk_text(seconds: Column) -> Column:
    return F.when(seconds.isNull(), "walking time unknown").when(seconds < 60, "under a minute's walk").otherwise(F.concat(F.round(seconds / 60).cast("int").cast("string"), F.lit(" min walk")))


def escape_html(text: Column) -> Column:
    for char, name in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#39;")):
        text = F.replace(text, F.lit(char), F.lit(name))
    return text


def fill_url(template: Column, **values: Column) -> Column:
    for key, value in values.items():
        template = F.replace(template, F.lit("{" + key + "}"), value)
    return template


def base_name(url: Column) -> Column:
    return F.substring_index(url, "/", -1)

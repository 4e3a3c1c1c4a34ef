"""Colours of catchments and buildings, as Column expressions and in plain Python for kernels."""

from __future__ import annotations

import colorsys

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values: the colours of the six classes
PALETTE = ("#4e79a7", "#f28e2b", "#59a14f", "#e15759", "#b07aa1", "#edc948")
#: Walking time from which a building is darkest, in seconds.
DARKEST_S = 1800


def class_colour(colour_class: Column) -> Column:
    return F.element_at(F.array(*map(F.lit, PALETTE)), (F.pmod(colour_class, F.lit(len(PALETTE))) + 1).cast("int"))


def hsl(hex_colour: Column) -> tuple[Column, Column, Column]:
    """Hue, saturation, lightness, each 0 to 1, of #rrggbb."""
    r, g, b = [F.conv(F.substring(hex_colour, 2 + 2 * i, 2), 16, 10).cast("int") / 255.0 for i in range(3)]
    high, low = F.greatest(r, g, b), F.least(r, g, b)
    span, light = high - low, (high + low) / 2
    safe = F.when(span == 0, 1.0).otherwise(span)
    hue = F.when(span == 0, 0.0).when(high == r, F.pmod((g - b) / safe, F.lit(6.0))).when(high == g, (b - r) / safe + 2).otherwise((r - g) / safe + 4)
    room = F.when(span == 0, 1.0).otherwise(1 - F.abs(2 * light - 1))
    return hue / 6, F.when(span == 0, 0.0).otherwise(span / room), light


def from_hsl(h: Column, s: Column, light: Column) -> Column:
    chroma = (1 - F.abs(2 * light - 1)) * s

    def channel(n: int) -> Column:
        k = F.pmod(n + h * 12, F.lit(12.0))
        part = F.greatest(F.lit(-1.0), F.least(k - 3, 9 - k, F.lit(1.0)))
        return F.lpad(F.lower(F.hex(F.round(255 * (light - chroma / 2 * part)).cast("int"))), 2, "0")

    return F.concat(F.lit("#"), channel(0), channel(8), channel(4))


def building_colour(colour: Column, seconds: Column) -> Column:
    """Darker and fuller the longer the walk; pale where the time is unknown."""
    h, s, light = hsl(colour)
    f = F.least(seconds, F.lit(DARKEST_S)) / float(DARKEST_S)
    known_s, known_l = s * (1 - 0.25 * f), F.greatest(F.lit(0.15), F.least(F.lit(0.85), light + 0.16 - 0.42 * f))
    return from_hsl(h, F.when(seconds.isNull(), s * 0.25).otherwise(known_s), F.when(seconds.isNull(), 0.60).otherwise(known_l))


def lightness(hex_colour: str) -> float:
    return colorsys.rgb_to_hls(*(int(hex_colour[i : i + 2], 16) / 255 for i in (1, 3, 5)))[1]

"""Breakpoint table of India's National Air Quality Index (CPCB).

Each pollutant has six concentration bands aligned with six index bands. The last band is
open: its index rises linearly from its floor to the top at twice the band's lower
concentration, then stays at the top (a project rule, not part of the published table).
"""

from __future__ import annotations

# ---------------------------------------------------------------------------------------
# Fixed values (published method; must not change).
# Index bands in order: (index_lo, index_hi, category).
BANDS: list[tuple[int, int, str]] = [
    (0, 50, "Good"),
    (51, 100, "Satisfactory"),
    (101, 200, "Moderate"),
    (201, 300, "Poor"),
    (301, 400, "Very Poor"),
    (401, 500, "Severe"),
]
# Concentration band (lo, hi) per pollutant, aligned with BANDS; hi None = open band.
# Units: ug/m3, except co in mg/m3.
BREAKPOINTS: dict[str, list[tuple[float, float | None]]] = {
    "pm10": [(0, 50), (51, 100), (101, 250), (251, 350), (351, 430), (430, None)],
    "pm2_5": [(0, 30), (31, 60), (61, 90), (91, 120), (121, 250), (250, None)],
    "no2": [(0, 40), (41, 80), (81, 180), (181, 280), (281, 400), (400, None)],
    "o3": [(0, 50), (51, 100), (101, 168), (169, 208), (209, 748), (748, None)],
    "co": [(0, 1.0), (1.1, 2.0), (2.1, 10), (10, 17), (17, 34), (34, None)],
    "so2": [(0, 40), (41, 80), (81, 380), (381, 800), (801, 1600), (1600, None)],
}
# Pollutants in tie-break order for the main pollutant, and how each is averaged.
POLLUTANT_ORDER: list[str] = ["pm2_5", "pm10", "no2", "so2", "o3", "co"]
DAILY_MEAN_POLLUTANTS: list[str] = ["pm2_5", "pm10", "no2", "so2"]
ROLLING_8H_POLLUTANTS: list[str] = ["o3", "co"]
PARTICULATES: tuple[str, ...] = ("pm2_5", "pm10")
MIN_HOURS_FOR_SUBINDEX = 16
MIN_POLLUTANTS_FOR_AQI = 3
MIN_HOURS_IN_8H_WINDOW = 6
INDEX_MAX = 500
# End of fixed values.
# ---------------------------------------------------------------------------------------


def open_band_top(c_lo: float) -> float:
    """Concentration at which the open band reaches the index top."""
    return 2 * c_lo


def interpolation_segments(pollutant: str) -> list[tuple[float | None, int, int, float, float]]:
    """(upper bound or None, i_lo, i_hi, c_lo, c_hi_for_slope) per band, in band order."""
    out = []
    for (i_lo, i_hi, _), (c_lo, c_hi) in zip(BANDS, BREAKPOINTS[pollutant], strict=True):
        out.append((c_hi, i_lo, i_hi, float(c_lo), float(c_hi if c_hi is not None else open_band_top(c_lo))))
    return out

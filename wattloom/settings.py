"""Thresholds and domain encodings shared by all operators."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

SLOTS_PER_DAY = 96
SLOT_MINUTES = 15
SLOTS_PER_HOUR = 4
HOURS_PER_DAY = 24


@dataclass(frozen=True)
class MeterSettings:
    """Every tunable of the engine. The defaults are fixed values of the domain."""

    # Calendar.
    epoch: dt.date = dt.date(2006, 1, 6)
    calendar_days: int = 3258

    # Voltage levels. Two nominal systems share one feed, so "low" is two bands.
    volt_out: float = 10.0
    volt_low_110: float = 88.0
    volt_floor_220: float = 132.0
    volt_low_220: float = 188.0
    volt_high: float = 236.0

    # Sanity bands and nominal voltages.
    band_low_all: float = 88.0
    band_low_single: float = 154.0
    band_high: float = 300.0
    nominal_220: float = 220.0
    nominal_110: float = 110.0

    # Data quality.
    missing_below: float = 0.1

    # Hour grouping and histograms.
    hour_groups: int = 6
    lloyd_rounds: int = 21
    elbow_rounds: int = 20
    min_points: int = 12
    power_bins: int = 10
    power_bins_weekend: int = 4
    volt_bins: int = 3

    # Meters of one simulated station.
    station_first_meter: int = 14
    station_meters: int = 1635


DEFAULTS = MeterSettings()

# How a flag of a long reading maps to a column of the phase-wide reading.
VOLT_PHASES = {1: "volt_a", 2: "volt_b", 3: "volt_c"}
CURRENT_PHASES = {1: "cur_a", 2: "cur_b", 3: "cur_c"}
FACTOR_PHASES = {0: "pfsum", 1: "pf_a", 2: "pf_b", 3: "pf_c"}
POWER_TYPES = {1: "psum", 2: "pa", 3: "pb", 4: "pc", 5: "qsum", 6: "qa", 7: "qb", 8: "qc"}

# Wide-curve column prefix, long value column and flag column per family.
CURVE_FAMILIES = {
    "volt": ("U", "phase_flag"),
    "power": ("P", "data_type"),
    "cur": ("I", "phase_flag"),
    "pf": ("C", "phase_flag"),
    "energy": ("R", "data_type"),
}

# Fixed values: (family code, flag) -> (measurement code, phase) of the star schema.
BASEREADING_CHANNELS = {
    "V": {1: ("V", "A"), 2: ("V", "B"), 3: ("V", "C")},
    "A": {1: ("A", "A"), 2: ("A", "B"), 3: ("A", "C")},
    "PF": {0: ("PF", "none"), 1: ("PF", "A"), 2: ("PF", "B"), 3: ("PF", "C")},
    "P": {
        1: ("P", "none"), 2: ("P", "A"), 3: ("P", "B"), 4: ("P", "C"),
        5: ("Q", "none"), 6: ("Q", "A"), 7: ("Q", "B"), 8: ("Q", "C"),
    },
    "E": {1: ("EP", "none"), 2: ("EQ", "none")},
}

# Value and flag column of the long reading behind each family code.
FAMILY_COLUMNS = {
    "V": ("volt", "phase_flag"),
    "A": ("cur", "phase_flag"),
    "PF": ("pf", "phase_flag"),
    "P": ("power", "data_type"),
    "E": ("energy", "data_type"),
}

# Day-curve output per measurement code: column prefix, flag column, flag value.
DAY_CURVES = {
    "P": ("P", "data_type", 1),
    "Q": ("P", "data_type", 5),
    "V": ("U", "phase_flag", 0),
    "A": ("I", "phase_flag", 0),
    "PF": ("C", "phase_flag", 0),
    "EP": ("R", "data_type", 1),
    "EQ": ("R", "data_type", 2),
}

# Labels.
SEASONS = ("Spring", "Summer", "Fall", "Winter")
DAYTYPES = ("Weekday", "Weekend", "Holiday")
LOAD_TYPES = ("Industrial", "Commercial", "Residential")

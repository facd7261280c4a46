"""Units of measure of CONVERT: a unit is a factor, and for temperatures a zero, of its dimension's base."""

from __future__ import annotations

# Names of units as spreadsheets have them, with their size in the base unit of the dimension.
SIZES = {
    "mass": {
        "g": 1.0, "sg": 14593.902937206365, "lbm": 453.59237, "u": 1.66053886e-24, "ozm": 28.349523125, "grain": 0.06479891, "cwt": 45359.237, "shweight": 45359.237,
        "uk_cwt": 50802.34544, "lcwt": 50802.34544, "hweight": 50802.34544, "stone": 6350.29318, "ton": 907184.74, "uk_ton": 1016046.9088, "LTON": 1016046.9088, "brton": 1016046.9088,
    },
    "length": {
        "m": 1.0, "mi": 1609.344, "Nmi": 1852.0, "in": 0.0254, "ft": 0.3048, "yd": 0.9144, "ang": 1e-10, "ell": 1.143, "ly": 9.4607304725808e15,
        "parsec": 3.0856775814913673e16, "pc": 3.0856775814913673e16, "Picapt": 0.0254 / 72, "Pica": 0.0254 / 72, "pica": 0.0254 / 6, "survey_mi": 6336000 / 3937,
    },
    "time": {"yr": 31557600.0, "day": 86400.0, "d": 86400.0, "hr": 3600.0, "mn": 60.0, "min": 60.0, "sec": 1.0, "s": 1.0},
    "pressure": {"Pa": 1.0, "p": 1.0, "atm": 101325.0, "at": 101325.0, "mmHg": 133.322, "psi": 6894.757293168361, "Torr": 101325 / 760},
    "force": {"N": 1.0, "dyn": 1e-5, "dy": 1e-5, "lbf": 4.4482216152605, "pond": 9.80665e-3},
    "energy": {
        "J": 1.0, "e": 1e-7, "c": 4.184, "cal": 4.1868, "eV": 1.602176487e-19, "ev": 1.602176487e-19, "HPh": 2684519.537696173, "hh": 2684519.537696173,
        "Wh": 3600.0, "wh": 3600.0, "flb": 1.3558179483314004, "BTU": 1055.05585262, "btu": 1055.05585262,
    },
    "power": {"HP": 745.6998715822702, "h": 745.6998715822702, "PS": 735.49875, "W": 1.0, "w": 1.0},
    "magnetism": {"T": 1.0, "ga": 1e-4},
    "temperature": {"C": 1.0, "cel": 1.0, "F": 5 / 9, "fah": 5 / 9, "K": 1.0, "kel": 1.0, "Rank": 5 / 9, "Reau": 1.25},
    "volume": {
        "tsp": 4.92892159375e-6, "tspm": 5e-6, "tbs": 1.478676478125e-5, "oz": 2.95735295625e-5, "cup": 2.365882365e-4, "pt": 4.73176473e-4, "us_pt": 4.73176473e-4,
        "uk_pt": 5.6826125e-4, "qt": 9.46352946e-4, "uk_qt": 1.1365225e-3, "gal": 3.785411784e-3, "uk_gal": 4.54609e-3, "l": 1e-3, "L": 1e-3, "lt": 1e-3,
        "barrel": 0.158987294928, "bushel": 0.03523907016688, "GRT": 2.8316846592, "regton": 2.8316846592, "MTON": 1.13267386368,
    },
    "area": {"uk_acre": 4046.8564224, "us_acre": 62726400000 / 15499969, "ar": 100.0, "ha": 10000.0, "Morgen": 2500.0},
    "information": {"bit": 1.0, "byte": 8.0},
    "speed": {"admkn": 0.5147733333333333, "kn": 1852 / 3600, "m/h": 1 / 3600, "m/hr": 1 / 3600, "m/s": 1.0, "m/sec": 1.0, "mph": 0.44704},
}
ZEROS = {"C": 273.15, "cel": 273.15, "F": 459.67 * 5 / 9, "fah": 459.67 * 5 / 9, "Reau": 273.15}
PREFIXES = {
    "Y": 24, "Z": 21, "E": 18, "P": 15, "T": 12, "G": 9, "M": 6, "k": 3, "h": 2, "da": 1, "e": 1, "d": -1, "c": -2, "m": -3, "u": -6, "n": -9, "p": -12, "f": -15, "a": -18, "z": -21, "y": -24,
}
BINARY = {"ki": 10, "Mi": 20, "Gi": 30, "Ti": 40, "Pi": 50, "Ei": 60, "Zi": 70, "Yi": 80}
#: Units that take metric prefixes, and lengths whose squares and cubes are units.
METRIC = (
    "g", "u", "m", "ang", "ly", "parsec", "pc", "sec", "s", "Pa", "p", "atm", "at", "mmHg", "Torr", "N", "dyn", "dy", "pond", "J", "e", "c", "cal", "eV", "ev", "Wh", "wh", "W", "w", "T", "ga", "K", "kel",
    "l", "L", "lt", "ar", "bit", "byte", "m/h", "m/hr", "m/s", "m/sec",
)
POWERS = ("m", "mi", "Nmi", "in", "ft", "yd", "ang", "ly", "Picapt", "Pica")
# End of fixed values.


def unit_table() -> dict[str, tuple[str, float, float]]:
    """(dimension, size, zero) of every unit by its name; a name without prefix comes before one with it."""
    out = {name: (dim, size, ZEROS.get(name, 0.0)) for dim, units in SIZES.items() for name, size in units.items()}
    for name in POWERS:
        for power, dim in ((2, "area"), (3, "volume")):
            for mark in ("", "^"):
                out[f"{name}{mark}{power}"] = (dim, SIZES["length"][name] ** power, 0.0)
    plain = dict(out)
    for prefix, exponent in PREFIXES.items():
        for name in METRIC:
            dim, size, zero = plain[name]
            out.setdefault(prefix + name, (dim, size * 10.0**exponent, zero))
        for name in ("m", "ang"):  # a prefix belongs to the length whose power is taken
            for power, dim in ((2, "area"), (3, "volume")):
                for mark in ("", "^"):
                    out.setdefault(f"{prefix}{name}{mark}{power}", (dim, (SIZES["length"][name] * 10.0**exponent) ** power, 0.0))
    for prefix, bits in BINARY.items():
        for name, size in SIZES["information"].items():
            out[prefix + name] = ("information", size * 2.0**bits, 0.0)
    return out


UNITS = unit_table()

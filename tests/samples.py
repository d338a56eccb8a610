"""Made-up readings: machine loads by site, and rainfall by basin, all from short rules."""

from pointlake.model import FieldType, MeasurementSchema

START_NS = 1_900_000_000 * 10**9
STEP_NS = 250_000

# Readings of each site of each machine.
READINGS = {"fan": {"east": 4, "north": 11, "south": 1}, "mill": {"east": 7, "west": 2}, "pump": {"north": 3}}


def load_of(machine: str, site: str, i: int) -> float:
    """Quarters between 0 and 25, with repeats."""
    return ((len(machine) * 31 + len(site) * 17 + ord(site[0]) + i * (i + 5) * 7) % 101) / 4


def readings(machine: str | None = None) -> list[tuple[str, str, float, int]]:
    """``(machine, site, load, time_ns)``; readings of all sites fall on the same times."""
    return [
        (name, site, load_of(name, site, i), START_NS + i * STEP_NS)
        for name, sites in READINGS.items()
        if machine in (None, name)
        for site, n in sites.items()
        for i in range(n)
    ]


def sample_lines() -> list[str]:
    return [f"{name},site={site} load={load:g} {t}" for name, site, load, t in readings()]


FAN = MeasurementSchema("fan", {"load": FieldType.FLOAT}, ("site",))

RAIN_START_S = 1_950_000_000
RAIN = MeasurementSchema(
    "rain", {"depth": FieldType.FLOAT, "kind of day": FieldType.STRING}, ("basin",), database="weather"
)
PROBES = MeasurementSchema("probes", {"reads": FieldType.INTEGER}, ("basin", "depth class"), database="weather")


def rain_points() -> list[dict]:
    """JSON points whose numbers and times are text."""
    points = [
        {
            "measurement": "rain",
            "tags": {"basin": basin},
            "fields": {"depth": f"{k * 5 / 8:.3f}", "kind of day": "dry" if k == 0 else "wet"},
            "timestamp": str(RAIN_START_S + 900 * k),
        }
        for basin in ("lower", "upper")
        for k in range(5)
    ]
    points += [
        {
            "measurement": "probes",
            "tags": {"basin": "upper", "depth class": depth},
            "fields": {"reads": str(3 * k + 1)},
            "timestamp": str(RAIN_START_S + 60 * k),
        }
        for k, depth in enumerate(("deep", "flat", "deep"))
    ]
    return points

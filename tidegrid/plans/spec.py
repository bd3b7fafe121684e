"""What a pipeline needs to know about a panel. Nothing here is domain specific."""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class PanelSpec:
    """Columns and options of one panel.

    ``limit`` caps interpolation (``None``: no cap), ``window`` is the number of
    input steps, ``season`` the calendar parts that key the seasonal means.
    ``longest`` bounds the rows of one series; it is measured if not given. ``dense``
    states that ``pos`` has no holes, as ``densify`` and ``with_position`` number it.
    """

    measures: tuple[str, ...]
    target: str
    series: str = "series"
    t: str = "t"
    pos: str = "pos"
    wind: str | None = None
    step_seconds: int = 3600
    cutoff: str = "2015-09-01"
    val_fraction: float = 0.15
    limit: int | None = 6
    window: int = 24
    season: tuple[str, ...] = ("month", "hour")
    longest: int | None = None
    dense: bool = False
    # raw-unit rolling features of the all-rows variants: {name: (column, kind, rows)}
    rolling: dict[str, tuple[str, str, int]] = field(default_factory=dict)

    @property
    def target_norm(self) -> str:
        return f"{self.target}_norm"

    @property
    def norms(self) -> list[str]:
        return [f"{c}_norm" for c in self.measures]

    @property
    def wind_features(self) -> list[str]:
        return ["wd_sin", "wd_cos"] if self.wind else []


# The air-quality panel, with the dot in its target's name taken out.
POLLUTANTS = ("pm25", "pm10", "so2", "no2", "co", "o3")
WEATHER = ("temp", "pres", "dewp", "rain", "wspm")

# Lag and trailing-window lengths of the 48-step feature set.
LAGS = (1, 2, 3, 6, 12, 24)
MEAN_ROWS = (3, 6, 12, 24)
STD_ROWS = (3, 6, 12)
MAX_ROWS = (6, 24)


def long_window_features(target_norm: str, stem: str) -> dict[str, tuple[str, str, int]]:
    """The 15 features of the normalised target: lags, trailing means, deviations, maxima."""
    return {
        **{f"{stem}_lag{n}": (target_norm, "lag", n) for n in LAGS},
        **{f"{stem}_rmean{n}": (target_norm, "mean", n) for n in MEAN_ROWS},
        **{f"{stem}_rstd{n}": (target_norm, "std", n) for n in STD_ROWS},
        **{f"{stem}_rmax{n}": (target_norm, "max", n) for n in MAX_ROWS},
    }


def raw_rolling_features(target: str, others: tuple[str, ...]) -> dict[str, tuple[str, str, int]]:
    """Raw-unit features: the target in detail, a six-step mean of each other column."""
    return {
        **{f"{target}_roll_mean_{n}": (target, "mean", n) for n in (3, 6, 12)},
        f"{target}_roll_std_6": (target, "std", 6),
        f"{target}_diff_1": (target, "diff", 1),
        **{f"{c}_roll_mean_6": (c, "mean", 6) for c in others},
    }


AIR_QUALITY = PanelSpec(
    measures=POLLUTANTS + WEATHER,
    target="pm25",
    series="station",
    wind="wd",
    rolling=raw_rolling_features("pm25", ("pm10", "temp", "wspm")),
)

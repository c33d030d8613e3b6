"""Settings of the planners and their checks."""

from __future__ import annotations

from dataclasses import dataclass, field


class ConfigError(ValueError):
    """A setting that can't be used; raised on the driver before any job."""


def number_list(text: str, kind=float) -> tuple:
    """Comma-separated numbers, sorted, each once."""
    try:
        out = tuple(sorted({kind(x) for x in text.split(",") if x.strip()}))
    except ValueError as e:
        raise ConfigError(f"not a list of numbers: {text!r}") from e
    if not out:
        raise ConfigError("an empty list")
    return out


#: Fixed value: the key of an example configuration.
PLACEHOLDER_KEY = "YOUR_API_KEY_HERE"


def usable_key(key: str | None, placeholder: str = PLACEHOLDER_KEY) -> str:
    """A service key that is neither missing nor the placeholder of an example."""
    if not key or not key.strip() or key.strip() == placeholder:
        raise ConfigError("no service key is set")
    return key.strip()


@dataclass(frozen=True)
class FixedConfig:
    """Cover with circles of 500 and 1000 metres.  mode: fast, fast-local or auto."""

    mode: str = "fast"
    coverage_step: float = 100.0
    tolerance_m2: float = 1.0
    rounds: int = 15
    additions: int = 2000
    exact_patches: int = 20

    def __post_init__(self) -> None:
        if self.mode not in ("fast", "fast-local", "auto"):
            raise ConfigError(f"mode {self.mode!r}")
        if min(self.coverage_step, self.rounds, self.additions) <= 0 or self.tolerance_m2 < 0:
            raise ConfigError("limits must be positive")


@dataclass(frozen=True)
class AdaptiveConfig:
    """Cover with radii that follow density.  ``phase_budget``: candidates of the second stage, instead of a wall clock."""

    min_radius: int = 500
    max_radius: int | None = None
    coverage_step: float = 100.0
    preserve_distance: float = 300.0
    scales: tuple[float, ...] = field(default=(0.86, 0.90, 0.94, 0.98, 1.02))
    band_steps: tuple[int, ...] = field(default=(75, 100, 125))
    phases: tuple[float, ...] = field(default=(0.0, 0.25, 0.5, 0.75))
    tolerance_m2: float = 1.0
    gap_patches: int = 1200
    exact_patches: int = 1500
    prune_passes: int = 3
    patch_factor: float = 1.35
    ring: int = 2
    regularity_weight: float = 4.0
    count_penalty: float = 1.0
    overlap_penalty: float = 0.6
    phase_budget: int = 225

    def __post_init__(self) -> None:
        if self.min_radius <= 0 or (self.max_radius is not None and self.max_radius <= self.min_radius):
            raise ConfigError("0 < min_radius < max_radius")
        if min(self.coverage_step, *self.scales, *self.band_steps) <= 0 or self.tolerance_m2 < 0 or self.prune_passes < 0:
            raise ConfigError("steps and scales must be positive")
        object.__setattr__(self, "phases", tuple(sorted({p % 1.0 for p in self.phases})))

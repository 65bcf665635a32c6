"""Settings, from defaults, a mapping or a YAML file."""

from __future__ import annotations

import copy
import logging
import os
from pathlib import Path
from types import SimpleNamespace
from typing import Any

log = logging.getLogger(__name__)

#: The settings of a YAML file that the engine uses, with their defaults. Names and defaults are fixed values.
DEFAULTS: dict[str, dict[str, Any]] = {
    "cleaning": {
        "track_gap_hours": 4.0,
        "min_track_points": 2,
        "bounds": {"lat_min": 54.0, "lat_max": 58.5, "lon_min": 7.0, "lon_max": 16.0},
        "max_velocity_knots": 50.0,
        "velocity_by_ship_type": {"cargo": 25.0, "tanker": 20.0, "passenger": 35.0, "fishing": 15.0, "default": 50.0},
    },
    "collision": {"distance_threshold_km": 50.0, "dbscan_eps_km": 5.0, "min_bounce_count": 3, "lookback_window": 10},
    "storage": {"raw_dir": "~/data/ais/raw", "clean_dir": "~/data/ais/clean", "state_dir": "~/data/ais/state"},
    "output": {"compression": "zstd", "compression_level": 3, "row_group_size": 100_000},
}
#: ``collision`` is nested in ``cleaning`` in the file. Fixed value.
NESTED = {"collision": "cleaning"}

#: Own settings beside those. ``split``: None for one series for an identifier that two vessels share, "per_cluster" for a series for each of them. ``numbering``: "numeric", a file goes on from a vessel's highest track number; "lexical", from the one that sorts last as text.
OWN = {"cleaning": {"split": None, "numbering": "numeric"}}


class Config:
    """A namespace a section: ``config.cleaning.track_gap_hours``, ``config.collision.dbscan_eps_km``."""

    def __init__(self, data: dict | None = None) -> None:
        """Sections of ``data`` over the defaults; keys that are not known are ignored."""
        data = data or {}
        for section, known in DEFAULTS.items():
            known = known | OWN.get(section, {})
            holder = (data.get(NESTED[section]) or {}) if section in NESTED else data
            given = holder.get(section) or {}
            setattr(self, section, SimpleNamespace(**copy.deepcopy(known | {k: v for k, v in given.items() if k in known})))

    @classmethod
    def cleaner(cls, *, collision: dict | None = None, **cleaning: Any) -> Config:
        """The defaults with these changes; names that are not known are an error."""
        for section, given in (("cleaning", cleaning), ("collision", collision or {})):
            if wrong := set(given) - set(DEFAULTS[section]) - set(OWN.get(section, {})):
                raise TypeError(f"no such settings: {sorted(wrong)}")
        return cls({"cleaning": cleaning | {"collision": collision or {}}})

    @classmethod
    def load(cls, path: str) -> Config:
        """From a YAML file; a missing one gives the defaults and a warning."""
        import yaml

        if not Path(path).exists():
            log.warning("no settings at %s, defaults are used", path)
            return cls()
        return cls(yaml.safe_load(Path(path).read_text(encoding="utf-8")))

    def path(self, name: str) -> str:
        """A storage folder: a URI as it stands, or a local path with ``~`` and variables filled in."""
        given = os.path.expandvars(getattr(self.storage, name))
        return given if "://" in given else os.path.expanduser(given)

"""Layered parameters: defaults, project, video. Later layers win, maps merge, scalars and lists replace."""

from __future__ import annotations

import hashlib
import json
from dataclasses import asdict, dataclass, field, fields
from pathlib import Path
from typing import Any

# Names of sections and keys, their defaults, and what they must satisfy (to the end of ``_RULES``).


@dataclass(frozen=True)
class Sample:
    fps: float = 1.0
    quality: int = 3
    skip_ranges: tuple = ()
    max_frames: int = 2000


@dataclass(frozen=True)
class Rectify:
    canonical_size: tuple = (1600, 1000)
    smooth_window: int = 9
    min_quad_confidence: float = 0.55
    aspect_bounds: tuple = (1.3, 2.2)
    max_jump_fraction: float = 0.10
    reanchor_after_frames: int = 3
    manual_corners: tuple = ()


@dataclass(frozen=True)
class Clean:
    align: bool = True
    clahe: dict = field(default_factory=lambda: {"on": True, "clip": 2.0, "tiles": 8})
    deglare: dict = field(default_factory=lambda: {"on": True, "amount": 0.3})
    moire: dict = field(default_factory=lambda: {"on": False, "sigma": 0.6})


@dataclass(frozen=True)
class Dedupe:
    band_rect: tuple = (0, 0, 1600, 190)
    hash_distance: float = 12
    full_frame_weight: float = 0.3
    min_gap_frames: int = 2


@dataclass(frozen=True)
class Ocr:
    regions: tuple = ("title", "tabs")
    min_word_confidence: float = 0.4
    psm: int = 7


@dataclass(frozen=True)
class Identify:
    montage_rows: int = 20
    prompt_version: int = 2
    max_output_tokens: int = 48000
    corroborate: bool = True
    full_frames: bool = False


@dataclass(frozen=True)
class Agreement:
    accept_threshold: float = 0.75
    weights: dict = field(default_factory=lambda: {"ocr_agreement": 0.3, "cross_frame": 0.3, "legibility": 0.2, "framing": 0.2})


@dataclass(frozen=True)
class Classify:
    fuzzy_threshold: float = 0.82
    near_miss_margin: float = 0.15
    aliases: dict = field(default_factory=dict)
    modules_in_scope: tuple = ()
    partial_labels: tuple = ()


SECTIONS: dict[str, type] = {"sample": Sample, "rectify": Rectify, "clean": Clean, "dedupe": Dedupe, "ocr": Ocr, "identify": Identify, "confidence": Agreement, "classify": Classify}
_RULES = (
    ("sample", "fps must be above 0", lambda c: c.fps > 0), ("sample", "quality must be 1 to 31", lambda c: 1 <= c.quality <= 31),
    ("sample", "max_frames must be above 0", lambda c: c.max_frames > 0), ("rectify", "smooth_window must be odd", lambda c: c.smooth_window % 2 == 1),
    ("rectify", "aspect_bounds must rise", lambda c: c.aspect_bounds[0] < c.aspect_bounds[1]), ("rectify", "max_jump_fraction must be in (0, 1]", lambda c: 0 < c.max_jump_fraction <= 1),
    ("rectify", "reanchor_after_frames must be above 1", lambda c: c.reanchor_after_frames > 1), ("dedupe", "band_rect must have a size", lambda c: c.band_rect[2] > 0 and c.band_rect[3] > 0),
    ("dedupe", "full_frame_weight must be in [0, 1]", lambda c: 0 <= c.full_frame_weight <= 1), ("confidence", "weights must have a sum", lambda c: sum(c.weights.values()) > 0),
    ("classify", "fuzzy_threshold must be in [0, 1]", lambda c: 0 <= c.fuzzy_threshold <= 1),
)


def merge(base: dict, over: dict) -> dict:
    return {k: merge(base[k], over[k]) if isinstance(base.get(k), dict) and isinstance(over.get(k), dict) else over.get(k, base.get(k)) for k in {**base, **over}}


def load_layer(path: str | Path) -> dict:
    """A YAML map; an empty file is an empty map."""
    import yaml

    said = yaml.safe_load(Path(path).read_text())
    if said is None:
        return {}
    if not isinstance(said, dict):
        raise ValueError(f"{path}: must be a map")
    return said


PROFILE_KEYS = ("name", "inventory", "root", "export_command", "publish_to")  # fixed value: what of a project is no section


@dataclass(frozen=True)
class Profile:
    """A project: where its inventory is and how it is made; relative paths are those of the folder it was read from."""

    name: str
    inventory: Path
    root: Path | None = None
    export_command: str | None = None
    publish_to: Path | None = None


def split_project(layer: dict) -> tuple[dict, dict]:
    """(profile, sections): the keys of a project layer that describe the project, and those that overlay the defaults."""
    return {k: v for k, v in layer.items() if k in PROFILE_KEYS}, {k: v for k, v in layer.items() if k not in PROFILE_KEYS}


def load_project(path: str | Path, base: str | Path | None = None) -> tuple[Profile, dict]:
    """The profile of a project and its sections; without ``inventory`` it is an error."""
    profile, sections = split_project(load_layer(path))
    if not profile.get("inventory"):
        raise ValueError(f"{path}: inventory is required")
    base = Path(base or Path(path).parent)
    place = lambda key: base / profile[key] if profile.get(key) else None
    return Profile(profile.get("name") or Path(path).stem, place("inventory"), place("root"), profile.get("export_command"), place("publish_to")), sections


def root_of(settings: dict[str, str | None], kind: str, base: str) -> str:
    """The folder of outputs or caches (``kind``: out, cache): the setting ``timeloom.<kind>.root``, or one under ``base``."""
    return settings.get(f"timeloom.{kind}.root") or f"{base.rstrip('/')}/{kind}"


def resolve(*layers: dict) -> dict[str, Any]:
    """Sections by name from layers, first to last; unknown sections and keys are errors."""
    merged: dict = {}
    for layer in layers:
        merged = merge(merged, layer)
    unknown = set(merged) - set(SECTIONS)
    if unknown:
        raise ValueError(f"unknown sections: {sorted(unknown)}")
    out = {}
    for name, kind in SECTIONS.items():
        values = merged.get(name) or {}
        bad = set(values) - {f.name for f in fields(kind)}
        if bad:
            raise ValueError(f"{name}: unknown keys {sorted(bad)}")
        out[name] = kind(**{k: tuple(v) if isinstance(v, list) else v for k, v in values.items()})
    for section, said, holds in _RULES:
        if not holds(out[section]):
            raise ValueError(f"{section}: {said}")
    return out


def digest(value: Any) -> str:
    """16 hexadecimal digits of the canonical JSON of a section, or of a whole configuration."""
    plain = {k: asdict(v) for k, v in value.items()} if isinstance(value, dict) else asdict(value)
    return hashlib.sha256(json.dumps(plain, sort_keys=True, separators=(",", ":")).encode()).hexdigest()[:16]

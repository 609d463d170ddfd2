"""Settings of a run (S01, M1), layered from files, environment and arguments."""

from __future__ import annotations

import json
import os
from dataclasses import dataclass, fields, replace
from pathlib import Path
from typing import Any

ENVIRONMENT_ROOT = "PARCELWRIGHT_STORAGE_ROOT"


@dataclass(frozen=True)
class Settings:
    # They must equal the ones that the published outputs were made with.
    periodo_geometria: str = "2026S2"
    zoom: int = 19
    supercell_tiles: int = 4
    block_supercells: int = 4
    block_overlap_supercells: int = 1
    boundary_buffer_m: float = 250
    max_retries: int = 5
    backoff_base_s: float = 2
    urban_min_area_m2: float = 1
    urban_max_area_m2: float = 50_000
    min_hole_area_m2: float = 50
    min_overlap_m2: float = 0.25
    fill_color: tuple[int, int, int] = (182, 221, 232)
    fill_tolerance: tuple[int, int, int] = (20, 22, 22)
    min_fill_alpha: int = 20
    max_candidate_alpha: int = 250
    max_color_distance: float = 70
    max_match_distance_m: float = 10
    large_component_hard_limit_polygons: int = 200_000
    storage_root: str | None = None

    @property
    def pixel_m(self) -> float:
        """Side of a pixel in projected metres."""
        from parcelwright.functions.scalars import HALF_WORLD

        return 2 * HALF_WORLD / 2**self.zoom / 256

    def pixels(self, square_metres: float) -> int:
        """The fewest pixels whose area is at least so many square metres."""
        side = self.pixel_m
        n = int(square_metres / side**2)
        return n if n * side**2 >= square_metres else n + 1


def _coerced(values: dict[str, Any]) -> dict[str, Any]:
    known = {f.name: f for f in fields(Settings)}
    return {k: tuple(v) if isinstance(v, list) else v for k, v in values.items() if k in known and v is not None}


def load_settings(path: str | Path | None = None, **overrides: Any) -> Settings:
    """Base file, then its ``.local`` neighbour, then the environment, then arguments that are not None."""
    settings = Settings()
    if path is not None:
        base = Path(path)
        for source in (base, local_path(base)):
            if source.exists():
                settings = replace(settings, **_coerced(json.loads(source.read_text(encoding="utf-8"))))
    if root := os.environ.get(ENVIRONMENT_ROOT):
        settings = replace(settings, storage_root=root)
    return replace(settings, **_coerced(overrides))


def local_path(path: str | Path) -> Path:
    """The file of local settings beside a settings file; it is read after it."""
    base = Path(path)
    return base.with_name(f"{base.stem}.local{base.suffix}")


def save_local(path: str | Path, **values: Any) -> Path:
    """Put values into the local settings beside ``path``, keeping the others that are there; returns that file.

    The new file is written beside the old one and takes its place at once.
    """
    destination = local_path(path)
    current = json.loads(destination.read_text(encoding="utf-8")) if destination.exists() else {}
    part = destination.with_name(destination.name + ".part")
    part.write_text(json.dumps(current | values, ensure_ascii=False, indent=2) + "\n", encoding="utf-8")
    os.replace(part, destination)
    return destination


def resolve_historic(path: str | Path, given: str | Path | None = None, folder: str | Path | None = None, pattern: str = "*.csv") -> Path | None:
    """The historic extract to use: the one given, else the one saved, else the newest by name in ``folder``, else none.

    One that is given is saved for the next time; if there is no such file, that is an error. A saved or found one that
    is gone counts as none.
    """
    local = local_path(path)
    saved = json.loads(local.read_text(encoding="utf-8")).get("reference_csv") if local.exists() else None
    newest = sorted(Path(folder).glob(pattern))[-1:] if folder is not None else []
    chosen = given or saved or (newest[0] if newest else None)
    if chosen is None or not Path(chosen).is_file():
        if given is not None:
            raise FileNotFoundError(str(given))
        return None
    if given is not None:
        save_local(path, reference_csv=str(Path(given).resolve()))
    return Path(chosen).resolve()

"""Settings of the curation pipeline, from defaults, a JSON file and ``HELIXFRAME_`` environment variables."""

from __future__ import annotations

import dataclasses
import json
import os
from dataclasses import dataclass, field


@dataclass
class Filtering:
    cutoff: str = "2021-09-30"
    max_resolution: float = 9.0
    min_residues: int = 4
    max_ca_distance: float = 10.0
    clash_distance: float = 1.7
    clash_share: float = 0.3


@dataclass
class Cropping:
    max_tokens: int = 384
    max_atoms: int = 4608
    interface_distance: float = 15.0
    seed: int = 42


@dataclass
class Alignments:
    max_rows: int = 16_384
    max_paired_rows: int = 8191
    max_templates: int = 4


@dataclass
class Config:
    filtering: Filtering = field(default_factory=Filtering)
    cropping: Cropping = field(default_factory=Cropping)
    alignments: Alignments = field(default_factory=Alignments)

    @classmethod
    def load(cls, path: str | None = None, environment: dict[str, str] | None = None, **overrides: dict) -> Config:
        """Later sources win: defaults, file, ``HELIXFRAME_SECTION__NAME`` variables, then keyword sections. Unknown names raise."""
        given: dict[str, dict] = {}
        if path:
            with open(path) as f:
                given = json.load(f)
        for k, v in (os.environ if environment is None else environment).items():
            if k.startswith("HELIXFRAME_") and "__" in k:
                section, name = k.removeprefix("HELIXFRAME_").lower().split("__", 1)
                try:
                    given.setdefault(section, {})[name] = json.loads(v)
                except json.JSONDecodeError:
                    given.setdefault(section, {})[name] = v
        for section, values in overrides.items():
            given.setdefault(section, {}).update(values)
        out = cls()
        for section, values in given.items():
            part = getattr(out, section)
            setattr(out, section, dataclasses.replace(part, **values))
        return out

    def to_json(self) -> str:
        return json.dumps(dataclasses.asdict(self), indent=2)

"""Settings of a run: defaults, a file of KEY=value lines or a JSON object, then PALAVER_* of the environment."""

from __future__ import annotations

import json
import os
from collections.abc import Mapping
from dataclasses import dataclass, fields
from pathlib import Path

PREFIX = "PALAVER_"


@dataclass(frozen=True)
class Settings:
    """Folders of the corpora and of the stages' tables, and the service that labels."""

    root: str = "data"
    meld: str = ""
    dailytalk: str = ""
    mustard: str = ""
    annomi: str = ""
    merged: str = "merged"
    service_form: str = ""
    service_url: str = ""
    service_model: str = ""
    service_key: str = ""
    seed: int = 200


def read_pairs(text: str) -> dict[str, str]:
    """KEY=value lines; blank ones and those that begin with # are passed over, quotes around a value are taken off."""
    if text.lstrip().startswith("{"):
        return {k: str(v) for k, v in json.loads(text).items()}
    out = {}
    for line in text.splitlines():
        line = line.strip().removeprefix("export ").strip()
        if line and not line.startswith("#"):
            key, sep, value = line.partition("=")
            if not sep:
                raise ValueError(f"no value in the setting {key!r}")
            out[key.strip()] = value.strip().strip("\"'")
    return out


def load(path: str | None = None, environ: Mapping[str, str] = os.environ) -> Settings:
    """Settings by file and environment; keys may be in any case, an unknown one in the file is an error."""
    names = {f.name: f for f in fields(Settings)}
    found = {k.lower(): v for k, v in read_pairs(Path(path).read_text()).items()} if path else {}
    if unknown := sorted(found.keys() - names.keys()):
        raise ValueError(f"unknown settings: {', '.join(unknown)}")
    found |= {k.removeprefix(PREFIX).lower(): v for k, v in environ.items() if k.startswith(PREFIX) and k.removeprefix(PREFIX).lower() in names}
    return Settings(**{k: int(v) if names[k].type == "int" else v for k, v in found.items()})

"""Settings from TOML files and the environment: what is given in code counts most, then variables, then the user's
file, then ``lodestrata.defaults.toml`` beside the package.

A variable is ``LODESTRATA_`` and the section and name with two underscores between, such as
``LODESTRATA_PATHS__SCAN_ROOT``; ``LODESTRATA_CONFIG`` names the user's file (else ``lodestrata.toml`` here).
"""

import dataclasses
import logging
import logging.handlers
import os
import sys
import tomllib
from dataclasses import dataclass, field
from pathlib import Path

PREFIX = "LODESTRATA_"


@dataclass
class Paths:
    scan_root: str | None = None
    store_root: str | None = None
    failures: str | None = None


@dataclass
class Runtime:
    discovery_workers: int = 64
    shuffle_partitions: int | None = None
    stale_hours: float = 24.0


@dataclass
class Logging:
    level: str = "INFO"
    log_file: str | None = None
    rotation_size_mb: int = 10
    rotation_backup_count: int = 5
    format: str = "%(asctime)s - %(name)s - %(levelname)s - %(message)s"


@dataclass
class Stores:
    name: str = "core"
    protected: list[str] = field(default_factory=lambda: ["core", "core_dev"])
    disposable: list[str] = field(default_factory=lambda: ["tmp_*", "fixture_*", "candidate_*", "archive_*"])


@dataclass
class Settings:
    paths: Paths = field(default_factory=Paths)
    runtime: Runtime = field(default_factory=Runtime)
    logging: Logging = field(default_factory=Logging)
    stores: Stores = field(default_factory=Stores)


def _typed(value: object, kind: str) -> object:
    """A value as the type of its field; text (of a variable) is converted."""
    if "list" in kind:
        return [x.strip() for x in value.split(",") if x.strip()] if isinstance(value, str) else [str(x) for x in value]
    if value is None or (value == "" and "None" in kind):
        return None
    for name, as_type in (("int", int), ("float", float)):
        if kind.startswith(name):
            return as_type(value)
    return str(value)


def _apply(settings: Settings, values: dict[str, dict]) -> None:
    """Takes over what is known of ``values``; the rest is ignored."""
    for section in dataclasses.fields(settings):
        own = getattr(settings, section.name)
        given = {str(k).lower(): v for k, v in values.get(section.name, {}).items()}
        for f in dataclasses.fields(own):
            if f.name in given:
                setattr(own, f.name, _typed(given[f.name], f.type.__name__ if isinstance(f.type, type) else str(f.type)))


def _from_environment(environment: dict[str, str]) -> dict[str, dict]:
    out: dict[str, dict] = {}
    for name, value in environment.items():
        section, parts, rest = name.upper().removeprefix(PREFIX).partition("__")
        if name.upper().startswith(PREFIX) and parts:
            out.setdefault(section.lower(), {})[rest.lower()] = value
    return out


def load(file: str | None = None, given: dict[str, dict] | None = None, environment: dict[str, str] | None = None) -> Settings:
    """The settings. A file that is named and isn't there is told on stderr and left out; wrong values raise ValueError."""
    environment = dict(os.environ) if environment is None else environment
    settings = Settings()
    named = file or environment.get(f"{PREFIX}CONFIG")
    user = Path(named or "lodestrata.toml")
    for at in (Path(__file__).resolve().parent.parent / "lodestrata.defaults.toml", user):
        if at.is_file():
            _apply(settings, tomllib.loads(at.read_text()))
    if named and not user.is_file():
        print(f"no configuration file {user}", file=sys.stderr)
    _apply(settings, _from_environment(environment))
    _apply(settings, given or {})
    if settings.runtime.discovery_workers < 1 or settings.runtime.stale_hours <= 0:
        raise ValueError("discovery_workers and stale_hours must be more than 0")
    return settings


def logger(settings: Settings) -> logging.Logger:
    """The engine's logger, to stderr and, where one is named, a file that is rotated."""
    out = logging.getLogger("lodestrata")
    out.setLevel(settings.logging.level)
    for old in list(out.handlers):
        out.removeHandler(old)
        old.close()
    handlers: list[logging.Handler] = [logging.StreamHandler()]
    if settings.logging.log_file:
        handlers.append(logging.handlers.RotatingFileHandler(settings.logging.log_file, maxBytes=settings.logging.rotation_size_mb << 20, backupCount=settings.logging.rotation_backup_count))
    for h in handlers:
        h.setFormatter(logging.Formatter(settings.logging.format))
        out.addHandler(h)
    return out

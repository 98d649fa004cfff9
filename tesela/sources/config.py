"""Profiles in TOML: a common table under a profile's own, checked strictly; and secrets from the environment."""

from __future__ import annotations

import os
import tomllib
from dataclasses import MISSING, dataclass, field, fields
from pathlib import Path

from ..functions.time import Period, checked


class ConfigError(RuntimeError):
    pass


@dataclass(frozen=True)
class Config:
    """What the stages need. Paths are strings that Spark can open."""

    name: str
    corpus: str
    rubric: str
    log: str
    output: str
    repaired: str = ""
    translated: str = ""
    translation_log: str = ""
    col_id: str = "id"
    col_text: str = "text_completo"
    col_lang: str = "lang"
    col_translation: str = "traducción"
    col_time: str = "created_at"
    zone: str = "America/Mexico_City"
    langs: tuple = ()
    query_types: tuple = ()
    drop_retweets: bool = True
    drop_quotes: bool = True
    sample: int = 0
    seed: int = 42
    scope: str = "fallidos"
    calls: int = 32
    attempts: int = 3
    block: int = 200
    breaker: int = 20
    most_words: int = 60
    reasoning: int = 0
    model: str = ""
    prices: dict = field(default_factory=dict)
    anchors: tuple = ()
    absence: object = "auto"
    periods: tuple = ()
    smoothing: int = 7
    small_sample: int = 30
    coverage: int = 30
    call_timeout: float = 90.0
    most_wait: float = 30.0
    again: bool = False
    translation_calls: int = 8

    def corpus_to_score(self) -> str:
        return self.translated if self.translated and Path(self.translated).exists() else self.repaired or self.corpus


def load(path: str | Path, profile: str) -> Config:
    """The profile's values over those of [comun]. An unknown or missing key is an error."""
    with open(path, "rb") as f:
        doc = tomllib.load(f)
    own = doc.get("perfiles", {})
    if profile not in own:
        raise ConfigError(f"no profile {profile!r}; there are {', '.join(sorted(own)) or 'none'}")
    values = {"name": profile, **doc.get("comun", {}), **own[profile]}
    known = {f.name: f for f in fields(Config)}
    if unknown := sorted(set(values) - set(known)):
        raise ConfigError(f"unknown keys: {', '.join(unknown)}")
    if lacking := sorted(k for k, f in known.items() if f.default is MISSING and f.default_factory is MISSING and k not in values):
        raise ConfigError(f"missing keys: {', '.join(lacking)}")
    if "periods" in values:
        try:
            values["periods"] = tuple(checked([Period(p["name"], p["start"], p.get("end")) for p in values["periods"]]))
        except (KeyError, TypeError, ValueError) as e:
            raise ConfigError(f"periods: {e}") from e
    return Config(**{k: tuple(v) if isinstance(v, list) else v for k, v in values.items()})


def secret(name: str, root: str | Path = ".") -> str:
    """From the environment, else from a .env file."""
    if os.environ.get(name, "").strip():
        return os.environ[name].strip()
    file = Path(root) / ".env"
    for line in file.read_text(encoding="utf-8").splitlines() if file.exists() else ():
        key, eq, value = line.partition("=")
        if eq and key.strip().removeprefix("export ").strip() == name and value.strip():
            return value.strip().strip("\"'")
    raise ConfigError(f"{name} is neither in the environment nor in {file}")

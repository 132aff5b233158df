"""Settings of the corpus plans as one value instead of process globals."""

from __future__ import annotations

import os
from dataclasses import dataclass, fields, replace


@dataclass(frozen=True)
class Settings:
    """What a run may change; ``from_env`` reads ``PAPERLOOM_<NAME>``, the environment winning over defaults."""

    max_pages: int = 0  # 0: no limit
    max_year: int = 2027
    article_boundary: bool = True
    inject_links: bool = True
    early_pages: int = 4

    @classmethod
    def from_env(cls, env: dict[str, str] | None = None) -> Settings:
        env = dict(os.environ) if env is None else env
        out = cls()
        for f in fields(cls):
            raw = env.get(f"PAPERLOOM_{f.name.upper()}")
            if raw is None or raw == "":
                continue
            kind = type(getattr(out, f.name))
            value = raw.strip().lower() in ("1", "true", "yes") if kind is bool else kind(raw)
            out = replace(out, **{f.name: value})
        return out

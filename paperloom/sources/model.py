"""An optional language model as an injected function; off unless one is given.

The engine calls no network. A caller may pass ``ask(prompt, **options) -> str``; its
answers only ever add to or withdraw from what the rules found, and a failing call keeps
the rules' result.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Ways to tell a service to answer without long reasoning, tried in turn.
MODES = ("disabled", "effort_low", "none")


@dataclass
class Model:
    """Calls ``ask`` and steps down a mode whenever the service rejects its option."""

    ask: Callable[..., str] | None = None
    mode: str = MODES[0]
    failures: list[str] = field(default_factory=list)

    def options(self) -> dict:
        return {"disabled": {"thinking": "disabled"}, "effort_low": {"effort": "low"}}.get(self.mode, {})

    def __call__(self, prompt: str) -> str | None:
        while self.ask is not None:
            try:
                return self.ask(prompt, **self.options())
            except ValueError as e:  # the option was rejected
                if self.mode == MODES[-1]:
                    self.failures.append(str(e))
                    return None
                self.mode = MODES[MODES.index(self.mode) + 1]
            except Exception as e:  # whatever else fails keeps the rules' result
                self.failures.append(str(e))
                return None
        return None


def lenient_json(col: Column) -> Column:
    """A JSON text as a variant; one that fails is tried again with its stray backslashes doubled."""
    fixed = F.regexp_replace(col, r'\\(?!["\\/bfnrtu])', r"\\\\")
    return F.coalesce(F.try_parse_json(col), F.try_parse_json(fixed))

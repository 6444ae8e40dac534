"""Settings of a run, and what they must hold."""

from __future__ import annotations

import os
from collections.abc import Callable
from dataclasses import dataclass, field

# Weights of roles for each use of an index.
EVEN = dict.fromkeys(("Arguments", "Precedents", "Facts", "Issues", "Reasoning", "Decision", "Statute", "Preamble", "Others"), 1.0)
PRECEDENTS = {"Decision": 3.0, "Precedents": 3.0, "Issues": 2.0, "Reasoning": 2.0, "Arguments": 1.0, "Facts": 0.5, "Statute": 0.5, "Preamble": 0.3, "Others": 0.2}
RETRIEVAL = {"Decision": 3.0, "Precedents": 3.0, "Issues": 2.5, "Preamble": 2.5, "Facts": 2.5, "Statute": 1.5, "Reasoning": 0.4, "Arguments": 0.3, "Others": 0.2}
WEIGHTS = {"even": EVEN, "precedents": PRECEDENTS, "retrieval": RETRIEVAL}


@dataclass
class Settings:
    """Where data are, and how they are cut and chosen."""

    source: str = ""
    index: str = ""
    progress: str = ""
    threshold: float = 0.7
    least: int = 3
    most: int = 10
    min_chars: int = 100
    top_k: int = 12
    weights: str = "even"
    embed: str = "hashed"
    roles_enabled: bool = False
    role_model: str = ""
    years: list[int] = field(default_factory=list)

    @classmethod
    def from_environment(cls, prefix: str = "LEXLOOM_") -> Settings:
        """Settings from variables named after them; lists are parted by commas."""
        own = cls()
        for name, default in vars(cls()).items():
            value = os.environ.get(prefix + name.upper())
            if value is None:
                continue
            if isinstance(default, bool):
                setattr(own, name, value.strip().lower() == "true")
            elif isinstance(default, list):
                setattr(own, name, [int(x) for x in value.split(",") if x.strip()])
            else:
                setattr(own, name, type(default)(value))
        return own

    def validate(self, exists: Callable[[str], bool] = os.path.exists) -> Settings:
        """These settings; an error that lists all that is wrong with them."""
        wrong = [f"{name} is not set" for name in ("source", "index", "progress") if not getattr(self, name)]
        wrong += [] if 0 <= self.threshold <= 1 else ["threshold must be from 0 to 1"]
        wrong += [] if 1 <= self.least <= self.most else ["least must be from 1 to most"]
        wrong += [] if self.top_k >= 0 else ["top_k must not be negative"]
        wrong += [] if self.weights in WEIGHTS else [f"weights must be one of {', '.join(WEIGHTS)}"]
        if self.roles_enabled and not (self.role_model and exists(self.role_model)):
            wrong.append(f"there is no role model at {self.role_model!r}")
        if wrong:
            raise ValueError("settings:\n" + "\n".join(f"  - {w}" for w in wrong))
        return self

"""Settings of a training run: defaults, and what environment variables say instead."""

from __future__ import annotations

import os
from collections.abc import Mapping
from dataclasses import dataclass, fields

PREFIX = "LOOM_"


@dataclass(frozen=True)
class TrainingConfig:
    """Each field is read from ``LOOM_<NAME>``, in the type of its default."""

    block: int = 384
    max_length: int = 192
    eval_fraction: float = 0.02
    seed: int = 42
    batch_size: int = 1
    accumulate: int = 16
    epochs: int = 2
    learning_rate: float = 2e-4
    warmup_share: float = 0.03
    max_steps: int = 0

    @classmethod
    def from_env(cls, env: Mapping[str, str] = os.environ) -> TrainingConfig:
        given = {f.name: env[PREFIX + f.name.upper()] for f in fields(cls) if env.get(PREFIX + f.name.upper(), "").strip()}
        try:
            return cls(**{name: type(getattr(cls, name))(value) for name, value in given.items()})
        except ValueError as e:
            raise ValueError(f"a setting is no number: {e}") from e

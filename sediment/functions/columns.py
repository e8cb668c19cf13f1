"""Column names: given one or many, checked, kept apart."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame


def as_list(names: str | Sequence[str]) -> list[str]:
    return [names] if isinstance(names, str) else list(names)


def require_columns(frames: Mapping[str, DataFrame], columns: Sequence[str], what: str) -> None:
    missing = {side: [c for c in columns if c not in df.columns] for side, df in frames.items()}
    if any(missing.values()):
        found = "; ".join(f"{side}: {names}" for side, names in missing.items() if names)
        raise KeyError(f"{what} missing in {found}")


def refuse_columns(df: DataFrame, reserved: Iterable[str], where: str) -> None:
    """Data must not bring columns under names that a step adds itself."""
    clash = sorted(set(df.columns) & set(reserved))
    if clash:
        raise ValueError(f"{where} adds columns of its own named {clash}; rename those of the data")

"""Names of the columns an operator works on."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame


@dataclass(frozen=True)
class FeatureSpec:
    """The roles of the columns of a labelled table.

    ``pos_label`` is the class that precision and recall are about; it is 0 unless
    the caller says otherwise.
    """

    numeric: tuple[str, ...]
    categorical: tuple[str, ...]
    label: str
    keys: tuple[str, ...] = ()
    ts: str | None = None
    pos_label: int = 0

    @property
    def features(self) -> list[str]:
        """Numeric names, then categorical names, in the order given."""
        return [*self.numeric, *self.categorical]


@dataclass(frozen=True)
class FeatureLookup:
    """One feature table to look up for each row of a fact table.

    With ``timestamp_lookup_key`` the lookup is point-in-time (latest feature row not
    after the fact); without it the feature row of the same key is taken.
    ``tie_break`` names the column whose highest value wins among feature rows that
    share key and time; without it such rows are an error.
    """

    features: DataFrame
    feature_names: tuple[str, ...]
    lookup_key: str | tuple[str, ...]
    timestamp_lookup_key: str | None = None
    tie_break: str | None = None
    rename: dict[str, str] = field(default_factory=dict)

    @property
    def keys(self) -> list[str]:
        return [self.lookup_key] if isinstance(self.lookup_key, str) else list(self.lookup_key)

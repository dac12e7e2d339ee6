"""Null policy as fit and transform: what is learned on training rows is a small JSON state."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import asdict, dataclass, field

from pyspark.sql import DataFrame, functions as F

from hearthrate.functions.nulls import number
from hearthrate.operators.quantiles import column_medians

# Columns by the reason their values are missing.
OWNER_COLUMN = "host_name"
UNKNOWN_COLUMNS = (
    "host_response_time", "host_location", "host_neighbourhood", "host_response_rate", "host_acceptance_rate",
)
NO_FLAG_COLUMNS = ("host_is_superhost",)
ZERO_COLUMNS = ("reviews_per_month", "host_quality_score")
NEVER_COLUMNS = ("days_since_last_review",)
NEVER = 9999
MEDIAN_COLUMNS = (
    "host_response_rate_num", "host_acceptance_rate_num", "beds", "minimum_minimum_nights",
    "maximum_minimum_nights", "minimum_maximum_nights", "maximum_maximum_nights",
)
MODE_COLUMNS = ("bathrooms_text", "has_availability")
SUPERSEDED_COLUMNS = ("first_review", "last_review", "neighbourhood")


def column_mode(df: DataFrame, column: str) -> str | None:
    """The most frequent value, the smallest on a tie: a counted top-1, not a per-task value map."""
    top = (
        df.where(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias("n"))
        .orderBy(F.desc("n"), F.asc(column))
        .limit(1)
        .collect()
    )
    return top[0][column] if top else None


def fill_values(df: DataFrame, values: Mapping[str, object]) -> DataFrame:
    """Fill missing cells of the named columns that exist; numbers become doubles."""
    changes = {}
    for name, value in values.items():
        if name not in df.columns or value is None:
            continue
        if isinstance(value, str):
            changes[name] = F.coalesce(F.col(name), F.lit(value))
        else:
            changes[name] = F.coalesce(number(df, name), F.lit(float(value)))
    return df.withColumns(changes) if changes else df


def fill_with_medians(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Fit medians on the table itself and fill it."""
    return fill_values(df, column_medians(df, list(columns)))


@dataclass
class NullPolicy:
    """Fitted fill values of the full policy."""

    medians: dict[str, float] = field(default_factory=dict)
    modes: dict[str, str] = field(default_factory=dict)
    owner: str = OWNER_COLUMN
    unknown: tuple[str, ...] = UNKNOWN_COLUMNS
    no_flag: tuple[str, ...] = NO_FLAG_COLUMNS
    zero: tuple[str, ...] = ZERO_COLUMNS
    never: tuple[str, ...] = NEVER_COLUMNS
    superseded: tuple[str, ...] = SUPERSEDED_COLUMNS

    @classmethod
    def fit(
        cls,
        df: DataFrame,
        median_columns: Sequence[str] = MEDIAN_COLUMNS,
        mode_columns: Sequence[str] = MODE_COLUMNS,
        **roles,
    ) -> "NullPolicy":
        """Medians and modes over the rows the policy keeps."""
        policy = cls(**roles)
        kept = policy.keep_rows(df)
        policy.medians = column_medians(kept, [c for c in median_columns if c in df.columns])
        for name in mode_columns:
            if name in df.columns and (mode := column_mode(kept, name)) is not None:
                policy.modes[name] = mode
        return policy

    def keep_rows(self, df: DataFrame) -> DataFrame:
        return df.where(F.col(self.owner).isNotNull()) if self.owner in df.columns else df

    def transform(self, df: DataFrame) -> DataFrame:
        out = self.keep_rows(df)
        out = fill_values(out, {c: "unknown" for c in self.unknown})
        out = fill_values(out, {c: "f" for c in self.no_flag})
        out = fill_values(out, {c: 0 for c in self.zero})
        out = fill_values(out, {c: NEVER for c in self.never})
        out = fill_values(out, {**self.medians, **self.modes})
        return out.drop(*self.superseded)

    def to_state(self) -> dict:
        return asdict(self)

    @classmethod
    def from_state(cls, state: Mapping) -> "NullPolicy":
        return cls(**{k: tuple(v) if isinstance(v, list) else v for k, v in state.items()})


def zero_fill(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return fill_values(df, {c: 0 for c in columns})

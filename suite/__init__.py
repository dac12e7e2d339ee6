"""Queries over the driver tables, each beside the SQL it must agree with."""

from suite import (  # noqa: F401
    cleaning, explaining, features, flagship, groups, imputing, modelling, panels, profiling, residuals, scoring, sources, validating,
)
from suite.registry import REGISTRY  # noqa: F401

"""Imports every query module so that the registry is complete."""

from checks import baseline, features, modelling, selection, validation  # noqa: F401
from checks.registry import QUERIES, SQL  # noqa: F401

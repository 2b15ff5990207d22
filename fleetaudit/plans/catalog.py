"""All registered queries."""

from fleetaudit.plans import edits, fields, integrity, lifecycle, objects, responses  # noqa: F401
from fleetaudit.plans.registry import CHECKS, QUERIES  # noqa: F401

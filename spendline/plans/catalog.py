"""All registered queries: importing this module fills the registry."""

from spendline.plans import checks, domain, measures, models, primitives, reports, seeded  # noqa: F401
from spendline.plans.registry import QUERIES  # noqa: F401

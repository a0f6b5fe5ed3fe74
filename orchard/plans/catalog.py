"""Import every catalog module so their queries register."""

from orchard.plans import (  # noqa: F401
    catalog_basic, catalog_checks, catalog_mdp, catalog_models, catalog_supervised, catalog_unsupervised,
)

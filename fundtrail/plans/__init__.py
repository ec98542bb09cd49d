"""The two batch jobs and their sinks."""

from fundtrail.plans.customer import customer_features
from fundtrail.plans.location import location_features

__all__ = ["customer_features", "location_features"]

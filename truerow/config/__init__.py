"""Driver-side configuration: everything here is small and turns into plan expressions."""

from truerow.config.endpoints import DeleteCondition, EndpointSchema, load_endpoint_schemas
from truerow.config.naming import Naming
from truerow.config.relationships import DEFAULT_RELATIONSHIPS, Relationship
from truerow.config.rules import AttributeRule, BrandRule, ProductTypeRule, RuleSet
from truerow.config.tracking import TrackedEndpoint, TrackingConfig

__all__ = [
    "AttributeRule",
    "BrandRule",
    "DEFAULT_RELATIONSHIPS",
    "DeleteCondition",
    "EndpointSchema",
    "Naming",
    "ProductTypeRule",
    "Relationship",
    "RuleSet",
    "TrackedEndpoint",
    "TrackingConfig",
    "load_endpoint_schemas",
]

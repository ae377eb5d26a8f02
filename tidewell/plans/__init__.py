"""Named queries over the given tables, and the layered job that chains the operators."""

from tidewell.plans import business, churn, history, streams, tables
from tidewell.plans.registry import Registry

ALL = Registry()
for _module in (tables, business, history, streams, churn):
    ALL.merge(_module.R)

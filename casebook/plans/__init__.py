"""Plan helpers: size-bounded broadcast and physical-plan inspection."""

from casebook.plans.broadcast import broadcast_if_small, literal_table
from casebook.plans.inspect import physical_plan, count_nodes, exchanges

__all__ = ["broadcast_if_small", "literal_table", "physical_plan", "count_nodes", "exchanges"]

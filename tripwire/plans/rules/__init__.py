"""The rule catalogue: per changed table, its rules and the facts they can read."""

from tripwire.plans.rules import client, invoicing, order_header, planning, purchasing, stock
from tripwire.plans.rules.base import Fact, Rule

CATALOGUE: dict[str, tuple[list[Rule], dict[str, Fact]]] = {
    "invoicing": (invoicing.RULES, invoicing.FACTS),
    "invoicing_line": (invoicing.LINE_RULES, invoicing.LINE_FACTS),
    "order_header": (order_header.RULES, order_header.FACTS),
    "client": (client.RULES, {}),
    "part_transaction": (stock.TRANSACTION_RULES, {}),
    "planning_lot_detailed": (planning.RULES, planning.FACTS),
    "purchase_order_line": (purchasing.RULES, purchasing.FACTS),
    "part_quantity": (stock.QUANTITY_RULES, {}),
}

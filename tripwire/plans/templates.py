"""The messages: wording, recipients' roles and placeholders per alert."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

ORDER_SUBJECT = "Order {ref}, client {client}: please check"
CLOSING = "\n\nThis message was sent automatically."


@dataclass(frozen=True)
class Template:
    """``to`` and ``cc`` are roles; ``route`` names a rule that replaces ``to``."""

    alert: str
    subject: str
    body: str
    to: tuple[str, ...] = ("sales",)
    cc: tuple[str, ...] = ()
    route: str = "role"


TEMPLATES = [
    Template("BO ALLOWED", "Client {ref}: please check",
             "Client {ref} was entered or reactivated with back orders allowed. Ignore this if it is intended."),
    Template("BO NOT ALLOWED", ORDER_SUBJECT,
             "A partial packing slip exists for order {ref}, which does not allow back orders, so its remainder "
             "would be cancelled. Cancel the slip and allow back orders."),
    Template("NOT RESERVED", ORDER_SUBJECT,
             "Order {ref} has a line whose reserved quantity differs from the ordered quantity. The rest will be "
             "held, back ordered or cancelled, depending on the order's shipping settings.", cc=("billing",)),
    Template("ZERO QUANTITY", ORDER_SUBJECT,
             "Order {ref} has a part with quantity 0. If it is a blanket order, correct its type."),
    Template("ORDER CANCELLED", "Order {ref}: cancelled",
             "Order {ref} was cancelled. Discard the picking list and hand the packing slip to {user}.",
             cc=("shipping", "warehouse")),
    Template("NEW BLANKET", "New blanket order {ref}",
             "Blanket order {ref} was created for {client}.", to=("planning",)),
    Template("NEW RELEASE", "New blanket release {ref}",
             "Blanket release {ref} was created for {client}.", to=("planning",)),
    Template("CANCELLED PACKING SLIP", "Order {order}: please check",
             "Packing slip {ref} of order {order} was cancelled by {user}.", cc=("billing",)),
    Template("SHIPPING COST MISSING", "Order {order}: please check",
             "Invoice {ref} has no shipping cost although the terms of order {order} ask for one. Cancel it, add "
             "the cost and invoice again.", cc=("billing",)),
    Template("LINE DATES", ORDER_SUBJECT,
             "The lines of order {ref} have different required dates, but the order ships whole or does not allow "
             "back orders. Set it to ship in parts with back orders allowed.", cc=("billing",)),
    Template("ZERO BANK FEES", ORDER_SUBJECT,
             "Order {ref} is paid by wire transfer and has no bank fees. Ignore this if it is intended.",
             cc=("billing",)),
    Template("NEGATIVE QUANTITY", "Part {part}: negative quantity",
             "Transaction {ref} ({description}) left part {part} with a negative quantity.", to=("planning",)),
    Template("COMPLETED BLANKET", ORDER_SUBJECT,
             "All quantities of blanket order {ref} are 0. Set a completed blanket order to cancelled."),
    Template("UNSENT INVOICE EMAIL", "Order {order}, invoice {ref}: please check",
             "Invoice {ref} was made without an e-mail to the client.", to=("billing",)),
    Template("INVOICED PRODUCTION", "Invoiced production, order {order}",
             "An invoice was made for a production of order {order} that has not run.", to=("planning",)),
    Template("CONVERTED DATE", ORDER_SUBJECT,
             "Order {ref} for {client} went from quote or pending to shipment, but its order date is not the day "
             "of the change."),
    Template("EXISTING BLANKET", ORDER_SUBJECT,
             "Order {ref} is a plain order, but these of its parts are on blanket orders of the client:\n\n{list}"),
    Template("MISSING COMPONENT", ORDER_SUBJECT,
             "Order {ref} for {client} lacks components. Its kits and the components present are:\n\n{list}\n\n"
             "Delete these lines and enter the kits again."),
    Template("COMPONENT MULTIPLIER", ORDER_SUBJECT,
             "Order {ref} for {client} has {noun}:\n\n{list}\n\nThe suggestion takes the quantity of the kit as "
             "right; otherwise delete the lines and enter the kit again."),
    Template("UNCHECKED NEED CALCULATION", "Lot {ref}: calculation to check",
             "Lot {ref} was calculated without the manufactured stock.", to=("planning_lead",), route="user"),
    Template("UNIT DATES", ORDER_SUBJECT,
             "Order {ref} for {client} has a unit that is due in less than 14 days. Ignore this if it is expedited."),
    Template("DUPLICATE PO", ORDER_SUBJECT,
             "Order {ref} for {client} has the client order number of another order of the invoiced client."),
    Template("MISSING TAX ID", ORDER_SUBJECT,
             "Order {ref} is for {client}, whose tax number is missing. No picking list can be printed."),
    Template("TRUCK SHIPMENT", ORDER_SUBJECT,
             "Order {ref} has a part that ships only by truck, but a parcel carrier is set."),
    Template("RECEPTION", "Purchase order {po}, supplier {supplier}: reception",
             "Goods of purchase order {po} ({supplier}) were received. Its reference asks for this message.",
             to=("purchasing_lead",), route="creator"),
    Template("MISSING SUPPLIER", "Purchase order {po}: please check",
             "Part {part} was ordered from a supplier that is not set up for it. Add the supplier and its prices.",
             to=("purchasing_lead",), route="user"),
    Template("OVER RECEPTION", "Purchase order {po}: please check",
             "More was received than ordered on purchase order {po}. Correct the ordered quantity.",
             to=("purchasing",)),
]

HANDLED = [t.alert for t in TEMPLATES]

NOUN_ONE = "a component with a wrong quantity"
NOUN_MANY = "components with wrong quantities"


# Placeholders in the order in which their values are handed to a format.
PLACEHOLDERS = [
    "ref", "user", "client", "order", "part", "description", "po", "supplier", "list", "noun",
]


def as_format(text: str) -> str:
    """A format in which ``%n$s`` stands for the n-th placeholder."""
    return re.sub(
        r"\{([a-z]+)\}", lambda m: f"%{PLACEHOLDERS.index(m[1]) + 1}$s", text.replace("%", "%%")
    )


def template_table(spark: SparkSession) -> DataFrame:
    """One row per handled alert: a fixed, small table."""
    rows = [
        (t.alert, as_format(t.subject), as_format(t.body + CLOSING), list(t.to), list(t.cc), t.route)
        for t in TEMPLATES
    ]
    return spark.createDataFrame(
        rows,
        "alert string, subject_format string, body_format string, "
        "to_roles array<string>, cc_roles array<string>, route string",
    )

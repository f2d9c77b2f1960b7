"""Business rules as columns, each with its fixed codes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str

# Vendor codes that are no sales routes (runaways, internal corrections, closures,
# technicians, uncollectible, warehouses).
NON_COMMERCIAL_ROUTES = (146, 147, 148, 149, 179, 181, 186, 197, 198, 200, 440, 441)
RUNAWAY_ROUTE = 146
CORRECTION_ROUTE = 147

# Routes of the gastronomy channel, for acquisitions and for debt.
GASTRO_ROUTES = (155, 156, 157, 158, 159, 160, 161, 162, 163, 164,
                 167, 168, 169, 170, 171, 172, 173, 174, 175, 176, 242)
GASTRO_DEBT_ROUTES = (157, 158, 159, 163, 164, 171, 172, 173, 176, 242)
DEBT_EXCLUDED_ROUTES = (0, 200, 300, 400)

# Vendors of the sales matrix and routes of the collections report.
SALES_VENDORS = (1, 2, 3, 4, 5, 10, 15, 20, 25, 30, 40, 50, 60, 70, 80, 90, 100, 110, 120,
                 155, 157, 158, 159, 160, 163, 164, 165, 170, 172, 173, 174, 175, 176, 242,
                 251, 260, 265, 270, 275, 281,
                 401, 410, 415, 420, 425, 430, 434, 460, 475, 481)
COLLECTION_ROUTES = (1, 2, 3, 5, 8, 9, 11, 13, 14, 16, 17, 18, 25, 35, 50, 71, 90,
                     4, 6, 12, 15, 19, 28, 36, 55, 70, 83, 99, 110, 119,
                     10, 20, 30, 40, 60, 74, 84, 96, 105, 116,
                     251, 260, 265, 270, 275, 281, 460, 475, 481,
                     401, 410, 415, 420, 425, 430, 434,
                     155, 157, 158, 159, 160, 163, 164, 172, 173, 176, 242)

# Depot address, gated communities, segment attribute, equipment product.
DEPOT_ADDRESS = "AV. CENTRAL 1234"
GATED_COMMUNITIES = (
    "NORDELTA", "BAHIA GRANDE", "BAHIA SAN MARCO", "EL TRIGAL", "LOS LAGOS", "PILAR DEL ESTE",
    "CAMPOS DE ECHEVERRIA", "SAN AGUSTIN", "SANTA CATALINA", "BARRIO ABRIL", "ALTOS DE GOLF",
    "LOS CARDALES", "AYRES DEL PILAR",
)
SEGMENT_ATTRIBUTE = 5
DISPENSER = "AC"

# Channel by customer category, payment terms, treasury methods.
CHANNEL_BY_CATEGORY = {"CAT-A": "RTO", "CAT-B": "RTO", "CAT-C": "Digital", "CAT-D": "Digital"}
CASH_TERMS = 1
CREDIT_TERMS = (2, 3, 4)
CASH_METHOD = "EFE"
INTERNAL_METHODS = ("CCB", "CPA")

# Retention events, highest priority first, with their descriptions.
RETENTION_EVENTS = {
    "E3": "FUGADO",
    "E4": "CORRECCIÓN INTERNA",
    "E1": "RTO/SUPER/TÉCNICO",
    "EC": "CAMBIO",
    "E2": "VOLVIÓ A COMPRAR",
}
STILL_SILENT = ("E5", "SIGUE SIN CONSUMO")


def community_patterns(names: Sequence[str] = GATED_COMMUNITIES) -> list[tuple[str, str]]:
    """(pattern, label) pairs: the name anywhere in the address."""
    return [(f"%{name}%", name) for name in names]


def promo_class(order_id: Column | None, total: ColumnOrName, has_zero: ColumnOrName) -> Column:
    """Promotion of a first purchase. Without `order_id` the no-purchase case does not exist."""
    total = F.col(total) if isinstance(total, str) else total
    has_zero = F.col(has_zero) if isinstance(has_zero, str) else has_zero
    paid_part_free = (total > 0) & (has_zero == 1)
    label = F.when(total == 0, "SIN CARGO").when(paid_part_free, "2x1/BONIF").otherwise("NORMAL")
    if order_id is None:
        return label
    return F.when(order_id.isNull(), "SIN COMPRA").otherwise(label)


def channel(category: ColumnOrName) -> Column:
    """Acquisition channel, NULL for a category of neither."""
    category = F.col(category) if isinstance(category, str) else category
    result = F.lit(None).cast("string")
    for name in sorted(set(CHANNEL_BY_CATEGORY.values())):
        codes = [code for code, value in CHANNEL_BY_CATEGORY.items() if value == name]
        result = F.when(category.isin(codes), name).otherwise(result)
    return result


def retirement_event(route: ColumnOrName, swap_id: ColumnOrName) -> Column:
    """Code of an equipment retirement: a swap, or told apart by the route that did it."""
    route = F.col(route) if isinstance(route, str) else route
    swap_id = F.col(swap_id) if isinstance(swap_id, str) else swap_id
    return (
        F.when(swap_id.isNotNull(), "EC")
        .when(route == RUNAWAY_ROUTE, "E3")
        .when(route == CORRECTION_ROUTE, "E4")
        .otherwise("E1")
    )


def event_priority(code: ColumnOrName) -> Column:
    """1 for the event that wins, 99 for an unknown one."""
    code = F.col(code) if isinstance(code, str) else code
    rank = F.lit(99)
    for position, name in reversed(list(enumerate(RETENTION_EVENTS, start=1))):
        rank = F.when(code == name, position).otherwise(rank)
    return rank


def event_text(code: ColumnOrName) -> Column:
    code = F.col(code) if isinstance(code, str) else code
    text = F.lit(None).cast("string")
    for name, label in RETENTION_EVENTS.items():
        text = F.when(code == name, label).otherwise(text)
    return text


def exclusive_debt(terms: ColumnOrName, cash: Column, credit: Column) -> tuple[Column, Column]:
    """Cash debt only for cash customers, credit debt only for credit customers."""
    terms = F.col(terms) if isinstance(terms, str) else terms
    zero = F.lit(0)
    return (
        F.when(terms == CASH_TERMS, F.coalesce(cash, zero)).otherwise(zero),
        F.when(terms.isin(*CREDIT_TERMS), F.coalesce(credit, zero)).otherwise(zero),
    )

"""Pricing and money rules as Column expressions.

All money is DECIMAL and rounded half-up, which is the stored type of the
source tables.  Every function returns a ``Column`` so it stays inside
whole-stage codegen.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, functions as F

from orderflow.schemas import dec

ColLike = Column | str

# FIXED VALUES: VAT rate inside gross amounts, kilograms per pallet,
# share of a line that may be returned (normal path / late path).
VAT_RATE = Decimal("0.10")
KG_PER_PALLET = 800
RETURN_SHARE = 0.10
LATE_RETURN_SHARE = 0.05


def _c(x: ColLike) -> Column:
    return F.col(x) if isinstance(x, str) else x


def unit_price(base_price: ColLike, discount_pct: ColLike) -> Column:
    """``round(base * (1 - pct/100), 2)`` with exact decimal arithmetic.

    A NUMERIC(5,2) discount gives a factor with four decimals in (-9, 11),
    so DECIMAL(7,4) holds it exactly and keeps the product at DECIMAL(18,6),
    Spark's compact 64-bit decimal representation."""
    factor = (F.lit(Decimal(1)) - _c(discount_pct) * F.lit(Decimal("0.01"))).cast(dec(7, 4))
    return F.round(_c(base_price).cast(dec(10, 2)) * factor, 2).cast(dec(10, 2))


def line_quantity(packs: ColLike, pack_qty: ColLike) -> Column:
    return (_c(packs) * _c(pack_qty)).cast("int")


def line_total(price: ColLike, quantity: ColLike) -> Column:
    return F.round(_c(price) * _c(quantity), 2).cast(dec(14, 2))


def line_weight(weight_kg: ColLike, quantity: ColLike) -> Column:
    return F.round(_c(weight_kg) * _c(quantity), 2).cast(dec(12, 2))


def vat_included(amount: ColLike, rate: Decimal = VAT_RATE) -> Column:
    """VAT contained in a gross amount: ``round(amount * r / (1 + r), 2)``.

    A two-decimal amount divided by 11 is never an exact half cent, so the
    rounding mode of the last step cannot change the result.  When
    ``(1 + r) / r`` is a whole number (11 for 10 %) the division by it stays
    in DECIMAL(18,6), Spark's compact representation, instead of widening to
    DECIMAL(24,8); its 6-decimal intermediate (a repeating ``.0909..``-type
    tail) cannot create a tie at the cent.
    """
    divisor = (Decimal(1) + rate) / rate
    if divisor == divisor.to_integral_value():
        return F.round(_c(amount) / F.lit(int(divisor)), 2).cast(dec(14, 2))
    r = F.lit(rate)
    return F.round(_c(amount) * r / (F.lit(Decimal(1)) + r), 2).cast(dec(14, 2))


def pallets(weight: ColLike, per: int = KG_PER_PALLET) -> Column:
    """``max(1, floor(weight / per))``."""
    return F.greatest(F.lit(1), F.floor(_c(weight) / F.lit(per)).cast("int"))


def due_date(created: ColLike, terms_days: ColLike) -> Column:
    """Created day plus payment terms; null terms count as 0."""
    return F.date_add(F.to_date(_c(created)), F.coalesce(_c(terms_days), F.lit(0)))


def production_date(created: ColLike) -> Column:
    return F.to_date(_c(created))


def best_before(created: ColLike, shelf_life_days: ColLike) -> Column:
    """Order time plus shelf life, as a date (time of day is dropped)."""
    return F.to_date(_c(created) + F.make_interval(days=_c(shelf_life_days)))


def payment_status(total: ColLike, paid: ColLike, due: ColLike, as_of: ColLike) -> Column:
    """paid in full -> paid, part -> partial, nothing and due after as_of -> planned,
    else overdue.  Strict ``>``: due today is overdue, not planned."""
    total, paid = _c(total), _c(paid)
    return (F.when(paid >= total, F.lit("paid"))
            .when(paid > 0, F.lit("partial"))
            .when(_c(due) > _c(as_of), F.lit("planned"))
            .otherwise(F.lit("overdue")))


def max_return_quantity(quantity: ColLike, share: float = RETURN_SHARE) -> Column:
    """Largest quantity one return may take: ``max(1, int(q * share))``."""
    return F.greatest(F.lit(1), (_c(quantity) * F.lit(share)).cast("int"))


def return_amount(price: ColLike, quantity: ColLike) -> Column:
    return F.round(_c(price) * _c(quantity), 2).cast(dec(14, 2))

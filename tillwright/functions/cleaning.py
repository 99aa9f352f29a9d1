"""Cleaning rules: discount, address, state, name, e-mail, ids, prices.

Every function takes columns and returns one column, so a rule can be used in
any ``select`` and stays inside code generation. None of them throws on dirty
text under ANSI mode.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

# Rate granted by each offer flag, first flag set wins.
OFFERS = {
    "offer_1": 0.05,
    "offer_2": 0.10,
    "offer_3": 0.15,
    "offer_4": 0.20,
    "offer_5": 0.25,
}

# Texts that count as a set flag.
TRUE_TEXTS = ("t", "true", "y", "yes", "1")

# State names by code.
STATES = {
    "AZ": "Arizona",
    "DC": "District of Columbia",
    "KY": "Kentucky",
    "CA": "California",
    "CT": "Connecticut",
    "VT": "Vermont",
    "MD": "Maryland",
    "AL": "Alabama",
    "TN": "Tennessee",
    "GA": "Georgia",
    "MA": "Massachusetts",
    "FL": "Florida",
    "CO": "Colorado",
    "AK": "Alaska",
    "AR": "Arkansas",
    "OK": "Oklahoma",
    "Washington": "Washington",
}

# Fixed value: what the strict rule accepts as an address.
ADDRESS = r"[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}"

ADDRESS_PARTS = [
    "shipping_street_name", "shipping_city", "shipping_state", "shipping_zip_code",
]


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def discount(offers: Mapping[str, float] = OFFERS) -> Column:
    """Rate of the first offer column that reads as true, else 0.

    Kept in double: a 4-byte rate shifts the third decimal of the total price.
    """
    # A set test, not a cast: a cast to boolean fails row by row on other texts.
    rates = [
        F.when(F.lower(F.trim(F.col(flag))).isin(*TRUE_TEXTS), F.lit(float(rate)))
        for flag, rate in offers.items()
    ]
    return F.coalesce(*rates, F.lit(0.0))


def state_name(state: Column | str, states: Mapping[str, str] = STATES) -> Column:
    """Full state name; a value that is no known code stays as it is."""
    state = _col(state)
    pairs = [F.lit(text) for pair in states.items() for text in pair]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), state), state)


def address_parts(
    address: Column | str = "shipping_address", states: Mapping[str, str] = STATES
) -> list[Column]:
    """street, city, state (as full name) and zip of ``street/city/state/zip``.

    Parts that are not there come out null.
    """
    pieces = F.split(_col(address), "/")
    parts = [F.get(pieces, F.lit(i)) for i in range(len(ADDRESS_PARTS))]
    parts[2] = state_name(parts[2], states)
    return [part.alias(name) for part, name in zip(parts, ADDRESS_PARTS)]


def full_name(first: Column | str, last: Column | str) -> Column:
    """``first last``; null as soon as either is null."""
    return F.concat(_col(first), F.lit(" "), _col(last))


def email(address: Column | str, mode: str = "lenient") -> Column:
    """Cleaned e-mail address.

    ``lenient``  drop all white space, put ``.com`` in place of the last label;
                 anything without ``@`` and a dot after it stays.
    ``strict``   trim, put ``com`` after the last dot, keep the address at the
                 start of the text, null when there is none.
    ``validate`` as strict, but the last label is left alone.
    """
    address = _col(address)
    if mode == "lenient":
        compact = F.regexp_replace(address, r"\s+", "")
        # Without an @ nothing can match, which the pattern finds out in quadratic time only.
        relabelled = F.regexp_replace(compact, r"(.+@.+)\.[^.]+", "$1.com")
        return F.when(address.contains("@"), relabelled).otherwise(compact)
    if mode not in ("strict", "validate"):
        raise ValueError(f"unknown e-mail mode: {mode}")
    text = F.regexp_replace(address, r"^\s+|\s+$", "")
    if mode == "strict":
        text = F.concat(F.regexp_extract(text, r"(?s)^(.*\.)", 1), F.lit("com"))
    found = F.regexp_extract(text, f"^({ADDRESS})", 1)
    return F.nullif(found, F.lit(""))


def transaction_id(value: Column | str) -> Column:
    """``trx-`` and the digits of ``value``; null when it has no digit."""
    digits = F.nullif(F.regexp_replace(_col(value), r"\D+", ""), F.lit(""))
    return F.concat(F.lit("trx-"), digits)


def unit_price(price: Column | str) -> Column:
    """Price without its sign."""
    return F.abs(_col(price))


def total_price(
    units: Column | str, price: Column | str, rate: Column | str, decimals: int | None = 3
) -> Column:
    """units x price x (1 - discount); ``decimals=None`` leaves it unrounded."""
    amount = _col(units) * _col(price) * (F.lit(1) - _col(rate))
    return amount if decimals is None else F.round(amount, decimals)


def whole_number(value: Column | str) -> Column:
    """Text or number to long, also when written as ``3.0``; null if it is neither."""
    value = _col(value)
    # The direct cast first: a double holds only 15 digits of an id exactly.
    return F.coalesce(value.try_cast("bigint"), value.try_cast("double").try_cast("bigint"))


def digits(value: Column | str, prefix: str = "") -> Column:
    """First run of digits after ``prefix`` as an integer, null if there is none."""
    return F.nullif(F.regexp_extract(_col(value), prefix + r"(\d+)", 1), F.lit("")).cast("int")

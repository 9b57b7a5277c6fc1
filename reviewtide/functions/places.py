"""Features of a place."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# A US address ends in a state code and a five-digit postcode.
US_ENDING = r"^([A-Z]{2})\s([0-9]{5})"
ADDRESS_PART = ", "
USA = "USA"


def _us_ending(address: Column, group: int) -> Column:
    # try_element_at: an empty array gives null instead of an error.
    last = F.try_element_at(address, F.lit(-1))
    ending = F.substring_index(last, ADDRESS_PART, -1)
    return F.nullif(F.regexp_extract(ending, US_ENDING, group), F.lit(""))


def state(address: Column) -> Column:
    return _us_ending(address, 1)


def postcode(address: Column) -> Column:
    return _us_ending(address, 2)


def country(state_code: Column) -> Column:
    return F.when(state_code.isNotNull(), F.lit(USA))


def address_text(address: Column) -> Column:
    """Joined by bare commas; null parts are skipped, a null array gives ''."""
    return F.concat_ws(",", address)


def price_level(price: Column) -> Column:
    """The number of currency signs."""
    return F.length(price)

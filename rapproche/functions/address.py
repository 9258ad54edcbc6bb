"""Cutting free-text French addresses into parts, as column expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rapproche.config import Parity
from rapproche.functions import text as T

# Street-type abbreviations and their long forms.
STREET_TYPES = {
    "r": "rue",
    "rte": "rue",
    "av": "avenue",
    "crs": "cours",
    "che": "chem",
    "esp": "esplanade",
}


def join_street(street_type: Column, street_name: Column) -> Column:
    """Type and name with one blank between, also where either is empty."""
    return F.concat(T.null_to_empty(street_type), F.lit(" "), T.null_to_empty(street_name))


def expand_street_types(address: Column, at_word_start: bool = False) -> Column:
    """Replace each abbreviation found by its long form.

    Each abbreviation is searched in the address as given, and the text found is replaced wherever it occurs.
    By default the end of a longer word counts too, as in 'Victor Hugo'.
    """
    lead = r"(?:^|\s)" if at_word_start else r"(?:\s?|^[A-Za-z])"

    capitals = F.upper(T.blanks(address))

    def expand(result: Column, item: tuple[str, str]) -> Column:
        abbreviation, long_form = item
        # The plain search settles most rows before a pattern is tried; an empty find replaces nothing.
        possible = capitals.contains(f"{abbreviation.upper()} ")
        found = F.when(possible, F.regexp_extract(address, f"(?iuU){lead}{abbreviation}\\s", 0)).otherwise("")
        return F.replace(result, found, F.lit(f" {long_form} "))

    return reduce(expand, STREET_TYPES.items(), address)


def remove_acronyms(address: Column) -> Column:
    return T.remove_pattern(address, T.ACRONYM)


def split_comma_address(address: Column) -> Column:
    """struct(city, postal_code, rest) of an address with a comma: city and code follow the last one."""
    tail = T.strip(F.substring_index(address, ",", -1))
    postal_code = F.regexp_extract(tail, T.POSTAL_CODE, 0)
    city = F.replace(tail, postal_code, F.lit(""))
    rest = T.strip(F.replace(F.replace(address, tail, F.lit("")), F.lit(","), F.lit("")))
    return F.struct(city.alias("city"), postal_code.alias("postal_code"), rest.alias("rest"))


def trailing_city(address: Column) -> Column:
    """The run of words in capitals at the end, '' if none."""
    found = F.regexp_extract(F.reverse(address), f"^{T.CAPITAL_RUN}", 0)
    return T.strip(F.upper(F.reverse(found)))


def trailing_postal_code(rest: Column) -> Column:
    """Three or more digits at the end, read backwards."""
    return F.regexp_extract(F.reverse(rest), f"^{T.POSTAL_CODE}", 0)


def split_plain_address(address: Column, fix_postal_code: bool = False) -> Column:
    """struct(city, postal_code, rest) of an address without a comma: capitals at the end are the city."""
    city = trailing_city(address)
    rest = F.when(city != "", T.strip(F.replace(address, city, F.lit("")))).otherwise(address)
    code = trailing_postal_code(rest)
    if fix_postal_code:
        code, rest = F.reverse(code), F.substring(rest, F.lit(1), F.length(rest) - F.length(code))
    return F.struct(city.alias("city"), code.alias("postal_code"), T.strip(rest).alias("rest"))


def leading_street_number(rest: Column) -> Column:
    """First digit run, '' when it ends in the second half of the text."""
    number = F.regexp_extract(rest, T.DIGITS, 0)
    end = F.length(F.regexp_extract(rest, r"(?U)^\D*\d+", 0))
    return F.when(end * 2 >= F.length(rest), F.lit("")).otherwise(number)


def remove_street_number(rest: Column, number: Column) -> Column:
    return T.strip(F.replace(rest, number, F.lit("")))


def split_address(df: DataFrame, source: str, parity: Parity = Parity()) -> DataFrame:
    """Cut the free-text column ``source`` into city, postal_code, street_number and address, each '' where absent.

    The steps stand in projections of their own, so that each is computed once per row.
    """
    text = T.null_to_empty(F.col(source))
    if parity.remove_acronyms:
        text = T.strip(remove_acronyms(text))
    kept = [c for c in df.columns if c not in (source, "city", "postal_code", "street_number", "address")]
    parts = F.when(F.col("_text").contains(","), split_comma_address(F.col("_text"))).otherwise(
        split_plain_address(F.col("_text"), parity.fix_trailing_postal_code)
    )
    number = leading_street_number(F.col("_parts.rest"))
    rest = remove_street_number(F.col("_parts.rest"), F.col("street_number"))
    street = T.strip(expand_street_types(F.col("_rest"), parity.street_type_at_word_start))
    return (
        df.select(*kept, text.alias("_text"))
        .select(*kept, parts.alias("_parts"))
        .select(*kept, "_parts", number.alias("street_number"))
        .select(*kept, "_parts", "street_number", rest.alias("_rest"))
        .select(
            *kept,
            F.col("_parts.city").alias("city"),
            F.col("_parts.postal_code").alias("postal_code"),
            "street_number",
            street.alias("address"),
        )
    )


def canonical_postal_code(code: Column) -> Column:
    """Digits as an integer is written ('01000' is '1000', '1e5' is '100000'); anything else as it is."""
    power = F.when(code.rlike("^[0-9]+e[0-9]{1,2}$"), code.try_cast("double"))
    whole = F.when(power < F.lit(2.0**63), power.try_cast("bigint"))
    return F.coalesce(F.when(code.rlike("^[0-9]+$"), code.try_cast("bigint")), whole).cast("string")


def stored_postal_code(code: Column, keep_text: bool = False) -> Column:
    return code if keep_text else F.coalesce(canonical_postal_code(code), code)

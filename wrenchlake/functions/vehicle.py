"""Chassis code and product text to model, plant and build date."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

from wrenchlake.functions import fixed_values as fixed


def lookup(table: dict, key: Column) -> Column:
    """Value of a small literal map, NULL where the key is absent."""
    literal = F.create_map(*[F.lit(v) for v in chain.from_iterable(table.items())])
    return F.try_element_at(literal, key)


def model_token(product: Column) -> Column:
    """Leading word of the product, cut at a comma, digit or hyphen, with three spellings unified."""
    word = F.regexp_extract(F.upper(F.coalesce(product, F.lit(""))), r"(?U)^\s*([^\s,\d\-]*)", 1)
    return (
        F.when(word.contains("CONTINENTAL"), F.lit("CONTINENTAL"))
        .when(word.isin("CL", "SIGNALS"), F.lit("CLASSIC"))
        .otherwise(word)
    )


def model_word(product: Column) -> Column:
    """The warehouse spelling of the model rule: first blank-separated word, else first run of letters."""
    upper = F.upper(product)
    word = F.split(upper, " ")[0]
    letters = F.get(F.regexp_extract_all(upper, F.lit("[a-zA-Z]+"), F.lit(0)), F.lit(0))
    return (
        F.when(word.isNull(), F.lit(fixed.UNKNOWN))
        .when(word.contains("CONTINENTAL"), F.lit("CONTINENTAL"))
        .when(word.isin("CL", "SIGNALS"), F.lit("CLASSIC"))
        .when(word.contains("HIMALAYAN"), F.lit("HIMALAYAN"))
        .when(word.contains("INTERCEPTOR"), F.lit("INTERCEPTOR"))
        .otherwise(letters)
    )


def chassis_slices(chassis: Column) -> dict[str, Column]:
    """The five coded characters; empty text for a missing or short chassis."""
    code = F.upper(F.coalesce(chassis, F.lit("")))
    positions = {"platform": 4, "displacement": 5, "ninth": 9, "year": 10, "eleventh": 11}
    return {name: F.substring(code, at, 1) for name, at in positions.items()}


def is_decodable(chassis: Column, product: Column) -> Column:
    return (F.coalesce(F.length(chassis), F.lit(0)) == fixed.CHASSIS_LENGTH) & (
        F.coalesce(F.length(product), F.lit(0)) > 0
    )


def model_type(platform: Column, product: Column, decodable: Column) -> Column:
    """Platform family; NA when chassis or product cannot be read."""
    return (
        F.when(~decodable, F.lit(fixed.UNKNOWN))
        .when((platform == "J") & F.upper(product).contains("CLASSIC"), F.lit("NEW CLASSIC"))
        .when(platform == "J", F.lit("METEOR"))
        .otherwise(F.coalesce(lookup(fixed.MODEL_TYPES, platform), F.lit(fixed.UNKNOWN)))
    )


def model(token: Column, platform: Column, product: Column, decodable: Column) -> Column:
    renamed = decodable & (platform == "J") & F.upper(product).contains("CLASSIC")
    return F.when(renamed, F.lit("NEW CLASSIC")).otherwise(token)


def model_name(model_: Column, displacement: Column) -> Column:
    size = lookup(fixed.DISPLACEMENTS, displacement)
    return F.coalesce(F.concat(model_, F.lit(" "), size), F.lit(fixed.UNKNOWN))


def _by_platform(platform: Column, older: Column, newer: Column) -> Column:
    # Older platforms (U, D) put the plant first and the month last; P and J swap them.
    return F.when(platform.isin("U", "D"), older).when(platform.isin("P", "J"), newer)


def plant(platform: Column, ninth: Column, eleventh: Column) -> Column:
    digit = _by_platform(platform, ninth, eleventh)
    return F.coalesce(lookup(fixed.PLANTS, digit), F.lit(fixed.UNKNOWN))


def mfg_month(platform: Column, ninth: Column, eleventh: Column) -> Column:
    letter = _by_platform(platform, eleventh, ninth)
    return F.coalesce(lookup(fixed.MFG_MONTHS, letter), F.lit(fixed.UNKNOWN_MONTH)).cast("bigint")


def mfg_year(letter: Column) -> Column:
    return F.coalesce(lookup(fixed.MFG_YEARS, letter), F.lit(fixed.UNKNOWN_YEAR)).cast("bigint")


def country(displacement: Column) -> Column:
    domestic = displacement.isin(*fixed.DISPLACEMENTS)
    return F.when(domestic, F.lit("Domestic")).otherwise(F.lit("International"))

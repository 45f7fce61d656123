"""Country and continent from a free-text location."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from threadloom import rules
from threadloom.functions.binding import constant, let
from threadloom.functions.matcher import first_contained
from threadloom.functions.regex import to_java
from threadloom.functions.text import normalize_text

MAX_PLACES = 10_000
UNKNOWN = ("unknown", "Unknown")
_USA, _GEORGIA = ("usa", "North America"), ("georgia", "Asia")


def place_table(cities: Mapping[str, Sequence[str]] | None = None) -> list[tuple[str, str, str]]:
    """(keyword, country, continent) in priority order, built by rule.

    A country is found by its name, its aliases and the given ``cities``; countries
    go by name ("usa" is filed as "united states").  A country outside the continent
    table gets continent ``Unknown``.
    """
    continents = {c: k for k, names in rules.COUNTRIES_BY_CONTINENT.items() for c in names}
    cities = cities or {}
    countries = sorted({*continents, *rules.COUNTRY_ALIASES, *cities},
                       key=lambda c: "united states" if c == "usa" else c)
    return place_table_from(
        {c: [c, *rules.COUNTRY_ALIASES.get(c, []), *cities.get(c, [])] for c in countries}, continents)


def place_table_from(keywords: Mapping[str, Sequence[str]],
                     continents: Mapping[str, str]) -> list[tuple[str, str, str]]:
    """The same from a full dictionary: country to keywords, in the order to be tried."""
    return [(kw, country, continents.get(country, UNKNOWN[1]))
            for country, words in keywords.items() for kw in words]


def read_place_table(df: DataFrame) -> list[tuple[str, str, str]]:
    """The same from a table (priority, keyword, country, continent).

    The table becomes a literal of every task, so it has to be a dictionary of
    names, not data that grows with the users.
    """
    rows = df.orderBy("priority").select("keyword", "country", "continent").limit(MAX_PLACES + 1).collect()
    if len(rows) > MAX_PLACES:
        raise ValueError(f"more than {MAX_PLACES} places")
    return [tuple(r) for r in rows]


def country_and_continent(location: Column, places: Sequence[tuple[str, str, str]] | None = None) -> Column:
    """Struct (country, continent) of a normalised location (see ``normalized_location``).

    First hit wins: "georgia, usa"; a two-letter state code after the first comma
    that is followed by two letters; a state name anywhere; a Georgian city; the
    first place keyword that occurs.  Everything is evaluated within the row: no
    join, so no shuffle and no hot location.  All keywords are searched for in one
    walk over the text (see ``functions.matcher``), so a longer table costs nothing more.
    """
    places = places if places is not None else place_table()
    return let(location, lambda text: _place(text, places))


def _place(location: Column, places: Sequence[tuple[str, str, str]]) -> Column:
    code = F.upper(F.regexp_extract(location, to_java(r",\s*([a-z]{2})\b"), 1))
    is_usa = location.rlike(to_java(r"\bgeorgia[, ]+usa\b")) | F.array_contains(constant(rules.US_STATE_CODES, "array<string>"), code)
    # States and Georgian cities come before all places, so one search for the first keyword decides.
    named = [*[(s, *_USA) for s in rules.US_STATES], *[(c, *_GEORGIA) for c in rules.GEORGIA_CITIES], *places]
    table = constant([{"country": c, "continent": n} for _, c, n in named], "array<struct<country:string,continent:string>>")
    hit = F.get(table, first_contained(location, [k for k, _, _ in named]))

    def place(country: str, continent: str) -> Column:
        return F.struct(F.lit(country).alias("country"), F.lit(continent).alias("continent"))

    return (
        F.when(location == "", place(*UNKNOWN))
        .when(is_usa, place(*_USA))
        .otherwise(F.coalesce(hit, place(*UNKNOWN))))


def location_text(location: Column) -> Column:
    """Location with an empty bio appended, as the rules expect it."""
    return F.concat(F.coalesce(location, F.lit("")), F.lit(" "))


def normalized_location(location: Column) -> Column:
    return normalize_text(location_text(location))

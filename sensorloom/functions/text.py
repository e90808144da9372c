"""Text expressions."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from sensorloom import settings

# What a station name tells about its surroundings, first match wins.
RURAL_WORDS = ["rural", "rambouillet"]
OBSERVATION_WORDS = ["tour eiffel"]
ROAD_PATTERN = r"\b(boulevard|avenue|place|rue|quai|autoroute|route|rn\s?\d|rd\s?\d)"

# Accented letters and their plain form.
ACCENTED = "éèêàâôûîç"
PLAIN = "eeeaaouic"


def station_type(name: Column) -> Column:
    """Classify a station by its name."""
    lowered = F.lower(name)

    def any_word(words):
        hit = lowered.contains(words[0])
        for word in words[1:]:
            hit = hit | lowered.contains(word)
        return hit

    return (
        F.when(any_word(RURAL_WORDS), "rural")
        .when(any_word(OBSERVATION_WORDS), "observation")
        .when(lowered.rlike(ROAD_PATTERN), "traffic")
        .otherwise("urban_background")
    )


def normalise(text: Column) -> Column:
    """Lower case, accents off, quotes and spaces to underscores."""
    return F.translate(F.trim(F.translate(F.lower(text), ACCENTED, PLAIN)), "' ", "__")


def normalise_header(name: str) -> str:
    """B12 for a column name."""
    plain = name.lower().translate(str.maketrans(ACCENTED, PLAIN)).strip()
    return plain.translate(str.maketrans("' ", "__"))


def harmonise(value: Column, mapping: Mapping[str, str]) -> Column:
    """Known spellings to one value; an unknown one becomes NULL."""
    result = None
    for spelling, target in mapping.items():
        result = (F if result is None else result).when(value == spelling, target)
    return result


def replace_known(value: Column, mapping: Mapping[str, str]) -> Column:
    """Known spellings to one value; the others stay."""
    return F.coalesce(harmonise(value, mapping), value)


def flag_from_text(value: Column) -> Column:
    """true/false as text or boolean -> 1/0, anything else NULL."""
    lowered = F.lower(value.cast("string"))
    return F.when(lowered == "true", 1).when(lowered == "false", 0)


def geo_level(code: Column) -> Column:
    """0 is the region, up to two digits a department, longer a municipality."""
    return (
        F.when(code == 0, "region")
        .when(F.length(code.cast("string")) <= 2, "department")
        .otherwise("municipality")
    )


def contains_ignoring_case(text: Column, part: str) -> Column:
    """C5 on plain codes: literal substring, case ignored."""
    return F.lower(text).contains(part.lower())


def collated(text: Column, collation: str = settings.COLLATION) -> Column:
    """The text under a collation; equality, grouping, joins, order and substrings then follow it.

    The default ignores case and accents, as the database's does.
    """
    return F.collate(text, collation)


def contains_text(text: Column, part: str, collation: str = settings.COLLATION) -> Column:
    """Literal substring under the collation; the empty text is in every text."""
    return F.contains(collated(text, collation), collated(F.lit(part), collation))

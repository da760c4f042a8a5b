"""Canonical city and region names."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

# Canonical name -> lower-cased spellings that map to it.
CITY_VARIANTS = {
    "Copenhagen": ["copenhagen", "københavn", "kobenhavn", "cph"],
    "Aarhus": ["aarhus", "århus"],
    "Odense": ["odense"],
    "Aalborg": ["aalborg", "ålborg"],
    "Esbjerg": ["esbjerg"],
    "Randers": ["randers"],
    "Kolding": ["kolding"],
    "Horsens": ["horsens"],
    "Vejle": ["vejle"],
    "Roskilde": ["roskilde"],
    "Herning": ["herning"],
    "Helsingør": ["helsingør", "helsingor", "elsinore"],
    "Silkeborg": ["silkeborg"],
    "Næstved": ["næstved", "naestved"],
    "Fredericia": ["fredericia"],
    "Viborg": ["viborg"],
    "Køge": ["køge", "koge"],
    "Høje-Taastrup": ["taastrup", "høje-taastrup", "hoeje-taastrup"],
}

# Canonical region -> lower-cased spellings that map to it.
REGION_VARIANTS = {
    "Capital Region": ["capital region", "capital region of denmark", "hovedstaden", "region hovedstaden"],
    "Central Denmark Region": ["central denmark region", "central jutland", "midtjylland", "region midtjylland"],
    "North Denmark Region": ["north denmark region", "north jutland", "nordjylland", "region nordjylland"],
    "Region of Southern Denmark": ["region of southern denmark", "southern denmark", "syddanmark",
                                   "region syddanmark"],
    "Region Zealand": ["zealand", "sjælland", "sjaelland", "region sjælland", "region sjaelland"],
}


def canonicalize(c, variants: dict[str, list[str]]) -> Column:
    """Map ``lower(c)`` through a variant dictionary; unknown values pass unchanged.

    The dictionary becomes one literal map expression (a hash lookup per row,
    inside codegen). A dictionary of millions of entries would instead be a
    broadcast lookup table joined on the lower-cased key.
    """
    c = F.col(c) if isinstance(c, str) else c
    lookup = F.create_map(*chain.from_iterable(
        (F.lit(v), F.lit(canon)) for canon, vs in variants.items() for v in vs))
    return F.coalesce(lookup[F.lower(c)], c)


def canonical_city(c) -> Column:
    return canonicalize(c, CITY_VARIANTS)


def canonical_region(c) -> Column:
    return canonicalize(c, REGION_VARIANTS)

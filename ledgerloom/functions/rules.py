"""Classification rules, written as CASE expressions over the fixed word lists."""

from __future__ import annotations

import re

from pyspark.sql import Column, functions as F

from ledgerloom import fixed_values as fixed
from ledgerloom.functions.clean import stripped

MULTILATERAL, BILATERAL, NGO, OTHER = "Multilatéral", "Bilatéral", "ONG", "Autre"
UNKNOWN, MIXED, GRANT, LOAN = "Inconnu", "Mixte", "Don", "Prêt"


def shortest_terms(terms: list[str]) -> list[str]:
    """Terms that hold no other term: a text with a longer one holds the shorter one too."""
    lowered = list(dict.fromkeys(t.lower() for t in terms))
    return [t for t in lowered if not any(o != t and o in t for o in lowered)]


def mentions(text: Column, terms: list[str], match: str = "substring") -> Column:
    """Does the text name one of the terms, in any case?

    ``substring`` is the published rule, under which "Foundation" mentions "UN";
    ``word`` accepts whole words only.
    """
    if match == "substring":
        pattern = "|".join(re.escape(t) for t in shortest_terms(terms))
    elif match == "word":
        alternatives = "|".join(re.escape(t.lower().strip()) for t in terms)
        pattern = rf"(?U)\b(?:{alternatives})\b"
    else:
        raise ValueError(f"unknown match: {match}")
    return F.lower(text).rlike(pattern)


def literal_map(block: str) -> Column:
    items = [F.lit(part) for pair in fixed.pairs(block) for part in pair]
    return F.create_map(*items)


def funder_country(ref: Column, name: Column, match: str = "substring") -> Column:
    """Donor country, or the class itself for donors that are not a country.

    The first rule that applies decides: known multilateral name, multilateral reference,
    country reference, charity keyword.
    """
    ref = stripped(F.coalesce(ref, F.lit("")))
    name = stripped(F.coalesce(name, F.lit("")))
    by_prefix = F.try_element_at(
        literal_map(fixed.BILATERAL_PREFIXES), F.upper(F.substring(ref, 1, 3))
    )
    multilateral_ref = F.lit(False)
    for prefix in fixed.MULTILATERAL_REF_PREFIXES:
        multilateral_ref = multilateral_ref | ref.startswith(prefix)
    return (
        F.when(mentions(name, fixed.words(fixed.MULTILATERAL_NAMES), match), MULTILATERAL)
        .when(multilateral_ref, MULTILATERAL)
        .when(by_prefix.isNotNull(), by_prefix)
        .when(mentions(name, fixed.words(fixed.NGO_KEYWORDS), match), NGO)
        .otherwise(OTHER)
    )


def funder_type(country: Column) -> Column:
    """Donor class of what :func:`funder_country` gave."""
    return F.when(country.isin(MULTILATERAL, NGO, OTHER), country).otherwise(BILATERAL)


def code_tokens(codes: Column) -> Column:
    """Single codes of a comma-joined text; no codes at all give an empty list."""
    tokens = F.transform(F.split(codes, ","), stripped)
    return F.when(F.coalesce(codes, F.lit("")) == "", F.array().cast("array<string>")).otherwise(tokens)


def financing_instrument(tokens: Column) -> Column:
    """Grant, loan, both or other, from the finance codes of an activity."""
    grant = F.arrays_overlap(tokens, F.lit(fixed.GRANT_CODES))
    loan = F.arrays_overlap(tokens, F.lit(fixed.LOAN_CODES))
    return (
        F.when(F.size(tokens) == 0, UNKNOWN)
        .when(grant & loan, MIXED)
        .when(grant, GRANT)
        .when(loan, LOAN)
        .otherwise(OTHER)
    )


def flow_name(code: Column) -> Column:
    return F.when(code == "X", "Export").otherwise("Import")


def is_section_code(code: Column) -> Column:
    """Customs sections start with a digit, other product groupings do not."""
    return F.coalesce(code.rlike(r"^\p{Nd}"), F.lit(False))


def code_label_text(codes: Column, labels: Column) -> Column:
    """``code_label, ...`` of two comma-joined lists; the labels alone if lengths differ."""
    code_items = F.transform(F.split(codes, ","), stripped)
    label_items = F.transform(F.split(labels, ","), stripped)
    zipped = F.zip_with(code_items, label_items, lambda c, l: F.concat(c, F.lit("_"), l))
    return (
        F.when(codes.isNull() | labels.isNull(), F.lit(None).cast("string"))
        .when(F.size(code_items) != F.size(label_items), labels)
        .otherwise(F.array_join(zipped, ", "))
    )

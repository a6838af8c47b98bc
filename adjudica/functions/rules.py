"""Classification and naming rules."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, functions as F

from adjudica.functions.typing import whole_number

# Labels, legal forms and company numbers of the published categories.
WORKS = "Travaux"
SUPPLIES = "Fournitures"
SERVICES = "Services"
UNCLASSIFIED = "Non catégorisé"
LEGAL_FORM_PREFIX = {"État": "71", "Groupement de communes": "734"}
LEGAL_FORMS = {
    "EPIC": ("4140", "4110", "4120"),
    "Commune": ("7210", "7312"),
    "Syndicat mixte": ("7354", "7355"),
    "Département": ("7220",),
    "Département outre-mer": ("7225",),
    "Région": ("7230",),
    "Établissement hospitalier": ("7364",),
}
PARIS = "217500016"
CATEGORY_BY_COMPANY = {
    "217500016": "Commune",
    "200046977": "Groupement de communes",
    "200076958": "Région",
    "200052678": "Département outre-mer",
    "200055507": "Département outre-mer",
    "229850003": "Département outre-mer",
    "229840004": "Département outre-mer",
}
PRIVATE_STATUS = "P"
PRIVATE_NAME = "[Données personnelles non-diffusibles]"


def first_match(cases: list[tuple[Column, Column]]) -> Column:
    """Value of the first condition that holds, else null."""
    (condition, value), *others = cases
    return reduce(lambda acc, case: acc.when(*case), others, F.when(condition, value))


def contract_type(product: Column) -> Column:
    """Works, supplies or services, from the two-digit division of the product code."""
    division = whole_number(F.substring(product, 1, 2), "tinyint")
    return (
        F.when(division == 45, F.lit(WORKS))
        .when(division.between(1, 44) | (division == 48), F.lit(SUPPLIES))
        .when(division.between(50, 98), F.lit(SERVICES))
        .otherwise(F.lit(UNCLASSIFIED))
    )


def buyer_category(legal_form: Column, buyer_id: Column) -> Column:
    """Category from the legal form; some buyers have one by company number.

    A company rule fills a missing category. Only the first of them also replaces a present one.
    """
    form = legal_form.cast("string")
    rules = [(form.startswith(start), F.lit(name)) for name, start in LEGAL_FORM_PREFIX.items()]
    rules += [(form.isin(*forms), F.lit(name)) for name, forms in LEGAL_FORMS.items()]
    by_company = [(buyer_id.startswith(no), F.lit(name)) for no, name in CATEGORY_BY_COMPANY.items()]
    return F.when(buyer_id.startswith(PARIS), F.lit(CATEGORY_BY_COMPANY[PARIS])).otherwise(
        F.coalesce(first_match(rules), first_match(by_company))
    )


def company_name(legal_name: Column, first_name: Column, family_name: Column, used_name: Column, status: Column) -> Column:
    """Display name: a person's first and used family name, else the legal name; hidden if private."""
    surname = F.coalesce(used_name, family_name)
    person = F.concat(first_name, F.lit(" "), surname)
    return (
        F.when(status == PRIVATE_STATUS, F.lit(PRIVATE_NAME)).when(surname.isNotNull(), person).otherwise(legal_name)
    )


def with_site_name(name: Column, site: Column) -> Column:
    """Site name in parentheses after the company name, unless it is the same."""
    return F.when(site != name, F.concat(name, F.lit(" ("), site, F.lit(")"))).otherwise(name)

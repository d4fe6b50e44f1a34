"""Column-name rules: raw camelCase headers to snake_case, typed graph headers."""

from __future__ import annotations

import re

_BOUNDARY = re.compile(r"(?<=[a-z0-9])(?=[A-Z])|(?<=[A-Z])(?=[A-Z][a-z])")


def camel_to_snake(name: str) -> str:
    """``statutDiffusionUniteLegale`` -> ``statut_diffusion_unite_legale``.

    Digits stay glued to the word before them (``prenom1UniteLegale`` ->
    ``prenom1_unite_legale``) and acronyms form one word
    (``activitePrincipaleNAF25UniteLegale`` -> ``activite_principale_naf25_unite_legale``).
    """
    return _BOUNDARY.sub("_", name).lower()


def graph_id(name: str, label: str) -> str:
    """Header of a node id column, e.g. ``siret:ID(Etablissement)``."""
    return f"{name}:ID({label})"


def graph_start(label: str) -> str:
    return f":START_ID({label})"


def graph_end(label: str) -> str:
    return f":END_ID({label})"


def typed(name: str, type_name: str) -> str:
    """Header of a typed property column, e.g. ``montant:double``."""
    return f"{name}:{type_name}"

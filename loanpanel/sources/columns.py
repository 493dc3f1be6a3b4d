"""The column model: canonical names and how they are found in file headers."""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Canonical name and the token that marks the column in a file
# header. The readable part of a header changes from year to year.
LOAN_TOKENS = {
    "statement": "ZC_VYKAZ",
    "statement_table": "ZC_VTAB",
    "fiscal_period": "0FISCPER",
    "muni_id": "ZC_UCJED",
    "borrower_ico": "ZC_ICO:ZC_ICO",
    "lender_ico": "ZC_PARTP:ZC_PARTP",
    "lender_name": "ZC_NAZPOS:ZC_NAZPOS",
    "kind": "ZC_URCN",
    "purpose": "ZC_UCFP:ZC_UCFP",
    "currency": "0CURRENCY",
    "rate_text": "ZC_URSA:ZC_URSA",
    "signed_on": "ZC_DATUS:ZC_DATUS",
    "matures_on": "ZC_TERSPL:ZC_TERSPL",
    "security": "ZC_ZPRU",
    "agreed_amount": "ZU_VYUV",
    "drawn_amount": "ZU_CEUV",
    "repaid_principal": "ZU_SPJUV",
    "paid_interest": "ZU_ZAPUP",
}

# Columns added by the registry lookup.
REGISTRY_TOKENS = {
    "registry_name": "ARES_Nazev_subjektu",
    "form_code": "ARES_Pravni_Forma_Kod",
    "form_official": "ARES_Pravni_Forma_Oficialni",
    "form_group": "ARES_Pravni_Forma_Skupina",
    "form_abbr": "ARES_Pravni_Forma_Zkratka",
}

# Without these a file cannot be keyed.
REQUIRED = (
    "muni_id", "borrower_ico", "lender_ico", "lender_name", "purpose",
    "signed_on", "matures_on", "agreed_amount", "drawn_amount",
)

BOOKKEEPING = ("source_file", "year", "pos")


class MissingColumns(ValueError):
    """A file lacks columns the panel cannot do without."""


def normalise_header(name: str) -> str:
    """No quotes, no outer blanks, single blanks inside."""
    return re.sub(r"\s+", " ", name.replace('"', "").strip())


def normalise_headers(names: Iterable[str]) -> list[str]:
    """Normalised names; a repeated name gets .1, .2, ..."""
    seen: dict[str, int] = {}
    result = []
    for name in map(normalise_header, names):
        n = seen.get(name, 0)
        seen[name] = n + 1
        result.append(f"{name}.{n}" if n else name)
    return result


def find_column(names: Iterable[str], token: str) -> str | None:
    """First name that contains the token."""
    return next((name for name in names if token in name), None)


def to_canonical(df: DataFrame, required: Iterable[str] = REQUIRED, extra: Iterable[str] = ()) -> DataFrame:
    """Select the panel's columns by token. An absent optional column becomes
    NULL, absent required ones raise and are all named. ``extra`` columns are
    kept as they are."""
    tokens = LOAN_TOKENS | {
        name: token for name, token in REGISTRY_TOKENS.items() if find_column(df.columns, token)
    }
    found = {name: find_column(df.columns, token) for name, token in tokens.items()}
    absent = sorted(name for name in required if found[name] is None)
    if absent:
        raise MissingColumns("no column for " + ", ".join(absent))
    kept = [F.col(name) for name in (*BOOKKEEPING, *extra) if name in df.columns]
    return df.select(
        *kept,
        *(
            (F.col(f"`{column}`") if column else F.lit(None).cast("string")).alias(name)
            for name, column in found.items()
        ),
    )

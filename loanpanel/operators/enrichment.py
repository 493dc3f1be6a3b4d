"""Lenders resolved against a registry snapshot and the legal-form codelist."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import registry_key
from ..sources.scratch import cut
from .lookup import lookup

# Outcomes of a lookup that found nothing.
INVALID, NOT_FOUND, CONNECTION_ERROR = "Invalid ICO", "Not Found", "Connection Error"
MISSING_STATUSES = (NOT_FOUND, INVALID, CONNECTION_ERROR)

# Short names of common legal forms, and what stands for an
# empty or an unknown form.
FORM_ABBREVIATIONS = {
    "101": "f.o.", "102": "f.o.", "111": "v.o.s.", "112": "s.r.o.", "121": "a.s.",
    "205": "družstvo", "331": "p.o.", "332": "státní p.o.", "706": "z.s.", "771": "s.o.",
    "801": "obec", "804": "kraj", "811": "MČ / MO",
}
NO_FORM = "N/A"
UNKNOWN_OFFICIAL, UNKNOWN_GROUP, OTHER = "Neznámá forma", "Neznámá klasifikace", "jiná"


def form_abbreviation(code: Column) -> Column:
    names = F.create_map(*(F.lit(x) for pair in FORM_ABBREVIATIONS.items() for x in pair))
    return F.when(F.coalesce(code, F.lit("")) == "", NO_FORM).otherwise(
        F.coalesce(F.try_element_at(names, code), F.lit(OTHER))
    )


def codelist_by_code(codelist: DataFrame) -> DataFrame:
    """One row per form code; of several lines the last one counts."""
    return codelist.filter(F.col("code").isNotNull()).groupBy("code").agg(
        F.max_by("official", "line_no").alias("official"),
        F.max_by("form_group", "line_no").alias("form_group"),
    )


def registry_lookup(ids: DataFrame, registry: DataFrame, id_col: str = "lender_ico") -> DataFrame:
    """Registry name and form code for each ID; the name of an ID that is not
    in the registry is the status of its lookup. An ID that the registry
    repeats has its first entry by name and form. An optional column
    ``status`` holds the fault of a lookup that failed (``HTTP Error n``,
    ``Connection Error``), NULL where it did not."""
    key = registry_key(F.col(id_col))
    valid = (F.length("_key") == 8) & (F.col("_key") != "00000000")
    found = F.col("_ico").isNotNull()
    fault = F.col("status") if "status" in registry.columns else F.lit(None).cast("string")
    entry = F.struct(F.coalesce(fault, "name").alias("name"), F.when(fault.isNull(), F.col("form_code")).alias("form"))
    entries = registry.groupBy(F.col("ico").alias("_ico")).agg(F.min(entry).alias("_entry"))
    entries = entries.select("_ico", F.col("_entry.name").alias("_name"), F.col("_entry.form").alias("_form"))
    return (
        ids.withColumn("_key", key)
        .join(entries, valid & (F.col("_key") == F.col("_ico")), "left")
        .withColumns(
            {
                "registry_name": F.when(~valid, INVALID).when(found, F.col("_name")).otherwise(NOT_FOUND),
                "form_code": F.when(found, F.coalesce("_form", F.lit(""))).otherwise(""),
            }
        )
        .drop("_key", "_ico", "_name", "_form")
    )


def with_legal_form(df: DataFrame, codelist: DataFrame) -> DataFrame:
    """Official name, group and abbreviation of ``form_code``."""
    forms = codelist_by_code(codelist).withColumnsRenamed(
        {"code": "form_code", "official": "_official", "form_group": "_group"}
    )
    none = F.col("form_code") == ""
    return (
        df.join(forms, "form_code", "left")
        .withColumns(
            {
                "form_official": F.when(none, NO_FORM).otherwise(F.coalesce("_official", F.lit(UNKNOWN_OFFICIAL))),
                "form_group": F.when(none, NO_FORM).otherwise(F.coalesce("_group", F.lit(UNKNOWN_GROUP))),
                "form_abbr": form_abbreviation(F.col("form_code")),
            }
        )
        .drop("_official", "_group")
    )


def resolve_lenders(loans: DataFrame, registry: DataFrame, codelist: DataFrame) -> DataFrame:
    """One row per lender ID as filed, with registry columns and the number
    ``n`` of loans. Grouping first means a lender with very many loans is
    looked up once."""
    ids = loans.filter(F.col("lender_ico").isNotNull()).groupBy("lender_ico").agg(F.count("*").alias("n"))
    return with_legal_form(registry_lookup(ids, registry), codelist)


def enrich(loans: DataFrame, registry: DataFrame, codelist: DataFrame) -> DataFrame:
    """Add the registry columns to every loan."""
    lenders = cut(resolve_lenders(loans, registry, codelist))
    return lookup(loans, lenders, ["lender_ico"], weight="n")


def missing_ids(enriched: DataFrame, statuses: tuple[str, ...] = MISSING_STATUSES) -> DataFrame:
    """Distinct lender IDs of each file that the registry could not resolve."""
    return (
        enriched.filter(F.col("registry_name").isin(*statuses))
        .select("source_file", F.col("lender_ico").alias("missing_ico"), F.col("registry_name").alias("status"))
        .distinct()
    )

"""Typed sources: positions by era, safe typing, and the row rules of each source.

Every function takes raw rows (columns c0, c1, ... plus extract_year and, where it matters,
part) of any number of extract years at once, and returns typed rows with extract_year.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from annualis import codes
from annualis.functions import (
    attach_code, fill, null_if, plain_int, safe_int, strip, without_prefix,
)
from annualis.functions.text import ascii_row, plain_row, row_int, row_strip, strip_sql
from annualis.operators.keys import dedup_by_key, drop_conflicting_keys
from annualis.sources.naming import OPEN, PART_LIMITS, wanted_part

MONTHS = range(1, 13)
MEMBERS = range(2, 11)

# Episode fields by position; the text ones, all others are integers.
EPISODE_FIELDS = [
    "person_id", "contribution_regime", "contribution_group", "contract_type", "ptcoef",
    "entry_date", "exit_date", "reason_dismissal", "disability", "firm_cc2", "firm_muni",
    None,  # industry, see below
    "firm_workers", "firm_age", "job_relationship", "firm_ett", "firm_jur_type",
    "firm_jur_status", "firm_id", "firm_cc", "firm_main_prov",
    "new_date_contract1", "prev_contract1", "prev_ptcoef1",
    "new_date_contract2", "prev_contract2", "prev_ptcoef2",
    "new_date_contribution_group", "prev_contribution_group",
]
EPISODE_TEXT_FIELDS = {
    "person_id", "firm_cc2", "firm_cc", "firm_jur_status", "new_date_contract1",
    "prev_contract1", "prev_ptcoef1", "new_date_contract2", "prev_contract2", "prev_ptcoef2",
    "new_date_contribution_group", "prev_contribution_group",
}
# Industry is position 11 in the classification of the time (1993 until the 2009
# extract, 2009 after), and from 2010 the 1993 code is repeated at position 29.
INDUSTRY_POSITION, OLD_INDUSTRY_POSITION, LAST_OLD_INDUSTRY_EXTRACT = 11, 29, 2009

# First monthly base, until and after the 2012 extract; regular and self-employed
# parts.
MONTH_START_UNTIL_2012, MONTH_START_AFTER_2012 = 8, 3
# (column prefix, test on the part)
BASES = {"regular": ("contribution_", "part BETWEEN 1 AND 12"),
         "autonomous": ("contribution_aut_", "part = 13")}

# Fields that a layout reads, by source, as (last extract, number of fields): shorter rows lack some.
FIELDS_READ = {"PERSONAL": [(OPEN, 10)], "CONVIVIR": [(OPEN, 21)],
               "AFILIAD": [(LAST_OLD_INDUSTRY_EXTRACT, 29), (OPEN, 30)],
               "COTIZA": [(2012, MONTH_START_UNTIL_2012 + 12), (OPEN, MONTH_START_AFTER_2012 + 12)],
               "FISCAL": [(2015, 9), (2016, 11), (OPEN, 12)], "PRESTAC": [(OPEN, 11)], "DIVISION": [(OPEN, 3)]}


def read_persons(raw: DataFrame, on_conflict: str = "drop") -> DataFrame:
    """Person records. Persons with conflicting records in an extract are dropped from it.

    The conflict test sees the record as delivered (stripped text), before codes are parsed.
    """
    df = raw.select(
        "extract_year",
        strip("c0").alias("person_id"),
        strip("c1").alias("birth_date"),
        safe_int("c2", "tinyint").alias("sex"),
        strip("c3").alias("nationality_text"),
        strip("c4").alias("birth_prov_text"),
        safe_int("c5", "int").alias("ss_reg_prov"),
        safe_int("c6", "int").alias("person_muni_latest"),
        strip("c7").alias("death_text"),
        strip("c8").alias("birth_country_text"),
        strip("c9").alias("edu_code"),
    )
    if on_conflict == "drop":
        df = drop_conflicting_keys(df, ["extract_year", "person_id"])

    def country(c):
        return null_if(plain_int(without_prefix(c)), 99)

    df = df.select(
        "extract_year", "person_id", "birth_date", "sex",
        F.coalesce(country("nationality_text"), country("birth_country_text"))
        .alias("nationality"),
        country("birth_country_text").alias("birth_country"),
        plain_int(without_prefix("birth_prov_text")).alias("birth_prov"),
        "ss_reg_prov", "person_muni_latest",
        safe_int("death_text").alias("death_year_month"),
        "edu_code",
    )
    df = attach_code(df, codes.EDUCATION_7, "edu_code", "STRING", "education", "INT")
    front = ["extract_year", "person_id"]
    return df.select(*front, *[c for c in df.columns if c not in front])


def read_households(raw: DataFrame) -> DataFrame:
    """Household members: up to nine (birth date, sex) pairs, one row per person and extract."""
    pairs = []
    for i in MEMBERS:
        pairs += [F.col(f"c{2 * i - 1}").alias(f"birth_date{i}"),
                  F.col(f"c{2 * i}").alias(f"sex{i}")]
    df = raw.select("extract_year", strip("c0").alias("person_id"), F.col("c1").alias("birth_date"),
                    F.col("c2").alias("sex"), *pairs)
    return dedup_by_key(df, ["extract_year", "person_id"])


def read_episodes(raw: DataFrame) -> DataFrame:
    """Employment episodes, all parts of all extracts.

    Whether a row needs clean-up is found once for all its integers and once for all its texts; rows
    that don't, which are nearly all, are cast and trimmed without a pattern for each field.
    """
    named = {name: f"c{i}" for i, name in enumerate(EPISODE_FIELDS) if name}
    texts = [c for name, c in named.items() if name in EPISODE_TEXT_FIELDS]
    here, repeated = f"c{INDUSTRY_POSITION}", f"c{OLD_INDUSTRY_POSITION}"
    integers = [c for name, c in named.items() if name not in EPISODE_TEXT_FIELDS] + [here, repeated]
    rows = raw.selectExpr("extract_year", *named.values(), here, repeated,
                          f"{plain_row(integers)} AS _plain", f"{ascii_row(texts)} AS _ascii")
    old = f"extract_year <= {LAST_OLD_INDUSTRY_EXTRACT}"
    return rows.selectExpr(
        "extract_year",
        *[f"{row_strip(c) if name in EPISODE_TEXT_FIELDS else row_int(c)} AS {name}" for name, c in named.items()],
        f"CASE WHEN {old} THEN {row_int(here)} ELSE {row_int(repeated)} END AS sector_cnae93",
        f"CASE WHEN NOT ({old}) THEN {row_int(here)} END AS sector_cnae09",
    )


def delivered_episode_parts(raw: DataFrame, limits: list[tuple[int, int]] = PART_LIMITS["AFILIAD"]) -> DataFrame:
    """Keep the parts an extract is made of; the scan does not open files of other ones."""
    identity = F.struct(F.col("extract_year").alias("year"), F.lit("AFILIAD").alias("source"), F.col("part"))
    return raw.filter(wanted_part(identity, {"AFILIAD": limits}))


def _months(raw: DataFrame) -> DataFrame:
    """extract_year, part, keys, and the twelve bases of the era as text with their plain_row."""
    months = raw.selectExpr("extract_year", "part", "c0", "c1", "c2", *[
        f"CASE WHEN extract_year <= 2012 THEN c{MONTH_START_UNTIL_2012 + m - 1} "
        f"ELSE c{MONTH_START_AFTER_2012 + m - 1} END AS m{m}" for m in MONTHS])
    return months.selectExpr("*", f"{plain_row(['c2', *[f'm{m}' for m in MONTHS]])} AS _plain")


def _bases(prefix: str, parts: str) -> list[str]:
    """The twelve monthly bases of the given parts, null on rows of other parts."""
    return [f"CASE WHEN {parts} THEN {row_int(f'm{m}')} END AS {prefix}{m}" for m in MONTHS]


def _contribution_keys() -> list[str]:
    return ["extract_year", f"{strip_sql('c0')} AS person_id", f"{strip_sql('c1')} AS firm_cc2",
            f"{row_int('c2', 'smallint')} AS year"]


def read_contributions(raw: DataFrame, autonomous: bool = False) -> DataFrame:
    """Monthly contribution bases in cents: the regular parts, or the self-employed part."""
    prefix, parts = BASES["autonomous" if autonomous else "regular"]
    return _months(raw.filter(parts)).selectExpr(*_contribution_keys(), *_bases(prefix, "true"))


def read_all_contributions(raw: DataFrame) -> DataFrame:
    """Regular and self-employed bases in one pass, side by side, rows not yet merged."""
    months = [c for prefix, parts in BASES.values() for c in _bases(prefix, parts)]
    any_part = " OR ".join(parts for _, parts in BASES.values())
    return _months(raw.filter(any_part)).selectExpr(*_contribution_keys(), *months)


def read_payments(raw: DataFrame) -> DataFrame:
    """Tax withholding records, with the temporary-disability parts added in by era.

    Cents stay whole numbers: wage_cents already contains the payments in kind, and
    inkind_cents is the part in kind. wage and inkind are the same in euros.
    """
    year = F.col("extract_year")
    rows = raw.selectExpr("*", f"{plain_row(['c5', 'c6', 'c7', 'c8', 'c10', 'c11'])} AS _plain",
                          f"{ascii_row(['c0', 'c1', 'c2', 'c4'])} AS _ascii")

    def cents(c):
        return fill(F.expr(row_int(c)), 0)

    def text(c):
        return F.expr(row_strip(c))

    # Until 2015 in kind is position 8; later it is 10, position 7 adds to the
    # amount, and from 2017 position 11 adds to the part in kind.
    amount = cents("c6") + F.when(year >= 2016, cents("c7")).otherwise(F.lit(0))
    inkind = (F.when(year <= 2015, cents("c8")).otherwise(cents("c10"))
              + F.when(year >= 2017, cents("c11")).otherwise(F.lit(0)))
    df = rows.select(
        text("c0").alias("person_id"), text("c2").alias("firm_id"),
        text("c1").alias("firm_jur_status"), text("c4").alias("payment_type"),
        F.expr(row_int("c5", "int")).alias("payment_subtype"), year.cast("smallint").alias("year"),
        amount.alias("amount_cents"), inkind.alias("inkind_cents"),
    )
    return df.select(
        "person_id", "firm_id", "firm_jur_status", "payment_type", "payment_subtype", "year",
        (F.col("amount_cents") + F.col("inkind_cents")).alias("wage_cents"), "inkind_cents",
        ((F.col("amount_cents") + F.col("inkind_cents")).cast("double") / 100).alias("wage"),
        (F.col("inkind_cents").cast("double") / 100).alias("inkind"),
    )


def read_pensions(raw: DataFrame) -> DataFrame:
    """Retirement pensions in full; partial classes and some regimes are left out."""
    df = raw.select(
        strip("c0").alias("person_id"), safe_int("c1", "smallint").alias("year"),
        strip("c3").alias("class"), safe_int("c9", "int").alias("regimep"),
        safe_int("c10").alias("date1"),
    )
    return full_retirement(df)


def full_retirement(df: DataFrame) -> DataFrame:
    """Rows of full retirement classes outside the excluded regimes (null regimes go too)."""
    wanted = [c for c in codes.RETIREMENT_CLASSES if c not in codes.PARTIAL_RETIREMENT_CLASSES]
    return df.filter(F.col("class").isin(wanted)
                     & ~F.col("regimep").isin(codes.EXCLUDED_PENSION_REGIMES))


def read_file_numbers(raw: DataFrame) -> DataFrame:
    """Which episode and contribution file a person's rows are in (space-delimited source)."""
    return raw.select("extract_year", strip("c0").alias("person_id"),
                      safe_int("c1", "tinyint").alias("relacionesfile"),
                      safe_int("c2", "tinyint").alias("basesfile"))

"""DuckDB SQL for the registered queries, written from the rules and not from the Spark code."""

from annualis import codes
from catalog.projections import PROJECTIONS, duckdb_text

ORACLE: dict[str, str] = {}
MONTHS = range(1, 13)
KEYS = "person_id, firm_cc2, year"
MAIN_TYPED = ["contribution_regime", "contract_type", "ptcoef", "firm_muni", "firm_id", "firm_cc",
              "rel_contract"]
MAIN_RAW = ["contribution_regime", "contribution_group", "contract_type", "ptcoef", "firm_muni",
            "firm_workers", "firm_age", "firm_jur_type", "firm_jur_status", "firm_id", "firm_cc",
            "firm_main_prov", "firm_ett", "sector_cnae09", "sector_cnae93", "rel_contract"]


# Named sub-queries: name -> (names it needs, text)
PARTS: dict[str, tuple[list[str], str]] = {
    name: ([], duckdb_text(name)) for name in PROJECTIONS
}


def part(name: str, needs: list[str], text: str) -> None:
    PARTS[name] = (needs, text)


def _needed(names: list[str], seen: list[str]) -> list[str]:
    for name in names:
        if name not in seen:
            _needed(PARTS[name][0], seen)
            seen.append(name)
    return seen


def oracle(name: str, needs: list[str], text: str) -> None:
    parts = ",\n".join(f"{n} AS ({PARTS[n][1]})" for n in _needed(needs, []))
    ORACLE[name] = f"WITH {parts}\n{text}"


# Fragments


def trimmed(c: str) -> str:
    return f"trim(nullif({c}, ''), ' ' || chr(9))"


def whole(text: str, dtype: str) -> str:
    return (f"CASE WHEN regexp_matches({text}, '^[+-]?[0-9]+$') "
            f"THEN TRY_CAST({text} AS {dtype}) END")


def number(c: str, dtype: str = "BIGINT") -> str:
    return whole(trimmed(c), dtype)


def no_n(c: str) -> str:
    return f"trim(regexp_replace({trimmed(c)}, '^N', ''))"


def any_range(c: str, ranges) -> str:
    return "(" + " OR ".join(f"({c} >= {a} AND {c} <= {b})" for a, b in ranges) + ")"


def code_values(table: dict, key: str, value: str) -> str:
    rows = ", ".join(f"({k!r}, {v!r})" for k, v in table.items())
    return f"(VALUES {rows}) t({key}, {value})"


def listed(c: str, values) -> str:
    return f"{c} IN ({', '.join(repr(v) for v in values)})"


def total(columns) -> str:
    return " + ".join(f"coalesce({c}, 0)" for c in columns)


CON = [f"contribution_{m}" for m in MONTHS]
AUT = [f"contribution_aut_{m}" for m in MONTHS]
DAYS = [f"days{m}" for m in MONTHS]


# Sources

part("persons_read", ["raw_persons"], f"""
SELECT extract_year, person_id, birth_date, sex,
       coalesce(nullif({whole('nat', 'INT')}, 99), nullif({whole('country', 'INT')}, 99)) AS nationality,
       nullif({whole('country', 'INT')}, 99) AS birth_country,
       {whole('prov', 'INT')} AS birth_prov,
       ss_reg_prov, person_muni_latest, {whole('death', 'BIGINT')} AS death_year_month,
       edu_code, CAST(e.education AS INT) AS education
FROM (SELECT *, count(*) OVER (PARTITION BY extract_year, person_id) AS n FROM (
        SELECT DISTINCT extract_year, {trimmed('c0')} AS person_id, {trimmed('c1')} AS birth_date,
               {number('c2', 'TINYINT')} AS sex, {no_n('c3')} AS nat, {no_n('c4')} AS prov,
               {number('c5', 'INT')} AS ss_reg_prov, {number('c6', 'INT')} AS person_muni_latest,
               {trimmed('c7')} AS death, {no_n('c8')} AS country, {trimmed('c9')} AS edu_code,
               c3, c4, c8
        FROM raw_persons))
LEFT JOIN {code_values(codes.EDUCATION_7, 'code', 'education').replace(') t(', ') e(')} ON e.code = edu_code
WHERE n = 1""")
oracle("read_persons", ["persons_read"], "SELECT * FROM persons_read")
oracle("scan_files", ["persons_read"], "SELECT * FROM persons_read")

_PAIRS = [(f"birth_date{i}", f"sex{i}", 2 * i - 1, 2 * i) for i in range(2, 11)]
_HOME_COLUMNS = [c for b, s, _, _ in _PAIRS for c in (b, s)]
part("households_read", ["raw_households"], f"""
SELECT extract_year, {trimmed('c0')} AS person_id, nullif(c1, '') AS birth_date, nullif(c2, '') AS sex,
       {', '.join(f"nullif(c{i}, '') AS {b}, nullif(c{j}, '') AS {s}" for b, s, i, j in _PAIRS)}
FROM raw_households
QUALIFY row_number() OVER (PARTITION BY extract_year, person_id ORDER BY
        birth_date NULLS FIRST, sex NULLS FIRST,
        {', '.join(f'{c} NULLS FIRST' for c in _HOME_COLUMNS)}) = 1""")
oracle("read_households", ["households_read"], "SELECT * FROM households_read")

_EPISODE_INTS = {1: "contribution_regime", 2: "contribution_group", 3: "contract_type",
                 4: "ptcoef", 5: "entry_date", 6: "exit_date", 7: "reason_dismissal",
                 8: "disability", 10: "firm_muni", 12: "firm_workers", 13: "firm_age",
                 14: "job_relationship", 15: "firm_ett", 16: "firm_jur_type", 18: "firm_id",
                 20: "firm_main_prov"}
_EPISODE_TEXTS = {0: "person_id", 9: "firm_cc2", 17: "firm_jur_status", 19: "firm_cc",
                  21: "new_date_contract1", 22: "prev_contract1", 23: "prev_ptcoef1",
                  24: "new_date_contract2", 25: "prev_contract2", 26: "prev_ptcoef2",
                  27: "new_date_contribution_group", 28: "prev_contribution_group"}
_EPISODE_NAMES = {**_EPISODE_INTS, **_EPISODE_TEXTS}
_EPISODE_ORDER = [_EPISODE_NAMES[i] for i in sorted(_EPISODE_NAMES)] + ["sector_cnae93",
                                                                        "sector_cnae09"]
part("episodes_read", ["raw_episodes"], f"""
SELECT extract_year,
       {', '.join(f'{number(f"c{i}")} AS {n}' for i, n in _EPISODE_INTS.items())},
       {', '.join(f'{trimmed(f"c{i}")} AS {n}' for i, n in _EPISODE_TEXTS.items())},
       CASE WHEN extract_year <= 2009 THEN {number('c11')} ELSE {number('c29')} END AS sector_cnae93,
       CASE WHEN extract_year > 2009 THEN {number('c11')} END AS sector_cnae09
FROM raw_episodes WHERE part <= CASE WHEN extract_year <= 2012 THEN 3 ELSE 4 END""")
oracle("read_episodes", ["episodes_read"], "SELECT * FROM episodes_read")


def _months_read(prefix: str, parts: str) -> str:
    months = ", ".join(
        f"CASE WHEN extract_year <= 2012 THEN {number(f'c{7 + m}')} ELSE {number(f'c{2 + m}')} END "
        f"AS {prefix}{m}" for m in MONTHS)
    return (f"SELECT extract_year, {trimmed('c0')} AS person_id, {trimmed('c1')} AS firm_cc2, "
            f"{number('c2', 'SMALLINT')} AS year, {months} FROM raw_contributions WHERE {parts}")


part("contributions_read", ["raw_contributions"], _months_read("contribution_", "part <= 12"))
part("autonomous_read", ["raw_contributions"], _months_read("contribution_aut_", "part = 13"))
oracle("read_contributions", ["contributions_read"], "SELECT * FROM contributions_read")
oracle("read_contributions_autonomous", ["autonomous_read"], "SELECT * FROM autonomous_read")

part("payments_read", ["raw_payments"], f"""
SELECT *, (wage_cents::DOUBLE) / 100 AS wage, (inkind_cents::DOUBLE) / 100 AS inkind FROM (
  SELECT person_id, firm_id, firm_jur_status, payment_type, payment_subtype, year,
         coalesce(amount, 0) + coalesce(il, 0) + coalesce(kind, 0) + coalesce(kind_il, 0) AS wage_cents,
         coalesce(kind, 0) + coalesce(kind_il, 0) AS inkind_cents
  FROM (SELECT {trimmed('c0')} AS person_id, {trimmed('c2')} AS firm_id,
               {trimmed('c1')} AS firm_jur_status, {trimmed('c4')} AS payment_type,
               {number('c5', 'INT')} AS payment_subtype, extract_year AS year,
               {number('c6')} AS amount,
               CASE WHEN extract_year > 2015 THEN {number('c7')} END AS il,
               CASE WHEN extract_year > 2015 THEN {number('c10')} ELSE {number('c8')} END AS kind,
               CASE WHEN extract_year > 2016 THEN {number('c11')} END AS kind_il
        FROM raw_payments))""")
oracle("read_payments", ["payments_read"], "SELECT * FROM payments_read")

part("pensions_read", ["raw_pensions"], f"""
SELECT * FROM (SELECT {trimmed('c0')} AS person_id, {number('c1', 'SMALLINT')} AS year,
                      {trimmed('c3')} AS class, {number('c9', 'INT')} AS regimep,
                      {number('c10')} AS date1 FROM raw_pensions)
WHERE class IN ('20', '21', '22', '23', '24', '26', 'J1', 'J2', 'J4', 'J5')
  AND regimep NOT IN (36, 37)""")
oracle("read_pensions", ["pensions_read"], "SELECT * FROM pensions_read")

oracle("read_file_numbers", ["raw_file_numbers"], f"""
SELECT extract_year, {trimmed('c0')} AS person_id, {number('c1', 'TINYINT')} AS relacionesfile,
       {number('c2', 'TINYINT')} AS basesfile FROM raw_file_numbers""")

# The spellings of raw_paths that occur, kind by kind (k is the kind, y the folder year).
oracle("source_names", ["raw_paths"], r"""
SELECT o_orderkey, path, CAST(y AS INT) AS year, source,
       CASE WHEN source IN ('AFILIAD', 'COTIZA') THEN CAST(p AS INT) END AS part
FROM (SELECT r.*, 2004 + r.o_orderkey % 24 AS y, 1 + o.o_custkey % 13 AS p,
             o.o_custkey % 10 = 0 AS stale, o.o_custkey % 14 AS k,
             CASE o.o_custkey % 14 WHEN 0 THEN 'AFILIAD' WHEN 1 THEN 'PERSONAL' WHEN 2 THEN 'COTIZA'
               WHEN 3 THEN 'AFILIAD' WHEN 4 THEN 'FISCAL' WHEN 5 THEN 'COTIZA' WHEN 6 THEN 'AFILIAD'
               WHEN 7 THEN 'AFILIAD' WHEN 8 THEN 'COTIZA' WHEN 9 THEN 'PRESTAC' WHEN 10 THEN 'PERSONAL'
               WHEN 11 THEN 'COTIZA' WHEN 12 THEN 'PRESTAC' ELSE 'DIVISION' END AS source
      FROM raw_paths r JOIN orders o ON o.o_orderkey = r.o_orderkey)
WHERE CASE k WHEN 0 THEN NOT stale WHEN 1 THEN NOT stale AND y >= 2009
        WHEN 2 THEN NOT stale AND y = 2005 WHEN 3 THEN y BETWEEN 2006 AND 2008
        WHEN 4 THEN y BETWEEN 2006 AND 2008 WHEN 5 THEN NOT stale AND y = 2009
        WHEN 6 THEN NOT stale AND y = 2010 WHEN 7 THEN NOT stale AND y = 2011
        WHEN 8 THEN NOT stale AND y = 2015 WHEN 9 THEN NOT stale AND y = 2016
        WHEN 10 THEN NOT stale AND y IN (2020, 2021)
        WHEN 11 THEN y = 2004 AND p < 10 AND p <> 6
        WHEN 12 THEN y = 2004 ELSE NOT stale END""")

# Scalars and predicates

_CODE = trimmed("code").replace("nullif(code, '')", "code")
oracle("safe_cast", ["texts"], f"""
SELECT l_orderkey, l_linenumber, {_CODE} AS stripped,
       {whole(_CODE, 'TINYINT')} AS as_tinyint, {whole(_CODE, 'SMALLINT')} AS as_smallint,
       {whole(_CODE, 'INT')} AS as_int, {whole(_CODE, 'BIGINT')} AS as_bigint,
       nullif({whole(f"trim(regexp_replace({_CODE}, '^N', ''))", 'INT')}, 99) AS country,
       CASE WHEN {_CODE} <> '' AND regexp_matches({_CODE}, '^0+$') THEN '0'
            WHEN {_CODE} = '' THEN '0'
            ELSE regexp_replace({_CODE}, '^0+', '') END AS no_zeros,
       CAST(substr(yyyymm, 1, 4) AS INT) AS birth_year, CAST(substr(yyyymm, 5, 2) AS INT) AS birth_month
FROM texts""")

oracle("date_parts", ["episodes"], """
SELECT person_id, firm_cc2, entry_date, exit_date,
       CAST(substr(CAST(entry_date AS VARCHAR), 1, 4) AS SMALLINT) AS entry_year,
       CAST(substr(CAST(entry_date AS VARCHAR), 5, 2) AS INT) AS entry_month,
       CAST(substr(CAST(entry_date AS VARCHAR), 7, 2) AS INT) AS entry_day,
       greatest(exit_date - entry_date, 0) AS at_least,
       least(exit_date - entry_date, 100) AS at_most,
       CASE WHEN ptcoef % 3 > 0 THEN greatest(least(exit_date - entry_date, 100), 0) END AS within
FROM episodes""")

FLAGS = f"""
CAST({any_range('contribution_regime', codes.WORK_REGIMES)}
     AND NOT (job_relationship BETWEEN 751 AND 756) AS TINYINT) AS rel_contract,
CAST({any_range('contribution_regime', codes.SELF_EMPLOYED_REGIMES)} AS TINYINT) AS self_emp,
CAST({any_range('contribution_regime', codes.DOMESTIC_REGIMES)} AS TINYINT) AS emp_hogar,
CAST(job_relationship BETWEEN 751 AND 756 AS TINYINT) AS unemp_jr,
CAST({any_range('firm_muni', codes.FORAL_MUNICIPALITIES)} AS TINYINT) AS basque_navarra"""
oracle("range_flags", ["episodes"], f"""
SELECT person_id, firm_cc2, entry_date, exit_date, contribution_regime, job_relationship, firm_muni,
       {FLAGS} FROM episodes""")

# Keys, sets and joins

oracle("conflict_drop", ["snapshots"], """
SELECT DISTINCT person_id, birth_date FROM snapshots WHERE person_id IN (
  SELECT person_id FROM (SELECT DISTINCT person_id, birth_date FROM snapshots)
  GROUP BY person_id HAVING count(*) = 1)""")
_SNAPSHOT_REST = ["birth_date", "sex", "edu_code", "snapshot_order", "birth_date2", "birth_date3"]
part("snapshots_one", ["snapshots"], f"""
SELECT * FROM snapshots QUALIFY row_number() OVER (PARTITION BY extract_year, person_id
  ORDER BY {', '.join(f'{c} NULLS FIRST' for c in _SNAPSHOT_REST)}) = 1""")
oracle("dedup_key", ["snapshots_one"], "SELECT * FROM snapshots_one")
oracle("top_per_key", ["payments"], """
SELECT person_id, year, payment_type, firm_id, wage_cents FROM payments
QUALIFY row_number() OVER (PARTITION BY person_id, year
                           ORDER BY wage_cents DESC, payment_type NULLS FIRST, firm_id NULLS FIRST) = 1""")
oracle("set_difference", ["pensions", "payments"], """
SELECT *, 'pension' AS only_in FROM (SELECT person_id, year FROM pensions EXCEPT SELECT person_id, year FROM payments)
UNION ALL
SELECT *, 'payment' AS only_in FROM (SELECT person_id, year FROM payments EXCEPT SELECT person_id, year FROM pensions)""")
oracle("union_relaxed", ["payments"], """
SELECT person_id, year, wage_cents, CASE WHEN year >= 1998 THEN inkind_cents END AS inkind_cents FROM payments""")

# Persons

part("household_joined", ["persons_read", "households_read"], f"""
SELECT p.*, {', '.join(f'h.{c}' for c in _HOME_COLUMNS)}
FROM persons_read p LEFT JOIN households_read h
  ON p.extract_year = h.extract_year AND p.person_id = h.person_id""")
oracle("household_join", ["household_joined"], "SELECT * FROM household_joined")


def consolidated(rows: str, attributes: dict[str, str], household: list[str]) -> str:
    """Bad persons are dropped first, the latest known value of each column is taken."""
    def latest(expression: str) -> str:
        return f"arg_max({expression}, extract_year) FILTER ({expression} IS NOT NULL)"

    columns = ", ".join(f"{latest(e)} AS {c}" for c, e in attributes.items())
    homes = "".join(f", arg_max_null({c}, extract_year) AS {c}" for c in household)
    return f"""
SELECT * REPLACE (CAST(CASE WHEN sex = 2 THEN 0 ELSE sex END AS TINYINT) AS sex) FROM (
  SELECT person_id, min(extract_year) AS first_extract, max(extract_year) AS last_extract,
         {latest('birth_year')} AS birth_year, {latest('birth_month')} AS birth_month,
         {latest('birth_date')} AS birth_date, {columns}{homes}
  FROM (SELECT *, {whole('substr(birth_date, 1, 4)', 'INT')} AS birth_year,
               {whole('substr(birth_date, 5, 2)', 'INT')} AS birth_month FROM {rows})
  GROUP BY person_id HAVING count(DISTINCT birth_year) = 1)
WHERE sex IN (1, 2)"""


part("entity", ["snapshots_one"], consolidated(
    "snapshots_one", {"sex": "nullif(sex, 0)", "edu_code": "edu_code"},
    ["birth_date2", "birth_date3"]))
oracle("entity_latest", ["entity"], "SELECT * FROM entity")


def spanned(last: int) -> str:
    return (f"least(birth_year + 16, first_extract) AS start_year, "
            f"greatest(least(last_extract + 4, {last}), least(birth_year + 16, first_extract)) AS end_year")


oracle("rectangularise", ["entity"], f"""
SELECT person_id, CAST(unnest(range(start_year, end_year + 1)) AS SMALLINT) AS year, birth_year, sex,
       first_extract, last_extract
FROM (SELECT *, {spanned(2000)} FROM entity)""")
oracle("cohort", ["entity"], f"""
SELECT person_id, last_extract, birth_year, birth_date FROM (
  SELECT *, unnest(range(start_year, end_year + 1)) AS year FROM (SELECT *, {spanned(1998)} FROM entity))
WHERE year = last_extract""")
oracle("cohort_episodes", ["episodes", "entity"], """
SELECT person_id, firm_cc2, entry_date, exit_date, firm_id, ptcoef FROM episodes e WHERE EXISTS (
  SELECT 1 FROM entity p WHERE p.person_id = e.person_id AND p.last_extract = e.entry_date // 10000)""")

# Episodes and contributions


def cleaned(rows: str, rest: list[str]) -> str:
    return f"""
SELECT *, CAST(entry_date // 10000 AS SMALLINT) AS entry_year, CAST(exit_date // 10000 AS SMALLINT) AS exit_year
FROM {rows} WHERE exit_date >= entry_date
QUALIFY row_number() OVER (PARTITION BY person_id, entry_date, exit_date, firm_cc2
                           ORDER BY {', '.join(f'{c} NULLS FIRST' for c in rest)}) = 1"""


_EPISODE_REST = ["contribution_regime", "job_relationship", "contract_type", "firm_muni",
                 "firm_id", "firm_cc", "ptcoef"]
part("clean", ["episodes"], cleaned("episodes", _EPISODE_REST))
oracle("episodes_clean", ["clean"], "SELECT * FROM clean")


def expanded(rows: str, first: int = 1960, last: int = 2024) -> str:
    return (f"SELECT *, CAST(unnest(range(greatest(entry_year, {first}), "
            f"least(exit_year, {last}) + 1)) AS SMALLINT) AS year FROM {rows}")


part("years", ["clean"], expanded("clean"))
oracle("episode_years", ["clean"], f"""
SELECT person_id, firm_cc2, entry_date, exit_date, year FROM ({expanded('clean', 1996, 1999)})""")


def days_case(m: int) -> str:
    """The day rules one by one, on date components."""
    starts, stops = f"(year = ay AND am = {m})", f"(year = xy AND xm = {m})"
    february = f"""
      WHEN {starts} AND ad = 1 AND NOT {stops} THEN 30
      WHEN {stops} AND xd IN (28, 29) AND NOT {starts} THEN 30
      WHEN {starts} AND {stops} AND ad = 1 AND xd IN (28, 29) THEN 30""" if m == 2 else ""
    return f"""CASE {february}
      WHEN entry_date = exit_date AND {starts} THEN 1
      WHEN {starts} AND {stops} THEN least(greatest(xd - ad + 1, 1), 30)
      WHEN {starts} THEN least(greatest({31 if m == 12 else 30} - ad + 1, 1), 30)
      WHEN {stops} THEN least(greatest(xd, 1), 30)
      WHEN make_date(year, {m}, 1) > make_date(ay, am, 1)
       AND make_date(year, {m}, 1) < make_date(xy, xm, 1) THEN 30 END"""


def with_days(rows: str) -> str:
    days = ", ".join(f"CAST({days_case(m)} AS INT) AS days{m}" for m in MONTHS)
    return f"""
SELECT * EXCLUDE (ay, am, ad, xy, xm, xd), {days} FROM (
  SELECT *, CAST(entry_date // 10000 AS INT) AS ay, CAST(entry_date // 100 % 100 AS INT) AS am,
         CAST(entry_date % 100 AS INT) AS ad, CAST(exit_date // 10000 AS INT) AS xy,
         CAST(exit_date // 100 % 100 AS INT) AS xm, CAST(exit_date % 100 AS INT) AS xd FROM {rows})"""


part("days", ["years"], with_days("years"))
oracle("monthly_days", ["days"],
       f"SELECT person_id, firm_cc2, entry_date, exit_date, year, {', '.join(DAYS)} FROM days")


def month_rows(autonomous: int, step: int) -> str:
    prefix = "contribution_aut_" if autonomous else "contribution_"
    return (f"SELECT {KEYS}, " + ", ".join(
        f"CASE WHEN month = {m} THEN cents // {step} * {step} END AS {prefix}{m}" for m in MONTHS)
        + f" FROM contributions WHERE autonomous = {autonomous}")


def joined_contributions(regular: str, autonomous: str) -> str:
    """Full outer join of the row sets, then the maximum of every month."""
    return f"""
SELECT {KEYS}, {', '.join(f'max({c}) AS {c}' for c in CON + AUT)}
FROM (SELECT * FROM ({regular}) r FULL JOIN ({autonomous}) a USING ({KEYS})) GROUP BY {KEYS}"""


for _name, _step in (("merged", 1), ("merged_ties", 5_000_000)):
    part(_name, ["contributions"],
         joined_contributions(month_rows(0, _step), month_rows(1, _step)))
oracle("contrib_merge", ["merged"], "SELECT * FROM merged")
oracle("stage_tables", ["merged"], f"SELECT {KEYS}, {', '.join(CON + AUT)} FROM merged")
oracle("contrib_full_outer", ["contributions"], f"""
SELECT {KEYS}, CAST(sum(cents) FILTER (autonomous = 0) AS BIGINT) AS regular_cents,
       CAST(sum(cents) FILTER (autonomous = 1) AS BIGINT) AS autonomous_cents
FROM contributions GROUP BY {KEYS}""")
oracle("episode_contrib", ["years", "merged"], f"""
SELECT y.person_id, y.entry_date, y.exit_date, y.firm_cc2, y.year, {', '.join(f'm.{c}' for c in CON + AUT)}
FROM years y LEFT JOIN merged m ON y.person_id = m.person_id AND y.firm_cc2 = m.firm_cc2 AND y.year = m.year""")

# Annual facts

part("flagged", ["days"], f"SELECT *, {FLAGS} FROM days")
_ROW_LAGS = ", ".join(f"lag(days, {n}) OVER (PARTITION BY person_id ORDER BY year) AS days_lag{n}"
                      for n in (1, 2, 3))
_CALENDAR_LAGS = ", ".join(
    f"(SELECT p.days FROM work_days p WHERE p.person_id = d.person_id AND p.year = d.year - {n}) "
    f"AS days_lag{n}" for n in (1, 2, 3))


def work_days(rows: str) -> str:
    return f"""
SELECT person_id, year, CAST({total(DAYS)} AS INT) AS days FROM (
  SELECT person_id, year, {', '.join(f'max({c}) AS {c}' for c in DAYS)}
  FROM {rows} WHERE rel_contract = 1 GROUP BY person_id, year)"""


part("work_days", ["flagged"], work_days("flagged"))
oracle("annual_days", ["work_days"], f"SELECT *, {_ROW_LAGS} FROM work_days")
oracle("annual_days_calendar", ["work_days"], f"SELECT *, {_CALENDAR_LAGS} FROM work_days d")
oracle("full_year", ["work_days"], f"""
SELECT *, CAST(coalesce(days_lag1, 0) >= 360 AS TINYINT) AS fullyear_lag1
FROM (SELECT *, {_ROW_LAGS} FROM work_days)""")


def firm_years(rows: str, bases: str, main: list[str], flags: str = "first",
               times: str = "sum") -> str:
    """Bases joined to every episode-year first, then grouped, as the rule says."""
    year_flags = ["self_emp", "emp_hogar", "unemp_jr", "basque_navarra"]
    first = ", ".join(f"arg_min_null({c}, entry_date * 100000000 + exit_date) AS {c}"
                      for c in main + (year_flags if flags == "first" else []))
    top = "".join(f", max({c}) AS {c}" for c in year_flags) if flags == "any" else ""
    days = ", ".join(f"max({c}) FILTER (rel_contract = 1) AS {c}" for c in DAYS)
    return f"""
SELECT e.person_id, e.firm_cc2, e.year, count(*) AS n_episodes,
       CAST({times}({total(CON)}) AS BIGINT) AS firm_cents,
       CAST({times}({total(AUT)}) AS BIGINT) AS firm_aut_cents,
       CAST(sum({total([f'e.{c}' for c in DAYS])}) AS BIGINT) AS firm_days,
       {days.replace('max(', 'max(e.').replace('(rel_', '(e.rel_')}, {first}{top}
FROM {rows} e LEFT JOIN {bases} b ON e.person_id = b.person_id AND e.firm_cc2 = b.firm_cc2 AND e.year = b.year
GROUP BY e.person_id, e.firm_cc2, e.year"""


part("firms_typed", ["flagged", "merged"], firm_years("flagged", "merged", MAIN_TYPED))
part("firms_ties", ["flagged", "merged_ties"], firm_years("flagged", "merged_ties", MAIN_TYPED))
part("firms_any", ["flagged", "merged"], firm_years("flagged", "merged", MAIN_TYPED, "any", "max"))
oracle("firm_year", ["firms_typed"], "SELECT * FROM firms_typed")


def person_years(firms: str, days: str, main: list[str], lags: str = _ROW_LAGS) -> str:
    return f"""
SELECT t.*, m.firm_cc2 AS main_firm_cc2, m.firm_cents::DOUBLE / 100 AS main_firm_contrib,
       {', '.join(f'm.{c}' for c in main)}, d.days, d.days_lag1, d.days_lag2, d.days_lag3
FROM (SELECT person_id, year, CAST(sum(firm_cents) AS BIGINT)::DOUBLE / 100 AS total_contribution,
             max(self_emp) AS self_emp_year, max(emp_hogar) AS emp_hogar_year,
             max(unemp_jr) AS unemp_year, max(basque_navarra) AS basque_navarra_year
      FROM {firms} GROUP BY person_id, year) t
JOIN (SELECT * FROM {firms} QUALIFY row_number() OVER (
        PARTITION BY person_id, year ORDER BY firm_cents DESC, firm_cc2) = 1) m
  ON t.person_id = m.person_id AND t.year = m.year
LEFT JOIN (SELECT *, {lags} FROM {days} d) d ON t.person_id = d.person_id AND t.year = d.year"""


part("annual_ties", ["firms_ties", "work_days"], person_years("firms_ties", "work_days", MAIN_TYPED))
oracle("person_year", ["firms_typed", "work_days"],
       person_years("firms_typed", "work_days", MAIN_TYPED))
oracle("main_job", ["annual_ties"], """
SELECT person_id, year, main_firm_cc2, main_firm_contrib, firm_muni, contract_type FROM annual_ties""")

# With calendar lags a year without work still has the days of the years before it.
part("annual_any", ["firms_any", "work_days"], person_years("firms_any", "work_days", MAIN_TYPED))
_ANY_LAGS = ", ".join(
    f"(SELECT p.days FROM work_days p WHERE p.person_id = d.person_id AND p.year = d.year - {n}) "
    f"AS days_lag{n}" for n in (1, 2, 3))
oracle("person_year_any", ["annual_any", "work_days"],
       f"SELECT d.* EXCLUDE (days_lag1, days_lag2, days_lag3), {_ANY_LAGS} FROM annual_any d")

oracle("row_counts", ["clean"], """
SELECT count(*) AS n_rows, count(DISTINCT person_id) AS n_entities FROM clean""")

# Firms

part("firm_rows", ["episodes"], """
SELECT firm_cc2, firm_cc, firm_id, exit_date, CAST(entry_date // 10000 AS SMALLINT) AS extract_year, firm_muni,
       CASE WHEN ptcoef % 3 <> 0 THEN ptcoef END AS firm_workers,
       CASE WHEN ptcoef % 5 <> 0 THEN ptcoef END AS firm_age,
       CASE WHEN contract_type % 3 <> 0 THEN contract_type % 100 END AS sector_cnae93,
       CASE WHEN contract_type % 7 <> 0 THEN contract_type % 90 END AS sector_cnae09,
       contribution_regime % 2 AS firm_ett, firm_muni // 1000 AS firm_main_prov,
       CASE WHEN contract_type % 4 <> 0 THEN contract_type END AS firm_jur_type,
       chr(CAST(65 + contract_type % 26 AS INT)) AS firm_jur_status FROM episodes""")


def filled(c: str) -> str:
    return (f"last_value({c} IGNORE NULLS) OVER (PARTITION BY firm_cc2 ORDER BY year "
            f"ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS {c}")


_FIRM = ["firm_muni", "sector_cnae93", "sector_cnae09", "firm_workers", "firm_age", "firm_ett", "firm_jur_type",
         "firm_jur_status", "firm_main_prov"]
part("firm_picked", ["firm_rows"], f"""
SELECT * FROM (
  SELECT DISTINCT firm_cc2, extract_year AS year, firm_muni, sector_cnae93, sector_cnae09, firm_workers, firm_age,
         firm_ett, firm_main_prov,
         coalesce(firm_jur_type, 0) AS firm_jur_type,
         CASE WHEN {listed('firm_jur_status', codes.JURIDICAL_STATUS)} THEN firm_jur_status END AS firm_jur_status
  FROM firm_rows)
QUALIFY row_number() OVER (PARTITION BY firm_cc2, year ORDER BY firm_age DESC NULLS FIRST,
  firm_muni NULLS FIRST, sector_cnae93 NULLS FIRST, sector_cnae09 NULLS FIRST, firm_workers NULLS FIRST,
  firm_ett NULLS FIRST, firm_jur_type NULLS FIRST, firm_jur_status NULLS FIRST, firm_main_prov NULLS FIRST) = 1""")
oracle("firm_panel", ["firm_picked"], f"""
SELECT firm_cc2, year, {', '.join(filled(c) for c in _FIRM)},
       min(year) OVER (PARTITION BY firm_cc2) AS ini_year, max(year) OVER (PARTITION BY firm_cc2) AS end_year
FROM firm_picked""")


def correction(rows: str, first_exit: int) -> str:
    return f"""
SELECT firm_cc, firm_id AS firm_id_correction FROM (
  SELECT *, count(*) OVER (PARTITION BY firm_cc) AS n,
         max(CASE WHEN firm_id = 0 THEN 1 ELSE 0 END) OVER (PARTITION BY firm_cc) AS zero
  FROM (SELECT firm_cc, firm_id, max(extract_year) AS latest FROM {rows}
        WHERE exit_date // 10000 >= {first_exit} GROUP BY firm_cc, firm_id))
WHERE zero = 1 AND n IN (2, 3) AND firm_id <> 0
QUALIFY row_number() OVER (PARTITION BY firm_cc ORDER BY latest DESC, firm_id) = 1"""


part("fix", ["firm_rows"], correction("firm_rows", 1998))
oracle("firm_id_fix", ["fix"], "SELECT * FROM fix")
oracle("firm_id_applied", ["episodes", "fix"], """
SELECT person_id, entry_date, exit_date, firm_cc,
       CASE WHEN firm_id = 0 THEN coalesce(firm_id_correction, 0) ELSE firm_id END AS firm_id
FROM episodes LEFT JOIN fix USING (firm_cc)""")

# Income and pensions

WORK = "payment_type NOT IN ('B', 'C', 'D', 'E', 'G', 'H', 'I', 'J', 'K', 'L', 'M')"
PROF = ("payment_type IN ('G', 'H') AND NOT ((payment_type = 'G' AND payment_subtype IN (0, 2)) "
        "OR (payment_type = 'H' AND payment_subtype = 3))")
BARE = "CASE WHEN ltrim(firm_id, '0') = '' THEN '0' ELSE ltrim(firm_id, '0') END"


def work(rows: str) -> str:
    return f"""
SELECT person_id, {BARE} AS firm_id, year, CAST(sum(wage_cents) AS BIGINT)::DOUBLE / 100 AS wage,
       CAST(sum(inkind_cents) AS BIGINT)::DOUBLE / 100 AS inkind
FROM {rows} WHERE {WORK} GROUP BY ALL"""


def income(rows: str, condition: str, kind: str) -> str:
    return f"""
SELECT person_id, year, CAST(sum(wage_cents) AS BIGINT)::DOUBLE / 100 AS inc_{kind},
       CAST(sum(inkind_cents) AS BIGINT)::DOUBLE / 100 AS inkind_{kind}
FROM {rows} WHERE {condition} GROUP BY person_id, year"""


oracle("income_work", ["payments"], work("payments"))
oracle("income_unemp", ["payments"], income("payments", "payment_type = 'C'", "unemp"))
oracle("income_prof", ["payments"], income("payments", PROF, "prof"))
part("pension_income", ["payments"], income("payments", "payment_type = 'B'", "pension"))
oracle("income_pension", ["pension_income"], "SELECT person_id, year, inc_pension FROM pension_income")


def retired(rows: str) -> str:
    """Smallest date of each year first, then the smallest of those."""
    return f"""
SELECT person_id, CAST(min(first_date // 100) AS INT) AS retirementyear FROM (
  SELECT person_id, year, min(date1) AS first_date FROM {rows} GROUP BY person_id, year)
GROUP BY person_id"""


oracle("retirement", ["pensions"], retired("""(
  SELECT * FROM pensions WHERE class IN ('20', '21', '22', '23', '24', '26', 'J1', 'J2', 'J4', 'J5')
                           AND regimep NOT IN (36, 37))"""))

# Attributes

part("moved", ["contributions"], """
SELECT person_id, CAST(year + 7 AS SMALLINT) AS year, CAST(sum(cents) AS BIGINT) AS cents
FROM contributions GROUP BY person_id, year""")


def with_persons(rows: str, persons: str, last: int, columns: list[str]) -> str:
    """The rectangular panel is built and joined on person and year."""
    return f"""
SELECT r.*, {', '.join(f'p.{c}' for c in columns)},
       r.year::DOUBLE - p.birth_year::DOUBLE AS age, p.first_extract::DOUBLE - p.birth_year::DOUBLE AS entryage
FROM {rows} r LEFT JOIN (
  SELECT *, unnest(range(start_year, end_year + 1)) AS panel_year FROM (SELECT *, {spanned(last)} FROM {persons})) p
  ON r.person_id = p.person_id AND r.year = p.panel_year"""


oracle("demographics", ["moved", "entity"], with_persons(
    "(SELECT person_id, CAST(year - 7 AS SMALLINT) AS year, cents FROM moved)", "entity", 2000,
    ["birth_year", "birth_month", "birth_date", "sex", "first_extract", "last_extract"]))


def family(rows: str, members: list[str]) -> str:
    ages = [f"CASE WHEN year - {whole(f'substr(trim({c}), 1, 4)', 'INT')} >= 0 "
            f"THEN year - {whole(f'substr(trim({c}), 1, 4)', 'INT')} END" for c in members]

    def count(low, high):
        return " + ".join(f"coalesce(CAST({a} BETWEEN {low} AND {high} AS INT), 0)" for a in ages)

    present = " + ".join(f"CAST(({a}) IS NOT NULL AS INT)" for a in ages)
    return (f"SELECT *, CAST(1 + {present} AS INT) AS famsize, CAST({count(0, 6)} AS INT) AS famsize_06, "
            f"CAST({count(7, 15)} AS INT) AS famsize_715, CAST({count(65, 120)} AS INT) AS famsize_a65 "
            f"FROM {rows}")


oracle("family", ["snapshots"], f"""
SELECT snapshot_order, year, famsize, famsize_06, famsize_715, famsize_a65
FROM ({family('(SELECT *, extract_year AS year FROM snapshots)', ['birth_date2', 'birth_date3'])})""")


def contract_group(c: str) -> str:
    return "CASE " + " ".join(f"WHEN {listed(c, members)} THEN {group}"
                              for group, members in codes.CONTRACT_GROUPS.items()) + f" ELSE {c} END"


def contract(rows: str) -> str:
    return f"""
SELECT *, CAST(CASE WHEN {listed('contractb', codes.PERMANENT_CONTRACTS)} THEN 1
                    WHEN {listed('contractb', codes.TEMPORARY_CONTRACTS)} THEN 0 END AS INT) AS permanent
FROM (SELECT *, CAST({contract_group('contract_type')} AS BIGINT) AS contractb FROM {rows})"""


oracle("contract_class", ["episodes"], contract(
    "(SELECT person_id, entry_date, exit_date, firm_cc2, contract_type FROM episodes)"))


def deflated(rows: str, amounts: list[str]) -> str:
    real = ", ".join(f"{c} / cpi_factor AS real_{c}" for c in amounts)
    return f"""
SELECT *, {real} FROM (
  SELECT r.*, coalesce(t.cpi, 103.664::DOUBLE) AS cpi, coalesce(t.cpi, 103.664::DOUBLE) / 103.664::DOUBLE AS cpi_factor
  FROM {rows} r LEFT JOIN (SELECT k, v::DOUBLE AS cpi FROM {code_values(codes.CPI, 'k', 'v')}) t ON t.k = r.year)"""


oracle("deflate", ["moved"], deflated("(SELECT *, cents::DOUBLE / 100 AS wage FROM moved)", ["wage"]))


def located(rows: str) -> str:
    cases = " ".join(f"WHEN province = {p} THEN {region}" for p, region in codes.PROVINCE_REGION.items())
    return (f"SELECT *, CAST(CASE {cases} END AS BIGINT) AS comunidad "
            f"FROM (SELECT *, firm_muni // 1000 AS province FROM {rows})")


oracle("geography", ["episodes"], located(
    "(SELECT person_id, entry_date, exit_date, firm_cc2, firm_muni FROM episodes)"))

FOUR = ("CAST(CASE WHEN education_7cats IN (10, 20) THEN 1 WHEN education_7cats = 30 THEN 2 "
        "WHEN education_7cats = 40 THEN 3 WHEN education_7cats IN (50, 60, 70) THEN 4 END AS BIGINT)")
oracle("education", ["snapshots"], f"""
SELECT snapshot_order, education_7cats, {FOUR} AS education FROM (
  SELECT snapshot_order, CAST(CASE WHEN edu_code IN ('10', '11') THEN 10 WHEN edu_code IN ('20', '21', '22') THEN 20
    WHEN edu_code IN ('30', '31', '32') THEN 30 WHEN edu_code IN ('40', '41', '42') THEN 40
    WHEN edu_code IN ('43', '44', '45') THEN 50 WHEN edu_code IN ('46', '47') THEN 60
    WHEN edu_code = '48' THEN 70 END AS INT) AS education_7cats FROM snapshots)""")
oracle("income_lag", ["moved"], """
SELECT *, lag(tot_inc) OVER (PARTITION BY person_id ORDER BY year) AS tot_inc_lag
FROM (SELECT *, cents::DOUBLE / 100 AS tot_inc FROM moved)""")

# The whole panel

_PERSON_ATTRIBUTES = {
    "sex": "nullif(sex, 0)", "birth_prov": "nullif(birth_prov, 0)",
    "ss_reg_prov": "nullif(ss_reg_prov, 0)", "birth_country": "birth_country",
    "death_year_month": "death_year_month", "nationality": "nationality",
    "education": "education", "person_muni_latest": "person_muni_latest", "edu_code": "edu_code",
}
part("p_persons", ["household_joined"],
     consolidated("household_joined", _PERSON_ATTRIBUTES, _HOME_COLUMNS))


def of_cohort(rows: str) -> str:
    return (f"SELECT r.* EXCLUDE (extract_year) FROM {rows} r "
            f"SEMI JOIN p_persons p ON p.person_id = r.person_id AND p.last_extract = r.extract_year")


part("p_kept", ["episodes_read", "p_persons"], of_cohort("episodes_read"))
part("p_clean", ["p_kept"], cleaned("p_kept", [
    c for c in _EPISODE_ORDER if c not in ("person_id", "entry_date", "exit_date", "firm_cc2")]))
part("p_years", ["p_clean"], expanded("p_clean"))
part("p_days", ["p_years"], with_days("p_years"))
part("p_flagged", ["p_days"], f"SELECT *, {FLAGS} FROM p_days")
part("p_bases", ["contributions_read", "autonomous_read", "p_persons"], joined_contributions(
    of_cohort("contributions_read"), of_cohort("autonomous_read")))
part("p_firms", ["p_flagged", "p_bases"], firm_years("p_flagged", "p_bases", MAIN_RAW))
part("p_work_days", ["p_flagged"], work_days("p_flagged"))
part("p_annual", ["p_firms", "p_work_days"], person_years("p_firms", "p_work_days", MAIN_RAW))
part("p_demo", ["p_annual", "p_persons"], with_persons(
    "p_annual", "p_persons", 2024,
    ["birth_year", "birth_month", "birth_date", "sex", "nationality", "birth_country",
     "death_year_month", "education", "person_muni_latest", "first_extract", "last_extract",
     *_HOME_COLUMNS]))
part("p_family", ["p_demo"], family("p_demo", [b for b, _, _, _ in _PAIRS]))
part("p_contract", ["p_family"], contract("p_family"))
part("p_fix", ["episodes_read"], correction("episodes_read", 2003))
part("p_work", ["payments_read"], work("payments_read"))
part("p_unemp", ["payments_read"], income("payments_read", "payment_type = 'C'", "unemp"))
part("p_prof", ["payments_read"], income("payments_read", PROF, "prof"))
part("p_retired", ["pensions_read"], retired("pensions_read"))
part("p_income", ["p_contract", "p_fix", "p_work", "p_unemp", "p_prof", "p_retired"], """
SELECT *, wage + inc_unemp + inc_prof AS tot_inc FROM (
  SELECT c.* EXCLUDE (firm_id, fixed), c.fixed AS firm_id,
         coalesce(w.wage, 0) AS fiscal_wage, coalesce(w.inkind, 0) AS fiscal_inkind,
         coalesce(w.wage, 0) + coalesce(w.inkind, 0) AS wage,
         coalesce(u.inc_unemp, 0) AS inc_unemp, coalesce(u.inkind_unemp, 0) AS inkind_unemp,
         coalesce(f.inc_prof, 0) AS inc_prof, coalesce(f.inkind_prof, 0) AS inkind_prof,
         r.retirementyear
  FROM (SELECT c.*, CAST(CASE WHEN firm_id = 0 THEN coalesce(firm_id_correction, 0) ELSE firm_id END AS VARCHAR) AS fixed
        FROM p_contract c LEFT JOIN p_fix x ON x.firm_cc = c.firm_cc) c
  LEFT JOIN p_work w ON w.person_id = c.person_id AND w.firm_id = c.fixed AND w.year = c.year
  LEFT JOIN p_unemp u ON u.person_id = c.person_id AND u.year = c.year
  LEFT JOIN p_prof f ON f.person_id = c.person_id AND f.year = c.year
  LEFT JOIN p_retired r ON r.person_id = c.person_id)""")
part("p_panel", ["p_income"], f"""
SELECT * EXCLUDE (education, {', '.join(_HOME_COLUMNS)}) REPLACE (coalesce(days, 0) AS days),
       {FOUR.replace('education_7cats', 'education')} AS education, education AS education_7cats,
       CAST(round(age) AS INT) AS age_int, death_year_month // 100 AS death_year,
       lag(tot_inc) OVER (PARTITION BY person_id ORDER BY year) AS tot_inc_lag,
       CAST(coalesce(days_lag1, 0) >= 360 AS TINYINT) AS fullyear_lag1
FROM ({deflated('(' + located('p_income') + ')', ['wage', 'inc_unemp', 'inc_prof', 'tot_inc'])})""")
oracle("panel", ["p_panel"], "SELECT * FROM p_panel")
oracle("panel_summary", ["p_panel"], """
SELECT year, count(DISTINCT person_id) AS n_persons, round(avg(real_wage), 4) AS mean_real_wage,
       round(avg(real_tot_inc), 4) AS mean_real_tot_inc, round(avg(days), 4) AS mean_days
FROM p_panel GROUP BY year""")


# The same panel for sources without firm identifiers and ages, in kind once, lags of calendar years

part("p_annual_lacking", ["p_annual", "p_work_days"],
     f"SELECT d.* EXCLUDE (days_lag1, days_lag2, days_lag3), {_ANY_LAGS.replace('FROM work_days', 'FROM p_work_days')} FROM p_annual d")
part("p_demo_lacking", ["p_annual_lacking", "p_persons"], with_persons(
    "p_annual_lacking", "p_persons", 2024,
    ["birth_year", "birth_month", "birth_date", "sex", "nationality", "birth_country",
     "death_year_month", "education", "person_muni_latest", "first_extract", "last_extract",
     *_HOME_COLUMNS]))
part("p_family_lacking", ["p_demo_lacking"], family("p_demo_lacking", [b for b, _, _, _ in _PAIRS]))
part("p_contract_lacking", ["p_family_lacking"], contract("p_family_lacking"))
part("p_income_lacking", ["p_contract_lacking", "p_work", "p_unemp", "p_prof", "p_retired"], """
SELECT *, wage + inc_unemp + inc_prof AS tot_inc FROM (
  SELECT c.* EXCLUDE (firm_id, age), coalesce(w.wage, 0) AS fiscal_wage, coalesce(w.inkind, 0) AS fiscal_inkind,
         coalesce(w.wage, 0) AS wage,
         coalesce(u.inc_unemp, 0) AS inc_unemp, coalesce(u.inkind_unemp, 0) AS inkind_unemp,
         coalesce(f.inc_prof, 0) AS inc_prof, coalesce(f.inkind_prof, 0) AS inkind_prof, r.retirementyear
  FROM p_contract_lacking c
  LEFT JOIN (SELECT person_id, year, CAST(sum(round(wage * 100)) AS BIGINT)::DOUBLE / 100 AS wage,
                    CAST(sum(round(inkind * 100)) AS BIGINT)::DOUBLE / 100 AS inkind
             FROM p_work GROUP BY person_id, year) w ON w.person_id = c.person_id AND w.year = c.year
  LEFT JOIN p_unemp u ON u.person_id = c.person_id AND u.year = c.year
  LEFT JOIN p_prof f ON f.person_id = c.person_id AND f.year = c.year
  LEFT JOIN p_retired r ON r.person_id = c.person_id)""")
oracle("panel_lacking", ["p_income_lacking"], f"""
SELECT * EXCLUDE (education, {', '.join(_HOME_COLUMNS)}) REPLACE (coalesce(days, 0) AS days),
       {FOUR.replace('education_7cats', 'education')} AS education, education AS education_7cats,
       CAST(NULL AS DOUBLE) AS age, CAST(year - birth_year AS INT) AS age_int, death_year_month // 100 AS death_year,
       (SELECT q.tot_inc FROM p_income_lacking q WHERE q.person_id = d.person_id AND q.year = d.year - 1) AS tot_inc_lag,
       CAST(coalesce(days_lag1, 0) >= 360 AS TINYINT) AS fullyear_lag1
FROM ({deflated('(' + located('p_income_lacking') + ')', ['wage', 'inc_unemp', 'inc_prof', 'tot_inc'])}) d""")

# Files: what is written as text comes back; stages give what the whole plan gives

for _name in ("households", "episodes", "contributions", "payments", "pensions", "file_numbers"):
    ORACLE[f"scan_{_name}"] = ORACLE[f"read_{_name}"]
ORACLE["entity_incremental"] = ORACLE["entity_latest"]
ORACLE["staged_run"] = ORACLE["panel"]
ORACLE["staged_summary"] = ORACLE["panel_summary"]

# By source: the projection, its fields, whether it has parts, and the fields its layout reads
_TEXTS = [("PERSONAL", "raw_persons", 10, False, "10"), ("CONVIVIR", "raw_households", 21, False, "21"),
          ("AFILIAD", "raw_episodes", 30, True, "CASE WHEN extract_year <= 2009 THEN 29 ELSE 30 END"),
          ("COTIZA", "raw_contributions", 20, True, "CASE WHEN extract_year <= 2012 THEN 20 ELSE 15 END"),
          ("FISCAL", "raw_payments", 12, False,
           "CASE WHEN extract_year <= 2015 THEN 9 WHEN extract_year = 2016 THEN 11 ELSE 12 END"),
          ("PRESTAC", "raw_pensions", 11, False, "11"), ("DIVISION", "raw_file_numbers", 3, False, "3")]
LEFT_OUT = "(part > CASE WHEN extract_year <= 2012 THEN 3 ELSE 4 END)"


def _ledger(source: str, rows: str, width: int, parts: bool, needed: str) -> str:
    fields = ", ".join(f"c{i}" for i in range(width))
    return f"""
SELECT '{source}' AS source, extract_year, {'part' if parts else 'CAST(NULL AS INT) AS part'}, count(*) AS n_rows,
       count_if(kind = 2 AND filled < {needed}) AS n_short, count_if(kind = 1) AS n_long, count_if(kind = 4) AS n_undecodable
FROM (SELECT *, CAST(substr(trim(c0), 2) AS BIGINT) % 7 AS kind,
             list_max(list_transform(list_zip([{fields}], range(1, {width} + 1)),
                                     lambda x: CASE WHEN x[1] <> '' THEN x[2] ELSE 0 END)) AS filled
      FROM {rows} {f"WHERE NOT {LEFT_OUT}" if source == 'AFILIAD' else ''})
GROUP BY ALL"""


oracle("scan_ledger", [t[1] for t in _TEXTS], "\nUNION ALL\n".join(_ledger(*t) for t in _TEXTS))
oracle("source_files", ["raw_episodes", "raw_payments", "raw_persons"], f"""
SELECT DISTINCT CAST(extract_year AS INT) AS year, 'AFILIAD' AS source, part,
       CASE WHEN {LEFT_OUT} THEN 'left out' ELSE 'read' END AS status FROM raw_episodes
UNION ALL SELECT DISTINCT CAST(extract_year AS INT), 'FISCAL', CAST(NULL AS INT), s
FROM raw_payments, (VALUES ('read'), ('superseded')) v(s)
UNION ALL SELECT DISTINCT CAST(extract_year AS INT), 'PERSONAL', CAST(NULL AS INT), s
FROM raw_persons, (VALUES ('read'), ('duplicate')) v(s)""")

oracle("person_report", ["contributions", "payments", "snapshots"], """
SELECT name, year, count(*) AS n_rows, count(DISTINCT person_id) AS n_entities, true AS within_error FROM (
  SELECT 'contributions' AS name, CAST(year AS INT) AS year, person_id FROM contributions
  UNION ALL SELECT 'payments', CAST(year AS INT), person_id FROM payments
  UNION ALL SELECT 'snapshots', CAST(extract_year AS INT), person_id FROM snapshots)
GROUP BY GROUPING SETS ((name, year), (name))""")

"""Projections of the test tables into the shapes the operators work on.

The SQL is portable: Spark and DuckDB run the same text, with the table names filled in. The
first group is typed rows; the second (raw_*) is text fields c0, c1, ... as a delivery has them.
"""

import re

TYPED = {
    "episodes": """
SELECT CAST(o.o_custkey AS BIGINT) AS person_id,
       CAST(l.l_suppkey AS BIGINT) AS firm_cc2,
       CAST(year(o.o_orderdate) * 10000 + month(o.o_orderdate) * 100 + day(o.o_orderdate) AS BIGINT) AS entry_date,
       CAST(year(l.l_shipdate) * 10000 + month(l.l_shipdate) * 100 + day(l.l_shipdate) AS BIGINT) AS exit_date,
       CAST(100 + l.l_partkey % 900 AS BIGINT) AS contribution_regime,
       CAST(CASE WHEN l.l_linenumber = 7 THEN 751 + l.l_partkey % 6
                 WHEN l.l_linenumber = 6 THEN NULL
                 ELSE l.l_linenumber * 100 END AS BIGINT) AS job_relationship,
       CAST(l.l_partkey % 560 AS BIGINT) AS contract_type,
       CAST(s.s_nationkey * 2000 + l.l_suppkey % 1000 AS BIGINT) AS firm_muni,
       CAST(CASE WHEN l.l_linenumber <= 2 AND l.l_suppkey % 2 = 0 THEN 0
                 WHEN l.l_linenumber = 3 AND l.l_suppkey % 3 = 0 THEN l.l_suppkey + 100000
                 ELSE l.l_suppkey END AS BIGINT) AS firm_id,
       CAST(l.l_suppkey AS BIGINT) AS firm_cc,
       CAST(l.l_quantity AS BIGINT) AS ptcoef
FROM {lineitem} l JOIN {orders} o ON l.l_orderkey = o.o_orderkey
                  JOIN {supplier} s ON l.l_suppkey = s.s_suppkey""",
    "contributions": """
SELECT CAST(o.o_custkey AS BIGINT) AS person_id,
       CAST(l.l_suppkey AS BIGINT) AS firm_cc2,
       CAST(year(l.l_shipdate) AS SMALLINT) AS year,
       CAST(month(l.l_shipdate) AS INT) AS month,
       CASE WHEN l.l_returnflag = 'R' THEN 1 ELSE 0 END AS autonomous,
       CAST(round(l.l_extendedprice * 100) AS BIGINT) AS cents
FROM {lineitem} l JOIN {orders} o ON l.l_orderkey = o.o_orderkey""",
    "snapshots": """
SELECT CAST(o.o_custkey AS BIGINT) AS person_id,
       CAST(year(o.o_orderdate) AS SMALLINT) AS extract_year,
       concat(CAST(1940 + o.o_custkey % 60 + CASE WHEN o.o_custkey % 97 = 0 THEN o.o_orderkey % 2 ELSE 0 END AS STRING),
              lpad(CAST(1 + o.o_custkey % 12 AS STRING), 2, '0')) AS birth_date,
       CAST(CASE WHEN o.o_custkey % 41 = 0 THEN 3
                 WHEN o.o_orderkey % 4 = 0 THEN 0
                 ELSE 1 + o.o_custkey % 2 END AS TINYINT) AS sex,
       CAST(10 + o.o_orderkey % 40 AS STRING) AS edu_code,
       CAST(o.o_orderkey AS BIGINT) AS snapshot_order,
       CASE WHEN o.o_orderkey % 3 = 0 THEN NULL
            ELSE concat(CAST(1930 + o.o_orderkey % 85 AS STRING), '01') END AS birth_date2,
       CASE WHEN o.o_orderkey % 5 = 0 THEN NULL
            ELSE concat(CAST(1985 + o.o_orderkey % 13 AS STRING), '07') END AS birth_date3
FROM {orders} o""",
    "payments": """
SELECT CAST(o.o_custkey AS BIGINT) AS person_id,
       lpad(CAST(l.l_suppkey AS STRING), CASE WHEN l.l_linenumber % 2 = 0 THEN 15 ELSE 8 END, '0') AS firm_id,
       CAST(year(l.l_shipdate) AS SMALLINT) AS year,
       CASE WHEN l.l_partkey % 50 = 0 THEN NULL
            ELSE substr('ABCDEFGHIJKLM', CAST(1 + l.l_partkey % 13 AS INT), 1) END AS payment_type,
       CAST(CASE WHEN l.l_linenumber = 5 THEN NULL ELSE l.l_linenumber % 4 END AS INT) AS payment_subtype,
       CAST(round(l.l_extendedprice * 100) AS BIGINT) AS wage_cents,
       CAST(l.l_quantity * 100 AS BIGINT) AS inkind_cents
FROM {lineitem} l JOIN {orders} o ON l.l_orderkey = o.o_orderkey""",
    "pensions": """
SELECT CAST(o.o_custkey AS BIGINT) AS person_id,
       CAST(year(o.o_orderdate) AS SMALLINT) AS year,
       CASE WHEN o.o_orderkey % 4 = 0 THEN 'J1'
            WHEN o.o_orderkey % 4 = 1 THEN '25'
            ELSE CAST(20 + o.o_orderkey % 9 AS STRING) END AS class,
       CAST(CASE WHEN o.o_custkey % 11 = 0 THEN NULL ELSE 30 + o.o_orderkey % 10 END AS INT) AS regimep,
       CAST(year(o.o_orderdate) * 100 + month(o.o_orderdate) AS BIGINT) AS date1
FROM {orders} o""",
    # two texts that exercise stripping, safe casts, prefixes and leading zeros
    "texts": r"""
SELECT CAST(l.l_orderkey AS BIGINT) AS l_orderkey, CAST(l.l_linenumber AS INT) AS l_linenumber,
       CASE l.l_partkey % 8
            WHEN 0 THEN concat('  ', CAST(l.l_partkey AS STRING), ' ')
            WHEN 1 THEN concat('N', CAST(l.l_partkey % 120 AS STRING))
            WHEN 2 THEN CAST(l.l_quantity AS STRING)
            WHEN 3 THEN concat(CAST(l.l_partkey AS STRING), 'e3')
            WHEN 4 THEN ''
            WHEN 5 THEN concat('000', CAST(l.l_partkey AS STRING))
            WHEN 6 THEN lpad('0', CAST(1 + l.l_suppkey % 6 AS INT), '0')
            ELSE CASE WHEN l.l_linenumber % 3 = 0 THEN concat('000000000000000000000', CAST(l.l_partkey AS STRING))
                 WHEN l.l_linenumber % 3 = 1 THEN concat('999999999999', CAST(l.l_partkey AS STRING), '00000000')
                 ELSE CAST(CAST(l.l_partkey AS BIGINT) * 30000000 AS STRING) END END AS code,
       concat(CAST(1900 + l.l_partkey % 120 AS STRING), lpad(CAST(1 + l.l_suppkey % 12 AS STRING), 2, '0')) AS yyyymm
FROM {lineitem} l""",
}

# The years of the test tables (1995-2001) are moved to 2011-2017, so that the layouts of
# contributions (changes after 2012) and payments (changes after 2015 and 2016) all occur.
_PERSON = "concat(' P', lpad(CAST(o.o_custkey AS STRING), 9, '0'), ' ')"
_EXTRACT = "CAST(year(o.o_orderdate) + 16 AS SMALLINT)"


def _ymd(c: str) -> str:
    return (f"CAST((year({c}) + 16) * 10000 + month({c}) * 100 + day({c}) AS STRING)")


def _fields(fields: dict[int, str], width: int) -> str:
    return ",\n       ".join(f"{fields.get(i, chr(39) * 2)} AS c{i}" for i in range(width))


# every sixth person has another identifier there, which matches no person
_HOUSEHOLD = {0: f"CASE WHEN o.o_custkey % 6 = 0 THEN concat(' H', lpad(CAST(o.o_custkey AS STRING), 9, '0'), ' ') "
                 f"ELSE {_PERSON} END", 1: "concat(CAST(1940 + o.o_custkey % 60 AS STRING), '01')", 2: "'1'"}
for _i in range(2, 11):
    _HOUSEHOLD[2 * _i - 1] = (
        f"CASE WHEN (o.o_orderkey + {_i}) % 3 = 0 THEN '' ELSE "
        f"concat(CAST(1930 + (o.o_orderkey * {_i}) % 90 AS STRING), '01') END")
    _HOUSEHOLD[2 * _i] = f"CAST(1 + (o.o_orderkey + {_i}) % 2 AS STRING)"

_EPISODE = {
    0: _PERSON,
    1: "CAST(100 + l.l_partkey % 900 AS STRING)",
    2: "lpad(CAST(1 + l.l_partkey % 11 AS STRING), 2, '0')",
    3: "CAST(l.l_partkey % 560 AS STRING)",
    4: "CAST(CAST(l.l_quantity AS INT) + (copies.copy - 1) AS STRING)",
    5: _ymd("o.o_orderdate"),
    6: f"CASE WHEN l.l_partkey % 50 = 0 THEN '' ELSE {_ymd('l.l_shipdate')} END",
    7: "'54'",
    8: "'00'",
    9: "concat('F', lpad(CAST(l.l_suppkey AS STRING), 6, '0'), '  ')",
    10: "CAST(s.s_nationkey * 2000 + l.l_suppkey % 1000 AS STRING)",
    11: "CAST(l.l_partkey % 100 AS STRING)",
    12: "CASE WHEN l.l_partkey % 3 = 0 THEN '' ELSE CAST(l.l_partkey % 500 AS STRING) END",
    13: "CASE WHEN l.l_partkey % 5 = 0 THEN '' ELSE CAST(19900101 + l.l_partkey % 97 AS STRING) END",
    14: "CASE WHEN l.l_linenumber = 7 THEN CAST(751 + l.l_partkey % 6 AS STRING) "
        "WHEN l.l_linenumber = 6 THEN '' ELSE CAST(l.l_linenumber * 100 AS STRING) END",
    15: "CAST(l.l_partkey % 2 AS STRING)",
    16: "CASE WHEN l.l_suppkey % 4 = 0 THEN 'A' ELSE CAST(l.l_suppkey % 10 AS STRING) END",
    17: "substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ', CAST(1 + l.l_suppkey % 26 AS INT), 1)",
    18: "CASE WHEN l.l_linenumber <= 2 AND l.l_suppkey % 2 = 0 THEN '000000000' "
        "WHEN l.l_linenumber = 3 AND l.l_suppkey % 3 = 0 THEN CAST(l.l_suppkey + 100000 AS STRING) "
        "ELSE CAST(l.l_suppkey AS STRING) END",
    19: "concat('C', CAST(l.l_suppkey AS STRING))",
    20: "CAST(s.s_nationkey AS STRING)",
    21: "'0'", 22: "'0'", 23: "'0'", 24: "'0'", 25: "'0'", 26: "'0'", 27: "'0'", 28: "'0'",
    29: "CAST(l.l_partkey % 90 AS STRING)",
}

_BASE = "CAST(CAST(round(l.l_extendedprice * 100) AS BIGINT) AS STRING)"
_DELIVERED = "CASE WHEN o.o_orderkey % 4 = 0 THEN year(o.o_orderdate) + 16 ELSE 2017 END"
_CONTRIBUTION = {0: _PERSON, 1: "concat('F', lpad(CAST(l.l_suppkey AS STRING), 6, '0'))",
                 2: "CAST(year(l.l_shipdate) + 16 AS STRING)"}
for _i in range(3, 20):
    # month m sits at 7 + m until the 2012 extract and at 2 + m after it
    _CONTRIBUTION[_i] = (
        f"CASE WHEN month(l.l_shipdate) = {_i} - CASE WHEN {_DELIVERED} <= 2012 THEN 7 ELSE 2 END "
        f"THEN {_BASE} ELSE '' END")

_INKIND = "CAST(CAST(l.l_quantity * 100 AS BIGINT) AS STRING)"
_PAYMENT = {
    0: _PERSON,
    1: "substr('ABCDEFGH', CAST(1 + l.l_suppkey % 8 AS INT), 1)",
    2: "lpad(CAST(l.l_suppkey AS STRING), CASE WHEN l.l_linenumber % 2 = 0 THEN 15 ELSE 8 END, '0')",
    4: "CASE WHEN l.l_partkey % 50 = 0 THEN '' "
       "ELSE substr('ABCDEFGHIJKLM', CAST(1 + l.l_partkey % 13 AS INT), 1) END",
    5: "CASE WHEN l.l_linenumber = 5 THEN '' ELSE lpad(CAST(l.l_linenumber % 4 AS STRING), 2, '0') END",
    6: _BASE,
    7: "CASE WHEN l.l_linenumber = 1 THEN '' ELSE CAST(l.l_partkey % 700 AS STRING) END",
    8: _INKIND,
    10: _INKIND,
    11: "CAST(l.l_suppkey % 300 AS STRING)",
}

_FACTS = "{lineitem} l JOIN {orders} o ON l.l_orderkey = o.o_orderkey"

RAW = {
    "raw_persons": f"""
SELECT {_EXTRACT} AS extract_year,
       {_fields({
        0: _PERSON,
        1: "CASE WHEN o.o_custkey % 53 = 0 AND year(o.o_orderdate) % 2 = 0 THEN '' ELSE "
           "concat(CAST(1940 + o.o_custkey % 60 + CASE WHEN o.o_custkey % 97 = 0 "
           "THEN year(o.o_orderdate) % 2 ELSE 0 END AS STRING), "
           "lpad(CAST(1 + o.o_custkey % 12 AS STRING), 2, '0')) END",
        2: "CASE WHEN o.o_custkey % 41 = 0 THEN '3' "
           "WHEN o.o_custkey % 89 = 0 THEN CAST(1 + o.o_orderkey % 2 AS STRING) "
           "WHEN year(o.o_orderdate) % 4 = 0 THEN '0' "
           "ELSE CAST(1 + o.o_custkey % 2 AS STRING) END",
        3: "CASE WHEN o.o_custkey % 5 = 0 THEN 'N99' WHEN o.o_custkey % 7 = 0 THEN 'X1' "
           "ELSE concat('N', CAST(o.o_custkey % 120 AS STRING)) END",
        4: "concat('N', CAST(o.o_custkey % 53 AS STRING))",
        5: "CAST(o.o_custkey % 53 AS STRING)",
        6: "CAST((1 + o.o_custkey % 52) * 1000 + year(o.o_orderdate) % 100 AS STRING)",
        7: "CASE WHEN o.o_custkey % 31 = 0 THEN concat(CAST(year(o.o_orderdate) + 16 AS STRING), '06') "
           "ELSE '' END",
        8: "CASE WHEN o.o_custkey % 13 = 0 THEN 'N99' "
           "ELSE concat(' N', CAST(o.o_custkey % 110 AS STRING)) END",
        9: "CAST(10 + (o.o_custkey + year(o.o_orderdate)) % 40 AS STRING)",
       }, 10)}
FROM {{orders}} o""",
    "raw_households": f"""
SELECT {_EXTRACT} AS extract_year,
       {_fields(_HOUSEHOLD, 21)}
FROM {{orders}} o""",
    # every second line item comes in two copies that differ in one field
    "raw_episodes": f"""
SELECT CAST(CASE WHEN l.l_linenumber % 3 = 0 THEN year(o.o_orderdate) + 16 ELSE 2017 END AS SMALLINT) AS extract_year,
       CAST(1 + l.l_orderkey % 4 AS INT) AS part,
       {_fields(_EPISODE, 30)}
FROM {_FACTS} JOIN {{supplier}} s ON l.l_suppkey = s.s_suppkey
     JOIN (SELECT 1 AS kind, 1 AS copy UNION ALL SELECT 2, 1 UNION ALL SELECT 2, 2) copies
       ON copies.kind = CASE WHEN l.l_linenumber = 2 THEN 2 ELSE 1 END""",
    "raw_contributions": f"""
SELECT CAST({_DELIVERED} AS SMALLINT) AS extract_year,
       CAST(CASE WHEN l.l_returnflag = 'R' THEN 13 ELSE 1 + l.l_orderkey % 12 END AS INT) AS part,
       {_fields(_CONTRIBUTION, 20)}
FROM {_FACTS}""",
    "raw_payments": f"""
SELECT CAST(year(l.l_shipdate) + 16 AS SMALLINT) AS extract_year,
       {_fields(_PAYMENT, 12)}
FROM {_FACTS}""",
    "raw_pensions": f"""
SELECT {_EXTRACT} AS extract_year,
       {_fields({
        0: _PERSON,
        1: "CAST(year(o.o_orderdate) + 16 AS STRING)",
        3: "CASE WHEN o.o_orderkey % 4 = 0 THEN 'J1' WHEN o.o_orderkey % 4 = 1 THEN '25' "
           "ELSE CAST(20 + o.o_orderkey % 9 AS STRING) END",
        9: "CASE WHEN o.o_custkey % 11 = 0 THEN '' ELSE CAST(30 + o.o_orderkey % 10 AS STRING) END",
        10: "CAST((year(o.o_orderdate) + 16) * 100 + month(o.o_orderdate) AS STRING)",
       }, 11)}
FROM {{orders}} o""",
    "raw_file_numbers": f"""
SELECT {_EXTRACT} AS extract_year,
       {_fields({0: "concat('P', lpad(CAST(o.o_custkey AS STRING), 9, '0'))",
                 1: "CAST(1 + o.o_custkey % 4 AS STRING)",
                 2: "CASE WHEN o.o_custkey % 9 = 0 THEN '500' ELSE CAST(1 + o.o_custkey % 12 AS STRING) END"}, 3)}
FROM {{orders}} o""",
    # delivered file paths of all spellings
    "raw_paths": """
SELECT CAST(o.o_orderkey AS BIGINT) AS o_orderkey,
       concat('hdfs://store/raw/', CAST(2004 + o.o_orderkey % 24 AS STRING), '/', name_of.prefix,
              CASE WHEN name_of.with_year = 1
                   THEN CAST(2004 + o.o_orderkey % 24 - CASE WHEN o.o_custkey % 10 = 0 THEN 1 ELSE 0 END AS STRING)
                   ELSE '' END,
              name_of.middle,
              CASE WHEN name_of.with_part = 1 THEN CAST(1 + o.o_custkey % 13 AS STRING) ELSE '' END,
              name_of.ending) AS path
FROM {orders} o JOIN (
    SELECT 0 AS k, 'XYZ' AS prefix, 1 AS with_year, 'AFILIAD' AS middle, 1 AS with_part, '_CDF.TXT' AS ending
    UNION ALL SELECT 1, 'XYZ', 1, 'PERSONAL', 0, '_CDF.txt'
    UNION ALL SELECT 2, 'XYZ', 1, 'BCOTIZA', 1, '.TXT'
    UNION ALL SELECT 3, 'AFILANON', 0, '', 1, '.trs'
    UNION ALL SELECT 4, 'DATOS_FISCALES', 0, '', 0, '.trs'
    UNION ALL SELECT 5, 'XYZ', 1, 'COTIZA', 1, '.txt'
    UNION ALL SELECT 6, 'XYZ', 1, 'AFLIAID', 1, '_CDF.TXt'
    UNION ALL SELECT 7, 'XYZ', 1, '.F2013.AFILIA', 1, '_CDF.txt'
    UNION ALL SELECT 8, 'XYZ', 1, 'COTIZA', 1, '_CDFF.TXT'
    UNION ALL SELECT 9, 'XYZ', 1, 'PRESTAC', 0, '_SDF.TXT'
    UNION ALL SELECT 10, 'XYZ', 1, 'PERSONAL', 0, '.TXT'
    UNION ALL SELECT 11, 'EST.LABT2004.COTIANON.FICHERO', 0, '', 1, '.TXT'
    UNION ALL SELECT 12, 'EST.LABT2004.PREANON', 0, '', 0, '.TXT'
    UNION ALL SELECT 13, 'XYZ', 1, 'DIVISION', 0, '_CDF.TXT/part-00000.txt'
  ) name_of ON o.o_custkey % 14 = name_of.k""",
}

PROJECTIONS = {**TYPED, **RAW}


def tables_of(name: str) -> list[str]:
    return sorted(set(re.findall(r"\{(\w+)\}", PROJECTIONS[name])))


def duckdb_text(name: str) -> str:
    """The projection over the registered table names."""
    return PROJECTIONS[name].format(**{t: t for t in tables_of(name)})

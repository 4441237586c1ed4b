"""Which extract year, source type and part a raw file holds, read off its path.

Deliveries were named differently from year to year. Instead of renaming files, the path is
matched in Spark, so one scan can cover every year. A "file" may also be a directory of
``part-*`` pieces.
"""

from pyspark.sql import Column
from pyspark.sql import functions as F

SOURCES = ["AFILIAD", "CONVIVIR", "COTIZA", "DIVISION", "FISCAL", "PERSONAL", "PRESTAC"]

_ANY = "|".join(SOURCES)
OPEN = 9999  # regular names go on

# The parts an extract is made of, by source, as (last extract, last part); parts count
# from one, and files of other parts are left out. Other sources come in one piece.
PART_LIMITS = {"AFILIAD": [(2012, 3), (OPEN, 4)], "COTIZA": [(OPEN, 13)]}

# File name patterns, as (first folder year, last folder year, pattern, source).
# Group 1 is the source where none is given; the last group is the part (may be empty).
# A pattern with the text {year} must repeat the folder year.
NAME_PATTERNS = [
    # the regular name
    (2004, OPEN, rf"^[A-Z]+{{year}}({_ANY})(\d*)_CDF\.TXT$", None),
    # 2004: mainframe data set names, some doubled
    (2004, 2004, r"^EST\.LABT2004\.AFILANON\.FICHERO([13])\.TXT$", "AFILIAD"),
    (2004, 2004, r"^EST\.LABT2004\.AFILANON\.FICHERO(2)"
                 r"\.EST\.LABT2004\.AFILANON\.FICHERO2\.EST\.LAB\.TXT$", "AFILIAD"),
    (2004, 2004, r"^EST\.LABT2004\.COTIANON\.FICHERO([1-57-9])\.TXT$", "COTIZA"),
    (2004, 2004, r"^EST\.LABT2004\.COTIANON\.FICHER(1[0-2])\.TXT$", "COTIZA"),
    (2004, 2004, r"^EST\.LABT2004\.COTIANON\.FICHERO(6)"
                 r"\.EST\.LABT2004\.COTIANON\.FICHERO6\.EST\.LAB\.TXT$", "COTIZA"),
    (2004, 2004, r"^EST\.LABT2004\.PERSANON()\.TXT$", "PERSONAL"),
    (2004, 2004, r"^EST\.LABT2004\.PREANON()\.TXT$", "PRESTAC"),
    (2004, 2004, r"^EST\.LABT2004\.DIVISION()\.TXT$", "DIVISION"),
    (2004, 2004, r"^EST\.LABT2004\.CPROPIA\.ANONIMO()\.TXT$", "CONVIVIR"),
    # 2005: a B before the source, no suffix
    (2005, 2005, rf"(?i)^[A-Z]+{{year}}B({_ANY})(\d*)\.TXT$", None),
    # 2006-2008: no year, other names, .trs
    (2006, 2008, r"(?i)^AFILANON(\d+)\.trs$", "AFILIAD"),
    (2006, 2008, r"(?i)^COTIANON(\d+)\.trs$", "COTIZA"),
    (2006, 2008, r"^CONVIVI()\.trs$", "CONVIVIR"),
    (2006, 2008, r"^PERSANON()\.trs$", "PERSONAL"),
    (2006, 2008, r"^PREANON()\.trs$", "PRESTAC"),
    (2006, 2008, r"^DATOS_FISCALES()\.trs$", "FISCAL"),
    (2006, 2008, r"^DIVISION()\.trs$", "DIVISION"),
    # 2009: contribution files without the suffix
    (2009, 2009, r"(?i)^[A-Z]+{year}COTIZA(\d+)\.TXT$", "COTIZA"),
    # 2010: misspelt source; 2011: another year inside the name
    (2010, 2010, r"^[A-Z]+{year}(?i:AFLIAID)(\d*)_CDF\.(?i:TXT)$", "AFILIAD"),
    (2011, 2011, r"(?i)^[A-Z]+{year}\.F2013\.AFILIA(\d+)_CDF\.txt$", "AFILIAD"),
    # 2015, 2016: misspelt suffix; 2020, 2021: no suffix on the person file
    (2015, 2015, rf"^[A-Z]+{{year}}({_ANY})(\d*)_CDFF\.(?i:TXT)$", None),
    (2016, 2016, rf"^[A-Z]+{{year}}({_ANY})(\d*)_SDF\.(?i:TXT)$", None),
    (2020, 2021, r"(?i)^[A-Z]+{year}PERSONAL()\.TXT$", "PERSONAL"),
    # any spelling of the extension
    (2009, OPEN, rf"^[A-Z]+{{year}}({_ANY})(\d*)_CDF\.(?i:TXT)$", None),
]


def folder_year(path: Column) -> Column:
    """The last folder of the path that is a year."""
    return F.regexp_extract(path, r"^.*/(20\d\d)/", 1).try_cast("int")


def file_name(path: Column) -> Column:
    """The last path component that is not a piece of a directory."""
    return F.regexp_extract(path, r"([^/]+?)(?:/part-[^/]*)?$", 1)


def _matches(path: Column) -> list[tuple[Column, Column]]:
    """For every pattern, whether the path is of that spelling, and what it then is."""
    year, name = folder_year(path), file_name(path)
    # every pattern sees the folder year as the text {year}
    subject = F.replace(name, year.cast("string"), F.lit("{year}"))
    out = []
    for first, last, pattern, source in NAME_PATTERNS:
        regex = pattern.replace("{year}", r"\{year\}")
        seen = subject if "{year}" in pattern else name
        named = F.lit(source) if source else F.upper(F.regexp_extract(seen, regex, 1))
        part = F.regexp_extract(seen, regex, 1 if source else 2).try_cast("int")
        identity = F.struct(year.alias("year"), named.alias("source"), part.alias("part"))
        out.append((year.between(first, last) & seen.rlike(regex), identity))
    return out


def delivered_file(path: Column) -> Column:
    """The path of the file, or of the directory that holds it in pieces."""
    return F.regexp_replace(path, r"/part-[^/]*$", "")


def wanted_part(identity: Column, limits: dict[str, list[tuple[int, int]]] = PART_LIMITS) -> Column:
    """Whether a file is of a part that its extract is made of; true for sources in one piece."""
    wanted = F.lit(True)
    for source, steps in limits.items():
        last = F.lit(None).cast("int")
        for until, part in sorted(steps, reverse=True):
            last = F.when(identity["year"] <= until, part).otherwise(last)
        inside = F.coalesce(identity["part"].between(F.lit(1), last), F.lit(False))
        wanted = F.when(identity["source"] == source, inside).otherwise(wanted)
    return wanted


def spelling(path: Column) -> Column:
    """Number of the first pattern that the path matches; the regular name comes first."""
    found = F.lit(None).cast("int")
    for k, (hit, _) in reversed(list(enumerate(_matches(path)))):
        found = F.when(hit, k).otherwise(found)
    return found


def source_identity(path: Column) -> Column:
    """Struct (year, source, part) of a path; null for files that are not wanted.

    Files of another year left in a folder never match, since the year in a name has to be
    the folder's. ``part`` is null for sources that come in one piece.
    """
    found = F.lit(None).cast("struct<year:int,source:string,part:int>")
    for hit, identity in reversed(_matches(path)):
        found = F.when(hit, identity).otherwise(found)
    return found

"""Secret scans with multipart credential linking.

Exact patterns give base spans. Weak parts (a token that may be a secret, a name that may be an
access identifier) are reported only if a complementary part lies within the same scope: an interval
join of parts of one document by their positions, as a window with a range frame, which needs no
pairs of parts.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from annualis.llm.common import written
from annualis.llm.spans import counted, found, located, ranked, spelled

ASSIGN = (r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"(?<![0-9a-f])[0-9a-f]{32,}"  # of runs of any length, those of 32 characters or more
KINDS = ("assign", "access", "hex")

IDENTIFIER = (r"""(?<![A-Za-z0-9_])(?i:user(?:name)?|login|client_?id|key_?id|account)["']?\x20*[:=]\x20*["']?"""
              r"[A-Za-z0-9_.@-]{3,}+")
# A dotted run with a part of 20 characters or more that has a digit and a letter.
LONG_PART = r"(?=[A-Za-z+/_=-]*+[0-9])(?=[0-9+/_=-]*+[A-Za-z])[A-Za-z0-9+/_=-]{20}"
TOKEN = (r"(?<![A-Za-z0-9+/_=.-])(?=(?:(?!" + LONG_PART + r")[A-Za-z0-9+/_=-]++\.)*+" + LONG_PART + ")"
         r"[A-Za-z0-9+/_=-]++(?:\.[A-Za-z0-9+/_=-]++)*+")
ENDPOINT = (r"(?i)(?<![A-Za-z0-9])(?:https?|ftp|s3|mongodb|postgres(?:ql)?|mysql|redis|amqp)://[^\s\"'<>]++"
            r"|(?<![0-9.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?::[0-9]{1,5})?(?![0-9.])")
SCOPE = 400  # code points between the end of a part and the start of one that belongs to it
ROLES = {"assign": "secret", "hex": "secret", "access": "identifier", "weak_secret": "secret",
         "weak_identifier": "identifier", "endpoint": "endpoint"}
NEEDS = {"weak_secret": ("identifier", "endpoint"), "weak_identifier": ("secret",)}


def _apart(spans: Column, others: Column) -> Column:
    """Spans that overlap none of the others."""
    return F.filter(spans, lambda s: ~F.exists(others, lambda o: (o["start"] < s["end"]) & (s["start"] < o["end"])))


def parts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, th (hash of the text), base spans and weak parts of every text."""
    none = F.array().cast("array<string>")
    text = F.col("text")
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    rows = rows.withColumns({
        "th": F.xxhash64("text"), "m_assign": found(text, ASSIGN),
        "m_access": F.when(F.contains(text, F.lit("AKIA")), found(text, ACCESS)).otherwise(none),
        "m_hex": found(text, HEX), "m_token": found(text, TOKEN),
        "m_name": F.when(F.contains(text, F.lit(":")) | F.contains(text, F.lit("=")), found(text, IDENTIFIER)).otherwise(none),
        "m_end": found(text, ENDPOINT)})
    value = F.when(F.size("m_assign") > 0, found(text, ASSIGN, 1)).otherwise(none)
    assign = F.filter(F.arrays_zip(located(text, ASSIGN, F.col("m_assign")).alias("s"), value.alias("v")),
                      lambda x: F.length(x["v"]) >= 8)
    access = F.filter(located(text, ACCESS, F.col("m_access")), lambda s: F.length(s["match"]) >= 16)
    rows = rows.withColumns({
        "base": F.concat(ranked(F.transform(assign, lambda x: x["s"]), "assign", 0), ranked(access, "access", 1),
                         ranked(located(text, HEX, F.col("m_hex")), "hex", 2)),
        "name": ranked(located(text, IDENTIFIER, F.col("m_name")), "weak_identifier", 4),
        "token": ranked(located(text, TOKEN, F.col("m_token")), "weak_secret", 3),
        "endpoint": ranked(located(text, ENDPOINT, F.col("m_end")), "endpoint", 5)})
    rows = rows.withColumn("name", _apart(F.col("name"), F.col("base")))
    rows = rows.withColumn("token", _apart(F.col("token"), F.concat("base", "name", "endpoint")))
    return rows.select("doc_id", "th", "base", F.concat("name", "token").alias("weak"), "endpoint")


def linked(found_: DataFrame, scope: int = SCOPE) -> DataFrame:
    """doc_id, th and added: the weak parts with a complementary part at most scope away.

    Of the parts that start no later than scope after a part's end, one reaches to scope before its
    start if and only if the largest end does. So a part is an event at its start, and a weak one
    also asks at its end + scope for the largest end so far.
    """
    role = F.create_map(*[F.lit(x) for pair in ROLES.items() for x in pair])
    at = F.col("p.start").cast("long"), F.col("p.end").cast("long") + scope
    events = F.array(F.struct(at[0].alias("at"), F.lit(False).alias("asks")), F.struct(at[1].alias("at"), F.lit(True).alias("asks")))
    rows = (found_.filter("size(weak) > 0").dropDuplicates(["doc_id", "th"])
            .select("doc_id", "th", F.explode(F.concat("base", "weak", "endpoint")).alias("p"))
            .select("doc_id", "th", "p", role[F.col("p.kind")].alias("role"), F.explode(events).alias("e"))
            .filter(~F.col("e.asks") | F.col("p.kind").isin(*NEEDS)))
    so_far = (Window.partitionBy("doc_id", "th").orderBy("e.at", "e.asks")
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    for r in sorted(set(ROLES.values())):
        rows = rows.withColumn(f"end_{r}", F.max(F.when(~F.col("e.asks") & (F.col("role") == r), F.col("p.end"))).over(so_far))
    complete = F.lit(False)
    for kind, needs in NEEDS.items():
        last = F.greatest(F.lit(-scope - 1), *[F.col(f"end_{n}") for n in needs])
        complete = complete | ((F.col("p.kind") == kind) & (last >= F.col("p.start") - scope))
    return rows.filter(F.col("e.asks") & complete).groupBy("doc_id", "th").agg(F.collect_list("p").alias("added"))


def scan_secrets(docs: DataFrame, scope: int = SCOPE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Secrets of every text: doc_id, base (spans of the exact patterns) and spans (all).

    A null or empty text has none. Repeated rows each come back with the same spans, and rows with a
    null doc_id like any other; parts are only linked within a text. Weak parts that overlap a base span
    are never reported. An empty table gives no rows.
    """
    rows = written(parts(docs, id_col, text_col), "secret-parts")
    extra = linked(rows, scope).withColumnsRenamed({"doc_id": "other_id", "th": "other_th"})
    joined = rows.join(extra, (rows["th"] == extra["other_th"]) & rows["doc_id"].eqNullSafe(extra["other_id"]), "left")
    spans = F.when(F.col("added").isNull(), F.col("base")).otherwise(F.concat("base", "added"))
    return joined.select("doc_id", "base", spans.alias("spans"))


def report(found_: DataFrame) -> DataFrame:
    """Counts of the base spans by kind, their digest, and all spans as text."""
    counts = [counted(F.col("base"), k).alias(f"n_{k}") for k in KINDS]
    return found_.select("doc_id", *counts, F.sha2(spelled(F.col("base")), 256).alias("base_sha256"),
                         spelled(F.col("spans")).alias("spans"))

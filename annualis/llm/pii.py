"""Personal data by candidate gradient boosting, with native columns only.

Exact patterns give base spans. Further generators propose overlapping spans with high recall;
boosted trees score them by format and context, and thresholds calibrated on held-out documents, one
for each kind, select those that are added. The trees learn from all candidates of the input: one
that overlaps a base span, or whose plain spelling is one, is an example of personal data, any other
one is not. As the features are few small integers, what the driver gets to fit on is one row per
combination, however large the input.
"""

from dataclasses import dataclass, field
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from annualis.llm.spans import counted, digits, found, located, luhn, ranked, spelled

# Possessive and guarded forms of the base patterns: same matches, no search from inside a run.
EMAIL = r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"(?<![0-9])(?<![0-9][ -])[0-9](?:[ -]?[0-9]){13,18}(?![ -]?[0-9])"
PHONE = r"\+[0-9][ ().0-9-]+[0-9]"
BYTE = r"0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"
KINDS = ("email", "ip", "card", "phone")

# Generators: numbers of seven digits or more, and whatever is written like an address with its @ as a
# word. Runs are possessive and guarded, so none is matched from its middle, however long.
NUMBER = r"(?<![0-9A-Za-z.+-])\(?[0-9](?:[ ().-]{0,2}[0-9]){6,}+(?![0-9A-Za-z])"
AT, DOT = r"(?i: ?[(\[{] ?at ?[)\]}] ?)", r"(?i: ?[(\[{] ?dot ?[)\]}] ?)"
SPELT_EMAIL = (rf"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++{AT}[A-Za-z0-9-]++"
               rf"(?:(?:\.|{DOT})[A-Za-z0-9-]++)*+")
ADDRESS = r"^[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}$"
CUES = ((1, r"(?i)tel|phone|call|fax|mobil"), (2, r"(?i)card|visa|account|iban"),
        (3, r"(?i)\bip\b|host|server"), (4, r"(?i)mail"))
CONTEXT = 32  # code points before a candidate in which cues count

FEATURES = ("n_digits", "n_seps", "parens", "dots", "spelt", "before", "after", "cue")
ROUNDS, RATE, SMOOTH = 24, 0.3, 1.0
PRECISION = 0.95
SPAN = "struct<kind:string,rank:int,start:int,end:int>"


def base_columns(text: Column) -> dict[str, Column]:
    """Matches of the base patterns (texts); a pattern runs only where its fixed character is."""
    none = F.array().cast("array<string>")
    return {"m_email": F.when(F.contains(text, F.lit("@")), found(text, EMAIL)).otherwise(none),
            "m_ip": found(text, IP), "m_card": found(text, CARD),
            "m_phone": F.when(F.contains(text, F.lit("+")), found(text, PHONE)).otherwise(none),
            "m_number": found(text, NUMBER),
            "m_spelt": F.when(text.rlike(r"(?i)[(\[{] ?at ?[)\]}]"), found(text, SPELT_EMAIL)).otherwise(none)}


def _valid(kind: str):
    tests = {"email": lambda s: F.lit(True),
             "ip": lambda s: s["match"].rlike(rf"^{BYTE}(?:\.{BYTE}){{3}}$"),
             "card": lambda s: luhn(digits(s["match"])),
             "phone": lambda s: F.length(digits(s["match"])).between(10, 15)}
    return tests[kind]


def with_spans(docs: DataFrame, text: str = "text") -> DataFrame:
    """Adds base (array of SPAN) and candidates (array of SPAN with features, label, and whether they
    overlap a base span) to docs."""
    docs = docs.withColumns(base_columns(F.col(text)))
    patterns = {"email": EMAIL, "ip": IP, "card": CARD, "phone": PHONE}
    base = F.concat(*[ranked(F.filter(located(F.col(text), p, F.col(f"m_{k}")), _valid(k)), k, r)
                      for r, (k, p) in enumerate(patterns.items())])
    numbers = located(F.col(text), NUMBER, F.col("m_number"))
    spelt = located(F.col(text), SPELT_EMAIL, F.col("m_spelt"))
    docs = docs.withColumns({"base": base, "numbers": F.concat(numbers, spelt)})
    candidates = F.transform(F.col("numbers"), lambda s: _features(F.col(text), s))
    docs = docs.withColumn("candidates", candidates)
    labelled = F.transform(F.col("candidates"), lambda c: c.withField("known", F.exists(
        "base", lambda b: (b["start"] < c["end"]) & (c["start"] < b["end"]))))
    labelled = F.transform(labelled, lambda c: c.withField("label", (c["known"] | c["address"]).cast("int")))
    names = [*base_columns(F.lit("")), "numbers"]
    return docs.withColumn("candidates", labelled).drop(*names)


def _features(text: Column, s: Column) -> Column:
    match, n = s["match"], F.length(digits(s["match"]))
    at = F.when(match.rlike("[A-Za-z]"), match)  # numbers hold no letters
    plain = F.regexp_replace(F.regexp_replace(at, AT, "@"), DOT, ".")
    before = F.substring(text, F.greatest(F.lit(1), s["start"] + 1 - CONTEXT),
                         F.least(F.lit(CONTEXT), s["start"]))
    after = F.substring(text, s["end"] + 1, F.lit(1))
    cue = F.lit(0)
    for value, pattern in reversed(CUES):
        cue = F.when(before.rlike(pattern), value).otherwise(cue)
    kind = (F.when(match.rlike("[A-Za-z]"), "email").when(match.rlike(rf"^{BYTE}(?:\.{BYTE}){{3}}$"), "ip")
            .when(n >= 13, "card").otherwise("phone"))
    rank = reduce(lambda acc, kr: F.when(kind == kr[1], kr[0]).otherwise(acc), enumerate(KINDS), F.lit(3))
    return F.struct(
        kind.alias("kind"), rank.cast("int").alias("rank"), s["start"].alias("start"), s["end"].alias("end"),
        F.least(n, F.lit(20)).alias("n_digits"),
        F.least(F.length(F.regexp_replace(match, "[^ .-]", "")), F.lit(5)).alias("n_seps"),
        match.rlike(r"[()]").cast("int").alias("parens"),
        F.coalesce(plain, match).rlike(r"\.[^@]*$").cast("int").alias("dots"), at.isNotNull().cast("int").alias("spelt"),
        F.when(before == "", 0).when(before.rlike(r"\s$"), 1).otherwise(2).alias("before"),
        F.when(after == "", 0).when(after.rlike(r"\s"), 1).otherwise(2).alias("after"), cue.alias("cue"),
        F.coalesce(plain.rlike(ADDRESS), F.lit(False)).alias("address"))


@dataclass
class Trees:
    """Boosted trees of depth two over FEATURES: (feature, cut, ((feature, cut, low, high), ...))."""
    bias: float = 0.0
    nodes: list = field(default_factory=list)
    thresholds: dict[int, float] = field(default_factory=dict)  # by rank of the kind: margin from which one is added

    def margin(self, rows: np.ndarray) -> np.ndarray:
        out = np.full(len(rows), self.bias)
        for f, cut, sides in self.nodes:
            values = [np.where(rows[:, g] <= c, low, high) for g, c, low, high in sides]
            out += np.where(rows[:, f] <= cut, *values)
        return out

    def column(self, c: Column) -> Column:
        """The margin as an expression over a candidate struct."""
        out = F.lit(self.bias)
        for f, cut, sides in self.nodes:
            values = [F.when(c[FEATURES[g]] <= k, low).otherwise(high) for g, k, low, high in sides]
            out = out + F.when(c[FEATURES[f]] <= cut, values[0]).otherwise(values[1])
        return out


def _split(rows: np.ndarray, slope: np.ndarray, curve: np.ndarray) -> tuple[int, int, float, float]:
    """The cut with the largest gain, and the values left and right of it."""
    best = (-1.0, 0, int(rows[:, 0].max(initial=0)), 0.0, 0.0)
    for f in range(rows.shape[1]):
        for cut in np.unique(rows[:, f]):
            low = rows[:, f] <= cut
            sides = [(slope[s].sum(), curve[s].sum() + SMOOTH) for s in (low, ~low)]
            gain = sum(g * g / h for g, h in sides)
            if gain > best[0] + 1e-12:
                best = (gain, f, int(cut), *(float(RATE * g / h) for g, h in sides))
    return best[1:]


def fit_trees(rows: np.ndarray, positive: np.ndarray, total: np.ndarray) -> Trees:
    """Gradient boosting with log loss on combinations of features with their counts."""
    trees = Trees()
    if not total.sum():
        return trees
    share = (positive.sum() + 1) / (total.sum() + 2)
    trees.bias = float(np.log(share / (1 - share)))
    for _ in range(ROUNDS):
        p = 1 / (1 + np.exp(-trees.margin(rows)))
        slope, curve = positive - total * p, total * p * (1 - p)
        f, cut, _, _ = _split(rows, slope, curve)
        sides = tuple(_split(rows[s], slope[s], curve[s]) if s.any() else (0, 0, 0.0, 0.0)
                      for s in (rows[:, f] <= cut, rows[:, f] > cut))
        trees.nodes.append((f, cut, sides))
    return trees


def calibrate(trees: Trees, rows: np.ndarray, positive: np.ndarray, total: np.ndarray) -> float:
    """The least margin from which at least PRECISION of the held-out candidates are positive, and one
    at least is."""
    margin = trees.margin(rows)
    for m in np.unique(margin):
        chosen = margin >= m
        if positive[chosen].sum() >= max(1, PRECISION * total[chosen].sum()):
            return float(m)
    return np.inf


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> Trees:
    """Learns from all candidates of docs; every fifth document by hash calibrates the threshold."""
    rows = with_spans(_texts(docs, id_col, text_col)).filter("size(candidates) > 0")
    grid = (rows.select((F.pmod(F.xxhash64("doc_id"), F.lit(5)) == 0).alias("held"), F.explode("candidates").alias("c"))
            .groupBy("held", F.col("c.rank").alias("rank"), *[F.col(f"c.{f}").alias(f) for f in FEATURES])
            .agg(F.sum("c.label").alias("positive"), F.count("*").alias("total"))
            .orderBy("held", "rank", *FEATURES).collect())  # one row per combination of small integers
    table = np.array([[r[f] for f in FEATURES] for r in grid], dtype=np.int64).reshape(-1, len(FEATURES))
    held = np.array([r["held"] for r in grid], dtype=bool)
    positive, total = (np.array([r[c] for r in grid], dtype=np.float64) for c in ("positive", "total"))
    trees = fit_trees(table[~held], positive[~held], total[~held])
    ranks = np.array([r["rank"] for r in grid], dtype=np.int64)
    for rank in np.unique(ranks[held]).tolist():
        mine = held & (ranks == rank)
        least = calibrate(trees, table[mine], positive[mine], total[mine])
        if least < np.inf:
            trees.thresholds[rank] = least
    return trees


def _texts(docs: DataFrame, id_col: str, text_col: str, *more: str) -> DataFrame:
    return docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"), *more)


def chosen(trees: Trees) -> Column:
    """Base spans and the candidates that the trees add: those that overlap no base span and reach
    the threshold of their kind."""
    if not trees.thresholds:
        return F.col("base")

    def wanted(c):
        least = F.lit(None).cast("double")
        for rank, value in trees.thresholds.items():
            least = F.when(c["rank"] == rank, F.lit(value)).otherwise(least)
        return ~c["known"] & (trees.column(c) >= least)
    return F.concat("base", F.transform(F.filter("candidates", wanted), lambda c: F.struct(
        c["kind"], c["rank"], c["start"], c["end"]).cast(SPAN)))


def find_pii(docs: DataFrame, trees: Trees | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Personal data of every text: doc_id, base (spans of the exact patterns) and spans (all).

    A null or empty text has none. Repeated rows each come back, a null doc_id as such. An empty table
    has no rows, and nothing is learnt from it. trees: a fitted model, else it is fitted on docs.
    """
    trees = trees or fit(docs, id_col, text_col)
    return with_spans(_texts(docs, id_col, text_col)).select("doc_id", "base", chosen(trees).alias("spans"))


def report(found_: DataFrame) -> DataFrame:
    """Counts of the base spans by kind, their digest, and all spans as text."""
    counts = [counted(F.col("base"), k).alias(f"n_{k}") for k in KINDS]
    return found_.select("doc_id", *counts, F.sha2(spelled(F.col("base")), 256).alias("base_sha256"),
                         spelled(F.col("spans")).alias("spans"))


def redacted(text: Column, spans: Column) -> Column:
    """The text with every span replaced by its kind in brackets; overlapping spans as one."""
    order = F.array_sort(F.transform(spans, lambda s: F.struct(
        s["start"].alias("start"), s["rank"].alias("rank"), s["end"].alias("end"), s["kind"].alias("kind"))))
    done = F.aggregate(order, F.struct(F.lit(0).alias("at"), F.lit("").alias("out")), lambda acc, s: F.struct(
        F.greatest(acc["at"], s["end"]).alias("at"),
        F.when(s["start"] >= acc["at"], F.concat(
            acc["out"], F.substring(text, acc["at"] + 1, s["start"] - acc["at"]),
            F.lit("["), F.upper(s["kind"]), F.lit("]"))).otherwise(acc["out"]).alias("out")),
        lambda acc: F.concat(acc["out"], F.substring(text, acc["at"] + 1, F.length(text))))
    return F.when(F.size(spans) > 0, done).otherwise(text)


def redact(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs with personal data in the text replaced; other columns and null texts stay as they are."""
    trees = fit(docs, id_col, text_col)
    packed = docs.select(F.struct("*").alias("row"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    marked = with_spans(packed).withColumn("spans", chosen(trees))
    clean = F.when(F.col(f"row.{text_col}").isNotNull(), redacted(F.col("text"), F.col("spans")))
    return marked.select(*[clean.alias(c) if c == text_col else F.col(f"row.{c}").alias(c) for c in docs.columns])

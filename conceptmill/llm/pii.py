"""Operator 2. Personal data by weak supervision. DataFrame functions only on the main path."""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from conceptmill.llm.common import written

# Order of kinds: the four of the base, then what the method adds.
KINDS = ("email", "ip", "card", "phone", "secret", "ssn")
SECRET_WORDS = ("password", "passwd", "token", "secret", "api_key", "apikey")
OCTET = "0*(?:25[0-5]|2[0-4][0-9]|[01]?[0-9]{1,2})"


@dataclass(frozen=True)
class Pattern:
    """A way to find candidates, in texts that hold a digit and one of the plain strings ``needs``."""

    kind: str
    base: bool
    regex: str
    needs: tuple[str, ...] = ()
    digit: bool = True


# Possessive forms of the base patterns: they match the same spans, in linear time. A run of
# characters before @ or of digits can only match from its first character (or from the end of
# the match before), which the lookbehinds state. A chain of digits matches as a whole, so chains
# of other than 12 to 19 digits, which the base drops, are left out at once.
PATTERNS = (
    Pattern("email", True, r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", ("@",), False),
    Pattern("ip", True, r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}"),
    Pattern("card", True, r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){11,18}+(?![\x20-]?[0-9])"),
    Pattern("phone", True, r"\+[0-9][\x20().0-9-]+[0-9]", ("+",)),
    Pattern("email", False, r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}\x20?[\[(]at[\])]\x20?[A-Za-z0-9-]{1,63}(?:\x20?(?:\.|[\[(]dot[\])])\x20?[A-Za-z0-9-]{1,63}){1,4}", ("(at)", "[at]"), False),
    Pattern("phone", False, r"(?<![0-9+.(-])(?<![0-9+)]\x20)(?:\([0-9]{3}\)\x20?|[0-9]{3}[.-])[0-9]{3}[.-][0-9]{4}(?![0-9.-])", ("-",)),
    Pattern("secret", False, r"(?<![A-Za-z0-9])AKIA[0-9A-Z]{16}(?![A-Za-z0-9])", ("AKIA",), False),
    Pattern("secret", False, r"(?<=(?:password|passwd|token|secret|api_key|apikey)\x20{0,2}[=:]\x20{0,2}[\"']?)[A-Za-z0-9/+_-]{12,}+", SECRET_WORDS, False),
    Pattern("ssn", False, r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])", ("-",)),
)
SECRET_NAMES = rf"(?:{'|'.join(SECRET_WORDS)})\x20{{0,2}}[=:]"

# Gazetteers (fixed values, in natural order).
TOP_DOMAINS = ["at", "au", "be", "biz", "br", "ca", "ch", "cn", "co", "com", "cz", "de", "dk", "edu", "es", "eu", "fi", "fr", "gov", "ie", "in", "info", "int", "io", "it", "jp", "kr", "mil", "mx", "net", "nl", "no", "nz", "org", "pl", "pt", "ru", "se", "uk", "us"]
CARD_ISSUERS = r"^(?:3[47]|4|5[1-5]|2[2-7]|6)"
CONTEXT = {
    "email": "e-?mail|contact|write|mailto|reach",
    "ip": "ip|host|server|address|client|login",
    "card": "card|visa|master|amex|credit|debit|pay",
    "phone": "phone|tel|call|fax|mobile|cell|contact",
    "secret": "key|token|secret|password|passwd|aws|access",
    "ssn": "ssn|social|security|tax",
}
BEFORE = 40
LIST = "array<struct<kind_no:int,pattern_no:int,at:int,gap:int,hit:string,before:string,after:string>>"
LABELERS = ("strict", "checked", "listed", "context", "border")
ADDED_FROM = 0.8
EM_ROUNDS = 12


def _found(pattern: Pattern) -> Column:
    """Matches of a pattern in ``text``: position in the list, length of the gap before, hit, its surroundings."""
    regex = F.lit(pattern.regex)
    gaps, hits = F.split("text", pattern.regex, -1), F.regexp_extract_all("text", regex, F.lit(0))
    both = F.arrays_zip(gaps.alias("gap"), hits.alias("hit"), F.slice(gaps, 2, 2_000_000_000).alias("rest"))
    found = F.transform(
        both,
        lambda x, i: F.struct(
            F.lit(KINDS.index(pattern.kind)).alias("kind_no"),
            F.lit(PATTERNS.index(pattern)).alias("pattern_no"),
            i.alias("at"),
            F.length(x["gap"]).alias("gap"),
            x["hit"].alias("hit"),
            F.lower(F.right(x["gap"], F.lit(BEFORE))).alias("before"),
            F.left(x["rest"], F.lit(1)).alias("after"),
        ),
    )
    found = F.filter(found, lambda x: x["hit"].isNotNull())
    may = F.col("has_digit") if pattern.digit else F.lit(True)
    if pattern.needs:
        may = may & reduce(or_, (F.contains("text", F.lit(s)) for s in pattern.needs))
    return F.coalesce(F.when(may, found), F.array().cast(LIST))


def candidates(docs: DataFrame) -> DataFrame:
    """A row for each match of each pattern, and one without a match for each document.

    Spans are in code points, the end exclusive. The place of a match is the sum of the
    gaps and matches before it.
    """
    numbered = docs.select(
        F.monotonically_increasing_id().alias("row"), "doc_id", F.coalesce("text", F.lit("")).alias("text")
    ).withColumn("has_digit", F.rlike("text", F.lit("[0-9]")))
    lists = [_found(p) for p in PATTERNS]
    matches = written(
        numbered.select("row", "doc_id", F.explode_outer(F.flatten(F.array(*lists))).alias("m")).select("row", "doc_id", "m.*"),
        "pii-candidates",
    )
    upto = Window.partitionBy("row", "pattern_no").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    ended = matches.withColumn("end", F.sum(F.col("gap") + F.length("hit")).over(upto))
    return ended.withColumn("start", F.col("end") - F.length("hit"))


def _by_kind(values: dict[str, Column], default: Column) -> Column:
    out = default
    for kind, value in values.items():
        out = F.when(F.col("kind_no") == KINDS.index(kind), value).otherwise(out)
    return out


def _vote(yes: Column, no: Column) -> Column:
    return F.when(yes, 1).when(no, -1).otherwise(0)


def voted(found: DataFrame) -> DataFrame:
    """Candidates with the base's verdict and the votes of five labelers: 1, -1, or 0 for none.

    strict   a base pattern found it
    checked  checksum, ranges and numbers of digits are right or wrong
    listed   gazetteers of top domains, card issuers and names of secrets know it or not
    context  a word before it speaks of its kind
    border   it stands alone or inside a longer word
    """
    digits = F.regexp_replace("hit", "[^0-9]", "")
    n = F.length(digits)
    base_pattern = F.col("pattern_no").isin([i for i, p in enumerate(PATTERNS) if p.base])
    right = _by_kind(
        {
            "email": F.rlike("hit", F.lit(r"[.)\]\x20][A-Za-z]{2,}$")),
            "ip": F.rlike("hit", F.lit(rf"^{OCTET}(?:\.{OCTET}){{3}}$")),
            "card": F.expr("luhn_check(regexp_replace(hit, '[^0-9]', ''))") & n.between(12, 19),
            "phone": n.between(9, 15),
            "secret": F.rlike("hit", F.lit("[0-9]")) & F.rlike("hit", F.lit("[A-Za-z]")),
            "ssn": ~F.rlike("hit", F.lit("^(?:000|666|9)|-00-|-0000$")),
        },
        F.lit(False),
    )
    valid = _by_kind({"ip": right, "card": right, "phone": right}, F.lit(True))
    top_domain = F.lower(F.regexp_extract("hit", r"([A-Za-z]+)$", 1))
    listed = _by_kind(
        {
            "email": top_domain.isin(TOP_DOMAINS),
            "ip": ~F.rlike("hit", F.lit(r"^(?:0|22[4-9]|23[0-9]|24|25)[0-9]*\.")),
            "card": F.rlike(digits, F.lit(CARD_ISSUERS)),
            "phone": ~F.rlike(digits, F.lit("^0{3}|^(.)\\1+$")),
            "secret": F.startswith("hit", F.lit("AKIA")) | F.rlike("before", F.lit(SECRET_NAMES)),
            "ssn": n == 9,
        },
        F.lit(False),
    )
    spoken = _by_kind({k: F.rlike("before", F.lit(rf"\b(?:{words})")) for k, words in CONTEXT.items()}, F.lit(False))
    inside = F.rlike("before", F.lit(r"[\p{L}0-9]$")) | F.rlike(F.coalesce("after", F.lit("")), F.lit(r"^[\p{L}0-9]"))
    return found.where("hit IS NOT NULL").select(
        "*",
        (base_pattern & valid).alias("in_base"),
        F.when(base_pattern, 1).otherwise(0).alias("strict"),
        _vote(right, ~right).alias("checked"),
        _vote(listed, ~listed).alias("listed"),
        F.when(spoken, 1).otherwise(0).alias("context"),
        _vote(~inside, inside).alias("border"),
        F.least(F.floor(F.length("hit") / 8), F.lit(4)).cast("int").alias("length_class"),
    )


def _marks() -> Column:
    """Numbers of what holds for a candidate: three for each labeler's vote, then one for each kind."""
    votes = [F.col(name) + 3 * i + 1 for i, name in enumerate(LABELERS)]
    return F.array(*votes, F.col("kind_no") + 3 * len(LABELERS))


def reliabilities(patterns: DataFrame, rounds: int = EM_ROUNDS) -> Column:
    """Log odds that a candidate is personal data, by expectation-maximisation over the votes.

    ``patterns`` has a row for each combination of kind, votes and length (a few thousand at
    most) with its number n and its ``marks``. A labeler gives each vote with a probability
    that depends on the hidden truth, alike for all kinds; kinds have shares of their own. The
    first guess is the majority. An E step adds up the weights of a combination's marks, an
    M step is one aggregation by mark (a fixed number of them).
    """
    first_kind = 3 * len(LABELERS)
    weights = [float(i % 3 - 1) for i in range(first_kind)] + [0.0] * len(KINDS)

    def odds() -> Column:
        table = F.array(*map(F.lit, weights))
        return F.aggregate("marks", F.lit(0.0), lambda total, mark: total + F.element_at(table, mark + 1))

    for _ in range(rounds):
        truth = patterns.select("n", (1 / (1 + F.exp(-odds()))).alias("p"), F.explode("marks").alias("mark"))
        sums = truth.groupBy("mark").agg(F.sum(F.col("n") * F.col("p")).alias("yes"), F.sum("n").alias("all")).collect()
        yes, no = [0.0] * len(weights), [0.0] * len(weights)
        for row in sums:
            yes[row["mark"]], no[row["mark"]] = row["yes"], row["all"] - row["yes"]
        all_yes, all_no = sum(yes[first_kind:]), sum(no[first_kind:])
        for i in range(first_kind):
            weights[i] = math.log((yes[i] + 1) / (all_yes + 3)) - math.log((no[i] + 1) / (all_no + 3))
        for i in range(first_kind, len(weights)):
            weights[i] = math.log((yes[i] + 1) / (no[i] + 1))
    return odds()


def features() -> list[Column]:
    kinds = [(F.col("kind_no") == k).cast("double").alias(f"kind_{k}") for k in range(len(KINDS))]
    votes = [(F.col(name) == v).cast("double").alias(f"{name}_{v + 1}") for name in LABELERS for v in (-1, 1)]
    lengths = [(F.col("length_class") == c).cast("double").alias(f"length_{c}") for c in range(5)]
    return [*kinds, *votes, *lengths]


def span_classifier(patterns: DataFrame) -> Column:
    """Probability of a candidate, from a logistic regression on what the votes agree on.

    Every combination stands twice, as personal data and as not, weighed by its number and
    the probability that expectation-maximisation gives.
    """
    if patterns.isEmpty():
        return F.lit(0.0)
    patterns = patterns.withColumn("marks", _marks())
    truth = 1 / (1 + F.exp(-reliabilities(patterns)))
    columns = features()
    both = F.explode(F.array(F.struct(F.lit(1.0).alias("y"), truth.alias("p")), F.struct(F.lit(0.0).alias("y"), (1 - truth).alias("p"))))
    table = patterns.select("n", *columns, both.alias("b")).select(
        "*", F.col("b.y").alias("label"), (F.col("n") * F.col("b.p") + 1e-6).alias("weight")
    )
    names = [name for name in table.columns if name not in ("n", "b", "label", "weight")]
    rows = VectorAssembler(inputCols=names, outputCol="features").transform(table)
    fitted = LogisticRegression(weightCol="weight", maxIter=50, regParam=0.001, standardization=False).fit(rows)
    odds: Column = F.lit(float(fitted.intercept))
    for value, column in zip(fitted.coefficients.toArray().tolist(), columns, strict=True):
        odds = odds + column * value
    return 1 / (1 + F.exp(-odds))


def find_personal_data(docs: DataFrame, added_from: float = ADDED_FROM) -> DataFrame:
    """(doc_id, spans): spans as array<struct<start, end, kind, in_base, probability>> by start, then kind.

    Base matches that pass their checks always stay. Candidates of other patterns (emails
    written with "at", phones without a plus, secrets, social security numbers) are added
    from ``added_from`` on. One row for each row of ``docs``; null and empty texts have an
    empty list, repeated rows one each, an empty table gives none. Other columns are ignored.
    """
    found = written(voted_or_empty(candidates(docs)), "pii-votes")
    seen = found.where("hit IS NOT NULL")
    patterns = written(
        seen.groupBy("kind_no", *LABELERS, "length_class").agg(F.count(F.lit(1)).alias("n")).coalesce(1), "pii-patterns"
    )
    judged = found.withColumn("probability", span_classifier(patterns))
    kept = F.col("hit").isNotNull() & (F.col("in_base") | (F.col("probability") >= added_from))
    span = F.struct(
        "start", "kind_no", "end", F.element_at(F.array(*map(F.lit, KINDS)), F.col("kind_no") + 1).alias("kind"), "in_base", "probability"
    )
    return (
        judged.groupBy("row")
        .agg(F.first("doc_id").alias("doc_id"), F.sort_array(F.collect_list(F.when(kept, span))).alias("spans"))
        .select(
            "doc_id",
            F.transform(
                "spans",
                lambda s: F.struct(
                    s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"),
                    s["in_base"].alias("in_base"), s["probability"].alias("probability"),
                ),
            ).alias("spans"),
        )
    )


def voted_or_empty(found: DataFrame) -> DataFrame:
    """Votes on the candidates, and the rows of documents without any."""
    return voted(found).unionByName(found.where("hit IS NULL"), allowMissingColumns=True)


def joined(spans: Column) -> Column:
    """kind:start:end, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def number_of(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("bigint")


def redacted(docs: DataFrame, found: DataFrame) -> DataFrame:
    """(doc_id, text) with every span replaced by its kind in brackets; doc_id has to be unique."""
    pieces = F.aggregate(
        "spans",
        F.struct(F.lit("").alias("out"), F.lit(0).cast("bigint").alias("at")),
        lambda acc, s: F.when(
            s["start"] >= acc["at"],
            F.struct(
                F.concat(acc["out"], F.substring(F.col("text"), (acc["at"] + 1).cast("int"), (s["start"] - acc["at"]).cast("int")), F.lit("["), s["kind"], F.lit("]")).alias("out"),
                s["end"].alias("at"),
            ),
        ).otherwise(acc),
        lambda acc: F.concat(acc["out"], F.substring(F.col("text"), (acc["at"] + 1).cast("int"), F.lit(2_000_000_000))),
    )
    return docs.select("doc_id", "text").join(found, "doc_id").select("doc_id", pieces.alias("text"))

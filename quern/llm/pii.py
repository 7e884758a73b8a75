"""Personal data: regular expressions propose spans, validators confirm them,
and context words in front adjust the score.  SQL functions only.

``regexp_extract_all`` gives the matches and ``split`` by the same pattern the text between
them, so starts are running sums of lengths.  Both walk the text in the same way, and possessive
quantifiers and the anchors in front of a run keep them linear and off the stack in long runs.

Edge cases: null and empty texts have no spans; overlapping spans of different kinds all stay;
repeated rows give equal results; an empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.llm.common import let, running_sums

#: Characters before a span in which context words count, what they add and what contrary ones take.
CONTEXT, BONUS, MALUS = 40, 0.15, 0.25


@dataclass(frozen=True)
class Kind:
    """A proposal: ``hint`` is a cheap test whether a text can hold one; ``pattern`` matches the same spans,
    leftmost and non-overlapping, as the plain expression in the comment."""

    name: str
    hint: str
    pattern: str
    base: float
    words: str
    contrary: str


_LOCAL = "A-Za-z0-9._%+-"
KINDS = (
    # [A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+
    Kind("email", "@", rf"(?:\G|(?<![{_LOCAL}]))[{_LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", 0.8,
         "mail|contact|write to|reply", "example|noreply"),
    # [0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)
    Kind("ip", r"[0-9]\.[0-9]++\.[0-9]++\.[0-9]", r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", 0.6,
         r"\bip\b|address|host|server|from", "version|section|release"),
    # [0-9]([\x20-]?[0-9])+
    Kind("card", r"[0-9](?:[ -]?[0-9]){15}", r"[0-9](?:[ -]?[0-9])++", 0.8, "card|visa|credit|debit|payment", "order|invoice|serial|isbn"),
    # \+[0-9][\x20().0-9-]+[0-9]
    Kind("phone", r"\+[0-9]", r"\+[0-9][ ().0-9-]+[0-9]", 0.7, "phone|tel|call|mobile|fax|contact", "score|total"),
    # The method's own: an IBAN, in one piece or in groups of four.
    Kind("iban", r"[A-Z]{2}[0-9]{2}[ A-Z0-9]",
         r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:[A-Z0-9]{11,30}|(?: [A-Z0-9]{4}){2,7}(?: [A-Z0-9]{1,3})?)(?![A-Za-z0-9])", 0.85,
         "iban|account|bank|transfer", "serial|order"),
)
BASE = ("email", "ip", "card", "phone")


def digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(number: Column) -> Column:
    """Whether a string of digits passes the Luhn check."""
    def cell(i: Column) -> Column:
        x = F.substring(number, -i, F.lit(1)).cast("int")
        return F.when(i % 2 == 1, x).otherwise(2 * x - F.when(x > 4, 9).otherwise(0))

    return F.aggregate(F.sequence(F.lit(1), F.length(number)), F.lit(0), lambda a, i: a + cell(i)) % 10 == 0


def mod97(iban: Column) -> Column:
    """Whether letters and digits of an IBAN give 1 modulo 97."""
    moved = F.concat(F.substring(iban, F.lit(5), F.length(iban)), F.substring(iban, 1, 4))
    def step(a: Column, i: Column) -> Column:
        code = F.ascii(F.substring(moved, i, F.lit(1)))
        return F.when(code >= 65, (a * 100 + code - 55) % 97).otherwise((a * 10 + code - 48) % 97)

    return F.aggregate(F.sequence(F.lit(1), F.length(iban)), F.lit(0), step) == 1


def confirmed(kind: str, value: Column) -> Column:
    if kind == "ip":
        small = lambda part: let(F.ltrim(part, F.lit("0")), lambda p: F.when(p == "", True).when(F.length(p) <= 3, p.cast("int") <= 255).otherwise(False))
        return F.forall(F.split(value, r"\."), small)
    if kind == "card":
        return let(digits(value), lambda d: F.when(F.length(d).between(16, 19), luhn(d)).otherwise(False))
    if kind == "phone":
        return F.length(digits(value)).between(8, 15)
    if kind == "iban":
        return let(F.regexp_replace(value, " ", ""), lambda v: F.when(F.length(v).between(15, 34), mod97(v)).otherwise(False))
    return F.lit(True)


_SPANS = "array<struct<kind:string,start:bigint,end:bigint,value:string,score:double>>"


def kind_spans(kind: Kind, text: Column) -> Column:
    """Confirmed spans of one kind, by start."""
    def placed(matches: Column, between: Column) -> Column:
        sizes = F.zip_with(between, matches, lambda gap, m: (F.length(gap) + F.coalesce(F.length(m), F.lit(0))).cast("long"))
        return let(running_sums(sizes), lambda at: F.transform(matches, lambda m, i: span(m, between[i], at[i])))

    def span(value: Column, gap: Column, at: Column) -> Column:
        start, near = at + F.length(gap), F.lower(F.substring(gap, -CONTEXT, CONTEXT))
        score = F.lit(kind.base) + F.when(near.rlike(kind.words), BONUS).otherwise(0.0) - F.when(near.rlike(kind.contrary), MALUS).otherwise(0.0)
        return F.struct(F.lit(kind.name).alias("kind"), start.cast("long").alias("start"), (start + F.length(value)).cast("long").alias("end"),
                        value.alias("value"), F.least(score, F.lit(1.0)).alias("score"))

    def found(t: Column) -> Column:
        matches = F.regexp_extract_all(t, F.lit(kind.pattern), F.lit(0))
        spans = let(matches, lambda m: let(F.split(t, kind.pattern, -1), lambda between: placed(m, between)))
        return F.filter(spans, lambda s: confirmed(kind.name, s["value"]))

    hint = F.contains(text, F.lit(kind.hint)) if len(kind.hint) == 1 else text.rlike(kind.hint)
    return F.when(hint, found(text)).otherwise(F.array().cast(_SPANS))


def spans(text: Column) -> Column:
    """All confirmed spans (kind, start, end in code points, value, score) by kind as listed, then start."""
    text = F.coalesce(text.cast("string"), F.lit(""))
    return F.concat(*[kind_spans(k, text) for k in KINDS])


def find(df: DataFrame, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Adds ``spans`` (an existing column of that name is replaced)."""
    kept = [c for c in (df.columns if keep is None else keep) if c.lower() != "spans"]
    return df.select(*[df[f"`{c}`"] for c in kept], spans(df[f"`{text}`"]).alias("spans"))


def redact(df: DataFrame, text: str = "text", least: float = 0.5) -> DataFrame:
    """Replaces every confirmed span of at least that score by its kind in brackets."""
    def masked(value: Column, kind: Kind) -> Column:
        good = lambda s: F.filter(s, lambda x: x["score"] >= least)
        return let(kind_spans(kind, value), lambda s: _replaced(value, good(s), kind.name))

    for kind in KINDS:  # one kind after another: earlier replacements don't match later patterns
        df = df.withColumn(text, F.when(F.col(text).isNotNull(), masked(F.col(text), kind)))
    return df


def _replaced(text: Column, found: Column, name: str) -> Column:
    start = F.struct(F.lit(0).cast("long").alias("at"), F.lit("").alias("out"))
    cut = lambda a, b: F.substring(text, (a + 1).cast("int"), (b - a).cast("int"))
    fold = F.aggregate(found, start, lambda a, s: F.struct(s["end"].alias("at"), F.concat(a["out"], cut(a["at"], s["start"]), F.lit(f"[{name}]")).alias("out")))
    return let(fold, lambda a: F.concat(a["out"], F.substring(text, (a["at"] + 1).cast("int"), F.length(text))))


def summary(found: DataFrame) -> DataFrame:
    """The query's columns from ``spans``."""
    listed = lambda a: F.array_join(F.transform(a, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    of = lambda k: F.size(F.filter("spans", lambda s: s["kind"] == k)).cast("long")
    base = F.filter("spans", lambda s: s["kind"].isin(*BASE))
    return found.select("doc_id", *[of(k).alias(f"n_{k}") for k in BASE], F.sha2(listed(base).cast("binary"), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans"),
                        F.coalesce(F.array_max(F.transform("spans", lambda s: s["score"])), F.lit(0.0)).alias("top_score"))

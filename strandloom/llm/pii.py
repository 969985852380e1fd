"""Personal data: patterns propose spans, checksums confirm them, context words adjust their score.

DataFrame functions only.  A pattern's matches come from ``regexp_extract_all``
and the text between them from ``split`` with the same pattern, so that sums of
lengths give code-point offsets; texts without a match are not split.

The patterns are possessive and start at \\G (the end of the match before) or
where no character of their first class stands before, which keeps long runs
of such characters linear and finds the same matches: a leftmost match never
starts inside such a run unless the match before ended there.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Code points around a span in which context words are sought; what they add; the least score of a span that the base patterns do not give.
NEAR, BONUS, LEAST = 40, 0.4, 0.6
_CHUNK = 64


@dataclass(frozen=True)
class Kind:
    """A kind of personal data: how it is proposed, confirmed and scored."""

    name: str
    pattern: str
    base: bool
    score: float
    context: str
    needs: str = ""  # a character without which the pattern cannot match


# Patterns, base scores and context words of every kind, in the order in which spans of one start are listed.
KINDS = (
    Kind("email", r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", True, 0.9, "mail|contact|write", "@"),
    Kind("ip", r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", True, 0.6, "ip|address|host|server", "."),
    Kind("card", r"[0-9](?:[ -]?[0-9])++", True, 0.8, "card|visa|payment|account"),
    Kind("phone", r"\+[0-9][ ().0-9-]+[0-9]", True, 0.6, "phone|call|tel|mobile|fax", "+"),
    Kind("iban", r"[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,4})?", False, 0.8, "iban|account|bank"),
    Kind("pan", r"[0-9]+", False, 0.7, "card|visa|payment|account"),
    Kind("ssn", r"[0-9]+-[0-9]+-[0-9]+", False, 0.4, "ssn|social|security|tax", "-"),
    Kind("secret", r"[0-9A-Fa-f]{32,64}", False, 0.4, "token|secret|key|password|credential"),
)
BASE = tuple(k.name for k in KINDS if k.base)


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes the Luhn check."""
    n = F.length(digits)
    total = F.aggregate(
        F.sequence(F.lit(1), F.greatest(n, F.lit(1))),
        F.lit(0),
        lambda s, i: s + F.when((n - i) % 2 == 0, F.substr(digits, i, F.lit(1)).cast("int")).otherwise((F.substr(digits, i, F.lit(1)).cast("int") * 2) - F.when(F.substr(digits, i, F.lit(1)).cast("int") > 4, 9).otherwise(0)),
    )
    return (n > 0) & (total % 10 == 0)


def mod97(iban: Column) -> Column:
    """Whether letters and digits pass the mod-97 check of international account numbers."""
    turned = F.concat(F.substr(iban, F.lit(5)), F.substr(iban, F.lit(1), F.lit(4)))
    rest = F.aggregate(
        F.split(turned, ""),
        F.lit(0),
        lambda s, c: F.when(c == "", s).when(c.between("0", "9"), (s * 10 + c.cast("int")) % 97).otherwise((s * 100 + F.ascii(c) - 55) % 97),
    )
    return rest == 1


def _confirmed(kind: str, m: Column) -> Column:
    """Whether a match passes what can be told from itself alone."""
    digits = F.regexp_replace(m, "[^0-9]", "")
    if kind == "ip":
        return m.rlike(r"^0*(25[0-5]|2[0-4][0-9]|[01]?[0-9]?[0-9])(\.0*(25[0-5]|2[0-4][0-9]|[01]?[0-9]?[0-9])){3}$")
    if kind == "card":
        return F.when(F.length(m) < 14, False).otherwise(F.when(F.length(digits).between(14, 19), luhn(digits)).otherwise(False))
    if kind == "phone":
        return F.length(digits).between(10, 15)
    if kind == "iban":
        return F.when(F.length(F.replace(m, F.lit(" "))).between(15, 34), mod97(F.replace(m, F.lit(" ")))).otherwise(False)
    if kind == "pan":
        return F.when(F.length(m).between(13, 19), luhn(m)).otherwise(False)
    if kind == "ssn":
        return m.rlike(r"^[0-9]{3}-[0-9]{2}-[0-9]{4}$")
    return F.lit(True)


def _alone(text: Column, m: Column, start: Column) -> Column:
    """Whether no letter or digit touches a match."""
    before = F.when(start > 0, F.substr(text, start, F.lit(1))).otherwise("")
    after = F.substr(text, start + F.length(m) + 1, F.lit(1))
    return ~before.rlike("[A-Za-z0-9]") & ~after.rlike("[A-Za-z0-9]")


def find(docs: DataFrame, text: str = "text", into: str = "spans") -> DataFrame:
    """Add the confirmed spans of every kind to the rows: an array of (start, rank, kind, end, score), sorted.

    Offsets are code points, the end is exclusive, rank is the kind's place in
    ``KINDS``.  Base kinds stay whatever their score; others need ``LEAST``,
    which ``BONUS`` for a context word nearby can reach.  A "pan" inside a base
    card span is not repeated.  Null text: no spans.  All rows and columns
    stay; a column that already bears the name is replaced.  Names of the
    steps between start with two underscores and "pii".
    """
    body = F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))
    rest = [F.col(f"`{c}`") for c in docs.columns if c != into]
    df = docs.select(*rest, body.alias("__pii_text"))
    t = F.col("__pii_text")
    none = F.array().cast("array<string>")
    matches = []
    for k in KINDS:
        every = F.regexp_extract_all(t, F.lit(k.pattern), F.lit(0))
        matches.append((F.when(F.contains(t, F.lit(k.needs)), every).otherwise(none) if k.needs else every).alias(f"__pii_m_{k.name}"))
    df = df.select("*", *matches)
    split = [F.when(F.size(f"__pii_m_{k.name}") > 0, F.split(t, k.pattern, -1)).otherwise(none).alias(f"__pii_p_{k.name}") for k in KINDS]
    df = df.select("*", *split)
    lengths = [F.zip_with(F.col(f"__pii_m_{k.name}"), F.slice(f"__pii_p_{k.name}", 1, F.greatest(F.size(f"__pii_m_{k.name}"), F.lit(0))), lambda m, p: F.length(m) + F.length(p)).alias(f"__pii_l_{k.name}") for k in KINDS]
    df = df.select("*", *lengths)
    # Sums of whole chunks, so that an offset adds few numbers in a text with very many matches.
    def sums(lengths: str) -> Column:
        count = F.floor(F.size(lengths) / _CHUNK).cast("int")
        return F.transform(F.sequence(F.lit(0), count), lambda j: F.aggregate(F.slice(lengths, j * _CHUNK + 1, F.lit(_CHUNK)), F.lit(0), lambda s, x: s + x))

    chunk = [sums(f"__pii_l_{k.name}") for k in KINDS]
    df = df.select("*", *[F.when(F.size(f"__pii_m_{k.name}") > 0, c).otherwise(F.array().cast("array<int>")).alias(f"__pii_c_{k.name}") for k, c in zip(KINDS, chunk, strict=True)])

    def spans(rank: int, k: Kind) -> Column:
        m, p, lengths, chunks = (F.col(f"__pii_{x}_{k.name}") for x in "mplc")
        add = lambda s, x: s + x
        numbered = F.transform(m, lambda x, i: F.struct(x.alias("match"), i.alias("i")))
        kept = F.filter(numbered, lambda s: _confirmed(k.name, s.match))

        def placed(z: Column, s: Column) -> Column:
            c = F.floor(s.i / _CHUNK).cast("int")
            ahead = F.aggregate(F.slice(z.chunks, F.lit(1), c), F.lit(0), add) + F.aggregate(F.slice(z.lengths, c * _CHUNK + 1, s.i - c * _CHUNK), F.lit(0), add)
            return F.struct((ahead + F.length(F.element_at(z.p, s.i + 1))).alias("start"), s.match.alias("match"))

        # The arrays are bound to one variable: a column that a function of elements names may be planned into it and computed for each element.
        bound = F.array(F.struct(kept.alias("kept"), p.alias("p"), lengths.alias("lengths"), chunks.alias("chunks")))
        at = F.element_at(F.transform(bound, lambda z: F.transform(z.kept, lambda s: placed(z, s))), 1)
        good = F.filter(at, lambda s: _alone(t, s.match, s.start)) if k.name in ("iban", "secret") else at

        def scored(s: Column) -> Column:
            end = s.start + F.length(s.match)
            lo = F.greatest(s.start - NEAR, F.lit(0))
            around = F.translate(F.concat(F.substr(t, lo + 1, s.start - lo), F.lit(" "), F.substr(t, end + 1, F.lit(NEAR))), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
            score = F.least(F.lit(1.0), F.lit(k.score) + F.when(around.rlike(k.context), BONUS).otherwise(0.0))
            return F.struct(s.start.alias("start"), F.lit(rank).alias("rank"), F.lit(k.name).alias("kind"), end.alias("end"), score.alias("score"))

        out = F.transform(good, scored)
        return out if k.base else F.filter(out, lambda s: s.score >= LEAST)

    empty = F.array().cast("array<struct<start:int,rank:int,kind:string,end:int,score:double>>")
    df = df.select(*rest, *[F.when(F.size(f"__pii_m_{k.name}") > 0, spans(i, k)).otherwise(empty).alias(f"__pii_s_{k.name}") for i, k in enumerate(KINDS)])
    pan = F.filter("__pii_s_pan", lambda s: ~F.exists("__pii_s_card", lambda c: (c.start <= s.start) & (s.end <= c.end)))
    every = F.array_sort(F.concat(*[pan if k.name == "pan" else F.col(f"__pii_s_{k.name}") for k in KINDS]))
    return df.select(*rest, every.alias(into))


def _ranked(rank: int):
    return lambda s: s["rank"] == rank


def listed(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s.kind, s.start, s.end)), ",")


def report(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """Per row: doc_id, counts of the base kinds, digest of the base spans, and all spans as kind:start:end.

    Null and empty texts have no spans.  Repeated rows and null ids each keep
    their row; an empty table gives an empty result; other columns are not read.
    """
    found = find(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")))
    base = F.filter("spans", lambda s: s["rank"] < len(BASE))
    counts = [F.size(F.filter("spans", _ranked(i))).cast("long").alias(f"n_{name}") for i, name in enumerate(BASE)]
    return found.select("doc_id", *counts, F.sha2(listed(base), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans"))


def redact(docs: DataFrame, text: str = "text") -> DataFrame:
    """The rows with every span of the text replaced by its kind in brackets; of overlapping spans, the first names the gap."""
    columns = docs.columns
    found = find(docs, text, "__pii_spans")
    t = F.col(f"`{text}`")

    def step(acc: Column, s: Column) -> Column:
        cut = F.concat(acc.out, F.substr(t, acc.at + 1, s.start - acc.at), F.lit("["), F.upper(s.kind), F.lit("]"))
        fresh = s.start >= acc.at
        return F.struct(F.when(fresh, cut).otherwise(acc.out).alias("out"), F.greatest(acc.at, s.end).alias("at"))

    start = F.struct(F.lit("").alias("out"), F.lit(0).alias("at"))
    joined = F.aggregate("__pii_spans", start, step, lambda acc: F.concat(acc.out, F.substr(t, acc.at + 1)))
    new = F.when(F.size("__pii_spans") > 0, joined).otherwise(t)
    return found.select(*[new.alias(c) if c == text else F.col(f"`{c}`") for c in columns])

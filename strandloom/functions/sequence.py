"""Column functions on sequences, intervals and flags: plain expressions, and Arrow functions where one scan of a sequence is needed."""

from __future__ import annotations

import re
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# IUPAC symbols with complements (S and W are their own), and stop codons.
IUPAC = "ACGTRYMKBDHVNacgtrymkbdhvn"
IUPAC_COMPLEMENT = "TGCAYRKMVHDBNtgcayrkmvhdbn"
STOPS = ("TAA", "TAG", "TGA")


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def positions(first: Column, last: Column, step: int = 1) -> Column:
    """first, first + step, ... up to last; empty when last is below first."""
    return F.when(last >= first, F.sequence(first.cast("int"), last.cast("int"), F.lit(step))).otherwise(F.array().cast("array<int>"))


def reverse_complement(seq: str | Column) -> Column:
    return F.reverse(F.translate(_col(seq), IUPAC, IUPAC_COMPLEMENT))


def canonical_signature(seq: str | Column) -> Column:
    """SHA-256 of the lesser of a sequence and its reverse complement."""
    return F.sha2(F.least(_col(seq), reverse_complement(seq)), 256)


def as_bases(text: str | Column) -> Column:
    """Letters of a text as bases: the place of A-Z in the alphabet, modulo 4, names A, C, G or T; all else is left out."""
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(F.regexp_replace(_col(text).cast("string"), "[^A-Za-z]", ""), letters + letters.lower(), ("ACGT" * 7)[:26] * 2)


def count_of(seq: str | Column, symbols: str) -> Column:
    s = _col(seq)
    return F.length(s) - F.length(F.translate(s, symbols, ""))


def gc_fraction(seq: str | Column) -> Column:
    """G and C among A, C, G and T only; 0 when there is none."""
    known = count_of(seq, "ACGTacgt")
    return F.when(known > 0, count_of(seq, "GCgc") / known).otherwise(0.0)


def gc_percent(seq: str | Column) -> Column:
    """G and C over the full length, in percent."""
    n = F.length(_col(seq))
    return F.when(n > 0, F.lit(100.0) * count_of(seq, "GCgc") / n).otherwise(0.0)


def internal_stops(seq: str | Column, frame: int = 0) -> Column:
    """Stop codons in a frame, the last complete codon not counted."""
    # Codons come from one scan: a substring by position would walk the text from its start each time.
    codons = F.regexp_extract_all(F.substr(F.translate(_col(seq), "acgt", "ACGT"), F.lit(frame + 1)), F.lit("(?s).{3}"), F.lit(0))
    inner = F.slice(codons, F.lit(1), F.greatest(F.size(codons) - 1, F.lit(0)))
    return F.size(F.filter(inner, lambda c: c.isin(*STOPS)))


_FRAMES = [f"{sign}{f}" for sign in "+-" for f in (1, 2, 3)]
_CODES = np.full(256, 4, np.uint8)
_CODES[np.frombuffer(b"ACGTacgt", np.uint8)] = [0, 1, 2, 3] * 2


def frame_stops(seqs: list[str]) -> np.ndarray:
    """Internal stop codons in frames 1, 2 and 3 of each sequence and of its reverse complement, a row of six a sequence, in one pass over all."""
    c = _CODES[np.frombuffer("".join(seqs).encode("ascii", "replace"), np.uint8)].astype(np.int16)
    size = np.array([len(s) for s in seqs], np.int64)
    codon = c[:-2] * 25 + c[1:-1] * 5 + c[2:] if len(c) > 2 else np.empty(0, np.int16)
    out = np.zeros((len(seqs), 6), np.int64)
    # TAA, TAG, TGA, and what they are on the other strand: TTA, CTA, TCA.
    for turned, group in enumerate((((3, 0, 0), (3, 0, 2), (3, 2, 0)), ((3, 3, 0), (1, 3, 0), (3, 1, 0)))):
        at = np.flatnonzero(np.isin(codon, [x * 25 + y * 5 + z for x, y, z in group]))
        row = np.searchsorted(np.cumsum(size), at, "right")
        place = at - (np.cumsum(size) - size)[row]
        # Where a codon begins on its own strand; one more has to follow it there, as the last complete one is not counted.
        place = size[row] - 3 - place if turned else place
        inner = (place >= 0) & (place + 6 <= size[row])
        out[:, 3 * turned : 3 * turned + 3] = np.bincount(row[inner] * 3 + place[inner] % 3, minlength=3 * len(seqs)).reshape(-1, 3)
    return out


_SIX = T.StructType([T.StructField("stops", T.IntegerType()), T.StructField("frame", T.StringType()), T.StructField("counts", T.MapType(T.StringType(), T.IntegerType()))])


@F.arrow_udf(_SIX)
def _six_frames(seqs: pa.Array) -> pa.Array:
    none = seqs.is_null()
    counts = frame_stops(pc.fill_null(seqs, "").to_pylist())
    # Labels are in order, so the first of the fewest has the least label.
    frame = pa.array(_FRAMES).take(pa.array(counts.argmin(1)))
    maps = pa.MapArray.from_arrays(pa.array(np.arange(0, counts.size + 1, 6), pa.int32()), pa.array(_FRAMES * len(counts), pa.string()), pa.array(counts.ravel(), pa.int32()))
    held = pa.scalar(None, pa.int32()), pa.scalar(None, pa.string())
    return pa.StructArray.from_arrays([pc.if_else(none, held[0], pa.array(counts.min(1), pa.int32())), pc.if_else(none, held[1], frame), pc.if_else(none, pa.scalar(None, maps.type), maps)], names=["stops", "frame", "counts"])


def six_frame_stops(seq: str | Column) -> Column:
    """Struct of the fewest internal stops over six frames, its label (ties: the least label) and all counts; fields are null for null."""
    return _six_frames(_col(seq))


def coding_view(seq: str | Column, label: str | Column) -> Column:
    """The sequence as its frame label reads it."""
    lab = _col(label)
    s = F.when(F.startswith(lab, F.lit("+")), _col(seq)).otherwise(reverse_complement(seq))
    return F.substr(s, F.substr(lab, F.lit(2)).cast("int"))


def kmers(seq: str | Column, k: int) -> Column:
    """Distinct k-mers; none for a shorter sequence."""
    s = _col(seq)
    shifted = [F.regexp_extract_all(F.substr(s, F.lit(i + 1)), F.lit(f"(?s).{{{k}}}"), F.lit(0)) for i in range(k)]
    return F.array_distinct(F.flatten(F.array(*shifted)))


def _found_runs(seq: str, symbol: str, least: int) -> list[dict[str, int]]:
    return [{"start": m.start() + 1, "end": m.end()} for m in re.finditer(f"{re.escape(symbol)}+", seq.upper()) if m.end() - m.start() >= least and m.start() > 0 and m.end() < len(seq)]


def interior_runs(seq: str | Column, symbol: str = "N", least: int = 1) -> Column:
    """1-based inclusive runs of a symbol that touch neither end, found in one scan; null for null."""

    @F.pandas_udf("array<struct<start:int,end:int>>")
    def runs(seqs: pd.Series) -> pd.Series:
        return pd.Series([None if s is None else _found_runs(s, symbol, least) for s in seqs], dtype=object)

    return runs(_col(seq))


def excise_runs(seq: str | Column, symbol: str = "N") -> Column:
    return F.regexp_replace(F.upper(_col(seq)), f"{symbol}+", "")


def parse_region(region: str | Column) -> Column:
    """``contig:start-end`` (1-based, inclusive) or a bare contig, whose bounds are null, to a struct.

    Only one colon and plain digits are understood; anything else, null too, raises.
    """
    r = _col(region)
    bound = lambda i: F.when(r.contains(":"), F.regexp_extract(r, r":([0-9]+)-([0-9]+)$", i).cast("long"))
    value = F.struct(F.regexp_extract(r, r"^[^:]+", 0).alias("contig"), bound(1).alias("start"), bound(2).alias("end"))
    wrong = F.raise_error(F.concat(F.lit("not a region: "), F.coalesce(r, F.lit("null")))).cast("struct<contig:string,start:bigint,end:bigint>")
    return F.when(r.rlike(r"^[^:]+(:[0-9]+-[0-9]+)?$"), value).otherwise(wrong)


def query_span(qstart, qend, sstart, send, qlen, slen) -> Column:
    """Where the whole query would lie on the subject of a hit.

    Struct of strand, start and end (1-based, clipped to the subject), bases
    clipped at either end, and the query intervals that are lost with them.
    """
    qs, qe, ss, se, ql, sl = map(_col, (qstart, qend, sstart, send, qlen, slen))
    forward = ss <= se
    head, tail = qs - 1, ql - qe
    start = F.when(forward, ss - head).otherwise(se - tail)
    end = F.when(forward, se + tail).otherwise(ss + head)
    left, right = F.greatest(F.lit(1) - start, F.lit(0)), F.greatest(end - sl, F.lit(0))
    prefix, suffix = F.when(forward, left).otherwise(right), F.when(forward, right).otherwise(left)
    lost = F.array(F.struct(F.lit(1).cast("long").alias("start"), prefix.cast("long").alias("end")), F.struct((ql - suffix + 1).cast("long").alias("start"), ql.cast("long").alias("end")))
    return F.struct(
        F.when(forward, "+").otherwise("-").alias("strand"),
        F.greatest(start, F.lit(1)).alias("start"),
        F.least(end, sl).alias("end"),
        left.alias("clipped_start"),
        right.alias("clipped_end"),
        F.filter(lost, lambda x: x["end"] >= x["start"]).alias("lost"),
    )


def _phreds(encoded: str | Column) -> Column:
    c = _col(encoded)
    return F.when(c == "*", F.array().cast("array<string>")).otherwise(F.filter(F.split(c, ""), lambda x: x != ""))


def phred_total(encoded: str | Column) -> Column:
    """Sum of Phred+33 qualities, below zero counted as zero; null, empty and ``*`` (no base) give 0."""
    return F.coalesce(F.aggregate(_phreds(encoded), F.lit(0).cast("long"), lambda s, x: s + F.greatest(F.ascii(x) - 33, F.lit(0))), F.lit(0))


def phred_count(encoded: str | Column) -> Column:
    return F.when(_col(encoded).isNull(), 0).otherwise(F.size(_phreds(encoded)))


def mean_phred(encoded: str | Column) -> Column:
    """Mean of Phred+33 qualities; 0 where there is no base (null, empty or ``*``)."""
    n = phred_count(encoded)
    return F.when(n > 0, phred_total(encoded) / n).otherwise(0.0)


def strand_balance(forward: str | Column, reverse: str | Column) -> Column:
    f, r = _col(forward), _col(reverse)
    return F.when(f + r > 0, F.lit(200.0) * F.least(f, r) / (f + r)).otherwise(0.0)


def best_identity(found: str | Column, truths: str | Column) -> Column:
    """100 * (1 - distance / longer length) against the best of several truths in either orientation."""
    s = _col(found)

    def one(t: Column) -> Column:
        longer = lambda a, b: F.greatest(F.length(a), F.length(b), F.lit(1))
        either = lambda a: F.lit(100.0) * (1 - F.levenshtein(a, t) / longer(a, t))
        return F.greatest(either(s), either(reverse_complement(s)))

    return F.coalesce(F.array_max(F.transform(_col(truths), one)), F.lit(0.0))


def flag_names(flags: str | Column) -> Column:
    """Names of flags in ``NAME (detail); NAME (detail)``."""
    return F.regexp_extract_all(_col(flags), F.lit(r"(?:^|; )([A-Z][A-Z0-9_]+)"), F.lit(1))


def has_bit(value: str | Column, bit: int) -> Column:
    return _col(value).bitwiseAND(F.lit(1 << bit)) != 0


def measured_interval(text: str | Column) -> Column:
    """``10 (+/-2)`` to centre, low and high."""
    part = lambda i: F.try_to_number(F.regexp_extract(_col(text), r"([0-9.]+)\s*\((?:\+/-|±)\s*([0-9.]+)\)", i), F.lit("999999.999999")).cast("double")
    c, d = part(1), part(2)
    return F.struct(c.alias("centre"), (c - d).alias("low"), (c + d).alias("high"))


def number(text: str | Column) -> Column:
    return F.expr(f"try_cast(`{text}` as double)") if isinstance(text, str) else text.try_cast("double")


def interval_contains(low, high, value) -> Column:
    return _col(value).between(_col(low), _col(high))


def interval_overlaps(low, high, other_low, other_high) -> Column:
    return (_col(low) <= _col(other_high)) & (_col(other_low) <= _col(high))


def same_value(a, b, tolerance: float = 5e-4) -> Column:
    x, y = _col(a), _col(b)
    return (x.isNull() & y.isNull()) | F.coalesce(F.abs(x - y) < tolerance, F.lit(False))


def tiles(length: str | Column, count: int) -> Column:
    """1..length in ``count`` spans, the remainder on the last."""
    n = _col(length).cast("long")
    width = F.floor(n / count)
    return F.transform(F.sequence(F.lit(0), F.lit(count - 1)), lambda i: F.struct((i * width + 1).alias("start"), F.when(i == count - 1, n).otherwise((i + 1) * width).alias("end")))


def seed_for(*parts: str | Column) -> Column:
    """A reproducible 60-bit seed of text columns, from SHA-256."""
    return F.conv(F.substr(F.sha2(F.concat_ws(":", *map(_col, parts)), 256), F.lit(1), F.lit(15)), 16, 10).cast("long")


def reasons(*rules: tuple[Column, str]) -> Column:
    """Codes of the conditions that hold, in order."""
    return F.array_compact(F.array(*[F.when(cond, F.lit(code)) for cond, code in rules]))


def base_certainty(depth, forward, reverse, alt_fraction, base_quality, mapping_quality, credible, min_quality: float = 20, min_mapping: float = 20) -> Column:
    """Reason codes that make a base uncertain; no depth ends the list at once."""
    d, f, r = map(_col, (depth, forward, reverse))
    rest = reasons(
        (d < 2, "INSUFFICIENT_FILTERED_DEPTH"),
        ((d < 5) & ((f == 0) | (r == 0)), "NO_BIDIRECTIONAL_SUPPORT"),
        (_col(alt_fraction) >= 0.20, "EXCESS_ALTERNATIVE_SUPPORT"),
        (_col(credible), "CREDIBLE_MIXED_SITE"),
        (_col(base_quality) < min_quality, "LOW_BASE_QUALITY"),
        (_col(mapping_quality) < min_mapping, "LOW_MAPPING_QUALITY"),
    )
    return F.when(d == 0, F.array(F.lit("ZERO_DEPTH"))).otherwise(rest)


def disposition(status, tier) -> Column:
    """What happens to a result: only successes of the best tier pass."""
    s, t = _col(status), _col(tier)
    return F.when(s != "SUCCESS", "HOLD").when(t == "HIGH", "PASS").when(t.isin("MEDIUM", "LOW"), "REVIEW").otherwise("HOLD")


def first_match(default: str, *rules: tuple[Column, str]) -> Column:
    return reduce(lambda acc, rule: F.when(rule[0], F.lit(rule[1])).otherwise(acc), reversed(rules), F.lit(default))

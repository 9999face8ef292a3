"""Column functions of an aligned read: eligibility, strand, 5' endpoint, clipping, indels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

UNMAPPED, REVERSE, SECONDARY, QCFAIL, DUPLICATE, SUPPLEMENTARY, PAIRED = 4, 16, 256, 512, 1024, 2048, 1
MATE_UNMAPPED, MATE_REVERSE, FIRST, LAST = 8, 32, 64, 128


def has(bits: int, flag: str | Column = "flag") -> Column:
    return (F.col(flag) if isinstance(flag, str) else flag).bitwiseAND(bits) != 0


def eligible(min_mapq: int) -> Column:
    """Primary, mapped, passing, not a duplicate."""
    return ~has(UNMAPPED | SECONDARY | QCFAIL | DUPLICATE | SUPPLEMENTARY) & (F.col("mapping_quality") >= min_mapq)


def eligible_rgen(min_mapq: int) -> Column:
    """As above, but supplementary alignments count."""
    return ~has(UNMAPPED | SECONDARY | QCFAIL | DUPLICATE) & (F.col("mapping_quality") >= min_mapq)


def diagnostic(min_mapq: int) -> Column:
    """Secondary or supplementary, duplicates included."""
    return ~has(UNMAPPED | QCFAIL) & has(SECONDARY | SUPPLEMENTARY) & (F.col("mapping_quality") >= min_mapq)


def strand() -> Column:
    return F.when(has(REVERSE), "-").otherwise("+")


def endpoint() -> Column:
    return F.when(has(REVERSE), F.col("reference_end") - 1).otherwise(F.col("reference_start"))


def five_prime_clip(cigar: str = "cigar") -> Column:
    """Length of a soft or hard clip at the 5' end."""
    first = F.regexp_extract(F.col(cigar), r"^(\d+)[SH]", 1)
    last = F.regexp_extract(F.col(cigar), r"(\d+)[SH]$", 1)
    found = F.when(has(REVERSE), last).otherwise(first)
    return F.coalesce(F.nullif(found, F.lit("")).cast("int"), F.lit(0))


def unclipped_end(cigar: str = "cigar") -> Column:
    """Where the 5' end would lie without any clips: all soft and hard ones before it count."""
    total = lambda side: F.aggregate(F.regexp_extract_all(F.regexp_extract(F.col(cigar), side, 0), F.lit(r"(\d+)"), F.lit(1)), F.lit(0).cast("long"), lambda s, x: s + x.cast("long"))
    return F.when(has(REVERSE), endpoint() + F.coalesce(total(r"(\d+[SH])+$"), F.lit(0))).otherwise(endpoint() - F.coalesce(total(r"^(\d+[SH])+"), F.lit(0)))


def indel_events(cigar: str = "cigar", start: str = "reference_start") -> Column:
    """Array of (pos, kind, length) in read order; empty where the CIGAR has no indel."""
    walk = f"""
      aggregate(
        arrays_zip(regexp_extract_all({cigar}, '(\\\\d+)[MIDNSHP=X]', 1), regexp_extract_all({cigar}, '\\\\d+([MIDNSHP=X])', 1)),
        named_struct('at', cast({start} as bigint), 'found', cast(array() as array<struct<pos:bigint,kind:string,length:int>>)),
        (s, op) -> named_struct(
          'at', s.at + CASE WHEN op.`1` IN ('M','D','N','=','X') THEN cast(op.`0` as int) ELSE 0 END,
          'found', CASE WHEN op.`1` = 'I' THEN concat(s.found, array(named_struct('pos', s.at, 'kind', 'INS', 'length', cast(op.`0` as int))))
                        WHEN op.`1` = 'D' THEN concat(s.found, array(named_struct('pos', s.at, 'kind', 'DEL', 'length', cast(op.`0` as int)))) ELSE s.found END),
        s -> s.found)"""
    none = "cast(array() as array<struct<pos:bigint,kind:string,length:int>>)"
    return F.expr(f"CASE WHEN {cigar} RLIKE '[ID]' THEN {walk} ELSE {none} END")


def reference_end(cigar: str = "cigar", start: str = "reference_start") -> Column:
    """Half-open end from the CIGAR."""
    sizes = F.regexp_extract_all(F.col(cigar), F.lit(r"(\d+)[MDN=X]"), F.lit(1))
    return F.col(start) + F.aggregate(sizes, F.lit(0).cast("long"), lambda s, x: s + x.cast("long"))

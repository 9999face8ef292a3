import re

from strandmark.schema import READ_SCHEMA

OPS = {"M": 1, "D": 1, "N": 1, "=": 1, "X": 1, "I": 0, "S": 0, "H": 0, "P": 0}


def read(start, flag=1, cigar="50M", mapq=60, nm=0, contig="chr1", name="q"):
    end = start + sum(int(n) * OPS[k] for n, k in re.findall(r"(\d+)([MIDNSHP=X])", cigar))
    return [name, flag, contig, start, end, mapq, cigar, nm]


def frame(spark, rows):
    rows = sorted(rows, key=lambda r: r[3])
    return spark.createDataFrame([(k, *r[:2], *r[2:]) for k, r in enumerate(rows)], READ_SCHEMA)


def forward(n, at, **kw):
    return [read(at, name=f"f{at}_{k}", **kw) for k in range(n)]


def reverse(n, last, **kw):
    """5' endpoint at last."""
    return [read(last - 49, flag=17, name=f"r{last}_{k}", **kw) for k in range(n)]


def covering(n, at):
    return [read(at - 20 - k, name=f"b{at}_{k}") for k in range(n)]


def reverse_covering(n, at):
    return [read(at - 49 + 1 + k, flag=17, name=f"c{at}_{k}") for k in range(n)]

import random

from strandmark.sources import formats

BODY = "ACGTTGCAAC" * 3


def test_tails_are_trimmed_before_the_length_filter(spark):
    seqs = {"whole": BODY, "g": BODY + "G" * 15, "t": BODY + "T" * 12, "short": BODY + "G" * 6, "mixed": BODY + "G" * 8 + "T" + "G" * 12, "left too short": BODY[:20] + "G" * 15, "all": "G" * 40}
    reads = spark.createDataFrame([(n, s, "I" * len(s)) for n, s in seqs.items()], "name string, seq string, qual string")
    got = {r.name: (r.seq, len(r.qual)) for r in formats.passing_reads(reads).collect()}
    assert got == {n: (BODY, 30) for n in ("whole", "g", "t", "mixed")} | {"short": (seqs["short"], 36)}
    assert {r.name: r.seq for r in formats.trimmed_tails(reads).collect()}["all"] == ""


def walked(seq, base, least):
    """The rule, a letter at a time from the end."""
    others = tail = steps = 0
    for k, x in enumerate(reversed(seq)):
        others += x != base
        if others > 5 or (others > (k + 1) // 8 and k >= least - 1):
            break
        steps = k + 1
        tail = steps if x == base else tail
    return tail if steps >= least else 0


def test_tails_against_a_walk():
    rng = random.Random(3)
    seqs = ["", "G", "é" * 12, "G" * 500] + ["".join(rng.choices("ACGTN", k=rng.randint(0, 40))) + "".join(rng.choices(rng.choice(["GGGGGGGGA", "TTTTTTTTTTTC", "AC", "G"]), k=rng.randint(0, 60))) for _ in range(400)]
    for base in "GATC":
        for least in (1, 10):
            assert formats._tails(seqs, base, least).tolist() == [walked(s, base, least) for s in seqs]


def test_plan_has_the_tails_once(spark):
    reads = spark.createDataFrame([("r", BODY + "G" * 15, "I" * 45)], "name string, seq string, qual string")
    plan = formats.passing_reads(reads)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("tail(") == 1 and "aggregate(" not in plan


def test_a_file_in_many_splits(spark, tmp_path):
    rng = random.Random(5)
    rows = [(f"r{k}/{'x' * rng.randint(0, 30)}", "".join(rng.choices("ACGT", k=rng.randint(0, 90)))) for k in range(700)]
    for name, own in (("a", rows[:500]), ("b", rows[500:])):
        (tmp_path / f"{name}.fq").write_text("".join(f"@{n}\n{s}\n+\n{'I' * len(s)}\n" for n, s in own))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "3000")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        df = formats.fastq(spark, [str(tmp_path / "a.fq"), str(tmp_path / "b.fq")])
        assert spark.read.text(str(tmp_path / "a.fq")).rdd.getNumPartitions() > 10
        got = sorted(tuple(r) for r in df.collect())
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert got == sorted((n, s, "I" * len(s)) for n, s in rows)

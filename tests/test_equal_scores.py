from strandmark.operators import double_strand

# equal ratios of counts, 7/8, one of them a bit more in doubles; and sums that are equal so
MORE, LESS = 0.875000000000000111, 0.875


def test_a_star_of_equal_scores_takes_the_first(spark):
    rows = [("chr1", 100, 97, LESS, []), ("chr1", 100, 102, MORE, [])]
    pairs = spark.createDataFrame(rows, "contig string, forward_position long, reverse_position long, pair_score double, caller_reasons array<string>")
    assert [tuple(r)[:3] for r in double_strand.select_pairs(pairs, 0).collect()] == [("chr1", 100, 97)]


def test_assignments_of_equal_sums_take_the_smallest_ranks():
    """Of a square of edges either diagonal: the sums of scores are equal but for the last bit, so are the ranks, so the first counts."""
    edges = [(1, 1, True, LESS), (1, 2, True, MORE), (2, 1, True, LESS), (2, 2, True, LESS)]
    assert MORE > LESS and 1 / 49 * 49 < 1
    assert double_strand.walked_assignment(edges) == double_strand.best_assignment(edges) == [0, 3]
    edges = [(1, 1, True, 1.0), (1, 2, True, 1.0), (2, 1, True, 1.0), (2, 2, True, 1 / 49 * 49)]
    assert double_strand.walked_assignment(edges) == double_strand.best_assignment(edges) == [0, 3]

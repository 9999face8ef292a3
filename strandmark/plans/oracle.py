"""DuckDB SQL of the registered queries."""

from __future__ import annotations

from strandmark.sources.fixtures import CONTIGS_SQL, MASK_SQL, PAIRS_SQL, READS_SQL, VARIANTS_SQL


def _with(body: str, *parts: str, sample: str = "treated") -> str:
    """WITH reads, control, variants, ... and the named parts, then the body."""
    known = {
        "variants": f"variants AS ({VARIANTS_SQL})",
        "mask": f"mask AS ({MASK_SQL})",
        "contigs": f"contigs AS ({CONTIGS_SQL})",
    }
    base = f"all_reads AS ({READS_SQL}), reads AS (SELECT *, {_ELIGIBLE} AS ok, {_STRAND} AS strand, {_END} AS pos5 FROM all_reads WHERE sample = 'treated'), control AS (SELECT *, {_ELIGIBLE} AS ok, {_STRAND} AS strand, {_END} AS pos5 FROM all_reads WHERE sample = 'control')"
    return f"WITH {', '.join([base, *[known.get(p, _PARTS.get(p, p)) for p in parts]])} {body}"


_ELIGIBLE = "((flag & 3844) = 0 AND mapping_quality >= 1)"
_STRAND = "CASE WHEN (flag & 16) <> 0 THEN '-' ELSE '+' END"
_END = "CASE WHEN (flag & 16) <> 0 THEN reference_end - 1 ELSE reference_start END"
_CLIP = "CASE WHEN (flag & 16) <> 0 THEN regexp_matches(cigar, '[SH]$') ELSE regexp_matches(cigar, '^[0-9]+[SH]') END"


def _depth(sites: str, reads: str, out: str) -> str:
    return f"""{out} AS (SELECT s.contig, s.pos, s.strand, count(*) FILTER (WHERE r.pos5 = s.pos) AS n, count(*) AS d,
      count(*) FILTER (WHERE r.pos5 = s.pos) / count(*)::DOUBLE AS f
      FROM (SELECT DISTINCT contig, pos, strand FROM {sites}) s JOIN {reads} r ON r.ok AND r.contig = s.contig AND r.strand = s.strand AND r.reference_start <= s.pos AND r.reference_end > s.pos GROUP BY ALL)"""


#: From tested(n, d, cn, cd): p and q values as controlled(..., fold, fp, fq).
_FISHER = """      tables AS (SELECT DISTINCT n AS a, greatest(d - n, 0) AS b, cn AS c, greatest(cd - cn, 0) AS e FROM tested WHERE cd >= 1),
      grid AS (SELECT *, unnest(range(greatest(0, a + c - (c + e)), least(a + b, a + c) + 1)) AS x FROM tables),
      probs AS (SELECT a, b, c, e, x, exp(lgamma(a + b + 1) - lgamma(x + 1) - lgamma(a + b - x + 1) + lgamma(c + e + 1) - lgamma(a + c - x + 1) - lgamma(e - a + x + 1) - (lgamma(a + b + c + e + 1) - lgamma(a + c + 1) - lgamma(b + e + 1))) AS p FROM grid),
      fisher AS (SELECT a, b, c, e, least(1.0, sum(p) FILTER (WHERE p <= o * (1 + 1e-12))) AS fp FROM (SELECT *, max(p) FILTER (WHERE x = a) OVER (PARTITION BY a, b, c, e) AS o FROM probs) GROUP BY ALL),
      ranked AS (SELECT t.*, f.fp, ((t.n + 0.5) / (t.d + 1.0)) / ((t.cn + 0.5) / (t.cd + 1.0)) AS fold FROM tested t LEFT JOIN fisher f ON t.cd >= 1 AND f.a = t.n AND f.b = greatest(t.d - t.n, 0) AND f.c = t.cn AND f.e = greatest(t.cd - t.cn, 0)),
      ps AS (SELECT fp, count(*) AS k FROM ranked WHERE fp IS NOT NULL GROUP BY fp),
      pr AS (SELECT fp, sum(k) OVER (ORDER BY fp ROWS UNBOUNDED PRECEDING) AS r, sum(k) OVER () AS t FROM ps),
      qs AS (SELECT fp, least(1.0, min(fp * t / r) OVER (ORDER BY fp DESC ROWS UNBOUNDED PRECEDING)) AS fq FROM pr),
      controlled AS (SELECT ranked.*, qs.fq FROM ranked LEFT JOIN qs ON qs.fp = ranked.fp)"""
_PARTS = {
    "ends": "ends AS (SELECT contig, pos5 AS pos, strand, count(*) AS count FROM reads WHERE ok GROUP BY ALL)",
    "piles": "piles AS (SELECT * FROM ends WHERE count >= 4)",
    "piles3": "piles3 AS (SELECT * FROM ends WHERE count >= 3)",
    "merged": """m0 AS (SELECT contig, start_, end_, max(end_) OVER (PARTITION BY contig ORDER BY start_, end_ ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS b FROM mask),
      m1 AS (SELECT *, sum(CASE WHEN b IS NULL OR start_ > b THEN 1 ELSE 0 END) OVER (PARTITION BY contig ORDER BY start_, end_ ROWS UNBOUNDED PRECEDING) AS g FROM m0),
      merged AS (SELECT contig, min(start_) AS s, max(end_) AS e FROM m1 GROUP BY contig, g)""",
    "open_ends": "open_ends AS (SELECT * FROM ends e WHERE NOT EXISTS (SELECT 1 FROM merged m WHERE m.contig = e.contig AND e.pos >= m.s AND e.pos < m.e))",
    "depth": _depth("piles", "reads", "depth"),
    "focal": "focal AS (SELECT * FROM depth WHERE f >= 0.2)",
    "indels": """indels AS (SELECT *, reference_start + 5 AS ip, CASE WHEN cigar LIKE '5M1I%' THEN 'INS' ELSE 'DEL' END AS kind, CASE WHEN cigar LIKE '5M1I%' THEN 1 ELSE 3 END AS len FROM reads WHERE ok AND (cigar LIKE '5M1I%' OR cigar LIKE '5M3D%')),
      near_indels AS (SELECT s.contig, s.pos, s.strand, i.read_ord, i.query_name, i.flag, i.reference_start, i.ip, i.kind, i.len FROM sites s JOIN indels i ON i.contig = s.contig AND i.reference_start < s.pos + 11 AND i.reference_end > greatest(s.pos - 10, 0)
        WHERE CASE WHEN i.kind = 'DEL' THEN i.ip < s.pos + 11 AND i.ip + i.len > greatest(s.pos - 10, 0) ELSE i.ip >= greatest(s.pos - 10, 0) AND i.ip < s.pos + 11 END),
      modal AS (SELECT contig, pos, strand, ip, kind, len FROM (SELECT *, row_number() OVER (PARTITION BY contig, pos, strand ORDER BY c DESC, o, ip) AS k FROM (SELECT contig, pos, strand, ip, kind, len, count(*) AS c, min(read_ord) AS o FROM near_indels GROUP BY ALL)) WHERE k = 1),
      indel_reads AS (SELECT contig, pos, strand, count(DISTINCT (query_name, flag, reference_start)) AS ir FROM near_indels GROUP BY ALL)""",
    "metrics": f"""near AS (SELECT s.contig, s.pos, s.strand, r.*, r.strand AS rs, {_CLIP} AS clipped,
        r.ok AND r.strand = s.strand AND r.pos5 = s.pos AS is_e, r.ok AND r.strand = s.strand AND r.reference_start <= s.pos AND s.pos < r.reference_end AS is_d,
        (r.flag & 516) = 0 AND (r.flag & 2304) <> 0 AND r.mapping_quality >= 1 AND r.strand = s.strand AND r.pos5 = s.pos AS is_s
        FROM sites s JOIN reads r ON r.contig = s.contig AND r.reference_start < s.pos + 11 AND r.reference_end > greatest(s.pos - 10, 0)),
      base AS (SELECT contig, pos, strand, count(*) FILTER (WHERE is_e) AS endpoint_count, count(*) FILTER (WHERE is_d) AS strand_depth,
        coalesce(avg(mapping_quality) FILTER (WHERE is_e), 0) AS support_mean_mapq, count(*) FILTER (WHERE is_e) AS support_read_count, coalesce(avg(mapping_quality) FILTER (WHERE ok), 0) AS local_mean_mapq, count(*) FILTER (WHERE ok) AS local_read_count,
        coalesce(avg(nm) FILTER (WHERE is_e), 0) AS support_mean_nm, count(nm) FILTER (WHERE is_e) AS support_nm_count, coalesce(avg(nm) FILTER (WHERE ok), 0) AS local_mean_nm, count(nm) FILTER (WHERE ok) AS local_nm_count,
        count(*) FILTER (WHERE is_e AND clipped) AS softclipped_count, count(*) FILTER (WHERE is_s) AS secondary_endpoint_count FROM near GROUP BY ALL),
      metrics AS (SELECT base.*, CASE WHEN strand_depth > 0 THEN endpoint_count / strand_depth::DOUBLE ELSE 0 END AS endpoint_fraction, CASE WHEN endpoint_count > 0 THEN softclipped_count / endpoint_count::DOUBLE ELSE 0 END AS softclip_fraction,
        coalesce(ir, 0) AS indel_read_count, CASE WHEN local_read_count > 0 THEN coalesce(ir, 0) / local_read_count::DOUBLE ELSE 0 END AS indel_fraction, modal.ip, modal.kind, modal.len
        FROM base LEFT JOIN indel_reads USING (contig, pos, strand) LEFT JOIN modal USING (contig, pos, strand))""",
    "sites": "sites AS (SELECT contig, pos, strand FROM piles)",
    "best": """pairs0 AS (SELECT f.contig, f.pos, f.strand, e.pos AS op, e.strand AS os FROM focal f JOIN opp_ends e ON e.contig = f.contig AND e.strand <> f.strand AND abs(e.pos - f.pos) <= 2),
      best AS (SELECT p.contig, p.pos, p.strand, p.op, d.n AS on_, d.d AS od, d.f AS of_, row_number() OVER (PARTITION BY p.contig, p.pos, p.strand ORDER BY (d.n >= 4 AND d.f >= 0.2) DESC, (d.n >= 2 OR d.f >= 0.05) DESC, d.n DESC, d.f DESC, abs(p.op - p.pos), p.op) AS k
        FROM pairs0 p JOIN odepth d ON d.contig = p.contig AND d.pos = p.op AND d.strand = p.os QUALIFY k = 1)""",
    "odepth": _depth("(SELECT DISTINCT e.* FROM opp_ends e JOIN focal f ON e.contig = f.contig AND e.strand <> f.strand AND abs(e.pos - f.pos) <= 2)", "reads", "odepth"),
    "called": """called AS (SELECT f.contig, f.pos, f.strand, f.n, f.d, f.f, b.op, coalesce(b.on_, 0) AS on_, coalesce(b.od, 0) AS od, coalesce(b.of_, 0) AS of_,
        CASE WHEN coalesce(b.on_, 0) >= 4 AND coalesce(b.of_, 0) >= 0.2 THEN 'POSSIBLE_DSB' WHEN coalesce(b.on_, 0) >= 2 OR coalesce(b.of_, 0) >= 0.05 THEN 'AMBIGUOUS' ELSE 'SSB' END AS signal,
        CASE WHEN b.op IS NULL THEN 0 ELSE f.f * b.of_ * (f.n + b.on_) / 4.0 END AS score FROM focal f LEFT JOIN best b USING (contig, pos, strand))""",
    "controlled": f"""{_depth("called", "control", "cdepth")},
      tested AS (SELECT c.*, coalesce(x.n, 0) AS cn, coalesce(x.d, 0) AS cd, coalesce(x.f, 0) AS cf FROM called c LEFT JOIN cdepth x USING (contig, pos, strand)),
{_FISHER}""",
    "labels": """labels AS (SELECT contig, pos - 1 AS s, pos - 1 + length(ref) AS e, concat(contig, ':', pos, ':', ref, '>', alt) AS label FROM (SELECT contig, pos, ref, string_agg(a, ',' ORDER BY k) AS alt FROM (SELECT contig, pos, ref, unnest(string_split(alt, ',')) AS a, unnest(range(len(string_split(alt, ',')))) AS k FROM variants) WHERE length(a) <> length(ref) GROUP BY ALL))""",
}
_ALL = ("ends", "piles", "sites", "depth", "focal", "mask", "merged", "open_ends")
_PLAIN_OPP = "opp_ends AS (SELECT * FROM ends)"
_SSB = ("ends", "piles", "sites", "depth", "focal", _PLAIN_OPP, "odepth", "best", "called")
_PAIRS = (
    "ends", "piles3", _depth("piles3", "reads", "depth"),
    """pairs AS (SELECT f.contig, f.pos AS forward_position, r.pos AS reverse_position, df.n AS fn, df.d AS fd, df.f AS ff, dr.n AS rn, dr.d AS rd, dr.f AS rf, df.f * dr.f * (df.n + dr.n) / 4.0 AS pair_score
      FROM piles3 f JOIN piles3 r ON f.contig = r.contig AND f.strand = '+' AND r.strand = '-' AND r.pos BETWEEN f.pos - 3 AND f.pos + 3
      JOIN depth df ON df.contig = f.contig AND df.pos = f.pos AND df.strand = '+' JOIN depth dr ON dr.contig = r.contig AND dr.pos = r.pos AND dr.strand = '-')""",
)
# the final table: masked piles, all evidence
_FINAL = (
    "ends", "mask", "merged", "open_ends", "piles AS (SELECT * FROM open_ends WHERE count >= 4)", "sites", "depth", "focal", "opp_ends AS (SELECT * FROM open_ends)", "odepth", "best", "called", "controlled", "indels", "metrics", "variants", "labels",
    """hits AS (SELECT c.contig, c.pos, c.strand, string_agg(DISTINCT l.label, ';' ORDER BY l.label) AS known FROM (SELECT contig, pos, strand, unnest([pos, op]) AS at FROM called) c JOIN labels l ON l.contig = c.contig AND c.at >= greatest(l.s - 10, 0) AND c.at < l.e + 10 GROUP BY ALL)""",
    """joined AS (SELECT c.*, m.* EXCLUDE (contig, pos, strand), coalesce(h.known, '') AS known FROM controlled c JOIN metrics m USING (contig, pos, strand) LEFT JOIN hits h USING (contig, pos, strand))""",
    """judged AS (SELECT *, CASE WHEN cd >= 1 THEN 'MATCHED_CONTROL' ELSE 'INSUFFICIENT_CONTROL_COVERAGE' END AS status,
      list_filter([CASE WHEN softclip_fraction >= 0.2 THEN 'HIGH_5P_SOFTCLIP' END, CASE WHEN indel_fraction >= 0.2 THEN 'NEARBY_INDEL' END, CASE WHEN known <> '' THEN 'KNOWN_INDEL' END, CASE WHEN support_mean_mapq < 10 THEN 'LOW_SUPPORT_MAPQ' END,
        CASE WHEN cd < 1 THEN 'INSUFFICIENT_CONTROL_COVERAGE' END, CASE WHEN cd >= 1 AND cf > 0.05 THEN 'HIGH_CONTROL_FRACTION' END, CASE WHEN cd >= 1 AND fold < 3 THEN 'LOW_CONTROL_FOLD' END, CASE WHEN cd >= 1 AND fq > 0.05 THEN 'CONTROL_Q_FAIL' END], lambda x: x IS NOT NULL) AS artifact FROM joined)""",
    """final AS (SELECT *, CASE WHEN len(artifact) > 0 THEN 'ARTIFACT_RISK' ELSE signal END AS classification, list_concat(artifact, CASE WHEN signal <> 'SSB' THEN [signal] ELSE [] END) AS reasons FROM judged)""",
)
_r = lambda x, name: f"round({x}, 6) AS {name}"
_side = lambda s, own, other: f"CASE WHEN strand = '{s}' THEN {own} ELSE {other} END"
_FINAL_SELECT = f"""SELECT 'treated' AS sample, 'ndigenome' AS analysis, 'control' AS control_sample, status AS control_status, contig, pos AS position_0based, pos + 1 AS position_1based, strand,
 {_side('+', 'pos', 'op')} AS forward_position_0based, {_side('+', 'pos', 'op')} + 1 AS forward_position_1based, {_side('-', 'pos', 'op')} AS reverse_position_0based, {_side('-', 'pos', 'op')} + 1 AS reverse_position_1based,
 endpoint_count, strand_depth, {_r('endpoint_fraction', 'endpoint_fraction')}, op AS opposite_position_0based, op + 1 AS opposite_position_1based, on_ AS opposite_count, od AS opposite_depth, {_r('of_', 'opposite_fraction')},
 {_side('+', 'n', 'on_')} AS forward_endpoint_count, {_side('+', 'd', 'od')} AS forward_depth, {_r(_side('+', 'f', 'of_'), 'forward_fraction')}, {_side('-', 'n', 'on_')} AS reverse_endpoint_count, {_side('-', 'd', 'od')} AS reverse_depth, {_r(_side('-', 'f', 'of_'), 'reverse_fraction')},
 {_r('score', 'digenome_pair_score')}, CAST(NULL AS DOUBLE) AS rgen_digenome_score, signal AS signal_classification, classification, CASE WHEN len(reasons) = 0 THEN 'PASS' ELSE 'FILTERED' END AS filter_status, array_to_string(reasons, ';') AS filter_reasons,
 {_r('support_mean_mapq', 'support_mean_mapq')}, {_r('local_mean_mapq', 'local_mean_mapq')}, {_r('support_mean_nm', 'support_mean_nm')}, {_r('local_mean_nm', 'local_mean_nm')}, {_r('softclip_fraction', 'softclip_fraction')}, secondary_endpoint_count,
 ip AS indel_position_0based, ip + 1 AS indel_position_1based, coalesce(kind, '') AS indel_type, CAST(coalesce(len, 0) AS BIGINT) AS indel_length, indel_read_count, {_r('indel_fraction', 'indel_fraction')}, known AS known_indel_overlap,
 cn AS control_endpoint_count, cd AS control_depth, {_r('cf', 'control_fraction')}, {_side('+', 'cn', '0')} AS control_forward_endpoint_count, {_side('+', 'cd', '0')} AS control_forward_depth, {_r(_side('+', 'cf', '0'), 'control_forward_fraction')},
 {_side('-', 'cn', '0')} AS control_reverse_endpoint_count, {_side('-', 'cd', '0')} AS control_reverse_depth, {_r(_side('-', 'cf', '0'), 'control_reverse_fraction')}, CAST(NULL AS DOUBLE) AS control_digenome_pair_score, CAST(NULL AS DOUBLE) AS control_rgen_digenome_score,
 {_r('CASE WHEN cd >= 1 THEN fold END', 'control_fold_enrichment')}, {_r('fp', 'control_fisher_p')}, {_r('fq', 'control_fisher_q')} FROM final"""

ORACLE_SQL = {
    "eligible_reads": _with(f"SELECT contig, strand, count(*) AS n, CAST(sum(reference_start) AS BIGINT) AS starts, CAST(sum(CASE WHEN {_CLIP} THEN 5 ELSE 0 END) AS BIGINT) AS clipped FROM reads WHERE ok GROUP BY ALL"),
    "read_endpoints": _with("SELECT query_name, contig, strand, pos5 AS pos FROM reads WHERE ok"),
    "endpoint_pileups": _with("SELECT * FROM piles", "ends", "piles"),
    "site_depth_fraction": _with("SELECT contig, pos, strand, n AS endpoint_count, d AS strand_depth, round(f, 6) AS endpoint_fraction FROM depth", "ends", "piles", "depth"),
    "site_local_metrics": _with(
        "SELECT contig, pos, strand, endpoint_count, strand_depth, round(endpoint_fraction, 6) AS endpoint_fraction, round(support_mean_mapq, 6) AS support_mean_mapq, support_read_count, round(local_mean_mapq, 6) AS local_mean_mapq, local_read_count, round(support_mean_nm, 6) AS support_mean_nm, support_nm_count, round(local_mean_nm, 6) AS local_mean_nm, local_nm_count, round(softclip_fraction, 6) AS softclip_fraction, softclipped_count, secondary_endpoint_count, indel_read_count, round(indel_fraction, 6) AS indel_fraction FROM metrics",
        "ends", "piles", "sites", "indels", "metrics"),
    "modal_indel": _with("SELECT contig, pos, strand, ip AS indel_position, kind AS indel_type, CAST(len AS BIGINT) AS indel_length FROM modal", "ends", "piles", "sites", "indels"),
    "opposite_best": _with("SELECT contig, pos, strand, op AS opposite_position, on_ AS opposite_count, od AS opposite_depth, round(of_, 6) AS opposite_fraction FROM best", *_SSB[:-1]),
    "ssb_calls": _with("SELECT contig, pos, strand, n AS endpoint_count, d AS strand_depth, op AS opposite_position_0based, on_ AS opposite_count, signal AS signal_classification, round(score, 6) AS digenome_pair_score FROM called", *_SSB),
    "pair_candidates": _with(
        "SELECT contig, forward_position, reverse_position, round(pair_score, 6) AS pair_score, array_to_string(list_filter([CASE WHEN fn <= 2 THEN 'LOW_FORWARD_COUNT' END, CASE WHEN rn <= 2 THEN 'LOW_REVERSE_COUNT' END, CASE WHEN fd <= 4 THEN 'LOW_FORWARD_DEPTH' END, CASE WHEN rd <= 4 THEN 'LOW_REVERSE_DEPTH' END, CASE WHEN ff <= 0.2 THEN 'LOW_FORWARD_FRACTION' END, CASE WHEN rf <= 0.2 THEN 'LOW_REVERSE_FRACTION' END, CASE WHEN pair_score <= 0.5 THEN 'LOW_DIGENOME_PAIR_SCORE' END], lambda x: x IS NOT NULL), ';') AS reasons FROM pairs",
        *_PAIRS),
    "pair_components": _with(
        """SELECT contig, forward_position, reverse_position, CAST(sum(CASE WHEN b IS NULL OR lo > b THEN 1 ELSE 0 END) OVER (PARTITION BY contig ORDER BY lo, hi, forward_position, reverse_position ROWS UNBOUNDED PRECEDING) AS BIGINT) AS component
        FROM (SELECT *, max(hi) OVER (PARTITION BY contig ORDER BY lo, hi, forward_position, reverse_position ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS b FROM (SELECT *, least(forward_position, reverse_position) AS lo, greatest(forward_position, reverse_position) AS hi FROM pairs))""",
        *_PAIRS),
    "control_evidence": _with("SELECT contig, pos, strand, CASE WHEN cd >= 1 THEN 'MATCHED_CONTROL' ELSE 'INSUFFICIENT_CONTROL_COVERAGE' END AS control_status, cn AS control_endpoint_count, cd AS control_depth, round(cf, 6) AS control_fraction, round(CASE WHEN cd >= 1 THEN fold END, 6) AS control_fold_enrichment, round(fp, 6) AS control_fisher_p, round(fq, 6) AS control_fisher_q FROM controlled", *_SSB, "controlled"),
    "q_values": """WITH o AS (SELECT o_orderkey, o_custkey % 3 AS g, CASE WHEN o_orderkey % 10 <> 0 THEN CAST(floor(o_totalprice) AS BIGINT) % 1000 / CAST(1000 AS DOUBLE) END AS p FROM orders),
      c AS (SELECT g, p, count(*) AS k FROM o WHERE p IS NOT NULL GROUP BY ALL), r AS (SELECT g, p, sum(k) OVER (PARTITION BY g ORDER BY p ROWS UNBOUNDED PRECEDING) AS r, sum(k) OVER (PARTITION BY g) AS t FROM c),
      q AS (SELECT g, p, least(1.0, min(p * t / r) OVER (PARTITION BY g ORDER BY p DESC ROWS UNBOUNDED PRECEDING)) AS q FROM r)
      SELECT o.o_orderkey, o.g, round(o.p, 6) AS p, round(q.q, 6) AS q FROM o LEFT JOIN q ON q.g = o.g AND q.p = o.p""",
    "blacklist_merge": _with('SELECT contig, s AS start, e AS "end" FROM merged', "mask", "merged"),
    "blacklist_totals": _with("SELECT count(*) AS interval_count, CAST(sum(e - s) AS BIGINT) AS excluded_bases FROM merged", "mask", "merged"),
    "blacklist_subtract": _with(
        """, tiles AS (SELECT contig, s, least(s + 1000, length) AS e FROM (SELECT contig, length, unnest(range(0, length, 1000)) AS s FROM contigs)),
        cuts AS (SELECT t.contig, t.s AS ts, t.e AS te, m.s, m.e FROM tiles t JOIN merged m ON m.contig = t.contig AND m.s < t.e AND m.e > t.s),
        gaps AS (SELECT contig, ts, te, e AS a, coalesce(lead(s) OVER (PARTITION BY contig, ts ORDER BY s), te) AS b FROM cuts UNION ALL SELECT contig, ts, te, ts, min(s) FROM cuts GROUP BY ALL
          UNION ALL SELECT contig, s, e, s, e FROM tiles t WHERE NOT EXISTS (SELECT 1 FROM cuts c WHERE c.contig = t.contig AND c.ts = t.s))
        SELECT contig, greatest(a, ts) AS start, least(b, te) AS "end" FROM gaps WHERE greatest(a, ts) < least(b, te)""".lstrip(),
        "contigs", "mask", "merged").replace(") , tiles", "), tiles"),
    "masked_endpoints": _with("SELECT * FROM open_ends WHERE count >= 4", "ends", "mask", "merged", "open_ends"),
    "known_indel_overlap": _with("SELECT p.contig, p.pos, p.strand, string_agg(DISTINCT l.label, ';' ORDER BY l.label) AS known_indel_overlap FROM piles p JOIN labels l ON l.contig = p.contig AND p.pos >= greatest(l.s - 10, 0) AND p.pos < l.e + 10 GROUP BY ALL", "ends", "piles", "variants", "labels"),
    "final_calls_ssb": _with(_FINAL_SELECT, *_FINAL),
    "tier_counts": _with("SELECT CASE WHEN len(reasons) = 0 THEN 'high_confidence' WHEN classification = 'ARTIFACT_RISK' THEN 'artifact' ELSE 'manual_review' END AS tier, classification, count(*) AS n FROM final GROUP BY ALL", *_FINAL),
    "bed_rows": _with("SELECT contig, pos AS start, pos + 1 AS \"end\", concat('treated|', strand, '|', classification) AS name, CAST(least(1000, round_even(endpoint_fraction * 1000, 0)) AS INT) AS score, strand AS bed_strand FROM final WHERE len(reasons) = 0", *_FINAL),
    "qc_counts": _with("SELECT count(*) AS total, count(*) FILTER (WHERE len(reasons) = 0) AS passed, count(*) FILTER (WHERE classification = 'SSB') AS ssb, count(*) FILTER (WHERE classification = 'POSSIBLE_DSB') AS possible_dsb, count(*) FILTER (WHERE classification = 'AMBIGUOUS') AS ambiguous, count(*) FILTER (WHERE classification = 'DSB') AS dsb, count(*) FILTER (WHERE classification = 'ARTIFACT_RISK') AS artifact_risk FROM final", *_FINAL),
    "contig_density": _with("SELECT contig, count(*) AS mapped FROM reads WHERE (flag & 4) = 0 GROUP BY ALL"),
    "flagstat": _with("SELECT count(*) AS total, " + ", ".join(f"count(*) FILTER (WHERE (flag & {b}) <> 0) AS {n}" for n, b in (("paired", 1), ("unmapped", 4), ("secondary", 256), ("qcfail", 512), ("duplicates", 1024), ("supplementary", 2048), ("reverse", 16))) + ", count(*) FILTER (WHERE (flag & 4) = 0) AS mapped FROM reads"),
    "rgen_score": _with(
        "SELECT contig, forward_position, CASE WHEN round(CAST(total AS DOUBLE), 6) = 0 THEN CAST(0 AS DOUBLE) ELSE round(CAST(total AS DOUBLE), 6) END AS rgen_digenome_score FROM summed",
        "ends", "piles3", "contigs",
        "ok_rgen AS (SELECT contig, flag, reference_start, reference_end, strand, pos5 FROM reads WHERE (flag & 1796) = 0 AND mapping_quality >= 1)",
        "fwd AS (SELECT contig, pos AS p FROM piles3 WHERE strand = '+')",
        "places AS (SELECT DISTINCT contig, p + k AS at FROM fwd, range(-3, 3) t(k))",
        "one AS (SELECT a.contig, a.at, count(*) FILTER (WHERE r.strand = '+' AND r.pos5 = a.at) AS f, count(*) FILTER (WHERE r.strand = '-' AND r.pos5 = a.at) AS r, count(*) AS d FROM places a JOIN contigs c ON c.contig = a.contig AND a.at >= 0 AND a.at < c.length JOIN ok_rgen r ON r.contig = a.contig AND r.reference_start <= a.at AND r.reference_end > a.at GROUP BY ALL)",
        "steps AS (SELECT w.contig, w.p, k, coalesce(a.f, 0) AS c1, coalesce(a.d, 0) AS d1, coalesce(b.r, 0) AS c2, coalesce(b.d, 0) AS d2, coalesce(e.r, 0) AS c3, coalesce(e.d, 0) AS d3, coalesce(g.f, 0) AS c4, coalesce(g.d, 0) AS d4 FROM (SELECT contig, p, k FROM fwd, range(-2, 3) t(k)) w LEFT JOIN one a ON a.contig = w.contig AND a.at = w.p LEFT JOIN one b ON b.contig = w.contig AND b.at = w.p - 1 + k LEFT JOIN one e ON e.contig = w.contig AND e.at = w.p - 1 LEFT JOIN one g ON g.contig = w.contig AND g.at = w.p + k)",
        "added AS (SELECT contig, p, k, CASE WHEN d3 > 0 AND d4 > 0 THEN ((c3::FLOAT - 1::FLOAT) / d3::FLOAT) * (c4::FLOAT - 1::FLOAT) / d4::FLOAT * ((c3 + c4)::FLOAT - 2::FLOAT) ELSE 0::FLOAT END + CASE WHEN d1 > 0 AND d2 > 0 THEN ((c1::FLOAT - 1::FLOAT) / d1::FLOAT) * (c2::FLOAT - 1::FLOAT) / d2::FLOAT * ((c1 + c2)::FLOAT - 2::FLOAT) ELSE 0::FLOAT END AS v FROM steps)",
        "wide AS (SELECT contig, p, max(v) FILTER (WHERE k = -2) AS a, max(v) FILTER (WHERE k = -1) AS b, max(v) FILTER (WHERE k = 0) AS c, max(v) FILTER (WHERE k = 1) AS d, max(v) FILTER (WHERE k = 2) AS e FROM added GROUP BY ALL)",
        "summed AS (SELECT contig, p AS forward_position, e + (d + (c + (b + (a + 0::FLOAT)))) AS total FROM wide)",
    ),
}

_REASONS = "list_filter([CASE WHEN fn <= 2 THEN 'LOW_FORWARD_COUNT' END, CASE WHEN rn <= 2 THEN 'LOW_REVERSE_COUNT' END, CASE WHEN fd <= 4 THEN 'LOW_FORWARD_DEPTH' END, CASE WHEN rd <= 4 THEN 'LOW_REVERSE_DEPTH' END, CASE WHEN ff <= 0.2 THEN 'LOW_FORWARD_FRACTION' END, CASE WHEN rf <= 0.2 THEN 'LOW_REVERSE_FRACTION' END, CASE WHEN pair_score <= 0.5 THEN 'LOW_DIGENOME_PAIR_SCORE' END], lambda x: x IS NOT NULL)"
#: One-to-one pairs by trying all subsets of each component, which are small here.
_CHOSEN = (
    f"reasoned AS (SELECT *, {_REASONS} AS reasons FROM pairs)",
    """spans AS (SELECT *, least(forward_position, reverse_position) AS lo, greatest(forward_position, reverse_position) AS hi FROM reasoned),
      islands AS (SELECT *, max(hi) OVER (PARTITION BY contig ORDER BY lo, hi, forward_position, reverse_position ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM spans),
      parts AS (SELECT *, sum(CASE WHEN before IS NULL OR lo > before THEN 1 ELSE 0 END) OVER (PARTITION BY contig ORDER BY lo, hi, forward_position, reverse_position ROWS UNBOUNDED PRECEDING) AS component FROM islands),
      numbered AS (SELECT *, row_number() OVER (PARTITION BY contig, component ORDER BY forward_position, reverse_position) - 1 AS i, count(*) OVER (PARTITION BY contig, component) AS k FROM parts),
      masks AS (SELECT contig, component, k, unnest(range(1, 1 << CAST(k AS INT))) AS mask FROM (SELECT DISTINCT contig, component, k FROM numbered)),
      tries AS (SELECT m.contig, m.component, m.mask, count(*) AS n, count(*) FILTER (WHERE len(x.reasons) = 0) AS passing, sum(x.pair_score) AS score, sum(x.i) AS ranks, sum(1 << CAST(m.k - 1 - x.i AS INT)) AS early, count(DISTINCT x.forward_position) AS nf, count(DISTINCT x.reverse_position) AS nr
        FROM masks m JOIN numbered x ON x.contig = m.contig AND x.component = m.component AND (m.mask >> CAST(x.i AS INT)) & 1 = 1 GROUP BY ALL),
      taken AS (SELECT contig, component, mask FROM tries WHERE n = nf AND n = nr QUALIFY row_number() OVER (PARTITION BY contig, component ORDER BY passing DESC, n DESC, round(score, 9) DESC, ranks, early DESC) = 1),
      chosen AS (SELECT x.* FROM numbered x JOIN taken t ON t.contig = x.contig AND t.component = x.component AND (t.mask >> CAST(x.i AS INT)) & 1 = 1)""",
)


def _rgen(forward: str, reads: str, tag: str, masked: bool) -> str:
    """summed_{tag}(contig, forward_position, total): the five-position score at forward(contig, p)."""
    hidden = "AND NOT EXISTS (SELECT 1 FROM merged m WHERE m.contig = a.contig AND a.at >= m.s AND a.at < m.e)" if masked else ""
    return f"""ok_{tag} AS (SELECT contig, flag, reference_start, reference_end, strand, pos5 FROM {reads} WHERE (flag & 1796) = 0 AND mapping_quality >= 1),
      places_{tag} AS (SELECT DISTINCT contig, p + k AS at FROM {forward}, range(-3, 3) t(k)),
      one_{tag} AS (SELECT a.contig, a.at, count(*) FILTER (WHERE r.strand = '+' AND r.pos5 = a.at) AS f, count(*) FILTER (WHERE r.strand = '-' AND r.pos5 = a.at) AS r, count(*) AS d FROM places_{tag} a JOIN contigs c ON c.contig = a.contig AND a.at >= 0 AND a.at < c.length {hidden} JOIN ok_{tag} r ON r.contig = a.contig AND r.reference_start <= a.at AND r.reference_end > a.at GROUP BY ALL),
      steps_{tag} AS (SELECT w.contig, w.p, k, coalesce(a.f, 0) AS c1, coalesce(a.d, 0) AS d1, coalesce(b.r, 0) AS c2, coalesce(b.d, 0) AS d2, coalesce(e.r, 0) AS c3, coalesce(e.d, 0) AS d3, coalesce(g.f, 0) AS c4, coalesce(g.d, 0) AS d4 FROM (SELECT contig, p, k FROM {forward}, range(-2, 3) t(k)) w LEFT JOIN one_{tag} a ON a.contig = w.contig AND a.at = w.p LEFT JOIN one_{tag} b ON b.contig = w.contig AND b.at = w.p - 1 + k LEFT JOIN one_{tag} e ON e.contig = w.contig AND e.at = w.p - 1 LEFT JOIN one_{tag} g ON g.contig = w.contig AND g.at = w.p + k),
      added_{tag} AS (SELECT contig, p, k, CASE WHEN d3 > 0 AND d4 > 0 THEN ((c3::FLOAT - 1::FLOAT) / d3::FLOAT) * (c4::FLOAT - 1::FLOAT) / d4::FLOAT * ((c3 + c4)::FLOAT - 2::FLOAT) ELSE 0::FLOAT END + CASE WHEN d1 > 0 AND d2 > 0 THEN ((c1::FLOAT - 1::FLOAT) / d1::FLOAT) * (c2::FLOAT - 1::FLOAT) / d2::FLOAT * ((c1 + c2)::FLOAT - 2::FLOAT) ELSE 0::FLOAT END AS v FROM steps_{tag}),
      wide_{tag} AS (SELECT contig, p, max(v) FILTER (WHERE k = -2) AS a, max(v) FILTER (WHERE k = -1) AS b, max(v) FILTER (WHERE k = 0) AS c, max(v) FILTER (WHERE k = 1) AS d, max(v) FILTER (WHERE k = 2) AS e FROM added_{tag} GROUP BY ALL),
      summed_{tag} AS (SELECT contig, p AS forward_position, CAST(e + (d + (c + (b + (a + 0::FLOAT)))) AS DOUBLE) AS total FROM wide_{tag})"""


_mean = lambda c, n: f"CASE WHEN f.{n} + r.{n} > 0 THEN (f.{c} * f.{n} + r.{c} * r.{n}) / (f.{n} + r.{n})::DOUBLE ELSE 0 END AS {c}"
_ratio = lambda a, b: f"CASE WHEN {b} > 0 THEN ({a}) / ({b})::DOUBLE ELSE 0 END"
_both = lambda c: f"f.{c} + r.{c}"
_FORWARD = "(f.indel_fraction > r.indel_fraction OR (f.indel_fraction = r.indel_fraction AND f.indel_read_count >= r.indel_read_count))"
_FINAL_DSB = (
    "ends", "mask", "merged", "open_ends", "contigs", "piles3 AS (SELECT * FROM open_ends WHERE count >= 3)", *_PAIRS[2:], *_CHOSEN,
    "sites AS (SELECT contig, forward_position AS pos, '+' AS strand FROM chosen UNION SELECT contig, reverse_position, '-' FROM chosen)", "indels", "metrics", "fwd AS (SELECT DISTINCT contig, forward_position AS p FROM chosen)",
    _rgen("fwd", "reads", "t", True), _rgen("fwd", "control", "c", True), _depth("sites", "control", "cdepth"),
    f"""joined AS (SELECT c.contig, c.forward_position, c.reverse_position, c.fn, c.fd, c.ff, c.rn, c.rd, c.rf, c.pair_score, c.reasons AS own,
      {_both('endpoint_count')} AS n, {_both('strand_depth')} AS d, {_ratio(_both('endpoint_count'), _both('strand_depth'))} AS endpoint_fraction, {_mean('support_mean_mapq', 'support_read_count')}, {_mean('local_mean_mapq', 'local_read_count')}, {_mean('support_mean_nm', 'support_nm_count')}, {_mean('local_mean_nm', 'local_nm_count')},
      {_ratio(_both('softclipped_count'), _both('endpoint_count'))} AS softclip_fraction, {_both('secondary_endpoint_count')} AS secondary_endpoint_count, {_both('indel_read_count')} AS indel_read_count, {_ratio(_both('indel_read_count'), _both('local_read_count'))} AS indel_fraction,
      CASE WHEN {_FORWARD} THEN f.ip ELSE r.ip END AS ip, CASE WHEN {_FORWARD} THEN f.kind ELSE r.kind END AS kind, CASE WHEN {_FORWARD} THEN f.len ELSE r.len END AS len, t.total AS rgen, u.total AS control_rgen,
      coalesce(x.n, 0) AS cfn, coalesce(x.d, 0) AS cfd, coalesce(x.f, 0) AS cff, coalesce(y.n, 0) AS crn, coalesce(y.d, 0) AS crd, coalesce(y.f, 0) AS crf, coalesce(x.n, 0) + coalesce(y.n, 0) AS cn, coalesce(x.d, 0) + coalesce(y.d, 0) AS cd
      FROM chosen c JOIN metrics f ON f.contig = c.contig AND f.pos = c.forward_position AND f.strand = '+' JOIN metrics r ON r.contig = c.contig AND r.pos = c.reverse_position AND r.strand = '-'
      JOIN summed_t t ON t.contig = c.contig AND t.forward_position = c.forward_position JOIN summed_c u ON u.contig = c.contig AND u.forward_position = c.forward_position
      LEFT JOIN cdepth x ON x.contig = c.contig AND x.pos = c.forward_position AND x.strand = '+' LEFT JOIN cdepth y ON y.contig = c.contig AND y.pos = c.reverse_position AND y.strand = '-')""",
    f"tested AS (SELECT *, {_ratio('cn', 'cd')} AS cf FROM joined)", _FISHER.strip(), "variants", "labels",
    "hits AS (SELECT c.contig, c.forward_position, c.reverse_position, string_agg(DISTINCT l.label, ';' ORDER BY l.label) AS known FROM (SELECT contig, forward_position, reverse_position, unnest([forward_position, reverse_position]) AS at FROM chosen) c JOIN labels l ON l.contig = c.contig AND c.at >= greatest(l.s - 10, 0) AND c.at < l.e + 10 GROUP BY ALL)",
    """judged AS (SELECT c.*, coalesce(h.known, '') AS known, CASE WHEN cd >= 1 THEN 'MATCHED_CONTROL' ELSE 'INSUFFICIENT_CONTROL_COVERAGE' END AS status,
      list_filter([CASE WHEN softclip_fraction >= 0.2 THEN 'HIGH_5P_SOFTCLIP' END, CASE WHEN indel_fraction >= 0.2 THEN 'NEARBY_INDEL' END, CASE WHEN h.known IS NOT NULL THEN 'KNOWN_INDEL' END, CASE WHEN support_mean_mapq < 10 THEN 'LOW_SUPPORT_MAPQ' END,
        CASE WHEN cd < 1 THEN 'INSUFFICIENT_CONTROL_COVERAGE' END, CASE WHEN cd >= 1 AND cf > 0.05 THEN 'HIGH_CONTROL_FRACTION' END, CASE WHEN cd >= 1 AND fold < 3 THEN 'LOW_CONTROL_FOLD' END, CASE WHEN cd >= 1 AND fq > 0.05 THEN 'CONTROL_Q_FAIL' END], lambda x: x IS NOT NULL) AS artifact
      FROM controlled c LEFT JOIN hits h USING (contig, forward_position, reverse_position))""",
    "final AS (SELECT *, CASE WHEN len(artifact) > 0 THEN 'ARTIFACT_RISK' ELSE 'DSB' END AS classification, list_concat(own, artifact) AS all_reasons FROM judged)",
)
_FINAL_DSB_SELECT = f"""SELECT 'treated' AS sample, 'digenome' AS analysis, 'control' AS control_sample, status AS control_status, contig, forward_position AS position_0based, forward_position + 1 AS position_1based, 'both' AS strand,
 forward_position AS forward_position_0based, forward_position + 1 AS forward_position_1based, reverse_position AS reverse_position_0based, reverse_position + 1 AS reverse_position_1based,
 n AS endpoint_count, d AS strand_depth, {_r('endpoint_fraction', 'endpoint_fraction')}, reverse_position AS opposite_position_0based, reverse_position + 1 AS opposite_position_1based, rn AS opposite_count, rd AS opposite_depth, {_r('rf', 'opposite_fraction')},
 fn AS forward_endpoint_count, fd AS forward_depth, {_r('ff', 'forward_fraction')}, rn AS reverse_endpoint_count, rd AS reverse_depth, {_r('rf', 'reverse_fraction')},
 {_r('pair_score', 'digenome_pair_score')}, CASE WHEN round(rgen, 6) = 0 THEN 0 ELSE round(rgen, 6) END AS rgen_digenome_score, 'DSB' AS signal_classification, classification, CASE WHEN len(all_reasons) = 0 THEN 'PASS' ELSE 'FILTERED' END AS filter_status, array_to_string(all_reasons, ';') AS filter_reasons,
 {_r('support_mean_mapq', 'support_mean_mapq')}, {_r('local_mean_mapq', 'local_mean_mapq')}, {_r('support_mean_nm', 'support_mean_nm')}, {_r('local_mean_nm', 'local_mean_nm')}, {_r('softclip_fraction', 'softclip_fraction')}, secondary_endpoint_count,
 ip AS indel_position_0based, ip + 1 AS indel_position_1based, coalesce(kind, '') AS indel_type, CAST(coalesce(len, 0) AS BIGINT) AS indel_length, indel_read_count, {_r('indel_fraction', 'indel_fraction')}, known AS known_indel_overlap,
 cn AS control_endpoint_count, cd AS control_depth, {_r('cf', 'control_fraction')}, cfn AS control_forward_endpoint_count, cfd AS control_forward_depth, {_r('cff', 'control_forward_fraction')}, crn AS control_reverse_endpoint_count, crd AS control_reverse_depth, {_r('crf', 'control_reverse_fraction')},
 {_r('cff * crf * (cfn + crn) / 4.0', 'control_digenome_pair_score')}, CASE WHEN round(control_rgen, 6) = 0 THEN 0 ELSE round(control_rgen, 6) END AS control_rgen_digenome_score, {_r('CASE WHEN cd >= 1 THEN fold END', 'control_fold_enrichment')}, {_r('fp', 'control_fisher_p')}, {_r('fq', 'control_fisher_q')} FROM final"""
_TILES = "tiles AS (SELECT contig, s, least(s + {0}, length) AS e, length FROM (SELECT contig, length, unnest(range(0, length, {0})) AS s FROM contigs))"
#: The plan of chunks over contigs of one length L; weights are times L, cuts times the number of chunks.
_CHUNKS = lambda n: (
    "ends", "contigs", "mask", "merged",
    f"""mapped AS (SELECT contig, length, count(*) AS m FROM reads JOIN contigs USING (contig) WHERE (flag & 4) = 0 GROUP BY ALL),
      gaps AS (SELECT contig, length, m, coalesce(lag(e) OVER w, 0) AS s, ms AS e FROM (SELECT x.contig, x.length, x.m, g.s AS ms, g.e FROM mapped x JOIN merged g USING (contig) UNION ALL SELECT contig, length, m, length, length FROM mapped) WINDOW w AS (PARTITION BY contig ORDER BY ms, e)),
      open_ AS (SELECT contig, length, m, s, e, coalesce(sum(e - s) OVER (PARTITION BY contig ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM gaps WHERE e > s),
      weights AS (SELECT contig, length, m, sum(m * (e - s)) AS w FROM open_ GROUP BY contig, length, m),
      line AS (SELECT *, coalesce(sum(w) OVER (ORDER BY contig ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS origin, sum(w) OVER () AS total FROM weights),
      cuts AS (SELECT contig, length, m, origin, total * k AS cut FROM line, range(1, {n}) t(k) WHERE total * k > origin * {n} AND total * k < (origin + w) * {n}),
      placed AS (SELECT c.contig, c.length, o.s + (2 * (c.cut - c.origin * {n}) + c.m * {n} - 2 * o.before * c.m * {n}) // (2 * c.m * {n}) AS spot FROM cuts c JOIN open_ o ON o.contig = c.contig AND c.cut - c.origin * {n} > o.before * c.m * {n} AND c.cut - c.origin * {n} <= (o.before + o.e - o.s) * c.m * {n}),
      bounds AS (SELECT contig, length, 0 AS spot FROM line UNION SELECT contig, length, CAST(spot AS BIGINT) FROM placed),
      pieces AS (SELECT contig, length, spot AS a, coalesce(lead(spot) OVER (PARTITION BY contig ORDER BY spot), length) AS b FROM bounds),
      filled AS (SELECT p.contig, p.length, p.a, p.b, coalesce(sum(greatest(0, least(o.e, p.b) - greatest(o.s, p.a))), 0) AS own, coalesce(sum(greatest(0, least(o.e, p.a) - o.s)), 0) AS left_ FROM pieces p JOIN open_ o USING (contig) GROUP BY ALL),
      numbered_pieces AS (SELECT f.*, l.m, (SELECT count(*) FROM range(1, {n}) t(k) WHERE 2 * l.total * k <= {n} * (2 * l.origin + l.m * (2 * f.left_ + f.own))) AS part FROM filled f JOIN line l USING (contig)),
      planned AS (SELECT contig, a, b, own, length, m, dense_rank() OVER (ORDER BY part) - 1 AS number FROM numbered_pieces),
      chunk AS (SELECT 'chunk_' || lpad(CAST(number AS VARCHAR), 3, '0') AS chunk_id, contig, a AS owner_start, b AS owner_end, greatest(0, a - 10) AS scan_start, least(length, b + 10) AS scan_end, CAST(own AS BIGINT) AS callable_bases, CAST(b - a - own AS BIGINT) AS excluded_bases,
        CAST((2 * sum(m * (b - a)) OVER (PARTITION BY number) + length) // (2 * length) AS BIGINT) AS mapped_records, CAST((2 * sum(m * own) OVER (PARTITION BY number) + length) // (2 * length) AS BIGINT) AS callable_mapped_records FROM planned)""",
)
_FASTQ = "fastq AS (SELECT o_orderkey AS k, left(CASE o_orderkey % 5 WHEN 0 THEN repeat('A', 60) WHEN 1 THEN repeat('ACGT', 15) ELSE repeat('GATTACAC', 8) END, CAST(24 + 8 * (o_orderkey % 6) AS INT)) AS seq FROM orders)"
_SHEET = """s AS (SELECT s_suppkey AS k, 's' || s_suppkey AS sample, unnest(range(1, s_suppkey % 3 + 2)) AS lane FROM supplier),
 sheet AS (SELECT sample, 'L' || lpad(CAST(lane AS VARCHAR), 3, '0') AS lane, '/lanes/' || sample || '_' || lane || '_1.fq.gz' AS fastq_1, '/lanes/' || sample || '_' || lane || '_2.fq.gz' AS fastq_2, CASE WHEN k > 7 AND k % 7 > 0 THEN 's' || (k % 7) ELSE '' END AS control,
  CASE WHEN k % 5 = 0 THEN '/known/' || sample || '.vcf.gz' ELSE '' END AS variant_vcf, CASE WHEN k % 5 = 0 THEN '/known/' || sample || '.vcf.gz.csi' ELSE '' END AS variant_index, CASE WHEN k IN (SELECT x.k % 7 FROM s x WHERE x.k > 7 AND x.k % 7 > 0) THEN 'true' ELSE 'false' END AS is_control FROM s)"""
_TIER = "CASE WHEN len(reasons) = 0 THEN 'high_confidence' WHEN classification = 'ARTIFACT_RISK' THEN 'artifact' ELSE 'manual_review' END"
_g8 = lambda x: f"coalesce(printf('%.8g', CAST({x} AS DOUBLE)), '')"
ORACLE_SQL |= {
    "pair_matching": _with("SELECT contig, forward_position, reverse_position, round(pair_score, 6) AS pair_score FROM chosen", *_PAIRS, *_CHOSEN),
    "final_calls_dsb": _with(_FINAL_DSB_SELECT, *_FINAL_DSB),
    "sam_reads": _with("SELECT query_name, flag, contig, reference_start, reference_end, mapping_quality, cigar, nm FROM reads"),
    "region_reads": _with("SELECT contig, query_name, reference_start, reference_end FROM reads WHERE contig = 'chr1' AND reference_start < 1000 OR contig = 'chr2' AND reference_start < 3001 AND reference_end > 3000 OR contig = 'chr3' AND reference_end > 5000"),
    "sam_header": CONTIGS_SQL,
    "reads_probe": _with("SELECT count(*) > 0 AS found, count(*) FILTER (WHERE (flag & 1) <> 0) > 0 AS paired FROM reads WHERE ok"),
    "vcf_variants": _with("SELECT contig, pos, ref, alt, pos + 9 AS last FROM variants", "variants"),
    "indel_spans": _with('SELECT contig, s AS start, CASE WHEN (s + 1) % 2 = 0 THEN greatest(e, s + 31) ELSE e END AS "end", label FROM labels', "variants", "labels"),
    "bed_mask": _with('SELECT contig, start_ AS start, end_ AS "end" FROM mask', "mask"),
    "overlap_bases": _with('SELECT t.contig, t.s AS start, t.e AS "end", CAST(sum(CASE WHEN m.s IS NULL THEN 0 ELSE least(t.e, m.e) - greatest(t.s, m.s) END) AS BIGINT) AS masked_bases FROM tiles t LEFT JOIN merged m ON m.contig = t.contig AND m.s < t.e AND m.e > t.s GROUP BY ALL', "contigs", "mask", "merged", _TILES.format(1000)),
    "coverage_faults": _with(
        """SELECT contig, before AS at, CASE WHEN s > before THEN 'gap' ELSE 'overlap' END AS fault FROM walked WHERE s <> before UNION ALL SELECT contig, max(e), 'end' FROM walked GROUP BY contig, length HAVING max(e) <> length""",
        "contigs", _TILES.format(500), "kept AS (SELECT contig, length, s, CASE WHEN s % 4000 = 2000 THEN e + 7 ELSE e END AS e FROM tiles WHERE s % 3500 <> 1000)", "walked AS (SELECT *, coalesce(lag(e) OVER (PARTITION BY contig ORDER BY s, e), 0) AS before FROM kept)"),
    "interval_table": _with("SELECT * FROM piles WHERE (pos // 5000) % 2 = 0", "ends", "piles"),
    "fastq_reads": f"WITH {_FASTQ}, scored AS (SELECT *, CAST(floor((k % 7) * length(seq) / 10.0) AS INT) AS low FROM fastq) SELECT 'r' || k AS name, seq, left(repeat('#', low) || repeat('I', 100), length(seq)) AS qual FROM scored WHERE k % 5 <> 0 AND length(seq) >= 30 AND low <= 0.4 * length(seq)",
    "duplicates": _with(f"""SELECT query_name, reference_start, CASE WHEN (flag & 2308) = 0 AND row_number() OVER (PARTITION BY contig, strand, CASE WHEN strand = '-' THEN pos5 + clip ELSE pos5 - clip END, (flag & 2308) = 0 ORDER BY mapping_quality DESC, read_ord) > 1 THEN flag | 1024 ELSE flag END AS flag FROM (SELECT *, CASE WHEN {_CLIP} THEN 5 ELSE 0 END AS clip FROM reads)"""),
    "samplesheet": f"WITH {_SHEET} SELECT * FROM sheet",
    "lanes": f"WITH {_SHEET} SELECT sample, count(*) AS lanes, string_agg(lane, ';' ORDER BY lane) AS names, 'PE' AS layout FROM sheet GROUP BY sample",
    "control_matching": f"WITH {_SHEET} SELECT control AS control_sample, count(DISTINCT sample) AS treated FROM sheet WHERE is_control = 'false' AND control <> '' GROUP BY ALL",
    "chunk_plan": _with("SELECT * FROM chunk", *_CHUNKS(8)),
    "chunk_table": _with("SELECT chunk_id, count(*) AS interval_count, count(DISTINCT contig) AS contig_count, max(mapped_records) AS estimated_mapped_records, max(callable_mapped_records) AS estimated_callable_mapped_records, CAST(sum(owner_end - owner_start) AS BIGINT) AS owned_bases, CAST(sum(callable_bases) AS BIGINT) AS callable_bases, CAST(sum(excluded_bases) AS BIGINT) AS excluded_bases, string_agg(contig || ':' || owner_start || '-' || owner_end, ',' ORDER BY contig, owner_start) AS intervals FROM chunk GROUP BY chunk_id", *_CHUNKS(8)),
    "chunked_calls": ORACLE_SQL["final_calls_ssb"],
    "pair_duplicates": f"""WITH p AS ({PAIRS_SQL}),
  e AS (SELECT *, CASE WHEN (flag & 16) <> 0 THEN reference_end - 1 + tail ELSE reference_start - head END AS five, (flag & 16) <> 0 AS back FROM p),
  m AS (SELECT a.*, b.five AS mate_five, b.contig AS mate_contig, b.back AS mate_back, b.mapping_quality AS mate_quality, b.read_ord AS mate_ord
        FROM e a LEFT JOIN e b ON a.query_name = b.query_name AND a.read_ord <> b.read_ord AND (a.flag & 1) <> 0),
  r AS (SELECT *, row_number() OVER (PARTITION BY contig, back, five, mate_contig, mate_five, mate_back ORDER BY mapping_quality + coalesce(mate_quality, 0) DESC, least(read_ord, coalesce(mate_ord, read_ord))) AS k,
               count(*) FILTER (WHERE mate_five IS NOT NULL) OVER (PARTITION BY contig, back, five) AS paired FROM m)
  SELECT query_name, read_ord, CAST(CASE WHEN k > 1 OR (mate_five IS NULL AND paired > 0) THEN flag | 1024 ELSE flag END | CASE WHEN coalesce(mate_back, false) THEN 32 ELSE 0 END AS INT) AS flag,
         coalesce(mate_contig, '') AS mate_contig, mate_five AS mate_end FROM r""",
    "ordered_pileups": ORACLE_SQL["endpoint_pileups"],
    "chunk_by_itself": _with(_FINAL_DSB_SELECT, *_FINAL_DSB),
    "chunk_totals": _with("SELECT CAST((SELECT count(*) FROM final) AS BIGINT) AS rows, CAST((SELECT count(*) FROM piles) AS BIGINT) AS candidates", *_FINAL),
    "formatted_calls": _with(f"SELECT contig, CAST(pos AS VARCHAR) AS position_0based, strand, {_g8('endpoint_fraction')} AS endpoint_fraction, {_g8('support_mean_mapq')} AS support_mean_mapq, {_g8('local_mean_mapq')} AS local_mean_mapq, {_g8('support_mean_nm')} AS support_mean_nm, {_g8('score')} AS digenome_pair_score, '' AS rgen_digenome_score, coalesce(CAST(op + 1 AS VARCHAR), '') AS opposite_position_1based, array_to_string(reasons, ';') AS filter_reasons FROM final", *_FINAL),
    "written_calls": _with(f"SELECT t AS tier, contig, pos AS position_0based, strand, classification, array_to_string(reasons, ';') AS filter_reasons FROM (SELECT *, unnest(['all', {_TIER}]) AS t FROM final)", *_FINAL),
    "qc_document": _with(
        f"""SELECT 'candidate_endpoints_or_pairs_before_filters' AS name, (SELECT count(*) FROM piles) AS n UNION ALL SELECT 'reported_candidates', count(*) FROM final UNION ALL SELECT 'high_confidence_calls', count(*) FILTER (WHERE {_TIER} = 'high_confidence') FROM final UNION ALL SELECT 'manual_review_candidates', count(*) FILTER (WHERE {_TIER} = 'manual_review') FROM final
        UNION ALL SELECT 'artifact_candidates', count(*) FILTER (WHERE {_TIER} = 'artifact') FROM final UNION ALL SELECT 'high_confidence_ssb', count(*) FILTER (WHERE {_TIER} = 'high_confidence') FROM final UNION ALL SELECT 'high_confidence_dsb', 0
        UNION ALL SELECT 'classifications_' || classification, count(*) FROM final GROUP BY classification UNION ALL SELECT 'signal_classifications_' || signal, count(*) FROM final GROUP BY signal""",
        *_FINAL),
    "streamed_pileups": ORACLE_SQL["endpoint_pileups"],
}

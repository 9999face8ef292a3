"""The training-data queries by name, and SQL for those that SQL can express."""

from __future__ import annotations

from . import hash_sql, infill, langid, lines, media, neighbours, packing, records, secrets, sentences, simhash, suffixes, toxicity

QUERIES = {
    "op1_best_fit_packing": packing.op1_best_fit_packing,
    "op2_line_dedup": lines.op2_line_dedup,
    "op3_media_columns": media.op3_media_columns,
    "op4_sentencepiece": sentences.op4_sentencepiece,
    "op5_toxicity": toxicity.op5_toxicity,
    "op6_language_id": langid.op6_language_id,
    "op7_nearest_neighbours": neighbours.op7_nearest_neighbours,
    "op8_simhash": simhash.op8_simhash,
    "op9_suffix_dedup": suffixes.op9_suffix_dedup,
    "op10_token_records": records.op10_token_records,
    "op11_fill_in_middle": infill.op11_fill_in_middle,
    "op12_secret_scan": secrets.op12_secret_scan,
}
ORACLE_SQL: dict[str, str] = {
    "op2_line_dedup": lines.SQL,
    "op7_nearest_neighbours": neighbours.SQL,
    "op8_simhash": hash_sql.simhash_sql(),
    "op9_suffix_dedup": suffixes.SQL,
    "op11_fill_in_middle": infill.SQL,
}

"""The queries of this package and the SQL that some of them equal."""

from __future__ import annotations

from quire.llm import audit, bpe, decontaminate, html, language, periodic, pieces, quality, shard, simhash, suffix, toxicity, warc

QUERIES = {
    "op1_shard": shard.op1_shard,
    "op2_language": language.op2_language,
    "op3_bpe": bpe.op3_bpe,
    "op4_decontaminate": decontaminate.op4_decontaminate,
    "op5_toxicity": toxicity.op5_toxicity,
    "op6_simhash": simhash.op6_simhash,
    "op7_html": html.op7_html,
    "op8_suffix": suffix.op8_suffix,
    "op9_quality_rules": quality.op9_quality_rules,
    "op10_warc": warc.op10_warc,
    "op11_pieces": pieces.op11_pieces,
    "op12_filter_audit": audit.op12_filter_audit,
    "op13_periodic_runs": periodic.op13_periodic_runs,
}

ORACLE_SQL: dict[str, str] = {
    "op1_shard": shard.ORACLE_SQL,
    "op4_decontaminate": decontaminate.ORACLE_SQL,
    "op8_suffix": suffix.ORACLE_SQL,
    "op9_quality_rules": quality.ORACLE_SQL,
    "op10_warc": warc.ORACLE_SQL,
    "op12_filter_audit": audit.ORACLE_SQL,
}

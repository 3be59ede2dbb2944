"""Queries of this subpackage, with SQL where SQL can express them."""

from __future__ import annotations

from ledgerline.llm import audit, bpe, fim, html, langid, minhash, packing, simhash, suffixes, tokencount, topk, toxicity, warc


def queries() -> dict:
    return {
        "op1_topk": topk.op1_topk,
        "op2_simhash": simhash.op2_simhash,
        "op3_html": html.op3_html,
        "op4_toxicity": toxicity.op4_toxicity,
        "op5_langid": langid.op5_langid,
        "op6_packing": packing.op6_packing,
        "op7_warc": warc.op7_warc,
        "op8_bpe": bpe.op8_bpe,
        "op9_fingerprints": minhash.op9_fingerprints,
        "op10_suffix_dedup": suffixes.op10_suffix_dedup,
        "op11_fim": fim.op11_fim,
        "op12_token_counts": tokencount.op12_token_counts,
        "op13_filter_audit": audit.op13_filter_audit,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op1_topk": topk.OP1_SQL,
        "op11_fim": fim.OP11_SQL,
        "op13_filter_audit": audit.OP13_SQL,
    }

"""Registered queries of the subpackage, and DuckDB SQL for those that SQL can express."""

from __future__ import annotations

from loomseq.llm import ann, langid, lattice, minhash, packing, pieces, runs, secrets, suffix_dedup, token_counts, toxicity, warc, whitening

QUERIES = {
    "op1_lattice": lattice.op1_lattice,
    "op2_ann": ann.op2_ann,
    "op3_warc": warc.op3_warc,
    "op4_langid": langid.op4_langid,
    "op5_minhash": minhash.op5_minhash,
    "op6_toxicity": toxicity.op6_toxicity,
    "op7_pieces": pieces.op7_pieces,
    "op8_packing": packing.op8_packing,
    "op9_suffix_dedup": suffix_dedup.op9_suffix_dedup,
    "op10_secrets": secrets.op10_secrets,
    "op11_runs": runs.op11_runs,
    "op12_token_counts": token_counts.op12_token_counts,
    "op13_whitening": whitening.op13_whitening,
}

ORACLE_SQL = {
    "op1_lattice": lattice.SQL,
    "op3_warc": warc.SQL,
    "op5_minhash": minhash.SQL,
    "op10_secrets": secrets.SQL,
}

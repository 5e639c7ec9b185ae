"""Registry of this subpackage's queries and their DuckDB SQL."""

from . import blob_ledger, bloom_search, decontam, extendible, html_wrappers, lattice, mixing, superminhash, token_planes, toxicity, turn_repair, url_templates, warc

QUERIES = {
    "op1_bitplane_tokens": token_planes.op1,
    "op2_wrapper_text": html_wrappers.op2,
    "op3_source_mix": mixing.op3,
    "op4_warc_normalise": warc.op4,
    "op5_lattice_neardup": lattice.op5,
    "op6_containment_search": decontam.op6,
    "op7_toxicity": toxicity.op7,
    "op8_blob_ledger": blob_ledger.op8,
    "op9_path_templates": url_templates.op9,
    "op10_superminhash": superminhash.op10,
    "op11_bloom_search": bloom_search.op11,
    "op12_turn_repair": turn_repair.op12,
    "op13_exact_index": extendible.op13,
}

ORACLE = {
    "op3_source_mix": mixing.OP3_SQL,
    "op4_warc_normalise": warc.OP4_SQL,
    "op6_containment_search": decontam.OP6_SQL,
    "op8_blob_ledger": blob_ledger.OP8_SQL,
    "op9_path_templates": url_templates.OP9_SQL,
    "op11_bloom_search": bloom_search.OP11_SQL,
    "op12_turn_repair": turn_repair.OP12_SQL,
    "op13_exact_index": extendible.OP13_SQL,
}

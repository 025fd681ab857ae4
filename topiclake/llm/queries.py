"""The registered queries of this package and their DuckDB twins, where SQL can say them."""

from __future__ import annotations

from . import (
    alignment,
    decontaminate,
    html_text,
    licenses,
    line_frequency,
    mtree,
    near_join,
    packing,
    periodic_runs,
    quality,
    token_files,
    toxicity,
    warc,
)

QUERIES = {
    "op1_line_frequency": line_frequency.op1_line_frequency,
    "op2_toxicity": toxicity.op2_toxicity,
    "op3_quality": quality.op3_quality,
    "op4_warc_bundles": warc.op4_warc_bundles,
    "op5_jaccard_join": near_join.op5_jaccard_join,
    "op6_license_scan": licenses.op6_license_scan,
    "op7_token_files": token_files.op7_token_files,
    "op8_best_fit_packing": packing.op8_best_fit_packing,
    "op9_html_text": html_text.op9_html_text,
    "op10_decontamination": decontaminate.op10_decontamination,
    "op11_top_k": mtree.op11_top_k,
    "op12_periodic_runs": periodic_runs.op12_periodic_runs,
    "op13_token_alignment": alignment.op13_token_alignment,
}

ORACLES = {
    "op1_line_frequency": line_frequency.OP1_SQL,
    "op4_warc_bundles": warc.OP4_SQL,
    "op10_decontamination": decontaminate.OP10_SQL,
    "op11_top_k": mtree.OP11_SQL,
}

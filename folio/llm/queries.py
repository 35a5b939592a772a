"""The training-data queries: one per operator, and the pipeline."""

from __future__ import annotations

import corpus_pipeline
from folio.llm.alignment import op13_token_alignment
from folio.llm.decontamination import op5_decontamination
from folio.llm.fingerprints import op4_fingerprints
from folio.llm.licenses import op6_license_scan
from folio.llm.line_dedup import op1_line_dedup
from folio.llm.lm_scoring import op3_lm_scoring
from folio.llm.manifest import op12_merkle_manifest
from folio.llm.minhash import op9_minhash
from folio.llm.mixing import op2_mixing
from folio.llm.oracles import ORACLES  # noqa: F401  (read by __spark_entry__)
from folio.llm.simhash import op11_simhash
from folio.llm.substring_dedup import op10_substring_dedup
from folio.llm.toxicity import op8_toxicity
from folio.llm.url_filter import op7_url_filter

QUERIES = {
    "op1_line_dedup": op1_line_dedup,
    "op2_mixing": op2_mixing,
    "op3_lm_scoring": op3_lm_scoring,
    "op4_fingerprints": op4_fingerprints,
    "op5_decontamination": op5_decontamination,
    "op6_license_scan": op6_license_scan,
    "op7_url_filter": op7_url_filter,
    "op8_toxicity": op8_toxicity,
    "op9_minhash": op9_minhash,
    "op10_substring_dedup": op10_substring_dedup,
    "op11_simhash": op11_simhash,
    "op12_merkle_manifest": op12_merkle_manifest,
    "op13_token_alignment": op13_token_alignment,
    "pipeline": corpus_pipeline.run,
}

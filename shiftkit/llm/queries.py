"""The queries of this subpackage and the SQL of those that SQL can express."""

from __future__ import annotations

from shiftkit.llm.embedding_neardup import op1_embedding_neardup
from shiftkit.llm.fill_in_middle import ORACLE as FIM_ORACLE
from shiftkit.llm.fill_in_middle import op11_fill_in_middle
from shiftkit.llm.fingerprints import op2_fingerprints
from shiftkit.llm.jaccard_join import op9_ngram_jaccard_join
from shiftkit.llm.mixing import op8_mixing_sources
from shiftkit.llm.ngram_lm import op5_ngram_lm
from shiftkit.llm.packing import op7_packing
from shiftkit.llm.pii import op3_pii
from shiftkit.llm.quality import op4_quality_classifier
from shiftkit.llm.suffix_dedup import ORACLE as REPEATS_ORACLE
from shiftkit.llm.suffix_dedup import op13_suffix_dedup
from shiftkit.llm.toxicity import op10_toxicity
from shiftkit.llm.vector_codes import ORACLE as CODES_ORACLE
from shiftkit.llm.vector_codes import op12_vector_codes
from shiftkit.llm.warc import ORACLE as WARC_ORACLE
from shiftkit.llm.warc import op6_warc

QUERIES = {
    "op1_embedding_neardup": op1_embedding_neardup,
    "op2_fingerprints": op2_fingerprints,
    "op3_pii": op3_pii,
    "op4_quality_classifier": op4_quality_classifier,
    "op5_ngram_lm": op5_ngram_lm,
    "op6_warc": op6_warc,
    "op7_packing": op7_packing,
    "op8_mixing_sources": op8_mixing_sources,
    "op9_ngram_jaccard_join": op9_ngram_jaccard_join,
    "op10_toxicity": op10_toxicity,
    "op11_fill_in_middle": op11_fill_in_middle,
    "op12_vector_codes": op12_vector_codes,
    "op13_suffix_dedup": op13_suffix_dedup,
}

ORACLES: dict[str, str] = {
    "op6_warc": WARC_ORACLE,
    "op11_fill_in_middle": FIM_ORACLE,
    "op12_vector_codes": CODES_ORACLE,
    "op13_suffix_dedup": REPEATS_ORACLE,
}

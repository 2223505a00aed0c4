"""Queries of this subpackage: each operator over its whole table."""

from __future__ import annotations

from lendlens.llm.conversations import op11_conversation_repair
from lendlens.llm.decontaminate import OP7_SQL, op7_decontamination
from lendlens.llm.fim import OP12_SQL, op12_fill_in_middle
from lendlens.llm.langid import op3_language_id
from lendlens.llm.licenses import op2_license_scan
from lendlens.llm.lm import op4_lm_scores
from lendlens.llm.oddsketch import op13_odd_sketch
from lendlens.llm.packing import op8_packing
from lendlens.llm.pii import op1_pii
from lendlens.llm.quality import op10_quality_rules
from lendlens.llm.simhash import op5_simhash
from lendlens.llm.substring import OP6_SQL, op6_substring_dedup
from lendlens.llm.warc import OP9_SQL, op9_warc


def pipeline(spark, sf_dir):
    import corpus_pipeline
    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {
    "op1_pii": op1_pii,
    "op2_license_scan": op2_license_scan,
    "op3_language_id": op3_language_id,
    "op4_lm_scores": op4_lm_scores,
    "op5_simhash": op5_simhash,
    "op6_substring_dedup": op6_substring_dedup,
    "op7_decontamination": op7_decontamination,
    "op8_packing": op8_packing,
    "op9_warc": op9_warc,
    "op10_quality_rules": op10_quality_rules,
    "op11_conversation_repair": op11_conversation_repair,
    "op12_fill_in_middle": op12_fill_in_middle,
    "op13_odd_sketch": op13_odd_sketch,
    "pipeline": pipeline,
}
ORACLES: dict[str, str] = {"op6_substring_dedup": OP6_SQL, "op7_decontamination": OP7_SQL, "op9_warc": OP9_SQL,
                           "op12_fill_in_middle": OP12_SQL}

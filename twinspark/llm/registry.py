"""The queries of the corpus operators, and their SQL where SQL can express them."""

from __future__ import annotations

from twinspark.llm import chat, decontaminate, jaccard, language, lines, media, mixing, quality, repair, runs, simhash, suffix, warc

QUERIES = {
    "op1_mix_sources": mixing.op1,
    "op2_language_crf": language.op2,
    "op3_simhash_golay": simhash.op3,
    "op4_quality_rff": quality.op4,
    "op5_mpeg_ts": media.op5,
    "op6_suffix_repeats": suffix.op6,
    "op7_line_templates": lines.op7,
    "op8_decontaminate": decontaminate.op8,
    "op9_chat_format": chat.op9,
    "op10_warc": warc.op10,
    "op11_conversation_repair": repair.op11,
    "op12_periodic_runs": runs.op12,
    "op13_ngram_jaccard": jaccard.op13,
}
SQL = {"op1_mix_sources": mixing.OP1_SQL, "op7_line_templates": lines.OP7_SQL, "op9_chat_format": chat.OP9_SQL, "op10_warc": warc.OP10_SQL, "op11_conversation_repair": repair.OP11_SQL, "op13_ngram_jaccard": jaccard.OP13_SQL}

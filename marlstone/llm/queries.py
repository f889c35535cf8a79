"""The queries of this subpackage: name -> (query, SQL or None)."""

from __future__ import annotations

from . import chat, decontam, licenses, lm, media, mixing, neardup, quality, toxicity, warc

QUERIES = {
    "op1_progressive_jpeg": (media.op1_progressive_jpeg, None),
    "op2_viterbi": (chat.op2_viterbi, None),
    "op3_segments": (toxicity.op3_segments, None),
    "op4_salvage": (warc.op4_salvage, warc.OP4_SQL),
    "op5_licenses": (licenses.op5_licenses, None),
    "op6_maxent": (lm.op6_maxent, None),
    "op7_crf": (quality.op7_crf, None),
    "op8_setsketch": (neardup.op8_setsketch, None),
    "op9_waterfill": (mixing.op9_waterfill, mixing.OP9_SQL),
    "op10_spaced_seeds": (decontam.op10_spaced_seeds, None),
}

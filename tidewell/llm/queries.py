"""The named queries of this subpackage and their SQL twins."""

from tidewell.llm import bpe, curves, fingerprints, language, licences, merkle, mixing, neardup, quality, simhash, suffix, toxicity, whitening

QUERIES = {
    "op1_language": language.op1_language,
    "op2_mix": mixing.op2_mix,
    "op3_near_duplicates": neardup.op3_near_duplicates,
    "op4_repeated_passages": suffix.op4_repeated_passages,
    "op5_bpe": bpe.op5_bpe,
    "op6_licences": licences.op6_licences,
    "op7_nearest": curves.op7_nearest,
    "op8_fingerprints": fingerprints.op8_fingerprints,
    "op9_quality": quality.op9_quality,
    "op10_toxicity": toxicity.op10_toxicity,
    "op11_whitening": whitening.op11_whitening,
    "op12_simhash": simhash.op12_simhash,
    "op13_manifest": merkle.op13_manifest,
}
ORACLES = {
    "op2_mix": mixing.OP2_SQL,
    "op6_licences": licences.OP6_SQL,
    "op13_manifest": merkle.OP13_SQL,
}

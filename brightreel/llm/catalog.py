"""The subpackage's registered queries and their SQL twins."""

from brightreel.llm import canonical, dedup, entities, fusion, leakage, lookalike, packing, pii

QUERIES = {
    "p1_found": canonical.p1_found,
    "p1_misses": canonical.p1_misses,
    "p2_found": fusion.p2_found,
    "p2_fused": fusion.p2_fused,
    "p3_found": lookalike.p3_found,
    "p3_normalised": lookalike.p3_normalised,
    "p4_found": entities.p4_found,
    "p4_scored": entities.p4_scored,
    "p6_found": dedup.p6_found,
    "p7_packed": packing.p7_packed,
    "p8_found": leakage.p8_found,
    "p8_near": leakage.p8_near,
    "p9_found": pii.p9_found,
    "p9_redacted": pii.p9_redacted,
}
SQL = {
    "p2_found": fusion.P2_SQL,
    "p6_found": dedup.P6_SQL,
    "p8_found": leakage.P8_SQL,
}

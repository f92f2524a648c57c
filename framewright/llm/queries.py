"""The queries that this subpackage adds, and their SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from framewright.llm import collocations, decontaminate, fingerprints, jaccard, langid, links, media, merkle, mixing, oracles, packing, sharding, substrings, surrogates

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_substrings": substrings.op1_substrings,
    "op2_fingerprints": fingerprints.op2_fingerprints,
    "op3_mixing": mixing.op3_mixing,
    "op4_packing": packing.op4_packing,
    "op5_jaccard": jaccard.op5_jaccard,
    "op6_links": links.op6_links,
    "op7_surrogates": surrogates.op7_surrogates,
    "op8_language": langid.op8_language,
    "op9_sharding": sharding.op9_sharding,
    "op10_media": media.op10_media,
    "op11_collocations": collocations.op11_collocations,
    "op12_decontaminate": decontaminate.op12_decontaminate,
    "op13_merkle": merkle.op13_merkle,
}

#: op1 in SQL took 100 s on 1000 documents, so it has none; the others without SQL are random, learned, hashed or use tokenizers.
ORACLE: dict[str, str] = {
    "op5_jaccard": oracles.JACCARD,
    "op6_links": oracles.link_sql(),
    "op11_collocations": oracles.COLLOCATIONS,
    "op12_decontaminate": oracles.DECONTAMINATE,
    "op13_merkle": oracles.merkle_sql(),
}

"""The registered queries of this package; importing the operators fills the registry."""

from hitlens.llm import (  # noqa: F401
    chunk_codec,
    edit_counts,
    grid_codes,
    license_rules,
    merkle_manifest,
    page_wrappers,
    quality_ledger,
    scaled_sketches,
    sequence_files,
    simhash_variants,
    suffix_decontamination,
    toxicity_models,
    url_automaton,
)
from hitlens.llm.common import ORACLES, QUERIES  # noqa: F401

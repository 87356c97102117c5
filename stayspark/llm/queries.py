"""The queries of this subpackage and the SQL that some of them equal."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from stayspark.llm.audit import SQL as OP13_SQL
from stayspark.llm.audit import op13_filter_interactions
from stayspark.llm.chat import op2_prefix_target
from stayspark.llm.decontamination import SQL as OP1_SQL
from stayspark.llm.decontamination import op1_template_decontamination
from stayspark.llm.errata import op11_errata_tries
from stayspark.llm.jaccard import op8_universe_partition
from stayspark.llm.licenses import op5_patience_licenses
from stayspark.llm.media import op7_tiff_pages
from stayspark.llm.packing import op3_best_fit_packing
from stayspark.llm.quality import op10_subword_quality
from stayspark.llm.scoring import op9_pseudo_likelihood
from stayspark.llm.sharding import op4_sampled_splitters
from stayspark.llm.suffixes import op12_suffix_dedup
from stayspark.llm.toxicity import op6_string_kernel_toxicity


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_template_decontamination, op2_prefix_target, op3_best_fit_packing, op4_sampled_splitters, op5_patience_licenses, op6_string_kernel_toxicity, op7_tiff_pages, op8_universe_partition, op9_pseudo_likelihood, op10_subword_quality, op11_errata_tries, op12_suffix_dedup, op13_filter_interactions)}


def oracle_sql() -> dict[str, str]:
    return {"op1_template_decontamination": OP1_SQL, "op13_filter_interactions": OP13_SQL}

"""The document operators applied to the given tables, and their SQL where SQL can say it."""

from __future__ import annotations

import functools
import os
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from tagloom.llm import collocations
from tagloom.llm.collocations import op11_collocations
from tagloom.llm.common import bounded_batches
from tagloom.llm.ctph import op1_fingerprints
from tagloom.llm.exact_dedup import op8_exact_dedup
from tagloom.llm.html_text import op13_html
from tagloom.llm.language import op9_language
from tagloom.llm.mixing import op6_mixing
from tagloom.llm.packing import op4_packing
from tagloom.llm.pii import op10_pii
from tagloom.llm.quality import op2_quality
from tagloom.llm.simhash import op7_simhash
from tagloom.llm.spelling import op12_spelling
from tagloom.llm.token_files import op3_token_files
from tagloom.llm.toxicity import op5_toxicity

ROOT = str(Path(__file__).resolve().parents[2])


def with_package(query: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """Lets Python workers find this package where the driver found it, also if it is not installed, and bounds their batches."""

    @functools.wraps(query)
    def run(spark: SparkSession, *rest) -> DataFrame:
        bounded_batches(spark)
        known = spark.sparkContext.environment
        paths = [p for p in known.get("PYTHONPATH", os.environ.get("PYTHONPATH", "")).split(os.pathsep) if p]
        if ROOT not in paths:
            known["PYTHONPATH"] = os.pathsep.join([*paths, ROOT])
        return query(spark, *rest)

    return run


QUERIES = {
    name: with_package(query)
    for name, query in {
        "op1_fingerprints": op1_fingerprints,
        "op2_quality": op2_quality,
        "op3_token_files": op3_token_files,
        "op4_packing": op4_packing,
        "op5_toxicity": op5_toxicity,
        "op6_mixing": op6_mixing,
        "op7_simhash": op7_simhash,
        "op8_exact_dedup": op8_exact_dedup,
        "op9_language": op9_language,
        "op10_pii": op10_pii,
        "op11_collocations": op11_collocations,
        "op12_spelling": op12_spelling,
        "op13_html": op13_html,
    }.items()
}

SQL = {
    "op11_collocations": collocations.SQL,
    "op8_exact_dedup": """
        SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
               doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
        FROM documents
        WINDOW same AS (PARTITION BY coalesce(text, ''))
    """,
}

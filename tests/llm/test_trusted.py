"""The target of the quality rules covers every trusted document."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from velostat.llm import quality_rules


def test_target_counts_all_trusted_documents(spark):
    n = 12_000
    docs = spark.range(n + 500).select(
        F.col("id").alias("doc_id"), F.when(F.col("id") < n, F.concat(F.lit("t"), F.col("id") % 7)).otherwise("other").alias("text")
    )
    buckets = 1 << 16
    got = {r.doc_id: r.score for r in quality_rules.score_quality(docs, docs.where(F.col("doc_id") < n), buckets=buckets).collect()}
    # a word and its pair with nothing: two n-grams a document, trusted ones as often in the target as in the raw corpus
    n_raw, n_target = 2 * (n + 500) + buckets, 2 * n + buckets
    assert got[0] == pytest.approx(np.log(n_raw / n_target), abs=1e-5)
    assert got[n] == pytest.approx(np.log(1 / n_target / (501 / n_raw)), abs=1e-5)

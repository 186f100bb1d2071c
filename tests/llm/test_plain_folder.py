"""Operators that store tables, and the whole pipeline, in a local session that names no shared folder."""

from test_plain_session import CODE, run_plain

MORE = """
import corpus_pipeline
from brightledger.llm import queries
for name in ("op9_exact_dedup", "op13_resampling"):
    assert queries.queries()[name](spark, "/root/testdata/sf0.001").count() == 200
assert corpus_pipeline.run(spark, "/root/testdata/sf0.001").count() > 0
"""


def test_training_operators(tmp_path):
    run_plain(CODE.replace("spark.stop()", MORE + "spark.stop()"), tmp_path)

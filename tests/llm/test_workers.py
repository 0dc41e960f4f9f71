"""Workers that have no copy of the package: only the driver knows its folder."""

import os
import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parents[2]
SCRIPT = """
import sys
sys.path.insert(0, {root!r})
from orderloom.session import local_session
from orderloom.llm import cross_tokens, hard_negatives, language_mix, ngram_join, pii_crf, piece_scan
from pyspark.sql import functions as F

spark = local_session("bare-workers", 2, shuffle_partitions=2)
assert spark.range(1).rdd.map(lambda _: __import__("importlib.util").util.find_spec("orderloom")).first() is None
rows = [(i, f"Write to a{{i}}@b.org, call +49 30 1234567 now or later today {{'x' * i}}", "en", "s", 9) for i in range(8)]
docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
assert pii_crf.find(docs).where("n_email = 1").count() == 8
assert piece_scan.encode(docs, chunk=32).where("n_tokens > 0").count() == 8
assert ngram_join.jaccard_components(docs).count() == 8
assert language_mix.identify(docs).count() == 8
assert cross_tokens.cross_tokens(docs).where("n_links > 0").count() == 8
vectors = docs.select("doc_id", F.array(F.lit(1.0), F.col("doc_id") / 9).alias("v"), (F.col("doc_id") % 2).alias("l"))
mined = hard_negatives.mine(vectors, "doc_id", "v", "l", F.col("doc_id") == 0)
assert mined.columns[0] == "anchor_id" and mined.count() >= 0
print("ALL DONE")
"""


def test_operators_run_where_workers_lack_the_package(tmp_path):
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    script = tmp_path / "run.py"
    script.write_text(SCRIPT.format(root=str(ROOT)))
    done = subprocess.run(
        [sys.executable, str(script)], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300
    )
    assert "ALL DONE" in done.stdout, done.stderr[-3000:]

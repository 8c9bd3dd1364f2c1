"""Stages against what they decide on, and the whole on a small table."""

import subprocess
import sys
from pathlib import Path

import corpus_pipeline as cp
from tests.conftest import SF
from tests.llm.test_chosen_path import brute
from tests.llm.test_digest_index import digest

ROOT = Path(__file__).resolve().parents[2]
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_stages_and_run(spark, folder):
    stages = dict(cp.STAGES)
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    kept = {}
    for name, stage in list(stages.items())[:4]:
        out = folder("stage")
        stage(spark, docs, SF).write.parquet(out)
        before, docs = docs, spark.read.parquet(out)
        assert docs.columns == COLUMNS
        kept[name] = (before.select("doc_id", "text").collect(), docs.select("doc_id", "text").collect())
    before, after = kept["language ID"]
    assert {r.doc_id for r in after} == {r.doc_id for r in before if any(c.isalpha() for c in r.text or "")}
    before, after = kept["exact dedup"]
    groups = {}
    for r in before:
        groups.setdefault(digest(r.text), []).append((-len(r.text), r.doc_id))
    assert {r.doc_id for r in after} == {min(g)[1] for g in groups.values()}
    before, after = kept["n-gram Jaccard join"]
    assert {r.doc_id for r in after} == {c for _, c, *_ in brute([(r.doc_id, r.text) for r in before])}
    before, after = kept["mixing sources to target weights"]
    assert {r.doc_id for r in after} <= {r.doc_id for r in before} and len(after) > 0.6 * len(before)
    labels = {r.doc_id: r for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    there = {r.doc_id for r in after}
    clean = [r.doc_id for r in before if r.doc_id in labels and labels[r.doc_id].quality == 1 and labels[r.doc_id].toxic == 0]
    assert sum(d in there for d in clean) >= 0.97 * len(clean)
    encoded = cp.run(spark, SF)
    assert encoded.count() == len(after) and encoded.filter("size(ids) != n_tokens OR n_tokens = 0").count() == 0


def test_the_rest_works_without_the_package(tmp_path):
    for name in ("lakeops", "__spark_entry__.py"):
        subprocess.run(["cp", "-r", str(ROOT / name), str(tmp_path)], check=True)
    copy = tmp_path / "lakeops"
    gone = tmp_path / "gone"
    (copy / "llm").rename(gone)
    code = "import __spark_entry__ as e; q = e.queries(); assert 'pipeline' not in q and not any(k.startswith('op') for k in q); print(len(q), len(e.oracle_sql()))"
    ran = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, timeout=120)
    assert ran.returncode == 0, ran.stderr
    code = "import __spark_entry__ as e; q = e.queries(); assert 'pipeline' in q and sum(k.startswith('op') for k in q) == 13"
    ran = subprocess.run([sys.executable, "-c", code], cwd=ROOT, capture_output=True, text=True, timeout=120)
    assert ran.returncode == 0, ran.stderr

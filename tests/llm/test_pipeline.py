import subprocess
import sys
from collections import Counter
from pathlib import Path

import pytest

REPO = Path(__file__).parents[2]
pipeline = pytest.importorskip("corpus_pipeline")


def test_stages_one_by_one(spark, docs, tmp_path):
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    frame, before = spark.read.parquet(f"{tmp_path}/documents.parquet"), None
    for i, (name, stage) in enumerate(pipeline.STAGES):
        columns = frame.columns
        out = stage(spark, frame, str(tmp_path))
        out.write.parquet(f"{tmp_path}/{i}")
        frame = spark.read.parquet(f"{tmp_path}/{i}")
        if i < len(pipeline.STAGES) - 1:
            assert frame.columns == columns, name
            ids = Counter(r.doc_id for r in frame.collect())
            assert before is None or all(n <= before[d] for d, n in ids.items())
            before = ids
    assert {r.doc_id for r in frame.collect()} == set(before)
    whole = pipeline.run(spark, str(tmp_path)).drop("sequence_id", "offset")
    assert Counter(map(tuple, whole.collect())) == Counter(map(tuple, frame.drop("sequence_id", "offset").collect()))


def test_stages_are_in_order():
    assert [n for n, _ in pipeline.STAGES] == ["quality_rules", "line_dedup", "simhash_near_dedup", "secret_scans", "best_fit_packing"]
    assert pipeline.ORACLE_SQL is None


def test_empty(spark, empty, tmp_path):
    empty.write.parquet(f"{tmp_path}/documents.parquet")
    assert pipeline.run(spark, str(tmp_path)).count() == 0


def test_clean_documents_stay(spark, tmp_path):
    """Distinct prose passes every stage whole."""
    import random

    from tests.llm.conftest import SCHEMA, prose

    rnd = random.Random(9)
    texts = ["\n".join(prose(rnd, 40) + "." for _ in range(4)) for _ in range(30)]
    rows = [(i, t, "en", "s", len(t)) for i, t in enumerate(texts)]
    frame = spark.createDataFrame(rows, SCHEMA)
    for _, stage in pipeline.STAGES[:-1]:
        frame = stage(spark, frame, "")
    assert {(r.doc_id, r.text) for r in frame.collect()} == {(r[0], r[1]) for r in rows}


@pytest.mark.parametrize("also", [(), ("corpus_pipeline.py",)])
def test_entry_without_the_subpackage(tmp_path, also):
    """Without these folders the rest imports, whether the pipeline over them is there or not."""
    import shutil

    shutil.copytree(REPO, tmp_path / "r", ignore=shutil.ignore_patterns(".git", "llm", "__pycache__", *also))
    code = "import __spark_entry__ as e; q = e.queries(); assert q and not any(k.startswith('op') or k == 'pipeline' for k in q); assert set(e.oracle_sql()) <= set(q)"
    subprocess.run([sys.executable, "-B", "-c", code], cwd=tmp_path / "r", check=True, env={"PYTHONPATH": str(tmp_path / "r"), "PATH": "/usr/bin:/bin"})

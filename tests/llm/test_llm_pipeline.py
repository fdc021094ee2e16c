"""The pipeline's stages, and every query that has SQL."""

import glob
import os
import subprocess
import sys

import duckdb
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from check import rows_of
from pagetide.llm import common, expected, registry


@pytest.mark.parametrize("name", sorted(expected.SQL))
def test_query_matches_sql(spark, sf_dir, name):
    db = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        db.execute(f"CREATE VIEW {os.path.basename(path).removesuffix('.parquet')} AS SELECT * FROM read_parquet('{path}')")
    df = registry.QUERIES[name](spark, sf_dir)
    found = db.execute(expected.SQL[name])
    columns = [d[0] for d in found.description]
    assert sorted(columns) == sorted(df.columns)
    assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == rows_of(columns, found.fetchall())


def test_registered():
    assert set(registry.QUERIES) | {"pipeline"} <= set(entry.queries())
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality", "exact_dedup", "near_dedup", "source_mix", "packing"]


def test_stages_on_unusual_documents(spark, sf_dir, odd_docs):
    kept = odd_docs
    sizes = [kept.count()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = common.stored(stage(spark, kept, sf_dir), name)
        assert kept.columns == odd_docs.columns
        sizes.append(kept.count())
        if name == "exact_dedup":
            assert kept.select("text").na.fill("").distinct().count() == kept.count()
        if name == "near_dedup":
            assert kept.where("doc_id BETWEEN 60 AND 109").count() == 1
    assert sizes[0] > sizes[2] > sizes[3]
    packed = corpus_pipeline.STAGES[-1][1](spark, kept, sf_dir)
    assert {r.doc_id for r in packed.collect()} == {r.doc_id for r in kept.where("length(trim(text)) > 0").collect()}


def test_stages_on_no_documents(spark, sf_dir, no_docs):
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, no_docs, sf_dir).count() == 0


def test_run(spark, sf_dir):
    packed = corpus_pipeline.run(spark, sf_dir).collect()
    docs = common.table(spark, sf_dir, "documents")
    labels = common.table(spark, sf_dir, "labels")
    good = {r.doc_id for r in labels.where("quality = 1").collect()}
    bad = {r.doc_id for r in labels.where("quality = 0").collect()}
    left = {r.doc_id for r in packed}
    assert left <= {r.doc_id for r in docs.collect()}
    assert len(left & bad) <= 0.2 * len(bad) and len(left & good) > 0.5 * len(good)


def test_the_rest_works_without_this_subpackage(tmp_path):
    root = os.path.dirname(os.path.abspath(entry.__file__))
    for name in ("pagetide", "__spark_entry__.py"):
        os.symlink(os.path.join(root, name), tmp_path / name) if name.endswith(".py") else None
    package = tmp_path / "pagetide"
    package.mkdir()
    for name in os.listdir(os.path.join(root, "pagetide")):
        if name != "llm":
            os.symlink(os.path.join(root, "pagetide", name), package / name)
    (package / "llm").mkdir()  # an empty folder is no subpackage
    code = "import __spark_entry__ as e; q = e.queries(); assert 'raw_events' in q and not [n for n in q if n.startswith('op')]"
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, env={**os.environ, "PYTHONPATH": str(tmp_path)})
    assert done.returncode == 0, done.stderr

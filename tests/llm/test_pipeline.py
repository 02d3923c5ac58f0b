"""The pipeline's stages against their operators' rules, and the registered queries against SQL."""

import pytest

import __spark_entry__ as entry
import corpus_pipeline
from gridiron.llm import common, near_dup, oracles
from tests.llm.test_operators import DOCS, brute_near, documents
from tests.oracle_check import compare, connect


def test_stages_in_order(spark, tmp_path):
    passage = " ".join(f"bench{i}x" for i in range(12))
    rows = [(i, f"the cat and the hat with number {i} and some other words that are all only for {i} x{i} y{i} z{i}", "en") for i in range(30)]
    rows += [(40, rows[3][1] + "\nan own line of forty", "en"), (50, f"text with {passage} inside", "en"), (60, None, "en"), (61, "123 456", "en")]
    rows += [(62, "щука плыла по реке долго и счастливо", None), (63, "ζωη και θαλασσα μακρια απο εδω", None)]  # in no learned language
    docs = spark.createDataFrame([(i, t, lang, "s", len(t or "")) for i, t, lang in rows], DOCS)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, passage)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    kept = []
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, str(tmp_path))
        assert k == 4 or out.columns == docs.columns, name
        out.write.parquet(f"{tmp_path}/{k}")
        docs = spark.read.parquet(f"{tmp_path}/{k}")
        kept.append({r.doc_id for r in docs.collect()})
    everything = {i for i, _, _ in rows}
    assert kept[0] == everything - {60, 61, 62, 63} and kept[1] == kept[0]
    lines = {r.doc_id: (r.text, r.n_chars) for r in spark.read.parquet(f"{tmp_path}/1").collect()}
    assert lines[40] == ("an own line of forty", 20)
    _, component = brute_near([(i, t) for i, (t, _) in lines.items()], near_dup.Settings().words)
    assert kept[2] == {i for i, c in component.items() if i == c}
    assert kept[3] == kept[2] - {50} == kept[4]
    assert {r.doc_id for r in corpus_pipeline.run(spark, str(tmp_path)).collect()} == kept[4]


def test_a_run_leaves_only_what_its_rows_are_computed_from(spark, tmp_path, monkeypatch):
    rows = [(i, f"the cat and the hat with number {i} and some other words that are all only for {i} x{i} y{i} z{i}", "en", "s", 9) for i in range(30)]
    spark.createDataFrame(rows, DOCS).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, "a b c")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    folder = tmp_path / "shared"
    monkeypatch.setattr(common, "shared_folder", lambda spark: f"file://{folder}")
    packed = corpus_pipeline.run(spark, str(tmp_path))
    left = sorted(x.name.rsplit("-", 1)[0] for x in folder.iterdir())
    assert packed.count() == 30
    assert "decontaminate" in left and not {"language_id", "line_dedup", "near_dedup", "links", "sketches"} & set(left)
    assert not any(name.endswith("-work") for name in left)


def test_line_stage_keeps_columns_of_any_name(spark):
    rows = [(1, "a shared line of text", 77, 5, "x"), (2, "a shared line of text\nown", 78, 6, "y")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_lines int, n_dropped long, doc string")
    out = corpus_pipeline.dedup_lines(spark, docs, "")
    assert out.columns == docs.columns
    assert sorted(tuple(r) for r in out.collect()) == [rows[0], (2, "own", 78, 6, "y")]


def test_empty_table(spark, tmp_path):
    documents(spark).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


@pytest.mark.parametrize("name", sorted(oracles.oracle_sql()))
def test_query_equals_sql(spark, sf_dir, name):
    rows, problems = compare(spark, connect(sf_dir), entry.queries()[name], oracles.oracle_sql()[name], sf_dir)
    assert rows and not problems


def test_every_operator_is_registered():
    names = entry.queries().keys()
    assert "pipeline" in names and all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 14))

"""The pipeline's stages, each against a plain version on what its predecessor kept."""

import pytest

import __spark_entry__
import corpus_pipeline
from sediment.llm import decontaminate, language, queries, simhash
from sediment.session import materialise
from tests.llm import test_line_windows, test_pivotal, test_simhash


@pytest.fixture(scope="module")
def stages(spark, sf_dir):
    """Documents before and after each stage."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    found = [("documents", docs)]
    for name, stage in corpus_pipeline.STAGES:
        docs = materialise(stage(spark, docs, sf_dir), name)
        found.append((name, docs))
    return found


def rows(frame):
    return {r["doc_id"]: r.asDict() for r in frame.collect()}


def test_stages_keep_the_columns(stages):
    columns = stages[0][1].columns
    assert all(frame.columns == columns for _, frame in stages[:-1])
    assert stages[-1][1].columns == [*columns, "copies", "taken"]
    assert [name for name, _ in stages[1:]] == [name for name, _ in corpus_pipeline.STAGES]


def test_language_keeps_texts_with_letters(stages):
    before, after = rows(stages[0][1]), rows(stages[1][1])
    assert all(before[k] == v for k, v in after.items())
    assert len(after) >= 0.99 * len(before)
    model = language.learn(stages[0][1])
    names, scores = model.predict([r["text"].encode() for r in before.values()])
    wanted = {k for k, n, s in zip(before, names, scores, strict=True) if n != "und" and s >= language.LEAST_SCORE}
    assert set(after) == wanted


def test_lines_equal_plain_loop(stages):
    before, after = rows(stages[1][1]), rows(stages[2][1])
    cut = test_line_windows.brute([(r["doc_id"], r["text"]) for r in before.values()])
    assert {k: r["text"] for k, r in after.items()} == {i: t for i, t, gone in cut if not gone or t.strip(test_line_windows.BLANK)}


def test_one_document_of_each_group_stays(stages):
    before, after = rows(stages[2][1]), rows(stages[3][1])
    fps = [(k, simhash.fingerprint(r["text"].encode()) & (1 << 64) - 1) for k, r in before.items()]
    assert set(after) == set(test_simhash.brute_components(fps, simhash.MAX_BITS))
    assert all(before[k] == v for k, v in after.items())


def test_no_benchmark_passage_is_left(stages, spark, sf_dir):
    before, after = rows(stages[3][1]), rows(stages[4][1])
    items = [decontaminate.normal(r["text"].encode())[0].tobytes() for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    whole = {k: decontaminate.normal(r["text"].encode())[0].tobytes() for k, r in before.items()}
    holding = {k for k, text in whole.items() if any(item in text for item in items)}
    assert not holding & set(after)
    for k in set(before) - set(after) - holding:  # parts of items, or items with edits
        assert any(
            item[at : at + 20] in whole[k] for item in items for at in range(0, len(item) - 20, 5)
        ), k
    assert all(before[k] == v for k, v in after.items())


def test_mix_comes_near_its_targets(stages):
    before, after = rows(stages[4][1]), rows(stages[5][1])
    plain = [(k, r["text"], r["source"]) for k, r in before.items()]
    sizes, wanted = test_pivotal.brute_targets(plain)
    taken = dict.fromkeys(sizes, 0)
    for k, r in after.items():
        assert r["text"] == before[k]["text"] and r["taken"] == r["copies"] * test_pivotal.size(r["text"]) and r["copies"] in (1, 2)
        taken[r["source"]] += r["taken"]
    for s in sizes:
        assert abs(taken[s] - wanted[s]) <= max(test_pivotal.size(t) for _, t, x in plain if x == s)


def test_run_applies_all_stages(spark, sf_dir, stages):
    assert sorted(map(str, corpus_pipeline.run(spark, sf_dir).collect())) == sorted(map(str, stages[-1][1].collect()))


def test_odd_documents_pass_through(spark, sf_dir):
    schema = "doc_id long, text string, lang string, source string, n_chars long, _id string, doc string, copies string"
    text = "the cat and the dog are in the house with a bird\n" * 4
    odd = [(None, text), (1, None), (2, ""), (3, " \n "), (4, text), (4, text), (5, text * 2000), (6, "123"), (None, None)]
    frame = spark.createDataFrame([(i, t, "en", None if i == 4 else "s", 0, "x", "y", "z") for i, t in odd], schema)
    for start in (frame, frame.limit(0)):
        docs = start
        for name, stage in corpus_pipeline.STAGES:
            docs = materialise(stage(spark, docs, sf_dir), name)
        assert docs.count() <= start.count()


def test_registered():
    names = __spark_entry__.queries()
    assert [n for n in queries.QUERIES if n.startswith("op")] == sorted(queries.QUERIES, key=lambda n: int(n[2:].split("_")[0]))
    assert len(queries.QUERIES) == 10 and "pipeline" in names and set(queries.ORACLE) <= set(queries.QUERIES)

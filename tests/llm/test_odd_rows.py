"""Nulls, empty and long texts, ties, repeated rows, empty tables, clashing columns: defined results."""

import pytest

import corpus_pipeline
from dockflow.llm import decontaminate, exact_dedup, language_id, license_scan, lm_score, mixing, near_dedup, quality, repeat_spans, secret_scan
from dockflow.llm.queries import EPOCHS, SEED, WEIGHTS, levels


@pytest.fixture(scope="module")
def items(spark):
    return spark.createDataFrame([(1, "One small text about a harbour and its boats at night."), (2, None), (None, "word1 word2 word3"), (3, ""), (3, "harbour")], "item_id long, text string")


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(1, 1), (1, 0), (2, None), (None, 1), (6, 0)], "doc_id long, quality int")


def operators(items, labels):
    return {
        "mixing": lambda d: mixing.mix(d, levels(), WEIGHTS, 1.0, EPOCHS, SEED), "quality": lambda d: quality.scores(d, quality.train(d, labels)),
        "secrets": secret_scan.scan, "lm": lm_score.scores, "lm_joined": lambda d: lm_score.scores(d, most=0), "exact": exact_dedup.exact_groups,
        "near": near_dedup.near_groups, "language": lambda d: language_id.languages(d, language_id.train(d)), "licenses": license_scan.scan,
        "repeats": repeat_spans.remove_repeats, "benchmark": lambda d: decontaminate.contamination(d, items),
    }


@pytest.mark.parametrize("name", sorted(operators(None, None)))
def test_every_row_has_a_result(odd, none, items, labels, name):
    run = operators(items, labels)[name]
    assert run(none).count() == 0
    rows = run(odd).collect()
    if name == "mixing":
        assert all(0 <= r.taken <= r.tokens for r in rows) and {r.epoch for r in rows} <= {0, 1}
    else:
        assert sorted((r.doc_id is None, r.doc_id or 0) for r in rows) == sorted((r.doc_id is None, r.doc_id or 0) for r in odd.collect())


def test_exact_and_near_ties(odd):
    rows = {(r.doc_id, r.text_sha256): r for r in exact_dedup.exact_groups(odd).collect()}
    same = [r for r in rows.values() if r.keep_id == 8]
    assert {(r.doc_id, r.group_size, r.kept) for r in same} == {(1, 3, False), (8, 3, True)}
    assert {r.keep_id for r in rows.values() if r.group_size == 3 and r.keep_id != 8} == {3}  # two nulls and ""
    near = near_dedup.near_groups(odd).collect()
    assert {r.component_id for r in near if r.doc_id == 8} == {1}
    assert {r.component_id for r in near if r.doc_id == 7} == {6}
    assert all(r.component_id == r.doc_id and r.n_shingles == 0 for r in near if r.doc_id in (2, 3, 4))


def test_mixing_budget(odd):
    rows = mixing.mix(odd, levels(), WEIGHTS, 0.5, EPOCHS, SEED).collect()
    total = sum(r[0] for r in odd.select(mixing.n_tokens(odd.text)).collect())
    assert sum(r.taken for r in rows) == int(total * 0.5)


@pytest.mark.parametrize("weight", [0.6, 2.9, float("nan"), float("inf")])
def test_mixing_weights_are_whole(spark, weight):
    with pytest.raises(ValueError, match="whole"):
        mixing.weight_table(spark, {("d0",): weight, ("d1",): 1})
    assert [x.weight for x in mixing.weight_table(spark, {("d0",): 2.0}).collect()] == [2]


def test_unlettered_is_und(odd):
    found = {r.doc_id: r for r in language_id.languages(odd, language_id.train(odd)).collect()}
    assert all(found[k].lang_pred == "und" and found[k].score == 0 for k in (2, 3, 4, 5)) and found[9].lang_pred != "und"


@pytest.mark.parametrize("which", ["odd", "none"])
def test_stages(spark, request, which, tmp_path):
    docs = request.getfixturevalue(which)
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, "/root/testdata/sf0.001")
        before = docs.count()
        out.write.parquet(f"{tmp_path}/{name}")
        if name != "mixing":
            assert out.schema.names == docs.schema.names
            docs = spark.read.schema(docs.schema).parquet(f"{tmp_path}/{name}")
            assert docs.count() <= before
            if which == "odd":
                assert docs.where("doc_id = 6").count() == 1  # clean rows stay

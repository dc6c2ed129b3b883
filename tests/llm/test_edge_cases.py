"""Nulls in any column, empty and very long texts, ties, repeated rows, empty tables and clashing columns."""
import collections

import pytest
from helpers import DOCS, EXTRA, odd_documents

from sparkguard.llm import (op1_substring_dedup, op2_token_binary, op3_ngram_join, op4_token_counts, op5_decontaminate,
                            op6_quality_rules, op7_quality_classifier, op8_url_filters, op9_line_dedup, op10_mixture)

BENCH = "item_id long, text string"


@pytest.fixture(scope="module")
def odd(spark):
    return odd_documents(spark)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="module")
def bench(spark):
    return spark.createDataFrame([(1, "two three four five six seven eight nine ten eleven twelve thirteen"), (2, None),
                                  (None, "negative id"), (3, ""), (3, "")], BENCH)


def ids(rows):
    return collections.Counter(r["doc_id"] for r in rows)


ALL = collections.Counter({0: 1, 1: 1, None: 2, 2: 1, 3: 1, 4: 2, 5: 2, -7: 1})


def test_substring_dedup(odd, none):
    rows = op1_substring_dedup.remove_repeats(odd).collect()
    assert ids(rows) == ALL
    assert [r.text for r in rows if r.doc_id == 1] == [None] and [r.text for r in rows if r.doc_id == 0] == [""]
    assert {r.n_removed for r in rows if r.doc_id == 4} == {0}        # repeated rows are one document
    assert op1_substring_dedup.remove_repeats(none).collect() == []


def test_tokens(odd, none, spark):
    rows = op2_token_binary.token_table(odd, segment_tokens=100).orderBy("doc_no").collect()
    assert ids(rows) == ALL and [r.doc_id for r in rows] == [None, None, -7, 0, 1, 2, 3, 4, 4, 5, 5]
    at = 0
    for r in rows:
        assert r.start == at
        at += r.n_tokens
    assert [r.n_tokens for r in rows if r.doc_id in (0, 1, 2)] == [1, 1, 1]
    assert op2_token_binary.token_table(none).collect() == []


def test_token_counts(odd, none):
    rows = op4_token_counts.corpus_token_counts(odd).collect()
    assert ids(rows) == ALL and {r.n_tokens for r in rows if r.doc_id in (0, 1, 2)} == {0}
    assert op4_token_counts.corpus_token_counts(none).collect() == []


def test_ngram_join(odd, none):
    rows = op3_ngram_join.ngram_join(odd).collect()
    assert ids(rows) == ALL
    by = {(r.doc_id, r.class_id, r.n_links) for r in rows}
    assert {(4, 4, 2), (5, 4, 2), (5, 5, 0), (0, 0, 0), (1, 1, 0), (3, 3, 0)} <= by
    kept = op3_ngram_join.keep_one(odd)
    assert kept.columns == odd.columns
    assert ids(kept.collect()) == ALL - collections.Counter({4: 1, 5: 1})
    assert op3_ngram_join.ngram_join(none).collect() == [] and op3_ngram_join.keep_one(none).collect() == []


def test_decontamination(odd, none, bench, spark):
    rows = op5_decontaminate.contamination_report(odd, bench).collect()
    assert ids(rows) == ALL
    assert {r.n_hit for r in rows if r.doc_id == 4} == {11} and {r.n_words for r in rows if r.doc_id in (0, 1, 2)} == {0}
    assert {r.n_items for r in rows if r.doc_id == -7} == {1}
    kept = op5_decontaminate.drop_contaminated(odd, bench)
    assert kept.columns == odd.columns and ids(kept.collect()) == ALL - collections.Counter({4: 2, 5: 1, -7: 1})
    assert op5_decontaminate.contamination_report(none, bench).collect() == []
    empty = spark.createDataFrame([], BENCH)
    assert not any(r.contaminated for r in op5_decontaminate.contamination_report(odd, empty).collect())


def test_quality_rules(odd, none):
    rows = op6_quality_rules.quality_ledger(odd).collect()
    assert ids(rows) == ALL
    assert {r.kept for r in rows if r.doc_id in (0, 1, 2)} == {False} and {r.kept for r in rows if r.doc_id == 4} == {True}
    kept = op6_quality_rules.apply_rules(odd)
    assert kept.columns == odd.columns and ids(kept.collect())[4] == 2
    assert op6_quality_rules.quality_ledger(none).collect() == []
    assert {r.n_kept for r in op6_quality_rules.ablation(op6_quality_rules.ledger(none)).collect()} == {0}


def test_quality_classifier(odd, none, spark):
    labels = spark.createDataFrame([(4, 1, 0), (4, None, 0), (None, 1, 0), (99, 0, 0), (0, 0, 0), (3, 1, 0), (5, 0, 1)],
                                   "doc_id long, quality int, toxic int")
    rows = op7_quality_classifier.classify(odd, labels).collect()
    assert ids(rows) == ALL and all(0 <= r.score <= 1 for r in rows)
    for labels in (labels.filter("quality = 1"), labels.limit(0)):
        rows = op7_quality_classifier.classify(odd, labels).collect()
        assert ids(rows) == ALL and {(r.score, r.kept) for r in rows} == {(None, True)}
    assert op7_quality_classifier.classify(none, labels).collect() == []


def test_url_filters(spark):
    pages = spark.createDataFrame([(1, None), (None, "http://A.net/x"), (2, ""), (3, "no scheme"), (4, "://"), (4, "://"),
                                   (5, "http://a.net"), (6, "http://" + "a" * 100_000 + ".org/fr/" + "b/" * 50_000)], "page_id long, url string")
    rows = op8_url_filters.judge(pages.selectExpr("*", "1 as host", "2 as tokens", "3 as best")).collect()
    assert collections.Counter(r.page_id for r in rows) == {1: 1, None: 1, 2: 1, 3: 1, 4: 2, 5: 1, 6: 1}
    by = {r.page_id: r for r in rows}
    assert (by[None].host, by[None].path, by[None].rule, by[None].verdict) == ("a.net", "/x", "net/", "block")
    assert {(by[i].host, by[i].path, by[i].rule, by[i].verdict) for i in (1, 2, 3, 4)} == {("", "", None, "allow")}
    assert by[5].rule is None and by[6].rule == "org/fr/"
    assert op8_url_filters.judge(pages.limit(0)).collect() == []


def test_line_dedup(odd, none):
    rows = op9_line_dedup.remove_boilerplate(odd, min_sites=2).collect()
    assert ids(rows) == ALL
    assert [r.text for r in rows if r.doc_id == 4] == ["", ""]        # on src0 and src3
    assert [r.text for r in rows if r.doc_id == 1] == [None]
    assert op9_line_dedup.remove_boilerplate(none).collect() == []


def test_mixture(odd, none):
    rows = op10_mixture.mixture(odd, share=9.0, max_epochs=2).collect()
    full = {r.doc_id for r in rows if r.epoch == 2}
    assert ids(r for r in rows if r.epoch == 1) == ALL and {3, 4, 5, -7} <= full
    mixed = op10_mixture.mix(odd, share=9.0, max_epochs=1)
    assert mixed.columns == odd.columns and ids(mixed.collect()) == ALL
    assert op10_mixture.mixture(none).collect() == []


def test_extra_columns_are_there(odd):
    assert set(EXTRA) <= set(odd.columns)

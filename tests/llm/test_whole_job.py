"""Cases in which an operator once did less than the whole job."""
import random

from helpers import documents, near_classes

from sparkguard.llm import op3_ngram_join, op6_quality_rules, op7_quality_classifier
from sparkguard.llm.queries import QUERIES


def test_links_of_a_group_around_its_base_text(spark):
    rng = random.Random(4)
    base = [f"w{i}" for i in range(300)]
    texts = [" ".join(base)]                                # the least node: distances to it reach 0.19, bins 19 to 37
    for n in range(120):
        w = list(base)
        for at in rng.sample(range(300), n % 7):
            w[at] = f"x{rng.randint(0, 10**6)}"
        texts.append(" ".join(w))
    texts += texts[40:60]
    want = near_classes(dict(enumerate(texts)))
    got = {r.doc_id: (r.class_id, r.n_links) for r in op3_ngram_join.ngram_join(documents(spark, texts), block=16).collect()}
    assert {d: (got[d], want[d]) for d in want if got[d] != want[d]} == {}


def test_every_unlabelled_row_is_in_the_pool(spark, monkeypatch):
    rng = random.Random(6)
    vocabulary = {1: ["river", "house", "letter", "garden"], 0: ["win", "cash", "click", "bonus"]}
    rows = [(i, " ".join(rng.choice(vocabulary[i % 2]) for _ in range(12)), "en", f"src{i % 2}", 0) for i in range(12_400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    labels = spark.createDataFrame([(i, i % 2) for i in range(400)], "doc_id long, quality int")
    sizes, fit = [], op7_quality_classifier._fit
    monkeypatch.setattr(op7_quality_classifier, "_fit", lambda r, x, *a: sizes.append((x, r.count())) or fit(r, x, *a))
    out = op7_quality_classifier.classify(docs, labels).collect()
    assert all((r.score >= 0.5) == (r.doc_id % 2 == 1) for r in out) and len(out) == len(rows)
    # all 12 000 are clear, so each view gives every one of them to the other in both rounds
    for x in ("text_x", "meta_x"):
        start, *rounds = [n for name, n in sizes if name == x]
        assert [n - start for n in rounds] == [12_000] * op7_quality_classifier.ROUNDS


def test_ablation_runs_as_a_query(spark, sf):
    judged = QUERIES["op6_quality_rules"](spark, sf).select("fails").collect()
    policy = op6_quality_rules.CURRENT
    names = list(op6_quality_rules.RULES)

    def kept(without=None):
        use = lambda rules: [1 << names.index(r) for r in rules if r != without]     # noqa: E731
        return sum(not any(r.fails & b for b in use(policy.hard)) and sum(bool(r.fails & b) for b in use(policy.soft)) <= policy.allowed
                   for r in judged)
    got = {r.rule: (r.n_failed, r.n_kept, r.n_kept_without, r.n_added) for r in QUERIES["op6_rule_ablation"](spark, sf).collect()}
    assert got == {rule: (sum(bool(r.fails & 1 << names.index(rule)) for r in judged), kept(), kept(rule), kept(rule) - kept())
                   for rule in policy.hard + policy.soft}

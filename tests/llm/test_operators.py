"""Each operator against a plain re-computation."""
import random
import zlib

import numpy as np
import pytest
from helpers import documents, near_classes
from hypothesis import given, settings
from hypothesis import strategies as st

from sparkguard.llm import (op1_substring_dedup, op2_token_binary, op3_ngram_join, op4_token_counts, op5_decontaminate,
                            op6_quality_rules, op7_quality_classifier, op8_url_filters, op9_line_dedup, op10_mixture)
from sparkguard.llm.eliasfano import EliasFano
from sparkguard.llm.queries import table
from sparkguard.llm.tokens import ChunkEncoder, default_tokenizer


@pytest.fixture(scope="module")
def docs(spark, sf):
    return table(spark, sf, "documents")


@pytest.fixture(scope="module")
def texts(docs):
    return {r.doc_id: r.text for r in docs.collect()}


@pytest.fixture(scope="module")
def whole_encoder():
    from tokenizers import Tokenizer
    return Tokenizer.from_file(default_tokenizer())


# ---- op2, op4 ------------------------------------------------------------------------------------------------
@given(st.lists(st.integers(0, 10_000), max_size=400), st.integers(0, 40))
@settings(max_examples=60, deadline=None)
def test_elias_fano_round_trip(values, zeros):
    v = sorted(values + [0] * zeros)
    ef = EliasFano.encode(np.array(v, np.uint64))
    assert ef.decode().tolist() == v and [ef.select(i) for i in range(len(v))] == v
    for first, last in ((0, len(v)), (len(v) // 3, len(v) // 2), (min(64, len(v)), len(v)), (len(v) // 2, len(v) // 2)):
        assert ef.select_range(first, last).tolist() == v[first:last]


def test_elias_fano_is_small():
    rng = np.random.default_rng(1)
    ends = np.cumsum(rng.integers(1, 2000, 10_000))
    ef = EliasFano.encode(ends)
    bits = 8 * (len(ef.low) + len(ef.high) + len(ef.samples)) / len(ends)
    assert bits <= 2 + np.log2(1000) + 1.5 and ef.decode().tolist() == ends.tolist()


@given(st.text(alphabet=st.sampled_from("abcXYZ ΣσςİıẞßéÉ́̈  \x1c\x85\t\n\r.,'’s!?<|>12٣中한가🙂#$*"), max_size=40))
@settings(max_examples=400, deadline=None)
def test_chunked_ids_equal_whole_ids(text):
    enc = test_chunked_ids_equal_whole_ids.__dict__.setdefault("enc", ChunkEncoder(default_tokenizer()))
    for t in (text, text + " <|endoftext|>" + text):
        assert next(enc.encode([t])).tolist() == enc.tok.encode(t, add_special_tokens=False).ids


def test_token_files(spark, docs, texts, whole_encoder, tmp_path):
    path = str(tmp_path / "tokens")
    op2_token_binary.write_tokens(docs.repartition(5), path, segment_tokens=2000)
    rows = op2_token_binary.read_documents(spark, path).orderBy("doc_no").collect()
    at, ids = 0, {}
    for no, (r, doc) in enumerate(zip(rows, sorted(texts), strict=True)):
        ids[no] = whole_encoder.encode(texts[doc] or "", add_special_tokens=False).ids + [1]
        crc = zlib.crc32(np.array(ids[no], "<u4").tobytes())
        assert (r.doc_id, r.doc_no, r.start, r.n_tokens, r.ids_crc32) == (doc, no, at, len(ids[no]), crc)
        at += len(ids[no])
    wanted = [0, 1, 77, len(rows) - 1]
    assert {r.doc_no: r.ids for r in op2_token_binary.read_ids(spark, path, wanted).collect()} == {n: ids[n] for n in wanted}


def test_rows_of_one_doc_id_stand_in_text_order(spark, tmp_path):
    """Null and equal doc_ids are dealt out by their texts; the files keep (doc_id, text) order."""
    rng = random.Random(1)
    rows = [(rng.choice([None, None, 7, 9]), "".join(rng.choice("abc ") for _ in range(rng.randint(0, 40)))) for _ in range(700)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    path = str(tmp_path / "tokens")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    op2_token_binary.write_tokens(docs.repartition(6), path, segment_tokens=300)
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert spark.read.parquet(f"{path}/data").select("part").distinct().count() > 3
    got = op2_token_binary.read_documents(spark, path).orderBy("doc_no").collect()
    assert [r.doc_no for r in got] == list(range(700))
    enc, want = ChunkEncoder(default_tokenizer()), sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode()))
    for (doc, _), ids, r in zip(want, enc.encode([t for _, t in want]), got):
        assert (r.doc_id, r.n_tokens, r.ids_crc32) == (doc, len(ids) + 1, zlib.crc32(np.append(ids, 1).astype("<u4").tobytes()))


def test_token_counts(docs, texts, whole_encoder):
    got = {r.doc_id: r.n_tokens for r in op4_token_counts.corpus_token_counts(docs.repartition(3)).collect()}
    assert got == {d: len(whole_encoder.encode(t or "", add_special_tokens=False).ids) for d, t in texts.items()}


@pytest.mark.parametrize("block,group", [(1, 2), (3, 2), (7, 4096)])
def test_separator_scan_over_blocks(spark, monkeypatch, block, group):
    monkeypatch.setattr(op4_token_counts, "GROUP_BLOCKS", group)
    rng, files, want = random.Random(block), [], set()
    for f in range(4):
        ids = [rng.choice([9, 1, 2, 3, 4]) for _ in range(rng.randint(0, 40))]
        docs, cur, start = [], [], 0
        for at, i in enumerate(ids):
            if i == 9:
                docs.append((start, len(cur), True))
                cur, start = [], at + 1
            else:
                cur.append(i)
        if cur:
            docs.append((start, len(cur), False))
        want |= {(f, k, *d) for k, d in enumerate(docs)}
        files += [(f, 2, b // block, bytearray(np.array(ids[b:b + block], "<u2").tobytes())) for b in range(0, len(ids), block)]
    blocks = spark.createDataFrame(files, "file int, width int, block long, data binary")
    got = {tuple(r) for r in op4_token_counts.count_tokens(blocks, 9).collect()}
    assert got == want


# ---- op1, op9 ------------------------------------------------------------------------------------------------
def test_substring_dedup(docs, texts):
    seen = {}
    for d in sorted(texts):
        pieces = [p.strip().lower() for p in op1_substring_dedup.sentences(texts[d] or "")]
        for i, j in op1_substring_dedup.runs([p.count(" ") + 1 if p else 0 for p in pieces]):
            seen.setdefault(tuple(pieces[i:j]), []).append((d, i, j))
    cut = {}
    for places in seen.values():
        for d, i, j in sorted(places)[1:]:
            cut.setdefault(d, set()).update(range(i, j))
    for task_spans in (op1_substring_dedup.TASK_SPANS, 40):
        for r in op1_substring_dedup.remove_repeats(docs.repartition(4), task_spans).collect():
            pieces = op1_substring_dedup.sentences(texts[r.doc_id])
            gone = cut.get(r.doc_id, set())
            assert r.text == "".join(p for i, p in enumerate(pieces) if i not in gone) and r.n_removed == len(gone)


def test_runs_are_the_shortest_ones():
    rng = random.Random(3)
    for _ in range(200):
        w = [rng.choice([0, 1, 2, 5, 9, 30, 50]) for _ in range(rng.randint(0, 14))]
        big = lambda i, j: sum(w[i:j]) >= 40 or (j - i >= 3 and sum(w[i:j]) >= 12)
        ok = [(i, j) for i in range(len(w)) for j in range(i + 1, len(w) + 1) if big(i, j)]
        want = {(i, min(b for a, b in ok if a == i)) for i, _ in ok} | {(max(a for a, b in ok if b == j), j) for _, j in ok}
        assert op1_substring_dedup.runs(w) == sorted(want)


def test_planted_passage_stays_once(spark):
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(6))
    sentence = lambda n: " ".join(word() for _ in range(n)).capitalize() + "."
    passage = " ".join(sentence(n) for n in (22, 1, 3, 2, 30))
    docs = documents(spark, [f"{sentence(9)} {sentence(8)} {passage} {sentence(7)}" for _ in range(6)])
    kept = [r.text for r in op1_substring_dedup.remove_repeats(docs).orderBy("doc_id").collect()]
    assert [passage in t for t in kept] == [True] + [False] * 5
    assert all(len(t.split()) == 24 for t in kept[1:])      # nothing else goes


@pytest.mark.parametrize("lg_k", [4, 10])
def test_line_spread_is_exact_at_the_threshold(spark, lg_k, monkeypatch):
    monkeypatch.setattr(op9_line_dedup, "LG_K", lg_k)
    monkeypatch.setattr(op9_line_dedup, "ERROR", 1.04 / 2 ** (lg_k / 2))
    rows = []
    for n in (1, 9, 10, 11, 40, 100):                       # a line on n sites, twice on each
        rows += [(len(rows) + i, f"line of {n}\nown {n} {i}", "en", f"s{i % n}", 0) for i in range(2 * n)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for r in op9_line_dedup.remove_boilerplate(docs).collect():
        n = int(rows[r.doc_id][1].split("\n")[0].split()[-1])
        assert (f"line of {n}" not in r.text) == (n >= 10) and "own" in r.text


# ---- op3 -----------------------------------------------------------------------------------------------------
@pytest.mark.parametrize("block", [256, 3])
def test_ngram_join_equals_all_pairs(docs, texts, block):
    want = near_classes(texts)
    got = {r.doc_id: (r.class_id, r.n_links) for r in op3_ngram_join.ngram_join(docs, block=block).collect()}
    assert got == want


def test_large_group_of_near_copies(spark):
    rng = random.Random(8)
    base = [f"w{rng.randint(0, 10**6)}" for _ in range(120)]
    texts = []
    for _ in range(150):
        w = list(base)
        for _ in range(rng.randint(0, 6)):
            w[rng.randrange(len(w))] = f"x{rng.randint(0, 10**6)}"
        texts.append(" ".join(w))
    texts += texts[:20]
    want = near_classes(dict(enumerate(texts)))
    got = {r.doc_id: (r.class_id, r.n_links) for r in op3_ngram_join.ngram_join(documents(spark, texts), block=16).collect()}
    assert {d: c for d, (c, _) in got.items()} == {d: c for d, (c, _) in want.items()}
    assert got == want


def test_bands_reach_the_recall():
    bands, rows = op3_ngram_join.bands_for(0.8, 0.999, 128)
    assert bands * rows <= 128 and 1 - (1 - 0.8 ** rows) ** bands >= 0.999


# ---- op5 -----------------------------------------------------------------------------------------------------
@pytest.mark.parametrize("shard_bytes", [1 << 20, 1500])
def test_shards_and_short_items(spark, shard_bytes):
    rng = random.Random(2)
    items = [(i, " ".join(rng.choice("abcde") for _ in range(rng.choice([0, 1, 3, 9, 10, 11, 25])))) for i in range(40)]
    texts = [" ".join(rng.choice("abcdefghij") for _ in range(rng.randint(0, 300))) for _ in range(40)]
    want = []
    for t in texts:
        w, hit, names = t.split(), set(), set()
        for i, item in items:
            p = item.split()
            n = min(10, len(p))
            for k in range(len(p) - n + 1) if n else ():
                for at in range(len(w) - n + 1):
                    if w[at:at + n] == p[k:k + n]:
                        hit |= set(range(at, at + n))
                        names.add(str(i))
        want.append((len(w), len(hit), sorted(names)))
    bench = spark.createDataFrame(items, "item_id long, text string")
    rows = op5_decontaminate.find_contamination(documents(spark, texts), bench, shard_bytes=shard_bytes).collect()
    got = {r.row.doc_id: (r.n_words, sum(r.spans[1::2]) - sum(r.spans[::2]), r["items"]) for r in rows}
    assert got == dict(enumerate(want))


# ---- op6, op7, op8, op10 ---------------------------------------------------------------------------------------
def test_ablation_equals_recounting(docs):
    led = op6_quality_rules.ledger(docs).cache()
    for policy in op6_quality_rules.POLICIES.values():
        for r in op6_quality_rules.ablation(led, policy).collect():
            hard = tuple(x for x in policy.hard if x != r.rule)
            soft = tuple(x for x in policy.soft if x != r.rule)
            less = op6_quality_rules.Policy("less", 1, hard, soft, policy.allowed)
            assert r.n_kept == led.filter(op6_quality_rules.verdict(policy)).count()
            assert r.n_kept_without == led.filter(op6_quality_rules.verdict(less)).count()
    led.unpersist()


def test_rules_keep_clean_documents(spark, docs, sf):
    judged = op6_quality_rules.quality_ledger(docs).join(table(spark, sf, "labels"), "doc_id").collect()
    good = [r for r in judged if r.quality == 1 and not r.base_failed]
    assert all(r.kept for r in good)
    assert not any(r.kept for r in judged if r.quality == 0)


def test_classifier_on_held_out_labels(spark):
    docs, labels = table(spark, "/root/testdata/sf0.01", "documents"), table(spark, "/root/testdata/sf0.01", "labels")
    test = labels.filter("doc_id % 3 = 0")
    out = op7_quality_classifier.classify(docs, labels.filter("doc_id % 3 <> 0")).join(test, "doc_id").collect()
    right = sum((r.score >= 0.5) == (r.quality == 1) for r in out) / len(out)
    assert len(out) > 100 and right >= 0.95
    assert all(r.kept for r in out if r.quality == 1)


def test_url_index_equals_every_rule(spark, sf, monkeypatch):
    import re
    monkeypatch.setattr(op8_url_filters, "PIECE", 5)
    rules = [*op8_url_filters.RULES, op8_url_filters.host_rule("block", "a.example.org/fr/1"),
             op8_url_filters.Rule("any-html", "block", r"\.html$"), op8_url_filters.Rule("utm", "allow", r"[?&]utm_source=", ("utm", "source"))]
    pages = table(spark, sf, "pages")
    rows = {r.page_id: r for r in op8_url_filters.judge(pages, rules).collect()}
    for page in pages.collect():
        m = re.match(r"(?s)(?:.*?)://([^/?#]*)([^?#]*)(.*)", page.url)
        host, path = m[1].lower(), m[2]
        rest = (m[1] + m[2] + m[3]).lower()
        fits = [r for r in rules if re.search(r.regex, host + path if r.host_rule else rest)]
        best = min(fits, key=lambda r: (not r.host_rule, -len(r.name), r.verdict != "block", r.name), default=None)
        got = rows[page.page_id]
        assert (got.host, got.path, got.verdict) == (host, path, best.verdict if best else "allow")
        assert (got.rule or got.pattern) == (best.name if best else None)


def test_budgets_fill_siblings_first(spark):
    leaves = spark.createDataFrame([("a", "x", "1", 100), ("a", "x", "2", 10), ("a", "y", "3", 100), ("b", "x", "4", 1000), ("b", None, "5", 7)],
                                   "domain string, lang string, source string, tokens long")
    from pyspark.sql import functions as F
    got = {r.source: r.budget for r in op10_mixture.budgets(leaves, F.lit(400), {}, 1).collect()}
    # a and b get 200 each; x and y 100 each; source 2 can give 10, its sibling 1 takes the other 90
    assert got == {"1": 90, "2": 10, "3": 100, "4": 193, "5": 7}
    got = {r.source: r.budget for r in op10_mixture.budgets(leaves, F.lit(600), {("a",): 2}, 1).collect()}
    assert got == {"1": 100, "2": 10, "3": 100, "4": 383, "5": 7}      # a is full: its shortage goes to b
    got = {r.source: r.budget for r in op10_mixture.budgets(leaves, F.lit(10**9), {}, 2).collect()}
    assert got == {"1": 200, "2": 20, "3": 200, "4": 2000, "5": 14}

"""The pipeline against the same steps in plain Python."""
import re
import zlib

import corpus_pipeline
import numpy as np
from helpers import byte_words, near_classes

from sparkguard.llm import op6_quality_rules, op10_mixture
from sparkguard.llm.queries import table
from sparkguard.llm.tokens import default_tokenizer


def test_stages(spark, sf, tmp_path):
    from tokenizers import Tokenizer
    docs = table(spark, sf, "documents")
    cols, seen = docs.columns, []
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, sf)
        out.write.parquet(str(tmp_path / str(k)))
        docs = spark.read.parquet(str(tmp_path / str(k)))
        seen.append(docs)
        if k < 4:
            assert docs.columns == cols
    rows = {r.doc_id: r for r in table(spark, sf, "documents").collect()}

    good = {r.doc_id for r in op6_quality_rules.quality_ledger(table(spark, sf, "documents")).filter("kept").collect()}
    assert {r.doc_id for r in seen[0].collect()} == good
    classes = near_classes({d: rows[d].text for d in good})
    one = {d for d in good if classes[d][0] == d}
    assert {r.doc_id for r in seen[1].collect()} == one

    windows = set()
    for r in table(spark, sf, "benchmark").collect():
        w = byte_words(r.text)
        windows |= {tuple(w[i:i + 10]) for i in range(max(1, len(w) - 9))} if w else set()
    longest = {len(w) for w in windows}

    def dirty(text):
        w = byte_words(text)
        return any(tuple(w[i:i + n]) in windows for n in longest for i in range(len(w) - n + 1))
    clean = {d for d in one if not dirty(rows[d].text)}
    assert {r.doc_id for r in seen[2].collect()} == clean and len(clean) < len(one)

    mixed = [r.doc_id for r in seen[3].collect()]
    count = lambda ids: sum(len(re.findall(r"[^ \t-\r]+", rows[d].text)) for d in ids)      # noqa: E731
    assert len(mixed) == len(set(mixed)) and set(mixed) <= clean
    plan = op10_mixture.cuts(seen[2], **corpus_pipeline.MIX)[1].collect()
    for leaf in plan:
        own = lambda ids: [d for d in ids if rows[d].source == leaf.source and rows[d].lang == leaf.lang]
        assert count(own(mixed)) <= leaf.budget and (leaf.budget < leaf.tokens or set(own(mixed)) == set(own(clean)))

    tok, at = Tokenizer.from_file(default_tokenizer()), 0
    for r, d in zip(sorted(seen[4].collect(), key=lambda r: r.doc_id), sorted(mixed), strict=True):
        ids = tok.encode(rows[d].text, add_special_tokens=False).ids + [1]
        assert (r.doc_id, r.start, r.n_tokens, r.ids_crc32) == (d, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        at += len(ids)


def test_run_gives_the_last_stage(spark, sf):
    out = corpus_pipeline.run(spark, sf)
    assert out.columns == ["doc_id", "start", "n_tokens", "ids_crc32"] and out.count() > 0

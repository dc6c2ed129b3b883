"""Quality classifier by co-training of a text-content view and a page-metadata view.

* Text view: hashed counts of lower-case words, of word shapes (``Aa,`` or ``A!!``) and of the share of distinct words,
  scaled to unit length.
* Metadata view: language, source, length, lines, upper-case share and symbol share, in bins, hashed.

Both logistic regressions start from the labelled rows.  In each round each view labels all unlabelled rows; what it is
confident about (probability >= ``CONFIDENT`` either way, the other view not confidently against it) joins the other
view's training rows, and both are fitted again.  A held-out fifth of the labels calibrates each view (Platt scaling); the
calibrated log-odds are added, less the prior's, and every document is scored.

Every unlabelled row is labelled in every round and all confident ones are fitted, whatever the input's size.  Only the labelled
rows are bounded: about ``MAX_LABELLED`` of them, chosen by a hash of doc_id at a rate from exact counts.  They weigh 1 / rate, so
that they count against the pseudo-labels as all labelled rows would.  The views are computed and written once, with term
counts (which Parquet packs well) in place of the unit vectors.  Everything runs in the JVM.

Labels are joined by doc_id; null labels and labels without a document are ignored; several labels of a document count
by their greatest.  Without labels of both classes there is no model: scores are null and all documents are kept.
Null texts count as empty.  Equal rows get equal scores; an empty table gives an empty result.
"""
from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import FeatureHasher, HashingTF, Normalizer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import written

MAX_LABELLED = 8000
ROUNDS, CONFIDENT = 2, 0.95
TEXT_DIM, META_DIM = 1 << 14, 1 << 9
KEEP_AT = 0.3
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
META = ["lang", "source", "f_len", "f_lines", "f_upper", "f_symbols"]


def _bin(share: Column) -> Column:
    return F.floor(F.sqrt(share) * 20).cast("string")


def views(docs: DataFrame) -> DataFrame:
    """``doc_id``, the vectors ``tf`` (term counts) and ``meta_x`` of every row."""
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("t"),
                    F.col("lang").cast("string").alias("lang"), F.col("source").cast("string").alias("source"))
    shape = F.regexp_replace(F.regexp_replace("t", r"\p{Ll}+", "a"), r"\p{Lu}+", "A")
    n = F.greatest(F.length("t"), F.lit(1))
    d = d.select("doc_id", "lang", "source", F.split(F.lower("t"), r"\s+").alias("words"), F.split(shape, r"\s+").alias("shapes"),
                 F.floor(F.log2(n) * 2).cast("string").alias("f_len"),
                 F.floor(F.log2(F.size(F.split("t", "\n"))) * 2).cast("string").alias("f_lines"),
                 _bin(F.length(F.regexp_replace("t", r"[^\p{Lu}]+", "")) / n).alias("f_upper"),
                 _bin(F.length(F.regexp_replace("t", r"[\p{L}\p{N}\s.,]+", "")) / n).alias("f_symbols"))
    distinct = F.floor(F.size(F.array_distinct("words")) * 20 / F.size("words"))
    marks = F.array_repeat(F.concat(F.lit("\x00distinct "), distinct.cast("string")), F.size("words"))
    shaped = F.transform("shapes", lambda s: F.concat(F.lit("\x00"), s))
    d = d.withColumn("terms", F.concat("words", shaped, marks))
    stages = [HashingTF(inputCol="terms", outputCol="tf", numFeatures=TEXT_DIM),
              FeatureHasher(inputCols=META, outputCol="meta_x", numFeatures=META_DIM, categoricalCols=META)]
    return PipelineModel(stages).transform(d).select("doc_id", "tf", "meta_x")


def _unit(rows: DataFrame) -> DataFrame:
    """``rows`` with ``text_x``, the term counts scaled to unit length."""
    return Normalizer(inputCol="tf", outputCol="text_x").transform(rows).drop("tf")


def _draw(seed: int) -> Column:
    """A uniform number of [0, 1) per doc_id."""
    return F.pmod(F.xxhash64(F.lit(seed), "doc_id"), F.lit(1 << 30)) / float(1 << 30)


def _fit(rows: DataFrame, x: str, reg: float = 1e-4):
    """Logistic regression of ``y`` on ``x``, weighted by ``w``."""
    return LogisticRegression(featuresCol=x, labelCol="y", weightCol="w", maxIter=20, regParam=reg, rawPredictionCol="raw",
                              probabilityCol="prob", predictionCol="pred").fit(rows)


def _scored(model, rows: DataFrame, name: str) -> DataFrame:
    """``rows`` with the model's log-odds as ``name``."""
    return model.transform(rows).withColumn(name, vector_to_array("raw")[1]).drop("raw", "prob", "pred")


class CoTrained:
    """The two fitted views and their calibration."""

    def __init__(self, text, meta, text_scale, meta_scale, prior: float):
        self.text, self.meta, self.text_scale, self.meta_scale, self.prior = text, meta, text_scale, meta_scale, prior

    def score(self, rows: DataFrame) -> DataFrame:
        """``rows`` (with the vectors) with p_text, p_meta and score."""
        out = _scored(self.meta, _scored(self.text, rows, "text_raw"), "meta_raw")
        logit = lambda c, s: F.lit(s[0]) * F.greatest(F.lit(-30.0), F.least(F.lit(30.0), F.col(c))) + F.lit(s[1])
        sig = lambda z: 1 / (1 + F.exp(-z))
        a, b = logit("text_raw", self.text_scale), logit("meta_raw", self.meta_scale)
        return out.withColumn("p_text", sig(a)).withColumn("p_meta", sig(b)) \
            .withColumn("score", sig(a + b - F.lit(self.prior))).drop("text_raw", "meta_raw")


def _platt(model, rows: DataFrame, x: str) -> tuple[float, float]:
    z = _scored(model, rows.select("y", x), "z")
    m = _fit(VectorAssembler(inputCols=["z"], outputCol="zv").transform(z.select("y", F.lit(1.0).alias("w"), "z")), "zv", 1e-3)
    return float(m.coefficients[0]), float(m.intercept)


def known_labels(labels: DataFrame) -> DataFrame:
    """``(doc_id, y)``: one label per document."""
    return labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("double").alias("y")) \
        .filter("doc_id is not null and y in (0.0, 1.0)").groupBy("doc_id").agg(F.max("y").alias("y"))


def co_train(rows: DataFrame, n_known: int, max_labelled: int = MAX_LABELLED, rounds: int = ROUNDS,
             confident: float = CONFIDENT, seed: int = 11) -> CoTrained | None:
    """Fit on ``rows``, the views of all documents with their label ``y`` or null; None without both classes.  ``n_known``
    is the number of labels."""
    import math
    rate = min(1.0, max_labelled / n_known)
    rows = _unit(rows)
    fit_rows = written(rows.filter("y is not null").filter(_draw(seed) < rate).withColumn("w", F.lit(1 / rate)), "labelled")
    pool = rows.filter("y is null").drop("y")
    held = fit_rows.filter(_draw(seed + 2) < 0.2)
    base = fit_rows.filter(_draw(seed + 2) >= 0.2)
    count = {(r["h"], r["y"]): r["count"] for r in fit_rows.groupBy((_draw(seed + 2) < 0.2).alias("h"), "y").count().collect()}
    if len({y for _, y in count}) < 2:
        return None
    if len(count) < 4:       # too few labels to hold some of both classes out
        base = held = fit_rows
        count = {(False, y): sum(n for (_, z), n in count.items() if z == y) for y in (0.0, 1.0)}
    n = {y: count[False, y] for y in (0.0, 1.0)}
    text, meta = _fit(base, "text_x"), _fit(base, "meta_x")
    edge = math.log(confident / (1 - confident))
    for _ in range(rounds):
        both = _scored(meta, _scored(text, pool, "a"), "b")
        sure = lambda own, other: F.when((F.col(own) >= edge) & (F.col(other) > -edge), 1.0).when(
            (F.col(own) <= -edge) & (F.col(other) < edge), 0.0)
        # `once` is always true; as a column that isn't deterministic it keeps the filter, and so a second scoring, out of the scan
        once = F.monotonically_increasing_id() >= 0
        given = lambda x, y: both.select(x, F.when(once, y).alias("y"), F.lit(1.0).alias("w")).filter("y is not null")
        for_meta = written(given("meta_x", sure("a", "b")), "given")      # small, without the text vectors
        for_text = given("text_x", sure("b", "a"))
        text = _fit(base.select("text_x", "y", "w").union(for_text), "text_x")
        meta = _fit(base.select("meta_x", "y", "w").union(for_meta), "meta_x")
    return CoTrained(text, meta, _platt(text, held, "text_x"), _platt(meta, held, "meta_x"), math.log(n[1.0] / n[0.0]))


def classify(docs: DataFrame, labels: DataFrame, keep_at: float = KEEP_AT, **options) -> DataFrame:
    """``(doc_id, p_text, p_meta, score, kept)`` for every row of ``docs``."""
    known = known_labels(labels)
    n_known, model = known.count(), None
    if n_known and not docs.isEmpty():
        rows = written(views(docs).join(known, "doc_id", "left"), "views")
        model = co_train(rows, n_known, **options)
    if model is None:
        none = F.lit(None).cast("double")
        return docs.select(F.col("doc_id").cast("long").alias("doc_id"), none.alias("p_text"), none.alias("p_meta"),
                           none.alias("score"), F.lit(True).alias("kept"))
    out = model.score(_unit(rows)).select("doc_id", "p_text", "p_meta", "score")
    return out.withColumn("kept", F.col("score") >= keep_at)

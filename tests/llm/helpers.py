"""Small inputs and plain re-computations for the operators' tests."""
import re

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
#: Columns of names that operators use for their own.
EXTRA = ["row", "k", "hash", "pos", "n_words", "kept", "bucket", "class", "spans", "tokens", "_text", "cut", "site", "epoch"]


def documents(spark, texts, lang="en", source=None):
    rows = [(i, t, lang, source or f"src{i % 4}", None if t is None else len(t)) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, DOCS)


def odd_documents(spark):
    """Nulls in every column, empty and blank texts, one long text, ties and repeated rows, clashing columns."""
    from pyspark.sql import functions as F
    long = " ".join(f"w{i % 5000}" for i in range(60_000))
    rows = [(0, "", "en", "src0", 0), (1, None, None, None, None), (None, "a text without an id. It is short. So it is.", "en", "src1", 5),
            (None, None, None, None, None), (2, " \n\t ", "en", "src0", 4), (3, long, "de", "src2", len(long)),
            (4, "one two three four five six seven eight nine ten eleven twelve.", "en", "src0", 1),
            (4, "one two three four five six seven eight nine ten eleven twelve.", "en", "src0", 1),
            (5, "one two three four five six seven eight nine ten eleven twelve.", "fr", "src3", 1),
            (5, "another text under the same id as the one before it, of more words.", "fr", "src3", 1),
            (-7, "a negative id é中\U0001f642 \x00 and odd characters", "en", "src0", 1)]
    df = spark.createDataFrame(rows, DOCS)
    return df.select("*", *[F.lit(7).alias(c) for c in EXTRA])


def byte_words(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def shingles(text, n=5):
    w = byte_words(text)
    n = min(n, len(w))
    return {tuple(w[i:i + n]) for i in range(len(w) - n + 1)} if w else set()


def near_classes(texts):
    """{id: (least id of its class, links)} by comparing every pair."""
    sets = {i: shingles(t) for i, t in texts.items()}
    up, links = {i: i for i in texts}, dict.fromkeys(texts, 0)

    def find(x):
        while up[x] != x:
            x = up[x]
        return x
    ids = sorted(texts)
    for n, a in enumerate(ids):
        for b in ids[:n]:
            both = len(sets[a] & sets[b])
            if both and 10 * both >= 8 * (len(sets[a]) + len(sets[b]) - both):
                links[a] += 1
                links[b] += 1
                x, y = find(a), find(b)
                up[max(x, y)] = min(x, y)
    return {i: (find(i), links[i]) for i in texts}

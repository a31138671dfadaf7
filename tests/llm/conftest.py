import random

import pytest
from pyspark.sql import functions as F

SYLLABLES = {
    "en": "the and ing ion ent for tha nth int ere".split(),
    "de": "der und ein sch ich auf gen ung lich keit".split(),
    "fr": "les que eau oui ment tre eux une aux ier".split(),
}


def sentence(rng: random.Random, lang: str, words: int) -> str:
    s = SYLLABLES[lang]
    return " ".join("".join(rng.choice(s) for _ in range(rng.randint(1, 3))) for _ in range(words)).capitalize() + "."


@pytest.fixture(scope="session")
def corpus(spark):
    """240 documents in three languages with toxic rows, copies and near copies; labels beside them."""
    rng = random.Random(5)
    docs, labels = [], []
    for i in range(240):
        lang = ("en", "de", "fr")[i % 3]
        words = sentence(rng, lang, rng.randint(30, 120)).split()
        toxic = i % 5 == 1
        if toxic:
            for _ in range(3):
                words.insert(rng.randrange(len(words)), rng.choice(["blockhead", "scoundrel", "nitwit"]))
        docs.append([i, " ".join(words), lang, f"src{i % 4}" if i % 3 else "hot", 0])
        labels.append((i, int(i % 7 != 0), int(toxic)))
    for i in range(200, 220):       # exact copies of one text
        docs[i][1] = docs[2][1]
        labels[i] = (i, 1, 0)
    for i in range(220, 230):       # near copies: one word changed
        words = (docs[3][1] + " " + docs[5][1]).split()
        words[i - 215] = "changed"
        docs[i][1] = " ".join(words)
        labels[i] = (i, 1, 0)
    docs_df = spark.createDataFrame([(i, t, lang, s, len(t)) for i, t, lang, s, _ in docs],
                                    "doc_id long, text string, lang string, source string, n_chars long")
    return docs_df, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


CLASHING = ["score", "predicted", "held_out", "lang_pred", "class_id", "kept", "node", "band", "bands", "fp", "shard",
            "slot", "size", "_h", "_pos", "_text", "_id", "_kept", "_source", "length", "piece", "key", "a", "b",
            "log_weight", "toxic", "quality", "law"]


@pytest.fixture(scope="session")
def odd_documents(spark):
    """Nulls in every column, empty, blank and long texts, repeated rows, ties, clashing extra columns."""
    rows = [(1, None, "en", "s"), (2, "", "en", None), (3, "   \n", None, "s"), (4, "12 34 !!", "de", "s"),
            (5, "word", "en", "s"), (None, "a text without an id in it", "en", "s"), (None, None, None, None),
            (6, "same text for two rows of ids", "en", "s"), (7, "same text for two rows of ids", "en", "s"),
            (8, "repeated row here", "en", "t"), (8, "repeated row here", "en", "t"),
            (9, "long " * 60_000, "en", "t"), (10, "x" * 200_000, "fr", "t"), (11, "日本語 ünïİ ’quoted’", "xx", "t")]
    df = spark.createDataFrame([(*r, None) for r in rows], "doc_id long, text string, lang string, source string, n_chars long")
    for c in CLASHING:
        df = df.withColumn(c, F.lit("other"))
    return df


@pytest.fixture(scope="session")
def no_documents(odd_documents):
    return odd_documents.limit(0)

"""Small fixtures that hold the awkward cases: nulls, empty and long texts, ties,
repeated rows, and extra columns whose names clash with the operators' own."""
import random

WORDS = ("the of and to a in that it is was for on are with as be by river stone green quickly "
         "mountain harbour paper window silver garden letter winter market bridge").split()


def prose(rng, n):
    return " ".join(rng.choice(WORDS) + str(rng.randrange(40)) for _ in range(n))


def odd_rows(seed=3):
    rng = random.Random(seed)
    base = [prose(rng, 60) for _ in range(8)]
    near = []
    for text in base[:4]:
        words = text.split()
        words[rng.randrange(len(words))] = "changed"
        near.append(" ".join(words))
    texts = [*base, *near, *near[:2], None, "", "   \n\t ", "one", "one", "Two words", base[0].upper(),
             prose(rng, 4000)]
    return [(i + 1, t) for i, t in enumerate(texts)]


def odd_documents(spark, seed=3):
    rows = odd_rows(seed)
    rows += [rows[0]]  # a repeated row
    extra = [(i, t, "en", "src", None if t is None else len(t), "x", 1, 2.0) for i, t in rows]
    return spark.createDataFrame(extra, "doc_id long, text string, lang string, source string, n_chars long, "
                                        "bucket string, n int, score double")


def empty_documents(spark):
    return odd_documents(spark).limit(0)


def words(text):
    """Words of white-space separated bytes, A-Z lower-cased."""
    return (text or "").encode().lower().split()

"""Small tables with the awkward cases that every operator must define."""

import random

SYLLABLES = "ka lo mi nu re sa to ve wi xo ya zu ber den fol gar hin jal kor lem".split()


def prose(seed: int, words: int) -> str:
    rng = random.Random(seed)
    return " ".join("".join(rng.choice(SYLLABLES) for _ in range(rng.randint(1, 3))) for _ in range(words))


def documents(spark, rows):
    """Extra columns have names that operators might use for themselves."""
    data = [(i, t, "en", None, 1, "x", 2.0) for i, t in rows]
    return spark.createDataFrame(
        data, "doc_id long, text string, lang string, source string, n_chars long, digest string, score double")


AWKWARD = [
    (1, None), (2, ""), (3, " \n\t "), (4, "one"), (None, "a row without a number of its own"), (5, "twice the same row here"),
    (5, "twice the same row here"), (6, "ünïcödé ﬁ İ 漢字 Ελλάς 🙂"), (7, prose(7, 30_000)), (8, "a.b@c.de " * 3)]

"""Small hard inputs that the operators' tests share."""

import random

SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, row string, sha string, hash long, "
          "again boolean, fp long, word string, n long, score double, part int, raw double, v string, z long")
WORDS = {"en": "the of and with that over under house water light running stone".split(),
         "de": "der die und nicht über Straße größer Wasser Häuser zwischen grün Öl".split(),
         "fr": "le les des être où français garçon maison été forêt déjà naïve".split()}


def prose(lang: str, seed: int, words: int = 40) -> str:
    rng = random.Random(f"{lang}{seed}")
    return " ".join(rng.choice(WORDS[lang]) for _ in range(words)) + "."


def row(doc_id, text, lang="en"):
    return (doc_id, text, lang, "s", None if text is None else len(text), "r", "x", 1, None, 2, "w", 3, 0.5, 4, 1.5,
            "v", 5)


def hard_rows() -> list[tuple]:
    """Nulls, empty and very long texts, repeated rows, copies, texts of white space or without letters."""
    rows = [row(k, prose(lang, k), lang) for k, lang in enumerate(["en", "de", "fr"] * 20, 100)]
    rows += [row(1, None), row(2, ""), row(3, " \t\n "), row(4, "12 34 !!"), row(5, None, None), row(None, "lost words"),
             row(None, "lost words"), row(None, None), row(6, "same text here now"), row(7, "same text here now"),
             row(8, "same text here now"), row(9, "said twice over"), row(9, "said twice over"),
             row(10, prose("en", 1, 30_000)), row(11, "x" * 200_000), row(12, "é" * 50_000), row(13, "日本語 テキスト 中文"),
             row(14, "a b c \x1c \x85 d"), row(15, "password = hunter2222 and 日本 token: abcdef123")]
    return [x if x[2] is None or k % 7 else (*x[:3], None, *x[4:]) for k, x in enumerate(rows)]


def hard_docs(spark, parts: int = 3):
    return spark.createDataFrame(hard_rows(), SCHEMA).repartition(parts)


def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)


def words_of(text) -> list[bytes]:
    return (text or "").encode().lower().split()

"""Small documents with the awkward cases that every operator must take."""

from __future__ import annotations

import random

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

WORD_FILE = public_tokenizers.path("word_bpe_49k.json")
BYTE_FILE = public_tokenizers.path("byte_bpe_50k.json")

SCHEMA = (
    "doc_id bigint, text string, lang string, source string, n_chars bigint, label string, count bigint,"
    " dropped string, text_key string, replaced string, line string, point bigint, salt int, key string, owner string"
)
CLASHING = ["c"] * 3 + ["d", 5, 6, "k", "o"]


def sentence(rng: random.Random, words: int) -> str:
    return " ".join(rng.choice(["alpha", "beta,", "Gamma", "delta.", "épée", "x1", "the", "of"]) + str(rng.randrange(60)) for _ in range(words))


def awkward_texts() -> list[str | None]:
    rng = random.Random(5)
    passage = sentence(rng, 400)
    long = "\n".join(sentence(rng, 40) for _ in range(900))
    texts = [None, "", " ", "\n", "a", "It's 42 o'clock<|endoftext|> now", "中文 text　 mixed\x85 ıİ", "x" * 3000]
    texts += [passage, passage, passage + "\n" + sentence(rng, 200), sentence(rng, 100) + " " + passage, long]
    texts += [long[: len(long) // 2] + " changed " + long[len(long) // 2 :], "  leading and trailing \t\r\n\n"]
    texts += [sentence(rng, rng.randrange(1, 300)) for _ in range(40)]
    return texts


def documents(spark: SparkSession, texts: list[str | None], first: int = 0) -> DataFrame:
    """Documents with extra columns whose names clash with those the operators make."""
    rows = [(first + n, t, None if n % 5 == 0 else "en", f"src{n % 3}", len(t or ""), "x", n, *CLASHING) for n, t in enumerate(texts)]
    return spark.createDataFrame(rows, SCHEMA)


def odd_rows(spark: SparkSession, texts: list[str | None]) -> DataFrame:
    """The documents with a null id and repeated rows besides."""
    plain = documents(spark, texts)
    extra = [(None, "no id", *[None] * 13), (3, texts[3], "en", "src0", 1, "x", 3, *CLASHING)]
    return plain.unionByName(spark.createDataFrame([*extra, extra[1]], SCHEMA)).repartition(3)

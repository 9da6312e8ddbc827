"""Text cleaning against a plain-Python reading of its steps, on random adversarial text."""

import random
import re

from catalog_sync.functions.text import build_embedding_text, clean_text


def _reference_clean(t: str) -> str:
    t = t.replace("\r\n", " ")
    t = re.sub(r"[\x00-\x08\x0b\x0c\x0e-\x1f]", "", t)
    t = re.sub(r"\s+", " ", t)
    return t.strip()


def test_clean_text_matches_the_steps_on_random_text(spark):
    alphabet = ["a", "é", " ", "\r", "\n", "\r\n", "\t", "\x00", "\x07", "\x0b", "\x0c", "\x1c", "\x1f",
                "\x85", "\xa0", " ", "　", "​", "z"]
    rng = random.Random(3)
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 30))) for _ in range(1000)]
    df = spark.createDataFrame(list(enumerate(texts)), "id long, text string")
    got = {r["id"]: r["t"] for r in df.select("id", clean_text("text").alias("t")).collect()}
    for i, t in enumerate(texts):
        assert got[i] == _reference_clean(t), repr(t)


def test_embedding_text_skips_null_parts(spark):
    df = spark.createDataFrame([("Tap", "H", "Sinks"), ("Tap", None, "Sinks")], "d string, b string, c string")
    got = [r[0] for r in df.select(build_embedding_text("d", "b", "c")).collect()]
    assert got == ["Tap | Brand: H | Category: Sinks", "Tap | Category: Sinks"]

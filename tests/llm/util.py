"""Small tables for the tests of the llm operators."""
import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
ODD_TEXTS = [None, "", " ", "\n\n", "\t \x0b\x0c\r", "one", "two words", "ä ö ü 😀 ▁ x", "a  b   c", "Ünïcode\u00a0space word"]


def docs(spark, rows, schema=SCHEMA):
    """Rows of (doc_id, text), (doc_id, text, lang) or whole ones as ``documents``."""
    full = [tuple(r) + (None, "s", None)[len(r) - 2:] if len(r) < 5 else r for r in rows]
    return spark.createDataFrame(full, schema)


def words(rng: random.Random, n: int, vocabulary: int = 40) -> list[str]:
    return [f"w{rng.randrange(vocabulary)}" for _ in range(n)]

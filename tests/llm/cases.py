"""Small documents with everything that must not crash an operator."""

import random

DOCUMENTS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def words(seed: int, n: int) -> list[str]:
    draw = random.Random(seed)
    parts = "an en th er on ti ing ed re ou ha le de que ción ß é".split()
    return ["".join(draw.choice(parts) for _ in range(draw.randint(1, 4))) for _ in range(n)]


def prose(seed: int, n: int) -> str:
    return " ".join(words(seed, n))


def rows() -> list[tuple]:
    """Nulls in any column, empty and long texts, ties, repeated rows, copies, near copies, odd characters."""
    out = [(i, prose(i, 40 + 7 * i), "en", f"s{i % 3}", 0) for i in range(12)]
    near = words(3, 61)
    near[30] = "other"
    out += [
        (20, prose(3, 61), "en", "s0", 1),
        (21, " ".join(near), "en", "s1", 1),
        (22, prose(5, 75), "de", None, None),
        (23, prose(5, 75), "de", None, None),
        (24, None, "en", "s0", 0),
        (25, None, None, None, None),
        (26, "", "en", "s1", 0),
        (27, "", "en", "s1", 0),
        (28, " \n\t ", "en", "s2", 0),
        (29, "word", "en", "s2", 4),
        (30, "\x00 null \x01 bytes \U0001f600 é <|endoftext|>   x y", "xx", "s2", 4),
        (31, prose(99, 6000), "en", "s2", 4),
        (32, "same " * 400, "en", "s2", 4),
        (33, prose(7, 30) + " " + prose(8, 60) + " " + prose(9, 20), "en", "s1", 0),
        (None, prose(50, 50), "en", "s1", 0),
        (None, None, None, None, None),
        (5, prose(5, 75), "en", "s2", 0),
        (5, prose(5, 75), "en", "s2", 0),
        (6, prose(60, 44), "en", "s2", 0),
    ]
    return out


def documents(spark, data=None, parts: int = 3):
    return spark.createDataFrame(rows() if data is None else data, DOCUMENTS).repartition(parts, "doc_id")


def stored_documents(spark, tmp_path, data=None, name: str = "docs"):
    """As files, like the tables that the operators are made for."""
    path = str(tmp_path / name)
    documents(spark, data).write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)

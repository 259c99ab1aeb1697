import random

import pytest

#: Names that the operators use for helper columns, or once did.
CLASHING = ["lines", "removed", "copies", "gone", "text_hash", "hash", "copy", "its_doc", "_gone", "_doc", "_hash", "_text", "_copy", "_s", "_d", "_t", "Batch", "part", "kept"]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, key string, node long, size string, row long, at long, place double, size_ string, " + ", ".join(f"{c} long" for c in CLASHING)

WORDS = [a + b for a in ("ta", "ri", "mo", "ske", "lun", "pra") for b in ("len", "dor", "vis", "", "qua", "tem", "sor")]


def prose(seed: int, n: int) -> str:
    r = random.Random(seed)
    words = [r.choice(WORDS) for _ in range(n)]
    for k in range(12, n, 12):
        words[k] += ".\n" + words[k].title()
    return " ".join(words)


def edited(text: str, seed: int, edits: int) -> str:
    r = random.Random(seed)
    words = text.split(" ")
    for _ in range(edits):
        words[r.randrange(len(words))] = f"x{r.randrange(1000)}"
    return " ".join(words)


def rows() -> list[tuple]:
    """Documents with nulls in every column, empty and long texts, ties, copies, near copies and repeated rows."""
    texts: list[tuple[int | None, str | None, str | None]] = [(k, prose(k, 40 + 7 * k), f"src{k % 3}") for k in range(1, 30)]
    base = prose(100, 120)
    texts += [(40 + k, edited(base, k, k), "src0") for k in range(8)]
    texts += [(60 + k, base if k % 2 else base.upper(), "src1") for k in range(6)]
    texts += [(70, None, "src1"), (71, "", None), (72, " \t\n ", "src2"), (73, "one two three", None), (74, "One  two\tthree", "src2"), (None, base, "src0"), (None, None, None)]
    texts += [(80, "long " + prose(7, 9000), "src1"), (81, "naïve café — “quoted” 　日本語 😀 ▁x▁", "src2"), (82, "w" * 5000, "src2")]
    texts += [(83, prose(9, 60), "src2"), (83, prose(9, 60), "src2"), (84, prose(3, 60), "src0"), (84, prose(4, 80), "src1")]
    return [(i, t, None if k % 4 == 0 else "en", s, len(t) if t is not None and k % 5 else None, "k" if k % 2 else None, k, None, k, None, 0.5, "s", *[100 * k + j for j in range(len(CLASHING))]) for k, (i, t, s) in enumerate(texts)]


@pytest.fixture(scope="session")
def docs(spark):
    return spark.createDataFrame(rows(), SCHEMA).repartition(3).cache()


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)

"""Small tables with every awkward case that the operators have to bear."""

import random

import pytest

SCHEMA = (
    "doc_id bigint, text string, lang string, source string, n_chars bigint, row string, hits int, items string, "
    "n_words bigint, score double, block bigint, shard int, pattern string, number bigint, tokens binary, cell int"
)
LINE = "this line is in many documents and has more than forty characters"


def passage(seed: int, words: int) -> str:
    rng = random.Random(seed)
    return " ".join("".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(2, 7))) for _ in range(words))


def rows():
    base = passage(1, 120)
    near = base.split()
    near[60] = "changed"
    texts = [
        None, "", " \n\t ", "one", "Two words", "123 456", base, base, " ".join(near), base.upper(),
        passage(2, 40) + "\n" + LINE + "\n" + passage(3, 5),
        LINE + "\n" + LINE.upper() + "\n \t" + LINE + " \r\nrest", f"{LINE}\na", f"{LINE}\nb", f"{LINE}\nc\n", f"x\n{LINE}",
        "Émile ÀÇÉ été où ça <|endoftext|> ½ ② \u00a0 \x1c end  of   text ", passage(4, 30) + " " + passage(9, 25) + " " + passage(5, 30),
        passage(9, 25), "x" * 60_000, passage(6, 9_000), "a.b@c.d, 1.2.3.4 +1 (499) 555-6503", "@@ a@b a@b.c.d.e@f.g 999.1.1.1 1.2.3.4.5.6.7.8",
    ]
    made = [(i, t) for i, t in enumerate(texts)]
    made += [(6, base), (6, base), (None, base), (None, None), (None, f"{LINE}\nno id"), (500, passage(9, 12))]
    return made


def wide(made):
    """The rows with the other columns of ``SCHEMA``, whose names the operators use themselves."""
    return [(i, t, "xx" if i and i % 2 else None, "s", None if t is None else len(t), "r", 1, "i", 7, 0.5, 3, 2, "p", 9, b"t", 4) for i, t in made]


@pytest.fixture(scope="session")
def texts():
    return rows()


@pytest.fixture(scope="session")
def docs(spark):
    return spark.createDataFrame(wide(rows()), SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)

import random

import pytest

SENTENCES = [
    "the cat of the house sat on a mat and it was good for all",
    "der Hund und die Katze sind auf dem Weg nach Hause mit dem Kind",
    "la maison de la ville est dans les bois et le chien est un ami",
]


def make_texts(seed: int, count: int = 40) -> list[str | None]:
    """Texts with copies, near copies, shared passages, odd spaces and characters, and nulls."""
    draw = random.Random(seed)
    passage = " ".join(draw.choice("alpha beta gamma delta omega".split()) + str(draw.randrange(99)) for _ in range(60))
    texts: list[str | None] = [None, None, "", " \t\n", "word", "two words", "\x0b\x0c", "é" * 130, "a" * 5000]
    while len(texts) < count:
        kind = draw.random()
        base = " ".join(draw.choice(SENTENCES) + " " + str(draw.randrange(10**6)) for _ in range(draw.randrange(1, 8)))
        if kind < 0.2 and texts[-1]:
            texts.append(draw.choice([t for t in texts if t]))
        elif kind < 0.35:
            texts.append(base + "\n" + passage + "\n" + base[:50])
        elif kind < 0.45:
            texts.append(passage[draw.randrange(100):] + "  it's we'll I'VE 'sx 　   ١٢ ½ 日本語 \U0001F600!!")
        elif kind < 0.55:
            texts.append(base.replace(" ", "\t\r\n", 3))
        else:
            texts.append(base)
    draw.shuffle(texts)
    return texts


@pytest.fixture(scope="session")
def texts():
    return make_texts(1)


@pytest.fixture(scope="session")
def docs(spark, texts, tmp_path_factory):
    """Documents with nulls in every column, repeated ids, a repeated row, and columns whose
    names the operators use themselves."""
    draw = random.Random(2)
    rows = [
        (i, text, draw.choice(["en", None]), draw.choice(["s1", "s2", "s10", "é", None]), i, "x")
        for i, text in enumerate(texts)
    ]
    rows += [rows[20], rows[20], (None, "a null id", None, None, None, None), (3, "an id again", "en", "s1", 1, "y")]
    draw.shuffle(rows)
    path = str(tmp_path_factory.mktemp("docs") / "documents.parquet")
    spark.createDataFrame(
        rows, "doc_id long, text string, lang string, source string, _row long, kept string"
    ).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="session")
def rows(docs):
    return docs.collect()


@pytest.fixture(scope="session")
def no_docs(docs):
    return docs.where("false")


def plain(frame) -> list[tuple]:
    """Rows as tuples in an order of their own."""
    return sorted((tuple(row) for row in frame.collect()), key=repr)

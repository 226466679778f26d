import random
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))

DOCS = "extra string, doc_id long, text string, text_key string, spans int"
SF_DIR = "/root/testdata/sf0.001"


def edge_rows():
    """Nulls, empty, blank, very long, tied and repeated texts, special signs; ids null and twice."""
    rng = random.Random(4)
    base = [rng.choice("alpha beta gamma delta epsilon zeta eta theta iota kappa".split()) + str(rng.randrange(40)) for _ in range(90)]
    near = base.copy()
    near[7] = "changed"
    personal = (
        "Write to Jo.Doe+x@mail.example.com or @home a@b.c@d.e today; 10.0.0.255 not 10.0.0.256 "
        "1.2.3.4.5.6.7.8 card 4111 1111 1111 1111 or 4111-1111-1111-1112 12345678901234567890123 "
        "phone +1 (415) 555-0100 or +12 é\x01 x@y.zz ü"
    )
    licence = (
        "Licensed under the Apache License, Version 2.0. Released under the MIT License. CC BY CC BY-NC 4.0 "
        "permission is hereby granted free of charge to any person obtaining a copy of this software "
        "and associated documentation files"
    )
    texts = [
        None, "", " \t\n\x0b", "one", "One one", "a b c", " ".join(base), " ".join(base), " ".join(near),
        " ".join(base).upper(), " ".join(base[:60]), personal, personal, licence,
        "x" * 30_000, "word " * 9_000, "é" * 5000 + " 你好 世界 мир\nline\nline\nline \n",
        "<|endoftext|> in a text <|endoftext|>", "#*$%&|<> " * 60, "tab\tand\r\nlines\n\nlines\x0cend",
        "1" * 5000, "a.b" * 3000, "+1" + " " * 3000 + "2", "\U0001f600 smile \U0001f600" * 40,
    ]
    rows = [("e", i, x, "k", 1) for i, x in enumerate(texts)]
    rows.append(rows[6])  # a repeated row
    rows.append(("f", 7, "another text under an id that is there already", None, None))
    rows.append((None, None, " ".join(base), None, None))
    rows.append((None, None, None, None, None))
    return rows


@pytest.fixture(scope="session")
def edges(spark):
    """The edge rows over several partitions, with columns that clash with inner names."""
    return spark.createDataFrame(edge_rows(), DOCS).repartition(3)


@pytest.fixture(scope="session")
def edge_pairs(edges):
    return [(r.doc_id, r.text) for r in edges.select("doc_id", "text").collect()]


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SF_DIR}/documents.parquet")


@pytest.fixture(scope="session")
def document_pairs(documents):
    return [(r.doc_id, r.text) for r in documents.select("doc_id", "text").collect()]

import pathlib
import random
import sys

import pytest

sys.path.insert(0, str(pathlib.Path(__file__).parent))

SF_DIR = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, key string, block int, node string, label int, size string, hash int, digest string, carried string, copies string, known int"


def odd_rows():
    """Nulls, empty and long texts, ties, repeated rows, near copies, shared passages, licenses, odd characters."""
    random.seed(7)
    vocabulary = [a + b for a in ("ka", "lo", "mi", "été", "Ru", "zz") for b in ("n", "ra", "st", "ö", "中")]

    def prose(n):
        return " ".join(random.choice(vocabulary) for _ in range(n))

    base, passage = prose(120), prose(40)
    swapped = base.split()
    swapped[60] = "changed"
    texts = [
        None, "", " \n\t", "one", "Short text only", base, base.upper(), base, " ".join(swapped), base + " and more", prose(300), prose(3000),
        prose(50) + "\n" + passage + "\n" + prose(60), passage, prose(30) + " " + passage, "same line\nsame line\n" + prose(20) + "\nsame line",
        "a b c d e " * 30, "x" * 400, "x" * 90, "Licensed under the Apache License, Version 2.0.", "GNU\nGeneral Public License v3 or later; MIT license!",
        "CC BY-SA 4.0 and cc-by", "SPDX-License-Identifier: MIT", "### $$$ %%% |||", "a b  c\x1cd\x85e <|endoftext|>", prose(12), "Two words", "two words",
    ]
    rows = [(i, t) for i, t in enumerate(texts)]
    rows += [(None, base), (None, None), (None, prose(15)), (5, base), (5, base), (10**15, passage + " " + prose(20)), (-3, prose(40))]
    sources = [None, "b", "a", "", "é"]
    return [(i, t, "en", sources[n % 5], None, "k", 1, "n", 2, "s", 3, "d", "c", "x", 4) for n, (i, t) in enumerate(rows)]


@pytest.fixture(scope="session")
def odd(spark):
    return spark.createDataFrame(odd_rows(), SCHEMA).repartition(3).persist()


@pytest.fixture(scope="session")
def given(spark):
    return spark.read.parquet(f"{SF_DIR}/documents.parquet")


@pytest.fixture(scope="session")
def empty(odd):
    return odd.where("false")


@pytest.fixture(scope="session")
def nothing_trusted(spark):
    return spark.createDataFrame([], "doc_id long")


@pytest.fixture(scope="session")
def labels(spark):
    return spark.read.parquet(f"{SF_DIR}/labels.parquet")


@pytest.fixture(params=["odd", "given"])
def docs(request):
    return request.getfixturevalue(request.param)

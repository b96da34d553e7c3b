import os
import random

import pytest

#: Python workers of the test session import this code, too.
os.environ["PYTHONPATH"] = os.pathsep.join([os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))),
                                            os.environ.get("PYTHONPATH", "")])
SCHEMA = "doc_id long, text string, source string, lang string, n_chars long, class string, row long, target double"


@pytest.fixture(scope="module")
def make(spark):
    """Documents with columns that clash with names used inside the operators."""
    spark.sparkContext.environment["PYTHONPATH"] = os.environ["PYTHONPATH"]

    def build(rows, parts=3):
        full = [(i, t, s, "en", len(t or ""), "x", 1, 2.0) for i, t, s in rows]
        return spark.createDataFrame(full, SCHEMA).repartition(parts)

    return build


@pytest.fixture(scope="session")
def texts():
    """Odd and ordinary texts: null, empty, blank, short, long, repeated, other scripts, near copies."""
    r = random.Random(7)
    words = ["".join(r.choice("aeioubcdfgklmnprst") for _ in range(r.randrange(2, 9))) for _ in range(900)]
    prose = lambda n: " ".join(r.choice(words) for _ in range(n))          # noqa: E731
    base = prose(240)
    rows = [None, "", " \t\n", "one", "Two words", "ÄÖ ß ñ \U0001F600 日本語 mixed Ünï", prose(9000), "same " * 400]
    rows += [base, base, base.upper(), base + " tail"] + [base.replace(w, w + "x", 1) for w in base.split()[:6]]
    rows += [prose(r.randrange(5, 120)) for _ in range(60)]
    shared = prose(60)
    rows += [prose(30) + "\n" + shared + "\n" + prose(30) for _ in range(6)]
    rows += ["\n".join(prose(20) for _ in range(8)) for _ in range(6)]
    return rows


@pytest.fixture
def docs(make, texts):
    return make([(None if i == 17 else i, t, None if i % 11 == 5 else f"s{i % 3 if i % 2 else 0}") for i, t in enumerate(texts)])

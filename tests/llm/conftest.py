import pytest

WORDS = "the of and to in that it was for on with as his they at be this from have or by one had not but what all were when we there can an your which their said if do will each about how up out them then she many some so these would other into has more her two like him see time could no make than first been its who now people my made over did down only way find use may water long little very after words called just where most know".split()


def sentence(seed: int, n: int) -> str:
    x, out = seed * 7919 + 13, []
    for _ in range(n):
        x = (x * 1103515245 + 12345) % 2**31
        out.append(WORDS[(x >> 8) % len(WORDS)] + ("" if x % 3 else str((x >> 16) % 50)))
    return " ".join(out)


@pytest.fixture(scope="session")
def edge_docs(spark):
    """Nulls in every column, empty and long texts, ties, repeated rows, and columns with clashing names."""
    long = sentence(5, 30_000)
    common = "shared line of many documents"
    rows = [(i, sentence(i, 60) + f"\n{common}\n" + sentence(i + 100, 20)) for i in range(12)]
    rows += [(20, rows[0][1]), (21, rows[0][1].upper()), (22, rows[1][1] + " extra words here"), (23, ""), (24, None), (25, " \t\n "), (26, "one"), (27, "one two three")]
    rows += [(30, long), (31, long + " end"), (None, rows[2][1]), (None, None), (26, "one"), (26, "one"), (40, "a\x00b \u00e9 \U0001f600 </s>")]
    data = [(d, t, "en" if d else None, "s", len(t or ""), 1, "k", "h", None) for d, t in rows]
    return spark.createDataFrame(data, "doc_id long, text string, lang string, source string, n_chars long, count int, key string, id string, fp string")


@pytest.fixture(scope="session")
def no_docs(edge_docs):
    return edge_docs.where("false")

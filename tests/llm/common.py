"""Small frames and plain-Python versions shared by the tests."""

from __future__ import annotations

LONG = "lorem ipsum dolor sit amet " * 20_000


def documents(spark, rows):
    """Rows of (doc_id, text), with the other columns and some that clash with names used inside."""
    full = [(i, t, "en", f"src{(i or 0) % 3}", len(t or ""), "x", 7, -1, "y", 0.5) for i, t in rows]
    return spark.createDataFrame(
        full,
        "doc_id bigint, text string, lang string, source string, n_chars bigint, key string, n bigint, component bigint, `group` string, score double",
    )


ODD = [
    (1, None),
    (2, ""),
    (3, " \n\t \n"),
    (4, "word"),
    (5, "Same line here today, friends.\nSame line here today, friends.\n"),
    (5, "Same line here today, friends.\nSame line here today, friends.\n"),
    (6, "same LINE here today, friends.\nsame line here today, friends.\n"),
    (7, LONG),
    (8, LONG),
    (9, "é ß 漢字 😀 \x00   end"),
    (None, "a row without a key but with some words in it for good measure"),
    (None, None),
]


def groups(n, links):
    """Smallest member reachable from each of ``n``."""
    parent = {i: i for i in n}

    def top(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in links:
        a, b = top(a), top(b)
        if a != b:
            parent[max(a, b)] = min(a, b)
    return {i: top(i) for i in n}

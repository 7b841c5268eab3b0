"""Small corpora for the tests of the subpackage."""

from __future__ import annotations

import random

SYLLABLES = "ka lo mi ru ten sha vor pel ing dro nas ek fi gul hem tra qui bo".split()


def prose(seed: int, words: int) -> str:
    r = random.Random(seed)
    made = ("".join(r.choice(SYLLABLES) for _ in range(r.randint(1, 4))) for _ in range(words))
    return " ".join(w.capitalize() + "." if i % 9 == 0 else w for i, w in enumerate(made))


#: Columns whose names the operators use inside.
CLASHING = "row version line key gone _id _text text_ _row n_dropped prefix cell bits label score copy"


def awkward(spark, texts: list[tuple]):
    """Rows (doc_id, text) with extra columns of clashing names."""
    extra = CLASHING.split()
    rows = [(i, t, *["x"] * len(extra)) for i, t in texts]
    return spark.createDataFrame(rows, "doc_id long, text string, " + ", ".join(f"`{c}` string" for c in extra))


#: NULLs in both columns, empty, blank and long texts, repeated rows and ids, ties.
AWKWARD = [
    (1, prose(1, 60)),
    (2, None),
    (3, ""),
    (4, "   \n\t "),
    (5, prose(5, 6000)),
    (6, prose(1, 60)),
    (6, prose(1, 60)),
    (7, prose(7, 30) + "\n" + prose(1, 60)),
    (7, prose(8, 30)),
    (None, prose(9, 40)),
    (None, None),
    (8, "x" * 30000),
    (9, "one"),
    (10, "É ß 中文 😀 ́ İ\x0b\x0c\r end"),
]


def collected(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=lambda r: [(v is not None, str(v)) for v in r])
